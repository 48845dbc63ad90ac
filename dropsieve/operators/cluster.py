"""Graph clustering by modularity to a local optimum, in rounds of DataFrame joins.

In a round every node looks for the neighbouring cluster it gains most by moving to. All that gain
cannot move at once, so a round makes only moves that raise modularity together:

* a cluster either takes nodes or gives them, by which of the two gains more. Moves from giving to
  taking clusters leave each other's links as they are, or better. Made are those that gain more than
  all the masses that come to their target and leave their source could take away from them;
* where there is no such move, those that gain most of all moves at both their source and target.

The best move of all is among the latter, so the search ends only where no move is left; modularity
rises with every round, so there is an end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import SAMPLE
from dropsieve.functions.sizing import fits_broadcast
from dropsieve.operators.ranks import distributed_rank
from dropsieve.session import Scratch

# Gains are compared at this many decimals; a gain is more than none at them.
DECIMALS = 9


def adjacency(edges: DataFrame) -> DataFrame:
    """Both directions of the undirected edges ``sample_id, src1, src2, weight``."""
    one = edges.select(SAMPLE, F.col("src1").alias("u"), F.col("src2").alias("v"), F.col("weight").alias("a"))
    return one.unionByName(one.select(SAMPLE, F.col("v").alias("u"), F.col("u").alias("v"), "a"))


def modularity(adj: DataFrame, labels: DataFrame, resolution: float) -> DataFrame:
    """Modularity ``q`` of a labelling per sample."""
    lu = labels.select(SAMPLE, "u", F.col("c").alias("cu"))
    lv = labels.select(SAMPLE, F.col("u").alias("v"), F.col("c").alias("cv"))
    same = F.when(F.col("cu") == F.col("cv"), F.col("a")).otherwise(0.0)
    per = (
        adj.join(lu, [SAMPLE, "u"])
        .join(lv, [SAMPLE, "v"])
        .groupBy(SAMPLE, "cu")
        .agg(F.sum(same).alias("inside"), F.sum("a").alias("k"))
    )
    k, total = F.col("k"), F.sum("k")
    return per.groupBy(SAMPLE).agg(
        (F.sum("inside") / total - resolution * F.sum(k * k) / (total * total)).alias("q")
    )


def _nodes(adj: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every node with its weight ``k`` and the weight ``m2`` of its sample, alone or in its cluster ``c`` if given."""
    own = adj.groupBy(SAMPLE, "u").agg(F.sum("a").alias("k"))
    total = own.groupBy(SAMPLE).agg(F.sum("k").alias("m2"))
    k = F.coalesce("k", F.lit(0.0))
    return (
        nodes.select(SAMPLE, F.col("id").alias("u"), F.col("c" if "c" in nodes.columns else "id").alias("c"))
        .join(own, [SAMPLE, "u"], "left")
        .join(F.broadcast(total) if fits_broadcast(total) else total, SAMPLE, "left")
        .select(SAMPLE, "u", "c", k.alias("k"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
    )


def gains(adj: DataFrame, state: DataFrame, resolution: float) -> DataFrame:
    """The best move of every node that gains: ``u, k, m2, c`` to ``to``, and its ``gain``.

    Modularity rises by ``2 * gain / m2``. Among equal gains the smallest label is taken.
    """
    mass = state.groupBy(SAMPLE, "c").agg(F.sum("k").alias("kc"))
    placed = state.join(mass, [SAMPLE, "c"])
    there = placed.select(SAMPLE, F.col("u").alias("v"), F.col("c").alias("to"), F.col("kc").alias("kt"))
    links = (
        adj.where("u <> v")
        .join(there, [SAMPLE, "v"])
        .groupBy(SAMPLE, "u", "to")
        .agg(F.sum("a").alias("w"), F.any_value("kt").alias("kt"))
    )
    each = links.join(placed, [SAMPLE, "u"])
    pull = F.col("w") - resolution * F.col("k") * F.col("kt") / F.col("m2")
    home = F.col("to") == F.col("c")
    # Without a link home a node keeps its share of the mass there, less its own.
    stay = F.coalesce(F.max(F.when(home, F.col("w"))), F.lit(0.0))
    rest = F.any_value("k") * (F.any_value("kc") - F.any_value("k")) / F.any_value("m2")
    best = each.groupBy(SAMPLE, "u").agg(
        *(F.any_value(x).alias(x) for x in ("c", "k", "m2")),
        F.min(F.when(~home, F.struct((-F.round(pull, DECIMALS)).alias("loss"), "to"))).alias("b"),
        (stay - resolution * rest).alias("stay"),
    )
    gain = F.round(-F.col("b.loss") - F.col("stay"), DECIMALS)
    found = best.where("b IS NOT NULL").select(SAMPLE, "u", "c", "k", "m2", F.col("b.to").alias("to"), gain.alias("gain"))
    return found.where("gain > 0")


def _per_cluster(moves: DataFrame, *sums) -> DataFrame:
    """``sums`` over the moves from or to each cluster; ``e.into`` tells which."""
    ends = F.array(
        F.struct(F.col("c").alias("at"), F.lit(False).alias("into")),
        F.struct(F.col("to").alias("at"), F.lit(True).alias("into")),
    )
    return moves.withColumn("e", F.explode(ends)).groupBy(SAMPLE, F.col("e.at").alias("at")).agg(*sums)


def _at_both_ends(moves: DataFrame, per: DataFrame) -> DataFrame:
    """``moves`` with the values of ``per`` at their source and at their target."""
    cols = [x for x in per.columns if x not in (SAMPLE, "at")]
    for side in ("c", "to"):
        named = per.select(SAMPLE, F.col("at").alias(side), *(F.col(x).alias(f"{x}_{side}") for x in cols))
        moves = moves.join(named, [SAMPLE, side])
    return moves


def _together(moves: DataFrame, resolution: float, salt: int) -> DataFrame:
    """Moves from giving to taking clusters that gain whatever the others do: ``u, to``."""
    def total(x: str, into: bool):
        return F.sum(F.when(F.col("e.into") if into else ~F.col("e.into"), F.col(x)).otherwise(0.0))

    net = F.round(total("gain", True) - total("gain", False), DECIMALS)
    coin = F.pmod(F.xxhash64("at", F.lit(salt)), F.lit(2)) == 0
    per = _per_cluster(
        moves, net.alias("net"), total("k", True).alias("comes"), total("k", False).alias("goes")
    ).select(SAMPLE, "at", ((F.col("net") > 0) | (F.col("net") == 0) & coin).alias("takes"), "comes", "goes")
    lost = resolution * F.col("k") * (F.col("comes_to") + F.col("goes_c") - 2 * F.col("k")) / F.col("m2")
    safe = ~F.col("takes_c") & F.col("takes_to") & (F.col("gain") > F.round(lost, DECIMALS))
    return _at_both_ends(moves, per).where(safe).select(SAMPLE, "u", "to")


def _one_by_one(moves: DataFrame) -> DataFrame:
    """Of the moves that touch a cluster the best one, where it is the best at both its ends."""
    mine = F.struct("gain", "u")
    best = _at_both_ends(moves, _per_cluster(moves, F.max(mine).alias("top")))
    return best.where((F.col("top_c") == mine) & (F.col("top_to") == mine)).select(SAMPLE, "u", "to")


def moved(adj: DataFrame, state: DataFrame, resolution: float, salt: int, scratch: Scratch) -> DataFrame | None:
    """The nodes after one round; None if no move gains."""
    moves = scratch.keep(gains(adj, state, resolution))
    if moves.isEmpty():
        return None
    made = scratch.keep(_together(moves, resolution, salt))
    if made.isEmpty():
        made = _one_by_one(moves)
    label = F.coalesce("to", "c").alias("c")
    return scratch.keep(state.join(made, [SAMPLE, "u"], "left").select(SAMPLE, "u", label, "k", "m2"))


def _contracted(adj: DataFrame, state: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Edges between clusters, and the clusters as nodes."""
    lu = state.select(SAMPLE, "u", F.col("c").alias("cu"))
    lv = state.select(SAMPLE, F.col("u").alias("v"), F.col("c").alias("cv"))
    edges = (
        adj.join(lu, [SAMPLE, "u"])
        .join(lv, [SAMPLE, "v"])
        .groupBy(SAMPLE, F.col("cu").alias("u"), F.col("cv").alias("v"))
        .agg(F.sum("a").alias("a"))
    )
    whole = state.groupBy(SAMPLE, F.col("c").alias("u")).agg(F.sum("k").alias("k"), F.any_value("m2").alias("m2"))
    return scratch.keep(edges), scratch.keep(whole.select(SAMPLE, "u", F.col("u").alias("c"), "k", "m2"))


def labels(edges: DataFrame, nodes: DataFrame, resolution: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Adjacency and the nodes ``sample_id, u, c, k, m2`` at a local optimum, as stored tables.

    Clusters merge round by round until no merge gains, then nodes move until no move gains; both are
    repeated until neither finds anything. So at the end neither moving a node to a neighbouring
    cluster nor merging two clusters raises modularity. The search starts from the clusters ``c`` of
    ``nodes``, if given.
    """
    scratch, out = Scratch(edges.sparkSession, "rounds"), Scratch(edges.sparkSession, "clusters")
    adj = out.keep(adjacency(edges))
    best = scratch.keep(_nodes(adj, nodes))
    merged = "c" in nodes.columns
    graph, parts = _contracted(adj, best, scratch) if merged else (adj, best)
    salt = seed
    while True:
        while (now := moved(graph, parts, resolution, salt, scratch)) is not None:
            salt, merged = salt + 1, True
            to = now.select(SAMPLE, F.col("u").alias("c"), F.col("c").alias("to"))
            best = scratch.keep(best.join(to, [SAMPLE, "c"]).select(SAMPLE, "u", F.col("to").alias("c"), "k", "m2"))
            graph, parts = _contracted(graph, now, scratch)
        shifted = False
        while merged and (now := moved(adj, best, resolution, salt, scratch)) is not None:
            salt, shifted, best = salt + 1, True, now
        if not shifted:
            best = out.keep(best)
            scratch.clear()
            return adj, best
        graph, parts = _contracted(adj, best, scratch)
        merged = False


def _links(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """All links between units of classes, summed, from ``pairs`` of classes; those inside a unit link it to itself."""
    one, other = (
        units.select(SAMPLE, F.col("cls").alias(f"src{i}"), F.col("u").alias(f"u{i}"), F.col("m").alias(f"m{i}"), F.col("inner").alias(f"i{i}"))
        for i in (1, 2)
    )
    weight = F.col("m1") * F.col("m2") * F.col("weight")
    between = pairs.select(SAMPLE, "src1", "src2", "weight").join(one, [SAMPLE, "src1"]).join(other, [SAMPLE, "src2"])
    alike = (
        one.where("i1 > 0").withColumnRenamed("src1", "cls").join(other.withColumnRenamed("src2", "cls"), [SAMPLE, "cls"])
        .where("u1 < u2 OR u1 = u2 AND m1 > 1")
    )
    inside = F.when(F.col("u1") < F.col("u2"), F.col("m1") * F.col("m2")).otherwise(F.col("m1") * (F.col("m1") - 1) / 2)
    named = (SAMPLE, F.col("u1").alias("src1"), F.col("u2").alias("src2"))
    return between.select(*named, weight.alias("weight")).unionByName(
        alike.select(*named, (inside * F.col("i1")).alias("weight"))
    )


def _split(member: DataFrame, gain: DataFrame, resolution: float) -> DataFrame:
    """``member`` with a part of each unit in ``gain`` as a unit of its own, about as large as gains most by its move.

    ``t`` of ``m`` nodes alike gain ``t * g + t * (t - 1) * b`` if one gains ``g``. ``b`` is below 0, or the
    whole unit would have gained.
    """
    one = F.col("k") / F.col("m")
    b = resolution * one * one / F.col("m2") - F.col("inner")
    t = F.when(b > 0, F.round((F.col("gain") * F.col("m2") / 2 / b + 1) / 2)).otherwise(F.col("m") / 2)
    share = F.least(F.greatest(t, F.lit(1.0)), F.col("m") - 1) / F.col("m")
    at = member.withColumn("h", F.xxhash64("id"))
    ends = (
        at.join(gain.select(SAMPLE, "u", share.alias("share")), [SAMPLE, "u"]).groupBy(SAMPLE, "u")
        .agg(
            # The node that names the unit stays; at least one other leaves.
            F.min(F.when(F.col("id") != F.col("u"), F.col("h"))).cast("double").alias("lo"),
            F.max("h").cast("double").alias("hi"),
            F.any_value("share").alias("share"),
        )
    )
    cut = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("share")
    off = F.coalesce((F.col("id") != F.col("u")) & (F.col("h").cast("double") <= cut), F.lit(False))
    marked = at.join(F.broadcast(ends) if fits_broadcast(ends) else ends, [SAMPLE, "u"], "left").withColumn("off", off)
    new = marked.where("off").groupBy(SAMPLE, "u").agg(F.max(F.struct("h", "id")).alias("last"))
    new = new.select(SAMPLE, "u", F.lit(True).alias("off"), F.col("last.id").alias("to"))
    return marked.join(F.broadcast(new) if fits_broadcast(new) else new, [SAMPLE, "u", "off"], "left").select(
        SAMPLE, "id", "cls", "inner", F.coalesce("to", "u").alias("u"), F.col("u").alias("was")
    )


def class_labels(pairs: DataFrame, member: DataFrame, resolution: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """As ``labels``, for nodes in classes: adjacency and units ``sample_id, u, c, k, m2, m``, as stored tables.

    ``member`` is as from ``list_classes``, ``pairs`` the links between classes. The nodes of a class move
    together, as a unit of ``m`` nodes, until no unit moves or merges. Where a single node of a unit would
    still gain, the part of the unit that gains most becomes a unit, and the search goes on. So at the end
    no move of a single node raises modularity, without the links of a class being laid out.
    """
    scratch = Scratch(pairs.sparkSession, "units")
    pairs = scratch.keep(pairs)
    member = scratch.keep(member.withColumn("u", F.col("cls")))
    size = (F.count("*").alias("m"), F.any_value("inner").alias("inner"))
    units = scratch.keep(member.groupBy(SAMPLE, "cls", "u").agg(*size))
    nodes = units.select(SAMPLE, F.col("u").alias("id"))
    while True:
        adj, found = labels(_links(pairs, units), nodes, resolution, seed)
        found = scratch.keep(found.join(units.select(SAMPLE, "u", "m", "inner"), [SAMPLE, "u"]))
        best = move_gains(adj, found, resolution).groupBy(SAMPLE, "u").agg(F.max("gain").alias("gain"))
        gain = scratch.keep(best.where("gain > 0").join(found.where("m > 1"), [SAMPLE, "u"]))
        if gain.isEmpty():
            return adj, found
        member = scratch.keep(_split(member, gain, resolution))
        units = scratch.keep(member.groupBy(SAMPLE, "cls", "u").agg(*size, F.any_value("was").alias("was")))
        place = found.select(SAMPLE, F.col("u").alias("was"), "c")
        nodes = units.join(place, [SAMPLE, "was"]).select(SAMPLE, F.col("u").alias("id"), "c")


def clusters(edges: DataFrame, nodes: DataFrame, resolution: float = 0.2, seed: int = 1000) -> DataFrame:
    """Cluster number per node, ``sample_id, id, cluster``; 0 is the largest cluster.

    ``nodes`` has ``sample_id, id``; those without an edge stay alone.
    """
    _, found = labels(edges, nodes, resolution, seed)
    return number_clusters(found.select(SAMPLE, F.col("u").alias("id"), "c"))


def move_gains(adj: DataFrame, state: DataFrame, resolution: float) -> DataFrame:
    """What modularity gains by each move of a node to a neighbouring cluster, ``u, to, gain``.

    Taken as a difference of whole sums, apart from the search, so that a labelling can be checked.
    Of a unit of ``m`` nodes one moves.
    """
    m = F.col("m") if "m" in state.columns else F.lit(1)
    lv = state.select(SAMPLE, F.col("u").alias("v"), F.col("c").alias("to"))
    mass = state.groupBy(SAMPLE, "c").agg(F.sum("k").alias("kc"))
    weight = adj.where("u <> v").join(lv, [SAMPLE, "v"]).groupBy(SAMPLE, "u", "to").agg(F.sum("a").alias("w"))
    own = state.join(weight.withColumnRenamed("to", "c").withColumnRenamed("w", "w0"), [SAMPLE, "u", "c"], "left")
    # What stays behind of the node's own unit.
    rest = adj.where("u = v").groupBy(SAMPLE, "u").agg(F.sum("a").alias("wu"))
    at = own.join(mass, [SAMPLE, "c"]).join(rest, [SAMPLE, "u"], "left")
    own_unit = F.coalesce("wu", F.lit(0.0)) if "m" in state.columns else F.lit(0.0)
    w0 = (F.coalesce("w0", F.lit(0.0)) + own_unit) / m
    there = mass.select(SAMPLE, F.col("c").alias("to"), F.col("kc").alias("kt"))
    m2, kc, kt = (F.col(x) for x in ("m2", "kc", "kt"))
    k = F.col("k") / m

    def inside(w, total):
        return 2 * w - resolution * total * total / m2

    before = inside(F.lit(0.0), kt) + inside(w0, kc)
    after = inside(F.col("w") / m, kt + k) + inside(F.lit(0.0), kc - k)
    moves = weight.join(at, [SAMPLE, "u"]).where("to <> c").join(there, [SAMPLE, "to"])
    return moves.select(SAMPLE, "u", "to", F.round((after - before) / m2, DECIMALS).alias("gain"))


def number_clusters(member: DataFrame) -> DataFrame:
    """Numbers labels by falling size, ties by a hash of the label.

    A sample may have as many single-node labels as nodes, so the numbers come
    from the distributed rank.
    """
    size = member.groupBy(SAMPLE, "c").agg(F.count("*").alias("size"))
    ordinal = size.withColumn("ord", F.xxhash64("c"))
    ranked = distributed_rank(ordinal, "size", run=1 << 48)
    number = ranked.select(SAMPLE, "c", (F.col("rank") - 1).cast("int").alias("cluster"))
    return member.join(number, [SAMPLE, "c"]).select(SAMPLE, "id", "cluster")


def count_clusters(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(SAMPLE).agg(F.count_distinct("cluster").alias("n_clusters"))
