"""Nearest neighbours and the shared-neighbour graph, per sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dropsieve.functions.scalars import SAMPLE
from dropsieve.functions.sizing import fits_broadcast, sized
from dropsieve.session import checkpoint

# Squared distances are compared at this many decimals; ties go to the smaller id.
DECIMALS = 9
# Bounds are widened by this share, far beyond what rounding changes.
SLACK = 1e-4
# Rows that meet a block at once, and blocks that one task searches for, at most about.
PIECE_ROWS = 1024
GROUP_BLOCKS = 8
# Bytes of a batch of pieces.
BATCH_BYTES = 16 << 20


def _nearest(a: np.ndarray, b: np.ndarray, k: int, same: bool):
    """Row and column of the ``k`` nearest rows of ``b`` for every row of ``a``.

    Columns are in id order, so among equal distances the smaller id wins.
    """
    bb = (b * b).sum(axis=1)
    take = min(k, len(b) - 1 if same else len(b))
    rows, cols, dist = [], [], []
    if take < 1:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    for at in range(0, len(a), 512):
        part = a[at : at + 512]
        d = (part * part).sum(axis=1)[:, None] + bb[None, :] - 2.0 * (part @ b.T)
        d = np.round(np.maximum(d, 0.0), DECIMALS)
        if same:
            i = np.arange(len(part))
            d[i, at + i] = np.inf
        limit = np.partition(d, take - 1, axis=1)[:, take - 1]
        r, c = np.nonzero(d <= limit[:, None])
        v = d[r, c]
        order = np.lexsort((c, v, r))
        r, c, v = r[order], c[order], v[order]
        first = np.searchsorted(r, np.arange(len(part)))
        keep = np.arange(len(r)) - first[r] < take
        rows.append(r[keep] + at)
        cols.append(c[keep])
        dist.append(v[keep])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


class _Nearest:
    """The ``k`` nearest so far of the rows of a block, among the pieces that it has met.

    Products in single precision leave out what lies beyond the ``k``-th so far by more than they can
    err; what is left is compared by exact differences. Equal distances go to the smaller ``ords``.
    """

    def __init__(self, x: np.ndarray, ords: np.ndarray, k: int):
        self.x, self.ords, self.k = x, ords, k
        finite = np.isfinite(x).all(axis=1)
        self.mid = x[finite].mean(axis=0) if finite.any() else np.zeros(x.shape[1])
        y = x - self.mid
        self.sq = (y * y).sum(axis=1)
        self.side = np.concatenate([y, np.ones((len(y), 1))], axis=1)
        self.low = self.side.astype(np.float32)
        self.d2 = np.full((len(x), k), np.inf)
        self.at = np.full((len(x), k), -1, np.int64)
        self.ids = np.empty((len(x), k), object)

    def meet(self, b: np.ndarray, ords: np.ndarray, ids: np.ndarray) -> None:
        """``b`` in the order of its ``ords``."""
        y = b - self.mid
        sq = (y * y).sum(axis=1)
        # The product of a row and a column is (row ** 2 - distance ** 2) / 2.
        other = np.concatenate([y, -sq[:, None] / 2], axis=1)
        most = sq.max(initial=0.0)
        low = max(most, self.sq.max(initial=0.0)) < 1e30
        mine, other = (self.low, other.astype(np.float32)) if low else (self.side, other)
        slack = (b.shape[1] + 8) * 2.0**-22 * (self.sq + most) + 10.0**-DECIMALS
        for begin in range(0, len(self.x), 2048):
            rows = slice(begin, begin + 2048)
            g = mine[rows] @ other.T
            least = (self.sq[rows] - self.d2[rows, -1] - slack[rows]) / 2
            new = np.isinf(self.d2[rows, -1])
            if new.any() and len(b) > self.k + 1:
                place = len(b) - self.k - 1
                least[new] = np.partition(g[new], place, axis=1)[:, place] - slack[rows][new]
            r, c = np.divmod(np.flatnonzero(g >= least[:, None].astype(g.dtype)), len(b))
            if len(r) > 64 * len(g):
                r, c, _ = _nearest(self.x[rows], b, self.k + 1, False)
            self._take(r + begin, c, b, ords, ids)

    def _take(self, r: np.ndarray, c: np.ndarray, b: np.ndarray, ords: np.ndarray, ids: np.ndarray) -> None:
        other = self.ords[r] != ords[c]
        r, c = r[other], c[other]
        d = np.empty(len(r))
        for at in range(0, len(r), 65_536):
            part = slice(at, at + 65_536)
            d[part] = ((self.x[r[part]] - b[c[part]]) ** 2).sum(axis=1)
        d = np.round(d, DECIMALS)
        last = self.d2[r, -1]
        better = (d < last) | ((d == last) & (ords[c] < self.at[r, -1]))
        r, c, d = r[better], c[better], d[better]
        if not len(r):
            return
        rows, n = np.unique(r, return_inverse=True)
        n = np.concatenate([np.repeat(np.arange(len(rows)), self.k), n])
        d2 = np.concatenate([self.d2[rows].ravel(), d])
        at = np.concatenate([self.at[rows].ravel(), ords[c]])
        names = np.concatenate([self.ids[rows].ravel(), ids[c]])
        order = np.lexsort((at, d2, n))
        best = order[np.searchsorted(n[order], np.arange(len(rows)))[:, None] + np.arange(self.k)]
        self.d2[rows], self.at[rows], self.ids[rows] = d2[best], at[best], names[best]


def _by_sample(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["vec"].to_list())


def _numbered(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    n = vectors.groupBy(SAMPLE).agg(F.count("*").alias("_n"))
    return vectors.select(
        SAMPLE, F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
    ).join(sized(n), SAMPLE)


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number ``ord`` that rises with the id within a sample; to be read once or stored."""
    dealt = rows.repartitionByRange(SAMPLE, "id").sortWithinPartitions(SAMPLE, "id")
    return dealt.withColumn("ord", F.monotonically_increasing_id())


def ball_blocks(
    vectors: DataFrame, id_col: str = "id", vec_col: str = "vec", block_rows: int = 4096
) -> DataFrame:
    """Rows dealt to the blocks of a ball partition: ``sample_id, id, ord, vec, ball, part, off``.

    ``ord`` rises with the id within a sample.
    The centres are rows taken by a hash of their id, one in ``block_rows`` on average and at least
    one a sample. Each row belongs to its nearest centre, ``off`` its distance to it; a ball with many
    more rows than a block is split by hash, so that no block is large, whatever the data.
    """
    rows = _numbered(vectors, id_col, vec_col)
    chunks = F.ceil(F.col("_n") / block_rows).cast("int")
    chosen = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(block_rows)) == 0
    first = rows.groupBy(SAMPLE).agg(F.min(F.struct(F.xxhash64("id", F.lit(2)), "id")).alias("m"))
    lone = first.select(SAMPLE, F.col("m.id").alias("id"))
    centres = (
        rows.join(lone.withColumn("_lone", F.lit(True)), [SAMPLE, "id"], "left")
        .where(chosen | F.col("_lone"))
        .withColumn("to", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(F.col(SAMPLE).alias("of"), F.col("id").alias("ball"), F.col("vec").alias("centre"), "to")
    )
    dealt = _ordered(rows).withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))

    def assign(own: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return pd.DataFrame({SAMPLE: [], "id": [], "ord": [], "vec": [], "ball": [], "off": []})
        centre = centre.sort_values("ball")
        c, names = np.stack(centre["centre"].to_list()), centre["ball"].to_numpy()
        x = _by_sample(own)
        ball, off = [], []
        for at in range(0, len(x), 1024):
            part = x[at : at + 1024]
            d = (part * part).sum(1)[:, None] + (c * c).sum(1) - 2.0 * (part @ c.T)
            at_min = d.argmin(axis=1)
            ball.append(names[at_min])
            off.append(np.sqrt(((part - c[at_min]) ** 2).sum(axis=1)))
        return pd.DataFrame(
            {SAMPLE: own[SAMPLE], "id": own["id"], "ord": own["ord"], "vec": own["vec"], "ball": np.concatenate(ball), "off": np.concatenate(off)}
        )

    kind = rows.schema["id"].dataType.simpleString()
    placed = (
        dealt.groupBy(SAMPLE, "chunk")
        .cogroup(centres.groupBy("of", "to"))
        .applyInPandas(assign, f"{SAMPLE} string, id {kind}, ord long, vec array<double>, ball {kind}, off double")
    )
    # Stored: everything that follows reads it, and the splits depend on its counts.
    placed = checkpoint(placed)
    count = placed.groupBy(SAMPLE, "ball").agg(F.ceil(F.count("*") / (2 * block_rows)).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("id", F.lit(3)), F.col("_parts")).cast("int").alias("part")
    return placed.join(sized(count), [SAMPLE, "ball"]).select(SAMPLE, "id", "ord", "vec", "ball", part, "off")


def _within(blocks: DataFrame, k: int, kind: str) -> DataFrame:
    """The blocks in pieces of at most ``PIECE_ROWS``: ``ids``, ``ords`` and the numbers ``vecs`` as bytes.

    With them the block's ``radius`` and ``rows``, and ``inside``, which the ``k`` nearest of none of its
    rows in the block exceed; null where the block has no ``k`` others.
    """

    def own(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord").combine_chunks()
        x = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)
        ords = table.column("ord").to_numpy()
        at = range(0, len(x), PIECE_ROWS)
        near = _Nearest(x, ords, k)
        for i in at:
            near.meet(x[i : i + PIECE_ROWS], ords[i : i + PIECE_ROWS], ords[i : i + PIECE_ROWS])
        furthest = float(np.sqrt(near.d2[:, -1].max()))
        one = table.slice(0, 1)
        lists = table.column("id").combine_chunks(), table.column("ord").combine_chunks()
        off = pa.array([*at, len(x)], pa.int32())
        n = len(at)
        out = {c: pa.array(one.column(c).to_pylist() * n, one.schema.field(c).type) for c in (SAMPLE, "ball", "part")}
        out["piece"] = pa.array(range(n), pa.int32())
        out["ids"], out["ords"] = (pa.ListArray.from_arrays(off, v) for v in lists)
        out["vecs"] = pa.array([x[i : i + PIECE_ROWS].tobytes() for i in at], pa.binary())
        out["radius"] = pa.array([table.column("off").to_numpy().max()] * n, pa.float64())
        out["rows"] = pa.array([len(x)] * n, pa.int64())
        out["inside"] = pa.array([furthest if np.isfinite(furthest) else None] * n, pa.float64())
        return pa.table(out)

    schema = (
        f"{SAMPLE} string, ball {kind}, part int, piece int, ids array<{kind}>, ords array<long>, vecs binary, "
        "radius double, rows long, inside double"
    )
    return blocks.groupBy(SAMPLE, "ball", "part").applyInArrow(own, schema)


def block_pairs(blocks: DataFrame, pieces: DataFrame, k: int) -> DataFrame:
    """Pairs of different blocks that may hold near rows of each other, by triangle bounds.

    ``sample_id, ball1, part1, ball2, part2``. No row of a block has its ``k``-th neighbour further than
    ``reach``: the furthest found inside the block, or across the nearest block that has ``k`` rows.
    Blocks whose gap (distance of the centres less both radii) exceeds the reach of both never meet.
    """
    block = pieces.where("piece = 0").select(SAMPLE, "ball", "part", "radius", "rows", "inside")
    centre = blocks.where("id = ball").select(SAMPLE, "ball", F.col("vec").alias("centre"))
    block = checkpoint(block.join(centre, [SAMPLE, "ball"]))

    def side(i: int) -> DataFrame:
        return block.select(SAMPLE, *(F.col(c).alias(f"{c}{i}") for c in block.columns if c != SAMPLE))

    square = F.aggregate(
        F.zip_with("centre1", "centre2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )
    met = (
        side(1).join(side(2), SAMPLE).where("ball1 <> ball2 OR part1 <> part2")
        .withColumn("far", F.sqrt(square))
        .select(SAMPLE, "ball1", "part1", "ball2", "part2", "inside1", "rows2", "far", (F.col("radius1") + F.col("radius2")).alias("wide"))
    )
    across = F.min(F.when(F.col("rows2") >= k, F.col("far") + F.col("wide")))
    reach = met.groupBy(SAMPLE, "ball1", "part1").agg(F.least(F.any_value("inside1"), across).alias("reach"))
    slack = SLACK * (1 + F.col("reach") + F.col("far"))
    near_by = F.col("reach").isNull() | (F.col("far") - F.col("wide") <= F.col("reach") + slack)
    wanted = met.join(reach, [SAMPLE, "ball1", "part1"]).where(near_by)
    one, other = (F.struct(F.col(f"ball{i}").alias("ball"), F.col(f"part{i}").alias("part")) for i in (1, 2))
    pair = wanted.select(SAMPLE, F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()
    return pair.select(
        SAMPLE,
        *(F.col(f"{x}.{c}").alias(f"{c}{i}") for i, x in ((1, "a"), (2, "b")) for c in ("ball", "part")),
    )


def _search(k: int, schema: pa.Schema):
    """Searches streams of pieces, each group's blocks (``asks``) before the pieces that these meet."""

    def numbers(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ords = np.array(row["ords"], np.int64)
        ids = np.empty(len(ords), object)
        ids[:] = row["ids"]
        return np.frombuffer(row["vecs"]).reshape(len(ords), -1), ords, ids

    def found(sample: str, own: dict) -> Iterator[pa.RecordBatch]:
        for ids, near in own.values():
            r, c = np.nonzero(np.isfinite(near.d2))
            cols = [np.full(len(r), sample, object), ids[r], near.ids[r, c], np.sqrt(near.d2[r, c]), (c + 1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(cols, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asks, own = None, {}, {}
        for row in (row for b in batches for i in range(len(b)) for row in b.slice(i, 1).to_pylist()):
            if (row[SAMPLE], row["grp"]) != key:
                if key is not None:
                    yield from found(key[0], own)
                key, asks, own = (row[SAMPLE], row["grp"]), {}, {}
            if row["asks"]:
                asks.setdefault((row["ball"], row["part"]), []).append(numbers(row))
                continue
            while asks:
                name, parts = asks.popitem()
                x, ords, ids = (np.concatenate(v) for v in zip(*parts))
                own[name] = ids, _Nearest(x, ords, k)
            x, ords, ids = numbers(row)
            for to in row["to"]:
                own[to["ball"], to["part"]][1].meet(x, ords, ids)
        if key is not None:
            yield from found(key[0], own)

    return run


def nearest_neighbours(
    vectors: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec", block_rows: int = 4096
) -> DataFrame:
    """Exact ``k`` nearest others of every row: ``sample_id, src, dst, dist, rank``.

    Of rows with equal vectors only the ``k + 1`` of smallest id can be among anyone's nearest. These
    are searched; the copies beyond them have the same list as the last of these.
    """
    rows = checkpoint(_ordered(vectors.select(
        SAMPLE, F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
    )).withColumn("_h", F.xxhash64("vec")))
    same = [SAMPLE, "_h", "vec"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy("ord"))
    first = checkpoint(rows.withColumn("_c", place).where(F.col("_c") <= k + 1))
    found = _searched(first.select(SAMPLE, "id", "vec"), k, block_rows)
    last = sized(first.where(F.col("_c") == k + 1).select(*same, F.col("id").alias("like"), F.col("ord").alias("_last")), 50_000)
    if last.isEmpty():
        return found
    copies = rows.join(last, same).where("ord > _last").select(SAMPLE, F.col("id").alias("src"), "like")
    item = F.struct("dst", "dist", "rank")
    lists = (
        found.withColumnRenamed("src", "like").join(last.select(SAMPLE, "like"), [SAMPLE, "like"], "left_semi")
        .groupBy(SAMPLE, "like").agg(F.collect_list(item).alias("list"))
    )
    return found.unionByName(
        copies.join(sized(lists, 50_000), [SAMPLE, "like"]).select(SAMPLE, "src", F.inline("list"))
    )


def _searched(vectors: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The ``k`` nearest of every row by search, stored.

    Rows of a sample lie in the blocks of a ball partition. Blocks meet where the triangle inequality
    does not rule it out. A task holds a group of some blocks with the nearest of their rows so far,
    while the pieces of all that these meet stream past, so only the ``k`` nearest ever leave it.
    """
    blocks = ball_blocks(vectors, block_rows=block_rows)
    kind = blocks.schema["id"].dataType.simpleString()
    pieces = checkpoint(_within(blocks, k, kind))
    pairs = checkpoint(block_pairs(blocks, pieces, k))
    block = pieces.where("piece = 0").select(SAMPLE, "ball", "part", "rows")
    # Groups of a sample: few, as each reads what it meets, but enough to keep several tasks busy.
    n = F.sum("rows").over(Window.partitionBy(SAMPLE))
    groups = F.greatest(F.ceil(n / (GROUP_BLOCKS * block_rows)), F.least(F.lit(4), F.ceil(n / block_rows)))
    group = F.pmod(F.xxhash64("ball", "part"), groups).cast("int")
    block = checkpoint(block.select(SAMPLE, "ball", "part", group.alias("grp")))
    own = block.select(SAMPLE, *(F.col(c).alias(f"{c}{i}") for i in (1, 2) for c in ("ball", "part")))
    turned = pairs.select(SAMPLE, *(F.col(f"{c}{3 - i}").alias(f"{c}{i}") for i in (1, 2) for c in ("ball", "part")))
    one, other = (F.struct(F.col(f"ball{i}").alias("ball"), F.col(f"part{i}").alias("part")) for i in (1, 2))
    met = (
        own.unionByName(pairs).unionByName(turned)
        .withColumn("mine", one == other)
        .join(block.withColumnsRenamed({"ball": "ball1", "part": "part1"}), [SAMPLE, "ball1", "part1"])
        .groupBy(SAMPLE, "grp", F.col("ball2").alias("ball"), F.col("part2").alias("part"))
        .agg(F.collect_list(one).alias("to"), (~F.max("mine")).alias("away"))
    )
    data = ("piece", "ids", "ords", "vecs")
    place = [SAMPLE, "ball", "part"]
    asks = pieces.join(sized(block), place).withColumns(
        {"asks": F.lit(True), "away": F.lit(False), "to": F.lit(None).cast(met.schema["to"].dataType)}
    )
    meets = pieces.join(sized(met), place).withColumn("asks", F.lit(False))
    cols = (SAMPLE, "grp", "asks", "away", "ball", "part", *data, "to")
    size = block.select(SAMPLE, "grp").distinct().count()
    stream = (
        asks.select(*cols).unionByName(meets.select(*cols))
        .repartition(max(min(2 * size, 4000), 1), SAMPLE, "grp")
        .sortWithinPartitions(SAMPLE, "grp", F.desc("asks"), "away", "ball", "part", "piece")
    )
    # Pieces are large rows.
    blocks.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    id_type = to_arrow_type(blocks.schema["id"].dataType)
    arrow = pa.schema([(SAMPLE, pa.string()), ("src", id_type), ("dst", id_type), ("dist", pa.float64()), ("rank", pa.int32())])
    schema = f"{SAMPLE} string, src {kind}, dst {kind}, dist double, rank int"
    return checkpoint(stream.mapInArrow(_search(k, arrow), schema))


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy(SAMPLE, "src").orderBy("d2", "dst")
    return (
        found.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select(SAMPLE, "src", "dst", F.sqrt("d2").alias("dist"), "rank")
    )


def _planes(tables: int, bits: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables * bits, width))


def approximate_neighbours(
    vectors: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "vec",
    tables: int = 8,
    probes: int = 4,
    bucket_rows: int = 512,
    seed: int = 1000,
) -> DataFrame:
    """About the ``k`` nearest others of every row, as ``nearest_neighbours`` returns them.

    Multi-probe random-projection hashing, to be chosen by name where the exact search is too dear.
    Each of ``tables`` codes has the signs of as many projections as make buckets of about
    ``bucket_rows`` rows on average. A row is stored in its bucket of each table and looks into it and
    into those reached by changing one of its ``probes`` signs that were closest to turning. A bucket
    of very many rows is dealt to parts, and the rows that look into it to as many again, which all
    meet: nothing is left out, no task holds more than two parts. With rows spread over buckets the
    work is linear in their number. Distances are exact; ties go to the smaller id.
    """
    rows = _numbered(vectors, id_col, vec_col)
    kind = rows.schema["id"].dataType.simpleString()
    place = f"tab int, code long, own boolean, {SAMPLE} string, id {kind}, vec array<double>"

    def hashed(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = _by_sample(pdf)
            n = pdf["_n"].to_numpy()
            bits = np.ceil(np.log2(np.maximum(n / bucket_rows, 1))).astype(int)
            for b in np.unique(bits):
                at = np.flatnonzero(bits == b)
                part = pdf.iloc[at]
                size = max(int(b), 1)
                p = (x[at] @ _planes(tables, size, x.shape[1], seed).T).reshape(len(at), tables, size)
                code = ((p > 0) << np.arange(size)).sum(axis=2) if b else np.zeros((len(at), tables), int)
                weak = np.argsort(np.abs(p), axis=2, kind="stable")[:, :, : min(probes, int(b))]
                for t in range(tables if b else 1):
                    looks = [(code[:, t], True)] + [(code[:, t] ^ (1 << weak[:, t, j]), False) for j in range(weak.shape[2])]
                    for c, own in looks:
                        yield pd.DataFrame(
                            {"tab": t, "code": c, "own": own, SAMPLE: part[SAMPLE], "id": part["id"], "vec": part["vec"]}
                        )

    placed = rows.mapInPandas(hashed, place)
    key = [SAMPLE, "tab", "code"]
    size = placed.groupBy(*key).agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("own") / (8 * bucket_rows))).cast("int").alias("_held"),
        F.ceil(F.count("*") / (8 * bucket_rows)).cast("int").alias("_asked"),
    )
    spread = placed.join(size, key)

    def part(count: str, salt: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(count)).cast("int")

    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    cols = (*key, "held", "asked", "id", "vec", "looks")
    held = spread.where("own").withColumns({"held": part("_held", 4), "looks": F.lit(False)}).withColumn("asked", every("_asked"))
    asks = spread.withColumns({"asked": part("_asked", 5), "looks": F.lit(True)}).withColumn("held", every("_held"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, looks = pdf["id"].to_numpy(), pdf["looks"].to_numpy()
        vec = _by_sample(pdf)
        x, y = np.flatnonzero(looks), np.flatnonzero(~looks)
        r, c, d = _nearest(vec[x], vec[y], k + 1, False)
        other = ids[x][r] != ids[y][c]
        return pd.DataFrame({SAMPLE: pdf[SAMPLE].iloc[0], "src": ids[x][r], "dst": ids[y][c], "d2": d})[other]

    schema = f"{SAMPLE} string, src {kind}, dst {kind}, d2 double"
    both = held.select(*cols).unionByName(asks.select(*cols))
    found = both.groupBy(*key, "held", "asked").applyInPandas(search, schema)
    return _top(found.groupBy(SAMPLE, "src", "dst").agg(F.min("d2").alias("d2")), k)


def shared_neighbours(knn: DataFrame, k: int, prune: float, hub_rows: int = 512) -> DataFrame:
    """Pairs of rows by the Jaccard index of their neighbour lists, from ``prune`` up.

    A list is the row itself and its ``k`` nearest others. Two lists that reach
    ``prune`` have so many members in common that at least one is among the
    rarer members of both; only those are indexed. A row that is a neighbour of
    very many others is the last to be indexed; where it still is, the rows
    around it are cut into parts of about ``hub_rows``, and each two parts meet
    under a key of their own.
    """
    own = knn.select(SAMPLE, "src").distinct().select(SAMPLE, "src", F.col("src").alias("dst"))
    members = knn.select(SAMPLE, "src", "dst").unionByName(own)
    degree = members.groupBy(SAMPLE, "dst").agg(F.count("*").alias("deg"))
    lists = (
        members.join(degree, [SAMPLE, "dst"])
        .groupBy(SAMPLE, "src")
        .agg(F.array_sort(F.collect_list(F.struct("deg", "dst"))).alias("_l"))
        .select(SAMPLE, "src", F.col("_l.dst").alias("nbrs"))
    )
    size = F.size("nbrs")
    need = F.greatest(F.lit(1), F.ceil(2 * size * prune / (1 + prune) - 1e-9).cast("int"))
    index = lists.select(
        SAMPLE, "src", "nbrs", F.explode(F.slice("nbrs", F.lit(1), size - need + 1)).alias("dst")
    )
    # The rows around one member, dealt to parts of bounded size; every two parts meet in one place.
    count = index.groupBy(SAMPLE, "dst").agg(F.ceil(F.count("*") / hub_rows).cast("int").alias("_parts"))
    hubs = count.where("_parts > 1")
    dealt = (
        index.join(hubs, [SAMPLE, "dst"], "left")
        .withColumn("_parts", F.coalesce("_parts", F.lit(1)))
        .withColumn("_p", F.pmod(F.xxhash64("src"), F.col("_parts")).cast("int"))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumns({"lo": F.least("_p", "_q"), "hi": F.greatest("_p", "_q")})
    )
    a, b = (
        dealt.select(SAMPLE, "dst", "lo", "hi", F.col("_p").alias(f"p{i}"), F.col("src").alias(f"src{i}"), F.col("nbrs").alias(f"n{i}"))
        for i in (1, 2)
    )
    both = F.array_intersect("n1", "n2")
    c = F.size("both")
    weight = c / (F.size("n1") + F.size("n2") - c)
    return (
        a.join(b, [SAMPLE, "dst", "lo", "hi"])
        .where("src1 < src2 AND (lo = hi OR p1 <> p2)")
        .withColumn("both", both)
        .where(F.get("both", F.lit(0)) == F.col("dst"))
        .select(SAMPLE, "src1", "src2", c.cast("bigint").alias("shared"), weight.alias("weight"))
        .where(F.col("weight") >= prune)
    )


def list_classes(knn: DataFrame, nodes: DataFrame) -> DataFrame:
    """``sample_id, id, cls, inner`` of every node: nodes alike in the shared-neighbour graph share ``cls``.

    Rows with the same list that are in nobody's list share the same members with everyone, and with each
    other all but themselves, ``inner`` by the Jaccard index. So the links of one, ``cls``, stand for those
    of all. Any other node is a class of its own.
    """
    lists = knn.groupBy(SAMPLE, F.col("src").alias("id")).agg(F.sort_array(F.collect_list("dst")).alias("nbrs"))
    named = knn.select(SAMPLE, F.col("dst").alias("id")).distinct()
    free = checkpoint(lists.join(named, [SAMPLE, "id"], "left_anti"))
    last = F.max(F.struct(F.xxhash64("id").alias("h"), "id")).alias("last")
    same = free.groupBy(SAMPLE, "nbrs").agg(last, F.count("*").alias("_n")).where("_n > 1")
    size = F.size("nbrs")
    alike = free.join(sized(same, 50_000), [SAMPLE, "nbrs"]).select(
        SAMPLE, "id", F.col("last.id").alias("cls"), (size / (size + 2)).alias("inner")
    )
    return nodes.select(SAMPLE, "id").join(alike, [SAMPLE, "id"], "left").select(
        SAMPLE, "id", F.coalesce("cls", "id").alias("cls"), F.coalesce("inner", F.lit(0.0)).alias("inner")
    )
