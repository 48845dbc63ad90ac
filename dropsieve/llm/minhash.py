"""Near-duplicate documents by one-permutation MinHash and star-shaped candidates.

One hash of every shingle falls into one of ``BINS`` bins by its leading bits; the smallest of a bin
is its value, and an empty bin copies a full one that a hash of its own chooses (optimal
densification). Bins are joined to bands, equal bands to buckets. A bucket emits no pairs but a star:
its members meet its centre, the one that shares most bands with others, and every candidate is
confirmed on the full sets. Where a bucket then still holds more than one component, its members go
through an exact join on their rarest shingles, so that no link between two members of a bucket is
lost for not being one with the centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.llm.common import (
    U,
    arrow_map,
    byte_prefix,
    drop,
    mix,
    parts,
    prefix,
    small_side,
    span_hash,
    stored,
    words,
)
from dropsieve.llm.graph import components

BANDS, ROWS = 40, 5
BINS = BANDS * ROWS

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text, A-Z taken as a-z.

    A text of fewer words than ``width`` has its whole sequence as its one shingle; without a word
    it has none.
    """
    buf = _LOW[buf]
    start, end, text = words(buf, off)
    word = prefix(span_hash(byte_prefix(buf), start, end))
    at = np.searchsorted(text, np.arange(len(off)))
    first = np.arange(len(start))
    last = np.minimum(first + width, at[text + 1])
    full = span_hash(word, first, last)
    for i in range(len(off) - 1):
        a, b = at[i], at[i + 1]
        yield np.unique(full[a : max(b - width + 1, min(a + 1, b))])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Densified bin values of non-empty sets, a row each."""
    n = len(sets)
    h = np.concatenate(sets)
    own = np.repeat(np.arange(n), [len(s) for s in sets])
    place = own * BINS + (((h >> U(32)) * U(BINS)) >> U(32)).astype(np.int64)
    first = np.ones(len(h), bool)
    first[1:] = place[1:] != place[:-1]
    full = np.zeros(n * BINS, bool)
    full[place[first]] = True
    value = np.zeros(n * BINS, np.uint64)
    value[place[first]] = h[first]
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        attempt += 1
        bins = (empty % BINS).astype(np.uint64)
        if attempt < 20 * BINS:
            to = mix(bins * U(0x9E3779B97F4A7C15) + U(attempt)) % U(BINS)
        else:
            to = (bins + U(attempt)) % U(BINS)  # ends for sure
        source = empty // BINS * BINS + to.astype(np.int64)
        hit = full[source]
        value[empty[hit]] = value[source[hit]]
        empty = empty[~hit]
    return value.reshape(n, BINS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    x = mix(signature).reshape(len(signature), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * U(0xA0761D6478BD642F)
    for r in range(ROWS):
        key = mix(key ^ x[:, :, r]) + U(r)
    return key


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (d1, d2) and its bands (null: empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in parts(b.column("text")):
                sets = list(shingle_sets(buf, off, width))
                n = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(n)
                digests = np.zeros((2, len(sets)), np.uint64)
                for k in some:
                    digests[0, k] = np.sum(mix(sets[k]))
                    digests[1, k] = np.sum(mix(sets[k] ^ U(0xD6E8FEB86659FD93)))
                bands: list = [None] * len(sets)
                if len(some):
                    keys = band_keys(signatures([sets[k] for k in some])).view(np.int64)
                    for k, row in zip(some.tolist(), keys):
                        bands[k] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(i, j - i),
                        pa.array(n),
                        *(pa.array(d.view(np.int64)) for d in digests),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in parts(b.column("text")):
                rows = [s.view(np.int64) for s in shingle_sets(buf, off, width)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(rows, pa.list_(pa.int64()))],
                    ["id", "shingles"],
                )

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return arrow_map(docs, run, "id long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets share at least ``percent`` of their union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(right, "b")
        # Sizes alone rule many out before the sets meet.
        .withColumn("nb", F.size("sb"))
        .join(left, "a")
        .where(100 * F.least(F.size("sa"), "nb") >= percent * F.greatest(F.size("sa"), "nb"))
        .where((100 + percent) * both >= percent * (F.size("sa") + F.col("nb")))
        .select("a", "b")
    )


def _placed(members: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return members.withColumn("component", F.col("rep"))
    of = F.coalesce("component", "rep").alias("component")
    return members.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("key", "rep", of)


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of ``members`` (rep, component) in different components that can be similar enough.

    Two sets that share ``percent`` of their union share one of their rarest shingles: of a set of n
    the ``n - ceil(percent * n / 100) + 1`` rarest, in one order for all. What only one set holds
    joins nothing, so an edited copy brings its own shingles to its front and meets few.
    """
    tokens = sets.join(members.select(F.col("rep").alias("id")), "id", "left_semi").select(
        "id", F.size("shingles").alias("n"), F.explode("shingles").alias("s")
    )
    often = tokens.groupBy("s").agg(F.count("*").alias("f"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("f", "s"))
    whole = 100 + percent
    front = (
        tokens.join(often, "s")
        .withColumn("place", place)
        .where(f"place <= n - ({percent} * n + 99) div 100 + 1 AND f > 1")
        .join(members.withColumnRenamed("rep", "id"), "id")
        .select("s", "id", "n", "component", "place")
    )
    mixed = front.groupBy("s").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    front = stored(front.join(mixed.where("lo < hi").select("s"), "s", "left_semi"), "front")
    # The smaller set of a pair has a shared shingle even further in front, and from the first that
    # they share on there is room for as many as they need.
    index = front.where(f"place <= n - (2 * {percent} * n + {whole - 1}) div {whole} + 1")
    other = front.toDF("s", "b", "nb", "cb", "pb")
    need = f"({percent} * (n + nb) + {whole - 1}) div {whole}"
    return (
        index.join(other, "s")
        .where("component <> cb AND (n < nb OR n = nb AND id < b)")
        .where(f"100 * n >= {percent} * nb AND 1 + least(n - place, nb - pb) >= {need}")
        .select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked when their sets of ``width``-word shingles share at least ``percent`` of
    the union. component_id is the smallest doc_id that links reach. A null text and one without a
    word have an empty set and no link. Rows that repeat a doc_id with the same text stand or fall
    together. A null doc_id is linked with nothing, has a null component and is kept. Columns other
    than doc_id and text are not read.

    Documents with equal sets are one class from the start, however many; only its smallest doc_id
    takes part in what follows.
    """
    all_docs = stored(sketches(docs, width), "sketches")
    some = all_docs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    digest = ["d1", "d2", "n_shingles"]
    classes = stored(some.groupBy(*digest).agg(F.min("doc_id").alias("rep")), "classes")
    keys = some.join(
        classes.withColumnRenamed("rep", "doc_id"), [*digest, "doc_id"], "left_semi"
    ).select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("n"))
    buckets = stored(
        keys.join(shared.where("lo < hi").select("key", "n"), "key").distinct(), "buckets"
    )
    # How many others share a document's bands tells how central it is among them.
    members = buckets.groupBy(F.col("rep").alias("id")).agg(F.sum("n").alias("popular"))
    members = stored(members, "members")
    wanted = members.select(F.col("id").alias("doc_id"))
    sets = full_sets(docs.where("doc_id IS NOT NULL").join(small_side(wanted), "doc_id", "left_semi"), width)
    sets = stored(sets.dropDuplicates(["id"]), "sets")

    ranked = buckets.join(members.withColumnRenamed("id", "rep"), "rep")
    leads = ranked.groupBy("key").agg(F.min(F.struct(-F.col("popular"), "rep")).alias("lead"))
    leads = stored(leads.select("key", F.col("lead.rep").alias("lead")), "leads")
    pairs = (
        buckets.join(leads, "key")
        .where("rep <> lead")
        .select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b"))
        .distinct()
    )
    links = stored(confirmed(pairs, sets, percent), "confirmed")
    found = None if links.isEmpty() else stored(components(links), "components")

    # The centre has met all; what is open are links between others in different components.
    rest = buckets.join(leads, "key").where("rep <> lead").select("key", "rep")
    rest = _placed(rest, found)
    open_keys = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    rest = rest.join(open_keys.where("lo < hi").select("key"), "key", "left_semi")
    rest = stored(rest.select("rep", "component").distinct(), "open")
    if not rest.isEmpty():
        more = stored(confirmed(prefix_pairs(rest, sets, percent), sets, percent), "confirmed")
        if not more.isEmpty():
            new = more.unionByName(links)
            found = stored(components(new), "components")
    drop(buckets, members, leads, rest)
    out = all_docs.join(classes, digest, "left")
    if found is not None:
        out = out.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    of = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", of.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, of which one document of each group stays."""
    gone = near_duplicates(docs, width, percent).where("NOT kept").select("doc_id").distinct()
    gone = stored(gone, "near-copies")
    return docs.join(small_side(gone), "doc_id", "left_anti").select(*docs.columns)
