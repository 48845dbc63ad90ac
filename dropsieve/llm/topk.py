"""Exact nearest rows by inner product: blocks meet blocks, with bounds from segment statistics.

Vectors are packed in blocks. A query block meets a data block once, and the k best rows that a query
has so far go on from one data block to the next. A vector's segments are summed up by their means and
deviations; by Cauchy and Schwarz the product of two vectors is at most the sum over segments of
``size * (mean * mean + deviation * deviation)``, which is a product of two short vectors. Bounds of
few segments come first, and of more segments only for what is left; exact products only for rows
whose bound reaches the k-th best exact product that the query has so far. A few rows and queries of
two blocks tell beforehand which bounds leave out enough to be worth their time there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.llm.common import arrow_map, drop, stored

BLOCK, BLOCK_BYTES = 4096, 1 << 21  # rows and bytes of a block, at most
TILE_QUERIES, TILE_ROWS = 512, 1024  # their products lie in a core's cache
FIRST_ROWS = 64  # of the first tile, when nothing is known; later ones grow with the rows met
PART_BLOCKS = 8  # of queries, that a task holds
TASK_BLOCKS = 32  # of data, that a task meets at least, if all cores have a task
SOME_QUERIES, SOME_ROWS = 64, 256  # of two blocks, that tell which bounds to use
READ_ROWS = 4096  # of an Arrow batch of single vectors
SEGMENTS = (1, 4, 16)
EXACT_SINGLE, EXACT = 2.0**24, 2.0**53
LARGEST = 2.0**63


def scaled(docs: DataFrame, vec_id: str, vector: str, factor: int, query: str | None = None) -> DataFrame:
    """vec_id, the integers floor(factor * x) and the bytes that each takes, without rows that are null,
    empty, or hold a null or a non-finite component; with ``query``, only ids that meet it. A component
    that takes more than 64 bits when scaled is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = b.column("vec_id"), b.column("v")
            at = lists.offsets.to_numpy().astype(np.int64)
            x = lists.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            bad = np.zeros(len(x) + 1, np.int64)
            np.cumsum(~np.isfinite(x), out=bad[1:])
            size = np.diff(at)
            ok = (size > 0) & (bad[at[1:]] == bad[at[:-1]])
            for col in (ids, lists):
                ok &= col.is_valid().to_numpy(zero_copy_only=False)
            for width in np.unique(size[ok]):
                r = np.flatnonzero(ok & (size == width))
                own = np.floor(factor * x[at[r][:, None] + np.arange(width)])
                top = np.abs(own).max(axis=1)
                if not (top < LARGEST).all():
                    i = ids[int(r[np.argmin(top < LARGEST)])]
                    raise OverflowError(f"a component of vector {i} takes more than 64 bits")
                steps = np.select([top < 2.0**15, top < 2.0**31], [2, 4], 8)
                for step in np.unique(steps):
                    z = np.flatnonzero(steps == step)
                    rows = own[z].astype(f"<i{step}").tobytes()
                    offsets = np.arange(len(z) + 1, dtype=np.int32) * np.int32(width * step)
                    vectors = pa.BinaryArray.from_buffers(
                        pa.binary(), len(z), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(r[z])), pa.array(np.full(len(z), step, np.int32)), vectors],
                        ["vec_id", "step", "v"],
                    )

    rows = docs.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    if query is not None:
        rows = rows.where(query)
    return arrow_map(rows, run, "vec_id long, step int, v binary", READ_ROWS)


def blocks(rows: DataFrame) -> DataFrame:
    """Rows packed into blocks: width, step, ids in ascending order and vectors as bytes.

    Blocks are filled inside the tasks, so no vector is shuffled for it. Vectors of different length
    or of other bytes a component go to different blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}

        def full(kind: tuple[int, int]) -> pa.RecordBatch:
            ids, rows = held.pop(kind)
            ids = np.array(ids, "<i8")
            by = np.argsort(ids, kind="stable")
            vectors = b"".join(rows[i] for i in by.tolist())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([kind[0] // kind[1]], pa.int32()),
                    pa.array([kind[1]], pa.int32()),
                    pa.array([ids[by].tobytes()], pa.binary()),
                    pa.array([vectors], pa.binary()),
                ],
                ["width", "step", "ids", "vectors"],
            )

        for b in batches:
            for i, step, v in zip(*(b.column(c).to_pylist() for c in ("vec_id", "step", "v"))):
                kind = len(v), step
                ids, rows = held.setdefault(kind, ([], []))
                ids.append(i)
                rows.append(v)
                if len(ids) == BLOCK or (len(ids) + 1) * len(v) > BLOCK_BYTES:
                    yield full(kind)
        for kind in sorted(held):
            yield full(kind)

    return arrow_map(rows, run, "width int, step int, ids binary, vectors binary", READ_ROWS)


def summary(x: np.ndarray, segments: int) -> np.ndarray:
    """Short vectors whose products bound the products of the rows of ``x``."""
    cols = []
    for part in np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1])):
        own = x[:, part]
        root = np.sqrt(len(part))
        cols += [root * own.mean(axis=1), root * own.std(axis=1)]
    return np.stack(cols, axis=1)


class Block:
    """Ids in ascending order and vectors, with what is made of them when it is first asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self._made: dict = {}

    def _once(self, key: object, make: Callable) -> object:
        if key not in self._made:
            self._made[key] = make()
        return self._made[key]

    def floats(self, dtype: type) -> np.ndarray:
        return self._once(dtype, lambda: self.vectors.astype(dtype))

    def norm(self) -> float:
        """The largest norm of a vector, or a little more."""
        def make() -> float:
            x = self.vectors.astype(np.float64)
            return float(np.sqrt(np.einsum("ab,ab->a", x, x).max(initial=1.0)) * (1 + 1e-9))

        return self._once("norm", make)

    def short(self, segments: int) -> np.ndarray:
        return self._once(segments, lambda: summary(self.vectors.astype(np.float64), segments))

    def some(self, rows: int) -> np.ndarray:
        """Places of ``rows`` vectors at most, evenly spread."""
        return np.linspace(0, len(self.ids) - 1, min(len(self.ids), rows)).astype(np.int64)

    def some_short(self, rows: int, segments: int) -> np.ndarray:
        def make() -> np.ndarray:
            return summary(self.vectors[self.some(rows)].astype(np.float64), segments)

        return self._once((rows, segments), make)


def whole(x: np.ndarray) -> np.ndarray:
    """Python's integers for products held as floats; no product stays minus infinity."""
    if x.dtype == object:
        return x
    out = x.astype(object)
    held = x > -np.inf
    out[held] = [int(v) for v in x[held]]
    return out


class Best:
    """Ids and products of the ``k`` best rows that each query of a block has so far, best first; ties
    go to smaller ids."""

    def __init__(self, n: int, k: int):
        self.ids, self.products = np.zeros((n, k), np.int64), np.full((n, k), -np.inf)
        self.met = 0  # rows

    def add(self, i: np.ndarray, ids: np.ndarray, products: np.ndarray) -> None:
        """Puts in row ``ids`` of that product for query ``i``."""
        if object in (products.dtype, self.products.dtype):
            products, self.products = whole(products), whole(self.products)
        k = self.ids.shape[1]
        rows = np.unique(i)
        had = self.products[rows]
        held = had > -np.inf
        i = np.concatenate([np.repeat(rows, held.sum(axis=1)), i])
        ids = np.concatenate([self.ids[rows][held], ids])
        products = np.concatenate([had[held], products])
        by = np.lexsort((ids, -products, i)) if products.dtype != object else np.array(
            sorted(range(len(i)), key=lambda t: (i[t], -products[t], ids[t])), np.int64
        )
        i, ids, products = i[by], ids[by], products[by]
        at = np.arange(len(i)) - np.searchsorted(i, i)
        best = at < k
        self.ids[i[best], at[best]] = ids[best]
        self.products[i[best], at[best]] = products[best]


def places(hit: np.ndarray) -> np.ndarray:
    """Numbers of the set places, which are few: eight are looked at together."""
    hit = hit.reshape(-1)
    if len(hit) % 8:
        return np.flatnonzero(hit)
    at = (np.flatnonzero(hit.view(np.uint64))[:, None] * 8 + np.arange(8)).reshape(-1)
    return at[hit[at]]


def worth(q: Block, d: Block, floor: np.ndarray, slack: float) -> list[int]:
    """Numbers of segments whose bounds leave half of the pairs at most, or half of what the bounds
    before leave, among some rows of two blocks."""
    least = floor[q.some(SOME_QUERIES), None] - slack
    out, left = [], 1.0
    for s in SEGMENTS:
        if 4 * s > q.vectors.shape[1]:
            break
        bound = q.some_short(SOME_QUERIES, s) @ d.some_short(SOME_ROWS, s).T
        share = (bound >= least).mean()
        if share <= left / 2:
            out.append(s)
            left = share
    return out


def meet(best: Best, q: Block, d: Block) -> None:
    """Puts the rows of ``d`` among the best of the queries ``q``; a query's own row takes no part."""
    k, width = best.ids.shape[1], q.vectors.shape[1]
    # By Cauchy and Schwarz no partial sum of a product is larger, in whatever order it is added up.
    big = q.norm() * d.norm()
    kind = np.float32 if big < EXACT_SINGLE else np.float64
    off = 0.0 if big < EXACT else (width + 8) * 2.0**-52 * big  # of products that a double cannot hold
    slack = 1e-9 * big + 1e-6 + off
    lowest = np.finfo(kind).min
    qf, df = q.floats(kind), d.floats(kind)
    own_j = np.minimum(np.searchsorted(d.ids, q.ids), len(d.ids) - 1)
    own_i = np.flatnonzero(d.ids[own_j] == q.ids)
    own_j = own_j[own_i]
    room = np.empty(TILE_QUERIES * TILE_ROWS, kind)
    segments, end = None, 0
    while end < len(d.ids):
        a, end = end, min(end + min(TILE_ROWS, max(FIRST_ROWS, best.met)), len(d.ids))
        best.met += end - a
        if segments is None:
            floor = best.products[:, -1].astype(np.float64)
            if floor.min() > -np.inf:
                segments = worth(q, d, floor, slack)
        for b in range(0, len(q.ids), TILE_QUERIES):
            floor = best.products[b : b + TILE_QUERIES, -1].astype(np.float64)
            i, j = np.arange(b, b + len(floor)), np.arange(a, end)
            left = None
            for s in segments or ():
                left = q.short(s)[i] @ d.short(s)[j].T >= floor[i - b, None] - slack
                rows, cols = left.any(axis=1), left.any(axis=0)
                i, j, left = i[rows], j[cols], left[rows][:, cols]
            if not len(i):
                continue
            value = room[: len(i) * len(j)].reshape(len(i), len(j))
            if left is None:
                np.matmul(qf[b : b + len(i)], df[a : a + len(j)].T, out=value)
            elif 16 * np.count_nonzero(left) > left.size:
                np.matmul(qf[i], df[j].T, out=value)
            else:
                value[:] = -np.inf
                x, y = np.nonzero(left)
                value[x, y] = np.einsum("ab,ab->a", qf[i[x]], df[j[y]])
            if len(own_i):
                x, y = (np.minimum(np.searchsorted(t, own), len(t) - 1) for t, own in ((i, own_i), (j, own_j)))
                here = (i[x] == own_i) & (j[y] == own_j)
                value[x[here], y[here]] = -np.inf
            # What a query has not yet is below any product, but above its own row's.
            least = np.maximum((floor[i - b] - off), lowest).astype(kind)[:, None]
            hit = value >= least
            if len(j) > k and np.count_nonzero(hit) > 4 * k * len(i):
                cut = np.partition(value, len(j) - k, axis=1)[:, len(j) - k, None]
                least = np.maximum(least, cut - kind(2 * off))
                hit = value >= least
                if not off:  # rows are in the order of ids: of ties the first remain
                    above = value > least
                    tied = hit & ~above
                    tied &= np.cumsum(tied, axis=1) <= k - np.count_nonzero(above, axis=1)[:, None]
                    hit = above | tied
            x, y = np.divmod(places(hit), len(j))
            if not len(x):
                continue
            i, j = i[x], j[y]
            if off:
                cuts = (slice(c, c + (1 << 16)) for c in range(0, len(i), 1 << 16))
                products = np.concatenate(
                    [(q.vectors[i[c]].astype(object) * d.vectors[j[c]].astype(object)).sum(axis=1) for c in cuts]
                )
            else:
                products = value[x, y].astype(np.float64)
            best.add(i, d.ids[j], products)


def top_k(
    rows: DataFrame,
    query: str,
    k: int = 5,
    factor: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank from 1, vec_id and score: the ``k`` best rows for every row that meets the SQL
    condition ``query`` on ``vec_id``; all, if there are fewer.

    Components x count as floor(factor * x); the score is the inner product. A query meets all rows
    of its length but those of its own id; ties go to the smaller id. Rows whose id or vector is
    null, or whose vector is empty or holds a null or a non-finite component, take no part. Rows
    that repeat an id with the same vector count once. A score beyond 64 bits is an error.

    Nothing goes through the driver or is broadcast: both sides are stored as blocks and dealt to
    parts. A task has a part of either side, reads the data blocks one by one and holds the query
    blocks; no block is copied for it, and the rows it sends on are the k best of its queries.
    """
    spark = rows.sparkSession

    def packed(name: str, condition: str | None = None) -> DataFrame:
        once = scaled(rows, vec_id, vector, factor, condition).dropDuplicates(["vec_id"])
        return stored(blocks(once), name)

    data, asked = packed("data-blocks"), packed("query-blocks", query)
    n_data, n_asked = data.count(), asked.count()
    query_parts = max(1, -(-n_asked // PART_BLOCKS))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(-(-2 * spark.sparkContext.defaultParallelism // query_parts), n_data // TASK_BLOCKS)
    data_parts = max(1, min(n_data, wanted, -(-tasks // query_parts)))
    # A product of the parts, which reads them where they are; both hints, else Spark may turn to a join.
    left = data.repartition(data_parts).hint("shuffle_replicate_nl")
    right = asked.repartition(query_parts).selectExpr(
        "width AS q_width", "step AS q_step", "ids AS q_ids", "vectors AS q"
    )
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.col("width") == F.col("q_width"))

    def block(b: pa.RecordBatch, r: int, names: tuple[str, str, str]) -> Block:
        step, ids, vectors = (b.column(c)[r] for c in names)
        ids = np.frombuffer(ids.as_buffer(), "<i8").copy()
        x = np.frombuffer(vectors.as_buffer(), f"<i{step.as_py()}")
        return Block(ids, x.reshape(len(ids), -1).copy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Block, Best]] = {}
        last, d = None, None
        for b in batches:
            for r in range(b.num_rows):
                # No id is in two blocks of a side, so its first id tells a block.
                q_key, d_key = (np.frombuffer(b.column(c)[r].as_buffer(), "<i8", 1)[0] for c in ("q_ids", "ids"))
                if d is None or d_key != last:
                    last, d = d_key, block(b, r, ("step", "ids", "vectors"))
                if q_key not in held:
                    q = block(b, r, ("q_step", "q_ids", "q"))
                    held[q_key] = q, Best(len(q.ids), k)
                q, best = held[q_key]
                meet(best, q, d)
        for q, best in held.values():
            found = best.products > -np.inf
            scores = best.products[found]
            if scores.dtype != object:
                scores = scores.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(q.ids, found.sum(axis=1))),
                    pa.array(best.ids[found]),
                    pa.array(scores, pa.int64()),
                ],
                ["query_id", "vec_id", "score"],
            )

    found = arrow_map(
        pairs.select("step", "ids", "vectors", "q_step", "q_ids", "q"),
        run,
        "query_id long, vec_id long, score long",
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
    top = stored(top, "top-rows")
    drop(data, asked)
    return top
