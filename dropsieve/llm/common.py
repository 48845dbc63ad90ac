"""Arrow batches of texts as byte arrays, vectorised helpers on them, and stored stages.

Texts of a batch lie one after the other in one byte array with ``n + 1`` offsets. Work runs over
slices of about ``SLICE`` bytes that hold whole texts, so that memory follows the longest text and
not the batch. A null text counts as an empty one everywhere.
"""

from __future__ import annotations

import gc
import os
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropsieve.llm.cache import drop_codec, give_back, kept
from dropsieve.session import shared_dir

SLICE = 1 << 20
SHORT_SLICE = 1 << 18  # for steps with many arrays of a slice
BATCH_ROWS = 250
BATCH_BYTES = 1 << 20
MAX_BROADCAST_ROWS = 1_000_000  # of an id or two: some 20 MB

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True  # fixed values: the word separators \x20 \x09-\x0D

U = np.uint64
_STEP = U(0xD6E8FEB86659FD93)
# Hashes of spans are polynomials modulo this prime. Modulo a power of two, texts such as a
# Thue-Morse word and its complement would have equal hashes whatever the base.
PRIME = (1 << 61) - 1
_BASE = 0x1E3779B97F4A7C15 % PRIME


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)

def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo ``PRIME`` of numbers of 61 bits."""
    low, half = U((1 << 31) - 1), U((1 << 30) - 1)
    ah, al, bh, bl = a >> U(31), a & low, b >> U(31), b & low
    middle = al * bh + ah * bl
    return _reduced(((ah * bh) << U(1)) + (middle >> U(30)) + ((middle & half) << U(31)) + al * bl)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo ``PRIME`` for ``i < n``."""
    have = kept().get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, SLICE + 2)
        out = []
        for b in (_BASE, pow(_BASE, -1, PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, product(p, np.full(len(p), pow(b, len(p), PRIME), np.uint64))])
            out.append(p[:size].copy())
        have = kept()["powers"] = out
    return have[0][:n], have[1][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span of ``values``, of which 61 bits count."""
    terms = product(values >> U(3), powers(len(values))[0])
    low, high = np.cumsum(terms & U(0xFFFFFFFF)), np.cumsum(terms >> U(32))
    out = np.zeros(len(values) + 1, np.uint64)
    turned = ((high & U((1 << 29) - 1)) << U(32)) + (high >> U(29))
    out[1:] = _reduced(_reduced(turned) + _reduced(low))
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``[start, end)``: equal contents have equal hashes."""
    h = product(_reduced(p[end] + U(PRIME) - p[start]), powers(len(p))[1][start])
    return mix(h + (end - start).astype(np.uint64) * _STEP)


def byte_prefix(buf: np.ndarray) -> np.ndarray:
    return prefix(BYTE_VALUES[buf])


def with_text(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal only inside one text."""
    return mix(h + text.astype(np.uint64) * U(0xA0761D6478BD642F))


def texts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    _, off, data = col.buffers()
    if off is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes each."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def parts(col: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last text, bytes and offsets of every slice of a column."""
    buf, off = texts(col)
    for i, j in slices(off, limit):
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order."""
    return runs(~WHITE[buf], off)


def runs(ink: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of set places, in order."""
    if not len(ink):
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.empty(len(ink) + 1, bool)
    first[0] = True
    first[1:] = ~ink
    first[off] = True
    after = np.empty(len(ink), bool)
    after[:-1] = ~ink[1:]
    after[-1] = True
    inner = off[1:][off[1:] > 0] - 1
    after[inner] = True
    starts = np.flatnonzero(ink & first[:-1])
    ends = np.flatnonzero(ink & after) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]`` one after the other."""
    total = int(size.sum())
    if not total:
        return flat[:0]
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(total)]


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in at least one span."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


def hex_column(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())


def arrow_map(
    df: DataFrame, fn: Callable, schema: str, batch_rows: int = BATCH_ROWS, with_codec: bool = False
) -> DataFrame:
    """``mapInArrow`` on batches of bounded row count and size.

    The bounds are session settings that hold when the job runs; a call with one of its own is to
    be stored at once, or to be the last before the job. Without ``with_codec``, a worker gives up the
    codec of an earlier step; after a task it hands back what is free.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not with_codec:
            drop_codec()
        try:
            yield from fn(batches)
        finally:
            give_back()

    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


_kept_at: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends there.

    Shuffle files go when the driver's JVM finds that nothing refers to them; it is asked to look,
    for steps that follow at once leave it no other occasion.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _kept_at[out] = path
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes what ``stored`` has written, once all that was read from it is stored itself."""
    for df in tables:
        path = _kept_at.pop(df, None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def at_most(df: DataFrame, rows: int) -> bool:
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def small_side(ids: DataFrame) -> DataFrame:
    """A table of ids, to be broadcast if it has at most ``MAX_BROADCAST_ROWS`` rows."""
    return F.broadcast(ids) if at_most(ids, MAX_BROADCAST_ROWS) else ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fold(column: str = "doc_id", folds: int = 5) -> str:
    """SQL for crc32 of an id, as text, modulo ``folds``."""
    return f"crc32(cast({column} as string)) % {folds}"
