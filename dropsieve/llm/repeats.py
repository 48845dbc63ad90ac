"""Places where strings of a fixed length occur more than once, found from winnowed anchors.

A document is a row of symbols (words or bytes). A string of ``length`` symbols holds ``length -
gram + 1`` grams, and the one of smallest hash is its anchor: equal strings have equal anchors at
equal places. Around an anchor lie all the strings that it can stand for.

1. Anchors whose whole surroundings are equal form a class. One grouping settles all but the first
   of a class, however many there are.
2. The first ones are seeds. A string reaches at least ``core`` symbols to the right of its anchor's
   start or to the left of its end, so seeds meet only where one of these two cores is equal.
3. Seeds with an equal core are compared with the first of them, to the left and to the right. What
   else a seed may share it shares with seeds that leave the first one at the same place by the same
   symbol: they are a node one level down in a trie of branching points. No pairs are formed.
   Groups of up to ``LOCAL`` seeds go through all levels inside a task, many at a time. Larger ones
   take a level per round, spread over tasks by a join with their first seed, until their branches
   are small.

Symbols are compared by 64-bit hashes or, for bytes, as they are; surroundings by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import (
    SHORT_SLICE,
    U,
    arrow_map,
    drop,
    mix,
    parts,
    prefix,
    span_hash,
    stored,
)

_NONE = U(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Search:
    """``symbols`` turns a slice of texts into 64-bit symbols and their offsets; ``raw`` gives what
    is compared, of ``dtype``. With ``later_only`` a place counts only where the string also occurs
    in a document of smaller id, else where it occurs anywhere else."""

    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    raw: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    dtype: str
    length: int
    gram: int
    later_only: bool

    @property
    def reach(self) -> int:
        return self.length - self.gram

    @property
    def core(self) -> int:
        return -(-(self.length + self.gram) // 2)

    @property
    def margin(self) -> int:
        """How far a string can go beyond its core."""
        return self.length - self.core


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``width`` neighbours; as many values as there are whole windows."""
    have, n = x, 1
    while 2 * n <= width:
        have = best(have[:-n], have[n:]) if len(have) > n else have[:0]
        n *= 2
    rest = width - n
    return best(have[: len(have) - rest], have[rest:]) if rest else have


def anchor_places(sym: np.ndarray, off: np.ndarray, p: np.ndarray, s: Search) -> np.ndarray:
    """Places of grams that are the smallest of some string of ``length`` in a text.

    Of equal smallest grams of a string all are taken.
    """
    n, width = len(sym), s.reach + 1
    if n < s.length:
        return np.zeros(0, np.int64)
    at = np.arange(n - s.gram + 1)
    gram = np.minimum(span_hash(p, at, at + s.gram), _NONE - U(1))
    # Strings that cross from a text to the next one do not count.
    least = sliding(gram, width, np.minimum)
    inside = np.zeros(len(least) + 1, np.int64)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        if b - a >= s.length:
            inside[a] += 1
            inside[b - s.length + 1] -= 1
    least = np.where(np.cumsum(inside[:-1]) > 0, least, U(0))
    # A gram is an anchor where it equals the least one of a string it lies in.
    edge = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(most == gram)


def anchors(docs: DataFrame, s: Search) -> DataFrame:
    """doc, pos, hash x of the surroundings, and hashes of the cores to the right and left, null
    where a text ends before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in parts(b.column("text"), SHORT_SLICE):
                sym, off = s.symbols(buf, off)
                p = prefix(sym)
                at = anchor_places(sym, off, p, s)
                text = np.searchsorted(off, at, "right") - 1
                lo, hi = off[text], off[text + 1]
                left = np.maximum(at - s.reach, lo)
                x = span_hash(p, left, np.minimum(at + s.length, hi))
                x = mix(x + (at - left).astype(np.uint64))
                cols = [b.column("doc_id").slice(i, j - i).take(pa.array(text)), pa.array(at - lo)]
                cols.append(pa.array(x.view(np.int64)))
                for begin in (at, at + s.gram - s.core):
                    out = (begin < lo) | (begin + s.core > hi)
                    h = span_hash(p, np.where(out, 0, begin), np.where(out, 0, begin + s.core))
                    cols.append(pa.array(h.view(np.int64), mask=out))
                yield pa.RecordBatch.from_arrays(cols, ["doc", "pos", "x", "right", "left"])

    schema = "doc long, pos long, x long, right long, left long"
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    return arrow_map(docs, run, schema)


def _seed_rows(docs: DataFrame, seeds: DataFrame, s: Search) -> DataFrame:
    """The margins of every seed's core, read from the texts; the left one from the core outwards.

    Seeds grow with the texts, so the two are always joined by a shuffle.
    """
    m = s.margin
    per_doc = seeds.groupBy("doc").agg(F.collect_set(F.struct("gid", "begin")).alias("at"))
    per_doc = per_doc.withColumnRenamed("doc", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column("at")
            for i, j, buf, off in parts(b.column("text"), SHORT_SLICE):
                sym, off = s.raw(buf, off)
                own = at.slice(i, j - i)
                count = np.diff(own.offsets.to_numpy())
                flat = own.flatten()
                gid = flat.field("gid")
                text = np.repeat(np.arange(j - i), count)
                begin = flat.field("begin").to_numpy() + off[text]
                la = np.minimum(begin - off[text], m)
                ra = np.minimum(off[text + 1] - begin - s.core, m)
                for k in range(0, len(begin), 4096):
                    z = slice(k, k + 4096)
                    side = np.arange(m)
                    l_at = begin[z, None] - 1 - side
                    r_at = begin[z, None] + s.core + side
                    left = np.where(side < la[z, None], sym[np.maximum(l_at, 0)], 0)
                    right = np.where(side < ra[z, None], sym[np.minimum(r_at, len(sym) - 1)], 0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            gid[z],
                            *(pa.array(np.full(len(left), v, np.int32)) for v in (0, m)),
                            b.column("doc_id").slice(i, j - i).take(pa.array(text[z])),
                            pa.array(begin[z] - off[text[z]]),
                            pa.array(la[z].astype(np.int32)),
                            pa.array(ra[z].astype(np.int32)),
                            _binary(left.astype(s.dtype)),
                            _binary(right.astype(s.dtype)),
                        ],
                        _ROW,
                    )

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(per_doc, "doc_id")
    return arrow_map(texts.select("doc_id", "text", "at"), run, _SCHEMA)


_ROW = ["gid", "lmin", "lmax", "doc", "begin", "la", "ra", "l", "r"]
_SCHEMA = (
    "gid long, lmin int, lmax int, doc long, begin long, la int, ra int, l binary, r binary"
)
LOCAL = 16_384
_CHUNK = 16_384


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    off = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(off), pa.py_buffer(rows)]
    )


def _matrix(col: pa.Array, dtype: str, width: int) -> np.ndarray:
    col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]].view(dtype).reshape(len(col), width)


def _shared_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differs = a != b
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


def _columns(b: pa.RecordBatch, s: Search) -> dict[str, np.ndarray]:
    out = {}
    for name in b.schema.names:
        col = b.column(name)
        if pa.types.is_binary(col.type):
            out[name] = _matrix(col, s.dtype, s.margin)
        else:
            out[name] = col.to_numpy(zero_copy_only=False)
    return out


def _compare(
    s: Search, row: dict[str, np.ndarray], lead: dict[str, np.ndarray]
) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, str, np.ndarray]]]:
    """Rows and the first rows of their groups: spans (doc, lo, hi) that they share, and who goes on
    to the next level: rows, their new groups, and the bound that changes and its value."""
    m, core = s.margin, s.core
    go = {}
    for way, have in (("l", "la"), ("r", "ra")):
        same = _shared_run(row[way], lead[way])
        go[way] = np.minimum(same, np.minimum(row[have], lead[have])).astype(np.int64)
    full = go["l"] + go["r"] >= m
    if s.later_only:
        full &= lead["doc"] < row["doc"]
    k = np.flatnonzero(full)
    sides = [row] if s.later_only else [row, lead]
    spans = np.concatenate(
        [
            np.stack([x["doc"][k], x["begin"][k] - go["l"][k], x["begin"][k] + core + go["r"][k]])
            for x in sides
        ],
        axis=1,
    )
    # A string of a group is told by how far it goes to the left of the core, from lmin to lmax.
    # Those that go beyond the shared part on the left are one branch, and of the others those that
    # go beyond it on the right: each string goes on in one branch.
    left, right = go["l"], go["r"]
    low, high = row["lmin"], np.minimum(np.minimum(left, row["lmax"]), m - right - 1)
    onward = (
        ("l", (left < row["la"]) & (left < row["lmax"]), "lmin", left + 1),
        ("r", (right < row["ra"]) & (right < m) & (low <= high), "lmax", high),
    )
    more = []
    for way, goes, what, value in onward:
        i = np.flatnonzero(goes)
        at = go[way][i]
        by = row[way][i, at].astype(np.uint64)
        gid = mix(row["gid"][i].view(np.uint64) + mix(by + U(1)))
        gid = mix(gid + (2 * at + (way == "r")).astype(np.uint64)).view(np.int64)
        more.append((i, gid, what, value[i].astype(np.int32)))
    return np.unique(spans, axis=1), more


def _spread(s: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One level of large groups: rows come beside the first of their group, under h names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            col = _columns(b, s)
            row = {k: v for k, v in col.items() if not k.startswith("h")}
            spans, more = _compare(s, row, {k[1:]: v for k, v in col.items() if k.startswith("h")})
            none = pa.nulls(spans.shape[1])
            cols = dict.fromkeys(_ROW, none) | {"doc": pa.array(spans[0]), "begin": pa.array(spans[1])}
            yield _batch(cols, pa.array(spans[2]))
            for i, gid, least, depth in more:
                cols = {c: b.column(c).take(pa.array(i)) for c in _ROW}
                cols |= {"gid": pa.array(gid), least: pa.array(depth)}
                yield _batch(cols, pa.nulls(len(i), pa.int64()))

    return run


def _grouped(s: Search, row: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Rows in order of groups, without groups that hold one place, or document, only; and for each
    the place of the first of its group."""
    hashed = mix(row["begin"].view(np.uint64) ^ mix(row["gid"].view(np.uint64)))
    by = (hashed, row["doc"], row["gid"]) if s.later_only else (row["begin"], row["doc"], hashed, row["gid"])
    order = np.lexsort(by)
    gid, doc, begin = (row[k][order] for k in ("gid", "doc", "begin"))
    new = np.ones(len(order), bool)
    new[1:] = gid[1:] != gid[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    other = doc != doc[first]
    if not s.later_only:
        other |= begin != begin[first]
    alive = np.zeros(len(order), bool)
    alive[first[other]] = True
    keep = alive[first]
    at = np.cumsum(keep) - 1
    return {k: v[order[keep]] for k, v in row.items()}, at[first[keep]]


def _inside(s: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All levels of small groups, whose rows come in order of groups."""

    def solved(row: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        while len(row["gid"]):
            row, first = _grouped(s, row)
            rest = np.flatnonzero(first != np.arange(len(first)))
            beside = {k: v[rest] for k, v in row.items()}
            spans, more = _compare(s, beside, {k: v[first[rest]] for k, v in row.items()})
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans], ["doc", "lo", "hi"])
            branches = [
                {k: v[i] for k, v in beside.items()} | {"gid": gid, least: depth}
                for i, gid, least, depth in more
            ]
            row = {k: np.concatenate([x[k] for x in branches]) for k in row}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(_columns(b, s))
            if sum(len(x["gid"]) for x in held) >= _CHUNK:
                row = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
                cut_at = int(np.searchsorted(row["gid"], row["gid"][-1]))
                yield from solved({k: v[:cut_at] for k, v in row.items()})
                held = [{k: v[cut_at:] for k, v in row.items()}]
        if held:
            yield from solved({k: np.concatenate([x[k] for x in held]) for k in held[0]})

    return run


def _batch(cols: dict[str, pa.Array], end: pa.Array) -> pa.RecordBatch:
    kinds = dict(gid=pa.int64(), doc=pa.int64(), begin=pa.int64(), l=pa.binary(), r=pa.binary())
    names = [*_ROW, "end"]
    return pa.RecordBatch.from_arrays(
        [cols[c].cast(kinds.get(c, pa.int32())) for c in _ROW] + [end.cast(pa.int64())], names
    )


def _local_spans(rows: DataFrame, s: Search) -> DataFrame:
    """The spans of groups of ``LOCAL`` rows at most."""
    dealt = rows.select(*_ROW).repartition("gid").sortWithinPartitions("gid")
    return stored(arrow_map(dealt, _inside(s), "doc long, lo long, hi long").distinct(), "spans")


def _order(s: Search) -> Column:
    """What is first in a group. By hash as far as that is free: in text that repeats a word, places
    in their order would leave a group one by one, each a level deeper than the one before."""
    if s.later_only:
        return F.struct("doc", F.xxhash64("begin", "gid").alias("o"), "begin")
    return F.struct(F.xxhash64("doc", "begin", "gid").alias("o"), "doc", "begin")


def repeated_spans(docs: DataFrame, s: Search) -> DataFrame:
    """doc, lo and hi: the union of the spans of a document is what its counting places cover.

    Rows that repeat a doc_id must repeat its text and are one document. Null ids are left out.
    """
    found = stored(anchors(docs, s), "anchors")
    place = F.xxhash64("doc", "pos")
    classes = stored(
        found.groupBy("x").agg(
            F.min(F.struct("doc", "pos", "right", "left")).alias("h"),
            (F.min(place) < F.max(place)).alias("several"),
        ),
        "classes",
    )
    several = classes.where("several").selectExpr("x", "h.doc AS hdoc", "h.pos AS hpos")
    again = stored(found.join(several, "x").select("doc", "pos", "hdoc", "hpos"), "copies")
    drop(found)
    settled = again.where("doc > hdoc" if s.later_only else "true")
    spans = [
        settled.selectExpr("doc", f"greatest(pos - {s.reach}, 0) AS lo", f"pos + {s.length} AS hi")
    ]

    # The first of every class: those settled need no answer but may be one.
    seeds = classes.selectExpr(
        "h.doc AS doc",
        "explode(array(named_struct('core', h.right, 'begin', h.pos),"
        f" named_struct('core', h.left, 'begin', h.pos + {s.gram - s.core}))) AS e",
    )
    seeds = seeds.selectExpr("doc", "e.begin AS begin", "e.core AS gid").where("gid IS NOT NULL")
    seeds = stored(seeds.join(_meeting(seeds, s), "gid"), "meeting")
    drop(classes)
    spans.append(_local_spans(_seed_rows(docs, seeds.where(f"n <= {LOCAL}"), s), s))
    large = seeds.where(f"n > {LOCAL}")
    rows = None if large.isEmpty() else stored(_seed_rows(docs, large, s), "rows")
    drop(seeds)
    while rows is not None:
        own = F.struct(_order(s).alias("o"), *(c for c in _ROW if c != "gid"))
        lead = rows.groupBy("gid").agg(F.min(own).alias("h"))
        lead = lead.select("gid", *(F.col("h." + c).alias("h" + c) for c in _ROW[3:]))
        beside = rows.join(lead, "gid").where("NOT (doc = hdoc AND begin = hbegin)")
        out = stored(arrow_map(beside, _spread(s), _SCHEMA + ", end long"), "level")
        drop(rows)
        ended = out.where("end IS NOT NULL").selectExpr("doc", "begin AS lo", "end AS hi")
        spans.append(stored(ended.distinct(), "spans"))
        more = out.where("end IS NULL").drop("end")
        more = stored(more.join(_meeting(more, s), "gid"), "branches")
        drop(out)
        spans.append(_local_spans(more.where(f"n <= {LOCAL}"), s))
        large = more.where(f"n > {LOCAL}").drop("n")
        rows = None if large.isEmpty() else stored(large, "rows")
        drop(more)
    return _with_twins(spans, again, s) if s.later_only else _union(spans)


def _meeting(rows: DataFrame, s: Search) -> DataFrame:
    """The groups that hold more than one document, or place, and their sizes."""
    what = F.col("doc") if s.later_only else F.xxhash64("doc", "begin")
    ends = rows.groupBy("gid").agg(
        F.min(what).alias("lo"), F.max(what).alias("hi"), F.count("*").alias("n")
    )
    return ends.where("lo < hi").select("gid", "n")


def _union(spans: list[DataFrame]) -> DataFrame:
    out = spans[0]
    for x in spans[1:]:
        out = out.unionByName(x)
    return out


def _with_twins(spans: list[DataFrame], again: DataFrame, s: Search) -> DataFrame:
    """A document may hold the first surroundings of a class several times: what was found about
    the first of these places holds for the others."""
    twins = again.where("doc = hdoc AND pos > hpos").selectExpr(
        "doc", "hpos AS first", "pos - hpos AS shift"
    )
    found = _union(spans[1:]) if len(spans) > 1 else None
    if found is None or twins.isEmpty():
        return _union(spans)
    moved = (
        found.join(twins, "doc")
        .where(
            f"least(hi, first + {s.length}) - greatest(lo, first - {s.reach}) >= {s.length}"
        )
        .selectExpr(
            "doc",
            f"greatest(lo, first - {s.reach}) + shift AS lo",
            f"least(hi, first + {s.length}) + shift AS hi",
        )
    )
    return _union([*spans, moved])


def cut(docs: DataFrame, spans: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Applies ``fn`` to batches of ``docs`` with ``_spans``: a list of lo and hi for each row.

    A document's spans come together in one row, as its text does: one at most for each of its
    places.
    """
    longest = spans.groupBy(F.col("doc").alias("_doc"), "lo").agg(F.max("hi").alias("hi"))
    per_doc = longest.groupBy("_doc").agg(F.collect_list(F.struct("lo", "hi")).alias("_spans"))
    both = docs.join(per_doc, F.col("doc_id").cast("long") == F.col("_doc"), "left").drop("_doc")
    return arrow_map(both, fn, schema)


def span_arrays(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """lo and hi of every row of a ``_spans`` column."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    flat = col.flatten()
    lo, hi = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("lo", "hi"))
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    for a, b in zip(at[:-1], at[1:]):
        yield lo[a:b], hi[a:b]

