"""Divergence of sources by chunk factorization.

Texts are counted as white-space chunks. Every globally distinct chunk is cut into terms once, where
all counts of it meet, and its terms take over its counts. So neither (document, chunk) nor (document,
term) pairs are ever shuffled: a task sends one row per chunk and group, with occurrences and documents.

Chunks of one term may share documents, so a term's documents lie between the largest of its chunks'
document counts and their sum. Where the bounds leave it open whether a term is kept, its documents are
counted in a second reading of the texts that looks for these terms only, by a filter of fixed size.

Texts of one row are one document; null lang, source and text are empty strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.llm.common import (
    U,
    arrow_map,
    byte_prefix,
    drop,
    gather,
    mix,
    runs,
    small_side,
    span_hash,
    stored,
    texts,
    words,
)

SCALE = 1_000_000_000
FLUSH = 8 << 20  # bytes of text counted together in a task
HELD_ROWS = 500_000  # rows of frequent chunks a task adds up before it sends them on
FREQUENT = 2  # occurrences in one flush
FILTER_BITS = 27
TILE = 1024  # sources of a language that are compared at once

# Bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F]
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

COUNTED = pa.schema(
    [("chunk", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _groups(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", *more)))


def strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of ``buf``, which do not overlap and lie in order, as strings."""
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=off[1:])
    step = np.zeros(len(buf) + 1, np.int8)
    step[start] += 1
    step[end] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(off), pa.py_buffer(buf[inside]))


def _per_document(spans: pa.Array, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Text, code and count of each distinct string of each text, and the strings of the codes."""
    coded = spans.dictionary_encode()
    code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    return *_distinct(text, code, len(names)), names


def _distinct(text: np.ndarray, code: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = max(codes, 1)
    pair, n = np.unique(text * width + code, return_counts=True)
    return pair // width, pair % width, n


def _codes(*columns: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """Rows numbered by their values in ``columns``, and the values of each number."""
    at = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        coded = c.dictionary_encode()
        at = at * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
    _, first, number = np.unique(at, return_index=True, return_inverse=True)
    return number, [c.take(pa.array(first)) for c in columns]


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together until they hold ``FLUSH`` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= FLUSH:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _summed(t: pa.Table) -> pa.Table:
    keys = COUNTED.names[:3]
    out = t.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns([c.removesuffix("_sum") for c in out.column_names]).select(COUNTED.names)


def chunk_counts(docs: DataFrame) -> DataFrame:
    """chunk, lang, source, n (occurrences) and docs of parts of the documents, to be added up."""

    def counted(t: pa.Table) -> pa.Table:
        buf, off = texts(_column(t, "text"))
        start, end, text = words(buf, off)
        text, code, n, names = _per_document(strings(buf, start, end), text)
        group, (lang, source) = _codes(_column(t, "lang"), _column(t, "source"))
        width = max(len(names), 1)
        key, at = np.unique(group[text] * width + code, return_inverse=True)
        cols = [
            names.take(pa.array(key % width)).cast(pa.string()),
            lang.take(pa.array(key // width)),
            source.take(pa.array(key // width)),
            pa.array(np.bincount(at, n, len(key)).astype(np.int64)),
            pa.array(np.bincount(at, minlength=len(key))),
        ]
        return pa.Table.from_arrays(cols, schema=COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = COUNTED.empty_table()
        for t in _flushes(batches):
            t = counted(t)
            often = pc.greater_equal(t.column("n"), FREQUENT)
            yield from t.filter(pc.invert(often)).to_batches()
            held = pa.concat_tables([held, t.filter(often)])
            if len(held) > HELD_ROWS:
                held = _summed(held)
            if len(held) > HELD_ROWS:
                yield from held.to_batches()
                held = COUNTED.empty_table()
        yield from _summed(held).to_batches()

    schema = "chunk string, lang string, source string, n long, docs long"
    return arrow_map(_groups(docs, "text"), run, schema, batch_rows=20_000)


def _new(*columns: pa.Array) -> np.ndarray:
    """Where rows begin that differ from the row before in one of ``columns``."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(out)


def _merged(t: pa.Table) -> pa.Table:
    """Rows of the same group in a run of a chunk added up, those of a language next to each other."""
    run = np.zeros(len(t), np.int64)
    run[_new(_column(t, "chunk"))[1:]] = 1
    key = np.cumsum(run)
    for c in ("lang", "source"):
        coded = _column(t, c).dictionary_encode()
        key = key * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    cols = [_column(t, c).take(pa.array(order[first])) for c in COUNTED.names[:3]]
    cols += [pa.array(np.add.reduceat(_column(t, c).to_numpy()[order], first)) for c in ("n", "docs")]
    return pa.Table.from_arrays(cols, schema=COUNTED)


TERMS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _terms_of(t: pa.Table) -> pa.RecordBatch:
    """Merged rows of whole runs of chunks, their counts handed to the terms of the chunk.

    ``docs`` are the documents of chunk and language, on the first of its sources; 0 on the others.
    """
    chunk, lang = _column(t, "chunk"), _column(t, "lang")
    n, docs = (_column(t, c).to_numpy() for c in ("n", "docs"))
    first = _new(chunk)
    buf, off = texts(chunk.take(pa.array(first)))
    start, end, of = runs(LETTER[buf], off)
    of, code, times, names = _per_document(strings(LOWER[buf], start, end), of)
    begin = _new(chunk, lang)
    of_language = np.zeros(len(n), np.int64)
    of_language[begin] = np.add.reduceat(docs, begin)
    size = np.bincount(of, minlength=len(first))
    mine = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(n))))
    row = np.repeat(np.arange(len(n)), size[mine])
    term = gather(np.arange(len(of)), (np.cumsum(size) - size)[mine], size[mine])
    return pa.RecordBatch.from_arrays(
        [
            lang.take(pa.array(row)),
            _column(t, "source").take(pa.array(row)),
            names.take(pa.array(code[term])).cast(pa.string()),
            pa.array(n[row] * times[term]),
            pa.array(of_language[row]),
        ],
        schema=TERMS,
    )


def term_counts(chunks: DataFrame) -> DataFrame:
    """lang, source, term, n and docs from all counts of ``chunks``; a chunk is cut once.

    The rows of a chunk arrive one after the other, by a hash of it: a number is sorted without comparing
    rows. Rows of two chunks of equal hash may alternate; then each of their runs hands on counts of its
    own. Those still add up, and the largest is still no more than the documents of the chunk.
    A chunk in every part and group of the input has one row of each, and those seen are added up at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = COUNTED.empty_table()
        for b in batches:
            if not b.num_rows:
                continue
            t = _merged(pa.concat_tables([held, pa.Table.from_batches([b])]).combine_chunks())
            last = int(_new(_column(t, "chunk"))[-1])
            if last:
                yield _terms_of(t.slice(0, last).combine_chunks())
            held = t.slice(last)
        if len(held):
            yield _terms_of(held.combine_chunks())

    placed = chunks.repartition("chunk").sortWithinPartitions(F.xxhash64("chunk"))
    schema = "lang string, source string, term string, n long, docs long"
    return arrow_map(placed, run, schema, batch_rows=20_000)


def _marks(term: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Places in the filter of terms, given hashes of them and of their languages."""
    return mix(term ^ mix(lang)) >> U(64 - FILTER_BITS)


def _hashes(col: pa.Array) -> np.ndarray:
    buf, off = texts(col)
    return span_hash(byte_prefix(buf), off[:-1], off[1:])


def _filter(terms: DataFrame) -> np.ndarray:
    """A bit for every (lang, term): at most 2**21 words, whatever the number of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _marks(_hashes(b.column("term")), _hashes(b.column("lang"))).astype(np.int64)
            bit = (U(1) << (m & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(m >> 6), pa.array(bit)], ["word", "bits"])

    found = arrow_map(terms, run, "word long, bits long", batch_rows=10_000)
    known = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[known["word"].to_numpy(np.int64)] = known["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def documents_with(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, term and docs, the documents of the language that hold it, for the rows of ``terms``."""
    known = _filter(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _flushes(batches):
            buf, off = texts(_column(t, "text"))
            buf = LOWER[buf]
            start, end, text = runs(LETTER[buf], off)
            lang = _column(t, "lang")
            # A term is hashed once a flush, however often it occurs.
            coded = strings(buf, start, end).dictionary_encode()
            code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            m = _marks(_hashes(names)[code], _hashes(lang)[text])
            hit = known[(m >> U(6)).astype(np.int64)] >> (m & U(63)) & U(1) == 1
            text, code, _ = _distinct(text[hit], code[hit], len(names))
            of, (langs,) = _codes(lang)
            width = max(len(names), 1)
            key, n = np.unique(of[text] * width + code, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(key // width)),
                    names.take(pa.array(key % width)).cast(pa.string()),
                    pa.array(n),
                ],
                ["lang", "term", "docs"],
            )

    found = arrow_map(_groups(docs, "text").drop("source"), run, "lang string, term string, docs long")
    return found.join(terms, ["lang", "term"], "left_semi").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, least: int = 10) -> DataFrame:
    """lang, source, term and n of the terms in at least ``least`` documents of their language.

    A stored table of the kept terms only.
    """
    parts = stored(term_counts(chunk_counts(docs)), "terms")
    language = Window.partitionBy("lang", "term")
    bounded = stored(
        parts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.max("docs").alias("most"), F.sum("docs").alias("all"))
        .select("lang", "source", "term", "n", F.max("most").over(language).alias("most"), F.sum("all").over(language).alias("all"))
        .where(F.col("all") >= least),
        "bounded",
    )
    drop(parts)
    unsure = stored(bounded.where(F.col("most") < least).select("lang", "term").distinct(), "unsure")
    counted = documents_with(docs, unsure).where(F.col("docs") < least)
    out = stored(
        bounded.join(counted, ["lang", "term"], "left_anti").select("lang", "source", "term", "n"), "kept-terms"
    )
    drop(bounded, unsure)
    return out


def _share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """``1 + floor(10**9 * (n + 2) / (total + 2 * terms))``, exactly."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", top, below))


def _gap(p: str, q: str) -> Column:
    """``floor((p - q)**2 / (p + q))``."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shared(rows: DataFrame) -> DataFrame:
    """lang, a, b and ``both``: what terms that two sources have in common add to their divergence.

    Per common term the gap of their shares, less the gaps of each share to the other's share of an
    absent term, plus the gap of both absent shares. The terms meet in blocks of sources: a task adds
    up a matrix for two tiles of a language's sources and sends it once, however many terms it had.
    """
    tiles = F.sequence(F.lit(0), F.expr(f"(sources - 1) div {TILE}"))
    own = F.expr(f"i div {TILE}")
    tiled = (
        rows.withColumn("other", F.explode(tiles))
        .withColumns({"ta": F.least(own, "other"), "tb": F.greatest(own, "other")})
        .select("lang", "ta", "tb", "term", "i", "p", "absent")
        .repartition("lang", "term")
        .sortWithinPartitions("lang", "ta", "tb", "term")
    )

    def sent(key: tuple, sums: np.ndarray) -> pa.RecordBatch:
        a, b = np.nonzero(sums)
        at = [np.where(x < TILE, key[1] * TILE + x, key[2] * TILE + x - TILE) for x in (a, b)]
        cols = [pa.array([key[0]] * len(a), pa.string()), *map(pa.array, at), pa.array(sums[a, b])]
        return pa.RecordBatch.from_arrays(cols, ["lang", "a", "b", "both"])

    def add(sums: np.ndarray, cross: bool, term: np.ndarray, i: np.ndarray, p: np.ndarray, absent: np.ndarray) -> None:
        have, col = np.unique(i, return_inverse=True)
        for lo in range(0, int(term[-1]) + 1, 4096):
            part = (term >= lo) & (term < lo + 4096)
            share = np.zeros((4096, len(have)), np.int64)
            none = np.ones(len(have), np.int64)
            share[term[part] - lo, col[part]] = p[part]
            none[col[part]] = absent[part]
            for c in range(len(have) - 1):
                r = np.flatnonzero(share[:, c])
                d = np.arange(c + 1, len(have))
                if cross:
                    d = d[(have[d] >= TILE) & (have[c] < TILE)]
                if not len(r) or not len(d):
                    continue
                x, y = share[r, c][:, None], share[np.ix_(r, d)]
                z = np.where(y > 0, y, 1)
                v = gaps(x, z) - gaps(x, none[d]) - gaps(none[c], z) + gaps(none[c], none[d])
                sums[have[c], have[d]] += np.where(y > 0, v, 0).sum(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, None
        for t in _whole(batches, ("lang", "ta", "tb", "term")):
            for k, s in _blocks(t):
                if k != key:
                    if key is not None:
                        yield sent(key, sums)
                    side = 2 * TILE if k[1] < k[2] else TILE
                    key, sums = k, np.zeros((side, side), np.int64)
                add(sums, k[1] < k[2], *s)
        if key is not None:
            yield sent(key, sums)

    found = arrow_map(tiled, run, "lang string, a long, b long, both long", batch_rows=20_000)
    return found.groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))


def _whole(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted batches as tables that do not cut rows of the same key apart."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        t = t.combine_chunks()
        last = int(_new(*(_column(t, c) for c in key))[-1])
        held = t.slice(last)
        if last:
            yield t.slice(0, last).combine_chunks()
    if held is not None:
        yield held.combine_chunks()


def _blocks(t: pa.Table) -> Iterator[tuple[tuple, tuple]]:
    """Key and (term number, place in the two tiles, share, absent share) of the runs of equal keys."""
    begin = _new(*(_column(t, c) for c in ("lang", "ta", "tb")))
    for lo, hi in zip(begin, np.append(begin[1:], len(t)), strict=True):
        s = t.slice(int(lo), int(hi - lo)).combine_chunks()
        key = tuple(_column(s, c)[0].as_py() for c in ("lang", "ta", "tb"))
        term = np.zeros(len(s), np.int64)
        term[_new(_column(s, "term"))[1:]] = 1
        i, p, absent = (_column(s, c).to_numpy() for c in ("i", "p", "absent"))
        place = np.where(i // TILE == key[1], i % TILE, TILE + i % TILE)
        yield key, (np.cumsum(term), place, p, absent)


def audit(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """How far the sources of a language lie apart, and by which terms: lang, source, part, item, value, rank.

    Terms are runs of letters, A-Z lower-cased; those in at least ``least`` documents of their language
    are kept. Part ``pair`` gives for each source every other source of the language and the sum of
    ``floor((p - q)**2 / (p + q))`` over the kept terms, p and q being smoothed shares in billionths; all
    ranks. Part ``term`` gives the ``top`` terms that a source has more of than its language. Ranks go
    by value, then by item in UTF-8.

    Every (lang, source) in ``docs`` is a group, also one without terms: then its shares are those of
    absent terms, and without any kept term in the language its pairs are 0. Rows are documents of their
    own, repeated ones too. An empty table gives no rows. Columns other than lang, source and text are
    not read.
    """
    kept = kept_counts(docs, least)
    by_term = kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = by_term.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    total, terms = F.coalesce("total", zero), F.coalesce("terms", zero)
    place = Window.partitionBy("lang")
    groups = stored(
        _groups(docs)
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(place.orderBy("source")) - 1).cast("long").alias("i"),
            F.count("*").over(place).alias("sources"),
            total.alias("total"),
            terms.alias("terms"),
            F.coalesce("lang_total", zero).alias("lang_total"),
            F.coalesce(_share(zero, total, terms), F.lit(1)).alias("absent"),
        ),
        "groups",
    )
    rows = kept.join(small_side(groups), ["lang", "source"]).withColumn("p", _share("n", "total", "terms"))

    alone = rows.groupBy("lang", "i", "p", "absent").agg(F.count("*").alias("times"))
    others = groups.select("lang", F.col("i").alias("j"), F.col("absent").alias("none"))
    one_sided = (
        alone.join(others, "lang")
        .where("i <> j")
        .withColumn("value", F.col("times") * (_gap("p", "none") - _gap("absent", "none")))
        .select("lang", F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "value")
    )
    neither = (
        groups.select("lang", F.col("i").alias("a"), "absent", "terms")
        .join(others, "lang")
        .where("a < j")
        .select("lang", "a", F.col("j").alias("b"), (F.col("terms") * _gap("absent", "none")).alias("value"))
    )
    both = _shared(rows).withColumnRenamed("both", "value")
    apart = one_sided.unionByName(neither).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = groups.select("lang", "source", F.col("i"))
    pairs = (
        apart.unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        .join(name.withColumnRenamed("i", "a"), ["lang", "a"])
        .join(name.select("lang", F.col("source").alias("item"), F.col("i").alias("b")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))

    in_language = F.sum("n").over(Window.partitionBy("lang", "term"))
    more = (
        rows.withColumn("q", _share(in_language, "lang_total", "terms"))
        .where("n > 0 AND p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top)
    )
    return pairs.unionByName(more)
