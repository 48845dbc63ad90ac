"""Repeated passages between documents: seeds on winnowed anchors, extended both ways.

See ``repeats`` for the search. Here symbols are words, a passage counts from ``length`` words on,
and it is removed wherever a document of smaller id has it too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import byte_prefix, covered, parts, span_hash, words
from dropsieve.llm.repeats import Search, cut, repeated_spans, span_arrays

GRAM = 8


def word_symbols(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, text = words(buf, off)
    return span_hash(byte_prefix(buf), start, end), np.searchsorted(text, np.arange(len(off)))


def search(length: int) -> Search:
    if length < 2 * GRAM:
        raise ValueError(f"passages must be of {2 * GRAM} words at least")
    return Search(word_symbols, word_symbols, "uint64", length, GRAM, later_only=True)


def passages(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc, lo and hi, in words: where a document repeats one of smaller id for ``length`` words.

    Null and empty texts have no words; null ids are left out. Rows that repeat a doc_id must
    repeat its text and are one document. Columns other than doc_id and text are not read.
    """
    return repeated_spans(docs, search(length))


def _without(
    b: pa.RecordBatch,
) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, text, start and end of its words, and which of them go."""
    spans = span_arrays(b.column("_spans"))
    for i, j, buf, off in parts(b.column("text")):
        start, end, text = words(buf, off)
        at = np.searchsorted(text, np.arange(len(off)))
        raw = buf.tobytes()
        for k in range(j - i):
            lo, hi = next(spans)
            s, e = start[at[k] : at[k + 1]] - off[k], end[at[k] : at[k + 1]] - off[k]
            gone = (
                covered(len(s), np.minimum(lo, len(s)), np.minimum(hi, len(s)))
                if len(lo)
                else np.zeros(len(s), bool)
            )
            yield i + k, raw[off[k] : off[k + 1]], s, e, gone


def report(docs: DataFrame, length: int = 50) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the digest of the kept words joined by a blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, sha = [], [], []
            for _, raw, s, e, gone in _without(b):
                n.append(len(s))
                removed.append(int(gone.sum()))
                kept = raw.split() if not removed[-1] else _picked(raw, s[~gone], e[~gone])
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return cut(texts, passages(docs, length), run, schema)


def _picked(raw: bytes, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]


def deduplicated(docs: DataFrame, length: int = 50) -> DataFrame:
    """The rows of ``docs`` without the repeated passages, all columns kept.

    A removed word goes with the white space after it. Texts without such words stay as they are,
    null ones too; a text may end up empty. ``n_chars``, where there is such a column, follows.
    """
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").to_pylist()
            for row, raw, s, _, gone in _without(b):
                if gone.any():
                    edge = np.append(s, len(raw))
                    keep = ~covered(len(raw), edge[:-1][gone], edge[1:][gone])
                    text[row] = np.frombuffer(raw, np.uint8)[keep].tobytes().decode("utf-8")
            out = {c: b.column(c) for c in fields.names} | {"text": pa.array(text, pa.string())}
            if "n_chars" in out:
                size = [n if t is None else len(t) for t, n in zip(text, out["n_chars"].to_pylist())]
                out["n_chars"] = pa.array(size, out["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return cut(docs, passages(docs, length), run, fields)
