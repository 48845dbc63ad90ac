"""Repeated byte strings by a sparse suffix array, sorted deep-shallow.

Only suffixes at anchors are sorted, and the prefixes before them likewise, backwards: every string
of ``length`` bytes holds an anchor at the same place as its copies do. The shallow part is a
multikey pass on keys of growing depth: whole surroundings, then the core to one side. Ties go on to
the deep part, whose groups share long prefixes: there a blind trie keeps only branching points
(depth and byte), and a round of ``repeats`` is a level of it. Byte runs that lie on one path of the
trie for ``length`` bytes occur more than once.

Sorting all suffixes would shuffle each text hundreds of times over; of these suffixes there is one
in about two hundred bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import BYTE_VALUES, covered, parts
from dropsieve.llm.repeats import Search, cut, repeated_spans, span_arrays

GRAM = 32


def _symbols(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[buf], off


def _raw(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return buf, off


def search(length: int) -> Search:
    if length < 2 * GRAM:
        raise ValueError(f"strings must be of {2 * GRAM} bytes at least")
    return Search(_symbols, _raw, "uint8", length, GRAM, later_only=False)


def spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc, lo and hi, in bytes: what strings of ``length`` bytes cover that start elsewhere too.

    Null texts are empty; null ids are left out. Rows that repeat a doc_id must repeat its text and
    are one document. Columns other than doc_id and text are not read.
    """
    return repeated_spans(docs, search(length))


def report(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), digest of what is left,
    n_kept (its bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = span_arrays(b.column("_spans"))
            n, removed, runs, sha = [], [], [], []
            for i, j, buf, off in parts(b.column("text")):
                for k in range(j - i):
                    own = buf[off[k] : off[k + 1]]
                    lo, hi = next(found)
                    n.append(len(own))
                    if len(lo):
                        gone = covered(len(own), np.minimum(lo, len(own)), np.minimum(hi, len(own)))
                        removed.append(int(gone.sum()))
                        runs.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum()))
                        own = own[~gone]
                    else:
                        removed.append(0)
                        runs.append(0)
                    sha.append(hashlib.sha256(own.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, removed, runs)),
                 pa.array(sha, pa.string()), pa.array(np.subtract(n, removed), pa.int64())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long"
    return cut(texts, spans(docs, length), run, schema)
