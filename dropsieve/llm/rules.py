"""Quality rules as a ledger of failure bits, with versioned policies and ablations.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; a policy is a mask over the bits, so that a new policy, or the effect of leaving a rule out,
needs no second look at the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import (
    arrow_map,
    byte_prefix,
    covered,
    parts,
    per_text,
    prefix,
    span_hash,
    with_text,
    words,
)

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
)

# Bit number, rule and SQL condition that fails; the ledger evaluates them on integers.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 40 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_upper > 50 * word_chars"),
)


def mask(*names: str) -> int:
    known = [n for n, _ in RULES]
    return sum(1 << known.index(n) for n in names)


BASE = mask("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails more than ``allowed`` of the rules in ``rules``."""

    version: str
    rules: int
    allowed: int = 0

    def kept(self, failures: str | Column = "failures") -> Column:
        col = F.col(failures) if isinstance(failures, str) else failures
        return F.bit_count(col.bitwiseAND(F.lit(self.rules))) <= F.lit(self.allowed)


POLICIES = {
    "base": Policy("base", BASE),
    "v1": Policy("v1", mask(*(n for n, _ in RULES))),
    "lenient": Policy("lenient", mask(*(n for n, _ in RULES)), 1),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True  # fixed values
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
WINDOW = 5


def measure(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of every text of a slice."""
    n = len(off) - 1
    start, end, text = words(buf, off)
    out = {"n_words": np.bincount(text, minlength=n)}
    chars = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=chars[1:])
    size = (chars[end] - chars[start]).astype(np.float64)
    out["word_chars"] = np.bincount(text, size, minlength=n).astype(np.int64)
    out["n_symbols"] = per_text(_SYMBOL[buf], off)
    out["n_upper"] = per_text(_UPPER[buf], off)

    bytes_up_to = byte_prefix(buf)
    breaks = np.flatnonzero(buf == 10)
    k = np.searchsorted(breaks, start)
    new = np.ones(len(start), bool)
    new[1:] = (k[1:] != k[:-1]) | (text[1:] != text[:-1])
    k, of = k[new], text[new]
    edge = np.concatenate([[-1], breaks, [len(buf)]])
    line = span_hash(
        bytes_up_to, np.maximum(edge[k] + 1, off[of]), np.minimum(edge[k + 1], off[of + 1])
    )
    _, at = np.unique(with_text(line, of), return_index=True)
    out["n_lines"] = np.bincount(of, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(of[at], minlength=n)

    word = prefix(span_hash(bytes_up_to, start, end))
    i = np.arange(max(0, len(start) - WINDOW + 1))
    i = i[text[i] == text[i + WINDOW - 1]] if len(i) else i
    key = with_text(span_hash(word, i, i + WINDOW), text[i])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(i), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = i[again]
    inside = covered(len(start), hit, hit + WINDOW)
    out["n_repeat_words"] = np.bincount(text[inside], minlength=n)
    return out


def failures(m: dict[str, np.ndarray]) -> np.ndarray:
    """Failure bits; the rules' conditions are plain integer arithmetic in SQL and in Python."""
    bits = np.zeros(len(m["n_words"]), np.int64)
    for i, (_, rule) in enumerate(RULES):
        bits |= eval(rule, {"__builtins__": {}}, m).astype(np.int64) << i  # noqa: S307
    return bits


def _measured(col: pa.Array) -> dict[str, np.ndarray]:
    found = [measure(buf, off) for _, _, buf, off in parts(col)]
    return {k: np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in MEASURES}


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measurements and ``failures``.

    Words are runs of other than ASCII white space. A null or empty text has no words and lines, all
    its measurements are 0 and it fails ``few_words``. Repeated rows are measured each. Columns
    other than doc_id and text are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _measured(b.column("text"))
            cols = [b.column("doc_id"), *(pa.array(m[k]) for k in MEASURES)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(failures(m))], ["doc_id", *MEASURES, "failures"]
            )

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in MEASURES) + ", failures long"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def passing(docs: DataFrame, policy: Policy = POLICIES["v1"]) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that the policy keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = failures(_measured(b.column("text"))) & policy.rules
            failed = sum((bits >> i) & 1 for i in range(len(RULES)))
            yield b.filter(pa.array(failed <= policy.allowed))

    return arrow_map(docs, run, docs.schema)


def ablation(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those kept if it alone were left out.

    The ledger is first reduced to one row per combination of bits, at most 2 ** rules of them.
    """
    by_bits = led.groupBy("failures").agg(F.count("*").alias("n"))
    used = [(i, name) for i, (name, _) in enumerate(RULES) if policy.rules >> i & 1]
    rules = F.array(
        *(F.struct(F.lit(name).alias("rule"), F.lit(1 << i).alias("bit")) for i, name in used)
    )
    x = by_bits.withColumn("r", F.explode(rules)).select("failures", "n", "r.*")
    held = F.bit_count(F.col("failures").bitwiseAND(F.lit(policy.rules)))
    own = F.when(F.col("failures").bitwiseAND(F.col("bit")) != 0, 1).otherwise(0)
    freed = (held > policy.allowed) & (held - own <= policy.allowed)
    return x.groupBy("rule").agg(
        F.sum(F.col("n") * own).alias("n_failed"),
        F.sum(F.when(freed, F.col("n")).otherwise(0)).alias("n_freed"),
    )
