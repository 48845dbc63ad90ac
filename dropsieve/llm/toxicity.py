"""Toxicity learned from many weak voters, without trusting any of them.

Voters look at a text and say "toxic" or abstain: word lists, patterns of their use, and words, stems
and repeated stems that learning rows suggest. A generative label model takes the true label as
hidden: by expectation maximisation it estimates how often each voter speaks on toxic and on other
texts, and how voters correlate beyond the label, so that a clique of voters counts as about one. A
linear classifier is then trained on the posterior labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import (
    U,
    arrow_map,
    byte_prefix,
    fold,
    mix,
    parts,
    span_hash,
    with_text,
    words,
)
from dropsieve.llm.linear import fit_soft, only, sample_ids, score, sigmoid

LEXICONS = {  # fixed values
    "person": "idiot moron clown loser imbecile fool jerk dumbass idiota imbécil imbécile crétin "
    "idiotin trottel depp tonto estúpido",
    "contempt": "stupid pathetic worthless disgusting dumb useless dämlich wertlos widerlich nutzlos "
    "inútil asqueroso inutile dégoûtant",
    "filth": "scum trash garbage filth vermin abschaum dreck müll escoria basura ordure racaille",
    "threat": "kill hate hurt destroy töten hasse matar odio tuer haine",
    "oath": "damn hell shit crap bastard scheiße mierda merde",
}
YOU = "you your you're du dein tu ton ta vous usted eres"  # fixed values

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
STEMS = (5, 6, 8)
_WORD, _TWICE = U(1), U(64)


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 in lower case, of UTF-8 bytes."""
    out = _LOWER[buf]
    if len(buf) > 1:
        capital = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return words(np.where(_LETTER[buf], buf, np.uint8(32)), off)


def _hash_of(word: str) -> int:
    b = lowered(np.frombuffer(word.encode(), np.uint8))
    p = byte_prefix(b)
    return int(span_hash(p, np.array([0]), np.array([len(b)]))[0])


def _known(listed: str) -> np.ndarray:
    return np.array(sorted(_hash_of(w) for w in listed.split()), np.uint64)


_LISTS = {k: _known(v) for k, v in LEXICONS.items()}
_ALL = np.unique(np.concatenate(list(_LISTS.values())))
_YOU = _known(YOU)
FIXED = (*LEXICONS, "two_listed", "often_listed", "said_to_you", "shouted", "silence")


def tokens(
    buf: np.ndarray, off: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every word, whether it is in capitals, and of all distinct tokens.

    A text's tokens are its words, the stems of some lengths in bytes of longer words, and stems
    that two or more different words of the text share.
    """
    start, end, text = _words(buf, off)
    low = lowered(buf)
    p = byte_prefix(low)
    word = span_hash(p, start, end)
    changed = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(low != buf, out=changed[1:])
    loud = (changed[end] - changed[start] > 1) if len(start) else np.zeros(0, bool)
    _, k = np.unique(with_text(word, text), return_index=True)
    tok, of = [mix(word[k] + _WORD)], [text[k]]
    s, e, t = start[k], end[k], text[k]
    for n in STEMS:
        long = e - s > n
        stem = mix(span_hash(p, s[long], s[long] + n) + U(n))
        _, first, count = np.unique(with_text(stem, t[long]), return_index=True, return_counts=True)
        tok.append(stem[first])
        of.append(t[long][first])
        twice = first[count > 1]
        tok.append(mix(stem[twice] + _TWICE))
        of.append(t[long][twice])
    return word, text, loud, np.concatenate(tok), np.concatenate(of)


def votes(buf: np.ndarray, off: np.ndarray, mined: np.ndarray) -> np.ndarray:
    """One row per text, one column per fixed voter and mined token (ascending hashes)."""
    n = len(off) - 1
    word, text, loud, tok, of = tokens(buf, off)
    out = np.zeros((n, len(FIXED) + len(mined)), np.uint8)
    for j, known in enumerate(_LISTS.values()):
        out[text[np.isin(word, known)], j] = 1
    listed = np.isin(word, _ALL)
    hits = np.bincount(text[listed], minlength=n)
    size = np.maximum(np.bincount(text, minlength=n), 1)
    j = len(_LISTS)
    out[:, j] = hits >= 2
    out[:, j + 1] = hits * 50 > size
    after = np.zeros(len(word), bool)
    for gap in (1, 2, 3):
        after[gap:] |= np.isin(word[:-gap], _YOU) & (text[:-gap] == text[gap:])
    out[text[listed & after], j + 2] = 1
    out[text[listed & loud], j + 3] = 1
    if len(mined) and len(tok):
        at = np.minimum(np.searchsorted(mined, tok), len(mined) - 1)
        hit = mined[at] == tok
        out[of[hit], len(FIXED) + at[hit]] = 1
    out[:, j + 4] = ~out.any(axis=1)
    return out


def column_votes(col: pa.Array, mined: np.ndarray) -> np.ndarray:
    rows = [votes(buf, off, mined) for _, _, buf, off in parts(col)]
    return np.concatenate(rows or [np.zeros((0, len(FIXED) + len(mined)), np.uint8)])


@dataclass
class LabelModel:
    """Rates of each voter on toxic and on other texts, its weight among its like, and the prior."""

    toxic: np.ndarray
    other: np.ndarray
    weight: np.ndarray
    prior: float

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """A single abstention says nothing, as most voters know one language; silence of all
        does, and is a voter itself."""
        gain = self.weight * np.log(self.toxic / self.other)
        return sigmoid(np.log(self.prior / (1 - self.prior)) + v @ gain)


def _weights(rest: np.ndarray) -> np.ndarray:
    """One over the number of voters that each goes with, itself included."""
    cov = rest.T @ rest
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    tie = np.clip(cov / np.outer(scale, scale), 0, 1)
    tie[tie < 0.3] = 0
    return 1 / np.maximum(tie.sum(axis=1), 1)


def label_model(
    v: np.ndarray, toxic: np.ndarray, other: np.ndarray, prior: float, trust: float = 4.0
) -> LabelModel:
    """Expectation maximisation at a given class balance.

    ``toxic`` and ``other`` are first guesses of the rates; they weigh like ``trust`` times the
    rows, so that the voters' majority cannot drift away from what the label means.
    """
    v = v.astype(np.float64)
    m = LabelModel(toxic, other, _weights(v - v.mean(axis=0)), prior)
    for _ in range(25):
        q = m.posterior(v)
        on, off = q.sum(), (1 - q).sum()
        held = trust * prior * len(v)
        m.toxic = np.clip((q @ v + held * toxic) / (on + held), 1e-6, 1 - 1e-6)
        held = trust * (1 - prior) * len(v)
        m.other = np.clip(((1 - q) @ v + held * other) / (off + held), 1e-6, 1 - 1e-6)
        # What voters share beyond the label.
        m.weight = _weights(v - q[:, None] * m.toxic - (1 - q)[:, None] * m.other)
    return m


@dataclass
class Model:
    mined: np.ndarray
    weights: np.ndarray

    def score(self, v: np.ndarray) -> np.ndarray:
        return score(v.astype(np.float64), self.weights)


def mined_tokens(
    sample: DataFrame, limit: int, least: int = 3, gain: float = 3.5
) -> list[tuple[int, int, int]]:
    """Tokens that toxic rows of ``sample`` (toxic, text) hold ``exp(gain)`` times as often as others,
    and at least ``least`` of them, with the numbers of both; at most ``limit``, the most telling
    first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = b.column("toxic").to_numpy(zero_copy_only=False)
            for i, _, buf, off in parts(b.column("text")):
                *_, tok, of = tokens(buf, off)
                key, inv = np.unique(tok, return_inverse=True)
                pos = np.bincount(inv, label[i + of], minlength=len(key)).astype(np.int64)
                n = np.bincount(inv, minlength=len(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(pos), pa.array(n - pos)],
                    ["token", "pos", "neg"],
                )

    total = sample.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    p, n = total["p"] or 0, (total["n"] or 0) - (total["p"] or 0)
    own = F.expr(f"ln((pos + 0.5) / {p + 1}) - ln((neg + 0.5) / {n + 1})")
    counts = (
        arrow_map(sample.select("toxic", "text"), run, "token long, pos long, neg long")
        .groupBy("token")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(f"pos >= {least}")
        .withColumn("gain", own)
        .where(F.col("gain") > gain)
        .orderBy(F.desc(F.col("gain") * F.sqrt("pos")), "token")
        .limit(limit)
    )
    return [(r["token"], r["pos"], r["neg"]) for r in counts.collect()]


def fit(docs: DataFrame, labels: DataFrame, rows: int = 20_000, voters: int = 300) -> Model:
    """Learns from at most ``rows`` rows of ``labels`` (doc_id, toxic), those of the lowest hash.

    At most ``voters`` mined tokens take part. To the driver go these and the sample's votes, a bit
    each. Labels serve to propose voters and first guesses; the classifier sees posteriors only.
    """
    ids = sample_ids(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), rows)
    sample = only(docs.select("doc_id", "text"), ids).selectExpr("doc_id", "cast(toxic AS long) toxic", "text")
    found = sorted(
        (int(np.int64(t).view(np.uint64)), pos, neg) for t, pos, neg in mined_tokens(sample, voters)
    )
    mined = np.array([t for t, _, _ in found], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.packbits(column_votes(b.column("text"), mined), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("toxic"), pa.array([x.tobytes() for x in v], pa.binary())],
                ["doc_id", "toxic", "v"],
            )

    got = arrow_map(sample, run, "doc_id long, toxic long, v binary").toPandas().sort_values("doc_id")
    width = len(FIXED) + len(mined)
    if not len(got):
        return Model(mined, np.append(np.zeros(width), -2.0))
    v = np.stack([np.frombuffer(x, np.uint8) for x in got["v"]])
    v = np.unpackbits(v, axis=1)[:, :width]
    y = got["toxic"].to_numpy(np.float64)
    toxic = (y @ v + 0.5) / (y.sum() + 1)
    other = ((1 - y) @ v + 0.5) / ((1 - y).sum() + 1)
    prior = float(np.clip(y.mean(), 0.001, 0.5))
    q = label_model(v, toxic, other, prior).posterior(v)
    return Model(mined, fit_soft(v.astype(np.float64), q))


def predict(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score and predicted for every row, from its whole text alone.

    No voter speaks on a null or empty text; it gets the score of silence. Repeated rows are scored
    each; columns other than doc_id and text are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.score(column_votes(b.column("text"), model.mined))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return arrow_map(texts, run, "doc_id long, score double, predicted int")


def learning_labels(labels: DataFrame) -> DataFrame:
    return labels.where(f"toxic IS NOT NULL AND {fold()} <> 0")
