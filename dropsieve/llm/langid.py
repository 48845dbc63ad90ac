"""Language identification with interpolated Kneser-Ney models of characters.

A text is reduced to its lower-case letters, every run of other characters being one blank. Grams of
up to four characters are counted per language over all learning rows, and every gram is kept. A model of
bounded size is held as a hash array per order, sorted by hash, with a column per language; a larger
one stays in tables that the grams of the texts are joined to. A text goes to the language of lowest
cross-entropy per character; whether it is a text of that language at all is judged by how far the
cross-entropy lies above what learning texts of that length show.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.quantiles import exact_median, exact_quantiles
from dropsieve.llm.cache import kept
from dropsieve.llm.common import arrow_map, drop, fold, mix, parts, stored
from dropsieve.llm.pieces import LETTER, char_classes, code_points

ORDER = 4
MAX_VALUES = 8_000_000  # grams times languages of a model in arrays: some 75 MB
CHUNK = 1 << 22  # characters of the texts that meet their grams in one task
ALPHABET = 1 << 16
BLANK = 0x20
UNKNOWN = "und"
FLUSH = 1_000_000
BANDS = 4 ** np.arange(2, 8)  # of text lengths, for rejection
BAND_ROWS = 100  # a band with fewer rows of a language takes those of all its bands
HIGH = 0.95  # quantile of calibration rows; up to one in twenty may be mislabelled
U = np.uint64


def lower_table() -> np.ndarray:
    """The lower-case form of every code point in 16 bits; 0 for what is no letter."""
    if "lower" not in kept():
        t = np.where(char_classes() == LETTER, np.arange(0x110000), 0).astype(np.int64)
        for c in np.flatnonzero(t[:0x20000]).tolist():
            x = chr(c).lower()
            if len(x) == 1:
                t[c] = ord(x)
        high = t >= ALPHABET
        # Letters beyond 16 bits share the 6,400 places of the private area.
        t[high] = 0xE000 + t[high] % 6400
        kept()["lower"] = t.astype(np.uint16)
    return kept()["lower"]


def letters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each text led by a blank, and where each text begins.

    A text without a letter has its blank only.
    """
    cp, at = code_points(buf)
    c = lower_table()[np.minimum(cp, 0x10FFFF)]
    text = np.searchsorted(off, at, "right") - 1
    n = len(off) - 1
    # A blank goes before each text; blanks after a blank are dropped.
    c = np.where(c == 0, BLANK, c)
    c = np.insert(c, np.searchsorted(text, np.arange(n)), BLANK)
    text = np.insert(text, np.searchsorted(text, np.arange(n)), np.arange(n))
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != BLANK) | (c[:-1] != BLANK) | (text[1:] != text[:-1])
    c, text = c[keep], text[keep]
    return c, np.searchsorted(text, np.arange(n + 1))


def grams(c: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The last ``ORDER`` characters up to each place, 16 bits each; blanks before the text."""
    back = np.arange(len(c)) - np.repeat(begin[:-1], np.diff(begin))
    key = np.zeros(len(c), np.uint64)
    for k in range(ORDER):
        x = np.full(len(c), BLANK, np.uint64)
        x[k:] = c[: len(c) - k]
        x[back < k] = BLANK
        key |= x << U(16 * k)
    return key


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, bool], list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(lang: tuple[str, bool]) -> tuple[np.ndarray, np.ndarray]:
        key, inv = np.unique(np.concatenate([k for k, _ in held[lang]]), return_inverse=True)
        n = np.bincount(inv, np.concatenate([n for _, n in held[lang]]), minlength=len(key))
        return key, n.astype(np.int64)

    def flushed() -> Iterator[pa.RecordBatch]:
        for lang, aside in sorted(held):
            key, n = merged((lang, aside))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(key), pa.string()),
                    pa.array([aside] * len(key), pa.bool_()),
                    pa.array(key.view(np.int64)),
                    pa.array(n),
                ],
                ["lang", "aside", "gram", "n"],
            )

    for b in batches:
        keys = list(zip(b.column("lang").to_pylist(), b.column("aside").to_pylist()))
        for own in sorted(set(keys)):
            col = b.column("text").filter(pa.array([k == own for k in keys]))
            for _, _, buf, off in parts(col):
                c, begin = letters(buf, off)
                codes, uniq = pd.factorize(grams(c, begin)[np.delete(np.arange(len(c)), begin[:-1])])
                if len(uniq):
                    held.setdefault(own, []).append((uniq, np.bincount(codes)))
                    size += len(uniq)
            if size > FLUSH:
                for x in held:
                    held[x] = [merged(x)]
                size = sum(len(x[0][0]) for x in held.values())
                if size > FLUSH // 2:
                    yield from flushed()
                    held.clear()
                    size = 0
    yield from flushed()


# Rows set aside: the final model counts them, the one that confidence is measured with does not.
_ASIDE = "coalesce(pmod(xxhash64(doc_id), 4) = 0, false)"


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram, n over all ``rows`` with a language and a text, and ``n_part`` without those set
    aside."""
    known = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    known = known.selectExpr("lang", f"{_ASIDE} AS aside", "text")
    return (
        arrow_map(known, _count, "lang string, aside boolean, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"), F.sum(F.expr("if(aside, 0L, n)")).alias("n_part"))
    )


@dataclass
class Model:
    """Per order: hashes of grams in ascending order with their own share of the probability, and
    of contexts with the weight of the next lower order; a column per language.

    A larger model has ``tables`` instead: grams with ``share`` and contexts with ``weight``, both
    arrays by language."""

    languages: list[str]
    tables: dict[int, tuple[DataFrame, DataFrame]] = field(default_factory=dict)
    grams: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    contexts: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: np.ndarray | None = None
    floor: np.ndarray | None = None
    sharpness: float = 1.0

    def probabilities(self, key: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of the last character given those before it, in each language."""
        if not order or not self.languages:
            return np.full((len(key), len(self.languages)), 1 / ALPHABET)
        low = key & U((1 << 16 * (order - 1)) - 1) if order > 1 else np.zeros_like(key)
        p = self.probabilities(low, order - 1) * _rows(self.contexts[order], key >> U(16), 1.0)
        return p + _rows(self.grams[order], key, 0.0)


def _rows(stored_rows: tuple[np.ndarray, np.ndarray], key: np.ndarray, absent: float) -> np.ndarray:
    hashes, values = stored_rows
    out = np.full((len(key), values.shape[1]), absent)
    if len(hashes):
        h = mix(key)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = hashes[at] == h
        out[hit] = values[at[hit]]
    return out


def _columns(cells: pd.DataFrame, key: str, value: str, n_lang: int, absent: float) -> tuple:
    h = mix(cells[key].to_numpy(np.int64).view(np.uint64))
    hashes, at = np.unique(h, return_inverse=True)
    out = np.full((len(hashes), n_lang), absent, np.float32)
    out[at, cells["j"].to_numpy()] = cells[value]
    return hashes, out


def _by_language(cells: DataFrame, key: str, value: str, name: str, n_lang: int, absent: float) -> DataFrame:
    own = [F.max(F.when(F.col("j") == j, F.col(value))) for j in range(n_lang)]
    values = F.array(*(F.coalesce(x, F.lit(absent)).cast("float") for x in own))
    return cells.groupBy(key).agg(values.alias(name))


def _smoothed(counts: DataFrame, languages: list[str], discounts: list[list[float]]) -> tuple:
    """Kneser-Ney shares of the grams of one order and weights of their contexts, by number of the
    language, for the final and the partial model; null where the partial one has none."""
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int")
    d, d_part = (F.element_at(F.array(*map(F.lit, x)), F.col("j") + 1) for x in discounts)
    cells = counts.select(
        (number - 1).alias("j"), "gram", F.shiftrightunsigned("gram", 16).alias("context"), "n", "n_part"
    )
    by = cells.groupBy("j", "context").agg(
        F.sum("n").alias("s"),
        F.count("*").alias("c"),
        F.sum("n_part").alias("s_part"),
        F.count_if(F.col("n_part") > 0).alias("c_part"),
    )
    shares = cells.join(by, ["j", "context"]).select(
        "j",
        "gram",
        ((F.col("n") - d) / F.col("s")).alias("share"),
        F.when(F.col("n_part") > 0, (F.col("n_part") - d_part) / F.col("s_part")).alias("share_part"),
    )
    weights = by.select(
        "j",
        "context",
        (d * F.col("c") / F.col("s")).alias("weight"),
        F.when(F.col("s_part") > 0, d_part * F.col("c_part") / F.col("s_part")).alias("weight_part"),
    )
    return shares, weights


def _sizes(counts: DataFrame) -> dict[str, tuple]:
    """Per language: grams, and how many occur once and twice, in all rows and without those set
    aside."""
    seen = [F.count_if(F.col(n) == k).alias(f"{n}_{k}") for n in ("n", "n_part") for k in (1, 2)]
    return {r[0]: tuple(r)[1:] for r in counts.groupBy("lang").agg(F.count("*"), *seen).collect()}


def _discount(once: int, twice: int) -> float:
    return min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)


def fit(rows: DataFrame, max_values: int = MAX_VALUES) -> Model:
    """A model of every language in ``rows``; all its texts and all their grams are counted.

    Counts, discounts and weights are computed in Spark. To the driver go the grams of a model with
    at most ``max_values`` of them times languages; a larger one stays in stored tables. A quarter
    of the rows is set aside for a second, partial model; on all of them that model shows how sure a
    margin is and how high the cross-entropy of a language's own texts goes. A text is rejected only well above a high quantile of these among texts
    of about its length, and above three quarters of the way to what the other languages' texts
    score. Medians and quantiles keep this where some rows have a wrong label. With one language
    none is rejected.
    """
    orders = {ORDER: stored(gram_counts(rows), "grams")}
    for k in range(ORDER - 1, 0, -1):
        # A lower order counts in how many longer grams its grams occur.
        keep = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("gram")
        part = F.expr("sum(if(n_part > 0, 1L, 0L))").alias("n_part")
        lower = orders[k + 1].select("lang", keep, "n_part").groupBy("lang", "gram")
        orders[k] = stored(lower.agg(F.count("*").alias("n"), part), f"grams-{k}")
    sizes = {k: _sizes(counts) for k, counts in orders.items()}
    languages = sorted(sizes[1])
    n_lang = len(languages)
    model, partial = Model(languages), Model(languages)
    if not languages:
        return model
    held = sum(x[0] for by in sizes.values() for x in by.values()) * n_lang <= max_values
    for k, counts in orders.items():
        discounts = [[_discount(*sizes[k][x][i : i + 2]) for x in languages] for i in (1, 3)]
        shares, weights = _smoothed(counts, languages, discounts)
        if held:
            shares, weights = shares.toPandas(), weights.toPandas()
        for m, part in ((model, ""), (partial, "_part")):
            share, weight = f"share{part}", f"weight{part}"
            if held:
                m.grams[k] = _columns(shares[shares[share].notna()], "gram", share, n_lang, 0.0)
                m.contexts[k] = _columns(weights[weights[weight].notna()], "context", weight, n_lang, 1.0)
            else:
                by_gram = _by_language(shares, "gram", share, "share", n_lang, 0.0)
                by_context = _by_language(weights, "context", weight, "weight", n_lang, 1.0)
                m.tables[k] = stored(by_gram, f"shares-{k}"), stored(by_context, f"weights-{k}")
    drop(*orders.values())
    _calibrate(model, partial, rows)
    for x in partial.tables.values():
        drop(*x)
    return model


def _joined(keys: DataFrame, model: Model, order: int = ORDER) -> DataFrame:
    """``gram`` and ``p``, what ``Model.probabilities`` is for arrays: distinct grams meet tables."""
    low, context = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1)), F.shiftrightunsigned("gram", 16)
    keys = keys.select("gram", low.alias("low"), context.alias("context"))
    shares, weights = model.tables[order]
    if order > 1:
        below = _joined(keys.select(F.col("low").alias("gram")).distinct(), model, order - 1)
        keys = keys.join(below.withColumnRenamed("gram", "low"), "low")
    else:
        keys = keys.withColumn("p", F.array_repeat(F.lit(1 / ALPHABET), len(model.languages)))
        weights = F.broadcast(weights)  # of the one empty context
    p = "if(weight IS NULL, p, zip_with(p, weight, (x, y) -> x * y))"
    p = f"if(share IS NULL, {p}, zip_with({p}, share, (x, y) -> x + y)) AS p"
    return keys.join(weights, "context", "left").join(shares, "gram", "left").selectExpr("gram", p)


def _distinct_grams(t: pa.Table) -> pa.Table:
    found = [np.unique(grams(*letters(buf, off))) for _, _, buf, off in parts(t.column("text"))]
    key = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))
    chunk = pa.array(np.full(len(key), t.column("_chunk")[0].as_py(), np.int64))
    return pa.Table.from_arrays([chunk, pa.array(key.view(np.int64))], ["_chunk", "gram"])


Cost = Callable[[np.ndarray], np.ndarray]


def _on_texts(docs: DataFrame, model: Model, fn: Callable[[Model, pa.Table, Cost], pa.Table], schema) -> DataFrame:
    """``fn`` on all rows, with the cost of grams in each language.

    With a model in tables the rows are dealt into chunks of some ``CHUNK`` characters by a hash of
    doc_id and text. The distinct grams of a chunk are joined to the model and come back to it, so a
    common gram is joined once per chunk and not once per text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, tables={}))
    if not model.tables:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for b in batches:
                out = fn(m, pa.Table.from_batches([b]), lambda key: -np.log(m.probabilities(key)))
                yield from out.to_batches()

        return arrow_map(docs, run, schema)

    chars = docs.select(F.sum(F.length("text").cast("long"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 + chars // CHUNK)).alias("_chunk")
    placed = docs.select("*", chunk)
    found = placed.select("_chunk", "text").groupBy("_chunk")
    found = stored(found.applyInArrow(_distinct_grams, "_chunk long, gram long"), "chunk-grams")
    priced = found.join(_joined(found.select("gram").distinct(), model), "gram")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        key = right.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(key)
        p = right.column("p").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        key, cost = key[order], -np.log(p.reshape(-1, len(m.languages))[order])
        return fn(m, left.drop_columns(["_chunk"]), lambda x: cost[np.searchsorted(key, x)])

    return placed.groupBy("_chunk").cogroup(priced.groupBy("_chunk")).applyInArrow(meet, schema)


def entropies(model: Model, col: pa.Array, price: Cost) -> tuple[np.ndarray, np.ndarray]:
    """Number of scored characters and nats per character in each language, for every text."""
    n_lang = len(model.languages)
    size, out = [np.zeros(0, np.int64)], [np.zeros((0, n_lang))]
    for _, _, buf, off in parts(col):
        c, begin = letters(buf, off)
        codes, uniq = pd.factorize(grams(c, begin))
        cost = price(uniq) if len(uniq) else np.zeros((0, n_lang))
        n = np.diff(begin) - 1
        total = np.zeros((len(off) - 1, n_lang))
        for j in range(n_lang):
            each = cost[codes, j]
            each[begin[:-1]] = 0
            total[:, j] = np.add.reduceat(each, begin[:-1]) if len(n) else 0
        size.append(n)
        out.append(total / np.maximum(n, 1)[:, None])
    return np.concatenate(size), np.concatenate(out)


def _calibrate(model: Model, partial: Model, rows: DataFrame) -> None:
    """Thresholds and sharpness from every row set aside; medians and quantiles are exact."""
    known = rows.where(f"lang IS NOT NULL AND text IS NOT NULL AND {_ASIDE}").select("doc_id", "lang", "text")
    names = model.languages

    def run(m: Model, t: pa.Table, price: Cost) -> pa.Table:
        n, h = entropies(m, t.column("text"), price)
        truth = np.searchsorted(names, t.column("lang").to_numpy()) if len(n) else np.zeros(0, np.int64)
        cols = [truth, n, np.digitize(n, BANDS), h[np.arange(len(n)), truth]]
        cols = [pa.array(c) for c in (*cols, list(h))]
        cols[-1] = cols[-1].cast(pa.list_(pa.float64()))
        return pa.Table.from_arrays(cols, ["j", "n", "band", "own", "h"]).filter(pa.array(n > 0))

    x = stored(_on_texts(known, partial, run, "j long, n long, band long, own double, h array<double>"), "entropies")
    count = len(names)
    model.mean, model.spread = np.zeros(count), np.ones(count)
    model.limit, model.floor = np.full((2, count, len(BANDS) + 1), np.inf)
    size = {(r["j"], r["band"]): r["count"] for r in x.groupBy("j", "band").count().collect()}
    seen = sorted({j for j, _ in size})
    if len(seen) > 1:
        model.mean[seen] = [v for _, v in sorted(exact_median(x, ["j"], "own").collect())]
        each = x.select("j", F.posexplode("h").alias("of", "v")).where("of <> j")
        foreign = dict(map(tuple, exact_median(each, ["of"], "v").collect()))
        mean = F.element_at(F.array(*map(F.lit, model.mean.tolist())), F.col("j").cast("int") + 1)
        off = x.select("j", "band", "own", ((F.col("own") - mean) * F.sqrt("n")).alias("off"))
        wide = dict(map(tuple, exact_median(off.select("j", F.abs("off").alias("v")), ["j"], "v").collect()))
        model.spread[seen] = [max(1.4826 * wide[j], 1e-3) for j in seen]
        every = off.withColumn("band", F.explode(F.array("band", F.lit(-1).cast("long"))))
        high = {v: _high(every, v) for v in ("off", "own")}
        for j in seen:
            for b in range(len(BANDS) + 1):
                near = j, b if size.get((j, b), 0) >= BAND_ROWS else -1
                model.limit[j, b] = max(1.25 * high["off"][near] / model.spread[j], 4.0)
                model.floor[j, b] = max(model.mean[j] + 0.75 * (foreign[j] - model.mean[j]), high["own"][near])
    sharps = 2.0 ** np.arange(-8, 4)

    def loss(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").flatten().to_numpy(zero_copy_only=False).reshape(len(b), count)
            n, at = b.column("n").to_numpy().astype(np.float64), b.column("j").to_numpy()
            p = [_confidence(h, n, sharp)[np.arange(len(h)), at] for sharp in sharps]
            lost = [-np.log(np.maximum(v, 1e-12)).sum() for v in p]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sharps))), pa.array(lost)], ["i", "loss"])

    lost = arrow_map(x.select("j", "n", "h"), loss, "i long, loss double").groupBy("i").agg(F.sum("loss")).collect()
    # Equal losses go to the least sharpness.
    model.sharpness = float(sharps[min(lost, key=lambda r: (r[1], r[0]))[0]]) if lost else 1.0
    drop(x)


def _high(rows: DataFrame, value: str) -> dict[tuple[int, int], float]:
    """A high quantile of ``value`` by ``j`` and ``band``, a value that occurs and never the largest of several."""
    q = exact_quantiles(rows, ["j", "band"], value, [HIGH]).select("j", "band", F.col("q")[0].alias("q"))
    # The quantile lies between two values, of which the lower counts.
    upto = F.col(value) <= F.col("q") + F.abs("q") * 1e-14
    low = rows.join(F.broadcast(q), ["j", "band"]).where(upto).groupBy("j", "band").agg(F.max(value))
    return {(r[0], r[1]): r[2] for r in low.collect()}


def _confidence(h: np.ndarray, n: np.ndarray, sharpness: float) -> np.ndarray:
    x = -sharpness * h * np.minimum(n, 1000)[:, None]
    x = np.exp(x - x.max(axis=1, keepdims=True, initial=-np.inf))
    return x / x.sum(axis=1, keepdims=True)


def _judged(model: Model, col: pa.Array, price: Cost) -> tuple[np.ndarray, ...]:
    """Number of the language, confidence, cross-entropy and rejection of every text."""
    n, h = entropies(model, col, price)
    if not model.languages:
        none = np.zeros(len(n))
        return none.astype(int) - 1, none, none, np.ones(len(n), bool)
    best = np.argmin(h, axis=1)
    own = h[np.arange(len(h)), best]
    p = _confidence(h, n, model.sharpness)[np.arange(len(h)), best]
    band = np.digitize(n, BANDS)
    far = (own - model.mean[best]) * np.sqrt(n) / model.spread[best] > model.limit[best, band]
    far &= own > model.floor[best, band]
    silent = n < 1
    return np.where(silent, -1, best), np.where(silent, 0.0, p), np.where(silent, 0.0, own), far | silent


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy and rejected, for every row.

    A null text and one without a letter are ``und`` with score 0, and rejected. Equal
    cross-entropies go to the first language by name. If nothing was learned, all are ``und``.
    Repeated rows are judged each; columns other than doc_id and text are not read. No shuffle, unless
    the model is in tables.
    """

    def run(m: Model, t: pa.Table, price: Cost) -> pa.Table:
        names = np.array([*m.languages, UNKNOWN], object)
        best, p, h, far = _judged(m, t.column("text"), price)
        return pa.Table.from_arrays(
            [t.column("doc_id"), pa.array(names[best], pa.string()), *(pa.array(x) for x in (p, h, far))],
            ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
        )

    schema = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
    return _on_texts(docs.select(F.col("doc_id").cast("long"), "text"), model, run, schema)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that are a text of one of the languages."""

    def run(m: Model, t: pa.Table, price: Cost) -> pa.Table:
        return t.filter(pa.array(~_judged(m, t.column("text"), price)[3]))

    return _on_texts(docs, model, run, docs.schema)


def learning_rows(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    return docs.where(f"{fold(folds=folds)} <> {held_out}")
