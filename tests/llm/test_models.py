"""Learned operators on held-out rows, exact search, and what they make of odd rows."""

import os
import random

import numpy as np
import pytest

from dropsieve.llm import langid, quality, topk, toxicity
from dropsieve.llm.common import table

FOLDER = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="provided tables not here")


def held_out_accuracy(spark, predicted, label):
    labels = table(spark, FOLDER, "labels").where("crc32(cast(doc_id AS string)) % 5 = 0")
    x = predicted.join(labels, "doc_id").select("predicted", label).collect()
    return sum(r["predicted"] == r[label] for r in x) / len(x)


@given
def test_quality(spark, odd, nothing):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = quality.fit(docs, *quality.learning_ids(docs, labels))
    assert 0.6 < model.prior < 0.99
    assert held_out_accuracy(spark, quality.predict(docs, model), "quality") > 0.93
    got = quality.predict(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    empty = quality.fit(nothing, nothing.select("doc_id"), nothing.select("doc_id"))
    assert {r["score"] for r in quality.predict(odd, empty).collect()} == {0.5}


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    pos = rng.normal(2, 1, 4000)
    unl = np.append(rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200))
    assert abs(quality.estimated_prior(pos, unl) - 0.7) < 0.05


@given
def test_toxicity(spark, odd, nothing):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = toxicity.fit(docs, toxicity.learning_labels(labels))
    assert held_out_accuracy(spark, toxicity.predict(docs, model), "toxic") > 0.9
    got = toxicity.predict(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.fit(nothing, labels.limit(0))
    assert all(r["predicted"] == 0 for r in toxicity.predict(odd, none).collect())


def test_cliques_of_voters_count_once():
    rng = np.random.default_rng(4)
    y = rng.random(4000) < 0.2
    alone = (rng.random((4000, 3)) < np.where(y, 0.6, 0.03)[:, None]).astype(np.uint8)
    clique = np.repeat((rng.random(4000) < np.where(y, 0.4, 0.2))[:, None], 5, axis=1).astype(np.uint8)
    v = np.hstack([alone, clique, ~(alone.any(axis=1) | clique.any(axis=1))[:, None]]).astype(np.uint8)
    toxic, other = np.array([0.5] * 8 + [0.05]), np.array([0.05] * 3 + [0.3] * 5 + [0.6])
    m = toxicity.label_model(v, toxic, other, 0.2)
    assert m.weight[:3].min() > 0.7 and m.weight[3:8].max() < 0.4
    assert ((m.posterior(v) > 0.5) == y).mean() > 0.9


@given
def test_language(spark, odd, nothing):
    docs = table(spark, FOLDER, "documents")
    model = langid.fit(langid.learning_rows(docs))
    got = langid.predict(docs, model).join(docs, "doc_id").where("crc32(cast(doc_id AS string)) % 4 = 2")
    got = got.select("lang", "lang_pred", "rejected").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert sum(r["rejected"] for r in got) <= 1
    by = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert all(by[i]["lang_pred"] == "und" and by[i]["rejected"] for i in (1, 2, 3))
    assert langid.accepted(docs, model).columns == docs.columns
    none = langid.fit(nothing)
    assert {r["lang_pred"] for r in langid.predict(odd, none).collect()} == {"und"}
    assert langid.predict(nothing, model).count() == 0


def test_language_probabilities_sum_to_one(spark):
    from tests.llm.conftest import made

    model = langid.fit(made(spark, [(1, "abab abba cab", "xx"), (2, "dada dad add", "yy")]))
    every = np.array([langid.BLANK, *map(ord, "abcd")], np.uint64)
    unseen = (langid.ALPHABET - len(every)) / langid.ALPHABET
    for before in ("   ", " ab", "dad"):
        head = sum(ord(c) << 16 * (3 - k) for k, c in enumerate(before))
        p = model.probabilities(every | np.uint64(head)).sum(axis=0)
        rest = model.probabilities(np.array([head + ord("q")], np.uint64))[0] * langid.ALPHABET * unseen
        assert np.allclose(p + rest, 1, atol=1e-5)


def test_language_model_keeps_every_gram_in_arrays_and_in_tables(spark):
    from collections import Counter

    from tests.llm.conftest import made

    rng = random.Random(5)
    wide = [chr(0x4E00 + i) for i in range(2000)]
    rows = [(i, "".join(rng.choice(wide) for _ in range(600)), "zh") for i in range(200)]
    rows += [(1000 + i, " ".join(rng.choice(("ab", "abc", "cad")) for _ in range(40)), "xx") for i in range(200)]
    docs = made(spark, rows)
    model = langid.fit(docs)
    real = Counter(x for _, t, lang in rows if lang == "zh" for s in [f"   {t}"] for x in (s[i:i + 4] for i in range(len(t))))
    seen = np.array([sum(ord(c) << 16 * (3 - k) for k, c in enumerate(x)) for x in real], np.uint64)
    hashes, share = model.grams[4]
    at = np.searchsorted(hashes, langid.mix(seen))
    assert (hashes[at] == langid.mix(seen)).all() and (share[at, model.languages.index("zh")] > 0).all()
    large = langid.fit(docs, max_values=0)
    assert large.tables and not large.grams
    more = docs.limit(30).unionByName(made(spark, [(1, None, None), (None, "abc cad", None), (7, "\u6f22 x", None)] * 2))
    pair = [sorted(map(tuple, langid.predict(more, m).collect()), key=str) for m in (model, large)]
    assert len(pair[0]) == len(pair[1]) == 36
    for a, b in zip(*pair):
        assert a[:2] == b[:2] and a[4] == b[4] and np.allclose(a[2:4], b[2:4], atol=1e-6)
    kept = [sorted(map(str, langid.accepted(more, m).collect())) for m in (model, large)]
    assert kept[0] == kept[1] and langid.accepted(more, large).columns == more.columns


def test_language_is_calibrated_on_every_row_set_aside(spark, monkeypatch):
    from tests.llm.conftest import made

    rng = random.Random(4)
    letters = ("abcde", "mnopq")
    rows = [(i, " ".join(rng.choice(letters[i % 2]) * 2 for _ in range(1, 3)), ("xx", "yy")[i % 2]) for i in range(90_000)]
    read, stored = [], langid.stored

    def counted(df, name):
        out = stored(df, name)
        if name == "entropies":
            read.append(out.count())
        return out

    monkeypatch.setattr(langid, "stored", counted)
    docs = made(spark, rows).repartition(8)
    model = langid.fit(docs)
    aside = docs.where(langid._ASIDE).count()
    assert aside > 20_000 and read == [aside]
    assert (model.limit < np.inf).all() and (model.spread > 0).all()


def test_foreign_text_is_rejected(spark):
    from tests.llm.conftest import made

    rng = random.Random(2)
    rows = []
    for i in range(400):
        letters = ("abcde", "mnopq")[i % 2]
        text = " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(30))
        rows.append((i, text, ("xx", "yy")[i % 2]))
    model = langid.fit(made(spark, rows))
    more = [(1, rows[0][1], None), (2, "вот совсем другой язык и другие буквы " * 5, None), (3, "123 !!", None)]
    by = {r["doc_id"]: r for r in langid.predict(made(spark, more), model).collect()}
    assert by[1]["lang_pred"] == "xx" and not by[1]["rejected"]
    assert by[2]["rejected"] and by[3]["lang_pred"] == "und"
    assert [r["doc_id"] for r in langid.accepted(made(spark, more), model).collect()] == [1]


def test_foreign_text_is_rejected_in_spite_of_wrong_labels(spark):
    from tests.llm.conftest import made

    rng = random.Random(3)

    def text(letters, n=30):
        return " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(n))

    rows = [(i, text(("abcde", "mnopq")[i % 2]), ("xx", "yy")[i % 2]) for i in range(800)]
    rows += [(800 + i, text([chr(0x4E00 + rng.randrange(20000)) for _ in range(400)]), "xx") for i in range(12)]
    model = langid.fit(made(spark, rows))
    more = [(1, text("абвгд"), None), (2, text("αβγδε", 100), None), (3, text("abcde"), None), (4, text("mnopq", 60), None)]
    by = {r["doc_id"]: r for r in langid.predict(made(spark, more), model).collect()}
    assert by[1]["rejected"] and by[2]["rejected"]
    assert not by[3]["rejected"] and not by[4]["rejected"]
    assert (by[3]["lang_pred"], by[4]["lang_pred"]) == ("xx", "yy")


def brute_top(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all():
            ok[i] = [int(np.floor(256 * x)) for x in v]
    out = []
    for q in ok:
        if q % 5 == 0:
            s = [(-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])]
            out += [(q, r, i, -p) for r, (p, i) in enumerate(sorted(s)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1, 3, 40, 300])
def test_top_k(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(0, 1, 24).round(1).tolist()) for i in range(size)]
    rows += [(1000 + i, [0.5] * 24) for i in range(20)]
    rows += [(2000, None), (2005, []), (2010, [1.0, None] * 12), (2015, [float("nan")] * 24), (None, [0.5] * 24)]
    rows += [(2020, [float("inf")] * 24), (3000, [1e9] * 24), (3005, [0.1, 0.2]), (4000, [0.5] * 24), (4000, [0.5] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS slot", "2 AS width")
    got = topk.top_k(df, "vec_id % 5 = 0", k=5)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5)
    assert topk.top_k(df.limit(0), "vec_id % 5 = 0").count() == 0


def test_top_k_of_products_beyond_a_double(spark):
    rng = np.random.default_rng(8)
    v = {i: [float(x) for x in rng.integers(-(2**30), 2**30, 3)] for i in range(12)}
    v[11] = [2.0**32, 3.0, 0.0]
    df = spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, "vec_id < 4", k=3, factor=1).collect())
    want = []
    for q in range(4):
        best = sorted((-sum(int(a) * int(b) for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q)[:3]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == want and max(abs(r[3]) for r in want) > 2**53
    large = spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="more than 64 bits"):
        topk.top_k(large, "vec_id = 1").collect()


def test_top_k_copies_no_block_for_a_pair(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    stored = topk.stored
    monkeypatch.setattr(topk, "stored", kept)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 8).round(1).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, "vec_id % 5 = 0", k=5).collect())) == brute_top(rows, 5)
    (meeting,) = (plan for _, plan in plans if "Join" in plan or "CartesianProduct" in plan)
    assert "CartesianProduct" in meeting and "Generate" not in meeting and "Broadcast" not in meeting


def test_top_k_of_many_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 7), ("PART_BLOCKS", 2), ("TILE_QUERIES", 3), ("TILE_ROWS", 4), ("FIRST_ROWS", 2)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    sizes = [(0.1, 16), (1, 16), (300, 16), (1e6, 16), (1, 3)]  # of components: two, four and eight bytes a component
    rows = [(i, (rng.normal(0, s, w)).round(2).tolist()) for i in range(240) for s, w in [sizes[i % 5 if i % 3 else 1]]]
    rows += [(300 + i, rows[7][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert sorted(map(tuple, topk.top_k(df, "vec_id % 5 = 0", k=5).collect())) == brute_top(rows, 5)


@pytest.mark.parametrize("kind", ["alike", "spread", "means", "ties", "large"])
def test_blocks_meet_in_any_order(monkeypatch, kind):
    monkeypatch.setattr(topk, "TILE_QUERIES", 16)
    monkeypatch.setattr(topk, "TILE_ROWS", 64)
    monkeypatch.setattr(topk, "FIRST_ROWS", 8)
    used, worth = set(), topk.worth
    monkeypatch.setattr(topk, "worth", lambda *a: used.add(tuple(worth(*a))) or worth(*a))
    rng = np.random.default_rng(5)
    d = rng.normal(0, 30, (600, 64))
    d *= {"spread": np.exp(rng.normal(0, 2, (600, 1))), "large": 2.0**24}.get(kind, 1.0)
    d = np.repeat(d[:15], 40, axis=0) if kind == "ties" else d
    d = d * 0.1 + rng.choice([-100, 0, 100], (600, 1)) if kind == "means" else d
    d, ids = np.floor(d).astype(np.int64), np.sort(rng.choice(5000, 600, replace=False))
    asked = np.arange(0, 600, 12)
    best, q = topk.Best(len(asked), 5), topk.Block(ids[asked], d[asked])
    part = rng.integers(0, 3, 600)
    for p in (2, 0, 1):
        topk.meet(best, q, topk.Block(ids[part == p], d[part == p]))
    products = d[asked].astype(object) @ d.T.astype(object)
    for n, i in enumerate(asked):
        want = sorted((-products[n, j], ids[j]) for j in range(600) if j != i)[:5]
        assert [(-int(s), v) for s, v in zip(best.products[n], best.ids[n])] == want
    if kind in ("spread", "means"):
        assert any(used)  # bounds left out rows
