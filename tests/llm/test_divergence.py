"""Divergence of sources against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dropsieve.llm import divergence

from .conftest import CLASHING

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
COLUMNS = "doc_id long, text string, lang string, source string"


def brute(docs, least=10, top=10):
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []

    def gap(p, q):
        return (p - q) ** 2 // (p + q)

    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        both = sum((count[lang, s] for s in sources), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        own, q = {s: share(count[lang, s]) for s in sources}, share(both)
        for s in sources:
            pairs = [(sum(gap(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(gap(own[s][t], q[t]), t) for t in kept if count[lang, s][t] and own[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", more, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(order, 1)]
    return sorted(out)


def documents():
    rng = random.Random(2)
    words = ["the", "The", "the,", "(the)", "a-b", "Été", "été!", "x1", "x2", "x3", "日本", "é", "É", "don't", "_", "12"]
    words += ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "fr", None, ""])
        text = " ".join(rng.choice(words) + rng.choice(["", "", ".", "!", ",x"]) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, lang, "hot" if rng.random() < 0.4 else rng.choice(["s1", "s2", "s3", "S3", None, ""])))
    rows += [(500 + i, f"x{i} Rare{i}mid y,y", "en", "s1") for i in range(12)]
    rows += [(600, None, "zz", "only"), (601, "", "zz", "other"), (602, "few terms", "de", "s"), (None, "the the", "en", "s9")]
    rows += [(700, "same row", "en", "s1")] * 11 + [(701, "long " * 1_200_000 + "the end", "en", "s2")]
    return rows


@pytest.mark.parametrize("tile", [divergence.TILE, 2])
def test_audit(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "FLUSH", 3000)
    monkeypatch.setattr(divergence, "HELD_ROWS", 50)
    rows = documents()
    df = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in (*CLASHING, "term", "i", "chunk", "docs")})
    got = divergence.audit(df.repartition(4))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_unsure_terms_are_counted(spark):
    """Twelve documents hold the term in six chunks, two documents each, or five documents in all of them."""
    ends = [".", "!", "?", ",", ";", ":"]
    rows = [(i, "word" + ends[i % 6], "en", "s") for i in range(12)]
    rows += [(20 + i, " ".join("other" + e for e in ends), "en", "t") for i in range(5)]
    kept = divergence.kept_counts(spark.createDataFrame(rows, COLUMNS).repartition(3)).collect()
    assert sorted(map(tuple, kept)) == [("en", "s", "word", 12)]


def test_chunks_of_equal_hash_may_alternate(spark, monkeypatch):
    """Rows of a chunk need not be in one run, nor those of a group side by side."""
    monkeypatch.setattr(divergence.F, "xxhash64", lambda c: F.length(c) * 0)
    rows = [("a.", "en", "s"), ("b", "en", "s"), ("a.", "fr", "s"), ("a.", "en", "t"), ("b", "en", "s"), ("a.", "en", "s")]
    chunks = spark.createDataFrame([(*r, 2, 1) for r in rows * 3], "chunk string, lang string, source string, n long, docs long")
    got = divergence.term_counts(chunks.coalesce(1)).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs"))
    sums = {tuple(r)[:4] for r in got.collect()}
    assert sums == {("en", "s", "a", 12), ("en", "t", "a", 6), ("fr", "s", "a", 6), ("en", "s", "b", 12)}


def test_a_task_adds_up_what_it_sees_twice(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH", 1)
    docs = spark.createDataFrame([(i, "twice twice once" + str(i), "en", "s") for i in range(50)], COLUMNS)
    found = divergence.chunk_counts(docs.coalesce(1)).where("chunk = 'twice'").collect()
    assert [(r.n, r.docs) for r in found] == [(100, 50)]


def test_spans_as_strings():
    buf = divergence.np.frombuffer(b"ab cdefg", divergence.np.uint8)
    got = divergence.strings(buf, divergence.np.array([0, 3, 5]), divergence.np.array([2, 5, 8]))
    assert got.to_pylist() == ["ab", "cd", "efg"]


def test_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], COLUMNS)).count() == 0
