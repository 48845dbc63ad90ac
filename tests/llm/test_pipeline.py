"""The pipeline against its stages done by brute force."""

import re
from collections import defaultdict

import corpus_pipeline
import pyarrow as pa
from dropsieve.llm import rules
from dropsieve.llm.cache import kept
from dropsieve.llm.common import arrow_map
from tests.llm.test_text_ops import WORD, brute_components, brute_packing, measured, own_words


def passes(text):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    m = dict(zip(names, measured(text)))
    m["n_lines"] = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    m["n_upper"] = sum("A" <= c <= "Z" for c in text or "")
    return not any(eval(rule, {}, m) for _, rule in rules.RULES)


def without_passages(docs, n):
    first = {}
    for i, t in sorted(docs.items()):
        w = own_words(t)
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    out = {}
    for i, t in docs.items():
        w = own_words(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        lead = re.match("[\x20\x09-\x0d]*", t).group()
        parts = re.findall("[^\x20\x09-\x0d]+[\x20\x09-\x0d]*", t)
        out[i] = lead + "".join(p for p, g in zip(parts, gone) if not g)
    return out


def test_stages(spark, odd, odd_rows, tmp_path):
    odd.where("doc_id IS NOT NULL AND doc_id <> 70").write.parquet(str(tmp_path / "documents.parquet"))
    docs = {i: t for i, t, _ in odd_rows if i is not None and i != 70}
    kept = {i: t for i, t in docs.items() if passes(t) and any(c.isalpha() for c in t)}
    groups = brute_components(list(kept.items()), width=5)
    kept = {i: t for i, t in kept.items() if groups[i][1] == i}
    kept = without_passages(kept, 50)
    assert 3 < len(kept) < len(docs) - 10
    want = brute_packing(kept.items())

    got, room = defaultdict(int), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]] += r["length"]
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == {i: len(x) for i, x in want.items()}
    for own in room.values():
        assert sum(n for _, n in own) <= 2048
        assert [o for o, _ in sorted(own)] == [
            sum(n for o2, n in own if o2 < o) for o, _ in sorted(own)
        ]


def test_stages_keep_the_columns(spark, odd, tmp_path):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, str(tmp_path)).columns == odd.columns


def test_workers_give_up_the_codec_of_an_earlier_stage(spark, odd, tmp_path):
    def left(batches):
        for b in batches:
            n = sum("packing" in str(k) or k == "codec" for k in kept())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    corpus_pipeline.pack_sequences(spark, odd, str(tmp_path)).collect()
    rows = spark.range(16).repartition(16)
    assert sum(r["n"] for r in arrow_map(rows, left, "n long").collect()) == 0
