"""Text operators against brute force, on texts of every odd kind."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from dropsieve.llm import bpe, common, minhash, packing, pieces, rules, substring, suffix
from dropsieve.llm.graph import components

from .conftest import made

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile("[^\x20\x09-\x0d]+")


def own_words(text):
    return WORD.findall(text or "")


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("  \n\t'sreveltmdx1٣é漢!?\U0001f600", max_size=12), max_size=5))
def test_split_matches_the_pattern(texts):
    buf, off = common.texts(pa.array(texts, pa.string()))
    want = []
    for t, at in zip(texts, off.tolist()):
        for m in regex.findall(public_tokenizers.PATTERN, t):
            want.append(at)
            at += len(m.encode())
    assert pieces.split(buf, off).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n\té", max_size=9)), max_size=6))
def test_words(texts):
    buf, off = common.texts(pa.array(texts, pa.string()))
    start, end, text = common.words(buf, off)
    raw = buf.tobytes()
    got = [(t, raw[s:e].decode()) for s, e, t in zip(start, end, text)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in own_words(t)]


def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(RANKS),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(RANKS))


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60))
def test_pieces_of_any_bytes(encoder, piece):
    want = tiktoken_encoding_cached()._encode_single_piece(piece) if piece else []
    assert encoder.encode(piece) == want


_cached = []


def tiktoken_encoding_cached():
    if not _cached:
        _cached.append(tiktoken_encoding())
    return _cached[0]


def test_ranks_in_no_order():
    """A merge may make a pair of lower rank than its own; that one goes first."""
    ranks = {bytes([b]): 10 + b for b in range(256)} | {b"ab": 5, b"cd": 6, b"abc": 2, b"bc": 7}
    one = bpe.Encoder(ranks)
    assert one.encode(b"abcd") == [2, 10 + ord("d")]
    assert one.encode(b"abab") == [5, 5]
    assert one.encode_many([b"", b"a", b"abc", b"abcdab"])[1].tolist() == [0, 1, 1, 3]


def test_rank_queue():
    q = bpe.RankQueue(50_000)
    for rank, place in [(49_999, 3), (0, 9), (4_096, 1), (0, 2)]:
        q.add(rank, [place])
    assert [q.pop() for _ in range(4)] == [(0, [2, 9]), (4_096, [1]), (49_999, [3]), None]


def test_bpe_round_trip(odd, odd_rows):
    enc = tiktoken_encoding_cached()
    want = []
    for i, t, _ in odd_rows:
        ids = enc.encode_ordinary(t or "")
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((i, len(ids), sha, hashlib.sha256((t or "").encode()).hexdigest()))
    got = rows_of(bpe.round_trip(odd, RANKS), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(odd, RANKS), RANKS)
    assert rows_of(back, "doc_id", "bytes") == sorted(
        ((i, bytearray((t or "").encode())) for i, t, _ in odd_rows), key=repr
    )


def test_bpe_of_nothing(nothing):
    assert bpe.round_trip(nothing, RANKS).count() == 0


def measured(text):
    w, seen, dup = own_words(text), set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for k in range(len(w) - 4):
        at[tuple(w[k : k + 5])].append(k)
    cover = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(5)}
    signs = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), signs, dup, len(cover)


def test_ledger(odd, odd_rows, nothing):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = rows_of(rules.ledger(odd), *cols)
    assert got == sorted(((i, *measured(t)) for i, t, _ in odd_rows), key=repr)
    assert rules.ledger(nothing).count() == 0


def test_policies_and_ablation(odd):
    led = rules.ledger(odd).cache()
    v1 = rules.POLICIES["v1"]
    kept = led.where(v1.kept()).count()
    assert rules.passing(odd, v1).count() == kept
    assert rules.passing(odd, v1).columns == odd.columns
    freed = {r["rule"]: r for r in rules.ablation(led, v1).collect()}
    for i, (name, _) in enumerate(rules.RULES):
        less = rules.Policy("less", v1.rules & ~(1 << i))
        assert freed[name]["n_freed"] == led.where(less.kept()).count() - kept
        assert freed[name]["n_failed"] == led.where(f"failures & {1 << i} <> 0").count()
    assert led.where(rules.POLICIES["lenient"].kept()).count() >= kept


def brute_packing(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    return {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in docs}


def test_added_tokens_are_taken_out_first(spark):
    texts = ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "<|endo", "ftext|>", "", "a<|endoftext|>'s  b", None]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    want = brute_packing([(i, t) for i, t, _ in rows])
    got = packing.token_pieces(made(spark, rows).coalesce(1), JSON, keep_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: x.tolist() for i, x in want.items()}


def thue_morse(n, a, b):
    """Two texts whose polynomial hashes modulo a power of two are equal whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_hashes_tell_thue_morse_words_apart(spark):
    one, two = thue_morse(2048, "a", "b")
    w1, w2 = (" ".join(x) for x in thue_morse(2048, "a", "b"))
    for x, y in ((one, two), (w1, w2)):
        buf, off = common.texts(pa.array([x, y]))
        h = common.span_hash(common.byte_prefix(buf), off[:-1], off[1:])
        assert h[0] != h[1]
    p = common.prefix(common.BYTE_VALUES[np.frombuffer((one + two).encode(), np.uint8)])
    h = common.span_hash(p, np.array([0, 2048]), np.array([2048, 4096]))
    assert h[0] != h[1]
    texts = [f"{one}\n{two}", one, two, f"start of it {w1}", f"end of all {w2}", w1, w2]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    docs = made(spark, rows).coalesce(1)
    enc = tiktoken_encoding_cached()
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, RANKS).collect()}
    assert ids == {i: enc.encode_ordinary(t) for i, t, _ in rows}
    got = rows_of(rules.ledger(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((i, *measured(t)) for i, t, _ in rows), key=repr)
    pair = minhash.near_duplicates(made(spark, [(1, one, "en"), (2, two, "en")]), width=4, percent=80)
    assert sorted(r["component_id"] for r in pair.collect()) == [1, 2]
    for length, op in ((50, substring), (400, suffix)):
        long = [(1, f"first {w1}"), (2, f"second {w2}")]
        got = {r["doc_id"]: r["n_removed"] for r in op.report(made(spark, [(i, t, "en") for i, t in long]), length=length).collect()}
        if length == 50:
            seen = {tuple(own_words(long[0][1])[k : k + 50]) for k in range(2049 - 49)}
            w = own_words(long[1][1])
            gone = {k + j for k in range(len(w) - 49) if tuple(w[k : k + 50]) in seen for j in range(50)}
            assert got == {1: 0, 2: len(gone)}


def test_packing(odd, odd_rows, nothing):
    import zlib

    docs = {i: t for i, t, _ in odd_rows if i is not None and i != 70}
    ids = brute_packing(docs.items())
    got = packing.pack_documents(odd, JSON, capacity=512).collect()
    room = defaultdict(list)
    for r in got:
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in room.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, x in ids.items():
        at = 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert k == 0 or r["length"] == 512
            assert r["ids_crc32"] == zlib.crc32(x[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(x)
    assert len(by[70]) == 2  # repeated rows are packed each
    assert packing.pack_documents(nothing, JSON).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=20))
def test_best_fit_is_best_fit_decreasing(counts):
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            k = min((g for g in gaps if g >= length), default=None)
            if k is None:
                gaps.append(40 - length)
            else:
                gaps.remove(k)
                if k > length:
                    gaps.append(k - length)
                else:
                    gaps.append(0)
    used = set()
    for _, _, n, first, each, _ in packing.best_fit(counts, 40):
        used.update(range(first, first + -(-n // each)))
    assert len(used) == len(gaps)


def test_piece_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    rng = random.Random(3)
    words = [" " + "".join(rng.choice("aeirstnöé漢-") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    words = [w for w in words if len(regex.findall(public_tokenizers.PATTERN, w)) == 1]
    flat, size = packing.piece_encoder(JSON)([w.encode() for w in words])
    want = [e.ids for e in tok.encode_batch(words, add_special_tokens=False)]
    assert flat.tolist() == [i for x in want for i in x]
    assert size.tolist() == [len(x) for x in want]


def shingles(text, width=4):
    w = re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if 0 < len(w) < width:
        return {tuple(w)}
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def brute_components(docs, width=4):
    sets = {i: shingles(t, width) for i, t in docs if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates(odd, odd_rows, nothing):
    want = brute_components([(i, t) for i, t, _ in odd_rows])
    got = minhash.near_duplicates(odd, width=4).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert minhash.near_duplicates(nothing).count() == 0
    kept = minhash.deduplicated(odd, width=4)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_chain_of_near_copies(spark):
    """A bucket whose first centre is like none of the others still yields their links."""
    from tests.llm.conftest import made

    rng = random.Random(5)
    base = ["w%d" % rng.randrange(10**6) for _ in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = "e%d" % rng.randrange(10**6)
        rows.append((i, " ".join(copy), "en"))
    want = brute_components([(i, t) for i, t, _ in rows])
    got = minhash.near_duplicates(made(spark, rows), width=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}


def test_densified_bins_agree_as_sets_do():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8):
        a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        b = np.unique(np.append(a[: int(len(a) * share)], rng.integers(0, 2**63, 20).astype(np.uint64)))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = minhash.signatures([a, b])
        assert abs((s[0] == s[1]).mean() - true) < 0.12
    assert minhash.signatures([np.array([5], np.uint64)]).tolist() == [[5] * minhash.BINS]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (2, 1)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}


def brute_passages(docs, n):
    first = {}
    for i, t in sorted((i, t) for i, t in docs if i is not None):
        w = own_words(t)
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    out = {}
    for i, t in docs:
        w = own_words(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_passages(odd, odd_rows, nothing):
    want = brute_passages([(i, t or "") for i, t, _ in odd_rows], 50)
    got = substring.report(odd, 50).collect()
    assert len(got) == len(odd_rows)
    assert all(want[r["doc_id"]] == (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)
    assert sum(r["n_removed"] for r in got) > 300
    assert substring.report(nothing).count() == 0
    left = substring.deduplicated(odd, 50)
    assert left.columns == odd.columns
    texts = {i: t for i, t, _ in odd_rows}
    for r in left.collect():
        words = own_words(r["text"])
        assert len(words) == want[r["doc_id"]][0] - want[r["doc_id"]][1]
        assert hashlib.sha256(" ".join(words).encode()).hexdigest() == want[r["doc_id"]][2]
        if not want[r["doc_id"]][1]:
            assert r["text"] == texts[r["doc_id"]]
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


@pytest.mark.parametrize(("seed", "local"), [(1, 4096), (2, 4)])
def test_passages_of_few_words(spark, monkeypatch, seed, local):
    """A small vocabulary makes ties, periods and matches that branch everywhere; groups of more
    than ``local`` seeds go level by level."""
    from dropsieve.llm import repeats

    monkeypatch.setattr(repeats, "LOCAL", local)
    from tests.llm.conftest import made

    rng = random.Random(seed)
    rows = []
    for i in range(40):
        t = []
        while len(t) < rng.randint(5, 160):
            if t and rng.random() < 0.5:
                k = rng.randrange(len(t))
                t += t[k : k + rng.randint(1, 40)]
            elif rows and rng.random() < 0.7:
                other = rng.choice(rows)[1].split()
                k = rng.randrange(len(other))
                t += other[k : k + rng.randint(1, 60)]
            else:
                t += [rng.choice("ab")] * rng.randint(1, 25)
        rows.append((i, " ".join(t), "en"))
    want = brute_passages([(i, t) for i, t, _ in rows], 20)
    for r in substring.report(made(spark, rows), 20).collect():
        assert want[r["doc_id"]] == (r["n_words"], r["n_removed"], r["kept_sha256"])


def brute_bytes(docs, n):
    seen = Counter()
    for t in docs.values():
        b = (t or "").encode()
        seen.update(b[k : k + n] for k in range(len(b) - n + 1))
    out = {}
    for i, t in docs.items():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("local", [4096, 4])
def test_byte_strings(odd, odd_rows, nothing, monkeypatch, local):
    from dropsieve.llm import repeats

    monkeypatch.setattr(repeats, "LOCAL", local)
    docs = {i: t for i, t, _ in odd_rows if i is not None}
    want = brute_bytes(docs, 100)
    got = suffix.report(odd, 100).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            own = (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            assert own == want[r["doc_id"]]
    assert suffix.report(nothing).count() == 0


def test_lengths_are_checked():
    with pytest.raises(ValueError):
        substring.search(5)
    with pytest.raises(ValueError):
        suffix.search(20)
