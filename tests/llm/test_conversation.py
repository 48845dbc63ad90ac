"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dropsieve.llm import conversation as c

COLUMNS = "conv_id long, turn long, role string, text string"
FIELDS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
INK = re.compile("[^\x20\x09-\x0d]")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k:
            role = "user" if k == 4 else role
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    """Blank, duplicate and truncated rows, each row once."""
    out, seen = [], set()
    for role, text in rows:
        ink = INK.findall(text)
        out.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Cheapest (cost, audit, rows), by trying every edit; the roles so far are kept as a string."""
    flaws = faults(rows)

    @cache
    def best(i, roles, spare):
        found = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((0, "", ()))

        def put(initial, cost, letter, line, j, left):
            if re.fullmatch("s?(ua)*u?", roles + initial) and initial:
                if rest := best(j, roles + initial, left):
                    found.append((cost + rest[0], letter + rest[1], (line, *rest[2])))

        if i < len(rows):
            (role, text), flaw = rows[i], flaws[i]
            if rest := best(i + 1, roles, spare):
                found.append((3 + rest[0], "D" + rest[1], rest[2]))
            if flaw not in ("b", "d"):
                cut = 1 if flaw == "t" else 0
                put(role[:1], cut, "K", f"{role}:{text}", i + 1, spare)
                for new in ("user", "assistant"):
                    put(new[0], 2 + cut, "R", f"{new}:{text}", i + 1, spare)
        if spare:
            for new in ("user", "assistant"):
                put(new[0], 2, "I", f"{new}:", i, spare - 1)
        return min(found, key=lambda x: x[:2]) if found else None

    return best(0, "", len(rows) + 2)


def order(row):
    _, turn, role, text = row
    digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, digest)


def brute(rows):
    by = defaultdict(list)
    for r in brute_damage(rows):
        by[r[0]].append(r)
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(by[conv], key=order)
        turns = {t for _, t, _, _ in own if t is not None}
        pairs = [(r, t) for _, _, r, t in own]
        f = faults(pairs)
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, lines = brute_repair(pairs)
        out.append(
            (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(f.count(x) for x in "bdt"), bad, cost, audit)
            + (hashlib.sha256("\n".join(lines).encode()).hexdigest(),)
        )
    return sorted(out, key=repr)


def code_of(role, flaw):
    return {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) | {"b": c.BLANK, "d": c.DUPLICATE, "t": c.CUT, "": 0}[flaw]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x", ""]), st.sampled_from(["a.", "b", " ", "c!", "d?"])), max_size=7))
def test_cheapest_edits(rows):
    cost, audit, _ = brute_repair(tuple(rows))
    assert c.edits(bytes(code_of(r, f) for (r, _), f in zip(rows, faults(rows)))) == (cost, audit)


def test_checkpoints_change_nothing():
    rng = random.Random(3)
    codes = bytes(rng.choice([0, 1, 2, 3, 4, 9, 17, 18]) for _ in range(5000))
    vectors, shift = [c.END], []
    for x in reversed(codes):
        v, least = c.before(x, vectors[-1])
        vectors.append(v)
        shift.append(least)
    said, state = [], c.START
    for i, x in enumerate(codes):
        e, state = c.tight(x, vectors[len(codes) - 1 - i], state)
        said.append(e)
    cost, audit = c.edits(codes)
    assert audit.rstrip("I") == "".join(said).rstrip("I")
    assert cost == sum(shift) + vectors[-1][c.START]


def odd_turns():
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "Usr"], ["Yes.", "No", " \t", "", None, "a.b!\n", "é?\x85", "x" * 9]
    rows = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([0, 1, 2, 3, 5, 8, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(100, 7, "user", "Hi.")] * 5 + [(None, None, None, None)] * 2
    return rows


def test_query_rows(spark):
    rows = odd_turns()
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    df = df.withColumns({x: F.lit(1) for x in ("copies", "key", "code", "audit", "row", "first", "at", "conv")})
    got = sorted((tuple(r[f] for f in FIELDS) for r in c.repair(c.damaged(df), copies="copies").collect()), key=repr)
    assert got == brute(rows)
    none = spark.createDataFrame([], COLUMNS)
    assert c.repair(c.damaged(none), copies="copies").count() == 0
    assert c.repaired(none).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 1, "assistant", "Hi."), (1, 2, "user", ""), (2, 0, "user", " ")]
    rows += [(3, i, ("user", "assistant")[i % 2], f"line {i}.") for i in range(5000)] + [(3, 5000, "user", "é" * 3_000_000 + ".")]
    out = defaultdict(list)
    for r in c.repaired(spark.createDataFrame(rows, COLUMNS)).orderBy("conv_id", "pos").collect():
        out[r["conv_id"]].append((r["role"], r["text"]))
    assert out[1] == [("system", "Be kind."), ("user", ""), ("assistant", "Hi.")]
    assert 2 not in out
    assert len(out[3]) == 5002 and out[3][-1] == ("assistant", "") and len(out[3][-2][1]) == 3_000_001
