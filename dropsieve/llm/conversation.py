"""Repair of conversations by the cheapest edits that give their roles the order ``(s?(ua)+)?``.

Every row costs nothing to keep, 2 to give another role, 3 to delete; a missing row costs 2. Blank
and repeated rows must go, a truncated one that stays costs 1 more. Four states (nothing yet, after
the system's row, after a user's, after an assistant's) make this a shortest path: a backward pass
finds what the rest costs from each state, a forward pass emits the edits that are tight.

Of the backward pass only every ``isqrt(n)``-th vector is kept; a block's vectors are computed again
when the forward walk reaches it. A conversation of any length so takes one byte a row and two times
the root of its length in vectors. Its texts are never held: they stream past its finished edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import arrow_map

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# Codes of rows: role s 0, u 1, a 2, other 3, and flags.
ROLES = {"s": 0, "u": 1, "a": 2}
BLANK, DUPLICATE, CUT = 4, 8, 16
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # where a user's or assistant's row leads
END = (0, 2 * INSERT, INSERT, 0)  # what it takes to end properly

Vector = tuple[int, int, int, int]


@lru_cache(maxsize=1 << 16)
def before(code: int, after: Vector) -> tuple[Vector, int]:
    """Costs from each state before a row, given those after it: less their minimum, and that."""
    b = [DELETE + x for x in after]
    if not code & (BLANK | DUPLICATE):
        cut, role = (TRUNCATED if code & CUT else 0), code & 3
        for s in range(4):
            fits = role == (2 if s == USER else 1)
            b[s] = min(b[s], (KEEP if fits else REROLE) + cut + after[NEXT[s]])
        if role == 0:
            b[START] = min(b[START], KEEP + cut + after[SYSTEM])
    u, a = min(b[USER], INSERT + b[ASSISTANT]), min(b[ASSISTANT], INSERT + b[USER])
    b = [min(b[START], INSERT + u), min(b[SYSTEM], INSERT + u), u, a]
    least = min(b)
    return tuple(x - least for x in b), least


@lru_cache(maxsize=1 << 16)
def tight(code: int, after: Vector, state: int) -> tuple[str, int]:
    """The ASCII-least edits up to and with a row, and the state they lead to."""
    now, least = before(code, after)
    done = ""
    while True:
        here, to = now[state] + least, NEXT[state]
        if DELETE + after[state] == here:
            return done + "D", state
        if INSERT + now[to] + least == here:
            done, state = done + "I", to
            continue
        cut, role = (TRUNCATED if code & CUT else 0), code & 3
        if state == START and role == 0 and cut + after[SYSTEM] == here:
            return done + "K", SYSTEM
        fits = role == (2 if state == USER else 1)
        return done + ("K" if fits else "R"), to


def edits(codes: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least of the edits that reach it, for the codes of a conversation."""
    n = len(codes)
    block = isqrt(n) + 1
    marks, now, cost = {}, END, 0
    for i in range(n - 1, -1, -1):
        if (i + 1) % block == 0:
            marks[i + 1] = now
        now, least = before(codes[i], now)
        cost += least
    cost += now[START]
    out, state = [], START
    for first in range(0, n, block):
        last = min(first + block, n)
        vectors = [marks.get(last, END) if last < n else END]
        for i in range(last - 1, first, -1):
            vectors.append(before(codes[i], vectors[-1])[0])
        for i in range(first, last):
            said, state = tight(codes[i], vectors.pop(), state)
            out.append(said)
    while n and END[state]:
        out.append("I")
        state = NEXT[state]
    return cost, "".join(out)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` of every row, damaged by crc32 of its place modulo 20.

    Nulls of role and text become one space, and count as one in the place. 0 drops the row (its
    copies are 0), 1 empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes the role user.
    """
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    k = F.crc32(F.concat(place[0], F.lit(":"), place[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(k == 4, "user").otherwise(role).alias("role"),
        F.when(k == 1, "").when(k == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _keyed(turns: DataFrame, copies: str | None) -> DataFrame:
    """Rows with columns without nulls to sort and join by, and a digest of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    keyed = turns.select(
        F.col("conv_id").cast("long").isNotNull().alias("has_conv"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").isNotNull().alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("at"),
        role.alias("role"),
        text.alias("text"),
        (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("copies"),
    )
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return keyed.withColumn("key", digest)


def _code() -> Column:
    """Role, and whether the text is blank or ends without a mark, as a number."""
    text = F.rtrim(F.translate("text", "\t\n\v\f\r", "     "))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(text == "", BLANK).when(~F.substring(text, -1, 1).isin(".", "!", "?"), CUT)
    return (role + F.coalesce(fault, F.lit(0))).cast("int")


FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SORT = ("has_conv", "conv", "has_turn", "at", "key")


def _audited(keyed: DataFrame) -> DataFrame:
    """has_conv, conv, the counts and the edits of every conversation.

    Texts are left behind. Equal rows of one turn are counted before the shuffle; which row of equal
    ones is the first comes from a minimum and a join on the whole key, so no text that is common in
    a conversation is a group of its own. The ordered codes of one conversation stream into one
    string, as the result demands.
    """
    place = ("has_conv", "conv", "has_turn", "at", "key")
    rows = (
        keyed.select(*place, _code().alias("code"), "copies")
        .groupBy(*place)
        .agg(F.max("code").alias("code"), F.sum("copies").alias("copies"))
    )
    first = (
        rows.where("copies > 0")
        .groupBy("has_conv", "conv", "key")
        .agg(F.min(F.struct("has_turn", "at")).alias("m"))
        .select("has_conv", "conv", "m.*", "key", F.lit(True).alias("first"))
    )
    placed = rows.join(first, list(place), "left").repartition("has_conv", "conv").sortWithinPartitions(*_SORT)
    keep = ("has_conv", "conv", "has_turn", "at", "code", "copies", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for b in batches:
            done = []
            for row in zip(*(b.column(c).to_pylist() for c in keep), strict=True):
                if seen is None or seen.key != row[:2]:
                    if seen is not None:
                        done.append(seen.result())
                    seen = _Facts(row[:2])
                seen.add(*row[2:])
            yield from _batch(done)
        if seen is not None:
            yield from _batch([seen.result()])

    return arrow_map(placed.select(*keep), run, f"has_conv boolean, conv long, {FACTS}", batch_rows=10_000)


_FACT_TYPES = pa.schema(
    [("has_conv", pa.bool_()), ("conv", pa.int64())]
    + [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in FACTS.split(", ")]
)


def _batch(done: list[tuple]) -> Iterator[pa.RecordBatch]:
    if done:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done, strict=True), _FACT_TYPES.types, strict=True)],
            schema=_FACT_TYPES,
        )


class _Facts:
    """What is known of a conversation while its rows stream past, in order."""

    def __init__(self, key: tuple[bool, int]) -> None:
        self.key, self.codes, self.turns = key, bytearray(), None

    def add(self, has_turn: bool, at: int, code: int, copies: int, first: bool | None) -> None:
        if not copies:
            return
        if has_turn:
            low, last, n = self.turns or (at, None, 0)
            self.turns = low, at, n + (at != last)
        again = code if code & BLANK else code & 3 | DUPLICATE
        self.codes += bytes([code if first else again])
        self.codes += bytes([again]) * (copies - 1)

    def result(self) -> tuple:
        low, high, n = self.turns or (0, -1, 0)
        x = np.frombuffer(self.codes, np.uint8)
        role = x & 3
        pair = role[:-1] * 4 + role[1:]
        legal = np.isin(pair, (ROLES["s"] * 4 + 1, ROLES["u"] * 4 + 2, ROLES["a"] * 4 + 1))
        faults = [int((x & f > 0).sum()) for f in (BLANK, DUPLICATE, CUT)]
        return (*self.key, high - low + 1 - n, *faults, int((~legal).sum()), *edits(bytes(self.codes)))


def _streamed(turns: DataFrame, copies: str | None, make: type, schema: str) -> DataFrame:
    """Every conversation's rows, in order, after its edits: ``make`` takes them one by one."""
    keyed = _keyed(turns, copies)
    facts = [c.split()[0] for c in FACTS.split(", ")]
    names = ("has_conv", "conv", *facts, "role", "text", "copies")
    audits = _audited(keyed).select("*", F.lit(False).alias("row"))
    rows = keyed.where("copies > 0").withColumn("row", F.lit(True))
    both = (
        audits.unionByName(rows, allowMissingColumns=True)
        .repartition("has_conv", "conv")
        .sortWithinPartitions("has_conv", "conv", "row", "has_turn", "at", "key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            out = make.table()
            cols = {c: b.column(c) for c in names}
            for i in range(b.num_rows):
                row = {c: cols[c][i].as_py() for c in names}
                if row["audit"] is not None:
                    if now is not None:
                        now.close(out)
                    now = make(row)
                    continue
                for _ in range(row["copies"]):
                    now.take(row["role"], row["text"], out)
            yield from make.batches(out)
        if now is not None:
            out = make.table()
            now.close(out)
            yield from make.batches(out)

    return arrow_map(both.select(*names), run, schema)


class _Walk:
    """Follows the edits of a conversation along its rows."""

    FIELDS: pa.Schema

    def __init__(self, facts: dict) -> None:
        self.facts, self.at, self.state = facts, 0, START

    @classmethod
    def table(cls) -> list:
        return []

    @classmethod
    def batches(cls, rows: list) -> Iterator[pa.RecordBatch]:
        if rows:
            cols = zip(zip(*rows, strict=True), cls.FIELDS.types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], schema=cls.FIELDS)

    def said(self) -> str:
        return self.facts["audit"][self.at : self.at + 1]

    def _next(self) -> str:
        self.at += 1
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def inserts(self, out: list) -> None:
        while self.said() == "I":
            self.emit(self._next(), "", out)

    def take(self, role: str, text: str, out: list) -> None:
        self.inserts(out)
        edit = self.said()
        if edit == "D":
            self.at += 1
        elif edit == "R":
            self.emit(self._next(), text, out)
        elif self.state == START and role[:1] == "s":
            self.at, self.state = self.at + 1, SYSTEM
            self.emit(role, text, out)
        else:
            self._next()
            self.emit(role, text, out)

    def close(self, out: list) -> None:
        self.inserts(out)

    def emit(self, role: str, text: str, out: list) -> None:
        raise NotImplementedError


class _Digest(_Walk):
    FIELDS = pa.schema([*_FACT_TYPES, ("repaired_sha256", pa.string())])

    def __init__(self, facts: dict) -> None:
        super().__init__(facts)
        self.hash, self.any = hashlib.sha256(), False

    def emit(self, role: str, text: str, out: list) -> None:
        self.hash.update(("\n" * self.any + f"{role}:{text}").encode())
        self.any = True

    def close(self, out: list) -> None:
        super().close(out)
        out.append((*(self.facts[c] for c in _FACT_TYPES.names), self.hash.hexdigest()))


class _Rows(_Walk):
    FIELDS = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def __init__(self, facts: dict) -> None:
        super().__init__(facts)
        self.n = 0

    def emit(self, role: str, text: str, out: list) -> None:
        out.append((self.facts["conv"] if self.facts["has_conv"] else None, self.n, role, text))
        self.n += 1


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """Per conversation: its gaps and faults, the cheapest edits and a digest of the repaired rows.

    Rows go by turn, nulls first, equal turns by the digest of role and text; null roles and texts
    count as one space, rows of a null conv_id as one conversation. Repeated rows are all there but
    for the first duplicates. ``copies`` names a column that says how often a row stands there; a
    conversation whose rows all stand there 0 times has zeros, no edits and the digest of an empty
    text. Columns other than these are not read; an empty table gives no rows.
    """
    schema = f"has_conv boolean, conv long, {FACTS}, repaired_sha256 string"
    made = _streamed(turns, copies, _Digest, schema)
    return made.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), *made.columns[2:])


def repaired(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired conversations: conv_id, pos (from 0), role and text of every row."""
    return _streamed(turns, copies, _Rows, "conv_id long, pos long, role string, text string")
