"""Personal data by anchor expansion.

One Aho-Corasick automaton looks for anchors in the lower-cased text: at-signs, plus signs, digits,
address schemes and identifier cues. A parser per anchor grows the span around it to both sides and
checks it (octets, digit counts, Luhn, modulo 97). Only the surroundings of anchors are read closely,
and no span is looked at twice, so the work is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.cache import kept
from dropsieve.llm.common import arrow_map

# Kinds in the order of equal starts; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account", "iban")

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_-")
DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# What follows a scheme or a cue, in lower case.
HOST = r"[a-z0-9-]+(?:\.[a-z0-9-]+)*"
MAILBOX = rf"[a-z0-9._%+-]+@{HOST}"
DIALLED = r"\+?[0-9][().0-9-]*[0-9]"
LOGIN = rf'[^\x00-\x20/@"<>]+@{HOST}'
SCHEMES = {
    "mailto:": MAILBOX,
    "xmpp:": MAILBOX,
    "sip:": MAILBOX,
    "sips:": MAILBOX,
    "tel:": DIALLED,
    "http://": LOGIN,
    "https://": LOGIN,
    "ftp://": LOGIN,
}
CUES = ("account", "acct", "passport", "token", "secret", "password", "passwd", "api_key", "apikey")
ACCOUNT = r"""[\x20]*[=:#][\x20]*["']?([a-z0-9]+(?:-[a-z0-9]+)*)"""
# Country, check digits, a bank code of up to four letters, digits.
IBAN = r"[\x20]*[=:#]?[\x20]*([a-z][a-z][0-9][0-9](?:[\x20]?[a-z]{1,4})?(?:[\x20]?[0-9])+)"

SPANS = "array<struct<kind:string,start:long,end:long>>"


def digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def luhn(d: list[int]) -> bool:
    doubled = [x * 2 - 9 * (x > 4) for x in d[-2::-2]]
    return (sum(d[-1::-2]) + sum(doubled)) % 10 == 0


def is_card(s: str) -> bool:
    d = digits(s)
    return 14 <= len(d) <= 19 and luhn(d)


def is_ip(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s.split("."))


def is_phone(s: str) -> bool:
    return 10 <= len(digits(s)) <= 15


def is_address(s: str) -> bool:
    return not s.startswith("tel:") or 7 <= len(digits(s)) <= 15


def is_account(s: str) -> bool:
    return len(s.replace("-", "")) >= 8 and bool(digits(s))


def is_iban(s: str) -> bool:
    x = s.replace(" ", "")
    if not 15 <= len(x) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def _tools() -> tuple:
    """The automaton and the parsers' patterns, made once per worker."""
    have = kept().get("pii")
    if have is None:
        import ahocorasick

        auto = ahocorasick.Automaton()
        anchors = [("@", "@"), ("+", "+"), *((d, "0") for d in "0123456789")]
        anchors += [(s, "address") for s in SCHEMES] + [(c, "account") for c in CUES] + [("iban", "iban")]
        for word, kind in anchors:
            auto.add_word(word, (kind, word))
        auto.make_automaton()
        at = {k: re.compile(p).match for k, p in (("domain", DOMAIN), ("ip", IP), ("card", CARD), ("phone", PHONE))}
        at |= {s: re.compile(p).match for s, p in SCHEMES.items()}
        at |= {"account": re.compile(ACCOUNT).match, "iban": re.compile(IBAN).match, "run": re.compile("[0-9]+").match}
        have = kept()["pii"] = auto, at
    return have


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in code points, by start and then in the order of ``KINDS``.

    Per kind spans are the leftmost ones that do not overlap; one that fails its check is dropped
    and nothing inside it is tried again.
    """
    auto, at = _tools()
    low = text.encode().lower().decode()  # A-Z only, so that places stay
    done = dict.fromkeys(KINDS, 0)
    out = []

    def take(kind: str, start: int, end: int, valid: bool) -> None:
        done[kind] = end
        if valid:
            out.append((start, end, kind))

    for last, (kind, word) in auto.iter(low):
        i = last + 1 - len(word)
        if kind == "0":
            if i >= done["card"]:
                m = at["card"](text, i)
                take("card", i, m.end() if m else i + 1, bool(m) and is_card(m.group()))
            if i >= done["ip"]:
                m = at["ip"](text, i)
                end = m.end() if m else at["run"](text, i).end()
                take("ip", i, end, bool(m) and is_ip(m.group()))
        elif kind == "@":
            start = i
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            m = at["domain"](text, i + 1) if start < i else None
            if m:
                take("email", start, m.end(), True)
        elif kind == "+":
            if m := at["phone"](text, i):
                take("phone", i, m.end(), is_phone(m.group()))
        elif kind == "address":
            if i >= done[kind] and (m := at[word](low, last + 1)):
                take(kind, i, m.end(), is_address(low[i : m.end()]))
        elif i >= done[kind] and not (i and low[i - 1] in WORD):
            if m := at[kind](low, last + 1):
                check = is_account if kind == "account" else is_iban
                take(kind, m.start(1), m.end(1), check(m.group(1)))
    order = {k: n for n, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[0], order[s[2]]))


def _span_column(found: list[list[tuple[int, int, str]]]) -> pa.Array:
    ends = [0]
    for f in found:
        ends.append(ends[-1] + len(f))
    flat = [s for f in found for s in f]
    items = pa.StructArray.from_arrays(
        [
            pa.array([k for _, _, k in flat], pa.string()),
            pa.array([s for s, _, _ in flat], pa.int64()),
            pa.array([e for _, e, _ in flat], pa.int64()),
        ],
        ["kind", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)


def spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans``, an array of (kind, start, end) in code points.

    A null or empty text has none. Repeated rows are searched each; a text's length bounds the
    memory of a task; columns other than doc_id and text are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _span_column(found)], ["doc_id", "spans"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, spans {SPANS}")


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, every span replaced by its kind in brackets; overlapping ones as one.

    A replaced run takes the name of its first span. A null text stays null.
    """
    at = docs.columns.index("text")

    def masked(text: str) -> str:
        out, end = [], 0
        for start, stop, kind in find(text):
            if start >= end:
                out += [text[end:start], f"[{kind.upper()}]"]
            end = max(end, stop)
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [None if (t := x.as_py()) is None else masked(t) for x in b.column("text")]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return arrow_map(docs, run, docs.schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans as text."""
    s = F.col("spans")
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(s, lambda x: x["kind"].isin(*BASE))
    return spans(docs).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(s).alias("spans"),
    )
