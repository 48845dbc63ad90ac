"""Personal data against plain regular expressions."""

import hashlib
import re
import sys

from hypothesis import given, settings
from hypothesis import strategies as st

from dropsieve.llm import pii

from .conftest import made

sys.set_int_max_str_digits(0)

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_check(kind, s):
    d = [int(c) for c in re.findall("[0-9]", s)]
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        total = 0
        for k, x in enumerate(reversed(d)):
            x = x * (1 + k % 2)
            total += x // 10 + x % 10
        return 14 <= len(d) <= 19 and total % 10 == 0
    if kind == "phone":
        return 10 <= len(d) <= 15
    if kind == "address":
        return not s.startswith("tel:") or 7 <= len(d) <= 15
    if kind == "account":
        return len(s.replace("-", "")) >= 8 and len(d) > 0
    if kind == "iban":
        z = s.replace(" ", "")
        return 15 <= len(z) <= 34 and int("".join(str(int(c, 36)) for c in z[4:] + z[:4])) % 97 == 1
    return True


def brute(text):
    low = text.translate(LOWER)
    out = [(m.start(), m.end(), k) for k, p in BASE.items() for m in re.finditer(p, text) if plain_check(k, m.group())]
    scheme = "|".join(f"(?:{s}{p})" for s, p in pii.SCHEMES.items())
    out += [(m.start(), m.end(), "address") for m in re.finditer(scheme, low) if plain_check("address", m.group())]
    for kind, cue, value in (("account", "|".join(pii.CUES), pii.ACCOUNT), ("iban", "iban", pii.IBAN)):
        for m in re.finditer(f"(?<![a-z0-9_-])(?:{cue}){value}", low):
            if plain_check(kind, m.group(1)):
                out.append((m.start(1), m.end(1), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


CASES = [
    "a@b.c@d.e x.y@z..com @a.b a@b a@b-.c- é.ü@x.de",
    "1.2.3.4.5.6.7.8 999.1.2.3.4 1.2.3 01.002.0003.255 1.2.3.256 " + "9" * 5000 + ".1.1.1",
    "4111 1111-1111 1111 4111111111111112 4111  1111 " + "0" * 19 + " " + "0" * 20 + " 4111111111111111é",
    "+1 (017) 555-7713 +1--2 +12345678901234567 + 1 ++49.30.1234567. +1()()()2",
    "MAILTO:Bob@localhost, sips:a@b.c tel:+49-30-12345 tel:1 https://u:p@h.org/x http://x/y@z ftp://@h",
    'Token = "04DBEBAB91" xtoken=abcdefg1 secret:password=abcd-efg1 api_key#x passport: 12345678 acct = abcdefgh',
    "IBAN: DE89 3704 0044 0532 0130 00, iban gb29 NWBK 6016 1331 9268 19 and iban DE88370400440532013000",
    "token=" * 50,
    "KKoken ſecret: abcdefgh1 İ a@b.cd",
]


def test_cases():
    for t in CASES:
        assert pii.find(t) == brute(t), t


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(list("a1.@+- 0(Z:=_é\n") + ["token", "tel:", "http://", "iban", "4111 1111 1111 1111", "1.2.3"]), max_size=40))
def test_any_text(bits):
    t = "".join(bits)
    assert pii.find(t) == brute(t)


def test_report(spark, odd, odd_rows, nothing):
    rows = [*odd_rows, *((200 + i, t, "en") for i, t in enumerate(CASES)), (300, "x +1 (017) 555-7713 " * 60_000, "en")]
    got = pii.report(made(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, t, _ in rows:
        s = brute(t or "")
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in s if k in BASE)
        counts = [sum(k == b for _, _, k in s) for b in BASE]
        want.append((i, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, b, k in s)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert pii.report(nothing).count() == 0


def test_redacted(spark):
    df = pii.redacted(made(spark, [(1, "call +1 (017) 555-7713 or mailto:a@b.de.", "en"), (2, None, None)]))
    assert [r["text"] for r in df.orderBy("doc_id").collect()] == ["call [PHONE] or [ADDRESS].", None]
    assert "score" in df.columns
