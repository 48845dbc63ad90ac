"""Texts split by the tokenizers' pattern, vectorised, and ids of pieces from a bounded cache."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa

from dropsieve.llm.cache import kept
from dropsieve.llm.common import byte_prefix, gather, parts, span_hash

# The code points that \s matches in the pattern.
_WHITE = (
    *range(0x9, 0xE),
    0x20,
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
SPACE, WHITE, LETTER, NUMBER, OTHER = range(5)


def char_classes() -> np.ndarray:
    """The class of every code point."""
    if "classes" not in kept():
        t = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind == "L":
                t[c] = LETTER
            elif kind == "N":
                t[c] = NUMBER
        t[list(_WHITE)] = WHITE
        t[0x20] = SPACE
        kept()["classes"] = t
    return kept()["classes"]


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the place of each."""
    lead = (buf & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    b = buf[at].astype(np.int32)
    if not (b >= 0x80).any():
        return b, at
    cp = b.copy()
    padded = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int32)
    for low, high, keep, n in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 7, 3)):
        k = np.flatnonzero((b >= low) & (b < high))
        v = b[k] & keep
        for j in range(1, n + 1):
            v = (v << 6) | (padded[at[k] + j] & 0x3F)
        cp[k] = v
    return cp, at


def split(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pattern's matches start.

    Runs of letters, numbers or other signs are a match each, with one blank before them if there
    is one. White space before a match gives up its last character, and is one match at a text's
    end. An apostrophe that stands alone takes the letters of an English ending with it.
    """
    if not len(buf):
        return np.zeros(0, np.int64)
    cp, at = code_points(buf)
    kind = char_classes()[np.minimum(cp, 0x10FFFF)]
    n = len(cp)
    opens = np.zeros(n + 1, bool)
    opens[np.searchsorted(at, off)] = True  # texts' first characters; the end counts as one
    run = np.where(kind == SPACE, WHITE, kind)
    new = opens[:-1].copy()
    new[1:] |= run[1:] != run[:-1]
    start = new.copy()
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], n)
    white = run[begin] == WHITE
    # White space with a match after it in the same text: its last character starts anew.
    start[end[white & ~opens[end]] - 1] = True
    # A run after a blank starts at the blank.
    inner = begin[~white & ~opens[begin]]
    start[inner[kind[inner - 1] == SPACE]] = False
    # 's 't 'm 'd 're 've 'll (fixed values)
    q = begin[(end - begin == 1) & (cp[begin] == 0x27) & ~opens[end]]
    q = q[opens[q] | (kind[q - 1] != SPACE)]
    if len(q):
        c = np.concatenate([cp, np.zeros(3, cp.dtype)])
        a, b = c[q + 1], c[q + 2]
        two = ~np.append(opens, [True, True])[q + 2]
        one = np.isin(a, [ord(x) for x in "stmd"])
        pair = np.zeros(len(q), bool)
        for x, y in ("re", "ve", "ll"):
            pair |= (a == ord(x)) & (b == ord(y)) & two
        size = np.where(one, 1, np.where(pair, 2, 0))
        q, size = q[size > 0], size[size > 0]
        start[q + 1] = False
        nxt = q + 1 + size
        more = (nxt < n) & ~opens[nxt]
        nxt = nxt[more]
        # Letters that go on after the ending are a match of their own.
        nxt = nxt[run[nxt] == LETTER]
        start[nxt] = True
    return at[start]


class PieceIds:
    """Ids of the pieces of a slice; new pieces are encoded once and kept while there is room.

    ``encode`` takes pieces and returns their ids one after the other and the number of each. What
    is kept is a hint only: when ``room`` pieces are held, all are dropped and met anew.
    """

    def __init__(
        self,
        encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
        room: int = 150_000,
    ):
        self.encode, self.room = encode, room
        self._drop()

    def _drop(self) -> None:
        self.row: dict[int, int] = {}
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.flat, self.filled = np.zeros(1 << 16, np.uint32), 0

    def _add(self, keys: list[int], flat: np.ndarray, size: np.ndarray) -> None:
        n = len(self.row)
        while len(self.start) < n + len(keys):
            self.start, self.size = (np.concatenate([x, x]) for x in (self.start, self.size))
        while len(self.flat) < self.filled + len(flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.start[n : n + len(keys)] = self.filled + np.cumsum(size) - size
        self.size[n : n + len(keys)] = size
        self.flat[self.filled : self.filled + len(flat)] = flat
        self.filled += len(flat)
        self.row.update(zip(keys, range(n, n + len(keys))))

    def slice_ids(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice and their ``n + 1`` offsets."""
        start = split(buf, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        end = np.append(start[1:], len(buf))
        codes, uniq = pd.factorize(span_hash(byte_prefix(buf), start, end))
        keys = uniq.tolist()
        rows = np.fromiter(map(self.row.get, keys, repeat(-1)), np.int64, len(keys))
        if len(self.row) + np.count_nonzero(rows < 0) > self.room:
            self._drop()
            rows[:] = -1
        new = np.flatnonzero(rows < 0)
        if len(new):
            first = np.empty(len(uniq), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            at = first[new]
            raw = buf.tobytes()
            rows[new] = len(self.row) + np.arange(len(new))
            got = self.encode([raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())])
            self._add([keys[i] for i in new.tolist()], *got)
        row = rows[codes]
        each = self.size[row]
        up_to = np.concatenate([[0], np.cumsum(each)])
        return gather(self.flat, self.start[row], each), up_to[np.searchsorted(start, off)]

    def column(self, col: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of a column, one array each."""
        for _, _, buf, off in parts(col):
            ids, at = self.slice_ids(buf, off)
            for i in range(len(off) - 1):
                yield ids[at[i] : at[i + 1]]
