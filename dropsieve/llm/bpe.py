"""Byte-level BPE with a rank queue on a hierarchical bitmap.

Pieces are linked lists of their bytes, many pieces at once in one list: no link crosses from a
piece to the next. Every adjacent pair that has a merge rank waits by its position in the bucket of
that rank. Which buckets hold something is noted in bitmaps of three levels, each bit of a level
standing for one word below, so that find-first-set gives the next rank in three steps however long
the pieces are. Entries whose pair has changed meanwhile are skipped when they come up.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.cache import codec
from dropsieve.llm.common import arrow_map, gather, hex_column, parts, per_text
from dropsieve.llm.pieces import PieceIds

_BITS = 64


class RankQueue:
    """Buckets of positions by rank, the lowest rank first."""

    def __init__(self, ranks: int):
        self.levels = []
        n = max(1, ranks)
        while True:
            n = -(-n // _BITS)
            self.levels.append([0] * n)
            if n == 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def add(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        for level in self.levels:
            word, bit = divmod(rank, _BITS)
            before = level[word]
            level[word] = before | (1 << bit)
            if before:
                return
            rank = word

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its positions in ascending order."""
        word = 0
        for level in reversed(self.levels):
            bits = level[word]
            if not bits:
                return None
            word = word * _BITS + (bits & -bits).bit_length() - 1
        rank = word
        for level in self.levels:
            word, bit = divmod(word, _BITS)
            level[word] &= ~(1 << bit)
            if level[word]:
                break
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Encoder:
    """Ids of pieces by the ranks of a vocabulary; ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.queue = RankQueue(max(self.token, default=0) + 1)
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.byte_pair = np.array(
            [[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64
        )
        self.pairs: dict[tuple[int, int], int] = {}

    def encode(self, piece: bytes) -> list[int]:
        return self.encode_many([piece])[0].tolist()

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' ids one after the other, and the number of ids of each.

        A piece that is a token itself is that token; in all others the pair of lowest rank, and
        of these the leftmost, is merged until none has a rank.
        """
        buf = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        off = np.concatenate([[0], np.cumsum(size)])
        n = len(buf)
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        start_ids = self.byte_id[buf]
        if (start_ids < 0).any():
            raise ValueError("a byte has no token in this vocabulary")
        alone = np.flatnonzero((whole >= 0) & (size > 0))
        start_ids[off[alone]] = whole[alone]
        alive = np.ones(n, bool)
        alive[np.repeat(whole >= 0, size)] = False
        alive[off[alone]] = True

        rank = np.full(n, -1, np.int64)
        if n > 1:
            rank[:-1] = self.byte_pair[buf[:-1], buf[1:]]
        filled = size > 0
        rank[off[1:][filled] - 1] = -1
        rank[~alive] = -1
        rank[off[alone]] = -1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[off[1:][filled] - 1] = -1
        before[off[:-1][filled]] = -1
        ids, removed = self._merge(
            start_ids.tolist(), rank, after.tolist(), before.tolist()
        )
        alive[removed] = False
        return np.array(ids, np.uint32)[alive], per_text(alive, off)

    def _merge(
        self, ids: list[int], rank: np.ndarray, after: list[int], before: list[int]
    ) -> tuple[list[int], list[int]]:
        queue, pairs, ranks, token = self.queue, self.pairs, self.ranks, self.token
        waiting = np.flatnonzero(rank >= 0)
        waiting = waiting[np.argsort(rank[waiting], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank[waiting])) + 1
        for group in np.split(waiting, cuts) if len(waiting) else ():
            queue.add(int(rank[group[0]]), group.tolist())
        rank_at, removed = rank.tolist(), []
        buckets, add = queue.buckets, queue.add
        if len(pairs) > 400_000:
            pairs.clear()

        def meet(left: int, right: int, place: int) -> int:
            """Notes the pair that now starts at ``place``; its rank, -1 if it has none."""
            pair = (left, right)
            q = pairs.get(pair)
            if q is None:
                q = pairs[pair] = ranks.get(token[left] + token[right], -1)
            rank_at[place] = q
            if q >= 0:
                bucket = buckets.get(q)
                if bucket is None:
                    add(q, [place])
                else:
                    bucket.append(place)
            return q

        while (head := queue.pop()) is not None:
            r, bucket = head
            for done, i in enumerate(bucket, 1):
                if rank_at[i] != r:
                    continue
                j = after[i]
                k = after[j]
                ids[i] = r
                rank_at[i] = rank_at[j] = -1
                removed.append(j)
                after[i] = k
                lowest = r
                if k >= 0:
                    before[k] = i
                    q = meet(r, ids[k], i)
                    if 0 <= q < lowest:
                        lowest = q
                h = before[i]
                if h >= 0:
                    q = meet(ids[h], r, h)
                    if 0 <= q < lowest:
                        lowest = q
                if lowest < r and done < len(bucket):
                    # A lower rank has come up: it goes first, the rest waits again.
                    add(r, bucket[done:])
                    break
        return ids, removed


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in f if x.strip())}


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks.items(), key=lambda x: x[1])
        self.size = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for t, r in tokens:
            self.size[r] = len(t)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.start[ids], self.size[ids])


def _codec(path: str) -> tuple[PieceIds, Decoder]:
    """Of a Python worker: it outlives tasks, and so do the pieces it knows."""

    def made() -> tuple[PieceIds, Decoder]:
        ranks = read_ranks(path)
        return PieceIds(Encoder(ranks).encode_many, room=500_000), Decoder(ranks)

    return codec(("bpe", path), made)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` of every row's whole text; a null or empty text has no ids.

    Repeated rows are encoded each; other columns are not read. No shuffle. ``path`` names the rank
    file on the machines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _ = _codec(path)
        for b in batches:
            for i, j, buf, off in parts(b.column("text")):
                ids, at = pieces.slice_ids(buf, off)
                col = pa.ListArray.from_arrays(
                    pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), col], ["doc_id", "ids"]
                )

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>", with_codec=True)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``bytes`` of every row's ids; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, back = _codec(path)
        for b in batches:
            rows = (back.decode(np.array(x or [], np.int64)).tobytes() for x in b["ids"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "bytes"]
            )

    return arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, bytes binary", with_codec=True)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row: number of ids, digest of the ids, digest of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, back = _codec(path)
        for b in batches:
            count, of_ids, of_bytes = [], [], []
            for _, _, buf, off in parts(b.column("text")):
                ids, at = pieces.slice_ids(buf, off)
                text = back.decode(ids)
                ends = np.concatenate([[0], np.cumsum(back.size[ids])])[at]
                raw = ids.astype("<u4")
                for i in range(len(off) - 1):
                    count.append(int(at[i + 1] - at[i]))
                    of_ids.append(hashlib.sha256(raw[at[i] : at[i + 1]]).hexdigest())
                    of_bytes.append(hashlib.sha256(text[ends[i] : ends[i + 1]]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(count, pa.int64()),
                    hex_column(of_ids),
                    hex_column(of_bytes),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return arrow_map(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        with_codec=True,
    )
