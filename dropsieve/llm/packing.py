"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bulk-synchronous: pieces are range-sorted by length across the cluster and gaps by size. In each
superstep all pieces of one length, the longest first, meet the gaps: every piece takes the smallest
gap that holds it (its successor), rank decides who takes which of equal gaps, pieces that find none
open new sequences, gaps shrink, and the next superstep begins.

Pieces of equal length are alike, and so are gaps of equal size. So what a superstep decides is an
interval of ranks for an interval of sequences. The state of the sweep is a table by size, at most
``capacity`` sizes whatever the data; pieces are ranked, and learn their place, in distributed steps.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.cache import codec
from dropsieve.llm.common import arrow_map, drop, gather, parts, stored
from dropsieve.llm.pieces import PieceIds

_PARTITION = 33  # bits of monotonically_increasing_id() that count rows


def byte_signs() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary of a byte-level tokenizer."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def piece_encoder(path: str) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """Encodes pieces as the tokenizer file does.

    Where the file is plain byte-level BPE whose merges are in the order of their ids and whose
    tokens all encode to themselves, which is tested here, a rank encoder gives the same ids and is
    ten times as fast.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True

    def many(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum())), size

    def slow(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return many([p.decode("utf-8") for p in pieces])

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    signs = byte_signs()
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if (
        any(a >= b for a, b in zip([-1, *merged], merged))
        or not all(c in signs for t in vocab for c in t)
        or len(merged) + 256 != len(vocab)
    ):
        return slow
    ranks = {bytes(signs[c] for c in t): i for t, i in vocab.items()}
    whole = [t for t in ranks if _is_text(t)]
    flat, size = slow(whole)
    if (size != 1).any() or flat.tolist() != [ranks[t] for t in whole]:
        return slow
    import tiktoken

    one = tiktoken.Encoding(
        "pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}
    )._encode_single_piece

    def fast(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [one(p) for p in pieces]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum())), size

    return fast


def added_tokens(path: str) -> dict[bytes, int]:
    """The strings a tokenizer file takes as whole tokens wherever they stand in a text."""
    with open(path, encoding="utf-8") as f:
        return {t["content"].encode(): t["id"] for t in json.load(f).get("added_tokens", [])}


def text_ids(
    known: PieceIds, added: dict[bytes, int], buf: np.ndarray, off: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice and their ``n + 1`` offsets, added tokens taken out first."""
    find = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True))))
    raw = buf.tobytes()
    if not added or not find.search(raw):
        return known.slice_ids(buf, off)
    hits = [
        (m.start(), m.end(), added[m.group()])
        for a, b in zip(off[:-1].tolist(), off[1:].tolist())
        for m in find.finditer(raw, a, b)
    ]
    if not hits:
        return known.slice_ids(buf, off)
    start, end, token = (np.array(x, np.int64) for x in zip(*hits))
    edges = np.unique(np.concatenate([off, start, end]))
    ids, at = known.slice_ids(buf, edges)
    size, own = np.diff(at), np.searchsorted(edges, start)
    ids, size[own] = ids.copy(), 1
    ids[at[own]] = token
    up_to = np.concatenate([[0], np.cumsum(size)])
    return gather(ids, at[:-1], size), up_to[np.searchsorted(edges, off)]


def _is_text(token: bytes) -> bool:
    try:
        token.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """The pieces of every row: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is the ids of its whole text and ``end_id``, so a null or empty text is one token. As
    with the library, a text that holds the string of an added token is cut there and gets its id.
    Only documents longer than ``capacity`` are cut; their first piece is the short one. Repeated
    rows are pieces of their own. No shuffle; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(("packing", path), lambda: PieceIds(piece_encoder(path)))
        added = added_tokens(path)
        for b in batches:
            for i, j, buf, off in parts(b.column("text")):
                ids, at = text_ids(known, added, buf, off)
                row, piece, start, length, crc, own = [], [], [], [], [], []
                for k in range(j - i):
                    x = np.append(ids[at[k] : at[k + 1]], np.uint32(end_id)).astype("<u4")
                    first = len(x) % capacity or capacity
                    cuts = [0, *range(first, len(x) + 1, capacity)]
                    for p, (s, e) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i + k)
                        piece.append(p)
                        start.append(s)
                        length.append(e - s)
                        crc.append(zlib.crc32(x[s:e]))
                        if keep_ids:
                            own.append(x[s:e].astype(np.int32))
                cols = [
                    b.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(v, pa.int64()) for v in (start, length, crc)),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array(own, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return arrow_map(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        schema + (", ids array<int>" if keep_ids else ""),
        with_codec=True,
    )


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces of each length, as runs of ranks.

    A run (length, rank, count, first, each, offset): pieces of that length with ranks from ``rank``
    on go to the sequences from ``first`` on, ``each`` to a sequence, from ``offset`` there.
    """
    gaps: list[int] = []  # sizes with open sequences, ascending
    open_at: dict[int, deque[tuple[int, int]]] = {}  # size: runs (first sequence, count)
    sequences, runs = 0, []

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in open_at:
                open_at[gap] = deque()
                insort(gaps, gap)
            open_at[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                first, n = open_at[gap].popleft()
                if not open_at[gap]:
                    del open_at[gap], gaps[k]
            else:
                gap, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = gap // length
            full = min(n, left // each)
            rest = min(left - full * each, each) if full < n else 0
            placed = full * each + rest
            runs.append((length, rank, placed, first, each, capacity - gap))
            leave(gap - each * length, first, full)
            if rest:
                leave(gap - rest * length, first + full, 1)
            leave(gap, first + full + (rest > 0), n - full - (rest > 0))
            rank, left = rank + placed, left - placed
    return runs


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with sequence_id and offset; sequences are gapless from 0 and at most ``capacity``.

    Needs doc_id, piece and a length of 1 to ``capacity``; other columns are carried along. If
    ``pieces`` is a table that ``stored`` has written, it is deleted. To the
    driver go the row count of each sorted partition and of each length, never rows.
    """
    ranked = stored(
        pieces.repartitionByRange("length", "doc_id", "piece")
        .sortWithinPartitions("length", "doc_id", "piece")
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )
    drop(pieces)
    part = F.shiftright("_at", _PARTITION).alias("part")
    sizes = {r["part"]: r["count"] for r in ranked.groupBy(part).count().collect()}
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    begin = np.zeros(max(sizes, default=0) + 2, np.int64)
    for p, n in sizes.items():
        begin[p + 1] = n
    begin = np.cumsum(begin)
    shorter, n = {}, 0
    for length in sorted(counts):
        shorter[length] = n
        n += counts[length]
    runs = np.array(
        sorted((shorter[length] + rank, *more, length) for length, rank, *more in best_fit(counts, capacity)),
        np.int64,
    ).reshape(-1, 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column("_at").to_numpy(zero_copy_only=False)
            place = begin[at >> _PARTITION] + (at & ((1 << _PARTITION) - 1))
            r = runs[np.searchsorted(runs[:, 0], place, "right") - 1]
            i, each = place - r[:, 0], np.maximum(r[:, 3], 1)
            out = b.drop_columns(["_at"])
            out = out.append_column("sequence_id", pa.array(r[:, 2] + i // each))
            yield out.append_column("offset", pa.array(r[:, 4] + i % each * r[:, 5]))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return ranked.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of all documents and their places; see ``token_pieces`` and ``pack``."""
    return pack(stored(token_pieces(docs, path, capacity, end_id), "pieces"), capacity)
