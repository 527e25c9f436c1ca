"""Byte-level BPE with a two-tier lookup.

Whole pre-tokens that are in the vocabulary are resolved by a minimal perfect
hash. The others are merged: their bytes are a linked list, and a heap holds the
adjacent pairs that form a token, lowest rank and leftmost first.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.llm.shipping import by_value
from shelfwise.llm.tables import fresh

by_value(__name__)

_WORD = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15

#: Pre-tokens of a generation of a task's memory, and their greatest length.
MEMO_ENTRIES, MEMO_BYTES = 300_000, 64

#: Bits of a place in a pre-token, below the rank in the number that names a pair.
PLACE_BITS = 32

#: Characters of the texts whose ids and bytes are handed on together.
SLICE_CHARS = 4_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash(NamedTuple):
    """Minimal perfect hash of the vocabulary: one slot per token, each checked.

    ``shift[bucket]`` is the displacement that sends the tokens of a bucket to
    free slots; for a bucket of one token it is the slot itself, as ``-1 - slot``.
    """

    shift: list[int]
    keys: list[bytes]
    ranks: list[int]

    def rank(self, token: bytes) -> int:
        """Rank of ``token``, -1 if it is not in the vocabulary."""
        h = xxhash.xxh3_64_intdigest(token)
        d = self.shift[h % len(self.shift)]
        slot = -1 - d if d < 0 else _slot(h, d, len(self.keys))
        return self.ranks[slot] if self.keys[slot] == token else -1


def _slot(h: int, d: int, n: int) -> int:
    x = (h ^ (d * _STEP & _WORD)) & _WORD
    x = (x ^ (x >> 32)) * _STEP & _WORD
    return (x >> 17) % n


def perfect_hash(ranks: dict[bytes, int]) -> PerfectHash:
    """Hash and displace: large buckets first, each with the first displacement
    that sends its tokens to distinct free slots."""
    tokens = list(ranks)
    n, n_buckets = len(tokens), max(1, len(tokens) // 4)
    buckets: list[list[int]] = [[] for _ in range(n_buckets)]
    hashes = [xxhash.xxh3_64_intdigest(t) for t in tokens]
    for i, h in enumerate(hashes):
        buckets[h % n_buckets].append(i)
    shift, owner = [0] * n_buckets, np.full(n, -1)
    for b in sorted(range(n_buckets), key=lambda b: -len(buckets[b])):
        members = buckets[b]
        if len(members) < 2:
            break
        own, d = np.array([hashes[i] for i in members], np.uint64), 0
        while True:
            tries = np.arange(d, d + 256, dtype=np.uint64)
            x = own[None, :] ^ (tries * np.uint64(_STEP))[:, None]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(_STEP)
            slots = ((x >> np.uint64(17)) % np.uint64(n)).astype(np.int64)
            ordered = np.sort(slots, axis=1)
            good = (owner[slots] < 0).all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                shift[b], owner[slots[k]] = d + k, members
                break
            d += 256
    free = iter(np.flatnonzero(owner < 0).tolist())
    for b, members in enumerate(buckets):
        if len(members) == 1:
            slot = next(free)
            shift[b], owner[slot] = -1 - slot, members[0]
    keys = [tokens[i] for i in owner.tolist()]
    return PerfectHash(shift, keys, [ranks[k] for k in keys])


class Memo(dict):
    """Values of ``make``, in two generations of at most ``entries`` keys: when the
    young one is full it becomes the old one, and what is used again comes back."""

    def __init__(self, entries: int | None = None):
        super().__init__()
        self.entries, self.old = entries or MEMO_ENTRIES, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= MEMO_BYTES:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Merger:
    """Token ids of pre-tokens that are no tokens themselves, as little-endian 32-bit integers.

    Parts are named by their first byte; ``stop`` is where a part ends and the next
    begins, ``before`` where the previous one begins. A pair that forms a token is one
    number, its rank above the place of its left part. The heap holds such numbers;
    ``pair`` has the one of today for each place, so a number that differs from it is
    out of date. Ranks of the many short parts are asked for in plain tables.
    """

    def __init__(self, ranks: dict[bytes, int], packed: list[bytes]):
        self.packed = packed
        self.raised = {token: rank << PLACE_BITS for token, rank in ranks.items()}
        self.first = {token: key for token, key in self.raised.items() if len(token) == 2}
        self.single = {token[0]: packed[rank] for token, rank in ranks.items() if len(token) == 1}

    def merge(self, piece: bytes) -> bytes:
        n, packed, raised = len(piece), self.packed, self.raised.get
        mask, pop, push, first = (1 << PLACE_BITS) - 1, heapq.heappop, heapq.heappush, self.first.get
        stop, before = list(range(1, n + 1)), list(range(-1, n))
        out = list(map(self.single.__getitem__, piece))
        pair = [first(piece[start : start + 2], -1) | start for start in range(n - 1)]
        heap = [key for key in pair if key >= 0]
        heapq.heapify(heap)
        pair.append(-1)
        while heap:
            key = pop(heap)
            start = key & mask
            if pair[start] != key:
                continue
            right = stop[start]
            stop[start] = end = stop[right]
            out[start], out[right] = packed[key >> PLACE_BITS], b""
            pair[start] = pair[right] = -1
            if end < n:
                before[end] = start
                key = raised(piece[start : stop[end]])
                if key is not None:
                    pair[start] = key = key | start
                    push(heap, key)
            if start:
                left = before[start]
                key = raised(piece[left:end])
                if key is None:
                    pair[left] = -1
                else:
                    pair[left] = key = key | left
                    push(heap, key)
        return b"".join(out)


class Encoder(Memo):
    """Ids of pre-tokens, as little-endian 32-bit integers.

    The perfect hash answers for whole pre-tokens, the heap for the others. A text is
    split as a whole, so one memory, of pre-tokens, is all that a task keeps.
    """

    def __init__(self, table: PerfectHash, pattern: str, entries: int | None = None):
        super().__init__(entries)
        self.rank, self.split = table.rank, regex.compile(pattern).findall
        self.packed = [b""] * (max(table.ranks, default=-1) + 1)
        for rank in table.ranks:
            self.packed[rank] = rank.to_bytes(4, "little")
        self.merge = Merger(dict(zip(table.keys, table.ranks, strict=True)), self.packed).merge

    def make(self, word: str) -> bytes:
        piece = word.encode()
        rank = self.rank(piece)
        return self.packed[rank] if rank >= 0 else self.merge(piece)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))


def tokenize(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    memo: int | None = None,
) -> DataFrame:
    """All columns of ``docs`` with the token ids, packed as little-endian
    unsigned 32-bit integers, and the bytes that they decode to.

    Null counts as an empty text, which has no tokens. Each match of ``pattern``
    is encoded separately; there are no special tokens. The tables that go to the
    executors are as large as the vocabulary. ``ids`` and ``decoded`` replace
    columns of that name, in any case. Rows are independent of one another. ``memo``,
    else ``MEMO_ENTRIES``, bounds what a task remembers and changes no result.
    """
    table = docs.sparkSession.sparkContext.broadcast(tuple(perfect_hash(ranks)))

    @F.pandas_udf(f"{ids} binary, {decoded} binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashed = PerfectHash(*table.value)
        encoder = Encoder(hashed, pattern, memo)
        by_rank = [b""] * (max(hashed.ranks, default=-1) + 1)
        for key, rank in zip(hashed.keys, hashed.ranks, strict=True):
            by_rank[rank] = key
        for texts in batches:
            packed, plain, held = [], [], 0
            for value in texts:
                data = encoder.encode(value) if value else b""
                packed.append(data)
                plain.append(b"".join(map(by_rank.__getitem__, np.frombuffer(data, "<u4").tolist())))
                held += len(value or "")
                if held > SLICE_CHARS:
                    yield pd.DataFrame({ids: packed, decoded: plain})
                    packed, plain, held = [], [], 0
            yield pd.DataFrame({ids: packed, decoded: plain})

    coded = encode(quoted(text).cast("string"))
    name = fresh(docs.columns, "coded")
    return docs.withColumn(name, coded).select(
        *[quoted(c) for c in docs.columns if c.lower() not in (ids.lower(), decoded.lower())],
        F.col(f"{name}.{ids}").alias(ids),
        F.col(f"{name}.{decoded}").alias(decoded),
    )


def token_digests(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    memo: int | None = None,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document."""
    texts = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    coded = tokenize(texts, ranks, pattern, memo=memo)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
