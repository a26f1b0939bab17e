"""Operator 8: byte-level BPE encoding and decoding by the ranks of a vocabulary file.

Tier one: a minimal perfect hash over the vocabulary says whether a whole pre-token is a token. Tier two: the other
pre-tokens are merged pair by pair, from a heap of ranks over a linked list of byte runs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import arrow_map, text_table
from .segments import Segments


class PerfectHash:
    """Each of n keys has a place of its own below n: keys share small buckets, and each bucket has a seed under which its
    keys fall on free places. A bucket of one key stores the place itself, as a negative number."""

    def __init__(self, keys: list[bytes]):
        self.size, self.buckets = len(keys), max(1, len(keys) // 4)
        groups: dict[int, list[bytes]] = {}
        for key in keys:
            groups.setdefault(xxhash.xxh3_64_intdigest(key) % self.buckets, []).append(key)
        self.seeds, taken = [0] * self.buckets, [False] * self.size
        single = []
        for bucket, group in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(group) == 1:
                single.append(bucket)
                continue
            seed = 0
            while True:
                seed += 1
                places = {xxhash.xxh3_64_intdigest(key, seed) % self.size for key in group}
                if len(places) == len(group) and not any(taken[p] for p in places):
                    break
            self.seeds[bucket] = seed
            for p in places:
                taken[p] = True
        free = (p for p in range(self.size) if not taken[p])
        for bucket in single:
            self.seeds[bucket] = -next(free) - 1

    def place(self, key: bytes) -> int:
        """The place of a key; of any other bytes, the place of some key."""
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % self.buckets]
        return -seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.size


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.hash = PerfectHash(list(ranks))
        self.slots: list[tuple[bytes, int]] = [(b"", 0)] * len(ranks)
        for token, rank in ranks.items():
            self.slots[self.hash.place(token)] = (token, rank)

    def encode(self, text: str) -> list[int]:
        ids = []
        for pre_token in self.split(text):
            data = pre_token.encode()
            token, rank = self.slots[self.hash.place(data)]
            if token == data:
                ids.append(rank)
            else:
                ids += self.merge(data)
        return ids

    def merge(self, data: bytes) -> list[int]:
        """Join the neighbouring runs of least rank, the leftmost on ties, until no two form a token."""
        n, ranks = len(data), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)

        def offer(left: int) -> None:
            if left >= 0 and (middle := after[left]) < n:
                end = after[middle]
                if (rank := ranks.get(data[left:end])) is not None:
                    heapq.heappush(heap, (rank, left, end))

        while heap:
            _, left, end = heapq.heappop(heap)
            middle = after[left]
            if middle < 0 or middle >= n or after[middle] != end:
                continue  # one of the two runs has been joined elsewhere
            after[left], after[middle] = end, -1
            before[end] = left
            offer(left)
            offer(before[left])
        ids, at = [], 0
        while at < n:
            ids.append(ranks[data[at : after[at]]])
            at = after[at]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@cache
def vocabulary(path: str, pattern: str) -> tuple[Vocabulary, Segments]:
    """One per Python worker; segments seen before are remembered up to a bound."""
    own = Vocabulary(read_ranks(path), pattern)
    return own, Segments(lambda segments: [np.array(own.encode(s), "<u4").tobytes() for s in segments])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) ``, ids_sha256, decoded_sha256``, one row per row.

    ``decoded_sha256`` is that of the bytes the ids decode to. A null or empty text has no ids; ``ids`` is null without ``keep_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, segments = vocabulary(ranks_path, pattern)
        for batch in batches:
            ids = [b"".join(x) for x in segments.of(batch.column("text").to_pylist())]
            decoded = [own.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids if keep_ids else [None] * len(ids), pa.binary()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

    return arrow_map(text_table(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")


def decode_documents(rows: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of id arrays; bytes that are no UTF-8 become the replacement character. Null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = vocabulary(ranks_path, pattern)
        for batch in batches:
            texts = [None if x is None else own.decode(np.frombuffer(x, "<u4").tolist()).decode(errors="replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return arrow_map(rows.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids"), run, "doc_id long, text string")
