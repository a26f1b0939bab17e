"""Operator 10: token counts under a unigram model, by forward scores in a trie that the pre-tokens share.

The best score of a prefix does not depend on what follows it. A trie node stands for a prefix, holds its best score and
the number of tokens on the best path, and is computed once for all pre-tokens that begin with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .byte_bpe import read_ranks
from .common import arrow_map, text_table
from .segments import Segments

#: Nodes after which a worker starts a new trie, so its memory is bounded.
NODES = 400_000


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log probabilities of tokens whose frequency is inverse to their rank."""
    total = math.log(sum(1 / (rank + 2) for rank in ranks.values()))
    return {token: -math.log(rank + 2) - total for token, rank in ranks.items()}


class Trie:
    """``score`` and ``tokens`` by node; a path of equal score with fewer tokens wins, then the one with the longer last token."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores, self.longest = scores, max(map(len, scores))
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score, self.tokens = [0.0], [0]

    def insert(self, word: bytes) -> int:
        """The number of tokens of ``word``; only the nodes below the longest known prefix are computed."""
        path, node = [0], 0
        for depth, byte in enumerate(word, 1):
            key = node << 8 | byte
            if (node := self.child.get(key, -1)) < 0:
                best, count = -math.inf, 0
                for start in range(max(0, depth - self.longest), depth):
                    if (score := self.scores.get(word[start:depth])) is not None:
                        prefix = path[start]
                        total, n = self.score[prefix] + score, self.tokens[prefix] + 1
                        if total > best or total == best and n < count:
                            best, count = total, n
                node = self.child[key] = len(self.score)
                self.score.append(best)
                self.tokens.append(count)
            path.append(node)
        if self.score[node] == -math.inf:
            raise ValueError("the vocabulary lacks a byte of the text")
        return self.tokens[node]


@cache
def counter(ranks_path: str, pattern: str) -> Segments:
    """One per Python worker: from segment to its number of pre-tokens and of tokens."""
    trie, split = Trie(zipf_scores(read_ranks(ranks_path))), regex.compile(pattern).findall

    def count(segments: list[str]) -> list[tuple[int, int]]:
        found = []
        for segment in sorted(segments):
            if len(trie.score) > NODES:
                trie.clear()
            words = split(segment)
            found.append((segment, (len(words), sum(trie.insert(w.encode()) for w in words))))
        found = dict(found)
        return [found[s] for s in segments]

    return Segments(count)


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every whole text, one row per row; a null or empty text counts 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = counter(ranks_path, pattern)
        for batch in batches:
            values = segments.of(batch.column("text").to_pylist())
            sums = [pa.array([sum(v[k] for v in x) for x in values], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *sums], ["doc_id", "n_pretokens", "n_tokens"])

    return arrow_map(text_table(docs, id_col, text_col), run, "doc_id long, n_pretokens long, n_tokens long")
