"""Operator 12: grouping of spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Bigrams are ordered by the
number of words that hold them. A word's prefix are its three rarest bigrams, its pivots two of them that don't overlap
and are rarest together. One edit touches at most one of two disjoint pivots, so of two near words the one whose prefix
ends earlier in the order has a pivot that the other has too, within its prefix. The edit lies on one side of that pivot.
On the other side both words are equal, so the pivot has the same place counted from that end; and of the side with the edit
the first or the last half is equal too. Pivots meet prefixes only at the same place with the same letters on the one side
and one equal half on the other. What meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import staged
from .common import arrow_map, text_table

#: Letters of the shortest word, its least number of occurrences, and how many times more often a word's form occurs.
LETTERS, LEAST, RATIO = 7, 2, 10
#: One occurrence in ``EDITED`` loses a letter, told by its hash.
EDITED = 31
#: Distinct words whose occurrences a task adds up before it sends them.
HELD = 500_000

# The characters of a run, and the letters that become lower case.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def occurrence(doc_id: int | None, run: str) -> str:
    """The word that a lower-cased run stands for: a fixed share of the occurrences lose the letter that their hash names."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % EDITED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, least: int = LEAST) -> DataFrame:
    """``word, n``: words of at least ``letters`` code points with at least ``least`` occurrences in all rows.

    Each task adds up what it reads before anything is shuffled. Null and empty texts have no words; equal rows each count.
    The hash is taken over the id as decimal text, empty for a null one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for m in _RUN.finditer(text.encode().translate(_LOWER).decode()):
                    run = m.group()
                    if len(run) < letters:
                        continue
                    word = occurrence(doc_id, run)
                    if len(word) >= letters:
                        total[word] = total.get(word, 0) + 1
            if len(total) >= HELD:
                yield _counts(total)
                total = {}
        yield _counts(total)

    counts = arrow_map(text_table(docs, id_col, text_col), run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counts(total: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def gram_order(vocabulary: DataFrame) -> dict[str, int]:
    """The place of each bigram when ordered by how many words hold it, the rarest first; at most the square of the number of different letters."""
    grams = vocabulary.select(F.explode(F.array_distinct(F.expr("transform(sequence(1, length(word) - 1), i -> substr(word, i, 2))"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n")).collect()
    return {row.gram: k for k, row in enumerate(sorted(counts, key=lambda r: (r.n, r.gram)))}


def prefix_and_pivots(word: str, order: dict[str, int]) -> tuple[list[int], tuple[int, int]]:
    """Places of the word's prefix bigrams and of two pivots among them.

    The prefix are the three rarest places, with every other place of a bigram as rare as the third. The pivots are the
    cheapest two disjoint places (by the sum of their bigrams' places in the order): a walk from left to right that keeps the
    cheapest single place that ends before the current one.
    """
    rank = [order[word[i : i + 2]] for i in range(len(word) - 1)]
    limit = sorted(rank)[2]
    prefix = [i for i, r in enumerate(rank) if r <= limit]
    best, pair, one, waiting = None, None, None, []
    for i in prefix:
        while waiting and waiting[0] + 2 <= i:
            j = waiting.pop(0)
            if one is None or rank[j] < rank[one]:
                one = j
        if one is not None and (best is None or rank[one] + rank[i] < best):
            best, pair = rank[one] + rank[i], (one, i)
        waiting.append(i)
    return prefix, pair


def _halves(known: str, rest: str, side: int, lengths: Iterable[int]) -> set[int]:
    """Hashes of the equal side with either half of the rest, cut as a rest of each length is: an edit leaves one half as it is."""
    first, last = {m // 2 for m in lengths}, {m - m // 2 for m in lengths}
    keys = {xxhash.xxh3_64_intdigest(f"{known}|{rest[:k]}", 2 * side) for k in first if k <= len(rest)}
    return keys | {xxhash.xxh3_64_intdigest(f"{known}|{rest[len(rest) - k :]}", 2 * side + 1) for k in last if k <= len(rest)}


def lookup_keys(vocabulary: DataFrame, order: dict[str, int], pivots: bool) -> DataFrame:
    """``key, last, letters, word, n``: every word under the keys of its prefix bigrams, or of its pivots as they look for others.

    ``last`` is the place in the order where the word's prefix ends, ``letters`` marks the bytes it has. Pivots ask for rests
    that are as long as their own, or one letter shorter or longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, many, last, letters = [], [], [], []
            for word in batch.column("word").to_pylist():
                prefix, pair = prefix_and_pivots(word, order)
                found: set[int] = set()
                for i in pair if pivots else prefix:
                    for side, known, rest in ((0, word[: i + 2], word[i + 2 :]), (1, word[i:], word[:i])):
                        m = len(rest)
                        found |= _halves(known, rest, side, range(max(m - 1, 0), m + 2) if pivots else (m,))
                keys += found
                many.append(len(found))
                last.append(max(order[word[i : i + 2]] for i in prefix))
                letters.append(reduce(lambda x, byte: x | 1 << byte % 31, word.encode(), 0))
            at = pa.array(np.repeat(np.arange(batch.num_rows), many))
            columns = [pa.array(last, pa.int32()), pa.array(letters, pa.int32()), batch.column("word"), batch.column("n")]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), *(c.take(at) for c in columns)], names)

    schema = "key long, last int, letters int, word string, n long"
    names = [x.split()[0] for x in schema.split(", ")]
    return arrow_map(vocabulary.select("word", "n"), run, schema)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: every pair of near words of ``vocabulary`` (``word, n``), both ways.

    Words need at least four code points, so that three bigrams exist. The bigrams' order reaches the driver and the tasks. A
    key joins words that share about three quarters of their letters; Spark splits partitions that are much larger than others.
    """
    order = gram_order(vocabulary)
    held = lookup_keys(vocabulary, order, False).toDF("key", "other_last", "other_letters", "other", "other_n")
    # an edit takes at most two bytes and adds at most two, three together
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 3
    near = (F.col("last") <= F.col("other_last")) & alike & (F.levenshtein("word", "other", 1) == 1)
    met = lookup_keys(vocabulary, order, True).join(held, "key").where(near).select("word", "n", "other", "other_n")
    return met.union(met.select(F.col("other"), F.col("other_n"), F.col("word"), F.col("n"))).distinct()


def variants(vocabulary: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root``: the form of a word is its near word of most occurrences (of equal ones the first
    in code-point order) if it occurs ``ratio`` times as often; the root is where the chain of forms ends.

    A form occurs ``ratio`` times as often as its word, so a chain is at most as long as the largest count has digits
    (to that base), and doubling steps reach its end in the logarithm of that.
    """
    # strings compare by their UTF-8 bytes, which is code-point order
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = vocabulary.join(near, "word", "left").withColumn("best", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")))
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))
    rows = staged(rows, "forms")
    step = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most, longest = rows.agg(F.max("n")).first()[0] or 1, 1
    while longest < np.log(max(most, 2)) / np.log(ratio):
        then = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(step.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        longest *= 2
    return rows.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of all words of a table (see ``words`` and ``variants``).

    No text, no words: an empty table gives no rows. Runs of any length are taken whole. Ties between forms fall to the first
    in code-point order. Further columns are not read.
    """
    vocabulary = staged(words(docs, id_col, text_col), "words")
    return variants(vocabulary, staged(near_pairs(vocabulary), "near-words"))
