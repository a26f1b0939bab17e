"""Operator 3: best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces of each length, at most ``capacity``
numbers whatever the input, decides which lengths share a sequence; Spark numbers the pieces of each length and gives
them their places.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.staging import staged
from .common import arrow_map, running_total, text_table
from .library_ids import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, fold long"
#: Pieces of one length are numbered in so many folds at first.
FOLDS = 4096


def fullest(free: dict[int, int], capacity: int) -> list[int]:
    """The combination of available lengths, the longest one among them, that leaves least of ``capacity`` unused.

    ``free``: number of pieces by length. Subset sums are bits of one integer: after each length, bit s says whether
    some choice among the lengths so far adds up to s. Longer lengths are offered first, and the search ends when the
    capacity is met exactly.
    """
    longest = max(free)
    room = capacity - longest
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(free, reverse=True):
        left = min(free[length] - (length == longest), room // length)
        copies = 1
        while left > 0 and not reach >> room & 1:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left, copies = left - take, 2 * copies
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, [longest]
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """How many sequences hold which lengths. A combination that is the fullest stays so while its pieces last."""
    free, plan = {k: n for k, n in counts.items() if n > 0}, []
    while free:
        chosen = fullest(free, capacity)
        used = Counter(chosen)
        times = min(free[k] // n for k, n in used.items())
        plan.append((times, sorted(chosen, reverse=True)))
        for k, n in used.items():
            free[k] -= times * n
            if not free[k]:
                del free[k]
    return plan


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole texts as token ids with ``end_id``, cut only where longer than ``capacity``; the first piece takes the remainder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, number = encoder(tokenizer), 0
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of(batch.column("text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, high in enumerate(range(first, len(ids) + 1, capacity)):
                    low = 0 if k == 0 else high - capacity
                    data = ids[low:high].tobytes()
                    number += 1
                    rows.append((doc_id, k, low, high - low, zlib.crc32(data), data if keep_ids else None, number % FOLDS))
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds)], names=[c.split()[0] for c in PIECES.split(", ")])

    return arrow_map(text_table(docs, id_col, text_col), cut, PIECES)


def _slots(spark: SparkSession, plan: list[tuple[int, list[int]]]) -> DataFrame:
    """For each length, which of its numbers go where: ``per`` numbers to a sequence from ``low`` on, at ``place``."""
    rows, sequence, given = [], 0, Counter()
    for times, lengths in plan:
        used, place = Counter(lengths), {}
        at = 0
        for length in sorted(used, reverse=True):
            place[length] = at
            at += length * used[length]
        for length, per in used.items():
            rows.append((length, given[length], given[length] + times * per, per, sequence, place[length]))
            given[length] += times * per
        sequence += times
    return spark.createDataFrame(rows, "length long, low long, high long, per long, first long, place long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens, as few as the method finds.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``; ``ids`` (little-endian
    unsigned 32-bit) is null without ``keep_ids``. A null or empty text is ``end_id`` alone; equal rows are packed each;
    a null id is kept; no documents give no rows.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer, capacity, end_id, keep_ids, id_col, text_col), "pieces")
    # the numbers of pieces by length and fold: a length with a third of all pieces is numbered in many tasks
    folds = staged(cut.groupBy("length", "fold").agg(F.count(F.lit(1)).alias("n")), "folds")
    counts = {r["length"]: r["n"] for r in folds.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    order = Window.partitionBy("length").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    folds = folds.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("length", "fold").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = cut.withColumn("within", within).join(folds, ["length", "fold"]).withColumn("number", F.col("within") + F.col("before"))
    # at most one row per length and pattern, and each pattern uses up a length
    slots = F.broadcast(_slots(spark, bin_patterns(counts, capacity)).withColumnRenamed("length", "slot"))
    number = F.col("number")
    placed = numbered.join(slots, (F.col("length") == F.col("slot")) & (number >= F.col("low")) & (number < F.col("high")))
    turn = number - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids",
        (F.col("first") + F.floor(turn / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.col("length") * (turn % F.col("per"))).cast("long").alias("offset"),
    )
