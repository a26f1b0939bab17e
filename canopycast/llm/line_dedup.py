"""Operator 13: line dedup over levelled sorted runs of line hashes.

A run is a table of distinct line keys, dealt into buckets by their hash and sorted within: how many documents hold the
key, and the largest id among them. Batches of documents arrive one after another. Each merge-anti-joins the runs: a key
that some run has already settled (often enough, and held by a larger document) isn't written again, all others form the
batch's own run. Two runs of one level are merged into one run of the next, so there are never more runs than the logarithm
of the batches. Joins and merges of runs shuffle nothing, as all have the same buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import remove, staged, staged_path
from .common import arrow_map, text_table

#: Code points of the shortest key, and documents from which on a key is a repeat.
LEAST, DOCUMENTS = 40, 5
#: Batches that ``repeated_lines`` takes a table in.
BATCHES = 6
#: A key in more than this share of the documents is hot; there are at most this many times a document's mean number of keys.
HOT = 200

# The characters stripped from both ends, and the letters that become lower case.
_BLANK = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def line_keys(text: str) -> list[bytes]:
    """The 128-bit hash of each line's key; empty for keys of fewer than ``LEAST`` code points."""
    keys = []
    for line in text.encode().translate(_LOWER).split(b"\n"):
        key = line.strip(_BLANK)
        long = len(key) >= LEAST and (key.isascii() or len(key.decode()) >= LEAST)
        keys.append(xxhash.xxh3_128_digest(key) if long else b"")
    return keys


def document_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, h, g`` (the two halves of a key's hash), once per row of ``docs`` and key. Rows without an id have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = set(line_keys(text)) - {b""}
                keys += found
                ids += [doc_id] * len(found)
            halves = [pa.array([int.from_bytes(k[at : at + 8], "little", signed=True) for k in keys], pa.int64()) for at in (0, 8)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *halves], ["doc_id", "h", "g"])

    return arrow_map(docs.where("doc_id IS NOT NULL"), run, "doc_id long, h long, g long")


class LineRuns:
    """Runs ``h, g, docs, last``, at most one of each level; ``add`` takes the keys of a batch, ``merged`` gives one row per key."""

    def __init__(self, spark: SparkSession, documents: int = DOCUMENTS):
        self.spark, self.documents = spark, documents
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, tuple[str, str]] = {}

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name = f"line_run_{uuid.uuid4().hex}"
        path = staged_path(self.spark, name)
        rows.select("h", "g", "docs", "last").write.bucketBy(self.buckets, "h", "g").sortBy("h", "g").option("path", path).saveAsTable(name)
        return name, path

    def _drop(self, *runs: tuple[str, str]) -> None:
        """Runs that have been merged are read by nobody."""
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            remove(path)

    def _both(self, one: tuple[str, str], two: tuple[str, str]) -> DataFrame:
        a, b = self.spark.table(one[0]).alias("a"), self.spark.table(two[0]).alias("b")
        either = a.join(b, F.expr("a.h = b.h AND a.g = b.g"), "full")
        return either.selectExpr(
            "coalesce(a.h, b.h) AS h", "coalesce(a.g, b.g) AS g", "coalesce(a.docs, 0) + coalesce(b.docs, 0) AS docs", "greatest(a.last, b.last) AS last"
        )

    def add(self, keys: DataFrame) -> None:
        """Add a batch of ``doc_id, h, g``. Rows of one id that come in one batch are one document; ids may come in any order."""
        own = keys.groupBy("h", "g").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("last")).alias("own")
        for name, _ in self.levels.values():
            settled = self.spark.table(name).where(F.col("docs") >= self.documents).alias("run")
            own = own.join(settled, F.expr("own.h = run.h AND own.g = run.g AND own.last < run.last"), "left_anti").alias("own")
        run, level = self._write(own), 0
        while level in self.levels:
            other = self.levels.pop(level)
            merged = self._write(self._both(other, run))
            self._drop(other, run)
            run, level = merged, level + 1
        self.levels[level] = run

    def merged(self) -> DataFrame:
        """Every key of all runs with its ``docs`` (of a settled key at least ``documents``, else exact) and ``last``."""
        while len(self.levels) > 2:
            small, next_one = sorted(self.levels)[:2]
            runs = self.levels.pop(small), self.levels.pop(next_one)
            self.levels[next_one] = self._write(self._both(*runs))
            self._drop(*runs)
        runs = list(self.levels.values())
        return self._both(*runs) if len(runs) == 2 else self.spark.table(runs[0][0])

    def clear(self) -> None:
        self._drop(*self.levels.values())
        self.levels = {}


def repeated_lines(keys: DataFrame, documents: int = DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """``h, g, docs, last`` of the keys that ``documents`` documents or more hold. Batches come by descending id, so that a key
    is mostly settled by the first that hold it."""
    shares = [k / batches for k in range(1, batches)] or [1.0]
    limits = sorted(set(keys.agg(F.percentile_approx("doc_id", shares)).first()[0] or []), reverse=True) if batches > 1 else []
    runs, below = LineRuns(keys.sparkSession, documents), [None, *limits]
    for high, low in zip(below, [*limits, None]):
        batch = keys if high is None else keys.where(F.col("doc_id") <= high)
        runs.add(batch if low is None else batch.where(F.col("doc_id") > low))
    found = staged(runs.merged().where(F.col("docs") >= documents), "repeated-lines")
    runs.clear()
    return found


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row, ``text`` without its repeated lines.

    A line's key is the line without blanks at its ends, A-Z in lower case. Keys of ``LEAST`` code points or more that at least
    ``documents`` documents hold lose all their lines except in the document of the largest id. A null or empty text is one
    empty line, and a text that loses all its lines becomes empty. Rows of one id are one document and decide alike, so equal
    rows keep or lose the same lines; rows without an id are no document and keep all lines. Texts are split whole, whatever
    their length; an empty table gives no rows; further columns are not read.
    """
    rows = text_table(docs, id_col, text_col)
    keys = staged(document_keys(rows), "line-keys")
    limit = rows.count() / HOT
    repeated = repeated_lines(keys, documents, batches)
    hot = repeated.where(F.col("docs") > limit).select("h", "g", F.col("last").alias("hot_last"))
    met = keys.join(F.broadcast(hot), ["h", "g"], "left")
    known = met.where("doc_id < hot_last").select("doc_id", "h", "g")
    rest = met.where("hot_last IS NULL").join(repeated.where(F.col("docs") <= limit), ["h", "g"]).where("doc_id < last").select("doc_id", "h", "g")
    lost = known.union(rest).groupBy("doc_id").agg(F.collect_set(F.struct("h", "g")).alias("lost"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, many, dropped = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist()):
                lines = text.split("\n")
                kept = lines
                if gone:
                    gone = {x["h"].to_bytes(8, "little", signed=True) + x["g"].to_bytes(8, "little", signed=True) for x in gone}
                    kept = [line for line, key in zip(lines, line_keys(text)) if key not in gone]
                texts.append("\n".join(kept))
                many.append(len(lines))
                dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(many, pa.int64()), pa.array(dropped, pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"],
            )

    # rows without an id stay out of the join, where they would fill one partition
    with_id = rows.where("doc_id IS NOT NULL").join(lost, "doc_id", "left")
    without = rows.where("doc_id IS NULL").withColumn("lost", F.lit(None).cast(lost.schema["lost"].dataType))
    return arrow_map(with_id.union(without), run, "doc_id long, text string, n_lines long, n_dropped long")


def digests(rows: DataFrame) -> DataFrame:
    """``deduplicated`` rows with the SHA-256 of their text instead of it."""
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
