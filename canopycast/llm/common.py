"""What the operators share: Arrow passes with bounded batches, running offsets, components, runs of equal keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..sources.staging import discard, staged

#: Rows and bytes that an Arrow batch holds at most, so a Python worker's memory doesn't depend on the table.
BATCH_ROWS, BATCH_BYTES = 500, 16 * 1024 * 1024
#: Rows whose running totals one task adds up.
RUN = 4096


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow over batches of bounded size."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def text_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names; a null text becomes empty."""
    name = lambda c: F.col(f"`{c}`")
    return docs.select(
        name(id_col).cast("long").alias("doc_id"), F.coalesce(name(text_col).cast("string"), F.lit("")).alias("text"), *[name(c).alias(c) for c in more]
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def running_total(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Add the total of ``value`` over all rows with a smaller ``order``, a whole number from 0.

    The totals are taken within runs of numbers, then over the runs, so that one task sorts a run or one row per run.
    """
    rows = df.withColumn("_run", F.floor(F.col(order) / RUN))
    before = (Window.unboundedPreceding, -1)
    runs = rows.groupBy("_run").agg(F.sum(value).alias("_sum"))
    runs = runs.withColumn("_base", F.coalesce(F.sum("_sum").over(Window.orderBy("_run").rowsBetween(*before)), F.lit(0))).drop("_sum")
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("_run").orderBy(order).rowsBetween(*before)), F.lit(0))
    return rows.withColumn("_inside", inside).join(runs, "_run").withColumn(out, F.col("_inside") + F.col("_base")).drop("_run", "_inside", "_base")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``(a, b)``, both long: ``(node, component)`` for every node that has a link.

    Every round each node joins the neighbour of least hash, and the links between the joined nodes go on. A constant
    share of the nodes disappears in every round, whatever the shape, so the rounds grow with the logarithm of the size.
    Null ends and links of a node with itself are dropped. Only the number of links is seen by the driver.
    """
    links = edges.where("a <> b").select("a", "b")
    links = staged(links.union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    label, turn, steps = None, 0, []
    while not links.isEmpty():
        mark = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("v"))
        best = links.groupBy("a").agg(F.min(mark(F.col("b"))).alias("m"))
        step = staged(best.select(F.col("a").alias("node"), F.least("m", mark(F.col("a")))["v"].alias("to")), "step")
        ends = links.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(
            step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b"
        )
        before, links = links, staged(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
        discard(before)
        steps.append(step)
        if label is None:
            label = step
        else:
            then = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
            label = label.join(then, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        turn += 1
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    found = staged(label.select("node", F.col("to").alias("component")), "components")
    discard(links, *steps)
    return found


def equal_runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """The rows of each key, one table at a time; the batches come sorted by ``key``."""
    import numpy as np

    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if waiting and keys[low] != last:
                yield last, pa.Table.from_batches(waiting)
                waiting = []
            last = keys[low]
            waiting.append(batch.slice(low, high - low))
    if waiting:
        yield last, pa.Table.from_batches(waiting)
