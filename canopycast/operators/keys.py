"""Matching of keys that are spelled differently in different sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import LOT
from ..functions.scalars import canonical_key


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """Each key spelling once, with its canonical form."""
    key = F.col(column).cast("string")
    return with_canonical(df.where(key.isNotNull()).select(key.alias("source_lote")).distinct())


def dated_keys(series: DataFrame, column: str, date: str) -> DataFrame:
    """Each key spelling once, with its canonical form and last date: one scan for both uses."""
    key = F.col(column).cast("string")
    dates = series.where(key.isNotNull()).groupBy(key.alias("source_lote")).agg(
        F.max(F.col(date).cast("date")).alias("last_date")
    )
    return with_canonical(dates)


def with_canonical(keys: DataFrame) -> DataFrame:
    return keys.withColumn("canonical_lote_key", canonical_key(F.col("source_lote")))


def unique_canonical(keys: DataFrame) -> DataFrame:
    """Canonical keys that stand for exactly one source spelling."""
    # min = max says "one distinct value" and needs no distinct aggregation
    return (
        keys.where(F.col("canonical_lote_key").isNotNull())
        .groupBy("canonical_lote_key")
        .agg(F.min("source_lote").alias("source_lote"), F.max("source_lote").alias("_last"))
        .where(F.col("source_lote") == F.col("_last"))
        .drop("_last")
    )


def key_match(targets: DataFrame, sources: DataFrame, prefix: str) -> DataFrame:
    """Match target lots to source keys: same spelling first, else a canonical form that is unique.

    Both inputs come from :func:`distinct_keys`. No broadcast hint: Spark sees the sizes and picks.
    """
    exact = sources.select(F.col("source_lote"), F.col("source_lote").alias("_exact"))
    canonical = unique_canonical(sources).withColumnRenamed("source_lote", "_canonical")
    method = (
        F.when(F.col("_exact").isNotNull(), "exact")
        .when(F.col("_canonical").isNotNull(), "canonical")
        .otherwise("no_match")
    )
    return (
        targets.join(exact, "source_lote", "left")
        .join(canonical, "canonical_lote_key", "left")
        .select(
            F.col("source_lote").alias(LOT),
            F.coalesce("_exact", "_canonical").alias(f"{prefix}_lote_matched"),
            method.alias(f"{prefix}_lote_match_method"),
        )
    )
