"""Registry of queries and of the statements that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .bridge import view
from .oracle import shift, statement

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Views:
    """The bridge views of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, as the checking statement does.

    The small shift keeps values that end in a half from falling to either side by their last bit.
    """
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`") + shift(digits), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None, doubles=(), digits: int = 6):
    """Register a query; ``sql`` checks its values and ``doubles`` are the columns to round."""

    def register(run: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(run(Views(spark, sf_dir)), digits)
        if sql is not None:
            ORACLES[name] = statement(sql, doubles, digits)
        return run

    return register
