"""Readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .parts import write_parts


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Options of a JDBC read; with a column, each task reads one range of it."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **more}
    if column is not None:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """One table of a relational database; Spark pushes column choice and filters into it."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def run_query(text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of an SQL query; ``{name}`` stands for an input table."""
    spark = next(iter(tables.values())).sparkSession
    return spark.sql(text, **tables)


def read_parquet_tree(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All parquet files below a folder, matched by column name; columns of any file are kept."""
    try:
        return (
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .option("mergeSchema", True)
            .parquet(path)
        )
    except AnalysisException as error:
        if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise FileNotFoundError(f"no parquet files below {path}") from error
        raise


def write_dataset(df: DataFrame, folder: str, name: str) -> str:
    """Write a named dataset and return its path."""
    path = f"{folder}/datasets/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def write_chunked(df: DataFrame, folder: str, name: str, rows_per_file: int = 100_000, replace: bool = True, order_by: Sequence[str] = ()) -> str:
    """Write a dataset as numbered files of ``rows_per_file`` rows, the last one shorter; the rows keep their order, or take that of ``order_by``.

    ``replace`` removes what was there; without it files of the same number are overwritten and others stay.
    """
    path = f"{folder}/datasets/{name}"
    write_parts(df.sparkSession, df, path, rows_per_file, replace, tuple(order_by))
    return path


def write_reports(reports: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, str]:
    """Write each report below the folder under its name; empty reports are written too."""
    paths = {}
    for name, df in reports.items():
        paths[name] = f"{folder}/{name}.{fmt}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(paths[name])
    return paths
