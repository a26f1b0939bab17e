"""A dataset as numbered files of equal length, written by a Spark data source of its own.

Tasks write their files beside the dataset. Once all tasks are done the driver moves them to their names; after a failure it
removes them, and the dataset is as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .staging import staged

FORMAT = "numbered_parts"
#: Column that names the part of a row; it is not written.
PART = "_part"


def part_name(part: int) -> str:
    return f"part-{part:05d}.parquet"


def _filesystem(path: str):  # noqa: ANN202
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """Parts of one task, with the names of their files beside the dataset."""

    files: list[tuple[int, str]]


class PartsWriter(DataSourceArrowWriter):
    """Rows come sorted by part, all rows of a part in one task."""

    def __init__(self, path: str, replace: bool):
        self.path, self.replace, self.beside = path, replace, f"{path}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import numpy as np
        from pyarrow import parquet

        filesystem, folder = _filesystem(self.beside)
        filesystem.create_dir(folder, recursive=True)
        files, open_part, writer = [], None, None
        try:
            for batch in iterator:
                parts = batch.column(PART).to_numpy()
                rows = batch.drop_columns([PART])
                cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)] if len(parts) else []
                for low, high in zip(cuts, cuts[1:]):
                    if parts[low] != open_part:
                        if writer:
                            writer.close()
                        open_part, name = int(parts[low]), f"{folder}/{uuid.uuid4().hex}.parquet"
                        files.append((open_part, name))
                        writer = parquet.ParquetWriter(name, rows.schema, filesystem=filesystem)
                    writer.write_batch(rows.slice(low, high - low))
        finally:
            if writer:
                writer.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        filesystem, folder = _filesystem(self.path)
        filesystem.create_dir(folder, recursive=True)
        if self.replace:
            for found in filesystem.get_file_info(fs.FileSelector(folder)):
                if not found.base_name.startswith("_writing-"):
                    (filesystem.delete_dir if found.type == fs.FileType.Directory else filesystem.delete_file)(found.path)
        for part, name in (f for m in messages if m for f in m.files):
            target = f"{folder}/{part_name(part)}"
            if filesystem.get_file_info(target).type != fs.FileType.NotFound:
                filesystem.delete_file(target)
            filesystem.move(name, target)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        filesystem, folder = _filesystem(self.beside)
        if filesystem.get_file_info(folder).type != fs.FileType.NotFound:
            filesystem.delete_dir(folder)


class NumberedParts(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> PartsWriter:  # noqa: ANN001
        return PartsWriter(self.options["path"], overwrite)


def numbered(df: DataFrame, order_by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``_number``, the place of each row from 0: in the order of the columns, or in that of the table's partitions.

    Rows are numbered within their partition and moved on by the rows of the partitions before, of which there is one row each.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    rows = staged(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    # the number of the partition stands above 33 bits that hold the place within
    rows = rows.withColumns({"_split": F.shiftright("_at", 33), "_inside": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_split").agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.select("_split", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    return rows.join(counts, "_split").withColumn("_number", F.col("_inside") + F.col("_base")).drop("_at", "_split", "_inside", "_base")


def write_parts(spark: SparkSession, df: DataFrame, path: str, rows_per_file: int, replace: bool, order_by: tuple[str, ...] = ()) -> None:
    """Part k holds the rows from ``k * rows_per_file`` on, as ``part-0000k.parquet``. Without ``replace`` parts of the same
    name are overwritten and others stay."""
    spark.dataSource.register(NumberedParts)
    rows = numbered(df, order_by).withColumn(PART, F.floor(F.col("_number") / rows_per_file))
    rows = rows.repartition(PART).sortWithinPartitions(PART, "_number").drop("_number")
    rows.write.format(FORMAT).mode("overwrite" if replace else "append").save(path)
