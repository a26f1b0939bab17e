import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from canopycast.sources import io, staging


def files(path):
    return {p.name: pq.read_table(p).column("id").to_pylist() for p in path.glob("*.parquet")}


def test_parts_are_numbered_and_hold_n_rows_each(spark, tmp_path):
    df, path = spark.range(0, 2500, 1, 7), tmp_path / "datasets" / "x"
    assert io.write_chunked(df, str(tmp_path), "x", 400) == str(path)
    want = {f"part-{k:05d}.parquet": list(range(400 * k, min(2500, 400 * (k + 1)))) for k in range(7)}
    assert files(path) == want and sorted(p.name for p in path.iterdir()) == sorted(want)
    # parts of the same name are overwritten, others stay
    io.write_chunked(spark.range(10_000, 10_500), str(tmp_path), "x", 400, replace=False)
    first = {"part-00000.parquet": list(range(10_000, 10_400)), "part-00001.parquet": list(range(10_400, 10_500))}
    assert files(path) == want | first
    io.write_chunked(spark.range(5).orderBy(F.desc("id")), str(tmp_path), "x", 3, order_by=["id"])
    assert files(path) == {"part-00000.parquet": [0, 1, 2], "part-00001.parquet": [3, 4]}


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = tmp_path / "datasets" / "x"
    io.write_chunked(spark.range(1000), str(tmp_path), "x", 100)
    before = files(path)
    bad = spark.range(1000).repartition(8).withColumn("_part", F.floor(F.col("id") / 100))
    broken = bad.select("id", F.when(F.col("id") < 990, F.col("_part")).otherwise(F.raise_error("no")).cast("long").alias("_part"))
    with pytest.raises(Exception, match="no"):
        broken.repartition("_part").write.format("numbered_parts").mode("overwrite").save(str(path))
    assert files(path) == before and sorted(p.name for p in path.iterdir()) == sorted(before)


def test_an_empty_table_has_no_parts(spark, tmp_path):
    io.write_chunked(spark.range(0), str(tmp_path), "x", 100)
    assert list((tmp_path / "datasets" / "x").iterdir()) == []


def test_parquet_tree_unites_columns(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "one"))
    spark.range(2).withColumn("more", F.lit("x")).write.parquet(str(tmp_path / "deep" / "two"))
    df = io.read_parquet_tree(spark, str(tmp_path))
    assert set(df.columns) == {"id", "more"} and df.count() == 5
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        io.read_parquet_tree(spark, str(tmp_path / "empty"))


def test_jdbc_options():
    assert io.jdbc_options("u", "t") == {"url": "u", "dbtable": "t", "fetchsize": "10000"}
    found = io.jdbc_options("u", "t", "id", 0, 10, 4)
    assert found["partitionColumn"] == "id" and found["numPartitions"] == "4"


def test_reports_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    for fmt in ("csv", "json"):
        paths = io.write_reports({"r": df}, str(tmp_path), fmt)
        reader = spark.read.schema(df.schema).option("header", True)
        assert sorted(reader.format(fmt).load(paths["r"]).collect()) == sorted(df.collect())


def test_staged_rows_are_read_from_the_shared_folder(spark):
    df = staging.staged(spark.range(5))
    assert df.count() == 5 and all(f.startswith("file:") and staging.shared_dir(spark) in f for f in df.inputFiles())
