"""Registered queries against their statements. CHECK_ALL=1 runs every one of them."""

import os

import pytest

from check import compare, duck

SF = "/root/testdata/sf0.001"
SOME = [
    "key_match", "prev_closing", "series_features", "climate_core", "enso_core", "assemble_features", "aggregated_dataset",
    "tail_error_report", "season_metrics", "apply_vocab", "target_association", "spearman_pairs", "fit_ridge",
]


def names():
    from __spark_entry__ import oracle_sql, queries

    return list(queries()) if os.environ.get("CHECK_ALL") else [n for n in SOME if n in oracle_sql()]


@pytest.mark.parametrize("name", names())
def test_query(spark, name):
    from __spark_entry__ import oracle_sql, queries

    got = queries()[name](spark, SF).toPandas()
    if name in oracle_sql():
        assert compare(got, duck(SF).execute(oracle_sql()[name]).df()) == ""


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
