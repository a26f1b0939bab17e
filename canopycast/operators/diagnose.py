"""Diagnostics of feature columns: gaps, drift, variance, association, redundancy, interactions.

Inputs are wide: one row per key with ``split``, a target and feature columns. Statistics of all
columns come from one aggregate; only tables with one row per feature or pair leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.weighted import correlation
from ..sources.staging import staged
from .ranks import exact_quantiles, running_counts, running_totals
from .splits import MAIN_SPLITS

# Thresholds of the reports.
NEAR_ZERO_VARIANCE = 1e-8
MIN_CORRELATION = 0.98
TOP_INTERACTIONS = 30
MIN_GAIN = 0.02
HIGH_MISSING = 0.95
UNSTABLE_SHIFT = 3.0
LOW_SIGNAL = 0.01
LOW_SIGNAL_ROWS = 100
SCORE_WEIGHTS = {"association": 0.55, "missing": 0.20, "stability": 0.15, "coverage": 0.10}

BINS = 16
COLUMNS_PER_AGG = 250


def quoted(name: str) -> str:
    """A column name within SQL text."""
    return "`" + name.replace("`", "``") + "`"


def wide_stats(df: DataFrame, keys: Sequence[str], columns: Sequence[str], stats: Mapping[str, str]) -> DataFrame:
    """Aggregate every column with the same SQL templates and return one row per group and column.

    Very wide inputs are handled in batches, so that generated code stays within its size limit.
    """
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_AGG):
        batch = columns[start : start + COLUMNS_PER_AGG]
        wide = df.groupBy(*keys).agg(
            *[F.expr(sql.format(c=quoted(c))).alias(f"{name}__{i}") for i, c in enumerate(batch) for name, sql in stats.items()]
        )
        structs = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{name}__{i}").alias(name) for name in stats]) for i, c in enumerate(batch)]
        parts.append(wide.select(*keys, F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, parts)


def per_split(values: Mapping[str, Column]) -> list[Column]:
    """One column per main split and value."""
    return [
        F.max(F.when(F.col("split") == split, value)).alias(f"{split}_{name}")
        for name, value in values.items()
        for split in MAIN_SPLITS
    ]


def missing_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing share and count of values per feature, by split and over all rows."""
    counts = wide_stats(df, ["split"], columns, {"values": "count({c})", "rows": "count(1)"})
    rate = 1 - F.col("values") / F.col("rows")
    dtypes = F.create_map(*[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())])
    result = counts.groupBy("feature").agg(
        *per_split({"missing_rate": rate}),
        *[
            F.coalesce(F.sum(F.when(F.col("split") == s, F.col("values"))), F.lit(0)).alias(f"{s}_non_null_count")
            for s in MAIN_SPLITS
        ],
        (1 - F.sum("values") / F.sum("rows")).alias("overall_missing_rate"),
        F.sum("values").alias("overall_non_null_count"),
    )
    return result.select(
        "feature",
        F.col("train_missing_rate").alias("missing_rate"),
        F.col("train_non_null_count").alias("non_null_count"),
        "overall_missing_rate",
        "overall_non_null_count",
        dtypes[F.col("feature")].alias("dtype"),
        *[f"{s}_missing_rate" for s in MAIN_SPLITS],
        *[f"{s}_non_null_count" for s in MAIN_SPLITS],
    )


def moments(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and sample variance per split and feature."""
    stats = {"mean": "avg({c})", "std": "stddev_samp({c})", "variance": "var_samp({c})"}
    return wide_stats(df.where(F.col("split").isin(*MAIN_SPLITS)), ["split"], numeric, stats)


def split_stability(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Shift of the validation and test mean in training standard deviations."""
    rows = moments(df, numeric)
    wide = rows.groupBy("feature").agg(*per_split({"mean": F.col("mean"), "std": F.col("std")}))
    shifts = {
        f"{s}_mean_shift_std": F.try_divide(F.col(f"{s}_mean") - F.col("train_mean"), F.col("train_std"))
        for s in ("validation", "test")
    }
    largest = F.greatest(*[F.abs(F.col(name)) for name in shifts])
    return wide.withColumns(shifts).withColumn("max_abs_mean_shift_std", largest)


def feature_variance(df: DataFrame, numeric: Sequence[str], threshold: float = NEAR_ZERO_VARIANCE) -> DataFrame:
    """Variance, deviation and number of distinct values per split; flag of near constant features."""
    rows = moments(df, numeric)
    wide = rows.groupBy("feature").agg(*per_split({"variance": F.col("variance"), "std": F.col("std")}))
    tall = df.where(F.col("split").isin(*MAIN_SPLITS)).select("split", *[F.col(c).cast("double").alias(c) for c in numeric])
    tall = tall.unpivot(["split"], list(numeric), "feature", "value").where(F.col("value").isNotNull())
    # two plain aggregations: distinct values first, then their number
    unique = tall.groupBy("feature", "split", "value").agg(F.lit(1).alias("_one")).groupBy("feature").agg(
        *[F.count(F.when(F.col("split") == s, 1)).alias(f"{s}_unique_count") for s in MAIN_SPLITS]
    )
    counts = [f"{s}_unique_count" for s in MAIN_SPLITS]
    joined = wide.join(unique, "feature", "left").fillna(0, counts)
    return joined.select(
        "feature",
        F.col("train_variance").alias("variance"),
        F.col("train_std").alias("std"),
        F.col("train_unique_count").alias("unique_count"),
        F.coalesce(F.col("train_variance") <= threshold, F.lit(False)).alias("near_zero_variance"),
        *[f"{s}_{name}" for name in ("variance", "std") for s in MAIN_SPLITS],
        *counts,
    )


# ---------------------------------------------------------------- association with the target


def rank_target(rows: DataFrame, keys: list[str], y: str) -> DataFrame:
    """Add ``ry``, the average rank of the target within the group, and ``rows_y``, the group size.

    ``rows`` has one row per group and value pair with their number ``n``.
    """
    counts = rows.groupBy(*keys, y).agg(F.sum("n").alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("rows_y"))
    ranked = running_counts(counts, keys, y).select(
        *keys, y, (F.col("before") + (F.col("n") + 1) / 2).alias("ry")
    )
    return rows.join(ranked.join(totals, keys), [*keys, y])


def target_ranks(df: DataFrame, numeric: Sequence[str], y: str) -> DataFrame:
    """Rows of each feature with both values present: (feature, x, n, ry, rows_y), as :func:`rank_target` makes them.

    Rows stay wide until they have their ranks. The distinct target values are counted once, with the rows that each feature has
    there, and all features share one order of them, so neither shuffle has a row per feature.
    """
    parts = []
    for start in range(0, len(numeric), COLUMNS_PER_AGG):
        batch = numeric[start : start + COLUMNS_PER_AGG]
        rows = df.where(F.col(quoted(y)).isNotNull()).select(
            F.col(quoted(y)).cast("double").alias("y"), *[F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(batch)]
        )
        names = [f"n{i}" for i in range(len(batch))]
        counts = staged(rows.groupBy("y").agg(*[F.count(f"x{i}").alias(n) for i, n in enumerate(names)]), "target-values")
        totals = counts.agg(*[F.sum(n).alias(n) for n in names]).first()  # one number per column
        ranks = running_totals(counts, "y", names).select(
            "y", *[(F.col(f"before_{n}") + (F.col(n) + 1) / 2).alias(f"r{i}") for i, n in enumerate(names)]
        )
        structs = [
            F.struct(
                F.lit(c).alias("feature"), F.col(f"x{i}").alias("x"), F.lit(1).alias("n"), F.col(f"r{i}").alias("ry"),
                F.lit(totals[i] or 0).cast("long").alias("rows_y"),
            )
            for i, c in enumerate(batch)
        ]
        parts.append(rows.join(ranks, "y").select(F.inline(F.array(*structs))).where(F.col("x").isNotNull()))
    return reduce(DataFrame.unionByName, parts)


def ranked_values(rows: DataFrame, keys: list[str], x: str, bins: int = 0) -> DataFrame:
    """Sums over each group that Spearman's correlation of ``x`` with a target of rank ``ry`` needs, by rank bin of ``x``.

    Grouped by value of ``x`` before ranking, sums over the target are all that is needed of it, so no rank is joined back to the
    rows. With ``bins`` there is one row per group and bin, with the rows in each target bin; without, one per group.
    """
    n, ry = F.col("n"), F.col("ry")
    target = rank_bin(ry, F.col("rows_y"), bins) if bins else None
    cells = [F.sum(F.when(target == b, n).otherwise(0)).alias(f"_b{b}") for b in range(bins)]
    own = [*keys, "rows_y"] if bins else list(keys)
    by_value = rows.groupBy(*own, x).agg(F.sum(n).alias("n"), F.sum(n * ry).alias("_y"), F.sum(n * ry * ry).alias("_yy"), *cells)
    # written once, as the limits of the ranges and the ranges themselves read it
    by_value = staged(by_value, "by-value")
    rx = F.col("before") + (F.col("n") + 1) / 2
    ranked = running_counts(by_value, own, x).withColumn("rx", rx)
    at = [rank_bin(F.col("rx"), F.col("rows_y"), bins).alias("bx")] if bins else []
    return ranked.groupBy(*own, *at).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("rx")).alias("_x"), F.sum(n * F.col("rx") * F.col("rx")).alias("_xx"),
        F.sum(F.col("rx") * F.col("_y")).alias("_xy"), F.sum("_y").alias("_y"), F.sum("_yy").alias("_yy"),
        F.count(F.lit(1)).alias("unique_count"), *[F.sum(f"_b{b}").alias(f"_b{b}") for b in range(bins)],
    )


def rank_correlation(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Spearman correlation of each group of :func:`ranked_values`."""
    names = ("n", "_x", "_y", "_xx", "_yy", "_xy")
    whole = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*names, "unique_count")])
    return whole.select(*keys, "n", "unique_count", correlation(*[F.col(c) for c in names]).alias("spearman"))


def value_pairs(df: DataFrame, numeric: Sequence[str], y: str) -> DataFrame:
    """Rows per feature, feature value and target value, both present: (feature, x, y, n)."""
    rows = df.where(F.col(y).isNotNull()).select(
        F.col(y).cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in numeric]
    )
    tall = rows.unpivot(["y"], list(numeric), "feature", "x").where(F.col("x").isNotNull())
    return tall.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n"))


def rank_bin(rank: Column, rows: Column, bins: int) -> Column:
    """Bin of an average rank when the rows are cut into ``bins`` parts of even size."""
    return F.least(F.floor((rank - 0.5) * bins / rows), F.lit(bins - 1)).cast("int")


def binned_mutual_info(cells: DataFrame, bins: int = BINS) -> DataFrame:
    """Mutual information of feature and target in nats, both cut into rank bins, from :func:`ranked_values`."""
    cells = cells.select(
        "feature", "rows_y", "bx", F.posexplode(F.array(*[F.col(f"_b{b}") for b in range(bins)])).alias("by", "c")
    )
    row = F.sum("c").over(Window.partitionBy("feature", "bx"))
    column = F.sum("c").over(Window.partitionBy("feature", "by"))
    term = F.when(
        F.col("c") > 0, F.col("c") / F.col("rows_y") * F.log(F.col("c") * F.col("rows_y") / (F.col("row") * F.col("col")))
    )
    return cells.withColumns({"row": row, "col": column}).groupBy("feature").agg(
        F.coalesce(F.sum(term), F.lit(0.0)).alias("mutual_info")
    )


def target_association(df: DataFrame, numeric: Sequence[str], y: str, bins: int = BINS) -> DataFrame:
    """Pearson, Spearman and mutual information of each feature with the target, on training rows."""
    train = df.where(F.col("split") == "train")
    pearson = wide_stats(
        train, [], numeric,
        {
            "valid_count": f"count(CASE WHEN {quoted(y)} IS NOT NULL THEN {{c}} END)",
            "_cov": f"covar_samp({{c}}, {quoted(y)})",
            "_sx": f"stddev_samp({{c}}) FILTER (WHERE {quoted(y)} IS NOT NULL)",
            "_sy": f"stddev_samp({quoted(y)}) FILTER (WHERE {{c}} IS NOT NULL)",
        },
    ).withColumn("pearson", F.try_divide("_cov", F.col("_sx") * F.col("_sy")))
    # target and feature are ranked once each; what is left are rows by feature and rank bin
    ranked = staged(ranked_values(target_ranks(train, numeric, y), ["feature"], "x", bins), "ranked")
    spearman = rank_correlation(ranked, ["feature"]).drop("n")
    joined = pearson.join(spearman, "feature", "left").join(binned_mutual_info(ranked, bins), "feature", "left")
    enough = (F.col("valid_count") >= 3) & (F.col("unique_count") > 1)

    def size(name: str) -> Column:
        return F.coalesce(F.abs(F.col(name)), F.lit(0.0))

    rows = joined.withColumns({name: F.when(enough, F.col(name)) for name in ("pearson", "spearman")})
    mutual = F.when(enough, F.col("mutual_info")).otherwise(0.0)
    return rows.select(
        "feature",
        "pearson",
        size("pearson").alias("pearson_abs"),
        "spearman",
        size("spearman").alias("spearman_abs"),
        "valid_count",
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        F.lit("train").alias("reference_split"),
        mutual.alias("mutual_info"),
        F.greatest(size("spearman"), size("pearson"), mutual).alias("target_association_score"),
    )


def by_association(association: DataFrame) -> DataFrame:
    """Features in report order, strongest first."""
    return association.orderBy(
        F.col("target_association_score").desc_nulls_last(), F.col("spearman_abs").desc_nulls_last(),
        F.col("mutual_info").desc_nulls_last(), "feature",
    )


def top_variance(df: DataFrame, numeric: Sequence[str], n: int | None = None) -> DataFrame:
    """The features that vary among training rows, those that vary most first; with ``n`` only so many."""
    rows = wide_stats(df.where(F.col("split") == "train"), [], numeric, {"variance": "var_samp({c})", "mean": "avg({c})"})
    rows = rows.where(F.col("variance") > 0).orderBy(F.desc("variance"), "feature")
    return rows if n is None else rows.limit(n)


def stable_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The same ``n`` rows whatever the partitioning: the smallest md5 of seed and key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), F.col(key)).limit(n)


# ---------------------------------------------------------------- redundancy


def pair_sums(df: DataFrame, columns: Sequence[str], centre: Sequence[float], scale: Sequence[float]) -> DataFrame:
    """Sums over the rows where both columns of a pair are present, for all pairs of columns.

    Each task multiplies its rows as matrices and sends one row per pair, whatever the number of rows.
    """
    width = len(columns)
    left, right = np.triu_indices(width, 1)
    centre_, scale_ = np.asarray(centre, dtype=float), np.asarray(scale, dtype=float)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sx, sxx, sxy = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            x = (batch.to_numpy(dtype=float, na_value=np.nan) - centre_) / scale_
            mask = np.isfinite(x)
            x = np.where(mask, x, 0.0)
            present = mask.astype(float)
            n += present.T @ present
            sx += x.T @ present
            sxx += (x * x).T @ present
            sxy += x.T @ x
        yield pd.DataFrame(
            {
                "i": left, "j": right, "n": n[left, right], "sx": sx[left, right], "sy": sx[right, left],
                "sxx": sxx[left, right], "syy": sxx[right, left], "sxy": sxy[left, right],
            }
        )

    numbers = df.select(*[F.col(f"`{c}`").cast("double") for c in columns])
    sums = numbers.mapInPandas(multiply, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    total = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(
        F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"), "n",
        correlation(*[F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]).alias("corr"),
    )


def _chosen(df: DataFrame, numeric: Sequence[str], max_features: int | None) -> list[tuple[str, float, float]]:
    """Name, mean and deviation of the features to pair: one number set per column on the driver."""
    rows = top_variance(df, numeric, max_features).collect()
    return [(r["feature"], r["mean"], r["variance"] ** 0.5) for r in rows]


def _strong(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.select("feature_a", "feature_b", F.abs("corr").alias("abs_corr")).where(F.col("abs_corr") >= threshold)


_EMPTY_PAIRS = "feature_a string, feature_b string, abs_corr double"


def correlation_pairs(
    df: DataFrame, numeric: Sequence[str], threshold: float = MIN_CORRELATION, max_features: int | None = None
) -> DataFrame:
    """Pairs of features whose absolute Pearson correlation reaches the threshold on training rows."""
    chosen = _chosen(df, numeric, max_features)
    if len(chosen) < 2:
        return df.sparkSession.createDataFrame([], _EMPTY_PAIRS)
    train = df.where(F.col("split") == "train")
    return _strong(pair_sums(train, *zip(*chosen)), threshold)


def spearman_pairs(
    df: DataFrame, key: str, numeric: Sequence[str], threshold: float = MIN_CORRELATION, max_features: int | None = None
) -> DataFrame:
    """Pairs of features whose absolute Spearman correlation reaches the threshold.

    Columns are ranked once. That is exact for two columns missing in the same rows; other pairs
    are ranked again on the rows where both are present.
    """
    chosen = [name for name, _, _ in _chosen(df, numeric, max_features)]
    spark = df.sparkSession
    if len(chosen) < 2:
        return spark.createDataFrame([], _EMPTY_PAIRS)
    train = df.where(F.col("split") == "train").select(key, *[F.col(c).cast("double").alias(c) for c in chosen])

    tall = train.unpivot([key], chosen, "feature", "x").where(F.col("x").isNotNull())
    counts = tall.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n"))
    ranks = running_counts(counts, ["feature"], "x").select(
        "feature", "x", (F.col("before") + (F.col("n") + 1) / 2).alias("r")
    )
    by_row = tall.join(ranks, ["feature", "x"]).groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("r"))).alias(c) for c in chosen]
    )
    stats = wide_stats(train, [], chosen, {"rows": "count({c})"}).collect()
    present = {r["feature"]: r["rows"] for r in stats}
    centre = [(present[c] + 1) / 2 for c in chosen]
    pairs = staged(pair_sums(by_row, chosen, centre, [max(1.0, present[c] / 3) for c in chosen]), "rank-pairs")

    sizes = F.create_map(*[F.lit(x) for c in chosen for x in (c, float(present[c]))])
    together = (F.col("n") == sizes[F.col("feature_a")]) & (F.col("n") == sizes[F.col("feature_b")])
    # pairs with gaps in different rows are ranked again, each on the rows where both are present
    apart = pairs.where(~together & (F.col("n") > 1)).select("feature_a", "feature_b")
    return _strong(pairs.where(together), threshold).unionByName(_strong(_ranked_pairs(train, chosen, staged(apart, "apart")), threshold))


def _ranked_pairs(rows: DataFrame, names: Sequence[str], pairs: DataFrame) -> DataFrame:
    """Spearman correlation of the ``pairs`` (``feature_a, feature_b``) over the rows where both are present, all in one plan.

    The list of pairs, at most the square of the number of columns, is one value that every row is held against.
    """
    index = F.create_map(*[F.lit(x) for k, c in enumerate(names) for x in (c, k)])
    wanted = pairs.select(F.struct(index[F.col("feature_a")].alias("a"), index[F.col("feature_b")].alias("b")).alias("p"))
    wanted = wanted.agg(F.sort_array(F.collect_list("p")).alias("pairs")).scalar()
    values = rows.select(F.array(*[F.col(quoted(c)) for c in names]).alias("v"))
    each = values.select("v", F.explode(wanted).alias("p")).select("p", F.get("v", F.col("p.a")).alias("y"), F.get("v", F.col("p.b")).alias("x"))
    joint = each.where("x IS NOT NULL AND y IS NOT NULL").groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"), "x", "y").agg(F.count(F.lit(1)).alias("n"))
    joint = staged(joint, "joint-values")
    found = rank_correlation(ranked_values(rank_target(joint, ["a", "b"], "y"), ["a", "b"], "x"), ["a", "b"])
    name = F.array(*[F.lit(c) for c in names])
    return found.select(F.get(name, F.col("a")).alias("feature_a"), F.get(name, F.col("b")).alias("feature_b"), F.col("spearman").alias("corr"))


def minmax_score(df: DataFrame, column: str, higher_is_better: bool = True) -> Column:
    """Column scaled to 0-1 over a table with one row per feature; missing values and constants are 0."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    score = F.try_divide(F.col(column) - low, high - low)
    return F.coalesce(score if higher_is_better else 1 - score, F.lit(0.0))


def connected_components(pairs: DataFrame) -> DataFrame:
    """Smallest member of the component of each feature: (feature, root).

    Labels move along edges and then jump to the label of their label, so the number of rounds
    grows with the logarithm of the longest chain. Each round is staged, which cuts the lineage.
    """
    edges = pairs.select(F.col("feature_a").alias("feature"), F.col("feature_b").alias("other"))
    edges = staged(edges.unionByName(edges.select(F.col("other").alias("feature"), F.col("feature").alias("other"))), "edges")
    labels = staged(edges.groupBy("feature").agg(F.least(F.col("feature"), F.min("other")).alias("root")), "labels")
    while True:
        near = edges.join(labels.withColumnsRenamed({"feature": "other", "root": "near"}), "other")
        moved = near.groupBy("feature").agg(F.min("near").alias("near")).join(labels, "feature").select(
            "feature", F.col("root").alias("before"), F.least("root", "near").alias("root")
        )
        jump = labels.select(F.col("feature").alias("root"), F.col("root").alias("jump"))
        step = staged(moved.join(jump, "root").select("feature", "before", F.least("root", "jump").alias("root")), "labels")
        if step.where(F.col("before") != F.col("root")).isEmpty():
            return step.select("feature", "root")
        labels = step.select("feature", "root")


def correlation_clusters(
    pairs: DataFrame, missing: DataFrame, stability: DataFrame, association: DataFrame
) -> DataFrame:
    """Groups of correlated features, each with the one worth keeping."""
    members = connected_components(pairs)
    evidence = (
        members.join(association.select("feature", "target_association_score", "spearman_abs", "mutual_info"), "feature", "left")
        .join(missing.select("feature", "missing_rate", "non_null_count"), "feature", "left")
        .join(stability.select("feature", "max_abs_mean_shift_std"), "feature", "left")
    )
    evidence = staged(evidence, "evidence")
    parts = {
        "association": minmax_score(evidence, "target_association_score"),
        "missing": minmax_score(evidence, "missing_rate", False),
        "stability": minmax_score(evidence, "max_abs_mean_shift_std", False),
        "coverage": minmax_score(evidence, "non_null_count"),
    }
    score = reduce(lambda a, b: a + b, [F.lit(SCORE_WEIGHTS[name]) * part for name, part in parts.items()])
    # one row per feature from here on
    roots = members.agg(F.array_sort(F.collect_set("root")).alias("roots")).select(
        F.posexplode("roots").alias("place", "root")
    )
    ends = pairs.select(F.col("feature_a").alias("feature"), "abs_corr").unionByName(
        pairs.select(F.col("feature_b").alias("feature"), "abs_corr")
    )
    closest = ends.groupBy("feature").agg(F.max("abs_corr").alias("max_abs_corr_to_cluster"))
    best = Window.partitionBy("root").orderBy(
        F.col("selection_score").desc_nulls_last(), F.col("target_association_score").desc_nulls_last(),
        F.col("missing_rate").asc_nulls_last(), F.col("max_abs_mean_shift_std").asc_nulls_last(), "feature",
    )
    cluster = Window.partitionBy("root")
    rows = evidence.withColumn("selection_score", score).withColumn("_place", F.row_number().over(best))
    rows = rows.withColumns(
        {
            "recommended_keep_feature": F.max(F.when(F.col("_place") == 1, F.col("feature"))).over(cluster),
            "cluster_size": F.count(F.lit(1)).over(cluster),
        }
    )
    keep = F.col("feature") == F.col("recommended_keep_feature")
    return rows.join(roots, "root").join(closest, "feature").select(
        (F.col("place") + 1).alias("cluster_id"),
        "feature",
        "recommended_keep_feature",
        keep.alias("is_recommended_keep"),
        (~keep).alias("drop_recommended"),
        "cluster_size",
        "target_association_score", "spearman_abs", "mutual_info", "missing_rate", "non_null_count",
        "max_abs_mean_shift_std", "selection_score", "max_abs_corr_to_cluster",
    )


# ---------------------------------------------------------------- interactions


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of each column; columns without values get 0. One number per column."""
    tall = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "x")
    found = exact_quantiles(tall, ["feature"], "x", {"median": 0.5}, ["feature"]).collect()
    return {c: 0.0 for c in columns} | {r["feature"]: r["median"] for r in found}


def interaction_candidates(
    df: DataFrame, y: str, association: DataFrame, top: int = TOP_INTERACTIONS, digits: int = 9
) -> DataFrame:
    """Products of strong features that say more about the target than either feature alone.

    Missing values take the median and columns are standardised first. Products that agree in
    ``digits`` decimals share a rank.
    """
    strongest = by_association(association).limit(top).collect()
    single = {r["feature"]: r["spearman_abs"] for r in strongest if r["unique_count"] > 1}
    names = list(single)
    schema = (
        "feature_a string, feature_b string, interaction_spearman double, interaction_spearman_abs double, "
        "best_individual_spearman_abs double, interaction_gain double"
    )
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], schema)
    rows = df.where((F.col("split") == "train") & F.col(y).isNotNull()).select(
        F.col(y).cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in names]
    )
    middle = column_medians(rows, names)
    rows = rows.fillna(middle)
    stats = wide_stats(rows, [], names, {"mean": "avg({c})", "sd": "stddev_pop({c})"}).collect()
    scale = {r["feature"]: (r["mean"], r["sd"]) for r in stats if r["sd"]}
    usable = [c for c in names if c in scale]

    # the target is ranked once: every product has a value in every row
    ranked = rank_target(rows.withColumns({"n": F.lit(1), "_all": F.lit(0)}), ["_all"], "y")

    def unit(c: str) -> Column:
        mean, sd = scale[c]
        return (F.col(quoted(c)) - F.lit(float(mean))) / F.lit(float(sd))

    products = ranked.select(
        "ry", "n",
        F.inline(F.array(*[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.round(unit(a) * unit(b), digits).alias("x"))
            for a, b in combinations(usable, 2)
        ])),
    )
    found = rank_correlation(ranked_values(products, ["feature_a", "feature_b"], "x"), ["feature_a", "feature_b"])
    best = F.create_map(*[F.lit(x) for c in usable for x in (c, float(single[c] or 0.0))])
    alone = F.greatest(best[F.col("feature_a")], best[F.col("feature_b")])
    size = F.coalesce(F.abs("spearman"), F.lit(0.0))
    return found.where(F.col("n") >= 3).select(
        "feature_a",
        "feature_b",
        F.col("spearman").alias("interaction_spearman"),
        size.alias("interaction_spearman_abs"),
        alone.alias("best_individual_spearman_abs"),
        (size - alone).alias("interaction_gain"),
    )


# ---------------------------------------------------------------- recommendations

# Reason of each test, and recommendation by falling priority.
REASONS = {
    "high_missing": "missing_rate>=0.95",
    "unstable": "split_mean_shift>=3_train_std",
    "near_zero": "near_zero_variance",
    "correlated": "correlated_cluster_redundant_candidate",
    "low_signal": "low_univariate_target_signal",
    "interaction": "interaction_candidate",
}
RECOMMENDATIONS = {
    "high_missing": "drop_high_missing",
    "near_zero": "drop_near_zero_variance",
    "correlated": "drop_correlated_redundant",
    "unstable": "review_unstable",
    "low_signal": "review_low_target_signal",
    "interaction": "review_interaction_candidate",
}


def feature_sets(
    missing: DataFrame, stability: DataFrame, variance: DataFrame, clusters: DataFrame,
    association: DataFrame, interactions: DataFrame,
) -> DataFrame:
    """All evidence of each feature, with one boolean per test."""
    strong = interactions.where(F.col("interaction_gain") > MIN_GAIN)
    involved = strong.select(F.col("feature_a").alias("feature")).unionByName(
        strong.select(F.col("feature_b").alias("feature"))
    ).distinct().withColumn("interaction", F.lit(True))
    rows = (
        missing.join(stability.select("feature", "max_abs_mean_shift_std"), "feature", "left")
        .join(variance, "feature", "left")
        .join(association.select("feature", "target_association_score", "spearman_abs", "mutual_info", "valid_count"), "feature", "left")
        .join(clusters.select("feature", "cluster_id", "recommended_keep_feature", "selection_score", "drop_recommended"), "feature", "left")
        .join(involved, "feature", "left")
    )
    tests = {
        "high_missing": F.col("missing_rate") >= HIGH_MISSING,
        "unstable": F.col("max_abs_mean_shift_std") >= UNSTABLE_SHIFT,
        "near_zero": F.col("near_zero_variance"),
        "correlated": F.col("drop_recommended"),
        "low_signal": (F.col("target_association_score") <= LOW_SIGNAL) & (F.col("valid_count") >= LOW_SIGNAL_ROWS),
        "interaction": F.col("interaction"),
    }
    return rows.withColumns({name: F.coalesce(test, F.lit(False)) for name, test in tests.items()})


def pruning_recommendations(sets: DataFrame) -> DataFrame:
    """Features that failed a test, with recommendation, reasons and evidence."""
    recommendation = None
    for name, text in RECOMMENDATIONS.items():
        test = F.col(name)
        recommendation = F.when(test, text) if recommendation is None else recommendation.when(test, text)
    reasons = F.concat_ws(";", *[F.when(F.col(name), text) for name, text in REASONS.items()])
    evidence = [
        c for c in sets.columns
        if c not in ("feature", "dtype", "valid_count", "drop_recommended", *REASONS) and not (c.endswith("_std") and c != "max_abs_mean_shift_std")
    ]
    return sets.where(reduce(lambda a, b: a | b, [F.col(name) for name in REASONS])).select(
        "feature", recommendation.alias("recommendation"), reasons.alias("reasons"), *evidence
    )
