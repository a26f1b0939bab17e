"""Queries over feature diagnostics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..config import KEY
from ..operators import diagnose as dg, neighbours
from ..plans import diagnostics as plan
from ..sources.staging import staged_path
from . import oracle as o
from .feature_queries import TABLE_NUMBERS, TABLE_TEXT
from .registry import Views, query

NUMBERS = TABLE_NUMBERS
VARYING = [c for c in NUMBERS if c != "constant"]
SPLITS = ("train", "validation", "test")

o.CTES["fm"] = "SELECT * FROM feature_matrix WHERE tch IS NOT NULL"
o.CTES["tall"] = " UNION ALL ".join(f"SELECT {KEY}, split, tch AS y, '{c}' AS feature, {c} AS x FROM fm" for c in NUMBERS)
o.CTES["presence"] = " UNION ALL ".join(
    f"SELECT split, '{c}' AS feature, {c} IS NULL AS gone, '{'double' if c in NUMBERS else 'string'}' AS dtype FROM fm"
    for c in [*NUMBERS, *TABLE_TEXT]
)


def _share(where: str) -> str:
    return f"count(*) FILTER (gone AND {where}) / (count(*) FILTER ({where}))::DOUBLE"


def _have(where: str) -> str:
    return f"count(*) FILTER (NOT gone AND {where})"


o.CTES["missing"] = (
    f"SELECT feature, {_share(_t := 'split = ' + repr('train'))} AS missing_rate, {_have(_t)} AS non_null_count, "
    f"{_share('true')} AS overall_missing_rate, {_have('true')} AS overall_non_null_count, any_value(dtype) AS dtype, "
    + ", ".join(f"{_share(f'split = {s!r}')} AS {s}_missing_rate, {_have(f'split = {s!r}')} AS {s}_non_null_count" for s in SPLITS)
    + " FROM presence GROUP BY feature"
)
MISSING_NAMES = ["missing_rate", "overall_missing_rate", *[f"{s}_missing_rate" for s in SPLITS]]
_AGG = ", ".join(
    f"{fn}(x) FILTER (split = '{s}') AS {s}_{name}"
    for s in SPLITS for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("variance", "var_samp"))
) + ", " + ", ".join(f"count(DISTINCT x) FILTER (split = '{s}') AS {s}_unique_count" for s in SPLITS)
o.CTES["split_moments"] = f"SELECT feature, {_AGG} FROM tall GROUP BY feature"
o.CTES["stability"] = """SELECT feature, train_mean, train_std, validation_mean, validation_std, test_mean, test_std,
 (validation_mean - train_mean) / nullif(train_std, 0) AS validation_mean_shift_std, (test_mean - train_mean) / nullif(train_std, 0) AS test_mean_shift_std,
 greatest(abs(validation_mean_shift_std), abs(test_mean_shift_std)) AS max_abs_mean_shift_std FROM split_moments"""
STABILITY_NAMES = [f"{s}_{n}" for s in SPLITS for n in ("mean", "std")] + [
    "validation_mean_shift_std", "test_mean_shift_std", "max_abs_mean_shift_std",
]
o.CTES["variances"] = """SELECT feature, train_variance AS variance, train_std AS std, train_unique_count AS unique_count, train_variance <= 1e-8 AS near_zero_variance,
 train_variance, validation_variance, test_variance, train_std, validation_std, test_std, train_unique_count, validation_unique_count, test_unique_count FROM split_moments"""
VARIANCE_NAMES = ["variance", "std", *[f"{s}_{n}" for s in SPLITS for n in ("variance", "std")]]

o.CTES["ranked"] = """SELECT *, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
 rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry,
 count(*) OVER (PARTITION BY feature) AS n FROM tall WHERE split = 'train' AND x IS NOT NULL"""
o.CTES["cells"] = """SELECT feature, n, least(15, floor((rx - 0.5) * 16 / n)) AS bx, least(15, floor((ry - 0.5) * 16 / n)) AS by_, count(*) AS c FROM ranked GROUP BY ALL"""
o.CTES["info"] = """SELECT feature, sum(c / n::DOUBLE * ln(c * n::DOUBLE / (cx * cy))) AS mutual_info FROM (
 SELECT *, sum(c) OVER (PARTITION BY feature, bx) AS cx, sum(c) OVER (PARTITION BY feature, by_) AS cy FROM cells) GROUP BY feature"""
o.CTES["assoc"] = """SELECT feature, pearson, ifnull(abs(pearson), 0) AS pearson_abs, spearman, ifnull(abs(spearman), 0) AS spearman_abs, valid_count, unique_count,
 'train' AS reference_split, mi AS mutual_info, greatest(pearson_abs, spearman_abs, mi) AS target_association_score FROM (
 SELECT feature, CASE WHEN count(DISTINCT x) > 1 THEN corr(x, y) END AS pearson, CASE WHEN count(DISTINCT x) > 1 THEN corr(rx, ry) END AS spearman,
 count(*) AS valid_count, count(DISTINCT x) AS unique_count, CASE WHEN count(DISTINCT x) > 1 THEN any_value(mutual_info) ELSE 0 END AS mi
 FROM ranked JOIN info USING (feature) GROUP BY feature)"""
ASSOC_NAMES = ["pearson", "pearson_abs", "spearman", "spearman_abs", "mutual_info", "target_association_score"]


def _pair(a: str, b: str, corr: str) -> str:
    return f"SELECT '{min(a, b)}' AS feature_a, '{max(a, b)}' AS feature_b, abs({corr}) AS abs_corr FROM fm WHERE split = 'train'"


def _rank(a: str, b: str) -> str:
    def r(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return (
        f"SELECT '{min(a, b)}' AS feature_a, '{max(a, b)}' AS feature_b, abs(corr(ra, rb)) AS abs_corr FROM ("
        f"SELECT {r(a)} AS ra, {r(b)} AS rb FROM fm WHERE split = 'train' AND {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


o.CTES["all_pairs"] = " UNION ALL ".join(_pair(a, b, f"corr({a}, {b})") for a, b in combinations(VARYING, 2))
o.CTES["rank_pairs"] = " UNION ALL ".join(_rank(a, b) for a, b in combinations(VARYING, 2))
o.CTES["strong_pairs"] = "SELECT * FROM all_pairs WHERE abs_corr >= 0.9"


def matrix(v: Views):
    return v.feature_matrix.where("tch IS NOT NULL")


def by_name(pairs):
    """Pairs with the smaller name first: equal variances leave the order of a pair open."""
    return pairs.withColumns(
        {"feature_a": F.least("feature_a", "feature_b"), "feature_b": F.greatest("feature_a", "feature_b")}
    )


@query("missing_rate", "SELECT * FROM missing", MISSING_NAMES)
def _(v):
    return dg.missing_rate(matrix(v), [*NUMBERS, *TABLE_TEXT])


@query("split_stability", "SELECT * FROM stability", STABILITY_NAMES)
def _(v):
    return dg.split_stability(matrix(v), NUMBERS)


@query("feature_variance", "SELECT * FROM variances", VARIANCE_NAMES)
def _(v):
    return dg.feature_variance(matrix(v), NUMBERS)


@query("target_association", "SELECT * FROM assoc", ASSOC_NAMES)
def _(v):
    return dg.target_association(matrix(v), NUMBERS, "tch")


@query("neighbour_mutual_info")
def _(v):
    """By three nearest neighbours; distances of all pairs are beyond a statement, so the test compares it on a small table."""
    return neighbours.neighbour_mutual_info(v.feature_matrix.where("split = 'train' AND tch IS NOT NULL"), NUMBERS, "tch")


@query("binned_mutual_info", "SELECT * FROM info", ["mutual_info"])
def _(v):
    train = matrix(v).where("split = 'train'")
    ranked = dg.rank_target(dg.value_pairs(train, NUMBERS, "tch"), ["feature"], "y")
    return dg.binned_mutual_info(dg.ranked_values(ranked, ["feature"], "x", dg.BINS))


@query(
    "topk_features",
    "SELECT feature, round(train_variance, 6) AS variance FROM split_moments WHERE train_variance > 0 ORDER BY variance DESC, feature LIMIT 5",
    ["variance"],
)
def _(v):
    return dg.top_variance(matrix(v), NUMBERS).select("feature", F.round("variance", 6).alias("variance")).orderBy(
        F.desc("variance"), "feature"
    ).limit(5)


@query("stable_sample", f"SELECT {KEY}, tch, ndvi_peak FROM feature_matrix ORDER BY md5('42:' || {KEY}), {KEY} LIMIT 500", ["tch", "ndvi_peak"])
def _(v):
    return dg.stable_sample(v.feature_matrix.select(KEY, "tch", "ndvi_peak"), KEY, 500)


@query("correlation_pairs", "SELECT * FROM strong_pairs", ["abs_corr"])
def _(v):
    return by_name(dg.correlation_pairs(matrix(v), NUMBERS, 0.9))


@query("spearman_pairs", "SELECT * FROM rank_pairs WHERE abs_corr >= 0.01", ["abs_corr"])
def _(v):
    return by_name(dg.spearman_pairs(matrix(v), KEY, NUMBERS, 0.01))


def _minmax(c: str, up: bool = True, frame: str = "") -> str:
    share = f"({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0)"
    return f"ifnull({share if up else f'1 - {share}'}, 0)"


@query(
    "minmax_score",
    f"SELECT feature, {_minmax('missing_rate', False)} AS fewer_gaps, {_minmax('non_null_count')} AS coverage FROM missing",
    ["fewer_gaps", "coverage"],
)
def _(v):
    rows = dg.missing_rate(matrix(v), [*NUMBERS, *TABLE_TEXT])
    return rows.select(
        "feature", dg.minmax_score(rows, "missing_rate", False).alias("fewer_gaps"),
        dg.minmax_score(rows, "non_null_count").alias("coverage"),
    )


o.CTES["reach"] = """WITH RECURSIVE walk(a, b) AS (
 SELECT feature_a, feature_b FROM strong_pairs UNION SELECT feature_b, feature_a FROM strong_pairs
 UNION SELECT feature_a, feature_a FROM strong_pairs UNION SELECT feature_b, feature_b FROM strong_pairs
 UNION SELECT w.a, e.o FROM walk w JOIN (SELECT feature_a AS i, feature_b AS o FROM strong_pairs UNION ALL SELECT feature_b, feature_a FROM strong_pairs) e ON e.i = w.b)
 SELECT a AS feature, min(b) AS root FROM walk GROUP BY a"""
o.CTES["evidence"] = f"""SELECT r.feature, r.root, dense_rank() OVER (ORDER BY r.root) AS cluster_id, count(*) OVER (PARTITION BY r.root) AS cluster_size,
 a.target_association_score, a.spearman_abs, a.mutual_info, m.missing_rate, m.non_null_count, s.max_abs_mean_shift_std,
 (SELECT max(abs_corr) FROM strong_pairs p WHERE r.feature IN (p.feature_a, p.feature_b)) AS max_abs_corr_to_cluster,
 0.55 * {_minmax('a.target_association_score')} + 0.2 * {_minmax('m.missing_rate', False)} + 0.15 * {_minmax('s.max_abs_mean_shift_std', False)}
 + 0.1 * {_minmax('m.non_null_count')} AS selection_score
 FROM reach r JOIN assoc a USING (feature) JOIN missing m USING (feature) JOIN stability s USING (feature)"""
o.CTES["clusters"] = """SELECT cluster_id, feature, keep AS recommended_keep_feature, feature = keep AS is_recommended_keep, feature <> keep AS drop_recommended, cluster_size,
 target_association_score, spearman_abs, mutual_info, missing_rate, non_null_count, max_abs_mean_shift_std, selection_score, max_abs_corr_to_cluster FROM (
 SELECT *, first_value(feature) OVER (PARTITION BY root ORDER BY round(selection_score, 9) DESC, round(target_association_score, 9) DESC, missing_rate, max_abs_mean_shift_std, feature) AS keep FROM evidence)"""
CLUSTER_NAMES = [
    "target_association_score", "spearman_abs", "mutual_info", "missing_rate", "max_abs_mean_shift_std", "selection_score",
    "max_abs_corr_to_cluster",
]


def parts(v: Views) -> plan.Diagnostics:
    return plan.diagnose(matrix(v), KEY, "tch", NUMBERS, TABLE_TEXT, threshold=0.9)


@query("correlation_clusters", "SELECT * FROM clusters", CLUSTER_NAMES)
def _(v):
    df = matrix(v)
    return dg.correlation_clusters(
        dg.correlation_pairs(df, NUMBERS, 0.9), dg.missing_rate(df, NUMBERS), dg.split_stability(df, NUMBERS),
        dg.target_association(df, NUMBERS, "tch"),
    )


# ---- interactions
_FILLED = ", ".join(f"ifnull({c}, median({c}) OVER ()) AS {c}" for c in VARYING)
o.CTES["filled"] = f"SELECT tch AS y, {_FILLED} FROM fm WHERE split = 'train'"
o.CTES["units"] = "SELECT y, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in VARYING) + " FROM filled"
o.CTES["products"] = "SELECT *, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM units"


def _product(a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(rx, ry) AS s FROM (SELECT ry, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx"
        f" FROM (SELECT ry, round({a} * {b}, 9) AS x FROM products))"
    )


o.CTES["gains"] = " UNION ALL ".join(_product(*sorted(p)) for p in combinations(VARYING, 2))
o.CTES["interactions"] = """SELECT feature_a, feature_b, s AS interaction_spearman, abs(s) AS interaction_spearman_abs,
 greatest(a.spearman_abs, b.spearman_abs) AS best_individual_spearman_abs, interaction_spearman_abs - best_individual_spearman_abs AS interaction_gain
 FROM gains JOIN assoc a ON a.feature = feature_a JOIN assoc b ON b.feature = feature_b"""
INTERACTION_NAMES = ["interaction_spearman", "interaction_spearman_abs", "best_individual_spearman_abs", "interaction_gain"]


@query("interaction_candidates", "SELECT * FROM interactions", INTERACTION_NAMES, 4)
def _(v):
    df = matrix(v)
    return by_name(dg.interaction_candidates(df, "tch", dg.target_association(df, NUMBERS, "tch")))


# ---- recommendations
o.CTES["involved"] = """SELECT DISTINCT unnest([feature_a, feature_b]) AS feature FROM (SELECT * FROM interactions WHERE interaction_gain > 0.02
 ORDER BY interaction_gain DESC, interaction_spearman_abs DESC, feature_a, feature_b LIMIT 100)"""
o.CTES["sets"] = """SELECT m.*, s.max_abs_mean_shift_std, v.* EXCLUDE (feature, train_std, validation_std, test_std), a.target_association_score, a.spearman_abs, a.mutual_info,
 c.cluster_id, c.recommended_keep_feature, c.selection_score, ifnull(m.missing_rate >= 0.95, false) AS high_missing, ifnull(s.max_abs_mean_shift_std >= 3, false) AS unstable,
 ifnull(v.near_zero_variance, false) AS near_zero, ifnull(c.drop_recommended, false) AS correlated,
 ifnull(a.target_association_score <= 0.01 AND a.valid_count >= 100, false) AS low_signal, i.feature IS NOT NULL AS interaction
 FROM missing m LEFT JOIN stability s USING (feature) LEFT JOIN variances v USING (feature) LEFT JOIN assoc a USING (feature) LEFT JOIN clusters c USING (feature)
 LEFT JOIN involved i USING (feature)"""
o.CTES["advice"] = """SELECT feature, CASE WHEN high_missing THEN 'drop_high_missing' WHEN near_zero THEN 'drop_near_zero_variance' WHEN correlated THEN 'drop_correlated_redundant'
 WHEN unstable THEN 'review_unstable' WHEN low_signal THEN 'review_low_target_signal' ELSE 'review_interaction_candidate' END AS recommendation,
 concat_ws(';', CASE WHEN high_missing THEN 'missing_rate>=0.95' END, CASE WHEN unstable THEN 'split_mean_shift>=3_train_std' END,
 CASE WHEN near_zero THEN 'near_zero_variance' END, CASE WHEN correlated THEN 'correlated_cluster_redundant_candidate' END,
 CASE WHEN low_signal THEN 'low_univariate_target_signal' END, CASE WHEN interaction THEN 'interaction_candidate' END) AS reasons,
 * EXCLUDE (feature, dtype, high_missing, unstable, near_zero, correlated, low_signal, interaction) FROM sets
 WHERE high_missing OR unstable OR near_zero OR correlated OR low_signal OR interaction"""
ADVICE_NAMES = [
    *MISSING_NAMES, "max_abs_mean_shift_std", "variance", "std", *[f"{s}_variance" for s in SPLITS],
    "target_association_score", "spearman_abs", "mutual_info", "selection_score",
]


@query(
    "feature_sets",
    "SELECT feature, high_missing, unstable, near_zero, correlated, low_signal, interaction FROM sets",
)
def _(v):
    return parts(v).sets.select(
        "feature", "high_missing", "unstable", "near_zero", "correlated", "low_signal", "interaction"
    )


@query("pruning_recommendations", "SELECT * FROM advice", ADVICE_NAMES, 4)
def _(v):
    return parts(v).reports["feature_pruning_recommendations"]


_REPORTS = {
    "feature_missing_rate": "missing", "feature_stability_by_split": "stability", "feature_variance": "variances",
    "feature_univariate_target_association": "assoc", "feature_correlation_pairs": "strong_pairs",
    "feature_spearman_correlation_pairs": "rank_pairs WHERE abs_corr >= 0.9", "feature_correlation_clusters": "clusters",
    "feature_interaction_candidates": "interactions", "feature_pruning_recommendations": "advice",
}


@query("feature_diagnostics", " UNION ALL ".join(f"SELECT '{name}' AS report, count(*) AS rows FROM {cte}" for name, cte in _REPORTS.items()))
def _(v):
    """Write every report and count its rows from the files."""
    paths = plan.write(parts(v), staged_path(v.spark, "diagnostics"))
    counts = None
    for name, path in paths.items():
        rows = v.spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.select(F.lit(name).alias("report"), "rows")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts
