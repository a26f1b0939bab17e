"""Queries over boosted trees and statistics of the target; the statements play the fit through level by level."""

from __future__ import annotations

from ..config import KEY
from ..operators import attribution, boosting, encode, models
from . import oracle as o
from .registry import Views, query

NUMBERS, TEXTS = ["ndvi_peak", "rain_acc", "gap_mid", "trend"], ["prod_ingenio", "prod_variedad"]
COLUMNS = [*NUMBERS, *TEXTS]
SPLITS = {
    "max_depth": 2, "max_bins": 16, "learning_rate": 0.4, "reg_alpha": 0.5, "reg_lambda": 2.0, "min_samples_leaf": 15, "min_child_weight": 20.0,
}

# ---- statistics of the target: of the rows before in training, of all training rows in scoring
_TEXT = ", ".join(f"coalesce({c}, '{encode.MISSING}') AS {c}" for c in TEXTS)
o.CTES["bt_rows"] = f"SELECT row_number() OVER (ORDER BY {KEY}) AS r, {KEY}, split, tch, {', '.join(NUMBERS)}, {_TEXT} FROM feature_matrix"
o.CTES["bt_tall"] = f"SELECT r, {KEY}, split, tch, feature, category FROM bt_rows UNPIVOT (category FOR feature IN ({', '.join(TEXTS)}))"
o.CTES["bt_mean"] = "SELECT avg(tch) AS mean FROM bt_rows WHERE split = 'train'"
_BEFORE = f"OVER (PARTITION BY feature, category ORDER BY md5('42:' || {KEY}), tch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
o.CTES["bt_ordered"] = f"""SELECT r, feature, category, (coalesce(sum(tch) {_BEFORE}, 0) + mean) / (count(tch) {_BEFORE} + 1) AS x
FROM bt_tall, bt_mean WHERE split = 'train' AND tch IS NOT NULL"""
o.CTES["bt_known"] = "SELECT feature, category, sum(tch) AS total, count(*) AS n FROM bt_tall WHERE split = 'train' AND tch IS NOT NULL GROUP BY ALL"
o.CTES["bt_scored"] = """SELECT t.r, t.feature, t.category, CASE WHEN k.n IS NULL THEN mean ELSE (k.total + mean) / (k.n + 1) END AS x
FROM bt_tall t CROSS JOIN bt_mean LEFT JOIN bt_known k USING (feature, category)"""

# ---- values and ranges; training rows have negative numbers
_NUMBERS = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUMBERS)
_PLACE = " ".join(f"WHEN '{c}' THEN {k}" for k, c in enumerate(COLUMNS))
o.CTES["bt_values"] = f"""SELECT r, CASE feature {_PLACE} END AS f, CASE WHEN isnan(x) THEN NULL ELSE x END AS x FROM (
 SELECT r, feature, x FROM (SELECT r, {_NUMBERS} FROM bt_rows) UNPIVOT INCLUDE NULLS (x FOR feature IN ({', '.join(NUMBERS)}))
 UNION ALL SELECT -r, feature, x FROM (SELECT r, {_NUMBERS} FROM bt_rows WHERE split = 'train' AND tch IS NOT NULL) UNPIVOT INCLUDE NULLS (x FOR feature IN ({', '.join(NUMBERS)}))
 UNION ALL SELECT r, feature, x FROM bt_scored UNION ALL SELECT -r, feature, x FROM bt_ordered)"""
o.CTES["bt_limits"] = f"""SELECT f, list(DISTINCT x) AS edges FROM (
 SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS place, count(*) OVER (PARTITION BY f) AS n FROM bt_values WHERE r < 0 AND x IS NOT NULL
) JOIN (SELECT unnest(range(1, {SPLITS['max_bins']})) AS k) ON place = ceil(k * n / {SPLITS['max_bins']}.0) GROUP BY f"""
o.CTES["bt_bins"] = f"""SELECT r, v.f, CASE WHEN x IS NULL THEN 0 ELSE 1 + len(list_filter(edges, lambda e: e < x)) END AS bin, x
FROM bt_values v JOIN bt_limits USING (f)"""


def fit(name: str, trees: int, loss: str = "squared", alpha: float = 0.5) -> str:
    """Names the expressions of a fit and returns the one that holds the prediction ``p`` of every row ``r``."""
    s, rate = SPLITS, SPLITS["learning_rate"]
    at_place = f"greatest(1, ceil({alpha} * count(*) OVER ({{}}) - 1e-9))"
    if loss == "squared":
        slope, base = "p - tch", "SELECT mean AS p FROM bt_mean"
    else:
        slope = f"CASE WHEN tch - p > 0 THEN -{alpha} ELSE 1 - {alpha} END"
        base = f"SELECT tch AS p FROM bt_rows WHERE split = 'train' AND tch IS NOT NULL QUALIFY row_number() OVER (ORDER BY tch) = {at_place.format('')}"
    o.CTES[f"{name}_0"] = f"""SELECT r, tch, p FROM (SELECT r, tch FROM bt_rows UNION ALL SELECT -r, tch FROM bt_rows WHERE split = 'train' AND tch IS NOT NULL) CROSS JOIN ({base})"""
    lean = f"power(greatest(abs({{g}}) - {s['reg_alpha']}, 0), 2) / ({{n}} + {s['reg_lambda']})"
    least = max(s["min_samples_leaf"], s["min_child_weight"])
    gain = " + ".join(lean.format(g=f"g{k}", n=f"n{k}") for k in ("l", "r")) + " - " + lean.format(g="g", n="n")
    for tree in range(trees):
        here = f"{name}_t{tree}"
        o.CTES[f"{here}_0"] = f"SELECT r, 0 AS node, {slope} AS g FROM {name}_{tree}"
        for level in range(s["max_depth"]):
            at = f"{here}_{level}"
            o.CTES[f"{at}_sums"] = f"SELECT node, f, bin, sum(g) AS g, count(*) AS n FROM {at} JOIN bt_bins USING (r) WHERE r < 0 GROUP BY ALL"
            o.CTES[f"{at}_best"] = f"""SELECT * FROM (
 SELECT *, round(({gain}) / 2, {boosting.DIGITS}) AS gain FROM (
  SELECT node, f, bin, missing_left, g, n, g1 + g0 * missing_left::INT AS gl, n1 + n0 * missing_left::INT AS nl, g - gl AS gr, n - nl AS nr FROM (
   SELECT node, f, bin, sum(g) OVER w AS g, sum(n) OVER w AS n, coalesce(sum(g) FILTER (bin = 0) OVER w, 0) AS g0, coalesce(sum(n) FILTER (bin = 0) OVER w, 0) AS n0,
    sum(g) FILTER (bin > 0) OVER u AS g1, sum(n) FILTER (bin > 0) OVER u AS n1
   FROM {at}_sums WINDOW w AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY bin)
  ), (VALUES (true), (false)) AS m(missing_left) WHERE bin > 0 AND (missing_left OR n0 > 0)
 ) WHERE nl >= {least} AND nr >= {least}
) WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin, missing_left DESC) = 1"""
            o.CTES[f"{here}_{level + 1}"] = f"""SELECT a.r, a.g, CASE WHEN s.f IS NULL THEN a.node
 WHEN CASE WHEN b.bin = 0 THEN s.missing_left ELSE b.bin <= s.bin END THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
FROM {at} a LEFT JOIN {at}_best s USING (node) LEFT JOIN bt_bins b ON b.r = a.r AND b.f = s.f"""
        end = f"{here}_{s['max_depth']}"
        if loss == "squared":
            o.CTES[f"{here}_leaf"] = f"""SELECT node, -sign(sum(g)) * greatest(abs(sum(g)) - {s['reg_alpha']}, 0) / (count(*) + {s['reg_lambda']}) AS w
FROM {end} WHERE r < 0 GROUP BY node"""
        else:
            o.CTES[f"{here}_leaf"] = f"""SELECT node, tch - p AS w FROM {end} JOIN {name}_{tree} USING (r) WHERE r < 0
QUALIFY row_number() OVER (PARTITION BY node ORDER BY tch - p) = {at_place.format('PARTITION BY node')}"""
        o.CTES[f"{name}_{tree + 1}"] = f"SELECT r, tch, p + {rate} * w AS p FROM {name}_{tree} JOIN {end} USING (r) JOIN {here}_leaf USING (node)"
    return f"{name}_{trees}"


def train_rows(v: Views):
    return v.feature_matrix.where("split = 'train'")


@query(
    "target_statistics",
    f"SELECT {KEY}, 'training' AS rows, {', '.join(f'max(x) FILTER (feature = $${c}$$) AS {c}' for c in TEXTS)} FROM bt_ordered JOIN bt_rows USING (r) GROUP BY r, {KEY} "
    f"UNION ALL SELECT {KEY}, 'all', {', '.join(f'max(x) FILTER (feature = $${c}$$)' for c in TEXTS)} FROM bt_scored JOIN bt_rows USING (r) GROUP BY r, {KEY}",
    TEXTS,
)
def _(v):
    """Text columns as means of the target: over the training rows before each, and over all of them for every row."""
    rows = train_rows(v).where("tch IS NOT NULL")
    found = encode.category_statistics(rows, TEXTS, "tch")
    ordered = encode.ordered_statistics(rows.select(KEY, "tch", *TEXTS), TEXTS, "tch", KEY, found, part_rows=500)
    final = encode.apply_statistics(v.feature_matrix.select(KEY, *TEXTS), found, TEXTS)
    columns = [f"_stat_{c} AS {c}" for c in TEXTS]
    return ordered.selectExpr(KEY, "'training' AS rows", *columns).union(final.selectExpr(KEY, "'all' AS rows", *columns))


@query("fit_boosted", f"SELECT {KEY}, split, p AS pred_tch FROM {fit('bt', 3)} JOIN bt_rows USING (r)", ["pred_tch"], 5)
def _(v):
    """Three trees of depth two over numeric and text columns, fitted on the training seasons and scored on all rows."""
    fitted = models.fit_model(train_rows(v), COLUMNS, "tch", "boosted", {"n_estimators": 3, **SPLITS})
    return models.score_rows(fitted, v.feature_matrix).select(KEY, "split", "pred_tch")


_QUANTILES = {name: fit(f"bq{k}", 1, "pinball", a) for k, (name, a) in enumerate(models.ALPHAS.items())}
_JOINED = " ".join(f"JOIN (SELECT r, p AS {name} FROM {at}) USING (r)" for name, at in _QUANTILES.items())


@query("quantile_forecast", f"SELECT {KEY}, split, {', '.join(models.ALPHAS)} FROM bt_rows {_JOINED}", list(models.ALPHAS), 5)
def _(v):
    """Quantiles by one tree of the pinball loss each; the width of the interval differs by row."""
    fitted = models.fit_quantiles(train_rows(v), COLUMNS, "tch", "boosted", {"n_estimators": 1, **SPLITS})
    return models.quantile_forecast(fitted, v.feature_matrix).select(KEY, "split", *models.ALPHAS)


@query(
    "quantile_crossings",
    f"SELECT split, count(*) AS rows, count(*) FILTER (pred_tch_p10 > pred_tch_p50 OR pred_tch_p50 > pred_tch_p90) AS crossed FROM bt_rows {_JOINED} GROUP BY split",
)
def _(v):
    fitted = models.fit_quantiles(train_rows(v), COLUMNS, "tch", "boosted", {"n_estimators": 1, **SPLITS})
    return models.crossings(models.quantile_forecast(fitted, v.feature_matrix))


# ---- attributions: a path of a tree of depth two has at most two features
def _paths(here: str) -> str:
    return f"""SELECT {SPLITS['learning_rate']} * w AS v, a.f AS f1, (CASE WHEN up = 1 THEN a.nl ELSE a.nr END) / a.n AS z1, a.bin AS c1, a.missing_left AS m1, up = 1 AS left1,
 b.f AS f2, (CASE WHEN l.node = 2 * up + 1 THEN b.nl ELSE b.nr END) / b.n AS z2, b.bin AS c2, b.missing_left AS m2, l.node = 2 * up + 1 AS left2
FROM (SELECT *, CASE WHEN node > 2 THEN (node - 1) // 2 ELSE node END AS up FROM {here}_leaf) l CROSS JOIN {here}_0_best a LEFT JOIN {here}_1_best b ON l.node > 2 AND b.node = up"""


o.CTES["bt_paths"] = " UNION ALL ".join(_paths(f"bt_t{k}") for k in range(3))
_PASS = "((CASE WHEN {b}.bin = 0 THEN m{k} ELSE {b}.bin <= c{k} END) = left{k})::INT"
o.CTES["bt_passes"] = f"""SELECT x.r, p.*, {_PASS.format(b='x', k=1)} AS o1, {_PASS.format(b='y', k=2)} AS o2
FROM bt_paths p JOIN bt_bins x ON x.f = f1 AND x.r > 0 LEFT JOIN bt_bins y ON y.f = f2 AND y.r = x.r"""
o.CTES["bt_shares"] = f"""SELECT r, {', '.join(f'coalesce(sum(a) FILTER (f = {k}), 0) AS {c}' for k, c in enumerate(COLUMNS))} FROM (
 SELECT r, f1 AS f, v * CASE WHEN f2 IS NULL THEN o1 - z1 WHEN f1 = f2 THEN o1 * o2 - z1 * z2 ELSE (o1 - z1) * (z2 + o2) / 2 END AS a FROM bt_passes
 UNION ALL SELECT r, f2, v * (o2 - z2) * (z1 + o1) / 2 FROM bt_passes WHERE f1 <> f2) GROUP BY r"""


def _three_trees(v: Views):
    return models.fit_model(train_rows(v), COLUMNS, "tch", "boosted", {"n_estimators": 3, **SPLITS})


@query("attributions", f"SELECT {KEY}, {', '.join(f's.{c}' for c in COLUMNS)} FROM bt_shares s JOIN bt_rows USING (r)", COLUMNS, 5)
def _(v):
    """How far each feature moves each row's prediction by the three trees of ``fit_boosted``."""
    return attribution.attributions(_three_trees(v), v.feature_matrix)


@query(
    "mean_attributions",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(abs({c})) AS mean_abs_attribution FROM bt_shares JOIN (SELECT r, split FROM bt_rows) USING (r) WHERE split = 'test'" for c in COLUMNS),
    ["mean_abs_attribution"],
    5,
)
def _(v):
    rows = attribution.attributions(_three_trees(v), v.feature_matrix.where("split = 'test'"))
    return attribution.mean_attributions(rows, COLUMNS)
