"""Queries over feature matrices, encoding, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import KEY
from ..functions import scalars as sc
from ..functions.names import feature_names
from ..operators import encode as enc, features as ft, reports
from ..sources import io
from ..sources.staging import staged_path
from . import oracle as o
from .bridge import VIEWS, duckdb_text, tables_of
from .registry import Views, query
from .report_queries import _BASIC, _BASIC_NAMES, _WITHIN, _WITHIN_NAMES, scored

# ---------------------------------------------------------------- longitudinal aggregates

NUMERIC = ["edad_de_cultivo", "area", "stac_ndvi_promedio", "clima_precip_sum", "clima_tmean_mean", "enso_oni"]
TREND = NUMERIC[2:]
TIEBREAK = ["tiebreak", "edad_de_cultivo", "stac_ndvi_promedio", "clima_precip_sum", "clima_tmean_mean", "enso_oni"]
FIRST = ["tch", "tc", "cod_cg", "zafra_norm", "area", "prod_ingenio", "prod_variedad"]
_ORDER = "(fecha_stac IS NULL, ifnull(fecha_stac, DATE '1900-01-01'), tiebreak, edad_de_cultivo, ifnull(stac_ndvi_promedio, -1), clima_precip_sum, clima_tmean_mean, enso_oni)"
o.CTES["long_rows"] = "SELECT * FROM longitudinal WHERE tch IS NOT NULL"


def _stats_sql(columns):
    return {
        f"{c}_{stat}": sql.format(c=c)
        for c in columns
        for stat, sql in (
            ("mean", "avg({c})"), ("max", "max({c})"), ("min", "min({c})"), ("std", "stddev_samp({c})"),
            ("last", f"arg_max({{c}}, {_ORDER}) FILTER ({{c}} IS NOT NULL)"), ("count", "count({c})"),
        )
    }


STATS = _stats_sql(NUMERIC)
SLOPES = {f"{c}_slope": o.slope(c, "edad_de_cultivo") for c in TREND}
WINDOWS = {
    f"{c}_{w}_{name}": f"{agg}({c}) FILTER (edad_de_cultivo BETWEEN {a} AND {b})"
    for w, (a, b) in {"early": (0, 120), "mid": (121, 240), "late": (241, 99999)}.items()
    for c in TREND
    for name, agg in (("mean", "avg"), ("max", "max"), ("min", "min"))
}
FIRSTS = {c: f"arg_min({c}, {_ORDER}) FILTER ({c} IS NOT NULL)" for c in FIRST}


def _grouped(parts: dict[str, str]) -> str:
    return f"SELECT {KEY}, " + ", ".join(f"{sql} AS {name}" for name, sql in parts.items()) + f" FROM long_rows GROUP BY {KEY}"


def _doubles(parts) -> list[str]:
    return [c for c in parts if not c.endswith("_count") and c not in ("cod_cg", "zafra_norm", "prod_ingenio", "prod_variedad")]


def long_rows(v: Views):
    return ft.longitudinal_rows(v.longitudinal, tiebreak=TIEBREAK)


@query("group_stats", _grouped(STATS), _doubles(STATS))
def _(v):
    return long_rows(v).groupBy(KEY).agg(*ft.group_stats(NUMERIC), *ft.group_last(NUMERIC))


@query("group_slope", _grouped(SLOPES), _doubles(SLOPES))
def _(v):
    return long_rows(v).groupBy(KEY).agg(*ft.group_slope(ft.trend_columns(NUMERIC)))


@query("window_stats", _grouped(WINDOWS), _doubles(WINDOWS))
def _(v):
    return long_rows(v).groupBy(KEY).agg(*ft.window_stats(ft.trend_columns(NUMERIC)))


@query("group_first", _grouped(FIRSTS), _doubles(FIRSTS))
def _(v):
    return long_rows(v).groupBy(KEY).agg(*ft.group_first(FIRST))


_ALL = {**FIRSTS, **STATS, **SLOPES, **WINDOWS}


@query("aggregated_dataset", _grouped(_ALL), _doubles(_ALL))
def _(v):
    # the extra tiebreak columns are features too, so only the first is kept out of the matrix
    rows = v.longitudinal
    matrix = ft.aggregated_dataset(rows.withColumn("_tie", F.struct(*[F.coalesce(F.col(c), F.lit(-1)) for c in TIEBREAK])).drop("tiebreak"), tiebreak=["_tie"])
    return matrix.df


# ---------------------------------------------------------------- feature table

TABLE_NUMBERS = ["ndvi_peak", "ndvi_copy", "ndvi_mirror", "rain_acc", "rain_copy", "rare", "gap_mid", "trend", "constant"]
TABLE_TEXT = ["prod_ingenio", "prod_familia_de_suelo", "prod_variedad", "prod_codigo_zae", "prod_finca"]


@query(
    "feature_table",
    f"SELECT {', '.join([KEY, 'cod_cg', 'zafra_norm', 'area', 'tch', *TABLE_NUMBERS, *TABLE_TEXT])} FROM feature_matrix WHERE tch IS NOT NULL",
    ["area", "tch", *TABLE_NUMBERS],
)
def _(v):
    return ft.feature_table(v.feature_matrix, order_by=["cod_cg"]).df


_REPEATED = f"SELECT * EXCLUDE ({KEY}), cod_cg || ':' || zafra_norm AS {KEY} FROM feature_matrix WHERE tch IS NOT NULL"


@query(
    "feature_table_first",
    f"SELECT {', '.join([KEY, 'cod_cg', 'zafra_norm', 'area', 'tch', *TABLE_NUMBERS, *TABLE_TEXT])} FROM ({_REPEATED})"
    f" QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY tch, ndvi_peak, trend) = 1",
    ["area", "tch", *TABLE_NUMBERS],
)
def _(v):
    """Several orders of a customer and season share a key: the first by a total order stays."""
    rows = v.feature_matrix.withColumn(KEY, F.concat_ws(":", "cod_cg", "zafra_norm"))
    return ft.feature_table(rows, order_by=["tch", "ndvi_peak", "trend"]).df


@query(
    "light_features",
    f"""SELECT {KEY}, stac_ndvi_promedio_late_mean - stac_ndvi_promedio_early_mean AS stac_ndvi_promedio_late_minus_early_mean,
    stac_ndvi_promedio_late_mean - stac_ndvi_promedio_mid_mean AS stac_ndvi_promedio_late_minus_mid_mean,
    clima_precip_sum_max - clima_precip_sum_min AS clima_precip_sum_range
    FROM ({_grouped({k: w for k, w in {**WINDOWS, **STATS}.items() if k.startswith(('stac_ndvi_promedio', 'clima_precip_sum')) and not k.endswith(('_last', '_std'))})})""",
    ["stac_ndvi_promedio_late_minus_early_mean", "stac_ndvi_promedio_late_minus_mid_mean", "clima_precip_sum_range"],
)
def _(v):
    rows = long_rows(v).groupBy(KEY).agg(*ft.window_stats(TREND), *ft.group_stats(["clima_precip_sum"]))
    derived = ft.light_features(rows, [c for c in rows.columns if c != KEY])
    wanted = [c for c in derived if c.startswith("stac_ndvi_promedio_late_minus") or c == "clima_precip_sum_range"]
    return rows.select(KEY, *[derived[c].alias(c) for c in wanted])


@query("season_rename", "SELECT cod_cg_zafra, zafra AS zafra_norm FROM productividad")
def _(v):
    return ft.rename_season(v.productividad.select(KEY, "zafra"))


@query(
    "scrub_inf",
    f"SELECT {KEY}, CASE WHEN gap_mid <> 0 THEN ndvi_peak / gap_mid END AS ratio, gap_mid FROM feature_matrix",
    ["ratio", "gap_mid"],
)
def _(v):
    gap, peak = F.col("gap_mid"), F.col("ndvi_peak")
    ratio = F.when(gap == 0, F.lit(float("inf")) * F.when(peak > 0, 1.0).otherwise(-1.0)).otherwise(peak / gap)
    return ft.scrub(v.feature_matrix.select(KEY, ratio.alias("ratio"), "gap_mid"))


@query(
    "to_numeric",
    f"SELECT {KEY}, TRY_CAST(replace(prod_variedad, 'V1', '1') AS DOUBLE) AS number FROM feature_matrix",
    ["number"],
)
def _(v):
    text = F.replace(F.col("prod_variedad"), F.lit("V1"), F.lit("1"))
    return v.feature_matrix.select(KEY, sc.to_numeric(text).alias("number"))


@query(
    "select_features",
    f"SELECT {', '.join([KEY, *TABLE_NUMBERS, *TABLE_TEXT])} FROM feature_matrix",
    TABLE_NUMBERS,
)
def _(v):
    numeric, categorical = ft.select_features(v.feature_matrix, ["area"])
    return v.feature_matrix.select(KEY, *numeric, *categorical)


@query(
    "feature_names",
    f"SELECT {KEY}, ndvi_peak AS a, ndvi_copy AS a_2, rain_acc AS a_1, trend AS f_9_x, area AS feature FROM feature_matrix",
    ["a", "a_2", "a_1", "f_9_x", "feature"],
)
def _(v):
    rows = v.feature_matrix.select(KEY, "ndvi_peak", "ndvi_copy", "rain_acc", "trend", "area")
    return rows.toDF(*feature_names([KEY, "a", " a!", "a_1", "9 (x)", "%"]))


@query(
    "index_align",
    """SELECT p.cod_cg_zafra, 'common' AS side FROM predictions p SEMI JOIN (SELECT * FROM feature_matrix WHERE rare IS NOT NULL) f USING (cod_cg_zafra)
    UNION ALL SELECT p.cod_cg_zafra, 'left' FROM predictions p ANTI JOIN (SELECT * FROM feature_matrix WHERE rare IS NOT NULL) f USING (cod_cg_zafra)""",
)
def _(v):
    common, left = ft.align_keys(v.predictions.select(KEY), v.feature_matrix.where("rare IS NOT NULL"))
    return common.withColumn("side", F.lit("common")).unionByName(left.withColumn("side", F.lit("left")))


# ---------------------------------------------------------------- encoding

ENCODED = ["prod_ingenio", "prod_familia_de_suelo", "prod_variedad", "prod_codigo_zae"]
o.CTES["train_text"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS category FROM feature_matrix WHERE split = 'train' AND {c} IS NOT NULL" for c in ENCODED
)
o.CTES["text_counts"] = """SELECT feature, category, count(*) AS n, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, category) AS place
FROM train_text GROUP BY feature, category"""
o.CTES["vocab"] = """SELECT feature, category, n FROM text_counts WHERE feature = 'prod_ingenio' OR n >= 30 OR (feature = 'prod_variedad' AND place <= 30)"""


def vocab(v: Views):
    return enc.fit_vocab(v.feature_matrix.where("split = 'train'"), ENCODED)


@query("topk_categories", "SELECT feature, category, n, place AS rank FROM text_counts WHERE place <= 10")
def _(v):
    return enc.top_categories(enc.category_counts(v.feature_matrix.where("split = 'train'"), ENCODED), 10)


@query("fit_vocab", "SELECT * FROM vocab")
def _(v):
    return vocab(v)


def _known(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '__MISSING__' WHEN {c} IN (SELECT category FROM vocab WHERE feature = '{c}') THEN {c} ELSE '__OTHER__' END"


@query("apply_vocab", f"SELECT {KEY}, " + ", ".join(f"{_known(c)} AS {c}" for c in ENCODED) + " FROM feature_matrix")
def _(v):
    return enc.apply_vocab(v.feature_matrix.select(KEY, *ENCODED), vocab(v), ENCODED)


def _one_hot_name(c: str) -> str:
    joined = f"'{c}_' || {_known(c)}"
    return f"trim(regexp_replace(regexp_replace({joined}, '[^0-9A-Za-z_]+', '_', 'g'), '_+', '_', 'g'), '_')"


@query(
    "one_hot",
    " UNION ALL ".join(f"SELECT {KEY}, {_one_hot_name(c)} AS name, 1 AS value FROM feature_matrix" for c in ENCODED)
    + f" UNION ALL SELECT {KEY}, 'zeros', (SELECT count(*) FROM vocab) + {len(ENCODED)} FROM feature_matrix",
)
def _(v):
    """Of all text columns, the 0/1 columns that are 1 by name, and how many are 0, for each row."""
    encoded = enc.one_hot(v.feature_matrix.select(KEY, *ENCODED), enc.vocab_lists(vocab(v)), ENCODED)
    made = [c for c in encoded.columns if c != KEY]
    tall = encoded.unpivot([KEY], made, "name", "value").where("value = 1")
    # one array, as a sum of hundreds of columns nests too deep for the driver's stack
    zeros = encoded.select(KEY, F.lit("zeros").alias("name"), F.size(F.filter(F.array(*made), lambda x: x == 0)).alias("value"))
    return tall.unionByName(zeros)


_MODE_COLUMNS = [KEY, "ndvi_peak", "prod_variedad", "prod_variedad_V1", "prod_variedad_MISSING", "prod_variedad_OTHER"]


@query(
    "encode_modes",
    f"""SELECT 'native' AS mode, {KEY}, ndvi_peak, ifnull(prod_variedad, '__MISSING__') AS prod_variedad, NULL AS "prod_variedad_V1",
    NULL AS "prod_variedad_MISSING", NULL AS "prod_variedad_OTHER" FROM feature_matrix
    UNION ALL SELECT 'none', {KEY}, ndvi_peak, NULL, NULL, NULL, NULL FROM feature_matrix
    UNION ALL SELECT 'controlled', {KEY}, ndvi_peak, NULL, ({_known('prod_variedad')} = 'V1')::INTEGER,
    ({_known('prod_variedad')} = '__MISSING__')::INTEGER, ({_known('prod_variedad')} = '__OTHER__')::INTEGER FROM feature_matrix""",
    ["ndvi_peak"],
)
def _(v):
    rows = v.feature_matrix.select(KEY, "ndvi_peak", "prod_ingenio", "prod_variedad", "prod_finca")
    names = ["prod_ingenio", "prod_variedad", "prod_finca"]
    result = None
    for mode in ("native", "none", "controlled"):
        spec = enc.encoder_spec(names, mode)
        part = enc.encode(rows, spec, vocab(v) if mode == "controlled" else None)
        part = part.select(F.lit(mode).alias("mode"), *[c for c in _MODE_COLUMNS if c in part.columns])
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


# ---------------------------------------------------------------- sources and sinks


@query("src_query", duckdb_text("productividad"), ["tch", "tc", "area", "edad"])
def _(v):
    return io.run_query(VIEWS["productividad"], {t: v.table(t) for t in tables_of("productividad")})


_TREE = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "lineitem": "l_orderkey", "events": "event_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "conversations": "conv_id",
}


@query(
    "src_parquet_tree",
    "SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM labels) + "
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in _TREE)
    + " AS rows, "
    + ", ".join(f"(SELECT sum({c}) FROM {t}) AS {c}" for t, c in _TREE.items() if c not in ("event_id",))
    + ", (SELECT count(event_id) FROM events) AS events, (SELECT sum(doc_id) FROM documents) + (SELECT sum(doc_id) FROM labels) AS doc_id",
)
def _(v):
    """All files of the folder as one table, columns matched by name."""
    tree = io.read_parquet_tree(v.spark, v.sf_dir)
    keys = [c for c in [*_TREE.values(), "doc_id"] if c != "event_id"]
    return tree.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in keys], F.count("event_id").alias("events"))


@query("sink_dataset", "SELECT * FROM enso", ["oni", "nino34", "soi"])
def _(v):
    path = io.write_dataset(v.enso, staged_path(v.spark, "sink"), "ocean")
    return v.spark.read.parquet(path)


@query(
    "sink_chunked",
    f"""SELECT {KEY}, split, pred_tch, CASE WHEN split = 'test' AND k IS NULL THEN t // 500 ELSE k // 500 END AS part FROM (
 SELECT {KEY}, split, pred_tch, row_number() OVER (ORDER BY {KEY}) - 1 AS k, NULL AS t FROM predictions
 UNION ALL SELECT {KEY}, split, pred_tch, NULL, row_number() OVER (ORDER BY {KEY}) - 1 FROM predictions WHERE split = 'test'
) WHERE t IS NOT NULL OR k >= 500 * ceil((SELECT count(*) FROM predictions WHERE split = 'test') / 500)""",
    ["pred_tch"],
)
def _(v):
    """Rows with the number of their file, after a write that overwrites the first files and leaves the others."""
    folder, rows = staged_path(v.spark, "sink"), v.predictions.select(KEY, "split", "pred_tch")
    for _ in range(2):
        path = io.write_chunked(rows, folder, "predictions", 500, order_by=[KEY])
    io.write_chunked(rows.where("split = 'test'"), folder, "predictions", 500, replace=False, order_by=[KEY])
    return v.spark.read.parquet(path).withColumn("part", F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("long"))


@query(
    "sink_reports",
    f"SELECT split, count(*) AS rows, {_BASIC}, {_WITHIN} FROM scored GROUP BY split",
    [*_BASIC_NAMES, *_WITHIN_NAMES],
)
def _(v):
    report = reports.lot_error_metrics(scored(v))
    paths = io.write_reports({"metrics_by_lot_error": report}, staged_path(v.spark, "reports"))
    return v.spark.read.option("header", True).schema(report.schema).csv(paths["metrics_by_lot_error"])


@query("state_io", "SELECT * FROM vocab")
def _(v):
    path = staged_path(v.spark, "encoder")
    enc.save_state(enc.encoder_spec(ENCODED, "controlled"), vocab(v), path)
    _, loaded = enc.load_state(v.spark, path)
    return loaded
