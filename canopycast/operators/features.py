"""Feature matrices: one row per key with target, metadata and feature columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import KEY, LOT, PROD_COLUMNS, SEASON, TARGET
from ..functions.scalars import nan_to_null, scrub_inf

AGE = "edad_de_cultivo"
DATE = "fecha_stac"

# Columns that are never features.
ID_COLUMNS = (
    KEY, LOT, SEASON, DATE, "stac_imagen_id", "cierre", "cierre_date", "cierre_ciclo",
    "radar_asc_fecha", "radar_asc_imagen_id", "radar_desc_fecha", "radar_desc_imagen_id", "enso_date",
)
TARGET_COLUMNS = (TARGET, "tc")
METADATA_COLUMNS = (KEY, LOT, SEASON, "zafra", "area", "tc", "fecha_inicio_ciclo", "fecha_fin_ciclo")
STATIC_COLUMNS = (SEASON, "area", *PROD_COLUMNS, "prod_cosecha")
# Blocked both under this name and with the prefix prod_.
BLOCKED = (
    "semana", "latitud", "longitud", "zona_longitudinal", "estrato",
    "rendimiento", "brix", "pureza", "jugo", "ph", "pol", "fibra", "humedad", "tah", "edad",
    "nitrogeno", "potasio", "fosforo", "cachaza", "vinaza", "sulfato", "urea_nitro_exted",
    "aplicaciones_foliares", "pre_incorporado",
    "riego", "total_riego_aplicado_mm", "numero_de_riegos", "dias_ultimo_riego",
    "pre_emergente", "post_emergente", "pre_post_emergente", "ultimo_control_de_malezas",
    "bejuco", "parchoneo", "arranque", "tipo_aplicacion_control_malezas",
    "inhibidor_de_floracion", "premadurante", "madurante", "tipo_de_aplicacion_madurante",
    "dias_madurantes", "horas_quema", "tipo_quema", "para_cosecha_en_verde", "mes_de_cosecha",
    "ndvi", "ndwi_11", "ndwi_12", "msi_11", "msi_12", "ultima_imagen",
    "de_infestacion_barrenador", "tipo_de_control_para_barrenador",
    "de_infestacion_de_roedores", "tipo_de_control_para_roedores",
    "chinche_salivosa_ninfas_tallo", "chinche_salivosa_adultos_tallo", "tipo_de_control_de_chinche",
    "precipitacion", "temp_minima", "radiacion_solar",
)
# Known only once the cycle has closed, so they would leak the outcome into the features.
LEAKING = (
    "fecha_cierre_real", "cycle_duration_days", "prod_edad_meses", "start_correction_days", "cod_cg_zafra_original",
)
BOOKKEEPING = ("cycle_uid", "duplicate_key", "split")
# Columns with a trend: a prefix and a suffix; the last suffix gets no age windows.
TREND_PREFIXES = ("stac_", "radar_asc_", "radar_desc_", "clima_", "enso_")
TREND_SUFFIXES = ("_promedio", "_mean", "_sum", "_oni", "_nino34", "_soi")
AGE_WINDOWS = {"early": (0, 120), "mid": (121, 240), "late": (241, None)}


class Matrix(NamedTuple):
    """A feature matrix and the role of its columns."""

    df: DataFrame
    numeric: list[str]
    categorical: list[str]
    metadata: list[str]


def blocked_columns(roles: str = "strict") -> set[str]:
    """Names that may not be features; ``strict`` also blocks leaking and bookkeeping columns."""
    if roles not in ("strict", "reference"):
        raise ValueError(f"unknown roles {roles!r}")
    names = {*ID_COLUMNS, *TARGET_COLUMNS, *BLOCKED, *[f"prod_{name}" for name in BLOCKED]}
    return names | {*LEAKING, *BOOKKEEPING} if roles == "strict" else names


def select_features(df: DataFrame, exclude: Sequence[str] = (), roles: str = "strict") -> tuple[list[str], list[str]]:
    """Names of the numeric and of the other feature columns, by schema."""
    blocked = blocked_columns(roles) | set(exclude)
    fields = [f for f in df.schema.fields if f.name not in blocked]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def rename_season(df: DataFrame) -> DataFrame:
    """Call the season column by its standard name when only ``zafra`` is there."""
    if SEASON in df.columns or "zafra" not in df.columns:
        return df
    return df.withColumnRenamed("zafra", SEASON)


def scrub(df: DataFrame) -> DataFrame:
    """NaN and infinite values become NULL in every fractional column."""
    fractional = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            scrub_inf(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, fractional) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def light_features(df: DataFrame, numeric: Sequence[str]) -> dict[str, Column]:
    """Differences between related columns, found by name."""
    names, derived = set(numeric), {}
    for name in numeric:
        pairs = []
        if name.endswith("_late_mean"):
            base = name.removesuffix("_late_mean")
            pairs = [(f"{base}_late_minus_{w}_mean", f"{base}_{w}_mean") for w in ("early", "mid")]
        elif name.endswith("_max"):
            base = name.removesuffix("_max")
            pairs = [(f"{base}_range", f"{base}_min")]
        derived |= {new: F.col(name) - F.col(other) for new, other in pairs if other in names}
    return derived


# ---------------------------------------------------------------- aggregates of a longitudinal table


def time_order(df: DataFrame, date: str, tiebreak: Sequence[str]) -> Column:
    """Sort key of the rows of a group: by date, undated rows last, then by tiebreak.

    A day and one integer pack into a long, which keeps the aggregation hash-based.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(types[date], T.DateType) and len(tiebreak) == 1 and isinstance(types[tiebreak[0]], T.IntegerType):
        day = F.coalesce(F.unix_date(date), F.lit(2**31 - 1)).cast("bigint")
        return F.shiftleft(day, 32) + F.coalesce(F.col(tiebreak[0]).cast("bigint"), F.lit(0))
    return F.struct(F.col(date).isNull(), F.col(date), *[F.col(c) for c in tiebreak])


def group_stats(columns: Sequence[str]) -> list[Column]:
    """Mean, max, min, sample deviation and count of each column."""
    stats = {"mean": "avg", "max": "max", "min": "min", "std": "stddev_samp", "count": "count"}
    return [F.expr(f"{fn}({c}) AS {c}_{name}") for c in columns for name, fn in stats.items()]


def group_last(columns: Sequence[str]) -> list[Column]:
    """Last value by time that is not NULL."""
    return [F.expr(f"max_by({c}, _order) FILTER (WHERE {c} IS NOT NULL) AS {c}_last") for c in columns]


def trend_columns(columns: Sequence[str]) -> list[str]:
    return [
        c for c in columns
        if c.startswith(TREND_PREFIXES) and c.endswith(TREND_SUFFIXES) and not c.endswith("_days_delta")
    ]


def group_slope(columns: Sequence[str]) -> list[Column]:
    """Least-squares slope of each column against age."""
    return [F.expr(f"regr_slope({c}, {AGE}) AS {c}_slope") for c in columns]


def window_stats(columns: Sequence[str]) -> list[Column]:
    """Mean, max and min of each column per age window; the columns exist even for empty windows."""
    result = []
    for window, (first, last) in AGE_WINDOWS.items():
        test = f"{AGE} >= {first}" + (f" AND {AGE} <= {last}" if last is not None else "")
        result += [
            F.expr(f"{agg}({c}) FILTER (WHERE {test}) AS {c}_{window}_{name}")
            for c in columns
            for name, agg in (("mean", "avg"), ("max", "max"), ("min", "min"))
        ]
    return result


def group_first(columns: Sequence[str]) -> list[Column]:
    """First value by time that is not NULL."""
    return [F.expr(f"min_by({c}, _order) FILTER (WHERE {c} IS NOT NULL) AS {c}") for c in columns]


def longitudinal_rows(df: DataFrame, target: str = TARGET, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows with target, key and season; clean numbers; ``_order`` sorts the rows of a key."""
    rows = df.where(F.col(target).isNotNull() & F.col(KEY).isNotNull() & F.col(SEASON).isNotNull())
    types = {f.name: f.dataType for f in rows.schema.fields}
    if isinstance(types[DATE], T.StringType):
        rows = rows.withColumn(DATE, F.expr(f"try_cast({DATE} AS timestamp)"))
    rows = rows.withColumn(AGE, nan_to_null(F.col(AGE)))
    doubles = [n for n, t in types.items() if isinstance(t, (T.DoubleType, T.FloatType)) and n != AGE]
    rows = rows.withColumns({c: nan_to_null(F.col(c)) for c in doubles})
    return rows.withColumn("_order", time_order(rows, DATE, tiebreak))


def aggregated_dataset(
    df: DataFrame, target: str = TARGET, tiebreak: Sequence[str] = (), roles: str = "strict"
) -> Matrix:
    """Feature matrix from a table with one row per key and observation.

    Numbers are folded by a hash aggregate. Text values, and last values under an order that is no
    number, force a sort aggregate, so they get one of their own over their columns only. Both
    combine before they shuffle and end partitioned by key, so joining them moves no row.
    """
    rows = longitudinal_rows(df, target, tiebreak)
    numeric, _ = select_features(df, [target, *tiebreak], roles)
    trend = trend_columns(numeric)
    windows = [c for c in trend if not c.endswith("_soi")]
    blocked = blocked_columns(roles) - {SEASON}
    static = [c for c in STATIC_COLUMNS if c in df.columns and c not in blocked]
    first = list(dict.fromkeys([target, "tc", LOT, SEASON, "area", *static]))
    first = [c for c in first if c in df.columns]
    numbers = [*group_stats(numeric), *group_slope(trend), *window_stats(windows)]
    texts = group_first(first)
    (numbers if isinstance(rows.schema["_order"].dataType, T.LongType) else texts).extend(group_last(numeric))
    by_key = rows.groupBy(KEY)
    result = scrub(by_key.agg(*texts).join(by_key.agg(*numbers), KEY))
    made = [c for c in result.columns if c not in (KEY, *first)]
    types = {f.name: f.dataType for f in result.schema.fields}
    features = [*static, *made]
    numbers = [c for c in features if isinstance(types[c], T.NumericType)]
    metadata = [c for c in (KEY, LOT, SEASON, "area", "tc") if c in result.columns]
    return Matrix(result, numbers, [c for c in features if c not in numbers], metadata)


# ---------------------------------------------------------------- ready feature table


def feature_table(
    df: DataFrame,
    target: str = TARGET,
    light: bool = True,
    order_by: Sequence[str] = (),
    roles: str = "strict",
    keep_unlabelled: bool = False,
) -> Matrix:
    """Feature matrix from a table that already has one row per key.

    Of several rows with one key the first by ``order_by`` stays (by all columns if not given).
    ``keep_unlabelled`` keeps rows without target, so that open cycles can be scored.
    """
    df = rename_season(df)
    missing = sorted({KEY, SEASON, target, "area"} - set(df.columns))
    if missing:
        raise ValueError(f"feature table lacks columns: {', '.join(missing)}")
    rows = df.dropna(subset=[KEY, SEASON] if keep_unlabelled else [KEY, SEASON, target])
    order = list(order_by) or [c for c in df.columns if c != KEY]
    # Spark keeps the first row per key on the map side already
    first = F.row_number().over(Window.partitionBy(KEY).orderBy(*order))
    rows = rows.withColumn("_row", first).where(F.col("_row") == 1).drop("_row")
    numeric, categorical = select_features(df, [*METADATA_COLUMNS, target], roles)
    derived = light_features(df, numeric) if light else {}
    metadata = [c for c in dict.fromkeys([*METADATA_COLUMNS, *STATIC_COLUMNS]) if c in df.columns]
    keep = list(dict.fromkeys([*metadata, target, *numeric, *categorical]))
    result = scrub(rows.select(*keep, *[column.alias(name) for name, column in derived.items()]))
    return Matrix(result, [*numeric, *derived], categorical, metadata)


def build_matrix(df: DataFrame, kind: str = "aggregated", **options) -> Matrix:
    """Feature matrix of the given kind."""
    if kind == "aggregated":
        return aggregated_dataset(df, **options)
    if kind in ("feature_table", "preaggregated"):
        return feature_table(df, **options)
    if kind == "sequential":
        raise NotImplementedError("sequential matrices are not available")
    raise ValueError(f"unknown dataset type {kind!r}")


def align_keys(left: DataFrame, right: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Rows of ``left`` whose key is in ``right``, and those whose key is not."""
    keys = right.select(key)
    return left.join(keys, key, "left_semi"), left.join(keys, key, "left_anti")
