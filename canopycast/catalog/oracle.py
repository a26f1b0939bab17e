"""DuckDB statements that check the operators row by row, built from named common table expressions."""

from __future__ import annotations

import re

from ..config import CLIMATE_OUTPUT, COVERAGE_OUTPUT, OPTICAL_INDEXES, OPTICAL_OUTPUT, PROD_COLUMNS, AGRONOMY
from .bridge import VIEWS, duckdb_text

CTES: dict[str, str] = {name: duckdb_text(name) for name in VIEWS}


def statement(select: str, doubles: tuple[str, ...] | list[str] = (), digits: int = 6) -> str:
    """Prefix a select with the expressions it names, and round the given columns."""
    order: list[str] = []

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", text)):
            if word in CTES and word not in order and word not in pending:
                pending.append(word)
                need(CTES[word])
                order.append(word)

    pending: list[str] = []
    need(select)
    with_ = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    if doubles:
        fixed = ", ".join(f'{number(c, digits)} AS "{c}"' for c in doubles)
        select = f"SELECT * REPLACE ({fixed}) FROM (\n{select}\n)"
    return f"WITH {with_}\n{select}" if order else select


def shift(digits: int) -> float:
    return 10.0 ** -(digits + 3) * 1.37


def number(column: str, digits: int = 6) -> str:
    """Rounded value; NaN is NULL and minus zero is zero."""
    value = f'"{column}"::DOUBLE'
    return f"CASE WHEN isnan({value}) THEN NULL ELSE round({value} + {shift(digits)!r}::DOUBLE, {digits}) + 0.0 END"


def canon(column: str) -> str:
    second = f"split_part(trim({column}), '-', 2)"
    return (
        f"CASE WHEN regexp_full_match({second}, '[0-9]+') "
        f"THEN split_part(trim({column}), '-', 1) || '-' || CAST(CAST({second} AS BIGINT) AS VARCHAR) END"
    )


def season(day: str) -> str:
    return f"CASE WHEN month({day}) < 6 THEN year({day}) - 1 || '_' || year({day}) ELSE year({day}) || '_' || (year({day}) + 1) END"


def no_nan(column: str) -> str:
    return f"CASE WHEN isnan({column}) THEN NULL ELSE {column} END"


def slope(y: str, x: str, where: str = "true") -> str:
    return f"CASE WHEN count(DISTINCT {x}) FILTER ({y} IS NOT NULL AND {where}) > 1 THEN regr_slope({y}, {x}) FILTER ({where}) END"


# ---- keys
CTES["stac_keys"] = f"SELECT DISTINCT lote AS source_lote, {canon('lote')} AS canonical_lote_key FROM stac_indices"
CTES["prod_keys"] = f"SELECT DISTINCT lote AS source_lote, {canon('lote')} AS canonical_lote_key FROM productividad"
CTES["stac_unique"] = """SELECT canonical_lote_key, any_value(source_lote) AS source_lote FROM stac_keys
WHERE canonical_lote_key IS NOT NULL GROUP BY ALL HAVING count(DISTINCT source_lote) = 1""".replace("GROUP BY ALL", "GROUP BY 1")
CTES["stac_lookup"] = """SELECT k.source_lote AS cod_cg, ifnull(s.source_lote, u.source_lote) AS stac_lote_matched,
 CASE WHEN s.source_lote = k.source_lote THEN 'exact' WHEN u.source_lote IS NOT NULL THEN 'canonical' ELSE 'no_match' END AS stac_lote_match_method
FROM prod_keys k LEFT JOIN stac_keys s USING (source_lote) LEFT JOIN stac_unique u ON u.canonical_lote_key = k.canonical_lote_key"""
CTES["climate_given"] = "SELECT cod_cg, climate_lote_matched, 'given' AS climate_lote_match_method FROM clima_lookup"

# ---- cycles
CTES["production"] = f"""SELECT lote AS cod_cg, cod_cg_zafra AS cod_cg_zafra_original,
 replace(regexp_replace(zafra, '^zafra\\s+', '', 'i'), '-', '_') AS zafra_norm_original, zafra AS zafra_productividad_raw,
 tch, tc, area, edad AS prod_edad_meses, {', '.join(f'{a} AS {p}' for a, p in zip(AGRONOMY, PROD_COLUMNS))}, cierre,
 coalesce(CAST(try_strptime(cierre, '%Y-%m-%d') AS DATE), CAST(try_strptime(cierre, '%d/%m/%Y') AS DATE)) AS fecha_cierre_real
FROM productividad WHERE tch >= 20 AND tch <= 150 AND edad IS NOT NULL AND lote IS NOT NULL"""
CTES["dated"] = """SELECT *, CAST(greatest(0, round_even(prod_edad_meses * 30.44, 0)) AS INTEGER) AS age_days,
 fecha_cierre_real - age_days AS fecha_inicio_baseline,
 lag(fecha_cierre_real) OVER (PARTITION BY cod_cg ORDER BY fecha_cierre_real, cod_cg_zafra_original) AS previous_fecha_cierre
FROM production WHERE fecha_cierre_real IS NOT NULL"""
CTES["closed"] = f"""SELECT cod_cg, {season('fecha_cierre_real')} AS zafra_norm, cod_cg_zafra_original, zafra_norm_original,
 'training' AS dataset_role, 'closed' AS cycle_status, true AS has_target_tch, tch, tc, area,
 greatest(fecha_inicio_baseline, previous_fecha_cierre + 21) AS fecha_inicio_ciclo, fecha_inicio_baseline, fecha_cierre_real,
 fecha_cierre_real AS fecha_fin_ciclo, previous_fecha_cierre,
 'closed_baseline_or_previous_cierre_plus_21d' AS start_rule,
 greatest(fecha_inicio_baseline, previous_fecha_cierre + 21) - fecha_inicio_baseline AS start_correction_days,
 'real_cierre_productiva' AS zafra_assignment_method, prod_edad_meses, {', '.join(PROD_COLUMNS)} FROM dated"""
CTES["last_closed"] = """SELECT * FROM closed
QUALIFY row_number() OVER (PARTITION BY cod_cg ORDER BY fecha_cierre_real DESC, cod_cg_zafra_original DESC) = 1"""
CTES["latest"] = f"""SELECT cod_cg, zafra_norm AS previous_zafra_norm, fecha_inicio_ciclo AS previous_fecha_inicio_ciclo,
 fecha_cierre_real AS previous_fecha_cierre, tch AS previous_tch, tc AS previous_tc, area, {', '.join(PROD_COLUMNS)} FROM last_closed"""
CTES["open_dates"] = "SELECT *, previous_fecha_cierre + 1 AS fecha_inicio_ciclo, previous_fecha_cierre + 366 AS fecha_cierre_estimada FROM latest"
CTES["last_seen"] = """SELECT cod_cg, max(day) AS day FROM (
 SELECT o.cod_cg, s.fecha AS day FROM open_dates o JOIN stac_lookup l USING (cod_cg) JOIN stac_indices s ON s.lote = l.stac_lote_matched WHERE s.fecha >= o.fecha_inicio_ciclo
 UNION ALL
 SELECT o.cod_cg, c.fecha_inicio FROM open_dates o JOIN climate_given l USING (cod_cg) JOIN clima c ON c.cod_cg = l.climate_lote_matched WHERE c.fecha_inicio >= o.fecha_inicio_ciclo
) GROUP BY cod_cg"""
CTES["observed"] = """SELECT o.*, ifnull(l.day, DATE '1900-01-01') AS latest_observation_date FROM open_dates o LEFT JOIN last_seen l USING (cod_cg)"""
CTES["opened"] = f"""SELECT cod_cg, {season('fecha_cierre_estimada')} AS zafra_norm, 'scoring' AS dataset_role, 'open' AS cycle_status,
 false AS has_target_tch, area, fecha_inicio_ciclo, fecha_cierre_estimada, fecha_cierre_estimada AS fecha_fin_ciclo, previous_fecha_cierre,
 'open_previous_cierre_plus_1d' AS start_rule, 'estimated_cierre_productiva' AS zafra_assignment_method, {', '.join(PROD_COLUMNS)},
 previous_zafra_norm, previous_fecha_inicio_ciclo, previous_tch, previous_tc, latest_observation_date
FROM observed WHERE latest_observation_date >= fecha_inicio_ciclo AND {season('fecha_cierre_estimada')} > (SELECT max(zafra_norm) FROM closed)"""
CTES["spine"] = """SELECT cod_cg || '_' || replace(zafra_norm, '_', '-') AS cod_cg_zafra, *, fecha_fin_ciclo AS natural_asof_limit_date FROM closed
UNION ALL BY NAME
SELECT cod_cg || '_' || replace(zafra_norm, '_', '-') || '_open' AS cod_cg_zafra, * EXCLUDE (latest_observation_date), latest_observation_date AS natural_asof_limit_date FROM opened"""


def eligible(min_age: int = 180, floor: str = "1995_1996") -> str:
    return f"""SELECT s.*, {min_age}::INTEGER AS min_prediction_age_days, 340::INTEGER AS max_prediction_age_days,
 least(natural_asof_limit_date, fecha_inicio_ciclo + 340) AS as_of_date, (as_of_date - fecha_inicio_ciclo)::DOUBLE AS as_of_age_days,
 (fecha_fin_ciclo - fecha_inicio_ciclo)::DOUBLE AS cycle_duration_days,
 cod_cg || '|' || fecha_inicio_ciclo || '|' || ifnull(CAST(fecha_cierre_real AS VARCHAR), 'open') AS cycle_uid,
 l.stac_lote_matched, l.stac_lote_match_method, g.climate_lote_matched, g.climate_lote_match_method
FROM spine s LEFT JOIN stac_lookup l USING (cod_cg) LEFT JOIN climate_given g USING (cod_cg)
WHERE as_of_date - fecha_inicio_ciclo >= {min_age} AND zafra_norm >= '{floor}'"""


CTES["eligible"] = eligible()
CTES["eligible_young"] = eligible(60)

# ---- optical
CTES["optical_rows"] = """SELECT e.cycle_uid, e.as_of_age_days, s.*, (s.fecha - e.fecha_inicio_ciclo)::DOUBLE AS age_days
FROM eligible e JOIN stac_indices s ON s.lote = e.stac_lote_matched AND s.fecha >= e.fecha_inicio_ciclo AND s.fecha <= e.as_of_date"""
CTES["optical_tall"] = " UNION ALL ".join(
    f"SELECT cycle_uid, as_of_age_days, fecha, age_days, '{i}' AS index_name, {no_nan(f'{i}_promedio')} AS v FROM optical_rows"
    for i in OPTICAL_INDEXES
)
CTES["optical_gaps"] = """SELECT *, age_days - lag(age_days) OVER (PARTITION BY cycle_uid, index_name ORDER BY age_days, v) AS gap
FROM optical_tall WHERE v IS NOT NULL"""

SPANS = {
    "0_asof": "true",
    "0_180": "age_days <= 180",
    "181_asof": "age_days >= 181",
    "last30": "age_days >= greatest(0, as_of_age_days - 30)",
    "last60": "age_days >= greatest(0, as_of_age_days - 60)",
}


def optical_stats() -> dict[str, str]:
    stats = {}
    for span in ("0_asof", "0_180"):
        f = f"FILTER ({SPANS[span]})"
        stats[f"obs_count_{span}"] = f"(count(DISTINCT fecha) {f})::DOUBLE"
        stats[f"first_obs_age_{span}"] = f"min(age_days) {f}"
        stats[f"last_obs_age_{span}"] = f"max(age_days) {f}"
        stats[f"max_gap_days_{span}"] = f"max(gap) {f}"
        stats[f"peak_{span}"] = f"max(v) {f}"
        stats[f"min_{span}"] = f"min(v) {f}"
        stats[f"amplitude_{span}"] = f"max(v) {f} - min(v) {f}"
        stats[f"slope_{span}"] = slope("v", "age_days", SPANS[span])
    for span in ("181_asof", "last30", "last60"):
        stats[f"obs_count_{span}"] = f"(count(v) FILTER ({SPANS[span]}))::DOUBLE"
    for span, where in SPANS.items():
        stats[f"mean_{span}"] = f"avg(v) FILTER ({where})"
    stats["slope_181_asof"] = slope("v", "age_days", SPANS["181_asof"])
    stats["last_value_before_asof"] = "arg_max(v, (age_days, v))"
    return stats


STATS = optical_stats()
CTES["optical_series"] = (
    "SELECT cycle_uid, index_name, "
    + ", ".join(f"{sql} AS {name}" for name, sql in STATS.items())
    + " FROM optical_gaps GROUP BY cycle_uid, index_name"
)
_wide = []
for _stat in COVERAGE_OUTPUT:
    if _stat.startswith("boundary"):
        _wide.append("greatest(n.first_obs_age_0_180, n.max_gap_days_0_180, 180 - n.last_obs_age_0_180) AS optical_boundary_max_gap_days_0_180")
    else:
        _wide.append(f"n.{_stat} AS optical_{_stat}")
_wide += [f"{i[0] if i == 'ndvi' else i}.{s} AS optical_{i}_{s}" for i, stats in OPTICAL_OUTPUT.items() for s in stats]
CTES["optical_wide"] = (
    "SELECT b.cycle_uid, " + ", ".join(_wide) + " FROM (SELECT DISTINCT cycle_uid FROM optical_series) b "
    + " ".join(
        f"LEFT JOIN optical_series {'n' if i == 'ndvi' else i} ON {'n' if i == 'ndvi' else i}.cycle_uid = b.cycle_uid AND {'n' if i == 'ndvi' else i}.index_name = '{i}'"
        for i in OPTICAL_INDEXES
    )
)

# ---- climate
CLIMATE = {"precip": "precipitacion_sum", "eto": "eto_sum", "rad": "radiacion_sum", "tmean": "temperatura_mean",
           "tmax": "temperatura_max", "tmin": "temperatura_min", "rh": "humedad_relativa"}
CTES["climate_clean"] = f"""SELECT cod_cg AS source_lote, fecha_inicio AS day, {', '.join(f'{no_nan(c)} AS {n}' for n, c in CLIMATE.items())},
 precip - eto AS water_balance, 5 * CASE WHEN tmean > 10 THEN tmean - 10 ELSE 0 END AS gdd_10c FROM clima"""
CTES["climate_rows"] = """SELECT e.cycle_uid, e.as_of_age_days, c.* EXCLUDE (gdd_10c), ifnull(c.gdd_10c, 0) AS gdd_10c, (c.day - e.fecha_inicio_ciclo)::DOUBLE AS age_days
FROM eligible e LEFT JOIN climate_clean c ON c.source_lote = e.climate_lote_matched AND c.day BETWEEN e.fecha_inicio_ciclo AND e.as_of_date"""
_climate = {}
for _c in CLIMATE_OUTPUT:
    _m = re.fullmatch(r"climate_(\w+?)_(count|acc|mean|slope|per_day)_(\w+)", _c)
    _name, _kind, _span = _m.groups()
    if _kind == "count":
        _climate[_c] = f"(count(day) FILTER ({SPANS[_span]}))::DOUBLE"
    elif _kind == "acc":
        _climate[_c] = f"sum({_name}) FILTER ({SPANS[_span]})"
    elif _kind == "mean":
        _climate[_c] = f"avg({_name})"
    elif _kind == "slope":
        _climate[_c] = slope(_name, "age_days")
CTES["climate_wide"] = (
    "SELECT cycle_uid, " + ", ".join(f"{sql} AS {c}" for c, sql in _climate.items()) + " FROM climate_rows GROUP BY cycle_uid"
)

# ---- ocean
_OCEAN = "e.fecha_inicio_ciclo - 180 <= o.date AND o.date <= e.as_of_date"
CTES["ocean_rows"] = f"SELECT e.cycle_uid, e.fecha_inicio_ciclo, o.* FROM eligible e LEFT JOIN enso o ON {_OCEAN}"
CTES["ocean_wide"] = (
    "SELECT cycle_uid, count(date)::DOUBLE AS enso_month_count_asof, max(abs(oni)) AS enso_oni_abs_max_asof, "
    + ", ".join(
        f"avg({c}) FILTER (date {op} fecha_inicio_ciclo) AS enso_{c}_{name}_mean"
        for c in ("oni", "nino34", "soi")
        for name, op in (("precycle", "<"), ("asof", ">="))
    )
    + " FROM ocean_rows GROUP BY cycle_uid"
)

# ---- assembly
CTES["flags"] = """SELECT e.cycle_uid, ifnull(o.optical_obs_count_0_180, 0) >= 7 AS asof_optical_obs_ok,
 ifnull(o.optical_boundary_max_gap_days_0_180, 9999) <= 60 AS asof_optical_gap_ok,
 ifnull(c.climate_pentad_count_0_180, 0) >= 30 AS asof_climate_coverage_ok,
 e.cycle_duration_days >= 180 AND e.cycle_duration_days <= 14 * 30.44 AS asof_cycle_duration_ok,
 o.optical_ndvi_peak_0_180 > 0.6 AND o.optical_ndvi_amplitude_0_180 > 0.4 AS asof_ndvi_shape_ok,
 o.optical_obs_count_0_180 >= 7 AND asof_optical_gap_ok AND asof_climate_coverage_ok AND asof_cycle_duration_ok AS asof_valid
FROM eligible e LEFT JOIN optical_wide o USING (cycle_uid) LEFT JOIN climate_wide c USING (cycle_uid)"""


def variant(suffix: str, swap: dict[str, str]) -> None:
    """Copies, with ``suffix``, of every expression that reads the swapped ones, reading their replacements."""
    names = dict(swap)
    words = {name: set(re.findall(r"[a-z_][a-z_0-9]*", text)) for name, text in CTES.items()}
    while more := {n: f"{n}{suffix}" for n, own in words.items() if n not in names and n not in swap.values() and own & names.keys()}:
        names |= more
    pattern = re.compile(r"\b(" + "|".join(names) + r")\b")
    for name, new in names.items():
        if name not in swap:
            CTES[new] = pattern.sub(lambda m: names[m[1]], CTES[name])


def varied(select: str, suffix: str) -> str:
    """A select over the copies made by ``variant``."""
    names = [n for n in CTES if f"{n}{suffix}" in CTES]
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: f"{m[1]}{suffix}", select)


# open cycles are old enough at 60 days
variant("_young", {"eligible": "eligible_young"})
# climate keys spelled like lots, matched as the optical ones are
CTES["climate_keys"] = f"SELECT DISTINCT cod_cg AS source_lote, {canon('cod_cg')} AS canonical_lote_key FROM clima_lots"
CTES["climate_unique"] = CTES["stac_unique"].replace("stac_keys", "climate_keys")
CTES["climate_by_key"] = CTES["stac_lookup"].replace("stac_", "climate_")
variant("_by_key", {"climate_given": "climate_by_key", "clima": "clima_lots"})
