"""Views that shape the order tables like the inputs of the engine.

The text runs unchanged in Spark SQL and DuckDB; ``{table}`` marks an input table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {}

VIEWS["productividad"] = """
SELECT c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 6, '0') AS lote,
       cast(o_orderkey AS varchar(20)) AS cod_cg_zafra,
       'Zafra ' || cast(year(o_orderdate) AS varchar(4)) || '-' || cast(year(o_orderdate) + 1 AS varchar(4)) AS zafra,
       o_totalprice / 3000.0 AS tch,
       o_totalprice / 3000.0 * (1 + o_orderkey % 20) AS tc,
       cast(1 + o_orderkey % 20 AS double) AS area,
       cast(8 + o_orderkey % 7 AS double) AS edad,
       CASE WHEN o_orderkey % 50 = 0 THEN 'pendiente'
            WHEN o_orderkey % 2 = 0 THEN substr(cast(cast(o_orderdate AS date) AS varchar(10)), 1, 10)
            ELSE substr(cast(cast(o_orderdate AS date) AS varchar(10)), 9, 2) || '/' ||
                 substr(cast(cast(o_orderdate AS date) AS varchar(10)), 6, 2) || '/' ||
                 substr(cast(cast(o_orderdate AS date) AS varchar(10)), 1, 4) END AS cierre,
       o_orderpriority AS ingenio, c_mktsegment AS grupo_de_suelo, o_orderstatus AS grupo_de_humedad,
       n_name AS codigo_zae, 'F' || cast(o_orderkey % 40 AS varchar(9)) AS familia_de_suelo,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'V' || cast(o_orderkey % 60 AS varchar(9)) END AS variedad,
       cast(o_orderkey % 8 AS varchar(9)) AS no_corte
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

VIEWS["stac_indices"] = """
SELECT CASE WHEN c_custkey % 13 = 0 AND l_linenumber % 2 = 0 THEN c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 9, '0')
            WHEN c_custkey % 3 = 0 THEN c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 6, '0')
            WHEN c_custkey % 3 = 1 THEN c_mktsegment || '-' || cast(c_custkey AS varchar(20))
            ELSE c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 8, '0') END AS lote,
       cast(l_shipdate AS date) AS fecha,
       CASE WHEN l_linenumber = 7 THEN cast('NaN' AS double) ELSE l_quantity / 50.0 END AS ndvi_promedio,
       l_discount * 10.0 AS evi2_promedio, l_tax * 12.5 AS gndvi_promedio,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity / 60.0 END AS ndre_promedio,
       l_quantity / 70.0 AS lswi_promedio, l_discount * 5.0 AS ndvire_promedio, l_tax * 10.0 AS cire_promedio,
       l_extendedprice / 100000.0 AS ndwi11_promedio, l_extendedprice / 50000.0 AS msi11_promedio
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
WHERE c_custkey % 11 <> 0
"""

VIEWS["clima"] = """
SELECT 'ST-' || cast(l_suppkey AS varchar(20)) AS cod_cg, cast(l_shipdate AS date) AS fecha_inicio,
       sum(l_quantity) AS precipitacion_sum, max(l_tax) * 500.0 AS eto_sum, max(l_quantity) * 4.0 AS radiacion_sum,
       CASE WHEN min(l_linenumber) = 7 THEN cast('NaN' AS double) ELSE max(l_discount) * 300.0 END AS temperatura_mean,
       max(l_discount) * 330.0 AS temperatura_max, max(l_discount) * 250.0 AS temperatura_min, max(l_tax) * 1000.0 AS humedad_relativa
FROM {lineitem} GROUP BY l_suppkey, cast(l_shipdate AS date)
"""

# Climate of each lot: a third spelled exactly, others shorter or longer, some in two ways, some missing.
VIEWS["clima_lots"] = """
SELECT CASE WHEN c_custkey % 13 = 0 AND l_linenumber % 2 = 0 THEN c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 9, '0')
            WHEN c_custkey % 3 = 0 THEN c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 6, '0')
            WHEN c_custkey % 3 = 1 THEN c_mktsegment || '-' || cast(c_custkey AS varchar(20))
            ELSE c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 8, '0') END AS cod_cg,
       cast(l_shipdate AS date) AS fecha_inicio, sum(l_quantity) AS precipitacion_sum, max(l_tax) * 500.0 AS eto_sum,
       max(l_quantity) * 4.0 AS radiacion_sum, max(l_discount) * 300.0 AS temperatura_mean, max(l_discount) * 330.0 AS temperatura_max,
       max(l_discount) * 250.0 AS temperatura_min, max(l_tax) * 1000.0 AS humedad_relativa
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
WHERE c_custkey % 7 <> 0 GROUP BY 1, 2
"""

VIEWS["clima_lookup"] = """
SELECT c_mktsegment || '-' || lpad(cast(c_custkey AS varchar(20)), 6, '0') AS cod_cg,
       'ST-' || cast(c_custkey % (SELECT count(*) + 1 FROM {supplier}) AS varchar(20)) AS climate_lote_matched
FROM {customer}
"""

VIEWS["enso"] = """
SELECT cast(date_trunc('month', o_orderdate) AS date) AS date,
       round(min(o_totalprice) / 10000.0 - 1.0, 4) AS oni, round(min(o_totalprice) / 1000.0, 4) AS nino34,
       round(max(o_totalprice) / 100000.0 - 4.0, 4) AS soi
FROM {orders} GROUP BY 1
"""

VIEWS["longitudinal"] = """
SELECT cast(o_orderkey AS varchar(20)) AS cod_cg_zafra, cast(o_custkey AS varchar(20)) AS cod_cg,
       cast(year(o_orderdate) AS varchar(4)) || '_' || cast(year(o_orderdate) + 1 AS varchar(4)) AS zafra_norm,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE cast(l_shipdate AS date) END AS fecha_stac, l_linenumber AS tiebreak,
       cast(l_linenumber * 45 + l_partkey % 30 AS double) AS edad_de_cultivo,
       CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_totalprice / 3000.0 END AS tch,
       o_totalprice / 300.0 AS tc, cast(1 + o_orderkey % 20 AS double) AS area,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity / 50.0 END AS stac_ndvi_promedio,
       l_tax * 1000.0 AS clima_precip_sum, l_discount * 300.0 AS clima_tmean_mean, l_discount - 0.05 AS enso_oni,
       o_orderpriority AS prod_ingenio, 'V' || cast(o_orderkey % 60 AS varchar(9)) AS prod_variedad
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

VIEWS["predictions"] = """
SELECT CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation'
            WHEN year(o_orderdate) = 2000 THEN 'test' ELSE 'external' END AS split,
       cast(o_orderkey AS varchar(20)) AS cod_cg_zafra, cast(o_custkey AS varchar(20)) AS cod_cg,
       cast(year(o_orderdate) AS varchar(4)) || '_' || cast(year(o_orderdate) + 1 AS varchar(4)) AS zafra_norm,
       cast(1 + o_orderkey % 20 AS double) AS area, o_totalprice / 3000.0 AS actual_tch,
       o_totalprice / 3000.0 + ((o_orderkey * 37) % 41 - 20) * 0.75 AS pred_tch,
       o_totalprice / 3000.0 + ((o_orderkey * 37) % 41 - 20) * 0.75 - 12.0 AS pred_tch_p10,
       o_totalprice / 3000.0 + ((o_orderkey * 37) % 41 - 20) * 0.75 + 1.0 AS pred_tch_p50,
       o_totalprice / 3000.0 + ((o_orderkey * 37) % 41 - 20) * 0.75 + (o_orderkey % 25) - 14.0 AS pred_tch_p90,
       o_orderpriority AS prod_ingenio, cast(o_orderkey % 8 AS varchar(9)) AS prod_no_corte, o_orderstatus AS prod_grupo_de_humedad
FROM {orders}
"""

# One row per order: numbers with and without gaps, a constant, near copies and text columns.
VIEWS["feature_matrix"] = """
SELECT cast(o_orderkey AS varchar(20)) AS cod_cg_zafra, cast(o_custkey AS varchar(20)) AS cod_cg,
       cast(year(o_orderdate) AS varchar(4)) || '_' || cast(year(o_orderdate) + 1 AS varchar(4)) AS zafra_norm,
       CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation'
            WHEN year(o_orderdate) = 2000 THEN 'test' ELSE 'external' END AS split,
       CASE WHEN o_orderkey % 90 = 0 THEN NULL ELSE o_totalprice / 3000.0 END AS tch,
       cast(1 + o_orderkey % 20 AS double) AS area,
       cast((o_orderkey * 37) % 101 AS double) AS ndvi_peak,
       cast((o_orderkey * 37) % 101 AS double) * 2.0 + cast(o_orderkey % 2 AS double) AS ndvi_copy,
       cast(1000 - (o_orderkey * 37) % 101 AS double) AS ndvi_mirror,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(floor(o_totalprice / 30000.0) AS double) END AS rain_acc,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(floor(o_totalprice / 15000.0) AS double) END AS rain_copy,
       CASE WHEN o_orderkey % 50 < 48 THEN NULL ELSE cast(o_orderkey % 13 AS double) END AS rare,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast((o_orderkey * o_orderkey) % 53 AS double) END AS gap_mid,
       cast(year(o_orderdate) - 1990 AS double) * 10.0 + cast(o_orderkey % 3 AS double) AS trend,
       cast(1 AS double) AS constant,
       o_orderpriority AS prod_ingenio, 'F' || cast(o_orderkey % 40 AS varchar(9)) AS prod_familia_de_suelo,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'V' || cast((o_orderkey * o_orderkey) % 97 AS varchar(9)) END AS prod_variedad,
       'Z' || cast((o_orderkey * 31) % 301 AS varchar(9)) AS prod_codigo_zae, o_orderstatus AS prod_finca
FROM {orders}
"""


def tables_of(name: str) -> list[str]:
    """Input tables named in a view."""
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))


#: Joins of a view as Spark runs them: orders meet their customers first, so the larger lineitem is shuffled by its order only.
_CHAIN = "JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey"
_NESTED = "JOIN ({orders} JOIN {customer} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the parquet tables of a folder."""
    inputs = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(name)}
    return spark.sql(VIEWS[name].replace(_CHAIN, _NESTED), **inputs)


def duckdb_text(name: str) -> str:
    """The same view with plain table names."""
    return VIEWS[name].format(**{t: t for t in tables_of(name)}).strip()
