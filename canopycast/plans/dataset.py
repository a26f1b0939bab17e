"""The dataset build: raw tables in, one feature row per cycle out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import CLIMATE_OUTPUT, FLAG_OUTPUT, KEY, LOT, MATCH_OUTPUT, OCEAN_OUTPUT, Settings, dataset_output, optical_output
from ..functions.scalars import per_day
from ..operators import asof, cycles, keys
from ..sources.staging import staged, staged_together

DEFAULTS = Settings()
#: Columns of an eligible cycle that features and flags are made from.
DATED = (asof.UID, KEY, asof.START, asof.AS_OF, "as_of_age_days", "cycle_duration_days", "stac_lote_matched", "climate_lote_matched")


@dataclass(frozen=True)
class Tables:
    """Raw inputs. ``climate_lookup`` (lot, matched station) replaces key matching when given."""

    production: DataFrame
    optical: DataFrame
    climate: DataFrame
    ocean: DataFrame
    climate_lookup: DataFrame | None = None


def build_spine(t: Tables, s: Settings = DEFAULTS, described: bool = True) -> DataFrame:
    """Closed and open cycles with their matched source keys.

    Closed cycles and source keys have several consumers each, so they are staged: both are small
    next to the series they come from. Without ``described`` only the columns that features depend
    on are staged, as Spark cannot see beyond a staged table which columns its readers leave out.
    """
    closed = cycles.closed_cycles(cycles.production_rows(t.production, s), s)
    ready = staged_together(
        {
            "closed": closed if described else closed.select(*cycles.DATED),
            "optical-keys": keys.dated_keys(t.optical, "lote", "fecha"),
            "climate-keys": keys.dated_keys(t.climate, "cod_cg", "fecha_inicio"),
        }
    )
    closed, optical_keys, climate_keys = ready["closed"], ready["optical-keys"], ready["climate-keys"]
    lots = keys.distinct_keys(t.production, "lote")
    optical = keys.key_match(lots, optical_keys, "stac")
    if t.climate_lookup is None:
        climate = keys.key_match(lots, climate_keys, "climate")
    else:
        method = F.when(F.col("climate_lote_matched").isNotNull(), "given").otherwise("no_match")
        climate = t.climate_lookup.withColumn("climate_lote_match_method", method)
    sources = [(optical_keys, optical, "stac_lote_matched"), (climate_keys, climate, "climate_lote_matched")]
    spine = cycles.cycle_spine(closed, cycles.open_cycles(closed, sources, s))
    spine = spine.join(optical, LOT, "left").join(climate, LOT, "left")
    return spine if described else spine.select(KEY, *cycles.DATED, "natural_asof_limit_date", *MATCH_OUTPUT)


def eligible_spine(t: Tables, s: Settings = DEFAULTS, described: bool = True, flagged: bool = False) -> DataFrame:
    """Eligible cycles, staged: four consumers read them, each only the columns it needs.

    Without ``described`` they have the ``DATED`` columns alone; with ``flagged`` also ``duplicate_key``, counted while the
    rows are still dealt by lot.
    """
    eligible = cycles.eligible_cycles(build_spine(t, s, described), s)
    if flagged:
        eligible = cycles.flag_duplicate_keys(eligible)
    return staged(eligible if described else eligible.select(*DATED, *["duplicate_key"] * flagged), "cycles")


def assemble(spine: DataFrame, optical: DataFrame, climate: DataFrame, ocean: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Join the aggregated features to the cycles and add rates and flags."""
    rows = spine.join(optical, asof.UID, "left").join(climate, asof.UID, "left")
    rows = asof.with_ocean(rows, asof.per_cycle(spine, ocean)).fillna(0.0, ["enso_month_count_asof"])
    rows = asof.fill_no_climate(rows)
    rates = {
        f"climate_{name}_per_day_0_asof": per_day(F.col(f"climate_{name}_acc_0_asof"), F.col("as_of_age_days"))
        for name in ("precip", "eto", "rad", "water_balance", "gdd_10c")
    }
    return rows.withColumns({**rates, **asof.quality_flags(s)})


def dataset(t: Tables, s: Settings = DEFAULTS, valid_only: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """The whole build. Extra columns at the end: ``cycle_uid`` and ``duplicate_key``.

    With ``columns`` it gives these alone; what describes the cycles is carried only if it is among them.
    """
    columns = columns or [*dataset_output(), asof.UID, "duplicate_key"]
    features = {*DATED, "duplicate_key", *FLAG_OUTPUT, *optical_output(), *CLIMATE_OUTPUT, *OCEAN_OUTPUT}
    spine = eligible_spine(t, s, described=not features.issuperset(columns), flagged="duplicate_key" in columns)
    optical_days = asof.optical_daily(asof.dated_between(t.optical, "fecha", spine))
    climate_days = asof.climate_daily(asof.dated_between(t.climate, "fecha_inicio", spine), s)
    optical = asof.join_daily(spine, optical_days, "stac_lote_matched")
    rows = assemble(
        spine,
        asof.optical_core(optical, s),
        asof.climate_features(spine, climate_days, s),
        asof.ocean_core(spine, t.ocean, s),
        s,
    )
    if valid_only:
        rows = rows.where("asof_valid")
    return rows.select(*columns)

