"""Thresholds and fixed name lists."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Thresholds of the dataset build; every one can be replaced."""

    season_start_month: int = 6
    first_season: str = "2020_2021"
    days_per_month: float = 30.44
    restart_gap_days: int = 21
    open_gap_days: int = 1
    open_cycle_days: int = 365
    min_age_days: int = 180
    max_age_days: int = 340
    min_tch: float = 20.0
    max_tch: float = 150.0
    early_end: int = 90
    mid_end: int = 180
    base_temperature: float = 10.0
    pentad_days: float = 5.0
    ocean_lead_days: int = 180
    min_optical_days: int = 7
    max_optical_gap: int = 60
    min_pentads: int = 30
    max_duration_months: float = 14.0
    min_ndvi_peak: float = 0.60
    min_ndvi_amplitude: float = 0.40


# Names that make up the input and output contract.
OPTICAL_INDEXES = ("ndvi", "evi2", "gndvi", "ndre", "lswi", "ndvire", "cire", "ndwi11", "msi11")

AGRONOMY = (
    "ingenio",
    "grupo_de_suelo",
    "grupo_de_humedad",
    "codigo_zae",
    "familia_de_suelo",
    "variedad",
    "no_corte",
)
PROD_COLUMNS = tuple(f"prod_{name}" for name in AGRONOMY)

KEY = "cod_cg_zafra"
LOT = "cod_cg"
SEASON = "zafra_norm"
TARGET = "tch"

# Statistics of each optical index that the dataset keeps, in output order.
OPTICAL_OUTPUT = {
    "ndvi": (
        "mean_0_180", "mean_0_asof", "mean_181_asof", "mean_last30", "mean_last60",
        "peak_0_180", "peak_0_asof", "min_0_180", "amplitude_0_180", "amplitude_0_asof",
        "slope_0_180", "slope_0_asof", "slope_181_asof", "last_value_before_asof",
    ),
    "evi2": ("mean_0_180", "mean_0_asof", "mean_last30", "peak_0_asof", "slope_0_asof"),
    "gndvi": ("mean_0_180", "mean_0_asof", "mean_last30", "peak_0_asof", "slope_0_asof"),
    "ndre": ("mean_0_180", "mean_0_asof", "mean_181_asof", "mean_last30", "peak_0_asof", "slope_0_asof"),
    "lswi": ("mean_0_asof", "mean_181_asof", "mean_last30"),
    "ndvire": ("mean_0_asof", "mean_181_asof"),
    "cire": ("mean_0_asof", "mean_181_asof"),
    "ndwi11": ("mean_0_asof", "mean_181_asof"),
    "msi11": ("mean_0_asof", "mean_181_asof"),
}

# Coverage statistics, taken from the ndvi series only.
COVERAGE_OUTPUT = (
    "obs_count_0_180", "obs_count_0_asof", "obs_count_181_asof", "obs_count_last30",
    "max_gap_days_0_180", "max_gap_days_0_asof", "boundary_max_gap_days_0_180",
)

# Cycle columns that head the dataset.
CYCLE_OUTPUT = (
    "cod_cg_zafra", "cod_cg", "zafra_norm", "dataset_role", "cycle_status", "has_target_tch",
    "area", "tch", "tc", "fecha_inicio_ciclo", "fecha_inicio_baseline", "fecha_cierre_real",
    "fecha_cierre_estimada", "fecha_fin_ciclo", "as_of_date", "as_of_age_days",
    "min_prediction_age_days", "max_prediction_age_days", "cycle_duration_days", "start_rule",
    "start_correction_days", "zafra_assignment_method", "cod_cg_zafra_original",
    "zafra_norm_original", "previous_zafra_norm", "previous_fecha_inicio_ciclo",
    "previous_fecha_cierre", "previous_tch", "previous_tc", "prod_edad_meses",
)
MATCH_OUTPUT = (
    "stac_lote_matched", "stac_lote_match_method",
    "climate_lote_matched", "climate_lote_match_method",
)
FLAG_OUTPUT = (
    "asof_valid", "asof_optical_obs_ok", "asof_optical_gap_ok",
    "asof_climate_coverage_ok", "asof_cycle_duration_ok", "asof_ndvi_shape_ok",
)
CLIMATE_OUTPUT = (
    "climate_pentad_count_0_asof", "climate_pentad_count_0_180", "climate_pentad_count_181_asof",
    "climate_precip_acc_0_asof", "climate_precip_acc_0_180", "climate_precip_acc_181_asof",
    "climate_precip_acc_last30", "climate_precip_acc_last60",
    "climate_eto_acc_0_asof", "climate_eto_acc_0_180",
    "climate_rad_acc_0_asof", "climate_rad_acc_0_180",
    "climate_water_balance_acc_0_asof", "climate_water_balance_acc_0_180",
    "climate_gdd_10c_acc_0_asof", "climate_gdd_10c_acc_0_180",
    "climate_precip_per_day_0_asof", "climate_eto_per_day_0_asof", "climate_rad_per_day_0_asof",
    "climate_water_balance_per_day_0_asof", "climate_gdd_10c_per_day_0_asof",
    "climate_tmean_mean_0_asof", "climate_tmax_mean_0_asof", "climate_tmin_mean_0_asof",
    "climate_rh_mean_0_asof",
    "climate_water_balance_slope_0_asof", "climate_precip_slope_0_asof", "climate_rad_slope_0_asof",
)
OCEAN_OUTPUT = (
    "enso_month_count_asof",
    "enso_oni_precycle_mean", "enso_oni_asof_mean", "enso_oni_abs_max_asof",
    "enso_nino34_precycle_mean", "enso_nino34_asof_mean",
    "enso_soi_precycle_mean", "enso_soi_asof_mean",
)


def optical_output() -> list[str]:
    """Names of the optical columns of the dataset, in output order."""
    coverage = [f"optical_{stat}" for stat in COVERAGE_OUTPUT]
    return coverage + [f"optical_{index}_{stat}" for index, stats in OPTICAL_OUTPUT.items() for stat in stats]


def dataset_output() -> list[str]:
    """All column names of the dataset, in output order."""
    return [
        *CYCLE_OUTPUT, *PROD_COLUMNS, *MATCH_OUTPUT, *FLAG_OUTPUT,
        *optical_output(), *CLIMATE_OUTPUT, *OCEAN_OUTPUT,
    ]
