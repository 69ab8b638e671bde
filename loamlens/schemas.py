"""Declared schemas and the immutable feature list of the training frame."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Column names of the input tables and of the feature frame, and the
# constants of the matching and of the report.
WEATHER_NUMERIC = (
    "sample_year", "sample_latitude", "sample_longitude",
    "avg_temperature", "max_temperature", "min_temperature",
    "total_precipitation", "avg_relative_humidity", "growing_degree_days",
)
CHEMICAL_COLUMNS = (
    "ph_h2o", "ph_cacl2", "estimated_organic_carbon",
    "total_carbon_ncs", "total_nitrogen_ncs", "carbon_to_nitrogen_ratio",
    "cec_nh4_ph_7", "base_sat_nh4oac_ph_7", "ca_nh4_ph_7",
    "mg_nh4_ph_7", "k_nh4_ph_7", "na_nh4_ph_7",
)
PHYSICAL_COLUMNS = (
    "clay_total", "silt_total", "sand_total",
    "bulk_density_oven_dry", "water_retention_15_bar", "particle_density_less_than_2mm",
)
DERIVED_NUMERIC = ("soil_quality_score", "temp_optimality", "ca_mg_ratio")
DERIVED_CATEGORICAL = ("gdd_suitability",)
SAMPLE_KEY = "pedlabsampnum"
LAB_KEY = "labsampnum"
COMMODITIES = ("CORN", "SOYBEANS", "WHEAT", "COTTON", "BARLEY")
FIRST_CROP_YEAR, LAST_CROP_YEAR = 1948, 2025
MAX_LOOKBACK_YEARS = 10
YIELD_LOW, YIELD_HIGH = 0.0, 1000.0
HOLDOUT_SHARE = 0.2
SEED = 42
CV_FOLDS = 5
NEIGHBOURS = 10
HIGH_VARIANCE_QUANTILE = 0.9
BAD_FOLD_R2 = 0.3


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


def _doubles(names) -> dict[str, T.DataType]:
    return {name: T.DoubleType() for name in names}


WEATHER_SCHEMA = _struct(**{
    SAMPLE_KEY: T.StringType(),
    "sample_year": T.IntegerType(),
    **_doubles(WEATHER_NUMERIC[1:]),
    "climate_region": T.StringType(),
})
CHEMICAL_SCHEMA = _struct(**{LAB_KEY: T.StringType(), **_doubles(CHEMICAL_COLUMNS)})
PHYSICAL_SCHEMA = _struct(**{LAB_KEY: T.StringType(), **_doubles(PHYSICAL_COLUMNS)})
CROP_SCHEMA = _struct(
    commodity_desc=T.StringType(), statisticcat_desc=T.StringType(), year=T.StringType(),
    value=T.StringType(), state_name=T.StringType(), county_name=T.StringType(),
    unit_desc=T.StringType(),
)
VERTEX_SCHEMA = _struct(
    poly=T.StringType(), part=T.IntegerType(), ring=T.IntegerType(), seq=T.IntegerType(),
    lon=T.DoubleType(), lat=T.DoubleType(),
)


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are features, target and group. Never mutated; derive a new one instead."""

    numeric: tuple[str, ...] = WEATHER_NUMERIC + CHEMICAL_COLUMNS + PHYSICAL_COLUMNS
    categorical: tuple[str, ...] = ("climate_region", "commodity_desc", "state_name")
    target: str = "yield_value"
    group: str = SAMPLE_KEY
    impute_group: str = "state_name"

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def with_derived(self) -> "FeatureSpec":
        """The feature list once the derived columns have been added."""
        return replace(
            self,
            numeric=self.numeric + tuple(c for c in DERIVED_NUMERIC if c not in self.numeric),
            categorical=self.categorical
            + tuple(c for c in DERIVED_CATEGORICAL if c not in self.categorical),
        )
