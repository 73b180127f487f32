"""Declared table schemas. Nothing is inferred from a batch."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_TEXT, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Table and column names as the stored tables have them, in their order.
COUNTY_YEAR = _table(
    [
        ("year", _LONG),
        ("state", _TEXT),
        ("state_fips", _TEXT),
        ("county_fips", _TEXT),
        ("county_name", _TEXT),
        ("population", _LONG),
        ("median_age", _DOUBLE),
        ("under_18", _LONG),
        ("over_65", _LONG),
        ("white_population", _LONG),
        ("black_population", _LONG),
        ("hispanic_population", _LONG),
        ("education_25_plus", _LONG),
        ("bachelors_degree", _LONG),
        ("median_household_income", _DOUBLE),
        ("poverty_population", _LONG),
        ("below_poverty", _LONG),
        ("population_16_plus", _LONG),
        ("civilian_labor_force", _LONG),
        ("unemployed", _LONG),
        ("housing_units", _LONG),
        ("total_housing_units", _LONG),
        ("vacant_housing_units", _LONG),
        ("occupied_housing_units", _LONG),
        ("owner_occupied_units", _LONG),
        ("average_household_size", _DOUBLE),
        ("median_gross_rent", _DOUBLE),
        ("median_home_value", _DOUBLE),
        ("foreign_born", _LONG),
        ("population_1_plus", _LONG),
        ("moved_within_county", _LONG),
        ("moved_from_other_county_same_state", _LONG),
        ("moved_from_other_state", _LONG),
        ("moved_from_abroad", _LONG),
        ("pct_under_18", _DOUBLE),
        ("pct_over_65", _DOUBLE),
        ("pct_white", _DOUBLE),
        ("pct_black", _DOUBLE),
        ("pct_hispanic", _DOUBLE),
        ("pct_bachelors_or_higher", _DOUBLE),
        ("pct_below_poverty", _DOUBLE),
        ("labor_force_participation_rate", _DOUBLE),
        ("unemployment_rate", _DOUBLE),
        ("homeownership_rate", _DOUBLE),
        ("vacancy_rate", _DOUBLE),
        ("pct_foreign_born", _DOUBLE),
        ("moved_last_year", _LONG),
        ("pct_moved_last_year", _DOUBLE),
    ]
)

MODEL_RUNS = _table(
    [
        ("run_id", _LONG),
        ("model_name", _TEXT),
        ("feature_start_year", _INT),
        ("feature_end_year", _INT),
        ("test_start_year", _INT),
        ("test_end_year", _INT),
        ("training_rows", _LONG),
        ("test_rows", _LONG),
        ("notes", _TEXT),
    ]
)

MODEL_METRICS = _table(
    [
        ("run_id", _LONG),
        ("model_name", _TEXT),
        ("test_year", _INT),
        ("training_rows", _LONG),
        ("test_rows", _LONG),
        ("growth_mae", _DOUBLE),
        ("growth_rmse", _DOUBLE),
        ("growth_r2", _DOUBLE),
        ("population_mae", _DOUBLE),
        ("population_mape", _DOUBLE),
    ]
)

PREDICTIONS = _table(
    [
        ("run_id", _LONG),
        ("model_name", _TEXT),
        ("test_year", _INT),
        ("location_id", _TEXT),
        ("county_name", _TEXT),
        ("feature_year", _INT),
        ("actual_population", _DOUBLE),
        ("predicted_population", _DOUBLE),
        ("population_error", _DOUBLE),
        ("absolute_population_error", _DOUBLE),
        ("absolute_percentage_error", _DOUBLE),
        ("actual_growth", _DOUBLE),
        ("predicted_growth", _DOUBLE),
    ]
)

# The columns of a forecast beside what happened.
ACTUAL_VS_PREDICTED = [
    "location_id",
    "county_name",
    "feature_year",
    "population",
    "future_growth_1yr",
    "predicted_growth_1yr",
    "predicted_population",
    "actual_population",
    "population_error",
    "population_error_pct",
    "prediction_error",
]
