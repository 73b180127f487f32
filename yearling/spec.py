"""Column roles of a panel, so that no operator hard-codes a name."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The feature columns of the county panel, in model order.
COUNTY_FEATURES = (
    "population",
    "historical_growth_1yr",
    "median_age",
    "pct_under_18",
    "pct_over_65",
    "pct_white",
    "pct_black",
    "pct_hispanic",
    "median_household_income",
    "pct_below_poverty",
    "labor_force_participation_rate",
    "unemployment_rate",
    "total_housing_units",
    "homeownership_rate",
    "vacancy_rate",
    "average_household_size",
    "pct_foreign_born",
    "pct_moved_last_year",
)


@dataclass(frozen=True)
class PanelSpec:
    """One row per (key, time); `past` is known at `time`, `target` is not."""

    key: str = "location_id"
    label: str = "county_name"
    time: str = "feature_year"
    value: str = "population"
    past: str = "historical_growth_1yr"
    target: str = "future_growth_1yr"
    features: tuple[str, ...] = COUNTY_FEATURES

    def with_features(self, *features: str) -> PanelSpec:
        return replace(self, features=tuple(features))

    @property
    def persistence_columns(self) -> list[str]:
        """The short column list the persistence forecast needs."""
        return [self.key, self.label, self.time, self.value, self.past, self.target]

    @property
    def model_columns(self) -> list[str]:
        """Identity columns, every feature, then the target."""
        wanted = [self.key, self.label, self.time, *self.features, self.target]
        return list(dict.fromkeys(wanted))
