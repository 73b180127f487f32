"""County-year records: unpack, join, type, derive, check, load."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions.numeric import (
    attempt,
    attempt_total,
    lenient_double,
    lenient_long,
    percent,
    strict,
    strict_total,
    total,
)
from yearling.operators import quality as q
from yearling.operators.joins import lookup_join, unmatched
from yearling.operators.load import insert_skip_existing
from yearling.schemas import COUNTY_YEAR
from yearling.sources.matrix import parse_matrix, unpack, unpack_or_tell
from yearling.sources.staging import staged


# The survey variables of the main source, by column.
MAIN_CELLS = {
    "state_fips": "state",
    "county_fips": "county",
    "county_name": "NAME",
    "population": "B01001_001E",
    "median_age": "B01002_001E",
    "white_population": "B02001_002E",
    "black_population": "B02001_003E",
    "hispanic_population": "B03003_003E",
    "education_25_plus": "B15003_001E",
    "median_household_income": "B19013_001E",
    "poverty_population": "B17001_001E",
    "below_poverty": "B17001_002E",
    "population_16_plus": "B23025_001E",
    "civilian_labor_force": "B23025_003E",
    "unemployed": "B23025_005E",
    "housing_units": "B25001_001E",
    "total_housing_units": "B25002_001E",
    "vacant_housing_units": "B25002_003E",
    "occupied_housing_units": "B25003_001E",
    "owner_occupied_units": "B25003_002E",
    "average_household_size": "B25010_001E",
    "median_gross_rent": "B25064_001E",
    "median_home_value": "B25077_001E",
}

# The variables of the second source.
MOBILITY_CELLS = {
    "county_fips": "county",
    "population_1_plus": "B07001_001E",
    "moved_within_county": "B07001_033E",
    "moved_from_other_county_same_state": "B07001_049E",
    "moved_from_other_state": "B07001_065E",
    "moved_from_abroad": "B07001_081E",
}

# Columns added up from whole-number cells.
SUMMED_CELLS = {
    "under_18": [
        "B01001_003E",
        "B01001_004E",
        "B01001_005E",
        "B01001_006E",
        "B01001_027E",
        "B01001_028E",
        "B01001_029E",
        "B01001_030E",
    ],
    "over_65": [
        "B01001_020E",
        "B01001_021E",
        "B01001_022E",
        "B01001_023E",
        "B01001_024E",
        "B01001_025E",
        "B01001_044E",
        "B01001_045E",
        "B01001_046E",
        "B01001_047E",
        "B01001_048E",
        "B01001_049E",
    ],
    "bachelors_degree": [
        "B15003_022E",
        "B15003_023E",
        "B15003_024E",
        "B15003_025E",
    ],
}
FOREIGN_BORN = [
    "B05001_001E",
    "B05001_002E",
]

# percentage = part / whole * 100.
RATIOS = {
    "pct_under_18": ("under_18", "population"),
    "pct_over_65": ("over_65", "population"),
    "pct_white": ("white_population", "population"),
    "pct_black": ("black_population", "population"),
    "pct_hispanic": ("hispanic_population", "population"),
    "pct_bachelors_or_higher": ("bachelors_degree", "education_25_plus"),
    "pct_below_poverty": ("below_poverty", "poverty_population"),
    "labor_force_participation_rate": ("civilian_labor_force", "population_16_plus"),
    "unemployment_rate": ("unemployed", "civilian_labor_force"),
    "homeownership_rate": ("owner_occupied_units", "occupied_housing_units"),
    "vacancy_rate": ("vacant_housing_units", "total_housing_units"),
    "pct_foreign_born": ("foreign_born", "population"),
    "pct_moved_last_year": ("moved_last_year", "population_1_plus"),
}
MOVED_PARTS = [
    "moved_within_county",
    "moved_from_other_county_same_state",
    "moved_from_other_state",
    "moved_from_abroad",
]

KEY = ["year", "state_fips", "county_fips"]

# The thirty checks are these 28 plus row count and unique key.
CHECKS = [
    *[
        q.not_missing(c)
        for c in (
            "year",
            "state",
            "state_fips",
            "county_fips",
            "county_name",
            "population",
            "population_1_plus",
        )
    ],
    q.positive("population"),
    q.positive("population_1_plus"),
    *[q.percentage(c) for c in RATIOS],
    q.parts_within("ages_within_population", ["under_18", "over_65"], "population"),
    q.reconcile(
        "housing_reconciles",
        ["vacant_housing_units", "occupied_housing_units"],
        "total_housing_units",
    ),
    q.chain(
        "labor_force_bounds", ["unemployed", "civilian_labor_force", "population_16_plus"]
    ),
    q.reconcile("mobility_reconciles", MOVED_PARTS, "moved_last_year"),
    q.chain("moved_bounds", ["moved_last_year", "population_1_plus"]),
    q.rederived(
        "foreign_born_reconciles", "population - (population - foreign_born)", "foreign_born"
    ),
]


_ALL_MAIN = MAIN_CELLS | {
    c: c for codes in [*SUMMED_CELLS.values(), FOREIGN_BORN] for c in codes
}
_ALL_MOBILITY = {"state_fips": "state"} | MOBILITY_CELLS


def unpack_main(documents: DataFrame, text: str = "value") -> DataFrame:
    """(year, state, position, named cells, cells to add up) per county."""
    return unpack(documents, parse_matrix(text), _ALL_MAIN, keep=["year", "state"])


def unpack_mobility(documents: DataFrame, text: str = "value") -> DataFrame:
    return unpack(documents, parse_matrix(text), _ALL_MOBILITY, keep=["year"])


def with_sums(main: DataFrame) -> DataFrame:
    """Strict sums: text or a missing cell fails, as a broken source should."""
    foreign_born = strict("foreign_born", "{0} - {1}", FOREIGN_BORN)
    return main.selectExpr(
        "*",
        *[f"{strict_total(name, codes)} as {name}" for name, codes in SUMMED_CELLS.items()],
        f"{foreign_born} as foreign_born",
    )


def typed(records: DataFrame) -> DataFrame:
    """Cells to their declared types, missing where not a number; 34 columns."""
    casts = {"bigint": lenient_long, "double": lenient_double}
    made = {*SUMMED_CELLS, "foreign_born", "year"}
    later = {*RATIOS, "moved_last_year"}
    columns = []
    for field in COUNTY_YEAR:
        kind = field.dataType.simpleString()
        if field.name in made or kind == "string":
            columns.append(field.name)
        elif field.name not in later:
            columns.append(f"{casts[kind](field.name)} as {field.name}")
    return records.selectExpr(*columns)


def derived(records: DataFrame) -> DataFrame:
    """Add `moved_last_year` and the percentages; 48 columns in declared order."""
    added = records.selectExpr("*", f"{total(MOVED_PARTS)} as moved_last_year")
    ratios = [f"{percent(part, whole)} as {name}" for name, (part, whole) in RATIOS.items()]
    return added.selectExpr("*", *ratios).select(*COUNTY_YEAR.fieldNames())


def county_records(main_documents: DataFrame, mobility_documents: DataFrame) -> DataFrame:
    """Both sources to the 48-column county-year frame."""
    main = with_sums(unpack_main(main_documents)).drop("position")
    joined = lookup_join(main, unpack_mobility(mobility_documents), KEY, "position")
    return derived(typed(joined))


def with_sums_or_problem(main: DataFrame) -> DataFrame:
    """As `with_sums`, but a row whose cells cannot be added says so in `problem`."""
    sums = {name: attempt_total(name, codes) for name, codes in SUMMED_CELLS.items()}
    sums["foreign_born"] = attempt("foreign_born", "{0} - {1}", FOREIGN_BORN)
    added = main.selectExpr("*", *[f"{number} as {name}" for name, (number, _) in sums.items()])
    tried = [f"if(problem is null and {name} is null, {p}, null)" for name, (_, p) in sums.items()]
    others = [c for c in added.columns if c != "problem"]
    return added.selectExpr(*others, f"coalesce(problem, {', '.join(tried)}) as problem")


def whole_or_problem(cells: DataFrame) -> DataFrame:
    """A row with a fraction where the table has a whole number says so in `problem`:
    as a whole number it would be lost without a trace."""
    kinds = {f.name: f.dataType.simpleString() for f in COUNTY_YEAR}
    lost = [
        f"if({lenient_double(c)} is not null and {lenient_long(c)} is null,"
        f" concat('{c}: not a whole number: ', {c}), null)"
        for c in cells.columns
        if kinds.get(c) == "bigint" and c in {*MAIN_CELLS, *MOBILITY_CELLS}
    ]
    others = [c for c in cells.columns if c != "problem"]
    return cells.selectExpr(*others, f"coalesce(problem, {', '.join(lost)}) as problem")


@dataclass(frozen=True)
class CountySources:
    """`records` of the sound documents, and `problems` of the others: (year, state, source,
    rows, problem), a row for each year, state and source that has any."""

    records: DataFrame
    problems: DataFrame


def county_sources(main_documents: DataFrame, mobility_documents: DataFrame) -> CountySources:
    """As `county_records`, but a document that cannot be read spoils its own year only.

    Cells are stored, so that records and problems come from one parse of each document.
    """
    keep = ["year", "state"]
    main = unpack_or_tell(main_documents, "value", _ALL_MAIN, keep)
    main = staged(whole_or_problem(with_sums_or_problem(main)), "main-cells")
    mobility = unpack_or_tell(mobility_documents, "value", _ALL_MOBILITY, keep)
    mobility = staged(whole_or_problem(mobility), "mobility-cells")
    told = [
        cells.filter("problem is not null")
        .groupBy("year", "state")
        .agg(F.count("*").alias("rows"), F.min("problem").alias("problem"))
        .selectExpr("year", "state", f"'{source}' as source", "rows", "problem")
        for source, cells in (("main", main), ("mobility", mobility))
    ]
    sound = [c.filter("problem is null").drop("problem") for c in (main, mobility)]
    joined = lookup_join(sound[0].drop("position"), sound[1].drop("state"), KEY, "position")
    return CountySources(derived(typed(joined)), told[0].unionByName(told[1]))


def unmatched_counties(main_documents: DataFrame, mobility_documents: DataFrame) -> DataFrame:
    """(year, state_fips, county_fips, county_name) of the counties that `county_records`
    drops, as the second source has no row for them."""
    main = unpack_main(main_documents).select(*KEY, "county_name")
    return unmatched(main, unpack_mobility(mobility_documents), KEY)


def landed_years(*documents: DataFrame) -> DataFrame:
    """The years of which any source landed a document: each must have records."""
    years = [d.select("year") for d in documents]
    return reduce(DataFrame.unionByName, years).distinct()


def check(
    records: DataFrame,
    batches: list[int] | DataFrame,
    expected_rows: int | None = 46,
    problems: DataFrame | None = None,
) -> DataFrame:
    """The thirty checks per year, in long form. `batches` are the years that must be
    there (`landed_years`, or a list); one without a record fails its row count.

    `problems` of the sources are failed checks of their years, and name what is wrong.
    """
    report = q.report(records, "year", CHECKS, KEY, expected_rows, batches)
    if problems is None:
        return report
    name = "concat('source ', source, ' of ', coalesce(state, 'no state'), ': ', problem)"
    return report.unionByName(
        problems.selectExpr(
            "year as batch", f"{name} as check_name", "rows as violations", "false as passed"
        )
    )


class BackfillStopped(ValueError):
    """A year failed its checks. `loaded` counts the rows of the years before it."""

    def __init__(self, reason: str, loaded: DataFrame | None):
        super().__init__(reason)
        self.loaded = loaded


def backfill(
    records: DataFrame,
    table: str,
    batches: list[int] | DataFrame,
    expected_rows: int | None = 46,
    problems: DataFrame | None = None,
) -> DataFrame | None:
    """Load years up to the first that fails a check, then raise if one did.

    Returns (year, read, inserted, skipped) of the years loaded, counted by the writes;
    None if there was nothing to load. `records` is read by the checks and by the load:
    give a stored table. `problems` are those of `county_sources`.
    """
    report = staged(check(records, batches, expected_rows, problems), "quality-report")
    failed = report.filter("not passed")
    # A row per year that was landed.
    years = [r.batch for r in report.select("batch").distinct().orderBy("batch").collect()]
    first = failed.selectExpr("min(batch)").first()[0]
    good = records if first is None else records.filter(f"year < {first}")
    years = [y for y in years if y is not None and (first is None or y < first)]
    loaded = None
    if first is None or not good.isEmpty():
        loaded = insert_skip_existing(good, table, records.columns, KEY, ("year", years))
    if first is not None:
        try:
            q.require_passed(failed.filter(f"batch = {first}"))
        except ValueError as reason:
            raise BackfillStopped(str(reason), loaded) from None
    return loaded


def county_panel(records: DataFrame) -> DataFrame:
    """The model contract's names over county-year rows, before growth is added."""
    return records.selectExpr(
        "*", "concat(state_fips, county_fips) as location_id", "int(year) as feature_year"
    )
