"""SQL for DuckDB that gives each query's result on the same tables."""

from __future__ import annotations

TESTS = "(1997, 1998, 1999)"
# The first day of the year of the day after the last order: that year is not over.
END = "(select date_trunc('year', max(o_orderdate) + interval 1 day) from orders)"
STATUSES = {"finished": "F", "open": "O", "partial": "P"}
PRIORITIES = {
    "urgent": "1-URGENT",
    "high": "2-HIGH",
    "medium": "3-MEDIUM",
    "unspecified": "4-NOT SPECIFIED",
    "low": "5-LOW",
}
PAST, NEXT = "historical_growth_1yr", "future_growth_1yr"
METRICS = ["growth_mae", "growth_rmse", "growth_r2", "population_mae", "population_mape"]


def count_if(condition: str, name: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint) as {name}"


def rounded(names: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) as {n}" for n in names)


def grown(source: str) -> str:
    """Adds both growth columns to a CTE of (location_id, feature_year, population)."""
    w = "over (partition by location_id order by feature_year)"
    return f"""
      select q.* exclude (p0, p1, y0, y1),
             case when feature_year - y0 = 1 then cast(population as double) / p0 - 1 end as {PAST},
             case when y1 - feature_year = 1 then cast(p1 as double) / population - 1 end as {NEXT}
      from (select *, lag(population) {w} as p0, lead(population) {w} as p1,
                   lag(feature_year) {w} as y0, lead(feature_year) {w} as y1
            from {source}) q"""


SHARES = (
    [(s, f"o_orderstatus = '{v}'") for s, v in STATUSES.items()]
    + [(p, f"o_orderpriority = '{v}'") for p, v in PRIORITIES.items()]
    + [
        ("weekend", "isodow(o_orderdate) >= 6"),
        ("first_half", "month(o_orderdate) <= 6"),
        ("large", "cast(round(o_totalprice * 100) as bigint) > 25000000"),
        ("negative_balance", "c_acctbal < 0"),
    ]
)
FEATURES = [
    "population", PAST, "avg_price", "avg_balance", "min_price", "max_price",
    *[f"pct_{n}" for n, _ in SHARES],
]


def place_panel(by_segment: bool = True) -> str:
    place, label = "lpad(cast(n_nationkey as varchar), 2, '0')", "n_name"
    if by_segment:
        place, label = f"{place} || '-' || c_mktsegment", f"{label} || ' ' || c_mktsegment"
    shares = ", ".join(
        f"cast(count(*) filter (where {c}) as double) / count(*) * 100 as pct_{n}"
        for n, c in SHARES
    )
    return f"""
    counted as (
      select {place} as location_id, {label} as county_name,
             cast(year(o_orderdate) as integer) as feature_year,
             cast(count(*) as bigint) as population,
             cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / count(*) / 100 as avg_price,
             cast(sum(cast(round(c_acctbal * 100) as bigint)) as double) / count(*) / 100 as avg_balance,
             min(cast(round(o_totalprice * 100) as bigint)) / 100.0e0 as min_price,
             max(cast(round(o_totalprice * 100) as bigint)) / 100.0e0 as max_price,
             {shares}
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
      where o_orderdate < {END}
      group by 1, 2, 3),
    panel as ({grown('counted')})"""


def _parts() -> str:
    parts = [("o_orderstatus", s, v) for s, v in STATUSES.items()]
    parts += [("o_orderpriority", p, v) for p, v in PRIORITIES.items()]
    return ", ".join(count_if(f"{c} = '{v}'", f"n_{n}") for c, n, v in parts)


def customer_counts(where: str) -> str:
    return f"""
    counted as (
      select cast(o_custkey as varchar) as location_id,
             'Customer ' || cast(o_custkey as varchar) as county_name,
             cast(year(o_orderdate) as integer) as feature_year,
             cast(count(*) as bigint) as population, {_parts()}
      from orders {where} group by 1, 2, 3)"""


CUSTOMER_COUNTS = customer_counts("")
CUSTOMER_PANEL = (
    f"{customer_counts(f'where o_orderdate < {END}')}, panel as ({grown('counted')})"
)

ERRORS = f"""
    complete as (select * from panel where {PAST} is not null and {NEXT} is not null),
    raw_errors as (
      select *, population * (1 + {NEXT}) as actual_population,
             population * (1 + {PAST}) as predicted_population
      from complete),
    scored as (
      select *, predicted_population - actual_population as population_error,
             abs(predicted_population - actual_population) as absolute_population_error,
             abs(predicted_population - actual_population)
               / nullif(abs(actual_population), 0) * 100 as absolute_percentage_error,
             (predicted_population - actual_population)
               / nullif(actual_population, 0) * 100 as population_error_pct,
             {PAST} - {NEXT} as prediction_error
      from raw_errors)"""


def r2(actual: str, predicted: str) -> str:
    miss = f"sum(({predicted} - {actual}) * ({predicted} - {actual}))"
    return (
        f"case when count(*) < 2 then null when regr_syy({actual}, {actual}) = 0 then "
        f"case when {miss} = 0 then 1.0e0 else 0.0e0 end "
        f"else 1 - {miss} / regr_syy({actual}, {actual}) end"
    )


def metric_list(actual: str, predicted: str) -> str:
    return f"""avg(abs({predicted} - {actual})) as growth_mae,
        sqrt(avg(({predicted} - {actual}) * ({predicted} - {actual}))) as growth_rmse,
        {r2(actual, predicted)} as growth_r2,
        avg(absolute_population_error) as population_mae,
        avg(absolute_percentage_error) as population_mape"""


def fold_counts(source: str = "complete") -> str:
    return f"""
      select t.test_year,
             cast(count(*) filter (where feature_year < t.test_year) as bigint) as training_rows,
             cast(count(*) filter (where feature_year = t.test_year) as bigint) as test_rows,
             min(feature_year) filter (where feature_year < t.test_year) as first_training_year,
             max(feature_year) filter (where feature_year < t.test_year) as last_training_year
      from {source}, (select cast(unnest([1997, 1998, 1999]) as integer) as test_year) t
      group by 1"""


PERSISTENCE_FOLDS = f"""
    {ERRORS},
    found as (
      select feature_year as test_year, {metric_list(NEXT, PAST)}
      from scored where feature_year in {TESTS} group by 1),
    folds as (
      select c.*, {', '.join(f'found.{m}' for m in METRICS)}
      from ({fold_counts()}) c join found using (test_year)
      where training_rows > 0 and test_rows > 0)"""

FOLD_COLUMNS = (
    "test_year, training_rows, test_rows, first_training_year, last_training_year, "
    + rounded(METRICS)
)
COMPLETE = f"complete as (select * from panel where {PAST} is not null and {NEXT} is not null)"

# A panel whose growth follows from one feature, so that what a forest gives is known.
KNOWN_PANEL = f"""{place_panel()},
    known as (
      select location_id, county_name, feature_year, population, pct_weekend, {PAST},
             case when population % 2 = 1 then 0.25e0 else -0.125e0 end as {NEXT}
      from panel where {NEXT} is not null and {PAST} is not null)"""
KNOWN_FOLDS = f"""{KNOWN_PANEL},
    errors as (
      select *, population * (1 + {NEXT}) as actual_population,
             population * (1 + {PAST}) as predicted_population from known),
    scored as (
      select *, abs(predicted_population - actual_population) as absolute_population_error,
             abs(predicted_population - actual_population)
               / nullif(abs(actual_population), 0) * 100 as absolute_percentage_error
      from errors),
    folds as (
      select feature_year as test_year, {metric_list(NEXT, PAST)},
             avg(abs({NEXT} - {NEXT})) as rf_growth_mae, sqrt(avg({NEXT} - {NEXT})) as rf_growth_rmse,
             {r2(NEXT, NEXT)} as rf_growth_r2,
             avg(population * (1 + {NEXT}) - actual_population) as rf_population_mae,
             avg(population * (1 + {NEXT}) - actual_population) as rf_population_mape
      from scored where feature_year in {TESTS} group by 1)"""

# --- county documents ----------------------------------------------------------

_COUNTED = {
    **{f"m{m}": f"month(o_orderdate) = {m}" for m in range(1, 9)},
    **{f"d{d}": f"day(o_orderdate) = {d}" for d in range(1, 13)},
    **{f"w{w}": f"isodow(o_orderdate) = {w + 1}" for w in range(4)},
    **{s: f"o_orderstatus = '{v}'" for s, v in STATUSES.items()},
    **{p: f"o_orderpriority = '{v}'" for p, v in PRIORITIES.items()},
    "small": "cents < 5000000",
    "working": "cents >= 10000000",
    "idle": "cents >= 40000000",
}
NO_RENT = "(n_nationkey = 3 and year = 1997)"
COUNTY_BASE = f"""
    priced as (
      select n_nationkey, n_name, orders.*, cast(round(o_totalprice * 100) as bigint) as cents
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
    counts as (
      select cast(year(o_orderdate) as bigint) as year, n_nationkey, n_name,
             cast(count(*) as bigint) as total, cast(sum(cents) as bigint) as spent,
             {', '.join(count_if(c, n) for n, c in _COUNTED.items())}
      from priced group by 1, 2, 3),
    mainrows as (
      select * from counts
      union all select * from counts where n_nationkey = 5 and year = 1998)"""


def _ratio(part: str, whole: str) -> str:
    return f"cast({part} as double) / nullif({whole}, 0) * 100"


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
COUNTY = f"""
    {COUNTY_BASE},
    typed as (
      select year, 'ST' as state, '07' as state_fips,
             lpad(cast(n_nationkey as varchar), 3, '0') as county_fips, n_name as county_name,
             total as population, cast(total % 70 as double) + 0.5 as median_age,
             m1 + m2 + m3 + m4 + m5 + m6 + m7 + m8 as under_18,
             {' + '.join(f'd{d}' for d in range(1, 13))} as over_65,
             finished as white_population, open as black_population, partial as hispanic_population,
             total as education_25_plus, urgent + high + medium + unspecified as bachelors_degree,
             cast(floor(spent / 100.0e0) as double) as median_household_income,
             total as poverty_population, small as below_poverty, total as population_16_plus,
             working as civilian_labor_force, idle as unemployed,
             total as housing_units, total as total_housing_units,
             finished as vacant_housing_units,
             case when {NO_RENT} then open else open + partial end as occupied_housing_units,
             open as owner_occupied_units, 2.25e0 as average_household_size,
             case when not {NO_RENT} then cast(total * 3 as double) end as median_gross_rent,
             cast(null as double) as median_home_value, partial as foreign_born,
             total as population_1_plus, w0 as moved_within_county,
             w1 as moved_from_other_county_same_state, w2 as moved_from_other_state,
             w3 as moved_from_abroad, w0 + w1 + w2 + w3 as moved_last_year
      from mainrows where not (n_nationkey = 7 and year = 1996)),
    county as (select *, {', '.join(f'{_ratio(*r)} as {n}' for n, r in RATIOS.items())} from typed)"""

CELLS = {
    "state_fips": "'07'",
    "county_fips": "lpad(cast(n_nationkey as varchar), 3, '0')",
    "county_name": "n_name",
    "population": "total",
    "median_age": "cast(total % 70 as varchar) || '.5'",
    "white_population": "finished",
    "black_population": "open",
    "hispanic_population": "partial",
    "education_25_plus": "total",
    "median_household_income": "cast(floor(spent / 100.0e0) as bigint)",
    "poverty_population": "total",
    "below_poverty": "small",
    "population_16_plus": "total",
    "civilian_labor_force": "working",
    "unemployed": "idle",
    "housing_units": "total",
    "total_housing_units": "total",
    "vacant_housing_units": "finished",
    "occupied_housing_units": f"case when {NO_RENT} then open else open + partial end",
    "owner_occupied_units": "open",
    "average_household_size": "'2.25'",
    "median_gross_rent": f"case when not {NO_RENT} then total * 3 end",
    "median_home_value": "'n/a'",
}
MATRIX_ROWS = f"""with {COUNTY_BASE}
    select year, 'ST' as state, {', '.join(f'cast({v} as varchar) as {n}' for n, v in CELLS.items())}
    from mainrows"""

_REQUIRED = (
    "year", "state", "state_fips", "county_fips", "county_name", "population", "population_1_plus",
)
_MOVED = (
    "moved_within_county + moved_from_other_county_same_state + moved_from_other_state"
    " + moved_from_abroad"
)
CHECKS = {
    **{f"{c}_not_missing": f"{c} is null" for c in _REQUIRED},
    **{f"{c}_positive": f"{c} <= 0" for c in ("population", "population_1_plus")},
    **{f"{c}_range": f"{c} is null or {c} < 0 or {c} > 100" for c in RATIOS},
    "ages_within_population": "under_18 > population or over_65 > population",
    "housing_reconciles": "vacant_housing_units + occupied_housing_units "
    "is distinct from total_housing_units or total_housing_units is null",
    "labor_force_bounds": "civilian_labor_force < 0 or civilian_labor_force > population_16_plus"
    " or unemployed < 0 or unemployed > civilian_labor_force",
    "mobility_reconciles": f"{_MOVED} is distinct from moved_last_year or moved_last_year is null",
    "moved_bounds": "moved_last_year < 0 or moved_last_year > population_1_plus",
    "foreign_born_reconciles": "foreign_born is null or population is null",
}
_CHECKED = f"""
      select year as batch, 'row_count' as check_name,
             cast(abs(count(*) - 25) as bigint) as violations from found group by 1
      union all
      select year, 'unique_key',
             cast(count(*) - count(distinct (state_fips, county_fips)) as bigint)
      from found group by 1
      {' '.join(
          f"union all select year, '{n}', cast(count(*) filter (where {c}) as bigint) "
          "from found group by 1" for n, c in CHECKS.items())}"""
# The second source lands nothing for 2000, so that year has no records.
DQ = f"""{COUNTY},
    found as (select * from county where year <> 2000),
    checked as ({_CHECKED}
      union all select 2000, 'row_count', 25
      {' '.join(f"union all select 2000, '{n}', 0" for n in CHECKS)})"""
BACKFILL = f"""{COUNTY},
    found as (select * from county),
    checked as ({_CHECKED})"""

# The main documents of 1997, 1999 and 2000 cannot be read.
_UNREADABLE = {
    1997: "not JSON rows of cells",
    1999: "no cell B01001_003E",
    2000: "no header row",
}
BROKEN = f"""{COUNTY},
    found as (select * from county where year not in (1997, 1999, 2000)),
    counted as ({_CHECKED}),
    checked as (
      select * from counted where check_name <> 'row_count'
      {' '.join(
          f"union all select {y}, 'source main of ST: {p}', 1" for y, p in _UNREADABLE.items())})"""

# --- calendar ------------------------------------------------------------------

_MOVING = [
    ("New Year''s Day", "month(d) = 1 and day(d) = 1"),
    ("Independence Day", "month(d) = 7 and day(d) = 4"),
    ("Veterans Day", "month(d) = 11 and day(d) = 11"),
    ("Christmas Day", "month(d) = 12 and day(d) = 25"),
]
_WEEKLY = [
    ("Martin Luther King Jr. Day", "month(d) = 1 and isodow(d) = 1 and day(d) between 15 and 21"),
    ("Washington''s Birthday", "month(d) = 2 and isodow(d) = 1 and day(d) between 15 and 21"),
    ("Memorial Day", "month(d) = 5 and isodow(d) = 1 and day(d) >= 25"),
    ("Labor Day", "month(d) = 9 and isodow(d) = 1 and day(d) <= 7"),
    ("Columbus Day", "month(d) = 10 and isodow(d) = 1 and day(d) between 8 and 14"),
    ("Thanksgiving Day", "month(d) = 11 and isodow(d) = 4 and day(d) between 22 and 28"),
]
HOLIDAYS = f"""
    dated as (select o_orderkey, cast(o_orderdate as date) as order_date from orders),
    used_years as (select distinct year(order_date) as y from dated),
    bounds as (select min(order_date) as lo, max(order_date) as hi from dated),
    days as (
      select cast(unnest(generate_series(make_date(year(lo), 1, 1), make_date(year(hi) + 1, 1, 1),
                                         interval 1 day)) as date) as d from bounds),
    named as (
      {' union all '.join(f"select d, '{n}' as n, true as moves from days where {c}" for n, c in _MOVING)}
      union all
      {' union all '.join(f"select d, '{n}', false from days where {c}" for n, c in _WEEKLY)}),
    all_holidays as (
      select d as holiday_date, n as holiday_name from named
      union all
      select cast(d - interval 1 day as date), n || ' (observed)' from named where moves and isodow(d) = 6
      union all
      select cast(d + interval 1 day as date), n || ' (observed)' from named where moves and isodow(d) = 7),
    holidays as (
      select * from all_holidays where year(holiday_date) in (select y from used_years))"""



def _on(month: int, day: int) -> str:
    return f"month(d) = {month} and day(d) = {day}"


def _after_easter(days: int) -> str:
    return f"d = easter + {days}"


_EVERYWHERE_OFF = {
    "AT": [
        ("Neujahr", _on(1, 1)),
        ("Heilige Drei Könige", _on(1, 6)),
        ("Staatsfeiertag", _on(5, 1)),
        ("Mariä Himmelfahrt", _on(8, 15)),
        ("Nationalfeiertag", _on(10, 26)),
        ("Allerheiligen", _on(11, 1)),
        ("Mariä Empfängnis", _on(12, 8)),
        ("Christtag", _on(12, 25)),
        ("Stefanitag", _on(12, 26)),
        ("Ostermontag", _after_easter(1)),
        ("Christi Himmelfahrt", _after_easter(39)),
        ("Pfingstmontag", _after_easter(50)),
        ("Fronleichnam", _after_easter(60)),
    ],
    "DE": [
        ("Neujahr", _on(1, 1)),
        ("Erster Mai", _on(5, 1)),
        ("Tag der Deutschen Einheit", _on(10, 3)),
        ("Erster Weihnachtstag", _on(12, 25)),
        ("Zweiter Weihnachtstag", _on(12, 26)),
        ("Karfreitag", _after_easter(-2)),
        ("Ostermontag", _after_easter(1)),
        ("Christi Himmelfahrt", _after_easter(39)),
        ("Pfingstmontag", _after_easter(50)),
    ],
    "FR": [
        ("Jour de l''an", _on(1, 1)),
        ("Fête du Travail", _on(5, 1)),
        ("Fête de la Victoire", _on(5, 8)),
        ("Fête nationale", _on(7, 14)),
        ("Assomption", _on(8, 15)),
        ("Toussaint", _on(11, 1)),
        ("Armistice", _on(11, 11)),
        ("Noël", _on(12, 25)),
        ("Lundi de Pâques", _after_easter(1)),
        ("Ascension", _after_easter(39)),
        ("Lundi de Pentecôte", f"{_after_easter(50)} and year(d) not in (2005, 2006, 2007)"),
    ],
    "GB": [
        ("New Year''s Day", _on(1, 1)),
        ("New Year''s Day (in lieu)", "month(d) = 1 and day(d) in (2, 3) and isodow(d) = 1"),
        ("Good Friday", _after_easter(-2)),
        ("Easter Monday", _after_easter(1)),
        ("Early May Bank Holiday",
         "month(d) = 5 and case year(d) when 1995 then day(d) = 8 else isodow(d) = 1 and day(d) <= 7 end"),
        ("Spring Bank Holiday",
         "isodow(d) = 1 and month(d) = 5 and day(d) >= 25 and year(d) not in (2002, 2012) "
         "or d in (date '2002-06-04', date '2012-06-04')"),
        ("Summer Bank Holiday", "isodow(d) = 1 and month(d) = 8 and day(d) >= 25"),
        ("Christmas Day", _on(12, 25)),
        ("Christmas Day (in lieu)", f"{_on(12, 27)} and isodow(d) <= 2"),
        ("Boxing Day", _on(12, 26)),
        ("Boxing Day (in lieu)", f"{_on(12, 28)} and isodow(d) <= 2"),
        ("Millennium Celebrations", "d = date '1999-12-31'"),
        ("Golden Jubilee", "d = date '2002-06-03'"),
        ("Royal Wedding", "d = date '2011-04-29'"),
        ("Diamond Jubilee", "d = date '2012-06-05'"),
    ],
}
# Easter after Gauss, for 1900 to 2099.
EASTER = """
    span as (select year(min(o_orderdate)) as y0 from orders),
    days as (
      select cast(unnest(generate_series(make_date(y0, 1, 1), make_date(y0 + 19, 12, 31),
                                         interval 1 day)) as date) as d from span),
    gauss as (
      select y, a, d1, (2 * (y % 4) + 4 * (y % 7) + 6 * d1 + 5) % 7 as e1
      from (select y, y % 19 as a, (19 * (y % 19) + 24) % 30 as d1
            from (select distinct year(d) as y from days))),
    dated as (
      select d, make_date(y, 3, 22) + cast(d1 + e1
        - case when e1 = 6 and (d1 = 29 or d1 = 28 and a > 10) then 7 else 0 end as integer) as easter
      from days join gauss on y = year(d))"""

# --- loading -------------------------------------------------------------------

SHIPPED = """
    shipped as (
      select l_orderkey, case when l_quantity > 1 then l_linenumber end as l_linenumber, l_partkey,
             l_suppkey, l_extendedprice, l_discount, l_tax,
             cast(year(l_shipdate) as integer) as ship_year
      from lineitem)"""


def first_rows(condition: str) -> str:
    columns = "l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax"
    return f"""
      select * from shipped where {condition} and l_linenumber is not null
      qualify row_number() over (
        partition by ship_year, l_orderkey, l_linenumber order by {columns}) = 1"""


_TYPES = {
    "orders": "o_orderkey:BIGINT o_custkey:BIGINT o_orderstatus:TEXT o_totalprice:DOUBLE_PRECISION "
    "o_orderdate:TIMESTAMP o_orderpriority:TEXT",
    "lineitem": "l_orderkey:BIGINT l_partkey:BIGINT l_suppkey:BIGINT l_linenumber:BIGINT "
    "l_quantity:DOUBLE_PRECISION l_extendedprice:DOUBLE_PRECISION l_discount:DOUBLE_PRECISION "
    "l_tax:DOUBLE_PRECISION l_returnflag:TEXT l_linestatus:TEXT l_shipdate:TIMESTAMP",
    "events": "event_id:BIGINT ts:TIMESTAMP user_id:BIGINT event_type:TEXT "
    "value:DOUBLE_PRECISION props:TEXT",
}
PROFILE = " union all ".join(
    f"select '{t}' as table_name, cast({i} as integer) as ordinal, '{c}' as column_name, "
    f"'{k.replace('_', ' ')}' as storage_type, cast(count(*) as bigint) as row_count, "
    f"cast(count({c}) as bigint) as non_null from {t}"
    for t, columns in _TYPES.items()
    for i, (c, k) in enumerate(x.split(":") for x in columns.split())
)

NOTES = "last known growth carried forward"

_DIRTY = """
    raw as (select event_id, event_id % 8 as turn, regexp_extract(props, '(\\d+)', 1) as k, event_type
            from events),
    cells as (
      select event_id, case turn when 0 then k when 1 then '' when 2 then 'nan' when 3 then event_type
             when 4 then k || 'd' when 5 then ' ' || k || ' ' when 6 then k || '.5' end as cell
      from raw),
    numbers as (
      select event_id, case when not isnan(try_cast(cell as double)) then try_cast(cell as double) end
             as number
      from cells)"""


def linear(panel: str, x: str, y: str) -> str:
    """Least squares on two features by Cramer's rule over each fold's training rows."""
    return f"""with {panel},
    ready as (
      select *, {x} as x, {y} as y, {NEXT} as t from panel
      where {' and '.join(f'{c} is not null' for c in (x, y, NEXT))}),
    counted_folds as ({fold_counts('ready')}),
    sums as (
      select f.test_year, avg(t) as mt, avg(x) as mx, avg(y) as my,
             regr_sxx(x, x) as sxx, regr_sxx(y, y) as syy, covar_pop(x, y) * count(*) as sxy,
             covar_pop(x, t) * count(*) as sxt, covar_pop(y, t) * count(*) as syt
      from counted_folds f join ready on feature_year < f.test_year group by 1),
    weights as (
      select *, (sxt * syy - syt * sxy) / (sxx * syy - sxy * sxy) as bx,
             (syt * sxx - sxt * sxy) / (sxx * syy - sxy * sxy) as by_ from sums),
    forecast as (
      select ready.*, w.test_year, mt + bx * (x - mx) + by_ * (y - my) as guess
      from ready join weights w on feature_year = w.test_year),
    scored as (
      select *, abs(population * (1 + guess) - population * (1 + t)) as absolute_population_error,
             abs(population * (1 + guess) - population * (1 + t))
               / nullif(abs(population * (1 + t)), 0) * 100 as absolute_percentage_error
      from forecast),
    found as (select test_year, {metric_list('t', 'guess')} from scored group by 1)
    select test_year, training_rows, test_rows, 'linear_regression' as model_name, {rounded(METRICS)}
    from counted_folds join found using (test_year)"""


def linear_all(panel: str) -> str:
    """Least squares on all features: each in turn is taken out of those after it and of
    the target, over each fold's training rows; one that the earlier ones give is left."""
    names = {f: f"x{i}" for i, f in enumerate(FEATURES)}
    columns = list(names.values())
    steps = [f"""
    ready as (
      select location_id, feature_year, population, {NEXT} as actual,
             {', '.join(f'cast({f} as double) as {x}' for f, x in names.items())}
      from panel where {' and '.join(f'{c} is not null' for c in [*FEATURES, NEXT])}),
    counted_folds as ({fold_counts('ready')}),
    s0 as (
      select f.test_year, feature_year < f.test_year as train, population, actual,
             {', '.join(
                 f'({x} - avg({x}) filter (where feature_year < f.test_year) over w)'
                 f' / stddev_pop({x}) filter (where feature_year < f.test_year) over w as {x}'
                 for x in columns)},
             actual - avg(actual) filter (where feature_year < f.test_year) over w as left_,
             avg(actual) filter (where feature_year < f.test_year) over w as guess,
             count(*) filter (where feature_year < f.test_year) over w as n
      from counted_folds f join ready on feature_year <= f.test_year
      window w as (partition by f.test_year))"""]
    for k, x in enumerate(columns):
        square = f"sum({x} * {x}) filter (where train) over w"

        def share(of: str, x: str = x, square: str = square) -> str:
            along = f"sum({of} * {x}) filter (where train) over w"
            return f"case when {square} > 1e-9 * n then {along} / {square} else 0 end"

        rest = ", ".join(f"{y} - ({share(y)}) * {x} as {y}" for y in columns[k + 1 :])
        steps.append(f"""
    s{k + 1} as (
      select test_year, train, population, actual, n, {rest + ', ' if rest else ''}
             left_ - ({share('left_')}) * {x} as left_, guess + ({share('left_')}) * {x} as guess
      from s{k} window w as (partition by test_year))""")
    return f"""with {panel}, {', '.join(steps)},
    scored as (
      select *, abs(population * (1 + guess) - population * (1 + actual)) as absolute_population_error,
             abs(population * (1 + guess) - population * (1 + actual))
               / nullif(abs(population * (1 + actual)), 0) * 100 as absolute_percentage_error
      from s{len(columns)} where not train),
    found as (select test_year, {metric_list('actual', 'guess')} from scored group by 1)
    select c.*, 'linear_regression' as model_name, {rounded(METRICS)}
    from counted_folds c join found using (test_year)"""


ORACLE: dict[str, str] = {
    "rolling_persistence_eval": f"with {place_panel(False)}, {PERSISTENCE_FOLDS} "
    f"select {FOLD_COLUMNS} from folds",
    "customer_persistence_eval": f"with {CUSTOMER_PANEL}, {PERSISTENCE_FOLDS} "
    f"select {FOLD_COLUMNS} from folds",
    "panel_growth": f"with {CUSTOMER_PANEL} select location_id, county_name, feature_year, "
    f"population, {PAST}, {NEXT} from panel",
    "complete_rows": f"with {place_panel()} select location_id, county_name, feature_year, "
    f"population, {rounded([f for f in FEATURES if f != 'population'] + [NEXT])} from panel "
    f"where {PAST} is not null and {NEXT} is not null",
    "expanding_folds": f"with {CUSTOMER_PANEL}, {COMPLETE} {fold_counts()}",
    "fold_membership": f"""with {CUSTOMER_PANEL}, {COMPLETE}
        select location_id, t.test_year,
               cast(count(*) filter (where feature_year < t.test_year) as bigint) as training_rows,
               cast(count(*) filter (where feature_year = t.test_year) as bigint) as test_rows
        from complete join (select cast(unnest([1997, 1998, 1999]) as integer) as test_year) t
             on feature_year <= t.test_year group by 1, 2""",
    "daily_folds": """
        with daily as (select cast(o_orderdate as date) as test_day, count(*) as n from orders group by 1)
        select * from (
          select test_day, cast(sum(n) over w as bigint) as training_rows,
                 cast(n as bigint) as test_rows, min(test_day) over w as first_training_day,
                 max(test_day) over w as last_training_day
          from daily
          window w as (order by test_day rows between unbounded preceding and 1 preceding))
        where training_rows > 0""",
    "time_split": f"""with {CUSTOMER_PANEL}, {COMPLETE}
        select location_id, feature_year,
               case when feature_year <= 1998 then 'train' else 'test' end as role
        from complete where feature_year <= 1999""",
    "regression_metrics": f"""with {place_panel()}, {COMPLETE}
        select location_id, county_name, cast(count(*) as bigint) as n_rows,
               round(avg(abs({PAST} - {NEXT})), 6) as mae,
               round(sqrt(avg(({PAST} - {NEXT}) * ({PAST} - {NEXT}))), 6) as rmse,
               round({r2(NEXT, PAST)}, 6) as r2
        from complete group by 1, 2""",
    "population_errors": f"with {CUSTOMER_PANEL}, {ERRORS} select location_id, feature_year, "
    + rounded(
        [
            "actual_population",
            "predicted_population",
            "population_error",
            "absolute_population_error",
            "absolute_percentage_error",
            "population_error_pct",
            "prediction_error",
        ]
    )
    + " from scored",
    "error_summary": f"""with {place_panel()}, {ERRORS},
        tests as (select *, feature_year as test_year from scored where feature_year in {TESTS}),
        top as (select * from tests qualify row_number() over (partition by test_year
                order by population_error desc, county_name, feature_year) = 1),
        low as (select * from tests qualify row_number() over (partition by test_year
                order by population_error, county_name, feature_year) = 1),
        summary as (
          select test_year, cast(count(*) as bigint) as rows_evaluated,
                 round(avg(abs(population_error)), 6) as mean_absolute_error,
                 round(avg(abs(population_error_pct)), 6) as mean_absolute_pct_error,
                 round(max(abs(population_error)), 6) as max_absolute_error,
                 round(median(abs(population_error_pct)), 6) as median_absolute_pct_error
          from tests group by 1)
        select summary.*,
               top.county_name as largest_over_label,
               round(top.population_error, 6) as largest_over_error,
               round(top.population_error_pct, 6) as largest_over_pct,
               low.county_name as largest_under_label,
               round(low.population_error, 6) as largest_under_error,
               round(low.population_error_pct, 6) as largest_under_pct
        from summary join top using (test_year) join low using (test_year)""",
    "median_price": "select l_returnflag, median(l_extendedprice) as median_price "
    "from lineitem group by 1",
    "fold_averages": f"""with {place_panel()}, {PERSISTENCE_FOLDS}
        select min(test_year) as first_test_year, max(test_year) as last_test_year,
               cast(count(*) as bigint) as years_evaluated,
               cast(sum(training_rows) as bigint) as total_training_rows,
               cast(sum(test_rows) as bigint) as total_test_rows,
               {', '.join(f'round(avg({m}), 6) as avg_{m}' for m in METRICS)}
        from folds""",
    "fold_lines": f"""with {place_panel(False)}, {PERSISTENCE_FOLDS}
        select test_year, printf('%d mae=%.6f rmse=%.6f r2=%.6f mape=%.2f%%',
               test_year, growth_mae, growth_rmse, growth_r2, population_mape) as line
        from folds""",
    "summary_lines": f"""with {place_panel(False)}, {PERSISTENCE_FOLDS},
        means as (select min(test_year) as a, max(test_year) as b, count(*) as n,
                  {', '.join(f'avg({m}) as {m}' for m in METRICS)} from folds)
        select cast(unnest(range(1, 8)) as integer) as ordinal, unnest([
          printf('test years %d-%d', a, b), printf('years evaluated %d', n),
          printf('average growth mae %.6f', growth_mae),
          printf('average growth rmse %.6f', growth_rmse),
          printf('average growth r2 %.6f', growth_r2),
          printf('average population mae %.0f', population_mae),
          printf('average population mape %.2f%%', population_mape)]) as line from means""",
    "forest_known_split": f"""with {KNOWN_PANEL}
        select location_id, county_name, feature_year, population, {NEXT},
               {NEXT} as predicted_growth_1yr, population * (1 + {NEXT}) as predicted_population,
               population * (1 + {NEXT}) as actual_population, 0.0e0 as population_error,
               0.0e0 as population_error_pct, 0.0e0 as prediction_error
        from known where feature_year = 1999""",
    "forest_known_importance": """
        select cast(1 as integer) as ordinal, 'is_odd: 1.000000' as line
        union all select 2, 'historical_growth_1yr: 0.000000'
        union all select 3, 'pct_weekend: 0.000000'""",
    "comparison_known": f"""with {KNOWN_FOLDS}
        select min(test_year) as first_test_year, max(test_year) as last_test_year,
               cast(count(*) as bigint) as years_evaluated,
               {', '.join(
                   f'round(avg({m}), 6) as avg_baseline_{n}, round(avg(rf_{m}), 6) as avg_rf_{n}'
                   for m, n in zip(METRICS, ['mae', 'rmse', 'r2', 'population_mae', 'mape']))}
        from folds""",
    "comparison_lines": f"""with {KNOWN_FOLDS}
        select test_year, cast(unnest(range(1, 5)) as integer) as ordinal, unnest([
          printf('baseline growth mae=%.6f rmse=%.6f r2=%.6f', growth_mae, growth_rmse, growth_r2),
          printf('baseline population mae=%.0f mape=%.2f%%', population_mae, population_mape),
          printf('rf growth mae=%.6f rmse=%.6f r2=%.6f', rf_growth_mae, rf_growth_rmse, rf_growth_r2),
          printf('rf population mae=%.0f mape=%.2f%%', rf_population_mae, rf_population_mape)
        ]) as line from folds""",
    "target_range": f"""with {CUSTOMER_PANEL}
        select cast(count(*) as bigint) as panel_rows, min(feature_year) as first_year,
               max(feature_year) as last_year, min({NEXT}) as lowest_target,
               max({NEXT}) as highest_target from panel""",
    "matrix_unpack": """
        select cast(c_custkey // 100 as bigint) as year, cast(c_custkey % 100 as bigint) as position,
               c_name as name,
               case when c_custkey % 10 not in (3, 5) then c_mktsegment end as segment,
               case when c_custkey % 10 <> 3
                    then cast(cast(round(c_acctbal * 100) as bigint) as varchar) end as balance
        from customer""",
    "matrix_scan": MATRIX_ROWS,
    "matrix_lines": MATRIX_ROWS,
    "coerce_numeric": f"""with {_DIRTY}
        select event_id, number, case when number = floor(number) then cast(number as bigint) end as whole
        from numbers""",
    "strict_sums": """
        select l_orderkey, l_linenumber, l_partkey, l_partkey + l_suppkey + l_orderkey as added,
               l_partkey - l_suppkey as difference from lineitem""",
    "ratio_features": f"""with {CUSTOMER_COUNTS}
        select location_id, feature_year, {_ratio('n_open', 'population')} as pct_open,
               {_ratio('n_finished', 'n_urgent')} as finished_per_urgent,
               {_ratio('n_low', 'n_low + n_high')} as pct_low_of_both from counted""",
    "lookup_join_last_wins": """
        with last_events as (
          select * from events
          qualify row_number() over (partition by user_id order by event_id desc) = 1)
        select o_orderkey, o_custkey, event_type, value
        from orders join last_events on o_custkey = user_id""",
    "unmatched_rows": """
        select o_orderkey, o_custkey from orders
        where not exists (select 1 from events where user_id = o_custkey)""",
    "ranked_by_rate": f"""with {CUSTOMER_COUNTS}
        select county_name, feature_year, population, n_finished,
               {_ratio('n_finished', 'n_urgent')} as rate
        from counted order by rate desc nulls last, county_name, feature_year""",
    "county_records": f"with {COUNTY} select * from county",
    "unmatched_counties": f"""with {COUNTY_BASE}
        select year, '07' as state_fips, lpad(cast(n_nationkey as varchar), 3, '0') as county_fips,
               n_name as county_name
        from mainrows where n_nationkey = 7 and year = 1996""",
    "county_backfill": f"""with {BACKFILL}
        select * from county
        where year < (select coalesce(min(batch) filter (where violations > 0), 9999) from checked)""",
    "county_backfill_broken": f"""with {BROKEN}
        select * from county
        where year < (select min(batch) filter (where violations > 0) from checked)""",
    "dq_verdict_broken": f"""with {BROKEN}
        select batch, cast(count(*) filter (where violations > 0) as bigint) as failed_checks,
               coalesce(string_agg(check_name, ', ' order by check_name)
                        filter (where violations > 0), '') as failures
        from checked group by 1""",
    "dq_report": f"with {DQ} select *, violations = 0 as passed from checked",
    "dq_verdict": f"""with {DQ}
        select batch, cast(count(*) filter (where violations > 0) as bigint) as failed_checks,
               coalesce(string_agg(check_name, ', ' order by check_name)
                        filter (where violations > 0), '') as failures
        from checked group by 1""",
    "dq_duplicates": """
        select cast(year(l_shipdate) as integer) as ship_year,
               cast(count(*) - count(distinct (l_orderkey, l_linenumber)) as bigint) as duplicates
        from lineitem group by 1""",
    "dq_missing": f"""with {CUSTOMER_PANEL}
        select feature_year, cast(count(*) as bigint) as rows,
               {', '.join(
                   count_if(f'{c} is null', f'{c}_not_missing')
                   for c in ['location_id', 'county_name', 'feature_year', 'population', PAST, NEXT])}
        from panel group by 1""",
    "dq_ranges": f"""with {CUSTOMER_COUNTS},
        shares as (select feature_year, {_ratio('n_open', 'population')} as pct_open,
               {_ratio('n_finished', 'n_urgent')} as finished_per_urgent,
               {_ratio('n_low', 'n_low + n_high')} as pct_low_of_both from counted)
        select feature_year, cast(count(*) as bigint) as rows,
               {', '.join(
                   count_if(f'{c} is null or {c} < 0 or {c} > 100', f'{c}_range')
                   for c in ['pct_open', 'finished_per_urgent', 'pct_low_of_both'])}
        from shares group by 1""",
    "dq_reconcile": f"""with {CUSTOMER_COUNTS}
        select feature_year, cast(count(*) as bigint) as rows,
               {count_if('n_finished + n_open + n_partial <> population', 'statuses')},
               {count_if('n_urgent + n_high + n_medium + n_unspecified <> population',
                         'priorities_without_low')},
               {count_if('population - n_open <> n_partial', 'partial_again')}
        from counted group by 1""",
    "dq_bounds": f"""with {CUSTOMER_COUNTS}
        select feature_year, cast(count(*) as bigint) as rows,
               {count_if('n_urgent <= 0', 'n_urgent_positive')},
               {count_if('n_urgent > n_open or n_high > n_open', 'within_open')},
               {count_if('n_urgent < 0 or n_urgent > n_finished or n_finished < 0 or '
                         'n_finished > population', 'urgent_chain')}
        from counted group by 1""",
    "insert_skip_existing": f"""with {SHIPPED},
        one as ({first_rows('ship_year <= 1998')}),
        two as ({first_rows('ship_year >= 1997')})
        select * from one
        union all
        select two.* from two anti join one using (ship_year, l_orderkey, l_linenumber)
        union all
        select * from shipped where l_linenumber is null and ship_year <= 1998
        union all
        select * from shipped where l_linenumber is null and ship_year >= 1997""",
    "load_counts": f"""with {SHIPPED},
        one as ({first_rows('ship_year <= 1998')}),
        two as ({first_rows('ship_year >= 1997')}),
        fresh as (
          select two.ship_year from two anti join one using (ship_year, l_orderkey, l_linenumber)
          union all
          select ship_year from shipped where l_linenumber is null and ship_year >= 1997),
        years as (select ship_year, cast(count(*) filter (where ship_year >= 1997) as bigint) as read
                  from shipped group by 1)
        select cast(ship_year as bigint) as ship_year, read, coalesce(inserted, 0) as inserted,
               read - coalesce(inserted, 0) as skipped
        from years left join (select ship_year, cast(count(*) as bigint) as inserted
                              from fresh group by 1) using (ship_year)""",
    "append_keyed": """
        select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as feature_year
        from orders""",
    "append_batches": f"""
        select o_orderkey, o_custkey, o_totalprice, cast(year(o_orderdate) as integer) as feature_year
        from orders""",
    "table_profile": PROFILE,
    "run_registry": f"""with {place_panel()}, {PERSISTENCE_FOLDS}
        select cast(2 as bigint) as run_id, 'persistence_baseline' as model_name, test_year,
               training_rows, test_rows, {rounded(METRICS)},
               cast(1992 as integer) as feature_start_year, cast(1998 as integer) as feature_end_year,
               cast(1997 as integer) as test_start_year, cast(1999 as integer) as test_end_year,
               cast(sum(training_rows) over () as bigint) as run_training_rows,
               cast(sum(test_rows) over () as bigint) as run_test_rows, '{NOTES}' as notes
        from folds""",
    "recorded_predictions": f"""with {place_panel()}, {ERRORS}
        select cast(1 as bigint) as run_id, 'persistence_baseline' as model_name,
               feature_year as test_year, location_id, county_name, feature_year,
               {rounded(['actual_population', 'predicted_population', 'population_error',
                         'absolute_population_error', 'absolute_percentage_error'])},
               round({NEXT}, 6) as actual_growth, round({PAST}, 6) as predicted_growth
        from scored where feature_year in {TESTS}
          and exists (select 1 from complete c where c.feature_year < scored.feature_year)""",
    "run_counts_update": f"""
        select cast(year(o_orderdate) as bigint) as run_id,
               cast(case when year(o_orderdate) = 1998 then 10 end as bigint) as training_rows,
               cast(case when year(o_orderdate) = 1998 then 20 else count(*) end as bigint) as test_rows
        from orders group by year(o_orderdate)""",
    "stored_run_update": """
        select cast(year(o_orderdate) as bigint) as run_id,
               cast(case when year(o_orderdate) = 1998 then 10 end as bigint) as training_rows,
               cast(case when year(o_orderdate) = 1998 then 20 else count(*) end as bigint) as test_rows
        from orders group by year(o_orderdate)""",
    "concurrent_runs": f"""with {place_panel()}, {PERSISTENCE_FOLDS}
        select cast(run_id as bigint) as run_id, 'persistence_baseline' as model_name, test_year,
               training_rows, test_rows, {rounded(METRICS)},
               case when run_id = 2 then 1
                    else cast(sum(training_rows) over (partition by run_id) as bigint) end
                 as run_training_rows,
               cast(1997 as integer) as test_start_year
        from folds, (values (1), (2)) as r(run_id)""",
    "growth_view": f"""with {place_panel(False)}
        select location_id, county_name, population, feature_year, {PAST}, {NEXT}
        from panel where feature_year between 1997 and 1998""",
    "holidays_by_country": f"""with {EASTER}
        {' union all '.join(
            f"select '{c}' as country, d as holiday_date, '{n}' as holiday_name from dated where {on}"
            for c, named in _EVERYWHERE_OFF.items() for n, on in named)}""",
    "holiday_table": f"""with {HOLIDAYS}
        select holiday_date, holiday_name, orders from holidays
        left join (select order_date, cast(count(*) as bigint) as orders from dated group by 1)
             on order_date = holiday_date""",
    "business_days": f"""with {HOLIDAYS}
        select order_date, cast(count(*) as bigint) as orders,
               isodow(order_date) < 6 and order_date not in (select holiday_date from holidays)
                 as is_business_day
        from dated group by 1""",
    "business_day_gate": f"""with {HOLIDAYS}
        select order_date, o_orderkey from dated
        where isodow(order_date) < 6 and order_date not in (select holiday_date from holidays)""",
    "linear_two_features": linear(place_panel(), PAST, "avg_price"),
    "linear_customers": linear(CUSTOMER_PANEL, PAST, "population"),
    "linear_rolling": linear_all(place_panel()),
    "forest_facts": f"""with {place_panel()},
        ready as (select * from panel
                  where {' and '.join(f'{c} is not null' for c in [*FEATURES, NEXT])})
        select test_year, test_rows, test_rows as within, cast(300 as integer) as trees,
               true as shares_of_one from ({fold_counts('ready')})""",
}
