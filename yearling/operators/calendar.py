"""Public holidays by country as a table, and the business-day filter."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from yearling.functions.dates import (
    easter_steps,
    is_weekend,
    monday_after,
    nth_weekday,
    observed_shift,
)
from yearling.functions.names import quoted, text

# US federal holidays and the first year of each rule used here.
# (name, first year, month, day)
FIXED_DATE = [
    ("New Year's Day", 1871, 1, 1),
    ("Juneteenth National Independence Day", 2021, 6, 19),
    ("Independence Day", 1871, 7, 4),
    ("Veterans Day", 1978, 11, 11),
    ("Christmas Day", 1871, 12, 25),
]
# (name, first year, month, weekday with Monday 0, nth; -1 is last)
NTH_WEEKDAY = [
    ("Martin Luther King Jr. Day", 1986, 1, 0, 3),
    ("Washington's Birthday", 1971, 2, 0, 3),
    ("Memorial Day", 1971, 5, 0, -1),
    ("Labor Day", 1894, 9, 0, 1),
    ("Columbus Day", 1971, 10, 0, 2),
    ("Thanksgiving Day", 1942, 11, 3, 4),
]
FIRST_YEAR = 1978


def federal_holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """(holiday_date, holiday_name) for each given year, observed days included.

    A fixed date on a weekend also closes the nearest weekday. New Year's Day of
    the next year may fall back into the last given year. Years before 1978 had
    other rules; asking for one fails. A missing year gives no rows.
    """
    days = []
    for name, first, month, day in FIXED_DATE:
        date = f"make_date(_year, {month}, {day})"
        days.append(_entry(name, first, date))
        days.append(_entry(f"{name} (observed)", first, observed_shift(date)))
    next_new_year = observed_shift("make_date(_year + 1, 1, 1)")
    days.append(_entry("New Year's Day (observed)", FIRST_YEAR, next_new_year))
    for name, first, month, weekday, nth in NTH_WEEKDAY:
        days.append(_entry(name, first, nth_weekday("_year", month, weekday, nth)))
    return (
        _checked_years(years, year, FIRST_YEAR)
        .selectExpr("_year", f"inline(array({', '.join(days)}))")
        .filter("year(holiday_date) = _year")
        .drop("_year")
        .distinct()
    )


@dataclass(frozen=True)
class Rules:
    """The public holidays of a country from `since` on, when the earlier rules ended.

    `fixed`: (name, first year, month, day). `weekday`: (name, first year, month, weekday
    with Monday 0, nth; -1 is last). `easter`: (name, first year, days after Easter Sunday).
    `instead`: the name and year of a holiday that was moved, and its date then, or None
    if it was dropped. `once`: (name, date). `made_up`: names of fixed dates that close a
    weekday after a weekend too, two days later but for New Year's Day.
    """

    since: int
    fixed: list[tuple] = field(default_factory=list)
    weekday: list[tuple] = field(default_factory=list)
    easter: list[tuple] = field(default_factory=list)
    instead: dict[tuple[str, int], str | None] = field(default_factory=dict)
    once: list[tuple[str, str]] = field(default_factory=list)
    made_up: tuple[str, ...] = ()


# Holidays that hold in a whole country by law (Great Britain: the bank
# holidays of England and Wales).
COUNTRIES = {
    "GB": Rules(
        since=1978,
        fixed=[
            ("New Year's Day", 1974, 1, 1),
            ("Christmas Day", 1871, 12, 25),
            ("Boxing Day", 1871, 12, 26),
        ],
        weekday=[
            ("Early May Bank Holiday", 1978, 5, 0, 1),
            ("Spring Bank Holiday", 1971, 5, 0, -1),
            ("Summer Bank Holiday", 1971, 8, 0, -1),
        ],
        easter=[("Good Friday", 1871, -2), ("Easter Monday", 1871, 1)],
        instead={
            ("Early May Bank Holiday", 1995): "1995-05-08",
            ("Early May Bank Holiday", 2020): "2020-05-08",
            ("Spring Bank Holiday", 2002): "2002-06-04",
            ("Spring Bank Holiday", 2012): "2012-06-04",
            ("Spring Bank Holiday", 2022): "2022-06-02",
        },
        once=[
            ("Royal Wedding", "1981-07-29"),
            ("Millennium Celebrations", "1999-12-31"),
            ("Golden Jubilee", "2002-06-03"),
            ("Royal Wedding", "2011-04-29"),
            ("Diamond Jubilee", "2012-06-05"),
            ("Platinum Jubilee", "2022-06-03"),
            ("State Funeral", "2022-09-19"),
            ("Coronation", "2023-05-08"),
        ],
        made_up=("New Year's Day", "Christmas Day", "Boxing Day"),
    ),
    "DE": Rules(
        since=1995,
        fixed=[
            ("Neujahr", 1871, 1, 1),
            ("Erster Mai", 1933, 5, 1),
            ("Tag der Deutschen Einheit", 1990, 10, 3),
            ("Erster Weihnachtstag", 1871, 12, 25),
            ("Zweiter Weihnachtstag", 1871, 12, 26),
        ],
        easter=[
            ("Karfreitag", 1871, -2),
            ("Ostermontag", 1871, 1),
            ("Christi Himmelfahrt", 1871, 39),
            ("Pfingstmontag", 1871, 50),
        ],
        once=[("Reformationstag", "2017-10-31")],
    ),
    "FR": Rules(
        since=1982,
        fixed=[
            ("Jour de l'an", 1871, 1, 1),
            ("Fête du Travail", 1919, 5, 1),
            ("Fête de la Victoire", 1982, 5, 8),
            ("Fête nationale", 1880, 7, 14),
            ("Assomption", 1871, 8, 15),
            ("Toussaint", 1871, 11, 1),
            ("Armistice", 1922, 11, 11),
            ("Noël", 1871, 12, 25),
        ],
        easter=[
            ("Lundi de Pâques", 1886, 1),
            ("Ascension", 1871, 39),
            ("Lundi de Pentecôte", 1886, 50),
        ],
        # The day was worked in these years.
        instead={("Lundi de Pentecôte", year): None for year in (2005, 2006, 2007)},
    ),
    "AT": Rules(
        since=1967,
        fixed=[
            ("Neujahr", 1871, 1, 1),
            ("Heilige Drei Könige", 1871, 1, 6),
            ("Staatsfeiertag", 1949, 5, 1),
            ("Mariä Himmelfahrt", 1871, 8, 15),
            ("Nationalfeiertag", 1967, 10, 26),
            ("Allerheiligen", 1871, 11, 1),
            ("Mariä Empfängnis", 1955, 12, 8),
            ("Christtag", 1871, 12, 25),
            ("Stefanitag", 1871, 12, 26),
        ],
        easter=[
            ("Ostermontag", 1871, 1),
            ("Christi Himmelfahrt", 1871, 39),
            ("Pfingstmontag", 1871, 50),
            ("Fronleichnam", 1871, 60),
        ],
    ),
}


def public_holidays(years: DataFrame, country: str = "US", year: str = "year") -> DataFrame:
    """(holiday_date, holiday_name) of a country for each given year.

    `US` are the federal holidays. A country without rules here, and a year before the
    first that its rules hold for, fail. A missing year gives no rows.
    """
    if country == "US":
        return federal_holidays(years, year)
    if country not in COUNTRIES:
        known = ", ".join(sorted(["US", *COUNTRIES]))
        raise ValueError(f"no holiday rules for {country!r}; there are some for {known}")
    rules = COUNTRIES[country]
    days = [
        (name, first, f"make_date(_year, {month}, {day})")
        for name, first, month, day in rules.fixed
    ]
    days += [
        (f"{name} (in lieu)", first, monday_after(f"make_date(_year, {month}, {day})", month != 1))
        for name, first, month, day in rules.fixed
        if name in rules.made_up
    ]
    days += [
        (name, first, nth_weekday("_year", month, weekday, nth))
        for name, first, month, weekday, nth in rules.weekday
    ]
    days += [(name, first, f"date_add(_easter, {after})") for name, first, after in rules.easter]
    days += [(name, rules.since, f"date '{on}'") for name, on in rules.once]
    entries = [_entry(n, first, _moved(n, on, rules.instead)) for n, first, on in days]
    found = _checked_years(years, year, rules.since)
    for columns in easter_steps("_year", "_easter"):
        found = found.selectExpr("*", *columns)
    return (
        found.selectExpr("_year", f"inline(array({', '.join(entries)}))")
        .filter("year(holiday_date) = _year")
        .drop("_year")
        .distinct()
    )


def _moved(name: str, usual: str, instead: dict[tuple[str, int], str | None]) -> str:
    """The date of a holiday, but for the years in which it was moved or dropped."""
    for (moved, year), to in instead.items():
        if moved == name:
            other = "cast(null as date)" if to is None else f"date '{to}'"
            usual = f"if(_year = {year}, {other}, {usual})"
    return usual


def _checked_years(years: DataFrame, year: str, since: int) -> DataFrame:
    early = f"concat('no holiday rules before {since}: ', _year)"
    checked = f"if(_year < {since}, cast(raise_error({early}) as int), _year) as _year"
    return years.selectExpr(f"int({quoted(year)}) as _year").selectExpr(checked)


def _entry(name: str, first: int, on: str) -> str:
    in_force = f"if(_year >= {first}, {on}, null) as holiday_date"
    return f"struct({in_force}, {text(name)} as holiday_name)"


def holidays_between(
    spark: SparkSession, first_year: int, last_year: int, country: str = "US"
) -> DataFrame:
    return public_holidays(spark.range(first_year, last_year + 1), country, "id")


def is_business_day(spark: SparkSession, day: date | None = None, country: str = "US") -> bool:
    """Whether a date, by default the session's current one, is a business day."""
    shown = f"date '{day.isoformat()}'" if day else "current_date()"
    asked = spark.range(1).selectExpr(f"{shown} as day")
    closed = public_holidays(asked.selectExpr("year(day) as year"), country)
    return not business_day_gate(asked, "day", closed).isEmpty()


def _closed_days(holidays: DataFrame, day: str) -> DataFrame:
    """One row per date. Spark knows `holidays_between` and stored tables to be
    small and broadcasts them; a table past its limit is joined by a shuffle.
    """
    return holidays.selectExpr(f"holiday_date as {quoted(day)}").distinct()


def with_business_day(
    df: DataFrame, day: str, holidays: DataFrame, name: str = "is_business_day"
) -> DataFrame:
    """Add whether a date is a weekday that no holiday falls on."""
    closed = _closed_days(holidays, day).selectExpr("*", "true as _closed")
    open_day = f"not ({is_weekend(quoted(day))}) and _closed is null as {quoted(name)}"
    return df.join(closed, day, "left").selectExpr("*", open_day).drop("_closed")


def business_day_gate(df: DataFrame, day: str, holidays: DataFrame) -> DataFrame:
    """Keep the rows dated on a business day."""
    weekdays = df.filter(f"not ({is_weekend(quoted(day))})")
    return weekdays.join(_closed_days(holidays, day), day, "left_anti")
