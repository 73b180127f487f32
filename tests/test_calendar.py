from datetime import date

import pytest

from yearling.functions.dates import easter_steps
from yearling.operators.calendar import (
    business_day_gate,
    holidays_between,
    is_business_day,
    with_business_day,
)

# Published federal holidays, weekdays only, observed days included.
CLOSED_2021 = [
    (1, 1), (1, 18), (2, 15), (5, 31), (6, 18), (7, 5), (9, 6), (10, 11), (11, 11), (11, 25),
    (12, 24), (12, 31),
]
CLOSED_2024 = [
    (1, 1), (1, 15), (2, 19), (5, 27), (6, 19), (7, 4), (9, 2), (10, 14), (11, 11), (11, 28),
    (12, 25),
]


def closed(spark, year):
    days = holidays_between(spark, year, year).filter("weekday(holiday_date) < 5")
    return sorted({(r.holiday_date.month, r.holiday_date.day) for r in days.collect()})


def test_published_years(spark):
    assert closed(spark, 2021) == CLOSED_2021
    assert closed(spark, 2024) == CLOSED_2024


def test_rules_start_in_their_year(spark):
    names = {r.holiday_name for r in holidays_between(spark, 1985, 1985).collect()}
    assert "Martin Luther King Jr. Day" not in names
    assert "Juneteenth National Independence Day" not in names
    assert "Labor Day" in names
    with pytest.raises(Exception, match="no holiday rules before 1978: 1977"):
        holidays_between(spark, 1977, 1980).collect()


def test_business_days_and_gate(spark):
    days = [
        (date(2024, 7, 3), True),
        (date(2024, 7, 4), False),
        (date(2024, 7, 6), False),
        (date(2024, 7, 7), False),
        (date(2022, 12, 26), False),
        (date(2021, 12, 31), False),
        (date(2024, 1, 2), True),
    ]
    df = spark.createDataFrame([(d,) for d, _ in days], "d date")
    holidays = holidays_between(spark, 2020, 2025)
    found = {r.d: r.is_business_day for r in with_business_day(df, "d", holidays).collect()}
    assert found == dict(days)
    kept = {r.d for r in business_day_gate(df, "d", holidays).collect()}
    assert kept == {d for d, open_day in days if open_day}


def test_user_holidays(spark):
    own = spark.createDataFrame([(date(2024, 7, 3), "Own")], "holiday_date date, holiday_name string")
    df = spark.createDataFrame([(date(2024, 7, 3),), (date(2024, 7, 4),)], "d date")
    assert [r.d for r in business_day_gate(df, "d", own).collect()] == [date(2024, 7, 4)]


def test_missing_dates_are_not_business_days(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert business_day_gate(df, "d", holidays_between(spark, 2024, 2024)).count() == 0


# Weekdays off as published: bank holidays of England and Wales, and laws of the others.
CLOSED = {
    ("GB", 2020): [(1, 1), (4, 10), (4, 13), (5, 8), (5, 25), (8, 31), (12, 25), (12, 28)],
    ("GB", 2022): [
        (1, 3), (4, 15), (4, 18), (5, 2), (6, 2), (6, 3), (8, 29), (9, 19), (12, 26), (12, 27),
    ],
    ("DE", 2023): [(4, 7), (4, 10), (5, 1), (5, 18), (5, 29), (10, 3), (12, 25), (12, 26)],
    ("FR", 2024): [
        (1, 1), (4, 1), (5, 1), (5, 8), (5, 9), (5, 20), (8, 15), (11, 1), (11, 11), (12, 25),
    ],
    ("AT", 2024): [
        (1, 1), (4, 1), (5, 1), (5, 9), (5, 20), (5, 30), (8, 15), (11, 1), (12, 25), (12, 26),
    ],
}


@pytest.mark.parametrize(("country", "year"), CLOSED)
def test_other_countries(spark, country, year):
    days = holidays_between(spark, year, year, country).filter("weekday(holiday_date) < 5")
    found = sorted({(r.holiday_date.month, r.holiday_date.day) for r in days.collect()})
    assert found == CLOSED[country, year]


def test_unknown_countries_and_early_years_fail(spark):
    with pytest.raises(ValueError, match="no holiday rules for 'XX'; .* AT, DE, FR, GB, US"):
        holidays_between(spark, 2020, 2020, "XX")
    with pytest.raises(Exception, match="no holiday rules before 1995: 1990"):
        holidays_between(spark, 1990, 1990, "DE").collect()


def test_easter(spark):
    # The earliest and latest possible, the two exceptions, and years that are usual.
    published = {
        1818: (3, 22), 1943: (4, 25), 1954: (4, 18), 1981: (4, 19), 2000: (4, 23), 2008: (3, 23),
        2011: (4, 24), 2024: (3, 31), 2025: (4, 20), 2049: (4, 18), 2076: (4, 19), 2285: (3, 22),
    }
    df = spark.createDataFrame([(y,) for y in published], "y int")
    for columns in easter_steps("y", "easter"):
        df = df.selectExpr("*", *columns)
    assert {r.y: (r.easter.month, r.easter.day) for r in df.collect()} == published


def test_today_is_the_default(spark):
    today = spark.sql("select current_date() as d").first().d
    assert is_business_day(spark) == is_business_day(spark, today)
    assert not is_business_day(spark, date(2024, 7, 4))
    assert is_business_day(spark, date(2024, 7, 4), "DE")
    assert not is_business_day(spark, date(2024, 10, 3), "DE")
    assert not is_business_day(spark, date(2024, 7, 6))
