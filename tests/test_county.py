import json

import pytest

from yearling import schemas
from yearling.operators import quality
from yearling.plans import county
from yearling.sources.tables import create_table


def county_row(year=2020, fips="001", **changes):
    """One consistent 48-column row."""
    row = {
        "year": year,
        "state": "ST",
        "state_fips": "07",
        "county_fips": fips,
        "county_name": f"County {fips}",
        "population": 1000,
        "median_age": 40.0,
        "under_18": 200,
        "over_65": 150,
        "white_population": 600,
        "black_population": 300,
        "hispanic_population": 50,
        "education_25_plus": 700,
        "bachelors_degree": 200,
        "median_household_income": 50000.0,
        "poverty_population": 990,
        "below_poverty": 100,
        "population_16_plus": 800,
        "civilian_labor_force": 500,
        "unemployed": 20,
        "housing_units": 450,
        "total_housing_units": 450,
        "vacant_housing_units": 50,
        "occupied_housing_units": 400,
        "owner_occupied_units": 300,
        "average_household_size": 2.5,
        "median_gross_rent": 900.0,
        "median_home_value": 150000.0,
        "foreign_born": 40,
        "population_1_plus": 990,
        "moved_within_county": 50,
        "moved_from_other_county_same_state": 20,
        "moved_from_other_state": 10,
        "moved_from_abroad": 5,
        "moved_last_year": 85,
    }
    row |= {name: row[part] / row[whole] * 100 for name, (part, whole) in county.RATIOS.items()}
    row |= changes
    return tuple(row[f] for f in schemas.COUNTY_YEAR.fieldNames())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.COUNTY_YEAR)


def failures(spark, *rows, expected=2, batches=(2020,)):
    report = county.check(frame(spark, *rows), list(batches), expected)
    return {r.check_name: r.violations for r in report.collect() if not r.passed}


def test_a_good_batch_passes_thirty_checks(spark):
    report = county.check(frame(spark, county_row(), county_row(fips="003")), [2020], 2)
    assert report.count() == 30
    assert report.filter("not passed").count() == 0
    quality.require_passed(report)


@pytest.mark.parametrize(
    "check, changes",
    [
        ("population_1_plus_not_missing", {"population_1_plus": None}),
        ("county_name_not_missing", {"county_name": None}),
        ("population_positive", {"population": 0, "under_18": 0, "over_65": 0}),
        ("pct_white_range", {"pct_white": 100.5}),
        ("pct_black_range", {"pct_black": -0.5}),
        ("vacancy_rate_range", {"vacancy_rate": None}),
        ("ages_within_population", {"over_65": 1001}),
        ("housing_reconciles", {"total_housing_units": 451}),
        ("housing_reconciles", {"occupied_housing_units": None}),
        ("labor_force_bounds", {"unemployed": 501}),
        ("labor_force_bounds", {"civilian_labor_force": 801}),
        ("labor_force_bounds", {"unemployed": -1}),
        ("mobility_reconciles", {"moved_within_county": 51}),
        ("moved_bounds", {"moved_last_year": 991, "moved_within_county": 956}),
        ("foreign_born_reconciles", {"foreign_born": None}),
    ],
)
def test_each_seeded_violation_is_found(spark, check, changes):
    found = failures(spark, county_row(), county_row(fips="003", **changes))
    assert found == {check: 1}


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 1.0), (1, 2.0, nan)], "b int, part double, whole double")
    checks = [
        quality.not_missing("part"),
        quality.positive("whole"),
        quality.percentage("part"),
        quality.parts_within("within", ["part"], "whole"),
        quality.reconcile("sum", ["part"], "whole"),
    ]
    assert tuple(quality.row_check_counts(df, "b", checks).first()) == (1, 2, 1, 0, 1, 0, 2)


def test_row_count_and_duplicates(spark):
    assert failures(spark, county_row(), expected=2) == {"row_count": 1}
    twice = failures(spark, county_row(), county_row(), county_row(), expected=3)
    assert twice == {"unique_key": 2}


def test_a_listed_year_without_rows_fails(spark):
    landed = spark.createDataFrame([("x", 2020), ("y", 2021), ("z", 2021)], "t string, year int")
    for batches in ([2020, 2021], county.landed_years(landed.limit(1), landed)):
        report = county.check(frame(spark, county_row()), batches, 1)
        failed = report.filter("not passed").collect()
        assert [(r.batch, r.check_name, r.violations) for r in failed] == [(2021, "row_count", 1)]


def test_every_failure_is_named(spark):
    report = spark.range(2500).selectExpr(
        "id as batch", "'c' as check_name", "1 as violations", "false as passed"
    )
    with pytest.raises(ValueError) as problem:
        quality.require_passed(report)
    assert str(problem.value).count(": c (1)") == 2500


def test_verdict_names_every_failure(spark):
    bad = county_row(unemployed=-1, pct_white=None)
    report = county.check(frame(spark, bad, county_row(2021)), [2020, 2021], 1)
    found = {r.batch: (r.failed_checks, r.failures) for r in quality.verdict(report).collect()}
    assert found == {2020: (2, "labor_force_bounds, pct_white_range"), 2021: (0, "")}
    with pytest.raises(ValueError, match="2020: labor_force_bounds .1.; 2020: pct_white_range"):
        quality.require_passed(report)


def test_backfill_stops_at_the_first_bad_year(spark, tmp_path):
    create_table(
        spark,
        "backfill_years",
        schemas.COUNTY_YEAR,
        key=county.KEY,
        partition_by=["year"],
        path=str(tmp_path / "t"),
    )
    good = frame(spark, county_row(2019), county_row(2020))
    mixed = frame(
        spark, county_row(2019), county_row(2020), county_row(2021, unemployed=-1), county_row(2022)
    )
    with pytest.raises(ValueError, match="2021: labor_force_bounds"):
        county.backfill(mixed, "backfill_years", [2019, 2020, 2021, 2022], 1)
    years = [r.year for r in spark.table("backfill_years").collect()]
    assert sorted(years) == [2019, 2020]
    county.backfill(good, "backfill_years", [2019, 2020], 1)
    assert spark.table("backfill_years").count() == 2
    with pytest.raises(ValueError, match="2019"):
        bad = frame(spark, county_row(2019, foreign_born=None))
        county.backfill(bad, "backfill_years", [2019], 1)


def _documents(spark, rows):
    return spark.createDataFrame(rows, "value string, year bigint, state string")


def _main(**cells):
    names = [*county.MAIN_CELLS.values(), *county.FOREIGN_BORN]
    names += [c for codes in county.SUMMED_CELLS.values() for c in codes]
    row = {n: "10" for n in names} | {"state": "07", "county": "001", "NAME": "A"} | cells
    return json.dumps([list(row), list(row.values())])


def _mobility(counties=("001",)):
    names = ["NAME", *county.MOBILITY_CELLS.values(), "state"]
    rows = [["A" if n == "NAME" else c if n == "county" else "07" if n == "state" else "20"
             for n in names] for c in counties]
    return json.dumps([names, *rows])


def test_documents_become_records(spark):
    main = _documents(spark, [(_main(B01001_001E="160", B19013_001E="n/a"), 2020, "ST")])
    mobility = _documents(spark, [(_mobility(), 2020, "ST")])
    found = county.county_records(main, mobility)
    assert [(f.name, f.dataType) for f in found.schema] == [
        (f.name, f.dataType) for f in schemas.COUNTY_YEAR
    ]
    row = found.first()
    assert (row.under_18, row.over_65, row.bachelors_degree, row.foreign_born) == (80, 120, 40, 0)
    assert (row.population, row.pct_under_18, row.median_household_income) == (160, 50.0, None)
    assert (row.state_fips, row.moved_last_year) == ("07", 80)
    panel = county.county_panel(found).first()
    assert (panel.location_id, panel.feature_year) == ("07001", 2020)


def test_same_county_of_another_year_is_no_match(spark):
    main = _documents(spark, [(_main(), 2020, "ST"), (_main(), 2021, "ST")])
    mobility = _documents(spark, [(_mobility(), 2020, "ST")])
    assert [r.year for r in county.county_records(main, mobility).collect()] == [2020]


def test_text_in_a_summed_cell_fails(spark):
    main = _documents(spark, [(_main(B01001_003E="x"), 2020, "ST")])
    mobility = _documents(spark, [(_mobility(), 2020, "ST")])
    with pytest.raises(Exception, match="under_18: not whole numbers"):
        county.county_records(main, mobility).collect()


def test_a_broken_document_spoils_its_year_only(spark, tmp_path):
    years = (2019, 2020, 2021, 2022, 2023)
    main = [(_main(), y, "ST") for y in years]
    main[2] = ("[[", 2021, "ST")
    main[4] = (_main(B01001_003E="x"), 2023, "ST")
    mobility = [(_mobility(), y, "ST") for y in years]
    mobility[3] = (json.dumps([["NAME"], ["A"]]), 2022, "ST")
    main, mobility = _documents(spark, main), _documents(spark, mobility)
    sources = county.county_sources(main, mobility)
    problems = {(r.year, r.source, r.rows): r.problem for r in sources.problems.collect()}
    assert list(sorted(problems)) == [(2021, "main", 1), (2022, "mobility", 1), (2023, "main", 1)]
    assert problems[2021, "main", 1] == "not JSON rows of cells"
    assert problems[2022, "mobility", 1].startswith("no cell ")
    assert problems[2023, "main", 1].startswith("under_18: not whole numbers: x, 10")
    strict = county.county_records(
        main.filter("year in (2019, 2020)"), mobility.filter("year in (2019, 2020)")
    )
    assert sorted(map(tuple, strict.collect())) == sorted(map(tuple, sources.records.collect()))

    checks = county.check(sources.records, years, None, sources.problems)
    failed = {(r.batch, r.check_name) for r in checks.filter("not passed").collect()}
    assert (2021, "source main of ST: not JSON rows of cells") in failed

    # The consistency of the made-up cells is no concern here.
    sound = frame(spark, *[county_row(y) for y in (2019, 2020)])
    create_table(
        spark, "spoiled_years", schemas.COUNTY_YEAR, county.KEY, ["year"], str(tmp_path / "t")
    )
    for inserted in (1, 0):
        with pytest.raises(county.BackfillStopped, match="2021: source main of ST") as stopped:
            county.backfill(sound, "spoiled_years", list(years), None, sources.problems)
        counts = [tuple(r) for r in stopped.value.loaded.orderBy("year").collect()]
        assert counts == [(2019, 1, inserted, 1 - inserted), (2020, 1, inserted, 1 - inserted)]
    assert sorted(r.year for r in spark.table("spoiled_years").collect()) == [2019, 2020]


def test_a_first_year_that_is_broken_loads_nothing(spark, tmp_path):
    main = _documents(spark, [("{", 2020, "ST"), (_main(), 2021, "ST")])
    mobility = _documents(spark, [(_mobility(), 2020, "ST"), (_mobility(), 2021, "ST")])
    sources = county.county_sources(main, mobility)
    create_table(
        spark, "broken_first", schemas.COUNTY_YEAR, county.KEY, ["year"], str(tmp_path / "t")
    )
    landed = county.landed_years(main, mobility)
    with pytest.raises(county.BackfillStopped) as stopped:
        county.backfill(sources.records, "broken_first", landed, None, sources.problems)
    assert stopped.value.loaded is None and spark.table("broken_first").isEmpty()


def test_a_fraction_in_a_whole_number_column_is_told(spark):
    main = _documents(
        spark,
        [(_main(B01001_001E="12.5"), 2020, "ST"), (_main(B01001_001E="12.0"), 2021, "ST"),
         (_main(B01001_001E="none", B01002_001E="40.5"), 2022, "ST")],
    )
    mobility = _documents(spark, [(_mobility(), y, "ST") for y in (2020, 2021, 2022)])
    sources = county.county_sources(main, mobility)
    told = [(r.year, r.problem) for r in sources.problems.collect()]
    assert told == [(2020, "population: not a whole number: 12.5")]
    # Text is missing, as ever, and the checks count it.
    assert {r.year: r.population for r in sources.records.collect()} == {2021: 12, 2022: None}
