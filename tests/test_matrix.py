import json

import pytest

from yearling.sources.matrix import (
    parse_matrix,
    read_documents,
    unpack,
    unpack_lines,
    unpack_or_tell,
)

CELLS = {"name": "NAME", "v": "V"}


def documents(spark, *matrices):
    rows = [(json.dumps(m), 2000 + i) for i, m in enumerate(matrices)]
    return spark.createDataFrame(rows, "value string, year bigint")


def unpacked(spark, matrix, strict=True):
    found = unpack(documents(spark, matrix), parse_matrix("value", strict), CELLS, ["year"], strict)
    return [(r.position, r.name, r.v) for r in found.orderBy("position").collect()]


def test_rows_and_null_cells(spark):
    found = unpacked(spark, [["V", "NAME"], ["1", "a"], [None, "b"]])
    assert found == [(0, "a", "1"), (1, "b", None)]


def test_last_of_equal_headers_wins(spark):
    assert unpacked(spark, [["V", "NAME", "V"], ["1", "a", "2"]]) == [(0, "a", "2")]


def test_numbers_become_text(spark):
    assert unpacked(spark, [["NAME", "V"], ["a", 7]]) == [(0, "a", "7")]


def test_header_only_gives_no_rows(spark):
    assert unpacked(spark, [["NAME", "V"]]) == []


def test_surplus_cells_are_dropped(spark):
    assert unpacked(spark, [["NAME", "V"], ["a", "1", "9"]]) == [(0, "a", "1")]


def test_short_row(spark):
    matrix = [["NAME", "V"], ["a"]]
    assert unpacked(spark, matrix, strict=False) == [(0, "a", None)]
    with pytest.raises(Exception, match="short row"):
        unpacked(spark, matrix)


def test_absent_header(spark):
    matrix = [["NAME", "W"], ["a", "1"]]
    assert unpacked(spark, matrix, strict=False) == [(0, "a", None)]
    with pytest.raises(Exception, match="no cell V"):
        unpacked(spark, matrix)


@pytest.mark.parametrize("text", ["[]", "{", "not json", None])
def test_broken_document_fails(spark, text):
    broken = spark.createDataFrame([(text, 1)], "value string, year bigint")
    with pytest.raises(Exception):
        unpack(broken, parse_matrix("value"), CELLS, ["year"]).collect()


def test_files_whole_and_by_line_agree(spark, tmp_path):
    for year, names in ((2001, ["a", "b"]), (2002, ["c], [d", 'e"']), (2003, [])):
        folder = tmp_path / f"year={year}" / "state=01"
        folder.mkdir(parents=True)
        matrix = [["NAME", "V"], *[[n, str(i)] for i, n in enumerate(names)]]
        lines = ",\n".join(json.dumps(r) for r in matrix)
        (folder / "part.json").write_text(f"[{lines}]")
    whole = unpack(
        read_documents(spark, str(tmp_path)), parse_matrix("value"), CELLS, ["year", "state"]
    ).drop("position")
    by_line = unpack_lines(spark, str(tmp_path), CELLS)
    expected = [
        (2001, "01", "a", "0"),
        (2001, "01", "b", "1"),
        (2002, "01", "c], [d", "0"),
        (2002, "01", 'e"', "1"),
    ]
    assert sorted(map(tuple, whole.collect())) == expected
    assert sorted(map(tuple, by_line.drop("position").collect())) == expected
    in_order = [r.name for r in by_line.filter("year = 2001").orderBy("position").collect()]
    assert in_order == ["a", "b"]


def test_lenient_reading_skips_an_empty_document(spark):
    empty = spark.createDataFrame([("[]", 1), ("not json", 2)], "value string, year bigint")
    found = unpack(empty, parse_matrix("value", False), CELLS, ["year"], strict=False)
    assert found.count() == 0 and found.collect() == []


@pytest.mark.parametrize(
    "text",
    [
        '[["NAME","V"],["a","0"],["b","1"]]',
        '[\n["NAME","V"],\n["a","0"],["b","1"]\n]',
        '[["NAME","V"],["a","0"],\n["b","1"]]\n',
        '[\n  [ "NAME", "V" ],\n  [ "a", "0" ],\n\n  [ "b", "1" ]\n]',
    ],
)
@pytest.mark.parametrize("strict", [True, False])
def test_any_layout_with_whole_rows_on_a_line(spark, tmp_path, text, strict):
    folder = tmp_path / "year=2001" / "state=01"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text(text)
    whole = unpack(
        read_documents(spark, str(tmp_path)), parse_matrix("value"), CELLS, ["year", "state"]
    ).drop("position")
    by_line = unpack_lines(spark, str(tmp_path), CELLS, strict)
    rows = [tuple(r) for r in by_line.orderBy("position").drop("position").collect()]
    assert rows == sorted(map(tuple, whole.collect())) and len(rows) == 2


@pytest.mark.parametrize(
    ("text", "problem"),
    [
        ('[["NAME","V"],\n[\n"a",\n"0"\n]]', "not whole rows on a line"),
        ('[["NAME","V"],["a","0"], oops]', "not whole rows on a line"),
        ("[\n]", "no header row"),
    ],
)
def test_other_layouts_fail_in_strict_mode(spark, tmp_path, text, problem):
    folder = tmp_path / "year=2001" / "state=01"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text(text)
    with pytest.raises(Exception, match=problem):
        unpack_lines(spark, str(tmp_path), CELLS).collect()


def test_names_with_quotes_and_blanks(spark):
    matrix = [["it's", "a b"], ["x", "1"]]
    found = unpack(
        spark.createDataFrame([(json.dumps(matrix), 1)], "value string, year bigint"),
        parse_matrix("value"),
        {"my name": "it's", "a.b": "a b"},
        ["year"],
    )
    assert found.columns == ["year", "position", "my name", "a.b"]
    assert tuple(found.first())[2:] == ("x", "1")


def told(spark, *texts):
    df = spark.createDataFrame(
        [(t, 2000 + i) for i, t in enumerate(texts)], "value string, year bigint"
    )
    found = unpack_or_tell(df, "value", CELLS, ["year"]).collect()
    return sorted(((r.year, r.position, r.name, r.v, r.problem) for r in found), key=str)


def test_a_broken_document_tells_and_spares_the_others(spark):
    sound = json.dumps([["V", "NAME", "V"], ["0", "a", "1"], [None, "b", None, "x"]])
    found = told(
        spark,
        sound,
        "{",
        None,
        "[]",
        "[null]",
        '[["NAME"], ["a"]]',
        '[["NAME", "V"], ["a"], ["b", "2"], null]',
        '[["NAME", "V"]]',
        "plain text",
        '[["NAME", "V"], "c"]',
    )
    assert found == [
        (2000, 0, "a", "1", None),
        (2000, 1, "b", None, None),
        (2001, None, None, None, "not JSON rows of cells"),
        (2002, None, None, None, "not JSON rows of cells"),
        (2003, None, None, None, "no header row"),
        (2004, None, None, None, "no header row"),
        (2005, None, None, None, "no cell V"),
        (2006, None, None, None, "short rows: 2"),
        (2008, None, None, None, "not JSON rows of cells"),
        (2009, None, None, None, "not JSON rows of cells"),
    ]


def test_sound_documents_unpack_alike_either_way(spark):
    matrices = [[["NAME", "V"], *[[f"n{i}", str(i)] for i in range(k)]] for k in range(5)]
    df = documents(spark, *matrices)
    strict = unpack(df, parse_matrix("value"), CELLS, ["year"])
    lenient = unpack_or_tell(df, "value", CELLS, ["year"])
    assert lenient.filter("problem is not null").isEmpty()
    assert sorted(lenient.drop("problem").collect()) == sorted(strict.collect())
