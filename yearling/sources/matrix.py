"""Header-and-rows JSON matrices: `[[h1, h2], [a, b], ...]`, all cells text.

Landed as files below `year=<y>/state=<s>/`; one read covers every file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.functions.names import quoted, text
from yearling.sources.staging import staged

_LANDED = "value string, year bigint, state string"
_MATRIX = "array<array<string>>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row (value, year, state) per landed document."""
    # The schema keeps state codes text: inference would drop leading zeros.
    return spark.read.schema(_LANDED).text(path, wholetext=True)


def _mode(strict: bool) -> str:
    return f"map('mode', '{'FAILFAST' if strict else 'PERMISSIVE'}')"


def parse_matrix(document: str, strict: bool = True) -> str:
    """Document text to rows of cells. Strict fails on bad JSON or no header row."""
    matrix = f"from_json({document}, '{_MATRIX}', {_mode(strict)})"
    if not strict:
        return matrix
    problem = "raise_error('document is not a matrix with a header row')"
    return f"if(size({matrix}) >= 1, {matrix}, cast({problem} as {_MATRIX}))"


def _places(header: str, names: list[str], strict: bool) -> list[str]:
    """`_places`: the 0-based place of each wanted header, the last of equal ones
    and NULL when absent; `_need`: how many cells a row needs for all of them."""
    at = [f"size({header}) - nullif(int(array_position(reverse({header}), {text(n)})), 0)" for n in names]
    fields = ", ".join(f"'h{i}', {place}" for i, place in enumerate(at))
    columns = [f"named_struct({fields}) as _places"]
    if strict:
        missing = f"array_except(array({', '.join(map(text, names))}), {header})"
        problem = f"raise_error(concat('no cell ', array_join({missing}, ', ')))"
        most = f"array_max(array({', '.join(at)})) + 1"
        columns.append(f"if(size({missing}) = 0, {most}, cast({problem} as int)) as _need")
    return columns


def _checked(strict: bool) -> str:
    if not strict:
        return "_cells"
    problem = "raise_error(concat('short row: ', array_join(_cells, ', ', 'null')))"
    return f"if(size(_cells) >= _need, _cells, cast({problem} as array<string>)) as _cells"


def _picked(cells: Mapping[str, str], names: list[str]) -> list[str]:
    at = {name: f"_places.h{i}" for i, name in enumerate(names)}
    return [f"get(_cells, {at[name]}) as {quoted(column)}" for column, name in cells.items()]


def unpack(
    documents: DataFrame,
    matrix: str,
    cells: Mapping[str, str],
    keep: list[str],
    strict: bool = True,
) -> DataFrame:
    """One row per matrix row: `keep`, `position`, then each {column: header}.

    Row 0 names the cells. The last of equal headers wins; a short row lacks its
    last cells (strict: fails), surplus cells are dropped. Places are looked up
    once per document, so a row costs one array read per wanted cell.
    """
    names = list(dict.fromkeys(cells.values()))
    rows = "posexplode(slice(_matrix, 2, greatest(size(_matrix) - 1, 0))) as (_row, _cells)"
    known = [*keep, "_places", *(["_need"] if strict else [])]
    return (
        documents.selectExpr(*keep, f"{matrix} as _matrix")
        .selectExpr(*keep, "_matrix", *_places("get(_matrix, 0)", names, strict))
        .selectExpr(*known, rows)
        .selectExpr(*keep, "_places", "bigint(_row) as position", _checked(strict))
        .selectExpr(*keep, "position", *_picked(cells, names))
    )


def unpack_or_tell(
    documents: DataFrame, text_column: str, cells: Mapping[str, str], keep: list[str]
) -> DataFrame:
    """As strict `unpack`, but a document that breaks a rule costs only itself.

    Adds `problem`: NULL for the rows of a sound document. One that is no JSON matrix, has
    no header row, lacks a wanted header or has a short row is a single row without cells
    that says so. Every document is parsed once.
    """
    names = list(dict.fromkeys(cells.values()))
    header = "get(_matrix, 0)"
    missing = f"array_except(array({', '.join(map(text, names))}), {header})"
    at = [f"_places.h{i}" for i in range(len(names))]
    need = f"array_max(array({', '.join(at)})) + 1"
    rows = "slice(_matrix, 2, greatest(size(_matrix) - 1, 0))"
    short = f"size(filter({rows}, r -> r is null or size(r) < {need}))"
    problem = f"""case
        when _matrix is null then 'not JSON rows of cells'
        when size(_matrix) = 0 or {header} is null then 'no header row'
        when size({missing}) > 0 then concat('no cell ', array_join({missing}, ', '))
        when {short} > 0 then concat('short rows: ', {short}) end as problem"""
    told = f"posexplode_outer(if(problem is null, {rows}, null)) as (_row, _cells)"
    return (
        documents.selectExpr(*keep, f"{parse_matrix(quoted(text_column), strict=False)} as _matrix")
        .selectExpr(*keep, "_matrix", *_places(header, names, strict=False))
        .selectExpr("*", problem)
        .selectExpr(*keep, "_places", "problem", told)
        # A sound document of no rows has nothing to tell.
        .filter("problem is not null or _row is not null")
        .selectExpr(*keep, "bigint(_row) as position", *_picked(cells, names), "problem")
    )


# A complete row of scalars on a line; brackets inside strings do not count.
_ROW = r'\[(?:[^\[\]"]|"(?:[^"\\]|\\.)*")*\]'


def unpack_lines(
    spark: SparkSession,
    path: str,
    cells: Mapping[str, str],
    strict: bool = True,
) -> DataFrame:
    """As `read_documents` + `unpack`, for documents whose rows do not span lines.

    Lines are splittable, so one very large document is read by many tasks. A line may
    hold any number of rows; the first row of a file is its header and is joined back by
    file name. `position` grows with the place of the row in its file. A line with
    anything beside rows, commas and the outer brackets, and a file without a row, fail
    in strict mode; otherwise such text is left out.
    """
    names = list(dict.fromkeys(cells.values()))
    parsed = f"from_json(_text, 'array<string>', {_mode(strict)})"
    lines = (
        spark.read.schema(_LANDED)
        .text(path)
        .select(
            "year",
            "state",
            F.expr("_metadata.file_path as _file"),
            F.expr("_metadata.file_block_start as _block"),
            F.monotonically_increasing_id().alias("_line"),
            F.regexp_extract_all("value", F.lit(_ROW), F.lit(0)).alias("_texts"),
            F.regexp_replace("value", _ROW, "").alias("_beside"),
            "value",
        )
    )
    if strict:
        problem = "raise_error(concat('not whole rows on a line: ', left(value, 200)))"
        clean = r"_beside rlike r'^[\s,\[\]]*$'"
        lines = lines.withColumn(
            "_texts", F.expr(f"if({clean}, _texts, cast({problem} as array<string>))")
        )
    lines = lines.drop("_beside", "value")
    place = "struct(_block as block, _line as line, {} as row) as position"
    first = f"min(if(size(_texts) > 0, struct({place.format(0)}, _texts[0] as _text), null))"
    headers = lines.groupBy("_file").agg(F.expr(f"{first} as _first")).select("_file", "_first.*")
    if strict:
        missing = "raise_error(concat('no header row in ', _file))"
        headers = headers.withColumn(
            "_text", F.expr(f"coalesce(_text, cast({missing} as string))")
        )
    # One line per file: stored, so Spark knows its size and need not shuffle the
    # rows of a usual number of files.
    headers = staged(
        headers.selectExpr("_file", "position as _at", f"{parsed} as _header").selectExpr(
            "_file", "_at", *_places("_header", names, strict)
        ),
        "matrix-headers",
    )
    rows = (
        lines.selectExpr("*", "posexplode(_texts) as (_number, _text)")
        .selectExpr("year", "state", "_file", place.format("_number"), f"{parsed} as _cells")
    )
    keep = ["year", "state", "position"]
    return (
        rows.join(headers, "_file")
        .where("position <> _at")
        .selectExpr(*keep, "_places", _checked(strict))
        .selectExpr(*keep, *_picked(cells, names))
    )
