"""Casts and arithmetic with one settled rule: a missing number is NULL."""

from __future__ import annotations

# Java also reads "12d" and "0x1p3" as doubles; a data cell must not.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def nan_to_null(number: str) -> str:
    return f"nullif({number}, double('NaN'))"


def lenient_double(cell: str) -> str:
    """A number, or NULL where the text is not one ('nan' included)."""
    return f"if({cell} rlike r'{_NUMBER}', try_cast({cell} as double), null)"


def lenient_long(cell: str) -> str:
    """A whole number, or NULL. '12.0' and '1e3' count as whole, '12.5' does not.

    Through a decimal, which holds every bigint exactly.
    """
    wide = f"try_cast(trim({cell}) as decimal(38,10))"
    whole = f"{cell} rlike r'{_NUMBER}' and {wide} % 1 = 0"
    return (
        f"coalesce(try_cast({cell} as bigint), if({whole}, try_cast({wide} as bigint), null))"
    )


def total(parts: list[str]) -> str:
    """Sum across columns, NULL when any part is."""
    return " + ".join(parts)


def attempt(name: str, formula: str, cells: list[str]) -> tuple[str, str]:
    """A formula over whole-number cells, NULL where a cell is text or missing, and what
    is wrong then.

    `formula` names the cells as {0}, {1}, ...
    """
    number = formula.format(*[f"try_cast({c} as bigint)" for c in cells])
    shown = ", ".join(f"coalesce({c}, 'missing')" for c in cells)
    return number, f"concat('{name}: not whole numbers: ', concat_ws(', ', {shown}))"


def attempt_total(name: str, cells: list[str]) -> tuple[str, str]:
    return attempt(name, total([f"{{{i}}}" for i in range(len(cells))]), cells)


def strict(name: str, formula: str, cells: list[str]) -> str:
    """As `attempt`, but text or a missing cell fails the job."""
    number, problem = attempt(name, formula, cells)
    return f"coalesce({number}, cast(raise_error({problem}) as bigint))"


def strict_total(name: str, cells: list[str]) -> str:
    return strict(name, total([f"{{{i}}}" for i in range(len(cells))]), cells)


def percent(part: str, whole: str) -> str:
    """part / whole * 100, NULL when the whole is zero."""
    return f"try_divide({part}, {whole}) * 100"


def growth(later: str, earlier: str) -> str:
    """Relative change as a fraction, NULL when the earlier value is zero."""
    return f"try_divide({later}, {earlier}) - 1"
