"""Names and texts as parts of SQL expressions."""

from __future__ import annotations


def quoted(name: str) -> str:
    """A column name as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string as a literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
