"""Aggregate expressions for forecast quality."""

from __future__ import annotations


def mae(actual: str, predicted: str) -> str:
    return f"avg(abs({predicted} - {actual}))"


def _squares(actual: str, predicted: str) -> str:
    return f"({predicted} - {actual}) * ({predicted} - {actual})"


def rmse(actual: str, predicted: str) -> str:
    return f"sqrt(avg({_squares(actual, predicted)}))"


def r2(actual: str, predicted: str) -> str:
    """NULL below two rows; a constant actual scores 1 if matched, else 0."""
    left, spread = f"sum({_squares(actual, predicted)})", f"regr_syy({actual}, {actual})"
    return f"""case when count({actual}) < 2 then null
        when {spread} = 0 then if({left} = 0, double(1), double(0))
        else 1 - try_divide({left}, {spread}) end"""
