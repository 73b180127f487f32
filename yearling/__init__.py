"""Yearly panels on Spark: build, check, load, forecast and evaluate."""

from yearling.spec import PanelSpec

__all__ = ["PanelSpec"]
