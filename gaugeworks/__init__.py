"""Spark operators for regular-grid observation series."""

from gaugeworks.spec import SeriesSpec

__all__ = ["SeriesSpec"]
