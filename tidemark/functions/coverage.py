"""Column functions that judge a coverage figure."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AT_TARGET = "At or above WHO target"
MODERATE = "Moderate coverage"
LOW = "Low coverage"


def _exact(limit: float) -> Column:
    """A limit as a decimal literal, so that comparing it with a decimal column stays exact."""
    return F.lit(Decimal(str(limit)))


def coverage_band(value: Column, threshold: float = 80.0, moderate_floor: float = 50.0) -> Column:
    return (
        F.when(value >= _exact(threshold), AT_TARGET)
        .when(value >= _exact(moderate_floor), MODERATE)
        .otherwise(LOW)
    )


def gap_to_target(value: Column, threshold: float = 80.0) -> Column:
    return (_exact(threshold) - value).cast("decimal(9,2)")


def target_marker(value: Column, threshold: float = 80.0) -> Column:
    return F.when(value < _exact(threshold), "below").otherwise("at_or_above")


def is_below(value: Column, threshold: float = 80.0) -> Column:
    """Strictly below: a figure equal to the threshold meets it."""
    return value < _exact(threshold)
