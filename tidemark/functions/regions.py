"""Column functions that describe a region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def region_type(code: Column, aggregate_prefix: str = "OWID_", country_len: int = 3) -> Column:
    """unknown / aggregate / country / other of a stripped code. The aggregate prefix is tested
    before the length."""
    return (
        F.when(code.isNull() | (code == ""), "unknown")
        .when(code.startswith(aggregate_prefix), "aggregate")
        .when(F.length(code) == country_len, "country")
        .otherwise("other")
    )


def region_key(code: Column, name: Column) -> Column:
    """The code where there is one, else the name in lower case with ``_`` for each space."""
    return F.coalesce(code, F.replace(F.lower(name), F.lit(" "), F.lit("_")))


def region_type_label(kind: Column) -> Column:
    return (
        F.when(kind == "country", "Country")
        .when(kind == "aggregate", "Regional aggregate")
        .otherwise("Other")
    )
