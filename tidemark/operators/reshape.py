"""From the wide snapshot to one row per region, year and indicator."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Indicator
from tidemark.functions.numbers import to_number
from tidemark.functions.text import quoted


def present_indicators(df: DataFrame, indicators: Sequence[Indicator]) -> list[str]:
    """The configured source columns the snapshot has, in the order of the file."""
    known = {i.source_col for i in indicators}
    return [c for c in df.columns if c in known]


def unpivot_indicators(
    df: DataFrame, indicators: Sequence[Indicator], ids: Sequence[str]
) -> DataFrame:
    """Long rows (``ids``, indicator_source_col, value), nulls kept.

    Columns of unknown indicators are left out before the unpivot, so the scan never reads them;
    an indicator the snapshot does not have is no error."""
    wanted = present_indicators(df, indicators)
    if not wanted:
        return df.select(
            *map(quoted, ids),
            F.lit(None).cast("string").alias("indicator_source_col"),
            F.lit(None).cast("double").alias("value"),
        ).where(F.lit(False))
    return df.unpivot(
        [quoted(c) for c in ids], [quoted(c) for c in wanted], "indicator_source_col", "value"
    )


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cols`` as doubles; text that is no number becomes null."""
    return df.withColumns({c: to_number(quoted(c).cast("string")) for c in cols})


def apply_indicator_metadata(df: DataFrame, indicators: Sequence[Indicator]) -> DataFrame:
    """Attach code, name, category and unit; rows of unknown indicators are dropped.

    The indicators are configuration, so they enter the plan as a constant map: the lookup runs
    inside the scan's stage and needs no join."""
    table = F.create_map(
        *chain.from_iterable(
            (
                F.lit(i.source_col),
                F.struct(
                    F.lit(i.code).alias("code"),
                    F.lit(i.name).alias("name"),
                    F.lit(i.category).alias("category"),
                    F.lit(i.unit).alias("unit"),
                ),
            )
            for i in indicators
        )
    )
    found = F.try_element_at(table, F.col("indicator_source_col"))
    return df.where(
        F.col("indicator_source_col").isin(*[i.source_col for i in indicators])
    ).withColumns(
        {
            "indicator_code": found["code"],
            "indicator_name": found["name"],
            "indicator_category": found["category"],
            "indicator_unit": found["unit"],
        }
    )
