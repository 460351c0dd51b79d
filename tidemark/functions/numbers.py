"""Column functions from text to numbers. Whatever is not a number becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JVM also reads "75d", "75f" and hexadecimal as numbers; a data file means none of these.
_JVM_ONLY_NUMBER = r"[dDxX]|[0-9.][fF]"


def to_number(col: Column) -> Column:
    """Text to double. NaN is null too: Spark orders it above every number, so a range rule
    would reject it where it only marks a missing value."""
    number = F.when(~col.rlike(_JVM_ONLY_NUMBER), col).try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def to_year(col: Column) -> Column:
    """Text to a whole year: "2020" and "2020.0" are 2020, "2020.5" is null. The longer way by
    way of a double is only gone for text that is not plain digits."""
    number = to_number(col)
    whole = F.when(number == F.rint(number), number).try_cast("int")
    return F.coalesce(col.try_cast("int"), whole)
