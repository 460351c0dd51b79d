"""Region names, codes, types and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.regions import region_key, region_type
from tidemark.functions.text import NO_CODE, normalise_code, null_if_in, strip_text


def fill_from_alias(
    df: DataFrame,
    aliases: DataFrame,
    name_col: str = "region_name",
    code_col: str = "iso_code",
    order_col: str = "alias_row",
) -> DataFrame:
    """Fill missing codes by an exact match of the name; codes that are there stay.

    A name listed twice takes its last row by ``order_col``, so no row of ``df`` is repeated. The
    alias side carries no broadcast hint: Spark broadcasts it when its size is under the session
    threshold, and splits a hot name in the sort-merge join otherwise."""
    last = aliases.groupBy(F.col("alias").alias("_alias")).agg(
        normalise_code(F.max_by("iso_code", order_col)).alias("_alias_code")
    )
    return (
        df.join(last, F.col(name_col) == F.col("_alias"), "left")
        .withColumn(code_col, F.coalesce(code_col, "_alias_code"))
        .drop("_alias", "_alias_code")
    )


def standardise_regions(
    df: DataFrame,
    aliases: DataFrame | None = None,
    name_col: str = "region_name",
    code_col: str = "iso_code",
    aggregate_prefix: str = "OWID_",
    country_len: int = 3,
) -> DataFrame:
    """Strip names and codes, fill codes from aliases, add region_type and region_key.

    Works on wide or long rows alike; on wide rows there are fewer of them."""
    # One step per column that is used twice below, so that no expression is worked out twice.
    out = df.withColumns({c: strip_text(F.col(c)) for c in (name_col, code_col)})
    out = out.withColumn(code_col, null_if_in(F.col(code_col), NO_CODE))
    if aliases is not None:
        out = fill_from_alias(out, aliases, name_col, code_col)
    return out.withColumns(
        {
            "region_type": region_type(F.col(code_col), aggregate_prefix, country_len),
            "region_key": region_key(F.col(code_col), F.col(name_col)),
        }
    )


def first_seen_dimension(
    df: DataFrame, key: str, attrs: Sequence[str], *order: Column
) -> DataFrame:
    """One row per key with the attributes of its first row by the whole number ``order``.

    Rows whose order is null are not seen. With several orders, each stands for one of several
    lists put end to end, in which the same row may appear: a row in the first list comes before
    all that are not.

    The rows shrink first to the distinct spellings of each key: that step keeps only numbers in
    its buffer, so it hashes, and a key holding a third of all rows collapses before the shuffle.
    Choosing among the few spellings left then needs a struct, for which Spark has to sort. Rows
    that share an order fall back on the attributes themselves."""
    places = [f"_seen{i}" for i in range(len(order))]
    spellings = (
        df.groupBy(key, *attrs)
        .agg(*[F.min(o.cast("bigint")).alias(p) for o, p in zip(order, places)])
        .where(F.coalesce(*places).isNotNull())
    )
    never = F.lit(2**63 - 1)
    position = F.struct(*[F.coalesce(p, never).alias(p) for p in places], *attrs)
    first = F.min_by(F.struct(*attrs), position)
    return spellings.groupBy(key).agg(first.alias("_first")).select(key, "_first.*")
