"""Snapshots derived from the test tables.

Parts act as regions and ship years as years; the shares of line items by flag act as four
indicators. Names, codes, years and values are roughened by fixed rules, so every rule of the
library has rows to act on. All columns are text, as if read from a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Indicator, Settings

AS_OF_YEAR = 2026
CURRENT, PRIOR = "2024-01-15", "2024-01-08"

SETTINGS = Settings(
    indicators=(
        Indicator("ind_f", "F", "Finished lines", "share", "%"),
        Indicator("ind_a", "A", "Lines flagged A", "share", "%"),
        Indicator("ind_b", "B", "Lines flagged N", "share", "%"),
        Indicator("ind_c", "C", "Lines flagged R", "share", "%"),
    ),
    main_indicator="F",
    name_col="entity",
    code_col="code",
    year_col="year",
    country_len=8,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(number: Column) -> Column:
    return number.cast("string")


def _padded_code(k: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(_text(k), 7, "0"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, y, entity, code, year, ind_f, ind_a, ind_b, ind_c): a row per part and ship year.

    Line items are counted per part and year before they meet the part names, so the join moves
    groups and not line items."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    shares = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("k"), F.year("l_shipdate").alias("y"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(flag == "A").alias("a"),
            F.count_if(flag == "N").alias("b"),
            F.count_if(flag == "R").alias("c"),
            F.count_if(status == "F").alias("f"),
        )
    )
    k, y = F.col("k"), F.col("y")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name")
    name = F.concat("p_name", F.lit(" "), _text(k))

    def share(count: str) -> Column:
        return F.floor(F.lit(100) * F.col(count) / F.col("n")).cast("int")

    return shares.join(part, "k").select(
        "k",
        "y",
        F.when(k % 101 == 0, "   ")
        .when(k % 7 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
        .otherwise(name)
        .alias("entity"),
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 1, F.concat(F.lit("OWID_"), _text(k)))
        .when(k % 10 == 2, F.concat(F.lit("X"), _text(k), F.lit("longcode")))
        .when(k % 10 == 3, F.concat(F.lit(" "), _padded_code(k), F.lit(" ")))
        .otherwise(_padded_code(k))
        .alias("code"),
        F.when(k % 211 == 0, "1900").when(k % 223 == 0, "n/a").otherwise(_text(y)).alias("year"),
        F.when((k + y) % 11 == 0, F.lit(None).cast("string"))
        .when((k + y) % 13 == 0, "abc")
        .when((k + y) % 37 == 0, _text(share("f") + 200))
        .otherwise(_text(share("f")))
        .alias("ind_f"),
        _text(share("a")).alias("ind_a"),
        F.when((k * 3 + y) % 17 != 0, _text(share("b"))).alias("ind_b"),
        _text(share("c")).alias("ind_c"),
    )


def prior_wide(current: DataFrame) -> DataFrame:
    """The snapshot before: some regions not there yet, some values different."""
    value = F.col("ind_f").try_cast("int")
    changed = ((F.col("k") * 7 + F.col("y")) % 19 == 0) & value.isNotNull()
    return current.where(F.col("k") % 29 != 0).withColumn(
        "ind_f", F.when(changed, _text((value + 50) % 101)).otherwise(F.col("ind_f"))
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes for half of the parts that lack one, each listed twice: the last row counts."""
    k = F.col("p_partkey")
    named = (
        table(spark, sf_dir, "part")
        .where(k % 20 == 10)
        .select(F.concat("p_name", F.lit(" "), _text(k)).alias("alias"), k)
    )
    once = [
        named.select("alias", code.alias("iso_code"), F.lit(row).cast("bigint").alias("alias_row"))
        for row, code in ((1, F.lit("STALE")), (2, _padded_code(k)))
    ]
    return once[0].unionByName(once[1])
