"""Fixed schemas of the published tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tidemark.functions.text import quoted


_TYPES: Mapping[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "figure": T.DecimalType(8, 2),
    "digest": T.DecimalType(38, 0),
}


def _schema(columns: str) -> T.StructType:
    """A schema from "name type, ..."; unlike DDL text it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Quarantined rows and revisions keep their values as read: they have not passed validation, and
# a figure too large for the staging type must not be lost or stop the load.
STAGING: Mapping[str, T.StructType] = {
    "stg_health_indicators": _schema(
        "region_key string, region_name string, iso_code string, region_type string, year int,"
        " indicator_code string, indicator_name string, indicator_category string,"
        " indicator_unit string, value figure, is_missing boolean, is_revised boolean,"
        " is_estimated boolean, loaded_at timestamp"
    ),
    "stg_regions": _schema(
        "region_key string, region_name string, iso_code string, region_type string"
    ),
    "stg_rejected_rows": _schema(
        "source_row bigint, region_name string, iso_code string, year int,"
        " indicator_code string, value double, reject_reason string, raw_line string,"
        " loaded_at timestamp"
    ),
    "stg_data_revisions": _schema(
        "region_key string, year int, indicator_code string, old_value double,"
        " new_value double, old_rows bigint, new_rows bigint, prior_snapshot string,"
        " detected_at timestamp"
    ),
    "stg_revision_values": _schema(
        "region_key string, year int, indicator_code string, value double, old_rows bigint,"
        " new_rows bigint"
    ),
}

WAREHOUSE: Mapping[str, T.StructType] = {
    "dim_region": _schema(
        "region_key string, region_name string, iso_code string, region_type string,"
        " region_type_label string"
    ),
    "dim_date": _schema(
        "date_id int, date_day date, day int, month int, year int, quarter int,"
        " reporting_frequency string"
    ),
    "dim_indicator": _schema(
        "indicator_code string, indicator_name string, indicator_category string,"
        " indicator_unit string"
    ),
    "fact_health_indicator": _schema(
        "region_key string, region_id string, value figure, is_missing boolean,"
        " is_revised boolean, is_estimated boolean, loaded_at timestamp,"
        " indicator_id string, date_id int"
    ),
    "fact_periods": _schema("indicator_id string, date_id int, fact_rows bigint"),
    "value_history_closed": _schema(
        "region_key string, year int, indicator_code string, value double, valid_from date, valid_to date"
    ),
    "value_history_open": _schema(
        "region_key string, year int, indicator_code string, value double, valid_from date, valid_to date"
    ),
    "value_history_dates": _schema("snapshot_date date, mark string"),
    "partition_marks": _schema("indicator_code string, year int, staged_rows bigint, one digest, other digest"),
}

# A report reads one indicator, and mostly its last year: one folder of the fact table. Staging is
# laid out in the same way, so that a late file has but the folders it touches written again.
PARTITIONS: Mapping[str, tuple[str, ...]] = {
    "stg_health_indicators": ("indicator_code", "year"),
    "fact_health_indicator": ("indicator_id", "date_id"),
}

# Within a folder rows are in this order, so that the history of one region is a small part of it.
CLUSTERS: Mapping[str, tuple[str, ...]] = {
    "stg_health_indicators": ("region_key",),
    "fact_health_indicator": ("region_id",),
}

SCHEMAS = {**STAGING, **WAREHOUSE}

QUALITY_LOG = "data_quality_log"


def _typed(field: T.StructField) -> Column:
    return quoted(field.name).cast(field.dataType).alias(field.name)


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns and types of the published table ``name``."""
    return df.select([_typed(f) for f in SCHEMAS[name].fields])
