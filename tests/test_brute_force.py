"""The whole cleaning step against plain Python, on random dirty snapshots."""

from collections import Counter
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.config import Indicator, Settings
from tidemark.plans.tidy import (
    flagged_rows,
    quarantined_rows,
    seen_regions,
    snapshot_revisions,
    typed_wide,
)

SETTINGS = Settings(indicators=tuple(Indicator(c, c.upper(), c, "x", "%") for c in ("a", "b")))
SCHEMA = "source_row bigint, region_name string, iso_code string, year string, b string, a string"
FILE_ORDER = ("b", "a")
ALIASES = {"Two": "TWO", "Three": "THREE"}
STAMP = datetime(2026, 1, 1)

NAMES = st.sampled_from(["One", " One ", "Two", "Three", "  ", None])
CODES = st.sampled_from(["ONE", " ONE", "OWID_ONE", "nan", "", "XY", None])
YEARS = st.sampled_from(["2020", "2021.0", "1900", "2020.5", "n/a", None])
VALUES = st.sampled_from(["5", "5.0", "80", "101", "-1", "abc", "NaN", "inf", None])
SNAPSHOT = st.lists(st.tuples(NAMES, CODES, YEARS, VALUES, VALUES), max_size=9)


def number(text):
    try:
        value = float(text)
    except (TypeError, ValueError):
        return None
    return None if value != value else value


def tidy(rows):
    """Long rows in the order of a melt: dicts with everything known before validation."""
    long = []
    for place, column in enumerate(FILE_ORDER):
        for at, (name, code, year, *values) in enumerate(rows):
            name = None if name is None else name.strip()
            code = None if code is None or code.strip() in ("", "nan", "None") else code.strip()
            code = code or ALIASES.get(name)
            when = number(year)
            kind = (
                "unknown" if code is None else "aggregate" if code.startswith("OWID_")
                else "country" if len(code) == 3 else "other"
            )
            key = code if code is not None else None if name is None else name.lower().replace(" ", "_")
            long.append(dict(
                row=at, name=name, code=code, kind=kind, key=key, indicator=column.upper(),
                year=int(when) if when is not None and when == int(when) else None,
                value=number(values[place]),
            ))
    return long


def reasons(r):
    found = []
    if r["year"] is None or not 1980 <= r["year"] <= 2027:
        found.append("invalid_year")
    if not r["name"]:
        found.append("missing_region")
    if r["value"] is not None and not 0 <= r["value"] <= 100:
        found.append("value_out_of_range")
    return "|".join(found)


def grain(r):
    return (r["key"], r["year"], r["indicator"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SNAPSHOT, SNAPSHOT)
def test_cleaning_agrees_with_plain_python(spark, current, prior):
    def typed(rows):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
        aliases = spark.createDataFrame(
            [(n, c, 0) for n, c in ALIASES.items()], "alias string, iso_code string, alias_row bigint"
        )
        return typed_wide(df, SETTINGS, aliases)

    long, before = tidy(current), tidy(prior)
    revised = {
        grain(n)
        for n in long
        for o in before
        if grain(n) == grain(o) and None not in (n["value"], o["value"]) and n["value"] != o["value"]
    }
    now = typed(current)
    found = snapshot_revisions(now, typed(prior), SETTINGS, "2025-01-01")
    assert {tuple(r) for r in found.select("region_key", "year", "indicator_code").collect()} == revised

    flagged = flagged_rows(now, found, SETTINGS, 2026, F.lit(STAMP))
    columns = ("region_key", "region_name", "iso_code", "region_type", "year", "indicator_code",
               "value", "is_missing", "is_revised", "is_estimated")
    assert Counter(tuple(r) for r in flagged.select(*columns).collect()) == Counter(
        (r["key"], r["name"], r["code"], r["kind"], r["year"], r["indicator"], r["value"],
         r["value"] is None, grain(r) in revised, r["value"] is None or grain(r) in revised)
        for r in long if not reasons(r)
    )

    rejects = quarantined_rows(now, SETTINGS, 2026, F.lit(STAMP)).drop("loaded_at")
    assert Counter(tuple(r) for r in rejects.collect()) == Counter(
        (r["row"], r["name"], r["code"], r["year"], r["indicator"], r["value"], reasons(r))
        for r in long if reasons(r)
    )

    first = {}
    for r in long:
        if not reasons(r):
            first.setdefault(r["key"], (r["name"], r["code"], r["kind"]))
    assert {r[0]: tuple(r)[1:] for r in seen_regions(now, SETTINGS, 2026).collect()} == first


def test_rows_are_dealt_while_they_are_wide(spark):
    """Dealing wide rows gives the same long rows, and none that a rule on region or year rejects is moved."""
    data = [(i, f"r{i % 5}", f"C{i % 5}", "x" if i % 7 == 0 else str(2000 + i % 3), *map(str, (i, i + 1, i + 2, 300))) for i in range(60)]
    columns = "source_row bigint, region_name string, iso_code string, year string, " + ", ".join(
        f"`{i.source_col}` string" for i in SETTINGS.indicators
    )
    now = typed_wide(spark.createDataFrame([d[: 4 + len(SETTINGS.indicators)] for d in data], columns), SETTINGS)
    plain = flagged_rows(now, None, SETTINGS, 2026, F.lit(STAMP))
    dealt = flagged_rows(now, None, SETTINGS, 2026, F.lit(STAMP), deal=("year", "region_key"))
    assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, plain.collect()))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("RepartitionByExpression")
