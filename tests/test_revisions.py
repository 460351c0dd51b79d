"""Revision detection against all pairs, worked out one by one on small inputs."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import rows
from tidemark.operators.revisions import (
    detect_revisions,
    flag_revised,
    pair_total,
    revised_measures,
    revision_values,
)

KEYS = ["region_key", "year", "indicator_code"]
SCHEMA = "region_key string, year int, indicator_code string, value double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def by_pairs(current, prior):
    """key -> (old values, new values, number of differing pairs), the slow and obvious way."""
    found = {}
    for *key, new in current:
        for *other, old in prior:
            if key == other and new is not None and old is not None and new != old:
                found[tuple(key)] = found.get(tuple(key), 0) + 1
    result = {}
    for key, pairs in found.items():
        olds = Counter(v for *k, v in prior if tuple(k) == key and v is not None)
        news = Counter(v for *k, v in current if tuple(k) == key and v is not None)
        result[key] = (olds, news, pairs)
    return result


def check(spark, current, prior):
    cur, old = frame(spark, current), frame(spark, prior)
    expected = by_pairs(current, prior)
    found = detect_revisions(cur, old, KEYS)
    got = {tuple(r[:3]): r for r in found.collect()}
    assert got.keys() == expected.keys()
    for key, (olds, news, _) in expected.items():
        row = got[key]
        assert (row.old_rows, row.new_rows) == (olds.total(), news.total())
        assert row.old_value == (next(iter(olds)) if len(olds) == 1 else None)
        assert row.new_value == (next(iter(news)) if len(news) == 1 else None)
    listed = revision_values(cur, old, found, KEYS)
    wanted = {
        (*key, v): (olds[v], news[v])
        for key, (olds, news, _) in expected.items()
        if len(olds) > 1 or len(news) > 1
        for v in olds.keys() | news.keys()
    }
    assert {tuple(r[:4]): (r.old_rows, r.new_rows) for r in listed.collect()} == wanted
    assert listed.count() == len(wanted)
    total = pair_total(found, listed).first()[0]
    assert total == sum(pairs for *_, pairs in expected.values())


def test_what_counts_as_a_revision(spark):
    current = [("A", 2020, "x", 5.0), ("B", 2020, "x", 5.0), ("C", 2020, "x", None),
               ("D", 2020, "x", 1.0), ("E", 2020, "x", 1.0)]
    prior = [("A", 2020, "x", 4.0), ("B", 2020, "x", 5.0), ("C", 2020, "x", 1.0),
             ("D", 2020, "x", None), ("F", 2020, "x", 1.0)]
    found = detect_revisions(frame(spark, current), frame(spark, prior), KEYS, prior_date="2024-01-01")
    assert rows(found) == [("A", 2020, "x", 4.0, 5.0, 1, 1, "2024-01-01")]


def test_null_keys_match_each_other_or_not(spark):
    current, prior = [("A", None, "x", 1.0)], [("A", None, "x", 2.0)]
    check(spark, current, prior)
    dropped = detect_revisions(frame(spark, current), frame(spark, prior), KEYS, null_keys="drop")
    assert dropped.count() == 0
    with pytest.raises(ValueError, match="null_keys"):
        detect_revisions(frame(spark, current), frame(spark, prior), KEYS, null_keys="other")


def test_same_values_on_both_sides_still_differ_in_pairs(spark):
    both = [("A", None, "x", 1.0), ("A", None, "x", 2.0)]
    check(spark, both, both)


def test_zero_has_no_sign(spark):
    check(spark, [("A", 1, "x", 0.0)], [("A", 1, "x", -0.0)])


ROW = st.tuples(
    st.sampled_from(["A", "B", None]),
    st.sampled_from([2020, None]),
    st.sampled_from(["x", "y"]),
    st.sampled_from([None, 1.0, 2.0, 3.5]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=14), st.lists(ROW, max_size=14))
def test_agrees_with_all_pairs(spark, current, prior):
    check(spark, current, prior)


def test_flag_never_repeats_a_row(spark):
    data = [("A", 2020, "x", 1.0), ("A", 2020, "x", 1.0), ("B", None, "x", 2.0), ("C", 1, "x", 3.0)]
    revised = spark.createDataFrame(
        [("A", 2020, "x"), ("A", 2020, "x"), ("B", None, "x")],
        "region_key string, year int, indicator_code string",
    )
    flagged = flag_revised(frame(spark, data), revised, KEYS)
    assert rows(flagged, "region_key", "is_revised") == [
        ("A", True), ("A", True), ("B", True), ("C", False),
    ]
    assert rows(flag_revised(frame(spark, data), None, KEYS), "is_revised") == [(False,)] * 4


def test_wide_rows_give_what_long_rows_give(spark):
    schema = "region_key string, year int, x double, y double"
    now = spark.createDataFrame(
        [("A", 1, 1.0, 2.0), ("A", 1, 1.0, None), ("B", None, 5.0, 6.0), ("C", 1, 1.0, 1.0)], schema
    )
    then = spark.createDataFrame(
        [("A", 1, 1.0, 3.0), ("B", None, 4.0, 6.0), ("B", None, 5.0, 6.0), ("C", 1, None, 1.0)],
        schema,
    )

    def unpivot(df):
        return df.unpivot(["region_key", "year"], ["x", "y"], "indicator_code", "value")

    wide = detect_revisions(now, then, ["region_key", "year"], ["x", "y"], "indicator_code")
    long = detect_revisions(unpivot(now), unpivot(then), KEYS)
    assert rows(wide, *long.columns) == rows(long)
    assert rows(long, "region_key", "indicator_code") == [("A", "y"), ("B", "x")]

    marked = revised_measures(now, wide, ["region_key", "year"], "indicator_code")
    assert marked.count() == now.count()
    assert rows(marked, "region_key", "x", "revised_measures") == rows(
        spark.createDataFrame(
            [("A", 1.0, ["y"]), ("A", 1.0, ["y"]), ("B", 5.0, ["x"]), ("C", 1.0, [])],
            "region_key string, x double, revised_measures array<string>",
        )
    )
    nothing = revised_measures(now, None, ["region_key", "year"], "indicator_code")
    assert {tuple(r.revised_measures) for r in nothing.collect()} == {()}


def test_a_hot_key_gives_one_row(spark):
    """A third of the rows under one key: pairs would be 10**10, the answer is one row."""
    hot = spark.range(100_000).selectExpr(
        "cast(null as string) region_key", "cast(null as int) year", "'x' indicator_code",
        "cast(id % 1000 as double) value",
    )
    rest = spark.range(200_000).selectExpr(
        "cast(id as string) region_key", "2020 year", "'x' indicator_code", "1d value"
    )
    both = hot.unionByName(rest)
    found = detect_revisions(both, both, KEYS)
    assert [(r.old_rows, r.new_rows) for r in found.collect()] == [(100_000, 100_000)]
    listed = revision_values(both, both, found, KEYS)
    assert listed.count() == 1000
    assert pair_total(found, listed).first()[0] == 100_000**2 - 1000 * 100 * 100
