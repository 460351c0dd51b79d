"""The history of values against plain Python, and the order of names."""

import random
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import functions as F

from helpers import FOUR_ROWS, rows, write_snapshot
from tidemark.config import Settings
from tidemark.operators.history import as_of, history_of, last_values, merge_snapshot
from tidemark.plans import reports
from tidemark.plans.history import read_history, snapshot_values, update_history
from tidemark.streaming.ingest import land_pending

SETTINGS = Settings()
NOW = datetime(2026, 3, 1, tzinfo=timezone.utc)
DAYS = [f"2026-01-{d:02d}" for d in (4, 9, 11, 17, 25, 30)]
DDL = "k string, y int, value double, source_row bigint"


def snapshot(seed):
    """Keys that come, go, repeat, and lack parts or a value."""
    r = random.Random(seed)
    out = []
    for row in range(60):
        key = (r.choice(["a", "b", "c", None]), r.choice([1, 2, 3, 4, None]))
        out.append((*key, r.choice([1.0, 2.0, None]), row))
    return out


def expected():
    """(k, y, value, from, to) by going through the snapshots one after the other."""
    values = []
    for i, _ in enumerate(DAYS):
        own = {}
        for k, y, v, _row in snapshot(i):
            if k is not None and y is not None and v is not None:
                own[k, y] = v
        values.append(own)
    out = []
    for key in {k for own in values for k in own}:
        begun = None
        for i, own in enumerate([*values, {}]):
            before = values[i - 1].get(key) if i else None
            now = own.get(key) if i < len(DAYS) else before
            if i and before is not None and (now != before or i == len(DAYS)):
                out.append((*key, before, DAYS[begun], DAYS[i] if i < len(DAYS) else None))
                begun = None
            if i < len(DAYS) and now is not None and now != before:
                begun = i
    return sorted(out, key=repr)


def plain(df):
    dated = df.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})
    return rows(dated, "k", "y", "value", "valid_from", "valid_to")


def test_merged_one_by_one_and_all_at_once(spark):
    frames = [last_values(spark.createDataFrame(snapshot(i), DDL), ["k", "y"]) for i in range(len(DAYS))]
    nothing = "k string, y int, value double, valid_from date, valid_to date"
    state, closed = spark.createDataFrame([], nothing), []
    for day, frame in zip(DAYS, frames, strict=True):
        step = merge_snapshot(state, frame, day, ["k", "y"]).collect()
        closed += [r for r in step if r.valid_to is not None]
        state = spark.createDataFrame([r for r in step if r.valid_to is None], nothing)
    merged = spark.createDataFrame([*closed, *state.collect()], nothing)
    dated = [f.withColumn("snapshot_date", F.lit(d).cast("date")) for f, d in zip(frames, DAYS, strict=True)]
    at_once = history_of(reduce(lambda a, b: a.unionByName(b), dated), ["k", "y"])
    assert plain(merged) == plain(at_once) == expected()
    for day, frame in zip(DAYS, frames, strict=True):
        assert rows(as_of(at_once, day), "k", "y", "value") == rows(frame, "k", "y", "value")
    assert rows(as_of(at_once, "2026-01-10"), "k", "y", "value") == rows(frames[1], "k", "y", "value")
    assert as_of(at_once, "2026-01-01").count() == 0


def test_the_last_values_of_several_columns(spark):
    """Each column has a last row of its own, and a key moves once for all of them."""
    df = spark.createDataFrame(
        [("a", 1, 1.0, None, 1), ("a", 1, 2.0, 5.0, 2), ("a", 1, None, 6.0, 3), ("a", 1, 9.0, None, None),
         ("b", 1, None, None, 4), (None, 1, 3.0, 3.0, 5), ("c", None, 4.0, 4.0, 6), ("d", 2, None, 7.0, 7),
         ("d", 2, None, 8.0, 7)],
        "k string, y int, one double, other double, source_row bigint",
    )
    found = last_values(df, ["k", "y"], ["one", "other"])
    assert rows(found) == [("a", 1, 2.0, 6.0), ("d", 2, None, 8.0)]


def test_a_snapshot_is_reduced_to_its_keys_while_it_is_wide(spark, tmp_path):
    write_snapshot(tmp_path / "source", "2026-02-15", [*FOUR_ROWS, "Kenya,KEN,2024,,87,91,89", "Nowhere,,x,1,1,1,1"])
    land_pending(spark, str(tmp_path / "source"), str(tmp_path), SETTINGS)
    found = snapshot_values(spark, str(tmp_path), "2026-02-15", SETTINGS, None, "source_row")
    kenya = found.where("region_key = 'KEN'").select("indicator_code", "value")
    assert {c: v for c, v in rows(kenya)} == {"dtp3": 90.0, "measles_mcv1": 87.0, "polio_pol3": 91.0, "hepb3": 89.0}
    assert found.count() == 15 and found.columns == ["region_key", "year", "indicator_code", "value"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("Aggregate")


def test_history_follows_the_landed_snapshots(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    assert update_history(spark, root, SETTINGS, NOW) == []

    def updated():
        land_pending(spark, str(source), root, SETTINGS)
        days = update_history(spark, root, SETTINGS, NOW)
        kenya = read_history(spark, root).where("region_key = 'KEN' and indicator_code = 'dtp3' and year = 2024")
        return days, rows(kenya, "value", "valid_from", "valid_to")

    first, second, third = date(2026, 2, 15), date(2026, 2, 22), date(2026, 3, 1)
    write_snapshot(source, "2026-02-15")
    assert updated() == (["2026-02-15"], [(90.0, first, None)])
    assert updated() == ([], [(90.0, first, None)])
    write_snapshot(source, "2026-03-01", ["Kenya,KEN,2024,91,88,91,89"])
    assert updated() == (["2026-03-01"], [(90.0, first, third), (91.0, third, None)])
    # A date in between, and a corrected file: made of all snapshots.
    write_snapshot(source, "2026-02-22", FOUR_ROWS[:2])
    days, found = updated()
    assert len(days) == 3 and found == [(90.0, first, second), (91.0, third, None)]
    write_snapshot(source, "2026-02-22", [*FOUR_ROWS[:2], "Kenya,KEN,2024,90,1,1,1"])
    days, found = updated()
    assert len(days) == 3 and found == [(90.0, first, third), (91.0, third, None)]
    # A file that is gone closes what only it had.
    write_snapshot(source, "2026-03-08", ["Peru,PER,2024,1,1,1,1"])
    assert updated()[1][1] == (91.0, third, date(2026, 3, 8))


def test_names_in_the_order_of_readers(spark):
    names = ["Zambia", "Österreich", "Oman", "Côte d'Ivoire", "Cote", "Åland", "albania", "Albania", "Egypt", "Élan", None]
    df = spark.createDataFrame([(n, 2024, 1.0) for n in names], "region_name string, year int, coverage_pct double")
    want = ["Åland", "albania", "Albania", "Cote", "Côte d'Ivoire", "Egypt", "Élan", "Oman", "Österreich", "Zambia", None]
    assert [r.region_name for r in reports.region_list(df).collect()] == want
    assert [r.region_name for r in reports.ordered("trends", df, "coverage_pct").collect()] == want
    series = reports.series_by_region(df.withColumnRenamed("coverage_pct", "c"), "c")
    assert [r.region_name for r in series.collect()] == want
    bounds = reports.first_and_last(df.withColumn("kind", F.lit("x")), "kind", "region_name")
    assert rows(bounds) == [("x", "Åland", "Zambia")]
