"""Checks that read what was added give what checks of everything give."""

import random
from datetime import datetime, timezone
from pathlib import Path

import pytest

from helpers import FOUR_ROWS, rows, write_snapshot
from tidemark.config import Settings
from tidemark.operators.increments import first_state, next_state, results
from tidemark.operators.quality import (
    AcceptedRange,
    MaxLength,
    NotNull,
    Relationship,
    RowCount,
    Unique,
    run_checks,
)
from tidemark.plans import checks as published_checks
from tidemark.plans.checks import check_published
from tidemark.plans.refresh import run
from tidemark.sources.tables import current_paths, read_published
from tidemark.streaming.ingest import land_pending

SETTINGS = Settings()
CHECKS = (
    NotNull("child", "a"), AcceptedRange("child", "v", 0, 9), MaxLength("child", "b", 1), Unique("child", ["a", "b"]),
    Unique("child", ["v"]), Relationship("child", "a", "parent", "a"), Unique("parent", ["a"]), NotNull("parent", "a"),
)
SHAPE = "a int, b string, v double"


def lot(draw, n):
    return [
        (draw.choice([None, *range(12)]), draw.choice([None, "x", "y", "zz"]), draw.choice([None, float(draw.randint(-2, 40))]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_states_of_dirty_rows_are_those_of_everything(spark, seed):
    """Nulls, repeated keys within and across lots, parents that come late, and empty lots."""
    draw = random.Random(seed)
    lots = [lot(draw, n) for n in (draw.randint(0, 12), 0, 15)]
    parents = [[(a,) for a in (0, 1, 1, None)[: 2 + 2 * (seed % 2)] + tuple(range(2, 2 + 3 * i))] for i in range(3)]
    frame = lambda data: spark.createDataFrame(data, SHAPE)
    state, before = None, []
    for own, parent in zip(lots, parents, strict=True):
        tables = {"child": frame(before + own), "parent": spark.createDataFrame(parent, "a int")}
        if state is None:
            state = first_state(tables, CHECKS)
        else:
            state = next_state(state, tables, {"child": frame(own)}, {"child": frame(before)}, CHECKS)
        state = spark.createDataFrame(state.collect(), state.schema)
        before = before + own
        names = ("check_name", "table_name", "column_name", "failures")
        assert rows(results(state, CHECKS), *names) == rows(run_checks(tables, CHECKS), *names)


def test_checks_without_a_state_of_their_own(spark):
    tables = {"t": spark.range(3).toDF("a")}
    with pytest.raises(ValueError, match="number of rows"):
        first_state(tables, [RowCount("t", 3)])
    with pytest.raises(ValueError, match="same name"):
        first_state(tables, [AcceptedRange("t", "a", 0, 1), AcceptedRange("t", "a", 0, 2)])


def test_an_append_is_checked_alone(spark, tmp_path, monkeypatch):
    """After an append the earlier rows are read only where the added ones have partitions, results are
    those of all rows, and other runs are checked whole."""
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    write_snapshot(source, "2026-02-22", ["Peru,PER,2021,91,88,91,89"])
    land_pending(spark, str(source), root, SETTINGS)
    now = datetime(2026, 3, 1, tzinfo=timezone.utc)
    read = []
    kept = published_checks.next_state

    def noted(state, tables, added, earlier, checks):
        read.append({n: (added[n].count(), earlier[n].count()) for n in added})
        return kept(state, tables, added, earlier, checks)

    monkeypatch.setattr(published_checks, "next_state", noted)
    names = ("check_name", "table_name", "column_name", "failures")

    wanted = ("fact_health_indicator", "stg_health_indicators")
    some = [c for c in published_checks.STANDARD_CHECKS if c.table in wanted and "date_id" not in c[1:2]]

    def agrees():
        found = check_published(spark, root, some)
        assert rows(found, *names) == rows(run_checks(read_published(spark, root), some), *names)

    run(spark, root, "2026-02-15", SETTINGS, now)
    agrees()
    assert read == []
    agrees()  # nothing was added
    assert read.pop()["fact_health_indicator"] == (0, 0)
    run(spark, root, "2026-02-22", SETTINGS, now, mode="append")
    agrees()
    seen = read.pop()
    assert seen["stg_health_indicators"] == (4, 0) and seen["fact_health_indicator"] == (4, 0)
    run(spark, root, "2026-02-22", SETTINGS, now)
    agrees()
    assert read == []
    # A check that died before it was complete is not built on.
    newest = sorted(Path(root, "checks").glob("*/*"))[-1]
    (newest / "covered" / "_SUCCESS").unlink()
    agrees()
    assert read == [] and len(current_paths(spark, root)["fact_health_indicator"]) == 1
