"""Reading files, landing snapshots, publishing tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import FOUR_ROWS, HEADER, rows, write_snapshot
from tidemark.config import Settings
from tidemark.operators.quality import run_checks
from tidemark.operators.warehouse import (
    build_dim_date,
    build_dim_indicator,
    build_dim_region,
    build_fact,
    build_periods,
)
from tidemark.plans import reports
from tidemark.plans.refresh import raw_root, read_warehouse, run
from tidemark.sources import snapshots
from tidemark.sources.files import dated_folders, read_aliases, read_wide, snapshot_files
from tidemark.sources.schemas import SCHEMAS
from tidemark.sources.tables import (
    current_paths,
    key_conflicts,
    read_paths,
    read_published,
    same_table,
    table_path,
    write_table,
)
from tidemark.streaming.ingest import land_pending, refresh_folders, stream_snapshots

SETTINGS = Settings()
RENAMES = SETTINGS.renames


# Files


def test_read_wide(spark, tmp_path):
    odd = ['"Bonaire, ""BES""",NA,2020,NaN,null,#N/A,7', "  X ,XXX,2020.0,,n/a, 5 ,NULL"]
    path = write_snapshot(tmp_path, "2024-01-01", odd)
    df = read_wide(spark, str(path), RENAMES, row_id="source_row", file_col="file")
    assert set(dict(df.drop("source_row").dtypes).values()) == {"string"}
    assert df.columns[:3] == ["region_name", "iso_code", "year"]
    got = {r.region_name: tuple(r)[1:] for r in df.collect()}
    assert got == {
        'Bonaire, "BES"': (None, "2020", None, None, None, "7", 0, "coverage.csv"),
        "  X ": ("XXX", "2020.0", None, None, " 5 ", None, 1, "coverage.csv"),
    }


def test_read_wide_rejects_files_with_different_headers(spark, tmp_path):
    write_snapshot(tmp_path, "d", name="a.csv")
    (tmp_path / "d" / "b.csv").write_text("Code,Entity,Year\nKEN,Kenya,2020\n")
    with pytest.raises(Exception, match="(?i)header|columns"):
        read_wide(spark, str(tmp_path / "d"), RENAMES).collect()


def test_read_aliases(spark, tmp_path):
    path = tmp_path / "aliases.csv"
    path.write_text("alias,iso_code,notes\n Ivory Coast , CIV,old name\nUSA,USA,\n")
    got = rows(read_aliases(spark, str(path)), "alias", "iso_code", "notes")
    assert got == [("Ivory Coast", "CIV", "old name"), ("USA", "USA", None)]
    none = read_aliases(spark, str(tmp_path / "no such file.csv"))
    assert none.count() == 0 and none.columns == ["alias", "iso_code", "notes", "alias_row"]


def test_dated_folders_and_files(spark, tmp_path):
    for name in ("2024-01-08", "snapshot_date=2024-01-15", "latest", "2024-13-01", "20240101"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text("x\n")
    assert dated_folders(spark, str(tmp_path)) == ["2024-01-08", "2024-01-15"]
    assert dated_folders(spark, str(tmp_path / "missing")) == []
    assert rows(snapshot_files(spark, str(tmp_path)), "snapshot_date", "file") == [
        (date(2024, 1, 15), "a.csv"), (date(2024, 1, 8), "a.csv"),
    ]


# Snapshots


def test_landing_a_date_again_replaces_that_date_only(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1,)], "x int")
    snapshots.land_snapshot(one, root, "2024-01-01")
    snapshots.land_snapshot(one, root, date(2024, 1, 8))
    snapshots.land_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), root, "2024-01-08")
    assert rows(snapshots.read_snapshot(spark, root, "2024-01-01")) == [(1,)]
    assert rows(snapshots.read_snapshot(spark, root, "2024-01-08")) == [(2,), (3,)]


def test_prior_snapshot(spark):
    days = [("2024-01-01",), ("2024-01-08",), ("2024-01-15",), ("latest",), (None,)]
    df = spark.createDataFrame(days, "snapshot_date string")
    prior = lambda as_of: snapshots.prior_snapshot_date(df, as_of).first()[0]
    assert prior("2024-01-15") == date(2024, 1, 8)
    assert prior("2024-01-16") == date(2024, 1, 15)
    assert prior(date(2024, 1, 1)) is None


def test_pending_and_counts(spark):
    files = spark.createDataFrame([("d1", "a"), ("d1", "b"), ("d2", "a"), ("d2", "a")],
                                  "snapshot_date string, file string")
    landed = files.where("snapshot_date = 'd1' and file = 'a'")
    assert rows(snapshots.pending_snapshots(files, landed)) == [("d1", "b"), ("d2", "a")]
    assert rows(snapshots.source_row_counts(files)) == [("d1", "a", 1), ("d1", "b", 1), ("d2", "a", 2)]


# Runs


@pytest.fixture()
def landed(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    second = [FOUR_ROWS[0], "South Africa,ZAF,2024,70,76,74,", *FOUR_ROWS[2:], "Bad,BAD,1900,1,1,1,1"]
    write_snapshot(source, "2026-02-22", second)
    write_snapshot(source, "2026-03-01", ["Chad,TCD,2024,55,1,1,1"])
    land_pending(spark, str(source), root, SETTINGS)
    return root


def test_land_pending_leaves_what_is_landed(spark, landed, tmp_path):
    source = str(tmp_path / "source")
    assert land_pending(spark, source, landed, SETTINGS) == []
    assert len(land_pending(spark, source, landed, SETTINGS, again=True)) == 3


def test_empty_tables_replace_full_ones(spark, landed):
    run(spark, landed, "2026-02-22", SETTINGS, datetime(2026, 3, 1))
    t = read_published(spark, landed)
    assert rows(t["stg_data_revisions"], "region_key", "old_value", "new_value", "prior_snapshot") == [
        ("ZAF", 75.0, 70.0, "2026-02-15")
    ]
    assert t["stg_rejected_rows"].count() == 4
    assert rows(t["stg_health_indicators"].where("is_revised"), "region_key", "year", "is_estimated") == [
        ("ZAF", 2024, True)
    ]
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 2))
    t = read_published(spark, landed)
    assert t["stg_data_revisions"].count() == 0 and t["stg_rejected_rows"].count() == 0
    assert t["stg_health_indicators"].count() == 16


def test_the_same_run_twice_gives_the_same_tables(spark, landed):
    def tables():
        run(spark, landed, "2026-02-22", SETTINGS, datetime(2026, 3, 1))
        return {n: rows(df) for n, df in read_published(spark, landed).items()}

    first, folders = tables(), current_paths(spark, landed)
    assert tables() == first
    # Not in the folders of the first one: a run that dies must not harm what is published.
    assert not {p[0] for p in folders.values()} & {p[0] for p in current_paths(spark, landed).values()}


def test_append_keeps_earlier_rows_and_refuses_repeated_keys(spark, landed):
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    run(spark, landed, "2026-03-01", SETTINGS, datetime(2026, 3, 2), mode="append")
    t = read_published(spark, landed)
    assert t["stg_health_indicators"].count() == 20 and t["stg_regions"].count() == 4
    w = read_warehouse(spark, landed)
    assert w.fact.count() == 19
    assert t["dim_region"].count() == 4
    # What was appended is what building all at once from the staged rows would give.
    dims = {
        "dim_region": build_dim_region(t["stg_regions"]),
        "dim_date": build_dim_date(t["stg_health_indicators"]),
        "dim_indicator": build_dim_indicator(t["stg_health_indicators"]),
    }
    for name, whole in dims.items():
        assert rows(t[name]) == rows(whole)
    columns = w.fact.columns
    whole = build_fact(t["stg_health_indicators"], **dims)
    assert rows(w.fact) == rows(whole.select(columns))
    assert rows(w.periods) == rows(build_periods(w.fact))
    before = current_paths(spark, landed)
    with pytest.raises(ValueError, match="repeat keys"):
        run(spark, landed, "2026-02-22", SETTINGS, datetime(2026, 3, 3), mode="append")
    assert current_paths(spark, landed) == before
    assert key_conflicts(t["stg_regions"], t["stg_regions"], ["region_key"]).count() == 4


def test_a_run_that_fails_leaves_the_published_tables(spark, landed):
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    before = current_paths(spark, landed)
    broken = spark.createDataFrame([("x", "y", 1)], "alias string, iso_code string, alias_row int")
    broken = broken.withColumn("iso_code", F.raise_error(F.lit("no aliases today")))
    with pytest.raises(Exception, match="no aliases today"):
        run(spark, landed, "2026-02-22", SETTINGS, datetime(2026, 3, 2), broken)
    assert current_paths(spark, landed) == before
    assert read_published(spark, landed)["stg_health_indicators"].count() == 16


def test_snapshots_with_other_columns(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    for day, text in (
        ("2024-01-01", "Entity,Code,Year,Other\nKenya,KEN,2020,1\n"),
        ("2024-01-08", "Entity,Code,Year,Other,Polio (Pol3)\nKenya,KEN,2020,1,2\n"),
    ):
        write_snapshot(source, day).write_text(text)
    land_pending(spark, str(source), root, SETTINGS)
    with pytest.raises(ValueError, match="none of the configured indicators"):
        run(spark, root, "2024-01-01", SETTINGS, datetime(2026, 3, 1))
    counts = run(spark, root, "2024-01-08", SETTINGS, datetime(2026, 3, 1)).counts
    assert counts["stg_health_indicators"] == 1 and counts["stg_data_revisions"] == 0


def test_unknown_mode_is_refused_before_anything_is_written(spark, landed):
    with pytest.raises(ValueError, match="mode"):
        run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1), mode="truncate")
    assert current_paths(spark, landed) == {}


def test_fact_is_laid_out_by_indicator_and_date(spark, landed):
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    path = current_paths(spark, landed)["fact_health_indicator"][0]
    parts = {tuple(f.split("/")[-3:-1]) for f in spark.read.parquet(path).inputFiles()}
    assert ("indicator_id=dtp3", "date_id=20240101") in parts and len(parts) == 8


# Streaming


def test_stream_takes_new_folders_only_oldest_first(spark, tmp_path):
    source, seen = tmp_path / "source", []
    write_snapshot(source, "2024-01-08")
    write_snapshot(source, "2024-01-01")
    write_snapshot(source, "notes")

    def drain():
        stream_snapshots(
            spark, str(source),
            lambda _, found: seen.extend((str(d), p.split(":")[-1].replace("///", "/")) for d, own in found.items() for p in own),
            checkpoint=str(tmp_path / "checkpoint"),
        ).awaitTermination()

    drain()
    assert seen == [(d, f"{source}/{d}") for d in ("2024-01-01", "2024-01-08")]
    drain()
    write_snapshot(source, "2024-01-15")
    drain()
    assert [d for d, _ in seen] == ["2024-01-01", "2024-01-08", "2024-01-15"]


def test_refresh_as_a_stream(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2024-01-01")
    write_snapshot(source, "2024-01-08", ["Kenya,KEN,2024,91,88,91,89"])
    aliases = tmp_path / "aliases.csv"
    aliases.write_text("alias,iso_code,notes\nKenya,KEN,\n")
    step = refresh_folders(root, SETTINGS, str(aliases))
    stream_snapshots(spark, str(source), step, checkpoint=str(tmp_path / "c")).awaitTermination()
    t = read_published(spark, root)
    assert rows(t["stg_data_revisions"], "region_key", "old_value", "new_value") == [("KEN", 90.0, 91.0)]
    assert dated_folders(spark, raw_root(root)) == ["2024-01-01", "2024-01-08"]


LATE = ["Peru,PER,2024,88,1,1,1"]


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_late_and_additional_files(spark, tmp_path, files_per_batch):
    """An older date never takes the place of the newest, whatever the number of files a batch has."""
    source, root = tmp_path / "source", str(tmp_path / "root")

    def refresh():
        step = refresh_folders(root, SETTINGS)
        stream_snapshots(
            spark, str(source), step, str(tmp_path / "c"), files_per_batch=files_per_batch
        ).awaitTermination()
        return {n: df.drop("loaded_at", "detected_at") for n, df in read_published(spark, root).items()}

    write_snapshot(source, "2026-02-15")
    write_snapshot(source, "2026-02-22", ["Kenya,KEN,2025,91,88,91,89"])
    write_snapshot(source, "2026-02-22", LATE, name="more.csv")
    t = refresh()
    assert rows(t["stg_regions"], "region_key") == [("KEN",), ("PER",)]
    write_snapshot(source, "2026-02-15", ["Kenya,KEN,2025,70,88,91,89"], name="late.csv")
    t = refresh()
    assert rows(t["stg_regions"], "region_key") == [("KEN",), ("PER",)]
    assert rows(t["stg_data_revisions"], "region_key", "old_value", "new_value") == [("KEN", 70.0, 91.0)]
    assert rows(t["dim_date"], "year") == [(2024,), (2025,)]


def test_a_second_file_of_a_landed_date(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    assert land_pending(spark, str(source), root, SETTINGS) == ["2026-02-15"]
    write_snapshot(source, "2026-02-15", LATE, name="more.csv")
    assert land_pending(spark, str(source), root, SETTINGS) == ["2026-02-15"]
    assert land_pending(spark, str(source), root, SETTINGS) == []
    landed = snapshots.read_snapshot(spark, raw_root(root), "2026-02-15")
    assert rows(landed.groupBy("file").count()) == [("coverage.csv", 4), ("more.csv", 1)]


def test_folders_named_by_a_column_and_nested_ones(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "snapshot_date=2026-02-15")
    write_snapshot(source / "deeper", "2026-02-22", LATE)
    stream_snapshots(spark, str(source), refresh_folders(root, SETTINGS), str(tmp_path / "c")).awaitTermination()
    assert dated_folders(spark, raw_root(root)) == ["2026-02-15", "2026-02-22"]
    assert land_pending(spark, str(source), str(tmp_path / "other"), SETTINGS) == ["2026-02-15", "2026-02-22"]


def test_lines_with_too_many_fields_are_kept_apart(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    bad = 'Korea, South,KOR,2024,90,91,92,93'
    path = write_snapshot(source, "2026-02-15", [*FOUR_ROWS, bad, '"Bonaire, BES",BES,2024,1,2,3', "Chad,TCD"])
    with pytest.raises(Exception, match="too many fields: Korea, South"):
        read_wide(spark, str(path), RENAMES).collect()
    with pytest.raises(Exception, match="too many fields"):
        read_wide(spark, str(path), RENAMES).select("year").collect()
    df = read_wide(spark, str(path), RENAMES, malformed_col="line")
    assert df.count() == 7 and rows(df.where("line is not null"), "region_name", "line") == [(None, bad)]
    assert rows(df.where("iso_code in ('BES', 'TCD')"), "region_name", "year") == [
        ("Bonaire, BES", "2024"), ("Chad", None),
    ]
    land_pending(spark, str(source), root, SETTINGS)
    run(spark, root, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    rejected = read_published(spark, root)["stg_rejected_rows"]
    assert rows(rejected.where("raw_line is not null"), "source_row", "reject_reason", "raw_line") == [
        (df_row(spark, root), "malformed_line", bad)
    ]
    assert read_published(spark, root)["stg_regions"].where("region_name like 'Korea%'").count() == 0


def df_row(spark, root):
    landed = snapshots.read_snapshot(spark, raw_root(root), "2026-02-15")
    return landed.where("malformed_line is not null").first().source_row


def test_rows_are_in_the_order_of_files(spark, tmp_path):
    """A small file before a large one of several splits, which Spark reads first."""
    folder = tmp_path / "2026-02-15"
    write_snapshot(tmp_path, "2026-02-15", ["Kenya,KEN,2024,1,1,1,1"], name="a.csv")
    many = [f"Region {i},R{i:05},2024,1,1,1,1" for i in range(4000)]
    write_snapshot(tmp_path, "2026-02-15", many, name="b.csv")
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(name, "20000")
    try:
        df = read_wide(spark, str(folder), RENAMES, row_id="source_row", file_col="file")
        got = [(r.region_name, r.file) for r in sorted(df.collect(), key=lambda r: r.source_row)]
        (tmp_path / "aliases").mkdir()
        (tmp_path / "aliases" / "a.csv").write_text("alias,iso_code,notes\nX,OLD,\n")
        (tmp_path / "aliases" / "b.csv").write_text(
            "alias,iso_code,notes\n" + "".join(f"Y{i},Y,\n" for i in range(3000)) + "X,NEW,\n"
        )
        aliases = read_aliases(spark, str(tmp_path / "aliases"))
        last = aliases.where("alias = 'X'").orderBy(F.desc("alias_row")).first().iso_code
    finally:
        spark.conf.set(name, before)
    assert got == [("Kenya", "a.csv"), *((f"Region {i}", "b.csv") for i in range(4000))]
    assert last == "NEW" and df.select("source_row").distinct().count() == 4001


def test_repeated_keys_without_values_fail_a_check(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15", ["Kenya,KEN,2024,,,,", "Kenya,KEN,2024,,,,"])
    land_pending(spark, str(source), root, SETTINGS)
    run(spark, root, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    failed = run_checks(read_published(spark, root)).where("failures > 0")
    assert rows(failed, "table_name", "check_name", "failures") == [
        ("stg_health_indicators", "unique_combination", 4)
    ]


def test_appended_folders_are_one_scan(spark, landed):
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    run(spark, landed, "2026-03-01", SETTINGS, datetime(2026, 3, 2), mode="append")
    for name in ("stg_health_indicators", "fact_health_indicator"):
        assert len(current_paths(spark, landed)[name]) == 2
        plan = read_published(spark, landed)[name]._jdf.queryExecution().toString()
        assert "Union" not in plan
    assert read_published(spark, landed)["fact_health_indicator"].columns == SCHEMAS["fact_health_indicator"].names


def test_folders_of_one_table():
    new = [table_path("/r", x, "fact_health_indicator") for x in "ab"]
    assert same_table(*new)
    assert not same_table("/r/runs/a/fact_health_indicator", new[0])


def test_append_of_a_run_without_facts(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    head = "Entity,Code,Year,Polio (Pol3)\n"
    for day, line in (("2024-01-01", "Kenya,KEN,2020,50\n"), ("2024-01-08", "Ghana,GHA,2021,\n")):
        write_snapshot(source, day).write_text(head + line)
    land_pending(spark, str(source), root, SETTINGS)
    run(spark, root, "2024-01-01", SETTINGS, datetime(2026, 3, 1))
    counts = run(spark, root, "2024-01-08", SETTINGS, datetime(2026, 3, 2), mode="append").counts
    assert counts["fact_health_indicator"] == 0 and counts["stg_health_indicators"] == 1
    t = read_published(spark, root)
    assert rows(t["fact_health_indicator"], "region_id", "date_id") == [("KEN", 20200101)]
    assert rows(t["dim_date"], "year") == [(2020,), (2021,)]
    assert rows(t["fact_periods"], "date_id", "fact_rows") == [(20200101, 1)]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_fact_files_hold_ranges_of_regions(spark, tmp_path):
    keys = spark.range(20_000).select(F.format_string("R%05d", F.col("id") % 5000).alias("region_id"), "id")
    fact = keys.select(
        "region_id", F.lit(2024).alias("date_id"), F.lit("d").alias("indicator_id"), F.lit(1).alias("value"),
        *(F.lit(None).alias(c) for c in ("region_key", "is_missing", "is_revised", "is_estimated", "loaded_at")),
    )
    name = "fact_health_indicator"
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")
    try:
        assert write_table(fact, str(tmp_path), "many", name) == 20_000
    finally:
        spark.conf.unset(coalescing)
    written = read_paths(spark, name, [table_path(str(tmp_path), "many", name)])
    files = written.groupBy(F.input_file_name().alias("f")).agg(F.min("region_id").alias("a"), F.max("region_id").alias("b"))
    ranges = sorted((r.a, r.b) for r in files.collect())
    assert len(ranges) > 1
    assert all(high < low for (_, high), (low, _) in zip(ranges, ranges[1:]))


def test_one_region_is_sought_by_key(spark, landed):
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    w = read_warehouse(spark, landed)
    name, key = w.region.select("region_name", "region_key").orderBy("region_key").first()
    plan = final_plan(reports.recent_for_region(w, name, SETTINGS.main_indicator))
    assert f"GreaterThanOrEqual(region_id,{key}), LessThanOrEqual(region_id,{key})" in plan
    assert reports.recent_for_region(w, "nobody", SETTINGS.main_indicator).count() == 0


def test_keys_of_the_fact_table_are_counted_once(spark, landed):
    run(spark, landed, "2026-02-15", SETTINGS, datetime(2026, 3, 1))
    plan = final_plan(run_checks(read_published(spark, landed)))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "region_id#" in line]
    assert len(scans) == 2  # keys, and single rows
    assert plan.count("ReusedExchange [region_id") == 3


def test_header_text_is_what_the_settings_expect():
    names = [i.source_col for i in SETTINGS.indicators]
    assert all(n in HEADER for n in names)
