"""Every registered query against its SQL, the published figures, and the plans."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registered
from compare import differences, duck
from workload import oracle, queries as workload_queries
from workload.workspace import workspace

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, ORACLE = workload_queries.registered(), oracle.statements()

# Counts of the derived snapshots, worked out apart from this code.
FIGURES = {
    SMALL: dict(indicator_rows=5405, null_values=297, region_count=198, country_count=140,
                rejected_rows=83, revisions_detected=58, latest_main_year=2001,
                countries_below_target=89),
    MIDDLE: dict(indicator_rows=53920, null_values=2980, region_count=1963, country_count=1373,
                 rejected_rows=1320, revisions_detected=2773, latest_main_year=2001,
                 countries_below_target=900),
}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLE[name]) == []


@pytest.mark.parametrize("sf_dir", FIGURES)
def test_published_figures(spark, sf_dir):
    got = QUERIES["quality_stats"](spark, sf_dir).first().asDict()
    assert got == FIGURES[sf_dir]


def test_rejects_by_reason(spark):
    counts = QUERIES["validate_rejects"](spark, MIDDLE).groupBy("reject_reason").count()
    assert {r[0]: r[1] for r in counts.collect()} == {
        "invalid_year": 465,
        "invalid_year|missing_region": 27,
        "invalid_year|missing_region|value_out_of_range": 1,
        "invalid_year|value_out_of_range": 3,
        "missing_region": 514,
        "missing_region|value_out_of_range": 2,
        "value_out_of_range": 308,
    }


def test_flagging_changes_no_row_count(spark):
    flags = QUERIES["quality_flags"](spark, MIDDLE)
    row = flags.selectExpr("count(*)", "count_if(is_revised)", "count_if(is_estimated)").first()
    assert tuple(row) == (53920, 561, 3541)


def test_valid_and_rejected_make_up_the_input(spark):
    parts = [QUERIES[n](spark, SMALL).count() for n in ("validate_clean", "validate_rejects")]
    wide = workspace(spark, SMALL).wide().count()
    assert sum(parts) == 4 * wide == QUERIES["unpivot_indicators"](spark, SMALL).count()


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() == 89 and "gap_to_target_pct" in df.columns


def test_entry_module_needs_no_session_to_import():
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    names = [set(line.split()) for line in done.stdout.splitlines()]
    assert len(names) == 2 and all(set(QUERIES) <= x for x in names), done.stderr
    assert names[1] <= names[0]


# Plans


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_reports_read_one_partition_and_few_columns(spark):
    text = plan(QUERIES["below_threshold"](spark, SMALL))
    assert "(indicator_id" in text and "dynamicpruning" in text
    assert "LessThan(value,80.00)" in text
    assert "ReadSchema: struct<region_id:string,value:decimal(8,2)>" in text
    assert len({x for x in text.splitlines() if "/fact_health_indicator/run=" in x}) == 1


def test_cleaning_does_not_shuffle(spark):
    for name in ("validate_clean", "validate_rejects", "standardise_regions", "indicator_metadata"):
        assert "Exchange" not in plan(QUERIES[name](spark, SMALL)), name


def test_big_aggregates_hash_and_shrink_before_the_shuffle(spark):
    text = plan(QUERIES["detect_revisions"](spark, SMALL))
    assert "Sort" not in text and text.count("Exchange hashpartitioning") == 0
    assert "partial_min" in text and sum(") Exchange" in x for x in text.splitlines()) == 1
