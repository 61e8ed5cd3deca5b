"""Every registered query against its DuckDB SQL on the driver's smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_type", "window_start", "window_end", "n", "cents"]


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert r["cols_match"], r["cols"]
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


SCAN_QUERIES = ["window_session", "window_session_dynamic", "window_count_tumbling", "window_count_sliding",
                "running_sum", "running_count", "running_avg", "late_events", "window_refinements",
                "late_rows", "window_watermark_ascending", "window_watermark_bounded", "window_watermark_sliding",
                "window_top_n_watermarked", "interval_join_late", "interval_join_late_left", "interval_join_late_right"]


@pytest.mark.parametrize("name", SCAN_QUERIES)
def test_scan_query_matches_oracle_with_many_slices(spark, con, sliced_scans, name):
    """The same plan cut into many small slices."""
    r = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert r["cols_match"] and r["rows"][0] == r["rows"][1] and r["hash_match"]


@pytest.mark.parametrize("name", ["late_events", "running_sum", "window_session", "window_count_sliding"])
def test_no_table_rows_in_one_task(spark, name):
    """One task may see the slices' totals, never the rows."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan.split("SinglePartition")[-1] if "SinglePartition" in plan else True
