"""Registered queries against their SQL on the small tables, also with every case oversized."""

import os

import pytest
from compare import difference, duck, duck_rows, spark_rows

import __spark_entry__ as spark_entry
from stagewatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
NAMES = [
    "normalized_events", "case_errors", "enriched_events", "injected_session_events", "state_labeled_events", "script_times",
    "rebase_anchors", "state_intervals", "state_intervals_arrival", "timing_summary", "time_sanity", "time_cutoff", "state_stats",
    "phase_variability", "phase_outliers", "phase_histogram", "box_stats", "case_trend", "axis_window", "timeline_clock",
    "stacked_layout", "schedule_risk", "schedule_bootstrap", "warning_top", "case_results", "case_discovery", "source_resolution",
    "run_diagnostics", "site_stats_doc", "sheet_rows", "sheet_errors", "case_sheets", "csv_bad_rows", "csv_rows", "replaced_sites", "ordered_sanity",
    "run_document", "warning_text_categories", "log_catalog", "log_versions", "unified_log", "zoned_times", "zoned_times_kept", "unknown_states", "state_numbers",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    got = spark_rows(spark_entry.queries()[name](spark, SF))
    assert difference(got, duck_rows(con, spark_entry.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", ["state_intervals", "script_times", "case_trend", "time_sanity"])
def test_oversized_cases_give_the_same_rows(spark, con, slices_of, name):
    slices_of(25)
    got = spark_rows(spark_entry.queries()[name](spark, SF))
    assert difference(got, duck_rows(con, spark_entry.oracle_sql()[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_has_a_stable_schema(spark):
    out = spark_entry.entry(spark)
    assert out.columns[:2] == ["site_code", "case_id"] and out.columns[-1] == "TotalMinutes"


@pytest.mark.parametrize("name, most", [
    ("case_discovery", 2), ("case_manifest", 2), ("first_cases", 2), ("source_resolution", 2), ("source_first_match", 2), ("matching_events", 3),
    ("timing_summary", 3), ("time_sanity", 3), ("cohorts", 3), ("timeline_normalized", 10), ("case_results", 12), ("run_diagnostics", 18),
])
def test_jobs_that_start_while_a_plan_is_built(spark, name, most):
    queries = spark_entry.queries()
    queries["case_discovery"](spark, SF)  # table statistics are taken once per session
    spark.sparkContext.setJobGroup(f"building {name}", "")
    queries[name](spark, SF)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}")
    spark.sparkContext.setJobGroup("other", "")
    assert len(jobs) <= most
