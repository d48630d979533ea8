import random
from datetime import timedelta

import pytest
from helpers import DAY, POST, clock, enriched, event, with_state
from pyspark.sql import functions as F

from oracle.ctes import query
from stagewatch.functions.ordered import slice_hot_groups
from stagewatch.operators import intervals, states, warnings
from stagewatch.sources.driver_tables import TYPES
from stagewatch.workflow import KEYS, event_order


def labels(spark, rows):
    out = states.label_states(enriched(spark, rows)).orderBy("row_number")
    return [(r.state, r.cleanup_rule_applied) for r in out.collect()]


def test_core_map(spark):
    kinds = ["SetupWorkflowRecord", "SetupUnlockWorkflowRecord", "Ready4Urology", "DeviceInsertionBegins", "InitialImaging",
             "AlignmentWorkflowRecord", "CoarseWorkflowRecord", "DetailedWorkflowRecord", "PlanReadyWorkflowRecord",
             "DeliveryInitializingWorkflowRecord"]
    got = labels(spark, [event(clock(f"09:{i:02d}"), k, i) for i, k in enumerate(kinds)])
    assert [s for s, _ in got] == [
        "TULSA QA", "Room ready", "Patient positioning & induction", "Device insertion", "Device repositioning", "Alignment",
        "Coarse", "Detailed", "Planning start angle", "Initialization"]


def test_pause_and_resume(spark):
    kinds = ["DeliveryWorkflowRecord", "DeliveryPausedWorkflowRecord", "DeliveryResumedWorkflowRecord",
             "DeliveryInterruptedWorkflowRecord", "ReviewWorkflowRecord"]
    got = labels(spark, [event(clock(f"09:{i:02d}"), k, i) for i, k in enumerate(kinds)])
    assert [s for s, _ in got] == ["Treating", "Paused", "Treating", "Review", POST]


def test_clears(spark):
    same = clock("09:00")
    assert labels(spark, [event(same, "CoarseWorkflowRecord", 1), event(same, "AlignmentWorkflowRecord", 2)]) == [
        ("Coarse", ""), (None, "clear_alignment_duplicate_coarse_same_timestamp")]
    assert labels(spark, [event(same, "CoarseWorkflowRecord", 1, segment="2024-12-31_segment")]) == [
        (None, "clear_segment_date_mismatch")]
    assert labels(spark, [event(same, "ReviewWorkflowRecord", 1), event(clock("09:05"), "MriConnectionRecord", 2)]) == [
        (POST, ""), (None, "clear_post_treatment_disconnect_events")]


def durations(spark, rows):
    out = intervals.state_intervals(with_state(spark, rows)).orderBy("row_number").collect()
    return [r.duration_sec for r in out], [r.quality_flags for r in out], out


CARRY = "carry_forward_previous_state"


@pytest.mark.parametrize("rows, expected, flags", [
    ([(clock("09:00"), "X", "Room ready", None), (DAY + timedelta(hours=9, seconds=10), "X", "Coarse", None),
      (DAY + timedelta(hours=9, seconds=25), "X", "Coarse", None)], [10, 15, 0], None),
    ([(clock("09:00"), "X", "Room ready", None), (clock("10:00"), "X", "Patient recovery & transfer", None),
      (clock("20:00"), "X", None, None)], [3600, 0, 0], ["interval_terminal_state_clamped", "interval_truncated_large_gap"]),
    ([(clock("09:10"), "AlignmentWorkflowRecord", "Alignment", None), (clock("16:00"), "X", None, None)], [7200, 0], None),
    ([(clock("07:00"), "FPumpRecord", "Room ready", CARRY), (clock("10:00"), "X", "Coarse", None)], [7200, 0], None),
    ([(clock("07:00"), "FPumpRecord", "Room ready", CARRY), (clock("08:15"), "X", "Coarse", None)], [4500, 0], None),
])
def test_golden_durations(spark, rows, expected, flags):
    got, got_flags, _ = durations(spark, rows)
    assert got == expected
    if flags:
        assert [f for f in got_flags[1] if f.startswith("interval")] == flags


def test_rebased_start_and_warnings(spark):
    rows = [(clock("01:00"), "X", "Room ready", None), (clock("09:00"), "AlignmentWorkflowRecord", "Alignment", None)]
    _, _, out = durations(spark, rows)
    assert [r.start_sec for r in out] == [-28800.0, 0.0] and out[0].rebase_anchor == "Alignment"
    found = warnings.interval_warnings(intervals.state_intervals(with_state(spark, rows)))
    assert "interval_negative_rebased_start" in {r.category for r in found.collect()}


def random_case(rng, case, n):
    rows, at = [], DAY
    for i in range(n):
        at += timedelta(minutes=rng.choice([0, 0, 5, 30, 130, 400]))
        segment = rng.choice([None, None, "SEG-1", at.strftime("%Y-%m-%d_x"), "2024-12-31_x"])
        rows.append(event(at, rng.choice(TYPES), i + 1, case, segment, rng.randrange(3)))
    return rows


def by_sql(rows):
    """Intervals of the rows by the SQL of the registered queries, over these events instead of the tables'."""
    import duckdb

    con = duckdb.connect()
    con.execute("""CREATE TABLE given (site_code TEXT, case_id TEXT, ts TIMESTAMP, event_type TEXT, source TEXT, is_synthetic BOOLEAN, source_detail TEXT,
        segment_id TEXT, event_kind INT, drop_reason TEXT, insertion_rule TEXT, row_number BIGINT)""")
    con.executemany(f"INSERT INTO given VALUES ({', '.join('?' * 12)})", rows)
    events = "SELECT *, epoch_us(ts) AS ts_us, 0 AS src, NULL AS raw_payload FROM given"
    select = """SELECT case_id, row_number, state, state_assignment_rule, cleanup_rule_applied, start_us, duration_us, rebase_anchor, flags
        FROM c_intervals"""
    return sorted(con.execute(query(select, {"c_enriched": events})).fetchall())


def in_spark(events):
    rows = intervals.state_intervals(states.label_states(events))
    return sorted(tuple(r) for r in rows.select(
        "case_id", "row_number", "state", "state_assignment_rule", "cleanup_rule_applied", "start_us", "duration_us", "rebase_anchor",
        F.concat_ws("|", "quality_flags")).collect())


@pytest.mark.parametrize("limit", [None, 7])
def test_random_cases_equal_the_sql(spark, slices_of, limit):
    rng = random.Random(11)
    cases = {f"c{n:02d}": random_case(rng, f"c{n:02d}", rng.choice([1, 2, 30, 45])) for n in range(24)}
    cases["big"] = random_case(rng, "big", 330)  # one case holds about a third of all rows
    rows = [row for case in cases.values() for row in case]
    events = enriched(spark, rows)
    if limit:
        slices_of(limit)
        events = slice_hot_groups(events, KEYS, event_order())
        assert events.filter("group_slice > 0").count() > 0
    assert in_spark(events) == by_sql(rows)


def hand_computed(spark, steps):
    """steps: (time, type, segment, kind) of one case; (state, clean-up) and (start, duration) seconds per row."""
    events = [event(clock(at), kind, i, segment=segment, event_kind=number) for i, (at, kind, segment, number) in enumerate(steps, 1)]
    out = intervals.state_intervals(states.label_states(enriched(spark, events))).orderBy("row_number").collect()
    return [r.state for r in out], [r.cleanup_rule_applied for r in out], [(r.start_sec, r.duration_sec) for r in out], out


def test_a_test_of_the_applicator_means_ready_until_positioning(spark):
    got, _, _, out = hand_computed(spark, [("08:00", "UATestRecord", None, 0), ("08:10", "Ready4Urology", None, 0), ("08:20", "UATestRecord", None, 0)])
    assert got == ["Room ready", "Patient positioning & induction", "Patient positioning & induction"]
    assert [r.state_assignment_rule for r in out] == ["map_uatest_pre_positioning", "map_anesthesia_or_urology_ready", CARRY]


def test_a_cleared_state_is_not_carried_on(spark):
    got, cleanup, _, _ = hand_computed(spark, [
        ("08:00", "CoarseWorkflowRecord", "2024-12-31_x", 0), ("08:05", "SignalOther", None, 0), ("08:10", "DetailedWorkflowRecord", "2025-01-01_x", 0),
        ("08:15", "SignalOther", "SEG-1", 0)])
    assert got == [None, None, "Detailed", "Detailed"] and cleanup == ["clear_segment_date_mismatch", "", "", ""]


@pytest.mark.parametrize("kind, number, cleared", [
    ("MriConnectionRecord", 0, True), ("SessionEventRecord", 1, True), ("SessionEventRecord", 0, False), ("SegmentEventRecord", 2, True),
    ("SegmentEventRecord", 1, False)])
def test_disconnects_end_the_last_state(spark, kind, number, cleared):
    got, _, _, _ = hand_computed(spark, [("08:00", "ReviewWorkflowRecord", None, 0), ("08:05", kind, None, number), ("08:10", "Other", None, 0)])
    assert got == [POST, None if cleared else POST, None if cleared else POST]


def test_time_before_the_anchor_is_negative(spark):
    _, _, times, out = hand_computed(spark, [
        ("08:00", "SetupWorkflowRecord", None, 0), ("08:30", "InitialImaging", None, 0), ("08:40", "PSHomingRecord", None, 0),
        ("09:00", "AlignmentWorkflowRecord", None, 0), ("09:00", "CoarseWorkflowRecord", None, 0)])
    assert times == [(-1800.0, 1800.0), (0.0, 600.0), (600.0, 1200.0), (1800.0, 0.0), (1800.0, 0.0)]
    assert out[0].rebase_anchor == "InitialImaging" and "negative_rebased_start" in out[0].quality_flags
    assert "zero_duration_to_next" in out[3].quality_flags


def test_long_gaps_are_cut_at_two_hours_or_the_case_end(spark):
    _, _, times, out = hand_computed(spark, [
        ("06:00", "FPumpRecord", None, 0), ("07:00", "CoarseWorkflowRecord", None, 0), ("12:00", "DetailedWorkflowRecord", None, 0),
        ("12:30", "PatientTransferEnds", None, 0), ("20:00", "Other", "2024-12-31_x", 0)])
    assert [d for _, d in times] == [3600.0, 18000.0, 1800.0, 0.0, 0.0]
    assert [f for f in out[3].quality_flags if f.startswith("interval")] == ["interval_terminal_state_clamped", "interval_truncated_large_gap"]


def test_same_rows_for_any_partition_count(spark):
    rng = random.Random(5)
    rows = [row for n in range(6) for row in random_case(rng, f"c{n}", 40)]

    def digest(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        out = intervals.state_intervals(states.label_states(enriched(spark, rows).repartition(partitions)))
        value = out.agg(F.sum(F.xxhash64(*KEYS, "row_number", "state", "duration_us", "start_us").cast("decimal(38,0)"))).first()[0]
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        return value

    assert digest(1) == digest(7)


def test_one_shuffle_and_one_sort_for_all_ordered_steps(spark):
    rows = [event(clock("09:00"), "CoarseWorkflowRecord", 1)]
    plan = intervals.state_intervals(states.label_states(enriched(spark, rows)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(site_code") == 1
    assert plan.count("Sort [site_code") == 1


def test_relative_times_without_group_columns_use_the_whole_table(spark, slices_of):
    rows = spark.createDataFrame([(n * 1_000_000, n) for n in range(50)], "ts_us bigint, row_number bigint")
    plain = intervals.relative_times(rows)
    slices_of(9)
    sliced = intervals.relative_times(rows)
    for out in (plain, sliced):
        got = [(r.start_sec, r.duration_sec) for r in out.orderBy("row_number").collect()]
        assert got == [(float(n), 1.0 if n < 49 else 0.0) for n in range(50)]
