"""Warnings as a long table: site_code, case_id, category, row_number, detail.

Row-level and case-level warnings of all stages are taken from the interval rows in one pass (case
facts are reported on the first row of the case); only first-occurrence warnings need an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.coerce import MICROS, day_number
from stagewatch.functions.durable import durable
from stagewatch.operators.states import DATE_RULE, DISCONNECT_RULE, DUPLICATE_RULE, is_critical_type, unmapped_critical
from stagewatch.operators.timeline import first_unknown_states, is_blank_state, midnight_crossings, timeline_rows
from stagewatch.workflow import DEFAULT, DIAGNOSTIC_FLAGS, KEYS, STATE_NAMES, Workflow, as_warnings

ROW = "row_number"


def entry(condition: Column, category: str | Column, row: Column, detail: Column | str | None) -> Column:
    return F.when(condition, F.struct(
        (F.lit(category) if isinstance(category, str) else category).alias("category"),
        row.cast("bigint").alias("row_number"),
        (detail if isinstance(detail, Column) else F.lit(detail)).cast("string").alias("detail"),
    ))


def explode_entries(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return df.select(*KEYS, F.explode(F.array_compact(F.array(*entries))).alias("w")).select(*KEYS, "w.*")


def state_entries() -> list[Column]:
    applied = F.split("cleanup_rule_applied", ";")
    row = F.col(ROW)
    dates = F.concat(
        F.lit("segment_prefix="), F.trim("segment_id").substr(1, 10),
        F.lit(":timestamp_date="), F.col("timestamp").cast("date").cast("string"),
    )
    return [
        entry(F.array_contains(applied, DUPLICATE_RULE), "cleanup_alignment_duplicate", row, None),
        entry(F.array_contains(applied, DISCONNECT_RULE), "cleanup_post_treatment_disconnect", row, None),
        entry(F.array_contains(applied, DATE_RULE), "cleanup_segment_date_mismatch", row, dates),
    ]


def interval_entries(workflow: Workflow = DEFAULT) -> list[Column]:
    first, none, row = F.col("pos") == 0, F.lit(None), F.col(ROW)
    trailing = F.col("n_rows") - F.col("case_end.pos") - 1
    anchor = F.split("anchor_warning", ":", 2)
    end_row = F.col("case_end.row_number")
    fallback = F.col("end_is_fallback")
    label = F.coalesce(F.when(F.trim("state") != "", F.trim("state")), F.lit("<NA>"))
    cut = (F.col("raw_us") > 0) & (F.col("duration_us") < F.col("raw_us"))
    cut_text = F.concat(
        F.lit("event_type="), F.col("event_type"), F.lit(":state="), label,
        F.lit(":raw_us="), F.col("raw_us").cast("string"), F.lit(":duration_us="), F.col("duration_us").cast("string"),
    )
    return [
        entry(first & F.col("non_monotonic"), "interval_non_monotonic_input", none, "reordered_for_computation"),
        entry(first & F.col("reordered") & ~F.col("non_monotonic"), "interval_input_reordered_by_tiebreak", none, None),
        entry(first & F.col("anchor_warning").isNotNull(), F.get(anchor, 0), none, F.get(anchor, 1)),
        entry(first, "case_end_inferred", end_row, F.when(fallback, "strategy=fallback_last_event").otherwise(
            F.concat(F.lit("strategy=last_meaningful_state:state="), F.trim("case_end.state")))),
        entry(first & (fallback | (trailing > 0)), "case_end_ambiguous", end_row,
              F.when(fallback, "no_meaningful_state:fallback=last_event").otherwise(
                  F.concat(F.lit("trailing_events_after_case_end="), trailing.cast("string")))),
        entry(cut, "interval_hardened_truncation", row, cut_text),
        entry(cut & F.col("early_cut"), "interval_early_state_truncated", row, cut_text),
        entry(F.col("start_us") < -workflow.negative_start_warn_sec * MICROS, "interval_negative_rebased_start", row,
              F.concat(F.lit("event_type="), F.col("event_type"), F.lit(":start_us="),
                       F.col("start_us").cast("string"), F.lit(":expected_pre_anchor=1"))),
    ]


def timeline_entries() -> list[Column]:
    row, blank, flat = F.col(ROW), is_blank_state(), F.col("duration_us") <= 0
    return [
        entry(blank, "plot_excluded_empty_state", row, None),
        entry(~blank & flat, "plot_excluded_nonpositive_duration", row,
              F.concat(F.lit("duration_us="), F.col("duration_us").cast("string"))),
        entry(~blank & ~flat & (F.size("quality_flags") > 0), "plot_row_quality_flags", row,
              F.concat(F.lit("flags="), F.concat_ws(",", "quality_flags"))),
    ]


def _first_unmapped(labelled: DataFrame) -> DataFrame:
    return as_warnings(unmapped_critical(labelled), "state_unmapped_event_type", F.lit(None), F.col("event_type"))


def _timeline_firsts(intervals: DataFrame) -> list[DataFrame]:
    rows = timeline_rows(intervals)
    crossing = midnight_crossings(rows)
    return [
        as_warnings(first_unknown_states(rows), "plot_unknown_state_appended", F.lit(None), F.col("state")),
        as_warnings(crossing, "plot_original_hour_crosses_midnight", F.col(ROW), F.concat(
            F.lit("start="), F.col("start_ts").cast("string"), F.lit(":end="), F.col("end_ts").cast("string"))),
    ]


def state_warnings(labelled: DataFrame) -> DataFrame:
    return explode_entries(labelled, state_entries()).unionByName(_first_unmapped(labelled))


def interval_warnings(intervals: DataFrame, workflow: Workflow = DEFAULT) -> DataFrame:
    return explode_entries(intervals, interval_entries(workflow))


def timeline_warnings(intervals: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [explode_entries(intervals, timeline_entries()), *_timeline_firsts(intervals)])


def run_warnings(intervals: DataFrame, workflow: Workflow = DEFAULT) -> DataFrame:
    """State, interval and timeline warnings together."""
    entries = [*state_entries(), *interval_entries(workflow), *timeline_entries()]
    return reduce(DataFrame.unionByName, [
        explode_entries(intervals, entries), _first_unmapped(intervals), *_timeline_firsts(intervals)
    ])


def interval_facts(intervals: DataFrame, workflow: Workflow = DEFAULT) -> DataFrame:
    """Per case, in one pass over the interval rows: events, durations, flags and the numbers of warnings by stage.

    Warnings that a case gives once per value (unmapped types, a crossing of midnight) or a site once per value (unknown
    states, at the first case that shows one) are counted as such.
    """
    def given(entries: Sequence[Column]) -> Column:
        return F.sum(F.size(F.array_compact(F.array(*entries))))

    rows, us = F.count(F.lit(1)), F.col("duration_us")
    shown = ~is_blank_state() & (us > 0)
    unmapped = F.when(F.col("state_assignment_rule").isNull() & is_critical_type(F.col("event_type")), F.col("event_type"))
    crosses = shown & (day_number(F.col("ts_us") + us) != day_number(F.col("ts_us")))
    unknown = F.when(shown & ~F.col("state").isin(*STATE_NAMES), F.col("state"))
    facts = durable(intervals.groupBy(*KEYS).agg(
        rows.alias("enriched_event_count"), rows.alias("state_labeled_event_count"), rows.alias("state_interval_count"),
        # Critical types are a short list, and states that the workflow lacks a handful.
        (given(state_entries()) + F.size(F.collect_set(unmapped))).alias("state_warning_count"),
        given(interval_entries(workflow)).alias("timing_warning_count"),
        (given(timeline_entries()) + F.max(crosses.cast("int"))).alias("plot_rows"), F.collect_set(unknown).alias("unknown"),
        F.max(us).alias("max_duration_us"), *[F.count_if(us > sec * MICROS).alias(f"n_over_{sec}") for sec in (7200, 14400, 28800)],
        *[F.count_if(F.array_contains("quality_flags", flag)).alias(flag) for flag in DIAGNOSTIC_FLAGS],
    ))
    first = facts.select(*KEYS, F.explode("unknown").alias("state")).groupBy("site_code", "state").agg(F.min("case_id").alias("case_id"))
    firsts = first.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("firsts"))
    plots = F.col("plot_rows") + F.coalesce("firsts", F.lit(0))
    return facts.join(firsts, KEYS, "left").withColumn("plot_warning_count", plots).drop("plot_rows", "firsts", "unknown")
