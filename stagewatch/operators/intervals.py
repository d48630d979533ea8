"""Time spent in each state: rebased starts, hardened durations and quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.coerce import MICROS
from stagewatch.functions.durable import durable
from stagewatch.functions.ordered import (
    SLICE, group_values, group_window, is_sliced, next_value, running_before, slice_hot_groups,
)
from stagewatch.operators.states import LANDMARKS, setup_positions
from stagewatch.workflow import DEFAULT, KEYS, Workflow, event_order, quoted


def is_unassigned(state: Column, workflow: Workflow = DEFAULT) -> Column:
    return F.coalesce(F.trim(state), F.lit("")).isin(*workflow.unassigned)


def rebase_anchors(labelled: DataFrame) -> DataFrame:
    """Add ``rebase_anchor``, ``anchor_us``, ``first_us`` and ``anchor_warning`` to every event."""
    out = setup_positions(labelled)
    aligned = F.col("al").isNotNull()
    homed = F.coalesce(F.col("uh_last.pos") > F.col("ready_at"), F.lit(False))
    imaged_early = F.coalesce(F.col("ii.pos") < F.col("al.pos"), F.lit(False))
    homing_only = F.col("ii").isNull() & F.col("uh_before_al").isNotNull()
    anchor = (
        F.when(~aligned & F.col("ii").isNotNull(), "InitialImaging")
        .when(~aligned & F.col("uh_last").isNotNull(), "LastUAHoming")
        .when(~aligned, "CaseStart")
        .when(homed & imaged_early, "InitialImaging")
        .when(homed & homing_only, "LastUAHoming")
        .otherwise("Alignment")
    )
    out = out.withColumn("rebase_anchor", anchor)
    named = F.col("rebase_anchor")
    return out.withColumns({
        "anchor_us": F.when(named == "InitialImaging", F.col("ii.ts_us"))
        .when((named == "LastUAHoming") & aligned, F.col("uh_before_al.ts_us"))
        .when(named == "LastUAHoming", F.col("uh_last.ts_us"))
        .when(named == "Alignment", F.col("al.ts_us"))
        .otherwise(F.col("first_us")),
        "anchor_warning": F.when(~aligned & (named == "CaseStart"), "rebase_anchor_missing:fallback=CaseStart")
        .when(~aligned, F.concat(F.lit("rebase_missing_alignment:fallback="), named))
        .when(homed & (named == "Alignment"), "rebase_anchor_fallback:Alignment"),
    }).drop(*[c for c in LANDMARKS])


def case_ends(positioned: DataFrame, workflow: Workflow = DEFAULT) -> DataFrame:
    """Add ``case_end`` (pos, ts_us, row_number, state) and ``n_rows``; needs ``pos``.

    The end is the last event with a meaningful state, or the last event when there is none.
    """
    row = F.struct("pos", "ts_us", "row_number", "state")
    meaningful = F.when(~is_unassigned(F.col("state"), workflow), row)
    out = group_values(positioned, KEYS, {
        "__meaningful": F.max(meaningful), "__final": F.max(row), "n_rows": F.count(F.lit(1)),
    })
    return out.withColumns({
        "case_end": F.coalesce("__meaningful", "__final"), "end_is_fallback": F.col("__meaningful").isNull(),
    }).drop("__meaningful", "__final")


def _input_order(labelled: DataFrame, arrival: str) -> DataFrame:
    """Add per-case ``non_monotonic`` (time steps back in arrival order) and ``reordered``."""
    by_arrival = [F.col(arrival)]
    out = running_before(labelled, KEYS, event_order(), {"__arrived": ("last", F.col(arrival))})
    aggs = {"reordered": F.max(F.coalesce(F.col(arrival) < F.col("__arrived"), F.lit(False)))}
    if is_sliced(labelled):
        hot = slice_hot_groups(labelled.filter(F.col(SLICE).isNotNull()).drop(SLICE), KEYS, by_arrival)
        hot = running_before(hot, KEYS, by_arrival, {"__prev_us": ("last", F.col("ts_us"))})
        backward = durable(hot.groupBy(*KEYS).agg(F.max(F.col("ts_us") < F.col("__prev_us")).alias("__hot_back")))
        frame = group_window(out, KEYS)
        out = out.withColumn("__prev_us", F.lag("ts_us").over(frame.orderBy(*by_arrival)))
        out = out.join(F.broadcast(backward), KEYS, "left")
        step_back = F.when(F.col(SLICE).isNotNull(), F.col("__hot_back")).otherwise(F.col("ts_us") < F.col("__prev_us"))
    else:
        out = out.withColumn("__prev_us", F.lag("ts_us").over(Window.partitionBy(*KEYS).orderBy(*by_arrival)))
        step_back = F.col("ts_us") < F.col("__prev_us")
    aggs["non_monotonic"] = F.max(F.coalesce(step_back, F.lit(False)))
    return group_values(out, KEYS, aggs).drop("__arrived", "__prev_us", "__hot_back")


def state_intervals(labelled: DataFrame, workflow: Workflow = DEFAULT, arrival: str | None = None) -> DataFrame:
    """One interval per event: ``start_sec``, ``duration_sec``, ``rebase_anchor``, ``quality_flags``.

    ``arrival`` names a column holding the order the rows came in; without it the input counts as
    ordered.  Case-level facts needed for warnings stay on the rows (``case_end``, ``n_rows``, …).
    """
    out = _input_order(labelled, arrival) if arrival else labelled.withColumns({
        "non_monotonic": F.lit(False), "reordered": F.lit(False),
    })
    out = case_ends(rebase_anchors(out), workflow)
    out = next_value(out, KEYS, event_order(), "next_us", F.col("ts_us"))

    def one_of(column: str, items) -> str:
        return f"{column} IN ({', '.join(quoted(i) for i in items)})"

    def steps(df: DataFrame, **columns: str) -> DataFrame:
        return df.withColumns({name: F.expr(text) for name, text in columns.items()})

    state, limit = "coalesce(trim(state), '')", workflow.large_gap_sec * MICROS
    out = steps(
        out,
        raw_us="next_us - ts_us",
        to_end_us="case_end.ts_us - ts_us",
        u=one_of(state, workflow.unassigned),
        t=one_of(state, workflow.terminal_states),
        e=one_of(state, workflow.early_states),
        sparse=f"coalesce({one_of('state_assignment_rule', workflow.sparse_rules)}, false)"
        f" OR {one_of('event_type', workflow.sparse_types)} OR (is_synthetic AND source = 'sessions')",
        start_us="ts_us - anchor_us",
    )
    out = steps(
        out,
        moving="coalesce(raw_us > 0, false)",
        large=f"coalesce(raw_us > {limit}, false)",
        past="coalesce(raw_us > 0 AND next_us > case_end.ts_us, false)",
        cap_us=f"IF(to_end_us > 0 AND to_end_us < {limit}, to_end_us, {limit})",
    )
    # Terminal and unassigned states end with the case; early states with sparse evidence and all
    # large gaps past the end are cut to the cap.
    out = steps(out, clamp="past AND (u OR t)", big="large AND (u OR t OR past)")
    out = steps(out, step1="IF(clamp, greatest(0, to_end_us), raw_us)")
    out = steps(out, early_cut="large AND e AND sparse AND cap_us < step1")
    out = steps(out, step2="IF(early_cut, cap_us, step1)")
    flags = [
        ("non_monotonic", "non_monotonic_input"), ("reordered", "input_reordered"), ("raw_us = 0", "zero_duration_to_next"),
        ("clamp AND t", "interval_terminal_state_clamped"), ("clamp AND u", "interval_unassigned_state_truncated"),
        ("early_cut", "interval_early_state_truncated"), ("early_cut OR big", "interval_truncated_large_gap"),
        ("big AND t", "interval_terminal_state_clamped"), ("big AND u", "interval_unassigned_state_truncated"),
        ("start_us < 0", "negative_rebased_start"), ("start_us < 0", "negative_rebased_start_expected_pre_anchor"),
    ]
    listed = ", ".join(f"IF({condition}, '{flag}', NULL)" for condition, flag in flags)
    out = steps(
        out,
        duration_us="CAST(CASE WHEN NOT moving THEN 0 WHEN big THEN least(step2, cap_us) ELSE step2 END AS BIGINT)",
        quality_flags=f"array_distinct(array_compact(array({listed})))",
    )
    out = steps(out, start_sec="start_us / 1e6D", duration_sec="duration_us / 1e6D", raw_duration_sec="raw_us / 1e6D")
    return out.drop("u", "t", "e", "sparse", "moving", "large", "past", "clamp", "big", "cap_us", "step1", "step2",
                    "to_end_us", "prior_state")


def relative_times(
    df: DataFrame, ts_us: str = "ts_us", keys: list[str] | None = None, tie: str = "row_number", largest: int | None = None,
) -> DataFrame:
    """Seconds since the group's first time, seconds to the next time (0 at the end, never negative).

    When one of the keys is absent from the data, the whole table is one group.
    """
    keys = KEYS if keys is None else keys
    keys = keys if all(k in df.columns for k in keys) else []
    order = [F.col(ts_us), F.col(tie)]
    out = slice_hot_groups(df.drop(SLICE), keys, order, largest=largest if keys else None)
    out = next_value(group_values(out, keys, {"__first": F.min(ts_us)}), keys, order, "__next", F.col(ts_us))
    return out.withColumns({
        "start_sec": (F.col(ts_us) - F.col("__first")) / 1e6,
        "duration_sec": F.greatest(F.coalesce((F.col("__next") - F.col(ts_us)) / 1e6, F.lit(0.0)), F.lit(0.0)),
    }).drop("__first", "__next", SLICE)
