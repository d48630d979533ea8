"""Clock sanity per case: windows, noon and cutoff crossings, backward steps, and site roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.coerce import clock_us, day_number, from_micros, parse_clock
from stagewatch.functions.ordered import SLICE, is_sliced, running_before, slice_hot_groups
from stagewatch.operators.summary import has_state
from stagewatch.workflow import KEYS

NOON = "12:00"


def _crossing(first: Column, last: Column, cutoff: int) -> Column:
    return F.coalesce((clock_us(first) < cutoff) & (clock_us(last) >= cutoff), F.lit(False))


def backward_steps(events: DataFrame, arrival: str = "row_number", largest: int | None = None) -> DataFrame:
    """Per case: does the clock ever step back in log order, and the worst step in seconds (≤ 0)."""
    order = [F.col(arrival)]
    out = slice_hot_groups(events.select(*KEYS, arrival, "ts_us"), KEYS, order, largest=largest)
    out = running_before(out, KEYS, order, {"__prev": ("last", F.col("ts_us"))})
    step = F.col("ts_us") - F.col("__prev")
    return out.groupBy(*KEYS).agg(F.least(F.coalesce(F.min(step), F.lit(0)), F.lit(0)).alias("step_us")).select(
        *KEYS, (F.col("step_us") < 0).alias("has_non_monotonic"), (F.col("step_us") / 1e6).alias("max_backward_sec")
    )


def time_sanity(labelled: DataFrame, log: DataFrame | None = None, largest: int | None = None) -> DataFrame:
    """One row per case: the log window and, for rows with a state, the procedural window.

    ``log`` holds the rows in arrival order for the backward-step check (default: the log rows of
    ``labelled``); the check would be empty on rows already sorted by time.  ``largest`` is the size of the largest case
    where it is known; without it the rows are counted first.
    """
    noon = parse_clock(NOON)
    together = log is None and not is_sliced(labelled)
    if together:  # the cases are in one place each already: another sort there instead of another pass over the log
        arrival = Window.partitionBy(*KEYS).orderBy(F.col("row_number").asc_nulls_last())
        step = F.when(F.col("row_number").isNotNull(), F.col("ts_us") - F.lag("ts_us").over(arrival))
        labelled = labelled.withColumn("__step_us", step)
    backward = F.least(F.coalesce(F.min("__step_us"), F.lit(0)), F.lit(0))
    with_state = has_state()
    proc_us = F.when(with_state, F.col("ts_us"))
    after = clock_us(F.col("ts_us")) >= noon
    facts = labelled.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("ts_us").alias("f"), F.max("ts_us").alias("l"), F.bool_or(after).alias("any_after_noon"),
        F.min(proc_us).alias("pf"), F.max(proc_us).alias("pl"),
        F.coalesce(F.bool_or(with_state & after), F.lit(False)).alias("proc_any_after_noon"),
        *([(backward < 0).alias("has_non_monotonic"), (backward / 1e6).alias("max_backward_sec")] if together else []),
    )
    if not together:
        logged = labelled.filter(F.col("row_number").isNotNull()) if log is None else log
        facts = facts.join(backward_steps(logged.drop(SLICE), largest=largest), KEYS, "left")

    def window(first: str, last: str, prefix: str) -> list[Column]:
        a, b = F.col(first), F.col(last)
        return [
            from_micros(a).alias(f"{prefix}first_ts"),
            from_micros(b).alias(f"{prefix}last_ts"),
            ((b - a) / 6e7).alias(f"{prefix}duration_min"),
            F.col(f"{prefix}any_after_noon"),
            _crossing(a, b, noon).alias(f"{prefix}crossed_noon"),
            F.coalesce(day_number(a) != day_number(b), F.lit(False)).alias(
                f"{prefix}multi_day" if prefix else "multi_day_log"),
        ]

    return facts.select(
        *KEYS, "n_events", *window("f", "l", ""),
        F.coalesce("has_non_monotonic", F.lit(False)).alias("has_non_monotonic"),
        F.coalesce("max_backward_sec", F.lit(0.0)).alias("max_backward_sec"),
        *window("pf", "pl", "proc_"),
    )


def time_cutoff(labelled: DataFrame, cutoff: str) -> DataFrame:
    """One row per case: the procedural window against a time of day; cases without one are kept."""
    at = parse_clock(cutoff)
    state = has_state() if "state" in labelled.columns else F.lit(True)
    us = F.when(state, F.col("ts_us"))
    facts = labelled.groupBy(*KEYS).agg(
        F.min(us).alias("f"), F.max(us).alias("l"),
        F.coalesce(F.bool_or(clock_us(us) >= at), F.lit(False)).alias("any_after_cutoff"),
    )
    return facts.select(
        *KEYS,
        from_micros(F.col("f")).alias("proc_first_ts"),
        from_micros(F.col("l")).alias("proc_last_ts"),
        ((F.col("l") - F.col("f")) / 6e7).alias("proc_duration_min"),
        "any_after_cutoff",
        _crossing(F.col("f"), F.col("l"), at).alias("crossed_cutoff"),
    )


def flag_rollup(per_case: DataFrame) -> DataFrame:
    """Cases per site, and how many carry each boolean flag."""
    flags = [f.name for f in per_case.schema if f.dataType.simpleString() == "boolean"]
    return per_case.groupBy("site_code").agg(
        F.count(F.lit(1)).alias("n_cases"), *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags]
    )
