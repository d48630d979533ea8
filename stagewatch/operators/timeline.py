"""Timeline tables: the rows, order, axis and warnings behind a per-case timeline figure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.coerce import clock_label, clock_us, day_number, from_micros
from stagewatch.functions.ordered import ranked
from stagewatch.functions.quantiles import exact_quantiles
from stagewatch.operators.summary import has_state, to_long
from stagewatch.workflow import KEYS, PLOT_STATES, UNKNOWN_STATE_COLOR, state_dimension

TIMELINE_COLUMNS = [
    *KEYS, "timestamp", "ts_us", "state", "start_us", "duration_us", "color", "ordinal", "row_number",
    "quality_flags", "event_type",
]


def is_blank_state() -> Column:
    return F.coalesce(F.trim("state"), F.lit("")).isin("", "NA")


def timeline_rows(intervals: DataFrame) -> DataFrame:
    """Plottable intervals with color and ordinal; ``ordinal`` is NULL for a state the workflow lacks."""
    dimension = F.broadcast(state_dimension(intervals.sparkSession))
    rows = intervals.filter(~is_blank_state() & (F.col("duration_us") > 0)).join(dimension, "state", "left")
    return rows.withColumn("color", F.coalesce("color", F.lit(UNKNOWN_STATE_COLOR))).select(*TIMELINE_COLUMNS)


def _reading_order() -> Column:
    return F.struct(
        F.col("case_id"), F.col("ts_us"), F.coalesce("row_number", F.lit(10**12)).alias("row_rank"), F.col("event_type")
    )


def state_order(rows: DataFrame) -> DataFrame:
    """Display order of the states present in a site: known ones by ordinal, then unknown by first sight."""
    seen = rows.groupBy("site_code", "state").agg(
        F.max("ordinal").alias("ordinal"), F.min(_reading_order()).alias("first_seen")
    )
    # One row per state and site.
    order = Window.partitionBy("site_code").orderBy(F.col("ordinal").asc_nulls_last(), "first_seen")
    return seen.select("site_code", "state", F.row_number().over(order).alias("state_order"))


def case_order(rows: DataFrame, largest: int | None = None) -> DataFrame:
    """y position (0-based) of every case of a site that has plottable rows; ``largest``: cases of the largest site, where known."""
    cases = rows.select(*KEYS).distinct()
    return ranked(cases, ["site_code"], [F.col("case_id")], "y", largest=largest).withColumn("y", F.col("y") - 1)


def first_unknown_states(rows: DataFrame) -> DataFrame:
    """States the workflow lacks, each with the case where a site shows it first."""
    return rows.filter(F.col("ordinal").isNull()).groupBy("site_code", "state").agg(
        F.min(_reading_order()).alias("first_seen")
    ).select("site_code", F.col("first_seen.case_id").alias("case_id"), "state")


def unknown_state_dictionary(rows: DataFrame) -> DataFrame:
    """state, number (from 1), and the site and case that show it first: states the workflow lacks, by first sight in the run.

    The run's order is site, case and the order inside the case.  Every task keeps the first sight of each state it meets;
    what is numbered has one row per state.
    """
    first = F.min(F.struct(F.col("site_code"), _reading_order().alias("at"))).alias("first")
    seen = rows.filter(F.col("ordinal").isNull()).groupBy("state").agg(first, F.count(F.lit(1)).alias("n_rows"))
    number = F.row_number().over(Window.orderBy("first", "state"))
    return seen.select(
        "state", number.alias("number"), F.col("first.site_code").alias("site_code"), F.col("first.at.case_id").alias("case_id"), "n_rows")


def with_state_numbers(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rows with a number for every state: a known one's ordinal, an unknown one's after all known ones."""
    known = len(PLOT_STATES)
    found = rows.join(dictionary.select("state", "number"), "state", "left")
    return found.withColumn("state_number", F.coalesce("ordinal", F.col("number") + known)).drop("number")


def normalized_timeline(rows: DataFrame, largest: int | None = None) -> DataFrame:
    """Rebased minutes per row and the case's y position."""
    return rows.join(case_order(rows, largest), KEYS).select(
        *KEYS, "y", "state", "color", "row_number", "ts_us", "event_type",
        (F.col("start_us") / 6e7).alias("start_min"), (F.col("duration_us") / 6e7).alias("duration_min"),
    )


def axis_window(
    rows: DataFrame, lower: float = 0.01, upper: float = 0.99, margin_sec: float = 300.0
) -> DataFrame:
    """Per site: the percentile window over all starts and ends, widened by a margin."""
    ends = rows.select("site_code", F.explode(F.array("start_us", F.col("start_us") + F.col("duration_us"))).alias("us"))
    found = exact_quantiles(ends, ["site_code"], F.col("us"), {"p_lo": lower, "p_hi": upper})
    low = F.col("p_lo") / 1e6 - margin_sec
    high = F.col("p_hi") / 1e6 + margin_sec
    return found.select(
        "site_code", low.alias("lower_sec"),
        F.when(high <= low, low + max(1.0, margin_sec * 2)).otherwise(high).alias("upper_sec"),
    )


def clock_timeline(rows: DataFrame) -> DataFrame:
    """Minutes since midnight of start and end, with HH:MM labels."""
    start = clock_us(F.col("ts_us")) / 6e7
    end = (clock_us(F.col("ts_us")) + F.col("duration_us")) / 6e7
    return rows.select(
        *KEYS, "state", "color", "row_number", "ts_us", "event_type",
        start.alias("start_minute"), end.alias("end_minute"),
        clock_label(start).alias("start_label"), clock_label(end).alias("end_label"),
    )


def clock_ticks(clock: DataFrame) -> DataFrame:
    """Tick positions per site: every 30 minutes up to a six-hour span, else hourly."""
    span = clock.groupBy("site_code").agg(F.min("start_minute").alias("lo"), F.max("end_minute").alias("hi"))
    spaced = span.withColumn("spacing", F.when(F.col("hi") - F.col("lo") <= 360, 30).otherwise(60).cast("bigint"))
    first = F.floor(F.col("lo") / F.col("spacing")) * F.col("spacing")
    last = F.ceil(F.col("hi") / F.col("spacing")) * F.col("spacing")
    ticks = spaced.select("site_code", "spacing", F.explode(F.sequence(first, last, F.col("spacing"))).alias("tick_minute"))
    return ticks.withColumn("tick_label", clock_label(F.col("tick_minute").cast("double")))


def midnight_crossings(rows: DataFrame) -> DataFrame:
    """First row of each case whose end falls on another day."""
    end_us = F.col("ts_us") + F.col("duration_us")
    crossing = rows.filter(day_number(end_us) != day_number(F.col("ts_us")))
    first = crossing.groupBy(*KEYS).agg(F.min(F.struct(
        F.col("ts_us"), F.coalesce("row_number", F.lit(10**12)).alias("row_rank"), F.col("event_type"),
        F.col("row_number"), end_us.alias("end_us"),
    )).alias("r"))
    return first.select(
        *KEYS, "r.row_number", "r.event_type", from_micros(F.col("r.ts_us")).alias("start_ts"),
        from_micros(F.col("r.end_us")).alias("end_ts"),
    )


def script_timeline(timed: DataFrame, max_cases: int | None = None, largest: int | None = None) -> DataFrame:
    """Script profile: minutes per row of the cases of each site in id order (``max_cases``: only the first so many)."""
    rows = timed.filter(has_state() & (F.col("duration_us") > 0))
    cases = ranked(rows.select(*KEYS).distinct(), ["site_code"], [F.col("case_id")], "nth", largest=largest)
    if max_cases is not None:
        cases = cases.filter(F.col("nth") <= max_cases)
    dimension = F.broadcast(state_dimension(timed.sparkSession))
    return rows.join(cases.withColumn("y", F.col("nth") - 1), KEYS).join(dimension, "state", "left").select(
        *KEYS, "y", "state", "ordinal", "row_number", "ts_us", "event_type",
        (F.col("start_us") / 6e7).alias("start_min"), (F.col("duration_us") / 6e7).alias("dur_min"),
    )


def stacked_layout(summary: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Phases of a case laid end to end in canonical order (at most one row per phase and case).

    ``keep_empty`` keeps phases of zero length and counts NULL as 0, as the stacked bars do.
    """
    dimension = F.broadcast(state_dimension(summary.sparkSession))
    long = to_long(summary, PLOT_STATES).withColumn("minutes", F.coalesce("minutes", F.lit(0.0)))
    if not keep_empty:
        long = long.filter(F.col("minutes") > 0)
    long = long.join(dimension, long["phase"] == dimension["state"]).drop("state")
    before = Window.partitionBy(*KEYS).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return long.select(
        *KEYS, "phase", "ordinal", "color",
        F.coalesce(F.sum("minutes").over(before), F.lit(0.0)).alias("start_min"), F.col("minutes").alias("duration_min"),
    )
