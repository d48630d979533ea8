"""Minutes per case and state: long form, wide form, totals and phase groups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.coerce import require_columns
from stagewatch.functions.ordered import ranked
from stagewatch.workflow import KEYS, MRI_STATES, PHASE_GROUPS, STATE_NAMES, quoted

MINUTE_US = 60_000_000
TOTALS = ("MRITotal", "ProcedureTotal", "TotalMinutes")


def has_state(state: str = "state") -> Column:
    return F.coalesce(F.col(state), F.lit("")) != ""


def drop_long_intervals(intervals: DataFrame, below_sec: int = 21_600) -> DataFrame:
    return intervals.filter(F.col("duration_us") < below_sec * 1_000_000)


def phase_micros(intervals: DataFrame, positive_only: bool = False) -> DataFrame:
    """Whole microseconds per (site, case, state); summed as integers, so the order does not matter."""
    require_columns(intervals, [*KEYS, "state", "duration_us"])
    rows = intervals.filter(has_state())
    if positive_only:
        rows = rows.filter(F.col("duration_us") > 0)
    return rows.groupBy(*KEYS, "state").agg(F.sum("duration_us").alias("phase_us"))


def _minutes(us: Column) -> Column:
    return us / F.lit(float(MINUTE_US))


def _sum(names: Iterable[str]) -> Column:
    return F.expr(" + ".join(f"`{n}`" for n in names))


def timing_summary(
    intervals: DataFrame,
    states: Sequence[str] = STATE_NAMES,
    positive_only: bool = False,
    totals: Sequence[str] = TOTALS,
) -> DataFrame:
    """One row per case: minutes per state (0.0 when absent) and the totals.

    The pivot list is fixed, so the schema never depends on the data.  A state outside the list
    still counts in ``TotalMinutes``.
    """
    long = phase_micros(intervals, positive_only)
    names = ", ".join(quoted(s) for s in states)
    wide = long.groupBy(*KEYS).agg(
        *[F.expr(f"coalesce(sum(phase_us) FILTER (WHERE state = {quoted(s)}), 0) AS `{s}`") for s in states],
        F.expr(f"coalesce(sum(phase_us) FILTER (WHERE state NOT IN ({names})), 0) AS __other"),
    )
    mri = [s for s in MRI_STATES if s in states]
    sums = {
        "MRITotal": _sum(mri),
        "ProcedureTotal": _sum([s for s in STATE_NAMES[:2] if s in states] + mri),
        "TotalMinutes": _sum([*states, "__other"]),
    }
    return wide.select(
        *KEYS,
        *[_minutes(F.col(f"`{s}`")).alias(s) for s in states],
        *[_minutes(sums[name]).alias(name) for name in totals],
    )


def phase_groups(intervals: DataFrame, groups: Mapping[str, Sequence[str]] = PHASE_GROUPS) -> DataFrame:
    """One row per case with the minutes of each named group of states."""
    return phase_micros(intervals).groupBy(*KEYS).agg(*[
        _minutes(F.coalesce(F.sum(F.when(F.col("state").isin(*states), F.col("phase_us"))), F.lit(0))).alias(name)
        for name, states in groups.items()
    ])


def to_long(summary: DataFrame, phases: Sequence[str] | None = None) -> DataFrame:
    """Unpivot the wide summary: site, case, phase, minutes (only phases present as columns)."""
    phases = [p for p in (phases or STATE_NAMES) if p in summary.columns]
    return summary.unpivot(KEYS, [F.col(f"`{p}`").alias(p) for p in phases], "phase", "minutes")


def merge_phases(summary: DataFrame, parts: Sequence[str] = ("Coarse", "Detailed"), into: str = "Localization") -> DataFrame:
    """Replace several phase columns by their sum (NULL counts as 0)."""
    if not all(p in summary.columns for p in parts):
        return summary
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{p}`"), F.lit(0.0)) for p in parts])
    return summary.withColumn(into, total).drop(*parts)


def fill_phases(summary: DataFrame, states: Sequence[str] = STATE_NAMES) -> DataFrame:
    """Add absent state columns as 0.0 and, when missing, the 1-based case number ``Pt`` per site."""
    out = summary.withColumns({s: F.lit(0.0) for s in states if s not in summary.columns and s != "NA"})
    return out if "Pt" in out.columns else ranked(out, ["site_code"], [F.col("case_id")], "Pt")


def attach_identifiers(df: DataFrame, cases: DataFrame) -> DataFrame:
    """Site, PtId (folder name), Pt (position among all case folders of the site), CaseFolder."""
    named = cases.select(
        *KEYS,
        F.col("site_code").alias("Site"),
        F.col("case_id").alias("PtId"),
        F.col("discovery_order").alias("Pt"),
        F.concat_ws("/", *KEYS).alias("CaseFolder"),
    )
    return df.join(named, KEYS)


def case_state_totals(intervals: DataFrame) -> DataFrame:
    """Minutes per state of each case; order by minutes descending at the sink."""
    return phase_micros(intervals).select(*KEYS, "state", _minutes(F.col("phase_us")).alias("minutes"))
