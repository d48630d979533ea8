"""Run health: durations, quality flags, warning categories, per-case results, event distributions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.coerce import warning_category
from stagewatch.functions.ordered import ranked
from stagewatch.workflow import DIAGNOSTIC_FLAGS, KEYS


# The order in which a run reports the stages of a case, by how their categories begin; timelines come last.
STAGES = (
    ("session", "ignored_session"), ("timing_log_blank",), ("timing_log",), ("state", "cleanup"), ("interval", "rebase", "case_end"),
)


def first_sight() -> Column:
    """A warning's place in the run's total order: cases by name, stages inside a case, rows inside a stage; timelines at the end."""
    category = F.col("category")
    stage = F.when(category == "uncategorized", -1)
    for i, beginnings in enumerate(STAGES):
        stage = stage.when(reduce(Column.__or__, [category.startswith(b) for b in beginnings]), i)
    return F.struct(
        category.startswith("plot").alias("late"), F.lower("case_id").alias("name"), F.col("case_id"),
        stage.otherwise(len(STAGES)).alias("stage"), F.coalesce("row_number", F.lit(0)).alias("row"), category,
    )


def warning_categories(warnings: DataFrame) -> DataFrame:
    """n_warnings per site and category, and where the run meets the category first."""
    return warnings.groupBy("site_code", "category").agg(F.count(F.lit(1)).alias("n_warnings"), F.min(first_sight()).alias("first"))


def warning_texts(warnings: DataFrame) -> DataFrame:
    """site_code, text: warnings as lines of a run document, ``case:category:row:detail``; uncategorized ones are their detail."""
    row = F.concat(F.lit("row="), F.col("row_number").cast("string"))
    line = F.concat_ws(":", "case_id", "category", row, "detail")
    return warnings.select("site_code", F.when(F.col("category") == "uncategorized", F.col("detail")).otherwise(line).alias("text"))


def text_categories(texts: DataFrame) -> DataFrame:
    """n_warnings per site and category of warning lines, whatever wrote them."""
    return texts.groupBy("site_code", warning_category(F.col("text")).alias("category")).agg(F.count(F.lit(1)).alias("n_warnings"))


def top_warnings(warnings: DataFrame, n: int = 8) -> DataFrame:
    """Most frequent categories per site; ties by first sight."""
    order = Window.partitionBy("site_code").orderBy(F.col("n_warnings").desc(), "first")
    ranked_rows = warning_categories(warnings).withColumn("rank", F.row_number().over(order))
    return ranked_rows.filter(F.col("rank") <= n).drop("first")


def site_diagnostics(cases: DataFrame, other_warnings: DataFrame) -> DataFrame:
    """``run_diagnostics`` from ``warnings.interval_facts`` of the cases and the warnings that do not come from intervals."""
    counts = [F.sum(c).alias(c) for c in (*[f"n_over_{sec}" for sec in (7200, 14400, 28800)], *DIAGNOSTIC_FLAGS)]
    given = F.col("state_warning_count") + F.col("timing_warning_count") + F.col("plot_warning_count")
    out = cases.groupBy("site_code").agg((F.max("max_duration_us") / 1e6).alias("max_duration_sec"), *counts, F.sum(given).alias("given"))
    others = other_warnings.groupBy("site_code").agg(F.count(F.lit(1)).alias("others"))
    total = F.col("given") + F.coalesce("others", F.lit(0))
    return out.join(others, "site_code", "left").withColumn("total_warnings", total).drop("given", "others")


def quality_flag_counts(intervals: DataFrame) -> DataFrame:
    """Intervals per site and quality flag, every flag found."""
    return intervals.select("site_code", F.explode("quality_flags").alias("flag")).groupBy("site_code", "flag").agg(
        F.count(F.lit(1)).alias("n_intervals")
    )


def run_diagnostics(intervals: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """One row per site: longest interval, counts over three thresholds, five flag counts, warnings."""
    out = intervals.groupBy("site_code").agg(
        (F.max("duration_us") / 1e6).alias("max_duration_sec"),
        *[F.count_if(F.col("duration_us") > sec * 1_000_000).alias(f"n_over_{sec}") for sec in (7200, 14400, 28800)],
        *[F.count_if(F.array_contains("quality_flags", flag)).alias(flag) for flag in DIAGNOSTIC_FLAGS],
    )
    if warnings is None:
        return out
    totals = warnings.groupBy("site_code").agg(F.count(F.lit(1)).alias("total_warnings"))
    return out.join(totals, "site_code", "left").withColumn("total_warnings", F.coalesce("total_warnings", F.lit(0)))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per case and stage, counted in one aggregate: ``{column name: DataFrame with the keys}``."""
    tagged = None
    for name, df in stages.items():
        part = df.select(*KEYS, F.lit(name).alias("stage"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*KEYS).agg(*[F.count_if(F.col("stage") == name).alias(name) for name in stages])


def case_results(
    sources: DataFrame, errors: DataFrame, first_rows: DataFrame, counts: DataFrame, years: list[int] | None = None
) -> DataFrame:
    """Status of every case and, for processed ones, its row and warning counts.

    ``sources``: keys, status, resolution_rule, source_path; ``errors``: keys, error;
    ``first_rows``: keys, case_year.
    """
    names = [c for c in counts.columns if c not in KEYS]
    joined = (
        sources.select(*KEYS, F.col("status").alias("source_status"), "source_type", "source_path")
        .join(errors.select(*KEYS, "error"), KEYS, "left")
        .join(first_rows.select(*KEYS, "case_year"), KEYS, "left")
        .join(counts, KEYS, "left")
    )
    outside = F.lit(False) if years is None else ~F.coalesce(F.col("case_year").isin(*years), F.lit(False))
    status = (
        F.when(F.col("source_status") == "no_candidates", "skipped_no_database_candidates")
        .when(F.col("source_status") != "resolved", "failed")
        .when(outside, "skipped_year_filter")
        .when(F.col("error").isNotNull(), "failed")
        .otherwise("processed")
    )
    out = joined.withColumn("status", status)
    done = F.col("status") == "processed"
    return out.select(
        *KEYS, "status",
        F.when(F.col("status") == "failed", F.coalesce(
            F.when(F.col("source_status") != "resolved", F.col("source_status")), F.col("error"))).alias("error"),
        *[F.when(done, F.col(c)).alias(c) for c in ("source_type", "source_path")],
        *[F.when(done, F.coalesce(F.col(c), F.lit(0))).alias(c) for c in names],
    )


def run_manifest(results: DataFrame) -> DataFrame:
    """One row per site: discovered, processed, failed and skipped cases."""
    return results.groupBy("site_code").agg(
        F.count(F.lit(1)).alias("cases_discovered"),
        F.count_if(F.col("status") == "processed").alias("cases_processed"),
        F.count_if(F.col("status") == "failed").alias("cases_failed"),
        F.count_if(F.col("status").startswith("skipped")).alias("cases_skipped"),
    )


def type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))


def kind_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_kind").agg(F.count(F.lit(1)).alias("n_events"))


def matching_events(events: DataFrame, pattern: str = "%Treat%", n: int | None = None, largest: int | None = None) -> DataFrame:
    """Events whose type matches the pattern, numbered per site in time order (``n``: only the first so many).

    ``largest``: events of the largest site, where known.
    """
    order = [F.col("ts_us"), F.col("case_id"), F.col("row_number")]
    hits = events.filter(F.col("event_type").like(pattern))
    if n is None:
        return ranked(hits, ["site_code"], order, "nth", largest=largest)
    # A bounded number per site: Spark's window group limit keeps only the first n before the shuffle.
    nth = F.row_number().over(Window.partitionBy("site_code").orderBy(*order))
    return hits.withColumn("nth", nth).filter(F.col("nth") <= n)


def stateless_types(labelled: DataFrame) -> DataFrame:
    """Event types among rows without a state."""
    return type_counts(labelled.filter(F.coalesce("state", F.lit("")) == ""))
