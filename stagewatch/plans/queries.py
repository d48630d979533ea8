"""The registered queries: every operator applied to the whole ``events`` table of a data folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewatch import sinks
from stagewatch.functions.coerce import safe_name
from stagewatch.functions.durable import durable
from stagewatch.operators import (
    diagnostics, enrich, intervals, normalize, sanity, schedule, states, stats, summary, timeline, warnings,
)
from stagewatch.plans.site_run import ScriptRun, SiteRun, composed_run
from stagewatch.sources import driver_tables as tables
from stagewatch.sources import listing
from stagewatch.workflow import KEYS, SESSION_FIELDS, TIMING_LABELS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
YEARS = [2024]
EVENT = [*KEYS, "timestamp", "event_type", "source", "source_detail", "row_number"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def site_run(spark: SparkSession, sf_dir: str, **options) -> SiteRun:
    return SiteRun(
        tables.raw_events(spark, sf_dir), tables.sessions(spark, sf_dir), tables.timing_log(spark, sf_dir),
        largest_case=largest(spark, sf_dir), **options,
    )


def full_run(spark: SparkSession, sf_dir: str, **options) -> SiteRun:
    """The run as composed from discovery on: processed cases only, all warnings."""
    return composed_run(
        discovered(spark, sf_dir), tables.raw_events(spark, sf_dir),
        tables.sessions(spark, sf_dir), tables.timing_log(spark, sf_dir), YEARS, largest_case=largest(spark, sf_dir), **options,
    )


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.discover_cases(tables.file_listing(spark, sf_dir), largest=tables.largest_site(spark, sf_dir))


def largest(spark: SparkSession, sf_dir: str) -> int:
    """Upper bound for the events of one case: its log rows plus the few synthetic ones."""
    return tables.largest_case(spark, sf_dir) + len(SESSION_FIELDS) + len(TIMING_LABELS)


def script_run(spark: SparkSession, sf_dir: str) -> ScriptRun:
    return ScriptRun(
        tables.raw_events(spark, sf_dir), tables.sessions(spark, sf_dir), largest_case=largest(spark, sf_dir))


def case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sessions(spark, sf_dir).select(*KEYS)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.timing_summary(site_run(spark, sf_dir).intervals)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written once: statistics read it several times, and it is far smaller than the log."""
    return durable(wide(spark, sf_dir))


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.to_long(stored(spark, sf_dir))


def timeline_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.timeline_rows(site_run(spark, sf_dir).intervals)


def stored_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durable(timeline_of(spark, sf_dir))


def rounded(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Doubles at a fixed number of digits, so that summation order cannot show."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def flags() -> Column:
    return F.concat_ws("|", "quality_flags").alias("quality_flags")


# ---- normalization ------------------------------------------------------------------------------

@query
def normalized_events(spark, sf):
    return normalize.kept(site_run(spark, sf).normalized).select(
        *KEYS, "row_number", "timestamp", "event_type", "segment_id", "event_kind", "source")


@query
def dropped_events(spark, sf):
    return normalize.dropped(site_run(spark, sf).normalized).select(*KEYS, "row_number", "event_type", "drop_reason")


@query
def case_errors(spark, sf):
    return normalize.case_errors(tables.raw_events(spark, sf))


@query
def event_type_counts(spark, sf):
    return diagnostics.type_counts(site_run(spark, sf).normalized)


@query
def event_kind_counts(spark, sf):
    return diagnostics.kind_counts(site_run(spark, sf).normalized)


@query
def year_selected_cases(spark, sf):
    raw = normalize.select_years(tables.raw_events(spark, sf), YEARS)
    return raw.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def lenient_time_quality(spark, sf):
    return normalize.bad_time_count(tables.raw_events(spark, sf), "raw_timestamp")


@query
def inferred_ids(spark, sf):
    return normalize.infer_patient_ids(tables.raw_events(spark, sf), tables.sessions(spark, sf))


@query
def aligned_logs(spark, sf):
    """Logs of two versions (here: by site) as one table."""
    raw = tables.raw_events(spark, sf).withColumnRenamed("raw_segment_id", "SegmentId")
    old = raw.filter("site_code IN ('S0', 'S1')").withColumnRenamed("SegmentId", "TreatmentId").withColumn("SignalHelpKey", F.lit("k"))
    new = raw.filter("site_code NOT IN ('S0', 'S1')").withColumn("Temperature", F.col("raw_event_kind").cast("double"))
    return normalize.align_log_versions(old, new).drop("raw_payload", "patient_id")


@query
def log_head(spark, sf):
    return normalize.log_head(tables.raw_events(spark, sf)).select(*KEYS, "row_number", "raw_timestamp", "raw_event_type", "raw_segment_id")


@query
def matching_events(spark, sf):
    return diagnostics.matching_events(site_run(spark, sf).normalized, largest=tables.sizes(spark, sf)[2]).select(
        *KEYS, "row_number", "timestamp", "event_type", "nth")


# ---- enrichment ---------------------------------------------------------------------------------

@query
def session_events(spark, sf):
    return enrich.session_events(tables.sessions(spark, sf)).select(*KEYS, "timestamp", "event_type", "source_detail")


@query
def session_field_stats(spark, sf):
    return enrich.session_field_stats(tables.sessions(spark, sf))


@query
def session_warnings(spark, sf):
    return enrich.session_warnings(tables.sessions(spark, sf))


@query
def timing_log_events(spark, sf):
    return enrich.timing_log_events(tables.timing_log(spark, sf)).select(*KEYS, "timestamp", "event_type", "source_detail")


@query
def timing_log_unmapped(spark, sf):
    return enrich.unmapped_labels(tables.timing_log(spark, sf)).select(*KEYS, "row_number", "label")


@query
def timing_log_warnings(spark, sf):
    return enrich.timing_log_warnings(tables.timing_log(spark, sf))


@query
def enriched_events(spark, sf):
    return site_run(spark, sf).enriched.select(*EVENT, "is_synthetic", "segment_id", "event_kind", "insertion_rule")


@query
def injected_session_events(spark, sf):
    return script_run(spark, sf).injected.select(
        *KEYS, "row_number", "raw_timestamp", "raw_event_type", "raw_segment_id", "raw_event_kind")


# ---- states -------------------------------------------------------------------------------------

@query
def state_labeled_events(spark, sf):
    return site_run(spark, sf).labelled.select(*EVENT, "state", "state_assignment_rule", "cleanup_rule_applied")


@query
def unmapped_critical(spark, sf):
    return states.unmapped_critical(site_run(spark, sf).labelled)


@query
def stateless_types(spark, sf):
    return diagnostics.stateless_types(site_run(spark, sf).labelled)


@query
def state_warnings(spark, sf):
    return warnings.state_warnings(site_run(spark, sf).labelled)


@query
def state_labeled_script(spark, sf):
    return script_run(spark, sf).labelled.select(*KEYS, "row_number", "timestamp", "event_type", "state")


@query
def setup_adjusted_script(spark, sf):
    return script_run(spark, sf).adjusted.select(
        *KEYS, "row_number", "timestamp", "event_type", "state", "rebase_anchor")


@query
def script_times(spark, sf):
    return script_run(spark, sf).timed.select(
        *KEYS, "row_number", "timestamp", "event_type", "state", "start_sec", "duration_sec", "first_us", "last_us")


@query
def review_tail(spark, sf):
    return states.relabel_review_tail(site_run(spark, sf).labelled).select(*EVENT, "state")


# ---- intervals ----------------------------------------------------------------------------------

@query
def rebase_anchors(spark, sf):
    rows = intervals.rebase_anchors(site_run(spark, sf).labelled)
    return rows.groupBy(*KEYS).agg(
        F.max("rebase_anchor").alias("rebase_anchor"),
        (F.max(F.col("anchor_us") - F.col("first_us")) / 1e6).alias("anchor_sec"),
        F.max("anchor_warning").alias("anchor_warning"),
    )


@query
def case_end(spark, sf):
    rows = site_run(spark, sf).intervals
    return rows.groupBy(*KEYS).agg(F.max("case_end").alias("e"), F.max("n_rows").alias("n_rows")).select(
        *KEYS, F.col("e.pos").alias("end_pos"), F.col("e.ts_us").alias("end_us"), F.col("e.row_number").alias("end_row"),
        F.col("e.state").alias("end_state"), "n_rows")


@query
def state_intervals(spark, sf):
    return site_run(spark, sf).intervals.select(
        *EVENT, "state", "start_sec", "duration_sec", "rebase_anchor", flags())


@query
def state_intervals_arrival(spark, sf):
    """Intervals of the log rows alone, with the check of the order they arrived in."""
    run = SiteRun(tables.raw_events(spark, sf), largest_case=largest(spark, sf))
    rows = intervals.state_intervals(run.labelled, arrival="row_number")
    return rows.select(*KEYS, "row_number", "event_type", "state", "duration_sec", "non_monotonic", "reordered")


@query
def interval_warnings(spark, sf):
    return warnings.interval_warnings(site_run(spark, sf).intervals)


@query
def relative_times(spark, sf):
    rows = normalize.kept(site_run(spark, sf).normalized)
    return intervals.relative_times(rows, largest=largest(spark, sf)).select(*KEYS, "row_number", "start_sec", "duration_sec")


@query
def interval_export(spark, sf):
    """Intervals in the export contract, payload joined back from the enriched rows."""
    run = site_run(spark, sf)
    return sinks.export_columns(sinks.with_payload(run.intervals, run.enrich(with_payload=True)), sinks.INTERVALS)


# ---- summaries ----------------------------------------------------------------------------------

@query
def timing_summary(spark, sf):
    return rounded(wide(spark, sf))


@query
def timing_summary_positive(spark, sf):
    rows = site_run(spark, sf).intervals
    return rounded(summary.timing_summary(rows, positive_only=True, totals=("MRITotal", "ProcedureTotal")))


@query
def timing_summary_filtered(spark, sf):
    return rounded(summary.timing_summary(summary.drop_long_intervals(site_run(spark, sf).intervals)))


@query
def timing_summary_script(spark, sf):
    return rounded(summary.timing_summary(summary.drop_long_intervals(script_run(spark, sf).timed)))


@query
def phase_groups(spark, sf):
    return rounded(summary.phase_groups(site_run(spark, sf).intervals))


@query
def case_state_totals(spark, sf):
    return rounded(summary.case_state_totals(site_run(spark, sf).intervals))


@query
def identified_summary(spark, sf):
    cases = discovered(spark, sf)
    return rounded(summary.attach_identifiers(wide(spark, sf), cases).select(
        "Site", "PtId", "Pt", "CaseFolder", "MRITotal", "ProcedureTotal", "TotalMinutes"))


@query
def filled_phases(spark, sf):
    """A summary that lacks a state, filled up."""
    return rounded(summary.fill_phases(wide(spark, sf).drop("Paused"))).select(*KEYS, "Pt", "Paused", "Treating")


@query
def localization_summary(spark, sf):
    merged = summary.merge_phases(wide(spark, sf))
    return rounded(merged.select(*KEYS, "Localization", "Treating"))


# ---- clock sanity -------------------------------------------------------------------------------

@query
def time_sanity(spark, sf):
    return rounded(sanity.time_sanity(site_run(spark, sf).labelled, largest=largest(spark, sf)))


@query
def sanity_rollup(spark, sf):
    return sanity.flag_rollup(sanity.time_sanity(site_run(spark, sf).labelled, largest=largest(spark, sf)))


@query
def time_cutoff(spark, sf):
    return rounded(sanity.time_cutoff(site_run(spark, sf).labelled, "16:30"))


@query
def cutoff_rollup(spark, sf):
    return sanity.flag_rollup(sanity.time_cutoff(site_run(spark, sf).labelled, "16:30"))


# ---- site statistics ----------------------------------------------------------------------------

@query
def state_stats(spark, sf):
    return rounded(stats.state_stats(long(spark, sf)))


@query
def phase_variability(spark, sf):
    return rounded(stats.phase_variability(long(spark, sf)))


@query
def cv_ranking(spark, sf):
    return rounded(stats.cv_ranking(stats.phase_variability(long(spark, sf))))


@query
def phase_outliers(spark, sf):
    return rounded(stats.phase_outliers(long(spark, sf), z=2.5))


@query
def phase_histogram(spark, sf):
    out = stats.phase_histogram(long(spark, sf))
    return rounded(out.withColumn("phase", safe_name(F.col("phase"))))


@query
def box_stats(spark, sf):
    return rounded(stats.box_stats(long(spark, sf), 0, 600))


@query
def box_stats_localization(spark, sf):
    merged = summary.merge_phases(stored(spark, sf))
    return rounded(stats.box_stats(summary.to_long(merged, ("Localization", "Treating", "Review"))))


@query
def implausible_cases(spark, sf):
    return rounded(stats.implausible_cases(long(spark, sf)))


@query
def longest_cases(spark, sf):
    return rounded(stats.longest_cases(wide(spark, sf)))


@query
def cohorts(spark, sf):
    out = stats.cohorts(wide(spark, sf), tables.largest_site(spark, sf)).select(*KEYS, "Pt", "cohort", "MRITotal")
    return rounded(out)


@query
def case_trend(spark, sf):
    out = stats.case_trend(summary.to_long(wide(spark, sf)), largest=tables.largest_site(spark, sf))
    return rounded(out)


@query
def describe_totals(spark, sf):
    totals = summary.to_long(stored(spark, sf), ["MRITotal"])
    return rounded(stats.describe(totals))


@query
def site_stats_doc(spark, sf):
    """Every field of every site's document, a row per phase."""
    rows = long(spark, sf)
    doc = stats.site_document(stats.phase_variability(rows), stats.phase_outliers(rows), case_table(spark, sf))
    phase = "struct<N:bigint,Mean:double,Median:double,SD:double,CV:double,Min:double,Max:double>"
    parsed = doc.select("site_code", F.from_json(
        "document", f"site string, n_cases bigint, phases map<string,{phase}>, outliers struct<n_outliers:bigint,z_threshold:double>").alias("d"))
    return rounded(parsed.select(
        F.col("d.site").alias("site_code"), "d.n_cases", "d.outliers.n_outliers", "d.outliers.z_threshold",
        F.explode_outer("d.phases").alias("phase", "s"),
    ).select("site_code", "n_cases", "n_outliers", "z_threshold", "phase", "s.*"))


# ---- timeline -----------------------------------------------------------------------------------

@query
def timeline_rows(spark, sf):
    return timeline_of(spark, sf).select(
        *KEYS, "timestamp", "state", "start_us", "duration_us", "color", "row_number", flags())


@query
def timeline_states(spark, sf):
    return timeline.state_order(timeline_of(spark, sf))


@query
def timeline_normalized(spark, sf):
    return rounded(timeline.normalized_timeline(stored_timeline(spark, sf), tables.largest_site(spark, sf)))


@query
def timeline_clock(spark, sf):
    return rounded(timeline.clock_timeline(timeline_of(spark, sf)))


@query
def clock_ticks(spark, sf):
    return timeline.clock_ticks(timeline.clock_timeline(timeline_of(spark, sf)))


@query
def axis_window(spark, sf):
    return rounded(timeline.axis_window(stored_timeline(spark, sf)))


@query
def midnight_crossings(spark, sf):
    return timeline.midnight_crossings(timeline_of(spark, sf))


@query
def timeline_warnings(spark, sf):
    return warnings.timeline_warnings(site_run(spark, sf, materialize=True).intervals)


@query
def script_timeline(spark, sf):
    return rounded(timeline.script_timeline(durable(script_run(spark, sf).timed), largest=tables.largest_site(spark, sf)).drop("ts_us"))


@query
def stacked_layout(spark, sf):
    return rounded(timeline.stacked_layout(wide(spark, sf)))


@query
def stacked_bars(spark, sf):
    return rounded(timeline.stacked_layout(wide(spark, sf), keep_empty=True).drop("color", "ordinal"))


# ---- what-if schedule ---------------------------------------------------------------------------

@query
def schedule_projection(spark, sf):
    return rounded(schedule.schedule_projection(wide(spark, sf)))


@query
def schedule_risk(spark, sf):
    return rounded(schedule.schedule_risk(schedule.schedule_projection(stored(spark, sf))))


@query
def schedule_bootstrap(spark, sf):
    days = schedule.bootstrap_days(stored(spark, sf), cases=case_table(spark, sf))
    return rounded(schedule.schedule_risk(days))


# ---- diagnostics --------------------------------------------------------------------------------

@query
def run_diagnostics(spark, sf):
    run = full_run(spark, sf)
    return diagnostics.site_diagnostics(warnings.interval_facts(run.intervals), run.other_warnings)


@query
def quality_flag_counts(spark, sf):
    return diagnostics.quality_flag_counts(site_run(spark, sf).intervals)


@query
def warning_top(spark, sf):
    return diagnostics.top_warnings(full_run(spark, sf, materialize=True).warnings)


@query
def case_discovery(spark, sf):
    cases = discovered(spark, sf)
    return cases.select(*KEYS, "discovery_order", *[F.concat_ws("|", c).alias(c) for c in ("databases", "zips", "warnings")])


@query
def case_manifest(spark, sf):
    return sinks.case_manifest(discovered(spark, sf))


@query
def first_cases(spark, sf):
    cases = discovered(spark, sf)
    return listing.first_cases(cases, n=20, suffix="3").select(*KEYS, "discovery_order")


@query
def source_resolution(spark, sf):
    found = listing.resolve_sources(discovered(spark, sf))
    return found.select(
        *KEYS, "status", "source_type", "resolution_rule", "source_path",
        F.concat_ws("|", "ambiguous_candidates").alias("ambiguous_candidates"))


@query
def source_first_match(spark, sf):
    found = listing.resolve_sources(discovered(spark, sf), policy="first")
    return found.select(*KEYS, "status", "source_path")


def results(spark, sf) -> DataFrame:
    """Two passes over the log: one for the facts of each case, one for its intervals."""
    run = site_run(spark, sf)
    cases = discovered(spark, sf)
    sources = listing.resolve_sources(cases)
    facts = durable(normalize.log_facts(run.raw))
    stages = diagnostics.stage_counts({
        "timing_log_entry_count": run.timing_sheet,
        "session_synthetic_count": enrich.session_events(run.sessions),
        "timing_log_synthetic_count": enrich.timing_log_events(run.timing_sheet),
    })
    counts = facts.select(*KEYS, "raw_event_count", "normalized_event_count", "dropped_event_count")
    rows = warnings.interval_facts(run.intervals).select(*KEYS, *[f"{n}_count" for n in (
        "enriched_event", "state_labeled_event", "state_interval", "state_warning", "timing_warning", "plot_warning")])
    counts = counts.join(stages, KEYS, "left").join(rows, KEYS, "left")
    errors = facts.filter("error IS NOT NULL").select(*KEYS, "error")
    found = diagnostics.case_results(sources, errors, facts, counts, YEARS)
    return found.join(sources.select(*KEYS, "discovery_order"), KEYS)


@query
def case_results(spark, sf):
    return results(spark, sf)


@query
def run_manifest(spark, sf):
    return diagnostics.run_manifest(results(spark, sf))


@query
def state_labeled_export(spark, sf):
    """Labelled events in the export contract, payload joined back from the enriched rows."""
    run = site_run(spark, sf)
    rows = sinks.with_payload(run.labelled, run.enrich(with_payload=True))
    return sinks.export_columns(rows, sinks.STATE_LABELED)


@query
def normalized_export(spark, sf):
    return sinks.export_columns(site_run(spark, sf).normalized, sinks.NORMALIZED)


@query
def enriched_export(spark, sf):
    return sinks.export_columns(site_run(spark, sf).enrich(with_payload=True), sinks.ENRICHED)
