"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.ctes import CASE, POST, query
from oracle.fixed import MRI_STATES, PHASE_GROUPS, PLOT_STATES, STATE_NAMES

WARNING = "site_code, case_id, category, row_number, detail"
EVENT = "site_code, case_id, ts AS timestamp, event_type, source, source_detail, row_number"


def q(text: str) -> str:
    return '"' + text + '"'


def names(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def summary(source: str, condition: str = "TRUE", total: bool = True) -> str:
    def minutes(states=None):
        filt = "" if states is None else f" FILTER (state IN ({names(states)}))"
        return f"round(coalesce(sum(duration_us){filt}, 0) / 60000000.0::DOUBLE, 6)"

    columns = [f"{minutes([s])} AS {q(s)}" for s in STATE_NAMES]
    columns += [f"{minutes(MRI_STATES)} AS MRITotal", f"{minutes((*STATE_NAMES[:2], *MRI_STATES))} AS ProcedureTotal"]
    if total:
        columns.append(f"{minutes()} AS TotalMinutes")
    return (f"SELECT site_code, case_id, {', '.join(columns)} FROM {source} "
            f"WHERE state IS NOT NULL AND {condition} GROUP BY site_code, case_id")


def box(source: str, condition: str) -> str:
    return f"""
        SELECT site_code, phase, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
          round(least(min(minutes) FILTER (minutes BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), any_value(q1)), 6) AS whisker_lo,
          round(greatest(max(minutes) FILTER (minutes BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), any_value(q3)), 6) AS whisker_hi,
          count(*) FILTER (minutes NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM (SELECT *, quantile_cont(minutes, 0.25) OVER g AS q1, quantile_cont(minutes, 0.5) OVER g AS med, quantile_cont(minutes, 0.75) OVER g AS q3
              FROM {source} WHERE {condition} WINDOW g AS (PARTITION BY site_code, phase)) GROUP BY site_code, phase"""


LOCALIZED = """(SELECT site_code, case_id, CASE WHEN phase IN ('Coarse', 'Detailed') THEN 'Localization' ELSE phase END AS phase, sum(minutes) AS minutes
    FROM c_long WHERE phase IN ('Coarse', 'Detailed', 'Treating', 'Review') GROUP BY ALL)"""

SANITY = """
    SELECT f.site_code, f.case_id, n_events, make_timestamp(f) AS first_ts, make_timestamp(l) AS last_ts, round((l - f) / 60000000.0::DOUBLE, 6) AS duration_min,
      any_after_noon, f % 86400000000 < 43200000000 AND l % 86400000000 >= 43200000000 AS crossed_noon,
      CAST(make_timestamp(f) AS DATE) <> CAST(make_timestamp(l) AS DATE) AS multi_day_log,
      coalesce(b.worst < 0, FALSE) AS has_non_monotonic, coalesce(b.worst, 0) / 1000000.0::DOUBLE AS max_backward_sec,
      make_timestamp(pf) AS proc_first_ts, make_timestamp(pl) AS proc_last_ts, round((pl - pf) / 60000000.0::DOUBLE, 6) AS proc_duration_min,
      proc_any_after_noon, coalesce(pf % 86400000000 < 43200000000 AND pl % 86400000000 >= 43200000000, FALSE) AS proc_crossed_noon,
      coalesce(CAST(make_timestamp(pf) AS DATE) <> CAST(make_timestamp(pl) AS DATE), FALSE) AS proc_multi_day
    FROM (SELECT site_code, case_id, count(*) AS n_events, min(ts_us) AS f, max(ts_us) AS l, bool_or(ts_us % 86400000000 >= 43200000000) AS any_after_noon,
            min(ts_us) FILTER (state IS NOT NULL) AS pf, max(ts_us) FILTER (state IS NOT NULL) AS pl,
            coalesce(bool_or(ts_us % 86400000000 >= 43200000000) FILTER (state IS NOT NULL), FALSE) AS proc_any_after_noon
          FROM c_labelled GROUP BY site_code, case_id) f
    LEFT JOIN (SELECT site_code, case_id, least(min(step), 0) AS worst FROM (
            SELECT site_code, case_id, ts_us - lag(ts_us) OVER (PARTITION BY site_code, case_id ORDER BY row_number) AS step
            FROM c_labelled WHERE row_number IS NOT NULL) GROUP BY site_code, case_id) b
      ON b.site_code = f.site_code AND b.case_id = f.case_id"""

CUTOFF = """
    SELECT site_code, case_id, make_timestamp(f) AS proc_first_ts, make_timestamp(l) AS proc_last_ts, round((l - f) / 60000000.0::DOUBLE, 6) AS proc_duration_min,
      any_after_cutoff, coalesce(f % 86400000000 < 59400000000 AND l % 86400000000 >= 59400000000, FALSE) AS crossed_cutoff
    FROM (SELECT site_code, case_id, min(ts_us) FILTER (state IS NOT NULL) AS f, max(ts_us) FILTER (state IS NOT NULL) AS l,
            coalesce(bool_or(ts_us % 86400000000 >= 59400000000) FILTER (state IS NOT NULL), FALSE) AS any_after_cutoff
          FROM c_labelled GROUP BY site_code, case_id)"""

VARIABILITY = """
    SELECT site_code, phase, count(*) AS n, round(avg(minutes), 6) AS mean, round(stddev_samp(minutes), 6) AS sd, round(min(minutes), 6) AS min,
      round(max(minutes), 6) AS max, round(CASE WHEN avg(minutes) > 0 THEN stddev_samp(minutes) / avg(minutes) END, 6) AS cv,
      round(quantile_cont(minutes, 0.5), 6) AS median
    FROM c_capped GROUP BY site_code, phase"""


def clock(minutes: str) -> str:
    whole = f"CAST(round_even({minutes}, 0) AS BIGINT)"
    return (f"CASE WHEN {whole} < 0 THEN '-' ELSE '' END || lpad(CAST(abs({whole}) % 1440 // 60 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(abs({whole}) % 1440 % 60 AS VARCHAR), 2, '0')")


DAY0 = 1735689600000000 + 27000000000
PHASE_OF = {"align": "Alignment", "coarse": "Coarse", "detailed": "Detailed", "plan": "Planning start angle",
            "treat": "Treating", "paused": "Paused", "post": POST.strip("'")}
BLOCKS = [("anest", "900000000"), ("gap", "900000000"), ("insert", "2700000000"), ("align", None), ("coarse", None), ("detailed", None),
          ("plan", None), ("treat", None), ("paused", None), ("plan2", "1200000000"), ("treat2", "3600000000"), ("post", None)]
LENGTHS = "SELECT site_code, case_id, " + ", ".join(
    f"coalesce(sum(duration_us) FILTER (state = '{p}'), 0) AS {b}_us" for b, p in PHASE_OF.items()
) + " FROM c_intervals WHERE state IS NOT NULL GROUP BY site_code, case_id"


def projection(source: str, keep: str = "") -> str:
    at, columns, post_end, align_start = str(DAY0), [], "", ""
    for block, fixed in BLOCKS:
        end = f"{at} + {fixed or block + '_us'}"
        if block != "gap":
            columns += [f"make_timestamp(CAST({at} AS BIGINT)) AS {block}_start", f"make_timestamp(CAST({end} AS BIGINT)) AS {block}_end"]
        align_start = at if block == "align" else align_start
        at = end
    cutoff = 1735689600000000 + 43200000000
    return (f"SELECT site_code, case_id, {keep} {', '.join(columns)}, round((({at}) % 86400000000 // 1000000) / 60.0::DOUBLE, 6) AS post_end_minutes, "
            f"{at} >= {cutoff} AS case_ends_after_cutoff, {at} >= {cutoff} AND {align_start} < {cutoff} AS case_crosses_cutoff FROM ({source})")


def risk(source: str) -> str:
    return f"""
        SELECT site_code, '12:00' AS cutoff, count(*) AS n_days, round(avg(CAST(case_ends_after_cutoff AS INTEGER)), 6) AS prob_ends_after_cutoff,
          round(avg(CAST(case_crosses_cutoff AS INTEGER)), 6) AS prob_crosses_cutoff, round(avg(sec) / 60, 6) AS end_min_mean,
          round(stddev_samp(sec / 60.0::DOUBLE), 6) AS end_min_std,
          {', '.join(f"round(quantile_cont(sec::DOUBLE, {p / 100}) / 60, 6) AS end_min_p{p:02d}" for p in (5, 25, 50, 75, 95))}
        FROM (SELECT *, hour(post_end) * 3600 + minute(post_end) * 60 + second(post_end) AS sec FROM ({source})) GROUP BY site_code"""


BOOTSTRAP = f"""
    SELECT l.*, d.day FROM (SELECT *, row_number() OVER (PARTITION BY site_code ORDER BY case_id) AS ordinal FROM ({LENGTHS})) l
    JOIN (SELECT site_code, day, (((day * 1103515245 + 24690) % 2147483648 * 1103515245 + 12345) % 2147483648 * n) // 2147483648 + 1 AS ordinal
          FROM (SELECT site_code, count(DISTINCT case_id) AS n FROM c_phase_us GROUP BY site_code), range(10000) r(day)) d
      ON d.site_code = l.site_code AND d.ordinal = l.ordinal"""

PROCESSED = "s.status = 'resolved' AND e.error IS NULL AND y.case_year = 2024"
COUNTS = {
    "raw_event_count": "c_raw", "normalized_event_count": "(SELECT * FROM c_norm WHERE event_type <> 'SignalRecord')",
    "dropped_event_count": "(SELECT * FROM c_norm WHERE event_type = 'SignalRecord')", "timing_log_entry_count": "c_sheet",
    "session_synthetic_count": "c_session_events", "enriched_event_count": "c_enriched", "state_labeled_event_count": "c_labelled",
    "timing_log_synthetic_count": "c_timing_events", "state_interval_count": "c_intervals", "state_warning_count": "c_state_warnings",
    "timing_warning_count": "c_interval_warnings", "plot_warning_count": "c_timeline_warnings",
}
RESULTS = f"""
    SELECT s.site_code, s.case_id,
      CASE WHEN s.status = 'no_candidates' THEN 'skipped_no_database_candidates' WHEN s.status <> 'resolved' THEN 'failed'
           WHEN coalesce(y.case_year, 0) <> 2024 THEN 'skipped_year_filter' WHEN e.error IS NOT NULL THEN 'failed' ELSE 'processed' END AS status,
      CASE WHEN s.status = 'ambiguous' THEN 'ambiguous' WHEN s.status = 'resolved' AND y.case_year = 2024 THEN e.error END AS error,
      CASE WHEN {PROCESSED} THEN CASE WHEN n_db > 0 THEN 'unzipped' ELSE 'zip_extracted' END END AS source_type,
      CASE WHEN {PROCESSED} THEN CASE WHEN n_db > 0 THEN databases ELSE zips END END AS source_path, discovery_order,
      {', '.join(f"CASE WHEN {PROCESSED} THEN coalesce(k{i}.n, 0) END AS {c}" for i, c in enumerate(COUNTS))}
    FROM c_sources s LEFT JOIN c_errors e ON e.site_code = s.site_code AND e.case_id = s.case_id
    LEFT JOIN (SELECT site_code, case_id, TRY_CAST(raw_timestamp[1:4] AS INTEGER) AS case_year FROM c_raw WHERE row_number = 1) y
      ON y.site_code = s.site_code AND y.case_id = s.case_id
    {' '.join(f"LEFT JOIN (SELECT site_code, case_id, count(*) AS n FROM {t} GROUP BY site_code, case_id) k{i} ON k{i}.site_code = s.site_code AND k{i}.case_id = s.case_id" for i, t in enumerate(COUNTS.values()))}"""

STATEMENTS: dict[str, str] = {
    "normalized_events": "SELECT site_code, case_id, row_number, ts AS timestamp, event_type, segment_id, event_kind, 'auditlog' AS source FROM c_norm WHERE event_type <> 'SignalRecord'",
    "dropped_events": "SELECT site_code, case_id, row_number, event_type, 'filtered_signal_record' AS drop_reason FROM c_norm WHERE event_type = 'SignalRecord'",
    "case_errors": "SELECT * FROM c_errors",
    "event_type_counts": "SELECT event_type, count(*) AS n_events FROM c_norm GROUP BY event_type",
    "event_kind_counts": "SELECT event_kind, count(*) AS n_events FROM c_norm GROUP BY event_kind",
    "year_selected_cases": """SELECT site_code, case_id, count(*) AS n_rows FROM c_raw
        WHERE (site_code, case_id) IN (SELECT (site_code, case_id) FROM c_raw WHERE row_number = 1 AND starts_with(raw_timestamp, '2024')) GROUP BY site_code, case_id""",
    "lenient_time_quality": "SELECT site_code, count(*) AS n_rows, count(*) FILTER (ts IS NULL) AS n_bad FROM c_typed GROUP BY site_code",
    "inferred_ids": """SELECT b.site_code, b.case_id, coalesce(max(r.patient_id),
        CASE WHEN user_id % 8 = 2 THEN 'Q' || user_id WHEN user_id % 8 = 3 THEN 'N' || user_id END, b.case_id) AS inferred_id
        FROM c_bases b JOIN c_raw r ON r.site_code = b.site_code AND r.case_id = b.case_id GROUP BY b.site_code, b.case_id, user_id""",
    "matching_events": """SELECT site_code, case_id, row_number, ts AS timestamp, event_type, nth FROM (SELECT *, row_number() OVER (PARTITION BY site_code ORDER BY ts_us, case_id, row_number) AS nth
        FROM c_norm WHERE event_type LIKE '%Treat%')""",
    "session_events": "SELECT site_code, case_id, ts AS timestamp, event_type, source_detail FROM c_session_events",
    "session_field_stats": "SELECT * FROM c_field_stats",
    "session_warnings": f"SELECT {WARNING} FROM c_session_warnings",
    "timing_log_events": "SELECT site_code, case_id, ts AS timestamp, event_type, source_detail FROM c_timing_events",
    "timing_log_unmapped": "SELECT site_code, case_id, row_number, label FROM c_sheet WHERE label NOT IN (SELECT label FROM c_labels)",
    "timing_log_warnings": f"SELECT {WARNING} FROM c_timing_warnings",
    "enriched_events": f"SELECT {EVENT}, is_synthetic, segment_id, event_kind, insertion_rule FROM c_enriched",
    "injected_session_events": "SELECT * EXCLUDE (treatment) FROM c_injected",
    "state_labeled_events": f"SELECT {EVENT}, state, state_assignment_rule, cleanup_rule_applied FROM c_labelled",
    "unmapped_critical": "SELECT * FROM c_unmapped",
    "stateless_types": "SELECT event_type, count(*) AS n_events FROM c_labelled WHERE state IS NULL GROUP BY event_type",
    "state_warnings": f"SELECT {WARNING} FROM c_state_warnings",
    "state_labeled_script": "SELECT site_code, case_id, row_number, ts AS timestamp, event_type, state FROM c_sc_f",
    "setup_adjusted_script": "SELECT site_code, case_id, row_number, ts AS timestamp, event_type, state, rebase_anchor FROM c_adjusted",
    "script_times": "SELECT site_code, case_id, row_number, ts AS timestamp, event_type, state, start_us / 1000000.0::DOUBLE AS start_sec, duration_us / 1000000.0::DOUBLE AS duration_sec, first_us, last_us FROM c_timed",
    "review_tail": f"""SELECT l.site_code, l.case_id, l.ts AS timestamp, event_type, source, source_detail, row_number,
        CASE WHEN pos >= CASE WHEN pt IS NOT NULL THEN pt WHEN rv IS NOT NULL THEN least(rv, greatest(n - 2, 0)) END THEN 'NA'
             WHEN event_type = 'ReviewWorkflowRecord' AND ts_us - rv_us > 1800000000 THEN 'NA' ELSE state END AS state
        FROM c_labelled l JOIN (SELECT site_code, case_id, min(pos) FILTER (event_type = 'PatientTransferEnds') AS pt, min(pos) FILTER (event_type = 'ReviewWorkflowRecord') AS rv,
            min(ts_us) FILTER (event_type = 'ReviewWorkflowRecord') AS rv_us, count(*) AS n FROM c_labelled GROUP BY site_code, case_id) m
        ON m.site_code = l.site_code AND m.case_id = l.case_id""",
    "rebase_anchors": "SELECT site_code, case_id, rebase_anchor, (anchor_us - first_us) / 1000000.0::DOUBLE AS anchor_sec, anchor_warning FROM c_cases",
    "case_end": "SELECT site_code, case_id, end_pos, end_us, end_row, end_state, n_rows FROM c_cases",
    "state_intervals": f"SELECT {EVENT}, state, start_us / 1000000.0::DOUBLE AS start_sec, duration_us / 1000000.0::DOUBLE AS duration_sec, rebase_anchor, flags AS quality_flags FROM c_intervals",
    "state_intervals_arrival": """SELECT i.site_code, i.case_id, row_number, event_type, state, duration_us / 1000000.0::DOUBLE AS duration_sec, non_monotonic, reordered
        FROM c_log_intervals i JOIN (SELECT site_code, case_id, bool_or(coalesce(prev_us > ts_us, FALSE)) AS non_monotonic, bool_or(nth <> pos) AS reordered
          FROM (SELECT *, lag(ts_us) OVER w AS prev_us, row_number() OVER w - 1 AS nth FROM c_log_intervals WINDOW w AS (PARTITION BY site_code, case_id ORDER BY row_number))
          GROUP BY site_code, case_id) o ON o.site_code = i.site_code AND o.case_id = i.case_id""",
    "interval_warnings": f"SELECT {WARNING} FROM c_interval_warnings",
    "relative_times": f"""SELECT site_code, case_id, row_number, (ts_us - min(ts_us) OVER (PARTITION BY {CASE})) / 1000000.0::DOUBLE AS start_sec,
        coalesce(lead(ts_us) OVER (PARTITION BY {CASE} ORDER BY ts_us, row_number) - ts_us, 0) / 1000000.0::DOUBLE AS duration_sec FROM c_norm WHERE event_type <> 'SignalRecord'""",
    "interval_export": """SELECT site_code, case_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, coalesce(state, '') AS state, start_us / 1000000.0::DOUBLE AS start_sec,
        duration_us / 1000000.0::DOUBLE AS duration_sec, rebase_anchor, event_type AS origin_event_type, source, is_synthetic, source_detail, row_number,
        coalesce(state_assignment_rule, '') AS state_assignment_rule, cleanup_rule_applied, flags AS quality_flags, coalesce(segment_id, '') AS segment_id, event_kind,
        '' AS drop_reason, coalesce(insertion_rule, '') AS insertion_rule, raw_payload AS raw_payload_json FROM c_intervals""",
    "timing_summary": summary("c_intervals"),
    "timing_summary_positive": summary("c_intervals", "duration_us > 0", total=False),
    "timing_summary_filtered": summary("c_intervals", "duration_us < 21600000000"),
    "timing_summary_script": summary("c_timed", "duration_us < 21600000000"),
    "phase_groups": "SELECT site_code, case_id, " + ", ".join(
        f"round(coalesce(sum(phase_us) FILTER (state IN ({names(states)})), 0) / 60000000.0::DOUBLE, 6) AS {g}" for g, states in PHASE_GROUPS.items()
    ) + " FROM c_phase_us GROUP BY site_code, case_id",
    "case_state_totals": "SELECT site_code, case_id, state, round(phase_us / 60000000.0::DOUBLE, 6) AS minutes FROM c_phase_us",
    "identified_summary": f"""SELECT s.site_code AS Site, s.case_id AS PtId, d.discovery_order AS Pt, s.site_code || '/' || s.case_id AS CaseFolder, MRITotal, ProcedureTotal, TotalMinutes
        FROM ({summary('c_intervals')}) s JOIN c_discovered d ON d.site_code = s.site_code AND d.case_id = s.case_id""",
    "localization_summary": """SELECT site_code, case_id, round(sum(minutes) FILTER (phase IN ('Coarse', 'Detailed')), 6) AS Localization,
        round(sum(minutes) FILTER (phase = 'Treating'), 6) AS Treating FROM c_long GROUP BY site_code, case_id""",
    "time_sanity": SANITY,
    "sanity_rollup": f"""SELECT site_code, count(*) AS n_cases, {', '.join(f'count(*) FILTER ({c}) AS n_{c}' for c in (
        'any_after_noon', 'crossed_noon', 'multi_day_log', 'has_non_monotonic', 'proc_any_after_noon', 'proc_crossed_noon', 'proc_multi_day'))} FROM ({SANITY}) GROUP BY site_code""",
    "time_cutoff": CUTOFF,
    "cutoff_rollup": f"SELECT site_code, count(*) AS n_cases, count(*) FILTER (any_after_cutoff) AS n_any_after_cutoff, count(*) FILTER (crossed_cutoff) AS n_crossed_cutoff FROM ({CUTOFF}) GROUP BY site_code",
    "state_stats": """SELECT site_code, phase, count(*) AS n, round(avg(minutes), 6) AS mean, round(stddev_samp(minutes), 6) AS std, round(quantile_cont(minutes, 0.5), 6) AS median
        FROM c_capped WHERE minutes <> 0 GROUP BY site_code, phase""",
    "phase_variability": VARIABILITY,
    "cv_ranking": """SELECT site_code, phase, round(cv, 6) AS cv, row_number() OVER (PARTITION BY site_code ORDER BY cv DESC, phase) AS cv_rank
        FROM (SELECT site_code, phase, CASE WHEN avg(minutes) > 0 THEN stddev_samp(minutes) / avg(minutes) END AS cv FROM c_capped GROUP BY ALL) WHERE cv IS NOT NULL""",
    "phase_outliers": """SELECT site_code, phase, case_id, round(minutes, 6) AS minutes, round(mean, 6) AS mean, round(sd, 6) AS sd, round((minutes - mean) / sd, 6) AS z
        FROM (SELECT *, avg(minutes) OVER g AS mean, stddev_samp(minutes) OVER g AS sd FROM c_capped WINDOW g AS (PARTITION BY site_code, phase)) WHERE sd > 0 AND abs((minutes - mean) / sd) >= 2.5""",
    "phase_histogram": """SELECT e.site_code, regexp_replace(regexp_replace(e.phase, '\\s+', '_', 'g'), '[^0-9A-Za-z_]', '', 'g') AS phase, e.bin,
          round(lo + e.bin * ((hi - lo) / 20), 6) AS bin_lo, round(lo + (e.bin + 1) * ((hi - lo) / 20), 6) AS bin_hi, coalesce(n, 0) AS n_cases
        FROM (SELECT g.*, CAST(b AS INTEGER) AS bin FROM (SELECT site_code, phase, CASE WHEN min(minutes) = max(minutes) THEN min(minutes) - 0.5 ELSE min(minutes) END AS lo,
                CASE WHEN min(minutes) = max(minutes) THEN max(minutes) + 0.5 ELSE max(minutes) END AS hi FROM c_capped WHERE minutes > 0 GROUP BY ALL) g, range(20) r(b)) e
        LEFT JOIN (SELECT m.site_code, m.phase, least(CAST(floor((minutes - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin, count(*) AS n
          FROM c_capped m JOIN (SELECT site_code, phase, CASE WHEN min(minutes) = max(minutes) THEN min(minutes) - 0.5 ELSE min(minutes) END AS lo,
                CASE WHEN min(minutes) = max(minutes) THEN max(minutes) + 0.5 ELSE max(minutes) END AS hi FROM c_capped WHERE minutes > 0 GROUP BY ALL) g
            ON g.site_code = m.site_code AND g.phase = m.phase WHERE minutes > 0 GROUP BY ALL) c
          ON c.site_code = e.site_code AND c.phase = e.phase AND c.bin = e.bin""",
    "box_stats": box("c_long", "minutes BETWEEN 0 AND 600"),
    "box_stats_localization": box(LOCALIZED, "TRUE"),
    "implausible_cases": "SELECT site_code, case_id, phase, round(minutes, 6) AS minutes FROM c_capped WHERE phase = 'Treating' AND minutes NOT BETWEEN 1 AND 240",
    "longest_cases": f"""SELECT site_code, case_id, MRITotal AS minutes, rank FROM (SELECT *, row_number() OVER (PARTITION BY site_code ORDER BY MRITotal DESC, case_id) AS rank
        FROM ({summary('c_intervals')})) WHERE rank <= 5""",
    "cohorts": f"""SELECT site_code, case_id, Pt, CASE WHEN Pt <= 50 THEN '1-50' WHEN Pt <= 75 THEN '51-75' ELSE '76+' END AS cohort, MRITotal
        FROM (SELECT *, row_number() OVER (PARTITION BY site_code ORDER BY case_id) AS Pt FROM ({summary('c_intervals')}))""",
    "case_trend": "SELECT site_code, case_id, phase, round(minutes, 6) AS minutes, row_number() OVER (PARTITION BY site_code, phase ORDER BY case_id) AS case_index FROM c_capped",
    "describe_totals": f"""SELECT site_code, count(*) AS count, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS std, round(min(m), 6) AS min, round(max(m), 6) AS max,
        round(quantile_cont(m, 0.25), 6) AS p25, round(quantile_cont(m, 0.5), 6) AS p50, round(quantile_cont(m, 0.75), 6) AS p75
        FROM (SELECT site_code, case_id, sum(minutes) FILTER (phase IN ({names(MRI_STATES)})) AS m FROM c_long GROUP BY ALL) GROUP BY site_code""",
    "site_stats_doc": """SELECT b.site_code, b.n AS n_cases, coalesce(o.n, 0) AS n_outliers, 3.0::DOUBLE AS z_threshold, v.* EXCLUDE (site_code)
        FROM (SELECT site_code, count(*) AS n FROM c_bases GROUP BY site_code) b
        LEFT JOIN (SELECT site_code, count(*) AS n FROM (SELECT *, avg(minutes) OVER g AS mean, stddev_samp(minutes) OVER g AS sd FROM c_capped WINDOW g AS (PARTITION BY site_code, phase))
            WHERE sd > 0 AND abs((minutes - mean) / sd) >= 3 GROUP BY site_code) o ON o.site_code = b.site_code
        LEFT JOIN (SELECT site_code, phase, count(*) AS N, round(avg(minutes), 6) AS Mean, round(quantile_cont(minutes, 0.5), 6) AS Median, round(stddev_samp(minutes), 6) AS SD,
            round(CASE WHEN avg(minutes) > 0 THEN stddev_samp(minutes) / avg(minutes) END, 6) AS CV, round(min(minutes), 6) AS Min, round(max(minutes), 6) AS Max
          FROM c_capped GROUP BY site_code, phase) v ON v.site_code = b.site_code""",
    "timeline_rows": "SELECT site_code, case_id, ts AS timestamp, state, start_us, duration_us, color, row_number, flags AS quality_flags FROM c_plot",
    "timeline_states": "SELECT site_code, state, row_number() OVER (PARTITION BY site_code ORDER BY ordinal) AS state_order FROM (SELECT DISTINCT site_code, state, ordinal FROM c_plot)",
    "timeline_normalized": """SELECT p.site_code, p.case_id, y, state, color, row_number, ts_us, event_type, round(start_us / 60000000.0::DOUBLE, 6) AS start_min,
        round(duration_us / 60000000.0::DOUBLE, 6) AS duration_min FROM c_plot p JOIN (SELECT site_code, case_id, row_number() OVER (PARTITION BY site_code ORDER BY case_id) - 1 AS y
        FROM (SELECT DISTINCT site_code, case_id FROM c_plot)) o ON o.site_code = p.site_code AND o.case_id = p.case_id""",
    "timeline_clock": f"""SELECT site_code, case_id, state, color, row_number, ts_us, event_type, round(a, 6) AS start_minute, round(b, 6) AS end_minute,
        {clock('a')} AS start_label, {clock('b')} AS end_label FROM (SELECT *, ts_us % 86400000000 / 60000000.0::DOUBLE AS a, (ts_us % 86400000000 + duration_us) / 60000000.0::DOUBLE AS b FROM c_plot)""",
    "clock_ticks": f"""SELECT site_code, spacing, t AS tick_minute, {clock('t::DOUBLE')} AS tick_label FROM (
        SELECT site_code, spacing, unnest(range(CAST(floor(lo / spacing) * spacing AS BIGINT), CAST(ceil(hi / spacing) * spacing AS BIGINT) + 1, spacing)) AS t
        FROM (SELECT *, CAST(CASE WHEN hi - lo <= 360 THEN 30 ELSE 60 END AS BIGINT) AS spacing FROM (SELECT site_code, min(ts_us % 86400000000) / 60000000.0::DOUBLE AS lo,
            max(ts_us % 86400000000 + duration_us) / 60000000.0::DOUBLE AS hi FROM c_plot GROUP BY site_code)))""",
    "axis_window": """SELECT site_code, round(lo, 6) AS lower_sec, round(CASE WHEN hi <= lo THEN lo + 600 ELSE hi END, 6) AS upper_sec FROM (
        SELECT site_code, quantile_cont(us::DOUBLE, 0.01) / 1000000 - 300 AS lo, quantile_cont(us::DOUBLE, 0.99) / 1000000 + 300 AS hi
        FROM (SELECT site_code, start_us AS us FROM c_plot UNION ALL SELECT site_code, start_us + duration_us FROM c_plot) GROUP BY site_code)""",
    "midnight_crossings": "SELECT site_code, case_id, row_number, event_type, ts AS start_ts, make_timestamp(ts_us + duration_us) AS end_ts FROM c_midnight",
    "timeline_warnings": f"SELECT {WARNING} FROM c_timeline_warnings",
    "script_timeline": """SELECT t.site_code, t.case_id, nth - 1 AS y, t.state, ordinal, row_number, event_type, round(start_us / 60000000.0::DOUBLE, 6) AS start_min, round(duration_us / 60000000.0::DOUBLE, 6) AS dur_min
        FROM c_timed t JOIN (SELECT site_code, case_id, row_number() OVER (PARTITION BY site_code ORDER BY case_id) AS nth FROM (SELECT DISTINCT site_code, case_id FROM c_timed WHERE duration_us > 0)) n
          ON n.site_code = t.site_code AND n.case_id = t.case_id LEFT JOIN c_states s ON s.state = t.state WHERE duration_us > 0""",
    "stacked_layout": f"""SELECT site_code, case_id, phase, ordinal, color, round(coalesce(sum(minutes) OVER (PARTITION BY {CASE} ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_min,
        round(minutes, 6) AS duration_min FROM c_long WHERE minutes > 0 AND phase <> 'NA'""",
    "stacked_bars": f"""SELECT site_code, case_id, phase, round(coalesce(sum(minutes) OVER (PARTITION BY {CASE} ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_min,
        round(minutes, 6) AS duration_min FROM c_long WHERE phase <> 'NA'""",
    "schedule_projection": projection(LENGTHS),
    "schedule_risk": risk(projection(LENGTHS)),
    "schedule_bootstrap": risk(projection(BOOTSTRAP, "day,")),
    "run_diagnostics": f"""SELECT i.*, coalesce(w.n, 0) AS total_warnings FROM (SELECT site_code, max(duration_us) / 1000000.0::DOUBLE AS max_duration_sec,
        {', '.join(f'count(*) FILTER (duration_us > {s}000000) AS n_over_{s}' for s in (7200, 14400, 28800))},
        {', '.join(f"count(*) FILTER (list_contains(string_split(flags, '|'), '{f}')) AS {f}" for f in (
            'interval_truncated_large_gap', 'interval_terminal_state_clamped', 'interval_early_state_truncated', 'interval_unassigned_state_truncated', 'negative_rebased_start'))}
        FROM c_intervals JOIN c_processed USING (site_code, case_id) GROUP BY site_code) i LEFT JOIN (SELECT site_code, count(*) AS n FROM c_run_warnings GROUP BY site_code) w ON w.site_code = i.site_code""",
    "quality_flag_counts": "SELECT site_code, flag, count(*) AS n_intervals FROM (SELECT site_code, unnest(string_split(flags, '|')) AS flag FROM c_intervals WHERE flags <> '') GROUP BY ALL",
    "warning_top": """SELECT site_code, category, n_warnings, rank FROM (SELECT *, row_number() OVER (PARTITION BY site_code ORDER BY n_warnings DESC, first) AS rank
        FROM (SELECT site_code, category, count(*) AS n_warnings, min((starts_with(category, 'plot'), lower(case_id), case_id,
            CASE WHEN category = 'uncategorized' THEN -1 WHEN starts_with(category, 'session') OR starts_with(category, 'ignored_session') THEN 0
                 WHEN starts_with(category, 'timing_log_blank') THEN 1 WHEN starts_with(category, 'timing_log') THEN 2
                 WHEN starts_with(category, 'state') OR starts_with(category, 'cleanup') THEN 3
                 WHEN starts_with(category, 'interval') OR starts_with(category, 'rebase') OR starts_with(category, 'case_end') THEN 4 ELSE 5 END,
            coalesce(row_number, 0), category)) AS first FROM c_run_warnings GROUP BY site_code, category)) WHERE rank <= 8""",
    "case_discovery": """SELECT site_code, case_id, discovery_order, databases, zips, concat_ws('|', CASE WHEN n_db = 0 AND n_zip = 0 THEN 'no_database_candidates_found' END,
        CASE WHEN n_db > 1 THEN 'multiple_unzipped_database_candidates' END, CASE WHEN n_zip > 1 THEN 'multiple_zip_candidates' END) AS warnings FROM c_discovered""",
    "case_manifest": """SELECT site_code, case_id, site_code || '/' || case_id AS case_path, discovery_order, databases AS candidate_unzipped_db_paths, zips AS candidate_zip_paths,
        concat_ws('|', CASE WHEN n_db = 0 AND n_zip = 0 THEN 'no_database_candidates_found' END, CASE WHEN n_db > 1 THEN 'multiple_unzipped_database_candidates' END,
        CASE WHEN n_zip > 1 THEN 'multiple_zip_candidates' END) AS warnings FROM c_discovered""",
    "first_cases": "SELECT site_code, case_id, discovery_order FROM c_discovered WHERE discovery_order <= 20 AND ends_with(case_id, '3')",
    "state_labeled_export": """SELECT l.site_code, l.case_id, strftime(l.ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, l.event_type, l.source, l.is_synthetic, coalesce(l.segment_id, '') AS segment_id,
        l.event_kind, coalesce(state, '') AS state, coalesce(state_assignment_rule, '') AS state_assignment_rule, cleanup_rule_applied, '' AS drop_reason, l.row_number, source_detail,
        coalesce(insertion_rule, '') AS insertion_rule, raw_payload AS raw_payload_json FROM c_labelled l""",
    "aligned_logs": """SELECT site_code, case_id, row_number, raw_timestamp, raw_event_type, raw_segment_id AS SegmentId, raw_event_kind,
        CASE WHEN site_code NOT IN ('S0', 'S1') THEN raw_event_kind::DOUBLE END AS Temperature FROM c_raw""",
    "log_head": "SELECT site_code, case_id, row_number, raw_timestamp, raw_event_type, raw_segment_id FROM c_raw WHERE row_number <= 5",
    "filled_phases": f"""SELECT site_code, case_id, row_number() OVER (PARTITION BY site_code ORDER BY case_id) AS Pt, 0.0::DOUBLE AS Paused, Treating
        FROM ({summary("c_intervals")})""",
    "normalized_export": """SELECT site_code, case_id, row_number, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, event_type, coalesce(segment_id, '') AS segment_id, event_kind,
        'auditlog' AS source, event_type = 'SignalRecord' AS is_dropped, CASE WHEN event_type = 'SignalRecord' THEN 'filtered_signal_record' ELSE '' END AS drop_reason,
        raw_payload AS raw_payload_json FROM c_norm""",
    "enriched_export": """SELECT site_code, case_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, event_type, source, is_synthetic, source_detail, coalesce(segment_id, '') AS segment_id,
        event_kind, '' AS drop_reason, coalesce(insertion_rule, '') AS insertion_rule, row_number, raw_payload AS raw_payload_json FROM c_enriched""",
    "source_resolution": """SELECT site_code, case_id, status, CASE WHEN status = 'resolved' THEN CASE WHEN n_db > 0 THEN 'unzipped' ELSE 'zip_extracted' END END AS source_type,
        CASE WHEN status = 'resolved' THEN CASE WHEN n_db > 0 THEN 'unzipped_precedence' ELSE 'zip_precedence' END END AS resolution_rule,
        CASE WHEN status = 'resolved' THEN CASE WHEN n_db > 0 THEN databases ELSE zips END END AS source_path,
        CASE WHEN status = 'ambiguous' THEN CASE WHEN n_db > 0 THEN databases ELSE zips END ELSE '' END AS ambiguous_candidates FROM c_sources""",
    "source_first_match": """SELECT site_code, case_id, CASE WHEN n_db + n_zip = 0 THEN 'no_candidates' ELSE 'resolved' END AS status,
        CASE WHEN n_db + n_zip > 0 THEN split_part(CASE WHEN n_db > 0 THEN databases ELSE zips END, '|', 1) END AS source_path FROM c_sources""",
    "case_results": RESULTS,
    "run_manifest": f"""SELECT site_code, count(*) AS cases_discovered, count(*) FILTER (status = 'processed') AS cases_processed, count(*) FILTER (status = 'failed') AS cases_failed,
        count(*) FILTER (starts_with(status, 'skipped')) AS cases_skipped FROM ({RESULTS}) GROUP BY site_code""",
}


SHEET_KIND = "(SELECT *, user_id % 9 AS kind FROM c_sheet JOIN c_bases USING (site_code, case_id))"
CASE_VERSION = "CAST(case_id[6:] AS BIGINT) % 3"
VERSION_COLUMNS = {
    0: {"TimeStamp": "STRING", "AuditRecordBase_Type": "STRING", "TreatmentId": "STRING", "SignalHelpKey": "STRING"},
    1: {"TimeStamp": "STRING", "AuditRecordBase_Type": "STRING", "SegmentId": "STRING", "EventKind": "BIGINT"},
    2: {"TimeStamp": "STRING", "AuditRecordBase_Type": "STRING", "SegmentId": "STRING", "EventKind": "BIGINT", "Temperature": "DECIMAL"},
}
CATALOG = " UNION ALL ".join(
    f"""SELECT site_code, case_id, '{column}' AS "column", {f"CASE WHEN count(raw_segment_id) = 0 THEN 'VOID' ELSE '{kind}' END" if column in ('SegmentId', 'TreatmentId') else f"'{kind}'"} AS type,
        count(*) AS n_rows, {"count(*) - count(raw_segment_id)" if column in ('SegmentId', 'TreatmentId') else "0"} AS n_null FROM c_raw WHERE {CASE_VERSION} = {v} GROUP BY site_code, case_id"""
    for v, columns in VERSION_COLUMNS.items() for column, kind in columns.items())
# Per zone and half of the year the first and the last skipped or repeated minute, and hours to UTC before and after.
CHANGES = "(VALUES ('America/New_York', 0, 120, 180, 5, 4), ('America/New_York', 1, 60, 120, 4, 5), ('Europe/Berlin', 0, 120, 180, -1, -2), ('Europe/Berlin', 1, 120, 180, -2, -1)) z(zone, half, lo, hi, h0, h1)"
ZONED = f"""
    SELECT event_id, 'S' || (user_id % 4) AS site_code, zone, wall_text, CASE WHEN k = 99 THEN 'bad' WHEN m < lo OR m >= hi THEN 'unique' WHEN half = 0 THEN 'gap' ELSE 'overlap' END AS instant_status,
      wall + to_hours(h0) AS before, wall + to_hours(h1) AS after, m, lo, hi, k
    FROM (SELECT e.*, k * 3 AS m, night || ' ' || lpad(CAST(k * 3 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k * 3 % 60 AS VARCHAR), 2, '0') || ':00' AS clock,
            CASE WHEN k = 99 THEN 'soon' ELSE night || ' ' || lpad(CAST(k * 3 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k * 3 % 60 AS VARCHAR), 2, '0') || ':00' END AS wall_text,
            TRY_CAST(CASE WHEN k = 99 THEN NULL ELSE night || ' ' || lpad(CAST(k * 3 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k * 3 % 60 AS VARCHAR), 2, '0') || ':00' END AS TIMESTAMP) AS wall
          FROM (SELECT *, CASE user_id % 4 WHEN 0 THEN '2024-03-10' WHEN 1 THEN '2024-11-03' WHEN 2 THEN '2024-03-31' ELSE '2024-10-27' END AS night FROM c_events) e)
    JOIN {CHANGES} ON zone = CASE WHEN user_id % 4 < 2 THEN 'America/New_York' ELSE 'Europe/Berlin' END AND half = user_id % 2"""
UNKNOWN = """
    SELECT i.*, u.state AS named FROM c_intervals i JOIN (VALUES ('TreatmentRecord', 'Cooling'), ('PSTestRecord', 'Robot check'), ('UATestRecord', 'Applicator check'), ('FPumpRecord', 'Pump')) u(kind, state)
      ON u.kind = i.event_type WHERE duration_us > 0"""
DICTIONARY = f"""
    SELECT state, row_number() OVER (ORDER BY first, state) AS number, first.s AS site_code, first.c AS case_id, n_rows
    FROM (SELECT named AS state, min({{'s': site_code, 'c': case_id, 't': ts_us, 'r': coalesce(row_number, 1000000000000), 'e': event_type}}) AS first, count(*) AS n_rows FROM ({UNKNOWN}) GROUP BY named)"""

STATEMENTS |= {
    "sheet_rows": f"""SELECT site_code, case_id, row_number + CASE WHEN kind = 4 AND row_number >= 5 THEN 1 ELSE 0 END AS row_number, label, start_text, end_text
        FROM {SHEET_KIND} WHERE kind <= 4 OR kind = 5 AND row_number <> 4""",
    "sheet_errors": """SELECT site_code, case_id, CASE user_id % 9 WHEN 5 THEN 4 ELSE 1 END AS row_number,
        CASE WHEN user_id % 9 = 5 THEN 'timing_log_short_row' WHEN user_id % 9 = 6 AND user_id % 2 = 0 THEN 'timing_log_header_only' ELSE 'timing_log_columns_missing' END AS error
        FROM c_bases WHERE user_id % 9 IN (5, 6, 7)""",
    "sheet_warnings": "SELECT site_code, case_id, 'timing_log_blank_row' AS category, 5 AS row_number FROM c_bases WHERE user_id % 9 = 4",
    "case_sheets": """SELECT site_code, case_id, user_id % 9 <> 8 AS has_sheet, CASE WHEN user_id % 9 <= 4 THEN 6 WHEN user_id % 9 = 8 THEN 0 END AS n_entries,
        CASE WHEN user_id % 9 = 4 THEN 1 WHEN user_id % 9 <= 3 OR user_id % 9 = 8 THEN 0 END AS n_blank,
        CASE WHEN user_id % 9 = 5 THEN 'timing_log_short_row' WHEN user_id % 9 = 6 AND user_id % 2 = 0 THEN 'timing_log_header_only' WHEN user_id % 9 IN (6, 7) THEN 'timing_log_columns_missing' END AS error
        FROM c_bases""",
    "csv_bad_rows": "SELECT site_code, count(*) AS n_rows, count(*) FILTER (row_number % 89 = 7 OR row_number % 97 = 5) AS n_bad FROM c_raw GROUP BY site_code",
    "csv_rows": """SELECT site_code, case_id, row_number, raw_timestamp, nullif(trim(raw_event_type), '') AS event_type, CAST(row_number * 7 % 1000 AS DOUBLE) AS duration_sec
        FROM c_raw WHERE row_number % 89 <> 7 AND row_number % 97 <> 5""",
    "unified_columns": """SELECT patient, first_row, count(*) AS n_rows FROM (
        SELECT CASE WHEN user_id % 8 = 2 THEN 'Q' || user_id END AS patient, 1 AS first_row FROM c_bases
        UNION ALL SELECT CASE WHEN user_id % 8 = 3 THEN 'N' || user_id END, NULL FROM c_bases) GROUP BY patient, first_row""",
    "replaced_sites": f"""SELECT * FROM ({summary("c_intervals")}) WHERE site_code <> 'S1'
        UNION ALL SELECT * FROM ({summary("c_intervals", "duration_us < 21600000000")}) WHERE site_code = 'S1'""",
    "ordered_sanity": f"SELECT site_code, case_id, first_ts, n_events, row_number() OVER (ORDER BY site_code, case_id, first_ts) - 1 AS position FROM ({SANITY})",
    "run_document": f"""SELECT r.site_code, (discovery_order - 1) // 10 + 1 AS part, (discovery_order - 1) % 10 AS at, case_id, status, error, source_path, state_interval_count,
        cases_discovered, cases_processed, 'out/state_intervals/site_code=' || r.site_code AS intervals_path
        FROM ({RESULTS}) r JOIN (SELECT site_code, count(*) AS cases_discovered, count(*) FILTER (status = 'processed') AS cases_processed FROM ({RESULTS}) GROUP BY site_code) m ON m.site_code = r.site_code""",
    "warning_text_categories": "SELECT site_code, category, count(*) AS n_warnings FROM c_run_warnings GROUP BY site_code, category",
    "log_catalog": CATALOG,
    "log_versions": f"""SELECT site_code, version, count(*) AS n_cases, sum(n_rows)::BIGINT AS n_rows FROM (
        SELECT site_code, case_id, string_agg("column", ',' ORDER BY "column") AS version, max(n_rows) AS n_rows FROM ({CATALOG}) GROUP BY site_code, case_id) GROUP BY site_code, version""",
    "unified_log": f"""SELECT site_code, case_id, row_number, raw_timestamp AS time_text, raw_event_type AS event_type, raw_segment_id AS segment_id,
        CASE WHEN {CASE_VERSION} > 0 THEN raw_event_kind END AS event_kind, CASE WHEN {CASE_VERSION} = 2 THEN raw_event_kind * 0.5::DOUBLE + 0.25 END AS temperature FROM c_raw""",
    "zoned_times": f"""SELECT event_id, site_code, zone, wall_text, instant_status,
        CASE instant_status WHEN 'overlap' THEN greatest(before, after) WHEN 'unique' THEN CASE WHEN m < lo THEN before ELSE after END END AS instant FROM ({ZONED})""",
    "zoned_times_kept": f"""SELECT event_id, site_code, zone, wall_text, instant_status,
        CASE instant_status WHEN 'overlap' THEN least(before, after) WHEN 'gap' THEN before ELSE CASE WHEN m < lo THEN before ELSE after END END AS instant FROM ({ZONED}) WHERE k <> 99""",
    "unknown_states": DICTIONARY,
    "state_numbers": f"""SELECT state_number, state, count(*) AS n_rows FROM (
        SELECT ordinal AS state_number, state FROM c_plot WHERE event_type NOT IN ('TreatmentRecord', 'PSTestRecord', 'UATestRecord', 'FPumpRecord')
        UNION ALL SELECT d.number + (SELECT count(*) FROM c_states WHERE state IN ({names(PLOT_STATES)})), u.named FROM ({UNKNOWN}) u JOIN ({DICTIONARY}) d ON d.state = u.named) GROUP BY state_number, state""",
}


def statements() -> dict[str, str]:
    return {name: query(select) for name, select in STATEMENTS.items()}
