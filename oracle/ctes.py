"""Shared common table expressions (DuckDB dialect) over the driver's tables."""

from __future__ import annotations

import re

from oracle.fixed import (
    CRITICAL_TYPES, FILES, LABELS, SCRIPT_ONLY_TRANSITIONS, SPARSE_RULES, SPARSE_TYPES, STATES, TIMING_LABELS, TRANSITIONS, TYPES,
)


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(text(v) if isinstance(v, str) or v is None else str(v) for v in r) + ")" for r in rows) + ")"


def listed(items) -> str:
    return ", ".join(text(i) for i in items)


ORDER = "ts_us, is_synthetic, coalesce(row_number, 1000000000000), src, event_type, source_detail"
CASE = "site_code, case_id"
POST = "'Post-treatment scans & Device removal'"
UNASSIGNED = "trim(coalesce(state, '')) IN ('', 'NA', '<NA>')"
DISC = ("(event_type = 'MriConnectionRecord' OR (event_type = 'SessionEventRecord' AND coalesce(event_kind, -1) = 1) "
        "OR (event_type = 'SegmentEventRecord' AND coalesce(event_kind, -1) = 2))")


def automaton(name: str, source: str, mapping: str, mismatch: str, seen_after_clears: bool) -> dict[str, str]:
    """State machine over an ordered relation: resets counted into groups, disconnects looked up inside a group."""
    guard = "AND NOT mis" if seen_after_clears else ""
    return {
        f"{name}_a": f"""
            SELECT o.*, m.st AS map_state, m.rule AS map_rule, coalesce({mismatch}, FALSE) AS mis, {DISC} AS disc
            FROM {source} o LEFT JOIN {mapping} m USING (event_type)""",
        f"{name}_b": f"""
            SELECT *, coalesce(max(CASE WHEN map_state = 'Patient positioning & induction' {guard} THEN 1 ELSE 0 END)
                OVER (PARTITION BY {CASE} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
            FROM {name}_a""",
        f"{name}_c": f"""
            SELECT *,
              CASE WHEN event_type = 'UATestRecord' AND seen = 0 THEN 'Room ready'
                   WHEN contains(event_type, 'DeliveryPaused') THEN 'Paused' ELSE map_state END AS tr,
              CASE WHEN event_type = 'UATestRecord' AND seen = 0 THEN 'map_uatest_pre_positioning'
                   WHEN contains(event_type, 'DeliveryPaused') THEN 'map_delivery_paused' ELSE map_rule END AS tr_rule
            FROM {name}_b""",
        f"{name}_d": f"""
            SELECT *, CASE WHEN dup OR mis THEN '#' ELSE tr END AS hard FROM {name}_c""",
        f"{name}_e": f"""
            SELECT *, count(hard) OVER w AS grp, last_value(hard IGNORE NULLS) OVER w AS latest
            FROM {name}_d WINDOW w AS (PARTITION BY {CASE} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        f"{name}_f": f"""
            SELECT *, CASE WHEN latest = '#' THEN NULL
              WHEN latest = {POST} AND bool_or(disc) OVER (PARTITION BY {CASE}, grp ORDER BY pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) THEN NULL ELSE latest END AS state
            FROM {name}_e""",
    }


LANDMARKS = """
    SELECT site_code, case_id,
      min(CASE WHEN event_type = 'AlignmentWorkflowRecord' THEN pos END) AS al,
      min(CASE WHEN event_type = 'InitialImaging' THEN pos END) AS ii,
      min(CASE WHEN event_type = 'DeviceInsertionEnds' THEN pos END) AS di,
      min(CASE WHEN event_type = 'SetupWorkflowRecord' THEN pos END) AS su,
      min(CASE WHEN event_type = 'PSHomingRecord' THEN pos END) AS uh_first,
      max(CASE WHEN event_type = 'PSHomingRecord' THEN pos END) AS uh_last,
      count(CASE WHEN event_type = 'PSHomingRecord' THEN 1 END) AS uh_n,
      min(ts_us) AS first_us, count(*) AS n_rows, max(pos) AS last_pos
    FROM {source} GROUP BY site_code, case_id"""

LANDMARKS_2 = """
    SELECT l.*,
      (SELECT max(pos) FROM {source} e WHERE e.site_code = l.site_code AND e.case_id = l.case_id
         AND e.event_type IN ('PSTestRecord', 'UATestRecord') AND e.pos < l.al) AS last_test,
      (SELECT max(pos) FROM {source} e WHERE e.site_code = l.site_code AND e.case_id = l.case_id
         AND e.event_type = 'PSHomingRecord' AND e.pos < l.al) AS uh_before
    FROM {marks} l"""

LANDMARKS_3 = """
    SELECT *, CASE WHEN coalesce(last_test, 0) > 1 THEN last_test WHEN uh_n > 1 THEN uh_first
                   WHEN su IS NOT NULL THEN su ELSE coalesce(last_test, 0) END AS ready_at
    FROM {marks}"""

G1_MISMATCH = ("regexp_full_match(trim(segment_id)[1:10], '\\d{4}-\\d{2}-\\d{2}') "
               "AND trim(segment_id)[1:10] <> strftime(ts, '%Y-%m-%d')")
G2_MISMATCH = ("length(trim(segment_id)) >= 10 AND contains(trim(segment_id), '-') "
               "AND trim(segment_id)[1:10] <> strftime(ts, '%Y-%m-%d')")

CTES: dict[str, str] = {
    "c_events": """
        SELECT user_id, event_id, epoch_us(ts) - CASE WHEN user_id % 10 = 4 THEN 365 * 86400000000 ELSE 0 END AS us, props, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
        FROM events""",
    "c_arrival": """
        SELECT *, us + CASE WHEN k % 17 = 0 THEN 86400000000 ELSE 0 END AS arrival_us,
               min(us) OVER (PARTITION BY user_id) AS base FROM c_events""",
    "c_numbered": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival_us, event_id) AS row_number,
               ((base + (us - base) // 12) // 900000000) * 900000000 AS cus FROM c_arrival""",
    "c_raw": f"""
        SELECT 'S' || (user_id % 4) AS site_code, 'case_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS case_id, row_number,
          CASE WHEN user_id % 50 = 49 AND row_number = 1 THEN 'not-a-date'
               ELSE strftime(make_timestamp(cus), '%Y-%m-%d %H:%M:%S') || '.0000000' END AS raw_timestamp,
          CASE WHEN user_id % 50 = 48 AND row_number = 2 THEN ' ' ELSE [{listed(TYPES)}][k % 40 + 1] END AS raw_event_type,
          CASE WHEN k % 21 = 0 THEN strftime(make_timestamp(cus - 86400000000), '%Y-%m-%d') || '_seg'
               WHEN k % 7 = 0 THEN strftime(make_timestamp(cus), '%Y-%m-%d') || '_seg'
               WHEN k % 7 = 1 THEN 'SEG-1' END AS raw_segment_id,
          CAST(k % 3 AS INTEGER) AS raw_event_kind,
          CASE WHEN k % 7 > 1 AND k % 11 = 3 THEN '{{"TreatmentId": "T-' || (k % 5) || '"}}' ELSE props END AS raw_payload,
          CASE WHEN user_id % 4 = 1 AND row_number > 1 THEN 'P' || user_id END AS patient_id
        FROM c_numbered""",
    "c_bases": """
        SELECT user_id, 'S' || (user_id % 4) AS site_code, 'case_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS case_id,
               min(us) AS base FROM c_events GROUP BY user_id""",
    "c_sessions": """
        SELECT site_code, case_id,
          CASE WHEN user_id % 5 = 0 THEN '0001-01-01 00:00:00' WHEN user_id % 7 = 0 THEN '' WHEN user_id % 11 = 0 THEN 'not-a-date'
               ELSE strftime(make_timestamp(base + 1800000000), '%Y-%m-%d %H:%M:%S') END AS TimePatientSedatedAt,
          CASE WHEN user_id % 6 <> 0 THEN strftime(make_timestamp(base + 4500000000), '%Y-%m-%d %H:%M:%S') END AS TimeUaInsertedAt,
          strftime(make_timestamp(base + 54000000000), '%Y-%m-%d %H:%M:%S') AS TimeUaRemovedAt,
          CASE WHEN user_id % 4 = 0 THEN '0001-01-01T00:00:00.0000000'
               ELSE strftime(make_timestamp(base + 72000000000), '%Y-%m-%d %H:%M:%S') END AS TimePatientTransferredAt
        FROM c_bases""",
    "c_sheet": f"""
        SELECT site_code, case_id, case_id || '.csv' AS source_file, i + 2 AS row_number, [{listed(LABELS)}][i + 1] AS label,
          CASE WHEN (user_id + i) % 13 = 0 THEN 'soon' ELSE strftime(make_timestamp(base + i * 600000000), '%Y-%m-%d %H:%M:%S') END AS start_text,
          CASE WHEN (user_id + i) % 7 = 0 THEN ''
               ELSE strftime(make_timestamp(base + i * 600000000 + 480000000), '%Y-%m-%d %H:%M:%S') END AS end_text
        FROM c_bases, range(6) r(i)""",
    "c_listing": f"""
        SELECT site_code, case_id, unnest(CASE user_id % 6 {' '.join(f"WHEN {i} THEN [{listed(f)}]" for i, f in enumerate(FILES))} END) AS relative_path
        FROM c_bases""",
    "c_typed": """
        SELECT *, TRY_CAST(raw_timestamp AS TIMESTAMP) AS ts FROM c_raw""",
    "c_errors": """
        SELECT site_code, case_id, min(row_number) AS row_number,
          arg_min(CASE WHEN ts IS NULL THEN 'invalid_timestamp' ELSE 'missing_event_type' END, row_number) AS error
        FROM c_typed WHERE ts IS NULL OR trim(raw_event_type) = '' GROUP BY site_code, case_id""",
    "c_norm": """
        SELECT t.site_code, t.case_id, t.row_number, t.ts, epoch_us(t.ts) AS ts_us, trim(raw_event_type) AS event_type,
               coalesce(trim(raw_segment_id), json_extract_string(raw_payload, '$.TreatmentId')) AS segment_id, raw_event_kind AS event_kind, raw_payload
        FROM c_typed t ANTI JOIN c_errors e ON e.site_code = t.site_code AND e.case_id = t.case_id""",
    "c_fields": """
        SELECT site_code, case_id, field, event_type, value,
          CASE WHEN value IS NULL OR trim(value) = '' THEN 'missing' WHEN starts_with(value, '0001-01-01') THEN 'sentinel'
               WHEN TRY_CAST(value AS TIMESTAMP) IS NULL THEN 'unparseable' ELSE 'ok' END AS status
        FROM (
          SELECT site_code, case_id, 'TimePatientSedatedAt' AS field, 'Ready4Urology' AS event_type, TimePatientSedatedAt AS value FROM c_sessions
          UNION ALL SELECT site_code, case_id, 'TimeUaInsertedAt', 'DeviceInsertionEnds', TimeUaInsertedAt FROM c_sessions
          UNION ALL SELECT site_code, case_id, 'TimePatientTransferredAt', 'PatientTransferEnds', TimePatientTransferredAt FROM c_sessions
          UNION ALL SELECT site_code, case_id, 'TimeUaRemovedAt', NULL, TimeUaRemovedAt FROM c_sessions)""",
    "c_session_events": """
        SELECT site_code, case_id, CAST(value AS TIMESTAMP) AS ts, event_type, 'Sessions.' || field AS source_detail,
          CAST(json_object('session_row_index', 1, 'source_field', field, 'source_value', value) AS VARCHAR) AS raw_payload
        FROM c_fields WHERE status = 'ok' AND event_type IS NOT NULL""",
    "c_field_stats": """
        SELECT site_code, case_id, field, count(*) FILTER (status = 'missing') AS missing,
          count(*) FILTER (status = 'unparseable') AS unparseable, count(*) FILTER (status = 'sentinel') AS sentinel,
          count(*) FILTER (status = 'ok') AS parseable, CAST(0 AS BIGINT) AS missing_column
        FROM c_fields GROUP BY site_code, case_id, field""",
    "c_session_warnings": """
        SELECT site_code, case_id, 'session_unparseable' AS category, CAST(1 AS BIGINT) AS row_number, field || ':value=' || value AS detail
        FROM c_fields WHERE status = 'unparseable'
        UNION ALL SELECT site_code, case_id, 'ignored_session_sentinel_timestamp', 1, field || ':value=' || value
        FROM c_fields WHERE status = 'sentinel'
        UNION ALL SELECT site_code, case_id, 'session_field_unmapped', 1, field FROM c_fields WHERE status = 'ok' AND event_type IS NULL
        UNION ALL SELECT site_code, case_id, 'session_field_not_usable', NULL,
          field || ':missing=' || missing || ':unparseable=' || unparseable || ':sentinel=' || sentinel
        FROM c_field_stats WHERE parseable = 0""",
    "c_labels": f"SELECT * FROM {values(TIMING_LABELS)} t(label, event_type, selector)",
    "c_mapped": """
        SELECT s.*, l.event_type, l.selector,
          TRY_CAST(CASE WHEN selector = 'start' THEN start_text ELSE end_text END AS TIMESTAMP) AS ts
        FROM c_sheet s JOIN c_labels l ON l.label = s.label""",
    "c_timing_events": """
        SELECT site_code, case_id, ts, event_type, label AS source_detail,
          CAST(json_object('source_file', source_file, 'source_row_number', row_number, 'label_text', label, 'time_selector', selector,
            'source_time_raw', CASE WHEN selector = 'start' THEN start_text ELSE end_text END) AS VARCHAR) AS raw_payload
        FROM c_mapped WHERE ts IS NOT NULL""",
    "c_timing_warnings": """
        SELECT site_code, case_id, 'timing_log_unmapped_label' AS category, row_number, 'label=' || label AS detail
        FROM c_sheet WHERE label NOT IN (SELECT label FROM c_labels)
        UNION ALL SELECT site_code, case_id, 'timing_log_missing_mapped_time', row_number, label || ':' || event_type || ':' || selector
        FROM c_mapped WHERE ts IS NULL
        UNION ALL SELECT site_code, case_id, 'timing_log_unparseable_datetime', row_number, 'field=TimeSTART:value=soon'
        FROM c_sheet WHERE start_text = 'soon'""",
    "c_enriched": """
        SELECT site_code, case_id, ts, epoch_us(ts) AS ts_us, event_type, source, is_synthetic, source_detail, segment_id,
               event_kind, row_number, insertion_rule, raw_payload, CASE source WHEN 'auditlog' THEN 0 WHEN 'sessions' THEN 1 ELSE 2 END AS src
        FROM (
          SELECT site_code, case_id, ts, event_type, 'auditlog' AS source, FALSE AS is_synthetic, 'normalized_audit_event' AS source_detail,
                 segment_id, event_kind, row_number, NULL AS insertion_rule, raw_payload FROM c_norm WHERE event_type <> 'SignalRecord'
          UNION ALL SELECT site_code, case_id, ts, event_type, 'sessions', TRUE, source_detail, NULL, NULL, NULL, 'session_field_map_v1', raw_payload FROM c_session_events
          UNION ALL SELECT site_code, case_id, ts, event_type, 'timing_log', TRUE, source_detail, NULL, NULL, NULL, 'timing_log_label_map_v1', raw_payload FROM c_timing_events)
        WHERE (site_code, case_id) NOT IN (SELECT (site_code, case_id) FROM c_errors)""",
    "c_ordered": f"""
        SELECT *, row_number() OVER w - 1 AS pos,
          coalesce(event_type = 'AlignmentWorkflowRecord' AND lag(event_type) OVER w = 'CoarseWorkflowRecord' AND lag(ts_us) OVER w = ts_us, FALSE) AS dup
        FROM c_enriched WINDOW w AS (PARTITION BY {CASE} ORDER BY {ORDER})""",
    "c_map": f"SELECT * FROM {values(TRANSITIONS)} t(event_type, st, rule)",
    "c_map_script": f"SELECT * FROM {values(TRANSITIONS + SCRIPT_ONLY_TRANSITIONS)} t(event_type, st, rule)",
    **automaton("c_sm", "c_ordered", "c_map", G1_MISMATCH, True),
    "c_prior": f"""
        SELECT *, lag(state) OVER (PARTITION BY {CASE} ORDER BY pos) AS prior FROM c_sm_f""",
    "c_labelled": f"""
        SELECT * EXCLUDE (s0),
          coalesce(tr_rule, CASE WHEN prior IS NOT NULL THEN 'carry_forward_previous_state' END) AS state_assignment_rule,
          concat_ws(';', CASE WHEN dup THEN 'clear_alignment_duplicate_coarse_same_timestamp' END,
            CASE WHEN s0 = {POST} AND disc THEN 'clear_post_treatment_disconnect_events' END,
            CASE WHEN s0 IS NOT NULL AND NOT (s0 = {POST} AND disc) AND mis THEN 'clear_segment_date_mismatch' END) AS cleanup_rule_applied
        FROM (SELECT *, CASE WHEN NOT dup THEN coalesce(tr, prior) END AS s0 FROM c_prior)""",
    "c_unmapped": f"""
        SELECT site_code, case_id, event_type, count(*) AS n_events FROM c_labelled
        WHERE state_assignment_rule IS NULL AND (contains(event_type, 'WorkflowRecord') OR contains(event_type, 'Delivery')
          OR event_type IN ({listed(CRITICAL_TYPES)}))
        GROUP BY site_code, case_id, event_type""",
    "c_state_warnings": """
        SELECT site_code, case_id, 'state_unmapped_event_type' AS category, CAST(NULL AS BIGINT) AS row_number, event_type AS detail FROM c_unmapped
        UNION ALL SELECT site_code, case_id, 'cleanup_alignment_duplicate', row_number, NULL FROM c_labelled WHERE contains(cleanup_rule_applied, 'clear_alignment')
        UNION ALL SELECT site_code, case_id, 'cleanup_post_treatment_disconnect', row_number, NULL FROM c_labelled WHERE contains(cleanup_rule_applied, 'clear_post')
        UNION ALL SELECT site_code, case_id, 'cleanup_segment_date_mismatch', row_number,
          'segment_prefix=' || trim(segment_id)[1:10] || ':timestamp_date=' || strftime(ts, '%Y-%m-%d')
        FROM c_labelled WHERE contains(cleanup_rule_applied, 'clear_segment')""",
    # ---- anchors and intervals ----
    "c_marks_1": LANDMARKS.format(source="c_labelled"),
    "c_marks_2": LANDMARKS_2.format(source="c_labelled", marks="c_marks_1"),
    "c_marks": LANDMARKS_3.format(marks="c_marks_2"),
    "c_anchor_pos": """
        SELECT *,
          CASE WHEN al IS NULL AND ii IS NOT NULL THEN 'InitialImaging' WHEN al IS NULL AND uh_last IS NOT NULL THEN 'LastUAHoming'
               WHEN al IS NULL THEN 'CaseStart' WHEN uh_last > ready_at AND ii < al THEN 'InitialImaging'
               WHEN uh_last > ready_at AND ii IS NULL AND uh_before IS NOT NULL THEN 'LastUAHoming' ELSE 'Alignment' END AS rebase_anchor,
          CASE WHEN al IS NULL AND ii IS NOT NULL THEN ii WHEN al IS NULL AND uh_last IS NOT NULL THEN uh_last
               WHEN al IS NULL THEN 0 WHEN uh_last > ready_at AND ii < al THEN ii
               WHEN uh_last > ready_at AND ii IS NULL AND uh_before IS NOT NULL THEN uh_before ELSE al END AS anchor_pos,
          CASE WHEN al IS NULL AND ii IS NOT NULL THEN 'rebase_missing_alignment:fallback=InitialImaging'
               WHEN al IS NULL AND uh_last IS NOT NULL THEN 'rebase_missing_alignment:fallback=LastUAHoming'
               WHEN al IS NULL THEN 'rebase_anchor_missing:fallback=CaseStart'
               WHEN uh_last > ready_at AND NOT (coalesce(ii < al, FALSE)) AND NOT (ii IS NULL AND uh_before IS NOT NULL)
                 THEN 'rebase_anchor_fallback:Alignment' END AS anchor_warning
        FROM c_marks""",
    "c_end_pos": f"""
        SELECT site_code, case_id, max(CASE WHEN NOT ({UNASSIGNED}) THEN pos END) AS end_pos FROM c_labelled GROUP BY site_code, case_id""",
    "c_cases": """
        SELECT a.*, an.ts_us AS anchor_us, e.end_pos IS NULL AS end_is_fallback, coalesce(e.end_pos, a.last_pos) AS end_pos,
          en.ts_us AS end_us, en.row_number AS end_row, en.state AS end_state
        FROM c_anchor_pos a
        JOIN c_end_pos e USING (site_code, case_id)
        JOIN c_labelled an ON an.site_code = a.site_code AND an.case_id = a.case_id AND an.pos = a.anchor_pos
        JOIN c_labelled en ON en.site_code = a.site_code AND en.case_id = a.case_id AND en.pos = coalesce(e.end_pos, a.last_pos)""",
    "c_gaps": f"""
        SELECT l.*, c.rebase_anchor, c.anchor_us, c.end_us, lead(l.ts_us) OVER (PARTITION BY l.site_code, l.case_id ORDER BY l.pos) AS next_us,
          {UNASSIGNED} AS u, trim(coalesce(state, '')) IN ('Patient recovery & transfer', {POST}) AS t,
          trim(coalesce(state, '')) IN ('Room ready', 'TULSA QA', 'Patient positioning & induction') AS e,
          coalesce(state_assignment_rule IN ({listed(SPARSE_RULES)}), FALSE) OR event_type IN ({listed(SPARSE_TYPES)})
            OR (is_synthetic AND source = 'sessions') AS sparse
        FROM c_labelled l JOIN c_cases c ON c.site_code = l.site_code AND c.case_id = l.case_id""",
    "c_steps_1": """
        SELECT *, next_us - ts_us AS raw_us, coalesce(next_us - ts_us > 7200000000, FALSE) AS large,
          coalesce(next_us > end_us, FALSE) AND next_us > ts_us AS past,
          CASE WHEN end_us > ts_us AND end_us - ts_us < 7200000000 THEN end_us - ts_us ELSE 7200000000 END AS cap_us
        FROM c_gaps""",
    "c_steps_2": """
        SELECT *, CASE WHEN past AND (u OR t) THEN greatest(0, end_us - ts_us) ELSE raw_us END AS e1 FROM c_steps_1""",
    "c_steps_3": """
        SELECT *, large AND e AND sparse AND cap_us < e1 AS early_cut,
          CASE WHEN large AND e AND sparse AND cap_us < e1 THEN cap_us ELSE e1 END AS e2,
          large AND (u OR t OR past) AS big FROM c_steps_2""",
    "c_intervals": """
        SELECT *, ts_us - anchor_us AS start_us,
          CAST(CASE WHEN coalesce(raw_us, 0) <= 0 THEN 0 WHEN big THEN least(e2, cap_us) ELSE e2 END AS BIGINT) AS duration_us,
          concat_ws('|',
            CASE WHEN raw_us = 0 THEN 'zero_duration_to_next' END,
            CASE WHEN past AND t THEN 'interval_terminal_state_clamped' END,
            CASE WHEN past AND u THEN 'interval_unassigned_state_truncated' END,
            CASE WHEN early_cut THEN 'interval_early_state_truncated' END,
            CASE WHEN early_cut OR big THEN 'interval_truncated_large_gap' END,
            CASE WHEN big AND t AND NOT (past AND t) THEN 'interval_terminal_state_clamped' END,
            CASE WHEN big AND u AND NOT (past AND u) THEN 'interval_unassigned_state_truncated' END,
            CASE WHEN ts_us < anchor_us THEN 'negative_rebased_start' END,
            CASE WHEN ts_us < anchor_us THEN 'negative_rebased_start_expected_pre_anchor' END) AS flags
        FROM c_steps_3""",
    "c_interval_warnings": """
        SELECT site_code, case_id, split_part(anchor_warning, ':', 1) AS category, CAST(NULL AS BIGINT) AS row_number,
          split_part(anchor_warning, ':', 2) AS detail FROM c_cases WHERE anchor_warning IS NOT NULL
        UNION ALL SELECT site_code, case_id, 'case_end_inferred', end_row,
          CASE WHEN end_is_fallback THEN 'strategy=fallback_last_event' ELSE 'strategy=last_meaningful_state:state=' || end_state END FROM c_cases
        UNION ALL SELECT site_code, case_id, 'case_end_ambiguous', end_row,
          CASE WHEN end_is_fallback THEN 'no_meaningful_state:fallback=last_event' ELSE 'trailing_events_after_case_end=' || (n_rows - end_pos - 1) END
        FROM c_cases WHERE end_is_fallback OR n_rows - end_pos - 1 > 0
        UNION ALL SELECT site_code, case_id, 'interval_hardened_truncation', row_number,
          'event_type=' || event_type || ':state=' || coalesce(state, '<NA>') || ':raw_us=' || raw_us || ':duration_us=' || duration_us
        FROM c_intervals WHERE raw_us > 0 AND duration_us < raw_us
        UNION ALL SELECT site_code, case_id, 'interval_early_state_truncated', row_number,
          'event_type=' || event_type || ':state=' || coalesce(state, '<NA>') || ':raw_us=' || raw_us || ':duration_us=' || duration_us
        FROM c_intervals WHERE raw_us > 0 AND duration_us < raw_us AND early_cut
        UNION ALL SELECT site_code, case_id, 'interval_negative_rebased_start', row_number,
          'event_type=' || event_type || ':start_us=' || start_us || ':expected_pre_anchor=1' FROM c_intervals WHERE start_us < -21600000000""",
    # ---- script profile ----
    "c_injected": """
        SELECT site_code, case_id, row_number, raw_timestamp, raw_event_type, raw_segment_id, raw_event_kind,
               json_extract_string(raw_payload, '$.TreatmentId') AS treatment FROM c_raw
        UNION ALL
        SELECT a.site_code, a.case_id, m.last_row + row_number() OVER (PARTITION BY a.site_code, a.case_id ORDER BY a.at),
               a.value, a.event_type, m.seg, m.kind, m.treatment
        FROM (SELECT site_code, case_id, event_type, trim(value) AS value,
                CASE field WHEN 'TimePatientSedatedAt' THEN 0 WHEN 'TimeUaInsertedAt' THEN 1 ELSE 2 END AS at
              FROM c_fields f WHERE event_type IS NOT NULL AND year(TRY_CAST(value AS TIMESTAMP)) >= 2000
                AND NOT EXISTS (SELECT 1 FROM c_raw r WHERE r.site_code = f.site_code AND r.case_id = f.case_id
                  AND r.raw_event_type = f.event_type AND r.raw_timestamp = trim(f.value))) a
        JOIN (SELECT site_code, case_id, max(row_number) AS last_row,
                max(CASE WHEN row_number = 1 THEN raw_segment_id END) AS seg,
                max(CASE WHEN row_number = 1 THEN raw_event_kind END) AS kind,
                max(CASE WHEN row_number = 1 THEN json_extract_string(raw_payload, '$.TreatmentId') END) AS treatment
              FROM c_raw GROUP BY site_code, case_id) m ON m.site_code = a.site_code AND m.case_id = a.case_id""",
    "c_script_events": f"""
        SELECT site_code, case_id, row_number, TRY_CAST(raw_timestamp AS TIMESTAMP) AS ts, epoch_us(TRY_CAST(raw_timestamp AS TIMESTAMP)) AS ts_us,
          raw_event_type AS event_type, coalesce(raw_segment_id, treatment) AS segment_id, raw_event_kind AS event_kind
        FROM c_injected WHERE TRY_CAST(raw_timestamp AS TIMESTAMP) IS NOT NULL AND trim(raw_event_type) <> '' AND raw_event_type <> 'SignalRecord'""",
    "c_script_dups": f"""
        SELECT *, coalesce(event_type = 'AlignmentWorkflowRecord' AND lag(event_type) OVER w = 'CoarseWorkflowRecord'
                  AND lag(ts_us) OVER w = ts_us, FALSE) AS is_dup
        FROM c_script_events WINDOW w AS (PARTITION BY {CASE} ORDER BY ts_us, row_number)""",
    "c_script_ordered": f"""
        SELECT * EXCLUDE (is_dup), FALSE AS dup, row_number() OVER (PARTITION BY {CASE} ORDER BY ts_us, row_number) - 1 AS pos
        FROM c_script_dups WHERE NOT is_dup""",
    **automaton("c_sc", "c_script_ordered", "c_map_script", G2_MISMATCH, False),
    "c_sc_marks_1": LANDMARKS.format(source="c_sc_f"),
    "c_sc_marks_2": LANDMARKS_2.format(source="c_sc_f", marks="c_sc_marks_1"),
    "c_sc_marks": LANDMARKS_3.format(marks="c_sc_marks_2"),
    "c_sc_anchor": """
        SELECT *, CASE WHEN al IS NULL THEN NULL WHEN NOT coalesce(uh_last > ready_at, FALSE) THEN 'Alignment'
          WHEN ii IS NULL AND uh_before IS NOT NULL THEN 'LastUAHoming' WHEN ii < al THEN 'InitialImaging' END AS rebase_anchor
        FROM c_sc_marks""",
    "c_adjusted": """
        SELECT e.* EXCLUDE (state), a.rebase_anchor,
          CASE WHEN a.rebase_anchor = 'LastUAHoming' AND e.pos BETWEEN a.uh_before AND a.al - 1 THEN 'Device repositioning'
               WHEN a.rebase_anchor = 'InitialImaging' AND e.pos BETWEEN a.ii AND a.al - 1 THEN 'Device repositioning'
               WHEN a.al IS NOT NULL AND a.di <= a.ii AND e.pos BETWEEN a.di AND a.ii THEN 'Device insertion'
               ELSE e.state END AS state
        FROM c_sc_f e JOIN c_sc_anchor a ON a.site_code = e.site_code AND a.case_id = e.case_id""",
    "c_timed": """
        SELECT k.*, k.ts_us - coalesce(CASE k.rebase_anchor WHEN 'InitialImaging' THEN g.ii_us WHEN 'LastUAHoming' THEN g.uh_us
                 WHEN 'Alignment' THEN g.al_us END, g.first_us) AS start_us,
          coalesce(lead(k.ts_us) OVER (PARTITION BY k.site_code, k.case_id ORDER BY k.pos) - k.ts_us, 0) AS duration_us,
          g.first_us, g.last_us
        FROM (SELECT * FROM c_adjusted WHERE state IS NOT NULL) k
        JOIN (SELECT site_code, case_id, min(ts_us) AS first_us, max(ts_us) AS last_us,
                min(CASE WHEN event_type = 'InitialImaging' THEN ts_us END) AS ii_us,
                max(CASE WHEN event_type = 'PSHomingRecord' THEN ts_us END) AS uh_us,
                min(CASE WHEN event_type = 'AlignmentWorkflowRecord' THEN ts_us END) AS al_us
              FROM c_adjusted WHERE state IS NOT NULL GROUP BY site_code, case_id) g
          ON g.site_code = k.site_code AND g.case_id = k.case_id""",
    # ---- summaries ----
    "c_states": f"SELECT * FROM {values([(s, i, c) for i, (s, c) in enumerate(STATES, start=1)])} t(state, ordinal, color)",
    "c_phase_us": """
        SELECT site_code, case_id, state, sum(duration_us) AS phase_us FROM c_intervals WHERE state IS NOT NULL GROUP BY ALL""",
    "c_long": """
        SELECT c.site_code, c.case_id, s.state AS phase, s.ordinal, s.color, coalesce(p.phase_us, 0) / 60000000.0::DOUBLE AS minutes
        FROM (SELECT DISTINCT site_code, case_id FROM c_phase_us) c CROSS JOIN c_states s
        LEFT JOIN c_phase_us p ON p.site_code = c.site_code AND p.case_id = c.case_id AND p.state = s.state""",
    "c_capped": "SELECT * FROM c_long WHERE minutes <= 1000",
    "c_plot": """
        SELECT i.*, s.ordinal, s.color FROM c_intervals i JOIN c_states s ON s.state = i.state
        WHERE i.state <> 'NA' AND duration_us > 0""",
    "c_midnight": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_code, case_id
            ORDER BY ts_us, coalesce(row_number, 1000000000000), event_type) AS nth
          FROM c_plot WHERE CAST(make_timestamp(ts_us + duration_us) AS DATE) <> CAST(ts AS DATE)) WHERE nth = 1""",
    "c_timeline_warnings": """
        SELECT site_code, case_id, 'plot_excluded_empty_state' AS category, row_number, NULL AS detail FROM c_intervals WHERE state IS NULL OR state = 'NA'
        UNION ALL SELECT site_code, case_id, 'plot_excluded_nonpositive_duration', row_number, 'duration_us=' || duration_us
        FROM c_intervals WHERE state IS NOT NULL AND state <> 'NA' AND duration_us <= 0
        UNION ALL SELECT site_code, case_id, 'plot_row_quality_flags', row_number, 'flags=' || replace(flags, '|', ',') FROM c_plot WHERE flags <> ''
        UNION ALL SELECT site_code, case_id, 'plot_original_hour_crosses_midnight', row_number,
          'start=' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ':end=' || strftime(make_timestamp(ts_us + duration_us), '%Y-%m-%d %H:%M:%S')
        FROM c_midnight""",
    "c_warnings": """
        SELECT * FROM c_state_warnings UNION ALL SELECT * FROM c_interval_warnings UNION ALL SELECT * FROM c_timeline_warnings
        UNION ALL SELECT * FROM c_session_warnings WHERE (site_code, case_id) NOT IN (SELECT (site_code, case_id) FROM c_errors)
        UNION ALL SELECT * FROM c_timing_warnings WHERE (site_code, case_id) NOT IN (SELECT (site_code, case_id) FROM c_errors)""",
    # ---- discovery ----
    "c_ranked_files": """
        SELECT *, CASE WHEN regexp_full_match(relative_path, '[^/.][^/]*/_[^/]*/local\\.db') THEN 0
                       WHEN regexp_full_match(relative_path, '_[^/]*/local\\.db') THEN 1
                       WHEN relative_path = 'local.db' THEN 2 END AS db_rank,
          CASE WHEN regexp_full_match(relative_path, 'TDC Sessions/_[^/]*\\.zip') THEN 0
               WHEN regexp_full_match(relative_path, '_201[^/]*\\.zip') THEN 1
               WHEN regexp_full_match(relative_path, '[^/.][^/]*/_201[^/]*\\.zip') THEN 2
               WHEN regexp_full_match(relative_path, 'Session[^/]*\\.zip') THEN 3 END AS zip_rank,
          site_code || '/' || case_id || '/' || relative_path AS path
        FROM c_listing""",
    "c_discovered": """
        SELECT site_code, case_id, row_number() OVER (PARTITION BY site_code ORDER BY lower(case_id)) AS discovery_order,
          coalesce(string_agg(path, '|' ORDER BY db_rank, lower(path)) FILTER (db_rank IS NOT NULL), '') AS databases,
          coalesce(string_agg(path, '|' ORDER BY zip_rank, lower(path)) FILTER (zip_rank IS NOT NULL), '') AS zips,
          count(db_rank) AS n_db, count(zip_rank) AS n_zip
        FROM c_ranked_files GROUP BY site_code, case_id""",
    "c_sources": """
        SELECT *,
          CASE WHEN n_db = 0 AND n_zip = 0 THEN 'no_candidates' WHEN n_db > 1 OR (n_db = 0 AND n_zip > 1) THEN 'ambiguous' ELSE 'resolved' END AS status
        FROM c_discovered""",
    "c_processed": """
        SELECT s.site_code, s.case_id FROM c_sources s
        JOIN c_raw y ON y.site_code = s.site_code AND y.case_id = s.case_id AND y.row_number = 1 AND TRY_CAST(y.raw_timestamp[1:4] AS INTEGER) = 2024
        ANTI JOIN c_errors e ON e.site_code = s.site_code AND e.case_id = s.case_id WHERE s.status = 'resolved'""",
    "c_run_warnings": """
        SELECT w.* FROM c_warnings w JOIN c_processed p ON p.site_code = w.site_code AND p.case_id = w.case_id
        UNION ALL SELECT site_code, case_id, 'uncategorized', NULL, 'no_database_candidates_found' FROM c_sources WHERE status = 'no_candidates'
        UNION ALL SELECT s.site_code, s.case_id, 'uncategorized', NULL, 'multiple_zip_candidates' FROM c_sources s
          JOIN c_processed p ON p.site_code = s.site_code AND p.case_id = s.case_id WHERE n_zip > 1""",
}

# The same chain over the log rows alone: every name of the chain gets the prefix c_log_.
_CHAIN = [n for n in CTES if n in ("c_ordered", "c_prior", "c_labelled") or n.startswith(("c_sm_", "c_marks"))
          or n in ("c_anchor_pos", "c_end_pos", "c_cases", "c_gaps", "c_steps_1", "c_steps_2", "c_steps_3", "c_intervals")]
CTES["c_log_enriched"] = "SELECT * FROM c_enriched WHERE source = 'auditlog'"
for _name in _CHAIN:
    CTES["c_log_" + _name[2:]] = re.sub(
        r"\bc_(" + "|".join(n[2:] for n in [*_CHAIN, "c_enriched"]) + r")\b", r"c_log_\1", CTES[_name])

_NAME = re.compile(r"\bc_[a-z_0-9]+\b")


def query(select: str, given: dict[str, str] | None = None) -> str:
    """Prefix a select with the CTEs it needs, in dependency order; ``given`` replaces some of them."""
    ctes = CTES | (given or {})
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in _NAME.findall(ctes[name]):
            if other != name:
                visit(other)
        ordered.append(name)

    for name in _NAME.findall(select):
        visit(name)
    body = ",\n".join(f"{n} AS MATERIALIZED ({ctes[n]})" for n in ordered)
    return f"WITH {body}\n{select}" if ordered else select
