"""Synthetic events from session fields and timing sheets, merged with the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.functions import coerce
from stagewatch.functions.ordered import SLICE, row_position, slice_hot_groups
from stagewatch.workflow import KEYS, SESSION_FIELDS, as_warnings, tie_rank, timing_label_dimension


def session_fields(sessions: DataFrame) -> DataFrame:
    """One row per session row and tracked field: status, parsed time, mapped event type."""
    pairs = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(event).cast("string").alias("event_type"),
            (F.col(name).cast("string") if name in sessions.columns else F.lit(None).cast("string")).alias("value"),
            F.lit(name not in sessions.columns).alias("absent"),
        )
        for name, event in SESSION_FIELDS
    ]
    long = sessions.select(*KEYS, "row_number", F.explode(F.array(*pairs)).alias("f")).select(
        *KEYS, "row_number", "f.*"
    )
    status = F.when(F.col("absent"), "missing_column").otherwise(coerce.optional_timestamp_status(F.col("value")))
    return long.withColumn("status", status).withColumn(
        "timestamp", F.when(F.col("status") == "ok", coerce.optional_timestamp(F.col("value")))
    )


def session_events(sessions: DataFrame) -> DataFrame:
    usable = session_fields(sessions).filter((F.col("status") == "ok") & F.col("event_type").isNotNull())
    return usable.select(
        *KEYS, "timestamp", "event_type",
        F.col("row_number").cast("bigint").alias("source_row"),
        F.lit("sessions").alias("source"),
        F.concat(F.lit("Sessions."), F.col("field")).alias("source_detail"),
        F.lit("session_field_map_v1").alias("insertion_rule"),
        F.to_json(F.struct(
            F.col("row_number").alias("session_row_index"), F.col("field").alias("source_field"),
            F.col("value").alias("source_value"),
        )).alias("raw_payload"),
    )


def session_field_stats(sessions: DataFrame) -> DataFrame:
    """Per case and field: how many values were missing, unparseable, sentinel, parseable, or had no column."""
    return session_fields(sessions).groupBy(*KEYS, "field").agg(*[
        F.count_if(F.col("status") == status).alias(name)
        for name, status in (
            ("missing", "missing"), ("unparseable", "unparseable"), ("sentinel", "sentinel"),
            ("parseable", "ok"), ("missing_column", "missing_column"),
        )
    ])


def session_warnings(sessions: DataFrame) -> DataFrame:
    fields = session_fields(sessions)
    per_value = fields.withColumn(
        "category",
        F.when(F.col("status") == "unparseable", "session_unparseable")
        .when(F.col("status") == "sentinel", "ignored_session_sentinel_timestamp")
        .when((F.col("status") == "ok") & F.col("event_type").isNull(), "session_field_unmapped"),
    ).filter(F.col("category").isNotNull())
    stats = session_field_stats(sessions)
    found = F.col("missing") + F.col("unparseable") + F.col("sentinel")
    per_field = stats.withColumn(
        "category",
        F.when((F.col("missing_column") > 0) & (found + F.col("parseable") == 0), "session_missing_column")
        .when((F.col("parseable") == 0) & (found > 0), "session_field_not_usable"),
    ).filter(F.col("category").isNotNull())
    counts = F.when(
        F.col("category") == "session_field_not_usable",
        F.format_string(":missing=%d:unparseable=%d:sentinel=%d", "missing", "unparseable", "sentinel"),
    ).otherwise("")
    return as_warnings(
        per_value, F.col("category"), F.col("row_number"),
        F.when(F.col("event_type").isNull() & (F.col("status") == "ok"), F.col("field"))
        .otherwise(F.concat_ws(":", "field", F.concat(F.lit("value="), F.col("value")))),
    ).unionByName(as_warnings(
        per_field, F.col("category"), F.lit(None), F.concat(F.col("field"), counts)
    ))


def timing_entries(sheet: DataFrame) -> DataFrame:
    """Parse start and end of timing-sheet rows (keys, source_file, row_number, label, start_text, end_text)."""
    return sheet.withColumns({
        "time_start": coerce.optional_timestamp(F.col("start_text")),
        "time_end": coerce.optional_timestamp(F.col("end_text")),
    })


def _mapped_labels(sheet: DataFrame) -> DataFrame:
    labels = F.broadcast(timing_label_dimension(sheet.sparkSession))
    at_start = F.col("selector") == "start"
    return timing_entries(sheet).join(labels, "label").withColumns({
        "timestamp": F.when(at_start, F.col("time_start")).otherwise(F.col("time_end")),
        "time_text": F.when(at_start, F.col("start_text")).otherwise(F.col("end_text")),
    })


def timing_log_events(sheet: DataFrame) -> DataFrame:
    return _mapped_labels(sheet).filter(F.col("timestamp").isNotNull()).select(
        *KEYS, "timestamp", "event_type",
        F.col("row_number").cast("bigint").alias("source_row"),
        F.lit("timing_log").alias("source"),
        F.col("label").alias("source_detail"),
        F.lit("timing_log_label_map_v1").alias("insertion_rule"),
        F.to_json(F.struct(
            "source_file", F.col("row_number").alias("source_row_number"), F.col("label").alias("label_text"),
            F.col("selector").alias("time_selector"), F.col("time_text").alias("source_time_raw"),
        )).alias("raw_payload"),
    )


def unmapped_labels(sheet: DataFrame) -> DataFrame:
    labels = F.broadcast(timing_label_dimension(sheet.sparkSession))
    return sheet.join(labels, "label", "left_anti")


def timing_log_warnings(sheet: DataFrame) -> DataFrame:
    entries = timing_entries(sheet)
    row = F.col("row_number")
    unparsed = entries.select("*", F.explode(F.array(
        F.struct(F.lit("TimeSTART").alias("name"), F.col("start_text").alias("text"), F.col("time_start").alias("ts")),
        F.struct(F.lit("TimeEND").alias("name"), F.col("end_text").alias("text"), F.col("time_end").alias("ts")),
    )).alias("t")).filter((F.trim("t.text") != "") & F.col("t.ts").isNull())
    return (
        as_warnings(unmapped_labels(sheet), "timing_log_unmapped_label", row, F.concat(F.lit("label="), F.col("label")))
        .unionByName(as_warnings(
            _mapped_labels(sheet).filter(F.col("timestamp").isNull()), "timing_log_missing_mapped_time", row,
            F.concat_ws(":", "label", "event_type", "selector"),
        ))
        .unionByName(as_warnings(
            unparsed, "timing_log_unparseable_datetime", row,
            F.concat(F.lit("field="), F.col("t.name"), F.lit(":value="), F.trim("t.text")),
        ))
    )


EVENT_COLUMNS = [
    *KEYS, "timestamp", "ts_us", "tie_rank", "event_type", "source", "is_synthetic", "source_detail",
    "segment_id", "event_kind", "drop_reason", "insertion_rule", "row_number", "source_row",
]


def enrich(kept_events: DataFrame, *synthetic: DataFrame, with_payload: bool = False) -> DataFrame:
    """Union of the log's events and the synthetic ones, in one schema.

    A mark ``is_bad`` on log rows is kept, so that a failing case can be removed with its synthetic events.
    """
    marked = "is_bad" in kept_events.columns
    columns = EVENT_COLUMNS + (["raw_payload"] if with_payload else []) + (["is_bad"] if marked else [])
    merged = kept_events.withColumns({
        "is_synthetic": F.lit(False),
        "source_detail": F.lit("normalized_audit_event"),
        "insertion_rule": F.lit(None).cast("string"),
        "source_row": F.col("row_number"),
    }).withColumn("tie_rank", tie_rank()).select(*columns)
    for part in synthetic:
        merged = merged.unionByName(part.withColumns({
            "ts_us": coerce.micros(F.col("timestamp")),
            "is_synthetic": F.lit(True),
            "segment_id": F.lit(None).cast("string"),
            "event_kind": F.lit(None).cast("int"),
            "drop_reason": F.lit(None).cast("string"),
            "row_number": F.lit(None).cast("bigint"),
            **({"is_bad": F.lit(False)} if marked else {}),
        }).withColumn("tie_rank", tie_rank()).select(*columns))
    return merged


def inject_session_rows(raw: DataFrame, sessions: DataFrame) -> DataFrame:
    """Script profile: session times become log rows cloned from the first log row of the case.

    New rows get the row numbers after the last one; a row whose type and time text are already in
    the log is skipped.  Injected rows are compared with the original log only, not with each other.
    """
    template = raw.groupBy(*KEYS).agg(
        F.min_by(F.struct("raw_segment_id", "raw_event_kind", "raw_payload"), "row_number").alias("first"),
        F.max("row_number").alias("last_row"),
    )
    mapped = [(i, name, event) for i, (name, event) in enumerate(SESSION_FIELDS) if event and name in sessions.columns]
    wanted = (
        sessions.select(*KEYS, F.col("row_number").alias("session_row"), F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), F.lit(event).alias("raw_event_type"),
                     coerce.plausible_session_text(F.col(name)).alias("raw_timestamp"))
            for i, name, event in mapped
        ])).alias("f"))
        .select(*KEYS, "session_row", "f.*")
        .filter(F.col("raw_timestamp").isNotNull())
    )
    # Only rows of the few mapped types can be equal to an injected one; no others need to move.
    types = sorted({event for _, _, event in mapped})
    logged = raw.filter(F.col("raw_event_type").isin(*types)).select(*KEYS, "raw_event_type", "raw_timestamp")
    fresh = wanted.join(logged, [*KEYS, "raw_event_type", "raw_timestamp"], "left_anti")
    order = [F.col("session_row"), F.col("at")]
    numbered = row_position(slice_hot_groups(fresh, KEYS, order, sized_by=sessions), KEYS, order, "nth").drop(SLICE)
    added = numbered.join(template, KEYS).select(
        *KEYS, (F.col("last_row") + F.col("nth")).alias("row_number"), "raw_timestamp", "raw_event_type",
        "first.raw_segment_id", "first.raw_event_kind", "first.raw_payload",
    )
    return raw.select(*added.columns).unionByName(added)
