"""Small hand-made events."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stagewatch.functions.coerce import micros
from stagewatch.workflow import tie_rank

DAY = datetime(2025, 1, 1)
SCHEMA = (
    "site_code string, case_id string, timestamp timestamp_ntz, event_type string, source string, is_synthetic boolean, "
    "source_detail string, segment_id string, event_kind int, drop_reason string, insertion_rule string, row_number bigint"
)


def clock(text: str) -> datetime:
    hour, minute = map(int, text.split(":"))
    return DAY + timedelta(hours=hour, minutes=minute)


def event(at, kind, number, case="c1", segment=None, event_kind=None, source="auditlog", site="S"):
    synthetic = source != "auditlog"
    return (site, case, at, kind, source, synthetic, "d", segment, event_kind, None, None, None if synthetic else number)


def enriched(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("ts_us", micros(F.col("timestamp"))).withColumn("tie_rank", tie_rank()).withColumn(
        "source_row", F.col("row_number"))


def with_state(spark, rows):
    """rows of (time, type, state, rule): labelled events of one case, as if states were given."""
    events = [event(at, kind, i) for i, (at, kind, _, _) in enumerate(rows, start=1)]
    given = spark.createDataFrame(
        [(i, s, r) for i, (_, _, s, r) in enumerate(rows, start=1)],
        "row_number bigint, state string, state_assignment_rule string",
    )
    return enriched(spark, events).join(given, "row_number").withColumns({
        "cleanup_rule_applied": F.lit(""), "prior_state": F.lit(None).cast("string"),
    })


POST = "Post-treatment scans & Device removal"
