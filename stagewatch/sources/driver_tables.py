"""Bind the ``events`` table to the engine's inputs: raw log rows, sessions, timing sheets, files.

Every user is one case.  All formulas are integer or text arithmetic on ``events``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewatch.functions.coerce import DAY_US, MICROS, from_micros, micros
from stagewatch.functions.ordered import SLICE, group_values, row_position, settled, slice_hot_groups
from stagewatch.workflow import KEYS, text_array

# Event types of the binding, index 0-39.
TYPES = (
    "SetupWorkflowRecord", "SetupUnlockWorkflowRecord", "AnesthesiaStart", "Ready4Urology",
    "DeviceInsertionBegins", "DeviceInsertionEnds", "InitialImaging", "AlignmentWorkflowRecord",
    "CoarseWorkflowRecord", "CoarseUnlockWorkflowRecord", "DetailedWorkflowRecord", "PlanReadyWorkflowRecord",
    "PlanReadyCompleteWorkflowRecord", "PlanReadyUserStoppedInitializationWorkflowRecord",
    "DeliveryInitializingWorkflowRecord", "DeliveryWorkflowRecord", "DeliveryResumedWorkflowRecord",
    "DeliveryPausedWorkflowRecord", "DeliveryInterruptedWorkflowRecord", "ReviewWorkflowRecord",
    "DevicesRemovalStarts", "DevicesRemovalEnds", "PatientTransferBegins", "PatientTransferEnds",
    "TreatmentRecord", "UATestRecord", "PSTestRecord", "PSHomingRecord", "MriConnectionRecord",
    "SessionEventRecord", "SegmentEventRecord", "SignalRecord", "SignalRecord", "FPumpRecord",
    "PSConnectionRecord", "UnknownWorkflowRecord", "CoarseWorkflowRecord", "PSHomingRecord",
    "UATestRecord", "AlignmentWorkflowRecord",
)
LABELS = (
    "Anesthesia Team starts to prepare the patient ", "Patient is ready for Urology team", "Devices Insertion",
    "Patient Transfer from MRI Bed to Recovery room", "Initial Device Imaging (From first until last survey)",
    "Device Removal",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=64)
def sizes(spark: SparkSession, sf_dir: str) -> tuple[int, int, int]:
    """Rows of the largest case, cases and rows of the largest site: table statistics, taken once per session and folder."""
    cases = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    sites = cases.groupBy(_site(F.col("user_id")).alias("site")).agg(
        F.max("n").alias("case_rows"), F.count(F.lit(1)).alias("cases"), F.sum("n").alias("rows"))
    found = sites.agg(F.max("case_rows"), F.max("cases"), F.max("rows")).first()
    return tuple(n or 0 for n in found)


def largest_case(spark: SparkSession, sf_dir: str) -> int:
    return sizes(spark, sf_dir)[0]


def largest_site(spark: SparkSession, sf_dir: str) -> int:
    """Cases of the largest site."""
    return sizes(spark, sf_dir)[1]


def _site(user: Column) -> Column:
    return F.concat(F.lit("S"), F.pmod(user, F.lit(4)).cast("string"))


def _case(user: Column) -> Column:
    return F.concat(F.lit("case_"), F.lpad(user.cast("string"), 6, "0"))


def _shifted(us: Column) -> Column:
    """Every tenth case lies a year earlier."""
    return us - F.when(F.col("user_id") % 10 == 4, F.lit(365 * DAY_US)).otherwise(F.lit(0))


def _stamp(us: Column) -> Column:
    return from_micros(us).cast("string").substr(1, 19)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, us, k = F.col("user_id"), F.col("us"), F.col("k")
    arrival = [F.col("arrival_us"), F.col("event_id")]
    events = table(spark, sf_dir, "events").select(
        _site(user).alias("site_code"), _case(user).alias("case_id"), "user_id", "event_id",
        _shifted(micros(F.col("ts"))).alias("us"), "props",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    ).withColumn("arrival_us", us + F.when(k % 17 == 0, F.lit(DAY_US)).otherwise(F.lit(0)))
    events = settled(slice_hot_groups(events, KEYS, arrival, largest=largest_case(spark, sf_dir)))
    events = row_position(events, KEYS, arrival, "row_number")
    events = group_values(events, KEYS, {"base": F.min("us")}, arrival).drop(SLICE)
    quarter = F.lit(900 * MICROS)
    squeezed = F.expr("(base + (us - base) div 12) div 900000000") * quarter
    day = _stamp(F.col("cus")).substr(1, 10)
    return (
        events.withColumn("cus", squeezed)
        .select(
            *KEYS, "row_number",
            F.when((user % 50 == 49) & (F.col("row_number") == 1), "not-a-date")
            .otherwise(F.concat(_stamp(F.col("cus")), F.lit(".0000000"))).alias("raw_timestamp"),
            F.when((user % 50 == 48) & (F.col("row_number") == 2), " ")
            .otherwise(F.get(text_array(TYPES), (k % 40).cast("int"))).alias("raw_event_type"),
            F.when(k % 21 == 0, F.concat(_stamp(F.col("cus") - DAY_US).substr(1, 10), F.lit("_seg")))
            .when(k % 7 == 0, F.concat(day, F.lit("_seg")))
            .when(k % 7 == 1, "SEG-1").alias("raw_segment_id"),
            (k % 3).cast("int").alias("raw_event_kind"),
            # Rows without a segment may name a treatment in their payload instead.
            F.when((k % 7 > 1) & (k % 11 == 3), F.concat(F.lit('{"TreatmentId": "T-'), (k % 5).cast("string"), F.lit('"}')))
            .otherwise(F.col("props")).alias("raw_payload"),
            F.when((user % 4 == 1) & (F.col("row_number") > 1), F.concat(F.lit("P"), user.cast("string"))).alias("patient_id"),
        )
    )


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, base: one row per user (pre-aggregated before the shuffle)."""
    return (
        table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first_ts"))
        .select(_site(F.col("user_id")).alias("site_code"), _case(F.col("user_id")).alias("case_id"),
                "user_id", _shifted(micros(F.col("first_ts"))).alias("base"))
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, base = F.col("user_id"), F.col("base")

    def after(minutes: int) -> Column:
        return _stamp(base + F.lit(minutes * 60 * MICROS))

    return _cases(spark, sf_dir).select(
        *KEYS,
        F.lit(1).cast("bigint").alias("row_number"),
        F.when(user % 5 == 0, "0001-01-01 00:00:00").when(user % 7 == 0, "").when(user % 11 == 0, "not-a-date")
        .otherwise(after(30)).alias("TimePatientSedatedAt"),
        F.when(user % 6 != 0, after(75)).alias("TimeUaInsertedAt"),
        F.when(user % 8 == 2, F.concat(F.lit("Q"), user.cast("string"))).otherwise(" ").alias("PatientId"),
        F.when(user % 8 == 3, F.concat(F.lit("N"), user.cast("string"))).alias("DisplayName"),
        after(15 * 60).alias("TimeUaRemovedAt"),
        F.when(user % 4 == 0, "0001-01-01T00:00:00.0000000").otherwise(after(20 * 60)).alias("TimePatientTransferredAt"),
    )


def timing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("base") + F.col("i").cast("bigint") * F.lit(600 * MICROS)
    return (
        _cases(spark, sf_dir)
        .select("*", F.posexplode(text_array(LABELS)).alias("i", "label"))
        .select(
            *KEYS,
            F.concat(F.col("case_id"), F.lit(".csv")).alias("source_file"),
            (F.col("i") + 2).cast("bigint").alias("row_number"),
            "label",
            F.when((F.col("user_id") + F.col("i")) % 13 == 0, "soon").otherwise(_stamp(start)).alias("start_text"),
            F.when((F.col("user_id") + F.col("i")) % 7 == 0, "").otherwise(_stamp(start + F.lit(480 * MICROS)))
            .alias("end_text"),
        )
    )


# Files of a case by user_id mod 6.
FILES = (
    ("local.db",), ("_s1/local.db",), ("a/_x/local.db", "b/_x/local.db"), ("Session1.zip",),
    ("TDC Sessions/_s.zip", "local.db"), ("notes.txt",),
)


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[text_array(files) for files in FILES])
    return _cases(spark, sf_dir).select(
        *KEYS, F.explode(F.get(kinds, (F.col("user_id") % 6).cast("int"))).alias("relative_path")
    ).withColumn("path", F.concat_ws("/", *KEYS, "relative_path"))


def sheet_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """keys, text of a timing sheet per case, in nine shapes by user_id mod 9 (8: the case has no sheet)."""
    # Rows of one case: six.
    rows = timing_log(spark, sf_dir).groupBy(*KEYS).agg(F.sort_array(F.collect_list(
        F.struct("row_number", "label", "start_text", "end_text"))).alias("r"))
    sheets = _cases(spark, sf_dir).join(rows, KEYS).filter(F.col("user_id") % 9 != 8)
    kind, odd = F.col("user_id") % 9, F.col("user_id") % 2 == 1

    def lines(form: str) -> Column:
        return F.transform("r", lambda r: F.format_string(form, r["label"], r["start_text"], r["end_text"], r["row_number"]))

    def sheet(header: str, rows: Column) -> Column:
        return F.concat(F.array(F.lit(header)), rows)

    named = lines("%1$s,%2$s,%3$s")
    shapes = [
        sheet("Events,TimeSTART,TimeEND", named),
        sheet('"TimeEND", Note , Events ,"TimeSTART"', lines('"%3$s","a ""quoted"", note","%1$s",%2$s')),
        sheet("No,Site,What,From,To", lines("%4$d,x,%1$s,%2$s,%3$s")),
        F.transform(sheet("\ufeffEvents,TimeSTART,TimeEND", named), lambda line: F.concat(line, F.lit("\r"))),
        sheet("Events,TimeSTART,TimeEND", F.concat(F.slice(named, 1, 3), F.array(F.lit(" , ,")), F.slice(named, 4, 3))),
        sheet("Events,TimeSTART,TimeEND", F.concat(F.slice(named, 1, 2), F.transform(F.slice("r", 3, 1), lambda r: r["label"]), F.slice(named, 4, 3))),
        F.when(odd, F.array(F.lit(""))).otherwise(F.array(F.lit("Events,TimeSTART,TimeEND"))),
        sheet("A,B", named),
    ]
    text = F.when(kind == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], 1):
        text = text.when(kind == i, shape)
    return sheets.select(*KEYS, F.array_join(text, "\n").alias("text"))


def payload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows whose columns are fields of a JSON payload, in three versions by case number mod 3 (sites have all three)."""
    version = F.substring("case_id", 6, 20).cast("bigint") % 3
    common = [F.col("raw_timestamp").alias("TimeStamp"), F.col("raw_event_type").alias("AuditRecordBase_Type")]
    segment, kind = F.col("raw_segment_id"), F.col("raw_event_kind")
    old = F.struct(*common, segment.alias("TreatmentId"), F.lit("k").alias("SignalHelpKey"))
    middle = F.struct(*common, segment.alias("SegmentId"), kind.alias("EventKind"))
    new = F.struct(*common, segment.alias("SegmentId"), kind.alias("EventKind"), (kind * 0.5 + 0.25).cast("double").alias("Temperature"))
    keep = {"ignoreNullFields": "false"}
    return raw_events(spark, sf_dir).select(
        *KEYS, "row_number",
        F.when(version == 0, F.to_json(old, keep)).when(version == 1, F.to_json(middle, keep)).otherwise(F.to_json(new, keep)).alias("raw_payload"),
    )


def local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, site_code, zone, wall_text: wall clocks of nights on which the zone's clocks change, some of them no times."""
    user, k = F.col("user_id"), F.get_json_object("props", "$.k").cast("bigint")
    east, spring = user % 4 < 2, user % 2 == 0
    night = F.when(east & spring, "2024-03-10").when(east, "2024-11-03").when(spring, "2024-03-31").otherwise("2024-10-27")
    minutes = k * 3
    clock = F.format_string("%02d:%02d:00", F.floor(minutes / 60), minutes % 60)
    return table(spark, sf_dir, "events").select(
        "event_id", _site(user).alias("site_code"), F.when(east, "America/New_York").otherwise("Europe/Berlin").alias("zone"),
        F.when(k == 99, "soon").otherwise(F.concat_ws(" ", night, clock)).alias("wall_text"),
    )


def state_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site_code, value: the log as lines of CSV, with synonyms for two columns by site and some broken lines."""
    raw = raw_events(spark, sf_dir)
    seconds = (F.col("row_number") * 7 % 1000).cast("string")
    number = F.when(F.col("row_number") % 97 == 5, F.lit("many")).otherwise(seconds)
    line = F.concat_ws(",", "case_id", F.col("row_number").cast("string"), F.col("raw_timestamp"), F.trim("raw_event_type"), number)
    value = F.when(F.col("row_number") % 89 == 7, F.concat("case_id", F.lit(",x"))).otherwise(line)
    return raw.select("site_code", value.alias("value"))
