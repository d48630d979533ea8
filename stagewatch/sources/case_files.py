"""Read SQLite case files, plain or inside zip archives, on the executors.

One chosen file is one unit of work, so only resolved files are ever read.  The decoder is the only
Python on the data path; it streams rows out in batches and everything after it is DataFrame work.
"""

from __future__ import annotations

import io
import json
import sqlite3
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.coerce import blank_to_null, optional_int
from stagewatch.sources.files import BATCH, open_root, read_bytes, spread
from stagewatch.workflow import KEYS

AUDIT, SESSIONS = "AuditLogRecords", "Sessions"
ROW_SCHEMA = "site_code string, case_id string, path string, member string, table_name string, row_number bigint, payload string, error string"


def _database(content: bytes, member: str | None) -> bytes:
    if member is None:
        return content
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        return archive.read(member)


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _text(value) -> str:
    return json.dumps(value, sort_keys=True, default=lambda v: v.hex() if isinstance(v, bytes) else str(v))


def _rows(database: bytes) -> Iterator[tuple[str, int, str]]:
    """(table, row number from 1, JSON row); row number 0 describes the table."""
    db = sqlite3.connect(":memory:")
    try:
        db.deserialize(database)
        tables = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")]
        if AUDIT not in tables:
            raise LookupError(f"missing table {AUDIT}")
        for table in sorted(tables, key=str.lower):
            columns = [r[1] for r in db.execute(f"PRAGMA table_info({_quote(table)})")]
            count = db.execute(f"SELECT count(*) FROM {_quote(table)}").fetchone()[0]
            yield table, 0, _text({"columns": columns, "rows": count})
            if table in (AUDIT, SESSIONS):
                for i, row in enumerate(db.execute(f"SELECT * FROM {_quote(table)}"), start=1):
                    yield table, i, _text(dict(zip(columns, row)))
    finally:
        db.close()


def case_rows(resolved: DataFrame, root: str) -> DataFrame:
    """Every row of the audit and session tables of the chosen file of each case.

    A file that cannot be read, or lacks the audit table, gives one row with ``error`` set.
    """
    columns = [c.split()[0] for c in ROW_SCHEMA.split(", ")]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = open_root(root)
        for batch in batches:
            for site, case, path, member in zip(*[batch[c] for c in ("site_code", "case_id", "source_path", "zip_member")]):
                pending: list[tuple] = []
                try:
                    for table, number, payload in _rows(_database(read_bytes(system, path), member)):
                        pending.append((site, case, path, member, table, number, payload, None))
                        if len(pending) == BATCH:
                            yield pd.DataFrame(pending, columns=columns)
                            pending = []
                except (sqlite3.Error, zipfile.BadZipFile, LookupError) as problem:
                    pending.append((site, case, path, member, None, None, None, f"{type(problem).__name__}: {problem}"))
                if pending:
                    yield pd.DataFrame(pending, columns=columns)

    chosen = resolved.filter(F.col("status") == "resolved").select(*KEYS, "source_path", "zip_member")
    return spread(chosen, "source_path").mapInPandas(decode, ROW_SCHEMA)


def land(rows: DataFrame, path: str) -> DataFrame:
    """Write the decoded rows as parquet once and read them back.

    Everything below reads the rows several times; landed, each reader touches one table's folder
    and only the columns it needs, and no file is decoded twice.
    """
    rows.withColumn("table_name", F.coalesce("table_name", F.lit("unreadable"))).write.mode("overwrite").partitionBy(
        "site_code", "table_name").parquet(path)
    names = [c.split()[0] for c in ROW_SCHEMA.split(", ")]
    return rows.sparkSession.read.schema(ROW_SCHEMA).parquet(path).select(*names)


def zip_members(cases: DataFrame, root: str) -> DataFrame:
    """Members ending in ``local.db`` (any case) of every candidate archive."""
    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = open_root(root)
        for batch in batches:
            for path in batch["path"]:
                try:
                    with zipfile.ZipFile(system.open_input_file(path)) as archive:
                        names = [n for n in archive.namelist() if n.lower().endswith("local.db")]
                except zipfile.BadZipFile:
                    names = []
                yield pd.DataFrame({"path": [path], "members": [names]})

    archives = cases.select(F.explode("zips").alias("path"))
    return spread(archives, "path").mapInPandas(members, "path string, members array<string>")


def read_errors(rows: DataFrame) -> DataFrame:
    """Cases whose chosen file could not be read or lacks the audit table."""
    return rows.filter(F.col("error").isNotNull()).select(*KEYS, F.lit(None).cast("bigint").alias("row_number"), "error")


def _field(name: str):
    return F.get_json_object("payload", f"$.{name}")


def audit_events(rows: DataFrame) -> DataFrame:
    """Raw log rows in file order; the segment column may carry its older name."""
    return rows.filter((F.col("table_name") == AUDIT) & (F.col("row_number") > 0)).select(
        *KEYS, "row_number",
        blank_to_null(_field("TimeStamp")).alias("raw_timestamp"),
        blank_to_null(_field("AuditRecordBase_Type")).alias("raw_event_type"),
        blank_to_null(F.coalesce(_field("SegmentId"), _field("TreatmentId"))).alias("raw_segment_id"),
        optional_int(_field("EventKind"), "int").alias("raw_event_kind"),
        blank_to_null(_field("PatientId")).alias("patient_id"),
        F.col("payload").alias("raw_payload"),
    )


def session_rows(rows: DataFrame) -> DataFrame:
    """Session rows; a field absent from a file's schema is NULL here and flagged by ``session_columns``."""
    names = ("TimePatientSedatedAt", "TimeUaInsertedAt", "TimeUaRemovedAt", "TimePatientTransferredAt",
             "PatientId", "DisplayName", "FirstName", "LastName")
    return rows.filter((F.col("table_name") == SESSIONS) & (F.col("row_number") > 0)).select(
        *KEYS, "row_number", *[_field(n).alias(n) for n in names],
        F.json_object_keys("payload").alias("session_columns"),
    )


def catalog(rows: DataFrame) -> DataFrame:
    """Tables of every file with their columns and row counts."""
    described = rows.filter(F.col("row_number") == 0)
    return described.select(
        "path", "member", "table_name",
        F.from_json(F.get_json_object("payload", "$.columns"), "array<string>").alias("columns"),
        _field("rows").cast("bigint").alias("n_rows"),
    )
