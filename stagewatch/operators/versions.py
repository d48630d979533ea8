"""Log versions: which columns the rows of a log have, found in their JSON payload, and one table out of several versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.workflow import KEYS


def log_fields(rows: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """keys, column, value (VARIANT) of every field of every payload; a payload that is no JSON object has none."""
    document = rows.select(*KEYS, F.try_parse_json(payload).alias("document"))
    fields = document.sparkSession.tvf.variant_explode(F.col("document").outer())
    return document.lateralJoin(fields).filter(F.col("key").isNotNull()).select(*KEYS, F.col("key").alias("column"), "value")


def log_catalog(rows: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """keys, column, type, n_rows, n_null: the columns of every case's log, counted before anything is shuffled.

    ``type`` is the least type that all values of the column have; VOID where all are null.
    """
    return log_fields(rows, payload).groupBy(*KEYS, "column").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.is_variant_null("value")).alias("n_null"))


def case_versions(catalog: DataFrame) -> DataFrame:
    """keys, version (the names of the case's columns), n_rows, from ``log_catalog``."""
    # A log has a few dozen columns at most; the list is one name per column.
    names = F.concat_ws(",", F.sort_array(F.collect_list("column")))
    return catalog.groupBy(*KEYS).agg(names.alias("version"), F.max("n_rows").alias("n_rows"))


def version_summary(versions: DataFrame) -> DataFrame:
    return versions.groupBy("site_code", "version").agg(F.count(F.lit(1)).alias("n_cases"), F.sum("n_rows").alias("n_rows"))


def unified_log(rows: DataFrame, columns: Mapping[str, tuple[str, Sequence[str]]], payload: str = "raw_payload") -> DataFrame:
    """The payloads' fields as typed columns whatever the version: {name: (type, names of the field in the versions)}.

    A value that does not fit the type is NULL, and so is a field that the row's version lacks.
    """
    document = rows.withColumn("document", F.try_parse_json(payload))
    wanted = [
        F.coalesce(*[F.try_variant_get("document", f"$.{field}", kind) for field in fields]).alias(name)
        for name, (kind, fields) in columns.items()
    ]
    return document.select(*KEYS, "row_number", *wanted)
