"""Tabular inputs with an explicit schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewatch.functions.coerce import blank_to_null, first_present, optional_int

# Intermediate tables of the script profile, as they are handed over in CSV.
STATES_SCHEMA = (
    "site_code string, case_id string, row_number bigint, timestamp timestamp_ntz, event_type string, "
    "segment_id string, event_kind int, state string, start_sec double, duration_sec double"
)
#: Holds a line that does not fit the schema.
BAD_LINE = "bad_line"


def read_table(spark: SparkSession, path: str, schema: str, form: str = "csv") -> DataFrame:
    """No schema inference: one pass over the data, and types that do not depend on it."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if form == "csv" else reader.format(form).load(path)


def read_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV rows with ``source_file`` and ``bad_line``: the line's text where it has other fields than the schema, else NULL."""
    reader = spark.read.schema(f"{schema}, {BAD_LINE} string").option("header", header).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", BAD_LINE)
    return reader.csv(path).withColumn("source_file", F.col("_metadata.file_path"))


def _is_bad(rows: DataFrame) -> Column:
    """Whether a row's line does not fit.

    Spark only parses the fields that a plan reads, and finds only their faults; so every field takes part, by a comparison
    with what no line holds, and the answer does not depend on the columns that a consumer asks for.
    """
    fields = [F.col(f"`{c}`").cast("string") for c in rows.columns if c not in (BAD_LINE, "source_file")]
    return F.col(BAD_LINE).isNotNull() | F.coalesce(F.concat(*fields) == "\0", F.lit(False))


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the text of those that do not with their file."""
    bad = _is_bad(rows)
    return rows.filter(~bad).drop(BAD_LINE), rows.filter(bad).select("source_file", BAD_LINE)


def bad_rows(rows: DataFrame, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """Rows and bad rows per file (or other keys)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(_is_bad(rows)).alias("n_bad"))


def unified(df: DataFrame, synonyms: Mapping[str, Sequence[str]], whole_numbers: Sequence[str] = ()) -> DataFrame:
    """Text columns under one name: the first non-blank of each name's synonyms; ``whole_numbers`` are read leniently as numbers.

    A name without any of its synonyms is an error before the plan runs.
    """
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    blank = texts.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in texts.columns])
    found = blank.select(*[first_present(blank, names).alias(name) for name, names in synonyms.items()])
    return found.withColumns({name: optional_int(F.col(name)) for name in whole_numbers}) if whole_numbers else found
