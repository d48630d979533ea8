"""Timing sheets of any number of sites: one CSV file per case, with named or positional columns.

The lines come from Spark's text reader, which splits large files.  A line's number needs no window over its file: the lines
of one split have consecutive ids, so a count per split, summed over the earlier splits of the file, is all that is missing.
A line break ends a record, inside quotes too.

A file per case costs a listing, an opening and a place on the driver each, whatever its size.  Landed sheets are a parquet
table of their texts instead, many sheets a file; its blocks take the place of a file's splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.workflow import KEYS, text_array

# Header names, and the 0-based positions used when they are absent.
HEADERS = ("Events", "TimeSTART", "TimeEND")
POSITIONS = (2, 3, 4)
#: Site and case in a sheet's path.
SITE_TREE = r"([^/]+)/TimingLogs/([^/]+)\.csv$"
#: The same where Spark wrote the sheets, one folder a case.
CASE_FOLDERS = r"site_code=([^/]+)/case_id=([^/]+)/[^/]+$"
BYTE_ORDER_MARK = "﻿"

#: Landed sheets.  A sheet is the texts of its blocks in order; each but the last ends with a line break.
LANDED = "source_file string, block bigint, text string"

EMPTY, NO_COLUMNS, HEADER_ONLY, SHORT_ROW = (
    "timing_log_empty", "timing_log_columns_missing", "timing_log_header_only", "timing_log_short_row")
BLANK_ROW = "timing_log_blank_row"


def _named(path: Column, pattern: str) -> list[Column]:
    # Paths of Spark's file sources are percent-encoded; a plus sign in them is a plus sign.
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return [F.regexp_extract(plain, pattern, i + 1).alias(key) for i, key in enumerate(KEYS)]


def sheet_files(spark: SparkSession, folder: str, pattern: str = SITE_TREE, landed: bool = False) -> DataFrame:
    """keys, source_file, n_bytes of every sheet below ``folder`` or, if ``landed``, in the table there."""
    if landed:
        size = F.sum(F.octet_length("text")).cast("bigint")
        found = spark.read.schema(LANDED).parquet(folder).groupBy("source_file").agg(size.alias("n_bytes"))
    else:
        found = _listed(spark, folder)
    return found.select(*_named(F.col("source_file"), pattern), "source_file", "n_bytes").filter(F.col("case_id") != "")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """source_file, n_bytes of every file below ``folder``; the files are listed, not read.

    Spark leaves files without a byte out of a scan, so the names come from its file index, which is on the driver anyway.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    meta = F.col("_metadata")
    sizes = listed.select(meta["file_path"].alias("source_file"), meta["file_size"].alias("n_bytes"))
    names = spark.createDataFrame([(_plain_scheme(name),) for name in listed.inputFiles()], "source_file string")
    return names.join(sizes, "source_file", "left").withColumn("n_bytes", F.coalesce("n_bytes", F.lit(0)))


def _plain_scheme(name: str) -> str:
    """The form in which the file metadata has a local file's name."""
    return "file:/" + name.removeprefix("file:").lstrip("/") if name.startswith("file:") else name


def land_sheets(spark: SparkSession, folder: str, path: str, pattern: str = SITE_TREE) -> None:
    """Write the sheets below ``folder`` to a table of landed sheets at ``path``, a block each, in one pass over the files."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    texts = read.select(F.col("_metadata")["file_path"].alias("source_file"), F.col("content").cast("string").alias("text"))
    found = sheet_files(spark, folder, pattern).select("source_file").join(texts, "source_file", "left")
    found.select("source_file", F.lit(0).cast("bigint").alias("block"), F.coalesce("text", F.lit("")).alias("text")).write.parquet(path)


def _file_lines(spark: SparkSession, folder: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("recursiveFileLookup", True).text(folder).select(
        meta["file_path"].alias("source_file"), meta["file_block_start"].alias("split"), "value",
        F.monotonically_increasing_id().alias("id"),
    )


def _landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines end as they do for Spark's text reader; a break at the end of a block starts no line."""
    cut = F.split("text", "\r\n|\r|\n")
    lines = F.when(F.element_at(cut, -1) == "", F.slice(cut, F.lit(1), F.size(cut) - 1)).otherwise(cut)
    return spark.read.schema(LANDED).parquet(path).select(
        "source_file", F.col("block").alias("split"), F.posexplode(lines).alias("at", "value"),
    ).select("source_file", "split", "value", F.col("at").cast("bigint").alias("id"))


def sheet_lines(spark: SparkSession, folder: str, pattern: str = SITE_TREE, landed: bool = False) -> DataFrame:
    """keys, source_file, line_number (1 = header), cells of every line of the sheets below ``folder`` or landed there."""
    read = _landed_lines(spark, folder) if landed else _file_lines(spark, folder)
    lines = stored(read.filter(F.regexp_extract("source_file", pattern, 0) != ""), "sheet-lines")
    # One row per split of a file (or block) from here to the join.
    splits = lines.groupBy("source_file", "split").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.expr("sum(n) OVER (PARTITION BY source_file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = splits.select("source_file", "split", (F.coalesce(earlier, F.lit(0)) - F.col("first") + 1).alias("offset"))
    numbered = lines.join(offsets, ["source_file", "split"]).withColumn("line_number", F.col("id") + F.col("offset"))
    text = F.when(F.col("line_number") == 1, F.ltrim(F.col("value"), F.lit(BYTE_ORDER_MARK))).otherwise(F.col("value"))
    return numbered.select(*_named(F.col("source_file"), pattern), "source_file", "line_number", csv_cells(text).alias("cells"))


def csv_cells(line: Column) -> Column:
    """The cells of a CSV record; a quote counts as one only at a cell's start, and an empty line has no cells."""
    quoted = r'"[^"]*+(?:""[^"]*+)*+"'
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",((?:{quoted})?[^,]*)"), F.lit(1))
    inside = rf"^({quoted})?(.*)$"

    def plain(cell: Column) -> Column:
        head = F.regexp_extract(cell, inside, 1)
        body = F.replace(F.substring(head, F.lit(2), F.length(head) - 2), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), F.concat(body, F.regexp_extract(cell, inside, 2))).otherwise(cell)

    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.transform(raw, plain))


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with their sheet's number of lines and the places of its three columns (NULL: it has no usable header)."""
    head = F.transform(F.max(F.when(F.col("line_number") == 1, F.col("cells"))), lambda name: F.trim(name))
    sheets = lines.groupBy("source_file").agg(head.alias("names"), F.max("line_number").alias("n_lines"))
    named = F.size(F.array_intersect("names", text_array(HEADERS))) == len(HEADERS)
    at = F.when(named, F.array(*[F.array_position("names", h).cast("int") - 1 for h in HEADERS])).when(
        F.size("names") >= 5, F.array(*[F.lit(p) for p in POSITIONS]))
    return lines.join(sheets.select("source_file", "n_lines", at.alias("at")), "source_file")


def _cell(i: int) -> Column:
    return F.get("cells", F.col("at")[i])


def _is_short() -> Column:
    return F.size("cells") <= F.array_max("at")


def _entries(lines: DataFrame) -> DataFrame:
    rows = _placed(lines).filter((F.col("line_number") > 1) & F.col("at").isNotNull() & ~_is_short())
    return rows.select(
        *KEYS, "source_file", F.col("line_number").alias("row_number"), _cell(0).alias("label"), _cell(1).alias("start_text"),
        _cell(2).alias("end_text"),
    ).withColumn("is_blank", F.trim(F.concat("label", "start_text", "end_text")) == "")


def sheet_rows(lines: DataFrame) -> DataFrame:
    """Data rows of usable sheets: keys, source_file, row_number, label, start_text, end_text."""
    return _entries(lines).filter(~F.col("is_blank")).drop("is_blank")


def blank_row_warnings(lines: DataFrame) -> DataFrame:
    return _entries(lines).filter("is_blank").select(
        *KEYS, F.lit(BLANK_ROW).alias("category"), "row_number",
        F.element_at(F.split("source_file", "/"), -1).alias("detail"),
    )


def sheet_errors(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """keys, row_number, error of sheets that fail their case: empty (needs ``files``), no usable header, header only, short row."""
    problem = (
        F.when(F.col("at").isNull(), NO_COLUMNS).when(F.col("n_lines") == 1, HEADER_ONLY)
        .when((F.col("line_number") > 1) & _is_short(), SHORT_ROW)
    )
    bad = _placed(lines).withColumn("error", problem).filter(F.col("error").isNotNull())
    found = bad.groupBy(*KEYS).agg(F.min("line_number").alias("row_number"), F.min_by("error", "line_number").alias("error"))
    if files is None:
        return found
    empty = files.filter(F.col("n_bytes") == 0)
    return found.unionByName(empty.select(*KEYS, F.lit(1).cast("bigint").alias("row_number"), F.lit(EMPTY).alias("error")))


def case_sheets(cases: DataFrame, files: DataFrame, lines: DataFrame) -> DataFrame:
    """Every case of ``cases`` with its sheet, if it has one: keys, source_file, n_entries, n_blank, error."""
    counts = _entries(lines).groupBy(*KEYS).agg(
        F.count_if(~F.col("is_blank")).alias("n_entries"), F.count_if("is_blank").alias("n_blank"))
    return (
        cases.select(*KEYS).join(files.select(*KEYS, "source_file"), KEYS, "left").join(counts, KEYS, "left")
        .join(sheet_errors(lines, files).select(*KEYS, "error"), KEYS, "left")
        .select(*KEYS, "source_file", *[
            F.when(F.col("error").isNull(), F.coalesce(n, F.lit(0))).alias(n) for n in ("n_entries", "n_blank")], "error")
    )
