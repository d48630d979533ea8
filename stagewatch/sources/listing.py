"""Find the database files of every case and choose one, from a plain listing of file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewatch.functions.ordered import ranked
from stagewatch.sources.files import list_case_files
from stagewatch.workflow import KEYS

# File patterns inside a case folder, in order of preference.
DB_PATTERNS = (r"^[^/.][^/]*/_[^/]*/local\.db$", r"^_[^/]*/local\.db$", r"^local\.db$")
ZIP_PATTERNS = (
    r"^TDC Sessions/_[^/]*\.zip$", r"^_201[^/]*\.zip$", r"^[^/.][^/]*/_201[^/]*\.zip$", r"^Session[^/]*\.zip$",
)
NO_CANDIDATES = "no_database_candidates_found"
MANY_DATABASES = "multiple_unzipped_database_candidates"
MANY_ZIPS = "multiple_zip_candidates"
TIMING_FOLDER = "TimingLogs"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths below ``root/<site>/<case>/…``; only names are read, never content."""
    return list_case_files(spark, root, skip=(TIMING_FOLDER,))


def _pattern_index(patterns: tuple[str, ...]) -> Column:
    """Index of the first pattern the path matches, so a path counts once."""
    return F.coalesce(*[F.when(F.col("relative_path").rlike(p), F.lit(i)) for i, p in enumerate(patterns)])


def _candidates(patterns: tuple[str, ...]) -> Column:
    # collect_list skips NULLs: only matching paths of a case are gathered.
    index = _pattern_index(patterns)
    entry = F.when(index.isNotNull(), F.struct(index.alias("p"), F.lower("path").alias("low"), F.col("path")))
    return F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["path"])


def discover_cases(files: DataFrame, roster: DataFrame | None = None, largest: int | None = None) -> DataFrame:
    """One row per case: numbered by lower-cased name, candidate paths in preference order, warnings.

    ``roster`` (keys) adds case folders that hold no file at all; ``largest`` is the number of cases of the largest site,
    where it is known.
    """
    found = files.groupBy(*KEYS).agg(
        _candidates(DB_PATTERNS).alias("databases"), _candidates(ZIP_PATTERNS).alias("zips")
    )
    if roster is not None:
        none = F.array().cast("array<string>")
        found = roster.select(*KEYS).distinct().join(found, KEYS, "left").withColumns({
            "databases": F.coalesce("databases", none), "zips": F.coalesce("zips", none),
        })
    warnings = F.array_compact(F.array(
        F.when((F.size("databases") == 0) & (F.size("zips") == 0), NO_CANDIDATES),
        F.when(F.size("databases") > 1, MANY_DATABASES),
        F.when(F.size("zips") > 1, MANY_ZIPS),
    ))
    order = [F.lower("case_id"), F.col("case_id")]
    return ranked(found, ["site_code"], order, "discovery_order", largest=largest).withColumn("warnings", warnings)


def first_cases(cases: DataFrame, n: int | None = None, suffix: str | None = None) -> DataFrame:
    """The first ``n`` cases of each site, and/or those whose id ends in ``suffix``."""
    if n is not None:
        cases = cases.filter(F.col("discovery_order") <= n)
    return cases if suffix is None else cases.filter(F.col("case_id").endswith(suffix))


def resolve_sources(
    cases: DataFrame,
    policy: str = "strict",
    allow_ambiguous: bool = False,
    candidate_index: int | None = None,
    member_index: int | None = None,
    zip_members: DataFrame | None = None,
) -> DataFrame:
    """Choose one source per case; failures are statuses, not exceptions.

    ``strict``: unzipped beats zipped, several candidates fail the case unless an index is given.
    ``first``: the first candidate wins.  ``zip_members`` (path, members) says which archives hold a
    database; without it every archive counts as holding ``local.db``.
    """
    if policy not in ("strict", "first"):
        raise ValueError(f"policy must be strict or first, got {policy!r}")
    out = cases
    if zip_members is None:
        out = out.withColumn("archives", F.transform("zips", lambda z: F.struct(
            z.alias("path"), F.array(F.lit("local.db")).alias("members"))))
    else:
        held = cases.select(*KEYS, F.posexplode("zips").alias("at", "path")).join(zip_members, "path", "left")
        held = held.groupBy(*KEYS).agg(F.sort_array(F.collect_list(
            F.struct("at", "path", F.coalesce("members", F.array().cast("array<string>")).alias("members")))).alias("h"))
        out = out.join(held, KEYS, "left").withColumn("archives", F.transform(
            F.coalesce("h", F.array().cast("array<struct<at:int,path:string,members:array<string>>>")),
            lambda h: F.struct(h["path"].alias("path"), h["members"].alias("members")))).drop("h")
    out = out.withColumns({
        "empty_zips": F.filter("archives", lambda a: F.size(a["members"]) == 0),
        "archives": F.filter("archives", lambda a: F.size(a["members"]) > 0),
    })
    unzipped = F.size("databases") > 0
    paths = F.when(unzipped, F.col("databases")).otherwise(F.transform("archives", lambda a: a["path"]))
    out = out.withColumn("candidates", paths)
    wanted, member_wanted = (0, 0) if policy == "first" else (
        (candidate_index, member_index) if allow_ambiguous else (None, None))

    def chosen(n: Column, index: int | None) -> Column:
        usable = F.lit(None).cast("int") if index is None else F.when((F.lit(index) >= 0) & (F.lit(index) < n), F.lit(index))
        return F.when(n == 1, F.lit(0)).otherwise(usable)

    out = out.withColumn("pick", chosen(F.size("candidates"), wanted))
    members = F.when(~unzipped, F.get(F.col("archives"), F.col("pick"))["members"])
    out = out.withColumn("members", members)
    out = out.withColumn("member_pick", F.when(~unzipped, chosen(F.size("members"), member_wanted)))
    none_found = F.size("candidates") == 0
    status = (
        F.when((F.size("databases") == 0) & (F.size("zips") == 0), "no_candidates")
        .when(none_found, "not_found")
        .when(F.col("pick").isNull(), "ambiguous")
        .when(~unzipped & F.col("member_pick").isNull(), "ambiguous_member")
        .otherwise("resolved")
    )
    out = out.withColumn("status", status)
    done = F.col("status") == "resolved"
    path = F.get("candidates", F.col("pick"))
    member = F.get("members", F.col("member_pick"))
    rest = F.array_except("candidates", F.array(path))
    other_members = F.array_except(F.coalesce("members", F.array(member)), F.array(member))
    return out.select(
        *KEYS, "discovery_order", "status",
        F.when(done, F.when(unzipped, "unzipped").otherwise("zip_extracted")).alias("source_type"),
        F.when(done, F.when(unzipped, "unzipped_precedence").otherwise("zip_precedence")).alias("resolution_rule"),
        F.when(done, path).alias("source_path"),
        F.when(done, member).alias("zip_member"),
        F.when(done, F.when(unzipped, rest).otherwise(F.concat(rest, other_members)))
        .otherwise(F.col("candidates")).alias("ambiguous_candidates"),
        F.concat(F.col("warnings"), F.transform(
            "empty_zips", lambda z: F.concat(F.lit("zip_without_localdb:"), z["path"]))).alias("warnings"),
    )


def source_warnings(resolved: DataFrame) -> DataFrame:
    """Long form; these carry no case prefix in their text and therefore no category of their own."""
    return resolved.select(*KEYS, F.explode("warnings").alias("detail")).select(
        *KEYS, F.lit("uncategorized").alias("category"), F.lit(None).cast("bigint").alias("row_number"), "detail"
    )
