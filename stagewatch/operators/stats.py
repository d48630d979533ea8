"""Site statistics over the per-case phase minutes (long form: site_code, case_id, phase, minutes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.coerce import capped
from stagewatch.functions.ordered import ranked
from stagewatch.functions.quantiles import exact_quantiles
from stagewatch.operators.summary import MINUTE_US
from stagewatch.workflow import KEYS

GROUP = ["site_code", "phase"]
MAX_MINUTES = 1000.0


def cap_minutes(long: DataFrame, max_minutes: float = MAX_MINUTES) -> DataFrame:
    """Values above the cap become NULL."""
    return long.withColumn("minutes", capped(F.col("minutes"), max_minutes))


def _as_us(minutes: Column) -> Column:
    return F.round(minutes * F.lit(float(MINUTE_US))).cast("bigint")


def _quantile_minutes(long: DataFrame, keys: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    found = exact_quantiles(long, keys, _as_us(F.col("minutes")), wanted).drop("n")
    return found.withColumns({name: F.col(name) / float(MINUTE_US) for name in wanted})


def state_stats(long: DataFrame, max_minutes: float = MAX_MINUTES) -> DataFrame:
    """Per phase N, mean, median, sample deviation; NULLs and zeros are left out."""
    rows = cap_minutes(long, max_minutes).filter(F.col("minutes").isNotNull() & (F.col("minutes") != 0))
    moments = rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.avg("minutes").alias("mean"), F.stddev_samp("minutes").alias("std"),
    )
    return moments.join(_quantile_minutes(rows, GROUP, {"median": 0.5}), GROUP)


def phase_variability(long: DataFrame, max_minutes: float = MAX_MINUTES) -> DataFrame:
    """Per phase N, mean, median, deviation, CV, min, max; zeros are kept."""
    rows = cap_minutes(long, max_minutes).filter(F.col("minutes").isNotNull())
    moments = rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.avg("minutes").alias("mean"), F.stddev_samp("minutes").alias("sd"),
        F.min("minutes").alias("min"), F.max("minutes").alias("max"),
    )
    cv = F.when(F.col("mean") > 0, F.col("sd") / F.col("mean"))
    return moments.withColumn("cv", cv).join(_quantile_minutes(rows, GROUP, {"median": 0.5}), GROUP)


def cv_ranking(variability: DataFrame) -> DataFrame:
    """Position of each phase of a site by falling CV (few rows: one per phase)."""
    order = Window.partitionBy("site_code").orderBy(F.col("cv").desc(), F.col("phase"))
    return variability.filter(F.col("cv").isNotNull()).select(*GROUP, "cv", F.row_number().over(order).alias("cv_rank"))


def phase_outliers(long: DataFrame, z: float = 3.0, max_minutes: float = MAX_MINUTES) -> DataFrame:
    """Cases whose minutes lie ``z`` sample deviations or more from the mean of their site and phase."""
    rows = cap_minutes(long, max_minutes).filter(F.col("minutes").isNotNull())
    # Means come from a map-side combined aggregate, not from a window over the whole phase.
    moments = rows.groupBy(*GROUP).agg(F.avg("minutes").alias("mean"), F.stddev_samp("minutes").alias("sd"))
    scored = rows.join(moments.filter(F.col("sd") > 0), GROUP)
    return scored.withColumn("z", (F.col("minutes") - F.col("mean")) / F.col("sd")).filter(F.abs("z") >= z)


def phase_histogram(long: DataFrame, bins: int = 20, max_minutes: float = MAX_MINUTES) -> DataFrame:
    """Equal-width bins between the smallest and largest positive value; empty bins are listed."""
    rows = cap_minutes(long, max_minutes).filter(F.col("minutes") > 0)
    edges = rows.groupBy(*GROUP).agg(F.min("minutes").alias("lo"), F.max("minutes").alias("hi"))
    # A single value gets a unit-wide range around it.
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        *GROUP, F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    placed = F.least(F.floor((F.col("minutes") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = rows.join(edges, GROUP).groupBy(*GROUP, placed.alias("bin")).agg(F.count(F.lit(1)).alias("n_cases"))
    grid = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, [*GROUP, "bin"], "left").select(
        *GROUP, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"), F.coalesce("n_cases", F.lit(0)).alias("n_cases"),
    )


def box_stats(long: DataFrame, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier count per phase; optional closed range filter."""
    rows = long.filter(F.col("minutes").isNotNull())
    if lo is not None:
        rows = rows.filter(F.col("minutes") >= lo)
    if hi is not None:
        rows = rows.filter(F.col("minutes") <= hi)
    quartiles = _quantile_minutes(rows, GROUP, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("minutes").between(low, high)
    return (
        rows.join(quartiles, GROUP).groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col("minutes"))).alias("whisker_lo"),
            F.max(F.when(inside, F.col("minutes"))).alias("whisker_hi"),
            F.count_if(~inside).alias("n_outliers"),
        )
        # Whiskers never end inside the box.
        .withColumns({"whisker_lo": F.least("whisker_lo", "q1"), "whisker_hi": F.greatest("whisker_hi", "q3")})
    )


def implausible_cases(
    long: DataFrame, phase: str = "Treating", lo: float = 1.0, hi: float = 240.0, max_minutes: float = MAX_MINUTES
) -> DataFrame:
    """Cases whose phase is shorter than ``lo`` or longer than ``hi`` minutes."""
    rows = cap_minutes(long, max_minutes).filter(F.col("phase") == phase)
    return rows.filter((F.col("minutes") < lo) | (F.col("minutes") > hi))


def describe(long: DataFrame, keys: Sequence[str] = ("site_code",)) -> DataFrame:
    """count, mean, std, min, quartiles, max of the minutes — exact, not sketched."""
    rows = long.filter(F.col("minutes").isNotNull())
    moments = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.avg("minutes").alias("mean"), F.stddev_samp("minutes").alias("std"),
        F.min("minutes").alias("min"), F.max("minutes").alias("max"),
    )
    return moments.join(_quantile_minutes(rows, keys, {"p25": 0.25, "p50": 0.5, "p75": 0.75}), list(keys))


def longest_cases(summary: DataFrame, n: int = 5, metric: str = "MRITotal") -> DataFrame:
    """The ``n`` longest cases of each site.

    Spark keeps the best ``n`` per site inside every task before the shuffle (a window group limit),
    so a large site is never ranked in one task.
    """
    order = Window.partitionBy("site_code").orderBy(F.col("minutes").desc(), F.col("case_id"))
    rows = summary.filter(F.col(metric).isNotNull()).select(*KEYS, F.col(f"`{metric}`").alias("minutes"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def cohorts(summary: DataFrame, largest: int | None = None) -> DataFrame:
    """Case number within the site and its slice: 1-50, 51-75, 76+.  ``largest``: cases of the largest site, where known."""
    numbered = ranked(summary, ["site_code"], [F.col("case_id")], "Pt", largest=largest)
    return numbered.withColumn(
        "cohort", F.when(F.col("Pt") <= 50, "1-50").when(F.col("Pt") <= 75, "51-75").otherwise("76+")
    )


def case_trend(long: DataFrame, max_minutes: float = MAX_MINUTES, largest: int | None = None) -> DataFrame:
    """Minutes against the position of the case in id order, NULLs removed first."""
    rows = cap_minutes(long, max_minutes).filter(F.col("minutes").isNotNull())
    return ranked(rows, GROUP, [F.col("case_id")], "case_index", largest=largest)


def site_document(variability: DataFrame, outliers: DataFrame, cases: DataFrame, z: float = 3.0) -> DataFrame:
    """One JSON document per site: number of cases, per-phase statistics, outlier count."""
    stats = F.struct("phase", F.struct(
        F.col("n").alias("N"), F.col("mean").alias("Mean"), F.col("median").alias("Median"), F.col("sd").alias("SD"),
        F.col("cv").alias("CV"), F.col("min").alias("Min"), F.col("max").alias("Max"),
    ))
    # At most one row per phase and site is collected here.
    phases = variability.groupBy("site_code").agg(F.map_from_entries(F.sort_array(F.collect_list(stats))).alias("phases"))
    found = outliers.groupBy("site_code").agg(F.count(F.lit(1)).alias("n_outliers"))
    counted = cases.groupBy("site_code").agg(F.count(F.lit(1)).alias("n_cases"))
    return counted.join(phases, "site_code", "left").join(found, "site_code", "left").select(
        "site_code",
        F.to_json(F.struct(
            F.col("site_code").alias("site"), "n_cases", "phases",
            F.struct(F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"), F.lit(z).alias("z_threshold")).alias("outliers"),
        )).alias("document"),
    )
