"""Exact quantiles of BIGINT values without holding a group in one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here values are counted in
two levels instead: coarse buckets of 2**21 units (2.1 s when the unit is a microsecond), then the
single values inside the one or two buckets that hold each wanted rank.  A task sees at most
2**21 distinct values, or one row per coarse bucket of the value range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE_BITS = 21


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, wanted: Mapping[str, float]
) -> DataFrame:
    """One row per group: ``keys``, ``n`` and one DOUBLE per wanted quantile (linear rule)."""
    counted = (
        df.select(*keys, value.cast("bigint").alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy(*keys, "v")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("coarse", F.shiftright("v", COARSE_BITS))
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counted.groupBy(*keys, "coarse")
        .agg(F.sum("c").alias("c"))
        .select("*", F.coalesce(F.sum("c").over(upto), F.lit(0)).alias("before"), F.sum("c").over(group).alias("n"))
    )
    names = list(wanted)
    ranks = F.array(*[
        F.struct(
            F.lit(i).alias("q"), F.lit(side).alias("side"),
            rounding(F.lit(wanted[name]) * (F.col("n") - 1)).cast("bigint").alias("rank"),
        )
        for i, name in enumerate(names)
        for side, rounding in (("lo", F.floor), ("hi", F.ceil))
    ])
    targets = (
        buckets.select(*keys, "coarse", "n", "before", "c", F.explode(ranks).alias("t"))
        .filter((F.col("t.rank") >= F.col("before")) & (F.col("t.rank") < F.col("before") + F.col("c")))
        .select(*keys, "coarse", "n", "t.q", "t.side", (F.col("t.rank") - F.col("before")).alias("rank"))
    )
    inside = Window.partitionBy(*keys, "coarse").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    # Only the one or two coarse buckets of each wanted rank are looked into.
    wanted_buckets = targets.select(*keys, "coarse").distinct()
    values = counted.join(wanted_buckets, [*keys, "coarse"], "left_semi").select(
        *keys, "coarse", "v", "c", F.coalesce(F.sum("c").over(inside), F.lit(0)).alias("before")
    )
    found = targets.join(values, [*keys, "coarse"]).filter(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("c"))
    )
    picked = found.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[
            F.max(F.when((F.col("q") == i) & (F.col("side") == side), F.col("v"))).alias(f"{side}{i}")
            for i in range(len(names))
            for side in ("lo", "hi")
        ],
    )
    position = [F.lit(wanted[name]) * (F.col("n") - 1) for name in names]
    return picked.select(
        *keys,
        "n",
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (position[i] - F.floor(position[i]))).alias(name)
            for i, name in enumerate(names)
        ],
    )
