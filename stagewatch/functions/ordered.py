"""Ordered, per-group computations that hold up when one group is huge.

A plain ``Window.partitionBy(keys)`` sends a whole group to one task.  :func:`slice_hot_groups` takes the rows of groups
above the row limit out, cuts them by range over (keys, order) into slices of about that many rows (``group_slice``), writes
them once, and puts them back beside the other rows, which stay as they are (``group_slice`` NULL).  Every helper below then
works inside a slice and adds what earlier (or later) slices contribute, one row per slice.  The limit is a number of rows,
the same at every data size: slices don't grow with the data, their number does, and so nothing about them is broadcast by
force.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.durable import durable

SLICE = "group_slice"
SLICE_ROWS_CONF = "spark.stagewatch.sliceRows"
DEFAULT_SLICE_ROWS = 5_000_000

Order = Sequence[Column]


def slice_rows_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(SLICE_ROWS_CONF, str(DEFAULT_SLICE_ROWS)))


def slice_hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    max_rows: int | None = None,
    sized_by: DataFrame | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Label the rows of oversized groups with ``group_slice``; other data comes back unchanged.

    ``order`` must be a total order within a group.  ``sized_by`` may be a cheaper DataFrame with
    the same keys and (about) the same group sizes, used only for finding the oversized groups.
    ``largest`` is the size of the largest group where the caller knows it.
    """
    limit = max_rows or slice_rows_limit(df)
    if largest is not None and largest <= limit:
        return df
    sizes = (df if sized_by is None else sized_by).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= limit:
        return df
    hot = durable(sizes.filter(F.col("n") > limit))
    hot_rows = hot.agg(F.sum("n")).first()[0]
    hot_keys = hot.select(*keys)
    hot_part = df.join(hot_keys, list(keys), "left_semi") if keys else df
    slices = -(-hot_rows // limit) + 1
    sliced = durable(hot_part.repartitionByRange(slices, *keys, *order).withColumn(SLICE, F.spark_partition_id()))
    if not keys:
        return sliced
    return df.join(hot_keys, list(keys), "left_anti").withColumn(SLICE, F.lit(None).cast("int")).unionByName(sliced)


def is_sliced(df: DataFrame) -> bool:
    return SLICE in df.columns


def settled(df: DataFrame) -> DataFrame:
    """Write the sliced rows once, so that the per-slice tables of later steps do not start from the source."""
    if not is_sliced(df):
        return df
    return df.filter(F.col(SLICE).isNull()).unionByName(durable(df.filter(F.col(SLICE).isNotNull())))


def group_window(df: DataFrame, keys: Sequence[str]):
    return Window.partitionBy(*keys, *([SLICE] if is_sliced(df) else []))


def _slice_rows(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.filter(F.col(SLICE).isNotNull()).groupBy(*keys, SLICE).agg(*aggs)


def _attach_slices(df: DataFrame, keys: Sequence[str], carried: DataFrame) -> DataFrame:
    return df.join(durable(carried), [*keys, SLICE], "left")


def running_before(
    df: DataFrame, keys: Sequence[str], order: Order, specs: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Add, per name, a value over the strictly earlier rows of the group.

    ``last`` is the latest non-null value, ``max`` the largest, ``sum`` the total (0 at the start).
    """
    frame = group_window(df, keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def over(how: str, value: Column) -> Column:
        return {"last": lambda: F.last(value, ignorenulls=True), "max": lambda: F.max(value),
                "sum": lambda: F.sum(value)}[how]()

    local = df.select("*", *[over(how, value).over(frame).alias(name) for name, (how, value) in specs.items()])
    if is_sliced(df):
        rank = F.struct(*order)
        per_slice = _slice_rows(df, keys, [
            (F.max_by(value, F.when(value.isNotNull(), rank)) if how == "last" else over(how, value)).alias(name)
            for name, (how, value) in specs.items()
        ])
        earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = per_slice.select(*keys, SLICE, *[
            over(how, F.col(name)).over(earlier).alias(f"__in_{name}") for name, (how, _) in specs.items()
        ])
        local = _attach_slices(local, keys, carried)
        merged = {
            "last": lambda here, into: F.coalesce(here, into),
            "max": lambda here, into: F.greatest(here, into),
            "sum": lambda here, into: F.coalesce(here, F.lit(0)) + F.coalesce(into, F.lit(0)),
        }
        local = local.withColumns({
            name: merged[how](F.col(name), F.col(f"__in_{name}")) for name, (how, _) in specs.items()
        }).drop(*[f"__in_{name}" for name in specs])
    sums = [name for name, (how, _) in specs.items() if how == "sum"]
    return local.withColumns({n: F.coalesce(n, F.lit(0)) for n in sums}) if sums else local


def next_value(df: DataFrame, keys: Sequence[str], order: Order, name: str, value: Column) -> DataFrame:
    """Add the value of the next row of the group (NULL on the last row)."""
    boxed = F.struct(value.alias("v"))
    local = df.withColumn(name, F.lead(boxed).over(group_window(df, keys).orderBy(*order)))
    if is_sliced(df):
        firsts = _slice_rows(df, keys, [F.min_by(boxed, F.struct(*order)).alias("__first")])
        following = Window.partitionBy(*keys).orderBy(SLICE)
        carried = firsts.select(*keys, SLICE, F.lead("__first").over(following).alias("__following"))
        local = _attach_slices(local, keys, carried)
        local = local.withColumn(name, F.coalesce(name, "__following")).drop("__following")
    return local.withColumn(name, F.col(f"{name}.v"))


def group_values(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], order: Order | None = None
) -> DataFrame:
    """Add aggregates over the whole group to each of its rows.

    With ``order`` the rows are sorted as the ordered steps around need them, so they share one sort.
    """
    window = group_window(df, keys)
    if order is not None:
        window = window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = df.select("*", *[agg.over(window).alias(name) for name, agg in aggs.items()])
    if not is_sliced(df):
        return local
    hot = df.filter(F.col(SLICE).isNotNull())
    named = [agg.alias(f"__all_{name}") for name, agg in aggs.items()]
    if keys:
        totals = durable(hot.groupBy(*keys).agg(*named))
        local = local.join(totals, list(keys), "left")
    else:
        totals = F.broadcast(durable(hot.groupBy(F.lit(1).alias("__one")).agg(*named)))
        local = local.withColumn("__one", F.lit(1)).join(totals, "__one", "left").drop("__one")
    return local.withColumns({
        name: F.when(F.col(SLICE).isNotNull(), F.col(f"__all_{name}")).otherwise(F.col(name)) for name in aggs
    }).drop(*[f"__all_{name}" for name in aggs])


def row_position(df: DataFrame, keys: Sequence[str], order: Order, name: str, first: int = 1) -> DataFrame:
    """Add the row's position in its group, counted from ``first``."""
    here = F.row_number().over(group_window(df, keys).orderBy(*order)).cast("bigint")
    local = df.withColumn(name, here + F.lit(first - 1))
    if is_sliced(df):
        counts = _slice_rows(df, keys, [F.count(F.lit(1)).alias("n")])
        earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = counts.select(*keys, SLICE, F.sum("n").over(earlier).alias("__before"))
        local = _attach_slices(local, keys, carried).withColumn(
            name, F.col(name) + F.coalesce("__before", F.lit(0))
        ).drop("__before")
    return local


def ranked(
    df: DataFrame, keys: Sequence[str], order: Order, name: str, sized_by: DataFrame | None = None, largest: int | None = None,
) -> DataFrame:
    """Number the rows of each group 1, 2, … whatever the group's size; leaves no slice column.

    Without ``largest``, the size of the largest group, the groups are counted while the plan is built.
    """
    return row_position(slice_hot_groups(df, keys, order, sized_by=sized_by, largest=largest), keys, order, name).drop(SLICE)
