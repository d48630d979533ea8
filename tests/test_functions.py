import numpy as np
import pytest
from pyspark.sql import functions as F

from stagewatch.functions import coerce
from stagewatch.functions.ordered import ranked, row_position, slice_hot_groups
from stagewatch.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("spread", [10, 5_000_000, 10**13])
def test_quantiles_match_numpy(spark, spread):
    rng = np.random.default_rng(3)
    groups = {"a": rng.integers(-spread, spread, 1000), "b": rng.integers(0, spread, 7), "c": np.array([42])}
    rows = [(g, int(v)) for g, values in groups.items() for v in values] + [("a", None)]
    wanted = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "top": 1.0}
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {r.g: r for r in exact_quantiles(df, ["g"], F.col("v"), wanted).collect()}
    for g, values in groups.items():
        assert got[g]["n"] == len(values)
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-6)


@pytest.mark.parametrize("limit", [1000, 10])
def test_rank_of_an_oversized_group(spark, slices_of, limit):
    slices_of(limit)
    rows = [("hot", f"k{n:04d}") for n in range(300)] + [(f"g{n % 60}", f"k{n:04d}") for n in range(600)]
    df = spark.createDataFrame(rows, "g string, k string").repartition(5)
    got = ranked(df, ["g"], [F.col("k")], "n").filter("g = 'hot'").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 301))


def test_one_instant_with_many_rows_is_split(spark):
    df = spark.createDataFrame([("hot", 5, n) for n in range(400)] + [("cool", 1, 0)], "g string, ts bigint, n bigint")
    order = [F.col("ts"), F.col("n")]
    sliced = slice_hot_groups(df, ["g"], order, max_rows=50)
    sizes = [r["count"] for r in sliced.filter("g = 'hot'").groupBy("group_slice").count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 150
    assert sliced.filter("g = 'cool' AND group_slice IS NULL").count() == 1
    positions = row_position(sliced, ["g"], order, "pos").filter("g = 'hot'").orderBy("n").collect()
    assert [r.pos for r in positions] == list(range(1, 401))


def test_timestamps(spark):
    texts = ["2025-01-01 09:00:00.1234567", "2025-01-01T09:00:00Z", "2025-01-01 09:00:00+05:00", "2025-01-01 09:00", "x", "",
             "2025-02-30 09:00:00", None, "2025-03-09 02:30:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    strict = [r.s for r in df.select("i", coerce.strict_timestamp(F.col("t")).cast("string").alias("s")).orderBy("i").collect()]
    assert strict == ["2025-01-01 09:00:00.123456", "2025-01-01 09:00:00", "2025-01-01 09:00:00", None, None, None, None, None,
                      "2025-03-09 02:30:00"]
    # The last one does not exist in the session's zone; the wall clock must survive the round trip.
    us = coerce.micros(coerce.strict_timestamp(F.col("t")))
    back = df.filter("i = 8").select(coerce.from_micros(us).cast("string")).first()[0]
    assert back == "2025-03-09 02:30:00"


def test_optional_timestamp_status(spark):
    texts = [None, " ", "0001-01-01T00:00:00.0000000", "01/01/0001 12:00:00 AM", "not-a-date", "2024", "2024-05-01 10:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in df.select("i", coerce.optional_timestamp_status(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == ["missing", "missing", "sentinel", "sentinel", "unparseable", "unparseable", "ok"]


def test_labels_and_names(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (65.0,), (1445.0,), (-65.0,), (0.5,), (1.5,)], "m double")
    assert [r[0] for r in df.select(coerce.clock_label(F.col("m"))).collect()] == [
        "00:00", "00:30", "01:05", "00:05", "-01:05", "00:00", "00:02"]
    row = spark.range(1).select(
        coerce.safe_name(F.lit("Post-treatment scans & Device removal")), coerce.optional_int(F.lit(" 3.7 ")),
        coerce.optional_int(F.lit("x")), coerce.warning_category(F.lit("c1:kind:a:b")), coerce.warning_category(F.lit("plain"))).first()
    assert list(row) == ["Posttreatment_scans__Device_removal", 3, None, "kind", "uncategorized"]


def test_parse_clock():
    assert coerce.parse_clock("12:00") == 43_200_000_000 and coerce.parse_clock("07:30:15") == 27_015_000_000
    for bad in ("noon", "25:00", "1:2:3:4"):
        with pytest.raises(ValueError):
            coerce.parse_clock(bad)
