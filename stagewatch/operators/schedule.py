"""What-if schedule: the day a case would take with fixed preparation blocks, and the risk of ending late."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.coerce import clock_us, from_micros, parse_clock
from stagewatch.functions.ordered import ranked
from stagewatch.functions.quantiles import exact_quantiles
from stagewatch.operators.summary import MINUTE_US
from stagewatch.workflow import KEYS, REMOVAL_STATE

# Fixed value: the arbitrary reference day 2025-01-01, in microseconds since 1970.
REFERENCE_DAY_US = 20_089 * 86_400 * 1_000_000


@dataclass(frozen=True)
class DayPlan:
    """Minutes of the fixed blocks and the clock times of a day."""

    anaesthesia_start: str = "07:30"
    anaesthesia: float = 15.0
    gap: float = 15.0
    insertion: float = 45.0
    extra_planning: float = 20.0
    extra_treatment: float = 60.0
    cutoff: str = "12:00"


def _as_us(minutes) -> Column:
    return F.round(minutes * float(MINUTE_US)).cast("bigint")


def schedule_projection(summary: DataFrame, plan: DayPlan = DayPlan(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Per case: 22 milestones, the end in minutes of the day, and the two cutoff flags.

    An absent or NULL phase takes no time and a negative one is treated as zero.
    """
    def phase(name: str) -> Column:
        if name not in summary.columns:
            return F.lit(0).cast("bigint")
        return _as_us(F.greatest(F.coalesce(F.col(f"`{name}`").try_cast("double"), F.lit(0.0)), F.lit(0.0)))

    def fixed(minutes: float) -> Column:
        return F.lit(round(minutes * MINUTE_US)).cast("bigint")

    blocks = [
        ("anest", fixed(plan.anaesthesia)), (None, fixed(plan.gap)), ("insert", fixed(plan.insertion)),
        ("align", phase("Alignment")), ("coarse", phase("Coarse")), ("detailed", phase("Detailed")),
        ("plan", phase("Planning start angle")), ("treat", phase("Treating")), ("paused", phase("Paused")),
        ("plan2", fixed(plan.extra_planning)), ("treat2", fixed(plan.extra_treatment)), ("post", phase(REMOVAL_STATE)),
    ]
    # One running sum: each block ends where the next begins.
    names = [f"__b{i}" for i in range(len(blocks))]
    out = summary.select(*KEYS, *keep, *[length.alias(n) for n, (_, length) in zip(names, blocks)])
    at: Column = F.lit(REFERENCE_DAY_US + parse_clock(plan.anaesthesia_start))
    milestones: dict[str, Column] = {}
    for column, (name, _) in zip(names, blocks):
        end = at + F.col(column)
        if name:
            milestones[f"{name}_start"], milestones[f"{name}_end"] = at, end
        at = end
    cutoff = F.lit(REFERENCE_DAY_US + parse_clock(plan.cutoff))
    late = milestones["post_end"] >= cutoff
    # Whole seconds of the clock; wraps at midnight although the flags use the full timestamp.
    end_minutes = F.floor(clock_us(milestones["post_end"]) / 1_000_000) / 60.0
    return out.select(
        *KEYS, *keep,
        *[from_micros(us).alias(name) for name, us in milestones.items()],
        end_minutes.alias("post_end_minutes"),
        late.alias("case_ends_after_cutoff"),
        (late & (milestones["align_start"] < cutoff)).alias("case_crosses_cutoff"),
    )


RISK_QUANTILES = {"end_min_p05": 0.05, "end_min_p25": 0.25, "end_min_p50": 0.5, "end_min_p75": 0.75, "end_min_p95": 0.95}


def schedule_risk(projection: DataFrame, plan: DayPlan = DayPlan()) -> DataFrame:
    """Per site: number of days, both probabilities, mean, deviation and quantiles of the end minute."""
    def share(flag: str) -> Column:
        return F.avg(F.col(flag).cast("double"))

    basics = projection.groupBy("site_code").agg(
        F.count(F.lit(1)).alias("n_days"),
        share("case_ends_after_cutoff").alias("prob_ends_after_cutoff"),
        share("case_crosses_cutoff").alias("prob_crosses_cutoff"),
        F.avg("post_end_minutes").alias("end_min_mean"),
        F.stddev_samp("post_end_minutes").alias("end_min_std"),
    ).withColumn("cutoff", F.lit(plan.cutoff))
    seconds = F.round(F.col("post_end_minutes") * 60)
    found = exact_quantiles(projection, ["site_code"], seconds, RISK_QUANTILES).drop("n")
    return basics.join(found.withColumns({q: F.col(q) / 60.0 for q in RISK_QUANTILES}), "site_code")


def draw(position: Column, n: Column, seed: int) -> Column:
    """Deterministic pseudo-random 0-based index below ``n`` (two congruential steps)."""
    modulus = F.lit(2_147_483_648)
    first = F.pmod(position * 1_103_515_245 + F.lit(seed * 12_345 + 12_345), modulus)
    second = F.pmod(first * 1_103_515_245 + F.lit(12_345), modulus)
    return F.call_function("div", second * n, modulus)


def bootstrap_days(
    summary: DataFrame, plan: DayPlan = DayPlan(), days: int = 10_000, seed: int = 1, cases: DataFrame | None = None
) -> DataFrame:
    """``days`` draws with replacement from the cases of each site, projected to a day each."""
    numbered = ranked(summary, ["site_code"], [F.col("case_id")], "ordinal", sized_by=cases)
    sizes = summary.groupBy("site_code").agg(F.count(F.lit(1)).alias("n"))
    draws = sizes.select("site_code", "n", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day"))
    draws = draws.select("site_code", "day", (draw(F.col("day").cast("bigint"), F.col("n"), seed) + 1).alias("ordinal"))
    return schedule_projection(numbered.join(draws, ["site_code", "ordinal"]), plan, keep=("day",))
