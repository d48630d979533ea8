"""Mixing sources to target weights by nested hash thresholds.

Every row has a fixed hash of its id and text.  Words are summed by source and hash bucket; the bucket in which a source's budget
ends is the only one that is looked into further, until a single hash value is left.  Rows below that value are taken, so
nothing is sorted and every pass is a partial aggregation over four narrow columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import nested, numbered, text_or_empty, unnested, word_count

HASH_BITS = 60
LEVEL_BITS = 12
#: Up to so many sources the table of thresholds (some 100 bytes a source) is broadcast, beyond it is joined by shuffle.
BROADCAST_SOURCES = 100_000

KEY, SIZE, HASH, TOTAL, TARGET = "__mix_key", "__mix_size", "__mix_hash", "__mix_total", "__mix_target"


@dataclass(frozen=True)
class MixPlan:
    """One row per source: key, words, target, copies that every row gets, and the hash below which rows get one more."""

    sources: DataFrame
    count: int

    def attached(self, df: DataFrame) -> DataFrame:
        """``df`` (with the key and hash columns) and its source's figures."""
        return df.join(F.broadcast(self.sources) if self.count <= BROADCAST_SOURCES else self.sources, KEY)


def source_key(source: str) -> Column:
    """A key that is never null: null and the empty string are different sources."""
    return F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))


def row_hash(doc_id: str, text: str, seed: str) -> Column:
    """60 bits of the MD5 of seed, id and the text's own MD5; only rows alike in both share it."""
    body = F.md5(text_or_empty(text).cast("binary"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"), body)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def with_mix_columns(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), source_key(source).alias(KEY), word_count(text).alias(SIZE), row_hash(doc_id, text, seed).alias(HASH))


def plan_mix(
    narrow: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> MixPlan:
    """Targets and thresholds for rows with the key, size and hash columns.

    Sources in code point order (null last) weigh ``weights``, repeating, and share ``share`` times all words.  A source's
    target stops at ``most`` times its size; what it can't use goes to the others by weight.
    """
    sizes = narrow.groupBy(KEY).agg(F.sum(SIZE).alias(TOTAL))
    ordered = numbered(sizes.withColumn("__last", F.col(KEY) == ""), ["__last", KEY], "__rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    sources = stored(ordered.select(KEY, TOTAL, weight.cast("double").alias("__weight")), "sources")
    limit = (F.col(TOTAL) * most).cast("double")

    totals = sources.agg(F.sum(TOTAL), F.sum("__weight"), F.count(F.lit(1))).first()
    words, free_weight, count = totals[0] or 0, totals[1] or 0.0, totals[2]
    # The level is what a weight of 1 is worth. It rises as full sources hand on their excess, until no more get full.
    level, full = (share * words / free_weight if free_weight else 0.0), 0
    while free_weight:
        is_full = limit < F.lit(level) * F.col("__weight")
        n, used, left = sources.agg(
            F.count(F.when(is_full, 1)), F.sum(F.when(is_full, limit)), F.sum(F.when(~is_full, F.col("__weight")))
        ).first()
        if n == full or not left:
            break
        level, full = (share * words - used) / left, n
    target = F.least(limit, F.lit(level) * F.col("__weight"))
    sources = sources.select(
        KEY, TOTAL, target.alias(TARGET),
        F.when(F.col(TOTAL) > 0, F.floor(target / F.col(TOTAL))).otherwise(0).cast("int").alias("__copies"),
    ).withColumn("__rest", F.col(TARGET) - F.col("__copies") * F.col(TOTAL))
    return MixPlan(stored(_with_thresholds(narrow, sources, count), "mix"), count)


def _with_thresholds(narrow: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Add ``__below``: rows with a smaller hash are taken once more."""
    rest = F.col("__rest")
    # A source whose rows all come equally often has no threshold.
    open_at = sources.filter(rest > 0).select(KEY, "__rest", F.lit(0).cast("bigint").alias("__prefix"), F.lit(0).cast("bigint").alias("__before"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        side = F.broadcast(open_at) if count <= BROADCAST_SOURCES else open_at
        inside = narrow.select(KEY, SIZE, HASH).join(side, KEY).filter(
            F.shiftright(HASH, shift + LEVEL_BITS) == F.col("__prefix")
        )
        cells = inside.groupBy(KEY, F.shiftright(HASH, shift).alias("__cell")).agg(
            F.sum(SIZE).alias("__n"), F.first("__rest").alias("__rest"), F.first("__before").alias("__start")
        )  # at most 2 ** LEVEL_BITS rows a source
        running = cells.withColumn(
            "__to", F.col("__start") + F.expr(f"sum(__n) OVER (PARTITION BY {KEY} ORDER BY __cell)")
        ).withColumn("__from", F.col("__to") - F.col("__n"))
        open_at = running.filter((F.col("__from") <= rest) & (rest < F.col("__to"))).select(
            KEY, "__rest", F.col("__cell").alias("__prefix"), F.col("__from").alias("__before"),
            F.col("__to").alias("__after"),
        )
    nearer = (F.col("__after") - rest) < (rest - F.col("__before"))
    threshold = F.col("__prefix") + F.when(nearer, 1).otherwise(0)
    found = open_at.select(KEY, threshold.alias("__below"))
    return sources.join(found, KEY, "left").select(
        KEY, TOTAL, TARGET, "__copies", F.coalesce("__below", F.lit(0)).cast("bigint").alias("__below")
    )


def copies() -> Column:
    return F.col("__copies") + F.when(F.col(HASH) < F.col("__below"), 1).otherwise(0)


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix"
) -> DataFrame:
    """The mixed corpus: every row as often as its source's target asks for, with the input's columns.

    Empty and null texts have no words; they follow their source's copies and threshold all the same.  Rows alike in id (null
    too) and text are taken or left together.  An empty table gives an empty table.  Columns of any name pass through.
    """
    plan = plan_mix(stored(with_mix_columns(docs, doc_id, text, source, seed).drop("doc_id"), "mix-sizes"))
    keyed = nested(docs, source_key(source).alias(KEY), row_hash(doc_id, text, seed).alias(HASH))
    return unnested(plan.attached(keyed).withColumn("__times", F.explode(F.array_repeat(F.lit(1), copies().cast("int")))))


def mix_report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix"
) -> DataFrame:
    """Per row: id, size, source_size, target and the words the mix takes of it."""
    narrow = stored(with_mix_columns(docs, doc_id, text, source, seed), "mix-sizes")
    return plan_mix(narrow).attached(narrow).select(
        "doc_id", F.col(SIZE).alias("size"), F.col(TOTAL).alias("source_size"), F.col(TARGET).alias("target"),
        (copies() * F.col(SIZE)).cast("bigint").alias("taken")
    )
