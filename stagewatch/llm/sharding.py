"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

A row's place in the shuffled order is a keyed permutation of its row number in the order of ids.  The permutation works on
the smallest power of two that holds all rows; a place beyond the last row is permuted again (cycle walking) until it falls
inside.  Shard and slot follow from the place by division, so both can be computed for any row number without the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import numbered, text_or_empty

ROUNDS = 4
#: Odd factors below 2 ** 31: a product with a half of at most 31 bits stays below 2 ** 62.
FACTORS = (1540483477, 2246822519 % (1 << 31) | 1, 668265263, 374761393)


def feistel(place: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """One pass of the permutation of 0 .. 2 ** bits - 1; ``bits`` from 2 to 62. Halves may differ by one bit."""
    low = bits // 2
    widths = (bits - low, low)
    left, right = place >> low, place & ((1 << low) - 1)
    for r in range(ROUNDS):
        # left has widths[0] bits, right widths[1]; they change places, so the widths do too.
        mixed = right * FACTORS[r % len(FACTORS)] + ((seed + r * 40503) & 0x7FFFFFFF)
        mixed ^= mixed >> 15
        left, right = right, left ^ ((mixed >> 3) & ((1 << widths[0]) - 1))
        widths = widths[::-1]
    return (left << widths[1]) | right


def permuted(rows: np.ndarray, total: int, seed: int = 1) -> np.ndarray:
    """Places of ``rows`` (numbers below ``total``) in the shuffled order: a permutation of 0 .. total - 1."""
    place = np.asarray(rows, dtype=np.int64)
    if total <= 1:
        return np.zeros_like(place)
    bits = max(2, int(total - 1).bit_length())
    place = feistel(place, bits, seed)
    outside = np.flatnonzero(place >= total)
    while len(outside):
        place[outside] = feistel(place[outside], bits, seed)
        outside = outside[place[outside] >= total]
    return place


def shard_of(row: int, total: int, shards: int, seed: int = 1) -> tuple[int, int]:
    """Shard and slot of one row number."""
    place = int(permuted(np.array([row]), total, seed)[0])
    return place % shards, place // shards


def with_shards(numbered_rows: DataFrame, row: str, total: int, shards: int, seed: int = 1) -> DataFrame:
    """Add shard and slot to rows that have a row number."""

    @F.pandas_udf(LongType())
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permuted(rows.to_numpy(np.int64, copy=True), total, seed))

    out = numbered_rows.withColumn("__place", place(row))
    return out.withColumns({
        "shard": F.pmod("__place", F.lit(shards)).cast("int"), "slot": F.expr(f"__place DIV {shards}").cast("bigint"),
    }).drop("__place")


def shard_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8, seed: int = 1) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes plus 1; a null text has none), text_crc32, law ``rows``, shard, slot, grown_shard.

    Shards hold row counts at most one apart and slots run from 0 without gaps.  Row numbers go by id, size and checksum;
    rows alike in all three are interchangeable, so a rerun gives the same rows.  A null id sorts first.  An empty table
    gives no rows.
    """
    body = text_or_empty(text)
    narrow = stored(
        docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
                    F.crc32(body.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("__tie")), "shard-sizes",
    )
    total = narrow.count()
    rows = numbered(narrow, ["doc_id", "size", "text_crc32", "__tie"], "__row")
    return with_shards(rows, "__row", total, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
