"""What several operators share: words, byte columns, row numbers in a total order."""

from __future__ import annotations

import os
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored

#: A word is a run of characters other than the six ASCII white space characters; bytes.split() cuts at the same six.
WORD = "[^\\x20\\x09-\\x0D]+"
#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A-Z to a-z, ASCII letters, digits and all bytes beyond ASCII as they are, the rest to a space.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that ``df`` has no column of (Spark tells no case apart)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def nested(df: DataFrame, *columns: Column) -> DataFrame:
    """All of ``df``'s columns as one struct ``row`` beside ``columns``, so that no scratch column can meet one of them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *columns)


def unnested(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def text_or_empty(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def row_key(id_column: str, text_column: str) -> Column:
    """Tells rows that share an id but not their text apart (rows equal in both may share results)."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the row's number from 0 in the order of the columns ``order`` (nulls first, as Spark sorts).

    No row goes through a single task: rows are dealt by range, numbered inside their range, and the range's offset is
    added.  The offsets are one row per shuffle partition, which is what makes broadcasting them safe.  Rows that tie in
    all of ``order`` may swap numbers between runs, so give an order under which tied rows are alike.
    """
    at, part, offset = f"__{name}_at", f"__{name}_part", f"__{name}_offset"
    ranged = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranged"
    ).withColumn(part, F.shiftright(at, 33))
    per_part = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    earlier = F.expr(f"sum(__n) OVER (ORDER BY {part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = per_part.select(part, F.coalesce(earlier, F.lit(0)).alias(offset))
    inside = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), part).withColumn(name, F.col(offset) + inside).drop(at, part, offset)
