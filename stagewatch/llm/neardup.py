"""SimHash near-duplicates: tiled exact comparison of distinct fingerprints.

Distinct 64-bit fingerprints are put into tiles by the population counts of their four quarters.  Two fingerprints within
the radius have quarter counts that differ by at most the radius in sum, so all other tile pairs are skipped.  The pairs
that remain are compared in full with numpy (exclusive or and bit counts), block by block.  A block comparison returns a
star per group of linked fingerprints, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import LOWER, as_bytes, nested, row_key, unnested
from stagewatch.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
QUARTERS = 4
#: Most fingerprints on one side of a block comparison; the other side holds at most so many of each neighbouring tile.
BLOCK = 4096
#: Fingerprint comparisons held in memory at once.
AT_ONCE = 1 << 20


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """SimHash of the lower-cased word shingles; 0 for a text without words."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)])) if len(words) >= width else [b" ".join(words)]
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - width + 1)
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, a key that tells rows of one id with different texts apart, and the fingerprint as a signed long."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(text).alias("text"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(t)) for t in as_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.int64())], names)

    names = ["doc_id", "row", "fp"]
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(prints, f"doc_id {kind}, row bigint, fp bigint")


def neighbour_steps(radius: int, parts: int = QUARTERS) -> list[tuple[int, ...]]:
    """Differences of two tiles' counts within the radius, each unordered pair of tiles once."""
    steps = product(range(-radius, radius + 1), repeat=parts)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * parts]


def _stars(own: np.ndarray, other: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``own`` and itself or ``other`` as (node, root) stars."""
    nodes, inverse = np.unique(np.concatenate([own, other]), return_inverse=True)
    root = np.arange(len(nodes))
    mine, theirs = inverse[: len(own)], inverse[len(own):]
    height = max(1, AT_ONCE // max(1, len(other)))
    for at in range(0, len(own), height):
        near = np.bitwise_count(own[at:at + height, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = mine[at + i], theirs[j]
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    leaf = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[leaf], nodes[root[leaf]]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Stars (a, b) that connect all distinct fingerprints within the radius; ``prints`` has a column fp, each value once."""
    steps = neighbour_steps(radius)
    width = 64 // QUARTERS
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", width * q).bitwiseAND(F.lit((1 << width) - 1))).cast("int") for q in range(QUARTERS)
    ]
    tile = F.expr("c0 * 289 * 17 + c1 * 289 + c2 * 17 + c3")
    tiled = prints.select("fp", *[c.alias(f"c{q}") for q, c in enumerate(counts)]).withColumn("tile", tile)
    # At most 17 ** 4 tiles exist, whatever the number of rows, so their table may be broadcast.
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    tiled = stored(
        tiled.join(F.broadcast(sizes), "tile")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")), "tiles",
    )
    sizes = stored(sizes, "tile-sizes")
    # A comparison is one block of a tile with the blocks of one number of itself and the tiles after it.
    ahead = F.array(*[F.struct(*[F.lit(d).alias(f"d{q}") for q, d in enumerate(s)]) for s in steps])
    reached = "(c0 {s} s.d0) * 4913 + (c1 {s} s.d1) * 289 + (c2 {s} s.d2) * 17 + (c3 {s} s.d3)"
    inside = " AND ".join(f"(c{q} - s.d{q}) BETWEEN 0 AND 16" for q in range(QUARTERS))
    to_tiles = tiled.withColumn("s", F.explode(ahead)).filter(inside).select(
        "fp", "block", F.expr(reached.format(s="-")).alias("left")
    )
    others = to_tiles.join(F.broadcast(sizes.select(F.col("tile").alias("left"), "blocks")), "left").select(
        "left", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("left_block"), F.col("block").alias("other_block"),
        "fp", F.lit(False).alias("own"),
    )
    quarters = {f"c{3 - i}": F.pmod(F.expr(f"tile DIV {17 ** i}"), F.lit(17)).cast("int") for i in range(QUARTERS)}
    most_blocks = (
        sizes.withColumns(quarters).withColumn("s", F.explode(ahead)).filter(inside)
        .select("blocks", F.expr(reached.format(s="-")).alias("left")).groupBy("left").agg(F.max("blocks").alias("most"))
    )
    owners = tiled.join(F.broadcast(most_blocks.withColumnRenamed("left", "tile")), "tile").select(
        F.col("tile").alias("left"), F.col("block").alias("left_block"),
        F.explode(F.sequence(F.lit(0), F.col("most") - 1)).alias("other_block"), "fp", F.lit(True).alias("own"),
    )

    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy(zero_copy_only=False)
        node, root = _stars(fp[own], fp[~own], radius)
        return pa.table({"a": node.view(np.int64), "b": root.view(np.int64)})

    return owners.unionByName(others).groupBy("left", "left_block", "other_block").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, row, fp and component_id (smallest id reachable over fingerprints within the radius) of every row.

    A null or empty text has fingerprint 0 and links like any other.  Rows with one text are linked.  A null id never names
    a component that has another id; a component of null ids only has a null name.  No rows in, no rows out.
    """
    return _rooted(docs, doc_id, text, radius).select("doc_id", "row", "fp", "component_id")


def _rooted(docs: DataFrame, doc_id: str, text: str, radius: int) -> DataFrame:
    """What ``near_duplicates`` returns and ``root`` (the component's smallest fingerprint, which no other component has)."""
    rows = stored(fingerprints(docs, doc_id, text), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(fingerprint_links(prints.select("fp"), radius))
    named = stored(
        prints.join(roots, prints.fp == roots.node, "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-roots",
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(named.join(least, "root").select("fp", "root", "component_id"), "fingerprint-classes")
    return rows.join(classes, "fp").select("doc_id", "row", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component: the first by id (null last), row key and, among equal rows, any.  Columns as in the input.

    Components are told apart by their root, not by an id, which rows with unlike texts may share or lack.
    """
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    first = _rooted(docs, doc_id, text, radius).groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row"))
    keyed = nested(docs, F.col(doc_id).alias("id"), row_key(doc_id, text).alias("key"))
    same = (F.col("key") == F.col("first_row")) & F.col("id").eqNullSafe(F.col("first_id"))
    kept = keyed.join(stored(first, "kept"), same, "left_semi")
    # Rows that are equal in id and text are of one component.
    return unnested(kept.dropDuplicates(["id", "key"]))


def fingerprint_text(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
