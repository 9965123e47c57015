"""Sharding by a hypergeometric communication matrix.

A uniform shuffle into shards of exact sizes (at most one row apart), without
sorting the table as a whole: rows lie in blocks (by a hash of the key); how
many rows each block sends to each shard is drawn from the multivariate
hypergeometric law with the blocks' and shards' exact totals; each block
permutes its rows and deals them out by the matrix; rows are exchanged; each
shard permutes what it got. All on DataFrame functions; the driver sees the
block totals and draws the matrix (blocks x shards numbers).

Everything random is a hash of the seed and the row, so a task that runs again
after a lost executor gives the same rows. Defined results: rows that are equal
in every column are interchangeable; where copies of a row fill a block beyond
HOT_BLOCK times its share, the rows of that block are spread over all blocks by
their place in the table, so no task takes them all; null keys are rows like any other; an
empty table gives an empty result; shards may be empty. The order columns must
tell apart rows that differ, or they too count as interchangeable.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.blocks import col
from eventide.session import ensure_checkpoint_dir

#: Rows of a block, about; a block is permuted in one task.
BLOCK_ROWS = 1_000_000
#: Blocks at least, so that small tables spread too.
LEAST_BLOCKS = 64
#: Blocks at most: the driver draws so many rows of the matrix.
MOST_BLOCKS = 1 << 16
#: A block is hot with more than so many times the mean rows, and so many more.
HOT_BLOCK, HOT_ROWS = 4, 1_000


def hypergeometric(good: int, bad: int, drawn: int, u: float) -> int:
    """How many of ``drawn`` out of ``good + bad`` are good, by inversion: the law
    is built up from its mode by exact ratios as far as it weighs anything, so
    it holds for any table size."""
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5
    reach = int(12 * spread) + 60
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    rise = np.cumprod((good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1)))
    fall = np.cumprod(down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1)))
    law = np.concatenate((fall[::-1], [1.0], rise))
    at = int(np.searchsorted(np.cumsum(law), u * law.sum(), side="right"))
    return min(high, mode - len(fall) + at)


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows from each block (axis 0) to each shard (axis 1) under a uniform shuffle."""
    random = np.random.default_rng(seed)
    room = list(shards)
    out = np.zeros((len(blocks), len(shards)), np.int64)
    for i, rows in enumerate(blocks):
        left, others = rows, sum(room)
        for s in range(len(room)):
            others -= room[s]
            out[i, s] = hypergeometric(room[s], others, left, random.random())
            room[s] -= int(out[i, s])
            left -= int(out[i, s])
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _draw(seed: int, salt: int, order: list[str]) -> Column:
    """A hash of the row; of its place too (``_place``, null for most) where the row's block is hot."""
    drawn = F.xxhash64(F.lit(seed), F.lit(salt), *[col(c) for c in order])
    return F.when(F.col("_place").isNull(), drawn).otherwise(F.xxhash64(drawn, F.col("_place")))


def shuffle(rows: DataFrame, shards: int, order: list[str], seed: int = 6, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` plus ``shard`` (int, from 0) and ``slot`` (bigint, gapless from 0 in
    each shard): a uniform random order cut into shards of exact size. ``order``
    names the columns that tell rows apart."""
    ensure_checkpoint_dir(rows.sparkSession)
    held = rows.select(F.struct(*[col(c) for c in rows.columns]).alias("d"), *[col(c).alias(f"_{i}") for i, c in enumerate(order)],
                       F.lit(None).cast("bigint").alias("_place"))
    keys = [f"_{i}" for i in range(len(order))]
    total = rows.count()
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-total // block_rows)))
    block = F.pmod(_draw(seed, 1, keys), F.lit(blocks)).cast("int")

    def counted() -> dict[int, int]:
        return {r["block"]: r["n"] for r in held.groupBy(block.alias("block")).agg(F.count("*").alias("n")).collect()}

    found = counted()
    hot = [b for b, n in found.items() if n > HOT_BLOCK * total / blocks + HOT_ROWS]
    if hot:  # copies of a row: only their places tell them apart, so these are fixed first
        held = held.withColumn("_place", F.when(block.isin(hot), F.monotonically_increasing_id())).checkpoint()
        found = counted()
    sizes = [found.get(b, 0) for b in range(blocks)]
    matrix = communication_matrix(sizes, shard_sizes(total, shards), seed)
    # ends[s] of a block: its ranks up to there go to shards up to s
    table = F.from_json(F.lit(json.dumps(matrix.cumsum(1).tolist())), "array<array<bigint>>")
    ends = rows.sparkSession.range(1).select(F.posexplode(table).alias("block", "ends"))

    # permute within the block and deal out by the matrix
    local = Window.partitionBy("block").orderBy(_draw(seed, 2, keys), *keys)
    dealt = (held.withColumn("block", block)
             .withColumn("rank", F.row_number().over(local).cast("bigint"))
             .join(F.broadcast(ends), "block")  # bounded: blocks x shards numbers
             .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("rank"))))
             .select("d", *keys, "_place", "shard"))

    # exchange, and permute within the shard: a random order, dealt over cells so
    # that no task holds a whole shard; a cell's first slot is the sum of those before
    cells = max(1, -(-blocks // shards) * 4)
    cell = F.pmod(_draw(seed, 3, keys), F.lit(cells)).cast("int")
    dealt = dealt.withColumn("cell", cell).checkpoint()  # read twice, and never dealt differently again
    inside = Window.partitionBy("shard", "cell").orderBy(_draw(seed, 4, keys), *keys)
    placed = dealt.withColumn("at", F.row_number().over(inside).cast("bigint") - 1)
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
             .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    return placed.join(first, ["shard", "cell"]).select("d.*", "shard", (F.col("at") + F.col("first")).alias("slot"))
