"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows lie in blocks (partitions of a checkpointed table). How many rows of block b go to shard s is drawn exactly:
row b of the matrix is a multivariate hypergeometric draw from what the shards still lack, so every arrangement of
all rows over the shards is equally likely and each shard gets exactly its size. Each block permutes its rows by
a keyed hash and deals them out by its matrix row, the rows are exchanged, and each shard permutes again; the place
in that second permutation is the slot. Only block sizes (one number per partition) reach the driver.

Defined results: rows are shuffled as they are, so nulls, empty texts, repeated rows and ties are ordinary rows; an
empty table gives no rows; columns named like the added ones are refused with an error unless other names are given.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.llm.common import fresh
from convlens.session import cut_lineage

NUMPY_LIMIT = 10 ** 9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn without replacement are among ``good`` ones. Above numpy's size limit the
    distribution is inverted on a window around its mode whose outside mass is below double precision."""
    if n == 0 or good == 0:
        return 0
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    sd = (n * (good / total) * (bad / total) * max(1, total - n) / max(1, total - 1)) ** 0.5
    a, b = max(low, mode - int(12 * sd) - 20), min(high, mode + int(12 * sd) + 20)
    k = np.arange(a, b, dtype=np.float64)
    step = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logp = np.concatenate([[0.0], np.cumsum(step)])
    p = np.exp(logp - logp.max())
    return int(a + np.searchsorted(np.cumsum(p) / p.sum(), rng.random(), side="right"))


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Rows: blocks, columns: shards; row and column sums are the given sizes, drawn uniformly."""
    rng, left = np.random.default_rng(seed), [int(s) for s in shards]
    out = np.zeros((len(blocks), len(shards)), dtype=np.int64)
    for i, size in enumerate(blocks):
        need, rest = int(size), sum(left)
        for j, have in enumerate(left):
            rest -= have
            take = hypergeometric(rng, have, rest, need)
            out[i, j], left[j], need = take, have - take, need - take
    return out


def shard_sizes(rows: int, n_shards: int) -> list[int]:
    """Exact sizes, at most one apart."""
    return [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]


def shuffle_to_shards(df: DataFrame, n_shards: int, seed: int = 0, shard_col: str = "shard",
                      slot_col: str = "slot", rows_per_piece: int = 100_000) -> DataFrame:
    """``df`` with ``shard`` (int, 0 to n_shards - 1, sizes at most one apart) and ``slot`` (long, gapless from 0 in
    each shard): a uniform random arrangement fixed by ``seed`` and the checkpointed blocks.

    ``rows_per_piece`` bounds what one task sorts: a shard is permuted as pieces of a uniform random key's range,
    and a piece's first slot is the count of rows in the pieces before it.
    """
    clash = {shard_col.lower(), slot_col.lower()} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; pass other names for shard_col and slot_col")
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    spark = df.sparkSession
    block, row, key, rank, piece, ends = fresh(df, "block", "row", "key", "rank", "piece", "ends")
    fixed = cut_lineage(df.withColumn(block, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()))

    counts = [(r[0], r[1]) for r in fixed.groupBy(block).count().orderBy(block).collect()]
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], shard_sizes(total, n_shards), seed)
    dealt = spark.createDataFrame([(b, [int(x) for x in np.cumsum(m)]) for (b, _), m in zip(counts, matrix)],
                                  f"`{block}` int, `{ends}` array<bigint>")

    local = Window.partitionBy(block).orderBy(F.xxhash64(F.lit(2 * seed), F.col(row)), row)
    pieces = max(1, -(-total // (n_shards * rows_per_piece)))
    placed = (
        fixed.withColumn(rank, F.row_number().over(local))
        .join(dealt, block)
        .withColumn(shard_col, F.size(F.filter(ends, lambda e: e < F.col(rank))))
        .withColumn(key, F.xxhash64(F.lit(2 * seed + 1), F.col(row)))
        .withColumn(piece, F.floor((F.shiftrightunsigned(key, 11).cast("double") * 2.0 ** -53) * pieces).cast("int"))
        .drop(block, rank, ends)
    )
    before = Window.partitionBy(shard_col).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(shard_col, piece).agg(F.count(F.lit(1)).alias(rank))
              .withColumn(ends, F.coalesce(F.sum(rank).over(before), F.lit(0)))
              .select(shard_col, piece, ends))
    within = Window.partitionBy(shard_col, piece).orderBy(key, row)
    return (placed.withColumn(slot_col, F.row_number().over(within).cast("long"))
            .join(starts, [shard_col, piece])
            .withColumn(slot_col, F.col(slot_col) - 1 + F.col(ends))
            .select(*df.columns, shard_col, slot_col))
