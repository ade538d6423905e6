"""Connected components of an edge table, in Spark joins and aggregates (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), of one orderable type -> (id, comp): comp is the least id that id is linked with over any path.

    Only ids with an edge to another id appear; loops, repeated edges and nulls do not matter. Each round is written to
    the shared folder; a round halves what is left to contract, and the loop ends when no edge changes.
    """
    kind = edges.schema["a"].dataType
    now = materialize(edges.where("a is not null and b is not null and a != b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    last, state = None, mark(now)
    while state != last and state[0]:
        now = materialize(_small_star(_large_star(now)).distinct(), "edges")
        last, state = state, mark(now)
    roots = now.select(F.col("b").alias("id")).distinct()
    return (now.select(F.col("a").alias("id"), F.col("b").alias("comp"))
            .union(roots.select("id", F.col("id").alias("comp")))
            .select(F.col("id").cast(kind), F.col("comp").cast(kind)))
