"""Blocks: rows that hold a few megabytes of a corpus with a table of the block's own distinct entries.

Work inside a block refers to entries by their place in its table. What must be known of an entry over the whole corpus (a
count, an id) is joined to the tables' rows: as many rows as blocks have distinct entries, not as the corpus has occurrences,
and nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def looked_up(blocks: DataFrame, block: str, entries: Column, key: str, table: DataFrame, values: list[str],
              also: list[str] = (), found: str = "found") -> DataFrame:
    """``blocks`` with ``found``: for each entry of the array ``entries`` that ``table`` has under ``key`` (and the columns
    ``also``, which are columns of both), a struct of its place ``at`` (from 0) and ``values``; in no order, empty if there are none."""
    rows = blocks.select(block, *also, F.posexplode(entries).alias("at", key))
    hits = (rows.join(table.select(key, *also, *values), [key, *also])
            .groupBy(block).agg(F.collect_list(F.struct("at", *values)).alias(found)))
    return blocks.join(hits, block, "left").withColumn(found, F.coalesce(found, F.array().cast(hits.schema[found].dataType)))
