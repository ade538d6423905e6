"""Best-fit packing of documents into training sequences of several permitted lengths.

A document of length n is one item; one longer than the greatest permitted length is cut into items of that length and a
rest, so nothing is dropped. Items are dealt into groups of bounded size by a hash, and each group is packed by best-fit
decreasing with variable capacities: an item goes to the open bin in which it leaves the least room; if it fits into none, a
bin is opened, of the permitted length whose cost, less the worth of the room that the items still to come are likely to
fill, is least. In the end each bin is downsized to the least permitted length that holds its contents.

All lengths compete for every bin, so they are optimised jointly; a group's bins differ from those of one global packing
by at most the last, partly filled ones. Defined results: a null length counts as 0; an item of length 0 takes no room but
has its place in a bin; repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def pack(lengths: list[int], capacities: list[int], overhead: float = 32.0) -> tuple[list[int], list[int], list[int]]:
    """Packs items in the given (descending) order. Returns each item's bin and its offset there, and each bin's capacity.
    A bin of capacity c costs c + ``overhead``."""
    sizes = sorted(capacities)
    worth = min((c + overhead) / c for c in sizes)
    rest = np.concatenate([np.cumsum(np.asarray(lengths[::-1], np.int64))[::-1], [0]]).tolist() if lengths else [0]
    rising = lengths[::-1]
    bins, offsets, used = [], [], []
    open_: dict[int, list[int]] = {}  # room -> bins that have it
    rooms: list[int] = []  # the keys of open_, sorted
    room_total = 0

    def likely(k: int, room: int) -> int:
        """How much of ``room`` the items after item k may fill beyond what open bins can take."""
        first = max(k + 1, len(lengths) - bisect_left(rising, room + 1))
        return max(0, min(room, rest[first] - room_total))

    def put(b: int, room: int) -> None:
        nonlocal room_total
        if room:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append(b)
            room_total += room

    for k, n in enumerate(lengths):
        i = bisect_left(rooms, n)
        if n == 0 and used:
            bins.append(len(used) - 1)
            offsets.append(used[-1])
        elif i < len(rooms):
            room = rooms[i]
            b = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            room_total -= room
            bins.append(b)
            offsets.append(used[b])
            used[b] += n
            put(b, room - n)
        else:
            size = min((c for c in sizes if c >= n), key=lambda c: (c + overhead - worth * likely(k, c - n), c))
            bins.append(len(used))
            offsets.append(0)
            used.append(n)
            put(len(used) - 1, size - n)
    return bins, offsets, [sizes[bisect_left(sizes, u)] for u in used]


def pack_documents(df: DataFrame, id_col: str, length_col: str, capacities: tuple[int, ...] = (2048, 4096, 8192, 16384),
                   group_rows: int = 50_000, overhead: float = 32.0) -> DataFrame:
    """One row per item: the id column, piece, start, length, bin, capacity, offset. Bins are numbered without regard to
    order; ``group_rows`` bounds what one task packs (about: items are dealt by a hash)."""
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities must be positive")
    row, most = "row", max(capacities)
    rows = df.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(F.col(length_col), F.lit(0)), F.lit(0)).cast("bigint").alias("n"),
                     F.monotonically_increasing_id().alias(row))
    pieces = F.greatest(F.ceil(F.col("n") / most), F.lit(1)).cast("int")
    groups = -(-(rows.agg(F.sum(pieces)).first()[0] or 0) // group_rows) or 1
    items = rows.select("id", row, "n", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece")).select(
        "id", row, "piece", (F.col("piece").cast("bigint") * most).alias("start"),
        F.least(F.lit(most), F.col("n") - F.col("piece").cast("bigint") * most).cast("bigint").alias("length"))
    items = items.withColumn("part", F.pmod(F.xxhash64(row, "piece"), F.lit(groups)).cast("int"))

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row", "piece"], ascending=[False, True, True])
        bins, offsets, sizes = pack(frame["length"].tolist(), list(capacities), overhead)
        at = np.asarray(bins, np.int64)
        return frame.assign(bin=(int(key[0]) << 32) + at, capacity=np.asarray(sizes, np.int64)[at], offset=offsets)[
            ["id", "piece", "start", "length", "bin", "capacity", "offset"]]

    kind = df.schema[id_col].dataType.simpleString()
    packed = items.groupBy("part").applyInPandas(
        one, f"id {kind}, piece int, start bigint, length bigint, bin bigint, capacity bigint, offset bigint")
    return packed.withColumnRenamed("id", id_col)
