"""Order-dependent computations that stay distributed under skew.

Spark's ``Window.partitionBy(g)`` sends a whole group to one task, and an
un-partitioned ``Window.orderBy`` sends the whole table to one task. The two
helpers here split the work in two phases so that no task ever holds more
than one *bounded* slice:

* :func:`sequence_within_group` – ``row_number`` per group, computed as
  (rows of the group in earlier cells) + (row number inside the cell), where a
  cell is a (group, day) or, for a hot one, a count-balanced part of it. The
  prefix runs over the small per-cell count table.
* :func:`ordered_prefix` – global running sums over an ordered key (ROC/PR
  curves, cumulative gains). The key is cut into ranges of near-equal row
  count by ``percentile_approx``; range totals (one row per range) give the
  offsets, and each range is summed by its own window partition.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequence_within_group(df: DataFrame, group: list[str], slice_col: str,
                          order_cols: list[str], out: str, max_group_rows: int = 1_000_000,
                          n_cuts: int = 256) -> DataFrame:
    """Exact ``row_number() over (partition by group order by slice_col, order_cols)``
    for non-NULL group and slice keys, without one task per whole group.

    * rows are numbered inside a (group, slice, sub) cell and offset by the
      rows of the group in earlier cells; the offset window runs over the small
      per-slice count table, so wide rows are shuffled once, by (group, slice).
    * ``slice_col`` (e.g. a day) is the leading sort key. A (group, slice)
      holding more than ``max_group_rows`` rows is cut into ``n_cuts``
      count-balanced sub-slices at approximate quantiles of the first order
      column (numeric); the sub-slice id is monotone in that column, so the
      ordering -- and the numbering -- stays exact. There is at most one such
      slice per ``max_group_rows`` rows, so their tables are broadcast.
    * the helper side is distinct on its join keys and joined LEFT, so when
      ``out`` is unused Catalyst drops the whole branch from the plan.
    """
    keys = [*group, slice_col]
    first = F.col(order_cols[0]).cast("double")
    sub = F.coalesce(F.size(F.filter("_cuts", lambda c: c < first)), F.lit(0))
    per_slice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = per_slice.where(F.col("_n") > max_group_rows).select(*keys)
    probs = [i / n_cuts for i in range(1, n_cuts)]
    narrow = df.select(*keys, order_cols[0])
    # quantile sketches and counts of sub-slices only for hot slices
    cuts = (narrow.join(F.broadcast(hot), keys, "left_semi")
            .groupBy(*keys).agg(F.percentile_approx(first, probs, 10_000).alias("_cuts")))
    subs = (narrow.join(F.broadcast(cuts), keys).groupBy(*keys, "_cuts", sub.alias("_sub")).agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(*keys, "_cuts").agg(F.collect_list(F.struct("_sub", "_n")).alias("_subs")))
    w_prefix = (Window.partitionBy(*group).orderBy(slice_col)
                .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum("_n").over(w_prefix), F.lit(0))
    side = (per_slice.select(*keys, before.alias("_before")).join(F.broadcast(subs), keys, "left")
            .groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("_before", "_cuts", "_subs")]))  # makes distinctness visible
    w_in = Window.partitionBy(*keys, "_sub").orderBy(*order_cols)
    in_slice = F.coalesce(F.aggregate(F.filter("_subs", lambda x: x["_sub"] < F.col("_sub")), F.lit(0).cast("bigint"),
                                      lambda total, x: total + x["_n"]), F.lit(0))
    ranked = df.join(side, on=keys, how="left").withColumn("_sub", sub).withColumn("_rn_in_cell", F.row_number().over(w_in))
    return (ranked.withColumn(out, (F.coalesce(F.col("_before"), F.lit(0)) + in_slice + F.col("_rn_in_cell")).cast("int"))
            .drop("_before", "_cuts", "_subs", "_rn_in_cell", "_sub"))


def ordered_prefix(df: DataFrame, order_col: str, sum_cols: list[str], keys: list[str] = (),
                   range_rows: int = 100_000, most_ranges: int = 100_000, accuracy: int = 100_000) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows with ``order_col`` <= this row's
    (ascending, ties by ``order_col`` only: callers pass distinct keys).

    With ``keys`` each key has running sums of its own, all keys in one pass: the ranges are cut over all rows,
    so a (key, range) part is never larger than a range.
    ``df`` should already be reduced to one row per distinct ``order_col`` (and key).
    The number of ranges follows the number of rows (about ``range_rows`` in each); only their boundaries, at most
    ``most_ranges``, are brought to the driver. One aggregate counts and cuts; a second is needed above a thousand ranges.
    """
    n_ranges = 1024
    while True:
        probs = [i / n_ranges for i in range(1, n_ranges)]
        rows, qs = df.agg(F.count(order_col), F.percentile_approx(order_col, probs, accuracy)).first()
        wanted = min(most_ranges, max(8, -(-rows // range_rows)))
        if wanted <= n_ranges:
            break
        n_ranges = wanted
    cuts = sorted({float(q) for q in (qs or [])[n_ranges // wanted - 1::n_ranges // wanted] if q is not None}) or [0.0]
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=order_col, outputCol="_range",
                          handleInvalid="keep").transform(df.withColumn(order_col, F.col(order_col).cast("double")))
    totals = bucketed.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    w_all = (Window.partitionBy(*keys) if keys else Window).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: at most most_ranges rows, so the single-partition window
    # and the broadcast below are bounded by that, not by the data.
    offsets = totals.select(*keys, "_range", *[
        F.coalesce(F.sum(f"_tot_{c}").over(w_all), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    w_in = (Window.partitionBy(*keys, "_range").orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = bucketed.join(offsets if keys else F.broadcast(offsets), on=[*keys, "_range"], how="inner")
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_off_{c}") + F.sum(c).over(w_in))
    return out.drop("_range", *[f"_off_{c}" for c in sum_cols])
