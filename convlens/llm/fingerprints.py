"""Document fingerprints by consistent weighted sampling, in Spark SQL functions only.

A text is a weighted set: its terms are its words, each with the next one (the last alone), the weight of a term is how often it
occurs. Weights are whole numbers, so a term of weight w is w terms of weight 1 (the term and a number below w): two texts share
the smaller weight's worth of them, and the plain Jaccard similarity of these slices is the generalised Jaccard similarity of the terms.
Every slice falls into one of ``bins`` bins by its hash, however heavy its term, and within a bin the sample is drawn by
improved consistent weighted sampling: r and c are Gamma(2, 1) and beta uniform, all fixed by the slice's hash; at weight 1
ln y = -r beta, and the slice with the least ln c - ln y - r is the bin's sample. Two texts agree in a bin with a probability equal to
the similarity of their slices there, and the share of agreeing bins among those that are not empty in both is an unbiased estimate
of the similarity of all (as for one-permutation hashing), whatever the weights. One gamma draw per slice instead of one per slice and
bin is what makes the whole corpus affordable.

Defined results: a null text counts as empty; texts without words have the fingerprint of the empty set, and two of
those have likeness 1; rows with equal texts get equal fingerprints; nulls and clashing names in other columns do not
matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.llm.common import fresh

_SCALE, _SHIFT = 2.0 ** 19, 64.0  # ln a lies in (-64, 4) for weights below e ** 20: 26 bits
_SPACES = "\t\n\x0b\x0c\r"
_MASK = 2 ** 21 - 1


def _bin_of(x: Column) -> Column:
    return F.shiftrightunsigned(x, 57)


def _sample_of(x: Column) -> Column:
    return x.bitwiseAND(F.lit(2 ** 31 - 1))


def _gamma(x: Column, low: int, high: int) -> Column:
    """Gamma(2, 1) from two disjoint stretches of 21 bits of a hash: minus the log of a product of two uniforms."""
    bits = lambda at: F.shiftrightunsigned(x, at).bitwiseAND(F.lit(_MASK)) + F.lit(0.5)
    return F.lit(42 * math.log(2)) - F.log(bits(low) * bits(high))


def _packed(h: Column, bins: int, seed: int) -> Column:
    """A slice's bin (6 bits), ln a (26 bits) and sample (31 bits) in one long, so that a bin's sample is its least long.

    The hash's lowest 6 bits choose the bin and its other bits r and beta; a second hash gives c.
    """
    r = _gamma(h, 6, 27)
    beta = (F.shiftrightunsigned(h, 48) + F.lit(0.5)) * F.lit(2.0 ** -16)
    log_a = F.log(_gamma(F.xxhash64(h, F.lit(seed)), 0, 21)) - r * (F.lit(1.0) - beta)
    q = F.floor((log_a + F.lit(_SHIFT)) * F.lit(_SCALE))
    least = F.shiftleft(q, 31).bitwiseOR(_sample_of(F.xxhash64(h, F.lit(0).cast("bigint"), F.lit(seed))))
    return F.coalesce(F.shiftleft(h.bitwiseAND(F.lit(bins - 1)), 57).bitwiseOR(least), F.lit(0))


def _slices(terms: Column) -> Column:
    """Of sorted hashes: each that begins a run, and for repeats the hash of the run's hash and how far they are into it."""
    size = F.size(terms)
    places = F.when(size == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))))
    first = lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1))
    starts = F.filter(places, first)
    # runs longer than one: (start, length)
    runs = F.filter(F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), lambda a, b: F.struct(
        a.alias("at"), (F.coalesce(b, size) - a).alias("n"))), lambda x: x["n"] > 1)
    more = F.flatten(F.transform(runs, lambda x: F.transform(F.sequence(F.lit(1), x["n"] - 1), lambda j: F.xxhash64(F.get(terms, x["at"]), j))))
    return F.concat(F.transform(starts, lambda i: F.get(terms, i)), more)


def with_fingerprint(df: DataFrame, text_col: str, out: str, bins: int = 64, seed: int = 1) -> DataFrame:
    """Adds ``out``: a long for each bin that is not empty, the bin's number in its upper bits and the sample below."""
    if bins not in (1, 2, 4, 8, 16, 32, 64):
        raise ValueError("bins must be a power of two up to 64")
    words, terms, slices, packed = fresh(df, "words", "terms", "slices", "packed")
    w, t, s, p = F.col(words), F.col(terms), F.col(slices), F.col(packed)
    spaced = F.coalesce(F.col(text_col), F.lit(""))
    for c in _SPACES:  # plain replacing and a one-character split are much cheaper than a regular expression
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    return (
        # every helper column is used at least twice below: the optimizer then never moves it into a lambda
        df.withColumn(words, F.array_remove(F.split(spaced, " "), ""))
        # each word with the next one; the last word stands alone
        .withColumn(terms, F.sort_array(F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b))))
        # the slices of a term: itself where it begins in the sorted list, and its hash with its number in its run for each repeat
        .withColumn(slices, _slices(t))
        .withColumn(packed, F.sort_array(F.transform(s, lambda h: _packed(h, bins, seed))))
        .withColumn(out, F.transform(
            F.filter(p, lambda x, i: (i == 0) | (_bin_of(x) != _bin_of(F.get(p, i - 1)))),
            lambda x: F.shiftleft(_bin_of(x), 57).bitwiseOR(_sample_of(x))))
        .drop(words, terms, slices, packed)
    )


def hex_string(fp: Column) -> Column:
    """Sixteen hex digits per bin that is not empty; the first six bits are the bin's number."""
    return F.concat_ws("", F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing bins among those that are not empty in both; 1 if all are."""
    bins = F.size(F.array_union(F.transform(a, _bin_of), F.transform(b, _bin_of)))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def with_next(df: DataFrame, order_col: str, tie_col: str, carried: dict[str, str],
              enrich: Callable[[DataFrame], DataFrame] = lambda df: df, pieces: int | None = None, piece_bytes: int = 64 << 20) -> DataFrame:
    """``enrich(df)`` with columns of the next row, under new names, in descending ``order_col`` and ascending ``tie_col`` (after
    the last row: the first), without a window over all rows: rows are cut into ranges of equal count, each range looks
    ahead by itself, and its last row takes the first row of the next range that has any. Nulls come last. Only these two columns, and what ``enrich``
    makes of them, can be carried.
    """
    piece, lead, head = fresh(df, "piece", "lead", "head")
    if pieces is None:  # a range for each stretch of ``piece_bytes`` of text, two a task at least
        size = df.agg(F.sum(F.octet_length(tie_col))).first()[0] or 0
        pieces = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2, -(-size // piece_bytes))
    grid = [i / pieces for i in range(1, pieces)]
    cuts = df.agg(F.percentile_approx(order_col, grid, 10 * pieces)).first()[0] if grid else []
    cuts = sorted({int(c) for c in cuts or []})
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    # piece 0 has the largest ids; rows without id come after all others
    cut = df.withColumn(piece, F.when(F.col(order_col).isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.size(F.filter(edges, lambda c: c > F.col(order_col)))))
    rank = F.struct((-F.coalesce(F.col(order_col), F.lit(-2 ** 63 + 1))).alias("k"), F.col(tie_col).alias("t"), F.col(order_col).alias("o"))
    firsts = cut.groupBy(piece).agg(F.min(rank).alias(head)).select(
        piece, F.col(f"{head}.o").alias(order_col), F.col(f"{head}.t").alias(tie_col))
    ring = Window.orderBy(piece)  # one row per range
    load = F.struct(*[F.col(c).alias(n) for c, n in carried.items()])
    ahead = enrich(firsts).select(piece, load.alias(lead)).select(piece, F.coalesce(
        F.lead(lead).over(ring),
        F.first(lead).over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias(head))
    rich = enrich(cut)
    order = [F.col(order_col).desc_nulls_last(), F.col(tie_col)]
    return (rich.withColumn(lead, F.lead(load).over(Window.partitionBy(piece).orderBy(*order)))
            .join(ahead, piece)
            .withColumn(lead, F.coalesce(lead, head))
            .select(*[c for c in rich.columns if c != piece], *[F.col(f"{lead}.{n}").alias(n) for n in carried.values()]))
