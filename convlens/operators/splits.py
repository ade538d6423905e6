"""Train / test / validation splits and sampling.

The split is a pure function of the key: ``md5(key:seed)`` -> a number in
[0, 10000). It needs no shuffle, does not depend on partitioning or on the
order rows arrive in, and survives recomputation after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions import columns as C


def hash_unit(key, seed: int | str, salt: str = "") -> F.Column:
    """Deterministic 0..9999 bucket of a key."""
    s = F.concat_ws(":", C.col_(key).cast("string"), F.lit(str(seed)), *([F.lit(salt)] if salt else []))
    return (F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") % 10000).cast("int")


def split_hash(df: DataFrame, key: str = "session_id", test_size: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    cut = int(round(test_size * 10000))
    return df.withColumn(out, F.when(hash_unit(key, seed) < cut, F.lit("test")).otherwise(F.lit("train")))


def split_nested(df: DataFrame, key: str = "session_id", test_size: float = 0.2, val_size: float = 0.1,
                 seed: int = 42, out: str = "split") -> DataFrame:
    """test / val / fit: ``val`` is ``val_size`` of the train part, drawn with an
    independent salt."""
    base = split_hash(df, key, test_size, seed, out)
    vcut = int(round(val_size * 10000))
    return base.withColumn(out, F.when((F.col(out) == "train") & (hash_unit(key, seed, "val") < vcut), F.lit("val"))
                           .when(F.col(out) == "train", F.lit("fit")).otherwise(F.col(out)))


def least_hashes(df: DataFrame, key: str, target: str, ranks: dict, seed: int | str, salt: str = "", few: int = 100_000) -> dict:
    """Per class and rank k of ``ranks`` (class -> ranks), the k-th least ``md5(key:seed[:salt])`` of the class's rows.

    Hashes are counted by their first hex digits: one aggregate finds in which prefix each rank lies, and prefixes are made
    longer, two digits more in each pass, only for those still wanted, until at most ``few`` rows share one; these
    are ranked. So no pass sorts or collects more than a few rows, and none of its tables is larger than 256 rows a wanted rank.
    """
    h = _hash(key, seed, salt)
    hashed = df.select(F.col(target).alias("c"), h.alias("h"))
    wanted = [(c, k, "", k) for c, ks in ranks.items() for k in ks if k > 0]  # class, rank, prefix, rank within the prefix
    found = {}
    while wanted:
        some = sorted({(c, p) for c, _, p, _ in wanted}, key=str)
        width = len(some[0][1]) + 2
        cond = None
        for c, p in some:
            one = F.col("c").eqNullSafe(F.lit(c)) & F.col("h").startswith(p)
            cond = one if cond is None else cond | one
        counts = hashed.where(cond).groupBy("c", F.substring("h", 1, width).alias("p")).count().collect()
        last, deeper = [], []
        for c, k, prefix, rest in wanted:
            for p, n in sorted((r["p"], r["count"]) for r in counts if r["c"] == c and r["p"].startswith(prefix)):
                if rest <= n:
                    (last if n <= few or width >= 32 else deeper).append((c, k, p, rest))
                    break
                rest -= n
        for c, p in {(c, p) for c, _, p, _ in last}:
            # at most ``few`` rows; a whole hash that more rows share is its own answer
            values = [p] if len(p) >= 32 else [r["h"] for r in hashed.where(F.col("c").eqNullSafe(F.lit(c)) & F.col("h").startswith(p)).orderBy("h").collect()]
            found |= {(c, k): values[min(rest, len(values)) - 1] for d, k, q, rest in last if (d, q) == (c, p)}
        wanted = deeper
    return found


def _hash(key, seed: int | str, salt: str = "") -> F.Column:
    return F.md5(F.concat_ws(":", C.col_(key).cast("string"), F.lit(str(seed)), *([F.lit(salt)] if salt else [])))


def stratified_parts(df: DataFrame, key: str, target: str, shares: list[float], seed: int | str = 42, salt: str = "",
                     out: str = "part") -> DataFrame:
    """``out`` = number of the part (from 0) of each row: within every class, parts hold exactly
    ``round(n * (shares up to it))`` rows less those before, by rank of the keyed hash. A pure filter once the thresholds (one per class and
    part) are known: no shuffle, no dependence on partitioning. Rows with equal keys stay together."""
    return df.withColumn(out, _part(df, key, target, shares, seed, salt))


def _part(df: DataFrame, key: str, target: str, shares: list[float], seed: int | str, salt: str) -> F.Column:
    """The number of the part, learned on ``df``: an expression over key and class."""
    per = _class_counts(df, target)
    ends = [sum(shares[:i + 1]) for i in range(len(shares) - 1)]
    cuts = {c: [int(n * e + 0.5) for e in ends] for c, n in per.items()}
    least = least_hashes(df, key, target, cuts, seed, salt)
    h = _hash(key, seed, salt)
    part = F.lit(0)
    for i in range(len(ends)):
        above = F.lit(True)
        for c, ks in cuts.items():
            limit = least.get((c, ks[i]))
            above = F.when(F.col(target).eqNullSafe(F.lit(c)), h > F.lit(limit) if limit is not None else F.lit(True)).otherwise(above)
        part = part + above.cast("int")
    return part


def split_stratified(df: DataFrame, key: str = "session_id", target: str = "target", test_size: float = 0.2, val_size: float = 0.1,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """test / val / fit with exact counts per class: ``val`` is ``val_size`` of the train part, by an independent hash."""
    base = stratified_parts(df, key, target, [test_size, 1 - test_size], seed, out="_test")
    val = _part(base.where(F.col("_test") == 1), key, target, [val_size, 1 - val_size], seed, "val")
    # one select over all rows, not a union: the rows are read once, and every partition holds its share of each part
    return base.withColumn(out, F.when(F.col("_test") == 0, F.lit("test")).when(val == 0, F.lit("val")).otherwise(F.lit("fit"))).drop("_test")


def stratified_folds(df: DataFrame, key: str = "session_id", target: str = "target", folds: int = 3, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """``out`` = 0 to folds - 1, with equal counts per class (but for rounding)."""
    return stratified_parts(df, key, target, [1 / folds] * folds, seed, "cv", out)


def split_summary(df: DataFrame, split: str = "split", target: str = "target") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                 C.round6(F.avg(F.col(target).cast("double"))).alias("cr"))


def split_by_time(df: DataFrame, date_col: str = "visit_date", test_size: float = 0.2,
                  out: str = "split") -> DataFrame:
    """Dates after the cut go to test; the cut is the first date at which the
    cumulative share of rows reaches 1 - test_size. The window runs over the
    distinct-date table (one row per day), not over rows."""
    days = df.where(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = days.agg(F.sum("_n")).scalar()
    cum = days.select(date_col, (F.sum("_n").over(w) / total).alias("_share"))
    cut = cum.where(F.col("_share") >= 1 - test_size).agg(F.min(date_col)).scalar()
    return df.withColumn(out, F.when(F.col(date_col) > cut, F.lit("test")).otherwise(F.lit("train")))


def sample_n(df: DataFrame, n: int, key: str = "session_id", seed: int = 42) -> DataFrame:
    """Uniform sample of exactly n rows: the n smallest ``md5(key:seed)``.

    A plain ``orderBy(hash).limit(n)`` ships n rows from *every* partition to
    one place; instead rows are first pre-filtered on the hash prefix with a
    cut expected to keep ~3n rows (a pure filter, no shuffle), and the exact
    top-n is taken among those. The n smallest hashes always pass the cut once
    at least n rows do, so the result is exact; the cut widens if too few pass.
    """
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    prefix = F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(20,0)")  # 60 uniform bits
    total = df.count()
    frac = min(1.0, 3.0 * n / max(total, 1))
    while True:
        cut = int(frac * (1 << 60))
        kept = df.withColumn("_h", h).where((prefix < F.lit(cut)) | F.lit(frac >= 1.0))
        if frac >= 1.0 or kept.count() >= min(n, total):
            break
        frac = min(1.0, frac * 4)
    return kept.orderBy("_h", key).limit(n).drop("_h")


def _class_counts(df: DataFrame, target: str) -> dict:
    """Rows per class, one aggregate (as many rows as classes)."""
    return {r[0]: r[1] for r in df.groupBy(target).agg(F.count(F.lit(1))).collect()}


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """Per class: n, balanced weight n / (k * n_c), and max_c(n_c) / n_c.
    One row per class (bounded by the number of classes)."""
    per = _class_counts(df, target)
    total, most, k = sum(per.values()), max(per.values(), default=0), len(per)
    rows = [(c, n, total / (k * n), most / n) for c, n in per.items()]
    kind = df.schema[target].dataType.simpleString()
    out = df.sparkSession.createDataFrame(rows, f"`{target}` {kind}, n bigint, b double, m double")
    return out.select(target, "n", C.round6("b").alias("weight_balanced"), C.round6("m").alias("weight_max_ratio"))


def with_class_weight(df: DataFrame, target: str = "target", out: str = "weight", per: DataFrame | None = None) -> DataFrame:
    """Attach the exact balanced class weight, as literals per class; counted in ``per`` (the same rows, cheaper to read) if given."""
    per = _class_counts(df if per is None else per, target)
    weight = F.lit(None).cast("double")
    for c, n in per.items():
        weight = F.when(F.col(target).eqNullSafe(F.lit(c)), F.lit(sum(per.values()) / (len(per) * n))).otherwise(weight)
    return df.withColumn(out, weight)
