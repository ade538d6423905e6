import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convlens.llm import fingerprints


def jaccard(a, b):
    """Generalised Jaccard similarity of the weighted sets the fingerprints are of."""
    def bag(t):
        w = (t or "").split()
        return Counter(zip(w, [*w[1:], None]))
    x, y = bag(a), bag(b)
    over = sum(max(x[k], y[k]) for k in x | y)
    return sum(min(x[k], y[k]) for k in x | y) / over if over else 1.0


def test_estimates_generalised_jaccard(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        words = rng.choices(["a", "b", "c", "d", "e", "f", "g", "h"], k=rng.randint(150, 400))
        other = [w if rng.random() > 0.2 else rng.choice("abcdefgh") for w in words]
        pairs.append((" ".join(words), " ".join(other)))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = (fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
           .select("a", "b", fingerprints.likeness(F.col("x"), F.col("y")).alias("l")).collect())
    error = [r.l - jaccard(r.a, r.b) for r in got]
    assert abs(sum(error) / len(error)) < 0.03 and max(map(abs, error)) < 0.35


def _mean_error(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = (fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
           .select("a", "b", fingerprints.likeness(F.col("x"), F.col("y")).alias("l")).collect())
    return sum(r.l - jaccard(r.a, r.b) for r in got) / len(got)


def test_unbiased_on_skewed_and_uniform_weights(spark):
    """A few terms hold most of the weight (repeated boilerplate), or all hold the same."""
    rng = random.Random(9)
    skewed, uniform = [], []
    for i in range(250):
        own = lambda n: [f"w{i}x{rng.random()}" for _ in range(n)]
        plate = [f"boiler{i}", f"plate{i}"]  # other ones in each pair: errors are independent
        skewed.append((" ".join(plate * 450 + own(60)), " ".join(plate * rng.randint(200, 500) + own(60))))
        shared = own(150)
        uniform.append((" ".join(shared + own(70)), " ".join(shared + own(70))))
    assert 0.4 < sum(jaccard(*p) for p in skewed) / 250 < 0.9
    assert abs(_mean_error(spark, skewed)) < 0.02 and abs(_mean_error(spark, uniform)) < 0.02


def test_query(spark, sf):
    from convlens.llm.queries import op10_fingerprints
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in op10_fingerprints(spark, sf).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for i, (d, t) in enumerate(docs):
        after, r, half = docs[(i + 1) % len(docs)][1], got[d], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert abs(r.near_edited - jaccard(t, edited)) < 0.4 and abs(r.near_next - jaccard(t, after)) < 0.4
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)


def test_next_row_with_ties_and_nulls(spark):
    rows = [(5, "a"), (5, "b"), (5, "b"), (3, "c"), (9, None), (None, "n"), (1, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS piece", "2 AS Lead")
    for pieces in (1, 2, 50):
        got = fingerprints.with_next(df, "doc_id", "text", {"text": "after", "doc_id": "next_id"}, pieces=pieces).collect()
        found = sorted(((r.doc_id, r.text, r.next_id, r.after) for r in got), key=str)
        assert found == sorted([(9, None, 5, "a"), (5, "a", 5, "b"), (5, "b", 5, "b"), (5, "b", 3, "c"), (3, "c", 1, ""), (1, "", None, "n"), (None, "n", 9, None)], key=str)


def test_edge_cases(spark):
    long = "word other " * 100_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (5, long)], "doc_id bigint, text string").selectExpr(
        "*", "0 AS words", "1 AS Slices")
    got = {r.doc_id: r for r in fingerprints.with_fingerprint(df, "text", "fp").collect()}
    assert got[1].fp == got[2].fp == got[3].fp == [] and len(got[4].fp) == 1 and len(got[5].fp) == 64
    assert fingerprints.with_fingerprint(df.limit(0), "text", "fp").collect() == []
    with pytest.raises(ValueError):
        fingerprints.with_fingerprint(df, "text", "fp", bins=3)


def test_no_python_in_the_plan(spark, sf):
    from convlens.llm.queries import op4_pii, op10_fingerprints
    for query in (op4_pii, op10_fingerprints):
        plan = query(spark, sf)._jdf.queryExecution().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
