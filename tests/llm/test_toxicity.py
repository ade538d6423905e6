import random

import pytest

from convlens.llm import toxicity


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    parts = ["tion", "er", "on", "the", "ing", "re", "an", "es", "st", "ha", "wh", "ble"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(2, len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "vermin", "dimwit", "Blockhead"])
        rows.append((" ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(600)
    model = toxicity.fit_model(rows[:400])
    held = rows[400:]
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(held)], "doc_id bigint, text string, y int")
    got = toxicity.score(df, model).collect()
    assert len(got) == len(held)
    hit = sum(r.score >= 0.5 for r in got if r.y) / sum(r.y for r in got)
    false = sum(r.score >= 0.5 for r in got if not r.y) / sum(1 - r.y for r in got)
    assert hit > 0.9 and false < 0.05


def test_windows_keep_all_words():
    text = "Ab  c\n" + "longword " * 50
    assert b" ".join(w.strip() for w in toxicity.windows(text)).split() == text.lower().encode().split()
    assert toxicity.windows(None) == toxicity.windows(" \n") == []


def test_query_learns_from_its_own_fold_only(spark, sf, write_tables):
    from pyspark.sql import functions as F
    from convlens.llm.queries import op2_toxicity
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    folder = write_tables(documents=docs, labels=turned)
    a = {r.doc_id: r for r in op2_toxicity(spark, sf).collect()}
    b = {r.doc_id: r for r in op2_toxicity(spark, folder).collect()}
    assert a == b and len(a) == docs.count()
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in a.values())


def test_edge_cases(spark):
    rows = corpus(120)
    model = toxicity.fit_model(rows)
    texts = [None, "", " ", "vermin " * 100_000, "x", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "2 AS weights", "null AS label")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert got[0] == got[1] == got[2] < 0.5 < got[3] and got[4] == got[5]
    assert toxicity.score(df.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        toxicity.score(df.selectExpr("*", "1 AS Score"), model)
    none = toxicity.fit(df, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.score for r in toxicity.score(df, none, keep_text=True).collect()} == {0.0}


def test_caps_do_not_move_the_threshold(spark):
    # labels that the texts tell nothing of: a calibrated score is the share of toxic labels
    rng = random.Random(5)
    texts = [t for t, y in corpus(1500, seed=7) if not y]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(rng.random() < 0.2)) for i in range(len(texts))] + [(10_000 + i, 1) for i in range(500)], "doc_id bigint, toxic int")
    share = labels.where("doc_id < 10000").agg({"toxic": "avg"}).first()[0]
    for caps in ({}, {"max_toxic": 150, "max_ordinary": 150}, {"max_toxic": 200, "max_ordinary": 100}):
        got = toxicity.score(df, toxicity.fit(df, labels, **caps)).agg({"score": "avg"}).first()[0]
        assert abs(got - share) < 0.06, (caps, got, share)


def test_learns_from_one_bounded_text_of_each_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit_model", lambda rows, **more: seen.extend(rows))
    df = spark.createDataFrame([(1, "b" * 50_000)] * 300 + [(1, "c"), (2, None), (3, "d")], "doc_id bigint, text string")
    toxicity.fit(df, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int"))
    assert sorted(seen, key=str) == [(" ".join(["b" * toxicity.LEARN_STEP] * (toxicity.LEARN_CHARS // toxicity.LEARN_STEP)), 1), ("d", 0), (None, 0)]


def test_long_texts_are_learned_from_all_over(spark):
    from pyspark.sql import functions as F
    long = "".join(f"{i:07d} " for i in range(50_000))
    df = spark.createDataFrame([(long,), ("short",), (None,), ("x" * toxicity.LEARN_CHARS,)], "t string")
    got = [r.s for r in df.select(toxicity.stretches(F.col("t")).alias("s")).collect()]
    assert got[1:] == ["short", None, "x" * toxicity.LEARN_CHARS]
    numbers = [int(w) for w in got[0].split() if len(w) == 7]
    assert numbers == sorted(numbers) and numbers[0] < 5000 and numbers[-1] > 45_000 and len(got[0]) < 1.01 * toxicity.LEARN_CHARS
    tenths = {n // 5000 for n in numbers}
    assert tenths == set(range(10))
