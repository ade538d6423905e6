import corpus_pipeline
from convlens.llm import components, ngram_join, toxicity
from convlens.llm.common import thinned


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    last = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        last = stage(spark, last, sf)
        assert last.columns == docs.columns and last.dtypes == docs.dtypes
        kept.append({r.doc_id: r for r in last.collect()})
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    fine = {r.doc_id for r in toxicity.score(docs, model).where("score < 0.5").collect()}
    assert set(kept[0]) == fine
    clean = docs.where(docs.doc_id.isin(list(fine)))
    groups = ngram_join.jaccard_components(clean, n=5, percent=80).collect()
    assert set(kept[1]) == {r.component_id for r in groups}
    assert set(kept[2]) == set(kept[1]) and any(kept[2][i].text != kept[1][i].text for i in kept[2])
    packed = corpus_pipeline.run(spark, sf).collect()
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(r.text.encode()) + 1 for i, r in kept[2].items()}


def test_stages_on_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (3, "a b " * 50_000, None, None, 1)], docs.schema)
    for rows in (odd, odd.limit(0)):
        df = rows.selectExpr("*", "1 AS score", "2 AS found")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, sf)
            assert df.columns == [*docs.columns, "score", "found"]
            assert df.count() == rows.count()
        corpus_pipeline.STAGES[-1][1](spark, df, sf).collect()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 600)] + [(7, 7), (None, 1), (3, 4), (4, 3)]
    got = {r.id: r.comp for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 600)} | {3: 3, 4: 3}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_thinned_keeps_every_wanted_row(spark):
    df, wanted = spark.range(20_000).selectExpr("id", "1 AS spot"), spark.range(0, 20_000, 97)
    got = thinned(df, df.id, wanted, wanted.id, bits=18)
    assert got.columns == ["id", "spot"]
    ids = {r.id for r in got.collect()}
    assert set(range(0, 20_000, 97)) <= ids and len(ids) < 1000


def test_one_row_of_each_component_stays(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = " ".join(f"w{i}" for i in range(200))
    near, other, third = words + " end", " ".join(f"x{i}" for i in range(50)), " ".join(f"y{i}" for i in range(50))
    rows = [(1, words), (1, words), (1, words), (2, near), (None, near), (2, other), (None, third), (None, third), (7, None), (7, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs.schema).selectExpr("*", "1 AS row", "2 AS gone_row")
    got = corpus_pipeline.drop_near_copies(spark, df, sf)
    assert got.columns == df.columns
    key = lambda x: (x[0] or 0, x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted([(1, words), (2, other), (None, third), (7, None), (7, None)], key=key)
