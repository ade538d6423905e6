"""How often rows are passed over: own rows, counted by what runs on them."""

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from convlens.operators import evaluation as EV
from convlens.operators import modeling as M
from convlens.plans import frames
from convlens.streaming import labeling as SL


def test_ids_given_out_once_without_a_python_call_per_id(spark, tmp_path):
    rows = [(str(i % 7), "R" if i % 2 else "N") for i in range(40)] + [(None, "R")]
    df = spark.createDataFrame(rows, "session_id string, event_action string")
    path, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    df.repartition(4).write.parquet(path)
    stream = SL.converted_once(SL.hits_stream(spark, path, df.schema, max_files=1), frames.CFG)
    plan = stream._jdf.queryExecution().logical().toString()
    assert "Deduplicate" in plan and "InPandasWithState" not in plan
    SL.run_to_table(stream, out, ckpt)
    got = [r.session_id for r in SL.read_converted(spark, out).collect()]
    assert sorted(got) == sorted({s for s, a in rows if a == "R" and s})


def test_scores_are_made_once_for_the_auc(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        made.add(1)
        return (i * 37 % 100) / 100

    df = spark.range(0, 400, 1, 4).select((F.col("id") % 3).alias("k"), score("id").alias("score"), (F.col("id") % 2).cast("int").alias("label"))
    assert EV.keyed_auc(df, ["k"]).count() == 3 and made.value == 400


def test_folds_times_grid_are_the_only_fits(spark, monkeypatch):
    rows = [(str(i), int(i % 3 == 0), "a" if i % 5 else "b", float(i % 11)) for i in range(300)]
    visits = spark.createDataFrame(rows, "session_id string, target int, utm_medium string, visit_hour double")
    monkeypatch.setattr(M, "encoder_stages", lambda cfg: _stages())
    fits, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: fits.append(self.getRegParam()) or fit(self, df))
    got = [tuple(r) for r in M.cv_logistic(visits, frames.CFG, grid=(0.5, 2.0), folds=3).collect()]
    assert [c for c, _ in got] == [0.5, 2.0] and all(0 < auc < 1 for _, auc in got)
    assert sorted(fits) == sorted([1 / (0.5 * 300), 1 / (2.0 * 300)] * 3)


def _stages():
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    return [SQLTransformer(statement="SELECT * FROM __THIS__"), VectorAssembler(inputCols=["visit_hour"], outputCol="features")]
