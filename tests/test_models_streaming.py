"""Model fitting / persistence (S7, M2-M8) and the streaming forms."""

import os

from pyspark.sql import functions as F

from riskframe.operators.models import batch_score, fit_candidate
from riskframe.plans import catalog as C
from riskframe.plans import presets as P
from riskframe.plans.scoring import score_batch
from riskframe.sources import io as IO
from riskframe.streaming import monitor as M


def _model(spark, sf_dir):
    return fit_candidate(C.train_rows(spark, sf_dir), "logreg", P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES, P.TARGET)


def test_fit_save_load_and_score(spark, sf_dir, tmp_path):
    model = _model(spark, sf_dir)
    IO.save_model(model, str(tmp_path / "m"))
    loaded = IO.load_model(str(tmp_path / "m"))
    test = C.test_rows(spark, sf_dir)
    a = batch_score(model, test, keep=[P.KEY])
    b = batch_score(loaded, test, keep=[P.KEY])
    assert a.exceptAll(b).count() == 0
    r = a.first()
    assert r.etiqueta in ("Mora", "Paga a tiempo") and 0 <= r.probabilidad_mora <= 1
    assert r.n_registros == test.count()


def test_score_batch_rejects_bad_rows(spark, sf_dir):
    model = _model(spark, sf_dir)
    batch = C.test_rows(spark, sf_dir).withColumn("edad_cliente", F.col("edad_cliente").cast("double"))
    scored, rejected = score_batch(model, batch, keep=[P.KEY])
    n_bad = batch.where(" OR ".join(f"{c} IS NULL" for c in
                                    [f.name for f in __import__("riskframe.plans.scoring", fromlist=["x"]).SCORING_SCHEMA.fields])).count()
    assert rejected.count() == n_bad
    assert scored.count() == batch.count() - n_bad


def test_streaming_period_stats_equal_batch(spark, sf_dir, tmp_path):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ev.write.parquet(str(tmp_path / "events_in"))          # file streams read a folder
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "events_in"))
    q = (M.stream_period_stats(stream, "7 days").writeStream.outputMode("complete").format("memory")
         .queryName("period_stats_t").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM period_stats_t")
    exp = M.period_stats(ev, "7 days")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_streaming_scores_equal_batch(spark, sf_dir, tmp_path):
    model = _model(spark, sf_dir)
    test = C.test_rows(spark, sf_dir)
    src = tmp_path / "batch"
    test.write.parquet(str(src))
    stream = spark.readStream.schema(test.schema).parquet(str(src))
    q = (M.stream_scores(stream, model, keep=[P.KEY]).writeStream.format("memory").queryName("scores_t")
         .option("checkpointLocation", str(tmp_path / "ck2")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM scores_t")
    exp = batch_score(model, test, keep=[P.KEY]).drop("n_registros")
    assert got.exceptAll(exp).count() == 0 and got.count() == exp.count()


def test_streaming_drift_per_batch(spark, sf_dir, tmp_path):
    ref = C.train_rows(spark, sf_dir)
    test = C.test_rows(spark, sf_dir).select(*C.DRIFT_COLUMNS)
    src = tmp_path / "drift_in"
    test.write.parquet(str(src))
    out = []
    q = M.stream_drift(spark.readStream.schema(test.schema).parquet(str(src)), ref, C.DRIFT_COLUMNS,
                       lambda rep, bid: out.append(rep.collect()), checkpoint=str(tmp_path / "ck3"))
    q.processAllAvailable()
    q.stop()
    assert out and len(out[0]) == len(C.DRIFT_COLUMNS)


def test_run_log_stream(spark, tmp_path):
    src = tmp_path / "metrics_in"
    spark.createDataFrame([("recall", 0.5)], "metric string, value double").write.parquet(str(src))
    stream = spark.readStream.schema("metric string, value double").parquet(str(src))
    q = M.run_log_stream(stream, str(tmp_path / "log"), str(tmp_path / "ck4"), "exp")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1
    assert os.path.isdir(tmp_path / "log" / "experiment=exp")


def test_learning_curve_ml_small(spark, sf_dir):
    from riskframe.plans.training import learning_curve_ml

    lc = learning_curve_ml(C.train_rows(spark, sf_dir), "logreg", n_splits=2, fractions=(0.5, 1.0)).collect()
    assert len(lc) == 2 and all(0.0 <= r.test_mean <= 1.0 for r in lc)
