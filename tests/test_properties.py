
from pyspark.sql import functions as F

from riskframe.operators import drift as K
from riskframe.operators import evaluation as V
from riskframe.operators import sampling as S
from riskframe.plans import catalog as C
from riskframe.plans import presets as P


def test_confusion_cells_sum_to_n(spark, sf_dir):
    t = C.scored_test(spark, sf_dir)
    cm = V.confusion_matrix(t, P.TARGET, "prediction").agg(F.sum("count")).first()[0]
    assert cm == t.count()


def test_auc_invariant_under_monotone_transform(spark, sf_dir):
    t = C.scored_test(spark, sf_dir).withColumn("s2", F.exp(F.col("puntaje_datacredito") / 100.0))
    a = V.roc_auc(t, P.TARGET, "puntaje_datacredito", 1).first()[0]
    b = V.roc_auc(t, P.TARGET, "s2", 1).first()[0]
    assert abs(a - b) < 1e-12


def test_ks_of_identical_samples_is_zero(spark, sf_dir):
    tr = C.train_rows(spark, sf_dir)
    rep = K.ks_report(tr, tr, ["capital_prestado", "edad_cliente"])
    assert all(r.ks_statistic == 0.0 and not r.drift_detectado for r in rep.collect())


def test_split_is_disjoint_complete_and_exact(spark, sf_dir):
    s = C.split_loans(spark, sf_dir)
    n = C.clean_loans(spark, sf_dir).count()
    assert s.count() == n and s.select(P.KEY).distinct().count() == n
    sizes = {(r[P.TARGET], r.split): r["count"] for r in s.groupBy(P.TARGET, "split").count().collect()}
    for y in (0, 1):
        tot = sizes.get((y, "test"), 0) + sizes.get((y, "train"), 0)
        assert sizes.get((y, "test"), 0) == int(tot * 0.2 + 0.5)


def test_stratified_fold_sizes_balanced(spark, sf_dir):
    f = S.stratified_kfold(C.train_rows(spark, sf_dir), P.TARGET, P.KEY, 5, 42, order="md5")
    counts = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(counts) - min(counts) <= 1


def test_smote_points_on_segments(spark, sf_dir):
    df = spark.createDataFrame([(i, 0 if i < 6 else 1, float(i % 6), float((i % 6) ** 2)) for i in range(30)],
                               "k long, y int, a double, b double")
    out = S.smote(df, "y", ["a", "b"], "k", minority=0, k=3, seed=7)
    syn = out.where("synthetic").collect()
    assert out.where("y = 0").count() == out.where("y = 1").count()
    pts = [(float(i), float(i * i)) for i in range(6)]
    for r in syn:
        # each synthetic point lies on a segment between two minority points
        ok = False
        for i, (ax, ay) in enumerate(pts):
            for (bx, by) in pts[:i] + pts[i + 1:]:
                if bx != ax:
                    u = (r.a - ax) / (bx - ax)
                    if -1e-9 <= u <= 1 + 1e-9 and abs(ay + u * (by - ay) - r.b) < 1e-6:
                        ok = True
        assert ok, r


def test_exact_knn_chunked_matches_brute_force(spark, monkeypatch):
    import numpy as np

    from riskframe.operators import sampling
    from riskframe.operators.sampling import exact_knn
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(120, 3))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "k long, a double, b double, c double")
    for bound in (1000, 25):                         # one cell, and several cells
        monkeypatch.setattr(sampling, "KNN_CELL", bound)
        got = {(r.k, r.nb_rank): r.nb_key for r in exact_knn(df, "k", ["a", "b", "c"], 3).collect()}
        for i in range(120):
            d = ((pts - pts[i]) ** 2).sum(1)
            d[i] = np.inf
            exp = sorted(range(120), key=lambda j: (d[j], j))[:3]
            assert [got[(i, r)] for r in range(3)] == exp
