"""Boosted fits on feature codes equal Spark's own fits; trees on arrays equal the model's transform; Ginis by range."""
import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from giniflow.operators import boosting, metrics, models

NUM, CAT = ["a", "b", "z"], ["c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 1500
    a, b, c = rng.normal(size=n), rng.integers(0, 6, n), rng.integers(0, 5, n)
    z = np.where(rng.random(n) < 0.6, 0.0, rng.random(n) - 0.3)
    y = rng.random(n) < 1 / (1 + np.exp(-(a + 0.4 * b - 2 + (c == 2) + 2 * z)))
    w = rng.integers(1, 4, n)
    data = [(i, float(a[i]) if i % 9 else None, float(b[i]), float(z[i]), f"v{c[i]}", int(y[i]), int(w[i])) for i in range(n)]
    return spark.createDataFrame(data, "id long, a double, b double, z double, c string, y int, w int").repartition(3, "id").cache()


def shape(tree) -> str:
    return re.sub(r"uid=\w+, |Predict: \S+", "", tree.toDebugString)


@pytest.mark.parametrize("jobs", [False, True])
@pytest.mark.parametrize("weight", [None, "w"])
def test_fit_equals_spark(spark, rows, monkeypatch, jobs, weight):
    if jobs:
        for name, value in (("SMALL_ROWS", 10), ("TASK_ROWS", 200), ("BLOCK_ROWS", 150), ("REBASE", 4)):
            monkeypatch.setattr(boosting, name, value)
    est = models.make_estimator("GBT", {"n_iter": 9}, 19)
    pipe = models.build_pipeline(NUM, CAT, est)
    from pyspark.ml import Pipeline
    train = models.prepare(rows, NUM, CAT, "y")
    assembled = Pipeline(stages=pipe.getStages()[:-1]).fit(train).transform(train).select("features", "label", "w").cache()
    if weight:
        est = est.setWeightCol(weight)
    assert boosting.can_fit(est)
    want, got = est.fit(assembled), boosting.fit(est, assembled, weight)
    assert [shape(t) for t in got.trees] == [shape(t) for t in want.trees] and got.treeWeights == want.treeWeights
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
    p = lambda m: [r[0] for r in m.transform(assembled).select(vector_to_array("probability")[1]).collect()]
    assert p(got) == pytest.approx(p(want), abs=1e-10)


def test_draws_and_deep_trees_stay_with_spark():
    for params in ({"subsample": 0.5}, {"rsm": 0.5}, {"depth": 9}):
        assert not boosting.can_fit(models.make_estimator("GBT", params))


def test_a_fit_is_not_three_jobs_a_tree(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("one-fit", "fit")
    fitted = models.fit(rows, NUM, CAT, "y", "GBT", {"n_iter": 40})
    sc.setJobGroup("other", "other")
    assert fitted.model.stages[-1].getNumTrees == 40
    assert len(sc.statusTracker().getJobIdsForGroup("one-fit")) < 40


def test_scores_equal_the_transform(rows):
    for params in ({"n_iter": 5}, {"n_iter": 3, "depth": 8, "subsample": 0.7}):
        fitted = models.fit(rows, NUM, CAT, "y", "GBT", params)
        new = rows.withColumn("c", F.when(F.col("id") % 7 == 0, "unseen").otherwise(F.col("c")))
        own = models.score(fitted, new, NUM, CAT)
        assert set(own.columns) == {*new.columns, "score"}
        ml = fitted.model.transform(models.prepare(new, NUM, CAT, None)).select("id", vector_to_array("probability")[1].alias("p"))
        both = own.select("id", "score").join(ml, "id").collect()
        assert len(both) == rows.count() and [r["score"] for r in both] == pytest.approx([r["p"] for r in both], abs=1e-12)


def test_row_gini_equals_gini(spark, monkeypatch):
    monkeypatch.setattr(metrics, "RANGE_ROWS", 100)
    rng = np.random.default_rng(5)
    data = [(None if k % 3 == 0 else f"g{k % 3}", float(s) if k % 2 else float(round(s, 1)), None if k % 50 == 0 else int(y))
            for k, (s, y) in enumerate(zip(rng.normal(size=900), rng.integers(0, 2, 900)))]
    data += [("one", 0.5, 1), ("nan", float("nan"), 1)]
    df = spark.createDataFrame(data, "g string, s double, y int")
    want = {r["g"]: r["gini"] for r in metrics.gini(df, "s", "y", by=["g"], digits=None).collect()}
    got = {r["g"]: r["gini"] for r in metrics.row_gini(df, "s", "y", by=["g"], digits=None).collect()}
    assert got == pytest.approx(want, abs=1e-9) and set(got) == set(want) and got["one"] is None
    assert metrics.row_gini(df, "s", "y").first()["gini"] == metrics.gini(df, "s", "y").first()["gini"]


@pytest.mark.parametrize("learner, params", [("LR", None), ("GBT", {"n_iter": 6}), ("GBT", {"n_iter": 3, "depth": 8, "rsm": 0.5})])
def test_variants_on_arrays_equal_variants_as_rows(rows, monkeypatch, learner, params):
    from giniflow.operators import importance
    fitted = models.fit(rows, NUM, CAT, "y", learner, params)
    some = rows.withColumn("c", F.when(F.col("id") % 7 == 0, "unseen").otherwise(F.col("c"))).withColumn(
        "y", F.when(F.col("id") % 11 != 0, F.col("y")))
    ask = lambda scorer: {r["feature"]: r["importance"] for r in importance.permutation_importance(
        some, [*CAT, *NUM], "y", "id", scorer, 4, 7).collect()}
    want = ask(lambda frame: models.score(fitted, frame, NUM, CAT))
    monkeypatch.setattr(models.Scorer, "__call__", None)         # the rows of the variants are not built
    for name, value in (("PASS_ROWS", 3000), ("CHUNK_ROWS", 400), ("HELD_ROWS", 900)):
        monkeypatch.setattr(importance, name, value)
    monkeypatch.setattr(metrics, "RANGE_ROWS", 300)
    got = ask(models.Scorer(fitted, NUM, CAT))
    assert got == pytest.approx(want, abs=1e-9) and set(got) == {*NUM, *CAT}


def test_passes_give_their_shuffles_back(rows, monkeypatch):
    from giniflow.operators import importance
    fitted, calls = models.fit(rows, NUM, CAT, "y", "LR"), []
    monkeypatch.setattr(importance, "PASS_ROWS", 1)
    monkeypatch.setattr(importance, "release_shuffles", lambda spark: calls.append(1))
    importance.permutation_importance(rows, ["a"], "y", "id", models.Scorer(fitted, NUM, CAT), 5, 7).collect()
    assert len(calls) == 4


def test_cells_of_a_search_share_folds_and_splits(spark, rows, monkeypatch):
    from giniflow.operators import sampling
    from giniflow.plans import stages
    from giniflow.spec import SampleSpec
    calls, plain = [], sampling.stratified_folds
    monkeypatch.setattr(sampling, "stratified_folds", lambda *a, **k: calls.append(1) or plain(*a, **k))
    spec = SampleSpec(key="id", date_col="id", target="y", numeric=("a", "b"), categorical=("c",))
    cells = stages.grid_cells(spark, ["LR"], [("ORIG", 0), ("OS", 60)], 0.3)
    rep = {r["label"]: r["gini"] for r in stages.search_grid(rows.drop("w", "z"), spec, cells, k=2, seed=5).collect()}
    assert len(calls) == 1 and set(rep) == {"LR", "LR_OS_60%"}
    oof, folds = models.cross_validate(rows, ["a", "b"], CAT, "y", "id", "LR", k=2, seed=5)
    assert models.cv_summary(oof, folds, "y")["gini"] == rep["LR"]


def test_uneven_partitions_are_evened(spark, monkeypatch):
    monkeypatch.setattr(models, "EVEN_ROWS", 100)
    df = spark.range(0, 1000, 1, 1).union(spark.range(1000, 1010, 1, 4))
    even = models.evened(df.cache())
    sizes = even.rdd.glom().map(len).collect()
    assert sum(sizes) == 1010 and max(sizes) <= 2 * 1010 / spark.sparkContext.defaultParallelism
    monkeypatch.setattr(models, "EVEN_ROWS", 2000)
    assert models.evened(df) is df


def test_missing_labels_and_infinite_values_raise(spark, rows):
    broken = rows.withColumn("y", F.when(F.col("id") != 5, F.col("y")))
    with pytest.raises(Exception, match="label"):
        models.fit(broken, NUM, CAT, "y", "GBT", {"n_iter": 2})
    broken = rows.withColumn("b", F.when(F.col("id") == 5, float("inf")).otherwise(F.col("b")))
    with pytest.raises(Exception, match="infinity"):
        models.fit(broken, NUM, CAT, "y", "GBT", {"n_iter": 2})
