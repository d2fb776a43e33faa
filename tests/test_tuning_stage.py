"""Early stop by AUC, the imputation stage, resampling by weights, combinations by rank, and the resumable fine-tuning stage."""
import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from giniflow.operators import metrics, models, reports, sampling
from giniflow.operators.encode import one_hot, one_hot_vectors
from giniflow.operators.impute import MedianImputer
from giniflow.operators.tuning import candidates, combination, n_combinations
from giniflow.plans import fine_tuning, stages
from giniflow.sources import io
from giniflow.sources.fixture import FIXTURE_SPEC

SMALL = FIXTURE_SPEC.with_features(["quantity", "discount", "acct_bal", "client_segm"])


@pytest.fixture(scope="module")
def pools(spark, fixture_df):
    few = fixture_df.where("year(report_dt) >= 1999")           # three dates
    p = sampling.four_pools(few, "epk_id", "report_dt", [dt.date(2001, 12, 31)], seed=19)
    return stages.narrow_copy(p, SMALL, ["report_dt", "pool"])


# --- early stop

def test_staged_auc_equals_fit_by_fit(pools):
    num, cat = list(SMALL.numeric), list(SMALL.categorical)
    train, valid = pools.where("pool = 'TRAIN'"), pools.where("pool = 'VALID'")
    full = models.fit(train, num, cat, SMALL.target, "GBT", {"n_iter": 6})
    learner = full.model.stages[-1]
    v = PipelineModel(stages=full.model.stages[:-1]).transform(models.prepare(valid, num, cat, SMALL.target)).select("features", "label")
    staged = models.staged_auc(learner, v)
    assert len(staged) == 6
    for k in (1, 3, 6):
        refit = models.fit(train, num, cat, SMALL.target, "GBT", {"n_iter": k})
        want = metrics.gini(models.score(refit, valid, num, cat), "score", SMALL.target, digits=None).first()["gini"]
        assert staged[k - 1] == pytest.approx((want / 100 + 1) / 2, abs=1e-12)
        cut = models.first_trees(learner, k)
        assert cut.getNumTrees == k and cut.featureImportances == refit.model.stages[-1].featureImportances
        a = cut.transform(v).agg(F.sum(vector_to_array("probability")[1])).first()[0]
        b = refit.model.stages[-1].transform(v).agg(F.sum(vector_to_array("probability")[1])).first()[0]
        assert a == pytest.approx(b, rel=1e-12)
    stopped = models.fit(train, num, cat, SMALL.target, "GBT", {"n_iter": 6}, valid=valid)
    assert stopped.n_iter == 1 + int(np.argmax(staged)) and stopped.model.stages[-1].getNumTrees == stopped.n_iter


def test_a_valid_pool_of_one_class_keeps_all_trees(pools):
    train, valid = pools.where("pool = 'TRAIN'"), pools.where("pool = 'VALID' and trg_flag = 0")
    fitted = models.fit(train, ["quantity"], [], SMALL.target, "GBT", {"n_iter": 3}, valid=valid)
    assert fitted.n_iter == 3


# --- imputation

def test_median_stage_is_exact_and_reloads(spark, fixture_df, tmp_path):
    cols = ["acct_bal", "part_size"]
    model = MedianImputer(inputCols=cols, outputCols=["a", "p"]).fit(fixture_df)
    want = fixture_df.agg(*[F.percentile(c, 0.5) for c in cols]).first()
    assert model.getOrDefault(model.medians) == pytest.approx(list(want))
    fitted = models.fit(fixture_df, cols, ["client_segm"], "trg_flag", "LR")
    io.save_model_package(spark, fitted.model, str(tmp_path / "m"), [*cols, "client_segm"], ["client_segm"])
    again = io.score_batch(spark, fixture_df, str(tmp_path / "m"))
    both = models.score(fitted, fixture_df, cols, ["client_segm"]).select("epk_id", "score").join(
        again.select("epk_id", F.col("score").alias("again")), "epk_id")
    assert both.where("score <> again").count() == 0 and both.count() == fixture_df.count()
    gaps = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, float("nan")), (4.0, None)], "x double, y double")
    got = MedianImputer(inputCols=["x", "y"], outputCols=["a", "b"]).fit(gaps).transform(gaps).select("a", "b").collect()
    assert sorted(map(tuple, got)) == [(1.0, 0.0), (2.5, 0.0), (2.5, 0.0), (4.0, 0.0)]


# --- resampling

def test_weights_are_the_copies_of_the_resampled_rows(fixture_df):
    d = fixture_df.select("epk_id", "trg_flag")
    copies = {r["epk_id"]: r["count"] for r in sampling.oversample(d, "trg_flag", 0.4, "epk_id", 3).groupBy("epk_id").count().collect()}
    weights = {r["epk_id"]: r["weight"] for r in sampling.resample_weights(d, "trg_flag", "OVER", 0.4, "epk_id", 3).collect()}
    assert weights == copies
    under = sampling.resample_weights(d, "trg_flag", "UNDER", 0.4, "epk_id", 3)
    assert under.where("weight <> 1").count() == 0
    assert under.count() == sampling.undersample(d, "trg_flag", 0.4, "epk_id", 3).count()
    assert sampling.resample_weights(d, "trg_flag", "NONE", 0.4, "epk_id", 3).count() == d.count()


def test_weighted_gini_equals_the_gini_of_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(float(rng.integers(0, 9)), int(rng.integers(0, 2)), int(rng.integers(1, 4))) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, y int, w int")
    copies = df.withColumn("c", F.explode(F.sequence(F.lit(1), F.col("w"))))
    assert metrics.gini(df, "s", "y", digits=None, weight="w").first()[0] == pytest.approx(
        metrics.gini(copies, "s", "y", digits=None).first()[0], abs=1e-12)


def test_cross_validation_resamples_and_stops(pools):
    dev = pools.where("pool <> 'OOT'")
    oof, folds = models.cross_validate(dev, ["quantity", "discount"], [], "trg_flag", "epk_id", "GBT", {"n_iter": 3}, 2, 19, "OVER", 0.4)
    assert oof.count() == dev.count() and oof.select("epk_id").distinct().count() == dev.count()
    assert folds.count() == 2 and folds.where("gini_train is null or gini_test is null").count() == 0


# --- combinations

@pytest.mark.parametrize("n,lower,upper", [(5, 2, 2), (6, 1, 4), (7, 4, 7), (4, 4, 4)])
def test_every_rank_is_another_combination(spark, n, lower, upper):
    total = n_combinations(n, lower, upper)
    got = spark.range(total).select("id", combination(F.col("id"), n, lower, upper).alias("p")).orderBy("id").collect()
    want = {c for k in range(lower, upper + 1) for c in itertools.combinations(range(n), k)}
    assert {tuple(r["p"]) for r in got} == want and len(got) == len(want)
    assert [len(r["p"]) for r in got] == sorted(len(r["p"]) for r in got)


def test_candidates_draw_from_all_combinations(spark):
    feats = [f"f{k}" for k in range(30)]
    rows = candidates(spark, 200, [], 5, feats, 4, 10).collect()
    assert all(4 <= r["n_features"] == len(set(r["features"])) <= 10 for r in rows)
    assert {f for r in rows for f in r["features"]} == set(feats)
    assert candidates(spark, 200, [], 5, feats, 4, 10).collect() == rows
    few = candidates(spark, 50, [], 5, ["a", "b"], 4, 10).collect()
    assert all(sorted(r["features"]) == ["a", "b"] for r in few)
    with pytest.raises(ValueError):
        candidates(spark, 1, [], 5, [f"f{k}" for k in range(500)], 100, 250)


# --- one-hot vectors

def test_one_hot_vectors_equal_columns(spark, fixture_df):
    train = fixture_df.where("client_segm <> 'BUILDING'")
    out, slots = one_hot_vectors(train, fixture_df.select("epk_id", "client_segm", "brand_cd"), ["client_segm", "brand_cd"])
    columns = one_hot(train, fixture_df.select("epk_id", "client_segm", "brand_cd"), ["client_segm", "brand_cd"])
    names = {c: [f"{c}_{r['category']}" for r in slots.where(F.col("feature") == c).orderBy("slot").collect()] for c in ("client_segm", "brand_cd")}
    want = {r["epk_id"]: tuple(tuple(float(r[x]) for x in names[c]) for c in names) for r in columns.collect()}
    got = {r["epk_id"]: tuple(tuple(r[f"{c}_vec"].toArray()) for c in names) for r in out.collect()}
    assert got == want


def test_one_hot_of_many_values(spark):
    df = spark.range(50_000).select("id", F.concat(F.lit("v"), "id").alias("c"))
    with pytest.raises(ValueError):
        one_hot(df, df, ["c"])
    out, slots = one_hot_vectors(df, df.unionByName(df.limit(1).select("id", F.lit("new").alias("c"))), ["c"])
    sizes = {(r["c_vec"].size, len(r["c_vec"].indices)) for r in out.collect()}
    assert sizes == {(50_000, 1), (50_000, 0)} and slots.count() == 50_000


# --- the stage

SETTINGS = dict(n_best=1, n_evals=1, k=2, params={"n_iter": 2, "depth": 2}, perm_iter=1, f_lower=1, f_upper=2)


def no_fit(*a, **k):
    raise AssertionError("a stored step was computed again")


def test_stage_searches_and_resumes(spark, pools, tmp_path, monkeypatch):
    s = fine_tuning.TuningSettings(sampler="UNDER", frac=40.0, final_valid=0.3, oot_frac=0.5, **SETTINGS)
    folder, ranked = str(tmp_path / "run"), ["quantity", "client_segm", "discount", "acct_bal"]
    res = fine_tuning.fine_tuning(pools, SMALL, ranked, s, folder, selection=7)
    trials = res["trials"].collect()
    assert len(trials) == 1 and 0.36 <= trials[0]["frac"] <= 0.44
    report = {r["model"]: r for r in res["result"].collect()}
    assert set(report) == {"TOP 4", "FINAL"} and report["FINAL"]["sel"] == 7
    assert report["TOP 4"]["train"] is not None and report["TOP 4"]["test"] is None and report["FINAL"]["oot"] is not None
    assert {r["pool"] for r in res["ginis"].collect()} == {"TRAIN", "VALID", "TEST", "OOT"}
    shown = {r["pool"]: r for r in res["report"].collect()}
    assert shown["OOT"]["TOP 4"] is None and shown["OOT"]["FINAL"] is not None
    assert sorted(r["feature"] for r in res["oot_importance"].collect()) == sorted(res["features"])
    monkeypatch.setattr(models, "fit", no_fit)
    again = fine_tuning.fine_tuning(pools, SMALL, ranked, s, folder, selection=7)
    assert again["result"].orderBy("model").collect() == res["result"].orderBy("model").collect()
    assert again["params"] == res["params"] and again["features"] == res["features"]


def test_stage_resumes_behind_its_last_step(pools, tmp_path, monkeypatch):
    """The search is skipped, so the best fit is the final one; the run stops after its fits and goes on from there."""
    s = fine_tuning.TuningSettings(status=fine_tuning.SKIP, **SETTINGS)
    folder, fits = str(tmp_path / "run"), []
    real = models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **k: fits.append(1) or real(*a, **k))
    stop = reports.gini_report
    monkeypatch.setattr(reports, "gini_report", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        fine_tuning.fine_tuning(pools, SMALL, ["quantity", "discount"], s, folder)
    before = len(fits)
    monkeypatch.setattr(reports, "gini_report", stop)
    res = fine_tuning.fine_tuning(pools, SMALL, ["quantity", "discount"], s, folder)
    assert before == 3 and len(fits) == 4             # top, best, one step; then one final step only
    g = {(r["model"], r["pool"]): r["gini"] for r in res["ginis"].collect()}
    assert all(g["FINAL", p] == g["TOP 1 BEST", p] for p in ("TRAIN", "VALID", "TEST", "OOT"))
    assert res["trials"] is None
    with pytest.raises(ValueError):
        fine_tuning.fine_tuning(pools, SMALL, ["quantity"], fine_tuning.TuningSettings(status="later"), str(tmp_path / "x"))


def test_stable_search_draws_features_and_shares(pools):
    s = fine_tuning.TuningSettings(design="STABLE", sampler="OVER", frac=40.0, **SETTINGS)
    best, trials = fine_tuning.search_params(pools.where("pool = 'TRAIN'"), SMALL, ["quantity", "discount"], s)
    assert 1 <= len(best["features"]) <= 2 and 0.36 <= best["frac"] <= 0.44 and trials.count() == 1


def test_backtest_refits_with_valid_and_sampler(pools):
    bt = stages.backtest_refit(pools, SMALL, ["quantity", "discount"], "GBT", {"n_iter": 2}, 19, 0.25, "UNDER", 0.4)
    n_dates = pools.select("report_dt").distinct().count()
    assert bt.count() == n_dates - 1 and bt.where("dev is null or oot is null").count() == 0


def test_selection_samples_rows(pools):
    rows = stages.selection_sample(pools, SMALL, 0.4, under=True, seed=1)
    share = rows.agg(F.avg("trg_flag")).first()[0]
    assert share == pytest.approx(0.4, abs=0.01)
    assert stages.selection_sample(pools, SMALL, 0.5, seed=1).count() == round(pools.count() * 0.5)


def test_a_failed_publication_keeps_the_deployed_package(spark, fixture_df, tmp_path):
    fitted = models.fit(fixture_df, ["quantity"], [], "trg_flag", "LR")
    good, bad, live = (str(tmp_path / x) for x in ("good", "bad", "live"))
    io.save_model_package(spark, fitted.model, good, ["quantity"], [])
    assert io.publish_package(spark, good, live) and io.publish_package(spark, good, live)
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        io.publish_package(spark, bad, live)
    assert io.score_batch(spark, fixture_df.limit(5), live).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad", "good", "live"]


def test_gates_take_a_gini_of_zero(spark):
    from giniflow.operators import gates
    g = spark.createDataFrame([("m", "TRAIN", 40.0), ("m", "TEST", 0.0), ("m", "OOT", 0.0), ("z", "TRAIN", 0.0),
                               ("z", "TEST", 0.0), ("z", "OOT", 0.0)], "model string, pool string, gini double")
    got = {r["model"]: r["stability"] for r in gates.stability_gate(g).collect()}
    assert got == {"m": "FAILED", "z": "GREEN"}
    steps = spark.createDataFrame([("OOT", 1, "a", 3.0), ("OOT", 2, "b", 0.0)], "pool string, step int, feature string, gini double")
    flagged, _ = gates.uplift_gate(steps)
    assert flagged.where("step = 1").first()["ratio"] is None
