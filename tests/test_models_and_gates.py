"""VIF, permutation, gates, tuning draws, reports, I/O helpers."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from giniflow.functions.columns import categorical_columns, order_features
from giniflow.functions.dates import report_date
from giniflow.operators import collinear, gates, importance, reports


def test_vif_planted_pair_and_intercept(spark, fixture_df):
    vals, const = collinear.vif(fixture_df, ["quantity", "quantity_x", "discount", "tax"])
    assert const == []
    assert vals["quantity"] > 20 and vals["quantity_x"] > 20
    assert vals["discount"] == pytest.approx(1.0, abs=0.05)
    assert all(v >= 1.0 - 1e-9 for v in vals.values())
    # intercept VIF equals the uncentred OLS form n / SSR of regressing 1 on the columns
    pdf = fixture_df.select("quantity", "quantity_x", "discount", "tax").toPandas().dropna()
    X = pdf.to_numpy()
    ones = np.ones(len(X))
    coef, res, *_ = np.linalg.lstsq(X, ones, rcond=None)
    ssr = float(((ones - X @ coef) ** 2).sum())
    assert vals["const"] == pytest.approx(len(X) / ssr, rel=1e-6)


def test_vif_select_drops_one_of_the_pair(fixture_df):
    dropped, final = collinear.vif_select(fixture_df, ["quantity", "quantity_x", "discount", "tax"], 1.7)
    assert len(dropped) == 1 and dropped[0][0] in ("quantity", "quantity_x")
    assert max(v for k, v in final.items() if k != "const") < 1.7


def test_permutation_is_a_bijection(fixture_df):
    d = fixture_df.select("epk_id", "quantity", "discount")
    p = importance.permute_column(d, "quantity", "epk_id", 5)
    assert sorted(r[0] for r in d.select("quantity").collect()) == sorted(r[0] for r in p.select("quantity").collect())
    assert p.join(d, ["epk_id", "discount"]).count() == d.count()
    assert p.join(d, ["epk_id", "quantity"]).count() < d.count()


def test_uplift_gate_verdicts(spark):
    rows = [(1, "a", "TRAIN", 40.0), (2, "b", "TRAIN", 50.0), (3, "c", "TRAIN", 45.0),
            (1, "a", "VALID", 44.8), (2, "b", "VALID", 30.0), (3, "c", "VALID", 45.0),
            (1, "a", "OOT", 30.0), (2, "b", "OOT", 40.0), (3, "c", "OOT", 45.0)]
    steps = spark.createDataFrame(rows, "step int, feature string, pool string, gini double")
    flagged, verdict = gates.uplift_gate(steps)
    v = {r["pool"]: r["verdict"] for r in verdict.collect()}
    assert v == {"TRAIN": "FAILED", "VALID": "YELLOW", "OOT": "GREEN"}


@pytest.mark.parametrize("tr,te,oo,expected", [
    (60.0, 40.0, 55.0, ("FAILED", "GREEN", "FAILED")),
    (50.0, 39.0, 48.0, ("YELLOW", "GREEN", "YELLOW")),
    (55.0, 52.0, 38.0, ("GREEN", "FAILED", "FAILED")),
    (50.0, 48.0, 36.0, ("GREEN", "YELLOW", "FAILED")),
])
def test_stability_gate_limits(spark, tr, te, oo, expected):
    g = spark.createDataFrame([("m", "TRAIN", tr), ("m", "TEST", te), ("m", "OOT", oo)], "model string, pool string, gini double")
    r = gates.stability_gate(g).first()
    assert (r["train_vs_test"], r["train_vs_oot"], r["oot_vs_test"]) == expected


def test_linspace_weights(spark):
    df = spark.createDataFrame([(dt.date(2000, m, 1),) for m in (1, 2, 3)], "report_dt date")
    w = [r["weight"] for r in gates.linspace_weights(df, "report_dt", 1.5).orderBy("report_dt").collect()]
    assert w == pytest.approx([1 / 3.75, 1.25 / 3.75, 1.5 / 3.75])


def test_report_dates_and_roles():
    assert report_date("DEC/20") == dt.date(2020, 10, 31)
    assert report_date("jan/21") == dt.date(2020, 11, 30)
    assert report_date("FEB/21") == dt.date(2020, 12, 31)
    assert categorical_columns(["abcd", "x_nflag", "y_group", "seg_segm", "amount"], ["amount"]) == \
        ["abcd", "x_nflag", "y_group", "seg_segm", "amount"]
    assert order_features(["lifestyle_a", "b_dt", "c", "lifestyle_x_dt"]) == ["c", "b_dt", "lifestyle_a", "lifestyle_x_dt"]


def test_deployable_keeps_null_verdict(spark):
    df = spark.createDataFrame([("a", "FAILED"), ("b", None), ("c", "GREEN")], "model string, stability string")
    assert sorted(r[0] for r in reports.deployable(df).collect()) == ["b", "c"]


def test_registry_versions(spark, tmp_path):
    from giniflow.sources import io
    path = str(tmp_path / "reg")
    assert io.register_run(spark, path, "model", {"a": 1}) == 1
    assert io.register_run(spark, path, "model", {"a": 2}) == 2
    assert io.register_run(spark, path, "selection", {"a": 3}) == 1


def test_read_through_writes_snapshot_once(spark, tmp_path):
    from giniflow.sources import io
    calls = []
    snap = str(tmp_path / "snap")
    load = lambda: spark.range(5)
    io.read_through(spark, snap, load, lambda d: calls.append(d.count()))
    io.read_through(spark, snap, load, lambda d: calls.append(d.count()))
    assert calls == [5]


def test_moments_equal_spark_covariances(fixture_df):
    cols = ["quantity", "quantity_x", "discount", "price"]
    mu, cov, n, _ = collinear.moments(fixture_df, cols)
    ref = fixture_df.agg(F.count(F.lit(1)), *[F.avg(c) for c in cols],
                         *[F.covar_pop(a, b) for a in cols for b in cols]).first()
    assert n == ref[0]
    assert mu == pytest.approx(list(ref[1:5]))
    assert cov.ravel() == pytest.approx(list(ref[5:]), rel=1e-9)


def test_category_of_many_levels_fits(spark):
    from giniflow.operators import models
    df = spark.range(3000).selectExpr("concat('c', id % 200) AS cat", "cast(id as double) AS x",
                                      "cast((id % 200) > 120 as int) AS y")
    fitted = models.fit(df, ["x"], ["cat"], "y", "GBT", {"n_iter": 2})
    assert models.score(fitted, df, ["x"], ["cat"]).where("score is null").count() == 0


def test_backtest_refit_steps(spark, fixture_df):
    from giniflow.plans import stages
    from giniflow.sources.fixture import FIXTURE_SPEC
    spec = FIXTURE_SPEC.with_features(["quantity", "discount"])
    bt = stages.backtest_refit(fixture_df, spec, ["quantity", "discount"], "LR")
    dates = sorted(r[0] for r in fixture_df.select("report_dt").distinct().collect())
    got = sorted(r["report_dt"] for r in bt.collect())
    assert got == dates[1:]
    assert all(r["oot"] is not None and r["dev"] > 20 for r in bt.collect())


def test_concat_columns_keeps_rows_and_left_copy(spark):
    from giniflow.operators.joins import concat_columns
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y")], "k int, a double, s string")
    b = spark.createDataFrame([(2, 20.0, "z"), (1, 10.0, "w")], "k int, b double, s string")
    out = sorted(tuple(r) for r in concat_columns(a, b, "k").collect())
    assert out == [(1, 1.0, "x", 10.0), (2, 2.0, "y", 20.0)]


def test_preselect_reuses_cached_importance(spark, fixture_df, tmp_path):
    import datetime as dt
    from giniflow.operators import sampling
    from giniflow.plans import stages
    from giniflow.sources.fixture import FIXTURE_SPEC
    spec = FIXTURE_SPEC.with_features(["quantity", "discount", "tax", "client_segm"])
    p = sampling.four_pools(fixture_df, "epk_id", "report_dt", [dt.date(2001, 12, 31)], seed=19)
    cache = str(tmp_path / "imp")
    imp1, rep1 = stages.preselect(p, spec, 2, "GBT", {"n_iter": 5}, 19, cache)
    imp2, rep2 = stages.preselect(p, spec, 2, "GBT", {"n_iter": 5}, 19, cache)
    assert "gini_all" in rep1.columns and "gini_all" not in rep2.columns
    assert [r["feature"] for r in imp1.orderBy("rank").collect()] == [r["feature"] for r in imp2.orderBy("rank").collect()]


def test_gini_report_hides_test_and_oot_before_final(spark):
    g = spark.createDataFrame([(p, "m", 1.0) for p in ("TRAIN", "VALID", "TEST", "OOT")], "pool string, model string, gini double")
    assert sorted(r["pool"] for r in reports.gini_report(g, columns=["m"], extended=False).collect()) == ["TRAIN", "VALID"]


def test_best_iteration_with_patience():
    from giniflow.operators.models import best_iteration
    losses = [5, 4, 3, 3.5, 3.6, 3.7, 2.0, 2.5]
    assert best_iteration(losses) == 7
    assert best_iteration(losses, patience=3) == 3
    assert best_iteration(losses, patience=4) == 7


def test_scorecard_steps_equal_the_ginis_of_its_rows(spark):
    from giniflow.operators import metrics
    from giniflow.plans import catalog_gates
    sf = "/root/testdata/sf0.001"
    rows = catalog_gates._scorecard_rows(spark, sf)
    by = ["pool", "step", "feature"]
    got, want = ({tuple(r[c] for c in by): round(r["gini"], 9) for r in g.collect()} for g in (
        catalog_gates._scorecard_steps(spark, sf), metrics.gini(rows, "score", catalog_gates.Y, by=by, digits=None)))
    assert got == want and len(got) == 16


def test_backtest_hashes_the_valid_share_once(spark, fixture_df, monkeypatch):
    from giniflow.operators import sampling
    from giniflow.plans import stages
    from giniflow.sources.fixture import FIXTURE_SPEC
    spec = FIXTURE_SPEC.with_features(["quantity", "discount"])
    asked = []
    plain = sampling.order_statistics
    monkeypatch.setattr(sampling, "order_statistics", lambda *a, **k: asked.append(k.get("stored")) or plain(*a, **k))
    bt = stages.backtest_refit(fixture_df, spec, ["quantity", "discount"], "LR")
    assert bt.count() == len(asked) == 6 and all(asked)      # every step reads stored hashes
