"""Metric properties: Gini against brute-force pairwise AUC, symmetry, monotone invariance, partitioning invariance."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from giniflow.operators import metrics


def brute_auc(s, y):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def rnd(spark):
    rng = np.random.default_rng(7)
    n = 3000
    s = np.round(rng.normal(size=n), 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-s))).astype(int)
    g = rng.integers(0, 3, n)
    df = spark.createDataFrame([(float(a), int(b), int(c)) for a, b, c in zip(s, y, g)], "s double, y int, g int")
    return df, s, y, g


def test_gini_equals_pairwise_auc(rnd):
    df, s, y, g = rnd
    got = metrics.gini(df, "s", "y", digits=None).first()["gini"]
    assert got == pytest.approx((2 * brute_auc(s, y) - 1) * 100, abs=1e-9)
    per = {r["g"]: r["gini"] for r in metrics.gini(df, "s", "y", by=["g"], digits=None).collect()}
    for k in range(3):
        assert per[k] == pytest.approx((2 * brute_auc(s[g == k], y[g == k]) - 1) * 100, abs=1e-9)


def test_symmetry_and_monotone_invariance(rnd):
    df, *_ = rnd
    base = metrics.gini(df, "s", "y", digits=None).first()["gini"]
    neg = metrics.gini(df.withColumn("s", -F.col("s")), "s", "y", digits=None).first()["gini"]
    mono = metrics.gini(df.withColumn("s", F.exp("s")), "s", "y", digits=None).first()["gini"]
    assert neg == pytest.approx(-base, abs=1e-9)
    assert mono == pytest.approx(base, abs=1e-9)


def test_partitioning_does_not_change_results(rnd):
    df, *_ = rnd
    a = metrics.gini(df, "s", "y", digits=None, n_buckets=1).first()["gini"]
    b = metrics.gini(df.repartition(7), "s", "y", digits=None, n_buckets=16).first()["gini"]
    assert a == pytest.approx(b, abs=1e-9)


def test_roc_points_match_thinning_rule(spark):
    df = spark.createDataFrame([(3.0, 1), (3.0, 0), (2.0, 1), (1.0, 1), (0.0, 0), (-1.0, 0)], "x double, y int")
    pts = metrics.roc_points(df, ["x"], "y").orderBy("idx").collect()
    # 2 and 1 each add one positive, 0 and -1 each add one negative: the points at 2 and 0 are collinear
    assert [r["value"] for r in pts] == [None, 3.0, 1.0, -1.0]
    assert pts[-1]["tpr"] == 1.0 and pts[-1]["fpr"] == 1.0


def test_bootstrap_band_covers_point_and_repeats(rnd):
    df, *_ = rnd
    point = metrics.gini(df, "s", "y").first()["gini"]
    _, band = metrics.bootstrap_gini(df, "s", "y", n_bs=200, seed=3)
    _, band2 = metrics.bootstrap_gini(df, "s", "y", n_bs=200, seed=3)
    b, b2 = band.first(), band2.first()
    assert b["gini_low"] < point < b["gini_upp"]
    assert (b["gini_low"], b["gini_upp"]) == (b2["gini_low"], b2["gini_upp"])


def test_bucketed_auc_matches_brute_force(rnd):
    df, s, y, g = rnd
    got = metrics.gini(df.repartition(5), "s", "y", by=["g"], digits=None, n_buckets=8).collect()
    for r in got:
        k = r["g"]
        assert r["gini"] == pytest.approx((2 * brute_auc(s[g == k], y[g == k]) - 1) * 100, abs=1e-9)


@pytest.mark.parametrize("q", [0.5, 0.1, 0.97])
def test_exact_quantiles_equal_percentile(fixture_df, q):
    from giniflow.operators.quantiles import exact_quantiles
    cols = ["quantity", "price", "acct_bal", "tax_sparse"]
    got = exact_quantiles(fixture_df, cols, q, accuracy=200)
    ref = fixture_df.agg(*[F.percentile(c, q).alias(c) for c in cols]).first()
    for c in cols:
        assert got[c] == pytest.approx(ref[c], rel=1e-12, abs=1e-12)


def test_poisson_bootstrap_path(rnd):
    df, *_ = rnd
    point = metrics.gini(df, "s", "y").first()["gini"]
    reps, band = metrics.bootstrap_gini(df, "s", "y", n_bs=100, seed=5, n_buckets=7)
    b = band.first()
    assert reps.count() == 100
    assert b["gini_low"] < point < b["gini_upp"]
    reps2, _ = metrics.bootstrap_gini(df.repartition(3), "s", "y", n_bs=100, seed=5, n_buckets=7)
    a = sorted(r["gini"] for r in reps.collect())
    c = sorted(r["gini"] for r in reps2.collect())
    assert a == pytest.approx(c, abs=1e-9)


def test_bucket_count_does_not_change_the_roc(spark, fixture_df):
    feats = ["quantity", "price", "acct_bal"]
    cols = ["feature", "idx", "value", "tps", "fps", "tpr", "fpr", "mass"]
    a = {(r["feature"], r["idx"]): r for r in metrics.roc_points(
        fixture_df, feats, "trg_flag", n_buckets=1).select(*cols).collect()}
    b = {(r["feature"], r["idx"]): r for r in metrics.roc_points(
        fixture_df, feats, "trg_flag", n_buckets=16).select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        ra, rb = a[k], b[k]
        assert (ra["tps"], ra["fps"]) == (rb["tps"], rb["fps"])
        assert (ra["value"] is None and rb["value"] is None) or ra["value"] == rb["value"] or \
            (ra["value"] != ra["value"] and rb["value"] is None)
        assert ra["mass"] == pytest.approx(rb["mass"], abs=1e-15)


def test_one_class_group_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 1, "a"), (2.0, 0, "a"), (3.0, 1, "b"), (4.0, 1, "b")], "s double, y int, g string")
    for n_buckets in (1, 4):
        got = {r["g"]: r["gini"] for r in metrics.gini(df, "s", "y", by=["g"], n_buckets=n_buckets).collect()}
        assert got["a"] == -100.0
        assert got["b"] is None


def test_null_group_has_a_gini(spark):
    df = spark.createDataFrame([(1.0, 0, None), (2.0, 1, None), (1.0, 1, "b"), (4.0, 0, "b")], "s double, y int, g string")
    for n_buckets in (1, 4):
        assert {r["g"]: r["gini"] for r in metrics.gini(df, "s", "y", by=["g"], n_buckets=n_buckets).collect()} == {
            None: 100.0, "b": -100.0}


def test_one_gini_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("cast(id % 17 as double) AS s", "cast(id % 3 = 0 as int) AS y").mapInArrow(
        count, "s double, y int")
    metrics.gini(df, "s", "y").collect()
    assert seen.value == 1000


def test_side_tables_of_any_size(spark, rnd, monkeypatch):
    from giniflow.operators import prefix
    df, s, y, g = rnd
    small = prefix.small_table
    monkeypatch.setattr(prefix, "small_table", lambda d: small(d, 1))
    got = metrics.gini(df, "s", "y", by=["g"], digits=None, n_buckets=8).collect()
    for r in got:
        k = r["g"]
        assert r["gini"] == pytest.approx((2 * brute_auc(s[g == k], y[g == k]) - 1) * 100, abs=1e-9)


def test_quantile_bracket_is_narrowed(fixture_df):
    from giniflow.operators.quantiles import exact_quantiles
    cols = ["quantity", "price", "acct_bal"]
    ref = fixture_df.agg(*[F.percentile(c, 0.5).alias(c) for c in cols]).first()
    got = exact_quantiles(fixture_df, cols, 0.5, accuracy=20, max_cells=10)
    for c in cols:
        assert got[c] == pytest.approx(ref[c], rel=1e-12)


def test_array_gini_equals_gini_by_rows(spark):
    # ties, missing scores and labels, a group of one class; several chunks a task and several ranges a group
    rows = [(g, None if i % 29 == 0 else float("nan") if i % 31 == 0 else ((i * 37 + g * 11) % 50) / 7.0,
             None if i % 17 == 0 else (0 if g == 3 else int((i * 7919 + g) % 5 == 0))) for g in range(4) for i in range(400)]
    d = spark.createDataFrame(rows, "variant int, score double, y int").repartition(3)
    want = {r["variant"]: r["gini"] for r in metrics.gini(d, "score", "y", by=["variant"], digits=None).collect()}
    for bounds in ([], [1.0, 3.0, 3.0, 5.5]):
        got = {r["variant"]: r["gini"] for r in metrics.array_gini(d, "score", "y", "variant", bounds, chunk_rows=100).collect()}
        assert got[3] is None and want[3] is None
        assert all(abs(got[g] - want[g]) < 1e-9 for g in range(3))
