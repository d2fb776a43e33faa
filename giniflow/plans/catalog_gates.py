"""Registered queries for gates, backtests, fold scores, VIF and bootstrap (W8-W10, X9, A8, A10, A13, A14, A16, M7, M8,
M12, M14-M16).

The uplift and stability tests run on a WoE-sum scorecard: WoE bins with fixed cut points are fitted on the TRAIN pool
and applied to every pool, and step k scores a row with minus the sum of the WoE of the k features of highest IV. This
keeps every step an exact function of the data, so DuckDB can check the steps, the Ginis and the verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from giniflow.operators import binning, collinear, gates, metrics, sampling
from giniflow.plans.catalog import DATE, KEY, POOLS_CTE, SEED, Y, pools, register, sample
from giniflow.plans.catalog_binning import FIXED, MIN_SIZE, _bin_case
from giniflow.plans.oracle import gini_sql, with_fixture
from giniflow.spec import BinnerConfig

CARD = list(FIXED)     # quantity, discount, acct_bal, part_size


def _scorecard(p):
    """The pool rows with the WoE of every feature, these columns, and the array of (step, feature, score)."""
    train = p.where(F.col("pool") == "TRAIN")
    model = binning.fit_binning(train, CARD, [], Y, BinnerConfig(min_size=MIN_SIZE), fixed_thresholds=FIXED)
    ranked = sorted(CARD, key=lambda f: -model.numeric[f].iv)
    enc = model.transform(p, keep=[KEY, "pool", Y], drop_incomplete=False)
    steps = []
    for k in range(1, len(ranked) + 1):
        s = F.round(-sum((F.col(f"woe_{f}") for f in ranked[:k]), F.lit(0.0)), 9)
        steps.append(F.struct(F.lit(k).alias("step"), F.lit(ranked[k - 1]).alias("feature"), s.alias("score")))
    return enc, [f"woe_{f}" for f in ranked], F.explode(F.array(*steps)).alias("s")


def _scorecard_rows(spark, sf_dir, p=None):
    """(epk_id, pool, trg_flag, step, feature, score) of the WoE-sum scorecard."""
    if p is None:
        p = pools(spark, sf_dir, columns=[Y, *CARD])
    enc, _, steps = _scorecard(p)
    return enc.select(KEY, "pool", Y, steps).select(KEY, "pool", Y, "s.*")


def _scorecard_steps(spark, sf_dir):
    """(pool, step, feature, gini). A row's scores follow from its WoE values, so rows are counted by these first, and the
    steps are made of the counts."""
    enc, woe, steps = _scorecard(pools(spark, sf_dir, columns=[Y, *CARD]))
    y = F.col(Y).cast("long")
    cells = enc.where(F.col(Y).isNotNull()).groupBy("pool", *woe).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))
    by = ["pool", "step", "feature"]
    hist = cells.select("pool", "pos", "neg", steps).select("pool", "pos", "neg", "s.*").where(
        F.col("score").isNotNull() & ~F.isnan("score")).groupBy(*by, "score").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    auc = metrics.auc_from_histogram(hist, "score", by)
    return auc.select(*by, ((F.lit(2.0) * F.col("auc") - F.lit(1.0)) * F.lit(100.0)).alias("gini"))


SCORECARD_CTE = POOLS_CTE + ",\n_binned AS (\n" + "\nUNION ALL\n".join(
    f"SELECT epk_id, pool, {Y}, '{f}' AS feature, {_bin_case(f, ts)} AS bin FROM pools" for f, ts in FIXED.items()
) + f"""),
_stats AS (SELECT feature, bin, count(*) AS n, sum({Y}) AS n_pos, avg(CAST({Y} AS DOUBLE)) AS target_rate
           FROM _binned WHERE pool = 'TRAIN' GROUP BY feature, bin),
_gb AS (SELECT CAST(sum(1 - {Y}) AS DOUBLE) AS G, CAST(sum({Y}) AS DOUBLE) AS B FROM pools WHERE pool = 'TRAIN'),
_mp AS (
  SELECT t.feature, CASE WHEN m.n IS NULL THEN 0 WHEN m.n > {MIN_SIZE} * t.nt THEN 0 ELSE
           (SELECT s.bin FROM _stats s WHERE s.feature = t.feature AND s.bin > 0
            ORDER BY abs(s.target_rate - m.target_rate), s.bin LIMIT 1) END AS nan_bin
  FROM (SELECT feature, sum(n) AS nt FROM _stats GROUP BY feature) t
  LEFT JOIN (SELECT * FROM _stats WHERE bin = 0) m ON m.feature = t.feature),
_b2 AS (SELECT b.epk_id, b.pool, b.{Y}, b.feature, CASE WHEN b.bin = 0 THEN mp.nan_bin ELSE b.bin END AS bin
        FROM _binned b JOIN _mp mp ON mp.feature = b.feature),
_s2 AS (SELECT feature, bin, count(*) AS n, sum({Y}) AS n_pos FROM _b2 WHERE pool = 'TRAIN' GROUP BY feature, bin),
_w2 AS (SELECT feature, bin, gd / G AS gr, bd / B AS br, ln((gd / G) / (bd / B)) AS woe FROM (
          SELECT feature, bin, CASE WHEN n - n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n - n_pos AS DOUBLE) END AS gd,
                 CASE WHEN n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n_pos AS DOUBLE) END AS bd
          FROM _s2), _gb),
_rank AS (SELECT feature, row_number() OVER (ORDER BY sum(woe * (gr - br)) DESC) AS rk FROM _w2 GROUP BY feature),
_rows AS (SELECT b.epk_id, b.pool, b.{Y}, r.rk, w.woe FROM _b2 b JOIN _w2 w ON w.feature = b.feature AND w.bin = b.bin
          JOIN _rank r ON r.feature = b.feature),
_steps AS (SELECT r.epk_id, r.pool, r.{Y}, s.rk AS step, f.feature, round(-sum(r.woe), 9) AS score
           FROM _rows r JOIN (SELECT DISTINCT rk FROM _rank) s ON r.rk <= s.rk JOIN _rank f ON f.rk = s.rk
           GROUP BY r.epk_id, r.pool, r.{Y}, s.rk, f.feature),
_gini AS ({gini_sql("_steps", "score", Y, ["pool", "step", "feature"], digits=None)})"""


@register("uplift_steps", with_fixture("SELECT pool, CAST(step AS INTEGER) AS step, feature, round(gini, 6) AS gini FROM _gini",
                                       SCORECARD_CTE))
def q_uplift_steps(spark, sf_dir):
    g = _scorecard_steps(spark, sf_dir)
    return g.select("pool", F.col("step").cast("int").alias("step"), "feature", F.round("gini", 6).alias("gini"))


@register("uplift_gate", with_fixture(f"""
SELECT pool, CASE WHEN max(CASE WHEN flag = 'FAILED' THEN 1 ELSE 0 END) = 1 THEN 'FAILED'
                  WHEN max(CASE WHEN flag = 'YELLOW' THEN 1 ELSE 0 END) = 1 THEN 'YELLOW' ELSE 'GREEN' END AS verdict
FROM (SELECT g.*, CASE WHEN gini >= 1.05 * last THEN 'FAILED'
                       WHEN gini >= 0.99 * last AND step <= floor(0.6 * n) THEN 'YELLOW' END AS flag
      FROM (SELECT *, last_value(gini) OVER (PARTITION BY pool ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING
                                             AND UNBOUNDED FOLLOWING) AS last,
                   max(step) OVER (PARTITION BY pool) AS n FROM _gini) g)
GROUP BY pool""", SCORECARD_CTE))
def q_uplift_gate(spark, sf_dir):
    g = _scorecard_steps(spark, sf_dir)
    _, verdict = gates.uplift_gate(g.withColumn("step", F.col("step").cast("int")))
    return verdict


@register("stability_gate", with_fixture(f"""
SELECT model,
  CASE WHEN tr - te > 15 AND (tr - te) / tr > 0.25 THEN 'FAILED' WHEN tr - te > 10 AND (tr - te) / tr > 0.15 THEN 'YELLOW'
       ELSE 'GREEN' END AS train_vs_test,
  CASE WHEN tr - oo > 15 AND (tr - oo) / oo > 0.30 THEN 'FAILED' WHEN tr - oo > 10 AND (tr - oo) / oo > 0.20 THEN 'YELLOW'
       ELSE 'GREEN' END AS train_vs_oot,
  CASE WHEN abs(oo - te) > 10 AND abs((oo - te) / oo) > 0.20 THEN 'FAILED'
       WHEN abs(oo - te) > 5 AND abs((oo - te) / oo) > 0.15 THEN 'YELLOW' ELSE 'GREEN' END AS oot_vs_test
FROM (SELECT 'STEP_' || CAST(step AS VARCHAR) AS model, max(CASE WHEN pool = 'TRAIN' THEN round(gini, 2) END) AS tr,
             max(CASE WHEN pool = 'TEST' THEN round(gini, 2) END) AS te,
             max(CASE WHEN pool = 'OOT' THEN round(gini, 2) END) AS oo
      FROM _gini GROUP BY step)""", SCORECARD_CTE))
def q_stability_gate(spark, sf_dir):
    g = _scorecard_steps(spark, sf_dir).select(F.concat(F.lit("STEP_"), F.col("step").cast("string")).alias("model"),
                                               "pool", F.round("gini", 2).alias("gini"))
    return gates.stability_gate(g).select("model", "train_vs_test", "train_vs_oot", "oot_vs_test")


# ---------------------------------------------------------------------------------------------------------------------
# Expanding-date backtest of a fixed score

BACKTEST_CTE = f"""
_dates AS (SELECT DISTINCT report_dt FROM scoring_sample WHERE report_dt IS NOT NULL),
_pairs AS (SELECT o.report_dt AS oot_dt, d.report_dt AS dev_dt FROM _dates o JOIN _dates d ON d.report_dt < o.report_dt),
_bt_rows AS (SELECT p.oot_dt, 'DEV' AS role, s.{Y}, s.quantity AS score FROM scoring_sample s
             JOIN _pairs p ON s.report_dt = p.dev_dt
             UNION ALL
             SELECT s.report_dt, 'OOT', s.{Y}, s.quantity FROM scoring_sample s
             WHERE s.report_dt > (SELECT min(report_dt) FROM _dates)),
_bt AS ({gini_sql("_bt_rows", "score", Y, ["oot_dt", "role"], digits=None)}),
_bt_wide AS (SELECT oot_dt AS report_dt, max(CASE WHEN role = 'DEV' THEN gini END) AS dev,
                    max(CASE WHEN role = 'OOT' THEN gini END) AS oot FROM _bt GROUP BY oot_dt)"""


def _backtest(spark, sf_dir):
    from giniflow.operators.backtest import backtest_gini
    return backtest_gini(sample(spark, sf_dir), DATE, "quantity", Y)


@register("backtest_pairs", with_fixture("SELECT oot_dt, dev_dt FROM _pairs", BACKTEST_CTE))
def q_backtest_pairs(spark, sf_dir):
    from giniflow.operators.backtest import date_pairs
    return date_pairs(sample(spark, sf_dir), DATE)


@register("backtest_gini", with_fixture("SELECT report_dt, round(dev, 6) AS dev, round(oot, 6) AS oot FROM _bt_wide", BACKTEST_CTE))
def q_backtest_gini(spark, sf_dir):
    return _backtest(spark, sf_dir).select(DATE, F.round("dev", 6).alias("dev"), F.round("oot", 6).alias("oot"))


@register("linspace_weights", with_fixture("""
SELECT report_dt, round(w / sum(w) OVER (), 6) AS weight FROM (
  SELECT report_dt, CASE WHEN count(*) OVER () = 1 THEN 1.0 ELSE
         1 + (1.5 - 1) * (row_number() OVER (ORDER BY report_dt) - 1) / (count(*) OVER () - 1) END AS w
  FROM _bt_wide)""", BACKTEST_CTE))
def q_linspace_weights(spark, sf_dir):
    w = gates.linspace_weights(_backtest(spark, sf_dir), DATE, 1.5)
    return w.select(DATE, F.round("weight", 6).alias("weight"))


@register("stability_score", with_fixture("""
SELECT round(CASE WHEN avg(oot) < 25 THEN CAST('inf' AS DOUBLE) ELSE
             -sum(oot * weight) + 5 * abs(avg(dev) - avg(oot)) END, 6) AS stability_score,
       round(avg(dev), 6) AS mean_dev, round(avg(oot), 6) AS mean_oot
FROM (SELECT *, w / sum(w) OVER () AS weight FROM (
        SELECT *, CASE WHEN count(*) OVER () = 1 THEN 1.0 ELSE
               1 + (1.5 - 1) * (row_number() OVER (ORDER BY report_dt) - 1) / (count(*) OVER () - 1) END AS w
        FROM _bt_wide))""", BACKTEST_CTE))
def q_stability_score(spark, sf_dir):
    s = gates.stability_score(_backtest(spark, sf_dir), accept_lvl=25.0, actuality=1.5, stable_fine=5.0)
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


# ---------------------------------------------------------------------------------------------------------------------
# Fold Ginis of a fixed score (W5 + A6 + A8 + M8)

FOLD_CTE = f"""
_folded AS (SELECT epk_id, {Y}, quantity AS score, CAST((_rn * 5 + _n - 1) // _n - 1 AS INTEGER) AS fold FROM (
  SELECT *, row_number() OVER (PARTITION BY {Y} ORDER BY ('0x'||substr(md5(epk_id||':fold-{SEED}'),1,8))::BIGINT, epk_id) AS _rn,
         count(*) OVER (PARTITION BY {Y}) AS _n FROM scoring_sample)),
_ft AS (SELECT f.fold AS k, r.{Y}, r.score FROM (SELECT DISTINCT fold FROM _folded) f JOIN _folded r ON r.fold = f.fold),
_fr AS (SELECT f.fold AS k, r.{Y}, r.score FROM (SELECT DISTINCT fold FROM _folded) f JOIN _folded r ON r.fold <> f.fold),
_fm AS (SELECT t.k AS fold, r.gini AS gini_train, t.gini AS gini_test
        FROM ({gini_sql("_ft", "score", Y, ["k"], digits=None)}) t JOIN ({gini_sql("_fr", "score", Y, ["k"], digits=None)}) r
        ON r.k = t.k)"""


def _fold_metric(spark, sf_dir):
    df = sampling.stratified_folds(sample(spark, sf_dir).select(KEY, Y, "quantity"), Y, 5, KEY, SEED)
    return metrics.fold_ginis(df, "quantity", Y, "fold")


@register("fold_gini", with_fixture(
    "SELECT fold, round(gini_train, 6) AS gini_train, round(gini_test, 6) AS gini_test FROM _fm", FOLD_CTE))
def q_fold_gini(spark, sf_dir):
    m = _fold_metric(spark, sf_dir)
    return m.select(F.col("fold").cast("int").alias("fold"), F.round("gini_train", 6).alias("gini_train"),
                    F.round("gini_test", 6).alias("gini_test"))


@register("kfold_score", with_fixture("""
SELECT round(-quantile_cont(gini_test, 0.5) + 0.25 * abs(quantile_cont(gini_train, 0.5) - quantile_cont(gini_test, 0.5)), 6)
         AS kfold_score,
       round(quantile_cont(gini_train, 0.5), 6) AS median_gini_train, round(quantile_cont(gini_test, 0.5), 6) AS median_gini_test
FROM _fm""", FOLD_CTE))
def q_kfold_score(spark, sf_dir):
    s = gates.kfold_score(_fold_metric(spark, sf_dir), 0.25)
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


# ---------------------------------------------------------------------------------------------------------------------
# Collinearity (A13, A14, M12) and bootstrap (A10)

VIF_COLS = ["quantity", "quantity_x", "discount"]


@register("vif", with_fixture("""
SELECT 'quantity' AS feature, round((1 - b*b) / d, 6) AS vif FROM _r
UNION ALL SELECT 'quantity_x', round((1 - c*c) / d, 6) FROM _r
UNION ALL SELECT 'discount', round((1 - a*a) / d, 6) FROM _r""", """
_r AS (SELECT a, b, c, 1 + 2*a*b*c - a*a - b*b - c*c AS d FROM (
        SELECT corr(quantity, quantity_x) AS a, corr(quantity_x, discount) AS b, corr(quantity, discount) AS c
        FROM scoring_sample))"""))
def q_vif(spark, sf_dir):
    values, _ = collinear.vif(sample(spark, sf_dir), VIF_COLS)
    t = collinear.vif_table(spark, {k: v for k, v in values.items() if k != collinear.CONST})
    return t.select("feature", F.round("vif", 6).alias("vif"))


@register("vif_select", None)
def q_vif_select(spark, sf_dir):
    """M12 on the numeric features (complete rows): dropped features in order with their VIF, then the final table."""
    cols = ["quantity", "quantity_x", "discount", "tax", "price", "acct_bal", "part_size"]
    dropped, final = collinear.vif_select(sample(spark, sf_dir), cols, cutoff=1.7)
    rows = [(i + 1, f, float(v), "DROPPED") for i, (f, v) in enumerate(dropped)]
    rows += [(None, f, float(v), "KEPT") for f, v in final.items()]
    return spark.createDataFrame(rows, "step int, feature string, vif double, status string")


@register("bootstrap_band", None)
def q_bootstrap_band(spark, sf_dir):
    """A10: 2,000 Poisson replicates of the Gini of the quantity score over the histogram."""
    reps, band = metrics.bootstrap_gini(sample(spark, sf_dir), "quantity", Y, n_bs=2000, seed=SEED)
    point = metrics.gini(sample(spark, sf_dir), "quantity", Y).first()["gini"]
    return band.select(F.lit(point).alias("gini"), "gini_low", "gini_upp")


# ---------------------------------------------------------------------------------------------------------------------
# Ranking and prefix steps over the fitted IV table

def _iv_table(spark, sf_dir):
    p = pools(spark, sf_dir, columns=[Y, *CARD])
    train = p.where(F.col("pool") == "TRAIN")
    model = binning.fit_binning(train, CARD, [], Y, BinnerConfig(min_size=MIN_SIZE), fixed_thresholds=FIXED)
    return spark.createDataFrame([(f, float(model.numeric[f].iv)) for f in CARD], "feature string, importance double")


IV_CTE = SCORECARD_CTE + ",\n_iv AS (SELECT feature, sum(woe * (gr - br)) AS importance FROM _w2 GROUP BY feature)"


@register("top_features", with_fixture(
    "SELECT feature, round(importance, 6) AS importance FROM _iv ORDER BY importance DESC, feature LIMIT 3", IV_CTE))
def q_top_features(spark, sf_dir):
    from giniflow.operators import reports
    t = reports.top_features(_iv_table(spark, sf_dir), 3)
    return t.select("feature", F.round("importance", 6).alias("importance"))


@register("uplift_prefix", with_fixture("""
SELECT CAST(rk AS INTEGER) AS step, feature,
       string_agg(feature, ',') OVER (ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS features
FROM (SELECT feature, row_number() OVER (ORDER BY importance DESC, feature) AS rk FROM _iv)""", IV_CTE))
def q_uplift_prefix(spark, sf_dir):
    from giniflow.operators import reports
    ranked = reports.rank_importance(_iv_table(spark, sf_dir))
    pre = gates.uplift_prefix(ranked)
    return pre.select(F.col("step").cast("int").alias("step"), "feature", F.array_join("features", ",").alias("features"))


@register("relative_to_last", with_fixture("""
SELECT pool, CAST(step AS INTEGER) AS step, round(gini / last_value(gini) OVER (PARTITION BY pool ORDER BY step
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 6) AS ratio FROM _gini""", SCORECARD_CTE))
def q_relative_to_last(spark, sf_dir):
    g = _scorecard_steps(spark, sf_dir).withColumn("step", F.col("step").cast("int"))
    r = gates.relative_to_last(g)
    return r.select("pool", "step", F.round("ratio", 6).alias("ratio"))


@register("worst_vif", with_fixture("""
SELECT feature, round(vif, 6) AS vif FROM (
  SELECT 'quantity' AS feature, (1 - b*b) / d AS vif FROM _r
  UNION ALL SELECT 'quantity_x', (1 - c*c) / d FROM _r
  UNION ALL SELECT 'discount', (1 - a*a) / d FROM _r) ORDER BY vif DESC, feature LIMIT 1""", """
_r AS (SELECT a, b, c, 1 + 2*a*b*c - a*a - b*b - c*c AS d FROM (
        SELECT corr(quantity, quantity_x) AS a, corr(quantity_x, discount) AS b, corr(quantity, discount) AS c
        FROM scoring_sample))"""))
def q_worst_vif(spark, sf_dir):
    from giniflow.operators import reports
    values, _ = collinear.vif(sample(spark, sf_dir), VIF_COLS)
    t = collinear.vif_table(spark, values)
    w = reports.worst(t, "vif", "feature", exclude=[collinear.CONST])
    return w.select("feature", F.round("vif", 6).alias("vif"))


@register("pools_with_scores", with_fixture(
    "SELECT epk_id, pool, " + Y + ", score FROM _steps WHERE step = 4", SCORECARD_CTE))
def q_pools_with_scores(spark, sf_dir):
    """The full scorecard's scores joined back to the pool rows by key."""
    from giniflow.operators.joins import pools_with_scores
    p = pools(spark, sf_dir, columns=[Y, *CARD])
    rows = _scorecard_rows(spark, sf_dir, p).where(F.col("step") == 4)
    return pools_with_scores(p, rows.select(KEY, Y, "score"), KEY)
