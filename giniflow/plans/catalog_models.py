"""Registered queries for modelling, selection, tuning, reports, packages and streaming (M1-M13, M17-M21,
S2-S12, X12). Fitted-model results have no SQL twin (rows-only check); the report layers that only reshape metric
tables (M17, M19, M20) and the candidate draws (X12) are checked against DuckDB on the scorecard of catalog_gates."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import functions as F

from giniflow.operators import collinear, gates, importance, models, reports, sampling
from giniflow.operators.tuning import candidates, gbt_space
from giniflow.plans import fine_tuning, stages
from giniflow.plans.catalog import DATE, KEY, SEED, Y, pools, register, sample
from giniflow.plans.catalog_gates import CARD, SCORECARD_CTE, _scorecard_steps
from giniflow.plans.oracle import with_fixture
from giniflow.session import ensure_checkpoint_dir, materialize
from giniflow.sources import io
from giniflow.sources.fixture import FIXTURE_SPEC

MODEL_FEATURES = FIXTURE_SPEC.features
SPEC = FIXTURE_SPEC.with_features(MODEL_FEATURES)


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/giniflow-{name}-{uuid.uuid4().hex[:8]}"


@register("model_pool_gini", None)
def q_model_pool_gini(spark, sf_dir):
    """M1 + M2 + A6: GBT on TRAIN, early stop on VALID, Gini of every pool."""
    p = pools(spark, sf_dir, "NONE", 0.25, [Y, *SPEC.features])
    fitted = stages.fit_on_pools(p, SPEC, SPEC.features, "GBT", None, SEED)
    return stages.pool_gini(fitted, p, SPEC, SPEC.features).withColumn("n_trees", F.lit(fitted.n_iter))


@register("feature_importance", None)
def q_feature_importance(spark, sf_dir):
    """M3 + O1: ranked importance of the fitted learner."""
    p = pools(spark, sf_dir, "NONE", 0.25, [Y, *SPEC.features])
    fitted = stages.fit_on_pools(p, SPEC, SPEC.features, "GBT", None, SEED)
    return reports.rank_importance(models.importance(fitted, spark))


@register("cross_validation", None)
def q_cross_validation(spark, sf_dir):
    """M5 + A8 + A9: stratified 5-fold CV of the boosted learner on DEV rows; pooled and median Ginis."""
    dev = pools(spark, sf_dir, "NONE", 0.25, [Y, *SPEC.features]).where(F.col("pool") != "OOT")
    oof, fm = models.cross_validate(dev, list(SPEC.numeric), list(SPEC.categorical), Y, KEY, "GBT", seed=SEED)
    s = models.cv_summary(oof, fm, Y)
    return spark.createDataFrame([(s["gini"], s["median_gini_train"], s["median_gini_test"])],
                                 "gini double, median_gini_train double, median_gini_test double")


@register("preselection", None)
def q_preselection(spark, sf_dir):
    """M4: all features -> importance -> top 4 -> refit; Gini per pool before and after."""
    _, rep = stages.preselect(pools(spark, sf_dir, "NONE", 0.25, [Y, *SPEC.features]), SPEC, 4, "GBT", None, SEED)
    return rep


@register("grid_search_report", None)
def q_grid_search_report(spark, sf_dir):
    """M6 + J6 + O3: all learners x {original, undersampled to 25 %, 5 % (infeasible)} by 5-fold CV."""
    d = sample(spark, sf_dir)
    share = d.agg(F.avg(F.col(Y).cast("double"))).first()[0]
    cells = stages.grid_cells(spark, models.MODELS, [("ORIG", 0), ("US", 5), ("US", 25)], share)
    return stages.search_grid(d, SPEC, cells, seed=SEED)


@register("permutation_importance", None)
def q_permutation_importance(spark, sf_dir):
    """M10 + J7: logistic pipeline fitted on TRAIN; 10 affine shuffles per feature on VALID."""
    p = pools(spark, sf_dir, "NONE", 0.25, [Y, *SPEC.features])
    num, cat = list(SPEC.numeric), list(SPEC.categorical)
    fitted = models.fit(p.where(F.col("pool") == "TRAIN"), num, cat, Y, "LR", None, SEED)
    valid = p.where(F.col("pool") == "VALID")
    return importance.permutation_importance(valid, SPEC.features, Y, KEY,
                                             models.Scorer(fitted, num, cat), seed=SEED)


@register("fine_selection", None)
def q_fine_selection(spark, sf_dir):
    """M13 + M11 + M12: WoE binning, VIF removal on WoE columns, 10-fold permutation importance (10 repeats) of the kept set."""
    return stages.fine_select(sample(spark, sf_dir), SPEC, seed=SEED)["importance"]


def _u_sql(name: str) -> str:
    return f"(('0x'||substr(md5(CAST(id AS VARCHAR)||':{name}-{SEED}'),1,8))::BIGINT / CAST(4294967296 AS DOUBLE))"


@register("tuning_candidates", with_fixture(f"""
SELECT CAST(id AS BIGINT) AS candidate,
       round(lo / 100 + {_u_sql('frac')} * (hi - lo) / 100, 9) AS frac,
       round(round(2 + {_u_sql('depth')} * 11, 0), 9) AS depth,
       round(exp(-5 + {_u_sql('learning_rate')} * 5), 9) AS learning_rate
FROM range(10) t(id),
     (SELECT greatest(1, round(avg({Y}) * 100) - 4) AS lo, least(50, round(avg({Y}) * 100) + 4) AS hi
      FROM scoring_sample)"""))
def q_tuning_candidates(spark, sf_dir):
    """Seeded draws of the search space; the share range is centred on the sample's minority share."""
    share = round(sample(spark, sf_dir).agg(F.avg(F.col(Y).cast("double"))).first()[0] * 100)
    space = [p for p in gbt_space(float(share)) if p.name in ("frac", "depth", "learning_rate")]
    c = candidates(spark, 10, space, SEED)
    return c.select("candidate", *[F.round(p.name, 9).alias(p.name) for p in space])


@register("fine_tuning", None)
def q_fine_tuning(spark, sf_dir):
    """Fits on all and on the best features (ranked by importance), uplift, search of parameters and resampling share,
    final fit with its package, importance on OOT, gates; the result report (base row and final model)."""
    p = pools(spark, sf_dir, "NONE", 0.25, [Y, *SPEC.features])
    first = stages.fit_on_pools(p, SPEC, SPEC.features, "GBT", None, SEED)
    ranked = [r["feature"] for r in reports.rank_importance(models.importance(first, spark)).orderBy("rank").collect()]
    settings = fine_tuning.TuningSettings(n_evals=2, k=3, params={"n_iter": 30}, sampler="UNDER", seed=SEED)
    return fine_tuning.fine_tuning(p, SPEC, ranked, settings, _scratch(spark, "model"), selection=1)["result"]


# ---------------------------------------------------------------------------------------------------------------------
# Reports over metric tables (M17, M19, M20) on the scorecard steps

@register("gini_report", with_fixture("""
SELECT pool, round(max(CASE WHEN step = 1 THEN gini END), 2) AS STEP_1, round(max(CASE WHEN step = 2 THEN gini END), 2) AS STEP_2,
       round(max(CASE WHEN step = 3 THEN gini END), 2) AS STEP_3, round(max(CASE WHEN step = 4 THEN gini END), 2) AS STEP_4
FROM _gini GROUP BY pool""", SCORECARD_CTE))
def q_gini_report(spark, sf_dir):
    g = _scorecard_steps(spark, sf_dir).select("pool", F.concat(F.lit("STEP_"), F.col("step").cast("string")).alias(
        "model"), "gini")
    return reports.gini_report(g, columns=["STEP_1", "STEP_2", "STEP_3", "STEP_4"])


RESULT_SQL = """
SELECT 'BASE' AS model, CAST(max(step) AS INTEGER) AS nfeats,
       round(max(CASE WHEN pool = 'TRAIN' THEN gini END), 2) AS train, round(max(CASE WHEN pool = 'VALID' THEN gini END), 2) AS valid,
       CAST(NULL AS DOUBLE) AS test, CAST(NULL AS DOUBLE) AS oot, CAST(NULL AS INTEGER) AS sel, NULL AS stability,
       NULL AS uplift_train, NULL AS uplift_test, NULL AS uplift_oot
FROM _gini WHERE step = (SELECT max(step) FROM _gini)
UNION ALL
SELECT s.model, CAST(s.nfeats AS INTEGER) AS nfeats, s.train, s.valid, s.test, s.oot, CAST(s.nfeats AS INTEGER) AS sel, st.stability,
       u.uplift_train, u.uplift_test, u.uplift_oot
FROM (SELECT 'STEP_' || CAST(step AS VARCHAR) AS model, step AS nfeats,
             round(max(CASE WHEN pool = 'TRAIN' THEN gini END), 2) AS train,
             round(max(CASE WHEN pool = 'VALID' THEN gini END), 2) AS valid,
             round(max(CASE WHEN pool = 'TEST' THEN gini END), 2) AS test,
             round(max(CASE WHEN pool = 'OOT' THEN gini END), 2) AS oot
      FROM _gini GROUP BY step) s
JOIN (SELECT model, CASE WHEN 'FAILED' IN (a, b, c) THEN 'FAILED' WHEN 'YELLOW' IN (a, b, c) THEN 'YELLOW'
                         ELSE 'GREEN' END AS stability FROM (
        SELECT 'STEP_' || CAST(step AS VARCHAR) AS model,
          CASE WHEN tr - te > 15 AND (tr - te) / tr > 0.25 THEN 'FAILED' WHEN tr - te > 10 AND (tr - te) / tr > 0.15
               THEN 'YELLOW' ELSE 'GREEN' END AS a,
          CASE WHEN tr - oo > 15 AND (tr - oo) / oo > 0.30 THEN 'FAILED' WHEN tr - oo > 10 AND (tr - oo) / oo > 0.20
               THEN 'YELLOW' ELSE 'GREEN' END AS b,
          CASE WHEN abs(oo - te) > 10 AND abs((oo - te) / oo) > 0.20 THEN 'FAILED'
               WHEN abs(oo - te) > 5 AND abs((oo - te) / oo) > 0.15 THEN 'YELLOW' ELSE 'GREEN' END AS c
        FROM (SELECT step, round(max(CASE WHEN pool = 'TRAIN' THEN gini END), 2) AS tr,
                     round(max(CASE WHEN pool = 'TEST' THEN gini END), 2) AS te,
                     round(max(CASE WHEN pool = 'OOT' THEN gini END), 2) AS oo FROM _gini GROUP BY step))) st
  ON st.model = s.model
LEFT JOIN (SELECT model, max(CASE WHEN pool = 'TRAIN' THEN verdict END) AS uplift_train,
                  max(CASE WHEN pool = 'TEST' THEN verdict END) AS uplift_test,
                  max(CASE WHEN pool = 'OOT' THEN verdict END) AS uplift_oot FROM (
  SELECT model, pool, CASE WHEN max(CASE WHEN flag = 'FAILED' THEN 1 ELSE 0 END) = 1 THEN 'FAILED'
                    WHEN max(CASE WHEN flag = 'YELLOW' THEN 1 ELSE 0 END) = 1 THEN 'YELLOW' ELSE 'GREEN' END AS verdict
  FROM (SELECT g.*, CASE WHEN gini >= 1.05 * last THEN 'FAILED'
                         WHEN gini >= 0.99 * last AND step <= floor(0.6 * k) THEN 'YELLOW' END AS flag
        FROM (SELECT *, last_value(gini) OVER (PARTITION BY k, pool ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND UNBOUNDED FOLLOWING) AS last
              FROM (SELECT 'STEP_' || CAST(k AS VARCHAR) AS model, k, _gini.* FROM _gini
                    JOIN (SELECT DISTINCT step AS k FROM _gini) ON step <= k)) g)
  GROUP BY model, pool) GROUP BY model) u ON u.model = s.model"""


def _result_report(spark, sf_dir):
    g = materialize(_scorecard_steps(spark, sf_dir).withColumn("step", F.col("step").cast("int")), "steps")
    model = lambda k: F.concat(F.lit("STEP_"), F.col(k).cast("string")).alias("model")
    long = g.select(model("step"), "step", "pool", "gini")
    stab = gates.stability_gate(long.select("model", "pool", F.round("gini", 2).alias("gini"))).select("model", "stability")
    # the model of step k is judged by its own steps 1..k
    own = g.withColumn("k", F.explode(F.sequence("step", F.lit(len(CARD))))).select(model("k"), "step", "feature", "pool", "gini")
    _, verdict = gates.uplift_gate(own, by=["model", "pool"])
    base = long.where(F.col("step") == len(CARD)).withColumn("model", F.lit("BASE"))
    selections = long.select("model", F.col("step").alias("sel")).distinct()
    return reports.result_report(long, stab, verdict, base, selections)


@register("result_report", with_fixture(RESULT_SQL, SCORECARD_CTE))
def q_result_report(spark, sf_dir):
    return _result_report(spark, sf_dir)


@register("deployable", with_fixture(f"SELECT * FROM ({RESULT_SQL}) WHERE stability IS DISTINCT FROM 'FAILED'",
                                     SCORECARD_CTE))
def q_deployable(spark, sf_dir):
    return reports.deployable(_result_report(spark, sf_dir))


@register("selection_report", None)
def q_selection_report(spark, sf_dir):
    """M18 + S12 + S7: two VIF selection runs on the data write their params and results as run folders; the
    report reads every run's JSON back (one row per run; start_from only in fast mode)."""
    base = _scratch(spark, "selections")
    cols = ["quantity", "quantity_x", "discount", "tax", "price", "acct_bal", "part_size"]
    d = materialize(sample(spark, sf_dir).select(*cols), "selection")     # two runs of two passes read it
    for run, (cutoff, fast) in enumerate([(1.7, False), (5.0, True)], start=1):
        dropped, _ = collinear.vif_select(d, cols, cutoff)
        params = {"bins": 20, "size": 0.05, "fast": fast, "start_from": 100, "vif_cutoff": cutoff,
                  "n_splits": 10, "perm_iter": 10, "n_dropped": len(dropped)}
        folder = f"{base}/selection_{run}"
        spark.createDataFrame([(json.dumps(params),)], "v string").coalesce(1).write.mode("overwrite").text(folder)
    runs = io.read_run_params(spark, base, "selection_*/part-*")
    return reports.selection_report(runs)


@register("package_scoring", None)
def q_package_scoring(spark, sf_dir):
    """Snapshot pools, fit, save the scoring package, publish it, load and score TEST and OOT."""
    from giniflow.operators.encode import category_long
    base = _scratch(spark, "package")
    p = io.snapshot_pools(pools(spark, sf_dir), f"{base}/pools")
    num, cat = list(SPEC.numeric), list(SPEC.categorical)
    fitted = models.fit(p.where(F.col("pool") == "TRAIN"), num, cat, Y, "LR", None, SEED)
    values = category_long(p.where(F.col("pool") == "TRAIN"), cat).distinct()
    io.save_model_package(spark, fitted.model, f"{base}/run_1", SPEC.features, cat, values, config={"seed": SEED})
    ok = io.publish_package(spark, f"{base}/run_1", f"{base}/deployed")
    missing = io.publish_package(spark, f"{base}/run_404", f"{base}/deployed_404")
    scored = io.score_batch(spark, p.where(F.col("pool").isin("TEST", "OOT")), f"{base}/deployed")
    from giniflow.operators.metrics import gini
    n_values = spark.read.parquet(f"{base}/deployed/categories").count()
    return gini(scored, "score", Y, by=["pool"]).withColumn("published", F.lit(ok)).withColumn(
        "missing_published", F.lit(missing)).withColumn("n_category_values", F.lit(n_values))


@register("stream_woe", None)
def q_stream_woe(spark, sf_dir):
    """Streaming: WoE bins fitted on TRAIN, applied to TEST rows arriving as parquet files through readStream."""
    from giniflow.operators import binning
    from giniflow.plans.catalog_binning import FIXED, MIN_SIZE
    from giniflow.spec import BinnerConfig
    from giniflow.streaming.scoring import read_stream, woe_stream, write_stream
    base = _scratch(spark, "stream")
    p = pools(spark, sf_dir, columns=[Y, *FIXED]).select(KEY, "pool", Y, *FIXED)
    model = binning.fit_binning(p.where(F.col("pool") == "TRAIN"), list(FIXED), [], Y, BinnerConfig(min_size=MIN_SIZE),
                                fixed_thresholds=FIXED)
    src = p.where(F.col("pool") == "TEST").select(KEY, Y, *FIXED)
    src.repartition(4).write.mode("overwrite").parquet(f"{base}/in")
    q = write_stream(woe_stream(read_stream(spark, f"{base}/in", src.schema, 2), model, [KEY, Y]), f"{base}/out",
                     f"woe-{uuid.uuid4().hex[:6]}")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("backtest_refit", None)
def q_backtest_refit(spark, sf_dir):
    """M7 with a refit per date: the logistic pipeline is fitted on all earlier report dates and scored on them (DEV)
    and on the date itself (OOT); plus the stability score of the resulting table."""
    d = sample(spark, sf_dir)
    bt = stages.backtest_refit(d, SPEC, ["quantity", "discount", "client_segm"], "LR", None, SEED)
    score = gates.stability_score(bt, 25.0, 1.5, 5.0).first()["stability_score"]
    return bt.withColumn("stability_score", F.lit(score))
