"""Model gates: uplift steps, uplift and stability verdicts, stability score, linspace weights
(W9, W10, X9, A16, M7 formula, M14-M16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the uplift gate: FAILED at >= 1.05 x the full-set Gini, YELLOW at >= 0.99 x within the first 60 % of
# the steps.
UPLIFT_RED, UPLIFT_YELLOW, UPLIFT_EARLY = 1.05, 0.99, 0.6

# Fixed values of the stability gate: (delta, ratio) limits for FAILED and YELLOW per comparison.
STABILITY_LIMITS = {
    "train_test": {"FAILED": (15.0, 0.25), "YELLOW": (10.0, 0.15)},
    "train_oot": {"FAILED": (15.0, 0.30), "YELLOW": (10.0, 0.20)},
    "oot_test": {"FAILED": (10.0, 0.20), "YELLOW": (5.0, 0.15)},
}


def uplift_prefix(ranked: DataFrame, rank_col: str = "rank", feature_col: str = "feature") -> DataFrame:
    """Prefix feature sets of a ranked list: step k holds the first k features (W9). One row per feature."""
    w = Window.orderBy(rank_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.select(F.col(rank_col).alias("step"), F.col(feature_col).alias("feature"),
                         F.collect_list(feature_col).over(w).alias("features"))


def relative_to_last(steps: DataFrame, score: str = "gini", by: Sequence[str] = ("pool",), step: str = "step") -> DataFrame:
    """Step score / score of the full set (the last step) per pool."""
    w = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return steps.withColumn("last", F.last(score).over(w)).withColumn("ratio", F.try_divide(F.col(score), F.col("last")))


def uplift_gate(steps: DataFrame, pools: Sequence[str] | None = None, score: str = "gini",
                by: Sequence[str] = ("pool",)) -> tuple[DataFrame, DataFrame]:
    """M15. ``steps``: (by..., step, feature, gini). Per group of ``by`` (a pool, or a model's pool): last = full-set Gini; a step is FAILED when
    score >= 1.05*last, else YELLOW when score >= 0.99*last and step <= int(0.6*n_steps).
    Returns (flagged steps with round(score/last, 4), verdict per group: FAILED > YELLOW > GREEN)."""
    s = steps if pools is None else steps.where(F.col("pool").isin(list(pools)))
    r = relative_to_last(s, score, by)
    n = F.max("step").over(Window.partitionBy(*by))
    flag = (F.when(F.col(score) >= F.lit(UPLIFT_RED) * F.col("last"), F.lit("FAILED"))
            .when((F.col(score) >= F.lit(UPLIFT_YELLOW) * F.col("last"))
                  & (F.col("step") <= F.floor(F.lit(UPLIFT_EARLY) * n)), F.lit("YELLOW")))
    flagged = r.withColumn("flag", flag).withColumn("ratio", F.round("ratio", 4))
    verdict = flagged.groupBy(*by).agg(
        F.when(F.max(F.when(F.col("flag") == "FAILED", 1).otherwise(0)) == 1, "FAILED")
        .when(F.max(F.when(F.col("flag") == "YELLOW", 1).otherwise(0)) == 1, "YELLOW")
        .otherwise("GREEN").alias("verdict"))
    return flagged.where(F.col("flag").isNotNull()).select(*by, "step", "feature", "ratio", "flag"), verdict


def _ratio(delta, base):
    """``delta / base``; of the sign of ``delta`` and without bound where ``base`` is 0 (0 where both are)."""
    unbounded = F.when(delta > 0, F.lit(float("inf"))).when(delta < 0, F.lit(float("-inf"))).otherwise(F.lit(0.0))
    return F.when(base == 0, unbounded).otherwise(F.try_divide(delta, base))


def _level(delta, ratio, limits, absolute=False):
    if absolute:
        delta, ratio = F.abs(delta), F.abs(ratio)
    (fd, fr), (yd, yr) = limits["FAILED"], limits["YELLOW"]
    return (F.when((delta > F.lit(fd)) & (ratio > F.lit(fr)), F.lit("FAILED"))
            .when((delta > F.lit(yd)) & (ratio > F.lit(yr)), F.lit("YELLOW")).otherwise(F.lit("GREEN")))


def stability_gate(ginis: DataFrame, model_col: str = "model") -> DataFrame:
    """M16 per model from long (model, pool, gini) with pools TRAIN, TEST, OOT: train-test (ratio to train),
    train-oot (ratio to oot), oot-test (absolute values, ratio to oot); overall = worst."""
    wide = ginis.groupBy(model_col).pivot("pool", ["TRAIN", "VALID", "TEST", "OOT"]).agg(F.first("gini"))
    tr, te, oo = F.col("TRAIN"), F.col("TEST"), F.col("OOT")
    tt = _level(tr - te, _ratio(tr - te, tr), STABILITY_LIMITS["train_test"])
    to = _level(tr - oo, _ratio(tr - oo, oo), STABILITY_LIMITS["train_oot"])
    ot = _level(oo - te, _ratio(oo - te, oo), STABILITY_LIMITS["oot_test"], absolute=True)
    out = wide.select(model_col, tt.alias("train_vs_test"), to.alias("train_vs_oot"), ot.alias("oot_vs_test"))
    cols = [F.col("train_vs_test"), F.col("train_vs_oot"), F.col("oot_vs_test")]
    worst = (F.when(F.array_contains(F.array(*cols), "FAILED"), "FAILED")
             .when(F.array_contains(F.array(*cols), "YELLOW"), "YELLOW").otherwise("GREEN"))
    return out.withColumn("stability", worst)


def linspace_weights(df: DataFrame, order_col: str, actuality: float) -> DataFrame:
    """Weight of the i-th of n rows (by ``order_col``) = 1 + (A-1)(i-1)/(n-1), normalised to sum 1; n=1 -> 1.
    Used on backtest tables (one row per date), so the single ordered window is over a handful of rows."""
    w = Window.orderBy(order_col)
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    i = F.row_number().over(w)
    raw = F.when(n == 1, F.lit(1.0)).otherwise(
        F.lit(1.0) + F.lit(actuality - 1.0) * (i - F.lit(1)) / (n - F.lit(1)))
    d = df.withColumn("__w", raw)
    return d.withColumn("weight", F.col("__w") / F.sum("__w").over(Window.partitionBy(F.lit(1)))).drop("__w")


def stability_score(backtest: DataFrame, accept_lvl: float, actuality: float, stable_fine: float,
                    date_col: str = "report_dt") -> DataFrame:
    """``-sum(oot_i * w_i) + STABLE_FINE*|mean dev - mean oot|``; +inf when mean oot < ACCEPT_LVL."""
    w = linspace_weights(backtest, date_col, actuality)
    agg = w.agg(F.sum(F.col("oot") * F.col("weight")).alias("__wo"), F.avg("dev").alias("__md"),
                F.avg("oot").alias("__mo"))
    score = F.when(F.col("__mo") < F.lit(accept_lvl), F.lit(float("inf"))).otherwise(
        -F.col("__wo") + F.lit(stable_fine) * F.abs(F.col("__md") - F.col("__mo")))
    return agg.select(score.alias("stability_score"), F.col("__md").alias("mean_dev"), F.col("__mo").alias("mean_oot"))


def kfold_score(fold_metric: DataFrame, kfold_fine: float) -> DataFrame:
    """M8: ``-median(test) + KFOLD_FINE*|median(train) - median(test)|`` (minimised)."""
    med = fold_metric.agg(F.percentile("gini_train", 0.5).alias("mtr"), F.percentile("gini_test", 0.5).alias("mte"))
    return med.select((-F.col("mte") + F.lit(kfold_fine) * F.abs(F.col("mtr") - F.col("mte"))).alias("kfold_score"),
                      F.col("mtr").alias("median_gini_train"), F.col("mte").alias("median_gini_test"))
