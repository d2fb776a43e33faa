"""Report tables: period report, ranking of importances / pipelines, Gini, selection and result reports, deployable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_report(df: DataFrame, date_col: str = "report_dt", target: str = "trg_flag") -> DataFrame:
    """By date: volume = count(target), n_response = sum(target), trg_rate = mean(target); plus a TOTAL row whose
    volume is the row count. One ``rollup`` = GROUPING SETS ((date), ()), partially aggregated map-side."""
    y = F.col(target).cast("long")
    agg = df.rollup(date_col).agg(
        F.count(y).alias("__cnt"), F.count(F.lit(1)).alias("__rows"), F.sum(y).alias("__sum"),
        F.avg(y.cast("double")).alias("__avg"), F.grouping(date_col).alias("__g"))
    return agg.select(
        F.when(F.col("__g") == 1, F.lit("TOTAL")).otherwise(F.col(date_col).cast("string")).alias("period"),
        F.when(F.col("__g") == 1, F.col("__rows")).otherwise(F.col("__cnt")).cast("long").alias("volume"),
        F.col("__sum").cast("long").alias("n_response"),
        F.round(F.col("__avg"), 6).alias("trg_rate"))


def rank_importance(importance: DataFrame, value: str = "importance", feature: str = "feature") -> DataFrame:
    """Sort by importance descending (name breaks ties) and number from 1. Input is one row per feature."""
    w = Window.orderBy(F.col(value).desc(), F.col(feature))
    return importance.select(feature, value, F.row_number().over(w).alias("rank"))


def top_features(importance: DataFrame, n: int, value: str = "importance", feature: str = "feature") -> DataFrame:
    """First n by importance (TakeOrderedAndProject: a bounded top-k, no full sort)."""
    return importance.orderBy(F.col(value).desc(), F.col(feature)).limit(n)


def rank_pipelines(report: DataFrame) -> DataFrame:
    """Order grid cells by the lower band when bands exist, else by Gini."""
    w = Window.orderBy(F.coalesce(F.col("gini_low"), F.col("gini")).desc(), F.col("label"))
    return report.withColumn("rank", F.row_number().over(w))


def worst(df: DataFrame, value: str, key: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Top-1 row by ``value`` (ties: smallest key), excluding some keys: a bounded top-k (TakeOrderedAndProject)."""
    d = df.where(~F.col(key).isin(list(exclude))) if exclude else df
    return d.orderBy(F.col(value).desc(), F.col(key)).limit(1).select(key, value)


def deployable(results: DataFrame, stability_col: str = "stability") -> DataFrame:
    """Models that may be deployed: stability verdict is not FAILED (a missing verdict is kept)."""
    return results.where(~F.col(stability_col).eqNullSafe("FAILED"))


def gini_report(metrics: DataFrame, row: str = "pool", column: str = "model", value: str = "gini",
                columns: Sequence[str] | None = None, extended: bool = True) -> DataFrame:
    """Pools x models table of Gini values with two digits (pivot with an explicit value list, so no extra distinct job).
    The non-extended report (before the final fit) shows only TRAIN and VALID."""
    if not extended:
        metrics = metrics.where(F.col(row).isin("TRAIN", "VALID"))
    g = metrics.groupBy(row)
    piv = g.pivot(column, list(columns)) if columns is not None else g.pivot(column)
    return piv.agg(F.round(F.first(value), 2))


def result_report(ginis: DataFrame, stability: DataFrame, uplift: DataFrame, base: DataFrame | None = None,
                  selections: DataFrame | None = None) -> DataFrame:
    """One row per model: number of features, Gini per pool, number of its selection run, stability verdict and uplift
    verdicts; before them a row of the base model (all preselected features), with TRAIN and VALID only.

    ``ginis``, ``base``: (model, step, pool, gini), reported with two digits; ``stability``: (model, stability); ``uplift``:
    (model, pool, verdict), the verdicts of each model's own steps; ``selections``: (model, sel). What is missing is NULL."""
    pools = ("TRAIN", "VALID", "TEST", "OOT")

    def wide(g: DataFrame) -> DataFrame:
        return g.groupBy("model").agg(
            F.max("step").cast("int").alias("nfeats"),
            *[F.round(F.max(F.when(F.col("pool") == p, F.col("gini"))), 2).alias(p.lower()) for p in pools])

    own = uplift.groupBy("model").agg(*[F.max(F.when(F.col("pool") == p, F.col("verdict"))).alias(f"uplift_{p.lower()}")
                                        for p in pools if p != "VALID"])
    rows = wide(ginis).join(stability.select("model", "stability"), "model", "left").join(own, "model", "left")
    rows = rows.join(selections, "model", "left") if selections is not None else rows.withColumn("sel", F.lit(None).cast("int"))
    columns = ["model", "nfeats", "train", "valid", "test", "oot", "sel", "stability", "uplift_train", "uplift_test", "uplift_oot"]
    out = rows.select(*columns)
    if base is not None:
        first = wide(base.where(F.col("pool").isin("TRAIN", "VALID")))
        out = first.unionByName(out, allowMissingColumns=True).select(*columns)
    return out


def selection_report(runs: DataFrame) -> DataFrame:
    """One row per selection run with its parameters; ``start_from`` is shown only in fast mode."""
    return runs.select(
        F.col("run_id").alias("selections"), "bins", "size", "fast",
        F.when(F.col("fast"), F.col("start_from")).alias("start_from"), "vif_cutoff", "n_splits", "perm_iter",
        "n_dropped").orderBy("selections")
