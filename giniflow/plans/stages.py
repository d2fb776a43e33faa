"""End-to-end stages: preselection (M4), grid search over learner x resampling (M6), fine selection (M13), fine tuning
(M21), and the candidate grid (J6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def cell_label(model: str, sampler: str, frac: int) -> str:
    return model if sampler == "ORIG" else f"{model}_{sampler}_{frac}%"


def grid_cells(spark: SparkSession, models: Sequence[str], samplers: Sequence[tuple[str, int]],
               minority_share: float) -> DataFrame:
    """Candidate grid: every learner with the original sample and each (sampler, share %). A resampling share below
    the present minority share is infeasible (it would need to remove minority rows / add majority rows).
    The grid is a product of two short configuration lists, built on the driver (no join)."""
    rows = []
    for m in models:
        for s, frac in samplers:
            feasible = s == "ORIG" or frac / 100.0 >= minority_share
            rows.append((m, s, int(frac), cell_label(m, s, int(frac)), bool(feasible)))
    return spark.createDataFrame(rows, "model string, sampler string, frac int, label string, feasible boolean")


# ---------------------------------------------------------------------------------------------------------------------
# Stages

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from giniflow.functions.hashing import key_columns, key_text, row_hash  # noqa: E402
from giniflow.operators import binning, collinear, gates, importance, metrics, models, reports, sampling  # noqa: E402
from giniflow.session import materialize  # noqa: E402
from giniflow.spec import BinnerConfig, SampleSpec  # noqa: E402

from concurrent.futures import ThreadPoolExecutor  # noqa: E402

THREADS = 4   # independent fits (grid cells, folds, uplift steps) submitted concurrently from the driver


def run_parallel(fn, items, threads: int = THREADS):
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(items) or 1))) as pool:
        return list(pool.map(fn, items))


def pool_gini(fitted, pools_df: DataFrame, spec: SampleSpec, features: Sequence[str],
              digits: int | None = 2) -> DataFrame:
    """Gini per pool of a fitted pipeline (one transform, one grouped metric)."""
    num = [f for f in features if f in spec.numeric]
    cat = [f for f in features if f in spec.categorical]
    scored = models.score(fitted, pools_df, num, cat)
    return metrics.row_gini(scored, "score", spec.target, by=["pool"], digits=digits)


def fit_on_pools(pools_df: DataFrame, spec: SampleSpec, features: Sequence[str], name: str = "GBT",
                 params: dict | None = None, seed: int = 19, patience: int | None = None, sampler: str = "NONE",
                 frac: float = 0.25):
    """Fit on TRAIN (resampled by weights where asked), early stop on VALID."""
    num = [f for f in features if f in spec.numeric]
    cat = [f for f in features if f in spec.categorical]
    train = sampling.resample_weights(pools_df.where(F.col("pool") == "TRAIN"), spec.target, sampler, frac, spec.key, seed)
    train = train.select(spec.target, "weight", *features).persist(StorageLevel.MEMORY_AND_DISK)
    valid = pools_df.where(F.col("pool") == "VALID")
    try:
        return models.fit(train, num, cat, spec.target, name, params, seed, valid, patience,
                          "weight" if sampler.upper() == "OVER" else None)
    finally:
        train.unpersist()


def preselect(pools_df: DataFrame, spec: SampleSpec, n_top: int, name: str = "GBT", params: dict | None = None,
              seed: int = 19, importance_cache: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M4: fit on every feature, rank by importance, refit on the top n; Gini per pool before and after.
    With ``importance_cache`` (a parquet path) a stored importance table is reused and the wide fit is skipped;
    otherwise the computed table is written there. Returns (ranked importance, report pool x {gini_all, gini_top})."""
    from giniflow.sources.io import read_registry
    spark = pools_df.sparkSession
    p = narrow_copy(pools_df, spec, ["pool"])
    cached = read_registry(spark, importance_cache) if importance_cache else None
    full = None
    if cached is not None:
        imp = cached
    else:
        full = fit_on_pools(p, spec, spec.features, name, params, seed)
        imp = small_result(reports.rank_importance(models.importance(full, spark)))
        if importance_cache:
            imp.write.mode("overwrite").parquet(importance_cache)
    top = [r["feature"] for r in reports.top_features(imp, n_top).collect()]
    small = fit_on_pools(p, spec, top, name, params, seed)
    g_top = pool_gini(small, p, spec, top).withColumnRenamed("gini", f"gini_top_{n_top}")
    if full is None:
        return imp, g_top
    g_all = pool_gini(full, p, spec, spec.features).withColumnRenamed("gini", "gini_all")
    return imp, g_all.join(g_top, "pool")


def search_grid(sample_df: DataFrame, spec: SampleSpec, cells: DataFrame, k: int = 5, seed: int = 19,
                bands: bool = False, n_bs: int = 2000, params: dict | None = None, patience: int | None = None) -> DataFrame:
    """M6: cross-validate every feasible grid cell (learner x resampling) and rank by lower band, else Gini.
    Infeasible cells are reported with NULL metrics."""
    spark = sample_df.sparkSession
    d = models.fold_rows(sample_df, spec.features, spec.target, spec.key, k, seed)

    def run_cell(c):
        if not c["feasible"]:
            return (c["label"], None, None, None, "infeasible")
        sampler = {"ORIG": "NONE", "US": "UNDER", "OS": "OVER"}[c["sampler"]]
        oof, fm = models.cross_validate(d, list(spec.numeric), list(spec.categorical), spec.target, spec.key,
                                        c["model"], params, k, seed, sampler, c["frac"] / 100.0 if c["frac"] else 0.25,
                                        threads=2, patience=patience, folded=d)
        s = models.cv_summary(oof, fm, spec.target, bands, n_bs, seed)
        return (c["label"], s["gini"], s["gini_low"], s["gini_upp"], "ok")

    rows = run_parallel(run_cell, cells.collect())
    rep = spark.createDataFrame(rows, "label string, gini double, gini_low double, gini_upp double, status string")
    return reports.rank_pipelines(rep)


def narrow_copy(df: DataFrame, spec: SampleSpec, extra: Sequence[str] = ()) -> DataFrame:
    """The key, target and feature columns, stored once for the passes of a stage."""
    return materialize(df.select(*dict.fromkeys([*key_columns(spec.key), *extra, spec.target, *spec.features])), "sample")


def selection_sample(df: DataFrame, spec: SampleSpec, frac: float = 1.0, under: bool = False, seed: int = 19) -> DataFrame:
    """The rows a selection works on: a share ``frac`` of all, or (``under``) all minority rows and as many majority rows as
    make the minority's share ``frac``."""
    if under:
        return sampling.undersample(df, spec.target, frac, spec.key, seed)
    return sampling.sample_rows(df, frac, spec.key, seed) if frac < 1 else df


def fine_select(sample_df: DataFrame, spec: SampleSpec, binner: BinnerConfig = BinnerConfig(),
                vif_cutoff: float = 1.7, n_splits: int = 10, n_iter: int = 10, seed: int = 19,
                name: str = "GBT", params: dict | None = None, sample_frac: float = 1.0, under: bool = False,
                sampler: str = "NONE", frac: float = 0.25, patience: int | None = None) -> dict:
    """Sample -> WoE binning -> iterative VIF removal on the WoE columns -> k-fold permutation importance of the kept
    features. Returns the binning model, dropped features, the VIF table and the importance table."""
    spark = sample_df.sparkSession
    d = narrow_copy(selection_sample(sample_df, spec, sample_frac, under, seed), spec)
    bm = binning.fit_binning(d, spec.numeric, spec.categorical, spec.target, binner)
    woe = materialize(bm.transform(d, keep=[*key_columns(spec.key), spec.target]), "woe")
    woe_cols = [f"woe_{f}" for f in bm.features]
    dropped, vif_final = collinear.vif_select(woe, woe_cols, vif_cutoff)
    drop_names = [f[len("woe_"):] for f, _ in dropped]
    kept = [f for f in spec.features if f in bm.features and f not in drop_names]
    imp = fold_permutation_importance(d, spec.with_features(kept), n_splits, n_iter, seed, name, params, sampler, frac,
                                      patience)
    return {"binning": bm, "dropped": dropped, "vif": vif_final, "importance": imp, "kept": kept,
            "woe": woe, "spark": spark}


def fold_permutation_importance(df: DataFrame, spec: SampleSpec, n_splits: int = 10, n_iter: int = 10,
                                seed: int = 19, name: str = "GBT", params: dict | None = None, sampler: str = "NONE",
                                frac: float = 0.25, patience: int | None = None) -> DataFrame:
    """Stratified folds; fit on k-1 folds (resampled by weights, early stop on the held-out fold), permutation
    importance on the held-out fold; mean over folds."""
    folded = materialize(sampling.stratified_folds(df, spec.target, n_splits, spec.key, seed), "folds")
    num, cat = list(spec.numeric), list(spec.categorical)

    def one_fold(j):
        train = sampling.resample_weights(folded.where(F.col("fold") != j), spec.target, sampler, frac, spec.key, f"{seed}-{j}")
        held = folded.where(F.col("fold") == j)
        fitted = models.fit(train, num, cat, spec.target, name, params, seed, held, patience,
                            "weight" if sampler.upper() == "OVER" else None)
        imp = importance.permutation_importance(
            held, spec.features, spec.target, spec.key, models.Scorer(fitted, num, cat), n_iter,
            f"{seed}-{j}")
        return small_result(imp)

    return mean_importance(run_parallel(one_fold, list(range(n_splits))))


def mean_importance(parts: Sequence[DataFrame]) -> DataFrame:
    """Mean of (feature, importance) over the folds, highest first."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(F.desc("importance"), "feature")


def small_result(df: DataFrame) -> DataFrame:
    """Materialise a per-feature result table (bounded by the feature count) so later unions do not re-run fits."""
    from giniflow.operators.prefix import small_table
    return small_table(df)


def backtest_refit(df: DataFrame, spec: SampleSpec, features: Sequence[str], name: str = "GBT",
                   params: dict | None = None, seed: int = 19, valid_size: float | None = 0.25, sampler: str = "NONE",
                   frac: float = 0.25, patience: int | None = None) -> DataFrame:
    """M7 backtest with a refit per step: for the i-th report date, fit on all earlier dates (their VALID share drives early
    stop, the sampler works on the rest) and take the Gini on all those rows and on the date itself. Returns
    (report_dt, dev, oot)."""
    from giniflow.operators.backtest import backtest_models
    num = [f for f in features if f in spec.numeric]
    cat = [f for f in features if f in spec.categorical]
    # the hash of the VALID share is the same at every step: stored once, compared by each
    hashed = df.withColumn("__h", row_hash(key_text(spec.key), f"backtest-valid-{seed}")) if valid_size else df
    base = narrow_copy(hashed, spec.with_features(features), [spec.date_col, *(["__h"] if valid_size else [])])

    def fit_and_score(dev, oot):
        train, valid = dev, None
        if valid_size:
            keyed = dev.withColumn("__key", key_text(spec.key))
            held = sampling.at_or_below("__h", "__key", sampling.smallest(keyed, "__h", valid_size))
            train, valid = (keyed.where(c).drop("__key", "__h") for c in (~held, held))
        train = sampling.resample_weights(train, spec.target, sampler, frac, spec.key, seed)
        fitted = models.fit(train, num, cat, spec.target, name, params, seed, valid, patience,
                            "weight" if sampler.upper() == "OVER" else None)
        both = dev.withColumn("role", F.lit("DEV")).unionByName(oot.withColumn("role", F.lit("OOT")))
        return metrics.gini(models.score(fitted, both, num, cat), "score", spec.target, by=["role"], digits=None)

    return small_result(backtest_models(base, spec.date_col, fit_and_score))


def stable_score(df: DataFrame, spec: SampleSpec, features: Sequence[str], params: dict | None = None,
                 name: str = "GBT", seed: int = 19, accept_lvl: float = 25.0, actuality: float = 1.5,
                 stable_fine: float = 5.0, **fitting) -> float:
    """Objective of the STABLE design (M7): stability score of the refit backtest (lower is better, +inf when the
    mean OOT Gini is below ACCEPT_LVL). ``fitting``: VALID share, sampler, its share and patience of the refits."""
    bt = backtest_refit(df, spec, features, name, params, seed, **fitting)
    return gates.stability_score(bt, accept_lvl, actuality, stable_fine).first()["stability_score"]
