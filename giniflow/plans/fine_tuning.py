"""Fine tuning (M21): fits on the preselected and on the best features, uplift test, hyperparameters (searched, given or
skipped), final fit with its scoring package, reports and gates.

Every step is stored in the run's folder under its own name. A call on a folder that holds a step reads it instead of
computing it again, so a run that was stopped resumes behind its last finished step, and a finished run is only read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.functions.columns import feature_projection_sql, order_features
from giniflow.operators import gates, importance, metrics, models, reports, sampling
from giniflow.operators.encode import category_long
from giniflow.operators.tuning import candidates, gbt_space, tune
from giniflow.plans import stages
from giniflow.sources import io
from giniflow.spec import SampleSpec

#: What becomes of the hyperparameters.
SEARCH, GIVEN, SKIP = "search", "given", "skip"


@dataclass(frozen=True)
class TuningSettings:
    n_best: int = 10                    # best features taken from the selection's ranking
    status: str = SEARCH                # search | given | skip
    given: dict = field(default_factory=dict)     # parameters of the final fit where they are given
    params: dict = field(default_factory=dict)    # of the fits before (learner defaults otherwise)
    patience: int | None = None
    n_evals: int = 4                    # candidates of the search
    design: str = "KFOLD"               # KFOLD | STABLE
    k: int = 5
    tuning_share: float = 1.0           # share of the TRAIN rows the search works on
    valid_size: float = 0.25            # VALID share inside each fit of the search
    sampler: str = "NONE"               # NONE | UNDER | OVER, of every fit
    frac: float = 25.0                  # minority share in percent that the sampler makes
    frac_amp: float = 4.0               # the search moves it within +- so many points
    kfold_fine: float = 0.25
    accept_lvl: float = 25.0
    actuality: float = 1.5
    stable_fine: float = 5.0
    f_lower: int = 4
    f_upper: int = 10
    final_valid: float = 0.0            # own VALID share of the final fit (0: the pool's)
    final_patience: int = 0             # own patience of the final fit (0: as before)
    oot_frac: float = 1.0
    perm_iter: int = 10
    seed: int = 19


class RunFolder:
    """Steps of a run by name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def has(self, name: str) -> bool:
        return io.path_exists(self.spark, f"{self.path}/{name}/_SUCCESS")

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.has(name):
            build().write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.parquet(f"{self.path}/{name}")

    def value(self, name: str, build: Callable[[], object]):
        """A small JSON value."""
        if not self.has(name):
            text = json.dumps(build(), sort_keys=True)
            self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/{name}")
        return json.loads(self.spark.read.text(f"{self.path}/{name}").first()[0])

    def model(self, name: str, build: Callable[[], models.FitResult], categorical: Sequence[str],
              values: DataFrame | None = None, config: dict | None = None) -> models.FitResult:
        """A scoring package; its metadata are written last, so a package that has them is whole."""
        folder = f"{self.path}/{name}"
        if not io.path_exists(self.spark, f"{folder}/meta/_SUCCESS"):
            fitted = build()
            cats = [f for f in fitted.features if f in categorical]
            if values is not None:
                values = values.where(F.col("feature").isin(cats)) if cats else values.limit(0)
            io.save_model_package(self.spark, fitted.model, folder, fitted.features, cats, values,
                                  {"n_iter": fitted.n_iter}, config)
        model, meta = io.load_model_package(self.spark, folder)
        return models.FitResult(model, meta["features"], meta["params"]["n_iter"])


def uplift_scores(pools_df: DataFrame, fit_on: Callable[[Sequence[str]], models.FitResult], spec: SampleSpec,
                  feats: Sequence[str]) -> DataFrame:
    """(step, feature, pool, gini) of refits on the first 1, 2, ... features."""

    def one(k: int) -> DataFrame:
        prefix = list(feats[:k])
        g = stages.pool_gini(fit_on(prefix), pools_df, spec, prefix, digits=None)
        return stages.small_result(g.select(F.lit(k).alias("step"), F.lit(feats[k - 1]).alias("feature"), "pool", "gini"))

    parts = stages.run_parallel(one, list(range(1, len(feats) + 1)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _learner(c: dict) -> dict:
    return {"depth": c["depth"], "learning_rate": min(c["learning_rate"], 1.0), "subsample": c["subsample"], "rsm": c["rsm"],
            "min_gain": c["min_gain"]}


def search_params(train: DataFrame, spec: SampleSpec, feats: Sequence[str], s: TuningSettings) -> tuple[dict, DataFrame]:
    """M9: seeded search; the loss is the k-fold score of the best features (KFOLD) or the stability score of a drawn
    combination of them (STABLE). Every fit has its VALID share, patience, and the candidate's resampling share.
    Returns (best candidate, trials)."""
    spark = train.sparkSession
    d = stages.narrow_copy(sampling.sample_rows(train, s.tuning_share, spec.key, s.seed * 2) if s.tuning_share < 1 else train,
                           spec.with_features(feats), [spec.date_col])
    sub, stable = spec.with_features(feats), s.design.upper() == "STABLE"
    folded = None if stable else models.fold_rows(d, feats, spec.target, spec.key, s.k, s.seed, s.valid_size)

    def objective(c: dict) -> float:
        params, frac = {**s.params, **_learner(c)}, float(c.get("frac", s.frac / 100.0))
        if stable:
            return stages.stable_score(d, spec, list(c["features"]), params, "GBT", s.seed, s.accept_lvl, s.actuality,
                                       s.stable_fine, valid_size=s.valid_size, sampler=s.sampler, frac=frac,
                                       patience=s.patience)
        _, folds = models.cross_validate(d, list(sub.numeric), list(sub.categorical), spec.target, spec.key, "GBT", params,
                                         s.k, s.seed, s.sampler, frac, s.valid_size, patience=s.patience, folded=folded)
        return gates.kfold_score(folds, s.kfold_fine).first()["kfold_score"]

    space = gbt_space(s.frac if s.sampler.upper() != "NONE" else None, s.frac_amp)
    cands = candidates(spark, s.n_evals, space, s.seed, feats if stable else None, s.f_lower, s.f_upper)
    return tune(cands, objective)


def own_valid(pools_df: DataFrame, spec: SampleSpec, share: float, seed: int) -> DataFrame:
    """TRAIN and VALID split anew with another share; TEST and OOT stay as they are."""
    dev = pools_df.where(F.col("pool").isin("TRAIN", "VALID")).drop("pool")
    dev = sampling.split_holdout(dev, share, spec.key, seed, salt="final-valid", out="__v")
    redone = dev.withColumn("pool", F.when(F.col("__v"), F.lit("VALID")).otherwise(F.lit("TRAIN"))).drop("__v")
    return redone.unionByName(pools_df.where(F.col("pool").isin("TEST", "OOT")))


def fine_tuning(pools_df: DataFrame, spec: SampleSpec, ranked: Sequence[str], settings: TuningSettings, folder: str,
                selection: int | None = None) -> dict:
    """The stage on four pools. ``ranked``: features by the selection's importance; ``selection``: number of that run.
    Returns stored tables (ginis, report, extended, stability, uplift, flagged, trials, oot_importance), the final fit,
    its features and parameters."""
    s, spark = settings, pools_df.sparkSession
    run = RunFolder(spark, folder)
    if s.status not in (SEARCH, GIVEN, SKIP):
        raise ValueError(f"unknown status {s.status}")
    columns = list(dict.fromkeys([*spec.id_cols, "pool", spec.target, *spec.features]))
    p = run.table("pools", lambda: sampling.oot_subsample(pools_df.select(*columns), s.oot_frac, spec.key, s.seed * 2))
    best_features = list(ranked)[:s.n_best]
    config = {**asdict(s), "selection": selection, "ranked": list(ranked)}
    values = run.table("category_values", lambda: category_long(p.where(F.col("pool") == "TRAIN"), list(spec.categorical)).distinct())

    def fitter(frame: DataFrame, params: dict, patience: int | None, frac: float):
        return lambda feats: stages.fit_on_pools(frame, spec, feats, "GBT", params, s.seed, patience, s.sampler, frac)

    before = fitter(p, dict(s.params), s.patience, s.frac / 100.0)
    top_name, best_name = f"TOP {len(spec.features)}", f"TOP {len(best_features)} BEST"
    top = run.model("top_model", lambda: before(spec.features), spec.categorical, values)
    best = run.model("best_model", lambda: before(best_features), spec.categorical, values)
    best_steps = run.table("best_uplift", lambda: uplift_scores(p, before, spec, best_features))

    params, feats, trials, final_pools = dict(s.params), best_features, None, p
    frac = s.frac / 100.0
    if s.status == SEARCH:
        def searched() -> DataFrame:
            found, table = search_params(p.where(F.col("pool") == "TRAIN"), spec, best_features, s)
            run.value("best_candidate", lambda: {k: v for k, v in found.items()})
            return table
        trials = run.table("trials", searched)
        chosen = run.value("best_candidate", dict)
        params |= _learner(chosen)
        feats, frac = list(chosen.get("features") or best_features), float(chosen.get("frac", frac))
    elif s.status == GIVEN:
        params |= s.given
    if s.status != SKIP and s.final_valid > 0:
        final_pools = run.table("final_pools", lambda: own_valid(p, spec, s.final_valid, s.seed))
    last = fitter(final_pools, params, s.final_patience or s.patience, frac)
    final = run.model("package", lambda: best if s.status == SKIP else last(feats), spec.categorical, values, config)
    run.table("feature_sql", lambda: spark.createDataFrame(
        [(feature_projection_sql(order_features(feats)).strip(),)], "sql string"))

    def all_ginis() -> DataFrame:
        rows = None
        for name, fitted, frame in ((top_name, top, p), (best_name, best, p), ("FINAL", final, final_pools)):
            g = stages.pool_gini(fitted, frame, spec, fitted.features, digits=None).select(
                F.lit(name).alias("model"), F.lit(len(fitted.features)).alias("step"), "pool", "gini")
            rows = g if rows is None else rows.unionByName(g)
        return rows

    ginis = run.table("ginis", all_ginis)
    names = [top_name, best_name, "FINAL"]
    # before the final fit only TRAIN and VALID are shown; the extended report shows all
    shown = ginis.where((F.col("model") == "FINAL") | F.col("pool").isin("TRAIN", "VALID"))
    report = run.table("gini_report", lambda: reports.gini_report(shown, columns=names))
    extended = run.table("gini_report_ext", lambda: reports.gini_report(ginis, columns=names))
    stability = run.table("stability", lambda: gates.stability_gate(
        ginis.where(F.col("model") == "FINAL").select("model", "pool", F.round("gini", 2).alias("gini"))))

    num, cat = [[f for f in final.features if f in kind] for kind in (spec.numeric, spec.categorical)]
    oot_importance = run.table("oot_importance", lambda: importance.permutation_importance(
        final_pools.where(F.col("pool") == "OOT"), final.features, spec.target, spec.key,
        models.Scorer(final, num, cat), s.perm_iter, s.seed))
    order = [r["feature"] for r in reports.rank_importance(oot_importance).orderBy("rank").collect()]
    steps = run.table("final_uplift", lambda: uplift_scores(final_pools, before if s.status == SKIP else last, spec, order))
    flagged, verdict = gates.uplift_gate(steps)
    result = run.table("result", lambda: reports.result_report(
        ginis.where(F.col("model") == "FINAL"), stability, verdict.withColumn("model", F.lit("FINAL")),
        base=ginis.where(F.col("model") == top_name),
        selections=spark.createDataFrame([("FINAL", selection)], "model string, sel int")))
    return {"ginis": ginis, "report": report, "extended": extended, "stability": stability, "steps": steps,
            "best_steps": best_steps,
            "uplift": verdict, "flagged": flagged, "trials": trials, "oot_importance": oot_importance, "result": result,
            "model": final, "features": feats, "params": params, "gini": metrics.gini(
                models.score(final, final_pools, num, cat), "score", spec.target, by=["pool"])}
