"""Estimators, pipeline fit with early stop, scoring, importance and cross-validation.

The boosting libraries of a single-machine pipeline are replaced by Spark ML learners (GBT, random forest, logistic
regression) inside one ``Pipeline``: exact ``MedianImputer`` -> ``StringIndexer(handleInvalid='keep')`` -> (one-hot for
the linear model) -> ``VectorAssembler`` -> learner. Every fit is a set of distributed Spark jobs; folds and grid cells
are independent and are submitted from a small driver thread pool.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.functions.hashing import key_columns, key_text, row_hash
from giniflow.operators import boosting, metrics, sampling
from giniflow.operators.impute import MedianImputer, MedianModel
from giniflow.operators.prep import normalize_categories, normalize_numeric
from giniflow.session import materialize

MODELS = ("GBT", "RF", "LR")

# Fixed defaults per learner (iterations, depth, learning rate, regularisation).
DEFAULTS = {
    "GBT": {"n_iter": 100, "depth": 3, "learning_rate": 0.1, "subsample": 1.0, "rsm": 1.0, "min_gain": 0.0},
    "RF": {"n_iter": 100, "depth": 5, "subsample": 1.0, "rsm": 1.0, "min_gain": 0.0},
    "LR": {"n_iter": 100, "l2": 0.0},
}


def _subset_strategy(rsm: float) -> str:
    return "all" if rsm >= 1.0 else str(max(min(float(rsm), 1.0), 0.01))


def make_estimator(name: str, params: dict | None = None, seed: int = 19, label: str = "label", max_bins: int = 32):
    """Catalogue of base learners with their defaults (M1). ``max_bins`` must reach the largest number of levels of a
    category; ``fit`` takes it from the fitted indexer."""
    name = name.upper()
    p = {**DEFAULTS[name], **(params or {})}
    if name == "GBT":
        return GBTClassifier(featuresCol="features", labelCol=label, maxIter=int(p["n_iter"]), maxDepth=int(p["depth"]),
                             stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]),
                             featureSubsetStrategy=_subset_strategy(p["rsm"]), seed=seed, maxBins=max_bins,
                             minInfoGain=float(p["min_gain"]))
    if name == "RF":
        return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=int(p["n_iter"]),
                                      maxDepth=int(p["depth"]), subsamplingRate=float(p["subsample"]),
                                      featureSubsetStrategy=_subset_strategy(p["rsm"]), seed=seed, maxBins=max_bins,
                             minInfoGain=float(p["min_gain"]))
    if name == "LR":
        return LogisticRegression(featuresCol="features", labelCol=label, maxIter=int(p["n_iter"]),
                                  regParam=float(p["l2"]), elasticNetParam=0.0)
    raise ValueError(f"unknown model {name}; choose from {MODELS}")


def build_pipeline(numeric: Sequence[str], categorical: Sequence[str], estimator, one_hot: bool = False) -> Pipeline:
    numeric, categorical = list(numeric), list(categorical)
    stages, inputs = [], []
    if numeric:
        stages.append(MedianImputer(inputCols=numeric, outputCols=[f"__imp_{c}" for c in numeric]))
        inputs += [f"__imp_{c}" for c in numeric]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=[f"__idx_{c}" for c in categorical],
                                    handleInvalid="keep", stringOrderType="frequencyDesc"))
        if one_hot:
            stages.append(OneHotEncoder(inputCols=[f"__idx_{c}" for c in categorical],
                                        outputCols=[f"__oh_{c}" for c in categorical], handleInvalid="keep"))
            inputs += [f"__oh_{c}" for c in categorical]
        else:
            inputs += [f"__idx_{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    stages.append(estimator)
    return Pipeline(stages=stages)


def prepare(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str | None) -> DataFrame:
    """NaN -> NULL for numeric, 'nan' marker for categories, double ``label``."""
    d = normalize_categories(normalize_numeric(df, numeric), categorical)
    return d.withColumn("label", F.col(target).cast("double")) if target else d


@dataclass
class FitResult:
    model: PipelineModel
    features: list[str]
    n_iter: int | None = None
    slots: list[str] | None = None     # source feature of every slot of the assembled vector
    slot_std: list[float] | None = None


def slot_features(assembled: DataFrame, features: Sequence[str]) -> list[str]:
    """Map every slot of the ``features`` vector to its source column via the assembler's attribute metadata."""
    attrs = assembled.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    flat = sorted((a["idx"], a.get("name", "")) for group in attrs.values() for a in group)
    out = []
    for _, name in flat:
        src = next((f for f in features if name in (f"__imp_{f}", f"__idx_{f}") or name.startswith(f"__oh_{f}_")
                    or name == f"__oh_{f}"), name)
        out.append(src)
    return out


def best_iteration(losses: Sequence[float], patience: int | None = None) -> int:
    """Number of trees to keep: the first iteration with the lowest loss, scanning until ``patience`` iterations pass
    without improvement (None: the whole sequence)."""
    best_i, best = 0, float("inf")
    for i, loss in enumerate(losses):
        if loss < best:
            best, best_i = loss, i
        elif patience is not None and i - best_i >= patience:
            break
    return best_i + 1


CHUNK_ROWS = 100_000    # rows whose margins a task sorts at once


def staged_auc(learner: GBTClassificationModel, valid: DataFrame, range_rows: int = metrics.RANGE_ROWS) -> list[float]:
    """AUC on ``valid`` (features, label) after each number of trees. Tasks evaluate the trees on arrays and sort the margins
    of a prefix by class; the sorted margins travel as arrays, cut at bounds from a sample of rows, and each (prefix, range)
    is compared by itself. Exact whatever the bounds, which only spread the work. NaN where ``valid`` holds one class only."""
    forest = boosting.forest_of(learner)
    n_trees = len(forest.trees)
    rows = valid.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("f"))

    def chunks(batches):
        """(labels, codes) of the rows of Arrow batches."""
        held, n = [], 0
        for batch in batches:
            held.append((batch["label"].to_numpy() > 0.5, batch["f"].flatten().to_numpy().reshape(batch.num_rows, -1)))
            n += batch.num_rows
            if n >= CHUNK_ROWS:
                yield held
                held, n = [], 0
        if n:
            yield held

    def sampled(batches):
        for held in chunks(batches):
            codes = forest.codes(np.concatenate([x for _, x in held]).T)
            margins = np.stack(list(forest.margins(codes)), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([m.tobytes() for m in margins], pa.binary())], ["m"])

    n = valid.count()
    n_ranges = max(1, -(-n // range_rows))
    bounds = np.zeros((n_trees, 0))
    if n_ranges > 1:
        some = rows.sample(min(1.0, max(2000, 50 * n_ranges) / n), seed=0).mapInArrow(sampled, "m binary").collect()
        if some:
            at = np.arange(1, n_ranges) * len(some) // n_ranges
            bounds = np.sort(np.stack([np.frombuffer(r["m"]) for r in some]), axis=0)[at].T

    def count(batches):
        for held in chunks(batches):
            label = np.concatenate([y for y, _ in held])
            out = []
            for t, m in enumerate(forest.margins(forest.codes(np.concatenate([x for _, x in held]).T))):
                out += [(t + 1, *cell) for cell in metrics.cells(m, label, bounds[t])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.int64(), *[pa.binary()] * 3))], ["trees", "range", "m", "pos", "neg"])

    def compare(group: pa.Table) -> pa.Table:
        return pa.table({c: [v] for c, v in zip(("trees", "range", "pos", "neg", "twice"), (
            group["trees"][0].as_py(), group["range"][0].as_py(), *metrics.pairs(group)))})

    compared = rows.mapInArrow(count, "trees long, range long, m binary, pos binary, neg binary").groupBy(
        "trees", "range").applyInArrow(compare, "trees long, range long, pos long, neg long, twice long")
    pos, neg, twice = ([0] * (n_trees + 1) for _ in range(3))
    for r in sorted(compared.collect()):       # ranges of a prefix in order, a number of rows that follows trees and ranges
        t = r["trees"]
        twice[t] += r["twice"] + 2 * r["pos"] * neg[t]
        pos[t] += r["pos"]
        neg[t] += r["neg"]
    return [twice[t] / (2 * pos[t] * neg[t]) if pos[t] and neg[t] else float("nan") for t in range(1, n_trees + 1)]


def first_trees(learner: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees, cut from the fitted one (a shorter fit with the same seed has the same trees)."""
    java = learner._java_obj
    gateway = SparkContext._active_spark_context._gateway
    trees, weights = java.trees(), java.treeWeights()
    some = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    scales = gateway.new_array(gateway.jvm.double, n)
    for k in range(n):
        some[k], scales[k] = trees[k], weights[k]
    cut = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), some, scales, java.numFeatures(), 2)
    out = GBTClassificationModel(cut)
    out._resetUid(learner.uid)
    return learner._copyValues(out)


EVEN_ROWS = 100_000     # rows from which the partitions of a fit are made equal


def evened(assembled: DataFrame) -> DataFrame:
    """The stored rows in partitions of equal size, a multiple of the cores: every job of Spark's learners waits for the
    largest. Few rows stay as they are."""
    n, cores = assembled.count(), assembled.sparkSession.sparkContext.defaultParallelism
    if n <= EVEN_ROWS:
        return assembled
    return assembled.repartition(cores * -(-n // (cores * boosting.TASK_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)


def fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, name: str = "GBT",
        params: dict | None = None, seed: int = 19, valid: DataFrame | None = None,
        patience: int | None = None, weight: str | None = None) -> FitResult:
    """Fit the pipeline; for GBT with a validation frame, early stop = the first prefix of trees with the highest AUC on it
    (optionally with a patience), taken from one fit and one scoring pass. ``weight``: a column of row weights (how
    often a resampled row counts)."""
    est = make_estimator(name, params, seed)
    pipe = build_pipeline(numeric, categorical, est, one_hot=name.upper() == "LR")
    train = prepare(df, numeric, categorical, target)
    # feature stages are fitted once; the assembled vectors are cached for the learner
    feature_model = Pipeline(stages=pipe.getStages()[:-1]).fit(train)
    levels = [len(labels) + 1 for s in feature_model.stages if hasattr(s, "labelsArray") for labels in s.labelsArray]
    max_bins = max([32, *levels])       # one bin per level and one for unseen values
    est = make_estimator(name, params, seed, max_bins=max_bins)
    if weight:
        est = est.setWeightCol(weight)
    assembled = feature_model.transform(train).select("features", "label", *([weight] if weight else [])).persist(
        StorageLevel.MEMORY_AND_DISK)
    slots = slot_features(assembled, [*numeric, *categorical])
    slot_std = None
    if name.upper() == "LR":
        from pyspark.ml.stat import Summarizer
        slot_std = assembled.select(Summarizer.std(F.col("features")).alias("s")).first()["s"].toArray().tolist()
    even = assembled
    try:
        if name.upper() == "GBT" and boosting.can_fit(est):
            learner = boosting.fit(est, assembled, weight)
        else:
            even = evened(assembled)
            learner = est.fit(even)
    finally:
        if even is not assembled:
            even.unpersist()
        assembled.unpersist()
    n_iter = None
    if valid is not None and name.upper() == "GBT":
        aucs = staged_auc(learner, feature_model.transform(prepare(valid, numeric, categorical, target)))
        known = [a for a in aucs if a == a]
        n_iter = best_iteration([1.0 - a for a in aucs], patience) if known else len(aucs)
        if n_iter < len(aucs):
            learner = first_trees(learner, n_iter)
    model = PipelineModel(stages=[*feature_model.stages, learner])
    return FitResult(model, [*numeric, *categorical], n_iter, slots, slot_std)


def score(fitted: FitResult | PipelineModel, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
          out: str = "score") -> DataFrame:
    """Probability of class 1 as a double column (stateless: valid on a streaming DataFrame too)."""
    model = fitted.model if isinstance(fitted, FitResult) else fitted
    if isinstance(model.stages[-1], GBTClassificationModel):       # trees on arrays; the assembler only lists their columns
        *encoders, assembler, learner = model.stages
        scored = PipelineModel(stages=encoders).transform(prepare(df, numeric, categorical, None))
        scored = scored.withColumn(out, boosting.scored(boosting.forest_of(learner), assembler.getInputCols()))
        return scored.drop(*[c for c in scored.columns if c.startswith("__")])
    scored = model.transform(prepare(df, numeric, categorical, None))
    drop = [c for c in scored.columns if c.startswith("__") or c in ("features", "rawPrediction", "probability",
                                                                      "prediction")]
    return scored.withColumn(out, vector_to_array("probability").getItem(1)).drop(*drop)


class Linear:
    """The linear model on arrays: a coefficient of a numeric feature, one for each code of a category."""

    def __init__(self, intercept: float, coefficients: Sequence[np.ndarray | float]):
        self.intercept, self.coefficients = intercept, list(coefficients)

    def _parts(self, columns: Sequence[np.ndarray]) -> list[np.ndarray]:
        return [x * c if np.isscalar(c) else c[np.minimum(x.astype(np.int64), len(c) - 1)]
                for c, x in zip(self.coefficients, columns)]

    def _sum(self, parts: Sequence[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(parts[0]))
        for p in parts:
            total += p
        return boosting.logistic(total + self.intercept)

    def probability(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        return self._sum(self._parts(columns))

    def variants(self, columns: Sequence[np.ndarray], others: Sequence[np.ndarray], wanted: Sequence[int]):
        """As of `boosting.Forest`."""
        parts, other = self._parts(columns), self._parts(others)
        for f in wanted:
            yield self._sum([*parts[:f], other[f], *parts[f + 1:]])


class Scorer:
    """Scores frames with a fitted pipeline; trees and the linear model also on arrays of encoded features."""

    def __init__(self, fitted: FitResult | PipelineModel, numeric: Sequence[str], categorical: Sequence[str]):
        self.fitted, self.numeric, self.categorical = fitted, list(numeric), list(categorical)

    def __call__(self, df: DataFrame) -> DataFrame:
        return score(self.fitted, df, self.numeric, self.categorical)

    def arrays(self) -> tuple[boosting.Forest | Linear, list[str]] | None:
        """The model on arrays and its features in order; None for learners without that form."""
        stages = self.fitted.model.stages if isinstance(self.fitted, FitResult) else self.fitted.stages
        learner, names = stages[-1], [*self.numeric, *self.categorical]
        if isinstance(learner, GBTClassificationModel):
            return boosting.forest_of(learner), names
        slots = self.fitted.slots if isinstance(self.fitted, FitResult) else None
        if not isinstance(learner, LogisticRegressionModel) or not slots or learner.coefficientMatrix.numRows != 1:
            return None
        per = [[c for s, c in zip(slots, learner.coefficients.toArray().tolist()) if s == f] for f in names]
        return Linear(learner.intercept, [p[0] if f in self.numeric else np.array([*p, 0.0]) for f, p in zip(names, per)]), names

    def encoded(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the features as the model takes them (medians for missing values, codes of categories)."""
        stages = self.fitted.model.stages if isinstance(self.fitted, FitResult) else self.fitted.stages
        ready = PipelineModel(stages=[s for s in stages if isinstance(s, (MedianModel, StringIndexerModel))]).transform(
            prepare(df, self.numeric, self.categorical, None))
        return ready.select(*keep, *[F.col(f"__imp_{f}").alias(f"e_{f}") for f in self.numeric],
                            *[F.col(f"__idx_{f}").alias(f"e_{f}") for f in self.categorical])


def importance(fitted: FitResult, spark: SparkSession) -> DataFrame:
    """(feature, importance) sorted descending. Trees: ``featureImportances`` summed over the slots of a feature;
    linear model: share of |coefficient| x slot standard deviation (scale-free), summed over a feature's slots."""
    est = fitted.model.stages[-1]
    names = fitted.features
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    else:
        std = fitted.slot_std or [1.0] * est.coefficients.size
        coefs = [abs(c) * (std[i] if i < len(std) else 1.0) for i, c in enumerate(est.coefficients.toArray().tolist())]
        total = sum(coefs) or 1.0
        vals = [c / total for c in coefs]
    slots = fitted.slots or names
    per = {n: 0.0 for n in names}
    for i, v in enumerate(vals):
        if i < len(slots) and slots[i] in per:
            per[slots[i]] += float(v)
    rows = [(n, per[n]) for n in names]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def train_medians(train: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Exact, interpolating median of every numeric column of the training rows (A12), all columns at once
    (sketch bracket + bounded histogram, see ``quantiles.py``)."""
    from giniflow.operators.quantiles import exact_quantiles
    med = exact_quantiles(train, numeric, 0.5)
    return train.sparkSession.createDataFrame([(c, med[c]) for c in numeric], "feature string, median double")


def fold_rows(df: DataFrame, columns: Sequence[str], target: str, key: str, k: int = 5, seed: int = 19,
              valid_size: float | None = 0.25) -> DataFrame:
    """The key, target and feature columns with the fold of a row and the hashes of the VALID splits of all folds, stored:
    every learner and candidate that is cross-validated on the rows reads them."""
    folded = sampling.stratified_folds(df.select(*dict.fromkeys([*key_columns(key), target, *columns])), target, k, key, seed)
    hashes = {f"__h{j}": row_hash(key_text(key), f"cv-valid-{seed}-{j}") for j in range(k)} if valid_size else {}
    return materialize(folded.withColumns(hashes), "folds")


def cross_validate(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, key: str,
                   name: str = "GBT", params: dict | None = None, k: int = 5, seed: int = 19,
                   sampler: str = "NONE", frac: float = 0.25, valid_size: float | None = 0.25,
                   threads: int = 8, patience: int | None = None, folded: DataFrame | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Stratified k-fold (M5): for each fold, train on the other folds (resampled when asked, R7, as a weight column, so no
    row is copied; an inner VALID split drives early stop), score the held-out fold. Returns (out-of-fold scores,
    per-fold train/test Gini); scores are stored, so no fold is scored twice. ``folded``: `fold_rows` of the rows."""
    if folded is None:
        folded = fold_rows(df, [*numeric, *categorical], target, key, k, seed, valid_size)
    hashes = [c for c in folded.columns if c.startswith("__h")]

    def one_fold(j: int):
        rest = folded.where(F.col("fold") != j)
        test = folded.where(F.col("fold") == j)
        valid = None
        if valid_size:
            keyed = rest.withColumn("__key", key_text(key))
            held = sampling.at_or_below(f"__h{j}", "__key", sampling.smallest(keyed, f"__h{j}", valid_size))
            rest, valid = (keyed.where(c).drop("__key", *hashes) for c in (~held, held))
        train = materialize(sampling.resample_weights(rest, target, sampler, frac, key, f"{seed}-{j}"), "train")
        res = fit(train, numeric, categorical, target, name, params, seed, valid, patience,
                  "weight" if sampler.upper() == "OVER" else None)
        oof = score(res, test, numeric, categorical).select(*key_columns(key), "fold", target, "score")
        tr = score(res, train, numeric, categorical).select(F.lit(j).alias("fold"), target, "score", "weight")
        weighted = sampler.upper() == "OVER"
        g_train = metrics.gini(tr, "score", target, by=["fold"], digits=None, weight="weight") if weighted else \
            metrics.row_gini(tr, "score", target, by=["fold"], digits=None)
        return materialize(oof, "oof"), g_train

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        results = list(pool.map(one_fold, range(k)))
    oof, g_train = results[0]
    for o, t in results[1:]:
        oof, g_train = oof.unionByName(o), g_train.unionByName(t)
    g_test = metrics.row_gini(oof, "score", target, by=["fold"], digits=None).withColumnRenamed("gini", "gini_test")
    fold_metric = g_train.withColumnRenamed("gini", "gini_train").join(g_test, "fold")
    return oof, materialize(fold_metric, "fold_ginis")


def cv_summary(oof: DataFrame, fold_metric: DataFrame, target: str, bands: bool = False, n_bs: int = 2000,
               seed: int = 19) -> dict:
    """Pooled out-of-fold Gini (A9), fold medians (A8) and optional bootstrap band (A10), rounded to 2 digits."""
    pooled = metrics.row_gini(oof, "score", target).first()["gini"]
    med = metrics.fold_median(fold_metric, ["gini_train", "gini_test"]).first()
    out = {"gini": pooled, "median_gini_train": med["median_gini_train"], "median_gini_test": med["median_gini_test"],
           "gini_low": None, "gini_upp": None}
    if bands:
        _, band = metrics.bootstrap_gini(oof, "score", target, n_bs, seed)
        b = band.first()
        out["gini_low"], out["gini_upp"] = b["gini_low"], b["gini_upp"]
    return out
