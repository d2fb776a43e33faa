"""Seeded random search over pipeline hyperparameters.

Candidates are rows of a DataFrame whose values are hashes of (candidate id, parameter name, seed): uniform,
quantised-uniform and log-uniform draws are plain column expressions, reproducible in SQL and independent of
partitioning. Feature subsets (the STABLE design) are drawn uniformly from all combinations of F_LOWER to F_UPPER features:
a candidate draws a rank, and the combination of that rank is computed from binomial coefficients (combinadic numbers), so
the product of all combinations is never built.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.functions.hashing import row_uniform


@dataclass(frozen=True)
class Param:
    name: str
    kind: str          # uniform | quniform | loguniform
    lo: float
    hi: float


def draw(pid: Column, p: Param, seed: int | str) -> Column:
    u = row_uniform(pid.cast("string"), f"{p.name}-{seed}")
    if p.kind == "uniform":
        return F.lit(p.lo) + u * F.lit(p.hi - p.lo)
    if p.kind == "quniform":
        return F.round(F.lit(p.lo) + u * F.lit(p.hi - p.lo), 0)
    if p.kind == "loguniform":
        return F.exp(F.lit(p.lo) + u * F.lit(p.hi - p.lo))
    raise ValueError(p.kind)


def gbt_space(frac: float | None = None, frac_amp: float = 4.0) -> list[Param]:
    """Search space of the boosted learner; the resampling share moves within +-amp points of the chosen one,
    bounded to [1, 50] percent."""
    space = [Param("depth", "quniform", 2, 13), Param("learning_rate", "loguniform", -5, 0),
             Param("subsample", "uniform", 0.3, 1.0), Param("rsm", "uniform", 0.1, 1.0),
             Param("min_gain", "loguniform", -10, 0)]
    if frac is not None:
        space.insert(0, Param("frac", "uniform", max(1.0, frac - frac_amp) / 100.0, min(50.0, frac + frac_amp) / 100.0))
    return space


def n_combinations(n: int, lower: int, upper: int) -> int:
    """Number of combinations of ``lower`` to ``upper`` out of ``n``."""
    return sum(math.comb(n, k) for k in range(lower, upper + 1))


def _check_total(total: int) -> None:
    if total >= 1 << 60:
        raise ValueError("too many combinations for a 60-bit rank: choose fewer features")


def combination(rank: Column, n: int, lower: int, upper: int) -> Column:
    """Positions (from 0, ascending) of the combination of a rank, 0 <= rank < n_combinations: smaller ones first, those of
    k positions by their greatest position, then the next, and so on.

    The greatest position of rank r among k is the largest c with C(c, k) <= r; the rest has rank r - C(c, k) among k - 1.
    Binomials are a literal table of n x upper numbers."""
    _check_total(n_combinations(n, lower, upper))
    table = F.array(*[F.array(*[F.lit(math.comb(c, k)).cast("long") for c in range(n)]) for k in range(1, upper + 1)])
    starts = [n_combinations(n, lower, k - 1) for k in range(lower, upper + 1)]
    begin = F.array(*[F.lit(s).cast("long") for s in starts])
    size = F.size(F.filter(begin, lambda s: s <= rank))          # which of the sizes, from 1
    inside = rank - F.element_at(begin, size)

    def step(state: Column, k: Column) -> Column:
        row = F.element_at(table, k)
        c = F.size(F.filter(row, lambda x: x <= state["rest"])) - 1
        return F.struct((state["rest"] - F.element_at(row, c + 1)).alias("rest"),
                        F.concat(F.array(c), state["picked"]).alias("picked"))

    start = F.struct(inside.cast("long").alias("rest"), F.array().cast("array<int>").alias("picked"))
    return F.aggregate(F.sequence(size + F.lit(lower - 1), F.lit(1), F.lit(-1)), start, step)["picked"]


def drawn_rank(pid: Column, total: int, seed: int | str) -> Column:
    """A rank below ``total`` from 60 bits of a hash."""
    _check_total(total)
    wide = F.conv(F.substring(F.md5(F.concat(pid.cast("string"), F.lit(f":combination-{seed}"))), 1, 15), 16, 10)
    return wide.cast("bigint") % F.lit(total).cast("long")


def candidates(spark: SparkSession, n: int, space: Sequence[Param], seed: int | str = 19,
               features: Sequence[str] | None = None, f_lower: int = 4, f_upper: int = 10) -> DataFrame:
    """``n`` candidate rows (id, params..., [n_features, features array])."""
    pid = F.col("id")
    cols = [pid.alias("candidate")] + [draw(pid, p, seed).alias(p.name) for p in space]
    if not features:
        return spark.range(n).select(*cols)
    names = F.array(*[F.lit(f) for f in features])
    hi = min(f_upper, len(features))
    lo = min(f_lower, hi)
    total = n_combinations(len(features), lo, hi)
    drawn = spark.range(n).withColumn("__r", drawn_rank(pid, total, seed)).withColumn(
        "__p", combination(F.col("__r"), len(features), lo, hi))
    return drawn.select(*cols, F.size("__p").alias("n_features"),
                        F.transform("__p", lambda i: F.element_at(names, i + 1)).alias("features"))


def tune(cands: DataFrame, objective: Callable[[dict], float]) -> tuple[dict, DataFrame]:
    """Score every candidate with ``objective`` (each evaluation is its own set of Spark jobs over the data) and keep
    the minimum. The candidate table is a configured count, so it is collected."""
    rows = [r.asDict() for r in cands.orderBy("candidate").collect()]
    trials = []
    for r in rows:
        loss = float(objective(r))
        trials.append({**r, "loss": loss})
    best = min(trials, key=lambda t: (math.inf if math.isnan(t["loss"]) else t["loss"], t["candidate"]))
    spark = cands.sparkSession
    cols = [c for c in trials[0] if c != "features"]
    table = spark.createDataFrame([tuple(t[c] for c in cols) for t in trials], cols)
    return best, table
