"""Discrimination metrics: Gini / AUC, ROC points and weights, fold medians, class counts, bootstrap bands.

Shape of every metric: the cluster first compresses the rows to a histogram ``(group, score) -> (pos, neg)`` (map-side
partial aggregation, so a hot score value costs one row), then the ordered part runs on the histogram with bucketed
running sums (``prefix.py``) instead of a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from giniflow.operators.prefix import (buckets_for, exact_rank, next_in_order, ordered_running_sum, range_bucket,
                                       running_sum, small_table)
from giniflow.session import materialize


def score_histogram(df: DataFrame, score: str, label: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``(by..., score) -> pos, neg`` over rows with a non-missing score and label; ``weight``: how often a row counts."""
    y, w = F.col(label).cast("long"), F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull() & ~F.isnan(F.col(score).cast("double")))
            .groupBy(*by, score)
            .agg(F.sum(y * w).alias("pos"), F.sum((F.lit(1) - y) * w).alias("neg")))


def stored_histogram(hist: DataFrame, n_buckets: int | None = None) -> tuple[DataFrame, int]:
    """The histogram evaluated once (the ordered part reads it several times), and its number of buckets."""
    hist = materialize(hist, "histogram")
    return hist, n_buckets or buckets_for(hist.count())


def auc_from_histogram(hist: DataFrame, score: str, by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """AUC with mid-rank ties: sum(pos * (neg strictly below + neg/2)) / (P * N), per group.

    The histogram has one row per (group, distinct score); it is stored, and its ordered sum runs in buckets of the
    score whose number follows the number of rows, so no group funnels through one task."""
    by = list(by)
    hist, n_buckets = stored_histogram(hist, n_buckets)
    below = ordered_running_sum(hist, by, score, ["neg"], inclusive=False, n_buckets=n_buckets, suffix="_below")
    pos = F.col("pos").cast("double")
    term = pos * (F.col("neg_below").cast("double") + F.col("neg").cast("double") / F.lit(2.0))
    agg = below.groupBy(*by).agg(F.sum(term).alias("__num"), F.sum("pos").cast("double").alias("__p"),
                                 F.sum("neg").cast("double").alias("__n"))
    # a group with one class only has no AUC: NULL (try_divide keeps ANSI mode from raising)
    return agg.select(*by, F.try_divide(F.col("__num"), F.col("__p") * F.col("__n")).alias("auc"))


def gini(df: DataFrame, score: str, label: str, by: Sequence[str] = (), digits: int | None = 2,
         scale: float = 100.0, n_buckets: int | None = None, weight: str | None = None) -> DataFrame:
    """``round((2*AUC - 1) * 100, 2)`` per group (the reference's Gini of a score)."""
    auc = auc_from_histogram(score_histogram(df, score, label, by, weight), score, by, n_buckets)
    g = (F.lit(2.0) * F.col("auc") - F.lit(1.0)) * F.lit(scale)
    if digits is not None:
        g = F.round(g, digits)
    return auc.select(*by, g.alias("gini"))


RANGE_ROWS = 200_000        # rows of one group and range that `array_gini` compares at once
CHUNK_ROWS = 1_000_000      # rows that a task of it sorts at once


def cells(m: np.ndarray, positive: np.ndarray, bounds: np.ndarray):
    """(range, m, pos, neg) of the scores of some rows, cut at ``bounds``. Where values repeat, ``m`` holds the different
    ones and pos, neg their counts; else ``m`` is empty and pos, neg hold the sorted scores of the classes."""
    p, q = np.sort(m[positive]), np.sort(m[~positive])
    distinct = sum(np.count_nonzero(x[1:] != x[:-1]) + 1 for x in (p, q) if len(x))
    if 4 * distinct < len(m):
        values = np.unique(np.concatenate([x[np.r_[True, x[1:] != x[:-1]]] for x in (p, q) if len(x)]))
        pos, neg = (np.searchsorted(x, values, "right") - np.searchsorted(x, values, "left") for x in (p, q))
        cuts = np.r_[0, np.searchsorted(values, bounds), len(values)]
        for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if a < b:
                yield r, values[a:b].tobytes(), pos[a:b].astype(np.int32).tobytes(), neg[a:b].astype(np.int32).tobytes()
        return
    at, of = (np.r_[0, np.searchsorted(x, bounds), len(x)].tolist() for x in (p, q))
    for r in range(len(bounds) + 1):
        if at[r] < at[r + 1] or of[r] < of[r + 1]:
            yield r, b"", p[at[r]:at[r + 1]].tobytes(), q[of[r]:of[r + 1]].tobytes()


def pairs(group: pa.Table) -> tuple[int, int, int]:
    """Positives, negatives and twice the concordant pairs (ties count one) of the `cells` of one range."""
    rows = [[x.as_py() for x in group[c]] for c in ("m", "pos", "neg")]
    plain = [np.sort(np.concatenate([np.empty(0), *[np.frombuffer(x) for m, x in zip(rows[0], c) if not m]])) for c in rows[1:]]
    counted = [(np.frombuffer(m), np.frombuffer(p, np.int32), np.frombuffer(q, np.int32)) for m, p, q in zip(*rows) if m]
    if not counted:
        pos, neg = plain
        return len(pos), len(neg), int((np.searchsorted(neg, pos, "left") + np.searchsorted(neg, pos, "right")).sum())
    parts = [*counted, (plain[0], np.ones(len(plain[0]), np.int32), np.zeros(len(plain[0]), np.int32)),
             (plain[1], np.zeros(len(plain[1]), np.int32), np.ones(len(plain[1]), np.int32))]
    m, pos, neg = map(np.concatenate, zip(*parts))
    order = np.argsort(m, kind="stable")
    m, pos, neg = m[order], pos[order].astype(np.int64), neg[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
    pos, neg = np.add.reduceat(pos, first), np.add.reduceat(neg, first)
    below = np.cumsum(neg) - neg
    return int(pos.sum()), int(neg.sum()), int((pos * (2 * below + neg)).sum())


def array_gini(df: DataFrame, score: str, label: str, group: str, bounds: Sequence[float] = (),
               chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(group, gini) as `gini(..., digits=None)`, for many groups of mostly different scores: tasks sort the scores of a
    group and count labels by value, the sorted counts travel as arrays, cut at ``bounds``, and each (group, range) is
    compared by itself. Exact whatever the bounds, which only spread the work. ``group``: an integer column."""
    bounds = np.unique(np.asarray(bounds, np.float64))

    def packed(held):
        g, y, m = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(g, kind="stable")
        g, y, m = g[order], y[order] > 0, m[order]
        at = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        out = [(int(g[a]), *cell) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(g)]) for cell in cells(m[a:b], y[a:b], bounds)]
        return packed_cells(out)

    def count(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch[c].to_numpy() for c in ("g", "y", "m")))
                n += batch.num_rows
            if n >= chunk_rows:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    value = F.col(score).cast("double")
    rows = df.where(value.isNotNull() & F.col(label).isNotNull() & ~F.isnan(value)).select(
        F.col(group).cast("int").alias("g"), F.col(label).cast("int").alias("y"), value.alias("m"))
    return compared_gini(rows.mapInArrow(count, CELL_SCHEMA)).withColumnRenamed("g", group)


CELL_SCHEMA = "g long, range long, m binary, pos binary, neg binary"


def packed_cells(out: Sequence[tuple]) -> pa.RecordBatch:
    """Rows (group, range, m, pos, neg) of `cells` as a batch of `CELL_SCHEMA`."""
    columns = zip(*out) if out else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), *[pa.binary()] * 3))],
                                      ["g", "range", "m", "pos", "neg"])


def compared_gini(found: DataFrame) -> DataFrame:
    """(g, gini) of a table of `CELL_SCHEMA`: every (group, range) is compared by itself, ranges are added in order."""
    def compare(table: pa.Table) -> pa.Table:
        return pa.table({c: [v] for c, v in zip(("g", "range", "pos", "neg", "twice"), (
            table["g"][0].as_py(), table["range"][0].as_py(), *pairs(table)))})

    compared = found.groupBy("g", "range").applyInArrow(compare, "g long, range long, pos long, neg long, twice long")
    earlier = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    total = compared.withColumn("below", F.coalesce(F.sum("neg").over(earlier), F.lit(0)).cast("double")).groupBy("g").agg(
        F.sum(F.col("twice").cast("double") + F.lit(2.0) * F.col("pos") * F.col("below")).alias("num"),
        F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"))
    auc = F.try_divide(F.col("num"), F.lit(2.0) * F.col("p") * F.col("n"))
    return total.select(F.col("g").cast("int"), ((F.lit(2.0) * auc - F.lit(1.0)) * F.lit(100.0)).alias("gini"))


def score_bounds(df: DataFrame, score: str, n: int) -> np.ndarray:
    """Bounds that cut ``n`` scores into ranges of about `RANGE_ROWS`, from a sample of rows."""
    n_ranges = -(-n // RANGE_ROWS)
    if n_ranges <= 1:
        return np.empty(0)
    some = df.select(F.col(score).cast("double")).sample(min(1.0, max(2000, 50 * n_ranges) / n), seed=0).collect()
    values = np.sort([r[0] for r in some if r[0] is not None and r[0] == r[0]])
    return np.unique(values[np.arange(1, n_ranges) * len(values) // n_ranges]) if len(values) else np.empty(0)


def row_gini(df: DataFrame, score: str, label: str, by: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    """`gini` of scored rows for a few groups, as a small table: the scores are evaluated once (and once for a sample that
    cuts them into ranges), sorted in their tasks and compared by range."""
    spark, by = df.sparkSession, list(by)
    groups = [tuple(r) for r in df.groupBy(*by).count().collect()]
    schema = df.select(*by).schema if by else None
    number = F.lit(0)
    for k, g in enumerate(groups if by else []):
        here = F.lit(True)
        for c, v in zip(by, g):
            here = here & F.col(c).eqNullSafe(F.lit(v))
        number = F.when(here, F.lit(k)).otherwise(number)
    rows = df.select(number.alias("__g"), F.col(score).cast("double").alias("__m"), F.col(label).alias("__y"))
    bounds = score_bounds(rows, "__m", sum(g[-1] for g in groups))
    found = array_gini(rows, "__m", "__y", "__g", bounds).collect()
    out = [(*(groups[r["__g"]][:-1] if by else ()), r["gini"]) for r in found]
    fields = [*(schema.fields if by else []), T.StructField("gini", T.DoubleType())]
    table = spark.createDataFrame(out, T.StructType(fields))
    return table if digits is None else table.withColumn("gini", F.round("gini", digits))


def fold_ginis(df: DataFrame, score: str, label: str, fold: str) -> DataFrame:
    """(fold, gini_train, gini_test), unrounded, of a fixed score: one histogram per fold; what the other folds hold is the
    total of a score less the fold's own share."""
    hist = materialize(score_histogram(df, score, label, [fold]), "folds")
    total = hist.groupBy(score).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    folds = hist.select(fold).distinct()
    each = total.withColumn(fold, F.explode(F.lit([r[0] for r in folds.collect()])))     # scores x folds, k is configured
    both = each.join(hist, [score, fold], "left").na.fill(0, ["pos", "neg"])
    train = both.select(fold, score, F.lit("train").alias("part"), (F.col("all_pos") - F.col("pos")).alias("pos"),
                        (F.col("all_neg") - F.col("neg")).alias("neg"))
    test = hist.select(fold, score, F.lit("test").alias("part"), "pos", "neg")
    auc = auc_from_histogram(train.unionByName(test), score, [fold, "part"])
    g = (F.lit(2.0) * F.col("auc") - F.lit(1.0)) * F.lit(100.0)
    return auc.groupBy(fold).agg(F.max(F.when(F.col("part") == "train", g)).alias("gini_train"),
                                 F.max(F.when(F.col("part") == "test", g)).alias("gini_test"))


def feature_gini(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = (),
                 absolute: bool = True, n_buckets: int | None = None) -> DataFrame:
    """``|2*AUC - 1|`` of every feature at once (unpivot, one histogram, one pass); not scaled, not rounded."""
    long = unpivot_numeric(df, features, [*by, label])
    auc = auc_from_histogram(score_histogram(long, "value", label, [*by, "feature"]), "value", [*by, "feature"],
                             n_buckets)
    g = F.lit(2.0) * F.col("auc") - F.lit(1.0)
    return auc.select(*by, "feature", (F.abs(g) if absolute else g).alias("gini"))


def unpivot_numeric(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Long form ``(keep..., feature, value double)``; rows with a missing value are kept with NULL."""
    cols = [F.col(f).cast("double").alias(f) for f in features]
    return df.select(*keep, *cols).unpivot(list(keep), list(features), "feature", "value")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Counts of each class and the share of class 1."""
    y = F.col(label).cast("long")
    return df.agg(F.sum(F.when(y == 0, 1).otherwise(0)).cast("long").alias("n_neg"),
                  F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("n_pos"),
                  F.avg(y.cast("double")).alias("pos_share"))


def fold_median(metrics: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact, interpolating median of per-fold metrics."""
    return metrics.groupBy(*by).agg(*[F.percentile(c, 0.5).alias(f"median_{c}") for c in cols])


# ---------------------------------------------------------------------------------------------------------------------
# ROC points (W1), weights (W2) and tail compaction

def roc_points(df: DataFrame, features: Sequence[str], label: str, n_buckets: int | None = None,
               drop_intermediate: bool = True) -> DataFrame:
    """ROC per feature at each distinct value, descending, plus the sentinel point ``idx = 0`` (0, 0).

    Columns: feature, idx (0 = sentinel, then 1.. in descending value), value (NULL at the sentinel), tps, fps, tpr,
    fpr, mass (= (tps + fps) / n, the population share at or above the value), base_rate. An interior point whose next
    point has the same (pos, neg) increment lies on a straight line with its neighbours and is dropped, which is exactly
    the second-difference rule of the usual ROC thinning.
    """
    long = unpivot_numeric(df, features, [label])
    hist = score_histogram(long, "value", label, ["feature"])
    return roc_from_histogram(hist, n_buckets, drop_intermediate)


def roc_from_histogram(hist: DataFrame, n_buckets: int | None = None, drop_intermediate: bool = True) -> DataFrame:
    """ROC points from a histogram ``(feature, value, pos, neg)`` (one row per distinct value)."""
    hist, n_buckets = stored_histogram(hist, n_buckets)
    hist = hist.withColumn("__desc", -F.col("value"))
    hist = range_bucket(hist, ["feature"], ["__desc"], n_buckets)
    cum = running_sum(hist, ["feature"], ["__desc"], "__bucket", ["pos", "neg"], inclusive=True)
    totals = small_table(hist.groupBy("feature").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    pts = cum.join(totals, "feature")
    if drop_intermediate:
        nxt = next_in_order(pts, "feature", "__desc", "__bucket", ["pos", "neg"])
        first = (F.col("pos_cum") == F.col("pos")) & (F.col("neg_cum") == F.col("neg"))
        is_last = F.col("__next_pos").isNull()
        same_step = (F.col("__next_pos") == F.col("pos")) & (F.col("__next_neg") == F.col("neg"))
        pts = nxt.where(first | is_last | ~same_step)
    body = pts.select("feature", "value", "__desc", "__bucket",
                      F.col("pos_cum").alias("tps"), F.col("neg_cum").alias("fps"), "P", "N")
    body = body.withColumn("__one", F.lit(1).cast("long"))
    body = running_sum(body, ["feature"], ["__desc"], "__bucket", ["__one"], inclusive=True).withColumnRenamed(
        "__one_cum", "idx")
    sentinel = totals.select("feature", F.lit(0).cast("long").alias("idx"), F.lit(None).cast("double").alias("value"),
                             F.lit(0).cast("long").alias("tps"), F.lit(0).cast("long").alias("fps"), "P", "N")
    allp = body.select("feature", "idx", "value", "tps", "fps", "P", "N").unionByName(sentinel)
    return allp.select(
        "feature", "idx", "value", "tps", "fps",
        F.try_divide(F.col("tps"), F.col("P")).alias("tpr"), F.try_divide(F.col("fps"), F.col("N")).alias("fpr"),
        ((F.col("tps") + F.col("fps")) / (F.col("P") + F.col("N"))).alias("mass"),
        (F.col("P") / (F.col("P") + F.col("N"))).alias("base_rate"))


def roc_weights(points: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Population mass between successive ROC points, ``br*dTPR + (1-br)*dFPR``; telescopes to ``mass``. The point before
    is found range by range, so no task sees all points of a feature."""
    points, n_buckets = stored_histogram(points, n_buckets)
    before = next_in_order(range_bucket(points, ["feature"], ["idx"], n_buckets), "feature", "idx", "__bucket", ["mass"],
                           back=True)
    return before.select(*points.columns, (F.col("mass") - F.coalesce("__next_mass", F.lit(0.0))).alias("weight"))


def edge_compaction(points: DataFrame, min_size: float) -> DataFrame:
    """Keep the sentinel, the last point and every interior point with mass from the start > min_size and mass to the
    end > min_size (strict), i.e. the net effect of merging the thin tails of the ROC into one segment each."""
    last = small_table(points.groupBy("feature").agg(F.max("idx").alias("__last")))
    p = points.join(last, "feature")
    keep = ((F.col("idx") == 0) | (F.col("idx") == F.col("__last"))
            | ((F.col("mass") > F.lit(min_size)) & ((F.lit(1.0) - F.col("mass")) > F.lit(min_size))))
    return p.where(keep).drop("__last")


# ---------------------------------------------------------------------------------------------------------------------
# Bootstrap bands (A10)

BLOCK_SCHEMA = "replicate long, block int, pos double, neg double, inner double"


def bootstrap_gini(df: DataFrame, score: str, label: str, n_bs: int = 2000, seed: int = 19,
                   n_buckets: int | None = None, chunk: int = 100) -> tuple[DataFrame, DataFrame]:
    """Poisson bootstrap of the Gini: returns (replicates, band).

    AUC depends on the rows only through the histogram ``(score, label) -> count``, and with an independent Poisson(1)
    weight per row a cell of c rows weighs Poisson(c). The histogram is cut into blocks of consecutive scores; each block
    draws all replicates and returns their class totals and the concordance inside the block, so the output is replicates
    x blocks. A prefix over the blocks of a replicate adds the concordance between blocks. The same draw at any size.
    Band = sorted replicate Ginis at 0-based positions ``int(n_bs*0.025)`` and ``int(n_bs*0.975)``."""
    hist, n_buckets = stored_histogram(score_histogram(df, score, label), n_buckets)
    hist = hist.select(F.col(score).cast("double").alias("score"), "pos", "neg")
    size = -(-hist.count() // n_buckets) or 1          # blocks by rank: the same at every run
    blocks = exact_rank(hist, [], ["score"], out="rank", n_buckets=n_buckets).select(
        "score", "pos", "neg", F.expr(f"cast((rank - 1) div {size} as int)").alias("block"))

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("score")
        p, q = pdf["pos"].to_numpy(np.float64), pdf["neg"].to_numpy(np.float64)
        block = int(pdf["block"].iloc[0])
        out = []
        for first in range(0, n_bs, chunk):
            reps = np.arange(first, min(n_bs, first + chunk))
            rng = np.random.default_rng([seed, block, first])
            pp = rng.poisson(p, size=(len(reps), len(p))).astype(np.float64)
            qq = rng.poisson(q, size=(len(reps), len(q))).astype(np.float64)
            inner = (pp * (np.cumsum(qq, axis=1) - qq / 2.0)).sum(axis=1)
            out.append(pd.DataFrame({"replicate": reps, "block": block, "pos": pp.sum(axis=1), "neg": qq.sum(axis=1),
                                     "inner": inner}))
        return pd.concat(out)

    drawn = blocks.groupBy("block").applyInPandas(draw, BLOCK_SCHEMA)
    earlier = Window.partitionBy("replicate").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = drawn.withColumn("below", F.coalesce(F.sum("neg").over(earlier), F.lit(0.0))).groupBy("replicate").agg(
        F.sum(F.col("inner") + F.col("pos") * F.col("below")).alias("num"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    auc = F.try_divide(F.col("num"), F.col("p") * F.col("n"))
    reps = materialize(total.select("replicate", ((F.lit(2.0) * auc - F.lit(1.0)) * F.lit(100.0)).alias("gini")),
                       "replicates")
    return reps, bootstrap_band(reps, n_bs)


def bootstrap_band(replicates: DataFrame, n_bs: int) -> DataFrame:
    """Order statistics of the replicate Ginis (0-based ``int(n*0.025)``, ``int(n*0.975)``), rounded to 2 digits.

    n_bs is a configured count (thousands), so the single ordered window over the replicate table is bounded."""
    lo, hi = int(n_bs * 0.025) + 1, int(n_bs * 0.975) + 1
    ranked = replicates.withColumn("__r", F.row_number().over(Window.orderBy("gini", "replicate")))
    return ranked.agg(F.round(F.max(F.when(F.col("__r") == lo, F.col("gini"))), 2).alias("gini_low"),
                      F.round(F.max(F.when(F.col("__r") == hi, F.col("gini"))), 2).alias("gini_upp"))
