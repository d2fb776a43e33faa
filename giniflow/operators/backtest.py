"""Expanding-date backtest.

For the i-th report date (i >= 2) the DEV part is every earlier date and the OOT part is that date. The date list is a
small table (one row per report date); its pairs come from an ordered window over that table, never from a join of the
data with itself. Rows are then assigned to steps by an equi-join on the date with the (broadcast, size-checked) pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from giniflow.operators import metrics
from giniflow.operators.prefix import small_table


def date_pairs(df: DataFrame, date_col: str) -> DataFrame:
    """(oot_dt, dev_dt) for every date and each earlier date."""
    dates = small_table(df.select(date_col).where(F.col(date_col).isNotNull()).distinct())
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    earlier = dates.select(F.col(date_col).alias("oot_dt"), F.collect_list(date_col).over(w).alias("__dev"))
    return earlier.select("oot_dt", F.explode("__dev").alias("dev_dt"))


def expanding_backtest(df: DataFrame, date_col: str) -> DataFrame:
    """Rows tagged with (oot_dt, role): role DEV for each later step, OOT for their own date (from the 2nd date on)."""
    pairs = small_table(date_pairs(df, date_col))
    first = pairs.agg(F.min("dev_dt")).first()[0]
    dev = df.join(pairs, df[date_col] == pairs["dev_dt"]).drop("dev_dt").withColumn("role", F.lit("DEV"))
    oot = df.where(F.col(date_col) > F.lit(first)).withColumn("oot_dt", F.col(date_col)).withColumn("role",
                                                                                                   F.lit("OOT"))
    return dev.unionByName(oot)


def backtest_gini(df: DataFrame, date_col: str, score: str, label: str) -> DataFrame:
    """(report_dt, dev, oot): unrounded Gini of a score per step. Rows are compressed to one histogram per date first, and
    the histogram is expanded to the steps."""
    hist = metrics.score_histogram(df, score, label, [date_col])
    tagged = expanding_backtest(hist, date_col).groupBy("oot_dt", "role", score).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    auc = metrics.auc_from_histogram(tagged, score, ["oot_dt", "role"])
    g = auc.select("oot_dt", "role", ((F.lit(2.0) * F.col("auc") - F.lit(1.0)) * F.lit(100.0)).alias("gini"))
    return g.groupBy(F.col("oot_dt").alias("report_dt")).agg(
        F.max(F.when(F.col("role") == "DEV", F.col("gini"))).alias("dev"),
        F.max(F.when(F.col("role") == "OOT", F.col("gini"))).alias("oot"))


def backtest_models(df: DataFrame, date_col: str, fit_and_score: Callable[[DataFrame, DataFrame], DataFrame],
                    threads: int = 4) -> DataFrame:
    """M7 backtest with a refit per step: ``fit_and_score(dev_rows, oot_rows)`` returns (role, gini) for one step.
    Steps are independent; each is its own set of Spark jobs, and ``threads`` of them are submitted at once."""
    dates = [r[0] for r in df.select(date_col).where(F.col(date_col).isNotNull()).distinct().orderBy(date_col)
             .collect()]

    def step(date) -> DataFrame:
        dev = df.where(F.col(date_col) < F.lit(date))
        oot = df.where(F.col(date_col) == F.lit(date))
        return fit_and_score(dev, oot).groupBy().agg(
            F.max(F.when(F.col("role") == "DEV", F.col("gini"))).alias("dev"),
            F.max(F.when(F.col("role") == "OOT", F.col("gini"))).alias("oot")).select(
            F.lit(date).alias("report_dt"), "dev", "oot")

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        parts = list(pool.map(step, dates[:0:-1]))[::-1]       # the longest step first
    out = None
    for g in parts:
        out = g if out is None else out.unionByName(g)
    return out
