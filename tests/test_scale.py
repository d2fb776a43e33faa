"""Work that must not grow by passes: inputs are evaluated once, line items move for two joins, ranges do not change an AUC."""

import datetime as dt

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from giniflow.operators import binning, models, sampling
from giniflow.sources.fixture import scoring_sample

from tests.conftest import SF_SMALL


def counted(spark, df):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def mark(x):
        seen.add(1)
        return x
    return df.withColumn("c", mark("c")), seen


def rows(spark, n=200):
    date = F.when(F.col("id") % 5 == 0, F.lit(dt.date(2001, 12, 31))).otherwise(F.lit(dt.date(2000, 12, 31)))
    return spark.range(n).select(F.col("id").cast("string").alias("k"), date.alias("d"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                 F.concat(F.lit("v"), F.col("id") % 7).alias("c"))


def test_four_pools_evaluates_its_rows_once(spark):
    df, seen = counted(spark, rows(spark))
    p = sampling.four_pools(df, "k", "d", [dt.date(2001, 12, 31)])
    assert p.where("pool = 'TRAIN'").select("c").distinct().count() == 7
    sizes = {r["pool"]: r["n"] for r in p.groupBy("pool").agg(F.count("c").alias("n")).collect()}
    assert sizes == {"OOT": 40, "TEST": 32, "VALID": 32, "TRAIN": 96} and seen.value == 200


def test_category_counts_evaluate_their_rows_once(spark):
    df, seen = counted(spark, rows(spark))
    stats = binning.category_stats(df, ["c"], "y")
    assert binning.merge_categories_spark(stats, 0.05, 4).count() == 7 and stats.agg(F.sum("n_total")).first()[0] == 200
    assert seen.value == 200


def test_line_items_take_part_in_two_joins(spark):
    plan = scoring_sample(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    at = next(i for i, line in enumerate(plan) if "Relation" in line and "l_orderkey" in line)
    above, joins = depth[at], 0
    for i in range(at, -1, -1):
        if depth[i] < above:
            above, joins = depth[i], joins + (plan[i].lstrip(" :+-").startswith("Join"))
    assert joins == 2


def test_ranges_do_not_change_staged_auc(spark):
    num = ["x", "z"]
    d = spark.range(3000).select((F.hash("id") % 100).cast("double").alias("x"), (F.hash("id", F.lit(1)) % 50).cast("double").alias("z"),
                                 F.col("id").alias("id"))
    d = d.withColumn("y", (F.col("x") + F.col("z") + F.hash("id", F.lit(2)) % 90 > 0).cast("int"))
    full = models.fit(d, num, [], "y", "GBT", {"n_iter": 5})
    v = PipelineModel(stages=full.model.stages[:-1]).transform(models.prepare(d, num, [], "y")).select("features", "label")
    one, many = (models.staged_auc(full.model.stages[-1], v, range_rows=r) for r in (10_000, 100))
    assert one == many and len(set(one)) == 5 and not np.isnan(one).any()


def test_join_partitions_follow_the_rows(spark):
    from giniflow.sources.fixture import spread
    d = spark.range(0, 12_000, 1, 2).withColumnRenamed("id", "k")
    assert spread(d, "k", rows_per_task=1000).rdd.getNumPartitions() == max(12, spark.sparkContext.defaultParallelism)
    assert spread(d, "k", rows_per_task=500).rdd.getNumPartitions() == 24
