"""The scoring-sample view over the driver tables (lineitem x orders x customer x part), one row per line item.

The driver tables carry no signal, so a logistic target, missing values and a near-copy column are planted with a hash
of the row key (see FIXTURES.md section 2). The joins are plain equi-joins: Catalyst prunes every table to the needed
columns at the parquet scan and AQE chooses broadcast or sort-merge from the measured sizes at run time, so the same plan
holds from 6,000 rows to a cluster-sized lineitem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.functions.hashing import row_hash, row_uniform
from giniflow.spec import SampleSpec, SplitConfig

FIXTURE_SPEC = SampleSpec(
    key="epk_id",
    date_col="report_dt",
    target="trg_flag",
    numeric=("quantity", "discount", "tax", "price", "quantity_x", "acct_bal", "part_size", "tax_sparse"),
    categorical=("brand_cd", "client_segm", "priority_group"),
)

# OOT token FEB/02 maps to 2001-12-31; DEV is every other date.
FIXTURE_SPLIT = SplitConfig(oot=("FEB/02",), dev="ALL", test_size=0.2, valid_size=0.25, seed=19)

FIXTURE_COLUMNS = ["epk_id", "report_dt", "trg_flag", *FIXTURE_SPEC.numeric, *FIXTURE_SPEC.categorical]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_TASK = 500_000     # line items that a task of the first join sorts


def spread(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hash-partition a scan on its join key, in partitions of about ``rows_per_task`` rows, so that a task of the join sorts
    as many rows at any size (the count reads the files' footers). Small inputs are dealt over the cluster when they
    yield fewer splits than it can run, else left to the planner."""
    target = df.sparkSession.sparkContext.defaultParallelism
    n = -(-df.count() // rows_per_task)
    if n > target:
        return df.repartition(n, key)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key)


def _logit() -> Column:
    segment = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit(0.9))
               .when(F.col("c_mktsegment") == "MACHINERY", F.lit(-0.6)).otherwise(F.lit(0.0)))
    return (F.lit(-2.2) + F.lit(0.06) * (F.col("l_quantity") - F.lit(25))
            - F.lit(20.0) * (F.col("l_discount") - F.lit(0.05)) + segment)


def scoring_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice"),
        "l_orderkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    # the customer of an order is joined on the orders, a quarter of the rows, so line items move for two joins only
    joined = (li.join(od.join(cu, od.o_custkey == cu.c_custkey), li.l_orderkey == od.o_orderkey)
              .join(pa, li.l_partkey == pa.p_partkey))
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                      F.col("l_quantity").cast("bigint").cast("string"))
    with_key = joined.withColumn("epk_id", key)
    h = lambda s: row_hash("epk_id", s)
    return with_key.select(
        "epk_id",
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-12-31")).cast("date").alias("report_dt"),
        (row_uniform("epk_id", 19) < F.lit(1.0) / (F.lit(1.0) + F.exp(-_logit()))).cast("int").alias("trg_flag"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") + (h(41) % 1000) / F.lit(100.0)).alias("quantity_x"),
        F.when(h(23) % 40 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("acct_bal"),
        F.when(h(29) % 5 == 0, F.lit(None).cast("int")).otherwise(F.col("p_size")).alias("part_size"),
        F.when(h(31) % 100 < 97, F.lit(None).cast("double")).otherwise(F.col("l_tax")).alias("tax_sparse"),
        F.col("p_brand").alias("brand_cd"),
        F.when(h(37) % 25 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("client_segm"),
        F.col("o_orderpriority").alias("priority_group"),
    )
