"""Registered queries: each pairs a Spark plan over the driver tables with an independent DuckDB SQL text.

Every query starts from the whole ``scoring_sample`` view (lineitem x orders x customer x part), so its work grows with
the tables. Names of result columns are identical on both sides; doubles are rounded to 6 digits (Gini to 2).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.functions.dates import report_dates
from giniflow.functions.hashing import duck_hash
from giniflow.operators import metrics, reports, sampling
from giniflow.plans.oracle import gini_sql, with_fixture
from giniflow.session import materialize
from giniflow.sources.fixture import FIXTURE_COLUMNS, FIXTURE_SPEC, FIXTURE_SPLIT, scoring_sample

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        CATALOG[name] = Entry(fn, sql)
        return fn
    return deco


KEY, DATE, Y = FIXTURE_SPEC.key, FIXTURE_SPEC.date_col, FIXTURE_SPEC.target
SEED = FIXTURE_SPLIT.seed
OOT_DATES = report_dates(list(FIXTURE_SPLIT.oot))          # [2001-12-31]
OOT_SQL = ", ".join(f"DATE '{d.isoformat()}'" for d in OOT_DATES)
NUMERIC = list(FIXTURE_SPEC.numeric)
CATEGORICAL = list(FIXTURE_SPEC.categorical)


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring sample, lazy: Catalyst prunes the joins to the columns of each query; operators that read a narrow
    projection several times keep that projection only."""
    return scoring_sample(spark, sf_dir)


def pools(spark: SparkSession, sf_dir: str, sampler: str = "NONE", frac: float = 0.25, columns: Sequence[str] = FIXTURE_COLUMNS
          ) -> DataFrame:
    """The four pools with the key, the date and ``columns``, stored: the joins of the sample run once."""
    rows = sample(spark, sf_dir).select(*dict.fromkeys([KEY, DATE, *columns]))
    return sampling.four_pools(rows, KEY, DATE, OOT_DATES, "ALL", FIXTURE_SPLIT.test_size,
                               FIXTURE_SPLIT.valid_size, SEED, label=Y, sampler=sampler, frac=frac)


POOLS_CTE = f"""
_dev AS (SELECT *, {duck_hash('epk_id', f'test-{SEED}')} AS _ht FROM scoring_sample
         WHERE report_dt NOT IN ({OOT_SQL}) OR report_dt IS NULL),
_t AS (SELECT *, row_number() OVER (ORDER BY _ht, epk_id) AS _rn, count(*) OVER () AS _n FROM _dev),
_rest AS (SELECT * EXCLUDE (_ht, _rn, _n), {duck_hash('epk_id', f'valid-{SEED}')} AS _hv
          FROM _t WHERE _rn > ceil(CAST({FIXTURE_SPLIT.test_size} AS DOUBLE) * _n)),
_v AS (SELECT *, row_number() OVER (ORDER BY _hv, epk_id) AS _rn, count(*) OVER () AS _n FROM _rest),
pools AS (
  SELECT * EXCLUDE (_ht, _rn, _n), 'TEST' AS pool FROM _t WHERE _rn <= ceil(CAST({FIXTURE_SPLIT.test_size} AS DOUBLE) * _n)
  UNION ALL
  SELECT * EXCLUDE (_hv, _rn, _n),
         CASE WHEN _rn <= ceil(CAST({FIXTURE_SPLIT.valid_size} AS DOUBLE) * _n) THEN 'VALID' ELSE 'TRAIN' END FROM _v
  UNION ALL
  SELECT *, 'OOT' FROM scoring_sample WHERE report_dt IN ({OOT_SQL})
)"""


# ---------------------------------------------------------------------------------------------------------------------
# Fixture, report, Gini

@register("scoring_sample", with_fixture("SELECT * FROM scoring_sample"))
def q_scoring_sample(spark, sf_dir):
    return sample(spark, sf_dir).select(*FIXTURE_COLUMNS)


@register("period_report", with_fixture(f"""
SELECT CASE WHEN grouping(report_dt) = 1 THEN 'TOTAL' ELSE CAST(report_dt AS VARCHAR) END AS period,
       CAST(CASE WHEN grouping(report_dt) = 1 THEN count(*) ELSE count({Y}) END AS BIGINT) AS volume,
       CAST(sum({Y}) AS BIGINT) AS n_response,
       round(avg(CAST({Y} AS DOUBLE)), 6) AS trg_rate
FROM scoring_sample GROUP BY GROUPING SETS ((report_dt), ())"""))
def q_period_report(spark, sf_dir):
    return reports.period_report(sample(spark, sf_dir), DATE, Y)


@register("gini_by_date", with_fixture(gini_sql("scoring_sample", "quantity", Y, ["report_dt"])))
def q_gini_by_date(spark, sf_dir):
    return metrics.gini(sample(spark, sf_dir), "quantity", Y, by=[DATE])


@register("gini_by_pool", with_fixture(gini_sql("pools", "discount", Y, ["pool"]), POOLS_CTE))
def q_gini_by_pool(spark, sf_dir):
    return metrics.gini(pools(spark, sf_dir, columns=["discount", Y]), "discount", Y, by=["pool"])


@register("feature_gini", with_fixture(
    gini_sql("_long", "value", Y, ["feature"], digits=6, scale=1.0, absolute=True),
    "_long AS (UNPIVOT (SELECT " + Y + ", " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
    + " FROM scoring_sample) ON " + ", ".join(NUMERIC) + " INTO NAME feature VALUE value)"))
def q_feature_gini(spark, sf_dir):
    g = metrics.feature_gini(sample(spark, sf_dir), NUMERIC, Y)
    return g.select("feature", F.round("gini", 6).alias("gini"))


@register("class_counts", with_fixture(f"""
SELECT CAST(sum(CASE WHEN {Y} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
       CAST(sum(CASE WHEN {Y} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       round(avg(CAST({Y} AS DOUBLE)), 6) AS pos_share FROM scoring_sample"""))
def q_class_counts(spark, sf_dir):
    c = metrics.class_counts(sample(spark, sf_dir), Y)
    return c.select("n_neg", "n_pos", F.round("pos_share", 6).alias("pos_share"))


# ---------------------------------------------------------------------------------------------------------------------
# Splits and resampling

@register("four_pools", with_fixture(f"""
SELECT pool, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum({Y}) AS BIGINT) AS n_pos,
       CAST(count(DISTINCT epk_id) AS BIGINT) AS n_keys
FROM pools GROUP BY pool""", POOLS_CTE))
def q_four_pools(spark, sf_dir):
    return pools(spark, sf_dir, columns=[Y]).groupBy("pool").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(Y).cast("long").alias("n_pos"),
        F.count_distinct(KEY).alias("n_keys"))


@register("pool_members", with_fixture("SELECT epk_id, pool FROM pools", POOLS_CTE))
def q_pool_members(spark, sf_dir):
    return pools(spark, sf_dir, columns=[]).select(KEY, "pool")


@register("split_holdout", with_fixture(f"""
SELECT epk_id, row_number() OVER (ORDER BY {duck_hash('epk_id', f'holdout-{SEED}')}, epk_id)
               <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS holdout
FROM scoring_sample"""))
def q_split_holdout(spark, sf_dir):
    return sampling.split_holdout(sample(spark, sf_dir), 0.2, KEY, SEED).select(KEY, "holdout")


@register("sample_rows", with_fixture(f"""
SELECT epk_id, {Y} FROM (
  SELECT *, row_number() OVER (ORDER BY {duck_hash('epk_id', f'sample-{SEED}')}, epk_id) AS _rn,
         count(*) OVER () AS _n FROM scoring_sample)
WHERE _rn <= round_even(CAST(0.5 AS DOUBLE) * _n, 0)"""))
def q_sample_rows(spark, sf_dir):
    return sampling.sample_rows(sample(spark, sf_dir), 0.5, KEY, SEED).select(KEY, Y)


def _under_sql(frac: float) -> str:
    ratio = frac / (1.0 - frac)
    return with_fixture(f"""
SELECT epk_id, {Y} FROM (
  SELECT *, row_number() OVER (PARTITION BY {Y} ORDER BY {duck_hash('epk_id', f'under-{SEED}')}, epk_id) AS _rn,
         sum(CASE WHEN {Y} = 1 THEN 1 ELSE 0 END) OVER () AS _nmin
  FROM scoring_sample)
WHERE {Y} = 1 OR _rn <= floor(_nmin / CAST({ratio!r} AS DOUBLE))""")


@register("undersample", _under_sql(0.25))
def q_undersample(spark, sf_dir):
    return sampling.undersample(sample(spark, sf_dir), Y, 0.25, KEY, SEED).select(KEY, Y)


@register("oversample", with_fixture(f"""
SELECT epk_id, {Y} FROM scoring_sample
UNION ALL
SELECT m.epk_id, m.{Y}
FROM (SELECT unnest(range(CAST(floor(n_maj * CAST({(0.25 / 0.75)!r} AS DOUBLE) - n_min) AS BIGINT))) AS j, n_min
      FROM (SELECT sum(CASE WHEN {Y} = 1 THEN 1 ELSE 0 END) AS n_min,
                   sum(CASE WHEN {Y} = 0 THEN 1 ELSE 0 END) AS n_maj FROM scoring_sample)) d
JOIN (SELECT epk_id, {Y}, row_number() OVER (ORDER BY {duck_hash('epk_id', f'overrow-{SEED}')}, epk_id) AS rn
      FROM scoring_sample WHERE {Y} = 1) m
  ON m.rn = ('0x'||substr(md5(CAST(j AS VARCHAR)||':over-{SEED}'),1,15))::BIGINT % d.n_min + 1"""))
def q_oversample(spark, sf_dir):
    return sampling.oversample(materialize(sample(spark, sf_dir).select(KEY, Y), "sample"), Y, 0.25, KEY, SEED)


@register("stratified_folds", with_fixture(f"""
SELECT epk_id, {Y}, CAST((_rn * 5 + _n - 1) // _n - 1 AS INTEGER) AS fold FROM (
  SELECT epk_id, {Y}, row_number() OVER (PARTITION BY {Y} ORDER BY {duck_hash('epk_id', f'fold-{SEED}')}, epk_id) AS _rn,
         count(*) OVER (PARTITION BY {Y}) AS _n FROM scoring_sample)"""))
def q_stratified_folds(spark, sf_dir):
    return sampling.stratified_folds(sample(spark, sf_dir), Y, 5, KEY, SEED).select(KEY, Y, "fold")


@register("oot_subsample", with_fixture(f"""
SELECT pool, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY pool ORDER BY {duck_hash('epk_id', f'oot-{SEED}')}, epk_id) AS _rn,
         count(*) OVER (PARTITION BY pool) AS _n FROM pools)
WHERE pool <> 'OOT' OR _rn <= round_even(CAST(0.25 AS DOUBLE) * _n, 0)
GROUP BY pool""", POOLS_CTE))
def q_oot_subsample(spark, sf_dir):
    p = sampling.oot_subsample(pools(spark, sf_dir, columns=[]), 0.25, KEY, SEED)
    return p.groupBy("pool").agg(F.count(F.lit(1)).alias("n_rows"))
