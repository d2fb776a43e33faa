"""Registered queries for projections, cleaning, dates, encoders, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from giniflow.functions.dates import MONTHS, report_date_col
from giniflow.functions.hashing import duck_hash, row_hash
from giniflow.operators import encode, prep, sampling
from giniflow.plans.catalog import (CATEGORICAL, DATE, KEY, NUMERIC, OOT_DATES, OOT_SQL, POOLS_CTE, SEED, Y, pools,
                                    register, sample)
from giniflow.plans.oracle import with_fixture
from giniflow.sources.fixture import table


@register("drop_columns", with_fixture(
    "SELECT * EXCLUDE (quantity, quantity_x, tax, price) FROM scoring_sample"))
def q_drop_columns(spark, sf_dir):
    d = prep.drop_prefix(sample(spark, sf_dir), "quantity")
    return prep.drop_listed(d, ["tax", "price", "not_a_column"])


@register("normalize_categories", with_fixture(
    "SELECT epk_id, " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan') AS {c}" for c in CATEGORICAL)
    + " FROM scoring_sample"))
def q_normalize_categories(spark, sf_dir):
    return prep.normalize_categories(sample(spark, sf_dir).select(KEY, *CATEGORICAL), CATEGORICAL)


RATIO_SQL = (f"CASE WHEN discount = 0 THEN CASE WHEN {duck_hash('epk_id', 43)} % 2 = 0 THEN CAST('inf' AS DOUBLE) "
             f"ELSE CAST('-inf' AS DOUBLE) END ELSE quantity / discount END")


def _ratio(df):
    inf = float("inf")
    r = F.when(F.col("discount") == 0,
               F.when(row_hash(KEY, 43) % 2 == 0, F.lit(inf)).otherwise(F.lit(-inf))
               ).otherwise(F.col("quantity") / F.col("discount"))
    return df.select(KEY, r.alias("ratio"))


@register("clip_infinite", with_fixture(f"""
SELECT epk_id, round(CASE WHEN ratio = CAST('inf' AS DOUBLE) THEN hi + 1
                          WHEN ratio = CAST('-inf' AS DOUBLE) THEN lo - 1 ELSE ratio END, 6) AS ratio
FROM (SELECT epk_id, {RATIO_SQL} AS ratio FROM scoring_sample),
     (SELECT max(r) AS hi, min(r) AS lo FROM (SELECT {RATIO_SQL} AS r FROM scoring_sample)
      WHERE r NOT IN (CAST('inf' AS DOUBLE), CAST('-inf' AS DOUBLE)))"""))
def q_clip_infinite(spark, sf_dir):
    d = prep.clip_infinite(_ratio(sample(spark, sf_dir)), ["ratio"])
    return d.select(KEY, F.round("ratio", 6).alias("ratio"))


@register("drop_incomplete", with_fixture(
    "SELECT epk_id, acct_bal, part_size FROM scoring_sample WHERE acct_bal IS NOT NULL AND part_size IS NOT NULL"))
def q_drop_incomplete(spark, sf_dir):
    return prep.drop_incomplete(sample(spark, sf_dir).select(KEY, "acct_bal", "part_size"), ["acct_bal", "part_size"])


@register("missing_profile", with_fixture(
    "SELECT feature, CAST(n_missing AS BIGINT) AS n_missing, round(n_missing / n, 6) AS share_missing, "
    "n_missing > (1 - 0.05) * n AS skipped, n_missing > 0.05 * n AS big_missing FROM ("
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_missing, count(*) AS n "
                           f"FROM scoring_sample" for c in NUMERIC + CATEGORICAL) + ")"))
def q_missing_profile(spark, sf_dir):
    return prep.missing_profile(sample(spark, sf_dir), NUMERIC + CATEGORICAL, 0.05)


MONTH_LIST = "[" + ", ".join(f"'{m.upper()}'" for m in MONTHS) + "]"


@register("report_dates", with_fixture(f"""
SELECT token, last_day(CAST(make_date(2000 + CAST(split_part(token, '/', 2) AS INTEGER),
                                      list_position({MONTH_LIST}, split_part(token, '/', 1)), 1)
                            - INTERVAL 2 MONTH AS DATE)) AS report_dt
FROM (SELECT DISTINCT upper(strftime(o_orderdate, '%b/%y')) AS token FROM orders)"""))
def q_report_dates(spark, sf_dir):
    tokens = table(spark, sf_dir, "orders").select(F.upper(F.date_format("o_orderdate", "MMM/yy")).alias("token"))
    return tokens.distinct().select("token", report_date_col("token").alias("report_dt"))


@register("distinct_dates", with_fixture("SELECT DISTINCT report_dt FROM scoring_sample WHERE report_dt IS NOT NULL"))
def q_distinct_dates(spark, sf_dir):
    return prep.distinct_dates(sample(spark, sf_dir), DATE)


@register("dates_except", with_fixture(
    f"SELECT DISTINCT report_dt FROM scoring_sample WHERE report_dt IS NOT NULL AND report_dt NOT IN ({OOT_SQL})"))
def q_dates_except(spark, sf_dir):
    oot = spark.createDataFrame([(d,) for d in OOT_DATES], "report_dt date")
    return prep.dates_except(sample(spark, sf_dir), DATE, oot)


@register("dates_semi_anti", with_fixture(f"""
SELECT 'OOT' AS part, CAST(count(*) AS BIGINT) AS n_rows FROM scoring_sample WHERE report_dt IN ({OOT_SQL})
UNION ALL
SELECT 'DEV', CAST(count(*) AS BIGINT) FROM scoring_sample WHERE report_dt NOT IN ({OOT_SQL}) OR report_dt IS NULL"""))
def q_dates_semi_anti(spark, sf_dir):
    from giniflow.operators.joins import dates_anti, dates_semi
    df = sample(spark, sf_dir)
    semi = dates_semi(df, DATE, OOT_DATES).agg(F.count(F.lit(1)).alias("n_rows"))
    anti = dates_anti(df, DATE, OOT_DATES).agg(F.count(F.lit(1)).alias("n_rows"))
    return semi.select(F.lit("OOT").alias("part"), "n_rows").unionByName(
        anti.select(F.lit("DEV").alias("part"), "n_rows"))


@register("category_values", with_fixture(" UNION ".join(
    f"SELECT DISTINCT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM scoring_sample"
    for c in CATEGORICAL)))
def q_category_values(spark, sf_dir):
    return encode.category_long(sample(spark, sf_dir), CATEGORICAL).distinct()


@register("distinct_count", with_fixture(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM scoring_sample"
    for c in NUMERIC)))
def q_distinct_count(spark, sf_dir):
    from giniflow.operators.metrics import unpivot_numeric
    long = unpivot_numeric(sample(spark, sf_dir), NUMERIC, [])
    return long.groupBy("feature").agg(F.count_distinct("value").alias("n_distinct"))


TRAIN_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM pools WHERE pool = 'TRAIN'"
    for c in CATEGORICAL)
FREQ_CTE = POOLS_CTE + f""",
_freq AS (SELECT feature, category, CASE WHEN category = 'nan' THEN -1 ELSE
                 CAST(row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, category) AS INTEGER) END AS code
          FROM ({TRAIN_LONG}) GROUP BY feature, category)"""


def _train(spark, sf_dir):
    return pools(spark, sf_dir, columns=CATEGORICAL).where(F.col("pool") == "TRAIN")


@register("frequency_codes", with_fixture("SELECT feature, category, code FROM _freq", FREQ_CTE))
def q_frequency_codes(spark, sf_dir):
    c = encode.frequency_codes(_train(spark, sf_dir), CATEGORICAL)
    return c.select("feature", "category", F.col("code").cast("int").alias("code"))


@register("ordinal_codes", with_fixture(f"""
SELECT feature, category, CASE WHEN category = 'nan' THEN -1 ELSE
       CAST(row_number() OVER (PARTITION BY feature ORDER BY category) AS INTEGER) END AS code
FROM (SELECT DISTINCT feature, category FROM ({TRAIN_LONG}))""", POOLS_CTE))
def q_ordinal_codes(spark, sf_dir):
    c = encode.ordinal_codes(_train(spark, sf_dir), CATEGORICAL)
    return c.select("feature", "category", F.col("code").cast("int").alias("code"))


@register("apply_codes", with_fixture(
    "SELECT p.epk_id, p.pool, " + ", ".join(
        f"(SELECT code FROM _freq f WHERE f.feature = '{c}' AND f.category = coalesce(CAST(p.{c} AS VARCHAR), 'nan'))"
        f" AS {c}" for c in CATEGORICAL) + " FROM pools p WHERE p.pool IN ('TEST', 'OOT')", FREQ_CTE))
def q_apply_codes(spark, sf_dir):
    p = pools(spark, sf_dir, columns=CATEGORICAL)
    codes = encode.frequency_codes(p.where(F.col("pool") == "TRAIN"), CATEGORICAL)
    rest = p.where(F.col("pool").isin("TEST", "OOT")).select(KEY, "pool", *CATEGORICAL)
    out = encode.apply_codes(rest, codes, CATEGORICAL)
    return out.select(KEY, "pool", *[F.col(c).cast("int").alias(c) for c in CATEGORICAL])


ONE_HOT = ["priority_group", "client_segm"]
# The order-priority and market-segment domains of the driver tables, plus the missing marker.
ONE_HOT_VALUES = {"priority_group": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                  "client_segm": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "nan"]}


@register("one_hot", with_fixture("SELECT epk_id, " + ", ".join(
    f"CAST(coalesce(CAST({c} AS VARCHAR), 'nan') = '{v}' AS INTEGER) AS \"{c}_{v}\""
    for c in ONE_HOT for v in ONE_HOT_VALUES[c]) + " FROM scoring_sample"))
def q_one_hot(spark, sf_dir):
    df = sample(spark, sf_dir)
    return encode.one_hot(df, df.select(KEY, *ONE_HOT), ONE_HOT)


@register("align_labels", with_fixture(
    f"SELECT epk_id, {Y}, quantity, discount FROM scoring_sample"))
def q_align_labels(spark, sf_dir):
    df = sample(spark, sf_dir)
    from giniflow.operators.joins import align_labels
    return align_labels(df.select(KEY, "quantity", "discount"), df.select(KEY, Y), KEY)


@register("grid_cells", with_fixture(f"""
SELECT model, sampler, CAST(frac AS INTEGER) AS frac,
       model || CASE WHEN sampler = 'ORIG' THEN '' ELSE '_' || sampler || '_' || CAST(frac AS VARCHAR) || '%' END AS label,
       sampler = 'ORIG' OR CAST(frac AS DOUBLE) / 100 >= share AS feasible
FROM (VALUES ('GBT'), ('RF'), ('LR')) m(model),
     (VALUES ('ORIG', 0), ('US', 5), ('US', 20), ('US', 25), ('US', 50), ('OS', 25)) s(sampler, frac),
     (SELECT avg(CAST({Y} AS DOUBLE)) AS share FROM scoring_sample)"""))
def q_grid_cells(spark, sf_dir):
    from giniflow.plans.stages import grid_cells
    share = sample(spark, sf_dir).agg(F.avg(F.col(Y).cast("double")).alias("s")).first()["s"]
    return grid_cells(spark, ["GBT", "RF", "LR"], [("ORIG", 0), ("US", 5), ("US", 20), ("US", 25), ("US", 50),
                                                    ("OS", 25)], share)


@register("train_medians", with_fixture(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.5), 6) AS median FROM pools WHERE pool = 'TRAIN'"
    for c in NUMERIC), POOLS_CTE))
def q_train_medians(spark, sf_dir):
    from giniflow.operators.models import train_medians
    m = train_medians(pools(spark, sf_dir, columns=NUMERIC).where(F.col("pool") == "TRAIN"), NUMERIC)
    return m.select("feature", F.round("median", 6).alias("median"))


@register("union_scores", with_fixture(f"""
SELECT pool, CAST(count(*) AS BIGINT) AS n_rows, round(sum(quantity), 6) AS sum_score FROM pools
WHERE pool IN ('VALID', 'TEST') GROUP BY pool""", POOLS_CTE))
def q_union_scores(spark, sf_dir):
    p = pools(spark, sf_dir, columns=["quantity"]).select("pool", "quantity")
    parts = [p.where(F.col("pool") == x).select("pool", "quantity") for x in ("VALID", "TEST")]
    u = parts[0].unionByName(parts[1])
    return u.groupBy("pool").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("quantity"), 6).alias("sum_score"))


@register("numeric_projection", with_fixture(
    "SELECT epk_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC) + " FROM scoring_sample"))
def q_numeric_projection(spark, sf_dir):
    """P8 + P12 + P5: ids + numeric features only, cast to double with NaN as NULL."""
    d = prep.select_features(sample(spark, sf_dir), [KEY], NUMERIC + CATEGORICAL)
    nums = [c for c in prep.numeric_only(d).columns]
    return prep.normalize_numeric(d.select(KEY, *nums), nums)


@register("period_report_csv", with_fixture(f"""
SELECT CASE WHEN grouping(report_dt) = 1 THEN 'TOTAL' ELSE CAST(report_dt AS VARCHAR) END AS period,
       CAST(CASE WHEN grouping(report_dt) = 1 THEN count(*) ELSE count({Y}) END AS BIGINT) AS volume,
       CAST(sum({Y}) AS BIGINT) AS n_response,
       round(avg(CAST({Y} AS DOUBLE)), 6) AS trg_rate
FROM scoring_sample GROUP BY GROUPING SETS ((report_dt), ())"""))
def q_period_report_csv(spark, sf_dir):
    """S4 round trip: the period report written as one CSV file with a header and read back with its schema."""
    import uuid
    from giniflow.operators import reports
    from giniflow.session import ensure_checkpoint_dir
    from giniflow.sources import io
    path = f"{ensure_checkpoint_dir(spark)}/giniflow-report-{uuid.uuid4().hex[:8]}"
    rep = reports.period_report(sample(spark, sf_dir), DATE, Y)
    io.write_report(rep, path, "csv")
    return spark.read.schema(rep.schema).option("header", True).csv(path)


@register("read_through_report", with_fixture(f"""
SELECT CASE WHEN grouping(report_dt) = 1 THEN 'TOTAL' ELSE CAST(report_dt AS VARCHAR) END AS period,
       CAST(CASE WHEN grouping(report_dt) = 1 THEN count(*) ELSE count({Y}) END AS BIGINT) AS volume,
       CAST(sum({Y}) AS BIGINT) AS n_response,
       round(avg(CAST({Y} AS DOUBLE)), 6) AS trg_rate
FROM scoring_sample GROUP BY GROUPING SETS ((report_dt), ())"""))
def q_read_through_report(spark, sf_dir):
    """S2 + A1: the first read writes a parquet snapshot of the sample (in the shared checkpoint folder) and emits the
    period report from it; a second read is served by the snapshot alone."""
    import uuid
    from giniflow.operators import reports
    from giniflow.session import ensure_checkpoint_dir
    from giniflow.sources import io
    snap = f"{ensure_checkpoint_dir(spark)}/giniflow-snapshot-{uuid.uuid4().hex[:8]}"
    first_reports = []
    load = lambda: sample(spark, sf_dir)
    io.read_through(spark, snap, load, lambda d: first_reports.append(reports.period_report(d, DATE, Y)))
    again = io.read_through(spark, snap, load, lambda d: first_reports.append(None))
    if len(first_reports) != 1:
        raise RuntimeError("snapshot was not reused")
    return reports.period_report(again, DATE, Y)
