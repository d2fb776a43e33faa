"""Registered queries with SQL twins for the registry, run parameters, feature lists and small report tables (S5-S7, S12, P3,
P9, J3, A10, A12, A15, O3, U3, X3, X10, X11, M12, M18), computed from the scoring sample."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from giniflow.functions.columns import categorical_columns, common_columns, feature_projection_sql, order_features
from giniflow.operators import collinear, metrics, reports, sampling
from giniflow.operators.encode import encode_lookup, one_hot_vectors, ordinal_codes
from giniflow.operators.impute import MedianImputer
from giniflow.operators.joins import concat_columns
from giniflow.operators.tuning import combination, n_combinations
from giniflow.plans import stages
from giniflow.plans.catalog import DATE, KEY, SEED, Y, register, sample
from giniflow.plans.oracle import gini_sql, with_fixture
from giniflow.session import ensure_checkpoint_dir, materialize
from giniflow.sources import io


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/giniflow-{name}-{uuid.uuid4().hex[:8]}"


_DATES_SQL = f"SELECT {DATE}, count(*) AS n, CAST(sum({Y}) AS BIGINT) AS n_pos FROM scoring_sample GROUP BY {DATE}"


def _dates(spark, sf_dir):
    """Rows and positives by report date, in order: one row per date."""
    return sample(spark, sf_dir).groupBy(DATE).agg(F.count(F.lit(1)).alias("n"), F.sum(Y).alias("n_pos")).orderBy(DATE).collect()


@register("register_runs", with_fixture(f"""
SELECT CASE WHEN year({DATE}) % 2 = 0 THEN 'even' ELSE 'odd' END AS kind,
       CAST(row_number() OVER (PARTITION BY year({DATE}) % 2 ORDER BY {DATE}) AS INTEGER) AS version,
       CAST(n AS BIGINT) AS n_rows FROM ({_DATES_SQL})"""))
def q_register_runs(spark, sf_dir):
    """One run per report date, of two kinds; versions count on within a kind."""
    path = _folder(spark, "registry")
    for r in _dates(spark, sf_dir):
        kind = "even" if r[DATE].year % 2 == 0 else "odd"
        io.register_run(spark, path, kind, {"n_rows": r["n"]})
    return io.read_registry(spark, path).select("kind", "version", F.get_json_object("params_json", "$.n_rows").cast("long").alias("n_rows"))


@register("run_params", with_fixture(f"""
SELECT CAST(row_number() OVER (ORDER BY {DATE}) AS INTEGER) AS run_id, CAST(n AS BIGINT) AS n_rows, n_pos,
       CAST({DATE} AS VARCHAR) AS report_dt FROM ({_DATES_SQL})"""))
def q_run_params(spark, sf_dir):
    """S12 + X3 + X11: parameters of every run from its JSON file, the run's number from its folder's name."""
    base = _folder(spark, "runs")
    for k, r in enumerate(_dates(spark, sf_dir), 1):
        params = {"n_rows": r["n"], "n_pos": r["n_pos"], "report_dt": str(r[DATE])}
        spark.createDataFrame([(json.dumps(params),)], "v string").coalesce(1).write.text(f"{base}/run_{k}")
    runs = io.read_run_params(spark, base, "run_*/part-*")
    return runs.select("run_id", "n_rows", "n_pos", F.col("report_dt").cast("string").alias("report_dt"))


@register("selection_runs", with_fixture("""
SELECT CAST(k AS INTEGER) AS selections, 20 AS bins, round(cutoff, 6) AS size, fast,
       CASE WHEN fast THEN 100 END AS start_from, CAST(1.7 AS DOUBLE) AS vif_cutoff, 10 AS n_splits, 10 AS perm_iter,
       CAST((missing[1] > cutoff)::INTEGER + (missing[2] > cutoff)::INTEGER + (missing[3] > cutoff)::INTEGER AS INTEGER) AS n_dropped
FROM (SELECT [avg((acct_bal IS NULL)::INTEGER), avg((part_size IS NULL)::INTEGER), avg((tax_sparse IS NULL)::INTEGER)] AS missing
      FROM scoring_sample),
     (VALUES (1, CAST(0.01 AS DOUBLE), false), (2, CAST(0.1 AS DOUBLE), true), (3, CAST(0.5 AS DOUBLE), true)) t(k, cutoff, fast)"""))
def q_selection_runs(spark, sf_dir):
    """One row per selection run; what each drops is counted on the sample, ``start_from`` shows in fast mode only."""
    base = _folder(spark, "selection-runs")
    cols = ["acct_bal", "part_size", "tax_sparse"]
    missing = sample(spark, sf_dir).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]).first()
    for k, (cutoff, fast) in enumerate([(0.01, False), (0.1, True), (0.5, True)], 1):
        params = {"bins": 20, "size": cutoff, "fast": fast, "start_from": 100, "vif_cutoff": 1.7, "n_splits": 10,
                  "perm_iter": 10, "n_dropped": sum(missing[c] > cutoff for c in cols)}
        spark.createDataFrame([(json.dumps(params),)], "v string").coalesce(1).write.text(f"{base}/selection_{k}")
    rep = reports.selection_report(io.read_run_params(spark, base, "selection_*/part-*"))
    whole = ["bins", "start_from", "n_splits", "perm_iter", "n_dropped"]
    return rep.select(*[F.col(c).cast("int").alias(c) if c in whole else c for c in rep.columns])


_FEATURES = ["lifestyle_part_size", "report_dt", "acct_bal", "quantity", "brand_cd", "client_segm", "tax_sparse"]


@register("feature_list", with_fixture("""
SELECT CAST(row_number() OVER (ORDER BY g, i) AS INTEGER) AS position, feature, CAST(n AS BIGINT) AS n_known,
       right(feature, 2) = 'cd' OR right(feature, 5) IN ('nflag', 'group') OR right(feature, 4) = 'segm' AS is_category,
       chr(10) || ', b.' || feature AS sql_line
FROM (SELECT i, feature, CASE WHEN starts_with(feature, 'lifestyle') THEN 2 WHEN ends_with(feature, '_dt') THEN 1 ELSE 0 END AS g, n
      FROM (SELECT 1 AS i, 'lifestyle_part_size' AS feature, count(part_size) AS n FROM scoring_sample
            UNION ALL SELECT 2, 'report_dt', count(report_dt) FROM scoring_sample
            UNION ALL SELECT 3, 'acct_bal', count(acct_bal) FROM scoring_sample
            UNION ALL SELECT 4, 'quantity', count(quantity) FROM scoring_sample
            UNION ALL SELECT 5, 'brand_cd', count(brand_cd) FROM scoring_sample
            UNION ALL SELECT 6, 'client_segm', count(client_segm) FROM scoring_sample
            UNION ALL SELECT 7, 'tax_sparse', count(tax_sparse) FROM scoring_sample))"""))
def q_feature_list(spark, sf_dir):
    """P3 + P9 + S5 + S6 + U3: features of the sample in report order with their role, extraction line and known values."""
    df = sample(spark, sf_dir).withColumnRenamed("part_size", "lifestyle_part_size")
    other = df.select(*reversed(_FEATURES), "price").limit(0)
    names = [f for f in _FEATURES if f in common_columns([df, other])]
    listed = f"{_folder(spark, 'categories')}"
    spark.createDataFrame([("  client_segm ",), ("",)], "v string").coalesce(1).write.text(listed)
    known = [r["name"] for r in io.read_category_list(spark, listed).collect()]
    cats = set(categorical_columns(names, known))
    counts = df.agg(*[F.count(f).alias(f) for f in names]).first()
    rows = [(k, f, counts[f], f in cats, feature_projection_sql([f])) for k, f in enumerate(order_features(names), 1)]
    return spark.createDataFrame(rows, "position int, feature string, n_known long, is_category boolean, sql_line string")


@register("concat_columns", with_fixture(
    f"SELECT epk_id, quantity, price, {Y}, acct_bal FROM scoring_sample WHERE discount > 0.02"))
def q_concat_columns(spark, sf_dir):
    """Two frames over the same rows side by side; the left copy of a shared column stays."""
    df = sample(spark, sf_dir)
    left = df.select(KEY, "quantity", "price", Y)
    right = df.where(F.col("discount") > 0.02).select(KEY, (F.col("quantity") + 1).alias("quantity"), "acct_bal")
    return concat_columns(left, right, KEY)


@register("mean_importance", with_fixture(f"""
SELECT feature, round(avg(gini), 6) AS importance FROM (
  SELECT 'quantity' AS feature, * FROM ({gini_sql('_d', 'quantity', Y, ['report_dt'], None, 1.0, True)})
  UNION ALL SELECT 'discount', * FROM ({gini_sql('_d', 'discount', Y, ['report_dt'], None, 1.0, True)})
  UNION ALL SELECT 'acct_bal', * FROM ({gini_sql('_d', 'acct_bal', Y, ['report_dt'], None, 1.0, True)})) GROUP BY feature""",
    "_d AS (SELECT * FROM scoring_sample)"))
def q_mean_importance(spark, sf_dir):
    """Mean over the report dates of each feature's |2 AUC - 1| on the date."""
    g = metrics.feature_gini(sample(spark, sf_dir), ["quantity", "discount", "acct_bal"], Y, by=[DATE])
    dates = [r[0] for r in g.select(DATE).distinct().collect()]
    parts = [g.where(F.col(DATE) == F.lit(d)).select("feature", F.col("gini").alias("importance")) for d in dates]
    return stages.mean_importance(parts).select("feature", F.round("importance", 6).alias("importance"))


@register("rank_pipelines", with_fixture(f"""
SELECT brand_cd AS label, round(gini, 6) AS gini, round(low, 6) AS gini_low,
       CAST(row_number() OVER (ORDER BY coalesce(low, gini) DESC, brand_cd) AS INTEGER) AS rank
FROM (SELECT brand_cd, gini, CASE WHEN length(brand_cd) % 2 = 0 THEN gini - 1 END AS low
      FROM ({gini_sql('scoring_sample', 'quantity', Y, ['brand_cd'], None)}))"""))
def q_rank_pipelines(spark, sf_dir):
    """O3: cells in order of the lower band where there is one, else of the Gini (cells: brands, score: quantity)."""
    g = metrics.gini(sample(spark, sf_dir), "quantity", Y, by=["brand_cd"], digits=None)
    low = F.when(F.length("brand_cd") % 2 == 0, F.col("gini") - 1)
    ranked = reports.rank_pipelines(g.select(F.col("brand_cd").alias("label"), "gini", low.alias("gini_low")))
    return ranked.select("label", F.round("gini", 6).alias("gini"), F.round("gini_low", 6).alias("gini_low"),
                         F.col("rank").cast("int").alias("rank"))


@register("bootstrap_order_statistics", with_fixture(f"""
SELECT round(max(CASE WHEN r = CAST(floor(n * 0.025) AS INTEGER) + 1 THEN gini END), 2) AS gini_low,
       round(max(CASE WHEN r = CAST(floor(n * 0.975) AS INTEGER) + 1 THEN gini END), 2) AS gini_upp
FROM (SELECT *, row_number() OVER (ORDER BY gini, brand_cd, report_dt) AS r, count(*) OVER () AS n
      FROM ({gini_sql('scoring_sample', 'quantity', Y, ['brand_cd', 'report_dt'], None)}) WHERE gini IS NOT NULL AND NOT isnan(gini))"""))
def q_bootstrap_order_statistics(spark, sf_dir):
    """A10: the band's order statistics over a table of replicates (here the Gini of each brand and date)."""
    g = metrics.gini(sample(spark, sf_dir), "quantity", Y, by=["brand_cd", DATE], digits=None).where(F.col("gini").isNotNull())
    reps = g.select(F.concat_ws("/", "brand_cd", DATE).alias("replicate"), "gini")
    return metrics.bootstrap_band(reps, reps.count())


@register("vif_select_pair", with_fixture("""
SELECT feature, round(vif, 4) AS vif, status FROM (
  SELECT 'quantity' AS feature, CAST(1 AS DOUBLE) AS vif, 'KEPT' AS status FROM _r WHERE vif >= 1.7
  UNION ALL SELECT 'quantity_x', vif, 'DROPPED' FROM _r WHERE vif >= 1.7
  UNION ALL SELECT unnest(['quantity', 'quantity_x']), vif, 'KEPT' FROM _r WHERE vif < 1.7)""", """
_r AS (SELECT 1 / (1 - corr(quantity, quantity_x) * corr(quantity, quantity_x)) AS vif FROM scoring_sample)"""))
def q_vif_select_pair(spark, sf_dir):
    """M12 on two columns: both have the VIF 1 / (1 - r^2); the later one goes when it reaches the cutoff."""
    dropped, final = collinear.vif_select(sample(spark, sf_dir), ["quantity", "quantity_x"], cutoff=1.7)
    rows = [(f, float(v), "DROPPED") for f, v in dropped]
    rows += [(f, float(v), "KEPT") for f, v in final.items() if f != collinear.CONST]
    return spark.createDataFrame(rows, "feature string, vif double, status string").withColumn("vif", F.round("vif", 4))


_PAIR = ["quantity", "discount", "tax", "price", "quantity_x"]


@register("feature_pairs", with_fixture("""
SELECT CAST(row_number() OVER (ORDER BY j, i) - 1 AS BIGINT) AS rank, _f[i] AS first, _f[j] AS second, round(r, 6) AS r
FROM (SELECT ['quantity', 'discount', 'tax', 'price', 'quantity_x'] AS _f, i, j, r FROM (""" + " UNION ALL ".join(
    f"SELECT {i + 1} AS i, {j + 1} AS j, corr({_PAIR[i]}, {_PAIR[j]}) AS r FROM scoring_sample"
    for j in range(len(_PAIR)) for i in range(j)) + "))"))
def q_feature_pairs(spark, sf_dir):
    """Every pair of features by its rank (no product is built), with their correlation on the sample."""
    n = len(_PAIR)
    pairs = spark.range(n_combinations(n, 2, 2)).select(F.col("id").alias("rank"), combination(F.col("id"), n, 2, 2).alias("p"))
    names = F.array(*[F.lit(f) for f in _PAIR])
    pairs = pairs.select("rank", F.element_at(names, F.col("p")[0] + 1).alias("first"), F.element_at(names, F.col("p")[1] + 1).alias("second"))
    rows = pairs.collect()        # feature pairs: a configured number
    found = sample(spark, sf_dir).agg(*[F.corr(r["first"], r["second"]).alias(str(r["rank"])) for r in rows]).first()
    return spark.createDataFrame([(r["rank"], r["first"], r["second"], found[str(r["rank"])]) for r in rows],
                                 "rank long, first string, second string, r double").withColumn("r", F.round("r", 6))


_HALF_SQL = "CAST('0x' || substr(md5(epk_id || ':half'), 1, 8) AS BIGINT) % 2"


@register("median_imputed", with_fixture("SELECT epk_id, " + ", ".join(
    f"round(coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM _train)), 6) AS {c}"
    for c in ("acct_bal", "part_size", "quantity")) + " FROM scoring_sample",
    f"_train AS (SELECT * FROM scoring_sample WHERE {_HALF_SQL} = 0)"))
def q_median_imputed(spark, sf_dir):
    """The pipeline's imputation stage, fitted on one half of the rows, applied to all."""
    df = sample(spark, sf_dir)
    half = F.conv(F.substring(F.md5(F.concat(KEY, F.lit(":half"))), 1, 8), 16, 10).cast("long") % 2
    cols = ["acct_bal", "part_size", "quantity"]
    model = MedianImputer(inputCols=cols, outputCols=[f"imp_{c}" for c in cols]).fit(df.where(half == 0))
    return model.transform(df).select(KEY, *[F.round(f"imp_{c}", 6).alias(c) for c in cols])


@register("oversample_weights", with_fixture(f"""
SELECT {Y}, CAST(count(*) AS BIGINT) AS n_rows, CAST(CASE WHEN {Y} = 1 THEN floor(n0 / 3.0) ELSE n0 END AS BIGINT) AS n_weighted
FROM scoring_sample, (SELECT count(*) AS n0 FROM scoring_sample WHERE {Y} = 0) GROUP BY {Y}, n0"""))
def q_oversample_weights(spark, sf_dir):
    """R4 + R7 as weights: a minority share of 25 % without a copied row. The weighted minority is exactly a third of the
    majority, rounded down."""
    d = sampling.resample_weights(materialize(sample(spark, sf_dir).select(KEY, Y), "sample"), Y, "OVER", 0.25, KEY, SEED)
    return d.groupBy(Y).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("weight").alias("n_weighted"))


@register("lookup_codes", with_fixture("""
SELECT epk_id, CAST(code AS INTEGER) AS code FROM scoring_sample LEFT JOIN (
  SELECT category, CASE WHEN category = 'nan' THEN -1 ELSE row_number() OVER (ORDER BY category) END AS code
  FROM (SELECT DISTINCT coalesce(client_segm, 'nan') AS category FROM scoring_sample)) ON client_segm = category"""))
def q_lookup_codes(spark, sf_dir):
    """One column's codes by lookup; a missing category finds no row."""
    df = sample(spark, sf_dir)
    codes = ordinal_codes(df, ["client_segm"]).select("category", "code")
    return encode_lookup(df.select(KEY, "client_segm"), "client_segm", codes, "category", "code").select(KEY, "code")


@register("one_hot_vectors", with_fixture("""
SELECT epk_id, coalesce(a.slot, 0) AS client_segm, coalesce(b.slot, 0) AS priority_group FROM scoring_sample s
LEFT JOIN _a a ON a.category = coalesce(s.client_segm, 'nan') LEFT JOIN _b b ON b.category = coalesce(s.priority_group, 'nan')""", """
_a AS (SELECT category, CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS slot FROM (
         SELECT DISTINCT coalesce(client_segm, 'nan') AS category FROM scoring_sample WHERE client_segm <> 'BUILDING')),
_b AS (SELECT category, CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS slot FROM (
         SELECT DISTINCT coalesce(priority_group, 'nan') AS category FROM scoring_sample WHERE client_segm <> 'BUILDING'))"""))
def q_one_hot_vectors(spark, sf_dir):
    """X7 as sparse vectors: the place of the one in each row's vector (from 1; 0 for values that were not in the training
    rows, which lack one segment and missing ones)."""
    from pyspark.ml.functions import vector_to_array
    cats = ["client_segm", "priority_group"]
    df = sample(spark, sf_dir).select(KEY, *cats)
    out, _ = one_hot_vectors(df.where("client_segm <> 'BUILDING'"), df, cats)
    return out.select(KEY, *[F.array_position(vector_to_array(f"{c}_vec"), 1.0).cast("int").alias(c) for c in cats])


@register("permute_column", with_fixture("""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(acct_bal) AS BIGINT) AS n_known, round(sum(acct_bal), 2) AS total,
       min(acct_bal) AS lo, max(acct_bal) AS hi, round(sum(quantity), 2) AS others, true AS moved FROM scoring_sample"""))
def q_permute_column(spark, sf_dir):
    """A shuffled column keeps its values, the others their rows; the values stand in other rows."""
    from giniflow.operators.importance import permute_column
    df = materialize(sample(spark, sf_dir).select(KEY, "quantity", "acct_bal"), "sample")
    out = permute_column(df, "acct_bal", KEY, SEED)
    n_moved = out.alias("x").join(df.alias("y"), KEY).where(~F.col("x.acct_bal").eqNullSafe(F.col("y.acct_bal"))).count()
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count("acct_bal").alias("n_known"), F.round(F.sum("acct_bal"), 2).alias("total"),
                   F.min("acct_bal").alias("lo"), F.max("acct_bal").alias("hi"), F.round(F.sum("quantity"), 2).alias("others"),
                   F.lit(n_moved > 0).alias("moved"))
