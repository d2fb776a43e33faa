"""Registered queries for binning and WoE."""

from __future__ import annotations

from pyspark.sql import functions as F

from giniflow.operators import binning, metrics
from giniflow.plans.catalog import KEY, NUMERIC, CATEGORICAL, Y, register, sample
from giniflow.plans.oracle import with_fixture
from giniflow.session import materialize
from giniflow.spec import BinnerConfig

MIN_SIZE = 0.05
FIXED = {"quantity": [10.0, 20.0, 30.0, 40.0], "discount": [0.02, 0.05, 0.08],
         "acct_bal": [0.0, 2500.0, 5000.0, 7500.0], "part_size": [10.0, 25.0, 40.0]}
ROC_FEATURES = ["quantity", "discount", "acct_bal"]


def _bin_case(col: str, ts: list[float]) -> str:
    parts = [f"CAST({col} > {ts[0]!r} AS INTEGER)"] + [f"CAST({col} >= {t!r} AS INTEGER)" for t in ts[1:]]
    return f"CASE WHEN {col} IS NULL OR isnan(CAST({col} AS DOUBLE)) THEN 0 ELSE 1 + {' + '.join(parts)} END"


BINNED_CTE = "_binned AS (\n" + "\nUNION ALL\n".join(
    f"SELECT epk_id, {Y}, '{f}' AS feature, {_bin_case(f, ts)} AS bin FROM scoring_sample" for f, ts in FIXED.items()
) + "\n)"

STATS_CTE = BINNED_CTE + f""",
_stats AS (SELECT feature, bin, count(*) AS n, sum({Y}) AS n_pos, avg(CAST({Y} AS DOUBLE)) AS target_rate
           FROM _binned GROUP BY feature, bin),
_gb AS (SELECT CAST(sum(1 - {Y}) AS DOUBLE) AS G, CAST(sum({Y}) AS DOUBLE) AS B FROM scoring_sample),
_woe AS (SELECT s.*, ln(((CASE WHEN n - n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n - n_pos AS DOUBLE) END) / G)
                      / ((CASE WHEN n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n_pos AS DOUBLE) END) / B)) AS woe,
                 (CASE WHEN n - n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n - n_pos AS DOUBLE) END) / G
                 - (CASE WHEN n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n_pos AS DOUBLE) END) / B AS dist
         FROM _stats s, _gb)"""


def _goods_bads(df):
    r = df.agg(F.sum(F.lit(1) - F.col(Y)).alias("g"), F.sum(Y).alias("b")).first()
    return float(r["g"]), float(r["b"])


@register("bin_stats_woe", with_fixture(f"""
SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(n AS BIGINT) AS n, CAST(n_pos AS BIGINT) AS n_pos,
       round(target_rate, 6) AS target_rate, round(woe, 6) AS woe FROM _woe""", STATS_CTE))
def q_bin_stats_woe(spark, sf_dir):
    df = sample(spark, sf_dir)
    stats = binning.bin_stats(df, FIXED, Y)
    woe, _ = binning.woe_iv(stats, *_goods_bads(df))
    return woe.select("feature", F.col("bin").cast("int").alias("bin"), "n", F.col("n_pos").cast("long").alias("n_pos"),
                      F.round("target_rate", 6).alias("target_rate"), F.round("woe", 6).alias("woe"))


@register("information_value", with_fixture(
    "SELECT feature, round(sum(woe * dist), 6) AS iv FROM _woe GROUP BY feature", STATS_CTE))
def q_information_value(spark, sf_dir):
    df = sample(spark, sf_dir)
    _, iv = binning.woe_iv(binning.bin_stats(df, FIXED, Y), *_goods_bads(df))
    return iv.select("feature", F.round("iv", 6).alias("iv"))


@register("place_missing", with_fixture(f"""
SELECT t.feature, CAST(CASE WHEN m.n IS NULL THEN 0 WHEN m.n > {MIN_SIZE} * t.nt THEN 0 ELSE
         (SELECT s.bin FROM _stats s WHERE s.feature = t.feature AND s.bin > 0
          ORDER BY abs(s.target_rate - m.target_rate), s.bin LIMIT 1) END AS INTEGER) AS nan_bin,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_missing
FROM (SELECT feature, sum(n) AS nt FROM _stats GROUP BY feature) t
LEFT JOIN (SELECT * FROM _stats WHERE bin = 0) m ON m.feature = t.feature""", STATS_CTE))
def q_place_missing(spark, sf_dir):
    return binning.place_missing(binning.bin_stats(sample(spark, sf_dir), FIXED, Y), MIN_SIZE)


PLACED_CTE = STATS_CTE + f""",
_mp AS (
  SELECT t.feature, CASE WHEN m.n IS NULL THEN 0 WHEN m.n > {MIN_SIZE} * t.nt THEN 0 ELSE
           (SELECT s.bin FROM _stats s WHERE s.feature = t.feature AND s.bin > 0
            ORDER BY abs(s.target_rate - m.target_rate), s.bin LIMIT 1) END AS nan_bin
  FROM (SELECT feature, sum(n) AS nt FROM _stats GROUP BY feature) t
  LEFT JOIN (SELECT * FROM _stats WHERE bin = 0) m ON m.feature = t.feature),
_b3 AS (SELECT b.epk_id, b.{Y}, b.feature, CASE WHEN b.bin = 0 THEN mp.nan_bin ELSE b.bin END AS bin
        FROM _binned b JOIN _mp mp ON mp.feature = b.feature),
_s3 AS (SELECT feature, bin, count(*) AS n, sum({Y}) AS n_pos FROM _b3 GROUP BY feature, bin)"""


@register("binning_report_fixed", with_fixture("""
SELECT feature, CAST(bin AS VARCHAR) AS bin, CAST(n AS BIGINT) AS n, CAST(n_pos AS BIGINT) AS n_pos,
       round(n_pos / n, 6) AS target_rate,
       round(ln(((CASE WHEN n - n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n - n_pos AS DOUBLE) END) / G)
                / ((CASE WHEN n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n_pos AS DOUBLE) END) / B)), 6) AS woe
FROM _s3, _gb""", PLACED_CTE))
def q_binning_report_fixed(spark, sf_dir):
    """The report of a fit (B9) whose cut points are given: bins, missing rows placed, rates and WoE."""
    model = binning.fit_binning(sample(spark, sf_dir), list(FIXED), [], Y, BinnerConfig(min_size=MIN_SIZE), fixed_thresholds=FIXED)
    return model.bin_spec(spark).select("feature", "bin", "n", "n_pos", F.round("target_rate", 6).alias("target_rate"),
                                        F.round("woe", 6).alias("woe"))


CATEGORY_CTE = "_cat AS (" + "\nUNION ALL\n".join(
    f"SELECT epk_id, {Y}, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM scoring_sample"
    for c in CATEGORICAL) + f"""),
_cs AS (SELECT feature, category, count(*) AS n, sum({Y}) AS n_pos FROM _cat GROUP BY feature, category),
_gb AS (SELECT CAST(sum(1 - {Y}) AS DOUBLE) AS G, CAST(sum({Y}) AS DOUBLE) AS B FROM scoring_sample),
_cw AS (SELECT _cs.*, ln(((CASE WHEN n - n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n - n_pos AS DOUBLE) END) / G)
                      / ((CASE WHEN n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n_pos AS DOUBLE) END) / B)) AS woe
        FROM _cs, _gb)"""


def _unmerged(df):
    """A fit that leaves every category a group of its own."""
    return binning.fit_binning(df, [], CATEGORICAL, Y, BinnerConfig(min_size=0.0, max_bins=1_000_000))


@register("category_woe", with_fixture("""
SELECT feature, category AS bin, CAST(n AS BIGINT) AS n, CAST(n_pos AS BIGINT) AS n_pos, round(n_pos / n, 6) AS target_rate,
       round(woe, 6) AS woe FROM _cw""", CATEGORY_CTE))
def q_category_woe(spark, sf_dir):
    spec = _unmerged(sample(spark, sf_dir)).bin_spec(spark)
    return spec.select("feature", "bin", "n", "n_pos", F.round("target_rate", 6).alias("target_rate"),
                       F.round("woe", 6).alias("woe"))


@register("category_woe_encode", with_fixture("SELECT epk_id, " + ", ".join(
    f"round(max(CASE WHEN feature = '{c}' THEN woe END), 6) AS woe_{c}" for c in CATEGORICAL)
    + " FROM _cat JOIN _cw USING (feature, category) GROUP BY epk_id", CATEGORY_CTE))
def q_category_woe_encode(spark, sf_dir):
    df = materialize(sample(spark, sf_dir).select(KEY, Y, *CATEGORICAL), "sample")      # two passes of the fit, one to encode
    out = _unmerged(df).transform(df, keep=[KEY], drop_incomplete=False)
    return out.select(KEY, *[F.round(f"woe_{c}", 6).alias(f"woe_{c}") for c in CATEGORICAL])


@register("woe_encode", with_fixture(f"""
SELECT epk_id, round(max(CASE WHEN feature = 'quantity' THEN woe END), 6) AS woe_quantity,
       round(max(CASE WHEN feature = 'acct_bal' THEN woe END), 6) AS woe_acct_bal
FROM (SELECT b.epk_id, b.feature, w2.woe FROM _b2 b JOIN _w2 w2 ON w2.feature = b.feature AND w2.bin = b.bin)
GROUP BY epk_id""", STATS_CTE + f""",
_mp AS (
  SELECT t.feature, CASE WHEN m.n IS NULL THEN 0 WHEN m.n > {MIN_SIZE} * t.nt THEN 0 ELSE
           (SELECT s.bin FROM _stats s WHERE s.feature = t.feature AND s.bin > 0
            ORDER BY abs(s.target_rate - m.target_rate), s.bin LIMIT 1) END AS nan_bin
  FROM (SELECT feature, sum(n) AS nt FROM _stats GROUP BY feature) t
  LEFT JOIN (SELECT * FROM _stats WHERE bin = 0) m ON m.feature = t.feature),
_b2 AS (SELECT b.epk_id, b.{Y}, b.feature, CASE WHEN b.bin = 0 THEN mp.nan_bin ELSE b.bin END AS bin
        FROM _binned b JOIN _mp mp ON mp.feature = b.feature WHERE b.feature IN ('quantity', 'acct_bal')),
_s2 AS (SELECT feature, bin, count(*) AS n, sum({Y}) AS n_pos FROM _b2 GROUP BY feature, bin),
_w2 AS (SELECT feature, bin, ln(((CASE WHEN n - n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n - n_pos AS DOUBLE) END) / G)
                      / ((CASE WHEN n_pos = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(n_pos AS DOUBLE) END) / B)) AS woe
        FROM _s2, _gb)"""))
def q_woe_encode(spark, sf_dir):
    df = sample(spark, sf_dir)
    fixed = {f: FIXED[f] for f in ("quantity", "acct_bal")}
    model = binning.fit_binning(df, list(fixed), [], Y, BinnerConfig(min_size=MIN_SIZE), fixed_thresholds=fixed)
    out = model.transform(df, keep=[KEY], drop_incomplete=False)
    return out.select(KEY, F.round("woe_quantity", 6).alias("woe_quantity"),
                      F.round("woe_acct_bal", 6).alias("woe_acct_bal"))


@register("category_stats", with_fixture(f"""
SELECT feature, category, CAST(sum({Y}) AS BIGINT) AS n_pos, CAST(count(*) AS BIGINT) AS n_total,
       round(count(*) / sum(count(*)) OVER (PARTITION BY feature), 6) AS frac,
       round(sum({Y}) / count(*), 6) AS trg_rate
FROM (""" + "\nUNION ALL\n".join(
    f"SELECT {Y}, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM scoring_sample"
    for c in CATEGORICAL) + ") GROUP BY feature, category"))
def q_category_stats(spark, sf_dir):
    s = binning.category_stats(sample(spark, sf_dir), CATEGORICAL, Y)
    return s.select("feature", "category", F.col("n_pos").cast("long").alias("n_pos"), "n_total",
                    F.round("frac", 6).alias("frac"), F.round("trg_rate", 6).alias("trg_rate"))


ROC_CTE = ("_long AS (UNPIVOT (SELECT " + Y + ", " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ROC_FEATURES)
           + " FROM scoring_sample) ON " + ", ".join(ROC_FEATURES) + " INTO NAME feature VALUE value)," + f"""
_h AS (SELECT feature, value, sum({Y}) AS pos, sum(1 - {Y}) AS neg FROM _long WHERE value IS NOT NULL
       GROUP BY feature, value),
_c AS (SELECT *, sum(pos) OVER (PARTITION BY feature ORDER BY value DESC ROWS UNBOUNDED PRECEDING) AS tps,
              sum(neg) OVER (PARTITION BY feature ORDER BY value DESC ROWS UNBOUNDED PRECEDING) AS fps,
              lead(pos) OVER (PARTITION BY feature ORDER BY value DESC) AS npos,
              lead(neg) OVER (PARTITION BY feature ORDER BY value DESC) AS nneg,
              row_number() OVER (PARTITION BY feature ORDER BY value DESC) AS rn FROM _h),
_k AS (SELECT * FROM _c WHERE rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg),
_t AS (SELECT feature, sum(pos) AS P, sum(neg) AS N FROM _h GROUP BY feature),
_p0 AS (SELECT feature, row_number() OVER (PARTITION BY feature ORDER BY value DESC) AS idx, value, tps, fps FROM _k
        UNION ALL SELECT feature, 0, NULL, 0, 0 FROM _t),
_p AS (SELECT p.feature, CAST(idx AS BIGINT) AS idx, value, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps,
              tps / P AS tpr, fps / N AS fpr, (tps + fps) / (P + N) AS mass FROM _p0 p JOIN _t USING (feature))""")


def _roc(spark, sf_dir):
    return metrics.roc_points(sample(spark, sf_dir), ROC_FEATURES, Y)


def _round_points(p, extra=()):
    return p.select("feature", "idx", "value", "tps", "fps", F.round("tpr", 6).alias("tpr"),
                    F.round("fpr", 6).alias("fpr"), F.round("mass", 6).alias("mass"), *extra)


@register("roc_points", with_fixture(
    "SELECT feature, idx, value, tps, fps, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(mass, 6) AS mass FROM _p",
    ROC_CTE))
def q_roc_points(spark, sf_dir):
    return _round_points(_roc(spark, sf_dir))


@register("roc_weights", with_fixture(
    "SELECT feature, idx, round(mass - coalesce(lag(mass) OVER (PARTITION BY feature ORDER BY idx), 0), 6) AS weight"
    " FROM _p", ROC_CTE))
def q_roc_weights(spark, sf_dir):
    w = metrics.roc_weights(_roc(spark, sf_dir))
    return w.select("feature", "idx", F.round("weight", 6).alias("weight"))


@register("edge_compaction", with_fixture(f"""
SELECT feature, idx, value, tps, fps, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(mass, 6) AS mass
FROM (SELECT *, max(idx) OVER (PARTITION BY feature) AS _last FROM _p)
WHERE idx = 0 OR idx = _last OR (mass > {MIN_SIZE} AND 1 - mass > {MIN_SIZE})""", ROC_CTE))
def q_edge_compaction(spark, sf_dir):
    return _round_points(metrics.edge_compaction(_roc(spark, sf_dir), MIN_SIZE))


PREBIN_FEATURES = ["price", "quantity", "acct_bal"]


@register("equal_size_prebin", with_fixture(f"""
SELECT feature, CAST(prebin AS INTEGER) AS prebin, CAST(sum(cnt) AS BIGINT) AS n, min(value) AS lo, max(value) AS hi
FROM (SELECT *, least(floor(coalesce(sum(cnt) OVER (PARTITION BY feature ORDER BY value DESC
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                            / greatest(floor(sum(cnt) OVER (PARTITION BY feature) / 10), 1)), 9) AS prebin
      FROM (SELECT feature, value, count(*) AS cnt
            FROM (UNPIVOT (SELECT """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PREBIN_FEATURES)
    + " FROM scoring_sample) ON " + ", ".join(PREBIN_FEATURES) + """ INTO NAME feature VALUE value)
            WHERE value IS NOT NULL GROUP BY feature, value))
GROUP BY feature, prebin"""))
def q_equal_size_prebin(spark, sf_dir):
    p = binning.equal_size_prebin(sample(spark, sf_dir), PREBIN_FEATURES, 10)
    return p.groupBy("feature", "prebin").agg(F.sum("cnt").cast("long").alias("n"), F.min("value").alias("lo"),
                                              F.max("value").alias("hi"))


@register("segment_loss", with_fixture("""
SELECT feature, round(coalesce(sum(CASE WHEN NOT e THEN abs(tpr - (k * fpr + c)) END), 0) / max(L), 9) AS loss
FROM (
  SELECT q.*, (b_tpr - a_tpr) / (b_fpr - a_fpr + CAST(1e-20 AS DOUBLE)) AS k,
         b_tpr - (b_tpr - a_tpr) / (b_fpr - a_fpr + CAST(1e-20 AS DOUBLE)) * b_fpr AS c
  FROM (SELECT p.*, count(*) OVER (PARTITION BY feature) AS L,
               last_value(CASE WHEN e THEN tpr END IGNORE NULLS) OVER w1 AS a_tpr,
               last_value(CASE WHEN e THEN fpr END IGNORE NULLS) OVER w1 AS a_fpr,
               first_value(CASE WHEN e THEN tpr END IGNORE NULLS) OVER w2 AS b_tpr,
               first_value(CASE WHEN e THEN fpr END IGNORE NULLS) OVER w2 AS b_fpr
        FROM (SELECT _p.*, idx = 0 OR idx = max(idx) OVER (PARTITION BY feature)
                     OR idx IN (SELECT min(q.idx) FROM _p q, (VALUES (0.25), (0.5), (0.75)) t(m)
                                WHERE q.feature = _p.feature AND q.mass >= t.m GROUP BY t.m) AS e FROM _p) p
        WINDOW w1 AS (PARTITION BY feature ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               w2 AS (PARTITION BY feature ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) q
) x GROUP BY feature""", ROC_CTE))
def q_segment_loss(spark, sf_dir):
    pts = materialize(_roc(spark, sf_dir), "roc")
    # fixed breaks: the first ROC point at or past each quartile of population mass
    quart = [F.min(F.when(F.col("mass") >= F.lit(m), F.col("idx"))) for m in (0.25, 0.5, 0.75)]
    breaks = pts.groupBy("feature").agg(F.array_distinct(F.array(*quart)).alias("break_idx"))
    loss = binning.segment_loss(pts, breaks)
    return loss.select("feature", F.round("loss", 9).alias("loss"))


@register("woe_binning_report", None)
def q_woe_binning_report(spark, sf_dir):
    """Full fit (B9): ROC cut search by DP and moves over all points, greedy category merges, missing placement, WoE, IV,
    WoE Gini. The columns of the fit are stored once, as it makes several passes."""
    df = materialize(sample(spark, sf_dir).select(*NUMERIC, *CATEGORICAL, Y), "binning")
    model = binning.fit_binning(df, NUMERIC, CATEGORICAL, Y, BinnerConfig(max_bins=20, min_size=MIN_SIZE))
    return model.feature_stat(spark)


@register("woe_bin_spec", None)
def q_woe_bin_spec(spark, sf_dir):
    df = materialize(sample(spark, sf_dir).select(*NUMERIC, *CATEGORICAL, Y), "binning")
    model = binning.fit_binning(df, NUMERIC, CATEGORICAL, Y, BinnerConfig(max_bins=10, min_size=MIN_SIZE, fast=True))
    return model.bin_spec(spark)


@register("merge_categories", None)
def q_merge_categories(spark, sf_dir):
    """B1 + B2 on every categorical feature: group number of every category and its place in the group's label."""
    stats = binning.category_stats(sample(spark, sf_dir), CATEGORICAL, Y)
    return binning.merge_categories_spark(stats, MIN_SIZE, 4)
