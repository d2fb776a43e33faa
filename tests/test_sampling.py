"""Splits, samples and folds: exact sizes, disjointness, balance, agreement with a plain sort."""
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from giniflow.functions.hashing import row_hash
from giniflow.operators import sampling
from giniflow.operators.prefix import exact_rank


def test_order_statistics_equal_a_plain_sort(fixture_df):
    d = fixture_df.select("epk_id", "trg_flag").withColumn("h", row_hash("epk_id", "t"))
    rows = sorted((r["h"], r["epk_id"]) for r in d.where("trg_flag = 0").collect())
    wanted = [((0,), 1), ((0,), 17), ((0,), len(rows) // 2), ((0,), len(rows))]
    got = sampling.order_statistics(d, ["trg_flag"], "h", "epk_id", wanted)
    for (g, r) in wanted:
        assert got[(g, r)] == rows[r - 1]


def test_exact_rank_equals_row_number(fixture_df):
    d = fixture_df.select("epk_id", "trg_flag").withColumn("h", row_hash("epk_id", "r"))
    ours = exact_rank(d, ["trg_flag"], ["h", "epk_id"], n_buckets=7)
    ref = d.withColumn("rn", F.row_number().over(Window.partitionBy("trg_flag").orderBy("h", "epk_id")))
    assert ours.join(ref, ["epk_id"]).where(F.col("rank") != F.col("rn")).count() == 0


def test_holdout_size_is_exact(fixture_df):
    n = fixture_df.count()
    out = sampling.split_holdout(fixture_df, 0.2, "epk_id", 19)
    assert out.where("holdout").count() == math.ceil(0.2 * n)


def test_undersample_count_and_error(fixture_df):
    counts = {r["trg_flag"]: r["count"] for r in fixture_df.groupBy("trg_flag").count().collect()}
    out = sampling.undersample(fixture_df, "trg_flag", 0.25, "epk_id", 19)
    c = {r["trg_flag"]: r["count"] for r in out.groupBy("trg_flag").count().collect()}
    assert c[1] == counts[1] and c[0] == int(counts[1] / (0.25 / 0.75))
    with pytest.raises(ValueError):
        sampling.undersample(fixture_df, "trg_flag", 0.05, "epk_id", 19)


def test_oversample_adds_exact_draws(fixture_df):
    counts = {r["trg_flag"]: r["count"] for r in fixture_df.groupBy("trg_flag").count().collect()}
    out = sampling.oversample(fixture_df, "trg_flag", 0.25, "epk_id", 19)
    extra = int(counts[0] * (0.25 / 0.75) - counts[1])
    assert out.count() == fixture_df.count() + extra
    assert out.where("trg_flag = 0").count() == counts[0]


def test_folds_disjoint_complete_balanced(fixture_df):
    f = sampling.stratified_folds(fixture_df, "trg_flag", 5, "epk_id", 19)
    assert f.count() == fixture_df.count() and f.select("epk_id").distinct().count() == fixture_df.count()
    per = f.groupBy("trg_flag", "fold").count().collect()
    for cls in (0, 1):
        sizes = [r["count"] for r in per if r["trg_flag"] == cls]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_four_pools_partition_dev_and_keep_oot(fixture_df):
    import datetime as dt
    p = sampling.four_pools(fixture_df, "epk_id", "report_dt", [dt.date(2001, 12, 31)], seed=19)
    c = {r["pool"]: r["count"] for r in p.groupBy("pool").count().collect()}
    assert sum(c.values()) == fixture_df.count()
    assert c["OOT"] == fixture_df.where("report_dt = DATE'2001-12-31'").count()
    n_dev = fixture_df.count() - c["OOT"]
    assert c["TEST"] == math.ceil(0.2 * n_dev)
    assert c["VALID"] == math.ceil(0.25 * (n_dev - c["TEST"]))


def test_order_statistics_break_hash_ties_by_key(spark):
    # a third of the rows share one hash value (a hot value); ranks inside it follow the key
    rows = [(i % 3 == 0 and 777 or 1000 + i, f"k{i:04d}") for i in range(300)]
    d = spark.createDataFrame(rows, "h long, k string")
    ordered = sorted(rows)
    wanted = [((), r) for r in (1, 50, 100, 101, 150, 300)]
    got = sampling.order_statistics(d, [], "h", "k", wanted)
    for (_, r) in wanted:
        assert got[((), r)] == ordered[r - 1]


def test_explicit_dev_list_may_overlap_oot(fixture_df):
    import datetime as dt
    dev, oot = sampling.split_dev_oot(fixture_df, "report_dt", [dt.date(2001, 12, 31)],
                                      [dt.date(2000, 12, 31), dt.date(2001, 12, 31)])
    assert dev.where("report_dt = DATE'2001-12-31'").count() == oot.count() > 0
    assert dev.select("report_dt").distinct().count() == 2


def test_pool_boundary_reads_keys_only_where_hashes_tie(spark):
    d = spark.createDataFrame([(h, k) for h, k in zip([1, 2, 2, 2, 5], "abcde")], "h long, __key string")
    assert sampling.smallest(d, "h", 0.2) == (1, None)           # the only row of its hash
    assert sampling.smallest(d, "h", 0.4) == (2, "b")            # others of the hash come after it
    assert sampling.smallest(d, "h", 0.8) == (2, None)           # the last of its hash
    for frac, n in ((0.2, 1), (0.4, 2), (0.8, 4)):
        assert d.where(sampling.at_or_below("h", "__key", sampling.smallest(d, "h", frac))).count() == n
