"""Sources: synthetic sample, category list, snapshots, streaming WoE."""
import datetime as dt

from pyspark.sql import functions as F

from giniflow.sources import io
from giniflow.sources.synthetic import make_synthetic


def test_synthetic_sample_shape_and_signal(spark):
    df = make_synthetic(spark, n=20_000, weight=0.05, seed=3)
    cols = df.columns
    assert cols[:3] == ["epk_id", "report_dt", "trg_flag"]
    assert sum(c.startswith("feature_") for c in cols) == 7 and sum(c.endswith("_cd") for c in cols) == 3
    rate = df.agg(F.avg("trg_flag")).first()[0]
    assert 0.02 < rate < 0.12
    oot = df.where(F.col("report_dt") == F.lit(dt.date(2020, 10, 31))).count() / 20_000
    assert 0.08 < oot < 0.12
    from giniflow.operators.metrics import gini
    assert gini(df, "feature_1", "trg_flag").first()["gini"] > 10
    # identical for any partitioning
    again = make_synthetic(spark, n=20_000, weight=0.05, seed=3).repartition(7)
    assert df.exceptAll(again).count() == 0


def test_category_list_and_snapshot(spark, tmp_path):
    p = tmp_path / "cats.txt"
    p.write_text("a_col \n\n b_col\n")
    assert [r[0] for r in io.read_category_list(spark, str(p)).collect()] == ["a_col", "b_col"]
    df = spark.createDataFrame([(1, "TRAIN"), (2, "TEST"), (3, "TRAIN")], "id int, pool string")
    snap = io.snapshot_pools(df, str(tmp_path / "pools"))
    assert sorted((r["id"], r["pool"]) for r in snap.collect()) == [(1, "TRAIN"), (2, "TEST"), (3, "TRAIN")]


def test_stream_woe_equals_batch(spark, fixture_df, tmp_path):
    from giniflow.operators import binning
    from giniflow.spec import BinnerConfig
    from giniflow.streaming.scoring import read_stream, woe_stream, write_stream
    fixed = {"quantity": [10.0, 20.0, 30.0], "acct_bal": [0.0, 5000.0]}
    model = binning.fit_binning(fixture_df, list(fixed), [], "trg_flag", BinnerConfig(), fixed_thresholds=fixed)
    src = fixture_df.select("epk_id", "trg_flag", "quantity", "acct_bal")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    q = write_stream(woe_stream(read_stream(spark, str(tmp_path / "in"), src.schema, 1), model, ["epk_id"]),
                     str(tmp_path / "out"), "test-woe")
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = model.transform(src, keep=["epk_id"])
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_read_sample_table_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    df.createOrReplaceTempView("sample_short")
    df.union(df).createOrReplaceTempView("sample_short_long")
    assert io.read_sample(spark, "sample_short", fmt="table").count() == 2
    assert io.read_sample(spark, "sample_short", fmt="table", long=True).count() == 4
    path = str(tmp_path / "s")
    df.write.parquet(path)
    assert sorted(r["id"] for r in io.read_sample(spark, path).collect()) == [1, 2]
