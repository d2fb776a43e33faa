"""Operators without a registered query of their own, and the rules of sources."""

import datetime as dt

import pytest

from giniflow.functions import columns, dates
from giniflow.operators import encode, prep
from giniflow.sources import io
from giniflow.sources.synthetic import make_synthetic


def test_common_columns_and_projection(spark):
    a, b = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int"), spark.createDataFrame([(1, 2)], "z int, x int")
    assert columns.common_columns([a, b]) == ["x", "z"] and columns.common_columns([]) == []
    assert columns.feature_projection_sql(["f", "g"]) == "\n, b.f\n, b.g"


def test_lookup_and_prefixes(spark):
    df = spark.createDataFrame([("a", 1), ("c", 2)], "k string, v int")
    codes = spark.createDataFrame([("a", 7), ("b", 8)], "m string, code int")
    got = {r["k"]: r["code"] for r in encode.encode_lookup(df, "k", codes, "m", "code").collect()}
    assert got == {"a": 7, "c": None}
    named = prep.add_prefix(df, ["v"], "woe_")
    assert "woe_v" in named.columns and prep.strip_prefix(named, "woe_").columns.count("v") == 1


@pytest.mark.parametrize("token, want", [("DEC/20", dt.date(2020, 10, 31)), ("jan/21", dt.date(2020, 11, 30)),
                                         ("FEB/02", dt.date(2001, 12, 31)), (" Apr/24 ", dt.date(2024, 2, 29))])
def test_report_dates(spark, token, want):
    assert dates.report_date(token) == want
    df = spark.createDataFrame([(token.strip(),)], "t string")
    assert df.select(dates.report_date_col("t")).first()[0] == want


def test_synthetic_dates_are_month_ends(spark):
    got = {r[0] for r in make_synthetic(spark, 300).selectExpr("last_day(report_dt) = report_dt").distinct().collect()}
    assert got == {True}


def test_a_snapshot_that_cannot_be_read_is_an_error(spark, tmp_path):
    snap = tmp_path / "snap"
    snap.mkdir()
    (snap / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        io.read_through(spark, str(snap), lambda: spark.range(3)).count()
    assert (snap / "part-0.parquet").read_bytes() == b"no parquet"


def test_two_writers_get_two_versions(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert io.claim_version(spark, path, "model", 1) == 1      # a writer that has not appended its run yet
    assert io.register_run(spark, path, "model", {}) == 2
    assert io.register_run(spark, path, "model", {}) == 3
    assert sorted(r.version for r in io.read_registry(spark, path).collect()) == [2, 3]


def test_a_package_is_published_whole(spark, tmp_path):
    from giniflow.operators import models
    df = spark.range(60).selectExpr("cast(id as double) AS x", "cast(id > 30 as int) AS y", "concat('c', id % 3) AS c")
    fitted = models.fit(df, ["x"], ["c"], "y", "LR")
    src, dst = str(tmp_path / "run"), str(tmp_path / "deployed")
    assert not io.publish_package(spark, src, dst)
    io.save_model_package(spark, fitted.model, src, ["x", "c"], ["c"], encode.category_long(df, ["c"]).distinct(),
                          {"depth": 2}, {"oot": "FEB/02"})
    assert io.publish_package(spark, src, dst) and io.publish_package(spark, src, dst)
    assert spark.read.parquet(f"{dst}/categories").count() == 3
    _, meta = io.load_model_package(spark, dst)
    assert meta["config"] == {"oot": "FEB/02"} and meta["params"] == {"depth": 2}
