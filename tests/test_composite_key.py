"""Rows keyed by client and report date: ids repeat, pairs are unique."""

import math

import pytest
from pyspark.sql import functions as F

from giniflow.functions.hashing import assert_unique
from giniflow.operators import joins, sampling

KEY = ("client", "dt")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).selectExpr("concat('c', id % 1000) AS client", "date_add(date'2001-01-31', int(id / 1000)) AS dt",
                                        "cast(id % 7 = 0 as int) AS y", "id AS x").persist()


def test_uniqueness_check(rows):
    assert_unique(rows, KEY)
    with pytest.raises(ValueError):
        assert_unique(rows, "client")


def test_exact_sizes(rows):
    n, n_pos = rows.count(), rows.where("y = 1").count()
    assert sampling.split_holdout(rows, 0.2503, KEY, 1).where("holdout").count() == math.ceil(0.2503 * n)
    kept = sampling.undersample(rows, "y", 0.25, KEY, 1)
    assert kept.count() == n_pos + int(n_pos / (0.25 / 0.75)) and kept.columns == rows.columns
    over = sampling.oversample(rows, "y", 0.25, KEY, 1)
    assert over.count() == n + int((n - n_pos) * (0.25 / 0.75) - n_pos)
    folds = sampling.stratified_folds(rows, "y", 5, KEY, 1).groupBy("fold", "y").count().collect()
    assert len(folds) == 10 and all(max(r["count"] for r in folds if r["y"] == y) - min(
        r["count"] for r in folds if r["y"] == y) <= 1 for y in (0, 1))
    pools = sampling.four_pools(rows, KEY, "dt", [__import__("datetime").date(2001, 2, 4)], "ALL", 0.2, 0.25, 3)
    got = {r["pool"]: r["count"] for r in pools.groupBy("pool").count().collect()}
    assert got == {"OOT": 1000, "TEST": 800, "VALID": 800, "TRAIN": 2400}


def test_joins_do_not_multiply_rows(rows):
    scores = rows.select(*KEY, F.rand(1).alias("score"))
    assert joins.pools_with_scores(rows.withColumn("pool", F.lit("A")), scores, KEY).count() == 5000
    assert joins.align_labels(rows.drop("y"), rows.select(*KEY, "y"), KEY).count() == 5000
    both = joins.concat_columns(rows, scores, KEY)
    assert both.count() == 5000 and both.columns == [*KEY, "y", "x", "score"]
