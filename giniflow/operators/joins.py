"""Joins of the pipeline (J1, J3, J4, J5; J2 is ``encode.encode_lookup``, J6 ``stages.grid_cells``, J7
``importance.permute_column``).

All are equi-joins on a row key or a date. The planner picks the strategy from measured sizes (AQE); the only explicit
broadcast is of a date list, whose size is the number of report dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giniflow.functions.hashing import key_columns


def align_labels(features: DataFrame, labels: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Features and a separate label table on the same rows (inner equi-join on the key)."""
    return features.join(labels, key_columns(key), "inner")


def concat_columns(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Column-wise concatenation of two frames over the same rows; duplicate non-key names keep the left copy."""
    extra = [c for c in right.columns if c not in key_columns(key) and c not in left.columns]
    return left.join(right.select(*key_columns(key), *extra), key_columns(key), "inner")


def dates_semi(df: DataFrame, date_col: str, dates: Sequence) -> DataFrame:
    """Rows whose date is in the list (left semi join with the broadcast date list)."""
    d = df.sparkSession.createDataFrame([(x,) for x in dates], f"{date_col} date")
    return df.join(F.broadcast(d), date_col, "left_semi")


def dates_anti(df: DataFrame, date_col: str, dates: Sequence) -> DataFrame:
    """Rows whose date is not in the list (left anti join)."""
    d = df.sparkSession.createDataFrame([(x,) for x in dates], f"{date_col} date")
    return df.join(F.broadcast(d), date_col, "left_anti")


def pools_with_scores(pools: DataFrame, scores: DataFrame, key: str | Sequence[str], cols: Sequence[str] = ("pool",)) -> DataFrame:
    """Predictions aligned to the pool rows and labels by key (no sort needed)."""
    return pools.select(*key_columns(key), *cols).join(scores, key_columns(key), "inner")
