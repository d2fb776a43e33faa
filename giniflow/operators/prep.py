"""Projections, cleaning and missing-value profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_CATEGORY = "nan"


def drop_prefix(df: DataFrame, prefix: str = "cred_") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def drop_listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist; unknown names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def category_expr(df: DataFrame, c: str) -> Column:
    """Category as a string; NULL, NaN and the strings 'nan' / 'None' all become the one marker 'nan'."""
    col = F.col(c)
    if _is_floating(df, c):
        col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
    s = col.cast("string")
    return F.when(s.isNull() | s.isin("nan", "None", "NaN"), F.lit(MISSING_CATEGORY)).otherwise(s)


def normalize_categories(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    cats = set(cats)
    return df.select(*[category_expr(df, c).alias(c) if c in cats else F.col(c) for c in df.columns])


def normalize_numeric(df: DataFrame, nums: Sequence[str]) -> DataFrame:
    """Cast to double; NaN becomes NULL (Spark orders NaN above +inf and lets it poison max/avg)."""
    nums = set(nums)
    out = []
    for c in df.columns:
        if c in nums:
            d = F.col(c).cast("double")
            out.append(F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def select_features(df: DataFrame, ids: Sequence[str], features: Sequence[str] | None = None,
                    target: str | None = None) -> DataFrame:
    """ids + target + chosen features (or every column when ``features`` is None)."""
    if features is None:
        return df
    keep = [*ids, *([target] if target else []), *features]
    return df.select(*[c for c in keep if c in df.columns])


def finite_bounds(df: DataFrame, nums: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Largest and smallest finite value per feature, in one aggregation (2 numbers per feature reach the driver)."""
    inf = float("inf")
    aggs = []
    for c in nums:
        d = F.col(c).cast("double")
        finite = d.isNotNull() & ~F.isnan(d) & (d != F.lit(inf)) & (d != F.lit(-inf))
        aggs += [F.max(F.when(finite, d)).alias(f"hi_{c}"), F.min(F.when(finite, d)).alias(f"lo_{c}")]
    if not aggs:
        return {}
    row = df.agg(*aggs).first()
    return {c: (row[f"hi_{c}"], row[f"lo_{c}"]) for c in nums}


def clip_infinite(df: DataFrame, nums: Sequence[str], bounds: dict | None = None) -> DataFrame:
    """+inf -> max finite + 1, -inf -> min finite - 1, per feature."""
    bounds = bounds if bounds is not None else finite_bounds(df, nums)
    inf = float("inf")
    out = []
    for c in df.columns:
        if c in bounds:
            hi, lo = bounds[c]
            d = F.col(c).cast("double")
            e = d
            if hi is not None:
                e = F.when(d == F.lit(inf), F.lit(hi + 1.0)).otherwise(e)
            if lo is not None:
                e = F.when(d == F.lit(-inf), F.lit(lo - 1.0)).otherwise(e)
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(cols) if cols is not None else None)


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


def missing_profile(df: DataFrame, features: Sequence[str], min_size: float = 0.05) -> DataFrame:
    """Per feature: missing rows, share, ``skipped`` (missing > (1-min_size)*n) and ``big_missing`` (> min_size*n).

    One pass for all features (one aggregation row), reshaped to long form on the cluster."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in features:
        col = F.col(c)
        miss = col.isNull() | (F.isnan(col) if _is_floating(df, c) else F.lit(False))
        aggs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("long").alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot(["__n"], list(features), "feature", "n_missing")
    n = F.col("__n").cast("double")
    return long.select(
        "feature", F.col("n_missing").cast("long").alias("n_missing"),
        F.round(F.col("n_missing") / n, 6).alias("share_missing"),
        (F.col("n_missing") > F.lit(1.0 - min_size) * n).alias("skipped"),
        (F.col("n_missing") > F.lit(min_size) * n).alias("big_missing"))


def distinct_dates(df: DataFrame, date_col: str) -> DataFrame:
    return df.select(date_col).where(F.col(date_col).isNotNull()).distinct().orderBy(date_col)


def dates_except(df: DataFrame, date_col: str, excluded: DataFrame) -> DataFrame:
    """All distinct dates minus the excluded ones (anti join), sorted."""
    d = df.select(date_col).where(F.col(date_col).isNotNull()).distinct()
    return d.join(excluded.select(F.col(excluded.columns[0]).alias(date_col)), date_col, "left_anti").orderBy(date_col)


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias("n_distinct"))


def add_prefix(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.col(c).alias(f"{prefix}{c}") if c in cols else F.col(c) for c in df.columns])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c[len(prefix):]) if c.startswith(prefix) else F.col(c) for c in df.columns])
