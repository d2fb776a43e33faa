"""Column-role rules over a schema (driver side, bounded by the number of columns)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType

# A column whose name ends with one of these suffixes is categorical.
CATEGORICAL_SUFFIXES = ("cd", "nflag", "group", "segm")


def is_categorical_name(name: str, known: Iterable[str] = ()) -> bool:
    """Pure suffix test (so ``abcd`` matches ``cd``) or membership in a known list."""
    return name.endswith(CATEGORICAL_SUFFIXES) or name in set(known)


def categorical_columns(columns: Sequence[str], known: Iterable[str] = ()) -> list[str]:
    known = set(known)
    return [c for c in columns if is_categorical_name(c, known)]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    exclude = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def order_features(features: Sequence[str]) -> list[str]:
    """Ordinary names first, then ``*_dt``, then ``lifestyle*``; each name once, input order kept within a group."""
    ordinary, dated, lifestyle = [], [], []
    for f in features:
        if f.startswith("lifestyle"):
            lifestyle.append(f)
        elif f.endswith("_dt"):
            dated.append(f)
        else:
            ordinary.append(f)
    return ordinary + dated + lifestyle


def common_columns(frames: Sequence[DataFrame]) -> list[str]:
    """Sorted intersection of the column names of all frames."""
    if not frames:
        return []
    names = set(frames[0].columns)
    for df in frames[1:]:
        names &= set(df.columns)
    return sorted(names)


def feature_projection_sql(features: Sequence[str], alias: str = "b") -> str:
    """Column list for a narrower extraction: one ``, <alias>.<feature>`` line per feature."""
    return "".join(f"\n, {alias}.{f}" for f in features)


def prefixed(features: Sequence[str], prefix: str) -> list[str]:
    return [f"{prefix}{f}" for f in features]


def unprefixed(names: Sequence[str], prefix: str) -> list[str]:
    return [n[len(prefix):] if n.startswith(prefix) else n for n in names]
