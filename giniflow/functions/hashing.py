"""Row-keyed pseudo-randomness.

Every random choice in the library (splits, samples, folds, draws, permutations) is a hash of the row key and a salt,
never ``rand()``: the choice is stable under any re-partitioning, survives task retries unchanged, and DuckDB can
reproduce it bit for bit.

``h(key, salt)`` = the first 32 bits of ``md5(key || ':' || salt)`` as an unsigned integer; ``u = h / 2^32``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_text(key: str | Sequence[str]) -> Column:
    """A row key as one string: the column itself, or the columns of a composite key joined by a unit separator (a NULL
    part is the empty string after a second separator, so it equals no value)."""
    if isinstance(key, str):
        return F.col(key).cast("string")
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1f")) for c in key])


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise when two rows share the key: splits and joins are exact for unique keys only."""
    cols = key_columns(key)
    repeated = df.groupBy(*cols).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"row key {cols} is not unique, e.g. {repeated[0].asDict()}")


def row_hash(key: str | Column, salt: str | int) -> Column:
    """Unsigned 32-bit hash of a string key (bigint column)."""
    digest = F.md5(F.concat(_col(key).cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def row_uniform(key: str | Column, salt: str | int) -> Column:
    """Uniform in [0, 1) from the row key."""
    return row_hash(key, salt) / F.lit(TWO_POW_32)


def duck_hash(key_sql: str, salt: str | int) -> str:
    """The same hash as DuckDB SQL text (used by the oracle queries)."""
    return f"('0x'||substr(md5(CAST({key_sql} AS VARCHAR)||':{salt}'),1,8))::BIGINT"


def duck_uniform(key_sql: str, salt: str | int) -> str:
    return f"({duck_hash(key_sql, salt)} / CAST(4294967296 AS DOUBLE))"
