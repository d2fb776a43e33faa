"""Running sums, neighbours and exact ranks without a single-task global window.

``Window.orderBy`` with no partition (or a partition that holds a third of the data, such as one class of the target)
moves every row through one task. The helpers here cut the ordered rows of all groups into ranges of about equal size
(``repartitionByRange``: the bounds come from a sample, each row finds its range by bisection), so that:

1. range totals are a small table (groups x ranges); their cumulative offsets are computed from that table;
2. the running sum inside a range is a window partitioned by ``(group, range)``, spread over many tasks; a rank needs no
   window, as rows are numbered in the sorted ranges;
3. the offsets are joined back by (group, range).

The number of ranges follows the number of rows, so a task's work is the same at any size and the whole is linear in the
rows (times the logarithm of the number of ranges). A frame cut into ranges is stored once, so all readers see the same
bounds. The small tables are computed by their own small job and re-enter the plan as local relations, which keeps every
plan linear in the number of steps. The result is exact; the ranges only decide how work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from giniflow.session import materialize

ALL = "__all"
SMALL_LIMIT = 100_000   # rows up to which a side table is read back through the driver and broadcast


def small_table(df: DataFrame, limit: int = SMALL_LIMIT) -> DataFrame:
    """Evaluate an aggregate once, for use as the side of joins: a broadcast local relation up to ``limit`` rows (checked),
    a stored table joined by its keys beyond."""
    side = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = side.limit(limit + 1).collect()
        if len(rows) > limit:
            return materialize(side, "side")
    finally:
        side.unpersist()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


ROWS_PER_BUCKET = 50_000   # rows that one window partition sorts


def buckets_for(n_rows: int) -> int:
    """Buckets of an ordered domain of ``n_rows`` rows, so that a bucket stays one task's work at any size."""
    return max(1, -(-int(n_rows) // ROWS_PER_BUCKET))


def join_side(df: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of a side table that has one row per key; NULL keys match NULL keys."""
    names = {k: f"__side_{k}" for k in keys}
    renamed = side.withColumnsRenamed(names)
    on = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(renamed[names[k]])
    return df.join(renamed, on).drop(*names.values())


def _group_cols(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str], bool]:
    by = list(by)
    if by:
        return df, by, False
    return df.withColumn(ALL, F.lit(0)), [ALL], True


def bucket_offsets(df: DataFrame, by: Sequence[str], bucket_col: str, values: Sequence[str]) -> DataFrame:
    """Small table ``(by..., bucket, __o_<v>)``: sum of v over the earlier buckets of the same group."""
    keys = [*by, bucket_col]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    w = Window.partitionBy(*by).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(f"__t_{v}").over(w), F.lit(0)).alias(f"__o_{v}")
                                     for v in values])
    return small_table(offsets)


def running_sum(df: DataFrame, by: Sequence[str], order_cols: Sequence[str], bucket_col: str,
                values: Sequence[str], inclusive: bool = True, suffix: str = "_cum") -> DataFrame:
    """Add ``<v><suffix>`` = sum of ``v`` over earlier rows of the same group in ``order_cols`` order.

    ``inclusive`` includes the current row. ``bucket_col`` must be non-decreasing along ``order_cols`` within a group.
    The order must be unique within a group for a row-exact result (callers compress ties first).
    """
    df, by, added = _group_cols(df, by)
    keys = [*by, bucket_col]
    offsets = bucket_offsets(df, by, bucket_col, values)
    end = Window.currentRow if inclusive else -1
    w_local = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, end)
    local = df.select("*", *[F.coalesce(F.sum(v).over(w_local), F.lit(0)).alias(f"__l_{v}") for v in values])
    out = join_side(local, offsets, keys).select(
        *df.columns, *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).alias(f"{v}{suffix}") for v in values])
    return out.drop(ALL) if added else out


def range_bucket(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n_buckets: int,
                 out: str = "__bucket") -> DataFrame:
    """``df`` cut into ``n_buckets`` ranges of (by, order), stored; ``out`` is non-decreasing along ``order`` in a group."""
    if n_buckets <= 1:
        return df.withColumn(out, F.lit(0))
    return materialize(df.repartitionByRange(n_buckets, *by, *order).withColumn(out, F.spark_partition_id()), "ranges")


def exact_rank(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], out: str = "rank",
               n_buckets: int | None = None) -> DataFrame:
    """1-based rank of each row within ``by`` along ``order`` (which has to be unique there), the same as
    ``row_number() over (partition by <by> order by <order>)``, for columns of any orderable type.

    Rows are numbered inside the sorted ranges; the rank is that number from the group's first row in the range on, plus
    the group's rows in earlier ranges. A range holds about the same number of rows at any size."""
    df, by, added = _group_cols(df, by)
    n = n_buckets or buckets_for(df.count())
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)       # place inside the partition
    rows = materialize(df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
                       .select("*", F.spark_partition_id().alias("__bucket"), number.alias("__at")), "ranks")
    w = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy(*by, "__bucket").agg(F.min("__at").alias("__lo"), F.count(F.lit(1)).alias("__n"))
    offsets = small_table(first.select(*by, "__bucket", (F.coalesce(F.sum("__n").over(w), F.lit(0)) - F.col("__lo"))
                                       .alias("__o")))
    ranked = join_side(rows, offsets, [*by, "__bucket"]).withColumn(out, F.col("__at") + F.col("__o") + 1)
    return ranked.drop("__bucket", "__at", "__o", *([ALL] if added else []))


def ordered_running_sum(df: DataFrame, by: Sequence[str], order_col: str, values: Sequence[str],
                        inclusive: bool = True, descending: bool = False, n_buckets: int = 64,
                        suffix: str = "_cum") -> DataFrame:
    """Running sum along an order column that is unique within a group."""
    src = df
    order = order_col
    if descending:
        src = src.withColumn("__neg_order", -F.col(order_col))
        order = "__neg_order"
    b = range_bucket(src, by, [order], n_buckets)
    r = running_sum(b, by, [order], "__bucket", values, inclusive=inclusive, suffix=suffix).drop("__bucket")
    return r.drop("__neg_order") if descending else r


def next_in_order(df: DataFrame, group: str, order: str, bucket: str, cols: Sequence[str], back: bool = False
                  ) -> DataFrame:
    """``__next_<c>`` = value of ``c`` on the next row of the group in ``order`` (with ``back``: on the row before), NULL
    where there is none. What the rows at the edge of a range see comes from a small table of the ranges' edge rows."""
    step, edge = (F.lag, F.max_by) if back else (F.lead, F.min_by)
    w = Window.partitionBy(group, bucket).orderBy(order)
    local = df.select("*", *[step(c).over(w).alias(f"__next_{c}") for c in cols])
    edges = df.groupBy(group, bucket).agg(*[edge(F.col(c), F.col(order)).alias(f"__edge_{c}") for c in cols])
    wb = Window.partitionBy(group).orderBy(bucket)
    nxt = small_table(edges.select(group, bucket, *[step(f"__edge_{c}").over(wb).alias(f"__nb_{c}") for c in cols]))
    out = join_side(local, nxt, [group, bucket])
    return out.select(*df.columns, *[F.coalesce(F.col(f"__next_{c}"), F.col(f"__nb_{c}")).alias(f"__next_{c}")
                                     for c in cols])


__all__ = ["running_sum", "exact_rank", "range_bucket", "ordered_running_sum", "next_in_order", "small_table",
           "bucket_offsets", "T"]
