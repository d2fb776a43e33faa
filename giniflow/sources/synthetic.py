"""Synthetic scoring sample (S3): ``spark.range(n)`` with hash-derived values, so it is generated in parallel and is
identical for any partitioning.

Columns: ``epk_id`` (string client id in [1e6, 1e8)), ``report_dt`` (one of ``n_dates`` month ends, or the OOT date with
probability ``oot_part``), ``trg_flag`` (planted logistic signal, about ``weight`` positives, ``flip_y`` label flips),
informative / redundant / repeated / noise numeric features, and letter categories with missing values.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.functions.hashing import row_uniform

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _normal(key, salt) -> F.Column:
    """Standard normal by Box-Muller from two hash uniforms."""
    u1 = F.greatest(row_uniform(key, f"{salt}a"), F.lit(1e-12))
    u2 = row_uniform(key, f"{salt}b")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def make_synthetic(spark: SparkSession, n: int = 50_000, n_informative: int = 3, n_redundant: int = 1,
                   n_repeated: int = 3, n_cat: int = 3, weight: float = 0.01, flip_y: float = 0.01,
                   n_dates: int = 5, oot_part: float = 0.1, oot_date: dt.date = dt.date(2020, 10, 31),
                   seed: int = 19, scale: float = 10.0) -> DataFrame:
    key = F.col("id").cast("string")
    base = spark.range(n)
    inf = [_normal(key, f"inf{i}-{seed}") for i in range(n_informative)]
    cols = {f"feature_{i + 1}": inf[i] * F.lit(scale) for i in range(n_informative)}
    j = n_informative
    for r in range(n_redundant):
        cols[f"feature_{j + 1}"] = (inf[r % n_informative] + inf[(r + 1) % n_informative]) * F.lit(scale / 2)
        j += 1
    for r in range(n_repeated):
        cols[f"feature_{j + 1}"] = cols[f"feature_{(r % n_informative) + 1}"]
        j += 1
    z = sum(inf, F.lit(0.0)) / F.lit(max(n_informative, 1) ** 0.5)
    # intercept puts about ``weight`` of the rows in class 1
    import math
    b0 = math.log(weight / (1 - weight)) - 1.0
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(b0) + F.lit(2.0) * z)))
    y = (row_uniform(key, f"y-{seed}") < p).cast("int")
    flip = row_uniform(key, f"flip-{seed}") < F.lit(flip_y)
    y = F.when(flip, F.lit(1) - y).otherwise(y)
    month_ends = [dt.date(9999, m, calendar.monthrange(9999, m)[1]) for m in range(1, n_dates + 1)]
    dates = F.array(*[F.lit(d) for d in month_ends])
    pick = (F.floor(row_uniform(key, f"date-{seed}") * F.lit(n_dates)) + 1).cast("int")
    date = F.when(row_uniform(key, f"oot-{seed}") < F.lit(oot_part), F.lit(oot_date)).otherwise(
        F.element_at(dates, pick))
    cats = {}
    for c in range(n_cat):
        letter = F.substring(F.lit(LETTERS), (F.floor(row_uniform(key, f"cat{c}-{seed}") * 26) + 1).cast("int"), 1)
        cats[f"catfeature_{c + 1}_cd"] = F.when(row_uniform(key, f"catna{c}-{seed}") < F.lit(0.05),
                                                F.lit(None).cast("string")).otherwise(letter)
    epk = (F.lit(1_000_000) + F.floor(row_uniform(key, f"epk-{seed}") * F.lit(99_000_000))).cast("long").cast("string")
    return base.select(epk.alias("epk_id"), date.alias("report_dt"), y.alias("trg_flag"),
                       *[v.alias(k) for k, v in cols.items()], *[v.alias(k) for k, v in cats.items()])
