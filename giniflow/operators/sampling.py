"""Splitting and resampling by a hash of the row key.

Exact sizes (``ceil(0.2*n)`` test rows, ``int(n_min/ratio)`` kept majority rows, fold boundaries) need the k-th smallest
row in (hash, key) order. ``order_statistics`` finds it without sorting or shuffling rows: a 32-bit hash is resolved in
three small histogram passes (12 + 10 + 10 bits, each a map-side-combined ``groupBy`` whose result is at most a few
thousand rows per requested rank), and the final tie on equal hashes is broken by the key among the handful of rows that
share the hash. Selection is then a filter ``(h, key) <= (H, K)``, so a split costs scans, not a shuffle of the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.functions.hashing import key_text, row_hash
from giniflow.operators.prefix import buckets_for, exact_rank
from giniflow.session import materialize, release_shuffles

LEVELS = ((20, 12), (10, 10), (0, 10))   # (shift, bits) of the hash resolved per pass
BEFORE_ALL = (-1, "")                    # boundary below every row (rank 0)


def _group_filter(by: Sequence[str], group: tuple) -> Column:
    cond = F.lit(True)
    for c, v in zip(by, group):
        cond = cond & (F.col(c).isNull() if v is None else (F.col(c) == F.lit(v)))
    return cond


def order_statistics(df: DataFrame, by: Sequence[str], hash_col: str, key_col: str,
                     wanted, stored: bool = False, whole: set | None = None) -> dict[tuple[tuple, int], tuple[int, str]]:
    """For each (group, r) return the (hash, key) of the r-th smallest row (1-based) of the group.

    ``wanted`` is a list of (group, r) or a function of the group sizes ``{group: n}`` returning such a list (the sizes
    come for free from the first histogram pass). r <= 0 returns ``BEFORE_ALL``. ``key_col`` must be unique within a
    group (it breaks hash ties). ``stored``: ``df`` is a stored table whose passes read the group and hash columns only, so
    nothing is kept. ``whole`` receives the (group, r) that no row of the same hash follows."""
    by = list(by)
    result: dict = {}
    todo = {}
    # only (group, hash, key) is kept, so the plan of ``df`` runs once for all passes
    narrow = df.select(*by, hash_col, key_col)
    if not stored:
        narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prev_shift = 32
        first = True
        for shift, bits in LEVELS:
            if first:
                part = F.shiftright(F.col(hash_col), shift).alias("__p")
                rows = narrow.groupBy(*by, part).count().collect()
                sizes: dict = {}
                for row in rows:
                    g = tuple(row[c] for c in by)
                    sizes[g] = sizes.get(g, 0) + row["count"]
                want = wanted(sizes) if callable(wanted) else wanted
                for g, r in want:
                    if r <= 0:
                        result[(g, r)] = BEFORE_ALL
                    else:
                        todo[(g, r)] = (0, r)
                if not todo:
                    return result
                first = False
            else:
                prefixes = {(g, pref) for (g, _), (pref, _) in todo.items()}
                cond = F.lit(False)
                for g, pref in prefixes:
                    cond = cond | (_group_filter(by, g) & (F.shiftright(F.col(hash_col), prev_shift) == F.lit(pref)))
                part = F.shiftright(F.col(hash_col), shift).alias("__p")
                rows = narrow.where(cond).groupBy(*by, part).count().collect()
            counts: dict = {}
            for row in rows:
                g = tuple(row[c] for c in by)
                counts.setdefault((g, row["__p"] >> bits), []).append((row["__p"], row["count"]))
            for (g, r), (pref, resid) in list(todo.items()):
                cum = 0
                for p, c in sorted(counts[(g, pref)]):
                    if cum + c >= resid:
                        todo[(g, r)] = (p, resid - cum)
                        break
                    cum += c
                else:
                    raise ValueError(f"rank {r} exceeds the size of group {g}")
            prev_shift = shift
        cond = F.lit(False)
        for (g, _), (h, _) in todo.items():
            cond = cond | (_group_filter(by, g) & (F.col(hash_col) == F.lit(h)))
        ties: dict = {}
        for row in narrow.where(cond).collect():
            ties.setdefault((tuple(row[c] for c in by), row[hash_col]), []).append(row[key_col])
        for (g, r), (h, resid) in todo.items():
            keys = sorted(ties[(g, h)])
            result[(g, r)] = (h, keys[resid - 1])
            if whole is not None and keys[resid - 1] == keys[-1]:
                whole.add((g, r))
    finally:
        if not stored:
            narrow.unpersist()
    return result


def at_or_below(hash_col: str, key_col: str, bound: tuple[int, str | None]) -> Column:
    """Rows up to a boundary; without a key it takes all rows of its hash, and the keys are not read."""
    h, k = bound
    if k is None:
        return F.col(hash_col) <= F.lit(h)
    return (F.col(hash_col) < F.lit(h)) | ((F.col(hash_col) == F.lit(h)) & (F.col(key_col) <= F.lit(k)))


def _group_counts(df: DataFrame, by: Sequence[str]) -> dict[tuple, int]:
    return {tuple(r[c] for c in by): r["count"] for r in df.groupBy(*by).count().collect()}


# ---------------------------------------------------------------------------------------------------------------------

def split_holdout(df: DataFrame, frac: float, key: str | Sequence[str], seed: int | str, salt: str = "holdout",
                  out: str = "holdout", exact: bool = True) -> DataFrame:
    """Random (not stratified) hold-out: exactly ``ceil(frac*n)`` rows with the smallest hash are flagged.

    ``exact=False`` flags ``u < frac`` instead (no extra pass; the count is then binomial)."""
    hcol = f"__h_{out}"
    d = df.withColumn("__key", key_text(key)).withColumn(hcol, row_hash("__key", f"{salt}-{seed}"))
    if not exact:
        return d.withColumn(out, F.col(hcol) < F.lit(int(frac * 4294967296.0))).drop(hcol, "__key")
    stats = order_statistics(d, [], hcol, "__key", lambda sizes: [((), math.ceil(frac * sizes.get((), 0)))])
    bound = next(iter(stats.values())) if stats else BEFORE_ALL
    return d.withColumn(out, at_or_below(hcol, "__key", bound)).drop(hcol, "__key")


def sample_rows(df: DataFrame, frac: float, key: str | Sequence[str], seed: int | str, exact: bool = True) -> DataFrame:
    """Rows without replacement: exactly ``round(frac*n)`` rows (hash order), or ``u < frac`` when not exact."""
    hcol = "__h_sample"
    d = df.withColumn("__key", key_text(key)).withColumn(hcol, row_hash("__key", f"sample-{seed}"))
    if not exact:
        return d.where(F.col(hcol) < F.lit(int(frac * 4294967296.0))).drop(hcol, "__key")
    stats = order_statistics(d, [], hcol, "__key", lambda sizes: [((), int(round(frac * sizes.get((), 0))))])
    bound = next(iter(stats.values())) if stats else BEFORE_ALL
    return d.where(at_or_below(hcol, "__key", bound)).drop(hcol, "__key")


def undersample_target(n_min: int, n_maj: int, frac: float) -> int:
    """Majority rows kept so that the minority share becomes ``frac``: ``int(n_min / (frac/(1-frac)))``.
    A share below the present one would need new minority rows and is an error."""
    ratio = frac / (1.0 - frac)
    if ratio < n_min / n_maj:
        raise ValueError(f"undersampling to share {frac} is below the present minority share "
                         f"{n_min / (n_min + n_maj):.4f}")
    return int(n_min / ratio)


def undersample(df: DataFrame, label: str, frac: float, key: str | Sequence[str], seed: int | str,
                counts: dict | None = None) -> DataFrame:
    """Keep every minority row and exactly ``int(n_min/ratio)`` majority rows (smallest hash), without replacement."""
    hcol = "__h_under"
    d = df.withColumn("__key", key_text(key)).withColumn(hcol, row_hash("__key", f"under-{seed}"))
    chosen: dict = {}

    def wanted(sizes):
        c = counts or {g: n for g, n in sizes.items()}
        if len(c) != 2:
            raise ValueError("undersampling needs exactly two classes")
        (_, n_min), (majority, n_maj) = sorted(((g[0], n) for g, n in c.items()), key=lambda t: (t[1], t[0]))
        chosen["majority"] = majority
        chosen["keep"] = undersample_target(n_min, n_maj, frac)
        return [((majority,), chosen["keep"])]

    stats = order_statistics(d, [label], hcol, "__key", wanted)
    majority = chosen["majority"]
    bound = stats[((majority,), chosen["keep"])]
    return d.where((F.col(label) != F.lit(majority)) | at_or_below(hcol, "__key", bound)).drop(hcol, "__key")


def oversample_draws(n_min: int, n_maj: int, frac: float) -> int:
    """Extra minority draws: ``int(n_maj*ratio - n_min)``; a share below the present one is an error."""
    ratio = frac / (1.0 - frac)
    if ratio < n_min / n_maj:
        raise ValueError(f"oversampling to share {frac} is below the present minority share")
    return int(n_maj * ratio - n_min)


def oversample(df: DataFrame, label: str, frac: float, key: str | Sequence[str], seed: int | str,
               counts: dict | None = None) -> DataFrame:
    """All rows plus ``m`` minority draws with replacement.

    Draw j picks minority row number ``h(j) mod n_min + 1`` (row numbers in hash order). The draws are a distributed
    ``spark.range(m)``, aggregated to a copy count per drawn row, then joined to the minority rows on the row number and
    replicated with ``explode(sequence(...))``: no draw list passes through the driver. Labels are not null."""
    weighted = oversample_weights(df, label, frac, key, seed, counts)
    copies = F.explode(F.sequence(F.lit(1), F.col("__weight").cast("int")))
    return weighted.withColumn("__copy", copies).select(*df.columns)


def oversample_weights(df: DataFrame, label: str, frac: float, key: str | Sequence[str], seed: int | str,
                       counts: dict | None = None, out: str = "__weight") -> DataFrame:
    """The rows of `oversample`, each once, with the number of its copies: 1, plus the draws of a minority row."""
    spark = df.sparkSession
    counts = counts or _group_counts(df, [label])
    (minority, n_min), (majority, n_maj) = sorted(((g[0], c) for g, c in counts.items()), key=lambda t: (t[1], t[0]))
    m = oversample_draws(n_min, n_maj, frac)
    if m == 0:
        return df.withColumn(out, F.lit(1).cast("long"))
    wide = F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f":over-{seed}"))), 1, 15), 16, 10)
    draws = (spark.range(0, m, 1, max(spark.sparkContext.defaultParallelism, buckets_for(m) // 10)).select((wide.cast("bigint") % F.lit(n_min) + F.lit(1)).alias("__rn"))
             .groupBy("__rn").agg(F.count(F.lit(1)).alias("__copies")))
    mino = df.where(F.col(label) == F.lit(minority)).withColumn("__key", key_text(key))
    mino = mino.withColumn("__h_over", row_hash("__key", f"overrow-{seed}"))
    mino = exact_rank(mino, [], ["__h_over", "__key"], out="__rn")
    drawn = mino.join(draws, "__rn", "left").select(*df.columns, (F.coalesce("__copies", F.lit(0)) + 1).alias(out))
    return df.where(F.col(label) != F.lit(minority)).withColumn(out, F.lit(1).cast("long")).unionByName(drawn)


def resample_weights(df: DataFrame, label: str, kind: str, frac: float, key: str | Sequence[str], seed: int | str,
                     out: str = "weight") -> DataFrame:
    """`resample` without copies of rows: undersampling filters, oversampling counts copies in ``out``."""
    if (kind or "NONE").upper() == "OVER":
        return oversample_weights(df, label, frac, key, seed, out=out)
    return resample(df, label, kind, frac, key, seed).withColumn(out, F.lit(1).cast("long"))


def resample(df: DataFrame, label: str, kind: str, frac: float, key: str | Sequence[str], seed: int | str) -> DataFrame:
    kind = (kind or "NONE").upper()
    if kind == "UNDER":
        return undersample(df, label, frac, key, seed)
    if kind == "OVER":
        return oversample(df, label, frac, key, seed)
    return df


def stratified_folds(df: DataFrame, label: str, k: int, key: str | Sequence[str], seed: int | str, out: str = "fold") -> DataFrame:
    """Shuffled stratified k-fold: inside each class, rows in hash order are cut into k consecutive runs;
    row of rank r in a class of n rows gets fold ``ceil(r*k/n) - 1``. Class share per fold is within one row."""
    hcol = "__h_fold"
    d = df.withColumn("__key", key_text(key)).withColumn(hcol, row_hash("__key", f"fold-{seed}"))
    counts: dict = {}

    def wanted(sizes):
        counts.update(sizes)
        return [(g, (j * n) // k) for g, n in sizes.items() for j in range(1, k)]

    bounds = order_statistics(d, [label], hcol, "__key", wanted)
    fold = F.lit(0)
    for g, n in counts.items():
        in_class = _group_filter([label], g)
        passed = F.lit(0)
        for j in range(1, k):
            b = bounds[(g, (j * n) // k)]
            passed = passed + F.when(~at_or_below(hcol, "__key", b), 1).otherwise(0)
        fold = F.when(in_class, passed).otherwise(fold)
    return d.withColumn(out, fold.cast("int")).drop(hcol, "__key")


def split_dev_oot(df: DataFrame, date_col: str, oot_dates: Sequence, dev_dates: str | Sequence = "ALL"
                  ) -> tuple[DataFrame, DataFrame]:
    """DEV = dates not in OOT when ``dev='ALL'``, else dates in the DEV list; OOT = dates in the OOT list.
    ``isin`` on a date column is pushed to the parquet scan (row-group skipping, partition pruning)."""
    oot = df.where(F.col(date_col).isin(list(oot_dates)))
    if isinstance(dev_dates, str) and dev_dates.upper() == "ALL":
        dev = df.where(~F.col(date_col).isin(list(oot_dates)) | F.col(date_col).isNull())
    else:
        dev = df.where(F.col(date_col).isin(list(dev_dates)))
    return dev, oot


def four_pools(df: DataFrame, key: str | Sequence[str], date_col: str, oot_dates: Sequence, dev_dates: str | Sequence = "ALL",
               test_size: float = 0.2, valid_size: float | None = 0.25, seed: int = 19, label: str | None = None,
               sampler: str = "NONE", frac: float = 0.25) -> DataFrame:
    """One DataFrame with a ``pool`` column: TRAIN / VALID / TEST / OOT (or DEV / TEST / OOT without valid_size). A date in
    both lists is OOT. The rows are evaluated once and stored with their two hashes (callers select the columns they need
    first); the boundaries read the stored hashes, and every later use of the pools is a scan with comparisons.

    TEST = exactly ``ceil(test_size*n_dev)`` DEV rows; VALID = ``ceil(valid_size*n_rest)`` of the rest; the sampler runs on
    TRAIN only, so TEST, VALID and OOT keep the natural rate."""
    in_oot = F.col(date_col).isin(list(oot_dates))
    if isinstance(dev_dates, str) and dev_dates.upper() == "ALL":
        in_dev = ~in_oot | F.col(date_col).isNull()
    else:
        in_dev = F.col(date_col).isin(list(dev_dates)) & ~F.coalesce(in_oot, F.lit(False))
    in_oot, in_dev = F.coalesce(in_oot, F.lit(False)), F.coalesce(in_dev, F.lit(False))
    test_h, valid_h = row_hash(key_text(key), f"test-{seed}"), row_hash(key_text(key), f"valid-{seed}")
    hashes = {"__t": test_h, **({"__v": valid_h} if valid_size else {})}
    tagged = materialize(df.where(in_oot | in_dev).withColumns(hashes), "pools").withColumn("__key", key_text(key))
    release_shuffles(df.sparkSession)        # of the joins behind the rows
    dev = tagged.where(in_dev)
    test_at = smallest(dev, "__t", test_size)
    valid_at = smallest(dev.where(~at_or_below("__t", "__key", test_at)), "__v", valid_size) if valid_size else None
    rest = F.when(at_or_below("__v", "__key", valid_at), "VALID").otherwise("TRAIN") if valid_size else F.lit("DEV")
    pool = F.when(in_oot, "OOT").when(in_dev & at_or_below("__t", "__key", test_at), "TEST").when(in_dev, rest)
    out = tagged.withColumn("pool", pool).where(F.col("pool").isNotNull()).drop("__key", "__t", "__v")
    if valid_size and label is not None and sampler.upper() != "NONE":
        train = resample(out.where(F.col("pool") == "TRAIN"), label, sampler, frac, key, seed)
        out = train.unionByName(out.where(F.col("pool") != "TRAIN"))
    return out


def smallest(narrow: DataFrame, hash_col: str, frac: float) -> tuple[int, str | None]:
    """Boundary of the ``ceil(frac * n)`` rows of smallest (hash, key) of stored rows; without a key where the boundary row
    is the last one of its hash, so that later passes read no keys."""
    whole: set = set()
    stats = order_statistics(narrow, [], hash_col, "__key", lambda sizes: [((), math.ceil(frac * sizes.get((), 0)))],
                             stored=True, whole=whole)
    bound = next(iter(stats.values())) if stats else BEFORE_ALL
    return (bound[0], None) if whole or bound == BEFORE_ALL else bound


def oot_subsample(pools: DataFrame, frac: float, key: str | Sequence[str], seed: int | str, pool_col: str = "pool") -> DataFrame:
    """Down-sample the OOT pool only, when frac < 1: exactly ``round(frac * n_oot)`` OOT rows (half-even, as a
    fractional row sample does), the ones with the smallest hash; the other pools are untouched."""
    if frac >= 1.0:
        return pools
    hcol = "__h_oot"
    d = pools.withColumn("__key", key_text(key)).withColumn(hcol, row_hash("__key", f"oot-{seed}"))
    oot = d.where(F.col(pool_col) == F.lit("OOT"))
    stats = order_statistics(oot, [], hcol, "__key", lambda sizes: [((), int(round(frac * sizes.get((), 0))))])
    bound = next(iter(stats.values())) if stats else BEFORE_ALL
    keep = (F.col(pool_col) != F.lit("OOT")) | at_or_below(hcol, "__key", bound)
    return d.where(keep).drop(hcol, "__key")
