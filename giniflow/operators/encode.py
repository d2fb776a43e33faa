"""Category encoders fitted on a training frame: frequency code, ordinal code, one-hot, lookup.

Fitting is one aggregation over an unpivot of all categorical columns; the fitted dictionary holds one row per
(feature, category). Applying it is a left join per feature whose strategy the planner picks from the measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giniflow.operators.prefix import exact_rank
from giniflow.operators.prep import MISSING_CATEGORY, category_expr
from giniflow.session import materialize


def category_long(df: DataFrame, cats: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., feature, category)`` with categories normalised to strings ('nan' for missing)."""
    cols = [category_expr(df, c).alias(c) for c in cats]
    return df.select(*keep, *cols).unpivot(list(keep), list(cats), "feature", "category")


def frequency_codes(train: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Category -> rank by training frequency (1 = most frequent, ties by value); 'nan' -> -1 and keeps its slot."""
    counts = category_long(train, cats).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    return _ranked(counts, [F.col("n").desc(), "category"])


def ordinal_codes(train: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Category -> rank of the sorted distinct values from 1; 'nan' -> -1 and keeps its slot."""
    values = category_long(train, cats).select("feature", "category").distinct()
    return _ranked(values, ["category"])


def _ranked(values: DataFrame, order: Sequence) -> DataFrame:
    """Codes by rank. Values of all features are ranked together in ranges, so one with millions of values is spread."""
    ranked = exact_rank(materialize(values, "categories"), ["feature"], order)
    return ranked.select("feature", "category", F.when(F.col("category") == MISSING_CATEGORY, F.lit(-1))
                         .otherwise(F.col("rank").cast("int")).alias("code"))


def apply_codes(df: DataFrame, codes: DataFrame, cats: Sequence[str], value_col: str = "code",
                suffix: str = "") -> DataFrame:
    """Replace each categorical column by its code; unseen categories become NULL. One left join per feature with the
    stored dictionary, at any size; the planner broadcasts what is small."""
    codes = materialize(codes.select("feature", "category", value_col), "codes")
    coded = [c for c in df.columns if c in cats]
    result = df.withColumns({f"__k_{c}": category_expr(df, c) for c in coded})
    for c in coded:
        lookup = codes.where(F.col("feature") == c).select(F.col("category").alias(f"__k_{c}"),
                                                           F.col(value_col).alias(f"__v_{c}"))
        result = result.join(lookup, f"__k_{c}", "left")
    return result.select(*[F.col(f"__v_{c}").alias(c + suffix) if c in coded else F.col(c) for c in df.columns])


#: Columns that `one_hot` makes at most; a column with more values is for `one_hot_vectors`.
MOST_COLUMNS = 2000


def one_hot(train: DataFrame, df: DataFrame, cats: Sequence[str], drop_source: bool = True) -> DataFrame:
    """One 0/1 column ``<feature>_<value>`` per training value (values sorted); the source column is dropped."""
    found = category_long(train, cats).select("feature", "category").distinct().limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} values: use one_hot_vectors")
    per_feature: dict[str, list[str]] = {}
    for r in sorted(found):
        per_feature.setdefault(r["feature"], []).append(r["category"])
    extra = []
    for c in cats:
        e = category_expr(df, c)
        extra += [F.when(e == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}") for v in per_feature.get(c, [])]
    base = [F.col(c) for c in df.columns if not (drop_source and c in cats)]
    return df.select(*base, *extra)


def one_hot_vectors(train: DataFrame, df: DataFrame, cats: Sequence[str], suffix: str = "_vec"
                    ) -> tuple[DataFrame, DataFrame]:
    """One sparse 0/1 vector per categorical column with a slot per training value (values sorted), all zeros for an unseen
    one, and the dictionary (feature, category, slot). Any number of values: slots come by a join, nothing is collected
    but the number of values of each column."""
    from pyspark.ml.feature import OneHotEncoder
    values = materialize(category_long(train, cats).select("feature", "category").distinct(), "categories")
    slots = exact_rank(values, ["feature"], ["category"], out="__slot").select(
        "feature", "category", (F.col("__slot") - 1).alias("slot"))
    sizes = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {c: sizes.get(c, 0) for c in cats}
    coded = apply_codes(df.withColumns({f"__c_{c}": F.col(c) for c in cats}), slots.withColumn(
        "feature", F.concat(F.lit("__c_"), "feature")), [f"__c_{c}" for c in cats], value_col="slot")
    # an unseen value gets the slot behind the last one, which the encoder drops
    coded = coded.withColumns({f"__c_{c}": F.coalesce(F.col(f"__c_{c}"), F.lit(sizes[c])).cast("double") for c in cats})
    last = train.sparkSession.createDataFrame([tuple(float(max(sizes[c] - 1, 0)) for c in cats)],
                                              ", ".join(f"`__c_{c}` double" for c in cats))
    encoder = OneHotEncoder(inputCols=[f"__c_{c}" for c in cats], outputCols=[f"{c}{suffix}" for c in cats],
                            handleInvalid="keep", dropLast=True).fit(last)
    return encoder.transform(coded).drop(*[f"__c_{c}" for c in cats]), slots


def encode_lookup(df: DataFrame, key: str, mapping: DataFrame, map_key: str, value: str,
                  out: str | None = None) -> DataFrame:
    """Left lookup of ``key`` in a mapping table; unseen keys give NULL. The planner picks broadcast or sort-merge
    from the measured size of ``mapping`` (AQE), so an unexpectedly large dictionary never blows up executor memory."""
    m = mapping.select(F.col(map_key).alias(key), F.col(value).alias(out or value))
    return df.join(m, key, "left")
