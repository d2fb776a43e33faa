"""Benchmark decontamination (operator 7): winnowing, in DataFrame operations only.

A text's fingerprints are the k-gram hashes that are the smallest (of equal ones the last) of any ``w`` consecutive
ones, with ``w = span - k + 1``. Two texts that share ``span`` words in a row share all k-grams of that span, hence its
smallest one: every span of at least ``span`` words is found. Fingerprints of documents and benchmark items are joined
by hash; each meeting carries the words around it and is extended to the left and right, compared word by word. Any
shared window that holds the k-gram lies within ``span - k`` words of it, so looking that far is exact, and the union
over all fingerprints gives every word inside any shared window.

Items of fewer words are one window each; they are joined by the window's whole text.

Null text has no words. Rows are kept apart by id and text, repeated rows get equal results, null ids work. Items
without words match nothing; a null item id counts for hits, not as an item. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import ascii_lower, stored

#: Words in a window of the rule, words in a fingerprinted k-gram.
SPAN, K = 10, 5
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark fingerprints are broadcast up to this many bytes and joined by a shuffle beyond.
BROADCAST_BYTES = 32 << 20
#: Documents with a hit are broadcast up to so many and joined by a shuffle of all documents beyond.
BROADCAST_HITS = 1_000_000
#: Equal rows that one list brings back.
SOME_ROWS = 10_000

_INT = 0x7FFFFFFF


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often and in whatever lambda the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def gram(ws: Column, at: Column, k: int) -> Column:
    """Hash of the k words from position ``at`` (from 0)."""
    return F.xxhash64(*[F.get(ws, at + j) for j in range(k)])


def fingerprints(text: Column, pad: str, span: int = SPAN, k: int = K, sized: bool = False) -> Column:
    """Array of (pos, hash, near): position from 0, hash of the k-gram there, and the words from ``span - k`` before it
    to ``span - k`` behind it, with ``pad`` beyond the ends of the text. ``sized`` puts an item in front whose pos is
    -1 less the number of words."""
    side, w = span - k, span - k + 1
    empty = F.array().cast("array<struct<pos:int,hash:bigint,near:array<string>>>")

    def picked(ws: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ws) - k)
        # 31 bits of the hash order the grams; of equal ones the last position is smallest
        order = F.transform(places, lambda i: F.shiftleft(gram(ws, i, k).bitwiseAND(_INT), 32)
                            .bitwiseOR((F.lit(_INT) - i).cast("long")))
        least = let(order, lambda o: F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size(ws) - span), lambda i: F.least(*[F.get(o, i + j) for j in range(w)]))))
        padded = F.concat(F.array_repeat(F.lit(pad), side), ws, F.array_repeat(F.lit(pad), side))
        return let(padded, lambda p: F.transform(least, lambda m: let(
            (F.lit(_INT) - m.bitwiseAND(_INT)).cast("int"),
            lambda i: F.struct(i.alias("pos"), gram(ws, i, k).alias("hash"),
                               F.slice(p, i + 1, 2 * side + k).alias("near")))))

    def all_of(ws: Column) -> Column:
        found = F.when(F.size(ws) >= span, picked(ws)).otherwise(empty)
        head = F.struct((-1 - F.size(ws)).alias("pos"), F.xxhash64(text).alias("hash"),
                        F.lit(None).cast("array<string>").alias("near"))
        return F.concat(F.array(head), found) if sized else found

    return let(words(text), all_of)


def _run(near: Column, other: Column, k: int, side: int, step: int) -> Column:
    """Equal words directly before (step -1) or behind (1) the k-gram in the middle of two neighbourhoods."""
    first = side - 1 if step < 0 else side + k
    out = F
    for n in range(side):
        j = first + step * n
        out = out.when(F.get(near, F.lit(j)) != F.get(other, F.lit(j)), n)
    return out.otherwise(side)


def window_hits(keyed: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, sized: bool = False) -> DataFrame:
    """doc_id, key, item_id and the hit words [from, past) of every meeting; ``keyed``: doc_id, key, text. ``sized`` adds
    a row for every document whose ``from`` is -1 less its number of words, so that one pass over the texts will do."""
    side = span - k
    items = stored(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
                   .select("item_id", F.explode(fingerprints(F.col("text"), "\n", span, k)).alias("f"))
                   .select("item_id", F.col("f.hash").alias("item_hash"), F.col("f.near").alias("other")),
                   "benchmark-prints", few=True, rows=100 * benchmark.count())
    size = items.agg(F.sum(F.octet_length(F.array_join("other", " ")) + 200)).first()[0] or 0
    prints = keyed.select("doc_id", "key", F.explode(fingerprints(F.col("text"), "", span, k, sized)).alias("f")).select(
        "doc_id", "key", F.col("f.pos").alias("pos"), F.col("f.hash").alias("hash"), F.col("f.near").alias("near"))
    met = prints.join(F.broadcast(items) if size <= BROADCAST_BYTES else items,
                      (F.col("hash") == F.col("item_hash")) & (F.col("pos") >= 0), "left" if sized else "inner")
    same = F.col("item_hash").isNotNull()
    for j in range(side, side + k):
        same = same & (F.get("near", F.lit(j)) == F.get("other", F.lit(j)))
    own = F.col("pos") < 0
    run = lambda step: _run(F.col("near"), F.col("other"), k, side, step)
    return (met.where(own | same).withColumn("left", run(-1)).withColumn("right", run(1))
            .where(own | (F.col("left") + F.col("right") + k >= span))
            .select("doc_id", "key", "item_id", F.when(own, F.col("pos")).otherwise(F.col("pos") - F.col("left")).alias("from"),
                    (F.col("pos") + k + F.col("right")).alias("past")))


def short_hits(keyed: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame | None:
    """The same for items of fewer than ``span`` words, None if there are none."""
    items = stored(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("ws"))
                   .where((F.size("ws") > 0) & (F.size("ws") < span))
                   .select("item_id", F.size("ws").alias("n"), F.array_join("ws", " ").alias("window")).distinct(),
                   "benchmark-short", few=True, rows=benchmark.count())
    stats = items.groupBy("n").agg(F.sum(F.octet_length("window") + 100).alias("bytes")).collect()  # below `span` rows
    if not stats:
        return None
    ns = sorted(r["n"] for r in stats)
    empty = F.array().cast("array<struct<pos:int,n:int,window:string>>")

    def windows_of(ws: Column, n: int) -> Column:
        window = lambda i: F.array_join(F.slice(ws, i + 1, n), " ")
        return F.when(F.size(ws) >= n, F.transform(
            F.sequence(F.lit(0), F.size(ws) - n),
            lambda i: F.struct(i.alias("pos"), F.lit(n).alias("n"), window(i).alias("window")))).otherwise(empty)

    windows = let(words(F.col("text")), lambda ws: F.flatten(F.array(*[windows_of(ws, n) for n in ns])))
    found = keyed.select("doc_id", "key", F.inline(windows))
    small = sum(r["bytes"] for r in stats) <= BROADCAST_BYTES
    return (found.join(F.broadcast(items) if small else items, ["n", "window"])
            .select("doc_id", "key", "item_id", F.col("pos").alias("from"), (F.col("pos") + F.col("n")).alias("past")))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, sized: bool = False) -> DataFrame:
    """doc_id, key, n_hit and item ids of the documents that share a window with an item; ``sized``: of all documents,
    with their number of words and of equal rows."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    hits = window_hits(keyed, benchmark, span, k, sized)
    short = short_hits(keyed, benchmark, span)
    hits = hits.unionByName(short) if short else hits
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("past")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["past"] - F.greatest(a["past"], s["from"]))).alias("n"),
                              F.greatest(a["past"], s["past"]).alias("past")))
    hit = F.col("from") >= 0
    return (hits.groupBy("doc_id", "key")
            .agg(F.collect_set(F.when(hit, F.struct("from", "past"))).alias("spans"),
                 F.collect_set("item_id").alias("items"), F.min("from").alias("least"),
                 F.count(F.when(~hit, 1)).alias("n_rows"))
            .select("doc_id", "key", (-1 - F.col("least")).cast("long").alias("n_words"), "n_rows",
                    covered["n"].cast("long").alias("n_hit"), F.array_sort("items").alias("items")))


def contamination_report(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of ``docs``."""
    found = benchmark_hits(docs.select("doc_id", "text"), benchmark, span, k, sized=True)
    # equal rows come back by two short lists, so a row that stands a thousand million times is never one long one
    more = F.sequence(F.lit(0).cast("long"), F.expr(f"(n_rows - 1) div {SOME_ROWS}"))
    rest = F.least(F.lit(SOME_ROWS).cast("long"), F.col("n_rows") - F.col("more") * SOME_ROWS)
    return (found.withColumn("more", F.explode(more)).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), rest)))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """The rows of ``docs`` without any hit, all columns unchanged."""
    hits = benchmark_hits(docs.select("doc_id", "text"), benchmark, span, k)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].alias("_id"),
                       F.xxhash64(docs["text"]).alias("_key"))
    hits = stored(hits.select(F.col("doc_id").alias("_hit_id"), F.col("key").alias("_hit_key")), "hits", few=True)
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_HITS else hits
    on = rows["_id"].eqNullSafe(hits["_hit_id"]) & (rows["_key"] == hits["_hit_key"])
    return rows.join(hits, on, "left_anti").select("row.*")
