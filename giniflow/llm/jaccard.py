"""N-gram Jaccard join (operator 2): token-combination prefixes.

A document is the set of its word n-grams, as 64-bit hashes (tokens). Two sets of sizes a and b with Jaccard similarity t
share at least ``t / (1 + t) * (a + b)`` tokens. Under any order of all tokens that is the same for all documents, the
first shared token lies in the first ``n - ceil(t n) + 1`` tokens (the prefix) of both. Tokens are ordered rare before
frequent, then by hash, so prefixes avoid tokens that many documents hold:

* rare tokens of the prefix are indexed one by one; a list has a bounded length by the definition of rare;
* where a prefix holds frequent tokens, no rare token may be shared. The prefix is then extended so that any partner
  shares at least d + 2 frequent tokens in it, d being the largest possible symmetric difference. Between these lie more
  gaps than there are unshared tokens, so two of them are neighbours in both documents: pairs of neighbouring frequent
  tokens are indexed.

What is frequent is counted over all documents: over the first tokens by hash of every set (twice the prefix, so a
document whose prefix loses its frequent tokens has the next rare ones at hand), and over the whole sets of documents
that have too few rare tokens there. The counts only set the order; any order gives the same links.

Candidates pass the length filter, the position filter and a parity sketch (the number of differing bits never exceeds
the symmetric difference), then their sets are compared. Equal sets are one class and joined once. A list of frequent
pairs may be of any length: its members are first compared with one pivot, and then only with members that are not yet
in the same component. So no link between different sets is lost, and copies are not expanded into all pairs.

Null or empty texts have an empty set and link with nothing. Rows are told apart by id and text; a null id joins and
takes the least id of its component (null if there is none). Repeated rows are equal sets. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import WordHashes, ascii_lower_bytes, few_partitions, stored, word_hashes
from giniflow.llm.components import components
from giniflow.llm.lists import across

#: Words in an n-gram; similarity in percent.
WIDTH, PERCENT = 3, 90
#: A token is frequent beyond so many documents; at least so many first tokens of a set are kept.
RARE, LEAST_HEAD = 20, 64
#: Numbers of 64 bits to which the parity sketch is folded where it filters inside a join.
FOLD = 8
#: Narrow rows that take as much work as one with its first tokens, and as one with a text.
WIDE, WHOLE = 10, 100
#: Bits of the parity sketch. Node lists are broadcast up to so many rows and joined by a shuffle beyond.
SKETCH_BITS, BROADCAST_NODES = 2048, 1_000_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def token_set(text: str | None, seen: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's n-grams; the whole sequence where there are fewer words."""
    words = ascii_lower_bytes(text or "").split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = seen.of(words)
    k = min(width, len(words))
    with np.errstate(over="ignore"):
        grams = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            grams = _mix(grams + hashes[j:len(words) - k + 1 + j])
    return np.unique(grams)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """n - ceil(t n) + 1"""
    return n - -(-percent * n // 100) + 1


def extended_size(n: int, percent: int = PERCENT) -> int:
    """Prefix in which a partner shares at least d + 2 tokens; d: largest symmetric difference, with n / t the size of
    the largest partner."""
    d = n * (100 - percent) // percent
    return prefix_size(n, percent) + d + 1


def head_size(n: int, percent: int = PERCENT) -> int:
    return min(n, max(2 * prefix_size(n, percent), LEAST_HEAD))


def parity_sketch(tokens: np.ndarray) -> bytes:
    bits = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _fields(schema: str, *columns) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "longs": pa.list_(pa.int64())}
    names = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, names, strict=True)],
                                      names=[n for n, _ in names])


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_NODES else df


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def describe(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of every row: its number, id and text key, set size, digest of the set, first tokens by hash, sketch."""
    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key(F.col("text")).alias("key"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = "n int, digest binary, held int, head binary, sketch binary, fold longs"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = word_hashes()
        for part in parts_of(batches):
            rows = []
            for text in part.column(3):
                t = token_set(text.as_py(), seen, width)
                held = head_size(len(t), percent)
                sketch = parity_sketch(t)
                rows.append((len(t), hashlib.blake2b(t.tobytes(), digest_size=16).digest(), held, t[:held].tobytes(), sketch,
                             np.bitwise_xor.reduce(np.frombuffer(sketch, np.int64).reshape(-1, FOLD)).tolist()))
            out = _fields(schema, *(zip(*rows, strict=True) if rows else [()] * 6))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *out.columns],
                                             names=["row", "doc_id", "key", *out.schema.names])

    return source.mapInArrow(run, f"row long, doc_id {kind}, key binary, {schema}".replace("longs", "array<long>"))


def parts_of(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about ``most`` bytes, so that what a task holds does not grow with the length of its rows."""
    for batch in batches:
        n = max(1, most * max(batch.num_rows, 1) // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def sets_of(docs: DataFrame, wanted: DataFrame, width: int, most: int | None = None) -> DataFrame:
    """(node, tokens) of the nodes in ``wanted`` (node, key), ``most`` of them at most, read from the texts again."""
    wanted = stored(wanted.select("node", "key").distinct(), "wanted", few=True, rows=most)
    size = wanted.count()
    texts = docs.select("text").withColumn("key", text_key(F.col("text"))).join(
        _small(wanted, size), "key").dropDuplicates(["node"]).select("node", "text")
    texts = few_partitions(texts, WHOLE * size)  # before the Python step, which starts anew for each partition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = word_hashes()
        for part in parts_of(batches):
            sets = [token_set(t.as_py(), seen, width).tobytes() for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "tokens"])

    return stored(texts.mapInArrow(run, "node long, tokens binary"), "sets")


def exploded(rows: DataFrame, column: str) -> DataFrame:
    """(node, token) for every token of a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            tokens = [np.frombuffer(b.as_py(), np.int64) for b in part.column(1)]
            index = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(index)),
                                              pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)]))],
                                             names=["node", "token"])

    return rows.select("node", column).mapInArrow(run, "node long, token long")


def short(token: Column, bits: int) -> Column:
    """The last ``bits`` bits. Counts and lists may take tokens for equal that are not: sets are compared in full."""
    return token.bitwiseAND((1 << bits) - 1)


def frequent_tokens(rows: DataFrame, column: str, bits: int) -> DataFrame:
    return (exploded(rows, column).groupBy(short(F.col("token"), bits).alias("token")).agg(F.count(F.lit(1)).alias("c"))
            .where(F.col("c") > RARE).select("token"))


def hot_tokens(rows: DataFrame, column: str, frequent: DataFrame, n_frequent: int, bits: int) -> DataFrame:
    """(node, hot): the frequent tokens of each row that has any."""
    return exploded(rows, column).withColumn("token", short(F.col("token"), bits)).join(
        _small(frequent, n_frequent), "token").groupBy("node").agg(F.collect_set("token").alias("hot"))


def postings(rows: DataFrame, column: str, percent: int, bits: int) -> DataFrame:
    """(pair, sig, node, n, pos): single rare tokens of the prefix and neighbouring frequent ones of the extended prefix.
    ``column`` holds the whole set or, where that suffices, its first tokens. ``pos`` counts tokens that a partner found
    this way first cannot share: those before a single token, all rare ones before a pair."""
    schema = "pair boolean, sig long, node long, n int, pos int"
    mask, wide = np.uint64((1 << bits) - 1), np.int64((1 << min(63, bits + 8)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, 1 << 20):
            found = [[np.zeros(0, t)] for t in (bool, np.int64, np.int64, np.int32, np.int32)]
            for node, n, raw, hot in zip(*(c.to_pylist() for c in part.columns), strict=True):
                tokens = np.frombuffer(raw, np.uint64)
                often = np.isin(tokens & mask, np.array(hot or [], np.int64).astype(np.uint64))
                rare, many = tokens[~often], prefix_size(n, percent)
                single = rare[:many]
                both = np.zeros(0, np.uint64)
                if len(rare) < many:
                    last = tokens[often][:max(0, extended_size(n, percent) - len(rare))]
                    with np.errstate(over="ignore"):
                        both = _mix(_mix(last[:-1]) + last[1:])
                s, b = len(single), len(both)
                sig = np.concatenate([single, both]).view(np.int64) & wide
                place = np.concatenate([np.arange(s), np.full(b, len(rare))])
                for column, x in zip(found, (np.arange(s + b) >= s, sig, np.full(s + b, node), np.full(s + b, n), place), strict=True):
                    column.append(x)
            pairs, sigs, nodes, sizes, places = (np.concatenate(c) for c in found)
            yield _fields(schema, pairs, sigs, nodes, sizes.astype(np.int32), places.astype(np.int32))

    return rows.select("node", "n", column, "hot").mapInArrow(run, schema)


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length and position filter: at most the tokens from ``pos`` on are shared."""
    n, m, i, j = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.pos"), F.col(f"{y}.pos")
    need = percent * (n + m)
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * (n - i) >= need)
            & ((100 + percent) * (m - j) >= need))


def folded() -> list[Column]:
    return [F.col("fold")[k].alias(f"s{k}") for k in range(FOLD)]


def may_be_alike(x: str, y: str, percent: int) -> Column:
    """Whether two sets may be similar enough by their sizes and folded sketches: the bits that differ are never more than
    the tokens that do, and these are at most (1 - t) / (1 + t) * (n + m). ``x`` and ``y``: prefixes of n and s0, s1, ..."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    bits = F.lit(0)
    for k in range(FOLD):
        bits = bits + F.bit_count(F.col(f"{x}s{k}").bitwiseXOR(F.col(f"{y}s{k}")))
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * bits <= (100 - percent) * (n + m)))


def _pairs(x: DataFrame, y: DataFrame, on: Column, percent: int) -> DataFrame:
    return (x.alias("x").join(y.alias("y"), (F.col("x.sig") == F.col("y.sig")) & on & _may_link("x", "y", percent))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _with_both(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def sketch_filter(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    @F.arrow_udf("int")
    def differing(x: pa.Array, y: pa.Array) -> pa.Array:
        bits = [np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(len(c), -1) for c in (x, y)]
        return pa.array(np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1).astype(np.int32))

    # |x - y| + |y - x| <= (1 - t) / (1 + t) * (|x| + |y|) for every link
    rows = _with_both(pairs, reps, ["n", "sketch"])
    most = (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return rows.where((100 + percent) * differing("sketch_a", "sketch_b") <= most).select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, compared token by token."""
    @F.arrow_udf("boolean")
    def similar(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y, strict=True):
            s, t = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
            shared = len(np.intersect1d(s, t, assume_unique=True))
            out.append(100 * shared >= percent * (len(s) + len(t) - shared))
        return pa.array(out, pa.bool_())

    return _with_both(pairs, sets, ["tokens"]).where(similar("tokens_a", "tokens_b")).select("a", "b")


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components so far."""
    for side in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    root = lambda s: F.coalesce(f"root_{s}", s)
    return pairs.where(root("a") != root("b")).select("a", "b")


def links(docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, root) of the linked nodes. ``reps``: one row per node with n, key, held, head and sketch."""
    # n tokens can link with n + 1 only if n / (n + 1) is similar enough; smaller sets link with equal ones only
    reps = reps.where(100 * F.col("n") >= percent * (F.col("n") + 1))
    total, n_nodes = reps.agg(F.sum("held"), F.count(F.lit(1))).first()
    total = total or 0
    bits = min(63, max(24, total.bit_length() + 6))
    rows = reps.select("node", "n", "key", "held", "head")
    frequent = stored(frequent_tokens(rows, "head", bits), "frequent", few=True, rows=total // RARE)

    def look_up(rows: DataFrame, column: str) -> DataFrame:
        return hot_tokens(rows, column, frequent, frequent.count(), bits)

    def dense_of(hot: DataFrame) -> DataFrame:
        """Nodes whose head lacks the rare tokens of a prefix while there are more tokens behind it."""
        few = F.col("held") - F.size("hot") < F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
        return rows.select("node", "n", "key", "held").join(hot, "node").where((F.col("held") < F.col("n")) & few)

    hot = stored(look_up(rows, "head"), "hot", few=True, rows=WIDE * n_nodes)
    dense = stored(dense_of(hot).select("node", "n", "key"), "dense", few=True, rows=n_nodes)
    if dense.limit(1).count():  # documents made of frequent tokens: count their whole sets, too
        sets = sets_of(docs, dense, width, n_nodes)
        frequent = stored(frequent.union(frequent_tokens(sets, "tokens", bits)).distinct(), "frequent", few=True)
        hot = stored(look_up(rows, "head"), "hot", few=True, rows=WIDE * n_nodes)
        dense = stored(dense_of(hot).select("node", "n", "key"), "dense", few=True, rows=n_nodes)
        whole = sets_of(docs, dense, width, n_nodes).join(dense.select("node", "n"), "node")
        n_dense = dense.count()
        sparse = rows.join(_small(dense.select("node"), n_dense), "node", "left_anti").join(hot, "node", "left")
        whole = whole.join(look_up(whole, "tokens"), "node", "left")
        indexed = postings(few_partitions(sparse, WIDE * n_nodes), "head", percent, bits).unionByName(
            postings(few_partitions(whole, WHOLE * n_dense), "tokens", percent, bits))
    else:
        indexed = postings(few_partitions(rows.join(hot, "node", "left"), WIDE * n_nodes), "head", percent, bits)
    indexed = stored(indexed, "postings")

    single, pair = indexed.where(~F.col("pair")), indexed.where("pair")
    # stored, so that Spark can split a long list in the join with its pivot
    pivots = stored(pair.groupBy("sig").agg(F.min(F.struct("pos", "node", "n")).alias("m"), F.count(F.lit(1)).alias("c"))
                    .where("c > 1").select("sig", "m.*"), "pivots", few=True, rows=pair.count() // 2)
    found = _pairs(single, single, F.col("x.node") < F.col("y.node"), percent).unionByName(
        _pairs(pivots, pair, F.lit(True), percent)).distinct()
    found = stored(sketch_filter(found, reps, percent), "candidates", few=True)
    return _confirmed(docs, reps, found, pair, width, percent, n_nodes)


def _confirmed(docs: DataFrame, reps: DataFrame, found: DataFrame, pair: DataFrame, width: int, percent: int,
               n_nodes: int) -> DataFrame:
    keys = reps.select("node", "key")
    ends = found.select(F.col("a").alias("node")).union(found.select(F.col("b").alias("node")))
    ends = ends.union(pair.select("node")).distinct()
    sets = sets_of(docs, keys.join(ends, "node"), width, n_nodes)

    # one pair per node first: what they join need not be compared again
    first = found.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    roots = components(linked(first, sets, percent), rows=n_nodes)
    more = stored(linked(_across(found, roots), sets, percent), "links", few=True)
    n_more = more.count()
    if n_more:
        roots = components(more.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), rows=n_more + n_nodes)

    # members of a list of frequent pairs that are not in the same component yet
    rest = across(pair.drop("pair"), roots, reps.select("node", "n", *folded()), lambda x, y: may_be_alike(x, y, percent),
                  lambda x, y: _may_link(x, y, percent))
    rest = stored(sketch_filter(rest, reps, percent), "candidates", few=True)
    n_rest = rest.count()
    if not n_rest:
        return roots
    return components(linked(rest, sets, percent).union(
        roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), rows=n_rest + n_nodes)


def row_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """row, doc_id, key, n and root of every row; equal sets have one root, empty sets none."""
    rows = stored(describe(docs, width, percent), "described")
    classes = stored(rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node")), "classes", few=True,
                     rows=rows.count())
    first = _small(classes.select(F.col("node").alias("row")), classes.count())
    reps = rows.join(first, "row", "left_semi").withColumnRenamed("row", "node").drop("doc_id", "digest")
    roots = links(docs, reps, width, percent)
    named = classes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    return rows.select("row", "doc_id", "key", "n", "digest").join(named, "digest", "left").drop("digest")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text_col: str = "text",
                       id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    rows = row_components(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), width, percent)
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that with the least id (null last, then by text); all columns unchanged. Rows with an
    empty set all stay."""
    rows = stored(row_components(docs.select("doc_id", "text"), width, percent).where("root is not null"), "rows", few=True)
    n_rows = rows.count()
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    kept = rows.groupBy("root").agg(F.min(place).alias("kept"))
    gone = stored(rows.join(kept, "root").where(~place.eqNullSafe(F.col("kept")))
                  .select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")).distinct(), "gone", few=True, rows=n_rows)
    twice = stored(rows.groupBy("doc_id", "key").count().where("count > 1")
                   .select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")), "twice", few=True, rows=n_rows // 2)
    tagged = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].alias("_id"),
                         text_key(docs["text"]).alias("_key"))
    on = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_key") == F.col("_gone_key"))
    out = tagged.join(_small(gone, gone.count()), on, "left_anti")
    n_twice = twice.count()
    if n_twice:  # equal rows of the kept document
        several = out.join(_small(twice, n_twice), on, "left_semi").dropDuplicates(["_id", "_key"])
        out = out.join(_small(twice, n_twice), on, "left_anti").unionByName(several)
    return out.select("row.*")
