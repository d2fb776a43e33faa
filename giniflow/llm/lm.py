"""Language-model scoring (operator 4): subword lattice likelihood.

The model is a unigram model over the pieces of an existing byte-level vocabulary, which covers every byte string. A
word (with the space before it) may be cut into pieces in many ways; its probability is the sum over all of them, found
by a forward recursion in log space. Pieces do not cross spaces, so the lattice of a text falls apart into its words, and
each different word of the corpus is summed once. Piece weights start from the training words' one cut by the tokenizer;
rounds of expectation (forward and backward over the lattices of all training words, by their counts) then replace them by
the pieces' expected counts over all cuts, smoothed by a small constant over the whole vocabulary.

Corpus statistics cover all training rows. Words and counts stay distributed: a block of documents (a split of the
input) sends its different words, gets back each word's count and log probability, and adds them up by document. A word
that every block holds is one row per block. The driver holds totals and the piece counts (bounded by the vocabulary).

Null text counts as empty: the end token alone. Rows need no key: repeated rows, null ids and extra columns do no harm.
Without training rows all counts are zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import id_bucket, stored
from giniflow.llm.tokens import TOKENIZER, tokenizer_path

#: Bytes of input that make one block at most.
BLOCK_BYTES = 16 << 20
LOG10 = math.log(10)
#: Rounds of expectation after the one-cut counts; what is added to every piece's expected count.
ROUNDS, SMOOTHING = 3, 0.1


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased (A-Z) words of all texts, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    kept = real.to_numpy(zero_copy_only=False)
    return words.filter(real), np.bincount(owner[kept], minlength=len(lists))


def file_blocks(spark) -> Column:
    """Block of a row of a file-based table: its split, halved until it is small enough."""
    split = spark.conf.get("spark.sql.files.maxPartitionBytes", "128m").strip().lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30}
    size = int(split[:-1]) << units[split[-1]] if split[-1] in units else int(split)
    parts = max(1, -(-size // BLOCK_BYTES))
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                      F.pmod(F.xxhash64("doc_id"), F.lit(parts)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(block, word, c): the different words of each block with their counts in its training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        rows = 0

        def summed() -> pa.Table:
            return pa.concat_tables(parts).group_by(["block", "word"]).aggregate([("c", "sum")]).rename_columns(
                ["block", "word", "c"])

        for batch in batches:
            words, sizes = split_words(batch.column("text"))
            block = np.repeat(batch.column("block").to_numpy(), sizes)
            train = np.repeat(batch.column("train").to_numpy(zero_copy_only=False), sizes).astype(np.int64)
            parts.append(pa.table({"block": block, "word": words, "c": train}).group_by(["block", "word"]).aggregate(
                [("c", "sum")]).rename_columns(["block", "word", "c"]))
            rows += len(parts[-1])
            if rows > 2_000_000 and len(parts) > 1:
                parts = [summed()]
                rows = len(parts[0]) // 2
        if parts:
            yield from summed().to_batches(max_chunksize=100_000)

    return docs.select("block", "train", "text").mapInArrow(run, "block long, word string, c long")


@cache
def pieces(path: str) -> tuple[dict[bytes, int], int]:
    """Byte strings of the vocabulary's pieces by id, and the longest one's length."""
    from tokenizers import Tokenizer, decoders
    tokenizer = Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    alphabet = byte_alphabet()
    assert isinstance(tokenizer.decoder, decoders.ByteLevel)
    table = {bytes(alphabet[c] for c in t): i for t, i in tokenizer.get_vocab().items() if t not in special}
    return table, max(map(len, table))


def byte_alphabet() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, the
    other bytes follow from U+0100 on in their order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def piece_counts(words: DataFrame, tokenizer: str) -> dict[int, int]:
    """How often each piece occurs when the training words are cut by the tokenizer; at most one entry per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from giniflow.llm.tokens import encoder
        encode = encoder(tokenizer_path(tokenizer))
        total = np.zeros(1, np.int64)
        for batch in batches:
            ids = encode.encode_once([w.as_py() for w in batch.column(0)])
            counts = np.repeat(batch.column(1).to_numpy(), [len(x) for x in ids])
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int64)
            if len(flat):
                part = np.bincount(flat, weights=counts).astype(np.int64)
                total = np.pad(total, (0, max(0, len(part) - len(total))))
                total[:len(part)] += part
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "c"])

    found = words.where("c > 0").select("word", "c").mapInArrow(run, "id long, c long")
    return {r["id"]: r["c"] for r in found.groupBy("id").agg(F.sum("c").alias("c")).collect()}


class Lattice:
    """All cuts of many words at once: words of one length are rows of a matrix of bytes, pieces are found by the hash of
    their bytes in a sorted table, and both recursions run over the columns."""

    def __init__(self, table: dict[bytes, int]):
        self.ids = np.fromiter(table.values(), np.int64, len(table))
        keys = np.empty(len(table), np.uint64)
        by_length: dict[int, list[int]] = {}
        names = list(table)
        for k, name in enumerate(names):
            by_length.setdefault(len(name), []).append(k)
        for length, some in by_length.items():
            rows = np.frombuffer(b"".join(names[k] for k in some), np.uint8).reshape(-1, length)
            keys[some] = self._keys(rows)[length - 1][:, 0]
        order = np.argsort(keys)
        self.keys, self.ids, self.longest = keys[order], self.ids[order], max(by_length)
        assert (np.diff(self.keys) > 0).all()
        self.lengths = np.array(sorted(by_length))

    def _keys(self, rows: np.ndarray, most: int | None = None) -> list[np.ndarray]:
        """Of every length (from 1) the keys of the parts of that length at each place."""
        n, size = rows.shape
        out, h = [], np.zeros((n, size + 1), np.uint64)
        with np.errstate(over="ignore"):
            for length in range(1, min(size, most or size) + 1):
                h = h[:, :size - length + 1] * np.uint64(0x100000001B3) + rows[:, length - 1:].astype(np.uint64) + np.uint64(1)
                x = (h ^ np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
                out.append(x ^ (x >> np.uint64(29)))
        return out

    def _steps(self, rows: np.ndarray, logs: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, place in the table, log probability) of the parts that are pieces anywhere; -inf where they are none."""
        out = []
        for length, keys in enumerate(self._keys(rows, self.longest), 1):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = self.keys[at] == keys
            if found.any():
                out.append((length, at, np.where(found, logs[at], -np.inf)))
        return out

    def groups(self, words: list[bytes], most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, rows of bytes) of words of one length, bounded in the number of their parts."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == size)
            step = max(1, most // (size * min(size, self.longest)))
            for k in range(0, len(at), step):
                some = at[k:k + step]
                yield some, np.frombuffer(b"".join(words[i] for i in some.tolist()), np.uint8).reshape(len(some), size)

    def forward(self, steps: list, n: int, size: int) -> np.ndarray:
        """Log of the summed probability of all cuts of each prefix (by its length)."""
        alpha = np.full((n, size + 1), -np.inf)
        alpha[:, 0] = 0.0
        for end in range(1, size + 1):
            alpha[:, end] = _log_sum([alpha[:, end - length] + s[:, end - length] for length, _, s in steps if length <= end])
        return alpha

    def log10(self, words: list[bytes], logs: np.ndarray) -> np.ndarray:
        """log10 of the summed probability of all cuts of each word. ``logs``: natural logs by piece of the table."""
        out = np.empty(len(words))
        for at, rows in self.groups(words):
            out[at] = self.forward(self._steps(rows, logs), *rows.shape)[:, -1]
        return out / LOG10

    def expected(self, words: list[bytes], counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """How often each piece of the table is expected in the words, over all cuts by their probability."""
        out = np.zeros(len(self.keys))
        for at, rows in self.groups(words):
            steps, (n, size) = self._steps(rows, logs), rows.shape
            alpha, beta = self.forward(steps, n, size), np.full((n, size + 1), -np.inf)
            beta[:, size] = 0.0
            for begin in range(size - 1, -1, -1):
                beta[:, begin] = _log_sum([s[:, begin] + beta[:, begin + length] for length, _, s in steps if begin + length <= size])
            for length, place, s in steps:
                share = np.exp(alpha[:, :size - length + 1] + s + beta[:, length:] - alpha[:, -1:])
                out += np.bincount(place.ravel(), weights=(share * counts[at, None]).ravel(), minlength=len(out))
        return out


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    """Log of the sum of exponents, row by row; -inf where all are."""
    if len(terms) == 1:
        return terms[0]
    x = np.stack(terms)
    top = x.max(axis=0)
    with np.errstate(invalid="ignore"):
        total = np.exp(x - top).sum(axis=0)
    return np.where(np.isneginf(top), top, top + np.log(np.where(np.isneginf(top), 1.0, total)))


@cache
def lattice(path: str) -> Lattice:
    return Lattice(pieces(path)[0])


def _many(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Batches joined to at least ``rows`` rows: the lattice works on all words of one length at once."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _bytes_of(words: pa.Array) -> list[bytes]:
    return [b" " + w.encode("utf-8", "surrogatepass") for w in words.to_pylist()]


def piece_logs(weights: np.ndarray, ends: float) -> np.ndarray:
    """Natural logs of the smoothed probabilities of the pieces (in the order of the table) beside the end token."""
    return np.log((weights + SMOOTHING) / (weights.sum() + ends + SMOOTHING * (len(weights) + 1)))


def expected_counts(words: DataFrame, weights: np.ndarray, ends: int, tokenizer: str) -> np.ndarray:
    """One step of expectation: the pieces' expected counts in the training words under the present weights. Each task sums
    its words, Spark sums the tasks; one number per piece comes back."""
    shared = words.sparkSession.sparkContext.broadcast(piece_logs(weights, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lattice(tokenizer_path(tokenizer))
        total = np.zeros(len(table.keys))
        for batch in _many(batches):
            total += table.expected(_bytes_of(batch.column(0)), batch.column(1).to_numpy().astype(float), shared.value)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "c"])

    out = np.zeros(len(weights))
    for r in words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, c double").groupBy("piece").agg(
            F.sum("c").alias("c")).collect():
        out[r["piece"]] = r["c"]
    return out


def fit_weights(words: DataFrame, ends: int, tokenizer: str, rounds: int) -> np.ndarray:
    """Weights of the pieces in the order of the lattice's table: counts of the tokenizer's one cut, then rounds of
    expectation over all cuts."""
    table = lattice(tokenizer_path(tokenizer))
    counts = piece_counts(words, tokenizer)
    weights = np.array([float(counts.get(i, 0)) for i in table.ids.tolist()])
    for _ in range(rounds):
        weights = expected_counts(words, weights, ends, tokenizer)
    return weights


def word_scores(words: DataFrame, weights: np.ndarray, ends: int, tokenizer: str) -> tuple[DataFrame, float]:
    """``words`` plus log10 of each word's probability, and log10 of the end token's."""
    shared = words.sparkSession.sparkContext.broadcast(piece_logs(weights, ends))  # one number per piece of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lattice(tokenizer_path(tokenizer))
        for batch in _many(batches):
            logs = table.log10(_bytes_of(batch.column(0)), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.float64())],
                                             names=["word", "c", "log_p"])

    end = math.log10((ends + SMOOTHING) / (weights.sum() + ends + SMOOTHING * (len(weights) + 1)))
    return words.select("word", "c").mapInArrow(run, "word string, c long, log_p double"), end


def lm_scores(docs: DataFrame, block: Column | None = None, held_out: tuple[int, int] = (7, 2),
              tokenizer: str = TOKENIZER, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row. ``block`` tells rows that
    are scored together; by default they are dealt out by a hash."""
    spark = docs.sparkSession
    mod, rest = held_out
    if block is None:
        n = max(1, 2 * spark.sparkContext.defaultParallelism, docs.count() // 10_000)
        block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
        blocked = docs.select(block.alias("block"), "doc_id", "text").repartition(n, "block")
    else:
        blocked = docs.select(block.alias("block"), "doc_id", "text")
    out = id_bucket(F.col("doc_id"), mod) == rest
    rows = blocked.select("block", "doc_id", "text", out.alias("held_out"), (~out).alias("train"))

    own = stored(word_counts(rows), "block-words")
    words = stored(own.groupBy("word").agg(F.sum("c").alias("c")), "words")
    known, tokens = words.agg(F.count(F.when(F.col("c") > 0, 1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    ends = docs.where(~(id_bucket(F.col("doc_id"), mod) == rest)).count()
    n_all, v_all = tokens + ends, known + (ends > 0)
    scored, end_log = word_scores(words, fit_weights(words, ends, tokenizer, rounds), ends, tokenizer)
    scored = stored(scored, "word-scores")
    wanted = own.select("block", "word").join(scored, "word")

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")
    base_of = lambda c: np.log10((c + 1) / (n_all + v_all + 1))

    def score(texts: pa.Table, table: pa.Table) -> pa.Table:
        order = table.combine_chunks()
        values = order.column("word").combine_chunks() if len(order) else pa.array([], pa.string())
        counts = np.append(order.column("c").to_numpy(), 0)
        base, logs = base_of(counts), np.append(order.column("log_p").to_numpy(), np.nan)
        result = []
        for batch in texts.to_batches(max_chunksize=2000):
            found, sizes = split_words(batch.column("text"))
            numbered = found.dictionary_encode()
            place = pc.index_in(numbered.dictionary, value_set=values)
            if place.null_count:
                raise RuntimeError("a block's words changed between two reads of the input")
            at = place.to_numpy(zero_copy_only=False)[numbered.indices.to_numpy()] if len(found) else np.zeros(0, int)
            end = np.cumsum(sizes)
            known_before = np.append(0, np.cumsum(counts[at] > 0))
            result.append(pa.table({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": sizes + 1,
                "n_known": known_before[end] - known_before[end - sizes] + int(ends > 0),
                "train_tokens": np.full(len(sizes), n_all, np.int64),
                "base_score": exact_sums(base[at], sizes) + float(base_of(ends)),
                "score": exact_sums(logs[at], sizes) + end_log}))
        return pa.concat_tables(result)

    return (rows.select("block", "doc_id", "held_out", "text").groupBy("block")
            .cogroup(wanted.groupBy("block")).applyInArrow(score, schema))


def exact_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups, each added up by itself (no running total over the batch that would lose digits)."""
    out = np.zeros(len(sizes))
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        out[full] = np.add.reduceat(values, starts)
    return out
