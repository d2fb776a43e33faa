"""Ranked lexical search (operator 13) by Block-Max MaxScore over index segments.

`index_segments` reads every text once and writes its postings into segments, one row each with a bound on its
size: sorted terms, postings in compressed blocks of 128, and of each block in a longer list the shortest document by class
of term frequency, from which the block's greatest contribution follows for whatever statistics the whole table has.
Document counts come from the segments' heads. `search` walks the segments window by window: lists in order of their
bounds; those whose bounds together stay below the item's threshold are not essential, only documents of the
others are candidates; the rest are asked list by list, and a candidate that cannot reach the threshold with the maximum of
its block is rejected before the block is decompressed. Each task keeps a heap per item over all its segments; heaps
of tasks are merged in two steps.

Queries come in blocks of bounded bytes; the index is not built again for each.

Null text, and text without terms, is no document of the index; an item without terms gets no rows; repeated rows are
documents (items) of their own; null ids stand last among equal scores; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from giniflow.llm.common import LOWER, UPPER, stored

#: Rows an item, terms of a segment, postings of a block, documents looked at together.
TOP, SEGMENT_TERMS, BLOCK, DOC_WINDOW = 50, 2_500_000, 128, 2048
#: Bytes of item texts that are answered together; parts in which heaps are merged first.
QUERY_BYTES, MERGE_PARTS = 32 << 20, 64
#: Upper ends of the classes of term frequency; the last class ends at the block's greatest.
TF_CLASSES = np.array([1, 2, 4, 8])
#: Stands for a null id inside a task: it comes last among equal scores.
_NO_ID = np.iinfo(np.int64).max

_PARTS = {"segment": pa.int64(), "n_docs": pa.int64(), "n_terms": pa.int64(), "ids": pa.binary(), "null_ids": pa.binary(),
          "lengths": pa.binary(), "terms": pa.binary(), "dfs": pa.binary(), "widths": pa.binary(),
          "lasts": pa.binary(), "bounds": pa.binary(), "postings": pa.binary()}
_KEPT = b"0123456789" + UPPER.encode() + LOWER.encode() + bytes(range(128, 256))
_TABLE = bytes(c if c in _KEPT else 32 for c in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """Letters, digits and all beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def _widths(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bytes (1, 2 or 4) a value of each block takes."""
    most = np.maximum.reduceat(values, starts)
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def segment_row(number: int, ids: list, lengths: np.ndarray, codes: np.ndarray, terms: list[bytes]) -> dict:
    """One segment: ``codes`` are the term numbers of all documents behind each other."""
    order = sorted(range(len(terms)), key=terms.__getitem__)
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    n = len(ids)
    key, tf = np.unique(rank[codes] * n + np.repeat(np.arange(n), lengths), return_counts=True)
    term, doc = np.divmod(key, n)
    dfs = np.bincount(term, minlength=len(terms))
    within = np.arange(len(term)) - (np.cumsum(dfs) - dfs)[term]
    opens = within % BLOCK == 0
    starts = np.flatnonzero(opens)
    sizes = np.diff(starts, append=len(term))
    gaps = np.where(opens, doc, np.diff(doc, prepend=0))
    gap_width, tf_width = _widths(gaps, starts), _widths(tf, starts)
    offsets = np.cumsum(sizes * (gap_width + tf_width)) - sizes * (gap_width + tf_width)
    blob = np.zeros(int((sizes * (gap_width + tf_width)).sum()), np.uint8)
    block = np.cumsum(opens) - 1
    inside = np.arange(len(term)) - starts[block]
    for values, width, begin in ((gaps, gap_width, offsets), (tf, tf_width, offsets + sizes * gap_width)):
        at = begin[block] + inside * width[block]
        for byte in range(4):
            some = width[block] > byte
            blob[at[some] + byte] = (values[some] >> 8 * byte) & 255
    long = dfs[term[starts]] > BLOCK  # blocks of lists with more than one
    kind = np.searchsorted(TF_CLASSES, tf)
    shortest = [np.minimum.reduceat(np.where(kind == k, lengths[doc], np.iinfo(np.uint32).max), starts)[long]
                for k in range(len(TF_CLASSES) + 1)]
    bounds = np.stack([*shortest, np.maximum.reduceat(tf, starts)[long]], axis=1)
    known = np.array([_NO_ID if x is None else x for x in ids], "<i8")
    return {"segment": number, "n_docs": n, "n_terms": int(lengths.sum()), "ids": known.tobytes(),
            "null_ids": np.array([k for k, x in enumerate(ids) if x is None], "<u4").tobytes(),
            "lengths": lengths.astype("<u4").tobytes(), "terms": b"\n".join(terms[k] for k in order),
            "dfs": dfs.astype("<u4").tobytes(), "widths": (gap_width * 8 + tf_width).astype("u1").tobytes(),
            "lasts": doc[starts + sizes - 1][long].astype("<u4").tobytes(), "bounds": bounds.astype("<u4").tobytes(),
            "postings": blob.tobytes()}


def _segment_writer(segment_terms: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        serial = count(TaskContext.get().partitionId() << 32)
        schema = pa.schema(list(_PARTS.items()))
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        ids: list = []
        found: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal numbers, size
            row = segment_row(next(serial), ids, np.array([len(x) for x in found]), np.concatenate(found), list(numbers))
            numbers, size = defaultdict(count().__next__), 0
            ids.clear()
            found.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                words = terms_of(text)
                if words:
                    ids.append(doc_id)
                    found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                    size += len(words)
                    if size >= segment_terms:
                        yield flush()
        if ids:
            yield flush()

    return write


def index_segments(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   segment_terms: int = SEGMENT_TERMS) -> DataFrame:
    """The index: one row per segment of about ``segment_terms`` term occurrences (a longer text is one alone)."""
    kinds = {pa.int64(): "long", pa.binary(): "binary"}
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    return rows.mapInArrow(_segment_writer(segment_terms), ", ".join(f"{k} {kinds[t]}" for k, t in _PARTS.items()))


class Segment:
    """One segment opened for a set of terms; decompressed blocks are kept while it is open."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.null_ids = frozenset(np.frombuffer(row["null_ids"], "<u4").tolist())
        self.m = norms(np.frombuffer(row["lengths"], "<u4").astype(np.int64), n_docs, n_terms)
        self.n_docs, self.n_terms, self.terms = n_docs, n_terms, row["terms"].split(b"\n")
        self.dfs = np.frombuffer(row["dfs"], "<u4").astype(np.int64)
        blocks = -(-self.dfs // BLOCK)
        self.first = np.concatenate(([0], np.cumsum(blocks)))  # of each term among all blocks
        self.first_long = np.concatenate(([0], np.cumsum(np.where(blocks > 1, blocks, 0))))
        widths = np.frombuffer(row["widths"], "u1")
        self.gap_width, self.tf_width = widths >> 3, widths & 7
        self.sizes = np.full(len(widths), BLOCK)
        self.sizes[self.first[1:] - 1] = self.dfs - (blocks - 1) * BLOCK
        used = self.sizes * (self.gap_width.astype(np.int64) + self.tf_width)
        self.offsets = np.cumsum(used) - used
        self.lasts = np.frombuffer(row["lasts"], "<u4").astype(np.int64)
        self.bounds = np.frombuffer(row["bounds"], "<u4").astype(np.int64).reshape(-1, len(TF_CLASSES) + 2)
        self.postings = row["postings"]
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.lists: dict[bytes, PostingList | None] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and contributions (before the term's weight) of a block."""
        if k not in self.open:
            n, g, t, at = int(self.sizes[k]), int(self.gap_width[k]), int(self.tf_width[k]), int(self.offsets[k])
            docs = np.cumsum(np.frombuffer(self.postings, f"<u{g}", n, at), dtype=np.int64)
            tf = np.frombuffer(self.postings, f"<u{t}", n, at + n * g).astype(np.int64)
            self.open[k] = docs, impacts(tf, self.m[docs])
        return self.open[k]

    def posting_list(self, term: bytes) -> PostingList | None:
        if term not in self.lists:
            at = bisect_left(self.terms, term)
            here = at < len(self.terms) and self.terms[at] == term
            self.lists[term] = PostingList(self, at) if here else None
        return self.lists[term]


class PostingList:
    def __init__(self, segment: Segment, term: int):
        self.segment, self.first = segment, int(segment.first[term])
        self.blocks = int(segment.first[term + 1]) - self.first
        if self.blocks == 1:  # the list is one block, which is its own bound
            docs, parts = segment.block(self.first)
            self.lasts, self.maxima = docs[-1:], np.array([parts.max()])
        else:
            some = slice(int(segment.first_long[term]), int(segment.first_long[term + 1]))
            self.lasts, bounds = segment.lasts[some], segment.bounds[some]
            shortest, ends = bounds[:, :-1], np.column_stack([np.tile(TF_CLASSES, (self.blocks, 1)), bounds[:, -1]])
            none = shortest == np.iinfo(np.uint32).max
            m = norms(np.where(none, 0, shortest).ravel(), segment.n_docs, segment.n_terms).reshape(shortest.shape)
            self.maxima = np.where(none, 0, impacts(ends, m)).max(axis=1)
        self.bound = int(self.maxima.max())

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings of documents from ``lo`` to below ``hi``."""
        a, b = np.searchsorted(self.lasts, (lo, hi))
        parts = [self.segment.block(self.first + k) for k in range(a, min(b + 1, self.blocks))]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, found = (np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0]
        x, y = np.searchsorted(docs, (lo, hi))
        return docs[x:y], found[x:y]

    def of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Contributions for sorted ``docs`` that could stand in ``blocks``; only these are decompressed."""
        out = np.zeros(len(docs), np.int64)
        for k in np.unique(blocks).tolist():
            lo, hi = np.searchsorted(blocks, (k, k + 1))
            have, found = self.segment.block(self.first + k)
            at = np.minimum(np.searchsorted(have, docs[lo:hi]), len(have) - 1)
            out[lo:hi] = np.where(have[at] == docs[lo:hi], found[at], 0)
        return out


def norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with ``n`` terms: 100 - 50 + (50 n N) div L, in Python integers where products could pass 64 bits."""
    if len(n) and int(n.max()) * 50 * n_docs >= 1 << 62:
        return np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()], np.int64)
    return 50 + 50 * n * n_docs // max(n_terms, 1)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Contribution of a term before its weight; it grows with ``tf`` and falls with ``m``."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Heap:
    """The best documents of one item so far, equal scores by id."""

    def __init__(self, top: int):
        self.top = top
        self.scores = self.ids = self.null = np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        """The least score that may still enter."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        best = np.lexsort((null, ids, -scores))[:self.top]
        self.scores, self.ids, self.null = scores[best], ids[best], null[best]


def search_segment(segment: Segment, weights: dict[bytes, int], heap: Heap, window: int = DOC_WINDOW) -> None:
    """Add the documents of a segment that belong into the heap."""
    lists = [(w * p.bound, w, p) for t, w in weights.items() if w and (p := segment.posting_list(t))]
    lists.sort(key=lambda x: x[0])
    below = np.concatenate(([0], np.cumsum([b for b, _, _ in lists], dtype=np.int64))).tolist()  # bounds of the lists before
    for lo in range(0, len(segment.ids), window):
        least, hi = heap.threshold, lo + window
        cut = bisect_left(below, least) - 1  # lists before are not essential: together they stay below the threshold
        if cut >= len(lists):
            return
        sums = np.zeros(window, np.int64)
        for _, w, p in lists[cut:]:
            docs, found = p.between(lo, hi)
            sums[docs - lo] += w * found
        docs = np.flatnonzero(sums)
        sums, docs = sums[docs], docs + lo
        for k in range(cut - 1, -1, -1):
            _, w, p = lists[k]
            blocks = np.searchsorted(p.lasts, docs)
            most = np.append(p.maxima, 0)[blocks] * w  # 0 behind the last block
            kept = sums + most + below[k] >= least
            docs, sums, blocks = docs[kept], sums[kept], blocks[kept]
            ask = np.flatnonzero(blocks < p.blocks)
            sums[ask] += w * p.of(docs[ask], blocks[ask])
        kept = sums >= least
        docs, sums = docs[kept], sums[kept]
        if len(docs):
            null = np.array([d in segment.null_ids for d in docs.tolist()], np.int64) if segment.null_ids \
                else np.zeros(len(docs), np.int64)
            heap.add(sums, segment.ids[docs], null)


def _df_counter(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                have = batch["terms"][k].as_py().split(b"\n")
                dfs = np.frombuffer(batch["dfs"][k].as_py(), "<u4")
                at = [(t, i) for t in terms.value if (i := bisect_left(have, t)) < len(have) and have[i] == t]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in at], pa.binary()),
                                                  pa.array([int(dfs[i]) for _, i in at], pa.int64())], ["term", "df"])

    return run


def _searcher(items, n_docs: int, n_terms: int, top: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heap(top) for _ in items.value]
        for batch in batches:
            for k in range(batch.num_rows):
                segment = Segment(batch.slice(k, 1).to_pylist()[0], n_docs, n_terms)
                for weights, heap in zip(items.value, heaps):
                    search_segment(segment, weights, heap, window)
        for number, heap in enumerate(heaps):
            ids = pa.array([None if x else i for i, x in zip(heap.ids.tolist(), heap.null.tolist())], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number)), ids, pa.array(heap.scores)],
                                             ["item", "doc_id", "score"])

    return run


def _best(df: DataFrame, keys: list, top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _answer(segments: DataFrame, items: list[tuple], id_type, n_docs: int, n_terms: int, top: int, window: int) -> DataFrame:
    spark = segments.sparkSession
    words = [sorted(set(terms_of(text or ""))) for _, text in items]
    different = sorted({t for w in words for t in w})
    counted = segments.select("terms", "dfs").mapInArrow(_df_counter(spark.sparkContext.broadcast(different)),
                                                         "term binary, df long")
    df = {bytes(r.term): r.df for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = spark.sparkContext.broadcast([{t: weights[t] for t in w if t in weights} for w in words])
    heaps = segments.mapInArrow(_searcher(asked, n_docs, n_terms, top, window), "item long, doc_id long, score long")
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS))
    merged = _best(_best(heaps, ["item", part], top).drop("rank"), ["item"], top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)],
                                  "item long, item_id " + id_type.simpleString())
    return merged.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(segments: DataFrame, items: DataFrame, top: int = TOP, text_col: str = "text", id_col: str = "item_id",
           query_bytes: int = QUERY_BYTES, window: int = DOC_WINDOW) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``top`` documents. ``segments`` is a stored index. Items are
    answered in blocks of about ``query_bytes``."""
    totals = segments.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    asked = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // query_bytes) or 1
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for k in range(blocks):
        rows = [(r.item_id, r.text) for r in numbered.where(F.col("block") == k).collect()]
        part = _answer(segments, rows, asked.schema["item_id"].dataType, totals.n, totals.l, top, window)
        out = part if out is None else out.unionByName(part)
    return out


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Index ``docs``, store the index, answer ``items``."""
    return search(stored(index_segments(docs), "segments"), items, top)
