"""Best-fit packing (operator 1): documents into sequences of a fixed token capacity by best-two-fit.

Bins depend on lengths only, and there are at most ``capacity`` different lengths. So best-two-fit runs on the histogram
of lengths: a bin is filled greedily with the largest lengths that fit; then its smallest document makes way for two
unpacked ones if they fit the widened gap more tightly. The same bin repeats as often as its lengths last, so the plan
has a few thousand patterns however many documents there are. Documents find their places in Spark: each gets its rank
among those of its length, and the plan maps ranks of a length to sequences and offsets.

A length may be shared by any share of the rows: ranks are counted in cells of a few hundred rows, offsets of cells are
summed per length. The driver holds the histogram and the plan (both bounded by the capacity), never documents.

Null text counts as empty (the end id alone). Equal rows are packed once each; rows of equal length are interchangeable.
An empty table gives no sequences. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from giniflow.llm.common import few_partitions, stored
from giniflow.llm.tokens import TOKENIZER, encoder, text_batches, tokenizer_path

CAPACITY = 2048
#: Rows of one length that are ranked together.
CELL_ROWS = 400


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all full but the first, which takes the remainder."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *[(at, capacity) for at in range(first, n, capacity)]]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, text_col: str = "text",
                 id_col: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian 32-bit, as binary) of every piece of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = encoder(tokenizer_path(tokenizer))
        encode = segments.ids
        end = np.array([end_id], "<u4")
        for batch in batches:
            ids_of, at = batch.column(0), 0
            for texts in text_batches(batch.column(1).to_pylist(), lambda t: len(t or "")):
                rows, pieces, starts, lengths, ids = [], [], [], [], []
                for k, own in enumerate(encode(texts)):
                    whole = np.concatenate([own, end])
                    for piece, (start, length) in enumerate(cut(len(whole), capacity)):
                        rows.append(at + k)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(length)
                        ids.append(whole[start:start + length].tobytes())
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(rows)), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])
        segments.trim()

    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def fill_bin(left: np.ndarray, capacity: int) -> tuple[Counter, Counter]:
    """One bin from the lengths that are left (``left[x]``: how many of length x): the greedy fill and the final one."""
    free = np.flatnonzero(left)
    bin_, gap = Counter(), capacity
    while gap:
        k = int(np.searchsorted(free, gap, side="right")) - 1
        while k >= 0 and left[free[k]] == bin_[int(free[k])]:
            k -= 1
        if k < 0:
            break
        x = int(free[k])
        many = min(gap // x, int(left[x]) - bin_[x])
        bin_[x] += many
        gap -= many * x
    greedy = Counter(bin_)
    if gap and sum(bin_.values()) > 1:
        small = min(bin_)
        room = gap + small
        rest = left.copy()
        for x, m in bin_.items():
            rest[x] -= m
        firsts = np.flatnonzero(rest[:room])  # room - 1 at most, so that a second one fits
        if len(firsts):
            # the largest free length at most x, and the one below x itself where only one of length x is left
            at_most = np.maximum.accumulate(np.where(rest[:room + 1] > 0, np.arange(room + 1), 0))
            cap = np.minimum(room - firsts, firsts)
            second = at_most[cap]
            second = np.where((second == firsts) & (rest[firsts] < 2), at_most[np.maximum(cap - 1, 0)], second)
            total = np.where(second > 0, firsts + second, 0)
            best = int(total.max())
            if best > small:
                k = int(np.flatnonzero(total == best)[-1])
                bin_[small] -= 1
                bin_[int(firsts[k])] += 1
                bin_[int(second[k])] += 1
    return greedy, +bin_


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """(lengths of a bin, how many such bins), in the order in which best-two-fit makes them."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan = []
    while left.any():
        greedy, bin_ = fill_bin(left, capacity)
        need = greedy | bin_
        times = min((int(left[x]) - need[x]) // m + 1 for x, m in bin_.items())
        for x, m in bin_.items():
            left[x] -= times * m
        plan.append((bin_, times))
    return plan


def slots(plan: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, past rank, copies in a bin, first sequence, offset): which ranks of a length go where."""
    used: Counter = Counter()
    out, sequence = [], 0
    for bin_, times in plan:
        offset = 0
        for x in sorted(bin_, reverse=True):
            m = bin_[x]
            out.append((x, used[x], used[x] + m * times, m, sequence, offset))
            used[x] += m * times
            offset += m * x
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) plus sequence_id and offset."""
    spark = pieces.sparkSession
    names = pieces.columns
    # The salt is stored, so ranks are the same whenever a task runs again.
    rows = stored(pieces.select(F.struct(*[pieces[f"`{c}`"] for c in names]).alias("row"),
                                pieces["length"].cast("int").alias("len"),
                                F.xxhash64(F.monotonically_increasing_id()).alias("salt")), "pieces")
    lengths = rows.groupBy("len").count()
    histogram = {r["len"]: r["count"] for r in lengths.collect()}  # at most `capacity` rows
    places = spark.createDataFrame(slots(plan_bins(histogram, capacity)),
                                   "len int, first long, past long, copies long, sequence long, base long")
    cells = spark.createDataFrame([(x, -(-n // cell_rows)) for x, n in histogram.items()], "len int, cells long")
    rows = rows.join(F.broadcast(cells), "len").withColumn("cell", F.pmod("salt", "cells"))
    before = (rows.groupBy("len", "cell").agg(F.count(F.lit(1)).alias("n"))
              .select("len", "cell", (F.sum("n").over(Window.partitionBy("len").orderBy("cell")) - F.col("n"))
                      .alias("before")))
    rank = F.row_number().over(Window.partitionBy("len", "cell").orderBy("salt")) - 1
    ranked = (rows.withColumn("nth", rank).join(before, ["len", "cell"])
              .select("row", "len", (F.col("before") + F.col("nth")).alias("rank")))
    ranked = few_partitions(ranked, sum(histogram.values()))
    k = F.col("rank") - F.col("first")
    placed = ranked.join(F.broadcast(places), (ranked["len"] == places["len"]) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("past")))
    return placed.select("row.*", (F.col("sequence") + F.floor(k / F.col("copies"))).cast("long").alias("sequence_id"),
                         (F.col("base") + F.pmod(k, F.col("copies")) * ranked["len"]).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces of ``docs`` with their digest and place; the ids themselves stay in the tokenizing stage."""
    pieces = token_pieces(docs, capacity, tokenizer=tokenizer)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary) and the doc_ids of each sequence, from packed pieces that still hold ``ids``. A group
    is one sequence, so it holds at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.col("parts.doc_id").alias("doc_ids"),
                    F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids")))
