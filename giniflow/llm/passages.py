"""Substring dedup (operator 8), the blocks: every run of words that occurs again, without regard to line ends.

A passage is a run of at least ``SPAN`` words (separated by blanks or line ends, A-Z in either case) that stands in two
rows, or twice in one row without overlap. All of them are found: each window of ``SPAN`` words is known by the least hash
of its ``K``-word grams, and neighbouring windows mostly share theirs: these are a block. Equal windows have equal least
hashes, so a first pass keeps two hashes a block, that of the gram and that of all its words. Where a gram occurs again,
its blocks are counted as a whole if all are alike, and window by window if not (at the ends of what is shared), which
extends each hit word by word. A passage is a maximal run of repeated windows, so it has the full extent of what is shared.
The first occurrence of a window (least id, then row) stays, all others are removed, except where they overlap the first
in its own row (one repeated phrase is kept for ``SPAN`` words).

Equal texts are one text with a count. Texts are numbered in the order of their first rows; blocks and windows are grouped
by hash with map-side counts, never compared in pairs: a passage with any number of copies costs as much as its occurrences.
Nothing is dropped or capped. Hashes have 64 bits (that of a block's words, compared within one gram, 32).

Null or empty texts have no passages. Equal rows are different occurrences; a null id sorts first. Extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from giniflow.llm.common import BLANKS, ascii_lower_bytes, stored, word_hashes
from giniflow.llm.jaccard import _mix, _small, text_key
from giniflow.operators.prefix import exact_rank

#: Words in a window, words in a gram.
SPAN, K = 50, 12

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True


def run_hashes(words: np.ndarray) -> Callable[[np.ndarray, np.ndarray | int], np.ndarray]:
    """Function of starts and lengths: hashes of these runs of words, by differences of one running sum (mod 2**64)."""
    n = len(words)
    with np.errstate(over="ignore"):
        powers, back = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _BACK, np.uint64)
        powers[0] = back[0] = 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(powers)[:n])])
        back = np.cumprod(back)

    def of(starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((sums[starts + lengths] - sums[starts]) * back[starts])

    return of


def blocks(words: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Callable]:
    """(first window, number of windows, least gram hash, hash of all words) of every block, and the hash function."""
    of, w = run_hashes(words), span - k + 1
    if len(words) < span:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64), of
    least, width = of(np.arange(len(words) - k + 1), k), 1
    while width < w:
        step = min(width, w - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    sizes = np.diff(np.append(starts, len(least)))
    return starts, sizes, least[starts], of(starts, sizes + span - 1), of


def prints(words: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Least gram hash and hash of all words of every block. A block in which the gram itself must stand twice comes with two
    different hashes."""
    _, sizes, least, whole, _ = blocks(words, span, k)
    long = sizes > span - k + 1
    short = (whole >> np.uint64(32)).astype(np.uint32)
    return (np.concatenate([least, least[long]]).view(np.int64),
            np.concatenate([short, ~short[long]]).view(np.int32))


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end in code points and line number of every word of UTF-8 bytes."""
    data = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[True], _BLANK[data], [True]]).astype(np.int8))
    first, past = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    return points[first], points[past], lines[first]


def _texts_of(docs: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Each text in ``wanted`` (key, doc_id of its first row, ...) once for every row with that id, with ``columns``."""
    wanted = wanted.withColumnRenamed("doc_id", "_first_id")
    texts = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    return texts.join(wanted, (texts["key"] == wanted["key"]) & F.col("doc_id").eqNullSafe(F.col("_first_id"))).select(*columns, "text")


def _units_of(texts: DataFrame, span: int, k: int) -> DataFrame:
    """tid, c, pos (in words), size (in windows) and hash of what may be repeated. ``texts``: with the gram hashes of
    blocks that are taken as a whole (alike) and window by window (mixed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = word_hashes()
        for batch in batches:
            for part in (batch.slice(j, 64) for j in range(0, batch.num_rows, 64)):
                owners, found = [np.zeros(0, np.int64)], [[np.zeros(0, np.int64)] * 3]
                for i, (alike, mixed, text) in enumerate(zip(*part.columns[2:], strict=True)):
                    starts, sizes, least, whole, of = blocks(seen.of(ascii_lower_bytes(text.as_py() or "").split()), span, k)
                    one, each = (np.isin(least.view(np.int64), x.values.to_numpy(zero_copy_only=False)) for x in (alike, mixed))
                    single = np.flatnonzero(np.repeat(each, sizes))
                    owners.append(np.full(len(single) + int(one.sum()), i, np.int64))
                    found.append([np.concatenate([starts[one], single]),
                                  np.concatenate([sizes[one], np.ones(len(single), np.int64)]),
                                  np.concatenate([whole[one], of(single, span)]).view(np.int64)])
                owner = pa.array(np.concatenate(owners))
                pos, size, value = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(pos.astype(np.int32)),
                     pa.array(size.astype(np.int32)), pa.array(value)], names=["tid", "c", "pos", "size", "hash"])

    return texts.mapInArrow(run, "tid long, c long, pos int, size int, hash long")


def _places_of(texts: DataFrame) -> DataFrame:
    """tid, pos, n and the start, end and line of n words from pos, for every asked (pos, n) of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tid, asked, text in zip(*batch.columns, strict=True):
                start, end, line = word_places((text.as_py() or "").encode("utf-8", "surrogatepass"))
                rows += [(tid.as_py(), a["pos"], a["n"], int(start[a["pos"]]), int(end[a["pos"] + a["n"] - 1]), int(line[a["pos"]]))
                         for a in asked.as_py()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)],
                                             names=["tid", "pos", "n", "start", "end", "line"])

    return texts.mapInArrow(run, "tid long, pos int, n int, start long, end long, line int")


def runs_of(docs: DataFrame, found: DataFrame, span: int, k: int) -> DataFrame:
    """`repeated_runs` from the stored description of every row (row, doc_id, key, n_words, prints, wholes)."""
    rows = found.where(F.col("n_words") >= span)
    copies = rows.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("same"), F.min("row").alias("row"))
    texts = copies.groupBy("key").agg(F.min(F.struct("doc_id", "row", "same")).alias("first"), F.sum("same").alias("c"))
    texts = texts.join(rows.select(F.col("row").alias("_row"), "n_words", F.arrays_zip("prints", "wholes").alias("blocks")),
                       F.col("first.row") == F.col("_row"))
    texts = exact_rank(stored(texts.select("key", "first.*", "c", "n_words", "blocks"), "texts"), [], ["doc_id", "row"], out="tid")
    each = texts.select("tid", "c", F.inline("blocks"))
    again = stored(each.groupBy("prints").agg(F.sum("c").alias("n"), F.min("wholes").alias("lo"), F.max("wholes").alias("hi"))
                   .where("n > 1").select("prints", (F.col("lo") == F.col("hi")).alias("same")), "again", few=True)
    hit = each.select("tid", "prints").join(_small(again, again.count()), "prints")
    wanted = hit.groupBy("tid").agg(F.collect_set(F.when(F.col("same"), F.col("prints"))).alias("alike"),
                                    F.collect_set(F.when(~F.col("same"), F.col("prints"))).alias("mixed"))
    heads = texts.select("tid", "key", "doc_id", "c", "n_words")
    wanted = stored(wanted.join(heads, "tid").select("tid", "c", "key", "doc_id", "alike", "mixed"), "wanted", few=True)
    asked = _texts_of(docs, _small(wanted, wanted.agg(F.sum(F.size("alike") + F.size("mixed"))).first()[0] or 0),
                      ["tid", "c", "alike", "mixed"])
    units = _units_of(asked, span, k)
    if texts.where("same > 1").limit(1).count():  # rows of equal text and id give the same units again
        units = units.distinct()
    units = stored(units, "units")
    groups = units.groupBy("hash").agg(F.min(F.struct("tid", "pos")).alias("first"), F.max(F.struct("tid", "pos")).alias("last"),
                                       F.max("c").alias("most"), F.sum("c").alias("n"))
    near = F.col("first.pos") + span
    groups = groups.where((F.col("first.tid") != F.col("last.tid")) | (F.col("most") > 1) | (F.col("last.pos") >= near))
    hits = units.drop("c").join(groups.select("hash", "first", "n"), "hash").select(
        "tid", "pos", "size", "n", F.col("first.tid").alias("first_tid"), F.col("first.pos").alias("first_pos"),
        ((F.col("tid") != F.col("first.tid")) | (F.col("pos") >= near)).alias("removed"))
    # consecutive windows of a text with the same outcome and their first occurrence in the same text
    same = ["tid", "first_tid", "removed"]
    before = F.sum("size").over(Window.partitionBy(*same).orderBy("pos")) - F.col("size")
    runs = hits.withColumn("run", F.col("pos") - before).groupBy(*same, "run").agg(
        F.min(F.struct("pos", "first_pos")).alias("a"), F.sum("size").alias("size"), F.max("n").alias("n_occurrences"))
    runs = stored(runs.select(*same, "a.pos", "a.first_pos", (F.col("size") + span - 1).cast("int").alias("n"), "n_occurrences"), "runs", few=True)

    # the other rows of a text that stands more than once are repeated from end to end
    begins = runs.where("pos = 0").groupBy("tid").agg(F.min(F.struct("first_tid", "first_pos")).alias("f"))
    most = runs.groupBy("tid").agg(F.max("n_occurrences").alias("n_occurrences"))
    copies = heads.where("c > 1").join(begins, "tid").join(most, "tid").select(
        "tid", "f.first_tid", F.lit(True).alias("removed"), F.lit(0).alias("pos"), "f.first_pos", F.col("n_words").alias("n"),
        "n_occurrences")
    ask = runs.select("tid", "pos", "n").unionByName(copies.select("tid", "pos", "n")).unionByName(
        runs.select(F.col("first_tid").alias("tid"), F.col("first_pos").alias("pos"), F.lit(1).alias("n"))).distinct()
    lists = ask.groupBy("tid").agg(F.collect_list(F.struct("pos", "n")).alias("asked")).join(heads, "tid").select(
        "tid", "key", "doc_id", "asked")
    lists = stored(lists, "asked", few=True)
    places = stored(_places_of(_texts_of(docs, _small(lists, ask.count()), ["tid", "asked"])).distinct(), "places", few=True)

    firsts = places.where("n = 1").select(F.col("tid").alias("first_tid"), F.col("pos").alias("first_pos"),
                                          F.col("start").alias("first_start"))
    ids = heads.select(F.col("tid").alias("first_tid"), F.col("doc_id").alias("first_doc_id"))
    least = heads.select("tid", "key", "doc_id")

    def named(r: DataFrame, owners: DataFrame) -> DataFrame:
        out = r.join(places.withColumnRenamed("line", "paragraph"), ["tid", "pos", "n"]).join(firsts, ["first_tid", "first_pos"])
        out = out.join(ids, "first_tid").join(owners, "tid")
        return out.select("doc_id", "paragraph", "start", "end", F.col("n").alias("n_words"), "n_occurrences", "first_doc_id",
                          F.when(F.col("removed"), F.col("first_start")).otherwise(F.col("start")).alias("first_start"), "removed")

    one = texts.where("c > 1").select("tid", F.col("row").alias("_first_row"), "key")
    others = rows.select("row", "doc_id", "key").join(one, "key").where(F.col("row") != F.col("_first_row")).select("tid", "doc_id")
    return named(runs, least.drop("key")).unionByName(named(copies, others))


def repeated_runs(docs: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """Every maximal run of words whose windows occur again: doc_id, paragraph (line of its first word), start, end (code
    points), n_words, n_occurrences (of its most frequent window), first_doc_id, first_start, removed. Runs of one row may
    overlap by less than ``span`` words where they have different first occurrences."""
    from giniflow.llm.paragraphs import BANDS, WIDTH, describe
    docs = docs.select("doc_id", "text")
    found = stored(describe(docs, 1 << 30, WIDTH, BANDS, span, k), "texts")
    return runs_of(docs, found.where(F.col("paragraph").isNull()), span, k)
