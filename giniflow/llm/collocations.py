"""Phrase collocation mining (operator 11) after SETM: occurrence relations, merge-joined and group-counted level by level.

Texts are cut into pieces and words. The occurrences of a chunk of texts form one relation per language, sorted by piece
and position: a *slot* numbers the words of a chunk and skips one number between pieces, so two occurrences are adjacent
in a piece when their slots differ by one. A relation is stored as slots and group codes with a dictionary of group ids.

Level k + 1: each chunk merge-joins its k-word relation with itself at the next slot (both k-word phrases have to be
frequent) and counts its own groups. Groups are dealt into parts by their ids and travel as one sorted, compressed list per
chunk and part; each part sums its counts over all chunks, keeps and numbers the frequent groups and tells every
chunk which of its groups these are; each chunk keeps the occurrences of those (the semi-join) for the next level. What
moves are the different groups of a chunk, never occurrences, so one phrase with a third of all occurrences is one entry
per chunk. The number of parts follows the number of words, and chunks have a bound (a longer text is a chunk of its own).

Null text has no words; a null language is ``und``; repeated rows count as often as they stand there; no frequent
phrase or an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from giniflow.llm.common import LOWER, UPPER, stored

#: Fewest occurrences, words of the longest phrase, rows a language, percent of a phrase inside a longer one.
MIN_COUNT, LONGEST, MOST, INSIDE_PERCENT = 30, 4, 2000, 80
#: Characters between pieces; blanks between words.
PIECE_ENDS, WORD_BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
#: Words that a task collects before it writes the largest language's chunk; words of the table to one part of groups.
CHUNK_WORDS, PART_WORDS = 2_000_000, 2_000_000
#: Parts in which a language's candidates are ranked first.
SALTS = 64

#: A byte that no UTF-8 text holds marks the piece ends.
_END = b"\xff"
_TABLE = bytes.maketrans((UPPER + PIECE_ENDS + "\t").encode(), LOWER.encode() + _END * len(PIECE_ENDS) + b" ")
_STEP = "chunk long, lang string, part int, packed binary"
_COUNTED = "chunk long, lang string, a long, b long, id long, f long, packed binary"


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers as bytes: lengths, then each column as gaps, byte plane by byte plane, compressed."""
    import zstandard
    raw = [np.array([len(columns), *map(len, columns)], "<i8").tobytes()]
    raw += [np.diff(c.astype("<i8"), prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.compress(b"".join(raw), 1)


def _unpack(packed: bytes) -> list[np.ndarray]:
    import zstandard
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    sizes = raw[8:8 + 8 * int(raw[:8].view("<i8")[0])].view("<i8")
    out, at = [], 8 + 8 * len(sizes)
    for n in sizes.tolist():
        out.append(np.cumsum(np.ascontiguousarray(raw[at:at + 8 * n].reshape(8, n).T).view("<i8").ravel()))
        at += 8 * n
    return out


def _chunk_writer(chunk_words: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        serial = count(TaskContext.get().partitionId() << 32)
        names = ["chunk", "lang", "packed", "words", "counts"]
        types = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
        known: dict[str, defaultdict[bytes, int]] = {}
        parts: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            codes, numbers = np.concatenate(parts.pop(lang)), known.pop(lang)
            counts = np.bincount(codes, minlength=len(numbers))[1:]
            slots = np.flatnonzero(codes)
            words = [w.decode("utf-8", "replace") for w in list(numbers)[1:]]
            row = next(serial), lang, _pack(slots, codes[slots] - 1), words, counts.tolist()
            del sizes[lang]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types)], names)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                marked = text.encode("utf-8", "replace").translate(_TABLE).replace(_END, b" " + _END + b" ")
                words = marked.split()  # only blanks are left of the six bytes this splits at
                if lang not in known:
                    known[lang] = defaultdict(count().__next__, {})
                    known[lang][_END]
                    parts[lang], sizes[lang] = [], 0
                codes = np.fromiter(map(known[lang].__getitem__, words), np.int32, len(words))
                parts[lang] += [codes, np.zeros(1, np.int32)]
                sizes[lang] += len(codes) + 1
                while sum(sizes.values()) >= chunk_words:
                    yield flush(max(sizes, key=sizes.get))
        for lang in list(parts):
            yield flush(lang)

    return write


def occurrence_chunks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                      chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """chunk, lang, packed (slots and word numbers), words and counts by word number."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    return texts.mapInArrow(_chunk_writer(chunk_words),
                            "chunk long, lang string, packed binary, words array<string>, counts array<long>")


def _meetings(slots: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge-join of a relation with itself at the next slot: slot of each meeting, and both codes as one number."""
    at = np.flatnonzero(np.diff(slots) == 1)
    return slots[at], codes[at] * max(len(ids), 1) + codes[at + 1]


def _adjacent(slots: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different meetings (sorted, as ``ids`` are): ids of both sides and number of occurrences."""
    pairs, n = np.unique(_meetings(slots, codes, ids)[1], return_counts=True)
    first, second = np.divmod(pairs, max(len(ids), 1))
    return ids[first], ids[second], n


def _part_of(a: np.ndarray, b: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _step_rows(chunk, lang, relation: bytes | None, a: np.ndarray, b: np.ndarray, n: np.ndarray, parts: int) -> pa.Table:
    """The relation (part is null) if it is needed again, and the groups of adjacent occurrences by part."""
    rows = [] if relation is None else [(None, relation)]
    part = _part_of(a, b, parts)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        some = order[bounds[k]:bounds[k + 1]]
        rows.append((k, _pack(a[some], b[some], n[some])))
    return pa.table({"chunk": pa.array([chunk] * len(rows), pa.int64()), "lang": pa.array([lang] * len(rows), pa.string()),
                     "part": pa.array([k for k, _ in rows], pa.int32()),
                     "packed": pa.array([x for _, x in rows], pa.binary())})


def _nothing() -> pa.Table:
    return _step_rows(None, None, None, *[np.zeros(0, np.int64)] * 3, 1)


def _first_level(parts: int):
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        """Occurrences of frequent words (the semi-join by word number) and their adjacent pairs."""
        if not left.num_rows or not right.num_rows:
            return _nothing()
        slots, codes = _unpack(left["packed"][0].as_py())
        place, ids = right["place"].to_numpy(), right["id"].to_numpy()
        order = np.argsort(ids)
        place, ids = place[order], ids[order]
        new = np.full(max(int(codes.max(initial=0)), int(place.max())) + 1, -1)
        new[place] = np.arange(len(place))
        kept = new[codes] >= 0
        slots, codes = slots[kept], new[codes[kept]]
        return _step_rows(left["chunk"][0].as_py(), left["lang"][0].as_py(), _pack(slots, codes, ids),
                          *_adjacent(slots, codes, ids), parts)

    return step


def _next_level(parts: int, last: bool):
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        """Occurrences of the frequent groups of adjacent ones, and the next groups made of these."""
        if not left.num_rows or not right.num_rows:
            return _nothing()
        slots, codes, names = _unpack(left["packed"][0].as_py())
        slots, pairs = _meetings(slots, codes, names)
        pairs, place = np.unique(pairs, return_inverse=True)
        a, b = (names[x] for x in np.divmod(pairs, max(len(names), 1)))
        fa, fb, ids = (np.concatenate(x) for x in zip(*(_unpack(p) for p in right["packed"].to_pylist())))
        order = np.argsort(ids)
        fa, fb, ids = fa[order], fb[order], ids[order]
        names = np.unique(a)                                # groups are sorted by (a, b): find the frequent ones there
        keys = _pair_keys(names, a, b)
        new = np.full(len(a), -1)
        new[np.searchsorted(keys, _pair_keys(names, fa, fb))] = np.arange(len(ids))
        kept = new[place] >= 0
        slots, codes = slots[kept], new[place[kept]]
        return _step_rows(left["chunk"][0].as_py(), left["lang"][0].as_py(), None if last else _pack(slots, codes, ids),
                          *_adjacent(slots, codes, ids), parts)

    return step


def _pair_keys(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One sortable key per pair: place of a among ``names``, then b."""
    keys = np.empty(len(a), np.dtype([("a", "<i8"), ("b", "<i8")]))
    keys["a"], keys["b"] = np.searchsorted(names, a), b
    return keys


def _count_part(min_count: int):
    def run(groups: pa.Table) -> pa.Table:
        """Sums of one part's groups over all chunks: a row (a, b, id, f) of each frequent group, and a row of each chunk
        with the frequent groups among its own."""
        part = groups["part"][0].as_py()
        found = [_unpack(x) for x in groups["packed"].to_pylist()]
        a, b, n = (np.concatenate(x) for x in zip(*found))
        names_a, code_a = np.unique(a, return_inverse=True)
        names_b, code_b = np.unique(b, return_inverse=True)
        pairs, place = np.unique(code_a * len(names_b) + code_b, return_inverse=True)
        f = np.zeros(len(pairs), np.int64)
        np.add.at(f, place, n)
        often = np.flatnonzero(f >= min_count)
        ids = np.full(len(pairs), -1)
        ids[often] = (part << 32) + np.arange(len(often))
        chunks, langs, packed, at = [], [], [], 0
        for k, (x, y, _) in enumerate(found):
            mine = ids[place[at:at + len(x)]]
            at += len(x)
            if (mine >= 0).any():
                chunks.append(groups["chunk"][k].as_py())
                langs.append(groups["lang"][k].as_py())
                packed.append(_pack(x[mine >= 0], y[mine >= 0], mine[mine >= 0]))
        first, second = np.divmod(pairs[often], len(names_b))
        numbers = lambda x: pa.concat_arrays([pa.array(x.astype(np.int64)), pa.nulls(len(chunks), pa.int64())])
        before = len(often)
        return pa.table({
            "chunk": pa.concat_arrays([pa.nulls(before, pa.int64()), pa.array(chunks, pa.int64())]),
            "lang": pa.concat_arrays([pa.nulls(before, pa.string()), pa.array(langs, pa.string())]),
            "a": numbers(names_a[first]), "b": numbers(names_b[second]), "id": numbers(ids[often]), "f": numbers(f[often]),
            "packed": pa.concat_arrays([pa.nulls(before, pa.binary()), pa.array(packed, pa.binary())])})

    return run


def _by_chunk(relations: DataFrame, frequent: DataFrame, step) -> DataFrame:
    keys = ["chunk", "lang"]
    relations = relations.select(*[F.col(c).alias(c) for c in relations.columns])  # both sides come from one table
    return relations.groupBy(*keys).cogroup(frequent.groupBy(*keys)).applyInArrow(step, _STEP)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, text_col: str = "text",
                     lang_col: str = "lang", chunk_words: int = CHUNK_WORDS, part_words: int = PART_WORDS
                     ) -> tuple[list[DataFrame], DataFrame]:
    """Stored tables (id, lang, phrase, last, f) of the frequent phrases of 1 to ``longest`` words, and (lang, n)."""
    chunks = stored(occurrence_chunks(docs, text_col, lang_col, chunk_words), "occurrences")
    words = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select(
        "chunk", "lang", "place", F.col("w.words").alias("phrase"), F.col("w.counts").alias("n"))
    totals = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
    parts = 1 + (totals.agg(F.sum("n")).first()[0] or 0) // part_words
    level = stored(words.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
                   .select(F.monotonically_increasing_id().alias("id"), "lang", "phrase", F.col("phrase").alias("last"), "f"),
                   "phrases", few=True)  # storing keeps the numbers
    levels = [level]
    back = words.join(level.select("id", "lang", "phrase"), ["lang", "phrase"]).select("chunk", "lang", "place", "id")
    relations, step = chunks.select("chunk", "lang", "packed"), _first_level(parts)
    for k in range(2, longest + 1):
        out = stored(_by_chunk(relations, back, step), "groups")
        counted = stored(out.where(F.col("part").isNotNull()).groupBy("part").applyInArrow(_count_part(min_count), _COUNTED),
                         "counted")
        first = level.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"))
        second = level.select(F.col("id").alias("b"), "last")
        kept = counted.where(F.col("id").isNotNull()).select("id", "a", "b", "f")
        level = stored(kept.join(first, "a").join(second, "b")
                       .select("id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f"), "phrases", few=True)
        levels.append(level)
        back = counted.where(F.col("id").isNull()).select("chunk", "lang", "packed")
        relations, step = out.where(F.col("part").isNull()).select("chunk", "lang", "packed"), _next_level(parts, k + 1 == longest)
    return levels, totals


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def score_of(a: str, left: str, right: str) -> Column:
    """floor(2,000,000 a / (l + r)), exact beyond 64 bits: what is taken off is the remainder of decimals."""
    top, bottom = _wide(a) * 2_000_000, _wide(left) + _wide(right)
    return ((top - top % bottom) / bottom).cast("long")


def _part(lo: Column, n: Column) -> Column:
    return F.concat_ws(" ", F.slice("w", lo, n))


def phrase_collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, most: int = MOST,
                        inside_percent: int = INSIDE_PERCENT, text_col: str = "text", lang_col: str = "lang",
                        chunk_words: int = CHUNK_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``most`` phrases by score, a and phrase."""
    levels, totals = frequent_phrases(docs, min_count, longest, text_col, lang_col, chunk_words, part_words)
    tables = [t.select("lang", "phrase", "f") for t in levels]
    parts, candidates = tables[0], None
    for k, t in enumerate(tables[1:], 2):
        t = t.withColumn("k", F.lit(k))
        candidates = t if candidates is None else candidates.unionByName(t)
        parts = parts.unionByName(t.drop("k"))
    candidates = candidates.withColumn("w", F.split("phrase", " "))

    inner = candidates.where("k > 2").select("lang", F.col("f").alias("longer"), "k", "w", F.explode(
        F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.struct(i.alias("i"), m.alias("m")))))).alias("s"))
    longer = inner.select("lang", _part(F.col("s.i"), F.col("s.m")).alias("phrase"), "longer") \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_wide("longer") * 100 < _wide("f") * inside_percent))

    cuts = alone.select("lang", "phrase", F.col("f").alias("a"), "k", "w",
                        F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(F.lit(1), F.col("cut")).alias("left"),
                       _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score_of("a", "l", "r"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("s")) \
        .select("lang", "phrase", "s.score", "s.a", "s.l", "s.r")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = lowest.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", "score")
