"""Substring dedup (operator 8): paragraph MinHash banding over units that cover the whole text.

Units are of two kinds. A *line* of at least ``MIN_WORDS`` words is compared as a set of five-word shingles. Equal lines (same
words, A-Z in either case) are one node. Nodes get MinHash bands, tuned so that a pair at the similarity asked for
collides with probability ``RECALL`` at least; colliding nodes are joined, their exact Jaccard similarity is computed
from the texts, and the links are closed into components. The first occurrence of a component stays, all others are
marked for removal.

A *block* (``passages.py``) is cut by content: neighbouring windows of fifty words that have the same least gram hash,
whatever the line ends. Blocks are compared for equality, for which that one hash is band enough; where a gram occurs
again, hits are extended word by word to the full shared run. Every word of a text of fifty words stands in a block, so a
passage inside longer lines, or over several, is found as well. `repeated_units` returns both from one pass over the texts.

Buckets may be of any size: members are compared with one pivot of the bucket first, then only across components and
only where sizes and parity sketches allow a link, so a group of copies costs about as many comparisons as it has
members. Nothing is dropped or capped.

Null or empty texts have no units. Rows are numbered once, so equal rows are different occurrences; a null id sorts
first. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import ascii_lower_bytes, stored, word_hashes
from giniflow.llm.components import components
from giniflow.llm.jaccard import FOLD, _mix, _small, folded, linked, may_be_alike, parts_of, text_key, token_set
from giniflow.llm.lists import across

MIN_WORDS, WIDTH, PERCENT, RECALL = 25, 5, 80, 0.999


def tune_bands(similarity: float, recall: float, most: int = 32) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest chance collisions, for which at most ``most`` hashes reach
    the recall at ``similarity``."""
    for rows in range(most, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows)))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("more hashes are needed for this recall")


BANDS = tune_bands(PERCENT / 100, RECALL)
_SEEDS = np.random.default_rng(8).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) | np.uint64(1)
_FLIP = np.random.default_rng(9).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2)


def band_hashes(hashes: np.ndarray, sizes: np.ndarray, width: int, bands: tuple[int, int]) -> np.ndarray:
    """(paragraphs, bands) of the paragraphs whose word hashes stand one after the other, ``sizes`` words each (``width``
    at least). Shingles are hashed as in ``token_set``; a repeated shingle does not change a minimum."""
    b, r = bands
    ends = np.cumsum(sizes)
    first, out = 0, []
    while first < len(sizes):  # some 20,000 words at a time
        before = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, before + 20_000)))
        words, at = hashes[before:ends[last - 1]], ends[first:last] - sizes[first:last] - before
        with np.errstate(over="ignore"):
            grams = np.full(len(words) - width + 1, width, np.uint64)
            for j in range(width):
                grams = _mix(grams + words[j:len(words) - width + 1 + j])
            values = (grams[:, None] ^ _FLIP[None, :b * r]) * _SEEDS[None, :b * r]
            across = (ends[first:last - 1, None] - before - np.arange(1, width)[None, :]).ravel()
            values[across] = np.uint64(2**64 - 1)  # shingles of two paragraphs
            least = np.minimum.reduceat(values, at, axis=0).reshape(-1, b, r)
            sig = np.broadcast_to(np.arange(b, dtype=np.uint64), least.shape[:2])
            for k in range(r):
                sig = _mix(sig + least[:, :, k])
        out.append(sig)
        first = last
    return np.concatenate(out).view(np.int64) if out else np.zeros((0, b), np.int64)


def split_paragraphs(text: str | None, min_words: int) -> Iterator[tuple[int, int, int, list[bytes], str, bytes]]:
    """(number, start, end, words, text, node) of the lines that are long enough; node is a digest of the words."""
    at = 0
    for k, line in enumerate((text or "").split("\n")):
        if len(line) >= 2 * min_words - 1:
            words = ascii_lower_bytes(line).split()
            if len(words) >= min_words:
                yield k, at, at + len(line), words, line, _node(words)
        at += len(line) + 1


def _node(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def describe(docs: DataFrame, min_words: int, width: int, bands: tuple[int, int], span: int = 0, k: int = 0) -> DataFrame:
    """Of every text, from one pass: a row for each line that is long enough (paragraph number, place, node, bands) and, with
    ``span``, a row (paragraph is null) with its number of words and its blocks (``passages.blocks``)."""
    from giniflow.llm import passages
    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key(F.col("text")).alias("key"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (f"row long, doc_id {kind}, key binary, paragraph int, start long, end long, n_words int, node binary, "
              "bands array<long>, prints array<long>, wholes array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = word_hashes()
        for batch in batches:
            for part in (batch.slice(j, 128) for j in range(0, batch.num_rows, 128)):
                found, hashes, whole = [], [], []
                for i, text in enumerate(part.column(3)):
                    text, at, mine = text.as_py() or "", 0, []
                    raw = ascii_lower_bytes(text)
                    lines = raw.split(b"\n")
                    # code points of a line are its bytes where all of the text is ASCII
                    sizes = map(len, lines if len(raw) == len(text) else text.split("\n"))
                    for number, (line, size) in enumerate(zip(lines, sizes, strict=True)):
                        words = line.split()
                        h = seen.of(words)
                        mine.append(h)
                        if len(words) >= min_words:
                            found.append((i, number, at, at + size, len(words), _node(words)))
                            hashes.append(h)
                        at += size + 1
                    if span:
                        mine = np.concatenate(mine)
                        whole.append((i, len(mine), *passages.prints(mine, span, k)))
                owner, number, start, end, n_words, node = zip(*found, strict=True) if found else [()] * 6
                sizes = np.array(n_words, np.int64)
                sigs = band_hashes(np.concatenate([*hashes, np.zeros(0, np.uint64)]), sizes, width, bands)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * bands[0], pa.int32()),
                                                 pa.array(sigs.ravel()))
                at = pa.array(owner, pa.int64())
                none = [pa.nulls(len(found), pa.list_(t)) for t in (pa.int64(), pa.int32())]
                names = ["row", "doc_id", "key", "paragraph", "start", "end", "n_words", "node", "bands", "prints", "wholes"]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(at) for c in range(3)], pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(end, pa.int64()), pa.array(sizes.astype(np.int32)), pa.array(node, pa.binary()), lists, *none], names)
                if whole:
                    owner, total, grams, alls = zip(*whole, strict=True)
                    at, n = pa.array(owner, pa.int64()), len(whole)
                    ends = pa.array(np.cumsum([0, *map(len, grams)]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c).take(at) for c in range(3)], pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                         pa.nulls(n, pa.int64()), pa.array(total, pa.int32()), pa.nulls(n, pa.binary()),
                         pa.nulls(n, pa.list_(pa.int64())), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(grams))),
                         pa.ListArray.from_arrays(ends, pa.array(np.concatenate(alls)))], names)

    return source.mapInArrow(run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, min_words: int, width: int) -> DataFrame:
    """(node, tokens, n, fold) of the nodes in ``wanted`` (node, key), read from the texts again."""
    wanted = stored(wanted.select("node", "key").distinct(), "wanted", few=True)
    size = wanted.count()
    keys = wanted.select("key").distinct()
    texts = docs.select(text_key(F.col("text")).alias("key"), "text").join(_small(keys, size), "key").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = word_hashes()
        for part in parts_of(batches):
            rows = []
            for text in part.column(0):
                for *_, line, node in split_paragraphs(text.as_py(), min_words):
                    t = token_set(line, seen, width)
                    odd = np.bincount((t >> np.uint64(40)).astype(np.int64) % (64 * FOLD), minlength=64 * FOLD) & 1
                    rows.append((node, t.tobytes(), len(t), np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["node", "tokens", "n", "fold"])

    found = texts.mapInArrow(run, "node binary, tokens binary, n int, fold array<long>")
    return stored(found.join(_small(wanted.select("node"), size), "node", "left_semi").groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("tokens", "n", "fold")]), "sets")


def bucket_links(docs: DataFrame, reps: DataFrame, min_words: int, width: int, percent: int) -> DataFrame:
    """(node, root) of the nodes that link with another one. ``reps``: node, key, bands."""
    rows = reps.select("node", F.explode("bands").alias("sig"))
    several = stored(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "buckets", few=True)
    rows = stored(rows.join(_small(several, several.count()), "sig"), "members")
    sets = sets_of(docs, reps.select("node", "key").join(rows.select("node").distinct(), "node"), min_words, width)
    sketches = sets.select("node", "n", *folded())

    # the pivot of a bucket is the member that meets most others: near copies lie around their original
    weight = rows.groupBy("node").agg(F.sum("c").alias("w"))
    pivots = rows.join(weight, "node").groupBy("sig").agg(F.max(F.struct("w", "node"))["node"].alias("a"))
    first = rows.join(pivots, "sig").where("a != node").select(
        F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    for side in "ab":
        first = first.join(sketches.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}")
                                                                        for c in sketches.columns[1:]]), side)
    true = stored(linked(first.where(may_be_alike("a_", "b_", percent)).select("a", "b"), sets, percent), "links", few=True)
    roots = components(true)

    # members of a bucket that are not in one component yet
    rest = across(rows.select("sig", "node"), roots, sketches, lambda x, y: may_be_alike(x, y, percent))
    more = stored(linked(rest, sets, percent), "links", few=True)
    if not more.limit(1).count():
        return roots
    return components(more.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, width: int = WIDTH, percent: int = PERCENT,
                        bands: tuple[int, int] = BANDS) -> DataFrame:
    """Every occurrence of a paragraph that occurs again, exactly or nearly: doc_id, paragraph (line number from 0),
    start, end (code points), n_words, n_occurrences, first_doc_id, first_start, removed (all but the first)."""
    docs = docs.select("doc_id", "text")
    return _repeated_lines(docs, stored(describe(docs, min_words, width, bands), "paragraphs"), min_words, width, percent)


def _repeated_lines(docs: DataFrame, found: DataFrame, min_words: int, width: int, percent: int) -> DataFrame:
    reps = stored(found.groupBy("node").agg(F.min("key").alias("key"), F.first("bands").alias("bands")), "nodes")
    roots = bucket_links(docs, reps, min_words, width, percent)
    found = found.drop("bands", "prints", "wholes").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    place = F.struct("doc_id", "start", "row")
    groups = found.groupBy("root").agg(F.count(F.lit(1)).alias("n_occurrences"), F.min(place).alias("first")).where(
        "n_occurrences > 1")
    return found.join(groups, "root").select(
        "doc_id", "paragraph", "start", "end", "n_words", "n_occurrences", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"), (~place.eqNullSafe(F.col("first"))).alias("removed"))


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, width: int = WIDTH, percent: int = PERCENT,
                   bands: tuple[int, int] = BANDS) -> DataFrame:
    """The repeated lines (`repeated_paragraphs`) and the repeated runs of words (``passages.repeated_runs``), told apart by
    ``unit`` ('line', 'run'); what is removed is the union of the removed ranges."""
    from giniflow.llm import passages
    docs = docs.select("doc_id", "text")
    found = stored(describe(docs, min_words, width, bands, passages.SPAN, passages.K), "units")
    lines = _repeated_lines(docs, found.where(F.col("paragraph").isNotNull()), min_words, width, percent)
    runs = passages.runs_of(docs, found.where(F.col("paragraph").isNull()), passages.SPAN, passages.K)
    return lines.select(F.lit("line").alias("unit"), *lines.columns).unionByName(runs.select(F.lit("run").alias("unit"), *runs.columns))
