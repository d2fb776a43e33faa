"""Token counts (operator 10) and token ids of whole texts, batch-encoded inside Arrow functions.

A byte-level BPE tokenizer splits a text into pretokens before it merges bytes, and none of its pretokens crosses the
border between a non-blank character and a blank one. Texts are cut there (safe boundaries), the distinct segments that
a worker has not met yet are encoded in batches of equal bytes, and results of short segments are kept in a bounded
cache. A document's ids are its segments' ids in order, so they are those of the library for the whole text.

Null text counts as empty; empty text has no tokens; repeated rows give repeated results; extra columns stay untouched.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import islice
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import by_bytes, held

TOKENIZER = "byte_bpe_50k.json"
#: Segments kept in a worker's cache, characters of a segment that is kept, characters of one encoded batch.
CACHE_SIZE, CACHED_LENGTH, BATCH_CHARS = 900_000, 64, 1 << 18
#: Segments that stay when the cache is full and between tasks: the first ones met, so the frequent ones.
KEPT = 400_000
#: Words in a line that is encoded at once.
LINE = 200
#: Texts beyond so many characters are cut at every safe boundary, and their segments beyond the second number between
#: ASCII letters and digits as well.
LONG_TEXT, LONG_SEGMENT = 1 << 22, 1 << 15

_BLANK_BEFORE_SPACE = re.compile(r"\s ")
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\x0b\x0c\r])")
_LETTER_DIGIT = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")

T = TypeVar("T")


def tokenizer_path(name: str) -> str:
    """A path is taken as it is, a bare file name is looked up among the public vocabularies."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def is_plain(text: str) -> bool:
    """Whether every space follows a non-blank character and no part between spaces is long."""
    return not _BLANK_BEFORE_SPACE.search(text) and text[:1] != " " and len(text) <= LONG_TEXT


def segments(text: str) -> list[str]:
    """Cut any text at safe boundaries; the segments joined give the text again."""
    return [p for q in _SAFE.split(text) for p in ([q] if len(q) <= LONG_SEGMENT else _LETTER_DIGIT.split(q))]


def fits_a_line(item: str) -> bool:
    """Whether a space and ``item`` may stand in a line between line feeds without changing its tokens: no blanks in it
    but single line feeds between non-blanks, and no special token (these contain ``<``)."""
    return item.split("\n") == item.split() and "<" not in item


class SegmentEncoder:
    """Encodes texts by their segments with a bounded cache. Plain texts are split at spaces and their words numbered by
    Arrow, so Python sees each different word of a batch once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, dict[str, bytes]] = {" ": {}, "": {}}
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None

    def _encode(self, items: list[str], lead: str) -> list[bytes]:
        """Little-endian 32-bit ids of ``lead + item``. Words behind a space go to the library many at a time,
        with line feeds between them by whose id they are told apart; the others go one by one."""
        found: dict[str, bytes] = {}
        words = [p for p in items if fits_a_line(p)] if lead and self.feed is not None else []
        lines = [words[k:k + LINE] for k in range(0, len(words), LINE)]
        for some in by_bytes(lines, BATCH_CHARS // 8):
            encoded = self.tokenizer.encode_batch_fast([" " + "\n ".join(x) for x in some], add_special_tokens=False)
            for line, e in zip(some, encoded, strict=True):
                ids = np.array(e.ids, "<u4")
                ends = [*np.flatnonzero(ids == self.feed).tolist(), len(ids)]
                parts = [p.count("\n") for p in line]
                if len(ends) != len(line) + sum(parts):  # never seen; these go one by one
                    continue
                raw, x, k = ids.tobytes(), 0, -1
                for p, more in zip(line, parts, strict=True):
                    k += 1 + more
                    found[p] = raw[4 * x:4 * ends[k]]
                    x = ends[k] + 1
        for group in by_bytes([p for p in items if p not in found], BATCH_CHARS):
            encoded = self.tokenizer.encode_batch_fast([lead + p for p in group], add_special_tokens=False)
            found.update((p, array("I", e.ids).tobytes()) for p, e in zip(group, encoded, strict=True))
        return [found[p] for p in items]

    def trim(self) -> None:
        for lead, known in self.known.items():
            if len(known) > KEPT:
                self.known[lead] = dict(islice(known.items(), KEPT))

    def look_up(self, items: list[str], lead: str) -> list[bytes]:
        """Ids of ``lead + item`` for each item, from the cache or new."""
        if len(self.known[lead]) > CACHE_SIZE:
            self.trim()
        known = self.known[lead]
        out = list(map(known.get, items))
        new = list(dict.fromkeys(p for p, v in zip(items, out, strict=True) if v is None))
        fresh = dict(zip(new, self._encode(new, lead), strict=True))
        known.update((p, v) for p, v in fresh.items() if len(p) <= CACHED_LENGTH)
        return [fresh[p] if v is None else v for p, v in zip(items, out, strict=True)]

    def encode_once(self, words: list[str]) -> list[np.ndarray]:
        """Ids of a space and each word, without the cache: for words that are all different."""
        return [np.frombuffer(x, "<u4") for x in self._encode(words, " ")]

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of plain texts: ids of the different segments, place and length of each, segment numbers of all texts, and
        where each text's segments begin."""
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        words, starts = lists.flatten(), lists.offsets.to_numpy()[:-1]
        numbered = words.dictionary_encode()
        codes = numbered.indices.to_numpy().astype(np.int64)
        behind = self.look_up(numbered.dictionary.to_pylist(), " ")
        heads = self.look_up(words.take(pa.array(starts)).to_pylist(), "")  # no space before the first word
        codes[starts] = len(behind) + np.arange(len(texts))
        values = behind + heads
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        return np.frombuffer(b"".join(values), "<u4"), lengths, codes, starts

    def counts(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        plain = [k for k, t in enumerate(texts) if t and is_plain(t)]
        if plain:
            _, lengths, codes, starts = self.plain([texts[k] for k in plain])
            for k, n in zip(plain, np.add.reduceat(lengths[codes], starts).tolist(), strict=True):
                out[k] = n
        for k in set(range(len(texts))).difference(plain):
            out[k] = sum(map(len, self.look_up(segments(texts[k] or ""), ""))) // 4
        return out

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        plain = [k for k, t in enumerate(texts) if t and is_plain(t)]
        if plain:
            table, lengths, codes, starts = self.plain([texts[k] for k in plain])
            place = np.cumsum(lengths) - lengths
            n = lengths[codes]
            end = np.cumsum(n)
            flat = table[np.repeat(place[codes] - (end - n), n) + np.arange(end[-1])]
            for k, x in zip(plain, np.split(flat, (end - n)[starts[1:]]), strict=True):
                out[k] = x
        for k in set(range(len(texts))).difference(plain):
            out[k] = np.frombuffer(b"".join(self.look_up(segments(texts[k] or ""), "")), "<u4")
        return out


def text_batches(texts: list[T], size: Callable[[T], int], most: int = 1 << 22) -> Iterator[list[T]]:
    """Consecutive texts of about ``most`` characters together."""
    group: list[T] = []
    total = 0
    for t in texts:
        group.append(t)
        total += size(t)
        if total >= most:
            yield group
            group, total = [], 0
    if group:
        yield group


def encoder(path: str) -> SegmentEncoder:
    """One encoder per worker process, so that its cache serves all tasks of the worker."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held(("encoder", path), lambda: SegmentEncoder(path))


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Number of tokens of each whole text, without begin, end or added special tokens."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(tokenizer_path(tokenizer))
        counts = encode.counts
        for batch in batches:
            lengths = [n for part in text_batches(batch.to_pylist(), lambda t: len(t or "")) for n in counts(part)]
            yield pa.array(lengths, pa.int64())
        encode.trim()

    return count(text)


def token_counts(docs: DataFrame, limit: int = 512, text_col: str = "text", id_col: str = "doc_id",
                 tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``) for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                        token_count(text, tokenizer).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
