"""Helpers shared by the text operators: tables, shared storage, ASCII lower case, word splitting.

Words of the operators are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``. ``bytes.split()`` splits on
exactly these six bytes, so tasks split UTF-8 bytes instead of running a regular expression.
"""

from __future__ import annotations

import ctypes
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\x0c\r"
T = TypeVar("T")
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch at most: rows are whole texts or token sets, so the usual 10,000 would fill hundreds of MB.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Files per core of a table that is stored with ``few``, at most; narrow rows that a file should hold at least.
FILES_PER_CORE, FILE_ROWS = 4, 50_000


def few_partitions(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in a few partitions per core and, where the number of its rows is known roughly, in no more than they fill.
    Partitions that meet in a task run one after the other."""
    most = FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(most if rows is None else max(1, min(most, -(-rows // FILE_ROWS))))


def stored(df: DataFrame, name: str, few: bool = False, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and return a DataFrame that reads it back.

    It cuts the lineage: an executor that is lost later costs a reread, never a second run of the plan before. ``few``: the
    table is narrow (links, keys, counts); it is written in a few files per core, or as few as ``rows`` rows fill, however
    many shuffle partitions there are, as creating and opening files would take longer than their rows. On a local folder
    Hadoop starts a ``chmod`` for every file besides, and until that process runs the executor's memory is there twice."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if few:
        df = few_partitions(df, rows)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict[tuple, object] = {}


def held(owner: tuple, build: Callable[[], T]) -> T:
    """What a worker process keeps from task to task for one operator (an encoder with its cache, word hashes). Another
    operator's takes its place, so that the stages of a pipeline do not add up in a worker that serves them all."""
    if owner not in _HELD:
        release()
        _HELD[owner] = build()
    return _HELD[owner]


def release() -> None:
    """For operators that keep nothing: what an earlier one left in this worker goes, back to the system where the C library
    can do that: a worker lives as long as its executor, whose memory it shares."""
    if not _HELD:
        return
    _HELD.clear()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


class WordHashes(dict):
    """64-bit hashes of words, never 0; emptied when it holds too many."""

    MOST = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash
        value = xxhash.xxh64_intdigest(word) or 1
        if len(self) < self.MOST:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    """The word hashes of this worker; those met first, so the frequent ones, stay between tasks."""
    return held(("word hashes",), WordHashes)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts (as many bytes as characters) take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def ascii_lower_bytes(text: str) -> bytes:
    """UTF-8 bytes with A-Z in lower case: ``bytes.lower`` touches ASCII letters only."""
    return text.encode("utf-8", "surrogatepass").lower()


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def id_bucket_py(doc_id, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def by_bytes(items: list[T], most: int) -> Iterator[list[T]]:
    """Consecutive groups of about ``most`` units of length; one longer item is a group of its own."""
    group: list[T] = []
    size = 0
    for item in items:
        if group and size + len(item) > most:
            yield group
            group, size = [], 0
        group.append(item)
        size += len(item)
    if group:
        yield group
