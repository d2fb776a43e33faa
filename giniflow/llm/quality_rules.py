"""Quality rules (operator 9): zstandard ratios over whole documents and fixed chunks, with limits by length.

The ratio is bytes / compressed bytes. Text that compresses far better than prose repeats itself; text that hardly
compresses is random characters or encoded data. Short texts compress worse (nothing to refer back to), so limits come in
bands by the length in bytes. Chunks, the last partial one included, catch documents that are sound on the whole but
hold long bad passages.

Null and empty texts have no words and fail the base rule. Repeated rows give repeated results; any length works, one
text at a time is held besides its batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import BLANKS, release

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """``limits``: (bytes up to, smallest ratio, largest ratio). Prose in Latin script lies near 1.4 to 1.7 below 512
    bytes, 2 to 2.6 at 4 KB and 2.3 to 3.5 beyond; random base64 near 1.3. A document fails when its whole ratio lies
    outside its band, or when chunks outside the chunk band hold more than ``max_bad_share`` of its bytes."""
    limits: tuple[tuple[float, float, float], ...] = (
        (512, 1.05, 3.0), (2048, 1.25, 4.0), (16384, 1.4, 5.0), (float("inf"), 1.45, 6.0))
    chunk_bytes: int = 4096
    chunk_limits: tuple[float, float] = (1.35, 5.0)
    max_bad_share: float = 0.3
    level: int = 3


def in_band(n: int, ratio: float, limits) -> bool:
    for most, low, high in limits:
        if n < most:
            return low <= ratio <= high
    return True


def chunk_in_band(n: int, ratio: float, bands: Bands) -> bool:
    """Full chunks against the chunk band; the rest behind the last full one against the band of its own length, but never
    against a higher least ratio than a full chunk."""
    low, high = bands.chunk_limits
    if n < bands.chunk_bytes:
        low, high = next((min(low, least), most) for size, least, most in bands.limits if n < size)
    return low <= ratio <= high


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    v = len(seen)
    if v < 1 << 21:
        code = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # pairs first, so that a code stays below 2**63
        pair = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1].astype(np.int64)
        code = pair[:-1] * v + ids[2:]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    at = np.concatenate([order[1:][same], order[:-1][same]])
    hit = np.zeros(n, dtype=bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def profile(text: str | None, bands: Bands, squeeze) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio (None if empty), in_bands."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return 0, 0, 0, 0, 0, None, False
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ratio = len(raw) / len(squeeze(raw))
    ok = in_band(len(raw), ratio, bands.limits)
    if ok and len(raw) > bands.chunk_bytes:
        bad = 0
        for at in range(0, len(raw), bands.chunk_bytes):
            chunk = raw[at:at + bands.chunk_bytes]
            if not chunk_in_band(len(chunk), len(chunk) / len(squeeze(chunk)), bands):
                bad += len(chunk)
        ok = bad <= bands.max_bad_share * len(raw)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), ratio, ok)


PROFILE = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, "
           "in_bands boolean")
_FIELDS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
           ("n_repeat_words", pa.int64()), ("ratio", pa.float64()), ("in_bands", pa.bool_()))


def text_profile(text: Column, bands: Bands = Bands()) -> Column:
    """Struct of the base counts, the whole document's ratio and the verdict of the bands."""

    @F.arrow_udf(PROFILE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        squeeze = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in batches:
            columns = list(zip(*(profile(t.as_py(), bands, squeeze) for t in batch), strict=True)) or [()] * len(_FIELDS)
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)],
                                             fields=[pa.field(n, t) for n, t in _FIELDS])

    return run(text)


def base_failed(p: Column, min_words: int = 50, max_repeat: int = 50) -> Column:
    return (p["n_words"] < min_words) | (100 * p["n_repeat_words"] > max_repeat * p["n_words"])


def quality_report(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the ratio, for every row of ``docs``."""
    p = F.col("p")
    return (docs.select(F.col(id_col).alias("doc_id"), text_profile(F.col(text_col), bands).alias("p"))
            .select("doc_id", p["n_words"].alias("n_words"), p["word_chars"].alias("word_chars"),
                    p["n_symbols"].alias("n_symbols"), p["n_dup_lines"].alias("n_dup_lines"),
                    p["n_repeat_words"].alias("n_repeat_words"), base_failed(p).alias("base_failed"),
                    (~base_failed(p) & p["in_bands"]).alias("kept"), p["ratio"].alias("ratio")))


def keep_quality(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the bands, all columns unchanged."""
    columns = [docs[f"`{c}`"] for c in docs.columns]
    row = docs.select(F.struct(*columns).alias("row"), text_profile(docs[f"`{text_col}`"], bands).alias("p"))
    return row.where(~base_failed(F.col("p")) & F.col("p")["in_bands"]).select("row.*")
