"""Language identification (operator 5): multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the n-grams of one to three characters are hashed
into ``2 ** BITS`` features with weight ``(1 + ln tf) * idf``, scaled to length one. Document frequencies are counted over
all training rows (distributed, at most one number per feature). The weights are trained by follow-the-regularised-leader
with elastic net on a bounded sample of at most ``SAMPLE`` rows per language; a part of the sample that takes no part in
training sets the temperature of the softmax.

Null texts and texts without a letter are ``und`` with score 0; without training rows every text is. Rows need no key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from giniflow.llm.common import id_bucket

BITS = 16
#: Rows per language in the sample (bound of the fit), share of them kept for calibration, passes over the others.
SAMPLE, CALIBRATION, EPOCHS = 300, 0.25, 3
#: FTRL-proximal: learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features that occur and how often; none without a letter."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[chars]
    if not letter.any():
        return none, none
    chars = np.where(letter, chars, 32)
    keep = np.ones(len(chars), bool)
    keep[1:] = letter[1:] | letter[:-1]
    c = np.concatenate([[32], chars[keep], [32]]).astype(np.uint64)
    with np.errstate(over="ignore"):
        one = c * _P[0]
        two = (one[:-1] ^ (c[1:] * _P[1])) * _P[0]
        three = (two[:-1] ^ (c[2:] * _P[2])) * _P[1]
    grams = np.concatenate([one[1:-1], two, three]) >> np.uint64(64 - BITS)
    counts = np.bincount(grams.astype(np.int64), minlength=1 << BITS)
    used = np.flatnonzero(counts)
    return used, counts[used]


def features(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[used]
    return x / np.sqrt(x @ x)


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, and the number of documents, over all rows of ``train``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                used, _ = ngram_counts(text.as_py())
                total[used] += 1
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["f", "c"])

    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in train.select("text").mapInArrow(run, "f long, c long").groupBy("f").agg(F.sum("c").alias("c")).collect():
        out[r["f"]] = r["c"]
    return out[:-1], int(out[-1])


def sampled(train: DataFrame, per_class: int, label: str, order: list[str]) -> DataFrame:
    """At most ``per_class`` rows of every class, those with the least hash of ``order``. A class is thinned to twice its
    share before it is ranked; rows that are equal count one by one, so no group of them comes as a whole."""
    sizes = train.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    u = F.pmod(F.xxhash64(F.lit("sample"), *order), F.lit(1 << 40)) / F.lit(float(1 << 40))
    thin = train.withColumn("_u", u).join(F.broadcast(sizes), label).where(F.col("_u") < F.lit(2.0 * per_class) / F.col("_size"))
    ranked = thin.withColumn("_rank", F.row_number().over(Window.partitionBy(label).orderBy("_u")))
    return ranked.where(F.col("_rank") <= per_class).drop("_size", "_u", "_rank")


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 7) -> np.ndarray:
    """Weights (features x classes) from rows of (features, values, class)."""
    z, n = np.zeros((1 << BITS, classes)), np.zeros((1 << BITS, classes))

    def weights(at):
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            squared = n[at] + g * g
            z[at] += g - (np.sqrt(squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] = squared
    return weights(np.arange(1 << BITS))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least negative log likelihood, on a grid of powers; of equally good ones the highest, so that a
    sample without errors does not make every score 1."""
    if not len(y):
        return 1.0
    grid = 2.0 ** np.arange(-6, 4.01, 0.25)
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(max(t for t, x in zip(grid, loss, strict=True) if x <= min(loss) + 1e-3))


def fit(train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, idf, weights and temperature from rows of doc_id, text, lang."""
    df, n_docs = document_frequencies(train)
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()),
                 pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())], names=["lang", "f", "c"])

    sample = sampled(train.where("text is not null"), SAMPLE, "lang", ["doc_id", "text"]).select("lang", "text")
    got = sorted(map(tuple, sample.mapInArrow(run, "lang string, f binary, c binary").collect()))  # at most SAMPLE per language
    langs = sorted({g[0] for g in got})
    rows = []
    for lang, f, c in got:
        used = np.frombuffer(f, np.int32)
        if len(used):
            rows.append((used, features(used, np.frombuffer(c, np.int32), idf), langs.index(lang)))
    mixed = np.random.default_rng(11).permutation(len(rows))
    cut = int(len(rows) * CALIBRATION)
    weights = fit_ftrl([rows[k] for k in mixed[cut:]], max(1, len(langs)))
    kept = [rows[k] for k in mixed[:cut]]
    logits = np.array([x @ weights[at] for at, x, _ in kept]).reshape(len(kept), max(1, len(langs)))
    return langs, idf, weights, fit_temperature(logits, np.array([y for _, _, y in kept], int))


def predict_language(docs: DataFrame, held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learns from text and lang of the rows that are not held out."""
    mod, rest = held_out
    out = id_bucket(F.col("doc_id"), mod) == rest
    langs, idf, weights, temperature = fit(docs.where(~out & F.col("lang").isNotNull()).select("doc_id", "text", "lang"))
    model = docs.sparkSession.sparkContext.broadcast((langs, idf, weights, temperature))  # features x languages

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        langs, idf, weights, temperature = model.value
        for batch in batches:
            names, scores = [], []
            for text in batch:
                used, counts = ngram_counts(text.as_py())
                if len(used) and langs:
                    p = softmax(features(used, counts, idf) @ weights[used] / temperature)
                    names.append(langs[int(p.argmax())])
                    scores.append(float(p.max()))
                else:
                    names.append("und")
                    scores.append(0.0)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["lang_pred", "score"])

    return docs.select("doc_id", out.alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")
