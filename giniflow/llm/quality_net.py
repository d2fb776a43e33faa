"""Quality classifier (operator 3): a byte-level convolutional network in numpy.

Bytes are embedded in ``EMBED`` numbers; filters over chunks of 16 bytes that overlap by half cover the whole text. Each
filter's largest response over all chunks (max pooling) goes through a small hidden layer into one probability. Filters,
embedding and the other weights are learned together by Adam on the whole texts of a bounded sample of at most ``SAMPLE``
labelled rows per class; the intercept is then corrected for the class shares of all training labels.

Scores use the text only and always the whole text; empty and null texts get the score of padding. A label without a
row in ``documents`` is not used, of several labels of an id the best counts, of several texts the least; without labels
of both classes every score is near that class (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import id_bucket
from giniflow.llm.langid import sampled

EMBED, HALF, FILTERS, HIDDEN = 8, 8, 64, 16
#: Of the fit: rows per class at most, passes, rows per step.
SAMPLE, EPOCHS, STEP = 2000, 8, 32

Net = dict[str, np.ndarray]


def new_net(seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    return {"embed": normal(256, EMBED), "left": normal(HALF * EMBED, FILTERS) / np.float32(HALF),
            "right": normal(HALF * EMBED, FILTERS) / np.float32(HALF), "bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS, HIDDEN) / np.float32(np.sqrt(FILTERS)), "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN) / np.float32(np.sqrt(HIDDEN)), "out_bias": np.zeros(1, np.float32)}


def blocks(raw: bytes) -> np.ndarray:
    """Bytes in rows of ``HALF``, padded with zeros; two neighbouring rows are one chunk."""
    size = max(2, -(-len(raw) // HALF))
    return np.frombuffer(raw.ljust(size * HALF, b"\0"), np.uint8).reshape(size, HALF)


def pooled(net: Net, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of every filter, and the chunk where it is; long texts go through in parts that overlap."""
    best, where = np.full(FILTERS, -np.inf, np.float32), np.zeros(FILTERS, np.int64)
    for at in range(0, len(rows) - 1, 1 << 13):
        x = net["embed"][rows[at:at + (1 << 13) + 1]].reshape(-1, HALF * EMBED)
        r = x[:-1] @ net["left"] + x[1:] @ net["right"]
        k = r.argmax(axis=0)
        top = r[k, np.arange(FILTERS)]
        more = top > best
        best[more], where[more] = top[more], (k + at)[more]
    return best + net["bias"], where


def head(net: Net, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pooled responses after the bend, hidden layer, logit."""
    a = np.tanh(p)
    h = np.maximum(0, a @ net["hidden"] + net["hidden_bias"])
    return a, h, h @ net["out"] + net["out_bias"][0]


def gradients(net: Net, texts: list[np.ndarray], y: np.ndarray) -> Net:
    found = [pooled(net, t) for t in texts]
    p = np.array([f[0] for f in found])
    a, h, z = head(net, p)
    d = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
    g = {k: np.zeros_like(v) for k, v in net.items()}
    g["out"], g["out_bias"][0] = h.T @ d, d.sum()
    dh = np.outer(d, net["out"]) * (h > 0)
    g["hidden"], g["hidden_bias"] = a.T @ dh, dh.sum(axis=0)
    dp = (dh @ net["hidden"].T) * (1 - a * a)
    g["bias"] = dp.sum(axis=0)
    for text, (_, where), dr in zip(texts, found, dp, strict=True):  # only the chunk that won passes the gradient on
        for side, rows in (("left", text[where]), ("right", text[where + 1])):
            x = net["embed"][rows].reshape(FILTERS, -1)
            g[side] += x.T * dr
            np.add.at(g["embed"], rows.reshape(-1), (net[side] * dr).T.reshape(-1, EMBED))
    return g


def fit_net(texts: list[np.ndarray], y: np.ndarray, seed: int = 5, rate: float = 0.01) -> Net:
    net = new_net(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    rng, t = np.random.default_rng(seed), 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), STEP):
            t += 1
            some = order[at:at + STEP]
            step = rate * (1 - epoch / EPOCHS)
            for k, g in gradients(net, [texts[i] for i in some], y[some]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                net[k] -= (step * (first[k] / (1 - 0.9 ** t))
                           / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return net


def fit_quality(docs: DataFrame, marked: DataFrame) -> tuple[Net | None, float]:
    """Network and the logit to add to its output, from docs (doc_id, text) and marked (doc_id, quality 0 or 1, unique
    ids). Ids alone meet the labels; only the texts of the sample move, found by a broadcast of its ids."""
    labelled = docs.select("doc_id").distinct().join(marked, "doc_id")
    n = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not (n0 and n1):
        return None, 0.0 if n0 == n1 else (9.0 if n1 else -9.0)
    chosen = sampled(labelled, SAMPLE, "quality", ["doc_id"])  # at most SAMPLE rows per class
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = sorted(map(tuple, texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(
        F.min("text").alias("text")).collect()), key=str)
    y = np.array([g[1] for g in got], np.float32)
    net = fit_net([blocks(g[2].encode("utf-8", "surrogatepass")) for g in got], y)
    ones = float(y.sum())
    return net, float(np.log(n1 / n0) - np.log(max(ones, 1) / max(len(y) - ones, 1)))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (5, 0),
                   threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    mod, rest = held_out
    marked = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    marked = marked.where(~(id_bucket(F.col("doc_id"), mod) == rest)).groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    net, shift = fit_quality(docs.select("doc_id", "text"), marked)
    model = docs.sparkSession.sparkContext.broadcast((net, shift))  # a few thousand numbers

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net, shift = model.value
        for batch in batches:
            if net is None:
                yield pa.array(np.full(len(batch), 1 / (1 + np.exp(-shift))), pa.float64())
                continue
            p = np.array([pooled(net, blocks((t.as_py() or "").encode("utf-8", "surrogatepass")))[0] for t in batch])
            z = head(net, p.reshape(len(batch), FILTERS))[2].astype(np.float64) + shift
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))), pa.float64())

    out = docs.select("doc_id", (id_bucket(F.col("doc_id"), mod) == rest).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
