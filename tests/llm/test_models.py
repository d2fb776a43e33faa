"""Trained operators (3, 4, 5): counts against brute force, held-out quality, degenerate inputs."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from giniflow.llm import langid, lm, quality_net, tokens
from giniflow.llm.common import read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def remainder(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def split(text):
    return (text or "").encode().lower().split()


def naive_base(docs):
    """doc_id -> n_tokens, n_known, N, base score."""
    counts, ends = Counter(), 0
    for doc_id, text in docs:
        if remainder(doc_id, 7) != 2:
            counts.update(split(text))
            ends += 1
    if ends:
        counts["<end>"] = ends
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in docs:
        words = [*split(text), "<end>"]
        out.append((doc_id, remainder(doc_id, 7) == 2, len(words), sum(counts[w] > 0 for w in words), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert g.score <= 0 and math.isfinite(g.score)


def test_lm_base_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    same(QUERIES["op4_lattice_lm"](spark, SF).collect(), naive_base(docs))


def test_lm_blocks_do_not_change_scores(spark):
    docs = read_table(spark, SF, "documents")
    a = {r.doc_id: r.score for r in lm.lm_scores(docs, lm.file_blocks(spark)).collect()}
    b = {r.doc_id: r.score for r in lm.lm_scores(docs).collect()}
    assert a.keys() == b.keys() and all(b[k] == pytest.approx(v, rel=1e-9) for k, v in a.items())


def brute_cuts(word, probability):
    """Every cut of a word into pieces, with its probability."""
    if not word:
        return [((), 1.0)]
    return [((word[:k], *rest), probability[word[:k]] * p) for k in range(1, len(word) + 1) if word[:k] in probability
            for rest, p in brute_cuts(word[k:], probability)]


def test_lattice_sums_all_segmentations():
    names = {b"a": .1, b"b": .2, b"ab": .3, b"ba": .05, b"aba": .07, b" ": .01, b" a": .02}
    table = lm.Lattice({name: k for k, name in enumerate(names)})
    logs = np.log(np.array(list(names.values())))[table.ids]
    words = [b"a", b"ab", b"abab", b"aababab", b" abaab", b"ba", b" a", b" a"]
    counts = np.array([3.0, 1, 2, 1, 4, 1, 2, 5])
    sums = [sum(p for _, p in brute_cuts(w, names)) for w in words]
    assert table.log10(words, logs) == pytest.approx(np.log10(sums))
    want = Counter()
    for w, n, total in zip(words, counts, sums, strict=True):
        for cut, p in brute_cuts(w, names):
            for piece in cut:
                want[piece] += n * p / total
    got = dict(zip([list(names)[k] for k in table.ids], table.expected(words, counts, logs), strict=True))
    assert got == pytest.approx({name: want[name] for name in names})


def naive_lattice(docs, rounds, smoothing):
    """(doc_id, n_tokens) -> score by plain recursions over dictionaries, weights by the same rounds."""
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(tokens.TOKENIZER)
    names, longest = lm.pieces(path)
    tokenizer, train, ends = Tokenizer.from_file(path), Counter(), 0
    for doc_id, text in docs:
        if remainder(doc_id, 7) != 2:
            train.update(b" " + w for w in split(text))
            ends += 1
    weight, by_id = Counter(), {i: name for name, i in names.items()}
    for w, n in train.items():
        for i in tokenizer.encode(w.decode(), add_special_tokens=False).ids:
            weight[by_id[i]] += n

    def forward(word, p):
        a = [1.0] + [0.0] * len(word)
        for e in range(1, len(word) + 1):
            a[e] = sum(a[b] * p(word[b:e]) for b in range(max(0, e - longest), e) if word[b:e] in names)
        return a

    for r in range(rounds + 1):
        total = sum(weight.values()) + ends + smoothing * (len(names) + 1)
        p = lambda x: (weight[x] + smoothing) / total  # noqa: B023, E731
        if r == rounds:
            break
        expected = Counter()
        for w, n in train.items():
            a = forward(w, p)
            back = [0.0] * len(w) + [1.0]
            for b in range(len(w) - 1, -1, -1):
                back[b] = sum(p(w[b:e]) * back[e] for e in range(b + 1, min(len(w), b + longest) + 1) if w[b:e] in names)
            for b in range(len(w)):
                for e in range(b + 1, min(len(w), b + longest) + 1):
                    if w[b:e] in names:
                        expected[w[b:e]] += n * a[b] * p(w[b:e]) * back[e] / a[-1]
        weight = expected
    known, end = {}, math.log10((ends + smoothing) / total)
    out = {}
    for doc_id, text in docs:
        score = end
        for w in split(text):
            if w not in known:
                known[w] = math.log10(forward(b" " + w, p)[-1])
            score += known[w]
        out[doc_id] = score
    return out


def test_lattice_scores_match_plain_recursions(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").where("length(text) < 1500").limit(60).collect()]
    got = {r.doc_id: r.score for r in lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == pytest.approx(naive_lattice(docs, lm.ROUNDS, lm.SMOOTHING), rel=1e-9)


def test_expectation_raises_the_likelihood(spark):
    docs = read_table(spark, SF, "documents")
    mean = lambda rounds: lm.lm_scores(docs, rounds=rounds).where("not held_out").agg(
        {"score": "sum", "n_tokens": "sum"}).selectExpr("`sum(score)` / `sum(n_tokens)` m").first().m
    cut, one, three = mean(0), mean(1), mean(3)
    assert cut + 0.1 < one < three


def test_pieces_cover_all_bytes():
    table, longest = lm.pieces(tokens.tokenizer_path(tokens.TOKENIZER))
    assert all(bytes([b]) in table for b in range(256))
    assert len(table) == 50_256 and longest == max(map(len, table))


def test_lm_of_degenerate_inputs(spark):
    docs = [(1, None), (2, ""), (None, "a b"), (3, "Ab aB"), (3, "Ab aB"), (4, "x" * 30_000), (5, "\x1c é É z"),
            *[(k, "hot words") for k in range(10, 60)]]
    df = spark.createDataFrame([(*d, 1, "w") for d in docs], "doc_id long, text string, block int, word string")
    same(lm.lm_scores(df).collect(), naive_base(docs))
    assert lm.lm_scores(df.limit(0)).collect() == []
    out = [d for d in docs if remainder(d[0], 7) == 2]
    only = spark.createDataFrame(out, "doc_id long, text string")
    same(lm.lm_scores(only).collect(), naive_base(out))


def test_language_of_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id for r in rows} == truth.keys()
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def plain_ngrams(text):
    """Feature -> count by loops over characters."""
    out, one, two, three = Counter(), *(int(p) for p in langid._P)
    text = (text or "").lower()
    if not any(map(str.isalpha, text)):
        return out
    chars = [" "]
    for x in text:
        if x.isalpha() or chars[-1] != " ":
            chars.append(x if x.isalpha() else " ")
    chars += [" "] if chars[-1] != " " or not text[-1].isalpha() else []
    c, m = [ord(x) for x in chars], (1 << 64) - 1
    for i in range(len(c)):
        a = c[i] * one & m
        if 0 < i < len(c) - 1:
            out[a >> (64 - langid.BITS)] += 1
        if i + 1 < len(c):
            b = ((a ^ (c[i + 1] * two & m)) * one) & m
            out[b >> (64 - langid.BITS)] += 1
            if i + 2 < len(c):
                out[((b ^ (c[i + 2] * three & m)) * two & m) >> (64 - langid.BITS)] += 1
    return out


def test_language_scores_match_dense_vectors(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in read_table(spark, SF, "documents").collect()] + [(9001, "?!", "en"), (9002, None, "fr")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    train = [d for d in docs if remainder(d[0], 4) != 2]
    df = Counter(f for _, text, _ in train for f in plain_ngrams(text))
    idf = np.array([np.log((1 + len(train)) / (1 + df[f])) + 1 for f in range(1 << langid.BITS)])
    langs, got_idf, weights, temperature = langid.fit(spark.createDataFrame(train, frame.schema))
    assert np.allclose(got_idf, idf)
    for r in langid.predict_language(frame).collect():
        counts = plain_ngrams(next(t for d, t, _ in docs if d == r.doc_id))
        if not counts:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        x = np.zeros(1 << langid.BITS)
        for f, n in counts.items():
            x[f] = (1 + np.log(n)) * idf[f]
        z = x / np.sqrt((x * x).sum()) @ weights / temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == langs[int(p.argmax())] and r.score == pytest.approx(p.max(), abs=1e-9)


def test_sample_is_bounded_for_equal_rows(spark):
    rows = [(1, "same", "en")] * 900 + [(None, f"t{k}", "en") for k in range(400)] + [(k, "other", "fr") for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = langid.sampled(frame, 50, "lang", ["doc_id", "text"]).groupBy("lang").count().collect()
    n = {r["lang"]: r["count"] for r in got}
    assert n["fr"] == 20 and n.get("en", 0) <= 50


def test_language_ignores_other_columns(spark):
    docs = read_table(spark, SF, "documents")
    other = docs.selectExpr("doc_id", "text", f"CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 "
                            "THEN 'xx' ELSE lang END AS lang", "'s' AS source")
    key = lambda df: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in df.collect())
    assert key(langid.predict_language(docs)) == key(langid.predict_language(other))


def test_language_of_degenerate_inputs(spark):
    texts = [None, "", "123 !?", "le la les des", "the and of to"]
    df = spark.createDataFrame([(k, t, "fr" if k == 3 else None, 0) for k, t in enumerate(texts)],
                               "doc_id long, text string, lang string, count int")
    rows = {r.doc_id: r for r in langid.predict_language(df).collect()}
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 for k in (0, 1, 2))
    assert langid.predict_language(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.predict_language(df.where("lang is null")).collect()} == {"und"}


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in read_table(spark, sf, "labels").collect()}
    rows = QUERIES["op3_quality_net"](spark, sf).collect()
    assert len(rows) == read_table(spark, sf, "documents").count()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_quality_scores_match_a_plain_network(spark):
    """Every chunk of the whole text at once, with the fitted weights."""
    docs, labels = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "labels")
    marks = labels.where("quality in (0, 1)").selectExpr("doc_id", "cast(quality as int) quality").collect()
    marked = spark.createDataFrame([m for m in marks if remainder(m.doc_id, 5) != 0], "doc_id long, quality int")
    net, shift = quality_net.fit_quality(docs.select("doc_id", "text"), marked)
    got = {r.doc_id: r.score for r in quality_net.quality_scores(docs, labels).collect()}
    n = {k: v.astype(np.float64) for k, v in net.items()}
    for r in docs.collect():
        raw = (r.text or "").encode()
        raw = raw.ljust(max(16, -(-len(raw) // 8) * 8), b"\0")
        chunks = np.array([list(raw[k:k + 16]) for k in range(0, len(raw) - 8, 8)])
        filters = np.concatenate([n["left"], n["right"]])
        a = np.tanh((n["embed"][chunks].reshape(len(chunks), -1) @ filters).max(axis=0) + n["bias"])
        z = np.maximum(0, a @ n["hidden"] + n["hidden_bias"]) @ n["out"] + n["out_bias"][0] + shift
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in quality_net.new_net(1).items()}
    texts = [quality_net.blocks(rng.bytes(n)) for n in (0, 5, 40, 300)]
    y = np.array([1, 0, 1, 0.0])

    def loss(net):
        z = quality_net.head(net, np.array([quality_net.pooled(net, t)[0] for t in texts], np.float64))[2]
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))

    g = quality_net.gradients(net, texts, y)
    for name in ("left", "right", "hidden", "out", "bias", "embed"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        up, down = ({k: v.copy() for k, v in net.items()} for _ in range(2))
        up[name][at] += 1e-3
        down[name][at] -= 1e-3
        assert g[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-3, rel=0.05, abs=1e-4)


def test_pooling_covers_long_texts():
    net = quality_net.new_net(2)
    rows = quality_net.blocks(np.random.default_rng(1).bytes(300_000))
    x = net["embed"][rows].reshape(len(rows), -1)
    whole = (x[:-1] @ net["left"] + x[1:] @ net["right"]).max(axis=0) + net["bias"]
    assert np.allclose(quality_net.pooled(net, rows)[0], whole, rtol=1e-4, atol=1e-4)


def test_quality_of_degenerate_inputs(spark):
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in ((1, None), (2, ""), (None, "a"), (3, "b c " * 50_000), (3, "d"))],
                                 "doc_id long, text string, quality string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (3, 1, 1), (None, 1, 0), (4, None, 0), (99, 0, 0)],
                                   "doc_id long, quality long, toxic long")
    for table, marks in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        rows = quality_net.quality_scores(table, marks).collect()
        assert len(rows) == table.count() and all(0 <= r.score <= 1 for r in rows)
