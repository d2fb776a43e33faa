"""Ranked search against scores of every document, segments against plain postings, degenerate inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from giniflow.llm import lexical
from giniflow.llm.common import LOWER, UPPER, read_table, stored
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLE = str.maketrans(UPPER, LOWER)
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(TABLE))


def naive(docs, items, top=50):
    terms = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    terms = [(doc_id, c, c.total()) for doc_id, c in terms if c]
    n_docs, n_terms = len(terms), sum(n for _, _, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c, n in terms:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(split(text)) if t in c)
            if score:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, k, doc_id, -score) for k, (score, _, doc_id) in enumerate(found[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_matches_scores_of_every_document(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    assert rows(QUERIES["op13_ranked_search"](spark, SF)) == naive(docs, items)


def texts(rng, n, words, most):
    return ["".join(rng.choice(words) + rng.choice([" ", ", ", "_", "\x00"]) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("seed,segment_terms,window", [(0, 300, 7), (1, 20_000, 64), (2, 10**9, 2048)])
def test_random_texts(spark, seed, segment_terms, window):
    """Common and rare words, many equal scores; small segments, query blocks and windows."""
    rng = random.Random(seed)
    words = [f"w{int(rng.expovariate(0.15))}" for _ in range(300)] + ["Ä", "é9", "THE", "the", "x"] * 20
    docs = [(rng.choice([k, k, 1000 - k]), t) for k, t in enumerate(texts(rng, 400, words, 40))]
    docs += [(k, "the the x") for k in range(300, 320)] + [(None, "the x"), (None, None), (7, "the x"), (7, "the x")]
    items = list(enumerate(texts(rng, 25, words, 12))) + [(None, "the"), (1, "the THE x"), (1, "the THE x"), (2, None)]
    segments = stored(lexical.index_segments(spark.createDataFrame(docs, DOCS).repartition(3),
                                             segment_terms=segment_terms), "test")
    totals = segments.agg({"n_docs": "sum", "n_terms": "sum"}).first()
    got = rows(lexical.search(segments, spark.createDataFrame(items, ITEMS), 10, query_bytes=200, window=window))
    assert got == naive(docs, items, 10)
    assert totals["sum(n_docs)"] == sum(bool(split(t)) for _, t in docs)
    assert totals["sum(n_terms)"] == sum(len(split(t)) for _, t in docs)


def segment_of(docs, number=0):
    terms, codes, lengths, ids = {}, [], [], []
    for doc_id, words in docs:
        codes += [terms.setdefault(w.encode(), len(terms)) for w in words]
        lengths.append(len(words))
        ids.append(doc_id)
    return lexical.segment_row(number, ids, np.array(lengths), np.array(codes), list(terms))


@pytest.mark.parametrize("seed", range(4))
def test_pruning_keeps_the_best(monkeypatch, seed):
    """Small blocks and windows in this process: the heap after pruning equals the sorted scores of all documents, and
    blocks of lists that are not essential stay compressed."""
    monkeypatch.setattr(lexical, "BLOCK", 4)
    rng = random.Random(seed)
    words = ["the"] * 60 + ["of"] * 30 + [f"w{k}" for k in range(40)]
    docs = [(k, rng.choices(words, k=rng.randint(1, 30))) for k in range(600)]
    n_docs, n_terms = len(docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    weights = {t.encode(): math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in ("the", "of", "w1", "w2", "none")}
    heap, opened, blocks = lexical.Heap(5), 0, 0
    for lo in range(0, 600, 200):
        segment = lexical.Segment(segment_of(docs[lo:lo + 200]), n_docs, n_terms)
        lexical.search_segment(segment, weights, heap, 16)
        opened += len(segment.open)
        blocks += sum(segment.lists[t].blocks for t in weights if segment.lists[t])
    scores = []
    for doc_id, w in docs:
        c, m = Counter(w), 50 + 50 * len(w) * n_docs // n_terms
        s = sum(weights[t.encode()] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ("the", "of", "w1", "w2") if t in c)
        scores.append((-s, doc_id))
    assert [(-s, d) for s, d in zip(heap.scores.tolist(), heap.ids.tolist())] == sorted(scores)[:5]
    assert opened < blocks


def test_segment_round_trip_and_bounds(monkeypatch):
    rng = random.Random(5)
    docs = [(k, rng.choices(["a", "b", "c", "d", "rare%d" % k], weights=[50, 20, 5, 1, 1], k=rng.randint(1, 700))) for k in range(700)]
    n_docs, n_terms = 10**6, 10**9
    segment = lexical.Segment(segment_of(docs), n_docs, n_terms)
    for t in ("a", "b", "c", "d", "rare3"):
        p = segment.posting_list(t.encode())
        have = [(k, Counter(w)[t]) for k, (_, w) in enumerate(docs) if t in w]
        if not have:
            assert p is None
            continue
        at, parts = p.between(0, len(docs))
        want = [10**9 * tf // (1000 * tf + 20 * (50 + 50 * len(docs[k][1]) * n_docs // n_terms)) for k, tf in have]
        assert at.tolist() == [k for k, _ in have] and parts.tolist() == want
        for b in range(p.blocks):
            assert max(want[b * lexical.BLOCK:(b + 1) * lexical.BLOCK]) <= p.maxima[b]
        some = np.array(sorted(rng.sample(range(len(docs)), 50)))
        blocks = np.searchsorted(p.lasts, some)
        inside = blocks < p.blocks
        assert p.of(some[inside], blocks[inside]).tolist() == [dict(zip(at.tolist(), want)).get(k, 0) for k in some[inside].tolist()]
    assert lexical.norms(np.array([2**31]), 10**12, 10**13).tolist() == [50 + 50 * 2**31 * 10**12 // 10**13]


def test_degenerate_tables(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (4, "w " * 60_000), (5, "word")]
    items = [(1, "W"), (2, ""), (3, None), (4, "absent")]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert rows(lexical.ranked_search(d, i)) == naive(docs, items)
    assert rows(lexical.ranked_search(d.limit(0), i)) == []
    assert rows(lexical.ranked_search(d, i.limit(0))) == []
    clash = spark.createDataFrame([(1, "one word", 3, "x", 5)], "doc_id long, text string, score int, segment string, id int")
    named = spark.createDataFrame([("q", "word", 1)], "item_id string, text string, block int")
    assert rows(lexical.ranked_search(clash, named)) == naive([(1, "one word")], [("q", "word")])
