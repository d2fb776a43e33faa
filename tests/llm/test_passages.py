"""Repeated runs of words against all windows compared, passages planted inside and across lines, degenerate inputs."""

import random
from collections import defaultdict

from giniflow.llm import paragraphs, passages
from giniflow.llm.common import read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def naive(docs, span=50):
    """doc_id -> positions (in words) of the windows that occur again; ``docs``: distinct ids."""
    places = defaultdict(list)
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        for i in range(len(words) - span + 1):
            places[tuple(words[i:i + span])].append((doc_id, i))
    out = defaultdict(set)
    for at in places.values():
        first = min(at)
        gone = [p for p in at if p[0] != first[0] or p[1] >= first[1] + span]
        for doc_id, i in (at if gone else []):
            out[doc_id].add((i, (doc_id, i) in gone))
    return out


def windows(rows, docs, span=50):
    """The same of the runs returned, from their places in the texts."""
    texts, out = dict(docs), defaultdict(set)
    for r in rows:
        text = texts[r.doc_id]
        before, inside = text[:r.start].split(), text[r.start:r.end].split()
        assert len(inside) == r.n_words >= span and r.paragraph == text.count("\n", 0, r.start)
        out[r.doc_id] |= {(len(before) + i, r.removed) for i in range(r.n_words - span + 1)}
    return out


def test_query_finds_every_repeated_window(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    rows = QUERIES["op8_paragraph_minhash"](spark, SF).collect()
    runs = [r for r in rows if r.unit == "run"]
    assert windows(runs, docs) == naive(docs)
    lines = paragraphs.repeated_paragraphs(read_table(spark, SF, "documents"))
    assert sorted(r[1:] for r in rows if r.unit == "line") == sorted(map(tuple, lines.collect()))
    assert {r.doc_id for r in runs} - {r.doc_id for r in rows if r.unit == "line"}


def test_passages_inside_and_across_lines(spark):
    rng = random.Random(6)
    vocabulary = [f"v{k}" for k in range(5000)] + ["wörd", "日本語"]
    some = lambda n: rng.choices(vocabulary, k=n)
    inside, across, short = some(50), some(70), some(49)
    docs = []
    for k in range(40):
        words = some(rng.randrange(60, 200))
        line = " ".join([*words, *(inside if k % 4 == 0 else short if k % 4 == 1 else []), *some(80)])
        if k % 4 == 2:
            cut = rng.randrange(20, 50)
            line = " ".join([*words, *across[:cut]]) + " \n" + " ".join([*across[cut:], *some(60)])
        docs.append((k, line.upper() if k % 8 == 0 else line))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = passages.repeated_runs(df).collect()
    found = paragraphs.repeated_units(df).collect()                 # the query's rows: lines that are alike, and these
    assert {r.doc_id for r in found} == {k for k in range(40) if k % 4 in (0, 2)}
    assert sorted(r[1:] for r in found if r.unit == "run") == sorted(map(tuple, got))
    assert {r.doc_id for r in got} == {k for k in range(40) if k % 4 in (0, 2)}
    assert windows(got, docs) == naive(docs)
    texts = dict(docs)
    for r in got:
        assert texts[r.doc_id][r.start:r.end].lower().split() == [w.lower() for w in (inside, across)[r.doc_id % 4 // 2]]
        assert (r.n_occurrences, r.first_doc_id, r.removed) == (10, r.doc_id % 4, r.doc_id > 2)


def test_shared_part_of_an_earlier_text_hides_nothing(spark):
    """A run of 60 words in two texts; 45 of them stand in an earlier one, which shares no window."""
    rng = random.Random(7)
    word = iter(f"{k}-{rng.random()}" for k in range(10_000))
    some = lambda n: [next(word) for _ in range(n)]
    run = some(60)
    docs = [(1, " ".join(some(40) + run[8:53] + some(40))), (2, " ".join(some(30) + run + some(9))),
            (3, " ".join(some(99) + run))]
    got = passages.repeated_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.first_doc_id, r.removed) for r in got) == [(2, 60, 2, False), (3, 60, 2, True)]


def test_degenerate_inputs(spark):
    long = " ".join(f"w{k}" for k in range(60))
    docs = [(1, None), (2, ""), (3, "\n\n"), (None, long), (4, long), (4, long), (5, "a " * 6000), (6, long + "\n" + long),
            (7, "b " * 99)]
    df = spark.createDataFrame([(*d, "k", 1, b"n") for d in docs], "doc_id long, text string, key string, row int, hash binary")
    got = [(r.doc_id, r.paragraph, r.start, r.end, r.n_words, r.removed) for r in passages.repeated_runs(df).collect()]
    n = len(long)
    assert sorted(got, key=str) == sorted([
        (None, 0, 0, n, 60, False), (4, 0, 0, n, 60, True), (4, 0, 0, n, 60, True), (6, 0, 0, n, 60, True),
        (6, 1, n + 1, 2 * n + 1, 60, True), (5, 0, 0, 197, 99, False), (5, 0, 100, 11_999, 5950, True)], key=str)
    assert passages.repeated_runs(df.limit(0)).collect() == []
