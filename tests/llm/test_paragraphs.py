"""Paragraph MinHash against all pairs of paragraphs compared, planted copies, degenerate inputs."""

import random

import pytest

from giniflow.llm import paragraphs
from giniflow.llm.common import read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def naive(docs, least=25, width=5, percent=80):
    """(doc_id, paragraph, start, removed) of the repeated paragraphs; ``docs``: distinct ids."""
    found = []
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        at = 0
        for k, line in enumerate((text or "").split("\n")):
            words = line.encode().lower().split()
            if len(words) >= least:
                found.append((doc_id, k, at, {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}))
            at += len(line) + 1
    root = list(range(len(found)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(found)):
        for j in range(i):
            a, b = found[i][3], found[j][3]
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    sizes = {}
    for i in range(len(found)):
        sizes[find(i)] = sizes.get(find(i), 0) + 1
    return sorted((d, k, at, find(i) != i) for i, (d, k, at, _) in enumerate(found) if sizes[find(i)] > 1)


def rows(df):
    return sorted((r.doc_id, r.paragraph, r.start, r.removed) for r in df.collect())


def test_query_matches_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    want = naive(docs)
    assert any(r[-1] for r in want)
    got = rows(QUERIES["op8_paragraph_minhash"](spark, SF).where("unit = 'line'"))
    assert len(set(want) - set(got)) <= 0.005 * len(want) and not {r[:3] for r in got} - {r[:3] for r in want}


def test_planted_passages_and_their_clouds(spark):
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(5000)]
    passages = [rng.choices(vocabulary, k=rng.randrange(51, 120)) for _ in range(12)]
    docs, planted = [], set()
    for k in range(240):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randrange(5, 90))) for _ in range(3)]
        if k % 3 == 0:
            copy = list(passages[k % 2 or k % 5])
            for _ in range(rng.randrange(2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            lines.insert(rng.randrange(4), " ".join(copy).upper() if k % 4 else " ".join(copy))
            planted.add(k)
        docs.append((k, "\n".join(lines)))
    got = rows(paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == naive(docs)
    assert {r[0] for r in got} == planted


def test_bands_reach_the_recall():
    for similarity in (0.8, 0.9):
        bands, size = paragraphs.tune_bands(similarity, 0.999)
        assert 1 - (1 - similarity ** size) ** bands >= 0.999 and bands * size <= 32


def test_degenerate_inputs(spark):
    long = " ".join(f"w{k}" for k in range(30))
    docs = [(1, None), (2, ""), (3, "\n\n"), (None, long), (4, long), (4, long), (5, "a " * 60_000), (6, long + "\n" + long)]
    df = spark.createDataFrame([(*d, "k", 1, b"n") for d in docs], "doc_id long, text string, key string, row int, node binary")
    got = paragraphs.repeated_paragraphs(df).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "4", "6", "6", "None"]
    assert sum(not r.removed for r in got) == 1
    assert paragraphs.repeated_paragraphs(df.limit(0)).collect() == []
