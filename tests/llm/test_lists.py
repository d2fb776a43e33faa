"""Pairs across components of candidate lists: none that share a list is lost, whatever the cells; a near-copy group whose
outer members link with each other only, against all pairs compared."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from giniflow.llm import jaccard, lists


@pytest.mark.parametrize("seed,cell", [(0, 1000), (1, 3), (2, 1)])
def test_every_pair_across_components(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(lists, "CELL", cell)
    rng = random.Random(seed)
    members = sorted({(rng.randrange(12), rng.randrange(60)) for _ in range(260)})
    root = {n: (0 if n < 25 else 25 if n < 32 else n) for n in range(60)}
    linked = [(n, r) for n, r in root.items() if sum(x == r for x in root.values()) > 1]
    sketch = [(n, n) for n in range(60)]
    got = lists.across(spark.createDataFrame(members, "sig long, node long"), spark.createDataFrame(linked, "node long, root long"),
                       spark.createDataFrame(sketch, "node long, n int"), lambda x, y: F.lit(True))
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and all(a < b and root[a] != root[b] for a, b in got)
    share = {(a, b) for s in range(12) for a, b in combinations(sorted(n for x, n in members if x == s), 2) if root[a] != root[b]}
    assert share <= set(got)
    # what is more is an outside node with the component it was compared with as a whole
    assert all(root[a] in (0, 25) or root[b] in (0, 25) for a, b in set(got) - share)


def test_conditions_hold_inside_the_join(spark):
    members = spark.createDataFrame([(1, n, n) for n in range(10)], "sig long, node long, pos int")
    roots = spark.createDataFrame([(n, 0) for n in range(4)], "node long, root long")
    sketches = spark.createDataFrame([(n, n % 3) for n in range(10)], "node long, n int")
    got = lists.across(members, roots, sketches, lambda x, y: F.col(f"{x}n") == F.col(f"{y}n")).collect()
    assert {tuple(r) for r in got} == {(a, b) for a, b in combinations(range(10), 2) if a % 3 == b % 3 and b > 3}
    none = lists.across(members.where("node < 4"), roots, sketches, lambda x, y: F.lit(True))
    assert none.collect() == []


@pytest.mark.parametrize("cell", [5, 1000])
def test_near_copies_around_one_text(spark, monkeypatch, cell):
    """Copies with few changes link with the original; those with many do not, but some of them with each other."""
    monkeypatch.setattr(lists, "CELL", cell)
    rng = random.Random(9)
    words = [f"v{k}" for k in range(4000)]
    base = rng.choices(words, k=120)
    docs = []
    for k in range(150):
        copy = list(base)
        for i in rng.sample(range(120) if k % 3 else range(40), rng.choice([1, 2, 5, 7])):
            copy[i] = rng.choice(words) + "x"
        docs.append((k, " ".join(copy)))
        if k % 10 == 0:
            copy[rng.randrange(120)] = "changed"
            docs.append((1000 + k, " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    grams = {d: {tuple(t.split()[i:i + 5]) for i in range(116)} for d, t in docs}
    least = {d: d for d in grams}

    def find(d):
        while least[d] != d:
            d = least[d]
        return d

    for a, b in combinations(sorted(grams), 2):
        if 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]):
            x, y = sorted((find(a), find(b)))
            least[y] = x
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(frame, 5, 80).collect()}
    assert got == {d: find(d) for d in grams}
    assert len(set(got.values())) > 5
