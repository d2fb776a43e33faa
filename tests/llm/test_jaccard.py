"""Jaccard join against all pairs compared, with copies, clouds of near copies, shared passages, degenerate inputs."""

import random

import pytest

from giniflow.llm import common, jaccard, lists, packing, winnow
from giniflow.llm import components as components_module
from giniflow.llm.common import read_table
from giniflow.llm.components import components
from giniflow.llm.queries import QUERIES
from test_winnow import naive_report

SF = "/root/testdata/sf0.001"


def naive(docs, width=3, percent=90):
    sets = []
    for _, text in docs:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    want = naive(docs)
    assert any(c != d for d, _, c in want)
    assert rows(QUERIES["op2_jaccard_join"](spark, SF)) == want


def corpus(seed):
    """Copies, chains and clouds around bases, one line in every third text, lengths from 3 to 400 words."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    line = rng.sample(vocabulary, 9)
    docs = []
    for n in (3, 9, 11, 12, 30, 60, 150, 400):
        for _ in range(2):
            base = rng.choices(vocabulary, k=n)
            for k in range(14):
                now = list(base)
                for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
                    now[rng.randrange(n)] = rng.choice(vocabulary)
                if k % 5 == 4:
                    base = now  # a chain
                docs.append(" ".join(now))
    for n in (10, 40, 90):
        docs += [" ".join(line + rng.choices(vocabulary, k=n)) for _ in range(25)]
    rng.shuffle(docs)
    return [(1000 - k, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize("rare, head", [(20, 64), (2, 4), (5, 16)])
def test_clouds_chains_and_shared_lines(spark, monkeypatch, rare, head):
    monkeypatch.setattr(jaccard, "RARE", rare)
    monkeypatch.setattr(jaccard, "LEAST_HEAD", head)
    docs = corpus(rare)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard.jaccard_components(df)) == naive(docs)


def test_other_width_and_similarity(spark):
    docs = corpus(7)[:250]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard.jaccard_components(df, width=2, percent=80)) == naive(docs, 2, 80)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_NODES", -1)
    monkeypatch.setattr(jaccard, "RARE", 3)
    docs = corpus(3)[:200]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard.jaccard_components(df)) == naive(docs)


def test_degenerate_inputs(spark):
    long = " ".join(f"x{k}" for k in range(40_000))
    docs = [(5, None), (6, ""), (7, " \n"), (8, "One two"), (9, "one  TWO"), (None, "one two"), (None, "alone here"),
            (3, "same row"), (3, "same row"), (11, long), (12, long + " y"), (13, "É a"), (14, "é a"), (15, "a"), (16, "a a")]
    df = spark.createDataFrame([(*d, "k", b"n") for d in docs], "doc_id long, text string, key string, node binary")
    assert rows(jaccard.jaccard_components(df)) == naive(docs)
    assert jaccard.jaccard_components(df.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(500, 500), (7, 0), (0, 7)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 0 for k in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_files_follow_the_rows_not_the_shuffle_partitions(spark, monkeypatch):
    """Every stored file is a ``chmod`` of the executor on a local folder: few rows need few files, however many shuffle
    partitions there are. Lists of pairs and their pivots are joined by an exchange each, which Spark can split."""
    files = {}

    def counted(df, name, *a, **b):
        out = common.stored(df, name, *a, **b)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    for module in (jaccard, components_module, lists, winnow, packing):
        monkeypatch.setattr(module, "stored", counted)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(40)]
    docs = []
    for k in range(120):  # one large group of near copies, whose tokens are all frequent
        words = base * 3
        words[rng.randrange(120)] = f"x{k % 30}"
        docs.append((k, " ".join(words)))
    docs += [(1000 + k, " ".join(rng.choices(base, k=90))) for k in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(jaccard.jaccard_components(frame, 5, 80))
        item = spark.createDataFrame([("i", docs[0][1])], "item_id string, text string")
        left = winnow.drop_contaminated(frame, item)
        n_left = left.count()
        packed = packing.pack_documents(frame)
        assert packed.rdd.getNumPartitions() == 1 and packed.count() == len(docs)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == naive(docs, 5, 80)
    assert n_left == sum(not r[-1] for r in naive_report(docs, [("i", docs[0][1])]))
    few = {"classes", "frequent", "hot", "dense", "wanted", "sets", "postings", "pivots", "edges", "benchmark-prints"}
    assert few <= set(files)
    assert {k: n for k, n in files.items() if k in few and n > (2 if k == "postings" else 1)} == {}


def test_a_worker_gives_back_what_an_operator_held(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_HELD", {("encoder",): [1]})
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: type("C", (), {"malloc_trim": staticmethod(calls.append)}))
    assert common.held(("encoder",), list) == [1] and calls == []
    assert common.held(("word hashes",), dict) == {} and calls == [0]
    common.release()
    common.release()
    assert common._HELD == {} and calls == [0, 0]
