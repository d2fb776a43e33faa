"""Winnowing against every window compared directly, planted spans, degenerate inputs."""

import hashlib
import random
import re

import pytest

from giniflow.llm import winnow
from giniflow.llm.common import LOWER, UPPER, read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLE = str.maketrans(UPPER, LOWER)


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TABLE))


def naive_report(docs, items, span=10):
    windows = {}
    for item_id, text in items:
        w = split(text)
        n = min(len(w), span)
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = split(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    bool(hit)))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    want = naive_report(docs, items)
    assert any(r[-1] for r in want)
    assert rows(QUERIES["op7_winnowing"](spark, SF)) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_with_few_words(spark, seed):
    """Few words make equal hashes inside a window and overlapping spans common."""
    rng = random.Random(seed)
    text = lambda n, v: " ".join(rng.choice("abcdefgh"[:v]) for _ in range(n))
    items = [(k, text(rng.choice([3, 9, 10, 11, 30]), rng.choice([2, 4]))) for k in range(12)]
    docs = []
    for k in range(60):
        own = text(rng.choice([0, 4, 9, 10, 40]), 8)
        w = split(rng.choice(items)[1])
        a = rng.randrange(len(w))
        docs.append((k, f"{own} {' '.join(w[a:a + rng.randrange(3, 20)])} {text(5, 8)}"))
    got = winnow.contamination_report(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == sorted(naive_report(docs, items), key=str)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    want = rows(QUERIES["op7_winnowing"](spark, SF))
    monkeypatch.setattr(winnow, "BROADCAST_BYTES", -1)
    assert rows(QUERIES["op7_winnowing"](spark, SF)) == want


def test_degenerate_inputs(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, "..."), (None, "Short Item"),
             (4, "short item"), (4, "short item")]
    passage = "ONE two, three four FIVE six seven eight nine ten!"
    docs = [(1, None), (2, ""), (None, passage), (3, passage), (3, passage), (3, "other text"), (4, "a short item here"),
            (5, "É" + passage), (6, "x " * 40_000 + passage)]
    schema = "doc_id long, text string, key string, pos int, spans string"
    df = spark.createDataFrame([(*d, "k", 1, "s") for d in docs], schema)
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, hash int")
    assert rows(winnow.contamination_report(df, bench)) == sorted(naive_report(docs, items), key=str)
    kept = winnow.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect())) == sorted(
        d for (d, _), r in zip(docs, naive_report(docs, items), strict=True) if not r[-1])
    assert winnow.contamination_report(df.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in winnow.contamination_report(df, bench.limit(0)).collect())


def test_main_path_has_no_python(spark):
    plan = QUERIES["op7_winnowing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
