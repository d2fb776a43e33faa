"""Phrase collocations against direct counting, on the query's table and on small random texts; degenerate inputs."""

import random
import re
from collections import Counter
from itertools import groupby

import pytest

from giniflow.llm import collocations
from giniflow.llm.collocations import phrase_collocations
from giniflow.llm.common import LOWER, UPPER, read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLE = str.maketrans(UPPER, LOWER)
SCHEMA = "doc_id long, text string, lang string"


def naive(docs, min_count=30, longest=4, most=2000, inside=80):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(TABLE)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    covered = set()
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * a >= inside * f[lang, p[i:i + m]]:
                    covered.add((lang, p[i:i + m]))
    rows = []
    for (lang, p), a in cand.items():
        if (lang, p) not in covered:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            rows.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    rows.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    return [(lang, i, *r[1:]) for lang, group in groupby(rows, key=lambda r: r[0])
            for i, r in enumerate(list(group)[:most], 1)]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_query_matches_direct_counts(spark):
    docs = [(r.text, r.lang) for r in read_table(spark, SF, "documents").collect()]
    assert rows(QUERIES["op11_phrase_collocations"](spark, SF)) == naive(docs)


@pytest.mark.parametrize("seed,chunk_words", [(0, 50), (1, 400), (2, 1_000_000)])
def test_random_texts(spark, seed, chunk_words):
    """Few words, so that long phrases are frequent and many scores tie; small chunks, so that groups meet across them."""
    rng = random.Random(seed)
    words = ["a", "B", "b", "é", "d-d", "x\x1cy", "zz"]
    docs = [(k, "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "de", None])) for k in range(80)]
    docs += docs[:10]
    got = rows(phrase_collocations(spark.createDataFrame(docs, SCHEMA).repartition(3), 3, 4, 25, chunk_words=chunk_words,
                                   part_words=max(100, chunk_words // 10)))
    want = naive([d[1:] for d in docs], 3, 4, 25)
    assert got == want
    assert {len(r[2].split()) for r in want} == {2, 3, 4}


def test_phrase_inside_a_longer_one_goes(spark):
    docs = [(k, "one two three four.", "en") for k in range(40)] + [(99, "two three. " * 20, "en")]
    got = {r[2]: r for r in rows(phrase_collocations(spark.createDataFrame(docs, SCHEMA)))}
    assert set(got) == {"one two three four", "two three"}  # 40 of 60 occurrences of "two three" are inside
    assert got["one two three four"][3:] == (40, 40, 40, 200, 1_000_000)


def test_phrases_do_not_cross_pieces_or_texts(spark):
    docs = [(k, "left, right", "en") for k in range(50)] + [(k, "alone", "en") for k in range(50)]
    assert rows(phrase_collocations(spark.createDataFrame(docs, SCHEMA))) == []


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(phrase_collocations(empty)) == []
    docs = [(None, None, None), (1, "", "en"), (2, " \t ", None), (2, "...\n", "de"), (3, "w" * 50_000, "en")]
    assert rows(phrase_collocations(spark.createDataFrame(docs, SCHEMA))) == []
    clash = [(1, "go on " * 30, None, 5, "x", 7, 1)]
    frame = spark.createDataFrame(clash, "doc_id long, text string, lang string, chunk int, phrase string, n int, a int")
    assert rows(phrase_collocations(frame)) == naive([("go on " * 30, None)])


def test_big_counts_stay_exact(spark):
    """Products pass 64 bits."""
    big = 4_611_686_018_427_387_903
    row = spark.createDataFrame([(big, big, big), (big // 7, big, big // 3)], "a long, l long, r long")
    got = [r.score for r in row.select(collocations.score_of("a", "l", "r").alias("score")).collect()]
    assert got == [2_000_000 * big // (2 * big), 2_000_000 * (big // 7) // (big + big // 3)]


def test_packed_columns_round_trip():
    import numpy as np
    columns = [np.array([0, 1, 5, 6, 7, 900_000]), np.array([2, 0, 1, 1, 0, 2]), np.array([7, 1 << 40, -9]), np.zeros(0, np.int64)]
    assert [x.tolist() for x in collocations._unpack(collocations._pack(*columns))] == [x.tolist() for x in columns]
    slots, codes, ids = columns[0], columns[1], np.array([7, 9, 1 << 40])
    assert collocations._meetings(slots, codes, ids)[0].tolist() == [0, 5, 6]
    assert list(zip(*(x.tolist() for x in collocations._adjacent(slots, codes, ids)))) == \
        [(9, 7, 1), (9, 9, 1), (1 << 40, 7, 1)]
