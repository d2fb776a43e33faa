"""Best-two-fit: a list-based version, exact places, round trip of the ids, degenerate inputs."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from giniflow.llm import packing, tokens
from giniflow.llm.common import read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def naive_bins(lengths, capacity):
    """Best-two-fit over a list: bins one after the other, each item handled by itself."""
    left = sorted(lengths, reverse=True)
    bins = []
    while left:
        bin_, gap = [], capacity
        for x in list(left):
            if x <= gap:
                bin_.append(x)
                left.remove(x)
                gap -= x
        if gap and len(bin_) > 1:
            small, room = bin_[-1], gap + bin_[-1]
            pairs = [(left[i] + left[j], left[i], left[j]) for i in range(len(left)) for j in range(i + 1, len(left))
                     if small < left[i] + left[j] <= room]
            if pairs:
                _, a, b = max(pairs)
                bin_.remove(small)
                left.remove(a)
                left.remove(b)
                left = sorted([*left, small], reverse=True)
                bin_ += [a, b]
        bins.append(sorted(bin_))
    return bins


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_histogram_plan_equals_the_list_version(lengths):
    histogram = defaultdict(int)
    for x in lengths:
        histogram[x] += 1
    plan = packing.plan_bins(histogram, 40)
    got = [sorted(b.elements()) for b, times in plan for _ in range(times)]
    assert sorted(got) == sorted(naive_bins(lengths, 40))


def test_plan_size_does_not_follow_the_number_of_documents():
    rng = np.random.default_rng(3)
    shape = np.round(10_000 * rng.lognormal(0, 1, 2048)).astype(int)
    histogram = {x + 1: int(n) for x, n in enumerate(shape)}
    few, many = (packing.plan_bins({x: n * f for x, n in histogram.items()}) for f in (1, 1000))
    assert len(many) <= len(few) * 1.2
    assert sum(times for _, times in many) == pytest.approx(1000 * sum(t for _, t in few), rel=0.001)
    tokens_all = sum(x * n for x, n in histogram.items())
    assert sum(t for _, t in few) <= tokens_all / 2048 * 1.01 + 1


def assert_gapless(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_places_every_id(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokens.tokenizer_path(tokens.TOKENIZER))
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    total = 0
    docs = read_table(spark, SF, "documents").collect()
    assert len(by) == len(docs)
    for d in docs:
        ids = np.array([*library.encode(d.text, add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        pieces = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert len(pieces) == -(-len(ids) // 2048)
        assert all(r.length == 2048 for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert assert_gapless(rows, 2048) <= -(-total // 2048) + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(k, "one two three " * k) for k in range(30)], "doc_id long, text string")
    pieces = packing.token_pieces(docs, capacity=32)
    packed = packing.pack(pieces, capacity=32)
    rows = packed.collect()
    assert_gapless(rows, 32)
    got = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert got[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_degenerate_inputs(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a", "x"), (7, "same words", "y"), (7, "same words", "y"),
            (8, "long " * 9000, "z")] + [(9, "hot", "h")] * 900
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = packing.pack_documents(docs).collect()
    assert len([r for r in got if r.doc_id != 8]) == len(rows) - 1
    assert [r.length for r in got if r.doc_id in (1, 2)] == [1, 1]
    long = sorted((r for r in got if r.doc_id == 8), key=lambda r: r.piece)
    assert long[0].length <= 2048 and {r.length for r in long[1:]} == {2048}
    assert_gapless(got, 2048)
    assert packing.pack_documents(docs.limit(0)).collect() == []
