"""The corpus pipeline against its definition in plain Python, stage by stage."""

import zlib

import numpy as np
import pytest
import zstandard

import corpus_pipeline
from giniflow.llm import pii, quality_rules, tokens
from giniflow.llm.common import read_table
from test_jaccard import naive
from test_winnow import naive_report

SF = "/root/testdata/sf0.001"


def expected(docs, benchmark):
    """Texts by id after four stages."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    kept = {}
    for doc_id, text in docs.items():
        p = quality_rules.profile(text, quality_rules.Bands(), squeeze)
        if p[0] >= 50 and 100 * p[4] <= 50 * p[0] and p[-1]:
            kept[doc_id] = text
    rows = sorted(kept.items())
    kept = {d: kept[d] for d, _, c in naive(rows, 5, 80) if c == d}
    kept = {r[0]: kept[r[0]] for r in naive_report(kept.items(), benchmark) if not r[-1]}
    return {d: pii.redacted(t) for d, t in kept.items()}


@pytest.fixture(scope="module")
def stages(spark):
    docs = read_table(spark, SF, "documents")
    out = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).persist()
        out.append(docs)
    return out


def test_stages_match_brute_force(spark, stages):
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    benchmark = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    want = expected(docs, benchmark)
    assert {r.doc_id: r.text for r in stages[-1].collect()} == want
    sizes = [s.count() for s in stages]
    assert len(docs) > sizes[0] > sizes[1] > sizes[2] == sizes[3]
    columns = read_table(spark, SF, "documents").columns
    assert all(s.columns == columns for s in stages)
    assert all(r.n_chars == len(r.text) for r in stages[-1].collect())


def test_run_packs_what_is_left(spark, stages):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokens.tokenizer_path(tokens.TOKENIZER))
    left = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 0] for r in stages[-1].collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == left.keys()
    assert sum(r.length for r in rows) == sum(map(len, left.values()))
    for r in rows:
        ids = np.array(left[r.doc_id][r.start:r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32


def test_stages_take_odd_tables(spark):
    """Nulls, empty texts, repeated rows, clashing extra columns and empty tables in every stage."""
    text = read_table(spark, SF, "documents").orderBy("n_chars", ascending=False).first().text
    rows = [(1, None, "en", "s", None), (2, "", None, "s", 0), (None, text, "en", None, 5), (3, text, "en", "s", 1),
            (3, text, "en", "s", 1), (3, "other " + text, "en", "s", 1), (4, "short", "en", "s", 5)]
    docs = spark.createDataFrame([(*r, "x", 1, b"n") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string, "
                                 "n int, node binary")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            if name != "packing":
                assert out.columns == docs.columns
            if name == "near_copies" and table is docs:
                assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 4]
            else:
                out.collect()
