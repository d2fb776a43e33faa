"""Merge-type encoding and decoding against the sentencepiece library, digests against the definition."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from giniflow.llm import pieces
from giniflow.llm.common import read_table
from giniflow.llm.queries import QUERIES
from giniflow.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
EDGE = ["", " ", "  a  b ", "a\nb", "▁x", "▁▁ ▁", "ﬁ Å", "a\x00b", "\x00\x00", "\x00\x01 \x00", "<s> </s> <unk> <0x0A>",
        " " * 1000 + "x", "x" * 5000, "日本語 " * 50, "\U0001f600a", "á", "�", "\t\ta", "1234567890" * 5,
        *(" " * k + "日" for k in range(36)), *(" " * k + "the" for k in range(36))]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))


@pytest.fixture(scope="module")
def table():
    return pieces.prefix_table(tokenizer_path(pieces.MODEL))


def check(table, library, texts):
    want = [library.encode(t, add_eos=True, num_threads=1) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in table.encode_many(texts)] == want
    got = table.decode_many(pa.array(want, pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(x) for x in want]


def test_edge_texts(table, library):
    check(table, library, EDGE)


@given(st.lists(st.text(max_size=60), min_size=1, max_size=20))
@settings(max_examples=200, deadline=None)
def test_any_text(table, library, texts):
    check(table, library, texts)


@pytest.mark.parametrize("alphabet", ["aeintsr", "ab ", "thine. ,", "éèñaos", "0123 ", "=-_/*#<> ", "àβ日ж\U0001f600 a"])
def test_random_strings(table, library, alphabet):
    rng = random.Random(1)
    check(table, library, ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(2000)])


def test_strings_of_pieces(table, library):
    rng = random.Random(2)
    names = [p.replace("▁", " ") for p in table.ids]
    check(table, library, ["".join(rng.choices(names, k=rng.randint(1, 8))) for _ in range(5000)])


def test_each_prefix_has_the_last_token_of_its_encoding(table):
    rng = random.Random(3)
    for _ in range(300):
        part = "▁" + "".join(rng.choices("aeinthsrgo", k=rng.randint(1, 25)))
        last = table.last_tokens(part)
        assert [table.pieces[t] for t in last[1:]] == [table.merged([*part[:k]])[-1] for k in range(1, len(part) + 1)]


def test_full_caches_change_nothing(table, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_SIZE", 3)
    monkeypatch.setattr(pieces, "KEPT", 2)
    monkeypatch.setattr(pieces, "PAIRS", 2)
    for t in EDGE:
        check(table, library, [t, t + " more words here"])


def test_decoding_of_any_ids(table, library):
    """Half characters and control pieces, which no encoding gives."""
    for ids in [[3 + 0xE6, 3 + 0x97], [3 + 0xE6, 28705, 3 + 0xA5], [1, 264, 2], [3 + 0xFF, 3 + 0xFF, 264], [], [2], [259, 259]]:
        assert table.decode_many(pa.array([ids], pa.list_(pa.int32()))).to_pylist() == [library.decode(ids)]
    with pytest.raises(ValueError):
        table.decode_many(pa.array([[32000]], pa.list_(pa.int32())))


def expected(library, doc_id, text):
    ids = library.encode(text or "", add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def test_query_matches_the_library(spark, library):
    want = [expected(library, r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, QUERIES["op12_piece_codec"](spark, SF).collect())) == sorted(want)


def test_degenerate_tables(spark, library):
    docs = [(k, t, t, 1, "x") for k, t in enumerate(EDGE)] + [(None, None, None, 2, "y"), (0, "same", "s", 3, None),
                                                             (0, "same", "s", 3, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, ids string, n_tokens int, decoded string")
    out = pieces.encode_documents(frame)
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = sorted(map(tuple, pieces.digests(out).collect()), key=str)
    assert got == sorted([expected(library, d[0], d[1]) for d in docs], key=str)
    empty = pieces.digests(pieces.encode_documents(frame.limit(0)))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    none = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids")).select(pieces.decode_pieces(F.col("ids")).alias("t"))
    assert none.collect()[0].t is None
