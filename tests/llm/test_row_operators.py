"""Operators that judge each text by itself (6, 9, 10): brute force, hand-made cases, degenerate inputs."""

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from giniflow.llm import pii, quality_rules, tokens
from giniflow.llm.common import WORD, read_table
from giniflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

EDGE = [None, "", " ", "a", "a a a a", "\n\n", "x" * 50_000, "wört " * 3000, "1" * 5000, "a1" * 30_000,
        "a  b\n c\t d <|endoftext|> e", "tab\tend  ", " 4012 8888 8888 1881 and 1.2.3.4", "a@b.c@d.e"]


@pytest.fixture(scope="module")
def edge_docs(spark):
    rows = [(k, t, "en", k) for k, t in enumerate(EDGE)] + [(None, "same", "en", 1), (3, "a", "en", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, p long")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.tokenizer_path(tokens.TOKENIZER))





PIECES = [*"ab1'é \n\t\x1c\u00a0\u3000!.<|>", "<|endoftext|>", "  ", "'s", "word", " word,", "!!\n"]
TRICKY = st.lists(st.sampled_from(PIECES), max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(TRICKY)
def test_segments_give_the_ids_of_the_whole_text(text):
    encode = tokens.encoder(tokens.tokenizer_path(tokens.TOKENIZER))
    assert "".join(tokens.segments(text)) == text
    whole = encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert [x.tolist() for x in encode.ids([text, None, text])] == [whole, [], whole]
    assert encode.counts([None, text]) == [0, len(whole)]


def test_token_counts_match_the_library(spark, docs, library):
    got = {r.doc_id: r for r in QUERIES["op10_token_counts"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for k, t in docs.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (n, len(t.encode()), n > 512)


def test_token_counts_of_edge_texts(edge_docs, library):
    got = tokens.token_counts(edge_docs).collect()
    assert len(got) == len(EDGE) + 2
    assert sorted(r.n_tokens for r in got) == sorted(
        len(library.encode(t or "", add_special_tokens=False).ids) for t in [*EDGE, "same", "a"])
    assert tokens.token_counts(edge_docs.limit(0)).collect() == []


def naive_profile(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(hit))


def test_quality_counts_match_brute_force(spark, docs):
    for r in QUERIES["op9_quality_rules"](spark, SF).collect():
        want = naive_profile(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_quality_of_edge_texts(edge_docs):
    for r in quality_rules.quality_report(edge_docs, id_col="p").collect():
        assert r.base_failed and not r.kept
    got = quality_rules.quality_report(edge_docs).collect()
    assert len(got) == len(EDGE) + 2
    by_id = {r.doc_id: r for r in got if r.doc_id != 3}
    for k, t in enumerate(EDGE):
        if k != 3:
            assert tuple(by_id[k])[1:6] == naive_profile(t)
    assert quality_rules.quality_report(edge_docs.limit(0)).collect() == []


def test_bands_reject_repetition_and_noise_and_keep_prose(docs):
    import base64
    import random

    import zstandard
    squeeze = zstandard.ZstdCompressor(level=3).compress
    verdict = lambda t: quality_rules.profile(t, quality_rules.Bands(), squeeze)[-1]
    rng = random.Random(5)
    assert not verdict("the same words again " * 400)
    assert not verdict(base64.b64encode(rng.randbytes(30_000)).decode())
    assert not verdict(" ".join(base64.b64encode(rng.randbytes(6)).decode() for _ in range(3000)))
    prose = max(docs.values(), key=lambda t: len(set(t.split())))
    assert verdict(prose)
    # sound as a whole, but most of its chunks repeat
    assert not verdict(prose[:20_000] + "".join(f"{w} " * 900 for w in ("alpha", "beta", "gamma", "delta")) * 4)


def test_junk_in_the_last_partial_chunk_counts(docs):
    import base64
    import random

    import zstandard
    squeeze = zstandard.ZstdCompressor(level=3).compress
    verdict = lambda t: quality_rules.profile(t, quality_rules.Bands(), squeeze)[-1]
    rng = random.Random(11)
    prose = max((t for t in docs.values() if t.isascii()), key=lambda t: len(set(t.split())))
    for n in (6500, 8186, 8190, 8191, 12_200):  # the last, partial chunk holds 33 to 50 % of the text
        for junk in (base64.b64encode(rng.randbytes(4096)).decode(), "the same phrase comes back " * 200):
            tail = n % 4096
            assert not verdict(prose[:n - tail] + junk[:tail])
    assert all(verdict(prose[:n]) for n in range(4096, 12_300, 97))


def test_kept_rows_keep_their_columns(edge_docs, spark, docs):
    long = max(docs.values(), key=lambda t: len(set(t.split())))
    df = edge_docs.unionByName(spark.createDataFrame([(99, long, "en", 5)], edge_docs.schema))
    got = quality_rules.keep_quality(df)
    assert got.columns == df.columns and [r.doc_id for r in got.collect()] == [99]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def naive_spans(text):
    text = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        odd = digits[-1::-2]
        even = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        if 16 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


PII_TEXT = st.lists(st.sampled_from(list("a0159. +-()@é\n") + ["a.b@c.de", "+1 (555) 010-9999", "10.0.0.255",
                                                                     "4111 1111 1111 1111"]), max_size=50).map("".join)


@settings(max_examples=1500, deadline=None)
@given(PII_TEXT)
def test_base_spans_equal_the_grammar(text):
    assert [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == naive_spans(text)


def test_pii_report_matches_brute_force(spark, docs):
    for r in QUERIES["op6_pii"](spark, SF).collect():
        want = naive_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in want) for k in pii.BASE_KINDS)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans.startswith(text)


def test_pii_of_edge_texts(edge_docs):
    got = pii.pii_report(edge_docs).collect()
    assert len(got) == len(EDGE) + 2
    assert {r.doc_id: r.n_card for r in got}[12] == 1
    assert pii.pii_report(edge_docs.limit(0)).collect() == []


@pytest.mark.parametrize("text, kind, value", [
    ("see https://joe:hunter2@db.example.org/x", "login", "joe:hunter2@db.example.org"),
    ('the token = "373e80f4fc42f278a10f"', "secret", "373e80f4fc42f278a10f"),
    ("PASSWORD=25a0bc4376e17c", "secret", "25a0bc4376e17c"),
    ("IBAN: DE89 3704 0044 0532 0130 00 and so on", "account", "DE89 3704 0044 0532 0130 00"),
    ("SSN 123-45-6789.", "account", "123-45-6789"),
    ("account no. 1234567890, please", "account", "1234567890"),
    ("mail jörg@exämple.de now", "intl_email", "jörg@exämple.de"),
])
def test_added_spans(text, kind, value):
    assert [text[a:b] for k, a, b in pii.find_spans(text) if k == kind] == [value]


@pytest.mark.parametrize("text", ["the secret of the word", "IBAN DE00 3704 0044 0532 0130 00", "SSN 000-12-3456",
                                  "a token ring", "of no account at all"])
def test_cues_alone_are_no_finding(text):
    assert [s for s in pii.find_spans(text) if s[0] in pii.ADDED_KINDS] == []


def test_redaction():
    assert pii.redacted("to a@b.de or +1 (555) 010-9999!") == "to <EMAIL> or <PHONE>!"
    assert pii.redacted(None) is None and pii.redacted("") == ""
