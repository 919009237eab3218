"""BPE ids against the library on whole texts, round trips, and counts against the library's unigram model."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hazegrid.llm import bpe, queries, unigram

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.RANKS)
PATTERN = public_tokenizers.PATTERN
ENCODING = bpe._encoding(bpe.read_ranks(PATH), PATTERN)
COUNTER = unigram.Counter(tuple(unigram.read_vocabulary(public_tokenizers.path(queries.VOCABULARY))))

TEXTS = [None, "", " ", "a", "\n\n", "it's 12 o'clock  ok\t", "</s><|endoftext|>", "日本語 — \U0001f600", "x   y",
         "a" * 3000, " word's" * 30, "same", "same"]


def test_pieces_do_not_change_ids(monkeypatch):
    texts = ["ab 1é\n's  \t x " * 300, "word " * 999, " \n" * 800 + "x", "y" + " " * 5000, "a" + "\n" * 2000 + " b", "q" * 5000]
    whole = [ENCODING.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe, "PIECE", 7)
    assert [bpe.encode_text(ENCODING, t) for t in texts] == whole


def test_very_long_runs():
    for text in (" " * 300_000 + "x", "a" + "\t" * 300_000, "b" * 300_000):
        ids = bpe.encode_text(ENCODING, text)
        assert ENCODING.decode_bytes(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab's \n\t é1#"), max_size=60))
def test_cuts_anywhere(text):
    before = bpe.PIECE, bpe.RUN, bpe._LONG
    import re
    try:
        bpe.PIECE, bpe.RUN, bpe._LONG = 3, 2, re.compile(f"[{bpe._WHITE}]{{3,}}")
        assert bpe.encode_text(ENCODING, text) == ENCODING.encode_ordinary(text)
    finally:
        bpe.PIECE, bpe.RUN, bpe._LONG = before


def test_columns_rows_and_clashes(spark):
    rows = [(i, t, [7], "kept") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, bytes string")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "bytes"]
    for r in out.collect():
        assert r.ids == (ENCODING.encode_ordinary(r.text) if r.text else [])
        assert bytes(r.bytes) == (r.text or "").encode()
    assert bpe.encode(df.limit(0), PATH, PATTERN).count() == 0


def test_query_matches_the_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op2_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer, models, pre_tokenizers
    t = Tokenizer(models.Unigram(unigram.read_vocabulary(public_tokenizers.path(queries.VOCABULARY)), unk_id=0))
    t.pre_tokenizer = pre_tokenizers.Metaspace()
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_counts_match_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op8_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {d: library(t) for d, t in texts.items()}
    for text in TEXTS + ["  two  spaces ", "<unk> <s> <0x0A>", "▁a▁", "\n\n\x00\x01 ", "\U0001f600" * 5]:
        assert COUNTER.count(text) == (library(text) if text else 0), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("theouning aé\n▁<unk>"), max_size=40))
def test_ties_and_unknowns(text):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = [("<unk>", 0.0), ("t", -1.0), ("h", -1.0), ("e", -1.0), ("th", -2.0), ("he", -2.0), ("the", -3.0), ("▁", -1.0),
                  ("o", -2.0), ("ou", -2.0), ("▁t", -2.0), ("n", -1.0), ("in", -3.0), ("ing", -3.5), ("g", -0.5)]
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0))
    t.pre_tokenizer = pre_tokenizers.Metaspace()
    expected = len(t.encode(text, add_special_tokens=False).ids) if text else 0
    assert unigram.Counter(tuple(vocabulary)).count(text) == expected


def test_counts_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5), (2, None, 6)], "id long, text string, n_tokens long")
    out = unigram.count_tokens(df, public_tokenizers.path(queries.VOCABULARY))
    assert out.columns == ["id", "text", "n_tokens"]
    assert {r.id: r.n_tokens for r in out.collect()} == {1: 2, 2: 0}
