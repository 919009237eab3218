"""The corpus pipeline stage by stage against plain Python, and as a whole."""

import os
import re

import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from hazegrid.llm import bpe, leaks, personal, queries
from test_leaks import least_distance, tokens
from test_ngram_join import expected

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near copies", "benchmark leaks", "personal data", "byte-level BPE"]
    assert all(df.columns == COLUMNS for df in stages[:-1])
    assert all(a.schema == b.schema for a, b in zip(stages[:-2], stages[1:-1], strict=True))


def test_languages(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {d: t for d, t in before.items() if t and any(c.isalpha() for c in t)}


def test_one_of_each_group(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert after == {d: before[d] for d, _, c in expected(list(before.items())) if d == c}
    assert len(after) < len(before)


def test_leaks(stages, spark):
    before, after = texts(stages[2]), texts(stages[3])
    items = [tokens(r.text) for r in queries.table(spark, SF, "benchmark").collect()]

    def leaks_into(text):
        own = tokens(text)
        return any(len(set(i) & set(own)) >= 0.5 * len(set(i)) and least_distance(i, own) <= int(leaks.SHARE * len(i)) for i in items)

    assert after == {d: t for d, t in before.items() if not leaks_into(t)}
    assert len(after) < len(before)


def test_redacted(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    for d, t in before.items():
        spans = personal.base(t)
        if spans:
            assert not personal.base(after[d])
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", after[d])
    assert {r.doc_id: r.n_chars for r in stages[4].collect()} == {d: len(t) for d, t in after.items()}


def test_encoded(stages):
    encoding = bpe._encoding(bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)), public_tokenizers.PATTERN)
    before = texts(stages[4])
    rows = stages[5].collect()
    assert len(rows) == len(before)
    for r in rows:
        assert r.ids == encoding.encode_ordinary(before[r.doc_id]) and r.n_tokens == len(r.ids)


def test_run_is_the_stages(spark, stages):
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.columns == stages[-1].columns
    assert sorted(map(str, out.collect())) == sorted(map(str, stages[-1].collect()))


def test_run_leaves_only_the_last_stage_in_the_shared_folder(spark):
    from hazegrid.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    out = corpus_pipeline.run(spark, SF)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark))) - before}
    # The first stage's table has a name that a sample of its own has as well.
    assert "byte-level-BPE" in left and not left & {n.replace(" ", "-") for n, _ in corpus_pipeline.STAGES[1:-1]}
    assert out.count() > 0


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "the of and to in", None, None, None, "x"), (1, "the of and to in", None, None, None, "x"), (2, None, "en", "s", 0, None),
            (3, "", "en", "s", 0, "y"), (None, "un deux trois quatre", "fr", None, 20, "z"), (5, "12 34", "en", "s", 5, "y"),
            (6, "the thing, mail a@b.co", "en", "s", 22, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string")
    for table in (docs, docs.limit(0)):
        df = table
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        kept = sorted(((r.doc_id or 0), r.n_tokens) for r in df.collect())
        assert [d for d, _ in kept] == ([0, 1, 6] if table is docs else [])


def test_copies_under_repeated_and_null_ids_go(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [(1, one), (5, one), (5, two), (5, two), (None, three), (None, three + " z"), (7, three), (8, None), (8, ""), (9, None)]
    docs = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, id string")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()]
    assert (1, one) in kept and (5, one) not in kept and kept.count((5, two)) == 1
    assert sum(t is not None and t.startswith("c0") for _, t in kept) == 1 and {(8, None), (8, ""), (9, None)} <= set(kept)


def test_shared_folder_is_the_sessions(spark):
    from hazegrid.session import shared_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark)) and (named or os.path.isdir(shared_dir(spark)))


def test_near_copies_share_four_fifths_of_their_five_word_shingles(spark):
    """Brute force at 5 words and 80 percent, with copies that are less alike on 4-word shingles than op6 asks for."""
    own = [f"w{k}" for k in range(100)]
    changed = lambda *at: " ".join("x" + w if k in at else w for k, w in enumerate(own))
    rows = [(1, changed()), (2, changed(30, 70)), (3, changed(20, 50, 80)), (4, "one two three four five six"), (5, "one two three four five seven")]

    def shingles(text):
        w = text.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    kept = []
    for d, t in rows:
        if not any(len(shingles(t) & shingles(u)) >= 0.8 * len(shingles(t) | shingles(u)) for c, u in rows if c < d):
            kept.append(d)
    assert kept == [1, 3, 4, 5]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()) == kept
