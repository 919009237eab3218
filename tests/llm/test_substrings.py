"""Repeats against all windows in plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazegrid.llm import queries, substrings
from hazegrid.llm.words import BLANK, texts, words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, span):
    """(doc_id, text): n_words, n_removed, kept. Rows of one id have one text here."""
    split = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    gone = {d: set() for d in split}
    for d in sorted(split, key=lambda d: (d is not None, d or 0)):
        for i in range(len(split[d]) - span + 1):
            if first.setdefault(tuple(split[d][i:i + span]), (d, i)) != (d, i):
                gone[d].update(range(i, i + span))
    return {d: (len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d])) for d, w in split.items()}


def got(df, **more):
    return [(r.doc_id, (r.repeats.n_words, r.repeats.n_removed, r.repeats.kept)) for r in substrings.without_repeats(df, **more).collect()]


def a_text(rng, letters, n, passages):
    out = []
    while len(out) < n:
        p = rng.random()
        if p < 0.3:
            out += rng.choice(passages)
        elif p < 0.4:
            out += [rng.choice(letters)] * rng.randint(2, 30)
        elif p < 0.5 and out:
            out += out[-rng.randint(1, 40):]
        else:
            out += [rng.choice(letters) for _ in range(rng.randint(1, 30))]
    return out


@pytest.mark.parametrize("letters", [2, 3, 20, 2000])
def test_equal_windows_stand_in_equal_stretches(letters):
    """A window's name and its place beside its symbol follow from its words alone, whatever surrounds it."""
    rng = random.Random(letters)
    alphabet = [f"w{i}" for i in range(letters)]
    for span, rounds in ((20, 4), (20, 6), (5, 3), (2, 2), (8, 1)):
        passages = [[rng.choice(alphabet) for _ in range(rng.randint(5, 60))] for _ in range(3)]
        docs = [a_text(rng, alphabet, rng.choice([1, 10, 50, 300]), passages) for _ in range(40)]
        seen = {}
        for _, data, ends in texts(pa.array([" ".join(d) for d in docs])):
            word, _, bounds = words(data, ends, BLANK[data])
            name, _, start, n = substrings.stretches(word, bounds, span, rounds)
            found = set()
            for k in range(len(name)):
                d = int(np.searchsorted(bounds, start[k], "right") - 1)
                for i in range(int(n[k])):
                    at = int(start[k] - bounds[d]) + i
                    found.add((d, at))
                    assert seen.setdefault(tuple(docs[d][at:at + span]), int(name[k])) == int(name[k])
            assert found == {(d, i) for d, w in enumerate(docs) for i in range(len(w) - span + 1)}


def test_high_symbols_are_found_in_plain_prose():
    """Most windows belong to a symbol, and symbols own many windows: far fewer rows than windows."""
    rng = random.Random(1)
    word = np.array([rng.getrandbits(64) for _ in range(50_000)], np.uint64)
    name, _, _, n = substrings.stretches(word, np.array([0, len(word)]), 20, 4)
    assert n.sum() == len(word) - 19 and len(name) < len(word) / 5 and len(set(name.tolist())) == len(name)


def test_query_matches_all_windows(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    found = dict(got(queries.table(spark, SF, "documents")))
    assert found == expected(rows, 20)
    assert sum(r[1] for r in found.values()) > 0
    out = queries.QUERIES["op11_repeats"](spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}


@pytest.mark.parametrize("letters,span", [(2, 5), (12, 20)])
def test_texts_of_few_words(spark, letters, span):
    rng = random.Random(span)
    alphabet = [f"w{i}" for i in range(letters)]
    passages = [[rng.choice(alphabet) for _ in range(rng.randint(5, 60))] for _ in range(3)]
    rows = [(i, " ".join(a_text(rng, alphabet, rng.choice([1, 10, 60, 400]), passages))) for i in range(60)]
    rows += [(60 + i, rows[7][1]) for i in range(20)] + [(-1, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert dict(got(df, span=span)) == expected(rows, span)


def test_nulls_empty_long_repeated_rows_and_clashing_columns(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    long = " ".join(rng.choice("abcdefgh") for _ in range(200_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, passage), (4, passage), (5, "x\x0b" + passage.replace(" ", "\n") + " é y"), (None, "of null " + passage),
            (6, long), (7, long[:1000]), (8, "a " * 500)]
    df = spark.createDataFrame([(d, t, "k", 1, 2) for d, t in rows], "doc_id long, text string, key string, row int, start int")
    out = got(df)
    want = expected(rows, 20)
    assert sorted(out, key=str) == sorted(((d, want[d]) for d, _ in rows), key=str)
    again = substrings.without_repeats(df)
    assert again.columns == [*df.columns, "repeats"] and {(r.key, r.row, r.start) for r in again.collect()} == {("k", 1, 2)}
    with pytest.raises(ValueError):
        substrings.without_repeats(df, name="row")


def test_rows_of_one_id_are_ordered_by_their_texts(spark):
    words_ = [f"w{i}" for i in range(30)]
    df = spark.createDataFrame([(1, "a " + " ".join(words_)), (1, "b " + " ".join(words_))], "doc_id long, text string")
    assert sorted(v[1] for _, v in got(df)) == [0, 30]


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
    assert got(spark.createDataFrame([(1, "few words")], "doc_id long, text string")) == [(1, (2, 0, "few words"))]
