"""Spelling variants against all pairs."""

import itertools
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from hazegrid.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(n, ratio=10):
    near = {w: [] for w in n}
    rest = {}
    for w in n:  # only words that share a text without one of their code points can be near
        for i in range(len(w)):
            rest.setdefault(w[:i] + w[i + 1:], set()).add(w)
        rest.setdefault(w, set()).add(w)
    for ws in rest.values():
        for a, b in itertools.combinations(sorted(ws), 2):
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    near = {w: set(v) for w, v in near.items()}
    form = {w: min(v, key=lambda x: (-n[x], x.encode())) for w, v in near.items() if v}
    form = {w: f for w, f in form.items() if n[f] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def got(df, **more):
    rows = spelling.variants(df, **more).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_matches_all_pairs(spark):
    n = Counter()
    for doc_id, text in queries.table(spark, SF, "documents").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    out = queries.QUERIES["op13_spelling"](spark, SF)
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out.collect()} == expected(n)


@pytest.mark.parametrize("letters,low,high,count", [("ab", 4, 9, 400), ("abcdé", 4, 8, 1500), ("a", 4, 40, 30)])
def test_no_pair_is_missed_where_grams_repeat(spark, letters, low, high, count):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(count)}
    n = {w: rng.choice([2, 3, 25, 400]) for w in sorted(words)}
    assert got(spark.createDataFrame(sorted(n.items()), "word string, n long")) == expected(n)


def test_pivots_are_the_rarest_that_dont_overlap():
    rng = random.Random(5)
    for _ in range(300):
        at = sorted(rng.sample(range(12), rng.randint(3, 6)))
        weight = [rng.randint(1, 50) for _ in at]
        best = min(weight[i] + weight[j] for i in range(len(at)) for j in range(i) if at[i] - at[j] >= 2)
        a, b = spelling.chosen(at, weight)
        assert b - a >= 2 and weight[at.index(a)] + weight[at.index(b)] == best


def test_ties_chains_repeats_nulls_and_clashing_columns(spark):
    rows = [("colours", 3), ("colour", 40), ("colouur", 4), ("golour", 40), (None, 9), ("color", 5), ("colors", 3), ("colour", 0), ("coolour", 1000)]
    df = spark.createDataFrame([(w, k, "x", 1) for w, k in rows], "word string, n long, key string, last int")
    n = Counter()
    for w, k in rows:
        if w is not None:
            n[w] += k
    assert got(df) == expected(dict(n))
    assert got(df)["colours"][:2] == ("colour", "coolour")  # by two steps


def test_edits_of_long_words(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("aé\U0001F600") for _ in range(n)) for n in (65, 66, 70) for _ in range(3)]
    rows = []
    for w in words:
        i = rng.randrange(len(w))
        for near in (w, w[:i] + w[i + 1:], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1:], w[:i] + "zz" + w[i:], "z" + w[1:-1] + "z", w + "z", w[:-1], w[1:], rng.choice(words)):
            rows.append((w, near))
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.withColumn("one", spelling.one_edit(F.col("a"), F.col("b"))).collect():
        assert r.one == one_edit(r.a, r.b), r


def test_empty_tables_long_words_and_short_ones(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert got(empty) == {}
    long = "ab" * 5_000
    n = {long: 500, long[:-1]: 3, "x" * 4_000: 7, "x" * 4_001: 80, "q" * 6_000: 2}
    assert got(spark.createDataFrame(list(n.items()), "word string, n long")) == expected_long(n)
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("abc", 2)], "word string, n long"))


def expected_long(n):
    a, b, c, d, e = n
    return {a: (None, a, 500, 1, None), b: (a, a, 3, 1, 500), c: (d, d, 7, 1, 80), d: (None, d, 80, 1, None), e: (None, e, 2, 0, None)}


def test_runs_of_letters(spark):
    text = "Über-Straße naïVE×x1abcdefg2 ABCDEFGHÀé " + "Z" * 100_000
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(spelling.runs(F.col("t"), 7)).collect()]
    assert got == [["naïve×x", "abcdefg", "abcdefghÀé", "z" * 100_000], None, []]
