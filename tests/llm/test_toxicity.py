"""Toxicity: held-out ranking, folding, exceptions, and tables without labels."""

import math
import re
from collections import Counter

import pytest

from hazegrid.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def rows_for(n):
    out = []
    for k in range(n):
        out.append((f"a plain text number word{k} about the weather and other things", 0))
        out.append((f"what a moron and idiotic clown word{k} says about things", 1))
        if k < 6:
            out.append((f"the clown fish word{k} swims in the sea", 0))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.createDataFrame(rows_for(120), "text string, toxic int"))


def scores(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    return [r.score for r in toxicity.score(df, model).orderBy("k").collect()]


def test_held_out_texts(spark):
    out = queries.QUERIES["op10_toxicity"](spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    labels = queries.table(spark, SF, "labels")
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    bad, good = [r.score for r in held if r.toxic == 1], [r.score for r in held if r.toxic == 0]
    area = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert area > 0.95
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_folding():
    assert toxicity.folded("ＩＤ1ОТ") == "idiot"
    assert toxicity.folded("m​or­on") == "moron"
    assert toxicity.folded("réeux É") == "réeux é"
    assert toxicity.folded(None) == ""


def test_disguises_and_exceptions(spark, model):
    texts = ["you moron", "you m0r0n", "you mоrоn", "you m​oron", "an oxymoron here", "you", "the clown fish swims", "a clown"]
    found = scores(spark, model, texts)
    plain = scores(spark, model, [""])[0]
    assert found[0] == found[1] == found[2] == found[3] > plain
    assert found[4] == found[5] == plain
    assert "clown fish" in model.exceptions and found[6] == plain


def test_a_long_text_needs_more(spark, model):
    short, long = scores(spark, model, ["you moron", "you moron " + "and some words " * 20_000])
    assert plain_below(short, long)


def plain_below(short, long):
    return long <= short


def test_nulls_repeats_and_columns(spark, model):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "moron", "x")], "doc_id long, text string, score string")
    out = toxicity.score(df, model)
    assert out.columns == ["doc_id", "text", "score"] and dict(out.dtypes)["score"] == "double"
    rows = sorted((r.doc_id, r.score) for r in out.collect())
    assert rows[0][1] == rows[1][1] == rows[2][1] < rows[3][1]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_without_both_labels(spark):
    empty = spark.createDataFrame([], "text string, toxic int")
    assert scores(spark, toxicity.fit(empty), ["moron"])[0] < 0.01
    clean = spark.createDataFrame([("a", 0), (None, 0), ("b", None)], "text string, toxic int")
    assert scores(spark, toxicity.fit(clean), ["moron", None])[0] < 0.01
    toxic = spark.createDataFrame([("a", 1), (None, 1)], "text string, toxic int")
    assert scores(spark, toxicity.fit(toxic), ["moron", None])[1] > 0.99


def test_all_labels_count(spark):
    """A word in SUPPORT of 60,000 texts and a phrase in CLEAN of them are learned, wherever they stand."""
    cases = "case when id % 15000 = 7 then 'you quixwort' when id % 6000 = 9 then 'the zorblax went' when id % 12000 = 3 then 'a zorblax fish' " \
        "when id % 10 = 1 then 'what a moron' else 'a plain text' end"
    docs = spark.range(60_000).selectExpr("id as doc_id", f"{cases} as text")
    labels = docs.selectExpr("doc_id", "cast(text in ('you quixwort', 'the zorblax went', 'what a moron') as int) as toxic")
    model = toxicity.fit(toxicity.labelled(docs, labels))
    assert {"moron", "quixwort", "zorblax"} <= {entry for entry, _ in model.lexicon}
    assert "zorblax fish" in model.exceptions


def test_labelled_rows_are_those_of_the_join(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (4, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, 1), (2, 1)], "doc_id long, toxic int")
    rows = sorted(toxicity.labelled(docs, labels).select("doc_id", "text", "toxic").collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, "a", 1), (1, "b", 1), (2, None, 0), (2, None, 1)]
    assert toxicity.labelled(docs, labels.limit(0)).count() == 0


WORD = re.compile(r"[^\W\d_]+")


def entries_of(word):
    return {word[:n] for n in range(toxicity.SHORTEST, min(len(word), toxicity.LONGEST) + 1)} | \
        (set() if toxicity.SHORTEST <= len(word) <= toxicity.LONGEST else {word})


def plain_lexicon(rows):
    n = Counter(t for _, t in rows)
    toxic, clean = Counter(), Counter()
    for text, label in rows:
        words = set(WORD.findall(toxicity.folded(text)))
        if label:
            toxic.update({e for w in words for e in entries_of(w)})
        else:
            clean.update(e for w in words for e in entries_of(w))
    odds = {e: math.log((k + 0.5) / (n[1] + 1)) - math.log((min(clean[e], n[0]) + 0.5) / (n[0] + 1)) for e, k in toxic.items() if k >= toxicity.SUPPORT}
    return {e: w for e, w in odds.items() if w >= toxicity.ODDS}


def plain_matches(text, lexicon):
    """(start, end, weight) of every word with an entry."""
    out = []
    for m in WORD.finditer(text):
        weights = [lexicon[e] for e in entries_of(m.group()) if e in lexicon]
        out += [(m.start(), m.end(), max(weights))] if weights else []
    return out


def plain_exceptions(rows, lexicon):
    n, toxic = Counter(), Counter()
    for text, label in rows:
        text = toxicity.folded(text)
        words = list(WORD.finditer(text))
        matched = {a for a, _, _ in plain_matches(text, lexicon)}
        found = set()
        for a, b in zip(words, words[1:], strict=False):
            if text[a.end():b.start()] == " " and (a.start() in matched or b.start() in matched):
                found.add(text[a.start():b.end()])
        n.update(found)
        toxic.update(found if label else ())
    return {p for p, k in n.items() if k >= toxicity.CLEAN and not toxic[p]}


def plain_score(text, lexicon, exceptions, model):
    text = toxicity.folded(text)
    words = list(WORD.finditer(text))
    spared = set()
    for a, b in zip(words, words[1:], strict=False):
        if text[a.start():b.end()] in exceptions:
            spared |= {a.start(), b.start()}
    total = sum(w for start, _, w in plain_matches(text, lexicon) if start not in spared)
    share = 100 * total / max(1, text.count(" ") + text.count("\n") + 1)
    return 1 / (1 + math.exp(-(model.bias + model.total * math.log1p(total) + model.density * math.log1p(share))))


def test_a_plain_count_agrees(spark):
    """Lexicon, exceptions and scores of a whole table, counted anew word by word."""
    sf = "/root/testdata/sf0.01"
    rows = toxicity.labelled(queries.table(spark, sf, "documents").select("doc_id", "text"), queries.table(spark, sf, "labels"))
    model = toxicity.fit(rows)
    plain = [(r.text, r.toxic) for r in rows.collect() if r.toxic is not None]
    lexicon = plain_lexicon(plain)
    assert lexicon and lexicon == pytest.approx(dict(model.lexicon))
    exceptions = plain_exceptions(plain, lexicon)
    assert exceptions == set(model.exceptions)
    for r in toxicity.score(rows, model).collect():
        assert r.score == pytest.approx(plain_score(r.text, lexicon, exceptions, model), abs=1e-9)


def test_long_words_are_entries_of_their_own(spark):
    """Compounds with a common beginning are told apart, and a neighbour of any length makes a phrase."""
    far = "x" * 70
    rows = [(f"die donaudampfschifftrottel{far} n{k}", 0) for k in range(2)]
    for k in range(30):
        rows += [(f"die donaudampfschiffkapitaene fahren word{k}", 0), (f"du donaudampfschifftrottel word{k}", 1), (f"{far} trottelblume", 0), ("so ein trottel", 1)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    lexicon, plain = dict(model.lexicon), plain_lexicon(rows)
    assert "donaudampfschifftrottel" in lexicon and not any("donaudampfschifftrottel".startswith(e) and len(e) <= 12 for e in lexicon)
    assert lexicon == pytest.approx(plain)
    finder = toxicity.Finder((("trottel", 3.0),), ())
    assert toxicity._neighbours(f"{far} trottelblume", 71) == [f"{far} trottelblume"] and finder.matches(f"{far} trottelblume") == {71: 3.0}
    whole = toxicity.Finder((("ass", 3.0), ("donaudampfschifftrottel", 3.0)), ())
    assert whole.matches("assess an ass") == {10: 3.0}
    assert whole.matches("donaudampfschifftrottels donaudampfschifftrottel") == {25: 3.0}


def test_many_matches_and_exceptions_in_a_long_text():
    finder = toxicity.Finder((("clown", 3.0),), ("clown fish",))
    found = finder.matches("clown fish " * 100_000 + "a clown")
    assert list(found.values()) == [3.0]


def test_a_label_column_of_the_documents_is_replaced(spark):
    docs = spark.createDataFrame([(1, "a", "own", 5)], "doc_id long, text string, toxic string, _possible int")
    labels = spark.createDataFrame([(1, 1, "other", 7.0)], "doc_id long, toxic int, text string, _possible double")
    [row] = toxicity.labelled(docs, labels).collect()
    assert row.asDict() == {"doc_id": 1, "text": "a", "_possible": 5, "toxic": 1}
