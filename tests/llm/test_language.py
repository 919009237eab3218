"""Language: held-out accuracy, what a prediction may depend on, and texts without letters."""

import pytest
from pyspark.sql import functions as F

from hazegrid.llm import language, queries

SF = "/root/testdata/sf0.01"

TEXTS = {
    "en": "the thing and that this with the other one was there when they were here",
    "de": "der die das und ist nicht mit einer für auf auch noch schon über straße",
    "fr": "le la les des une est que dans pour être avoir mais où déjà très",
    "es": "el la los una que es por para con más pero cuando donde también niño",
}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for code, text in TEXTS.items():
        words = text.split()
        rows += [(None if k % 7 == 0 else k, " ".join(words[k % 5:] + words[:k % 3]), code) for k in range(25)]
    rows += [(1, None, "en"), (2, "something", None), (3, "", "fr")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return language.fit(labelled)


def predicted(spark, model, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    return [(r.lang_pred, r.score) for r in language.identify(df, model).orderBy("k").collect()]


def test_held_out_accuracy(spark):
    out = queries.QUERIES["op4_language"](spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    known = queries.table(spark, SF, "documents").select("doc_id", "lang", F.length("text").alias("size"))
    rows = out.join(known, "doc_id").collect()
    assert len(rows) == known.count()
    held = [r for r in rows if r.held_out]
    assert held and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    long = [r for r in held if r.size > 200]
    assert sum(r.lang == r.lang_pred for r in long) == len(long)


def test_two_levels(spark, model):
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert len(model.between) == 1 and all(len(m) == 1 for m in model.within.values())
    assert [p for p, _ in predicted(spark, model, TEXTS.values())] == list(TEXTS)


def test_texts_without_letters(spark, model):
    out = predicted(spark, model, [None, "", " \n", "12 + 3 = 15!", "…—“”", "a", "日本", "é", "\U0001f600"])
    assert out[:5] == [("und", 0.0)] * 5 and out[8] == ("und", 0.0)
    assert all(code in TEXTS and 0 < score <= 1 for code, score in out[5:8])


def test_a_very_long_text_and_its_neighbours(spark, model):
    texts = [TEXTS["de"], TEXTS["fr"] * 60_000, TEXTS["en"], "", TEXTS["es"]]
    assert [c for c, _ in predicted(spark, model, texts)] == ["de", "fr", "en", "und", "es"]


def test_only_the_text_counts(spark, model):
    df = spark.createDataFrame([(1, "x", "den", TEXTS["fr"], 5.0), (None, None, None, TEXTS["fr"], None)],
                               "doc_id long, source string, lang string, text string, score double")
    out = language.identify(df, model)
    assert out.columns == ["doc_id", "source", "lang", "text", "lang_pred", "score"]
    a, b = out.collect()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score)
    assert language.identify(df.limit(0), model).count() == 0


def test_nothing_or_one_language_to_learn(spark, labelled):
    none = language.fit(labelled.limit(0))
    assert predicted(spark, none, ["abc", None]) == [("und", 0.0), ("und", 0.0)]
    one = language.fit(labelled.filter("lang = 'fr'"))
    assert [c for c, _ in predicted(spark, one, ["abc", "1"])] == ["fr", "und"]
    other = language.fit(labelled.filter("lang in ('en', 'fr')").withColumn("lang", F.when(F.col("lang") == "en", "xx").otherwise("yy")))
    assert [c for c, _ in predicted(spark, other, [TEXTS["en"], TEXTS["fr"]])] == ["xx", "yy"]
