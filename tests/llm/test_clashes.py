"""Columns named as the operators' own working columns: they come back as they were, and results don't change."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hazegrid.llm import addresses, bpe, leaks, quality, queries, toxicity, unigram

NAMES = (
    "_key", "_ruled", "_possible", "_listed", "_look", "_block", "_filled", "possible", "key", "block", "listed", *(f"bit{k}" for k in range(4)),
    *(f"word{k}" for k in range(4)), "_value", "_words", "_lines", "value", "n", "label", "toxic", "made", "entry", "batch", "item", "spans", "pos", "col", "_1")
ROWS = [
    (1, "a text of mine, call ann@example.org or else. You moron!", "https://www.example.org/es/1?a=1"), (2, None, None), (3, "", "nothing"),
    (3, "", "nothing"), (4, "line\nline\nline " * 300, "http://EXAMPLE.com/fr/x#y")]


def of_addresses(df, spark):
    listed = spark.createDataFrame([("example.org/es/1?a=1",), (None,)], "key string")
    return addresses.judged(df, (("allow", "com", "/fr/"),), listed)


def of_toxicity(df, spark):
    return toxicity.score(df, toxicity.Model((("moron", 3.0),), (), -2.0, 1.0, 1.0))


OPERATORS = {
    "addresses": of_addresses,
    "quality": lambda df, spark: quality.judged(quality.measured(df), 0.0, {n: {-1: -1.0, 0: 0.0, 1: 1.0} for n in quality.rules()}),
    "toxicity": of_toxicity,
    "bpe": lambda df, spark: bpe.encode(df, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN),
    "unigram": lambda df, spark: unigram.count_tokens(df, public_tokenizers.path(queries.VOCABULARY)),
    "leaks": lambda df, spark: leaks.with_leaks(df, spark.createDataFrame([(7, "a text of mine call ann")], "item_id long, text string")),
}


@pytest.mark.parametrize("operator", OPERATORS)
def test_extra_columns(spark, operator):
    make = OPERATORS[operator]
    bare = spark.createDataFrame(ROWS, "doc_id long, text string, url string")
    more = bare.select("*", *(F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES))
    plain = make(bare, spark)
    out = make(more, spark)
    made = [c for c in plain.columns if c not in bare.columns]
    quoted = ["`" + c + "`" for c in plain.columns]
    rows = sorted(map(str, out.select(*quoted).collect()))
    assert rows == sorted(map(str, plain.collect())) and len(rows) == len(ROWS)
    for name in (n for n in NAMES if n not in made):
        assert all(r[0] == f"{name}{r[1]}" for r in out.select(f"`{name}`", "doc_id").collect()), name
    none = make(more.limit(0), spark)
    assert none.count() == 0 and none.columns == out.columns
