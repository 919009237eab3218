"""A corpus cleaned and encoded: language, near copies, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last keep the columns of `documents` and, of the rows that stay, all values but redacted texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.llm import bpe, language, leaks, ngram_join, personal
from hazegrid.llm.shipping import ship
from hazegrid.llm.staging import remainder, staged, unstaged

#: What the stages work on and return; further columns of a table pass through.
RANKS = "byte_bpe_50k.tiktoken"
#: Words of a shingle and least similarity in percent of near copies; op6 has its own.
SHINGLE, ALIKE = 5, 80


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language; texts that are null or without a letter go. Machines learn from the rows whose crc32(doc_id) modulo 4 isn't 2."""
    ship(spark)
    model = language.fit(docs.filter(F.coalesce(remainder("doc_id", 4) != 2, F.lit(False))))
    judged = language.identify(docs, model, language="_language", score="_score")
    return judged.filter(F.col("_language") != language.UNKNOWN).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least doc_id of each component of near copies, null first; rows of one id are told apart and ordered by a hash of their
    texts. Rows that equal each other in id and text are one; texts without a word stay."""
    ship(spark)
    digest = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    own = docs.select(F.struct(docs["doc_id"].alias("id"), digest.alias("digest")).alias("row"), docs["text"].alias("text"))
    found = staged(ngram_join.components(own, key="row", size=SHINGLE, percent=ALIKE), "components")
    chosen = found.filter(F.col("row") == F.col("component_id")).groupBy("row").agg(F.count("*").alias("rows")) \
        .select(F.col("row.id").alias("id"), F.col("row.digest").alias("digest"), "rows")
    kept = docs.join(chosen.drop("rows"), docs["doc_id"].eqNullSafe(chosen["id"]) & (digest == chosen["digest"]), "left_semi")
    # Texts move once more only where a whole row of id and text is repeated.
    return kept if chosen.filter("rows > 1").isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item in their text."""
    ship(spark)
    marked = leaks.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name="_leaks")
    return marked.filter(F.size("_leaks") == 0).select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in their texts replaced by its kind, and n_chars the length of the new text."""
    ship(spark)
    out = personal.redact(docs, personal.fit(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every row."""
    ship(spark)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    encoded = bpe.encode(docs.select(*kept, "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return encoded.select(*kept, "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language", keep_known_languages),
    ("near copies", keep_one_of_each_group),
    ("benchmark leaks", drop_leaks),
    ("personal data", redact_personal_data),
    ("byte-level BPE", encode),
]

#: No stage but the last could be said in SQL: machines, trees and merges are learned or read from files.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next, whose rows take its place there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        unstaged(before)
    return docs
