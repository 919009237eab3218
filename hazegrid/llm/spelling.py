"""Words grouped with their misspellings: pairs one edit apart, found by pivotal bigrams, and the form that each word stands for.

Bigrams of a word are ordered by their frequency in the vocabulary, rarest first, then by gram and place. The first 2 * EDITS + 1
are its prefix; among them dynamic programming chooses EDITS + 1 that don't overlap and are rarest together: the pivots. An edit
touches at most EDITS of the pivots, so in a near word one of them is left, moved by at most the difference in length. If the prefix of the near
word doesn't end before the own one, that pivot stands in its prefix: it is rare enough, and as an edit makes at most
2 * EDITS new grams, it is among its first 4 * EDITS + 1, also where a gram repeats. So prefixes are indexed by gram, length and place,
and pivots look there under each place and length that one edit allows. Besides, one edit leaves one of two halves as it is:
which half and its hash are part of the key. What meets is verified by the edit distance, inside the join, so unequal pairs are never written.

EDITS is one: keys, halves and the form are made for it. Words are compared by code points and taken as they are. A null word is
dropped, repeated rows of a word are one with the sum of their n; a word of less than 4 code points has too few grams and is refused. An empty
vocabulary gives no rows. Extra columns are not kept, whatever their names. Ties between forms go to the smallest in code-point order.

Driver and tasks hold one number for each gram: at most the square of the letters that `WORD` allows, 90 * 90.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.staging import staged

EDITS = 1
LETTER = r"[A-Za-zÀ-ÿ]"
SHORTEST = 4
#: Code points beyond which words are compared in another way, with the same result.
LONG = 64


def runs(text: Column, shortest: int) -> Column:
    """All maximal runs of letters of at least so many code points, A-Z lower-cased; null has none."""
    # A run is matched whole, as a match starts at its first letter and takes all it can.
    found = F.regexp_extract_all(text, F.lit(f"({LETTER}{{{shortest},}})"), 1)
    return F.transform(found, lambda w: F.translate(w, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def chosen(at: list[int], weight: list[float], wanted: int = EDITS + 1) -> list[int]:
    """Places of `wanted` bigrams that don't overlap, of least weight together, from places in ascending order."""
    best = [[(0.0, ())] + [None] * wanted]  # best[i][k]: k of the first i places
    for i, place in enumerate(at):
        row = list(best[-1])
        free = next((j for j in range(i, 0, -1) if at[j - 1] <= place - 2), 0)
        for k in range(1, wanted + 1):
            before = best[free][k - 1]
            if before is not None and (row[k] is None or before[0] + weight[i] < row[k][0]):
                row[k] = (before[0] + weight[i], (*before[1], place))
        best.append(row)
    return list(best[-1][wanted][1])


def grams(words: DataFrame) -> DataFrame:
    """(gram, n) of all bigrams of the words."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    return words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def marked(words: DataFrame, weights: dict[str, int]) -> DataFrame:
    """Words with `last` (rank of the prefix's last gram), places of `prefix` and `pivots`, and `letters`, a bit for each letter's class."""
    rank = {g: i for i, g in enumerate(sorted(weights, key=lambda g: (weights[g], g)))}
    own, most = 2 * EDITS + 1, 4 * EDITS + 1
    schema = pa.schema([("word", pa.string()), ("last", pa.int32()), ("prefix", pa.list_(pa.int32())), ("pivots", pa.list_(pa.int32())), ("letters", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in schema]
            for word in batch.column(0).to_pylist():
                order = sorted((rank[word[i:i + 2]], i) for i in range(len(word) - 1))
                last = order[own - 1][0]
                first = sorted((i, r) for r, i in order[:own])
                bits = 0
                for letter in word:
                    bits |= 1 << ((ord(letter) * 37) & 63)
                row = (word, last, [i for r, i in order[:most] if r <= last],
                       chosen([i for i, _ in first], [weights[word[i:i + 2]] for i, _ in first]), bits - (bits >> 63 << 64))
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    return words.select("word").mapInArrow(run, "word string, last int, prefix array<int>, pivots array<int>, letters long")


def one_edit(a: Column, b: Column) -> Column:
    """Whether one inserted, deleted or replaced code point turns a into b."""
    # The built-in distance takes the square of the length, so long words are cut at their first difference.
    first = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    rest = lambda w, longer: F.substring(w, first + F.when(longer, 1).otherwise(0), F.length(w))
    cut = (F.abs(F.length(a) - F.length(b)) <= 1) & (rest(a, F.length(a) >= F.length(b)) == rest(b, F.length(b) >= F.length(a)))
    return F.when(F.length(a) <= LONG, F.levenshtein(a, b, EDITS) == EDITS).otherwise((a != b) & cut)


def pairs(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of distinct words that one inserted, deleted or replaced code point turns into each other."""
    weights = {r["gram"]: r["n"] for r in grams(words).toLocalIterator()}
    found = staged(marked(words, weights).withColumn("size", F.length("word")), "spelling-grams")

    def key(place: Column, size: Column, half: Column, same: Column, from_: Column) -> Column:
        return F.xxhash64(F.substring("word", from_ + 1, F.lit(2)), size, place, half, same).alias("key")

    middle = F.floor(F.col("size") / 2).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("half"), F.xxhash64(F.substring("word", F.lit(1), middle)).alias("same")),
                     F.struct(F.lit(1).alias("half"), F.xxhash64(F.substring("word", middle + 1, F.col("size"))).alias("same")))
    index = found.select("word", "last", "letters", "size", F.explode("prefix").alias("place"), halves.alias("halves")) \
        .select("word", "last", "letters", "size", "place", F.inline("halves").alias("half", "same")) \
        .select(key(F.col("place"), F.col("size"), F.col("half"), F.col("same"), F.col("place")),
                F.col("word").alias("near"), F.col("last").alias("near_last"), F.col("letters").alias("near_letters"))

    # Of a near word with `more` code points more: its size, the end of its first half, and what of the own word would be the same.
    other = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda more: F.struct(
        more.alias("more"), F.floor((F.col("size") + more) / 2).cast("int").alias("cut"),
        F.xxhash64(F.substring("word", F.lit(1), F.floor((F.col("size") + more) / 2).cast("int"))).alias("head"),
        F.xxhash64(F.substring("word", F.floor((F.col("size") + more) / 2).cast("int") - more + 1, F.col("size"))).alias("tail")))
    probes = found.select("word", "last", "letters", "size", "pivots", F.inline(other).alias("more", "cut", "head", "tail")) \
        .select("*", F.explode("pivots").alias("pivot")) \
        .select("*", F.explode(F.array_distinct(F.array(F.col("pivot"), F.col("pivot") + F.col("more")))).alias("place")) \
        .select("*", F.inline(F.array(F.struct(F.lit(0).alias("half"), F.col("head").alias("same")), F.struct(F.lit(1).alias("half"), F.col("tail").alias("same")))).alias("half", "same"))
    # A pivot inside the half that is the same stands before the edit, or after it.
    before = (F.col("half") == 0) & (F.col("place") + 2 <= F.col("cut"))
    after = (F.col("half") == 1) & (F.col("place") >= F.col("cut"))
    probes = probes.filter((F.col("place") >= 0) & ~(before & (F.col("place") != F.col("pivot"))) & ~(after & (F.col("place") != F.col("pivot") + F.col("more")))) \
        .select(key(F.col("place"), F.col("size") + F.col("more"), F.col("half"), F.col("same"), F.col("pivot")), "word", "last", "letters")

    meet = probes.join(index, "key").filter(
        (F.col("last") <= F.col("near_last")) & (F.bit_count(F.col("letters").bitwiseXOR(F.col("near_letters"))) <= 2 * EDITS)
        & (F.col("word") != F.col("near")) & one_edit(F.col("word"), F.col("near"))).select("word", "near")
    return meet.union(meet.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Every word (word, n) with form, root, n_near and form_n.

    form: the near word with the largest n, if that is at least `ratio` times the own; else null. root: where the forms end.
    """
    vocabulary = staged(words.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    facts = vocabulary.agg(F.max("n"), F.min(F.length("word"))).head()
    if (facts[1] or SHORTEST) < SHORTEST:
        raise ValueError(f"words have at least {SHORTEST} code points")
    near = staged(pairs(vocabulary), "spelling-pairs")
    known = near.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = known.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    joined = vocabulary.join(best, "word", "left").withColumn("form_n", -F.col("best.order"))
    stands = F.col("form_n") >= ratio * F.col("n")
    joined = staged(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                  F.when(stands, F.col("best.near")).alias("form"), F.when(stands, F.col("form_n")).alias("form_n")), "spelling-forms")
    # n grows along the forms by the ratio, so paths are short; each round doubles the steps taken.
    up = joined.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log(max(facts[0] or 1, 1), ratio) + 1)) + 1):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = staged(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return joined.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
