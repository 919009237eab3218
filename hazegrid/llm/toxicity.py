"""Toxicity of whole texts from a weighted lexicon, found with an Aho-Corasick automaton in folded text.

Folding: lower case, look-alike letters of other scripts to Latin, digits that stand for letters to these letters,
invisible characters away. The lexicon holds beginnings of folded words of SHORTEST to LONGEST letters, and shorter and
longer words whole, with the log odds that labelled texts give them: all that have SUPPORT and ODDS, whatever their number.
A word counts with the heaviest entry that matches it; words inside an exception phrase don't count. The score is a logistic function of the summed weight and of that sum for each word of the text, so that a long text
isn't toxic for one doubtful word.

Lexicon and exceptions go to the tasks with the model. They grow with the vocabulary of the toxic labelled texts alone, which
people label, and not with the texts that are scored.

Null and empty texts get the score of a text without any match, repeated rows one each, an empty table an empty one; long texts
are searched whole. All columns are kept but for those named as the score or the label, which are replaced. If the labels hold no toxic or no clean text, the
lexicon is empty and every score is the share of toxic labels, or 0 without labels.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm import addresses
from hazegrid.llm.columns import added, fresh, without
from hazegrid.llm.staging import staged

#: Shortest and longest beginning of a word in the lexicon. Other entries are whole words.
SHORTEST, LONGEST = 4, 12
#: Least number of toxic texts with an entry and least log odds.
SUPPORT, ODDS = 4, 2.5
#: Words counted before a task hands its counts on. Memory only.
HELD = 300_000
#: A phrase of a match and a neighbour is an exception if so many clean texts have it and no toxic one.
CLEAN = 5

#: Letters of other scripts, wide letters and digits, with the Latin letter each stands for.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɡ": "g", "ɑ": "a",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
}
INVISIBLE = "­​‌‍⁠﻿"

_FOLD = {ord(a): b for a, b in LOOK_ALIKES.items()} | {ord(c): None for c in INVISIBLE} \
    | {0xFF41 + k: chr(97 + k) for k in range(26)} | {0xFF10 + int(d): LOOK_ALIKES.get(d, d) for d in "0123456789"}
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str | None) -> str:
    return text.lower().translate(_FOLD) if text else ""


def _letter(character: str) -> bool:
    """Whether a character, if there is one, is part of a word."""
    return character.isalnum() and not character.isdecimal()


def _beginnings(word: str) -> list[str]:
    """Entries that match a word: its beginnings, and the word itself if it's shorter or longer than those."""
    whole = [] if SHORTEST <= len(word) <= LONGEST else [word]
    return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)] + whole


def _neighbours(text: str, start: int) -> list[str]:
    """The phrases of the word at `start` with the word before and the word after, where one space parts them."""
    end = _WORD.match(text, start).end()
    after = _WORD.match(text, end + 1) if text[end:end + 1] == " " else None
    out = [text[start:after.end()]] if after else []
    first = start - 1
    if start and text[first] == " ":
        while first and _letter(text[first - 1]):
            first -= 1
        out += [text[first:end]] if first < start - 1 else []
    return out


@dataclass(frozen=True)
class Model:
    lexicon: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    bias: float = 0.0
    total: float = 0.0
    density: float = 0.0


class Finder:
    """Matches of a lexicon in folded texts."""

    def __init__(self, lexicon: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
        import ahocorasick
        self.entries = ahocorasick.Automaton()
        for entry, weight in lexicon:
            self.entries.add_word(entry, (len(entry), weight))
        self.empty = not lexicon
        if lexicon:
            self.entries.make_automaton()
        self.phrases = ahocorasick.Automaton()
        for phrase in exceptions:
            self.phrases.add_word(phrase, len(phrase))
        self.spared = bool(exceptions)
        if exceptions:
            self.phrases.make_automaton()

    def matches(self, text: str) -> dict[int, float]:
        """Weight of each matching word by where it starts."""
        found: dict[int, float] = {}
        if self.empty:
            return found
        for last, (size, weight) in self.entries.iter(text):
            start = last - size + 1
            begins = not _letter(text[max(start - 1, 0):start])
            if begins and weight > found.get(start, 0.0) and (SHORTEST <= size <= LONGEST or not _letter(text[last + 1:last + 2])):
                found[start] = weight
        if found and self.spared:
            starts = sorted(found)
            for last, size in self.phrases.iter(text):
                first = last - size + 1
                if not _letter(text[max(first - 1, 0):first]) and not _letter(text[last + 1:last + 2]):
                    for start in starts[bisect.bisect_left(starts, first):bisect.bisect_right(starts, last)]:
                        found.pop(start, None)
        return found

    def features(self, text: str) -> tuple[float, float]:
        """Summed weight, and for each word of the text, both on a log scale."""
        found = self.matches(text)
        if not found:
            return 0.0, 0.0
        total = sum(found.values())
        return math.log1p(total), math.log1p(100 * total / max(1, text.count(" ") + text.count("\n") + 1))


@functools.lru_cache(4)
def _finder(lexicon: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]) -> Finder:
    return Finder(lexicon, exceptions)


def learn_lexicon(rows: DataFrame) -> tuple[tuple[str, float], ...]:
    """Entries with their log odds, from rows (text, toxic). Counts cover all rows; each task adds up its own first."""
    sizes = {int(r.toxic): r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return ()

    def run(batches):
        held: Counter = Counter()

        def out():
            data = pa.RecordBatch.from_arrays([
                pa.array([w for w, _ in held], pa.string()), pa.array([t for _, t in held], pa.int32()),
                pa.array(list(held.values()), pa.int64())], names=["entry", "toxic", "n"])
            held.clear()
            return data

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                beginnings = {b for w in set(_WORD.findall(folded(text))) for b in _beginnings(w)} if toxic else \
                    set(_WORD.findall(folded(text)))
                for b in beginnings:
                    held[b, toxic] += 1
                if len(held) > HELD:
                    yield out()
        yield out()

    counts = staged(rows.mapInArrow(run, "entry string, toxic int, n long").groupBy("entry", "toxic").agg(F.sum("n").alias("n")), "lexicon")
    frequent = counts.filter((F.col("toxic") == 1) & (F.col("n") >= SUPPORT)).select("entry", F.col("n").alias("toxic_n"))
    size = F.length("entry")
    # Clean texts hand on words, toxic ones beginnings: the beginnings of the clean words are made after counting.
    clean = counts.filter("toxic = 0").select(
        F.explode(F.when(size < SHORTEST, F.array("entry")).otherwise(F.concat(
            F.transform(F.sequence(F.lit(SHORTEST), F.least(size, F.lit(LONGEST))), lambda n: F.substring("entry", F.lit(1), n)),
            F.when(size > LONGEST, F.array("entry")).otherwise(F.array().cast("array<string>"))))).alias("entry"),
        "n").groupBy("entry").agg(F.least(F.sum("n"), F.lit(sizes[0])).alias("clean_n"))
    odds = F.log((F.col("toxic_n") + 0.5) / (sizes[1] + 1)) - F.log((F.coalesce("clean_n", F.lit(0)) + 0.5) / (sizes[0] + 1))
    best = frequent.join(clean, "entry", "left").withColumn("weight", odds).filter(F.col("weight") >= ODDS)
    return tuple(sorted((r.entry, float(r.weight)) for r in best.collect()))


def learn_exceptions(rows: DataFrame, lexicon: tuple[tuple[str, float], ...]) -> tuple[str, ...]:
    """Phrases of a match and the word before or after it that only clean texts have."""
    def run(batches):
        finder = _finder(lexicon, ())
        for batch in batches:
            phrases, labels = [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                text = folded(text)
                own = set()
                for start in finder.matches(text):
                    own.update(_neighbours(text, start))
                phrases += own
                labels += [toxic] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], names=["phrase", "toxic"])

    found = rows.mapInArrow(run, "phrase string, toxic int").groupBy("phrase") \
        .agg(F.sum("toxic").alias("toxic_n"), F.count("*").alias("n")).filter(f"toxic_n = 0 and n >= {CLEAN}")
    return tuple(sorted(r.phrase for r in found.collect()))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """`docs` with the column `label` of `labels`, a row for each pair of a document and a label of its key; a column of that name in
    `docs` is replaced, null keys have no labels. Of the texts hardly more than the labelled ones move: a Bloom filter of the labels' keys
    goes to the tasks first. Its size is bounded; when it's full, more texts move."""
    blocks = min(max(1, labels.count() // addresses.PER_BLOCK), addresses.BROADCAST_BLOCKS)
    docs = docs.select(*without(docs, label))
    [maybe] = fresh(docs, "_possible")
    found = addresses.possible(docs, key, labels.select(F.col(key).alias("key")), blocks, maybe).filter(F.col(maybe)).drop(maybe)
    # Merged at any size of the labels, so that what is moved grows with the texts.
    return found.join(labels.select(key, label).hint("merge"), key)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic") -> Model:
    """Lexicon, exceptions and logistic weights from the rows of `labelled` with a label 0 or 1."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("toxic")).filter("toxic in (0, 1)")
    rows = staged(rows, "toxicity")
    lexicon = learn_lexicon(rows)
    if not lexicon:
        share = rows.agg(F.avg("toxic")).first()[0] or 0.0
        return Model((), (), math.log((share + 1e-9) / (1 - share + 1e-9)))
    exceptions = learn_exceptions(rows, lexicon)

    def run(batches):
        finder = _finder(lexicon, exceptions)
        for batch in batches:
            made = [finder.features(folded(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.float64()), pa.array(made, pa.list_(pa.float64()))],
                                             names=["label", "made"])

    # Equal features fall together, weighted by their number: most texts have no match.
    data = staged(rows.mapInArrow(run, "label double, made array<double>").groupBy("label", "made").agg(F.count("*").cast("double").alias("n")),
                  "toxicity").withColumn("features", array_to_vector("made"))
    fitted = LogisticRegression(maxIter=50, regParam=1e-4, weightCol="n").fit(data)
    total, density = fitted.coefficients
    return Model(lexicon, exceptions, float(fitted.intercept), float(total), float(density))


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """`df` with the column `name`, 0 to 1, from `text` alone; a column of that name is replaced."""
    def make(column: pa.Array) -> list:
        finder = _finder(model.lexicon, model.exceptions)
        out = []
        for t in column.to_pylist():
            a, b = finder.features(folded(t))
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.bias + model.total * a + model.density * b)))))
        return [pa.array(out, pa.float64())]

    return added(df, f"`{name}` double", text, make)
