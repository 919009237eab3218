"""Language of whole texts in two levels: first the family, then linear support vector machines, one for each pair of its languages.

A text is its share of every hashed pair and triple of bytes, so a machine's margin is the mean weight of the text's
pairs and triples. At each level every machine votes; most votes win, then the larger sum of margins, then the name.
The score is the logistic function of the least margin on the way. Null texts and texts without a letter are `und`
with score 0; so is everything if nothing could be learned. With one language it gets every text with a letter.

Machines are fitted on a bounded sample: about SAMPLE texts of each language, picked by a hash of the row.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm import words
from hazegrid.llm.columns import added
from hazegrid.llm.staging import spread, staged

UNKNOWN = "und"
#: Texts of each language that the machines are fitted on, about.
SAMPLE = 1000
#: Hashed features.
WIDTH = 1024
#: Passes and regularisation of a machine.
PASSES, PENALTY = 25, 1e-4

#: Families by language code. Other codes are families of their own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

_SHIFT = np.uint32(32 - WIDTH.bit_length() + 1)
#: Letters and bytes beyond ASCII stay, in lower case; all else is a space.
_FOLD = np.where((np.arange(256) >= 128) | ((words.LOWER >= 97) & (words.LOWER < 123)), words.LOWER, 32).astype(np.uint32)
_ASCII_LETTER = (words.LOWER >= 97) & (words.LOWER < 123)


def family(language: str) -> str:
    return FAMILY.get(language, language)


def _features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed pairs and triples by their first byte; a pair and a triple that would go beyond the end are missing."""
    x = _FOLD[data]
    pairs = (x[:-1] * np.uint32(256) + x[1:]) * np.uint32(2654435761)
    triples = ((x[:-2] * np.uint32(65536) + x[1:-1] * np.uint32(256) + x[2:]) * np.uint32(2246822519)) ^ np.uint32(0x55555555)
    return pairs >> _SHIFT, triples >> _SHIFT


def shares(data: np.ndarray) -> np.ndarray:
    """Share of each feature in one text."""
    out = np.zeros(WIDTH)
    if len(data) > 1:
        pairs, triples = _features(data)
        out = np.bincount(pairs, minlength=WIDTH) + np.bincount(triples, minlength=WIDTH).astype(float)
        out /= out.sum()
    return out


@dataclass
class Machine:
    """Positive margins speak for `yes`."""
    yes: str
    no: str
    weights: np.ndarray
    bias: float


@dataclass
class Model:
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def _machine(rows: DataFrame, yes: str, no: str, column: str) -> Machine:
    data = rows.filter(F.col(column).isin(yes, no)).withColumn("label", (F.col(column) == yes).cast("double"))
    fitted = LinearSVC(maxIter=PASSES, regParam=PENALTY, aggregationDepth=2).fit(data.select("label", "features"))
    return Machine(yes, no, np.asarray(fitted.coefficients.toArray()), float(fitted.intercept))


def fit(labelled: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Machines learned from the rows of `labelled` that have a text and a language. The key only picks the sample."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(language).alias("language")) \
        .filter("text is not null and language is not null")
    # One row a language.
    counts = {r.language: r.n for r in rows.groupBy("language").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model({}, [], {})
    share = F.lit(0.0)
    for code, n in sorted(counts.items()):
        share = F.when(F.col("language") == code, F.lit(sample / n)).otherwise(share)
    # The key is null in some tables: the text decides as well.
    chosen = rows.filter(spread("key", "text") < share)

    def run(batches):
        for batch in batches:
            made = [shares(np.frombuffer(t.encode(), np.uint8)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("language"), pa.array(made, pa.list_(pa.float64()))], names=["language", "shares"])

    rows = staged(chosen.mapInArrow(run, "language string, shares array<double>"), "language")
    rows = rows.withColumn("features", array_to_vector("shares")).drop("shares")
    found = sorted(r.language for r in rows.select("language").distinct().collect())
    families: dict[str, list[str]] = {}
    for code in found:
        families.setdefault(family(code), []).append(code)
    kin = F.lit(None).cast("string")
    for name, codes in families.items():
        kin = F.when(F.col("language").isin(codes), name).otherwise(kin)
    rows = rows.withColumn("family", kin).persist()
    try:
        between = [_machine(rows, a, b, "family") for a, b in itertools.combinations(sorted(families), 2)]
        within = {name: [_machine(rows, a, b, "language") for a, b in itertools.combinations(codes, 2)]
                  for name, codes in families.items()}
    finally:
        rows.unpersist()
    return Model(families, between, within)


def _margins(machines: list[Machine], data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Margins of all rows of a piece, machine by machine."""
    out = np.zeros((len(machines), len(ends) - 1))
    if len(data) > 2 and machines:
        pairs, triples = _features(data)
        lo, last = ends[:-1], ends[1:]
        to_pair, to_triple = np.maximum(last - 1, lo), np.maximum(last - 2, lo)
        size = np.maximum(to_pair - lo + to_triple - lo, 1)
        for k, m in enumerate(machines):
            sums = 0
            for codes, to in ((pairs, to_pair), (triples, to_triple)):
                run = np.concatenate([[0.0], np.cumsum(m.weights[codes])])
                sums = sums + run[np.minimum(to, len(codes))] - run[np.minimum(lo, len(codes))]
            out[k] = sums / size + m.bias
    return out


def _elected(names: list[str], machines: list[Machine], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner among `names` for each row, and its least margin."""
    votes, sums = np.zeros((len(names), margins.shape[1])), np.zeros((len(names), margins.shape[1]))
    for m, margin in zip(machines, margins, strict=True):
        for name, own in ((m.yes, margin), (m.no, -margin)):
            k = names.index(name)
            votes[k] += own > 0
            sums[k] += own
    best = np.argmax(votes + np.tanh(sums) * 0.25, axis=0)
    least = np.full(margins.shape[1], np.inf)
    for m, margin in zip(machines, margins, strict=True):
        for name, own in ((m.yes, margin), (m.no, -margin)):
            least = np.where(best == names.index(name), np.minimum(least, own), least)
    return best, least


def identify(df: DataFrame, model: Model, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """`df` with the columns `language` and `score`; columns of these names are replaced. No other column is read."""
    families = sorted(model.families)
    machines = model.between + [m for f in families for m in model.within[f]]

    def judged(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margins = _margins(machines, data, ends)
        kin, least = _elected(families, model.between, margins[:len(model.between)])
        named, at = np.full(len(kin), UNKNOWN, object), len(model.between)
        for k, f in enumerate(families):
            own = model.within[f]
            code, inner = _elected(model.families[f], own, margins[at:at + len(own)])
            named = np.where(kin == k, np.array(model.families[f], object)[code], named)
            least = np.where(kin == k, np.minimum(least, inner), least)
            at += len(own)
        return named, 1 / (1 + np.exp(-np.clip(least, -30, 30)))

    def make(column: pa.Array) -> list:
        named, scores = [], []
        for row, data, ends in words.texts(column):
            ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[ends]
            has = np.diff(ascii_letters) > 0
            for k in np.flatnonzero(~has):
                has[k] = any(c.isalpha() for c in data[ends[k]:ends[k + 1]].tobytes().decode())
            if families:
                code, value = judged(data, ends)
            else:
                has[:] = False
                code, value = np.full(len(has), UNKNOWN, object), np.zeros(len(has))
            named += list(np.where(has, code, UNKNOWN))
            scores.append(np.where(has, value, 0.0))
        return [pa.array(named, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]

    return added(df, f"`{language}` string, `{score}` double", text, make)
