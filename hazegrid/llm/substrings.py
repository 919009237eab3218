"""Long repeats between and within texts, found by recompression, and texts without them.

A text of words is compressed in rounds. In each, runs of a symbol become one symbol, then neighbours become one where a coin
thrown for every symbol shows tails for the left and heads for the right. Names are global: a 64-bit hash of what a run
or pair is made of, so all tasks name equal runs and pairs alike without meeting, and names need no shuffle of every word. Equal stretches of text are thus
cut alike but for their ends. How far the ends reach is known for every symbol (`low`, `high`): the words around it that decide
that it is cut like this. Where these lie within a window of `span` words, the symbol stands in every occurrence of the window.

A window belongs to one such symbol of the highest level that has any in it (the least hash, the first of equals), named
together with the words that decide it; a window without any, as in long runs, is a symbol of its own. Neighbouring windows of one symbol are a stretch, a row. Spark then
counts the names: windows under a name that stands once are no repeats. Stretches that are equal as a whole form a class, of which
all but the earliest are repeats, whatever their number, so copies cost one row a stretch. Only where a name has several classes are the windows of their earliest stretches compared one by one.

A window is a repeat if its word sequence also starts earlier: in a row of smaller key, or earlier in the same row. Rows of equal key are
ordered by a hash of their texts; rows equal in key and text are one document, both give the same. Null keys come first. Null, empty and blank texts have
no words, texts of fewer words than `span` no windows; an empty table gives no rows. All columns of the input are kept, whatever their names; a clash with the new one is refused.

Words are 64-bit hashes, compared windows 128 bits (name and window).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hazegrid.llm import addresses
from hazegrid.llm.columns import added, sliced
from hazegrid.llm.staging import staged
from hazegrid.llm.words import BLANK, mixed, shingled, texts, words

SPAN, ROUNDS = 20, 4

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_RUN, _LEFT, _RIGHT, _COIN, _PICK, _PLACE = (np.uint64(x) for x in (
    0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93))


class Level:
    """Symbols of several texts in a row: name, first and last word, first and last word that decide it, and text."""

    def __init__(self, name, begin, end, low, high, of):
        self.name, self.begin, self.end, self.low, self.high, self.of = name, begin, end, low, high, of

    def joined(self) -> np.ndarray:
        """For each symbol, whether the one before it is of the same text."""
        out = np.zeros(len(self.of), bool)
        out[1:] = self.of[1:] == self.of[:-1]
        return out


def _runs(level: Level, word: np.ndarray, bounds: np.ndarray) -> Level:
    joined = level.joined()
    same = joined.copy()
    same[1:] &= level.name[1:] == level.name[:-1]
    first = np.flatnonzero(~same)
    last = np.append(first[1:], len(same)) - 1
    n = (last - first + 1).astype(np.uint64)
    name = level.name[first]
    name = np.where(n > 1, mixed(name * _RUN + n), name)
    begin, end, of = level.begin[first], level.end[last], level.of[first]
    # A neighbour whose adjoining word differs is another symbol, whatever else it holds.
    left = np.where(joined[first], np.where(word[level.end[first - 1]] != word[level.end[first]], begin - 1, level.low[first - 1]), bounds[of] - 1)
    after = np.minimum(last + 1, len(same) - 1)
    inside = np.append(joined, False)[last + 1]
    right = np.where(inside, np.where(word[level.begin[after]] != word[level.begin[last]], end + 1, level.high[after]), bounds[of + 1])
    return Level(name, begin, end, np.minimum(level.low[first], left), np.maximum(level.high[last], right), of)


def _pairs(level: Level, bounds: np.ndarray, number: int) -> Level:
    joined = level.joined()
    heads = (mixed(level.name * _COIN + np.uint64(number)) >> np.uint64(63)).astype(bool)
    second = joined & heads
    second[1:] &= ~heads[:-1]
    first = np.flatnonzero(~second)
    last = np.append(first[1:], len(second)) - 1
    two = last > first
    name = level.name[first]
    name = np.where(two, mixed(name * _LEFT + level.name[last] * _RIGHT), name)
    of = level.of[first]
    # Tails can't be the right one of a pair, heads not the left one: there a neighbour decides nothing.
    left = np.where(heads[first], np.where(joined[first], level.low[first - 1], bounds[of] - 1), level.low[first])
    after = np.minimum(last + 1, len(second) - 1)
    inside = np.append(joined, False)[last + 1]
    right = np.where(heads[last], level.high[last], np.where(inside, level.high[after], bounds[of + 1]))
    return Level(name, level.begin[first], level.end[last], np.minimum(left, np.minimum(level.low[first], level.low[last])),
                 np.maximum(right, np.maximum(level.high[first], level.high[last])), of)


def compressed(word: np.ndarray, bounds: np.ndarray, rounds: int) -> list[Level]:
    """Levels 1 to `rounds` over texts whose words begin and end at `bounds`."""
    at = np.arange(len(word))
    level = Level(word, at, at, at, at, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)))
    out = []
    for number in range(rounds):
        level = _pairs(_runs(level, word, bounds), bounds, number)
        out.append(level)
    return out


def stretches(word: np.ndarray, bounds: np.ndarray, span: int, rounds: int):
    """Name, hash, first word and number of windows of all stretches."""
    window = shingled(word, span)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(of[:len(window)] == of[span - 1:]) if len(window) else np.zeros(0, np.int64)
    if not len(starts):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    powers = np.cumprod(np.append(np.uint64(1), np.full(len(word), _BASE, np.uint64)))
    back = np.cumprod(np.append(np.uint64(1), np.full(len(word), _BACK, np.uint64)))
    before = np.append(np.uint64(0), np.cumsum(word * powers[:-1]))
    owner = np.full(len(starts), -1, np.int64)
    name = window[starts]
    free, offset = np.arange(len(starts)), 0
    for level in reversed(compressed(word, bounds, rounds)):
        s = starts[free]
        # Symbols from `a` to `b` are decided by words of the window alone.
        a = np.cumsum(np.bincount(level.low + 1, minlength=len(word) + 1))[s]
        b = np.cumsum(np.bincount(level.high, minlength=len(word) + 1))[s + span - 1] - 1
        open_ = np.flatnonzero(a <= b)
        best, pick = np.full(len(s), -1, np.int64), mixed(level.name * _PICK)
        step = 0
        left = open_
        while len(left):
            at = a[left] + step
            now = best[left]
            better = (now < 0) | (pick[at] < pick[now])
            best[left[better]] = at[better]
            step += 1
            left = left[a[left] + step <= b[left]]
        got, which = free[open_], best[open_]
        owner[got] = which + offset
        low, high = level.low[which], level.high[which]
        around = (before[high + 1] - before[low]) * back[low]
        name[got] = mixed(mixed(around + (level.begin[which] - low).astype(np.uint64) * _PLACE) ^ level.name[which])
        offset += len(level.name)
        free = free[a > b]
        if not len(free):
            break
    owner[free] = offset + free
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    inside = np.arange(len(starts)) - np.repeat(first, n)
    whole = np.add.reduceat(mixed(window[starts] + inside.astype(np.uint64) * _PLACE), first)
    return name[first], mixed(whole + n.astype(np.uint64)), starts[first], n


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _owners(docs: DataFrame, span: int, rounds: int) -> DataFrame:
    """(name, whole, key, digest, start, n) of every stretch."""
    schema = StructType([*StructType.fromDDL("name long, whole long"), docs.schema["key"], *StructType.fromDDL("digest long, start int, n int")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in sliced(b, "text")):
            for row, data, ends in texts(batch.column("text")):
                word, _, bounds = words(data, ends, BLANK[data])
                name, whole, start, n = stretches(word, bounds, span, rounds)
                if not len(name):
                    continue
                of = np.searchsorted(bounds, start, "right") - 1
                take = pa.array(of + row)
                yield pa.RecordBatch.from_arrays(
                    [_signed(name), _signed(whole), batch.column("key").take(take), batch.column("digest").take(take),
                     pa.array((start - bounds[of]).astype(np.int32)), pa.array(n.astype(np.int32))], schema=arrow)

    return docs.mapInArrow(run, schema)


def _windows(docs: DataFrame, span: int) -> DataFrame:
    """(name, window, key, digest, start): one by one, the windows of the stretches in `wanted`."""
    schema = StructType([*StructType.fromDDL("name long, window long"), docs.schema["key"], *StructType.fromDDL("digest long, start int")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in sliced(b, "text")):
            wanted = batch.column("wanted")
            parts = wanted.flatten()
            name, start, n = (parts.field(k).to_numpy(zero_copy_only=False) for k in ("name", "start", "n"))
            per = np.append(0, np.cumsum(wanted.value_lengths().to_numpy(zero_copy_only=False)))
            for row, data, ends in texts(batch.column("text")):
                word, _, bounds = words(data, ends, BLANK[data])
                window = shingled(word, span)
                lo, hi = per[row], per[row + len(ends) - 1]
                of = np.repeat(np.arange(len(ends) - 1), np.diff(per[row:row + len(ends)]))
                many = n[lo:hi]
                inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = np.repeat(start[lo:hi], many) + inside
                of = np.repeat(of, many)
                take = pa.array(of + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(name[lo:hi], many)), _signed(window[bounds[of] + at]), batch.column("key").take(take),
                     batch.column("digest").take(take), pa.array(at.astype(np.int32))], schema=arrow)

    return docs.mapInArrow(run, schema)


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["key"].eqNullSafe(b["key"]) & (a["digest"] == b["digest"])


def _sifted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with `possible`: false where no row of `found` has its digest. Most texts then needn't move to be joined; when the filter is full, more do."""
    blocks = min(max(1, found.count() // addresses.PER_BLOCK), addresses.BROADCAST_BLOCKS)
    return addresses.possible(docs, "digest", found.select(F.col("digest").alias("key")), blocks)


def repeats(docs: DataFrame, span: int = SPAN, rounds: int = ROUNDS) -> DataFrame:
    """(key, digest, start, n): for rows (key, digest, text), stretches of n windows that also start earlier."""
    place = F.struct("key", "digest", "start")
    owners = staged(_owners(docs, span, rounds), "repeats-stretches")
    # Written, so that the join deals its rows anew and a name of many rows can be split.
    shared = staged(owners.groupBy("name").agg(F.count("*").alias("rows")).filter("rows > 1").select("name"), "repeats-names")
    owners = staged(owners.join(shared, "name", "left_semi"), "repeats-shared")
    classes = staged(owners.groupBy("name", "whole").agg(F.min(place).alias("first"), F.max("n").alias("n")), "repeats-classes")
    copies = owners.join(classes.drop("n"), ["name", "whole"]).filter(place != F.col("first")).select("key", "digest", "start", "n")
    several = classes.groupBy("name").agg(F.count("*").alias("rows")).filter("rows > 1").select("name")
    wanted = staged(classes.join(several, "name", "left_semi").groupBy("first.key", "first.digest")
                    .agg(F.collect_list(F.struct("name", "first.start", "n")).alias("wanted")), "repeats-wanted")
    some = _sifted(docs, wanted).filter("possible")
    texts_ = some.join(wanted, _same(some, wanted)).select(some["key"], some["digest"], some["text"], "wanted")
    windows = staged(_windows(texts_, span), "repeats-windows")
    earliest = staged(windows.groupBy("name", "window").agg(F.min(place).alias("first"), F.count("*").alias("rows")).filter("rows > 1").drop("rows"), "repeats-earliest")
    others = windows.join(earliest, ["name", "window"]).filter(place != F.col("first")).select("key", "digest", "start", F.lit(1).alias("n"))
    return copies.union(others)


def _kept(span: int):
    def make(column: pa.Array) -> list:
        out = {"n_words": [], "n_removed": [], "kept": [], "spans": []}
        for row in column:
            text, marks = row["text"].as_py(), row["marks"].as_py()
            found = (text or "").encode().split()  # at space and the control characters from tab to carriage return
            spans = []
            for start, n in sorted((m["start"], m["n"]) for m in marks or ()):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], start + n + span - 1)
                else:
                    spans.append([start, start + n + span - 1])
            left, at = [], 0
            for start, end in spans:
                left += found[at:start]
                at = end
            left += found[at:]
            out["n_words"].append(len(found))
            out["n_removed"].append(len(found) - len(left))
            out["kept"].append(b" ".join(left).decode())
            out["spans"].append([{"start": a, "end": b} for a, b in spans])
        return [pa.StructArray.from_arrays([pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string()),
                                            pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                                           names=list(out))]
    return make


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "repeats", span: int = SPAN, rounds: int = ROUNDS) -> DataFrame:
    """`docs` with a struct `name`: n_words, n_removed, kept (the words left, joined by a space) and spans (of words removed, end exclusive)."""
    if name in docs.columns:
        raise ValueError(f"there is a column {name}")
    rest = [c for c in docs.columns if c != text]
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    bare = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.col(text).alias("text"))
    marks = staged(repeats(bare, span, rounds).groupBy("key", "digest").agg(F.collect_list(F.struct("start", "n")).alias("marks")), "repeats-marks")
    whole = docs.select(F.struct(*rest, F.lit(0).alias("_none_")).alias("row"), F.col(key).alias("key"), digest.alias("digest"), F.col(text).alias("text"))
    sifted = _sifted(whole, marks)
    some = sifted.filter("possible")
    joined = some.join(marks, _same(some, marks), "left").select("row", F.struct("text", "marks").alias("work"))
    both = sifted.filter("not possible").select("row", F.struct("text", F.lit(None).cast(marks.schema["marks"].dataType).alias("marks")).alias("work")).union(joined)
    made = added(both, "result struct<n_words: long, n_removed: long, kept: string, spans: array<struct<start: int, end: int>>>", "work", _kept(span))
    return made.select(*(F.col("work.text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns), F.col("result").alias(name))
