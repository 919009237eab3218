"""Benchmark items inside documents, up to a fifth of their words inserted, dropped or replaced.

Words are runs of letters and digits, in lower case. The search follows the CGK embedding: two strings walk along
shared random bits, one output a step, and a step moves on by one word or none, as a random bit of the word read says.
Strings at a small edit distance then agree in most outputs. A window of the document starts at each of its words; so
does one at each word of an item, for as long as the walk stays inside the item. A key is a sample of the outputs, and
independent walks give as many keys. Equal keys propose where the item as a whole lies in the document, and the
edit distance over words decides: at most SHARE of the item's words, rounded down.

Steps and number of walks follow from the item's length, SHARE and RECALL. Edits are worst spaced evenly: they leave the
shortest clean stretches. A walk from the first word of a stretch reads only clean words if it moves less often than the
stretch has words, a binomial chance; stretches and walks are independent. Each length takes the most steps with which
REPEATS walks or fewer miss all stretches at a chance of 1 - RECALL at most. An item with a single word is looked up by it.

Null and empty documents and items without a word match nothing. Equal items are reported each; of several places of one
item in a document the closest, then the first is. Items are taken in blocks of about BLOCK words, in the order of item
and text: a block is read by the driver, travels with the tasks of one pass over the documents and is let go. So driver and
tasks hold one block whatever the size of the benchmark; between two passes the documents are written with what was found.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm import words
from hazegrid.llm.columns import added, fresh
from hazegrid.llm.staging import staged

#: Part of an item's words that may differ.
SHARE = 0.2
#: Least chance that an item with as many edits as allowed is proposed, however they lie.
RECALL = 0.999
#: Independent walks, and the steps of a walk, at most.
REPEATS, STEPS = 8, 16
#: Proposals looked at together. Memory only.
CANDIDATES = 1 << 18
#: Words of benchmark items in a block, about; the item that fills a block ends it.
BLOCK = 2_000_000

#: Outputs of each walk that go into its key: all of the first four, later every other one by chance.
_SAMPLED = np.random.Generator(np.random.PCG64(5)).random((REPEATS, STEPS)) < 0.5
_SAMPLED[:, :4] = True
_KEY = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _blank(data: np.ndarray) -> np.ndarray:
    """Bytes that aren't part of a letter or digit: ASCII signs, and the blocks of Latin, general and CJK punctuation."""
    blank = ~_WORD_BYTE[data]
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE2) | (data == 0xE3))
    if len(lead):
        wide = lead[data[lead] != 0xC2]
        wide = wide[wide + 2 < len(data)]
        wide = wide[(data[wide + 1] == 0x80) | (data[wide + 1] == 0x81) & (data[wide] == 0xE2)]
        narrow = lead[data[lead] == 0xC2]
        narrow = narrow[narrow + 1 < len(data)]
        for at, size in ((wide, 3), (narrow, 2)):
            for k in range(size):
                blank[at + k] = True
    return blank


def _missed(n: int, steps: int) -> float:
    """Chance, at most, that one walk of so many steps misses an item of n words whose allowed edits are spaced evenly."""
    edits = int(SHARE * n)
    least, longer = divmod(n - edits, edits + 1)
    clean = [sum(math.comb(steps - 1, k) for k in range(min(size, steps))) / 2 ** (steps - 1) for size in (least, least + 1)]
    return (1 - clean[0]) ** (edits + 1 - longer) * (1 - clean[1]) ** longer


@functools.lru_cache(None)
def _plan(n: int) -> tuple[int, int]:
    """Steps and number of the walks over an item of n words: they read n words at most, and RECALL holds."""
    steps = 1 << (min(n, STEPS).bit_length() - 1)
    while steps > 1 and _missed(n, steps) ** REPEATS > 1 - RECALL:
        steps //= 2
    return steps, next(k for k in range(1, REPEATS + 1) if k == REPEATS or _missed(n, steps) ** k <= 1 - RECALL)


def _walks(tokens: np.ndarray, starts: np.ndarray, repeat: int, wanted: set[int]):
    """Keys of the walks from `starts` after each wanted number of steps, and the last word read. Needs STEPS words beyond each start."""
    at = starts.copy()
    coins = words.mixed(tokens + np.uint64((repeat + 1) * int(_KEY) & (1 << 64) - 1))
    key = np.full(len(starts), repeat + 1, np.uint64)
    for step in range(max(wanted)):
        word = tokens[at]
        if _SAMPLED[repeat, step]:
            key = (key ^ word) * _KEY
            key ^= key >> np.uint64(29)
        if step + 1 in wanted:
            yield step + 1, key, at
        at = at + ((coins[at] >> np.uint64(step)) & _ONE).astype(np.int64)


class Items:
    """Keys of a block of items, for each number of steps and each walk."""

    def __init__(self, texts: list[str | None]):
        self.words: list[np.ndarray] = []
        for _, data, ends in words.texts(pc.utf8_lower(pa.array(texts, pa.large_string()))):
            hashes, _, rows = words.words(data, ends, _blank(data))
            self.words += [hashes[rows[k]:rows[k + 1]].copy() for k in range(len(rows) - 1)]
        found = defaultdict(list)
        for item, own in enumerate(self.words):
            if not len(own):
                continue
            steps, repeats = _plan(len(own))
            padded = np.append(own, np.zeros(STEPS + 1, np.uint64))
            for repeat in range(repeats):
                for _, key, last in _walks(padded, np.arange(len(own)), repeat, {steps}):
                    inside = np.flatnonzero(last < len(own))
                    found[steps, repeat].append((key[inside], np.full(len(inside), item), inside))
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        # Whether an item has a word, by a hash of both; a false yes only costs time.
        pairs = np.concatenate([w + k for w, k in zip(self.words, self.marks(np.arange(len(self.words))), strict=True)] or [np.zeros(0, np.uint64)])
        self.shift = np.uint64(64 - min(24, max(16, len(pairs).bit_length() + 4)))
        self.has = np.zeros(1 << (64 - int(self.shift)), bool)
        self.has[words.mixed(pairs) >> self.shift] = True
        self.tables = {}
        for kind, parts in found.items():
            keys, items, offsets = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            bits = min(24, max(16, int(len(keys)).bit_length() + 5))
            seen = np.zeros(1 << bits, bool)
            seen[keys >> np.uint64(64 - bits)] = True
            self.tables[kind] = keys[order], items[order], offsets[order], seen, np.uint64(64 - bits)
        self.steps = {repeat: {s for s, r in self.tables if r == repeat} for _, repeat in self.tables}

    def proposed(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and the words of the document where they would start, for all equal keys."""
        padded = np.append(tokens, np.zeros(STEPS + 1, np.uint64))
        starts = np.arange(len(tokens))
        items, begins = [], []
        for repeat, wanted in self.steps.items():
            for steps, key, _ in _walks(padded, starts, repeat, wanted):
                keys, owner, offset, seen, shift = self.tables[steps, repeat]
                hit = np.flatnonzero(seen[key >> shift])
                if not len(hit):
                    continue
                lo, hi = np.searchsorted(keys, key[hit], "left"), np.searchsorted(keys, key[hit], "right")
                n = hi - lo
                which = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                items.append(owner[which])
                begins.append(np.repeat(hit, n) - offset[which])
        if not items:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(items), np.concatenate(begins)

    @staticmethod
    def marks(items: np.ndarray) -> np.ndarray:
        return words.mixed(items.astype(np.uint64) + _ONE)

    def likely(self, tokens: np.ndarray, item: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of proposals, each once, those around which as many of the item's words stand as a match needs."""
        both = np.unique(item * (2 * len(tokens) + 2 * int(self.sizes.max(initial=0))) + begin + int(self.sizes.max(initial=0)))
        item, begin = np.divmod(both, 2 * len(tokens) + 2 * int(self.sizes.max(initial=0)))
        begin -= int(self.sizes.max(initial=0))
        kept = []
        for at in range(0, len(item), CANDIDATES):
            which = np.arange(at, min(at + CANDIDATES, len(item)))
            size = self.sizes[item[which]]
            slack = (SHARE * size).astype(np.int64)
            first, width, mark = begin[which] - slack, size + 2 * slack, self.marks(item[which])
            # Words that may still be missing; who has run out of them is out.
            spare = width - (size - slack)
            for k in range(int(width.max())):
                place = first + k
                inside = (place >= 0) & (place < len(tokens))
                there = self.has[words.mixed(tokens[np.where(inside, place, 0)] + mark) >> self.shift] & inside
                spare = spare - (~there & (k < width))
                if k % 8 == 7:
                    left = spare >= 0
                    which, first, width, mark, spare = which[left], first[left], width[left], mark[left], spare[left]
                    if not len(which):
                        break
            kept.append(which[spare >= 0])
        which = np.concatenate(kept)
        return item[which], begin[which]


def placed(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of an item to any stretch of a text, in words, and that stretch: of equals the one that ends first, then the longest."""
    m = len(text)
    at = np.arange(m + 1)
    row, origin = np.zeros(m + 1, np.int64), at.copy()
    # Distance and origin in one number: the smaller origin wins among equals.
    base = m + 2
    state = row * base + origin
    for k, word in enumerate(item):
        down = state + base
        step = np.empty(m + 1, np.int64)
        step[0] = (k + 1) * base
        step[1:] = np.minimum(down[1:], state[:-1] + np.where(text == word, 0, base))
        state = np.minimum.accumulate(step - at * base) + at * base
    end = int(np.argmin(state // base))
    return int(state[end] // base), int(state[end] % base), end


def found(items: Items, tokens: np.ndarray, rows: np.ndarray):
    """(row, item, distance, first word, end word) of every match in a piece of documents; words are counted in the piece."""
    item, begin = items.proposed(tokens)
    if not len(item):
        return
    item, begin = items.likely(tokens, item, begin)
    # A walk from a word of one row may read words of the next: the start tells the row.
    sizes = items.sizes
    middle = np.clip(begin, 0, max(len(tokens) - 1, 0))
    candidates = set()
    for at in (middle, np.clip(begin + sizes[item] - 1, 0, max(len(tokens) - 1, 0)), np.clip(begin + sizes[item] // 2, 0, max(len(tokens) - 1, 0))):
        row = np.searchsorted(rows, at, "right") - 1
        candidates |= set(zip(row.tolist(), item.tolist(), begin.tolist(), strict=True))
    places = defaultdict(list)
    for row, i, b in candidates:
        places[row, i].append(b)
    for (row, i), starts in sorted(places.items()):
        own, lo, hi = items.words[i], int(rows[row]), int(rows[row + 1])
        slack = int(SHARE * len(own))
        best = None
        starts.sort()
        k = 0
        while k < len(starts):
            first = last = starts[k]
            while k + 1 < len(starts) and starts[k + 1] <= last + slack + 1:
                k += 1
                last = starts[k]
            k += 1
            if lo <= first and first + len(own) <= hi and np.array_equal(tokens[first:first + len(own)], own):
                result = 0, first, first + len(own)
            else:
                a, b = max(lo, first - slack), min(hi, last + len(own) + slack)
                if b - a < len(own) - slack:
                    continue
                distance, s, e = placed(own, tokens[a:b])
                result = distance, a + s, a + e
            if result[0] <= slack and (best is None or result < best):
                best = result
        if best:
            yield row, i, *best


def _blocks(rows: DataFrame):
    """(ids, texts) of each block of `rows` (item, text), in order; one empty block if there is no row."""
    ids, texts, size, any_yet = [], [], 0, False
    # Spark hands over one partition of the sorted items after another.
    for r in rows.orderBy("item", "text").toLocalIterator():
        ids.append(r.item)
        texts.append(r.text)
        size += len((r.text or "").split())
        if size >= BLOCK:
            yield ids, texts
            ids, texts, size, any_yet = [], [], 0, True
    if ids or not any_yet:
        yield ids, texts


def _marked(df: DataFrame, text: str, name: str, kind: str, ids: list, items: Items) -> DataFrame:
    """`df` with the matches of one block in the column `name`."""
    def make(column: pa.Array) -> list:
        out: list[list] = [[] for _ in range(len(column))]
        for first, data, ends in words.texts(pc.utf8_lower(column.cast(pa.large_string()))):
            blank = _blank(data)
            hashes, starts, bounds = words.words(data, ends, blank)
            for row, k, distance, a, b in found(items, hashes, bounds):
                at, last = int(starts[a]), int(starts[b - 1]) if b > a else int(starts[a])
                end = int(ends[row + 1])
                gap = np.flatnonzero(blank[last:end])
                end = last + int(gap[0]) if len(gap) else end
                # Continuation bytes aren't code points.
                chars = lambda x, y: int(np.count_nonzero((data[x:y] & 0xC0) != 0x80))
                start = chars(int(ends[row]), at)
                out[first + row].append((ids[k], distance, len(items.words[k]), start, start + chars(at, end)))
        return [[[dict(zip(("item", "distance", "n_words", "start", "end"), x, strict=True)) for x in own] for own in out]]

    return added(df, f"`{name}` array<struct<item: {kind}, distance: long, n_words: long, start: long, end: long>>", text, make)


def with_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
               name: str = "leaks") -> DataFrame:
    """`df` with the column `name`: for each row the benchmark items in its text, by item order, as
    array<struct<item, distance, n_words, start, end>>; places are code points, the end exclusive."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    out = None
    for ids, texts in _blocks(rows):
        if out is None:
            out = _marked(df, text, name, kind, ids, Items(texts))
        else:
            # What is found so far is written: no task holds two blocks, and none is searched twice.
            out = staged(out, "leaks")
            more, = fresh(out, "_more")
            out = _marked(out, text, more, kind, ids, Items(texts)).withColumn(name, F.concat(F.col(f"`{name}`"), F.col(more))).drop(more)
    return out
