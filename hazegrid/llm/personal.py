"""Personal data in whole texts: e-mail and IP addresses, payment card and phone numbers.

Base spans follow fixed rules, leftmost and without overlap for each kind; a match that fails its test is dropped and
not tried again. Generators with high recall then propose further, overlapping spans: addresses written with `(at)` and
`dot`, quads in brackets or inside longer dotted numbers, stretches of grouped digits. Boosted trees judge format and context of every
proposal, and those that pass and touch no base span of any kind are added, the likeliest first.

The trees learn what the base rules miss. In all texts every base span is rewritten where it stands, in forms that the
rules don't know (`rewritten`: spelled addresses, national numbers, other separators): the span of the new form is right, all else
that is proposed there is wrong. In the same places stand things that only look alike (`lookalikes`: prices, versions, dates, order and serial
numbers): all proposals there are wrong. Other proposals of the texts teach nothing, as nobody knows what they are. A threshold for each kind is set on a part that the
trees haven't seen: down to the last likelihood at which still PRECISION of the proposals are right. Equal rows of features and label are one row
whose weight is their number, so the trees' table grows with the forms that spans have and not with the texts.

Null and empty texts have no spans; repeated rows have the same. Without base spans of a kind nothing of that kind is learned or added. Other columns stay, whatever their names; one named as the new column is replaced.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.columns import added, sliced
from hazegrid.llm.staging import spread, staged
from hazegrid.session import scratch

#: Kinds in the order of their listing.
KINDS = ("email", "ip", "card", "phone")
#: Rounds and depth of the trees; share of right ones at every likelihood that passes; parts of the likelihood; share of the places that thresholds come from.
ROUNDS, DEPTH, PRECISION, BINS, HELD = 30, 5, 0.95, 20, 0.3

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its first digit fails from all others.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_SPELLED = re.compile(r"[\x20]?(?:\(at\)|\[at\]|\{at\}|[\x20]at[\x20])[\x20]?([A-Za-z0-9-]+(?:(?:[\x20]?(?:\(dot\)|\[dot\]|[\x20]dot[\x20])[\x20]?|\.)[A-Za-z0-9-]+)+)", re.I)
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
_OPEN = re.compile(r"[0-9]+(?:[\x20]?[\[({]?(?:\.|dot)[\])}]?[\x20]?[0-9]+){3}")
_GROUPED = re.compile(r"\+?\(?[0-9](?:[\x20()./-]{0,2}[0-9])+")
_GROUP = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The sign first: the local part is the run before it, back to the last match, so no run is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = at + 1
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", done)


def base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) that might be personal data, besides the base spans."""
    done = 0
    for m in _SPELLED.finditer(text) if "at" in text or "AT" in text else ():
        start = done + len(text[done:m.start()].rstrip(_LOCAL))
        done = m.end()
        if start < m.start():
            yield 0, start, m.end()
    if not _DIGIT.search(text):
        return
    for m in _DOTTED.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in _GROUP.finditer(m.group())]
        for k in range(len(groups) - 3):
            yield 1, groups[k][0], groups[k + 3][1]
    for m in _OPEN.finditer(text):
        yield 1, m.start(), m.end()
    for m in _GROUPED.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in _GROUP.finditer(m.group())]
        for k in range(len(groups)):
            size = 0
            for a, b in groups[k:k + 20]:  # a group has a digit, and 19 are the most
                size += b - a
                if size > 19:
                    break
                start = groups[k][0]
                if size >= 12:
                    yield 2, start, b
                if 7 <= size <= 15:
                    # A sign or bracket before the first group belongs to a phone number.
                    lead = text[max(m.start(), start - 2):start]
                    yield 3, start - (len(lead) - len(lead.rstrip("+("))), b


_AT, _DOT = re.compile(r"[(\[{]at[)\]}]", re.I), re.compile(r"[(\[{\x20]dot[)\]}\x20]", re.I)
#: What belongs to the same number on either side.
_BEFORE, _AFTER = re.compile(r"[0-9\x20().+/-]*\Z"), re.compile(r"[0-9\x20().+/-]*")
#: A word before a number that says what it is.
_NAMED = re.compile(r"(?:\b(?:no|nr|id|order|item|version|serial|total|price|isbn|on)[.:]?|\bv)[\x20]?$", re.I)
#: Context: characters looked at on either side.
_NEAR = 24
#: Places whose proposals a task holds before it hands them on. Memory only.
TAUGHT = 256


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - _NEAR):start], text[end:end + _NEAR]
    groups = [len(g) for g in _GROUP.findall(span)]
    digits = _digits(span)
    parts = [int(g[:6]) for g in _GROUP.findall(span)] if kind == 1 else []
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        float(end - start), float(len(digits)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(luhn(digits)) if len(digits) >= 12 else -1.0, float(max(parts, default=-1)),
        float(span.count(".")), float(span.count(" ")), float(span.count("-")), float(span.count("(")), float(span[:1] == "+"),
        float("@" in span), float(before[-1:].isdigit()), float(before[-1:].isalpha()), float(before[-1:] in list("._+-@/")),
        float(after[:1].isdigit()), float(after[:1].isalpha()), float(after[:1] in list("-@/")),
        float(span.count("/")), float(span.count("[") + span.count("{")), float(span.count("  ")), float(span.lstrip("(")[:1] == "0"), float(span.lstrip("(")[:2] == "00"),
        float(bool(_AT.search(span))), float(bool(_DOT.search(span))), float(bool(_NAMED.search(before))), float(before.rstrip()[-1:] in list("#$€£=:")),
        float(after.lstrip()[:1] in list("%$€£:")), float(after[:1] in list(",:/") and after[1:2].isdigit()), float(before[-1:] in list(",:/") and before[-2:-1].isdigit()),
        float(after[:2][:1] == "." and after[1:2].isalnum()), float(len(_digits(_BEFORE.search(before).group()))), float(len(_digits(_AFTER.match(after).group()))),
    ]


WIDTH = len(features("", 0, 0, 0))


def rewritten(kind: int, span: str) -> list[str]:
    """Forms of a base span that the base rules miss."""
    groups, digits = _GROUP.findall(span), _digits(span)
    if kind == 0:
        name, _, domain = span.rpartition("@")
        parts = domain.split(".")
        return [f"{name} (at) {domain}", f"{name}[at]{'[dot]'.join(parts)}", f"{name} at {' dot '.join(parts)}", f"{name} (at) {' dot '.join(parts)}",
                f"{name} [at] {' [dot] '.join(parts)}", f"{name}(at){domain}", f"{name} {{at}} {' dot '.join(parts)}"]
    if kind == 1:
        return [mark.join(groups) for mark in ("[.]", "(.)", " . ", " [.] ", "{.}", " dot ")]
    if kind == 2:
        fours = [digits[k:k + 4] for k in range(0, len(digits), 4)]
        return [mark.join(fours) for mark in (".", "/", "  ", "--")] + [" / ".join(fours).replace(" / ", " /"), "  ".join(digits)]
    own = digits[-10:].rjust(10, "5")  # without the country
    area, first, last = own[:3], own[3:6], own[6:]
    return [f"0{area} {first} {last}", f"(0{area}) {first}{last}", f"0{area}/{first}{last}", f"0{area}-{first}-{last}", f"00{digits[:2]} {area} {first} {last}",
            f"({area}) {first}-{last}", f"0{area} {first[:2]} {first[2:]}{last[:1]} {last[1:]}", f"0{own}"]


def lookalikes(kind: int, span: str) -> list[str]:
    """What looks like personal data and isn't, with the digits of a base span."""
    if kind == 0:
        name, _, domain = span.rpartition("@")
        return [f"sold at {domain}", f"{name} at {domain}", f"look at {name.replace('.', ' dot ')}", f"{name} (at) noon", f"5 at {domain.split('.')[0]}"]
    d = (_digits(span) * 4 + "4093857261")[:24]
    wrong = d[:15] + next(c for c in "0123456789" if not luhn(d[:15] + c))
    return [f"{int(d[:1]) + 1}.{d[1:4]}.{d[4:7]}", f"{d[:3]} {d[3:6]} {d[6:9]}", f"{int(d[:2])},{d[2:5]}.{d[5:7]}", f"${d[:3]},{d[3:6]},{d[6:9]}", f"EUR {int(d[:1]) + 1}.{d[1:4]}.{d[4:7]},{d[7:9]}",
            f"v{int(d[0])}.{int(d[1:3])}.{int(d[3:6]) + 300}.{int(d[6])}", f"version {int(d[0])}.{int(d[1])}.{int(d[2])}.{int(d[3:5])}.{int(d[5:8])}",
            f"20{d[:2]}-0{d[2]}-1{d[3]} 1{d[4]}:2{d[5]}:3{d[6]}", f"1{d[0]}/0{int(d[1])}/20{d[2:4]} 1{d[4]}:{d[5:7]}", f"no. {d[:11]}", f"id {d[:12]}", f"order {d[:5]}-{d[5:12]}", wrong,
            f"{wrong[:4]} {wrong[4:8]} {wrong[8:12]} {wrong[12:]}", f"{wrong[:4]}.{wrong[4:8]}.{wrong[8:12]}.{wrong[12:]}", f"978-{d[0]}-{d[1:3]}-{d[3:9]}-{d[9]}", f"{d[:4]}-{d[4:8]}", f"{d[:7]}",
            f"{int(d[:3]) + 256}.{d[3:6]}.{d[6:9]}.{d[9:12]}", f"{d[:2]} . {d[2:4]}", f"{int(d[0]) + 1} {d[1:4]} {d[4:7]} {d[7:10]}", f"#{d[:9]}", f"{d[:10]}", f"1{d[:18]}", f"{d[:3]}/{d[3:6]}/{d[6:9]}"]


def places(text: str) -> Iterator[tuple[int, str, str, str]]:
    """Kind of each base span of a text, what stands before it, the span, and what stands after it."""
    reach = 4 * _NEAR
    for kind, a, b in base(text):
        yield kind, text[max(0, a - reach):a], text[a:b], text[b:b + reach]


def lessons(kind: int, before: str, span: str, after: str) -> set[tuple[tuple[float, ...], float]]:
    """Features and label of the proposals in the place of a base span, which is rewritten and replaced; equal ones count once."""
    out = set()
    for forms, right in ((rewritten, 1.0), (lookalikes, 0.0)):
        for form in forms(kind, span):
            made = before + form + after
            lo, hi = len(before), len(before) + len(form)
            known = base(made)
            if any(x < hi and y > lo for _, x, y in known):
                continue  # the base rules know it
            for proposal in set(proposals(made)):
                if proposal[1] < hi and proposal[2] > lo:
                    out.add((tuple(features(made, *proposal)), right * float(proposal == (kind, lo, hi))))
    return out


@dataclass
class Trees:
    """Boosted trees as arrays: split feature (-1 for a leaf), threshold, children and value of each node; roots and weights of the trees."""
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: list[int] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    limits: tuple[float, ...] = (2.0,) * len(KINDS)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for root, weight in zip(self.roots, self.weights, strict=True):
            at = np.full(len(rows), root)
            while True:
                inner = self.feature[at] >= 0
                if not inner.any():
                    break
                f = self.feature[at[inner]]
                low = rows[inner, f] <= self.threshold[at[inner]]
                at[inner] = np.where(low, self.left[at[inner]], self.right[at[inner]])
            total += weight * self.value[at]
        return 1 / (1 + np.exp(-2 * total))


def taught(docs: DataFrame, text: str = "text") -> DataFrame:
    """(held, made, label, weight): the proposals of all places of `docs`, with the number of places that have them.

    Equal places are one, so that copies of a text count once; a place is learned from or held as a whole.
    """
    def found(batches):
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            rows = [row for t in batch.column("text").to_pylist() for row in places(t)]
            kinds, *words = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), *(pa.array(w, pa.string()) for w in words)], names=["kind", "before", "span", "after"])

    def run(batches):
        for batch in (part for whole in batches for part in sliced(whole, "span")):
            for at in range(0, len(batch), TAUGHT):
                names, made, labels = [], [], []
                for kind, before, span, after in zip(*(c.to_pylist() for c in batch.slice(at, TAUGHT).columns), strict=True):
                    name = int.from_bytes(hashlib.blake2b(f"{before}\0{span}\0{after}".encode(), digest_size=7).digest(), "big")
                    for row, label in lessons(kind, before, span, after):
                        names.append(name)
                        made.append(row)
                        labels.append(label)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(made, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["place", "made", "label"])

    whole = docs.select(F.col(text).alias("text")).filter("text is not null")
    distinct = whole.mapInArrow(found, "kind int, before string, span string, after string").distinct()
    # A place is few bytes and much work: by bytes alone all would be joined into a few tasks.
    dealt = distinct.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "before", "span", "after")
    return dealt.mapInArrow(run, "place long, made array<double>, label double") \
        .groupBy((spread("place") < HELD).alias("held"), "made", "label").agg(F.count("*").cast("double").alias("weight"))


def fit(docs: DataFrame, text: str = "text") -> Trees:
    """Trees and thresholds learned from all texts."""
    data = staged(taught(docs, text), "personal").withColumn("features", array_to_vector("made"))
    sizes = {(r.held, r.label): r["count"] for r in data.groupBy("held", "label").count().collect()}
    if any((False, label) not in sizes for label in (0.0, 1.0)):
        return Trees()
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, weightCol="weight", seed=1).fit(data.filter("not held"))
    path = scratch(docs.sparkSession, "trees")
    model.save(path)
    trees = read_trees(docs.sparkSession, path, list(model.treeWeights))
    # Bins of the likelihood, a few rows whatever the corpus.
    kinds = F.array_position(F.slice("made", 1, len(KINDS)), 1.0).cast("int") - 1
    bins = data.filter("held").select(kinds.alias("kind"), "label", "weight", "made") \
        .mapInArrow(_binned(trees), "kind int, bin int, label double, weight double") \
        .groupBy("kind", "bin").agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")).collect()  # one row a part and kind
    limits = []
    for kind in range(len(KINDS)):
        own = {r.bin: r for r in bins if r.kind == kind}
        # Down to the first part of the likelihood where too many are wrong; half at least.
        passing = BINS // 2
        for part in range(passing, BINS + 1):
            if part in own and own[part].good < PRECISION * own[part].n:
                passing = part + 1
        limit = passing / BINS if any(r.good for r in own.values()) else 2.0
        limits.append(limit)
    trees.limits = tuple(limits)
    return trees


def _binned(trees: Trees):
    def run(batches):
        for batch in batches:
            rows = np.array(batch.column("made").to_pylist(), float).reshape(-1, WIDTH)
            bins = np.floor(trees.probability(rows) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(bins), batch.column("label"), batch.column("weight")], names=["kind", "bin", "label", "weight"])
    return run


def read_trees(spark, path: str, weights: list[float]) -> Trees:
    """Nodes of saved boosted trees; 2^(DEPTH+1) a tree at most."""
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    place = {(r.treeID, r.id): k for k, r in enumerate(rows)}
    leaf = [r.leftChild < 0 for r in rows]
    return Trees(
        np.array([-1 if end else r.split.featureIndex for r, end in zip(rows, leaf, strict=True)], int),
        np.array([0.0 if end else r.split.leftCategoriesOrThreshold[0] for r, end in zip(rows, leaf, strict=True)]),
        np.array([place.get((r.treeID, r.leftChild), 0) for r in rows], int), np.array([place.get((r.treeID, r.rightChild), 0) for r in rows], int),
        np.array([r.prediction for r in rows]), [place[t, 0] for t in range(len(weights))], weights)


def spans(text: str, trees: Trees) -> list[tuple[int, int, int, bool, float]]:
    """(kind, start, end, base, likelihood) of one text, by start and kind."""
    known = base(text)
    out = [(k, a, b, True, 1.0) for k, a, b in known]
    if trees.roots:
        more = sorted(set(proposals(text)) - set(known))
        taken = bytearray(len(text)) if more else b""
        for _, a, b in known if more else ():
            taken[a:b] = b"\1" * (b - a)
        more = [p for p in more if 1 not in taken[p[1]:p[2]]]
        if more:
            likely = trees.probability(np.array([features(text, *p) for p in more]))
            for j in sorted(range(len(more)), key=lambda j: (-likely[j], more[j][1] - more[j][2], more[j])):
                kind, a, b = more[j]
                if likely[j] >= trees.limits[kind] and 1 not in taken[a:b]:
                    out.append((kind, a, b, False, float(likely[j])))
                    taken[a:b] = b"\1" * (b - a)
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def find(df: DataFrame, trees: Trees, text: str = "text", name: str = "spans") -> DataFrame:
    """`df` with the column `name`: array<struct<kind, start, end, base, likelihood>> by start, then kind as listed; code points, end exclusive."""
    def make(column: pa.Array) -> list:
        return [[[{"kind": KINDS[k], "start": a, "end": b, "base": own, "likelihood": p} for k, a, b, own, p in spans(t, trees)] if t else []
                 for t in column.to_pylist()]]

    return added(df, f"`{name}` array<struct<kind: string, start: long, end: long, base: boolean, likelihood: double>>", text, make)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """`df` with every span of `text` replaced by its kind in brackets; of overlapping spans the union is replaced, under the first one's kind. Null stays null."""
    def make(column: pa.Array) -> list:
        out = []
        for t in column.to_pylist():
            if t:
                parts, at = [], 0
                for k, a, b, _, _ in spans(t, trees):
                    if a >= at:
                        parts += [t[at:a], f"[{KINDS[k].upper()}]"]
                    at = max(at, b)
                t = "".join(parts) + t[at:]
            out.append(t)
        return [pa.array(out, pa.string())]

    order = df.columns
    return added(df, f"`{text}` string", text, make).select(*order)
