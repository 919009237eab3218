"""Extremely randomised trees that predict several labels at once, grown level by level from sums over the rows.

Of every open node some features are drawn and, between the least and largest value that a feature has in the node, a cut for each; the
best cut is the one that leaves the least variance of all labels together. A level takes two passes over the rows: the ranges of the drawn features,
then, for each cut, number and label sums of what lies below it. Tasks find a row's node in every tree from the trees themselves and add up; what is moved
are sums of nodes, never rows. The choice of the best cut is made by Spark, so the driver gets one row for each node that is split.

Trees are independent, so they are grown in blocks whose open nodes fit `BUDGET`. Draws follow from seed, block and level
alone, so a forest does not depend on how the rows are partitioned, but for the order in which doubles are added.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, functions as F

#: Bytes of the sums of a block's open nodes, in a task and at the driver.
BUDGET = 256 << 20
SMALLEST_SPLIT = 3


@dataclass
class Forest:
    """Trees as flat arrays: of a node its feature (-1 in a leaf), cut, first child (the second follows it) and mean of each label."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @property
    def size(self) -> int:
        return sum(a.nbytes for a in (self.roots, self.feature, self.cut, self.left, self.value))

    def predicted(self, x: np.ndarray) -> np.ndarray:
        """Means over the trees, a column for each label."""
        out = np.zeros((len(x), self.value.shape[1]))
        for root in self.roots:
            out += self.value[leaves(x, root, self.feature, self.cut, self.left)]
        return out / len(self.roots)

    def nodes(self) -> list[tuple]:
        """A row for each node: number, feature, cut, left, value; and -1, root of each tree as rows of feature -2."""
        return [(int(r), -2, 0.0, -1, []) for r in self.roots] + [
            (i, int(f), float(c), int(l), v.tolist()) for i, (f, c, l, v) in enumerate(zip(self.feature, self.cut, self.left, self.value))]


NODES = "node int, feature int, cut double, left int, value array<double>"


def from_nodes(rows) -> Forest:
    own = sorted(r for r in rows if r["feature"] != -2)
    return Forest(np.array(sorted(r["node"] for r in rows if r["feature"] == -2)), np.array([r["feature"] for r in own]),
                  np.array([r["cut"] for r in own]), np.array([r["left"] for r in own]), np.array([r["value"] for r in own]))


def leaves(x: np.ndarray, root: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node of one tree that each row comes to."""
    node = np.full(len(x), root, np.int64)
    at = np.arange(len(x))
    while len(at):
        at = at[feature[node[at]] >= 0]
        here = node[at]
        node[at] = left[here] + (x[at, feature[here]] > cut[here])
    return node


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class _Grown:
    """Growing trees of a block. `labels` of forest f are the f-th part of y."""

    def __init__(self, forests: int, trees: int, labels: int):
        n = forests * trees
        self.labels = labels
        self.forest = np.repeat(np.arange(forests), trees)  # of each tree
        self.tree = np.arange(n)  # of each node; the roots come first
        self.feature, self.cut, self.left = np.full(n, -1), np.zeros(n), np.full(n, -1)
        self.value = np.zeros((n, labels))
        self.open = np.arange(n)

    def visitor(self, drawn: np.ndarray):
        """For a task: calls `use(slots, x values, y)` with the rows of every tree that are in an open node."""
        number = np.full(len(self.feature), -1)
        number[self.open] = np.arange(len(self.open))
        feature, cut, left, forest, m = self.feature, self.cut, self.left, self.forest, self.labels
        inside = set(self.tree[self.open].tolist())

        def visit(batch: pa.RecordBatch, use) -> None:
            x, y = _matrix(batch.column(0)), _matrix(batch.column(1))
            for tree in inside:
                node = number[leaves(x, tree, feature, cut, left)]
                rows = np.flatnonzero(node >= 0)
                if len(rows):
                    own = node[rows]
                    use(own, x[rows[:, None], drawn[own]], y[rows, forest[tree] * m:(forest[tree] + 1) * m])

        return visit

    def ranges(self, ready: DataFrame, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest value of each drawn feature in each open node."""
        visit, shape = self.visitor(drawn), drawn.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = np.full(shape, np.inf), np.full(shape, -np.inf)

            def use(own, x, y):
                np.minimum.at(low, own, x)
                np.maximum.at(high, own, x)

            for batch in batches:
                visit(batch, use)
            some = np.flatnonzero(low <= high)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(low.ravel()[some]), pa.array(high.ravel()[some])], names=["slot", "low", "high"])

        found = ready.mapInArrow(run, "slot long, low double, high double").groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
        low, high = np.zeros(drawn.size), np.zeros(drawn.size)
        slot = found["slot"].to_numpy()
        low[slot], high[slot] = found["low"].to_numpy(), found["high"].to_numpy()
        return low.reshape(shape), high.reshape(shape)

    def best(self, ready: DataFrame, drawn: np.ndarray, cuts: np.ndarray, usable: np.ndarray) -> pa.Table:
        """Of each open node its best cut: slot, number and label sums below it (n0, a0, a1, ..) and in the whole node (n, b0, ..)."""
        visit, (nodes, k), m = self.visitor(drawn), drawn.shape, self.labels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            below, whole = np.zeros((nodes * k, m + 1)), np.zeros((nodes, m + 1))

            def use(own, x, y):
                first, last = own.min(), own.max() + 1
                under = (x <= cuts[own]).astype(float)
                slot = ((own - first)[:, None] * k + np.arange(k)).ravel()
                size = (last - first) * k
                below[first * k:last * k, 0] += np.bincount(slot, under.ravel(), size)
                whole[first:last, 0] += np.bincount(own - first, minlength=last - first)
                for j in range(m):
                    below[first * k:last * k, j + 1] += np.bincount(slot, (under * y[:, j:j + 1]).ravel(), size)
                    whole[first:last, j + 1] += np.bincount(own - first, y[:, j], last - first)

            for batch in batches:
                visit(batch, use)
            some = np.flatnonzero(usable.ravel() & (np.repeat(whole[:, 0], k) > 0))
            yield pa.RecordBatch.from_arrays([pa.array(some)] + [pa.array(below[some, j]) for j in range(m + 1)] + [pa.array(whole[some // k, j]) for j in range(m + 1)],
                                             names=["slot", "n0", *(f"a{j}" for j in range(m)), "n", *(f"b{j}" for j in range(m))])

        columns = ["n0", *(f"a{j}" for j in range(m)), "n", *(f"b{j}" for j in range(m))]
        sums = ready.mapInArrow(run, "slot long, " + ", ".join(f"{c} double" for c in columns)).groupBy("slot").agg(*(F.sum(c).alias(c) for c in columns))
        # The variance left is least where these squares are largest.
        squares = " + ".join(f"a{j} * a{j} / n0 + (b{j} - a{j}) * (b{j} - a{j}) / (n - n0)" for j in range(m))
        order = F.struct(F.expr(squares).alias("score"), (-F.col("slot")).alias("first"))
        return sums.filter("n0 > 0 and n0 < n").groupBy(F.expr(f"slot div {k}").alias("node")) \
            .agg(F.max_by(F.struct("slot", *columns), order).alias("s")).select("s.*").toArrow()

    def totals(self, ready: DataFrame) -> np.ndarray:
        """Number of rows and mean of each label; the value of every root."""
        width = self.labels * (int(self.forest.max()) + 1)
        row = ready.agg(F.count("*").alias("n"), *(F.avg(F.col("y")[j]).alias(f"m{j}") for j in range(width))).head()
        means = np.array([row[f"m{j}"] or 0.0 for j in range(width)]).reshape(-1, self.labels)
        self.value[:] = means[self.forest]
        return row["n"]

    def split(self, found: pa.Table, drawn: np.ndarray, cuts: np.ndarray, smallest: int) -> None:
        m = self.labels
        found = found.sort_by("slot")
        slot = found["slot"].to_numpy()
        nodes = self.open[slot // drawn.shape[1]]
        first = len(self.feature) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.left[nodes] = drawn.ravel()[slot], cuts.ravel()[slot], first
        n0, n = found["n0"].to_numpy(), found["n"].to_numpy()
        a = np.stack([found[f"a{j}"].to_numpy() for j in range(m)], axis=1).reshape(-1, m)
        b = np.stack([found[f"b{j}"].to_numpy() for j in range(m)], axis=1).reshape(-1, m)
        rows = np.stack([n0, n - n0], axis=1).ravel()
        values = np.stack([a / n0[:, None], (b - a) / (n - n0)[:, None]], axis=1).reshape(-1, m)
        new = len(self.feature) + np.arange(2 * len(nodes))
        self.tree = np.append(self.tree, np.repeat(self.tree[nodes], 2))
        self.feature = np.append(self.feature, np.full(len(new), -1))
        self.cut, self.left = np.append(self.cut, np.zeros(len(new))), np.append(self.left, np.full(len(new), -1))
        self.value = np.concatenate([self.value, values])
        self.open = new[rows >= smallest]

    def forests(self) -> list[Forest]:
        return [Forest(np.flatnonzero(self.forest == f), self.feature, self.cut, self.left, self.value) for f in range(int(self.forest.max()) + 1)]


def _only(forest: Forest) -> Forest:
    """The nodes that the roots reach, numbered anew."""
    found = list(forest.roots)
    for node in found:
        if forest.feature[node] >= 0:
            found += [forest.left[node], forest.left[node] + 1]
    # Children stand together: breadth first keeps their order.
    number = np.full(len(forest.feature), -1)
    number[found] = np.arange(len(found))
    left = forest.left[found]
    return Forest(np.arange(len(forest.roots)), forest.feature[found], forest.cut[found], np.where(left >= 0, number[left], -1), forest.value[found])


def joined(parts: list[Forest]) -> Forest:
    """One forest of all trees."""
    at = np.cumsum([0] + [len(p.feature) for p in parts])
    return Forest(np.concatenate([p.roots + a for p, a in zip(parts, at)]), np.concatenate([p.feature for p in parts]), np.concatenate([p.cut for p in parts]),
                  np.concatenate([np.where(p.left >= 0, p.left + a, -1) for p, a in zip(parts, at)]), np.concatenate([p.value for p in parts]))


def fit(ready: DataFrame, features: int, labels: int, forests: int = 1, trees: int = 200, depth: int = 30, subset: int | None = None,
        smallest: int = SMALLEST_SPLIT, seed: int = 42) -> list[Forest]:
    """Forests over rows (x array<double>, y array<double>) without nulls, read often: a written table. y holds `labels` values for each forest.

    subset: features drawn for a node, the root of their number if not given.
    """
    subset = subset or max(1, int(np.sqrt(features)))
    n = ready.count()
    widest = min(2 ** min(depth, 40), max(n, 1))
    block = max(1, BUDGET // (widest * subset * (labels + 1) * 16 * forests))
    parts: list[list[Forest]] = [[] for _ in range(forests)]
    for number, at in enumerate(range(0, trees, block)):
        grown = _Grown(forests, min(block, trees - at), labels)
        grown.totals(ready)
        for level in range(depth if n >= smallest else 0):
            if not len(grown.open):
                break
            rng = np.random.default_rng([seed, number, level])
            drawn = np.argsort(rng.random((len(grown.open), features)), axis=1)[:, :subset]
            low, high = grown.ranges(ready, drawn)
            cuts = low + rng.random(drawn.shape) * (high - low)
            cuts = np.where(cuts >= high, low, cuts)
            grown.split(grown.best(ready, drawn, cuts, low < high), drawn, cuts, smallest)
        for own, forest in zip(parts, grown.forests()):
            own.append(_only(forest))
    return [joined(own) for own in parts]


register_pickle_by_value(sys.modules[__name__])  # tasks get the functions themselves and needn't import them
