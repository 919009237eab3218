"""A Merkle manifest of a dataset: a postorder append log of every group's tree, and inclusion proofs read from it.

A leaf is the digest of a row. The leaves of a group stand in order; of the nodes of a level each run of `fan` neighbours
(the last may be shorter, even one node) becomes the node above it, until one is left: the group's subroot. The subroots,
in order of their groups, are the leaves of one more tree, whose top is the root.

A tree is kept as a log in postorder: a node is appended when the last leaf below it has been. Builders are aligned: each
takes fan ** levels neighbouring nodes of one level and writes what lies above them in order of completion, without
knowing of other builders, as the place of a node follows from sizes alone (`position`): before a node whose last leaf is r come
all nodes that end before r and those of lower levels that end at r. The tops of the builders go to the next round, so a round covers `levels`
levels and a tree of n leaves takes log(n) / (levels * log(fan)) rounds.

Proofs are read from the log from top to bottom: the nodes of a builder stand in one stretch of it, where the places of a
node's siblings are computed in the same way; what lies above is a path read a round before, one row a builder.

Leaves are numbered by a range partitioning over (group, order, digest), so a group of any size is many tasks. Null groups
come first, null order values first in a group. Rows equal in group and order are ordered by digest; rows equal in that too are interchangeable,
each has its own place. An empty table has no root and gives no rows. A single leaf is its own subroot, a single subroot the root, with nothing on
the path. Columns of the input are kept under their own names where asked for, whatever they are called; a null value and an empty one have different digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hazegrid.llm.staging import staged

FAN, LEVELS = 16, 3
PATH = "array<struct<left: string, right: string>>"
#: Rows with proofs handed over at once: a proof is some kilobytes long.
ROWS = 512


def element(value: Column) -> Column:
    """A value as part of a leaf: `-` if null, else its length in bytes as text, a colon and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of a row of these values, in this order."""
    return F.sha2(F.concat(*(element(v) for v in values)).cast("binary"), 256)


def folded(path: Column, start: Column) -> Column:
    """What a leaf of digest `start` makes of the root, with the siblings of a path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def widths(n: int, fan: int) -> list[int]:
    """Numbers of nodes on the levels of a tree of n leaves."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // fan))
    return out


def position(level: int, at, n: int, fan: int):
    """Place in the log of the nodes `at` of a level, of a tree of n leaves."""
    last = np.minimum((np.asarray(at, np.int64) + 1) * fan ** level, n) - 1
    out = np.full(last.shape, -1, np.int64)
    for j in range(len(widths(n, fan))):
        out += -(-(last + 1) // fan ** j) if j <= level else last // fan ** j
    return out


# --- numbering ----------------------------------------------------------------------

def numbered(rows: DataFrame) -> DataFrame:
    """Rows (tree, place, digest, ...) with `at`, their number in their tree by place and digest, and `n`, the size of the tree."""
    order = ("tree", "place", "digest", "copy")
    copies = rows.withColumn("copy", F.monotonically_increasing_id())  # equal rows may go to several tasks
    placed = staged(staged(copies, "manifest-leaves").repartitionByRange(*order).sortWithinPartitions(*order).drop("copy", "place")
                    .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "manifest-order")
    runs = placed.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("here"))
    whole = Window.partitionBy("tree")
    runs = runs.withColumns({"before": F.sum("here").over(whole.orderBy("part")) - F.col("here"), "n": F.sum("here").over(whole)})
    return placed.join(runs.drop("here"), ["tree", "part"]).withColumn("at", F.col("before") + F.col("row") - F.col("first")) \
        .drop("part", "row", "first", "before")


# --- tasks over sorted rows ---------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (tree, block) after the other, from rows sorted by them."""
    held: list[pa.Table] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        trees, blocks = table["tree"].combine_chunks(), table["block"].to_numpy()
        codes = trees.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(codes)]
        for lo, hi in zip(cuts, cuts[1:]):
            key = (trees[lo].as_py(), int(blocks[lo]))
            if key != now and held:
                yield pa.concat_tables(held)
                held = []
            now = key
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def _builder(base: int, levels: int, fan: int, schema: pa.Schema):
    """Tasks that append what lies above aligned stretches of level `base`, in order of completion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            n, first = block["n"][0].as_py(), block["at"][0].as_py()
            tree, number = block["tree"][0].as_py(), block["block"][0].as_py()
            height = len(widths(n, fan)) - 1
            nodes = [d.hex() for d in block["digest"].to_pylist()]
            found = []  # position, level, at, digest
            for level in range(base, min(base + levels, height) + 1):
                if level > base:
                    nodes = [hashlib.sha256("".join(nodes[i:i + fan]).encode()).hexdigest() for i in range(0, len(nodes), fan)]
                    first //= fan
                elif base:
                    continue  # written by the round before
                at = range(first, first + len(nodes))
                found += zip(position(level, at, n, fan).tolist(), [level] * len(nodes), at, nodes)
            found.sort()
            places, of_level, at, digests = zip(*found) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays([
                pa.array([tree] * len(found), pa.string()), pa.array([number] * len(found), pa.int64()), pa.array(places, pa.int64()),
                pa.array(of_level, pa.int32()), pa.array(at, pa.int64()), pa.array([n] * len(found), pa.int64()),
                pa.array([bytes.fromhex(d) for d in digests], pa.binary())], schema=schema)

    return run


LOG = "tree string, block long, position long, level int, at long, n long, digest binary"


def _appended(nodes: DataFrame, base: int, levels: int, fan: int) -> DataFrame:
    """Rows of the log above the nodes of level `base`; a tree's leaves are rows of the first round's."""
    schema = StructType.fromDDL(LOG)
    rows = nodes.select("tree", F.expr(f"at div {fan ** levels}").alias("block"), "at", "n", "digest")
    return staged(_by_block(rows, "at").mapInArrow(_builder(base, levels, fan, to_arrow_schema(schema)), schema), "manifest-log")


def _reader(base: int, levels: int, fan: int, schema: pa.Schema):
    """Tasks that read the paths of the nodes of level `base` from the log, above them, and the path of their builder's top."""

    def paths(block: pa.Table) -> Iterator[pa.RecordBatch]:
        above = block.slice(0, 1)
        upper = [(s["left"], s["right"]) for s in above["path"][0].as_py()]
        subroot = above["subroot"][0].as_py()
        logged = block.filter(pa.compute.and_kleene(pa.compute.is_valid(block["position"]), pa.compute.greater(block["level"], base)))
        nodes = block.filter(pa.compute.equal(block["level"], base))
        if not nodes.num_rows:
            return
        n, first = nodes["n"][0].as_py(), nodes["at"][0].as_py()
        log = dict(zip(logged["position"].to_pylist(), (d.hex() for d in logged["digest"].to_pylist())))
        sizes = widths(n, fan)
        here = [d.hex() for d in nodes["digest"].to_pylist()]
        runs = []  # of each level: number of the first run, the runs as text
        for level in range(base, min(base + levels, len(sizes) - 1)):
            start = first // fan ** (level - base)
            if level > base:
                end = min(start + fan ** (base + levels - level), sizes[level])
                here = [log[p] for p in position(level, np.arange(start, end), n, fan).tolist()]
            runs.append((start, ["".join(here[i:i + fan]) for i in range(0, len(here), fan)]))
        for lo in range(0, nodes.num_rows, ROWS):
            part = nodes.slice(lo, ROWS).combine_chunks()
            lefts, rights = [], []
            for at in part["at"].to_pylist():
                for start, texts in runs:
                    text, inside = texts[(at - start) // fan], (at - start) % fan
                    lefts.append(text[:64 * inside])
                    rights.append(text[64 * inside + 64:])
                    at //= fan
                for left, right in upper:
                    lefts.append(left)
                    rights.append(right)
            steps = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], fields=list(schema.field("path").type.value_type))
            each = len(runs) + len(upper)
            found = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * each, pa.int32()), steps, type=schema.field("path").type)
            known = {"path": found, "subroot": pa.array([subroot] * part.num_rows, pa.string())}
            yield pa.RecordBatch.from_arrays([known[f.name] if f.name in known else part[f.name].combine_chunks().cast(f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield from paths(block)

    return run


def _read(nodes: DataFrame, log: DataFrame, above: DataFrame, base: int, levels: int, fan: int) -> DataFrame:
    """Nodes of level `base` with `path` and `subroot`. above: (tree, block, path, subroot) of their builders' tops."""
    kept = [f for f in nodes.schema if f.name not in ("tree", "at", "n", "digest")]
    schema = StructType(nodes.schema.fields + StructType.fromDDL(f"path {PATH}, subroot string").fields)
    rows = nodes.withColumns({"block": F.expr(f"at div {fan ** levels}"), "level": F.lit(base)}) \
        .unionByName(log.filter(F.col("level") > base), allowMissingColumns=True).unionByName(above, allowMissingColumns=True)
    # The path comes first, then what the log holds, then the nodes themselves.
    ordered = _by_block(rows.select("tree", "block", "level", "position", "at", "n", "digest", "path", "subroot", *(f.name for f in kept)),
                        "level", "position", "at")
    return ordered.mapInArrow(_reader(base, levels, fan, to_arrow_schema(schema)), schema)


# --- whole trees --------------------------------------------------------------------

class Trees:
    """Trees over numbered nodes (tree, at, n, digest, ...)."""

    def __init__(self, leaves: DataFrame, fan: int = FAN, levels: int = LEVELS):
        self.fan, self.levels = fan, levels
        largest = leaves.agg(F.max("n")).head()[0] or 0
        self.rounds = [leaves]
        self.logs = [_appended(leaves, 0, levels, fan)]
        while largest > fan ** (levels * len(self.rounds)):
            base = levels * len(self.rounds)
            tops = self.logs[-1].filter((F.col("level") == base) & (F.col("n") > fan ** base)).select("tree", "at", "n", "digest")
            self.rounds.append(tops)
            self.logs.append(_appended(tops, base, levels, fan))

    def log(self) -> DataFrame:
        """All nodes: tree, position, level, at, digest."""
        out = self.logs[0]
        for more in self.logs[1:]:
            out = out.union(more)
        return out.select("tree", "position", "level", "at", "digest")

    def tops(self) -> DataFrame:
        """(tree, digest) of the top of every tree, which is its last node."""
        return self.log().groupBy("tree").agg(F.max_by("digest", "position").alias("digest"))

    def paths(self, above: DataFrame) -> DataFrame:
        """The leaves with `path` and `subroot`. above: (tree, path, subroot) of the trees' tops."""
        ends, reach = None, self.fan ** self.levels
        sizes = self.rounds[0].groupBy("tree").agg(F.max("n").alias("n"))
        tops = above.join(sizes, "tree").withColumn("block", F.lit(0).cast("long"))
        for k in reversed(range(len(self.rounds))):
            inside = F.col("n") <= reach ** (k + 1)
            here = tops.filter(inside & (F.col("n") > reach ** k) if k else inside).select("tree", "block", "path", "subroot")
            if ends is not None:
                here = here.unionByName(ends.select("tree", F.col("at").alias("block"), "path", "subroot"))
            ends = _read(self.rounds[k], self.logs[k], here, k * self.levels, self.levels, self.fan)
            ends = staged(ends, "manifest-paths") if k else ends
        return ends


def with_proofs(rows: DataFrame, group: str, order: str, digest: str, kept: Sequence[str] = (), name: str = "proof",
                fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Columns `kept` of every row and a struct `name`: subroot, root, place (position in the log of its group) and path.

    digest: name of the column with the leaf, in lowercase hex.
    """
    if name in kept:
        raise ValueError(f"a column {name} would stand beside the proof")
    # A group as text that orders as the group does, null first.
    tree = F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    leaves = numbered(rows.select(tree.alias("tree"), F.col(order).alias("place"), F.unhex(digest).alias("digest"), F.struct(*kept, F.lit(0).alias("_")).alias("kept")))
    leaves = staged(leaves, "manifest-numbered")
    trees = Trees(leaves, fan, levels)
    tops = staged(trees.tops(), "manifest-tops")
    over = Trees(staged(numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("place"), "digest", F.struct(F.col("tree")).alias("kept"))),
                        "manifest-subroots"), fan, levels)
    last = over.tops().head()
    root = bytes(last["digest"]).hex() if last else None
    none = rows.sparkSession.range(1).select(F.lit("").alias("tree"), F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    above = over.paths(none).select(F.col("kept.tree").alias("tree"), "path", F.lower(F.hex("digest")).alias("subroot"))
    found = trees.paths(staged(above, "manifest-above"))
    proof = F.struct("subroot", F.lit(root).alias("root"), "at", "path")
    return found.select(*(F.col("kept")[c].alias(c) for c in kept), proof.alias(name))
