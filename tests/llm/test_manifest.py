"""The manifest against trees built in plain Python."""

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from hazegrid.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def grown(leaves, fan):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def path(levels, at, fan):
    out = []
    for nodes in levels[:-1]:
        start = at // fan * fan
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1:start + fan])))
        at //= fan
    return out


def expected(rows, fan):
    """doc_id, group, leaf, path, subroot, root of rows (group, doc_id, leaf)."""
    key = lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])
    groups = {}
    for r in sorted(rows, key=key):
        groups.setdefault(r[0], []).append(r)
    trees = {g: grown([r[2] for r in rs], fan) for g, rs in groups.items()}
    over = grown([t[-1][0] for t in trees.values()], fan)
    out = []
    for i, (g, rs) in enumerate(groups.items()):
        for at, r in enumerate(rs):
            out.append((r[1], g, r[2], path(trees[g], at, fan) + path(over, i, fan), trees[g][-1][0], over[-1][0]))
    return out


def by_spark(spark, rows, fan, levels):
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string")
    found = manifest.with_proofs(df, "source", "doc_id", "leaf", kept=("doc_id", "source", "leaf"), fan=fan, levels=levels)
    return [(r.doc_id, r.source, r.leaf, [(s.left, s.right) for s in r.proof.path], r.proof.subroot, r.proof.root) for r in found.collect()]


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("fan,levels", [(2, 3), (3, 2), (16, 3)])
def test_proofs_equal_those_of_plain_trees(spark, fan, levels):
    rows = []
    for g, n in ((None, 3), ("", 1), ("é", 17), ("z", 40), ("a", 16), ("b", 5), ("~", 33)):
        ids = random.Random(n).sample(range(1000), n)
        rows += [(g, i, h(str(g), str(i))) for i in ids]
    assert order(by_spark(spark, rows, fan, levels)) == order(expected(rows, fan))


def test_one_group_one_row_and_none(spark):
    one = [("a", 1, h("x"))]
    assert by_spark(spark, one, 16, 3) == [(1, "a", h("x"), [], h("x"), h("x"))]
    many = [("a", i, h(str(i))) for i in range(300)]
    assert order(by_spark(spark, many, 4, 2)) == order(expected(many, 4))
    assert by_spark(spark, [], 16, 3) == []


def test_ties_repeats_and_null_keys_have_places_of_their_own(spark):
    rows = [("a", None, h("1")), ("a", None, h("0")), ("a", 5, h("2"))] + [("a", 5, h("3"))] * 7 + [(None, None, h("4"))] * 2
    assert order(by_spark(spark, rows, 2, 2)) == order(expected(rows, 2))


def test_leaves_tell_null_from_empty_and_values_apart(spark):
    df = spark.createDataFrame([(1, None, "ab"), (1, "", "ab"), (11, "", "b"), (None, "é", None)], "a long, b string, c string")
    got = [r[0] for r in df.select(manifest.leaf(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [h("1:1", "-", "2:ab"), h("1:1", "0:", "2:ab"), h("2:11", "0:", "1:b"), h("-", "2:é", "-")]


def test_a_changed_row_is_found_and_others_hold(spark):
    rows = [(f"g{i % 3}", i, h(str(i))) for i in range(50)]
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string").withColumn("at", F.lit("own"))
    found = manifest.with_proofs(df, "source", "doc_id", "leaf", kept=("doc_id", "leaf", "at"), fan=3, levels=2)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf"))
    for r in found.withColumn("folded", manifest.folded(F.col("proof.path"), changed)).collect():
        assert (r.folded == r.proof.root) == bool(crc32(str(r.doc_id).encode()) % 5)
        assert r.at == "own"


def test_log_is_in_postorder_without_gaps(spark):
    leaves = [h(str(i)) for i in range(77)]
    df = spark.createDataFrame([("t", i, d) for i, d in enumerate(leaves)], "tree string, place long, d string") \
        .select("tree", "place", F.unhex("d").alias("digest"))
    log = manifest.Trees(manifest.numbered(df), 3, 2).log().orderBy("position").collect()
    assert [r.position for r in log] == list(range(len(log)))
    stack = []
    for r in log:  # in postorder a node's children are on top of the stack
        below = [d for level, d in stack if level == r.level - 1]
        if r.level:
            stack = [s for s in stack if s[0] != r.level - 1]
            assert bytes(r.digest).hex() == h(*below)
        stack.append((r.level, bytes(r.digest).hex()))
    assert stack == [(4, grown(leaves, 3)[-1][0])]


def test_very_long_texts_and_clashing_columns(spark):
    long = "A b" * 400_000
    df = spark.createDataFrame([(1, "s", long, 7), (2, "s", None, 8)], "doc_id long, tree string, digest string, n long")
    rows = df.withColumn("leaf", manifest.leaf(F.col("doc_id"), F.col("digest")))
    got = {r.doc_id: r for r in manifest.with_proofs(rows, "tree", "doc_id", "leaf", kept=("doc_id", "tree", "n", "leaf")).collect()}
    assert got[1].leaf == h("1:1", f"{len(long)}:{long}") and got[1].n == 7 and got[2].tree == "s"
    assert [(s.left, s.right) for s in got[1].proof.path] == [("", got[2].leaf)]
    with pytest.raises(ValueError):
        manifest.with_proofs(rows, "tree", "doc_id", "leaf", kept=("doc_id",), name="doc_id")
