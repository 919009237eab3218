"""Connected components of links between long ids, by joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.staging import staged, unstaged


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): the label is the smallest node that links reach.

    In each round every node takes the least label among itself and its neighbours, then the label of its label, so paths
    shrink to a quarter or less. Each round is written, and its links run between labels only: links inside one label are dropped, so the work
    shrinks. A hub's neighbours are never collected: its least neighbour is an aggregate with map-side combine.
    """
    links = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    result, rounds = None, []
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")) \
            .select("node", F.least("node", "near").alias("up"))
        # Each node points to a smaller one or itself; two jumps shorten chains.
        up = least
        for _ in range(2):
            top = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            up = up.join(top, "up").select("node", F.col("top").alias("up"))
        up = staged(up, "labels")
        rounds.append(up)
        if result is None:
            result = up.withColumnRenamed("up", "label")
        else:
            moved = up.select(F.col("node").alias("label"), F.col("up").alias("higher"))
            result = result.join(moved, "label", "left").select("node", F.coalesce("higher", "label").alias("label"))
        ends = links
        for c in ("a", "b"):
            ends = ends.join(up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")), c)
        done = links
        links = staged(ends.filter("a_up <> b_up").select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), "links")
        unstaged(done)
        if links.isEmpty():
            result = staged(result, "components")
            unstaged(links, *rounds)
            return result
