"""Components against all pairs, on small tables with copies, groups, short texts and shared passages."""

import random
import re

from hazegrid.llm import graph, ngram_join, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 4]) for k in range(len(words) - 3)}


def expected(rows):
    own = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(own)))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(own)):
        for j in range(i):
            a, b = own[i][1], own[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, s) in enumerate(own):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(s), least.get(top(i))) for i, (d, s) in enumerate(own))


def got(df, **more):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(df, **more).collect())


def test_query_matches_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    out = queries.QUERIES["op6_ngram_components"](spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    assert sorted(map(tuple, out.collect())) == expected(rows)


def test_groups_chains_and_passages(spark, monkeypatch):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 30, 120]))]
        if rng.random() < 0.5:
            words += passage
        for _ in range(rng.choice([1, 2, 14])):
            # Each copy drifts from the last one: chains whose ends are no longer alike.
            if len(words) > 20 and rng.random() < 0.8:
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += ["", None, "  \n", "one", "ONE", "One two", "one two", "É x y z", "é x y z"]
    rng.shuffle(texts)
    rows = [(k * 3, t) for k, t in enumerate(texts)]
    # Lists count as long at once, so that their order and the passing on are tried.
    monkeypatch.setattr(ngram_join, "SHORTEST_LONG", 2)
    monkeypatch.setattr(ngram_join, "HELD", 64)
    monkeypatch.setattr(ngram_join, "BUCKET", 256)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df) == expected(rows)
    # All left to the last comparison, or as much as can be to the pivots.
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "WIDEST", 3)
    assert got(df) == expected(rows)


def test_lists_of_one_first_member_are_shared(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "WIDEST", 100)
    heads = spark.createDataFrame([(k, 5, 7) for k in range(400)] + [(1000 + k, 2, 9) for k in range(50)], "place long, members long, first long")
    rows = ngram_join._shares(heads).collect()
    assert sorted((r.place, r.members, r.first) for r in rows) == sorted(map(tuple, heads.collect()))
    weight = {}
    for r in rows:
        weight[r.first, r.share] = weight.get((r.first, r.share), 0) + r.members
    # 100 members in all are one share still; 2000 become 20 shares of about 100.
    assert weight[9, 0] == 100 and len([k for k in weight if k[0] == 9]) == 1
    assert len([k for k in weight if k[0] == 7]) == 20 and max(weight.values()) <= 200


def test_a_group_of_near_copies_names_few_pairs_and_loses_no_link(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(120):
        own = list(words)
        own[rng.randrange(60)] = f"x{k}"  # two of them share about 49 of 65 shingles, neighbours more
        rows.append((k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    named, passes = [], []
    whole = ngram_join._rest

    def rest(lists, known, percent, *nearest):
        out = whole(lists, known, percent, *nearest)
        named.append(out.filter("a is not null").count())
        passes.append((lists.count(), *nearest))
        return out

    monkeypatch.setattr(ngram_join, "_rest", rest)
    # All is left to the last comparison, with pairs of low likeness and high.
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    for percent in (70, 85):
        got_now = got(df, percent=percent)
        if percent == 85:
            assert got_now == expected(rows)
        else:
            assert {c for _, _, c in got_now} == {0}
    # 120 alike make 7140 pairs.
    assert passes and named[0] <= 120 * 12, (named, passes)


def test_nearest_pairs_of_either_end():
    import numpy as np
    a, b = np.array([0, 0, 0, 1, 1, 2]), np.array([1, 2, 3, 2, 3, 3])
    far = np.array([.1, .2, .3, .4, .5, .6])
    assert ngram_join._nearest(a, b, far, 1).tolist() == [True, True, True, False, False, False]
    assert ngram_join._nearest(a, b, far, 3).all()


def test_other_columns_nulls_repeats_and_empty(spark):
    rows = [(1, "a b c d e", "x"), (1, "a b c d e", "x"), (5, "a b c d e", None), (2, None, "y"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    assert got(df) == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (5, 2, 1)]
    assert got(df.limit(0)) == []
    lone = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e")], "doc_id long, text string")
    assert {tuple(r) for r in ngram_join.components(lone).collect()} == {(None, 2, 4), (4, 2, 4)}


def test_a_long_text(spark):
    words = [f"t{k % 9973}" for k in range(120_000)]
    other = words[:60_000] + ["new"] + words[60_000:]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:1000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == expected(rows)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(100, 180)] + [(7, k) for k in range(8, 60)] + [(500, 500)]
    rng.shuffle(links)
    out = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {k: 100 for k in range(100, 181)} | {k: 7 for k in range(7, 60)}


def test_disk_holds_no_table_that_is_done_with(spark, monkeypatch):
    """Tables that nothing reads any more are gone from the shared folder; the result can still be read, again and again."""
    import os

    from hazegrid import session

    monkeypatch.setattr(ngram_join, "SHORTEST_LONG", 2)
    rng = random.Random(3)
    own = [[f"w{rng.randrange(5000)}" for _ in range(60)] for _ in range(40)]
    rows = [(k, " ".join(["x", *w[1:]] if k % 3 == 1 else w)) for k, w in enumerate(w for w in own for _ in range(3))]
    folder = session.shared_dir(spark)
    before = set(os.listdir(folder))
    out = ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert "rows" in left and not left & {"counted", "lengths", "members", "sets", "heads", "compared", "links"}
    for _ in range(2):
        assert sorted(map(tuple, out.collect())) == expected(rows)


def test_only_staged_tables_go(spark, tmp_path):
    import os

    from hazegrid.llm.staging import staged, unstaged

    path = str(tmp_path / "given")
    spark.range(3).write.parquet(path)
    given, table = spark.read.parquet(path), staged(spark.range(5), "own")
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file:"))
    assert os.path.isdir(folder)
    unstaged(given, table.filter("id > 1"), None)
    assert given.count() == 3 and table.count() == 5
    unstaged(table, table)
    assert not os.path.exists(folder) and os.path.isdir(os.path.dirname(folder)) and given.count() == 3


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    """Without a collection of garbage in the driver, whose plan they hang on."""
    import time

    from hazegrid.llm.staging import staged

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size())} if files.size() else set()

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    before = {f for f in shuffled() if f.startswith("shuffle_")}
    table = staged(spark.range(20000).repartition(3, "id"), "moved")
    for _ in range(50):
        left = {f for f in shuffled() if f.startswith("shuffle_")} - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and table.count() == 20000
    assert spark.conf.get(setting, None) == was
