"""Benchmark leaks against an exhaustive search of all windows, and the recall of the search under edits."""

import random
import re

import numpy as np
import pytest

from hazegrid.llm import leaks, queries

SF = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def least_distance(item, text):
    """Edit distance of an item to any stretch of a text."""
    row = [0] * (len(text) + 1)
    for k, a in enumerate(item):
        new = [k + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_placed_is_the_least_distance():
    rng = random.Random(4)
    for _ in range(200):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 8))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 14))]
        distance, start, end = leaks.placed(np.array(item, np.uint64), np.array(text, np.uint64))
        assert distance == least_distance(item, text)
        assert least_distance(item, text[start:end]) == distance


def test_query_finds_every_copy(spark):
    documents = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    items = {r.item_id: r.text for r in queries.table(spark, SF, "benchmark").collect()}
    out = {(r.doc_id, r.item_id): r for r in queries.QUERIES["op1_benchmark_leaks"](spark, SF).collect()}
    for d, text in documents.items():
        own = tokens(text)
        for i, item in items.items():
            wanted = tokens(item)
            # Exhaustive only where the words overlap at all.
            if len(set(wanted) & set(own)) < 0.5 * len(set(wanted)):
                assert (d, i) not in out
                continue
            distance = least_distance(wanted, own)
            assert ((d, i) in out) == (distance <= int(leaks.SHARE * len(wanted))), (d, i, distance)
            if (d, i) in out:
                r = out[d, i]
                assert r.distance == distance and r.n_words == len(wanted)
                assert least_distance(wanted, tokens(text[r.start:r.end])) == distance
    assert out


@pytest.mark.parametrize("edits,least", [(0, 1.0), (1, 0.97), (2, 0.95), (4, 0.9)])
def test_recall_under_edits(spark, edits, least):
    rng = random.Random(edits)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "en", "ing", "or", "eth")] + ["the", "of", "and", "to"] * 6
    items, docs = [], []
    for k in range(150):
        item = [rng.choice(words) for _ in range(rng.randrange(22, 50))]
        own = list(item)
        for _ in range(edits):
            at = rng.randrange(len(own))
            kind = rng.randrange(3)
            if kind == 0:
                own[at] = "zzz"
            elif kind == 1:
                del own[at]
            else:
                own.insert(at, "zzz")
        text = [rng.choice(words) for _ in range(60)] + own + [rng.choice(words) for _ in range(60)]
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(text).upper()))
    found = leaks.with_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    pairs = {(r.doc_id, x["item"]) for r in found.collect() for x in r.leaks}
    assert sum((k, k) in pairs for k in range(150)) >= least * 150
    assert all(a == b for a, b in pairs)


def test_nulls_short_items_ties_and_clashes(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "a b, C-d e!", 0), (3, "a b, C-d e!", 0), (4, "«a» “b” c… d e f", 0), (5, "x" * 50_000 + " lone", 0)],
                                 "doc_id long, text string, leaks int")
    items = spark.createDataFrame([(1, "A b c d e"), (2, "a B c d e"), (3, None), (4, " ?!"), (5, "lone"), (None, "d e f")], "item_id long, text string")
    out = leaks.with_leaks(docs, items)
    assert out.columns == ["doc_id", "text", "leaks"]
    rows = sorted((r.doc_id, [(x["item"], x["distance"], r.text[x["start"]:x["end"]]) for x in r.leaks]) for r in out.collect())
    both = [(1, 0, "a b, C-d e"), (2, 0, "a b, C-d e")]
    assert rows == [(1, []), (2, []), (3, both), (3, both), (4, [(None, 0, "d e f"), (1, 0, "a» “b” c… d e"), (2, 0, "a» “b” c… d e")]), (5, [(5, 0, "lone")])]
    assert leaks.with_leaks(docs.limit(0), items).count() == 0
    assert all(r.leaks == [] for r in leaks.with_leaks(docs, items.limit(0)).collect())


def items_words(items):
    return sum(len((r.text or "").split()) for r in items.collect())


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = queries.table(spark, SF, "documents").select("doc_id", "text"), queries.table(spark, SF, "benchmark")
    whole = sorted(str(r) for r in leaks.with_leaks(docs, items).select("doc_id", "leaks").collect())
    monkeypatch.setattr(leaks, "BLOCK", 1 + items_words(items) // 3)
    rows = items.select(items.item_id.alias("item"), "text")
    assert 3 <= len(list(leaks._blocks(rows))) <= 4
    assert sorted(i for ids, _ in leaks._blocks(rows) for i in ids) == sorted(r.item for r in rows.collect())
    assert len(list(leaks._blocks(rows.limit(0)))) == 1
    assert sorted(str(r) for r in leaks.with_leaks(docs, items).select("doc_id", "leaks").collect()) == whole


def test_a_word_that_is_repeated_very_often(spark):
    docs = spark.createDataFrame([(1, "the of " * 20_000 + "a b c d e f g h i j"), (2, "the of")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the of the of the of the of the of the of"), (2, "a b c d e f g h i j")], "item_id long, text string")
    out = {r.doc_id: [(x["item"], x["distance"]) for x in r.leaks] for r in leaks.with_leaks(docs, items).collect()}
    assert out == {1: [(1, 0), (2, 0)], 2: []}


@pytest.mark.parametrize("even", [True, False])
def test_recall_at_all_allowed_edits_and_every_length(even):
    """Items of 5 words and more with floor(n / 5) words replaced, dropped, inserted or each of these, at even distances or anywhere."""
    rng = np.random.default_rng(8)
    lost = []
    for n in [*range(5, 61), 80, 140, 200, 400]:
        items = leaks.Items([" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n)) for _ in range(100)])
        edits = int(leaks.SHARE * n)
        missed = 0
        for k, own in enumerate(items.words):
            places = [(j + 1) * (n + 1) // (edits + 1) - 1 for j in range(edits)] if even else rng.choice(n, edits, replace=False)
            changed = own.tolist()
            # From the last place on, so that earlier ones keep theirs.
            for place in sorted(places, reverse=True):
                kind = ("replace", "drop", "insert")[rng.integers(3) if k % 4 == 3 else k % 4]
                new = [] if kind == "drop" else [int(rng.integers(1, 1 << 63))]
                changed[place:place + (kind != "insert")] = new
            changed = np.array(changed, np.uint64)
            noise = rng.integers(1, 1 << 63, 60, dtype=np.uint64)
            text = np.concatenate([noise[:30], changed, noise[30:]])
            missed += k not in {i for _, i, d, _, _ in leaks.found(items, text, np.array([0, len(text)])) if d <= edits}
        lost.append((n, missed))
    assert all(missed <= 2 for _, missed in lost), lost
    assert sum(missed for _, missed in lost) <= 0.004 * 100 * len(lost), lost
