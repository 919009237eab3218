"""Base spans against the plain patterns, what the trees add, and redaction."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazegrid.llm import personal, queries

SF = "/root/testdata/sf0.01"

PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += sum(divmod(2 * d, 10)) if k % 2 else d
    return total % 10 == 0


def expected(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text(st.sampled_from("a.@_-%+ 1"), max_size=40), st.text(st.sampled_from("12.5 -+()a"), max_size=40),
                 st.text(st.sampled_from("0123456789 -+."), max_size=60), st.text(max_size=30)))
def test_base_spans(text):
    assert personal.base(text) == expected(text)


def test_edges_and_very_long_texts():
    for text in ["", "4111 1111 1111 1111", "a@b.c.d@e.f", "x_a@b.co_y@z.de", "1.2.3.4.5.6.7.8", "0001.2.3.4", "256.1.1.1", "+1 (017) 555-7713 ",
                 "９９@x.de", "1" * 5000, "+" * 5000, "a" * 50_000 + "@", "@" * 5000, "1." * 5000, "+1" + " " * 5000]:
        assert personal.base(text) == expected(text), text[:40]
    # Runs that no match ends must not be read again from each of their characters.
    assert personal.base("a" * 3_000_000 + " " + "1" * 3_000_000 + "+1" + "-" * 3_000_000) == []


def test_query_has_all_base_spans(spark):
    out = queries.QUERIES["op9_personal_data"](spark, SF)
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = sorted(expected(texts[r.doc_id]), key=lambda s: (s[1], s[0]))
        text = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in own)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for k, _, _ in own) for j in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(filter(None, text.split(","))) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), personal.KINDS.index(s.split(":")[0])))


def learned(spark):
    rows = []
    for k in range(300):
        rows.append((k, f"write to name{k}@mail{k % 9}.example.com or call +1 (555) 01{k:02d}-33{k:02d} now, number {k * 7919 % 100000}, "
                        f"from 10.{k % 250}.3.{k % 90} version 1.{k}.2.300, id {k}{'4111111111111' + str(k % 10)} price {k}-{k}"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_what_is_added_is_apart_from_base_spans(spark):
    docs = learned(spark)
    trees = personal.fit(docs)
    assert trees.roots and len(trees.limits) == 4
    text = "ann (at) mail.example.com, bob@mail.example.com, 1.2.3.4.5 and 9 4111-1111-1111-1111 x +1 (555) 0100-3300"
    spans = personal.spans(text, trees)
    own = [(k, a, b) for k, a, b, known, _ in spans if known]
    assert sorted(own) == sorted(expected(text))
    for _, a, b, known, likely in spans:
        assert 0 <= likely <= 1
        if not known:
            assert all(b <= x or y <= a for _, x, y in own)


def test_all_texts_teach_and_copies_count_once(spark):
    docs = learned(spark)
    # Plain texts teach nothing, however many: a share of all texts would lose places of `docs`.
    plain = spark.range(0, 30_000, 1, 4).select("id", F.concat(F.lit("plain text no "), "id").alias("text"))
    more = docs.union(plain).union(docs)
    alone, all_of_them = personal.fit(docs), personal.fit(more)
    assert alone.roots and alone.limits == all_of_them.limits
    seen = [place for r in docs.collect() for place in personal.places(r.text)]
    rows = np.array([row for place in seen[:100] for row, _ in personal.lessons(*place)])
    assert np.allclose(alone.probability(rows), all_of_them.probability(rows))
    # Each proposal of each place weighs as much as any other.
    weights = {(r.made, r.label): 0 for r in personal.taught(more).select(F.col("made").cast("string"), "label").collect()}
    for place in set(seen):
        for row, label in personal.lessons(*place):
            weights[_text(row), label] += 1
    got = {}
    for r in personal.taught(more).select(F.col("made").cast("string"), "label", "weight").collect():
        got[r.made, r.label] = got.get((r.made, r.label), 0) + r.weight
    assert got == weights


def _text(row):
    return "[" + ", ".join(map(str, row)) + "]"


def test_planted_data_that_the_rules_miss_are_found_and_lookalikes_stay(spark):
    rng = random.Random(7)
    texts = [r.text for r in queries.table(spark, SF, "documents").orderBy("doc_id").limit(600).collect()]
    pick = lambda *forms: rng.choice(forms)
    rows, wanted = [], set()
    for i, text in enumerate(texts[:300]):
        words = (text or "x").split(" ")
        at = rng.randrange(len(words))
        head, tail = " ".join(words[:at]) + " ", " " + " ".join(words[at:])
        n = lambda a, b: str(rng.randint(a, b))
        if i < 100:
            mail = pick(f"ann{i} (at) mail{i} dot com", f"b.ann{i} [at] post{i} dot co dot uk", f"joe{i} at firm{i} dot org", f"kim_{i}[at]web{i}[dot]net")
            call = pick(f"0171 555 {n(1000, 9999)}", f"(0{n(20, 99)}) {n(100, 999)} {n(1000, 9999)}", f"0{n(300, 999)}/{n(100000, 9999999)}", f"0{n(100, 999)}-{n(100, 999)}-{n(1000, 9999)}")
            made = head + mail + " or " + call + tail
            wanted |= {(i, made.index(mail, len(head)), len(mail)), (i, made.index(call, len(head) + len(mail)), len(call))}
        elif i < 130:
            quad = pick("[.]", "(.)").join(str(rng.randint(1, 255)) for _ in range(4))
            made = head + quad + tail
            wanted.add((i, len(head), len(quad)))
        else:
            made = head + pick(f"{n(2, 9)}.{n(100, 999)}.{n(100, 999)} km", f"release v{n(1, 9)}.{n(10, 99)}.{n(300, 999)}.{n(1, 9)}", f"${n(1, 999)},{n(100, 999)},{n(100, 999)}.00",
                               f"20{n(10, 24)}-0{n(1, 9)}-1{n(0, 9)} 1{n(0, 9)}:{n(10, 59)}", f"id {n(10**9, 10**12)}", f"no. {n(10**6, 10**9)}", f"{n(10**14, 10**17)}7",
                               f"chapter {n(1, 9)}.{n(1, 9)}.{n(1, 9)}.{n(300, 999)}", f"look at page {n(1, 99)}", "meet at shop.example", f"{n(1, 9)} {n(100, 999)} {n(100, 999)} people") + tail
        rows.append((i, made))
    rows += [(300 + i, t) for i, t in enumerate(texts[300:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    added = {(r.doc_id, s.start, s.end - s.start) for r in personal.find(docs, personal.fit(docs)).collect() for s in r.spans if not s.base}
    found = {(d, a) for d, a, _ in added}
    recall = sum((d, a) in found for d, a, _ in wanted) / len(wanted)
    # In part found counts as wrong, and as found only from its start.
    precision = len(added & wanted) / len(added)
    assert recall >= 0.9 and precision >= 0.95, (recall, precision, sorted((d, dict(rows)[d][a:a + n]) for d, a, n in added - wanted)[:20],
                                                  sorted((d, dict(rows)[d][a:a + n]) for d, a, n in wanted if (d, a) not in found)[:20])


def test_one_digit_at_a_time_and_long_names():
    assert (2, 0, 31) in set(personal.proposals("4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"))
    name = "a" * 300
    assert (0, 2, 2 + 300 + 13) in set(personal.proposals(f"x {name} (at) mail.de"))
    list(personal.proposals("a (at) b.c " * 20_000 + "1 " * 100_000))  # linear


def test_nothing_to_learn_and_columns(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 4), (3, "mail a@b.co", 5), (3, "mail a@b.co", 5)], "doc_id long, text string, spans int")
    trees = personal.fit(df.filter("doc_id < 3"))
    assert not trees.roots
    out = personal.find(df, trees)
    assert out.columns == ["doc_id", "text", "spans"]
    assert sorted((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in out.collect()) == [
        (1, []), (2, []), (3, [("email", 5, 11)]), (3, [("email", 5, 11)])]
    assert not personal.fit(df.limit(0)).roots and personal.find(df.limit(0), trees).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "to a@b.co, 1.2.3.4 and +4111 1111 1111 1111.", 0), (2, None, 0), (3, "none", 0)], "doc_id long, text string, spans int")
    out = personal.redact(df, personal.Trees())
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "to [EMAIL], [IP] and +[CARD].", 2: None, 3: "none"}


def test_saved_trees_are_the_model(spark):
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    from hazegrid.session import scratch
    rng = np.random.default_rng(1)
    made = rng.normal(size=(300, personal.WIDTH))
    rows = [(x.tolist(), float(x[0] + x[3] * x[5] > 0)) for x in made]
    data = spark.createDataFrame(rows, "made array<double>, label double").withColumn("features", array_to_vector("made"))
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(data)
    path = scratch(spark, "trees")
    model.save(path)
    trees = personal.read_trees(spark, path, list(model.treeWeights))
    theirs = [(r.made, r.probability[1]) for r in model.transform(data).collect()]
    ours = trees.probability(np.array([m for m, _ in theirs]))
    assert np.allclose(ours, [p for _, p in theirs])
