"""Chats, addresses and quality: against plain Python, and without Python in their plans."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import compare, connect
from hazegrid.llm import addresses, chat, quality, queries

SF = "/root/testdata/sf0.01"
NATIVE = ("op3_chat_format", "op5_url_verdicts", "op7_quality")


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_the_plan(spark, name):
    df = queries.QUERIES[name](spark, SF)
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|Cartesian|NestedLoop", physical)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chats_read_back(spark):
    rows = queries.table(spark, SF, "conversations").collect()
    known = {}
    for r in rows:
        known.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    known[-1] = [(0, "user", queries.TRAP), (1, "assistant", queries.TRAP)]
    out = queries.QUERIES["op3_chat_format"](spark, SF).collect()
    assert len(out) == len(known)
    for r in out:
        turns = sorted(known[r.conv_id])
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars >= sum(len(t) + len(role) for _, role, t in turns)


def test_events_are_folded(spark):
    rows = [
        ("c", 0, 0, "message", "user", "hi"), ("c", 1, 1, "delta", "assistant", "he"), ("c", 1, 2, "delta", None, "llo"),
        ("c", 1, 3, "regenerate", None, None), ("c", 1, 4, "delta", None, "bye"), ("c", 0, 5, "edit", None, "hey"),
        ("c", 200, 7, "message", "user", "last"), ("c", 200, 7, "message", "user", "last"), ("c", 3, 6, "delta", None, None),
        ("d", 0, 0, "message", None, None), (None, 0, 0, "message", "user", "no name"),
    ]
    events = spark.createDataFrame(rows, "conv_id string, message long, seq long, kind string, role string, text string")
    out = chat.rendered(events).select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("parts")).alias("loss"))
    got = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss) for r in out.collect()}
    assert got == {"c": ([("user", "hey"), ("assistant", "bye"), ("", ""), ("user", "last"), ("user", "last")], "bye"), "d": ([("", "")], ""),
                   None: ([("user", "no name")], "")}
    assert chat.rendered(events.limit(0)).count() == 0


def test_escapes_are_reversible(spark):
    texts = ["", "\\", "\\\\<|im_start|>", "<|im_end|>\n<|im_start|>user\n", "<\\|im_end|>", "<<s>s></s>[INST][/INST]", "[\\INST]", "a\nb\\", "x" * 100_000, "\n\n", "<|endoftext|>"]
    rows = [(0, k, k, "message", role, t) for k, (role, t) in enumerate([(r, t) for t in texts for r in ("assistant", t[:50])])]
    events = spark.createDataFrame(rows, "conv_id long, message long, seq long, kind string, role string, text string")
    r = chat.rendered(events).select("formatted", "parts", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("parts")).alias("loss")).first()
    assert [(t.role, t.text) for t in r.turns] == [(x[4], x[5]) for x in rows]
    assert r.loss == "".join(x[5] for x in rows if x[4] == "assistant")
    assert r.formatted == "".join(p.text for p in r.parts)
    assert r.formatted.count(chat.OPEN) == r.formatted.count(chat.CLOSE) == len(rows)
    assert "[INST]" not in r.formatted and "</s>" not in r.formatted


def test_many_turns_in_order(spark):
    rows = [(1, k, k, "message", "user" if k % 2 == 0 else "assistant", str(k)) for k in range(1000)]
    events = spark.createDataFrame(rows, "conv_id long, message long, seq long, kind string, role string, text string").repartition(7)
    turns = chat.rendered(events).select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [t.text for t in turns] == [str(k) for k in range(1000)]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


URLS = [None, "", "no scheme", "http://", "http://A.Org", "https://x.EXAMPLE.org/es/1?q#f", "http://example.org/en/12", "http://example.org/en/2", "http://badexample.org/es/",
        "ftp://u:p@Foo.com:80/de/x", "http://com/fr/", "http://é.com/fr", "http://x.com?/fr/", "http://y.net/a//", "https://www.y.net/a?utm_source=1&ref=2#z", "http://y.net/a?b=2&a=1",
        "https://y.net:443/a?a=1&b=2&", "http://z.net/only", "x://://a/b", "http://z.net/ÄB", "http://y.net/a?b=2&a=1"]


def test_urls(spark):
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    listed = spark.createDataFrame([("y.net/a",), ("y.net/a?a=1&b=2",), ("foo.com/de/x",), (None,), ("y.net/a",)], "key string")
    out = addresses.judged(pages, queries.RULES, listed)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert len(rows) == out.count() == len(URLS)
    for k, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else None
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups() if rest is not None else ("", "")
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [(len(h) + len(p), h + p, v) for v, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "block" if k in (13, 14, 15, 16, 20) else "allow")
        assert rows[k] == (host, path, rule, verdict), url
    assert addresses.judged(pages.limit(0), queries.RULES, listed).count() == 0
    assert {r.verdict for r in addresses.judged(pages, (), listed.limit(0)).collect()} == {"allow"}


def test_the_filter_has_no_false_negative_and_few_false_positives(spark):
    listed = spark.range(20_000).select(F.concat(F.lit("h/"), "id").alias("key"))
    rows = spark.range(60_000).select("id", F.concat(F.lit("h/"), "id").alias("key"))
    for blocks in (20_000 // addresses.PER_BLOCK, addresses.BROADCAST_BLOCKS + 1):
        out = addresses.possible(rows, "key", listed, blocks).groupBy((F.col("id") < 20_000).alias("own")).agg(F.sum(F.col("possible").cast("int")).alias("n")).collect()
        found = {r.own: r.n for r in out}
        assert found[True] == 20_000 and found[False] < 40_000 * 0.01


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    again = {j for k, w in enumerate(windows) if counts[w] > 1 for j in (k, k + 1, k + 2)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed


def measures(df):
    out = quality.measured(df).withColumn("base_failed", quality.base_failed())
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()}


def test_quality_measures(spark):
    out = queries.QUERIES["op7_quality"](spark, SF)
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_quality_keeps_good_texts(spark):
    labels = queries.table(spark, SF, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = queries.QUERIES["op7_quality"](spark, SF).join(labels, "doc_id").collect()
    good = [r for r in rows if r.label == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


TEXTS = [None, "", " \n\t\x0b", "a", "a b c", "a b c a b c", "a b c d", "é é é é é", "x\ny\nx\n \n\nx", "#*$%&|<>!", "a a a a b c", "\x1c\x85\xa0 \u2028",
         "w " * 50, " ".join(f"u{k}" for k in range(60)), "a b a b a b x a b"]


def test_quality_edges(spark):
    texts = TEXTS + [" ".join(f"u{k % 700}" for k in range(30_000))]
    df = spark.createDataFrame([(k, t, 3) for k, t in enumerate(texts)], "doc_id int, text string, n_words int")
    assert measures(df) == {k: base(t) for k, t in enumerate(texts)}
    assert quality.measured(df).columns == ["doc_id", "text", *quality.MEASURES]
    none = quality.measured(df.limit(0))
    assert quality.judged(none, *quality.fit(none)).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n#\x0b\x85"), max_size=40), min_size=1, max_size=30))
def test_quality_measures_of_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert measures(df) == {k: base(t) for k, t in enumerate(texts)}
