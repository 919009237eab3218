"""Quality of whole texts by weak supervision: rules vote or abstain, and expectation-maximisation finds what each vote is worth.

Measures are native expressions over the text alone. Each rule says good (1), bad (-1) or nothing (0). A two-class model
with a chance of every vote in either class is fitted to the counts of vote patterns over all rows; there are at most
3 ^ rules patterns, so the counts are few whatever the corpus. No labels are used. The posterior probability of `good`
decides, together with the base rules, which are never overruled.

Words are runs of other characters than space and tab to carriage return. Null text counts as empty: no words, failed
base rules. Repeated rows count each. An empty table gives an empty result. All other columns are kept, whatever their
names; only those named as a result are replaced. A posterior of exactly one half is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.columns import fresh, without

#: Passes of expectation-maximisation, and what is added to every count.
PASSES, SMOOTH = 100, 1.0
#: Symbols that are counted; separators.
SYMBOLS = "[#*$%&|<>]"
_BLANKS = " \t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"
_CHARACTER = r"[^\x20\x09-\x0D]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts", "n_ends")


def _bound(value: Column, use) -> Column:
    """`use` of a value that is computed once: a name inside the expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more, of an array of words. Windows are compared by 64-bit hashes of their words."""
    def covered(hashes: Column) -> Column:
        places = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))

        def of(sorted_: Column) -> Column:
            same = lambda a, b: F.get(sorted_, a)["h"] == F.get(sorted_, b)["h"]
            again = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda j:
                             F.coalesce(same(j, j + 1), F.lit(False)) | F.coalesce((j > 0) & same(j, F.greatest(j - 1, F.lit(0))), F.lit(False)))
            first = F.transform(again, lambda j: F.get(sorted_, j)["k"])
            return F.size(F.array_distinct(F.flatten(F.transform(first, lambda k: F.array(k, k + 1, k + 2)))))

        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _bound(places, of)).otherwise(0)

    windows = F.transform(F.slice(words, 1, F.size(words) - 2), lambda w, k: F.xxhash64(w, F.get(words, k + 1), F.get(words, k + 2)))
    return F.when(F.size(words) < 4, 0).otherwise(_bound(windows, covered))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the long columns MEASURES of its column `text`; columns of these names are replaced."""
    kept = without(df, *MEASURES)
    own, its_words, its_lines = fresh(df, "_value", "_words", "_lines")
    value = F.coalesce(F.col(text), F.lit(""))
    bare = F.call_function("btrim", value, F.lit(_BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _GAP))
    lines = F.filter(F.split(value, "\n", -1), lambda x: x.rlike(_CHARACTER))
    of_words = _bound(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    of_lines = _bound(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    made = df.withColumn(own, value).withColumn(its_words, of_words).withColumn(its_lines, of_lines)
    value, of_words, of_lines = F.col(own), F.col(its_words), F.col(its_lines)
    numbers = {
        "n_words": of_words["n"], "word_chars": F.length(value) - _count(value, r"[\x20\x09-\x0D]"), "n_symbols": _count(value, SYMBOLS),
        "n_dup_lines": of_lines["again"], "n_repeat_words": of_words["again"], "n_lines": of_lines["n"],
        "n_upper": _count(value, "[A-Z]"), "n_shouts": _count(value, "!"), "n_ends": _count(value, "[.?]"),
    }
    return made.select(*kept, *(numbers[m].cast("long").alias(m) for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes over the measures. Where a share has no denominator the rule abstains."""
    words, lines, chars = (F.nullif(F.col(c), F.lit(0)) for c in ("n_words", "n_lines", "word_chars"))
    return {
        "length": _vote(F.col("n_words") >= 80, F.col("n_words") < 50),
        "symbols": _vote(F.col("n_symbols") / words < 0.05, F.col("n_symbols") / words > 0.3),
        "lines": _vote(F.col("n_dup_lines") / lines < 0.1, F.col("n_dup_lines") / lines > 0.3),
        "windows": _vote(F.col("n_repeat_words") / words < 0.1, F.col("n_repeat_words") / words > 0.3),
        "word_length": _vote((chars / words).between(3, 9), (chars / words < 2.5) | (chars / words > 12)),
        "capitals": _vote(F.col("n_upper") / chars < 0.15, F.col("n_upper") / chars > 0.4),
        "shouts": _vote(F.col("n_shouts") / words < 0.05, F.col("n_shouts") / words > 0.3),
        "sentences": _vote(F.col("n_ends") / words > 0.02, (F.col("n_ends") / words < 0.002) & (F.col("n_words") > 100)),
    }


def fit(rows: DataFrame) -> tuple[float, dict[str, dict[int, float]]]:
    """Prior log odds of `good`, and for each rule the log odds of each vote, from all measured rows."""
    names = list(rules())
    # One row a pattern of votes.
    patterns = rows.select(*(v.alias(n) for n, v in rules().items())).groupBy(*names).agg(F.count("*").alias("n")).collect()
    votes = [(tuple(r[n] for n in names), r["n"]) for r in patterns]
    # Begin with the majority of votes.
    good = [1 / (1 + math.exp(-sum(v))) for v, _ in votes]
    prior, odds = 0.0, {n: {v: 0.0 for v in (-1, 0, 1)} for n in names}
    for _ in range(PASSES):
        yes = sum(g * n for g, (_, n) in zip(good, votes, strict=True)) + SMOOTH
        no = sum((1 - g) * n for g, (_, n) in zip(good, votes, strict=True)) + SMOOTH
        prior = math.log(yes / no)
        for k, name in enumerate(names):
            for vote in (-1, 0, 1):
                a = sum(g * n for g, (v, n) in zip(good, votes, strict=True) if v[k] == vote) + SMOOTH
                b = sum((1 - g) * n for g, (v, n) in zip(good, votes, strict=True) if v[k] == vote) + SMOOTH
                odds[name][vote] = math.log(a / (yes + 2 * SMOOTH)) - math.log(b / (no + 2 * SMOOTH))
        total = [prior + sum(odds[n][x] for n, x in zip(names, v, strict=True)) for v, _ in votes]
        good = [1 / (1 + math.exp(-max(-60.0, min(60.0, t)))) for t in total]
    return prior, odds


def judged(rows: DataFrame, prior: float, odds: dict[str, dict[int, float]]) -> DataFrame:
    """Measured rows with base_failed, the posterior probability `quality`, and kept; columns of these names are replaced."""
    total = F.lit(prior)
    for name, vote in rules().items():
        total = total + F.when(vote == 1, odds[name][1]).when(vote == -1, odds[name][-1]).otherwise(odds[name][0])
    return rows.withColumn("base_failed", base_failed()).withColumn("quality", 1 / (1 + F.exp(-total))) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
