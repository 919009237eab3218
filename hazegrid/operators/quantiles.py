"""Exact quantiles without gathering a group in one task.

The built-in `percentile` keeps every distinct value of a group in one buffer.
Here a first scan brackets every wanted rank with a mergeable sketch, and a second
counts: values inside a bracket one by one, all others as one segment between two
brackets. Running sums over these few rows give exact ranks, and show whether a rank lies inside
its bracket.

Where it doesn't, or a group is so large that its brackets would be long, doubles are split into
three order-preserving digits, and the digit that holds a wanted rank is found level by level from
counts: three more scans with partial aggregation, over the groups in question alone. No task ever sees
more than the buckets of one level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.session import stage

#: Of the sketch: larger is finer. The values of a bracket that are counted are 4 / ACCURACY of a group.
ACCURACY = 10_000
#: Values of a group beyond which its brackets would be long, so digits are taken.
MOST = 1 << 31

# Bits of the fraction resolved by the three levels; the first level also holds
# sign and exponent.
_BITS = (8, 22, 22)


def _with_digits(df: DataFrame) -> DataFrame:
    """Add `_d1`..`_d3` to the column `_v`; comparing them in order compares the values.

    One projection per step, so that no step is evaluated more than once.
    """
    kept = df.columns
    # Infinities have the digits of the largest numbers.
    largest = F.lit(1.7976931348623157e308)
    ends = df.select("*", F.greatest(F.least("_v", largest), -largest).alias("_w"))
    near = ends.select("*", F.floor(F.log2(F.abs("_w"))).alias("_near"))
    # The logarithm may be off by one next to a power of two.
    exact = F.expr(
        "CASE WHEN pow(2D, _near) > abs(_w) THEN _near - 1 "
        "WHEN pow(2D, _near + 1) <= abs(_w) THEN _near + 1 ELSE _near END")
    out = near.select(*kept, "_w", exact.alias("_e"))
    out = out.select("*", (F.abs("_w") / F.pow(F.lit(2.0), F.col("_e")) - 1).alias("_f0"))
    for i, bits in enumerate(_BITS, 1):
        out = out.select("*", (F.col(f"_f{i - 1}") * float(1 << bits)).alias("_s"))
        out = out.select(*[c for c in out.columns if c != "_s"], F.floor("_s").alias(f"_c{i}"),
                         (F.col("_s") - F.floor("_s")).alias(f"_f{i}"))
    first = f"(_e + 1080) * {1 << _BITS[0]} + _c1 + 1"
    # Missing values get the digits of zero and are told apart by counting `_v`:
    # columns that cannot be null need no filter, which would be pushed below
    # all these projections and repeat them.
    return out.select(*kept, *[
        F.expr(f"coalesce(CASE WHEN _v > 0 THEN {code} WHEN _v < 0 THEN -({code}) END, 0L)").alias(f"_d{i}")
        for i, code in enumerate((first, "_c2", "_c3"), 1)])


def _interpolated(ends: DataFrame, names, keys) -> DataFrame:
    """One row per group from its found values: n, i (number of the probability), side, part, _value."""
    each = ends.groupBy(*names, "n", "i").agg(
        F.max(F.when(F.col("side") == 0, F.col("_value"))).alias("low"),
        F.max(F.when(F.col("side") == 1, F.col("_value"))).alias("high"),
        F.max("part").alias("part"),
    )
    # A rank that is whole is its value; infinities have no difference.
    q = F.when(F.col("part") == 0, F.col("low")).otherwise(
        F.col("low") + (F.col("high") - F.col("low")) * F.col("part"))
    ordered = F.array_sort(F.collect_list(F.struct("i", q.alias("q"))))
    return each.groupBy(*names, "n").agg(F.transform(ordered, lambda x: x["q"]).alias("q")).select(
        *keys, "n", "q")


def _wanted(probs) -> Column:
    """Ranks on both sides of every probability, of `n` values."""
    last = F.col("n") - 1
    return F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(side).alias("side"),
            bound(F.lit(float(p)) * last).cast("long").alias("rank"),
            (F.lit(float(p)) * last - F.floor(F.lit(float(p)) * last)).alias("part"),
        )
        for i, p in enumerate(probs) for side, bound in ((0, F.floor), (1, F.ceil))
    ])


def exact_quantiles(df: DataFrame, keys, value: str, probs, few_groups: bool = False,
                    accuracy: int = ACCURACY, margin: float | None = None) -> DataFrame:
    """One row per group with `n` and `q`, the linearly interpolated quantiles.

    `few_groups` states that the number of groups is bounded by the schema or
    by a fixed list (columns, categories). Only then the brackets, two values per group and
    probability, are broadcast; otherwise the join is left
    to the optimizer, which knows the sizes. Without keys there is one group.

    A sketch of this accuracy errs by n / accuracy ranks, so brackets reach twice as far on both sides.
    """
    keys, probs = list(keys), list(probs)
    few_groups = few_groups or not keys
    groups = [F.col(k) for k in keys] or [F.lit(0).alias("_all")]
    names = keys or ["_all"]
    v = F.col(value).cast("double")
    small = F.broadcast if few_groups else (lambda x: x)
    # What isn't a number is missing; -0.0 is 0.0.
    rows = df.select(*groups, F.when(~F.isnan(v), v + F.lit(0.0)).alias("_v")).filter("_v IS NOT NULL")
    reach = 2.0 / accuracy if margin is None else margin
    ends = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-reach, reach)]
    sketch = rows.groupBy(*names).agg(F.count("_v").alias("n"), F.percentile_approx("_v", ends, accuracy).alias("_e"))
    # Columns and not an array, as these expressions are compiled. Null where the group is too large for brackets: then all its values are one segment.
    each = range(len(probs))
    brackets = sketch.select(*names, "n", *[
        F.when(F.col("n") <= MOST, F.col("_e")[2 * i + k]).alias(f"_{side}{i}") for i in each for k, side in enumerate("lh")])
    placed = rows.join(small(brackets), names).select(
        *names, "n", "_v", F.expr(" + ".join(f"CAST(_l{i} <= _v AS INT)" for i in each)).alias("_segment"),
        F.expr("coalesce(" + " OR ".join(f"(_l{i} <= _v AND _v <= _h{i})" for i in each) + ", false)").alias("_inside"))
    counts = placed.groupBy(*names, "n", "_segment", F.when(F.col("_inside"), F.col("_v")).alias("_value")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_first"))
    # Segments hold no value of a bracket, so their least values order all rows.
    before = Window.partitionBy(*names).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_below", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_want", _wanted(probs))
    hits = ranked.select(*names, "n", "_value", F.inline(F.expr(
        "filter(_want, w -> w.rank >= _below AND w.rank < _below + _n)")))
    # One small row a group, written: whether the digits are needed is known from it, and readers share it.
    found = stage(_interpolated(hits, names, names), "quantiles")
    missed = F.exists("q", lambda x: x.isNull())
    out = found.filter(~missed).select(*keys, "n", "q")
    again = found.filter(missed).select(*names)
    if again.isEmpty():
        return out
    rest = rows.join(small(again), names, "left_semi")
    return out.unionByName(quantiles_by_digits(rest, keys, "_v", probs, few_groups))


def quantiles_by_digits(df: DataFrame, keys, value: str, probs, few_groups: bool = False) -> DataFrame:
    """The same from digits alone: four scans, and no task that sees more than the buckets of a level."""
    keys, probs = list(keys), list(probs)
    few_groups = few_groups or not keys
    groups = [F.col(k) for k in keys] or [F.lit(0).alias("_all")]
    names = keys or ["_all"]
    v = F.col(value).cast("double")
    # What isn't a number is missing.
    rows = _with_digits(df.select(*groups, F.when(~F.isnan(v), v).alias("_v")))
    small = F.broadcast if few_groups else (lambda x: x)

    def hits(counts: DataFrame, known, digit: str) -> DataFrame:
        """Buckets of one level with the wanted ranks that fall into them."""
        group = Window.partitionBy(*known)
        before = group.orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_below", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        if digit == "_d1":
            counts = counts.withColumn("n", F.sum("_n").over(group))
            counts = counts.withColumn("_want", _wanted(probs))
        # Wanted ranks count from the start of the bucket, so that the next level
        # finds them among its own rows.
        moved = F.expr("transform(filter(_want, w -> w.rank >= _below AND w.rank < _below + _n), "
                       "w -> struct(w.i, w.side, w.rank - _below AS rank, w.part))")
        return counts.withColumn("_want", moved).filter(F.size("_want") > 0).drop("_n", "_below")

    # A bucket carries the ranks wanted from it along: they are part of the
    # grouping key, so that a level reads the one before it exactly once.
    known, carried, found = list(names), [], None
    for digit in ("_d1", "_d2", "_d3"):
        measure = [F.count("_v").alias("_n")] + ([F.min("_v").alias("_value")] if digit == "_d3" else [])
        hit = rows if found is None else rows.join(small(found), known)
        counts = hit.groupBy(*known, digit, *carried).agg(*measure)
        found = hits(counts.filter("_n > 0"), known, digit)
        known, carried = known + [digit], ["n", "_want"]
    return _interpolated(found.select(*names, "n", "_value", F.inline("_want")), names, keys)
