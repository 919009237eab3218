"""Ordered work on long series, split into chunks of positions.

A window partitioned by series alone puts one series in one task. Series with
a complete spine have integer positions (days or hours since the epoch), so
the frame of a row is known from its position: a series is cut into chunks of
`length` positions, and either the few rows a frame needs are copied into the
neighbouring chunk (`haloed`), or one small row per chunk carries what lies
before and after it (`gapfill`, `numbered`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# About eleven years of days. Far above the longest frame (365), so that few
# rows are copied, and small enough to sort in one task.
LENGTH = 4096


def day(date: Column) -> Column:
    return F.unix_date(date).cast("long")


def hour(ts: Column) -> Column:
    """Hours since the epoch of a timestamp without time zone."""
    return F.unix_date(ts.cast("date")).cast("long") * 24 + F.hour(ts)


def chunk_of(position: Column, length: int) -> Column:
    return F.floor(position / length)


def haloed(df: DataFrame, position: Column, before: int = 0, after: int = 0,
           length: int = LENGTH) -> DataFrame:
    """Copy each row into every chunk with a frame that reaches it.

    `before`/`after` are the rows a frame looks back and ahead. Windows over
    `in_chunk(keys)` then see what a window over the whole series would;
    `settled` drops the copies.
    """
    df = df.withColumn("_pos", position)
    pos = F.col("_pos")
    chunks = F.sequence(chunk_of(pos - after, length), chunk_of(pos + before, length))
    return df.withColumn("_chunk", F.explode(chunks))


def in_chunk(keys) -> Window:
    return Window.partitionBy(*keys, "_chunk").orderBy("_pos")


def settled(df: DataFrame, length: int = LENGTH) -> DataFrame:
    own = F.col("_chunk") == chunk_of(F.col("_pos"), length)
    return df.filter(own).drop("_chunk", "_pos")


def numbered(df: DataFrame, keys, position: Column, length: int = LENGTH) -> DataFrame:
    """Add `row_no` (from 0, by position) and `n_rows` per series.

    Chunks are counted first; only the one count per chunk is ordered over a
    whole series.
    """
    df = df.withColumn("_pos", position).withColumn("_chunk", chunk_of(F.col("_pos"), length))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        df.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys, "_chunk",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("n_rows"),
        )
    )
    inner = F.row_number().over(in_chunk(keys)).cast("long") - 1
    return (
        df.join(counts, [*keys, "_chunk"])
        .withColumn("row_no", F.col("_before") + inner)
        .drop("_pos", "_chunk", "_before")
    )
