"""Verdicts on URLs: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter. Native expressions.

A rule names a host and the beginning of a path, and holds for the host's subdomains as well; the longest rule that fits
wins. Rules are a short configuration and become one expression. A URL without a rule is blocked if its canonical form is
listed. The list may be long: it is put into a Bloom filter of blocks of four 64-bit words, one bit a word for each URL.
Pages look up one block; only those whose four bits are set go to the exact join with the list, all others are
allowed at once, without a shuffle while the filter is small enough to be broadcast (its size is checked).

Null URLs and those without `://` have an empty host and path, no rule, no canonical form, and are allowed. Repeated
pages are judged each; repeated or null list entries count once or not at all. An empty table gives an empty one; without
list or rules all is allowed. All other columns are kept, whatever their names; only host, path, rule and verdict are replaced.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.columns import fresh, without

#: Listed URLs for each block of 256 bits: one in about 400 others passes the filter.
PER_BLOCK = 16
#: A filter of more blocks is joined and not broadcast; a block takes 40 bytes.
BROADCAST_BLOCKS = 1 << 18
WORDS = 4
#: Query parameters that only tell where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z in lower case."""
    name = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(name, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without www. and default port, path without slashes at its end, parameters in order without tracking. Scheme and fragment go."""
    name = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), ":(80|443)$", "")
    trail = F.regexp_replace(path(url), "/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(_rest(url).isNotNull(), F.concat(name, trail, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def ruled(rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits columns host and path, as struct<rule, verdict>; null without one. rules: verdict, host, path."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, name, begin in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(begin)
        found = F.when(fits, F.struct(F.lit(name + begin).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _bits(key: Column, blocks: int) -> list[Column]:
    """Block of a key and its bit in each of the block's words."""
    other = F.xxhash64(key, F.lit(1))
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")] + [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(other, 6 * k).bitwiseAND(63).cast("int")).alias(f"bit{k}")
        for k in range(WORDS)]


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, word0..) with the bits of all keys."""
    return keys.select(*_bits(F.col("key"), blocks)).groupBy("block").agg(*(F.bit_or(f"bit{k}").alias(f"word{k}") for k in range(WORDS)))


def possible(rows: DataFrame, key: str, listed: DataFrame, blocks: int, name: str = "possible") -> DataFrame:
    """`rows` with the boolean column `name`: false where `key` is surely not listed. A column of that name is replaced."""
    look, block, filled = fresh(rows, "_look", "_block", "_filled")
    small = bloom(listed, blocks).select(F.col("block").alias(block), F.struct(*(f"word{k}" for k in range(WORDS))).alias(filled))
    small = F.broadcast(small) if blocks <= BROADCAST_BLOCKS else small
    marked = rows.withColumn(look, F.struct(*_bits(F.col(key), blocks)))
    marked = marked.join(small, F.col(look)["block"] == F.col(block), "left")
    hit = F.col(key).isNotNull()
    for k in range(WORDS):
        hit = hit & (F.col(filled)[f"word{k}"].bitwiseAND(F.col(look)[f"bit{k}"]) != 0)
    return marked.select(*without(rows, name), F.coalesce(hit, F.lit(False)).alias(name))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule and verdict; columns of these names are replaced. listed: canonical URLs in a column `key`, read more than once: a written table."""
    own, fits, hit, found = fresh(pages, "_key", "_ruled", "_possible", "_listed")
    listed = listed.filter("key is not null").select("key").distinct()
    blocks = max(1, listed.count() // PER_BLOCK)
    kept = without(pages, "host", "path", "rule", "verdict")
    known = pages.select(*kept, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), canonical(F.col(url)).alias(own)) \
        .withColumn(fits, ruled(rules))
    known = known.select(*kept, "host", "path", F.col(fits)["rule"].alias("rule"), F.col(fits)["verdict"].alias("verdict"),
                         F.when(F.col(fits).isNull(), F.col(own)).alias(own))
    marked = possible(known, own, listed, blocks, hit)
    sure = marked.filter(~F.col(hit)).withColumn("verdict", F.coalesce("verdict", F.lit("allow"))).drop(own, hit)
    hits = marked.filter(F.col(hit)).join(listed.select(F.col("key").alias(own), F.lit("block").alias(found)), own, "left")
    hits = hits.withColumn("verdict", F.coalesce(F.col(found), F.lit("allow"))).drop(own, hit, found)
    return sure.unionByName(hits)
