"""Documents whose sets of word n-grams are nearly equal: an exact Jaccard join by T-occurrence search, and its components.

A document of n shingles can only link with one that holds at least T = ceil(share * n) of them. Its inverted lists are
divided as in DivideSkip, with the longest T - k lists skipped: a partner must stand in k of the other n - T + k lists,
the short ones, which are merged; the skipped lists are probed by binary search, candidate by candidate, until the
overlap is exact. Which lists are long is counted first, over all documents; the order is by length, then by hash, and
serves speed alone: whatever it is, no link is lost. k is a twentieth of n, so that a few shingles in common, which any
two texts may have, make no candidate.

Documents with equal sets share one node, so copies meet as one posting. Most postings stand alone in their list and
are dropped at once, and so are nodes that stand in fewer than k lists with others. The rest form open lists. Copies of
one text would be a pair for every two of them, so lists are worked off in rounds: each list has a pivot, a member of its
largest component, and each member of another component is compared with the pivot that it meets most; links merge
components; members of one component need no comparison any more. When rounds bring little, or run out, all pairs of
different components are proposed at their first common list: what stands before it in either set cannot be shared, so
its place in both orders must leave room for the overlap. In a group of near copies these are still nearly all pairs, so each
member names its nearest partners first, by bitmaps; after their links are merged, lists that had more to name are worked off
again, with more partners each, until none is left out. No pair goes untested unless its nodes are linked already, or
sizes, places or bitmaps rule it out, so components are exact. A bitmap holds the parity of a set's shingles in SIGNS
hash classes: where two differ, a shingle is not shared.

Nodes are 64-bit hashes of whole sets, shingles are 64-bit hashes. Null and empty texts have no shingle and link with
nothing; a text of fewer words than n has one shingle. Repeated rows are copies.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm import graph, words
from hazegrid.llm.columns import sliced
from hazegrid.llm.staging import no_leftovers, removed, staged, unstaged
from hazegrid.session import scratch

#: Bytes of text handled at once, few enough for a core's cache. Speed only.
PIECE = 1 << 18
#: Words of a shingle; least similarity in percent.
SIZE, PERCENT = 4, 85
#: Lists that the order knows as long, at most: 16 bytes each go to every task. The least length falls as they allow.
LONG_LISTS = 1 << 20
SHORTEST_LONG = 8
#: Lists in which two partners meet at least, in percent of the set.
MEETINGS = 5
#: Rounds with pivots at most; they end as well when a round links fewer than one in PROGRESS nodes.
ROUNDS, PROGRESS = 8, 50
#: Members of a list that meet in one task, at most; lists with one first member are spread beyond as many members in all.
WIDEST = 4096
#: Partners that each member of a list names at least in the last comparison; as many times more in each pass over the lists that have others left.
NEAREST = 4
#: Bits of a set's bitmap.
SIGNS = 1024
#: Bytes of text whose shingles go into one bucket of lists, about: what a task holds at once.
BUCKET = 1 << 25
#: Passes that drop nodes with too few meetings.
SWEEPS = 3
#: Tokens or postings that a task holds before it hands them on. Memory only.
HELD = 1 << 19
#: Bits of the filter that keeps only sets of open lists, at most.
FILTER_BITS = 1 << 25


def pieces(column: pa.Array, size: int):
    """(shingles, bounds, nodes) of a text column piece by piece: the sorted distinct shingles of each row back to back, where rows begin and end
    among them, and the hash of each row's set."""
    for _, data, ends in words.texts(column, PIECE):
        data = words.LOWER[data]
        hashes, _, rows = words.words(data, ends, words.BLANK[data])
        n = np.diff(rows)
        all_of_them = words.shingled(hashes, size)
        flat = np.empty(int(np.where(n >= size, n - size + 1, n > 0).sum()), np.uint64)
        at = 0
        bounds = [0]
        for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
            if hi - lo >= size:
                own = flat[at:at + hi - lo - size + 1]
                own[:] = all_of_them[lo:hi - size + 1]
                own.sort()
                at += len(own)
            elif hi > lo:
                # The whole sequence, apart from sequences of other lengths.
                flat[at:at + 1] = words.shingled(hashes[lo:hi], hi - lo) ^ np.uint64(hi - lo)
                at += 1
            bounds.append(at)
        bounds = np.array(bounds)
        fresh = np.append(True, flat[1:] != flat[:-1])[:len(flat)]
        fresh[bounds[:-1][bounds[:-1] < len(flat)]] = True
        bounds = np.append(0, np.cumsum(fresh))[bounds]
        flat = flat[fresh]
        yield flat, bounds, nodes(flat, bounds)


def sets(column: pa.Array, size: int):
    """(row, sorted distinct shingles) of every text in a column."""
    row = 0
    for flat, bounds, _ in pieces(column, size):
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield row, flat[lo:hi]
            row += 1


def nodes(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The hash of each set, as a signed 64-bit number."""
    sums = np.append(np.uint64(0), np.cumsum(words.mixed(flat), dtype=np.uint64))
    total = sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return words.mixed(total).view(np.int64)


def least_overlap(n, percent: int):
    """Shingles that a set of n must share with a partner, at least."""
    return -(-percent * n // 100)


def meetings(n, percent: int):
    """Short lists in which a set of n must meet a partner of its size, at least; grows with n."""
    return 1 + n * MEETINGS // 100


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Binary probes of the smaller set in the larger: is 100 * intersection >= percent * union?"""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    same = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * same >= percent * (len(a) + len(b) - same)


def signs(shingles: np.ndarray) -> bytes:
    """Parity of a set's shingles in each class."""
    counts = np.bincount((shingles % np.uint64(SIGNS)).astype(np.int64), minlength=SIGNS)
    return np.packbits(counts & 1).tobytes()


def _places(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """List number of each shingle: its bucket, and 32 bits within. Two shingles under one number only mean more candidates."""
    return ((shingles >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (shingles & np.uint64(0xFFFFFFFF))


class _Held:
    """Arrays of a task, handed on as one blob for each bucket when there are many."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *arrays: np.ndarray) -> None:
        self.parts.append(arrays)
        self.size += len(arrays[0])

    def blobs(self):
        if self.size:
            columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
            bucket = (columns[0] >> np.uint64(32)).astype(np.int32)
            # Numbers of 16 bits are sorted by radix.
            order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 1 << 16 else bucket, kind="stable")
            columns = [c[order] for c in columns]
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            bounds = np.concatenate([[0], cuts, [len(order)]])
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                rest = b"".join(c[lo:hi].tobytes() for c in columns[1:])
                yield int(bucket[order[lo]]), (columns[0][lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + rest
        self.parts, self.size = [], 0


def _counted(docs: DataFrame, buckets: int, size: int, percent: int) -> DataFrame:
    """A row (key, node, n) for each document, and rows (bucket, blob) with the shingles that may stand in short lists."""
    def run(batches):
        held = _Held()

        def handed(key=(), nodes=(), sizes=()):
            blobs = list(held.blobs()) if held.size >= HELD or not len(sizes) else []
            lead, tail = pa.nulls(len(blobs), key_type), pa.nulls(len(sizes), pa.binary())
            return pa.RecordBatch.from_arrays([
                pa.concat_arrays([key, lead]) if len(sizes) else lead, pa.array([*nodes, *[None] * len(blobs)], pa.int64()),
                pa.array([*sizes, *[None] * len(blobs)], pa.int64()), pa.array([*[None] * len(sizes), *[b for b, _ in blobs]], pa.int32()),
                pa.concat_arrays([tail, pa.array([b for _, b in blobs], pa.binary())])], names=["key", "node", "n", "bucket", "blob"])

        key_type = pa.int64()
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            names, sizes = [], []
            key_type = batch.column("key").type
            for flat, bounds, own in pieces(batch.column("text"), size):
                n = np.diff(bounds)
                names += [a if m else None for a, m in zip(own.tolist(), n.tolist(), strict=True)]
                sizes += n.tolist()
                # Twice the short lists: the order may skip as many for longer ones.
                at = np.arange(len(flat)) - np.repeat(bounds[:-1], n)
                held.add(_places(flat[at < np.repeat(2 * (n - least_overlap(n, percent) + meetings(n, percent)), n)], buckets))
            yield handed(batch.column("key"), names, sizes)
        yield handed()

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, node long, n long, bucket int, blob binary")


def _long_lists(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the longest lists, ascending, and their lengths."""
    def count(table: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("blob").to_pylist()])
        bucket = table.column("bucket")[0].as_py()
        value, n = np.unique(tokens, return_counts=True)
        value, n = value[n >= SHORTEST_LONG], n[n >= SHORTEST_LONG]
        return pa.table({"place": value.astype(np.int64) + (bucket << 32), "length": n.astype(np.int64)})

    lengths = staged(counted.filter("bucket is not null").select("bucket", "blob").groupBy("bucket")
                     .applyInArrow(count, "place long, length long"), "lengths")
    # How many lists there are of each length, on a log scale: a few dozen rows.
    steps = {r.step: r.n for r in lengths.groupBy(F.floor(F.log2("length")).cast("int").alias("step")).agg(F.count("*").alias("n")).collect()}
    least, total = max(steps, default=3) + 1, 0
    while least - 1 in steps and total + steps[least - 1] <= LONG_LISTS:
        least -= 1
        total += steps[least]
    rows = lengths.filter(F.col("length") >= 1 << least).orderBy("place").toArrow()
    unstaged(lengths)
    return rows.column("place").to_numpy().astype(np.uint64), rows.column("length").to_numpy()


def _postings(docs: DataFrame, buckets: int, size: int, percent: int, places: np.ndarray, lengths: np.ndarray) -> DataFrame:
    """Members (place, node, n) of all lists that two nodes or more share, of the short lists of every set."""
    seen = np.zeros(1 << 22, bool)
    seen[places % np.uint64(1 << 22)] = True

    def run(batches):
        short, long = _Held(), _Held()

        def handed():
            rows = [(b, False, x) for b, x in short.blobs()] + [(b, True, x) for b, x in long.blobs()]
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.bool_()),
                pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "long", "blob"])

        met: set[int] = set()
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            for flat, bounds, names in pieces(batch.column("text"), size):
                n = np.diff(bounds)
                new = np.zeros(len(n), bool)
                for k, name in enumerate(names.tolist()):
                    if n[k] and name not in met:
                        new[k] = True
                        if len(met) < HELD:
                            met.add(name)
                own = _places(flat, buckets)
                length = np.zeros(len(own), np.int64)
                maybe = np.flatnonzero(seen[own % np.uint64(1 << 22)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(places, own[maybe]), len(places) - 1)
                    hit = places[at] == own[maybe]
                    length[maybe[hit]] = lengths[at[hit]]
                row = np.repeat(np.arange(len(n)), n)
                order = np.arange(len(own))
                # Only sets with a long list are put into another order than that by hash.
                for k in np.unique(row[length > 0]):
                    lo, hi = bounds[k], bounds[k + 1]
                    order[lo:hi] = lo + np.argsort(length[lo:hi], kind="stable")
                at = np.arange(len(own)) - np.repeat(bounds[:-1], n)
                chosen = new[row] & (at < (n - least_overlap(n, percent) + meetings(n, percent))[row])
                order, at, row = order[chosen], at[chosen].astype(np.uint32), row[chosen]
                for held, which in ((short, length[order] == 0), (long, length[order] > 0)):
                    if which.any():
                        held.add(own[order[which]], names[row[which]], n[row[which]].astype(np.uint32), at[which])
            if short.size + long.size >= HELD:
                yield handed()
        yield handed()

    def merged(table: pa.Table) -> pa.Table:
        """Lists of a bucket: those that are known as long are passed on, of the others the single postings go."""
        bucket = table.column("bucket")[0].as_py()
        out = []
        for kind in (False, True):
            parts = []
            for blob, long in zip(table.column("blob").to_pylist(), table.column("long").to_pylist(), strict=True):
                if long == kind:
                    m = len(blob) // 20
                    parts.append((np.frombuffer(blob, np.uint32, m), np.frombuffer(blob, np.int64, m, 4 * m),
                                  np.frombuffer(blob, np.uint32, m, 12 * m), np.frombuffer(blob, np.uint32, m, 16 * m)))
            if not parts:
                continue
            rows = [np.concatenate(x) for x in zip(*parts, strict=True)]
            if not kind:
                # Most postings stand alone and need no order.
                value = np.sort(rows[0])
                twice = np.zeros(1 << 24, bool)
                twice[value[1:][value[1:] == value[:-1]] & 0xFFFFFF] = True
                maybe = twice[rows[0] & 0xFFFFFF]
                rows = [x[maybe] for x in rows]
                if not len(rows[0]):
                    continue
            order = np.lexsort((rows[3], rows[1], rows[0]))
            rows = [x[order] for x in rows]
            fresh = np.append(True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
            rows = [x[fresh] for x in rows]
            if not kind:
                same = np.append(False, rows[0][1:] == rows[0][:-1])
                shared = same | np.append(same[1:], False)
                rows = [x[shared] for x in rows]
            out.append((rows[0].astype(np.int64) + (bucket << 32), rows[1], rows[2].astype(np.int64), rows[3].astype(np.int64)))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("place", "node", "n", "at"), columns, strict=True)))

    blobs = docs.mapInArrow(run, "bucket int, long boolean, blob binary")
    return blobs.groupBy("bucket").applyInArrow(merged, "place long, node long, n long, at long")


def _open_sets(docs: DataFrame, members: DataFrame, size: int, buckets: int) -> tuple[str, str]:
    """Name and folder of a table (node, n, signs, shingles) of the nodes in open lists, and some others: a filter of bounded size picks them while
    texts are read again. The table is bucketed by node, so that joins on it move the other side alone."""
    nodes = members.select("node").distinct()
    # Nodes are hashes already. 16 bits a node, as long as the filter may grow.
    bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * nodes.count()).bit_length()))
    at = nodes.select(F.pmod("node", F.lit(bits)).alias("at"))
    filled = at.groupBy(F.floor(F.col("at") / 32).alias("word")) \
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 32).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[filled.column("word").to_numpy()] = filled.column("bits").to_numpy().astype(np.uint32)

    def run(batches):
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            rows = []
            for flat, bounds, own_names in pieces(batch.column("text"), size):
                at = own_names % bits
                known = (table[at // 32] >> (at % 32).astype(np.uint32) & 1).astype(bool) & (np.diff(bounds) > 0)
                for k in np.flatnonzero(known).tolist():
                    own = flat[bounds[k]:bounds[k + 1]]
                    rows.append((int(own_names[k]), len(own), signs(own), own.tobytes()))
            names, sizes, maps, shingles = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary()),
                                              pa.array(shingles, pa.binary())], names=["node", "n", "signs", "shingles"])

    def once(batches):
        """The first row of each node, of rows that are sorted by node."""
        before: int | None = None
        for batch in batches:
            if len(batch):
                names = batch.column("node").to_numpy()
                yield batch.filter(pa.array(np.append(before is None or names[0] != before, names[1:] != names[:-1])))
                before = int(names[-1])

    spark = docs.sparkSession
    columns = "node long, n long, signs binary, shingles binary"
    unique = docs.mapInArrow(run, columns).repartition(buckets, "node").sortWithinPartitions("node").mapInArrow(once, columns)
    name, path = f"sets_{uuid.uuid4().hex}", scratch(spark, "sets")
    with no_leftovers(spark):
        unique.write.bucketBy(buckets, "node").option("path", path).format("parquet").saveAsTable(name)
    return name, path


def _compared(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(a, b, same) for those pairs (a, b) that their bitmaps leave, by the sets of both. Many pairs share a b, few an a: the sets of all b are few."""
    pairs = _possible(pairs, known, percent)
    first = pairs.join(known.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    wanted = pairs.select(F.col("b").alias("node")).distinct()
    second = known.join(wanted, "node", "left_semi").select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches):
        for batch in (part for whole in batches for part in sliced(whole, "of_a")):
            same = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same, pa.bool_())], names=["a", "b", "same"])

    found = staged(first.join(second, "b").mapInArrow(run, "a long, b long, same boolean"), "compared")
    unstaged(pairs)
    return found


def _possible(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps differ in no more shingles than a link allows."""
    for c in ("a", "b"):
        pairs = pairs.join(known.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("signs").alias(f"{c}_signs")), c)

    def run(batches):
        for batch in batches:
            m = len(batch)
            a, b = (np.frombuffer(b"".join(batch.column(f"{c}_signs").to_pylist()), np.uint64).reshape(m, -1) for c in ("a", "b"))
            both = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
            differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) if m else both
            kept = batch.filter(pa.array(differ <= both - 2 * -(-percent * both // (100 + percent))))
            yield kept.select(["a", "b"])

    return staged(pairs.select("a", "b", "a_n", "b_n", "a_signs", "b_signs").mapInArrow(run, "a long, b long"), "pairs")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _merged(labels: DataFrame | None, found: DataFrame) -> DataFrame | None:
    """Labels after links (a, b) between nodes are added; those of before are no longer read, and go where new ones are written."""
    links = found.filter("same").select("a", "b")
    if links.isEmpty():
        return labels
    if labels is None:
        return graph.components(links)
    for c in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")), c, "left") \
            .withColumn(c, F.coalesce(f"{c}_label", c)).select("a", "b")
    moved = graph.components(links)
    known = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("higher")), "label", "left") \
        .select("node", F.coalesce("higher", "label").alias("label"))
    fresh = moved.join(known, "node", "left_anti")
    out = staged(known.unionByName(fresh), "labels")
    unstaged(moved, labels)
    return out


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """A row (key, n_shingles, component_id) for each row of `docs`: the set's size, and the least key that links reach, its own included."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # More buckets for more text, so that none grows with the corpus.
    size_of_all = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    buckets = min(max(parts, -(-size_of_all // BUCKET)), (1 << 31) - 1)
    counted = staged(_counted(docs, buckets, size, percent), "counted")
    long = _long_lists(counted)
    # The shingles take half as much room as the texts do.
    rows = staged(counted.filter("bucket is null").select("key", "node", "n"), "rows")
    unstaged(counted)
    members = _swept(staged(_postings(docs.select("text"), buckets, size, percent, *long), "members"), percent)
    labels = None
    if not members.isEmpty():
        name, path = _open_sets(docs.select("text"), members, size, parts)
        try:
            labels = _linked(members, spark.table(name), percent)
        finally:
            spark.sql(f"drop table if exists {name}")
            removed(spark, path)
    unstaged(members)
    named = _labelled(rows, labels)
    # Without shingles a row is on its own.
    least = named.filter("node is not null").groupBy("label").agg(F.min("key").alias("least"))
    return named.join(least, "label", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "key").alias("component_id"))


def _swept(members: DataFrame, percent: int) -> DataFrame:
    """Members without those that cannot have a partner: it has `least_overlap` shingles at least, and meets them in as many lists as that asks for."""
    # One less, as two shingles of a set may have fallen into one list.
    least = F.greatest(F.lit(1), (F.floor((F.col("n") * percent + 99) / 100) * MEETINGS / 100).cast("long"))
    for _ in range(SWEEPS):
        enough = members.groupBy("node").agg(F.count("*").alias("met"), F.first("n").alias("n")).filter(F.col("met") >= least).select("node")
        left = members.join(enough, "node", "left_semi")
        shared = left.groupBy("place").agg(F.count("*").alias("size")).filter("size > 1").select("place")
        before, members = members, staged(left.join(shared, "place", "left_semi"), "members")
        unstaged(before)
    return members


def _nearest(a: np.ndarray, b: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Which pairs (a, b) are among the `most` nearest ones of either end; of equally far ones the first."""
    ends = np.concatenate([a, b])
    order = np.lexsort((np.concatenate([far, far]), ends))
    ends = ends[order]
    starts = np.flatnonzero(np.append(True, ends[1:] != ends[:-1]))
    rank = np.arange(len(ends)) - np.repeat(starts, np.diff(np.append(starts, len(ends))))
    kept = np.zeros(len(a), bool)
    kept[order[rank < most] % len(a)] = True
    return kept


def _rest(lists: DataFrame, known: DataFrame, percent: int, nearest: int) -> DataFrame:
    """Pairs (a, b) of different labels that sizes, places and bitmaps leave, of all open lists (place, node, n, at, label, members, first, share).

    Where a list part has more than `nearest` pairs a member, those go out that are among the `nearest` of either end, and so does a row (place)
    that says that the list has others: rows out grow with rows in.

    Pairs are looked at inside tasks and only the few that are left go out. Lists with one first member mostly have the same
    members: they go to one task, which names a pair once, or to as many shares as `_shares` gives them. A list of more than
    WIDEST members is cut into parts by node, and each two of its parts meet in a task.
    """
    signed = lists.join(known.select("node", "signs"), "node")
    parts = F.ceil(F.col("members") / WIDEST).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    met = signed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))) \
        .select("first", "share", "place", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "n", "at", "label", "signs")

    def pairs_of(rows: dict[str, np.ndarray], lo: int, hi: int) -> tuple[np.ndarray, bool]:
        """Rows (a, b) of one list part, in blocks of rows, and whether these are all."""
        node, n, at, label, own, maps = (rows[c][lo:hi] for c in ("node", "n", "at", "label", "own", "signs"))
        apart = rows["low"][lo] != rows["high"][lo]
        at_a, at_b, far, all_of_them = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), True
        step = max(1, (1 << 20) // (hi - lo))
        for i in range(0, hi - lo, step):
            s = slice(i, i + step)
            both = n[s, None] + n
            least = -(-percent * both // (100 + percent))
            ok = (node[s, None] < node) & (label[s, None] != label) & (n[s, None] - at[s, None] >= least) & (n - at >= least)
            ok &= (100 * n[s, None] >= percent * n) & (100 * n >= percent * n[s, None])
            if apart:
                ok &= own[s, None] != own
            a, b = np.nonzero(ok)
            if len(a):
                differ = np.bitwise_count(maps[a + i] ^ maps[b]).sum(axis=1, dtype=np.int64)
                left = differ <= both[a, b] - 2 * least[a, b]
                at_a, at_b = np.append(at_a, a[left] + i), np.append(at_b, b[left])
                far = np.append(far, differ[left] / both[a[left], b[left]])
                if len(at_a) > nearest * (hi - lo):
                    kept = _nearest(at_a, at_b, far, nearest)
                    all_of_them &= bool(kept.all())
                    at_a, at_b, far = at_a[kept], at_b[kept], far[kept]
        return np.stack([node[at_a], node[at_b]], axis=1), all_of_them

    def run(batches):
        rest: pa.Table | None = None

        def done(table: pa.Table, whole: bool):
            """Pairs of all list parts that are complete, and the rows of the last one if more may come."""
            rows = {c: table.column(c).to_numpy() for c in ("place", "low", "high", "own", "node", "n", "at", "label")}
            rows["signs"] = np.frombuffer(b"".join(table.column("signs").to_pylist()), np.uint64).reshape(len(table), -1)
            fresh = np.append(True, (np.diff(rows["place"]) != 0) | (np.diff(rows["low"]) != 0) | (np.diff(rows["high"]) != 0))
            starts = np.append(np.flatnonzero(fresh), len(table))
            last = len(starts) - 1 if whole else len(starts) - 2
            found = []
            for k in range(last):
                if starts[k + 1] - starts[k] > 1:
                    pairs, all_of_them = pairs_of(rows, starts[k], starts[k + 1])
                    found.append(pairs)
                    if not all_of_them:
                        more.add(int(rows["place"][starts[k]]))
            return found, table.slice(int(starts[last]))

        more: set[int] = set()

        def named(found: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            places = sorted(more)
            more.clear()
            return pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(pairs[:, k]), pa.nulls(len(places), pa.int64())]) for k in (0, 1)]
                + [pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(places, pa.int64())])], names=["a", "b", "place"])

        held: list[np.ndarray] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            found, rest = done(table, False)
            held += found
            if sum(map(len, held)) > HELD:
                yield named(held)
                held = []
        if rest is not None and len(rest):
            held += done(rest, True)[0]
        yield named(held)

    return met.repartition("first", "share", "low", "high").sortWithinPartitions("first", "share", "low", "high", "place") \
        .mapInArrow(run, "a long, b long, place long").distinct()


def _shares(heads: DataFrame) -> DataFrame:
    """Lists (place, members, first) with the share of their first member's lists that they belong to: one for WIDEST members, by place.

    A node that stands first in very many lists, as one of a large group does, would bring them all into one task. Two shares
    may both name a pair, at most once for each list that it meets in.
    """
    busy = staged(heads.groupBy("first").agg(F.sum("members").alias("all")).filter(F.col("all") > WIDEST)
                  .select("first", F.ceil(F.col("all") / WIDEST).alias("shares")), "shares")
    return heads.join(busy, "first", "left") \
        .select("place", "members", "first", F.coalesce(F.pmod(F.xxhash64("place"), F.col("shares")), F.lit(0)).alias("share"))


def _linked(members: DataFrame, known: DataFrame, percent: int) -> DataFrame | None:
    """Components (node, label) of all links between members of common lists."""
    labels, tested, total, linked_now = None, None, members.select("node").distinct().count(), None

    def near(n, m, at, other):
        """May sets of n and m link that have nothing in common before places `at` and `other` of their orders?"""
        n, m, at, other = (F.col(c) for c in (n, m, at, other))
        least = F.ceil((n + m) * percent / (100 + percent) - 1e-9)
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (n - at >= least) & (m - other >= least)

    def untested(pairs: DataFrame) -> DataFrame:
        if tested is None:
            return pairs
        both = tested.union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return pairs.join(both, ["a", "b"], "left_anti")

    def open_lists(turn: int) -> tuple[DataFrame, DataFrame]:
        """Members with their labels, and a row for each list that has more than one label."""
        lists = _labelled(members, labels)
        groups = lists.groupBy("place", "label").agg(F.count("*").alias("size"), F.min("node").alias("least"), F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "at")).alias("one"))
        return lists, staged(groups.groupBy("place").agg(
            F.max(F.struct("size", F.negative("one.h").alias("h"), "label", "one")).alias("head"), F.count("*").alias("groups"),
            F.sum("size").alias("members"),
            F.min("least").alias("first")).filter("groups > 1"), "heads")

    for turn in range(ROUNDS):
        # Lists with one component left are done.
        lists, heads = open_lists(turn)
        if heads.isEmpty():
            unstaged(heads)
            return labels
        if linked_now is not None and linked_now * PROGRESS < total:
            break
        pivot = heads.select("place", F.col("head.label").alias("other"), F.col("head.one.node").alias("b"), F.col("head.one.n").alias("m"),
                             F.col("head.one.at").alias("b_at"))
        pairs = lists.join(pivot, "place").filter((F.col("label") != F.col("other")) & near("n", "m", "at", "b_at"))
        pairs = untested(pairs.groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("met")))
        pairs = staged(pairs.groupBy("a").agg(F.max_by("b", F.struct("met", "b")).alias("b")).select("a", "b"), "pairs")
        unstaged(heads)
        found = _compared(pairs, known, percent)
        labels = _merged(labels, found)
        linked_now = found.filter("same").count()
        unstaged(found)
        tested = pairs if tested is None else tested.union(pairs)
    else:
        lists, heads = open_lists(ROUNDS)

    nearest = NEAREST
    while not heads.isEmpty():
        named = staged(_rest(lists.join(_shares(heads), "place"), known, percent, nearest), "rest")
        unstaged(heads)
        pairs = staged(untested(named.filter("place is null").select("a", "b")), "pairs")
        found = _compared(pairs, known, percent)
        labels = _merged(labels, found)
        unstaged(found)
        more = named.filter("place is not null").select("place")
        if more.isEmpty():
            break
        # No part of a list is left out: in the end each member may name all others.
        members = members.join(more, "place", "left_semi")
        tested = pairs if tested is None else tested.union(pairs)
        nearest *= NEAREST
        lists, heads = open_lists(ROUNDS)
    unstaged(heads)
    return labels
