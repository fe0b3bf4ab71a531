"""Documents linked by the Jaccard similarity of their word n-grams: a grouped prefix join.

A document's set holds the 64-bit hashes of its distinct n-grams. Two sets that reach the similarity share one of the first n - ceil(t * n) + 1
hashes (their prefixes) in any order that is the same for all. The order is that of the numbers, but hashes that many documents hold come last. Those are found by
a count over all documents (of the hashes that can come into a prefix); the MOST_FREQUENT most frequent are put last, which is an order like any other, so nothing
depends on that bound but work. Equal sets are one node, told apart by 128-bit digests. Nodes with identical prefixes and equal size are one group, so a hash's posting list holds groups. Pairs of groups that meet in lists are filtered by their sizes and by how many lists they meet in
(similar sets share about half of their prefixes), then expanded to their members; member pairs are filtered by bitmaps of their sets (every hash flips one of 256 bits, so the bits in which
two bitmaps differ are a lower bound of the hashes in which the sets differ) and verified by the sets themselves: first one pair per node, then the pairs
that these links leave in different components.

Lists (and groups) of more than SMALL nodes are never paired as they are. Lists with the same most central group become one bucket. Of a
bucket the core is taken: the hashes that more than half of PROBES of its nodes hold; any core gives the same links, so it need not be known from all. Let |x| be the hashes in which a node differs from the core, d(x, y) <= |x| + |y|.
Pairs whose |x| + |y| is small enough are linked without a look at them, and all of them are linked to the node with the
least |x| against its size; so one link per node does for all. Any other linked pair differs from the core in a common hash, again
in one of the first few, so the nodes are dealt anew to a bucket per such hash, if it holds a second node and one that is not yet connected with the rest; a bit
table tells that before any row is made. More than half of the probes agree with the core in any one hash, so every bucket leaves them behind, and buckets come near
to half with every step until all are small. The new buckets go on with the differences, not with the sets. No pair is lost, no bucket is cut off, and
nothing is quadratic in a bucket above SMALL. Hashes of a passage that many texts share are in the core, and so out of the way.

Only prefixes and digests are stored. The whole sets of nodes that are looked at are made from their texts again.

Links become components on Spark, with a stored table per step.

Defined results: A-Z are lowered; words end at ASCII white space; fewer words than an n-gram needs make one n-gram; NULL, empty and blank texts have
an empty set and are linked with nothing; rows equal in all columns are members of one component; a NULL doc_id counts after all others; an
empty table gives no rows; other columns are ignored. Very long texts are read whole; a set takes 8 bytes per distinct n-gram, also in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import join_groups, join_known, screen, store, whole_text
from dockcast.llm.simhash import connect
from dockcast.llm.texts import slices, starts_of, words

SHINGLE, PERCENT = 4, 85
#: All pairs of a bucket with at most so many nodes are looked at.
SMALL = 64
#: So many nodes of a large bucket tell its core; all nodes are held against it.
PROBES = 17
#: Places of the bit table of the hashes that are worth a bucket (two megabytes), and of a part of it.
SLOT_BITS, PART_BITS = 24, 18
#: A task's marks are merged whenever there are so many.
MARKS = 1 << 20
#: Hashes that are counted are so many times those of a prefix without frequent ones: texts of which three fifths are frequent hashes still fill their prefixes with others.
COUNTED = 2.7
#: Hashes that are put last, at most; two megabytes.
MOST_FREQUENT = 1 << 18
#: Longs of a bitmap.
MAP = 4

SETS = "doc_id long, text_key binary, n long, sig binary, grouped binary, prefix array<long>, bits array<long>"

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of `width` words."""
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        out = out * _ODD + hashes[k : k + len(out)]
    out = (out ^ (out >> np.uint64(29))) * _MIX
    return out ^ (out >> np.uint64(32))


def shingles(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Texts to the distinct n-gram hashes of each, ascending (as signed numbers), and how many each has."""
    flat, counts = words(pc.ascii_lower(texts))
    coded = flat.dictionary_encode()
    of = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in coded.dictionary.to_pylist()], np.uint64)
    hashes = of[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    parts, owners = [], []
    if len(hashes) >= shingle:
        within = text[: len(text) - shingle + 1] == text[shingle - 1 :]
        parts.append(_joined(hashes, shingle)[within])
        owners.append(text[: len(within)][within])
    starts = starts_of(counts)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    parts.append(np.array([_joined(hashes[starts[i] : starts[i + 1]], int(counts[i]))[0] for i in short], np.uint64))
    owners.append(short)
    found, owner = np.concatenate(parts).view(np.int64), np.concatenate(owners)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], np.bincount(owner[new], minlength=len(counts))


def prefix_length(n, percent: int):
    """Of a set of n hashes, so many must hold one that any similar set has in its own prefix."""
    return n - (percent * n + 99) // 100 + 1


def bitmaps(found: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Per set 64 * MAP bits: whether an even or odd number of hashes falls on each."""
    width = 64 * MAP
    bit = ((found.view(np.uint64) * _ODD) >> np.uint64(40)).astype(np.int64) % width
    odd = np.bincount(owner * width + bit, minlength=size * width).astype(np.uint8) & 1
    return np.packbits(odd.reshape(size, width), axis=1, bitorder="little").view("<i8").reshape(size, MAP)


def _counted(shingle: int, percent: int):
    """(text_key, text) to the hashes that can come into a prefix, those below a limit; once for equal texts of a partition."""
    # more than a prefix holds, for prefixes from which frequent hashes were taken
    limit = np.int64(-(1 << 63) + int((1 << 64) * min(1.0, COUNTED * (100 - percent) / 100)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch, texts in slices(batches, 1):
            new = []
            for i, h in enumerate(batch.column(0).to_pylist()):
                if h not in seen:
                    seen.add(h)
                    new.append(i)
            found, _ = shingles(texts.take(pa.array(new, pa.int64())), shingle)
            yield pa.RecordBatch.from_arrays([pa.array(found[found <= limit])], ["hash"])

    return run


def frequent_hashes(texts: DataFrame, shingle: int, percent: int) -> np.ndarray:
    """The hashes that most documents hold, of those in more than SMALL; ascending, at most MOST_FREQUENT."""
    counts = texts.select("text_key", "text").mapInArrow(_counted(shingle, percent), "hash long").groupBy("hash").count()
    most = counts.filter(F.col("count") > SMALL).orderBy(F.desc("count"), "hash").limit(MOST_FREQUENT)
    return np.sort(np.array([r["hash"] for r in most.select("hash").collect()], np.int64))


def _is_in(found: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.searchsorted(listed, found)
    return listed[np.minimum(at, len(listed) - 1)] == found if len(listed) else np.zeros(len(found), bool)


def _digests(found: np.ndarray, starts: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> list[bytes]:
    """128 bits of the hashes from each start to its end, and a number."""
    raw = memoryview(found.astype("<i8").tobytes())
    salted = zip(starts.tolist(), ends.tolist(), marks.tolist(), strict=True)
    return [blake2b(raw[8 * a : 8 * b], digest_size=16, salt=m.to_bytes(8, "little")).digest() for a, b, m in salted]


def _lists(found: np.ndarray, sizes: np.ndarray, given: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts_of(sizes).astype(np.int32)), pa.array(found), mask=pa.array(~given))


def _sets(shingle: int, percent: int, frequent: np.ndarray):
    """(doc_id, text_key, text) to SETS; the prefix only with the first of a partition's equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch, texts in slices(batches, 2):
            found, counts = shingles(texts, shingle)
            starts, owner = starts_of(counts), np.repeat(np.arange(len(counts)), counts)
            sig = _digests(found, starts[:-1], starts[1:], counts)
            bits = bitmaps(found, owner, len(counts))
            ordered = found[np.lexsort((found, _is_in(found, frequent), owner))]
            kept = np.where(counts > 0, prefix_length(counts, percent), 0)
            grouped = _digests(ordered, starts[:-1], starts[:-1] + kept, counts)
            first = np.zeros(len(sig), bool)
            for i, s in enumerate(sig):
                if counts[i] and s not in seen:
                    seen.add(s)
                    first[i] = True
            taken = (np.arange(len(found)) < (starts[:-1] + kept)[owner]) & first[owner]
            maps = pa.ListArray.from_arrays(np.arange(0, len(counts) * MAP + 1, MAP, dtype=np.int32), pa.array(bits.ravel()))
            cells = [batch.column(0), batch.column(1), pa.array(counts.astype(np.int64)), pa.array(sig, pa.binary()), pa.array(grouped, pa.binary())]
            yield pa.RecordBatch.from_arrays([*cells, _lists(ordered[taken], np.where(first, kept, 0), first), maps], [c.split()[0] for c in SETS.split(", ")])

    return run


def _whole(shingle: int):
    """(node, n, text) to (node, n, hashes): whole sets, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 2):
            found, counts = shingles(texts, shingle)
            lists = _lists(found, counts, np.ones(len(counts), bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["node", "n", "hashes"])

    return run


def _pairs(percent: int):
    """Sorted small buckets (bucket, node, n, open) to pairs of nodes that their sizes allow, and in how many buckets they meet; one of each is open."""

    def listed(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        bucket, node, n, open_ = rows
        found = []
        for k in range(1, SMALL):
            same = np.flatnonzero(bucket[k:] == bucket[:-k])
            if not len(same):
                break
            x, y = same, same + k
            fits = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (open_[x] | open_[y])
            a, b = node[x[fits]], node[y[fits]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
        every = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        order = np.lexsort((every[:, 1], every[:, 0]))
        every = every[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(every)), bool), (every[1:] != every[:-1]).any(axis=1)]))
        times = np.diff(np.append(new, len(every)))
        return pa.RecordBatch.from_arrays([pa.array(every[new, 0]), pa.array(every[new, 1]), pa.array(times)], ["a", "b", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            last = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            if last:
                yield listed(tuple(c[:last] for c in rows))
            held = tuple(c[last:] for c in rows)
        if held is not None:
            yield listed(held)

    return run


def small_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of nodes of small buckets (bucket, node, n, open), and in how many buckets they meet."""
    rows = buckets.select("bucket", "node", "n", "open").repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(_pairs(percent), "a long, b long, times long").groupBy("a", "b").agg(F.sum("times").alias("times"))


def enough(pairs: DataFrame, groups: DataFrame, large_lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups that meet in enough lists to be similar.

    A common hash is in both prefixes, or it comes after the end of the prefix that ends first. So the sets share at most as many as their prefixes do,
    and the rest of the larger one. What prefixes share are the small lists that were counted and, at most, the large lists that each is in.
    """
    for c in "ab":
        own = groups.select(F.col("gid").alias(c), F.col("n").alias(f"n{c}"))
        many = large_lists.select(F.col("gid").alias(c), F.col("uncounted").alias(f"u{c}"))
        pairs = pairs.join(own, c).join(many, c, "left")
    uncounted = F.least(F.coalesce("ua", F.lit(0)), F.coalesce("ub", F.lit(0)))
    larger = F.greatest("na", "nb")
    most = F.col("times") + uncounted + larger - prefix_column(larger, percent)
    return pairs.filter((100 + percent) * most >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def prefix_column(n: Column, percent: int) -> Column:
    return n - F.floor((percent * n + 99) / 100) + 1


def differing(n: Column, m: Column, percent: int) -> Column:
    """The most hashes in which similar sets of these sizes differ."""
    return F.floor((100 - percent) * (n + m) / (100 + percent))


def _wholes(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node, n and hashes of the wanted nodes (one column), from one text of each. Other texts are passed over by a bit table."""
    asked = store(nodes.join(wanted.select("node").distinct(), "node").select("node", "n", "text_key"), "join-asked")
    short = F.xxhash64("text_key")
    near = screen(texts.select("text", "text_key"), short, asked.select(short.alias("h")), max(1, asked.count()).bit_length() + 4).filter("_maybe")
    one = near.groupBy("text_key").agg(F.first("text").alias("text"))
    made = asked.join(one, "text_key").select("node", "n", "text").mapInArrow(_whole(shingle), "node long, n long, hashes array<long>")
    return store(made, "join-wholes")


def _sized(rows: DataFrame, total: int) -> DataFrame:
    """rows with `m`, the nodes of their bucket; only buckets with two nodes or more and an open one."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m"), F.max("open").alias("_any")).filter("m > 1 AND _any").drop("_any")
    return join_known(rows, store(sizes, "join-sizes"), "bucket", "m", total)


def _cores(held: DataFrame) -> DataFrame:
    """Per bucket of (bucket, node, m, base) its core, from PROBES nodes (all, of fewer): what more than half of them hold. Also its m, as `_m`."""
    at = F.xxhash64("bucket", "node")
    some = held.filter(F.pmod(at, F.col("m")) < 4 * PROBES).withColumn("_at", at)
    probes = some.withColumn("_k", F.row_number().over(Window.partitionBy("bucket").orderBy("_at", "node"))).filter(F.col("_k") <= PROBES)
    hashes = probes.select("bucket", "m", F.explode("base").alias("hash"))
    most = hashes.groupBy("bucket", "hash").agg(F.count("*").alias("c"), F.first("m").alias("m")).filter(2 * F.col("c") > F.least("m", F.lit(PROBES)))
    return most.groupBy("bucket").agg(F.array_sort(F.collect_list("hash")).alias("core"), F.first("m").alias("_m"))


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (bucket, open, prefix, ...): per entry of the prefixes its row, its hash and its place in the bit table."""
    lists = batch.column("prefix")
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    found = lists.flatten().to_numpy()
    mixed = (found.view(np.uint64) ^ (batch.column("bucket").to_numpy().view(np.uint64)[row] * _ODD)) * _MIX
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD
    return row, found, (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, open, prefix) to (part, marks): per place that a task has met, whether twice (1) and whether by an open node (2), packed."""

    def packed(met: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        places, at = np.unique(np.concatenate(met) >> 1, return_inverse=True)
        twice = np.bincount(at, minlength=len(places)) > 1
        by_open = np.bincount(at, weights=np.concatenate(met) & 1, minlength=len(places)) > 0
        marks = ((places & ((1 << PART_BITS) - 1)) << 2 | twice | by_open.astype(np.int64) << 1).astype("<u4")
        parts, starts = np.unique(places >> PART_BITS, return_index=True)
        blobs = [m.tobytes() for m in np.split(marks, starts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(blobs, pa.binary())], ["part", "marks"])

    met: list[np.ndarray] = []
    for batch in batches:
        row, _, place = _entries(batch)
        if len(place):
            met.append(place << 1 | batch.column("open").to_numpy(zero_copy_only=False)[row])
        if sum(map(len, met)) >= MARKS:
            yield from packed(met)
            met = []
    if met:
        yield from packed(met)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All marks of some parts to (part, bits): places that two nodes have met, one of them open."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, marks in zip(batch.column("part").to_pylist(), batch.column("marks").to_pylist(), strict=True):
            seen = held.setdefault(part, np.zeros(1 << PART_BITS, np.uint8))
            found = np.frombuffer(marks, "<u4")
            # bit 0: met, bit 1: met twice, bit 2: met by an open node; a place comes once in a row of marks
            place, twice, by_open = found >> 2, (found & 1).astype(np.uint8), (found >> 1 & 1).astype(np.uint8)
            seen[place] |= ((seen[place] & 1 | twice) << 1) | 1 | by_open << 2
    for part, seen in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.packbits(seen == 7).tobytes()], pa.binary())], ["part", "bits"])


def _dealt(useful: np.ndarray):
    """(bucket, node, n, open, prefix) to a row per hash whose place in the bit table is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found, place = _entries(batch)
            kept = np.flatnonzero(useful[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
            own = batch.select(["bucket", "node", "n", "open"]).take(pa.array(row[kept]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found[kept])], ["parent", "node", "n", "open", "hash"])

    return run


def _deal(left: DataFrame) -> DataFrame:
    """Rows (bucket, node, n, open, prefix) to the rows of their next buckets, without those that hold one node or no open one.

    The bit table has one size, however many hashes there are: the more, the more rows pass needlessly; none is missed.
    """
    marks = left.select("bucket", "open", "prefix").mapInArrow(_marks, "part long, marks binary").repartition("part")
    size = 1 << PART_BITS >> 3
    useful = np.zeros(1 << SLOT_BITS >> 3, np.uint8)
    for r in marks.mapInArrow(_merged, "part long, bits binary").collect():
        useful[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    rows = left.mapInArrow(_dealt(useful), "parent long, node long, n long, open boolean, hash long")
    return rows.select(F.xxhash64("parent", "hash").alias("bucket"), "node", "n", "open", "parent")


def _halved(held: DataFrame, total: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Large buckets (bucket, node, n, m, open, base) to sure links (a, b), the rows of the next, smaller buckets, and (parent, node, base) for those.

    A base is a node's set, or the hashes in which it differs from the core of the bucket that this one comes from: differences from one set differ
    as the sets do. Nodes that are not open are connected with each other already, so pairs of them are of no interest. What is surely linked to a bucket's centre joins them, if
    one of them is there too or none is in the bucket.
    """
    # a core holds at most twice as many hashes as its probes' mean base
    core = store(_cores(held), "join-cores")
    own = F.coalesce("core", F.array().cast("array<long>"))
    met = join_groups(held, core, "bucket", "_m", total).withColumn("off", F.concat(F.array_except("base", own), F.array_except(own, F.col("base"))))
    weight = (100 + percent) * F.size("off") - (100 - percent) * F.col("n")
    at = store(met.select("bucket", "node", "n", "m", "open", "off", weight.alias("w")), "join-off")
    centre = at.groupBy("bucket").agg(F.min(F.struct("w", "node")).alias("c"), F.count("*").alias("_size"))
    sure = (F.col("w") + F.col("c.w") <= 0) | (F.col("node") == F.col("c.node"))
    marked = join_groups(at, centre, "bucket", "_size", total).withColumn("sure", sure)
    linked = marked.filter("sure AND node <> c.node").select(F.col("node").alias("a"), F.col("c.node").alias("b"))
    flags = marked.groupBy("bucket").agg(
        F.max(~F.col("open")).alias("closed"), F.max(~F.col("open") & F.col("sure")).alias("meets"),
        F.max(F.col("open") & ~F.col("sure")).alias("apart"), F.max("open").alias("any"), F.count("*").alias("_rows"),
    )
    one = ~F.col("closed") | F.col("meets")
    alive = store(flags.filter(F.when(one, F.col("apart")).otherwise(F.col("any"))).select("bucket", one.alias("one"), "_rows"), "join-alive")
    left = join_known(marked, alive, "bucket", "_rows", total)
    largest = F.floor(100 * F.col("n") / percent)
    kept = F.least(F.size("off").cast("long"), differing(F.col("n"), largest, percent) + 1).cast("int")
    open_ = F.col("open") & ~(F.col("sure") & F.col("one"))
    left = store(left.select("bucket", "node", "n", open_.alias("open"), F.slice("off", F.lit(1), kept).alias("prefix")), "join-left")
    return linked, _deal(left), at.select(F.col("bucket").alias("parent"), "node", F.col("off").alias("base"))


def _families(shared: DataFrame) -> DataFrame:
    """Large lists (bucket, gid) to (bucket, gid) without repeats: lists with one most central group are one bucket."""
    total = shared.count()
    times = shared.groupBy("gid").agg(F.count("*").alias("times"))
    family = shared.join(times, "gid").groupBy("bucket").agg(F.max(F.struct("times", "gid"))["gid"].alias("family"), F.count("*").alias("_rows"))
    return join_known(shared.select("bucket", "gid"), store(family, "join-families"), "bucket", "_rows", total).select(F.col("family").alias("bucket"), "gid").distinct()


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs of nodes those whose bitmaps allow that they are similar."""
    short = sets.filter("prefix IS NOT NULL").select("node", "n", "bits")
    left, right = (short.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits{c}")) for c in "ab")
    off = F.aggregate(F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    met = pairs.join(left, "a").join(right, "b")
    return met.filter(off <= differing(F.col("na"), F.col("nb"), percent)).select("a", "b")


def _verified(near: DataFrame, wholes: DataFrame, percent: int) -> DataFrame:
    """Of pairs of nodes those that are similar, by their sets."""
    left, right = (wholes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("hashes").alias(f"h{c}")) for c in "ab")
    common = F.size(F.array_intersect("ha", "hb"))
    return near.join(left, "a").join(right, "b").filter((100 + percent) * common >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def links(texts: DataFrame, sets: DataFrame, nodes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes: all similar pairs are connected by them, and no others."""
    groups = nodes.groupBy("grouped").agg(F.min("node").alias("gid"), F.count("*").alias("size"), F.first("n").alias("n"))
    groups = store(groups, "join-groups")
    first = sets.filter("prefix IS NOT NULL").select(F.col("node").alias("gid"), "prefix")
    prefixes = store(groups.select("gid", "size", "n").join(first, "gid"), "join-prefixes")
    several = groups.filter("size > 1").select("grouped", "gid", "size")
    members = store(join_groups(nodes.select("grouped", "node", "n"), several, "grouped", "size", max(1, nodes.count())).filter("gid IS NOT NULL"), "join-members")

    def expand(rows: DataFrame, column: str) -> DataFrame:
        own = members.select(F.col("gid").alias(column), F.col("node").alias("_node"))
        return rows.join(own, column, "left").withColumn(column, F.coalesce("_node", column)).drop("_node")

    posted = prefixes.select("gid", "size", "n", F.explode("prefix").alias("bucket"))
    sizes = posted.groupBy("bucket").agg(F.sum("size").alias("m"), F.count("*").alias("lists")).filter("lists > 1")
    total = prefixes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    # most hashes are in one list alone: their rows should not get as far as a join's output
    shared = store(join_known(posted, store(sizes, "join-sizes"), "bucket", "lists", total).drop("lists"), "join-shared")
    yes = F.lit(True).alias("open")
    few = shared.filter(F.col("m") <= SMALL).select("bucket", F.col("gid").alias("node"), "n", yes)
    large_lists = store(shared.filter(F.col("m") > SMALL).groupBy("gid").agg(F.count("*").alias("uncounted")), "join-uncounted")
    met = store(enough(small_pairs(few, percent), groups, large_lists, percent), "join-met")
    pairs = [expand(expand(met, "a"), "b")]
    inside = members.filter(F.col("size") <= SMALL).select(F.col("gid").alias("bucket"), "node", "n", yes)
    pairs.append(small_pairs(inside, percent).select("a", "b"))

    many = _families(shared.filter(F.col("m") > SMALL).select("bucket", "gid")).withColumn("node", F.col("gid"))
    many = expand(many.select("bucket", "node"), "node").unionByName(members.filter(F.col("size") > SMALL).select(F.col("gid").alias("bucket"), "node"))
    at = store(many.distinct().join(nodes.select("node", "n"), "node").select("bucket", "node", "n", yes), "join-buckets")
    sure, bases = [], None
    while not at.isEmpty():
        sized = store(_sized(at, at.count()), "join-sized")
        pairs.append(small_pairs(sized.filter(F.col("m") <= SMALL), percent).select("a", "b"))
        large = sized.filter(F.col("m") > SMALL)
        if large.isEmpty():
            break
        if bases is None:
            held = large.join(_wholes(texts, nodes, large, shingle).select("node", F.col("hashes").alias("base")), "node")
        else:
            held = large.join(bases, ["parent", "node"])
        linked, again, bases = _halved(held, large.count(), percent)
        sure.append(linked)
        at = store(again, "join-buckets")
    near = store(_near(reduce(DataFrame.unionByName, pairs).distinct(), sets, percent), "join-near")
    both = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node")))
    wholes = _wholes(texts, nodes, both, shingle)
    first = near.groupBy("b").agg(F.min("a").alias("a"))
    linked = store(reduce(DataFrame.unionByName, [_verified(first, wholes, percent), *sure]).distinct(), "join-first")
    open_ = store(_apart(near, connect(linked)).join(first, ["a", "b"], "left_anti"), "join-open")
    return linked.unionByName(_verified(open_, wholes, percent))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components so far (roots: node, root of all that are not roots themselves)."""
    held = store(roots, "join-roots")
    for c in "ab":
        pairs = pairs.join(held.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c, "left")
    return pairs.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id of its component) and n_sets, the component's distinct sets."""
    given = whole_text(text)
    texts = docs.select("doc_id", F.unhex(F.md5(given.cast("binary"))).alias("text_key"), given.alias("text"))
    frequent = frequent_hashes(texts, shingle, percent)
    sets = store(texts.mapInArrow(_sets(shingle, percent, frequent), SETS).withColumn("node", F.monotonically_increasing_id()), "join-sets")
    first = F.when(F.col("prefix").isNotNull(), F.struct("node", "text_key"))
    nodes = sets.filter("n > 0").groupBy("sig").agg(
        F.min(first).alias("one"), F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("grouped").alias("grouped")
    )
    nodes = store(nodes.select("sig", "one.node", "one.text_key", "least", "rows", "n", "grouped"), "join-nodes")
    roots = store(connect(store(links(texts, sets, nodes, shingle, percent).distinct(), "join-links")).withColumnRenamed("node", "_node"), "join-roots")
    rooted = nodes.select("sig", "node", "least", "rows").join(roots, F.col("node") == F.col("_node"), "left")
    rooted = store(rooted.select("sig", "rows", "least", F.coalesce("root", "node").alias("root")), "join-rooted")
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_sets"))
    named = join_groups(rooted, whole, "root", "n_sets", max(1, nodes.count())).select("sig", "rows", "component_id", "n_sets")
    rows = sets.select("doc_id", "n", "sig")
    linked = join_groups(rows.filter("n > 0"), store(named, "join-components"), "sig", "rows", max(1, sets.count()))
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_sets"))
    out = linked.select("doc_id", "n", "component_id", "n_sets").unionByName(alone)
    return out.withColumnRenamed("n", "n_shingles")
