"""Near-duplicates by SimHash: fingerprints that differ in few bits, found by joining a binary trie with itself.

A fingerprint's bits are majorities over the hashes of word shingles. Distinct fingerprints are the rows from then on, so
copies cost nothing. Two fingerprints within the budget of e bits agree in at least one of e + 1 parts of their bits;
each part gives a layout with those bits first, and equal first bits put fingerprints into one bucket. Inside a
partition the sorted buckets are tries whose nodes are ranges. Pairs of nodes are followed down together; a pair whose
bits already differ in more than e places is dropped.

A bucket with too many fingerprints is cut anew by the parts of its remaining bits, as often as necessary: as the rows
are distinct, r remaining bits hold at most 2^r, so there is no cap and no pair is lost.

A bucket reports a star per connected set, not its pairs. Stars are joined to components by alternating large-star
and small-star steps on Spark, with every step's table in the shared folder.

Defined results: NULL and empty texts have fingerprint 0 and are linked like others; fewer words than a shingle needs
form one shingle; rows equal in all columns are separate members of one component; an empty table gives no rows; other
columns are ignored by components() and kept by drop_near_copies(). Very long texts are read whole, with some hundred
bytes of memory per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import computed_once, first_of, join_groups, screen, store, whole_text

BITS = 64
SHINGLE, BUDGET = 3, 2
#: A bucket with more fingerprints than this is cut anew; pairs of nodes that are followed at once.
MOST_IN_BUCKET = 1 << 16
FRONTIER = 1 << 16
#: Links that are held before they are merged into the sets.
LINKS = 1 << 19


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text. A-Z are lowered; words end at ASCII white space; a tie in a bit gives 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    hashed = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashed, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashed)).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).astype(np.int64))

    return of(text)


def layout(path: tuple[int, ...], budget: int) -> tuple[list[int], int]:
    """The order of the bits that a path of parts gives, and how many of them are shared in a bucket."""
    shared: list[int] = []
    rest = list(range(BITS))
    for part in path:
        cuts = [list(c) for c in np.array_split(rest, budget + 1)]
        shared += cuts[part]
        rest = [b for i, c in enumerate(cuts) if i != part for b in c]
    return shared + rest, len(shared)


def permute(values: np.ndarray, order: list[int]) -> np.ndarray:
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.ascontiguousarray(np.packbits(bits[:, order], axis=1)).view(">u8").ravel().astype(np.uint64)


def _lay_out(budget: int, deeper: bool):
    """Each fingerprint under the layouts of every part: path, bucket (the shared bits), and the reordered value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            paths = batch.column(1).to_pylist() if deeper else [""] * len(values)
            for path in sorted(set(paths)):
                own = values[[p == path for p in paths]]
                for part in range(budget + 1):
                    order, shared = layout((*map(int, path), part), budget)
                    value = permute(own, order)
                    bucket = (value >> np.uint64(BITS - shared)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{path}{part}"] * len(own)), pa.array(bucket), pa.array(value.astype(np.int64)), pa.array(own.astype(np.int64))],
                        ["path", "bucket", "value", "fp"],
                    )

    return run


LAID = "path string, bucket long, value long, fp long"


class _Sets:
    """Connected sets of 0..n-1, fed with arrays of links. Links inside a set are dropped at once, the others merged in bulk."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        new = self.of[a] != self.of[b]
        if new.any():
            self.held.append((a[new], b[new]))
        if sum(len(x) for x, _ in self.held) > LINKS:
            self.merge()

    def merge(self) -> None:
        if not self.held:
            return
        a, b = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held = []
        while len(a):
            x, y = self.of[a], self.of[b]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(jumped := self.of[self.of], self.of):
                self.of = jumped
            open_ = self.of[a] != self.of[b]
            a, b = a[open_], b[open_]


def join_trie(values: np.ndarray, shared: int, budget: int) -> np.ndarray:
    """Sorted distinct values whose first `shared` bits name the bucket: per value the first one of its connected set.

    The trie of each bucket meets itself. A pair of nodes is two ranges and the bits in which they differ so far; both
    split at the next bit. Two single values are compared at once.
    """
    sets = _Sets(len(values))
    zeros: dict[int, np.ndarray] = {}

    def split(depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Where the ones of that bit start in each range."""
        if depth not in zeros:
            zeros[depth] = np.concatenate([[0], np.cumsum((values >> np.uint64(BITS - 1 - depth)) & np.uint64(1) == 0)])
        return lo + zeros[depth][hi] - zeros[depth][lo]

    head = values >> np.uint64(BITS - shared)
    starts = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(values) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(values)) if len(starts) else starts
    stack = [(shared, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
    while stack:
        depth, a, b, c, d, off = stack.pop()
        single = (b - a == 1) & (d - c == 1)
        i, j = a[single], c[single]
        near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        sets.link(i[near], j[near])
        a, b, c, d, off = (x[~single] for x in (a, b, c, d, off))
        if not len(a):
            continue
        if len(a) > FRONTIER:
            stack += [(depth, *(x[i : i + FRONTIER].copy() for x in (a, b, c, d, off))) for i in range(0, len(a), FRONTIER)]
            continue
        m, n = split(depth, a, b), split(depth, c, d)
        own = a == c
        more = off < budget
        crossed = more & ~own
        parts = [
            (a, m, c, n, off),
            (m, b, n, d, off),
            (a[more], m[more], n[more], d[more], off[more] + 1),
            (m[crossed], b[crossed], c[crossed], n[crossed], off[crossed] + 1),
        ]
        together = [np.concatenate(x) for x in zip(*parts, strict=True)]
        full = (together[1] > together[0]) & (together[3] > together[2])
        stack.append((depth + 1, *(x[full] for x in together)))
    sets.merge()
    return sets.of


def _stars(budget: int):
    """The buckets of a partition to links (a, b): a fingerprint and the first of its connected set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = [b.to_pandas() for b in batches]
        if not frames:
            return
        for path, own in pd.concat(frames).groupby("path"):
            values, first = np.unique(own["value"].to_numpy().astype(np.uint64), return_index=True)
            fps = own["fp"].to_numpy()[first]
            of = join_trie(values, layout(tuple(map(int, path)), budget)[1], budget)
            moved = of != np.arange(len(of))
            yield pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[of[moved]])], ["a", "b"])

    return run


def links(prints: DataFrame, budget: int = BUDGET, most: int = MOST_IN_BUCKET) -> DataFrame:
    """Distinct fingerprints (one long column) to links (a, b) that connect all pairs within the budget, and no others."""
    laid = store(prints.mapInArrow(_lay_out(budget, False), LAID), "simhash-buckets")
    found = []
    while True:
        sizes = laid.groupBy("path", "bucket").count()
        # at most rows / most buckets can be large; the limit grows with the rows, so they are few enough to broadcast
        rows = laid.count()
        limit = max(most, rows // 50_000)
        large = store(sizes.filter(F.col("count") > limit).select("path", "bucket"), "simhash-large")
        again = large.count() > 0
        ready = laid.join(F.broadcast(large), ["path", "bucket"], "left_anti") if again else laid
        dealt = ready.repartition(max(8, rows // (4 * MOST_IN_BUCKET)), "path", "bucket")
        found.append(store(dealt.mapInArrow(_stars(budget), "a long, b long"), "simhash-links"))
        if not again:
            break
        rest = laid.join(F.broadcast(large), ["path", "bucket"]).select("fp", "path")
        laid = store(rest.mapInArrow(_lay_out(budget, True), LAID), "simhash-buckets")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def connect(edges: DataFrame) -> DataFrame:
    """Links (a, b) to (node, root) for every node that is not its component's smallest, which is the root."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs if not large else pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        met = both.join(least, "a")
        if large:
            return met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        moved = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    at = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = state(at)
    while before[0]:
        at = store(star(star(at, True), False), "components")
        now = state(at)
        if now == before:
            break
        before = now
    return at.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, text: str = "text") -> DataFrame:
    """One row per document: doc_id, `fp` (signed), `component_id` (the smallest id of the component) and `n_prints`, its fingerprints."""
    rows = store(docs.select("doc_id", fingerprint_column(F.col(text), shingle).alias("fp")), "simhash-prints")
    nodes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    roots = store(connect(links(nodes.select("fp"), budget)), "simhash-roots")
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_prints"))
    linked = store(rooted.select("fp", "n", "root").join(ids, "root").select("fp", "n", "component_id", "n_prints"), "simhash-components")
    return join_groups(rows, linked, "fp", "n", docs.count()).select("doc_id", "fp", "component_id", "n_prints")


def drop_linked(docs: DataFrame, found: DataFrame, key: str, key_of: Callable[[], Column]) -> DataFrame:
    """One document of each component_id in `found` (doc_id, the key, component_id): the one with that id, with all its columns.

    Rows that are dropped are few against the texts, so all others pass by a bit table; the rest is joined.
    """
    decided = found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    marked = store(first_of(decided, ["component_id"], "kept").select("doc_id", key, "kept"), "simhash-verdicts")
    dropped = marked.filter("NOT kept").select(F.xxhash64("doc_id").alias("h"))
    split = screen(docs, F.xxhash64("doc_id"), dropped, max(1, marked.count()).bit_length() + 3)
    stay = marked.filter("kept").select(F.col("doc_id").alias("_id"), F.col(key).alias("_stay"))
    # the key is worked out for these rows only; the optimizer would otherwise filter all rows on it first
    doubtful = split.filter("_maybe").drop("_maybe").withColumn("_key", computed_once(key_of()))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_stay"))
    kept = doubtful.join(stay, same, "left_semi").dropDuplicates(["doc_id", "_key"]).drop("_key")
    return split.filter(~F.col("_maybe")).drop("_maybe").unionByName(kept)


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, text: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    return drop_linked(docs, components(docs, shingle, budget, text), "fp", lambda: fingerprint_column(F.col(text), shingle))
