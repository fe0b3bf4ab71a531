"""Ranked lexical search: best-first over document intervals, bounded by range maxima of the posting lists.

Documents are kept as rows of (term, occurrences) for the terms that the queries ask for. A task takes such rows in segments. In a
segment every term has a posting list in document order, with the impact of each posting (what it adds to a score), and a sparse
table over it that gives the place of the greatest impact of any range in one step. A query starts with the whole segment as one
interval. The sum of its terms' range maxima bounds every score inside. The intervals with the greatest bounds are taken first;
each is split at the document with the greatest single impact, which is scored, and both sides get bounds of their own. An interval is dropped
when its bound cannot reach the query's last place any more. Places already found in earlier segments of the task count, so
later segments are cut off sooner. The best of all tasks are merged in two steps by ranks. Nothing is skipped: what is dropped is proven to be lower.

Inside a segment the documents are ordered by which of the commonest terms they hold, so intervals hold alike documents and bounds are close.

Queries are taken in blocks of about QUERIES_AT_ONCE, so that what every task holds is bounded (their terms and weights); documents are
spread over tasks and only (query, rank) candidates are shuffled.

Score: see `impacts`. Equal scores are ranked by ascending doc_id.

Defined results: NULL and empty texts have no terms, are found by no query and do not count; very long texts are read whole; rows with equal
doc_id are documents of their own; a NULL doc_id ranks after all others of its score; a query is a distinct (item_id, text), one without
terms gives no rows; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import store
from dockcast.llm.texts import slices, starts_of, words

TOP = 50
QUERIES_AT_ONCE = 4096
#: Documents of a segment, queries that are searched together in it, and intervals of each that are split at once.
SEGMENT, TOGETHER, AT_ONCE = 8192, 64, 32
#: Commonest terms by which the documents of a segment are ordered.
ORDERING_TERMS = 24

NO_ID = np.iinfo(np.int64).max
FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"
HITS = "item int, doc_id long, score long"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts, and their number per text: maximal runs of ASCII letters and digits and all other non-ASCII characters, A-Z lowered."""
    if texts.offset or texts.null_count:
        texts = pa.concat_arrays([pc.fill_null(texts, ""), pa.array([], texts.type)]) if not texts.offset else pa.array(texts.to_pylist(), texts.type).fill_null("")
    valid, offsets, data = texts.buffers()
    folded = pa.py_buffer(data.to_pybytes().translate(_FOLD)) if data is not None else data
    return words(pa.Array.from_buffers(texts.type, len(texts), [None, offsets, folded]))


@dataclass(frozen=True)
class Queries:
    """A block of queries: per query its terms as numbers of the vocabulary, filled up with -1."""

    ids: list
    vocabulary: list[str]
    terms: np.ndarray

    @staticmethod
    def of(rows: list) -> Queries:
        flat, counts = terms_of(pa.array([r.text or "" for r in rows], pa.string()))
        coded = flat.dictionary_encode()
        at, own = starts_of(counts), coded.indices.to_numpy()
        sets = [np.unique(own[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        padded = np.full((len(rows), max([1, *map(len, sets)])), -1, np.int64)
        for i, s in enumerate(sets):
            padded[i, : len(s)] = s
        return Queries([r.item_id for r in rows], coded.dictionary.to_pylist(), padded)


def _forward(vocabulary: list[str]):
    """Documents with a term to (doc_id, number of terms, terms of the vocabulary, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch, texts in slices(batches, 1):
            flat, counts = terms_of(texts)
            coded = flat.dictionary_encode()
            number = pc.fill_null(pc.index_in(coded.dictionary, known), -1).to_numpy()
            term = number[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
            text = np.repeat(np.arange(len(counts)), counts)[term >= 0]
            key, times = np.unique(text * max(1, len(vocabulary)) + term[term >= 0], return_counts=True)
            text, term = np.divmod(key, max(1, len(vocabulary)))
            offsets = starts_of(np.bincount(text, minlength=len(counts))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (term, times)]
            rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.astype(np.int64)), *lists], ["doc_id", "n", "terms", "counts"])
            yield rows.filter(pa.array(counts > 0))

    return run


def weights(found: np.ndarray, n_docs: int) -> np.ndarray:
    """The weight of a term that `found` documents hold."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in found], np.int64)


def impacts(weight: np.ndarray, times: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of a document with n terms that holds it so many times; whole numbers."""
    m = 50 + 50 * n * n_docs // max(1, n_terms)
    return weight * (1_000_000_000 * times // (1000 * times + 20 * m))


class RangeMaxima:
    """Sparse tables over an array: the place of the greatest value of any range that is no longer than `longest`."""

    def __init__(self, values: np.ndarray, longest: int):
        self.values = values
        levels = [np.arange(len(values), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            half, last = 1 << (len(levels) - 1), levels[-1]
            a, b = last[:-half], last[half:]
            levels.append(np.where(values[a] >= values[b], a, b))
        self.base = np.cumsum([0, *map(len, levels)])[:-1]
        self.flat = np.concatenate(levels)
        self.level = np.concatenate([[0], np.floor(np.log2(np.arange(1, max(2, longest + 1)))).astype(np.int64)])

    def places(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places of the maxima of the ranges lo..hi, which hold something."""
        k = self.level[hi - lo]
        base = self.base[k]
        a, b = self.flat[base + lo], self.flat[base + hi - (1 << k)]
        return np.where(self.values[a] >= self.values[b], a, b)


class Best:
    """The best `top` documents of each query so far."""

    def __init__(self, queries: int, top: int):
        self.top = top
        self.item, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        #: what a document must beat: score, and id where scores are equal
        self.least, self.last = np.zeros(queries, np.int64), np.full(queries, NO_ID)

    def offer(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = (score > self.least[item]) | ((score == self.least[item]) & (score > 0) & (ids < self.last[item]))
        if not better.any():
            return
        item, score, ids = (np.concatenate([x, y[better]]) for x, y in ((self.item, item), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, item))
        item = item[order]
        new = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        rank = np.arange(len(item)) - np.repeat(new, np.diff(np.append(new, len(item))))
        kept = rank < self.top
        self.item, self.score, self.id = item[kept], score[order][kept], ids[order][kept]
        full = rank == self.top - 1
        self.least[item[full]], self.last[item[full]] = score[order][full], ids[order][full]


class Segment:
    """Posting lists of some documents, with their sparse tables."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        size = len(ids)
        owner = np.repeat(np.arange(size), np.diff(offsets))
        common = np.argsort(-np.bincount(terms, minlength=len(weight)), kind="stable")[:ORDERING_TERMS]
        bit = np.zeros(len(weight), np.int64)
        bit[common] = 1 << np.arange(len(common))[::-1]
        order = np.lexsort((ids, np.bincount(owner, bit[terms], size)))
        place = np.empty(size, np.int64)
        place[order] = np.arange(size)
        self.size, self.ids = size, ids[order]
        key = terms.astype(np.int64) * size + place[owner]
        by = np.argsort(key)
        self.key, self.doc = key[by], place[owner][by]
        self.impact = impacts(weight[terms], counts.astype(np.int64), n[owner], n_docs, n_terms)[by]
        self.start = np.searchsorted(self.key, np.arange(len(weight) + 1) * size)
        self.maxima = RangeMaxima(self.impact, int(np.diff(self.start).max(initial=1)))
        self.oldest = RangeMaxima(-self.ids, size)

    def _bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of postings (interval x term) to the bound of each interval and the document with the greatest single impact."""
        row, column = np.nonzero(hi > lo)
        place = self.maxima.places(lo[row, column], hi[row, column])
        bound, doc = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        if len(row):
            value = self.impact[place]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            bound[row[first]] = np.add.reduceat(value, first)
            highest = np.maximum.reduceat(value, first)
            top = np.flatnonzero(value == np.repeat(highest, np.diff(np.append(first, len(row)))))
            doc[row[top]] = self.doc[place[top]]
        return bound, doc

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Queries by their terms (query x term, -1 is none); what is found goes to `best`."""
        none = terms < 0
        lo, hi = (np.where(none, 0, self.start[terms + k]).astype(np.int32) for k in (0, 1))
        bound, doc = self._bounds(lo, hi)
        at = np.arange(len(terms))
        held = (at, np.zeros(len(at), np.int64), np.full(len(at), self.size), bound, doc, lo, hi)
        while True:
            query, a, b, bound, doc, lo, hi = held
            open_ = bound > best.least[query]
            tied = np.flatnonzero((bound == best.least[query]) & (bound > 0))
            if len(tied):
                open_[tied] = self.ids[self.oldest.places(a[tied], b[tied])] < best.last[query[tied]]
            if not open_.any():
                return
            left = np.flatnonzero(open_)
            left = left[np.lexsort((-bound[left], query[left]))]
            owner = query[left]
            new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            rank = np.arange(len(owner)) - np.repeat(new, np.diff(np.append(new, len(owner))))
            taken, rest = (tuple(x[left[m]] for x in held) for m in (rank < AT_ONCE, rank >= AT_ONCE))
            query, a, b, _, doc, lo, hi = taken
            row, column = np.nonzero(hi > lo)
            wanted = terms[query[row], column] * self.size + doc[row]
            split = np.searchsorted(self.key, wanted)
            on = self.key[np.minimum(split, len(self.key) - 1)] == wanted
            score = np.bincount(row[on], self.impact[split[on]], len(query)).astype(np.int64)
            best.offer(query, score, self.ids[doc])
            middle, after = lo.copy(), hi.copy()
            middle[row, column] = split
            after[row, column] = split + on
            after[hi <= lo] = hi[hi <= lo]
            children = []
            for c, d, x, y in ((a, doc, lo, middle), (doc + 1, b, after, hi)):
                value, at_doc = self._bounds(x, y)
                real = value > 0
                children.append(tuple(z[real] for z in (query, c, d, value, at_doc, x, y)))
            held = tuple(np.concatenate(x) for x in zip(rest, *children, strict=True))


def _search(queries: Queries, weight: np.ndarray, n_docs: int, n_terms: int, top: int):
    """Rows of the forward table to the best documents of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = np.split(queries.terms, range(TOGETHER, len(queries.terms), TOGETHER))
        best = [Best(len(g), top) for g in groups]
        held: list[pa.RecordBatch] = []

        def segment() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            terms, counts = table.column("terms").combine_chunks(), table.column("counts").combine_chunks()
            ids = pc.fill_null(table.column("doc_id"), NO_ID).to_numpy()
            own = Segment(ids, table.column("n").to_numpy(), terms.offsets.to_numpy(), terms.flatten().to_numpy(), counts.flatten().to_numpy(), weight, n_docs, n_terms)
            if not len(own.key):
                return
            for terms, found in zip(groups, best, strict=True):
                own.search(terms, found)

        for batch in batches:
            for at in range(0, len(batch), SEGMENT):
                held.append(batch.slice(at, SEGMENT))
                if sum(map(len, held)) >= SEGMENT:
                    segment()
                    held = []
        if held:
            segment()
        for i, b in enumerate(best):
            ids = pa.array(b.id, mask=b.id == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array((b.item + i * TOGETHER).astype(np.int32)), ids, pa.array(b.score)], ["item", "doc_id", "score"])

    return run


def _ranked(hits: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, rows: list, top: int, text: str) -> DataFrame:
    spark = docs.sparkSession
    queries = Queries.of(rows)
    forward = store(docs.select("doc_id", text).mapInArrow(_forward(queries.vocabulary), FORWARD), "search-forward")
    n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = np.zeros(len(queries.vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row per term of the block
        found[r["term"]] = r["count"]
    hits = forward.mapInArrow(_search(queries, weights(found, n_docs), n_docs, n_terms, top), HITS)
    few = _ranked(hits.withColumn("part", F.spark_partition_id() % 64), ["item", "part"], top).drop("part", "rank")
    names = spark.createDataFrame(list(enumerate(queries.ids)), "item int, item_id long")
    return _ranked(few, ["item"], top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text") -> DataFrame:
    """For every query (item_id, text) its best documents: item_id, rank, doc_id, score."""
    distinct = store(items.select("item_id", "text").distinct(), "search-queries")
    blocks = -(-distinct.count() // QUERIES_AT_ONCE)
    if not blocks:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = [_search_block(docs, distinct.filter(block == i).orderBy("item_id", "text").collect(), top, text) for i in range(blocks)]
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole
