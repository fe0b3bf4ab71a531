"""Periodic runs of words, caught online by completed power-of-two blocks.

Words are appended one after the other (or many at once). At every level L = 1, 2, 4, ... each completed block of L words has a
catcher. An appended word completes one suffix of L words per level, and that suffix is compared with the blocks that lie
between L and 2L words before it (2L and 4L where plain squares are asked for), one comparison per catcher. A match is a block that comes again
at a distance q. Its equality is followed to both sides; where it holds for q words or more a square of period q has been found, and
all squares of one period that overlap are one run. Comparisons use 64-bit names of all stretches of 2^k words, made of the names of
their halves, so a stretch is compared in one step and followed in logarithmically many.

No run is missed: a run of period q and at least 3q words holds a whole aligned block of L <= q < 2L words together with its
repetition q words later; for squares, L <= q / 2 gives the same. A multiple of the smallest period gives the same stretch of words,
so of the periods of a stretch the least is kept.

Texts of a slice are appended as one stream, each followed by a word of its own, so that nothing matches across texts. Work is
linear in the words times the number of levels, also for a text that is one long run; memory is 8 bytes per word and level.

Defined results: words end at ASCII white space and are compared as they are; NULL and empty texts have no words and no run; every row is
worked on by itself, so repeated rows, NULL ids and other columns stay as they are; an empty table gives no rows; columns that are
called n_words, runs or collapsed are replaced. Very long texts are worked on whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.llm.texts import slices, starts_of, words

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
ADDED = ("n_words", "runs", "collapsed")

_FIRST, _SECOND, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _FIRST + b * _SECOND
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


class Catchers:
    """The catchers of one stream of words. Words are whole numbers; `longest` bounds the length of a run that can occur."""

    def __init__(self, times: int = LEAST_TIMES, least: int = LEAST_WORDS, longest: int | None = None):
        self.times, self.least, self.longest = max(2, times), least, longest
        #: a suffix meets the blocks that start so many blocks before its own place
        self.reach = (1,) if self.times >= 3 else (2, 3)
        self.n = 0
        self.names: list[np.ndarray] = [np.empty(0, np.uint64)]
        self.found = np.empty((0, 3), np.int64)
        self.open = np.empty((0, 3), np.int64)

    def _levels(self) -> int:
        longest = self.n if self.longest is None else min(self.n, self.longest)
        return max(1, (max(1, longest // self.times // self.reach[0])).bit_length())

    def _extend_names(self, new: np.ndarray) -> list[int]:
        """Names of all stretches that the new words complete; per level, where the new ones start."""
        before = [len(x) for x in self.names]
        zero = np.zeros(len(new), np.uint64)
        self.names[0] = np.concatenate([self.names[0], _named(np.asarray(new).astype(np.uint64), zero)])
        self.n = len(self.names[0])
        while len(self.names) < self._levels():
            self.names.append(np.empty(0, np.uint64))
            before.append(0)
        for k in range(1, len(self.names)):
            half, at = 1 << (k - 1), before[k]
            ends = max(at, self.n - (1 << k) + 1)
            halves = self.names[k - 1]
            self.names[k] = np.concatenate([self.names[k], _named(halves[at:ends], halves[at + half : ends + half])])
        return before

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are alike from places a and b on, b after a."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, on = self.names[k], np.arange(len(a))
            while len(on):
                on = on[b[on] + out[on] < len(names)]
                on = on[names[a[on] + out[on]] == names[b[on] + out[on]]]
                out[on] += 1 << k
                if k < len(self.names) - 1:
                    break
        return out

    def _follow_back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are alike before places a and b, b after a."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, on, size = self.names[k], np.arange(len(a)), 1 << k
            while len(on):
                on = on[a[on] - out[on] >= size]
                on = on[names[a[on] - out[on] - size] == names[b[on] - out[on] - size]]
                out[on] += size
                if k < len(self.names) - 1:
                    break
        return out

    def _squares(self, block: np.ndarray, period: np.ndarray) -> np.ndarray:
        """(start, end, period) of what a block's repetition belongs to."""
        left = self._follow_back(block, block + period)
        right = self._follow(block, block + period)
        return np.unique(np.stack([block - left, block + period + right, period], axis=1), axis=0)

    def append(self, new: np.ndarray) -> None:
        """Words come in; every one advances the comparison of its suffixes, and squares join the runs."""
        before = self._extend_names(new)
        caught = []
        if len(self.open):
            more = self._follow(self.open[:, 1] - self.open[:, 2], self.open[:, 1])
            caught.append(np.stack([self.open[:, 0], self.open[:, 1] + more, self.open[:, 2]], axis=1))
        for k, names in enumerate(self.names):
            suffix = np.arange(before[k], len(names))
            for back in (*self.reach, *((1,) if k == 0 and self.reach[0] > 1 else ())):
                block = (suffix >> k) - back << k
                ready = block >= 0
                meets = ready.copy()
                meets[ready] = names[suffix[ready]] == names[block[ready]]
                if meets.any():
                    caught.append(self._squares(block[meets], (suffix - block)[meets]))
        if not caught:
            self.open = np.empty((0, 3), np.int64)
            return
        runs = np.unique(np.concatenate(caught), axis=0)
        ends = runs[:, 1] == self.n
        self.open = runs[ends]
        self.found = np.unique(np.concatenate([self.found, self._long(runs[~ends])]), axis=0)

    def _long(self, runs: np.ndarray) -> np.ndarray:
        length = runs[:, 1] - runs[:, 0]
        return runs[(length >= self.least) & (length >= self.times * runs[:, 2])]

    def runs(self) -> np.ndarray:
        """(start, end, smallest period) of all runs so far, in order."""
        all_ = np.unique(np.concatenate([self.found, self._long(self.open)]), axis=0)
        # sorted by start, end, period: the first of equal stretches has the least period
        first = np.ones(len(all_), bool)
        first[1:] = (all_[1:, :2] != all_[:-1, :2]).any(axis=1)
        kept = all_[first]
        return kept[np.lexsort((kept[:, 2], kept[:, 0]))]


def runs_of_texts(texts: pa.Array, times: int = LEAST_TIMES, least: int = LEAST_WORDS) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Words per text, runs per text, and the texts in which every run is cut down to its first period."""
    flat, counts = words(texts)
    starts = starts_of(counts)
    coded = flat.dictionary_encode()
    stream = np.empty(len(flat) + len(counts), np.int64)
    place = np.arange(len(flat)) + np.repeat(np.arange(len(counts)), counts)
    stream[place] = coded.indices.to_numpy()
    stream[starts[1:] + np.arange(len(counts))] = len(coded.dictionary) + np.arange(len(counts))
    catchers = Catchers(times, least, int(counts.max(initial=0)))
    catchers.append(stream)
    found = catchers.runs()
    text = np.searchsorted(starts[:-1] + np.arange(len(counts)), found[:, 0], side="right") - 1
    # in the words of all texts there are no words between texts
    first, end, period = found[:, 0] - text, found[:, 1] - text, found[:, 2]
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, first + period, 1)
    np.add.at(change, end, -1)
    keep = np.cumsum(change[:-1]) == 0
    owner = np.repeat(np.arange(len(counts)), counts)
    kept = starts_of(np.bincount(owner[keep], minlength=len(counts)))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(kept.astype(np.int32), flat.filter(pa.array(keep))), " ")
    offsets = starts_of(np.bincount(text, minlength=len(counts))).astype(np.int32)
    struct = pa.StructArray.from_arrays([pa.array(x) for x in (first - starts[text], end - first, period)], fields=list(_RUN))
    return counts.astype(np.int64), pa.ListArray.from_arrays(offsets, struct), collapsed


def find_runs(docs: DataFrame, text: str = "text", times: int = LEAST_TIMES, least: int = LEAST_WORDS) -> DataFrame:
    """All columns of the table, and `n_words`, `runs` (start, length, period) by start, then period, and `collapsed`.

    A run is a stretch of words with a smallest period, at least `least` words and `times` times its period long, which neither neighbouring word
    continues. `collapsed` is the text without what follows a run's first period, its words joined by one blank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            counts, runs, collapsed = runs_of_texts(texts, times, least)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts), runs, collapsed], [*batch.schema.names, *ADDED])

    base = docs.drop(*ADDED)
    long = T.LongType()
    entry = T.StructType([T.StructField(c, long) for c in ("start", "length", "period")])
    added = [T.StructField("n_words", long), T.StructField("runs", T.ArrayType(entry)), T.StructField("collapsed", T.StringType())]
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *added]))


def collapse_documents(docs: DataFrame, text: str = "text", times: int = LEAST_TIMES, least: int = LEAST_WORDS) -> DataFrame:
    """The table with every run of its texts cut down to its first period; texts without a run stay as they are."""
    found = find_runs(docs, text, times, least)
    return found.withColumn(text, F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col(text))).select(docs.drop(*ADDED).columns)
