"""Scoring texts with a probabilistic suffix tree, beside an add-one unigram baseline.

The tree's symbols are the bytes of a text whose words (A-Z lowered, split at ASCII white space) are joined by single
blanks, with byte 255, which UTF-8 never uses, as the end and as what stands before the first byte. Spark counts all
(DEPTH + 1)-grams of the training texts. A context of up to DEPTH bytes becomes a state if it makes up at least
LEAST_SHARE of the training symbols and its next-symbol distribution diverges from that of its longest proper suffix.
A state's distribution is smoothed towards that of its longest suffix among the states, the root's towards equal shares.

LEAST_SHARE bounds the model: at most 1 / LEAST_SHARE contexts per length, whatever the corpus, so every task can hold it. It is
compiled to an automaton whose nodes know the longest state that is a suffix of what was read; a batch of texts is cut into
streams that run through the automaton in step.

The baseline needs the count of every word. The HEAD_WORDS most frequent words (a bounded table) are known to every task; all
other words are joined by a shuffle, in which no word is frequent.

Defined results: NULL text is empty and has the end token only; NULL ids count as the empty id; without training texts every
symbol has an equal share and no token is known; an empty table gives no rows; repeated rows are scored each on their own;
other columns are ignored. Very long texts are
read and scored whole; their symbols run through the automaton in parallel streams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import store

DEPTH = 5
LEAST_SHARE = 1e-4
LEAST_DIVERGENCE = 0.01  # nats
PRIOR = 16.0  # symbols that the smoothing counts for
HEAD_WORDS = 1 << 17
END = 255
SLICE_BYTES = 2 << 20
STREAM = 2048


@dataclass(frozen=True)
class Tree:
    """The automaton over the symbols seen in training, and one that stands for all others.

    `symbol` numbers the bytes; per node and symbol there are the next node and the log10 probability; `start` is the node after
    an end.
    """

    symbol: np.ndarray
    step: np.ndarray
    log10: np.ndarray
    start: int
    n_states: int
    depth: int


@dataclass(frozen=True)
class Unigrams:
    """Counts of all words (a stored table), all training tokens with ends, distinct ones, ends, and the frequent words."""

    counts: DataFrame
    tokens: int
    distinct: int
    ends: int


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Batches of bounded text size, with their lowered words as lists."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES)))
            yield batch.slice(at, stop - at), pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(at, stop - at)))
            at = stop


def _words(listed: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and for each the number of its text."""
    words = listed.flatten()
    text = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
    real = pc.not_equal(words, "")
    return words.filter(real), text[real.to_numpy(zero_copy_only=False)]


def _bytes(listed: pa.Array, ends: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one array of symbols, each followed by `ends` end symbols, and where each text's first end is."""
    joined = pc.utf8_trim(pc.binary_join(listed, " "), " ")
    sizes = pc.binary_length(joined).to_numpy(zero_copy_only=False).astype(np.int64)
    first_end = np.cumsum(sizes + ends) - ends
    out = np.full(int((sizes + ends).sum()), END, np.uint8)
    text = np.ones(len(out), bool)
    for k in range(ends):
        text[first_end + k] = False
    raw = joined.buffers()[2]
    if raw is not None and sizes.sum():
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1]
        out[text] = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    return out, first_end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, listed in _slices(batches, 0):
        counted = pc.value_counts(_words(listed)[0])
        yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "n"])


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _count_grams(depth: int):
    """A partition's (depth + 1)-grams as numbers, the next symbol in the lowest byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for _, listed in _slices(batches, 0):
            symbols, first_end = _bytes(listed, depth)
            padded = np.concatenate([np.full(depth, END, np.uint8), symbols]).astype(np.int64)
            codes = np.zeros(len(symbols), np.int64)
            for k in range(depth + 1):
                codes = (codes << 8) | padded[k : k + len(symbols)]
            real = np.ones(len(symbols), bool)
            for k in range(1, depth):
                real[first_end + k] = False
            parts.append(np.unique(codes[real], return_counts=True))
            if sum(len(p[0]) for p in parts) > 1 << 20:
                parts = [_merge(parts)]
        if parts:
            codes, counts = _merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["gram", "n"])

    return run


def train_unigrams(docs: DataFrame, text: str = "text") -> Unigrams:
    counts = store(docs.select(text).mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = docs.count()
    return Unigrams(counts, words + ends, distinct + (ends > 0), ends)


def contexts(
    docs: DataFrame, text: str = "text", depth: int = DEPTH, least_share: float = LEAST_SHARE, least_divergence: float = LEAST_DIVERGENCE
) -> DataFrame:
    """The states with their next symbols: depth, context, symbol, n, total. The root is always there."""
    grams = docs.select(text).mapInArrow(_count_grams(depth), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = store(grams, "lm-grams")
    context = F.when(F.col("depth") == 0, F.lit(0)).otherwise(
        F.shiftright("gram", 8).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("depth") * 8) - 1)
    )
    parts = (
        grams.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
        .groupBy("depth", context.alias("context"), F.col("gram").bitwiseAND(F.lit(255)).alias("symbol"))
        .agg(F.sum("n").alias("n"))
    )
    parts = store(parts, "lm-parts")
    all_symbols = grams.agg(F.sum("n")).first()[0] or 0
    totals = parts.groupBy("depth", "context").agg(F.sum("n").alias("total")).filter(F.col("total") >= least_share * all_symbols)
    # at most (depth + 1) / least_share contexts pass, so their symbols are a bounded table from here on
    common = store(parts.join(F.broadcast(totals), ["depth", "context"]), "lm-contexts")
    parent_mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("depth") - 1) * 8) - 1
    shorter = common.select(F.col("depth").alias("_d"), F.col("context").alias("_c"), F.col("symbol").alias("_s"), (F.col("n") / F.col("total")).alias("_p"))
    child = common.filter("depth > 0").withColumn("_up", F.when(F.col("depth") == 1, F.lit(0)).otherwise(F.col("context").bitwiseAND(parent_mask)))
    met = child.join(shorter, (F.col("depth") - 1 == F.col("_d")) & (F.col("_up") == F.col("_c")) & (F.col("symbol") == F.col("_s")))
    share = F.col("n") / F.col("total")
    kept = met.groupBy("depth", "context").agg(F.sum(share * F.log(share / F.col("_p"))).alias("divergence")).filter(F.col("divergence") >= least_divergence)
    states = common.join(F.broadcast(kept.select("depth", "context")), ["depth", "context"], "left_semi")
    return states.unionByName(common.filter("depth = 0"))


def compile_tree(states: pa.Table, depth: int = DEPTH) -> Tree:
    """States (depth, context, symbol, n) to the automaton."""
    depths, contexts_, symbols, counts = (states[c].to_numpy() for c in ("depth", "context", "symbol", "n"))
    used = np.union1d(symbols[depths == 0], [END]).astype(np.int64)
    other, width = len(used), len(used) + 1
    symbol = np.full(256, other, np.int64)
    symbol[used] = np.arange(other)
    pairs, state = np.unique(np.stack([depths.astype(np.int64), contexts_]), axis=1, return_inverse=True)
    names = [int(c).to_bytes(8, "big", signed=True)[8 - d :] if d else b"" for d, c in pairs.T.tolist()] or [b""]
    seen = np.zeros((len(names), width))
    np.add.at(seen, (state.ravel(), symbol[symbols]), counts)
    row = {name: i for i, name in enumerate(names)}
    smooth = np.empty((len(names), width))
    for name in sorted(names, key=len):
        i = row[name]
        rest = next((smooth[row[name[k:]]] for k in range(1, len(name) + 1) if name[k:] in row), 1 / 256)
        smooth[i] = (seen[i] + PRIOR * rest) / (seen[i].sum() + PRIOR)
    np.log10(smooth, out=smooth)
    nodes = sorted({name[:k] for name in names for k in range(len(name) + 1)}, key=lambda x: (len(x), x))
    number = {name: i for i, name in enumerate(nodes)}
    step = np.zeros((len(nodes), width), np.int32)
    log10 = np.empty((len(nodes), width), np.float32)
    children: dict[bytes, list[bytes]] = {}
    for name in nodes[1:]:
        children.setdefault(name[:-1], []).append(name)
    for i, name in enumerate(nodes):  # shorter ones first, so the suffix's row is ready
        suffix = next((number[name[k:]] for k in range(1, len(name) + 1) if name[k:] in number), 0)
        if name:
            step[i] = step[suffix]
        log10[i] = smooth[row[name]] if name in row else log10[suffix]
        for child in children.get(name, ()):
            step[i, symbol[child[-1]]] = number[child]
    start = 0
    for _ in range(depth):
        start = int(step[start, symbol[END]])
    step[:, symbol[END]] = start
    return Tree(symbol, step, log10, start, len(names), depth)


def train_tree(docs: DataFrame, text: str = "text") -> Tree:
    return compile_tree(contexts(docs, text).select("depth", "context", "symbol", "n").toArrow())


def score_symbols(tree: Tree, symbols: np.ndarray) -> np.ndarray:
    """log10 probability of every symbol. Streams start `depth` symbols early, which is all a state can depend on."""
    n, depth, width = len(symbols), tree.depth, tree.step.shape[1]
    streams = max(1, -(-n // STREAM))
    padded = np.full(depth + streams * STREAM, END, np.uint8)
    padded[depth : depth + n] = symbols
    columns = np.lib.stride_tricks.as_strided(padded, (streams, depth + STREAM), (STREAM, 1)).T
    step, log10 = tree.step.ravel(), tree.log10.ravel()
    out = np.empty((STREAM, streams), np.float32)
    node = np.zeros(streams, np.int64)
    for t in range(depth + STREAM):
        if t == depth:
            node[0] = tree.start
        place = node * width + tree.symbol[columns[t]]
        if t >= depth:
            out[t - depth] = log10[place]
        node = step[place].astype(np.int64)
    return out.T.reshape(-1)[:n]


SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, score double, word string, tf long"
_SCORED = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("word", pa.string()), ("tf", pa.int64())]
)


def _score(tree: Tree, head: dict[str, int], below: float, ends: int):
    """Per text a row with its scores as far as the frequent words go, and a row per other word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch, listed in _slices(batches, 1):
            n = len(listed)
            rows = row + np.arange(n)
            row += n
            symbols, end = _bytes(listed, 1)
            score = np.add.reduceat(score_symbols(tree, symbols).astype(np.float64), np.concatenate([[0], end[:-1] + 1]))
            words, text = _words(listed)
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy()
            known = np.array([head.get(w, 0) for w in coded.dictionary.to_pylist()], np.int64)
            count = known[codes]
            found = count > 0
            base = np.bincount(text[found], np.log10((count[found] + 1) / below), n) + np.log10((ends + 1) / below)
            n_tokens = np.bincount(text, minlength=n) + 1
            n_known = np.bincount(text[found], minlength=n) + (ends > 0)
            nothing = pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), batch.column(0), pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(score), *nothing], schema=_SCORED
            )
            pairs, tf = np.unique(text[~found] * np.int64(len(known)) + codes[~found], return_counts=True)
            if len(pairs):
                m = len(pairs)
                other = coded.dictionary.take(pa.array(pairs % len(known)))
                empty = [pa.nulls(m, t) for t in (pa.int64(),) * 3 + (pa.float64(),) * 2]
                yield pa.RecordBatch.from_arrays([pa.array(rows[pairs // len(known)]), *empty, other, pa.array(tf)], schema=_SCORED)

    return run


def score(docs: DataFrame, tree: Tree, words: Unigrams, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    below = float(words.tokens + words.distinct + 1)
    frequent = words.counts.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).toArrow()  # a bounded table
    head = dict(zip(frequent["word"].to_pylist(), frequent["c"].to_pylist(), strict=True))
    run = _score(tree, head, below, words.ends)
    out = store(docs.select("doc_id", text).mapInArrow(run, SCORED), "lm-scored")
    c = F.coalesce("c", F.lit(0))
    other = (
        out.filter("word IS NOT NULL")
        .select("row", "word", "tf")
        .join(words.counts, "word", "left")
        .groupBy("row")
        .agg(F.sum(F.col("tf") * F.log10((c + 1) / F.lit(below))).alias("more"), F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("also"))
    )
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return (
        out.filter("word IS NULL")
        .drop("word", "tf")
        .join(other, "row", "left")
        .select(
            "doc_id", "n_tokens", plus("n_known", "also").alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
            plus("base", "more").alias("base_score"), "score",
        )
    )


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2
