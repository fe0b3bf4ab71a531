"""Token ids as binary shards in a word-aligned code, written and read by Spark.

Simple-8b: a 64-bit word has a 4-bit selector and up to 60 bits of payload, which holds as many ids of one width as fit.
Ids are coded in blocks of BLOCK ids that start at a word; the block offsets let a reader decode any block alone, and all
words with one selector are decoded at once. An id of 60 bits or more is an escape: its place holds 0, and place and
value stand in a list behind the words.

A shard, little-endian: magic, version, ids per block, then the numbers of documents, ids, words and escapes; ids of the
documents; ids per document; word offsets of the blocks; words; escapes. A shard holds whole documents. A dataset is a
Parquet folder with a shard per row (`file`, `shard`, `n_ids`, `payload`), so Spark's own commit protocol writes it, on any
storage and once, however many tasks are lost; `file` and `shard` number the shards in ascending order of doc_id.

Defined results: NULL or empty texts have the end id only; NULL ids come first; equal ids are ordered by a hash of
the text; an empty table gives an empty dataset; other columns are ignored. Very long texts are
encoded whole and lie in one shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockcast.llm.common import whole_text
from dockcast.llm.tokens import encoder

BLOCK = 1024
SHARD_IDS = 1 << 20
#: Documents that are encoded at once.
DOCS_AT_ONCE = 1024
MAGIC, VERSION = b"S8BT", 1
HEADER = struct.Struct("<4sHHQQQQ")
NO_ID = -(1 << 63)

# Ids per word and bits per id, by selector; the last one is a run of zeros.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 120])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
_PAD = int(COUNTS.max())
_ESCAPED = np.uint64(1 << 60)
FILES = "file long, shard long, n_ids long, payload binary"


def _selectors(widths: np.ndarray) -> np.ndarray:
    """For every place of every block the selector that takes the most ids from there. Maxima over windows by doubling."""
    length = widths.shape[1] - _PAD
    best = np.full((widths.shape[0], length), np.argmax(COUNTS == 1), np.uint8)
    over = {1: widths}
    for count in sorted(set(COUNTS.tolist()) - {1}):
        part = max(c for c in over if 2 * c >= count and c < count) if count > 2 else 1
        base = over[part]
        shift = count - part
        over[count] = np.maximum(base[:, : base.shape[1] - shift], base[:, shift:])
        selector = int(np.argmax(COUNTS == count))
        best[over[count][:, :length] <= WIDTHS[selector]] = selector
    return best


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids to words, word offsets of the blocks (one more than blocks), and escapes as rows (place, value)."""
    ids = ids.astype(np.uint64)
    escaped = np.flatnonzero(ids >= _ESCAPED)
    escapes = np.stack([escaped.astype(np.uint64), ids[escaped]], axis=1)
    n_blocks = -(-len(ids) // BLOCK)
    grid = np.zeros((n_blocks, BLOCK + _PAD), np.uint64)
    flat = np.zeros(n_blocks * BLOCK, np.uint64)
    flat[: len(ids)] = ids
    flat[escaped] = 0
    grid[:, :BLOCK] = flat.reshape(n_blocks, BLOCK)
    if not n_blocks:
        return np.empty(0, np.uint64), np.zeros(1, np.uint64), escapes
    best = _selectors(_bit_lengths(grid))
    lengths = np.full(n_blocks, BLOCK)
    lengths[-1] = len(ids) - (n_blocks - 1) * BLOCK
    rows, at, steps = np.arange(n_blocks), np.zeros(n_blocks, np.int64), []
    while len(rows):
        chosen = best[rows, at]
        steps.append((rows, at, chosen))
        at = at + COUNTS[chosen]
        open_ = at < lengths[rows]
        rows, at = rows[open_], at[open_]
    row, place, chosen = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.lexsort((place, row))
    row, place, chosen = row[order], place[order], chosen[order]
    words = chosen.astype(np.uint64) << np.uint64(60)
    cells = grid.ravel()
    for selector in np.unique(chosen):
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        own = np.flatnonzero(chosen == selector)
        first = row[own] * (BLOCK + _PAD) + place[own]
        if width:
            packed = np.zeros(len(own), np.uint64)
            for k in range(count):
                packed |= cells[first + k] << np.uint64(k * width)
            words[own] |= packed
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_blocks))]).astype(np.uint64)
    return words, offsets, escapes


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    out = np.zeros(values.shape, np.uint8)
    top = int(values.max(initial=0)).bit_length()
    for b in range(top):
        out += values >= np.uint64(1 << b)
    return out


def decode_ids(words: np.ndarray, offsets: np.ndarray, n_ids: int, escapes: np.ndarray) -> np.ndarray:
    """All blocks at once, one step per selector."""
    n_blocks = len(offsets) - 1
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    before = np.cumsum(counts) - counts
    per_block = np.diff(offsets.astype(np.int64))
    row = np.repeat(np.arange(n_blocks), per_block)
    place = before - np.repeat(before[offsets[:-1].astype(np.int64)], per_block) if n_blocks else before
    cells = np.zeros(n_blocks * (BLOCK + _PAD), np.uint64)
    for selector in np.unique(chosen):
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        if not width:
            continue
        own = np.flatnonzero(chosen == selector)
        first = row[own] * (BLOCK + _PAD) + place[own]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            cells[first + k] = (words[own] >> np.uint64(k * width)) & mask
    ids = cells.reshape(n_blocks, BLOCK + _PAD)[:, :BLOCK].reshape(-1)[:n_ids].copy()
    ids[escapes[:, 0].astype(np.int64)] = escapes[:, 1]
    return ids


def encode_shard(docs: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets, escapes = encode_ids(ids)
    head = HEADER.pack(MAGIC, VERSION, BLOCK, len(docs), len(ids), len(words), len(escapes))
    parts = (docs.astype("<i8"), lengths.astype("<u8"), offsets.astype("<u8"), words.astype("<u8"), escapes.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def decode_shard(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the documents, ids per document, and all ids."""
    magic, version, block, n_docs, n_ids, n_words, n_escapes = HEADER.unpack_from(payload)
    if (magic, version, block) != (MAGIC, VERSION, BLOCK):
        raise ValueError("not a shard of this version")
    at = HEADER.size

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        at += 8 * n
        return np.frombuffer(payload, kind, n, at - 8 * n)

    docs, lengths = take(n_docs, "<i8"), take(n_docs, "<u8")
    offsets, words, escapes = take(-(-n_ids // BLOCK) + 1, "<u8"), take(n_words, "<u8"), take(2 * n_escapes, "<u8").reshape(-1, 2)
    return docs, lengths, decode_ids(words, offsets, n_ids, escapes)


def _shards(path: str, end_id: int):
    """A sorted partition of documents to its shards, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, shard = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            docs, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            row = [[file], [shard], [len(ids)], [encode_shard(docs, lengths, ids)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(),) * 3 + (pa.binary(),), strict=True)], ["file", "shard", "n_ids", "payload"])

        for batch in batches:
            docs = batch.column(0).fill_null(NO_ID).to_numpy()
            for at in range(0, len(docs), DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                ids, counts = encoder(path).encode(part.column(1))
                held.append((docs[at : at + DOCS_AT_ONCE], counts + 1, np.insert(ids, np.cumsum(counts), np.uint32(end_id))))
                if sum(len(h[2]) for h in held) >= SHARD_IDS:
                    yield out()
                    held, shard = [], shard + 1
        if held:
            yield out()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, text: str = "text") -> None:
    """Writes the ids of all documents, each followed by `end_id`, in ascending order of doc_id."""
    rows = docs.select("doc_id", whole_text(text).alias("_text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("_text")]
    dealt = rows.repartitionByRange(docs.sparkSession.sparkContext.defaultParallelism * 8, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(_shards(tokenizer, end_id), FILES).write.mode("errorifexists").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, shard, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            docs, lengths, ids = decode_shard(payload)
            stops = np.cumsum(lengths.astype(np.int64))
            raw = memoryview(ids.astype("<u4").tobytes())
            starts = stops - lengths.astype(np.int64)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
            own = pa.array(docs, pa.int64(), mask=docs == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(docs), pa.int64()), pa.array([shard] * len(docs), pa.int64()), own, pa.array(starts), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                ["file", "shard", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, `start` (ids of all documents before it), `n_tokens` and `ids_crc32`, all from the files.

    Shards are counted per file, files by a running sum over one row each, so no step sorts the documents.
    """
    files = spark.read.parquet(path)
    sizes = files.groupBy("file", "shard").agg(F.sum("n_ids").alias("n_ids"))
    per_file = sizes.groupBy("file").agg(F.sum("n_ids").alias("n_file"))
    base = per_file.select("file", (F.sum("n_file").over(Window.orderBy("file")) - F.col("n_file")).alias("base"))
    inside = sizes.select("file", "shard", (F.sum("n_ids").over(Window.partitionBy("file").orderBy("shard")) - F.col("n_ids")).alias("inside"))
    found = files.select("file", "shard", "payload").mapInArrow(_read, "file long, shard long, doc_id long, within long, n_tokens long, ids_crc32 long")
    start = (F.col("base") + F.col("inside") + F.col("within")).alias("start")
    return found.join(inside.join(base, "file"), ["file", "shard"]).select("doc_id", start, "n_tokens", "ids_crc32")
