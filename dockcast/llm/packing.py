"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's ids are cut at whole windows; full windows stand alone, and the last pieces are packed. Pieces are dealt by a hash
into groups of about GROUP_WINDOWS windows' worth of ids, so a group has a bounded size whatever the corpus. Within a group the
pieces are split over as few windows as their sum allows: every piece starts as a partition of itself, and the two
partitions with the largest imbalance are merged so that the fullest window of one takes the emptiest of the other, until
one is left. If its fullest window is above the capacity, the group gets more windows and starts anew.

Defined results: NULL or empty texts have the end id only; ties in length are broken by id and place; rows equal in id
are packed each on their own; an empty table gives no rows; other columns are ignored.
Very long texts are encoded whole and cut into pieces of the capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import store
from dockcast.llm.tokens import encoder

CAPACITY = 4096
GROUP_WINDOWS = 128
#: Documents whose ids a task holds at once.
DOCS_AT_ONCE = 1024
#: Sequence ids are group * ID_STEP + place in the group.
ID_STEP = 1 << 20
PIECE = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def spread(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each length, by differencing: near-equal sums over `windows` windows.

    A partition is its sums, sorted downwards, with what each holds; only differences count, so its smallest sum is
    taken off and kept in a base. The heap gives the largest imbalance first.
    """
    if windows == 1 or len(lengths) == 0:
        return np.zeros(len(lengths), np.int64)
    # A partition is kept sparse: only its windows that hold something, as (sum, items), largest first.
    heap = [(-int(n), i, [(int(n), (i,))]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    tick = len(lengths)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = _merge(a, b, windows)
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (-(merged[0][0] - least), tick, merged))
        tick += 1
    out = np.zeros(len(lengths), np.int64)
    for w, (_, items) in enumerate(heap[0][2]):
        todo = [items]
        while todo:
            x = todo.pop()
            if isinstance(x, int):
                out[x] = w
            else:
                todo.extend(x)
    return out


def _merge(a: list, b: list, windows: int) -> list:
    """Fullest with emptiest: a's windows from the largest, b's from the smallest."""
    free = windows - len(a)
    if len(b) <= free:
        return sorted(a + b, key=lambda x: -x[0])
    # the smallest windows of a take the largest of b that find no free one
    paired = len(b) - free
    kept, met = a[: len(a) - paired], a[len(a) - paired :]
    alone, joined = b[:free], b[free:]
    both = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(met, reversed(joined), strict=True)]
    return sorted(kept + alone + both, key=lambda x: -x[0])


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each length (none above the capacity); the window count rises until no window is too full."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        place = spread(lengths, windows)
        if not len(lengths) or np.bincount(place, lengths).max() <= capacity:
            return place
        windows += 1


def _cut(path: str, end_id: int, capacity: int, with_ids: bool):
    """Documents to pieces, with their ids if asked for."""
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "ids_crc32")] + [("ids", pa.binary())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, DOCS_AT_ONCE) for b in batches for at in range(0, len(b), DOCS_AT_ONCE)):
            ids, counts = encoder(path).encode(batch.column(1))
            stops = np.cumsum(counts)
            rows = []
            for doc, stop, n in zip(batch.column(0).to_pylist(), stops.tolist(), counts.tolist(), strict=True):
                own = np.append(ids[stop - n : stop], np.uint32(end_id)).astype("<u4")
                for start in range(0, n + 1, capacity):
                    raw = own[start : start + capacity].tobytes()
                    rows.append((doc, start, len(raw) // 4, n + 1, zlib.crc32(raw), raw)[: len(fields)])
            columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], schema=pa.schema(fields))

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most `capacity` ids; `ids` are little-endian unsigned 32-bit numbers."""
    return docs.select("doc_id", text).mapInArrow(_cut(tokenizer, end_id, capacity, with_ids), PIECE + ", ids binary" * with_ids)


def _place(capacity: int):
    """A group's pieces to windows. Full pieces take a window each; the others are spread."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        lengths = group["length"].to_numpy()
        n_full = int((lengths == capacity).sum())
        window = np.concatenate([np.arange(n_full), n_full + pack_group(lengths[n_full:], capacity)])
        order = np.argsort(window, kind="stable")
        group, window, lengths = group.take(pa.array(order)), window[order], lengths[order]
        before = np.cumsum(lengths) - lengths
        first = np.concatenate([[True], window[1:] != window[:-1]])
        offset = before - np.maximum.accumulate(np.where(first, before, 0))
        out = group.append_column("sequence_id", pa.array(group["_group"].to_numpy() * ID_STEP + window)).append_column("offset", pa.array(offset))
        return out.select([c.split()[0] for c in PACKED.split(", ")])

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (stored, without their ids) to pieces with sequence_id and offset; only lengths are moved."""
    total = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, total // (GROUP_WINDOWS * capacity))
    dealt = cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups))
    )
    return dealt.groupBy("_group").applyInArrow(_place(capacity), PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """The plan of the sequences: one row per piece of a document."""
    cut = store(pieces(docs, tokenizer, end_id, capacity, text), "pack-pieces")
    return pack(cut, capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """The sequences themselves: sequence_id, its ids and its number of ids before padding."""
    key = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    cut = pieces(docs, tokenizer, end_id, capacity, text, with_ids=True).select(*key, "ids")
    # rows equal in id and ids are interchangeable, so one copy of the ids serves every place
    pairs = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]
    joined = packed.alias("p").join(cut.dropDuplicates(key).alias("c"), pairs[0] & pairs[1] & pairs[2] & pairs[3])
    return (
        joined.select("p.sequence_id", "p.offset", "c.ids")
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (s, x) -> concat(s, x.ids))").alias("ids"))
        .withColumn("length", (F.octet_length("ids") / 4).cast("long"))
    )
