"""Exact deduplication by a Golomb-coded exchange of fingerprints.

Every partition of the documents sends each owner (a range of fingerprints) its distinct fingerprints, sorted and
Golomb-Rice-coded, about two bits more than the range makes necessary. The owner answers with a bitmap: which of them
another partition has as well. Only documents under such a fingerprint, or one that a partition holds twice itself, are
suspects; only their texts are shuffled, and texts are grouped by their bytes, so a fingerprint decides nothing.

A fingerprint that a third of all rows has is sent once per partition, and its texts are merged before the shuffle.

Defined results: NULL text equals the empty text; of equal texts the row with the largest doc_id stays (NULL ids are
smallest), of rows equal in doc_id too any one; an empty table gives no rows; other columns are ignored by decide() and
kept by drop_copies(), whatever their names (names that start with an underscore are ours). Very long texts are hashed whole, and
compared whole where their fingerprints meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import first_of, join_groups, screen, store, whole_text

#: Fingerprints of one owner, about; and bits of a fingerprint beyond those that number the documents.
OWNER_ROWS = 1 << 21
SPARE_BITS = 12
MESSAGE = "owner long, sender long, n long, rice int, coded binary, twice binary"


def rice_encode(values: np.ndarray, rice: int) -> bytes:
    """Sorted distinct values as differences: quotient in unary, a zero, and `rice` bits of remainder."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotient = (gaps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(quotient + 1 + rice)
    starts = ends - (quotient + 1 + rice)
    bits = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    within = np.arange(int(quotient.sum())) - np.repeat(np.cumsum(quotient) - quotient, quotient)
    bits[np.repeat(starts, quotient) + within] = 1
    for b in range(rice):
        bits[starts + quotient + 1 + b] = ((gaps >> np.uint64(rice - 1 - b)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).tobytes()


def rice_decode(coded: bytes, n: int, rice: int) -> np.ndarray:
    """The values again. The zeros that end the unary parts are found one after the other, all else at once."""
    bits = np.unpackbits(np.frombuffer(coded, np.uint8))
    zeros = np.flatnonzero(bits == 0)
    next_zero = np.searchsorted(zeros, np.arange(len(bits) + 1)).tolist()
    where = zeros.tolist()
    stops, at = np.empty(n, np.int64), 0
    for i in range(n):
        stop = where[next_zero[at]]
        stops[i] = stop
        at = stop + 1 + rice
    starts = np.concatenate([[0], stops[:-1] + 1 + rice]) if n else stops
    gaps = (stops - starts).astype(np.uint64) << np.uint64(rice)
    for b in range(rice):
        gaps |= bits[stops + 1 + b].astype(np.uint64) << np.uint64(rice - 1 - b)
    return np.cumsum(gaps, dtype=np.uint64)


def _rice(n: int, span: int) -> int:
    return max(0, int(np.log2(max(1.0, span / max(1, n)) * 0.69)))


def _send(bits: int, owner_bits: int):
    """A partition's messages: one per owner that it has fingerprints for."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values, counts = np.unique(np.concatenate(held).astype(np.uint64) if held else np.empty(0, np.uint64), return_counts=True)
        width = np.uint64(bits - owner_bits)
        owners = values >> width
        rows = []
        for owner in np.unique(owners):
            lo, hi = np.searchsorted(owners, [owner, owner + np.uint64(1)])
            own = values[lo:hi] - (owner << width)
            rice = _rice(len(own), 1 << int(width))
            rows.append((int(owner), TaskContext.get().partitionId(), hi - lo, rice, rice_encode(own, rice), np.packbits(counts[lo:hi] > 1).tobytes()))
        frame = pd.DataFrame(rows, columns=["owner", "sender", "n", "rice", "coded", "twice"]).astype({"owner": "int64", "sender": "int64", "n": "int64", "rice": "int32"})
        yield pa.RecordBatch.from_pandas(frame, preserve_index=False, schema=_MESSAGE)

    return send


_MESSAGE = pa.schema(
    [("owner", pa.int64()), ("sender", pa.int64()), ("n", pa.int64()), ("rice", pa.int32()), ("coded", pa.binary()), ("twice", pa.binary())]
)


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: which fingerprints of each message another one has too."""
    values = [rice_decode(m.coded, m.n, m.rice) for m in messages.itertuples()]
    every, inverse, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = np.split(counts[inverse] > 1, np.cumsum([len(v) for v in values])[:-1])
    return pd.DataFrame({"owner": messages["owner"], "sender": messages["sender"], "shared": [np.packbits(s).tobytes() for s in shared]})


def _suspected(bits: int, owner_bits: int):
    """A sender reads its bitmaps: the fingerprints that some other document has as well."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for m in frame.itertuples():
                on = np.unpackbits(np.frombuffer(m.shared, np.uint8) | np.frombuffer(m.twice, np.uint8), count=m.n).astype(bool)
                values = rice_decode(m.coded, m.n, m.rice)[on] + (np.uint64(m.owner) << np.uint64(bits - owner_bits))
                yield pd.DataFrame({"fp": values.astype(np.int64)})

    return read


def suspects(fingerprints: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """The fingerprints (one long column, `bits` bits) that more than one row has."""
    sent = store(fingerprints.mapInArrow(_send(bits, owner_bits), MESSAGE), "dedup-messages")
    answers = sent.select("owner", "sender", "n", "rice", "coded").groupBy("owner").applyInPandas(_answer, "owner long, sender long, shared binary")
    return sent.join(answers, ["owner", "sender"]).mapInPandas(_suspected(bits, owner_bits), "fp long").distinct()


class _Exchange:
    """The documents split by the exchange: those that share no fingerprint, and the suspects."""

    def __init__(self, docs: DataFrame, text: str):
        self.total = docs.count()
        numbering = max(1, self.total).bit_length()
        bits = min(62, numbering + SPARE_BITS)
        owner_bits = max(3, numbering - (OWNER_ROWS.bit_length() - 1))
        fp = F.shiftrightunsigned(F.xxhash64(whole_text(text)), 64 - bits)
        doubtful = store(suspects(docs.select(fp.alias("fp")), bits, owner_bits), "dedup-suspects")
        self.screened = screen(docs, fp, doubtful, numbering + 3)
        self.sha = F.sha2(whole_text(text), 256)
        self.text = whole_text(text)

    def alone(self) -> DataFrame:
        return self.screened.filter(~F.col("_maybe")).drop("_maybe")

    def suspects(self) -> DataFrame:
        return self.screened.filter("_maybe").drop("_maybe")

    def verdicts(self) -> DataFrame:
        """One row per suspect. Texts are grouped by their bytes, merged before the shuffle."""
        groups = self.suspects().groupBy(self.text.alias("_text")).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        groups = store(groups.select(F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size"), "dedup-groups")
        rows = store(self.suspects().select("doc_id", self.sha.alias("text_sha256")), "dedup-members")
        joined = join_groups(rows, groups, "text_sha256", "group_size", self.total)
        return first_of(joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))), ["text_sha256"], "kept")


def decide(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, `keep_id`, `group_size`, `kept` and `text_sha256`."""
    split = _Exchange(docs, text)
    alone = split.alone().select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), split.sha.alias("text_sha256")
    )
    return alone.unionByName(split.verdicts())


def drop_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Only suspects are shuffled."""
    split = _Exchange(docs, text)
    stay = split.verdicts().filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_stay"))
    own = split.suspects().withColumn("_sha", split.sha)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_stay"))
    kept = own.join(stay, same, "left_semi").dropDuplicates(["doc_id", "_sha"]).drop("_sha")
    return split.alone().unionByName(kept)
