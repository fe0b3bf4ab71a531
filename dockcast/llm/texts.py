"""Arrow batches of texts as slices of bounded size, and their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], column: int | str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches whose texts hold about `most` bytes, with those texts; NULL is an empty text."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            before = int(sizes[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + most)))
            yield batch.slice(at, stop - at), texts.slice(at, stop - at)
            at = stop


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (maximal runs of anything but ASCII white space) one after the other, and the number of words per text."""
    listed = pc.ascii_split_whitespace(texts)
    flat = listed.flatten()
    real = pc.not_equal(flat, "")
    text = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
    counts = np.bincount(text[real.to_numpy(zero_copy_only=False)], minlength=len(listed))
    return flat.filter(real), counts


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each text starts in the words of all, and their number at the end."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
