"""Token ids of whole texts by a public tokenizer, word by word with a cache.

The tokenizer drops white space, and none of its pieces crosses ASCII white space, so a text's ids are the ids of its
words in order. Each distinct piece of a word is encoded once per process and looked up from then on; a full cache
keeps the pieces that came again. Plain words (Latin letters, then punctuation) go straight to the model, all others through the whole tokenizer.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Distinct pieces that a process keeps, and bytes of text that are encoded at once.
MOST_PIECES = 250_000
SLICE_BYTES = 4 << 20

# Letters whose lower case and normal form are themselves or one letter, and ASCII punctuation.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = rf"^(?P<word>[{_LETTERS}]+)(?P<rest>[!-/:-@\[-`{{-~]*)$"


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes are themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Encodes arrays of texts to one array of ids and the number of ids per text.

    A plain word is two pieces, its letters and its punctuation (or nothing); any other word is one piece, marked by a tab,
    which no word holds. The cache maps pieces to places in arrays.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.empty(1 << 14, np.int64)
        self.counts = np.empty(1 << 14, np.int32)
        self.slices = np.zeros(1 << 14, np.int32)
        self.used = 0
        self._learn([""])

    def _forget(self) -> None:
        """Keeps the pieces that came in most slices, at most half of the cache and none that came once."""
        held = np.array(list(self.place), dtype=object)[1:]  # the first piece, the empty one, is always there
        slices = self.slices[1 : 1 + len(held)]
        kept = np.flatnonzero(slices > max([1, *np.sort(slices)[-(MOST_PIECES // 2) :][:1].tolist()]))
        kept = np.concatenate([[0], 1 + kept])
        starts, counts, often = self.starts[kept], self.counts[kept], self.slices[kept] // 2
        sums = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(starts - sums[:-1], counts) + np.arange(sums[-1])]
        self.place = dict(zip(["", *held[kept[1:] - 1].tolist()], range(len(kept)), strict=True))
        self.ids[: len(ids)], self.used = ids, len(ids)
        self.starts[: len(kept)], self.counts[: len(kept)] = sums[:-1], counts
        self.slices[:] = 0
        self.slices[: len(kept)] = often

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces. The letters for bytes are put in for all pieces at once."""
        if not pieces:
            return []
        mapped = "\n".join(pieces).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
        model = self.model.tokenize
        whole = self.tokenizer.encode
        return [
            whole(piece[1:], add_special_tokens=False).ids if piece[:1] == "\t" else [t.id for t in model(own)] if own else []
            for piece, own in zip(pieces, mapped, strict=True)
        ]

    def _learn(self, pieces: list[str]) -> None:
        """Appends the ids of pieces that are not in the cache."""
        encoded = self._encoded(pieces)
        counts = np.fromiter(map(len, encoded), np.int32, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.uint32, int(counts.sum()))
        n, m = len(self.place), len(pieces)
        while n + m > len(self.starts):
            self.starts, self.counts = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.counts))
            self.slices = np.concatenate([self.slices, np.zeros_like(self.slices)])
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[n : n + m] = self.used + np.cumsum(counts) - counts
        self.counts[n : n + m] = counts
        self.used += len(flat)
        self.place.update(zip(pieces, range(n, n + m), strict=True))

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and their number per word."""
        parts = pc.extract_regex(words, _PLAIN)
        plain = parts.is_valid()
        first = pc.if_else(plain, pc.utf8_lower(parts.field(0)), pc.binary_join_element_wise("\t", words, ""))
        rest = pc.if_else(plain, parts.field(1), "")
        coded = pa.concat_arrays([first, rest]).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.place]
        if len(self.place) + len(new) > MOST_PIECES:
            self._forget()
            new = [p for p in pieces if p not in self.place]
        self._learn(new)
        place = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        self.slices[place] += 1
        where = place[coded.indices.to_numpy()].reshape(2, len(words)).T.ravel()
        counts = self.counts[where]
        sums = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(self.starts[where] - sums[:-1], counts) + np.arange(sums[-1])]
        return ids, counts.reshape(-1, 2).sum(axis=1, dtype=np.int32)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        listed = pc.ascii_split_whitespace(texts.fill_null(""))
        ends = listed.offsets.to_numpy()
        coded = listed.flatten().dictionary_encode()
        ids, sizes = self._of_words(coded.dictionary)
        where = coded.indices.to_numpy()
        counts = sizes[where]
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        # a slice has far fewer ids than 2^31
        shift = ((np.cumsum(sizes, dtype=np.int64) - sizes)[where] - sums[:-1]).astype(np.int32)
        at = np.repeat(shift, counts)
        at += np.arange(len(at), dtype=np.int32)
        return ids[at], np.diff(sums[ends - ends[0]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number per text; NULL is empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        cuts = np.unique(np.searchsorted(sizes, np.arange(SLICE_BYTES, (sizes[-1] if len(sizes) else 0) + SLICE_BYTES, SLICE_BYTES)) + 1)
        parts, at = [], 0
        for cut in [*cuts.tolist(), len(texts)]:
            cut = min(cut, len(texts))
            if cut > at:
                parts.append(self._slice(texts.slice(at, cut - at)))
                at = cut
        # what the slices needed goes back, so that workers that share a machine do not each keep it
        pa.default_memory_pool().release_unused()
        if not parts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process, so that the cache lives as long as the worker."""
    return Encoder(path)
