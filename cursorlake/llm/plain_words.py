"""Words as runs of characters other than ASCII white space, over Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import mix64
from .near_dup import Words


class PlainWords(Words):
    """The words ``[^\\x20\\x09-\\x0D]+`` of an array of texts (null: no words).
    ``number`` of each occurrence, text by text; ``size`` words per text; ``hash``
    per number; ``words``, the occurrences themselves. With ``lower``, A-Z are
    lower-cased first."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        flat, size = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
        void = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # at either end of a text
        self.size = size - np.bincount(np.repeat(np.arange(len(size)), size)[void], minlength=len(size))
        self.words = flat.filter(pa.array(~void))
        coded = self.words.dictionary_encode()
        self.number = coded.indices.to_numpy()
        length = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        self.hash = self._hashed(coded.dictionary, length)

    def starts(self) -> np.ndarray:
        """Where each text's words begin; one more entry than there are texts."""
        return np.concatenate([[0], np.cumsum(self.size)])


def windows(values: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive values (uint64)."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    last = len(values) - n + 1
    total = np.zeros(last, np.uint64)
    for j in range(n):
        total += values[j: j + last] * np.uint64(0x9E3779B97F4A7C15 ** (j + 1) % (1 << 64))
    return mix64(total)
