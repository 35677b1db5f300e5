"""Hashes of words and of word windows, for code that runs on Arrow batches.

A batch of texts becomes one flat array of word hashes with the place where each
text begins; everything after that is array arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Characters of text that are worked on at once; a longer text is worked on alone.
SLICE_CHARS = 2_000_000


def filled(texts: pa.ChunkedArray | pa.Array) -> pa.Array:
    """Texts as one array with 64-bit offsets, NULL as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes of text each."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += int(size) + 64
    if start < len(sizes):
        yield start, len(sizes)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and the index of each text's first word (with the end)."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    return flat.filter(pa.array(full)), before[offsets]


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and the index of each text's first word (with the end)."""
    words, starts = split_words(texts)
    coded = words.dictionary_encode()
    known = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(text_hash, known), np.uint64, len(known))
    return hashes[coded.indices.to_numpy()] if known else hashes, starts


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits in, 64 well-mixed bits out; one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on; the last positions are left out.

    Windows run on over the end of a text: callers choose the positions.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for k in range(length):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + n]
        total ^= total >> np.uint64(29)
    return mixed(total)


def counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive groups of the given sizes."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
