"""Words and shingles of texts, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SEED = 42

#: Keeps 0-9, a-z and bytes from 0x80 on, lowers A-Z, turns the rest into spaces.
WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """Texts of an Arrow column as UTF-8 bytes, one at a time."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py()


def spaced_words(text: bytes | None) -> list[bytes]:
    """Runs free of white space (0x20, 0x09 to 0x0D), A-Z lowered."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and code points from 0x80 on, A-Z lowered."""
    return text.translate(WORD_BYTES).split() if text else []


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every ``size`` consecutive words joined by a space, repeats included.

    A shorter sequence is one shingle, an empty one has none.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    buffer = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(size, n)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n - size + 1].tolist(), ends[size - 1:].tolist())
    return np.fromiter((digest(buffer[i:j], SEED) for i, j in spans), np.uint64, n - size + 1)
