"""Sets of word shingles as 64-bit hashes, computed on Arrow's own byte buffers.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return, with A-Z in lower case. Nothing decodes or splits strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from gapwise.llm.spans import LOWER, U64, WINDOW, blocks, buffers, mix, span_hashes, windows, words

#: One odd multiplier for each place in a shingle.
_STEPS = (U64(0x9FB21C651E98DF25), U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3))


def words_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text (null: empty) the hashes of its words, in order."""
    data, offsets = buffers(texts)
    for row, last in blocks(offsets):
        own, cuts = data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        if len(own) > WINDOW:
            yield np.concatenate([span_hashes(w, *words(w, np.zeros(1, np.int64)), LOWER) for w in windows(own)])
        elif len(own):
            start, end = words(own, cuts)
            yield from np.split(span_hashes(own, start, end, LOWER), np.searchsorted(start, cuts[1:-1]))
        else:
            yield from (np.zeros(0, np.uint64) for _ in range(row, last))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of `width` words, ascending; of fewer words the whole sequence is one."""
    n = len(words)
    if not n:
        return words
    if n < width:
        whole = np.array([n], np.uint64)
        for i in range(n):
            whole = mix(whole * _STEPS[0] + words[i : i + 1])
        return whole
    total = words[: n - width + 1] * _STEPS[0]
    for i in range(1, width):
        total = total + mix(words[i : n - width + 1 + i] + U64(int(_STEPS[i % len(_STEPS)]) * i % (1 << 64)))
    shingles = np.sort(mix(total))
    return shingles[np.concatenate([[True], shingles[1:] != shingles[:-1]])]
