"""Words of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A word is a run of bytes between gaps (space and the controls tab to return,
or all ASCII punctuation besides); the letters A-Z are lower-cased.  Long texts are hashed in slices that end between
words, so memory follows the slice, not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: For words without punctuation: every ASCII byte but letters and digits is a gap.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[128:] = PUNCTUATION[ord("0") : ord("9") + 1] = False
PUNCTUATION[ord("A") : ord("Z") + 1] = PUNCTUATION[ord("a") : ord("z") + 1] = False
_FOLD = np.arange(256, dtype=np.uint64) + np.uint64(1)
_FOLD[ord("A") : ord("Z") + 1] += np.uint64(32)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


class _Powers:
    """Powers of the odd multiplier and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            steps = np.full(n, _MULT)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = np.uint64(_inverse(int(_MULT)))
            self.down = np.multiply.accumulate(steps)
        return self.up, self.down


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _words_of(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and past-last bytes of the words; no word crosses a bound."""
    solid = ~gap[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    ends = np.flatnonzero(last) + 1
    up, down = _powers(len(data) + 1)
    run = np.empty(len(data) + 1, dtype=np.uint64)
    run[0] = 0
    np.cumsum(_FOLD[data] * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts]), starts, ends


def _long(data: np.ndarray, gap: np.ndarray) -> Iterator[np.ndarray]:
    """Slices of one long text that end after a gap between words where there is any."""
    at = 0
    while at < len(data):
        end = at + SLICE_BYTES
        if end < len(data):
            gaps = np.flatnonzero(gap[data[at:end]])
            while not len(gaps) and end < len(data):
                end += SLICE_BYTES
                gaps = np.flatnonzero(gap[data[at:end]])
            end = at + int(gaps[-1]) + 1 if len(gaps) and end < len(data) else min(end, len(data))
        yield data[at:end]
        at = end


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a text column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)
    else:
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def row_slices(offsets: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``budget`` bytes; a longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + budget, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_hashes(column: pa.Array, gap: np.ndarray = SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per range of rows: its first row, the word hashes, and each row's bounds in them."""
    offsets, data = buffers(column)
    for lo, hi in row_slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        if hi == lo + 1 and len(part) > SLICE_BYTES:
            words = np.concatenate([_words_of(x, np.zeros(0, np.int64), gap)[0] for x in _long(part, gap)])
            yield lo, words, np.array([0, len(words)])
        elif len(part):
            bounds = offsets[lo : hi + 1] - offsets[lo]
            words, starts, _ = _words_of(part, bounds, gap)
            yield lo, words, np.searchsorted(starts, bounds)
        else:
            yield lo, np.zeros(0, np.uint64), np.zeros(hi - lo + 1, np.int64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text, with repeats; a shorter text is one shingle."""
    if len(words) == 0:
        return words
    size = min(k, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = mix(out * _MULT + words[i : len(words) - size + 1 + i])
    return out


def block_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, for all places that have k words."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(words) + 1)
    run = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=run[1:])
    return mix((run[k:] - run[:-k]) * down[: len(words) - k + 1])
