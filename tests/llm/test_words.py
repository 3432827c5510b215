import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import words
from sluice.llm.words import PUNCTUATION, SPACE, block_hashes, buffers, row_slices, shingles, word_hashes

PATTERN = {"space": r"[^\x20\x09-\x0D]+", "punctuation": r"(?:[0-9a-z]|[^\x00-\x7F])+"}
GAP = {"space": SPACE, "punctuation": PUNCTUATION}


def plain(text, kind):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(PATTERN[kind], folded)


def texts(n=300):
    rnd = random.Random(6)
    alphabet = "abAB019.,-é😀   \t\n\x0b\x0c\r\x1c\x85  "
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]
    return out + [None, "", " ", "x", " x", "x ", "É É", "same", "SAME"]


@pytest.mark.parametrize("kind", ["space", "punctuation"])
@pytest.mark.parametrize("budget", [7, 60, 1 << 20])
def test_words_equal_the_pattern(kind, budget, monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", budget)
    monkeypatch.setattr(words.row_slices, "__defaults__", (budget,))
    rows = texts()
    column = pa.array([None, *rows]).slice(1)  # an offset into the buffers
    known: dict[str, int] = {}
    seen = 0
    for lo, hashes, bounds in word_hashes(column, GAP[kind]):
        for i in range(len(bounds) - 1):
            want = plain(rows[lo + i], kind)
            got = hashes[bounds[i] : bounds[i + 1]].tolist()
            assert len(got) == len(want), rows[lo + i]
            for w, h in zip(want, got):
                assert known.setdefault(w, h) == h
            seen += 1
    assert seen == len(rows) and len(set(known.values())) == len(known)


def test_large_strings_and_slices():
    rows = ["a b", None, "c", "d " * 50]
    offsets, data = buffers(pa.array(rows, pa.large_string()))
    assert offsets.tolist() == [0, 3, 3, 4, 104] and bytes(data[:4].tobytes()) == b"a bc"
    assert list(row_slices(offsets, 5)) == [(0, 3), (3, 4)]
    assert list(word_hashes(pa.array([], pa.string()))) == []


def test_shingles_and_blocks():
    w = np.arange(1, 30, dtype=np.uint64) % np.uint64(7)
    s, b = shingles(w, 3), block_hashes(w, 3)
    grams = [tuple(w[i : i + 3]) for i in range(27)]
    for h in (s, b):
        assert len(h) == 27
        assert all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(27) for j in range(27))
    assert len(shingles(w[:2], 3)) == 1 and len(block_hashes(w[:2], 3)) == 0 and len(shingles(w[:0], 3)) == 0
    assert shingles(w[:2], 3)[0] != shingles(w[:1], 3)[0]
