import random

import numpy as np
import pytest

from sluice.llm.passages import equal_runs, kept_starts, repeated_passages


def brute(rows, least):
    """Covered word numbers per document: words of any window that another document holds too."""
    where, words = {}, {}
    for i, t in rows:
        if i is None or t is None:
            continue
        words[i] = w = t.encode().lower().split()
        for j in range(len(w) - least + 1):
            where.setdefault(tuple(w[j : j + least]), set()).add(i)
    out = {}
    for i, w in words.items():
        got = set()
        for j in range(len(w) - least + 1):
            if len(where[tuple(w[j : j + least])]) > 1:
                got.update(range(j, j + least))
        out[i] = got
    return out


def covered(df):
    out = {}
    for r in df.collect():
        assert r.end - r.start >= 50 and r.end <= r.n_words
        got = out.setdefault(r.doc_id, set())
        assert not got & set(range(r.start, r.end))
        got.update(range(r.start, r.end))
    return out


def corpus(prose, n=150):
    rnd = random.Random(8)
    shared = [prose(("s", k), m) for k, m in enumerate((49, 50, 51, 60, 80, 200))]
    rows = []
    for i in range(n):
        parts = [prose(("d", i), rnd.randint(0, 120))]
        if i % 3 == 0:
            parts += [shared[0], prose(("e", i), 30), rnd.choice(shared[1:]), prose(("f", i), rnd.randint(0, 40))]
        if i % 7 == 0:
            w = shared[5].split()
            w[rnd.randrange(200)] = "changed"
            parts += [" ".join(w).upper()]
        if i % 10 == 0:
            parts += [shared[4][: len(shared[4]) // 2]]
        rows.append((i, "\n".join(p for p in parts if p)))
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, rows[1][1] + " more"), (503, None), (504, ""), (505, "short"), (None, rows[3][1]), (506, prose("x", 60)), (506, prose("x", 60))]
    return rows


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_spans_equal_brute_force(spark, docs, prose, partitions):
    rows = corpus(prose)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = covered(repeated_passages(docs(rows, start=1, t="x", h=2)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = {i: c for i, c in brute(rows, 50).items() if c}
    total = sum(map(len, want.values()))
    assert set(got) <= set(want)
    assert all(c <= want[i] for i, c in got.items())
    # neighbours are compared, not all pairs: chance agreements at the edge of a shorter shared passage can be missed
    assert sum(map(len, got.values())) >= 0.98 * total > 1000


def test_passage_of_a_third_of_all_texts(docs, prose):
    shared = prose("s", 55)
    rows = [(i, f"{prose(i, 20)} {shared if i % 3 == 0 else prose(('o', i), 55)} {prose(('p', i), 20)}") for i in range(300)]
    got = covered(repeated_passages(docs(rows)))
    assert set(got) == set(range(0, 300, 3)) and all(c >= set(range(20, 75)) for c in got.values())
    assert all(c <= want for i, want in brute(rows, 50).items() if (c := got.get(i)))


def test_monotonous_texts(docs, prose):
    rows = [(1, "la " * 5000), (2, prose(2, 40) + " la" * 300), (3, "lo " * 400), (4, prose(4, 90))]
    got = covered(repeated_passages(docs(rows)))
    assert got == {1: set(range(5000)), 2: set(range(40, 340))}


def test_every_window_keeps_the_same_start():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 60, 4000).astype(np.uint64)
    at = kept_starts(h, 35)
    assert np.diff(at).max() <= 35 and len(at) < 4000 / 12
    again = kept_starts(h[1234:2000], 35) + 1234
    assert set(again[(again > 1290) & (again < 1950)]) == set(at[(at > 1290) & (at < 1950)])


def test_equal_runs():
    x = np.array([9, 1, 2, 3, 9, 9, 4, 5])
    y = np.array([1, 2, 3, 7, 7, 4, 5])
    assert equal_runs(x, y, -1, 2) == [(1, 4), (6, 8)]
    assert equal_runs(x, y, -1, 4) == equal_runs(x, y, 50, 1) == []


def test_empty(docs):
    assert repeated_passages(docs([])).count() == 0
    assert repeated_passages(docs([(1, None), (2, "a")])).count() == 0
