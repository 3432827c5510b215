import random
import re

import numpy as np
import pytest

from sluice.llm.components import components
from sluice.llm.neardup import HASHES, band_rows, least_matches, near_duplicates, one_of_each_group


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def variants(prose, seed, base, n, changes):
    rnd, words = random.Random(seed), base.split()
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rnd.randint(0, changes)):
            w[rnd.randrange(len(w))] = prose(rnd.random(), 1)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, docs, prose, k, percent):
    texts = []
    for s in range(12):
        base = prose(s, 60 + 20 * s)
        texts += [base, base, base.upper(), base.replace(" ", "\n")] + variants(prose, s, base, 14, 6)
    texts += [prose(f"x{i}", 3 + i) for i in range(60)] + ["", " \t", None, "one", "One", "one two", "one two three"]
    random.Random(5).shuffle(texts)
    rows = list(enumerate(texts))
    want = brute(rows, k, percent)
    got = near_duplicates(docs(rows), words=k, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_family_is_dealt_over_tiles(spark, docs, prose, monkeypatch):
    from sluice.llm import neardup

    monkeypatch.setattr(neardup, "TILE", 40)
    texts = variants(prose, 1, prose("base", 120), 220, 9)
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows)).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 3, 85).items()}
    assert len(set(got.values())) > 5


def test_nulls_repeats_and_clashing_columns(docs, prose):
    text = prose(1, 30)
    d = docs([(3, text), (3, text), (None, text), (2, text), (7, None), (None, None), (2, prose(2, 30))], node="n", h1=1, text_hash="t", kept="k")
    got = sorted(((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in near_duplicates(d).collect()), key=str)
    assert got == sorted(
        [(3, True, 2, False), (3, True, 2, False), (None, True, None, True), (2, True, 2, True), (7, False, 7, True), (None, False, None, True), (2, True, 2, True)],
        key=str,
    )
    assert near_duplicates(docs([])).count() == 0


def test_one_of_each_group_keeps_clean_rows(docs, prose):
    base = prose(1, 80)
    rows = [(5, base), (4, base), (4, base), (9, base + " tail"), (11, prose(2, 80)), (12, None), (13, ""), (None, base), (11, base), (20, "solo")]
    d = docs(rows, n_shingles="x")
    got = one_of_each_group(d)
    assert got.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(4, base), (11, prose(2, 80)), (12, None), (13, ""), (None, base), (20, "solo")], key=str
    )


def test_groups_that_share_an_id_keep_a_row_each(docs, prose):
    a, b, c = (prose(s, 80) for s in ("a", "b", "c"))
    rows = [(5, a), (5, b), (8, a), (9, b + " tail"), (5, b), (6, c), (6, c + " end"), (7, c), (6, prose("d", 80))]
    want = [a, b, prose("d", 80)]
    got = [(r.doc_id, r.text) for r in one_of_each_group(docs(rows).repartition(3)).collect()]
    assert sorted(x for x in got if x[1] in want) == sorted([(5, a), (5, b), (6, want[2])])
    assert sum(t.startswith(c) for _, t in got) == 1 and len(got) == 4


def test_long_text(docs, prose):
    long = prose(1, 200_000)
    got = near_duplicates(docs([(1, long), (2, long + " end"), (3, "x" * 3_000_000)])).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_bands_and_posterior():
    for percent in (80, 85, 95):
        r = band_rows(percent)
        assert HASHES % r == 0 and (1 - (percent / 100) ** r) ** (HASHES // r) <= 1e-4
    rng = np.random.default_rng(0)
    lost = 0
    for _ in range(4000):  # pairs exactly at the threshold are hardly ever dropped
        agree = rng.random(HASHES) < 0.85
        lost += any(agree[:n].sum() < m for n, m in least_matches(85, 5e-4))
    assert lost <= 20
    assert all(m > 0.6 * n for n, m in least_matches(85, 5e-4)[2:])


def test_components_of_long_chains_and_stars(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(1000 + i, 1000) for i in range(50)] + [(7, 7), (None, 3), (5, 6), (6, 5)]
    rnd.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1000 for i in range(1000, 1050)}, 5: 5, 6: 5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
