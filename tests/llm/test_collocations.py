import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import collocations as co
from sluice.llm.collocations import collocations

OPTIONS = dict(max_words=4, min_count=3, percent=100, first=50)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def all_runs(rows, max_words):
    """(count of every run of words, words per language), from the wording."""
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    return f, n


def by_hand(rows, max_words=5, min_count=100, percent=100, first=2000):
    f, n = all_runs(rows, max_words)
    able = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = {}
    for (lang, w), a in able.items():
        if any(
            100 * b >= percent * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (other, v), b in able.items()
            if other == lang and len(v) > len(w)
        ):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:first])
    }


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    out = collocations(df, **{**OPTIONS, **options})
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture
def rows(prose):
    few = ["ba", "Do", "ki", "lu,", "mer", "nos.", "é", "ba\x00"]
    made = [(prose(i, 40, few), ["en", "de", None][i % 3]) for i in range(60)]
    fixed = [("one two three four\tfive", "en")] * 5 + [("x one two three.", "en"), ("two three", "en"), ("Five six", "de"), ("five SIX", "de"), ("five\nsix", "de"), ("five  six", "de")]
    return made + fixed + [(None, "en"), ("", None), (" ., ", "fr"), ("a a a a a", "fr")]


@pytest.mark.parametrize("options", [{}, {"max_words": 5, "percent": 60}, {"max_words": 2, "first": 3}, {"min_count": 1, "max_words": 3, "first": 10_000}])
def test_against_the_definition(spark, rows, options):
    assert run(spark, rows, **options) == by_hand(rows, **{**OPTIONS, **options})


def test_small_filter_only_costs_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(co, "FILTER_BITS", 64)
    monkeypatch.setattr(co.fingerprint_filter, "__defaults__", (64,))
    assert run(spark, rows) == by_hand(rows, **OPTIONS)


def chunk_counts(rows, max_words, full=None):
    """The verified counts of the last reading, in this process, through a filter that lets all pass."""
    class Shared:
        value = np.full(8, 255, np.uint8)

    seeds = {lang: hash(lang) % 1000 for _, lang in rows}
    batch = pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([x[1] or "und" for x in rows]),
            "seed": pa.array([seeds[x[1]] for x in rows], pa.int64()),
            "text": pa.array([x[0] for x in rows], pa.string()),
        }
    )
    total = Counter()
    for out in co._phrase_counts(Shared, max_words)(iter([batch])):
        for r in out.to_pylist():
            assert len(r["phrase"].split(" ")) == r["words"]
            total[r["lang"], tuple(r["phrase"].split(" "))] += r["n"]
    return total


def test_colliding_fingerprints_and_word_hashes_are_told_apart(rows, monkeypatch):
    want, _ = all_runs(rows, 3)
    assert chunk_counts(rows, 3) == want
    real = co.fingerprints
    monkeypatch.setattr(co, "fingerprints", lambda chunk, seeds, n: real(chunk, seeds, n) & np.uint64(3))
    assert chunk_counts(rows, 3) == want
    words = co._words_of

    def few(*args):
        hashes, starts, ends = words(*args)
        return hashes & np.uint64(1), starts, ends

    monkeypatch.setattr(co, "_words_of", few)
    assert chunk_counts(rows, 3) == want
    long = [("z" * 100 + "a " + "z" * 100 + "b " + "z" * 100 + "a", "en")]
    assert chunk_counts(long, 2) == all_runs(long, 2)[0]


@pytest.mark.parametrize("slice_bytes", [1, 30, 256])
def test_long_texts_in_slices_and_small_chunks(rows, prose, monkeypatch, slice_bytes):
    rows = rows + [(prose("long", 300) + ". " + "w" * 700 + "  v u " * 30, "en"), ("tail of words", "de")]
    want, n = all_runs(rows, 3)
    monkeypatch.setattr(co, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(co, "CHUNK", 100)
    got = chunk_counts(rows, 3)
    assert got == want
    batch = pa.RecordBatch.from_pydict({"lang": [x[1] or "und" for x in rows], "seed": [1] * len(rows), "text": [x[0] for x in rows]})
    words = Counter()
    for out in co._language_words(iter([batch])):
        for r in out.to_pylist():
            words[r["lang"]] += r["n"]
    assert +words == +n


def test_phrases_of_several_chunks_are_one_row(rows, monkeypatch):
    class Shared:
        value = np.full(8, 255, np.uint8)

    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "seed": [1] * 50, "text": ["a b c a b d"] * 50})
    monkeypatch.setattr(co, "CHUNK", 12)
    for held, most in ((1 << 19, 1), (8, 60)):
        monkeypatch.setattr(co, "SUMMED", held)
        out = [r for b in co._phrase_counts(Shared, 2)(iter([batch])) for r in b.to_pylist()]
        total = Counter()
        for r in out:
            total[r["lang"], tuple(r["phrase"].split(" "))] += r["n"]
        assert total == all_runs([("a b c a b d", "en")] * 50, 2)[0]
        assert max(Counter(r["phrase"] for r in out).values()) <= most


def test_rows_handed_on_do_not_grow_with_the_partitions(spark, monkeypatch):
    handed, real = spark.sparkContext.accumulator(0), co._phrase_counts

    def spied(shared, max_words):
        run = real(shared, max_words)

        def spy(batches):
            for batch in run(batches):
                handed.add(len(batch))
                yield batch

        return spy

    monkeypatch.setattr(co, "_phrase_counts", spied)
    rows = [("a b c, d e", "en")] * 400
    parts = spark.createDataFrame(rows, "text string, lang string").repartition(40)
    got = {(r.words, r.phrase): r.n for r in co.phrase_counts(parts.selectExpr("lang", "1L seed", "text"), 3, 3).collect()}
    assert got == {(len(w), " ".join(w)): n for (_, w), n in all_runs(rows, 3)[0].items()}
    assert len(got) <= handed.value <= len(got) * spark.sparkContext.defaultParallelism


def test_frequent_phrases_are_held_when_rare_ones_are_handed_on(monkeypatch):
    monkeypatch.setattr(co, "SUMMED", 16)

    def batch(phrases):
        columns = {"lang": ["en"] * len(phrases), "words": [1] * len(phrases), "phrase": phrases, "n": [2 if p == "hot" else 1 for p in phrases]}
        return pa.RecordBatch.from_pydict(columns)

    batches = [batch(["hot"] + [f"r{i}_{k}" for k in range(8)]) for i in range(50)]
    out = [r for b in co._summed(iter(batches)) for r in b.to_pylist()]
    assert [r["n"] for r in out if r["phrase"] == "hot"] == [100]
    assert len(out) == 401 and sum(r["n"] for r in out) == 500
    # a phrase too long to be held is handed on
    monkeypatch.setattr(co, "SUMMED_BYTES", 200)
    out = [r for b in co._summed(iter([batch(["x" * 300, "hot"])] * 5)) for r in b.to_pylist()]
    assert Counter(r["phrase"] for r in out)["x" * 300] == 5 and sum(r["n"] for r in out) == 15


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", 1, "a", 9 * 10**11), ("en", 1, "b", 7 * 10**11), ("en", 2, "a b", 5 * 10**11)], "lang string, words int, phrase string, n long"
    )
    totals = spark.createDataFrame([("en", 8 * 10**13)], "lang string, n long")
    (r,) = co.scored_phrases(counts, totals).collect()
    assert r.score == 1000 * r.a * r.n // (r.l * r.r) and 1000 * r.a * r.n > 1 << 64


def test_a_hot_language_and_ties(spark):
    rows = [(f"w{i % 20} v{i % 20}", "en") for i in range(200)] + [("w1 v1", "de")] * 3
    got = run(spark, rows, first=7)
    assert got == by_hand(rows, **{**OPTIONS, "first": 7})


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "text string, lang string, phrase int, n string, seed string")
    assert collocations(empty, **OPTIONS).count() == 0
    rows = [("a b", "en", 1, "x", "y")] * 4
    df = spark.createDataFrame(rows, "text string, lang string, phrase int, n string, seed string")
    assert [r.phrase for r in collocations(df, **OPTIONS).collect()] == ["a b"]
