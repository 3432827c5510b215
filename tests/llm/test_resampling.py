import hashlib
import math
import re
import zlib

import pytest

from sluice.llm import resampling
from sluice.llm.resampling import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def grams(text, max_n):
    w = WORD.findall(lower(text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def by_hand(rows, target, max_n=1, buckets=10_000, seed="2024", percent=10, min_words=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for f in grams(text, max_n)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in grams(text, max_n)[1]:
            t[bucket(f)] += 1
    out = []
    for doc_id, text in rows:
        n_words, fs = grams(text, max_n)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in map(bucket, fs)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n_words, len(fs), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = rank + 1
    return sorted(map(tuple, out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


EDGES = [
    (900, None), (901, ""), (902, " .,\n"), (903, "\x00a\x7fb"), (904, "Ünïcode ÄÖ 123 x_y"), (905, "KKelvin"),
]


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_against_the_definition(spark, docs, prose, max_n):
    rows = [(i, prose(i, 5 + i % 60)) for i in range(300)] + EDGES
    target = [prose(f"t{i}", 30, ["balan", "doun", "x9"]) for i in range(5)] + [None, ""]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    mixed = docs(rows).repartition(5)
    assert got(resample(mixed, t, max_n=max_n, buckets=97, percent=25)) == by_hand(rows, target, max_n, 97, percent=25)


def test_features_do_not_cross_documents(spark, docs):
    t = spark.createDataFrame([("b c",)], "text string")
    df = docs([(1, "a b"), (2, "c d"), (3, "b c")]).coalesce(1)
    out = {r.doc_id: r for r in resample(df, t, max_n=2).collect()}
    assert [out[i].n_features for i in (1, 2, 3)] == [3, 3, 3]
    assert out[3].weight > max(out[1].weight, out[2].weight)


def test_long_texts_in_slices(spark, docs, prose, monkeypatch):
    rows = [(1, prose(1, 5000)), (2, "x" * 3000 + " " + "y z " * 200), (3, "short one")]
    target = [prose(2, 50)]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    monkeypatch.setattr(resampling, "SLICE_BYTES", 256)
    for max_n in (1, 3):
        counted = {}
        import pyarrow as pa

        for first, n, row, code, _ in resampling.features(pa.array([x for _, x in rows]), max_n, 97):
            for r in row:
                counted[first + r] = counted.get(first + r, 0) + 1
        assert counted == {i: len(grams(text, max_n)[1]) for i, (_, text) in enumerate(rows)}
    monkeypatch.undo()
    assert got(resample(docs(rows), t, max_n=2, buckets=97)) == by_hand(rows, target, 2, 97)


def test_ties_go_to_the_smaller_id_and_repeats_rank_each(spark, docs, prose):
    t = spark.createDataFrame([("nothing",)], "text string")
    same = prose(0, 30)
    rows = [(7, same)] * 40 + [(None, same)] * 40 + [(i, prose(i, 25)) for i in range(40)]
    ranks = [r.rank for r in resample(docs(rows), t, percent=100).collect()]
    assert sorted(ranks) == list(range(1, 121))
    assert got(resample(docs(rows).repartition(7), t, percent=50)) == by_hand(rows, ["nothing"], percent=50)


def test_no_target_few_rows_empty_table_and_clashing_columns(spark, docs, prose):
    nothing = spark.createDataFrame([], "text string")
    few = [(i, prose(i, 25)) for i in range(9)]
    out = resample(docs(few, rank="x", score="y", bucket="z", row="r", n="n"), nothing)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert got(out) == by_hand(few, [])
    assert all(r.rank is None for r in out.collect())
    assert resample(docs([]), nothing).count() == 0


def test_draw_follows_the_target(spark, docs, prose):
    near, far = ["balan", "domo", "kirik"], ["zuxo", "viwes", "tenyar"]
    rows = [(i, prose(i, 40, near if i % 4 == 0 else far)) for i in range(400)]
    t = spark.createDataFrame([(prose("t", 60, near),)], "text string")
    drawn = [r.doc_id for r in resample(docs(rows), t).collect() if r.rank]
    assert len(drawn) == 40 and all(i % 4 == 0 for i in drawn)
