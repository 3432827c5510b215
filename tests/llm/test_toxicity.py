import random
import zlib

import numpy as np
import pytest

from sluice.llm import queries
from sluice.llm.toxicity import Matcher, choose_terms, context_factor, edits_allowed, features, fit_weights, loose_edits, score_toxicity, words_of

SF = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def prefix_distance(word, stem):
    return min(distance(word[:n], stem) for n in range(len(word) + 1))


def run(terms, words, loose=False):
    m = Matcher(terms, loose)
    text = "\n".join(words)
    points = np.array([ord(c) for c in text])
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    return m.run(m.classes(points), starts, ends)


def test_automaton_equals_edit_distance():
    terms = ["abcde*", "zebras", "quizzically", "trio", "abacus"]
    rnd = random.Random(1)
    words = ["abcde", "abcdefgh", "abxde", "zebra", "zebrass", "zeebras", "quizically", "quzzicaly", "trio", "trip", "abacu", "acabus", "q", "xbcde"]
    for t in terms:
        for _ in range(300):
            w = list(t.rstrip("*"))
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(w) + 1)
                w[i : i + rnd.randint(0, 1)] = rnd.choice(["", *"abcdeqz", "?"])
            words.append("".join(w) + rnd.choice(["", "", "ly", "x"]))
    words = sorted({w for w in words if w})
    got = run(terms, words)
    for w, f in zip(words, got):
        best = {}
        for i, t in enumerate(terms):
            stem = t.rstrip("*")
            # the first letter must be right
            d = (prefix_distance(w, stem) if t.endswith("*") else distance(w, stem)) if w[0] == stem[0] else 99
            if d <= edits_allowed(len(stem)):
                best[i] = d
        if f >= 0:
            assert best.get(f // 3) == f % 3 == min(best.values()), w
        else:
            # a first letter that is doubled or dropped and put back is the one difference allowed
            assert all(d > 0 for d in best.values()), w


def test_loose_automaton_equals_edit_distance_everywhere():
    terms = ["abcde*", "zebras", "quizzically", "trio", "idiot", "abacus", "xy"]
    rnd = random.Random(7)
    words = ["1diot", "*diot", "xidiot", "diot", "iidiot", "trip", "rio", "btrio", "xy", "xz", "bcdefgh", "uzically", "cabacus", "q", "id"]
    for t in terms:
        for _ in range(300):
            w = list(t.rstrip("*"))
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(w) + 1)
                w[i : i + rnd.randint(0, 1)] = rnd.choice(["", *"abcdeqz", "?"])
            words.append("".join(w) + rnd.choice(["", "", "ly", "x"]))
    words = sorted({w for w in words if w})
    for w, f in zip(words, run(terms, words, loose=True)):
        best = {}
        for i, t in enumerate(terms):
            stem = t.rstrip("*")
            d = prefix_distance(w, stem) if t.endswith("*") else distance(w, stem)
            if d <= loose_edits(len(stem)):
                best[i] = d
        assert (f < 0) == (not best), w
        if best:
            assert best.get(f // 3) == f % 3 == min(best.values()), w


def test_a_sign_may_stand_for_the_first_letter():
    terms = ["stupid", "idiot", "scum"]
    both = Matcher(terms), Matcher(terms, loose=True)
    for text, column in (("so $tupid", 6), ("*diot!", 7), ("$$cum", 8), ("a tupid one", 6), ("**idiot**", 2), ("scun", 8), ("@stuped", 1)):
        got = features(both[0], [text], 3, both[1])[0, :9]
        assert np.flatnonzero(got).tolist() == [column], text
    assert not features(both[0], ["no such thing", None], 3, both[1]).any()


def test_disguised_and_short_terms_raise_the_score(docs, spark, prose):
    rows, labels = corpus(docs, spark, prose)
    # a term of three letters, alone in its documents
    short = [(2000 + i, f"{prose(('s', i), 20)} zyx {prose(('t', i), 20)}") for i in range(200)]
    more = [(9000, prose(77, 30)), *[(9001 + i, f"{prose(77, 15)} {w} {prose(78, 15)}") for i, w in enumerate(["zyx", "1grimling", "6rimling", "rimling", "$lunderhead"])]]
    labels = labels.union(spark.createDataFrame([(i, 1, 1) for i, _ in short], labels.schema))
    got = {r.doc_id: r for r in score_toxicity(docs(rows + short + more), labels).collect()}
    assert got[9001].predicted == 1
    assert all(got[9001 + i].score > got[9000].score and got[9001 + i].terms_matched == 1 for i in range(5))


def test_words_keep_signs_inside():
    text = "Id!ot m*ron, $$$ end$ a@b x"
    points = np.array([ord(c) for c in text])
    s, e = words_of(points)
    assert [text[a:b] for a, b in zip(s, e)] == ["Id!ot", "m*ron", "end", "a@b", "x"]


def test_context():
    plain, quoted = "look at that zork over there", 'he wrote "what a zork" in a letter'
    for t, low, high in ((plain, 1.0, 1.0), (quoted, 0.1, 0.5), ("you zork", 1.1, 1.5)):
        at = t.index("zork")
        assert low <= context_factor(t, at, at + 4) <= high


def test_stems_and_words_are_chosen():
    found = [("zorka", 30, 0), ("zorkb", 30, 0), ("zorkc", 30, 0), ("zork*", 90, 0), ("zor*", 90, 0), ("zorka*", 30, 0), ("plain", 50, 0), ("plai*", 50, 0), ("plain*", 50, 0)]
    assert choose_terms(found) == ["zork*", "plain"]


def corpus(docs, spark, prose, n=600):
    rows, labels = [], []
    rnd = random.Random(2)
    for i in range(n):
        toxic = i % 5 == 0
        words = prose(i, 40).split()
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["zorkface", "blunderhead", "grimling"]))
        rows.append((i, " ".join(words)))
        if i % 4:
            labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_and_finds_misspellings_and_spares_quotations(docs, spark, prose):
    rows, labels = corpus(docs, spark, prose)
    more = [(9000, "hello grimlling there blunderheed x"), (9001, prose(77, 30)), (9002, None), (9003, ""), (None, "zorkface"), (9004, 'she said "grimling" once'), (9005, "all grimling once")]
    d = docs(rows + more, toxic=7, score="x")
    got = {r.doc_id: r for r in score_toxicity(d, labels).collect()}
    assert len(got) == len(rows) + len(more)
    held = [r for r in got.values() if r.doc_id is not None and r.doc_id < 9000 and r.held_out]
    assert held and all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values() if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[9000].terms_matched and got[9000].score > got[9001].score
    assert got[9001].score == got[9002].score == got[9003].score < 0.5
    assert got[9004].score < got[9005].score


def test_without_labels_and_without_documents(docs, spark, prose):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = score_toxicity(docs([(1, "x"), (2, None)]), none).collect()
    assert [(r.score, r.predicted) for r in rows] == [(0.0, 0)] * 2
    assert score_toxicity(docs([]), none).count() == 0


def test_reruns_agree(docs, spark, prose):
    rows, labels = corpus(docs, spark, prose, 300)
    a = {(r.doc_id, r.score) for r in score_toxicity(docs(rows), labels).collect()}
    b = {(r.doc_id, r.score) for r in score_toxicity(docs(rows[::-1]).repartition(5), labels.repartition(3)).collect()}
    assert {i for i, _ in a} == {i for i, _ in b} and dict(a) == pytest.approx(dict(b))


def test_weights_solve_the_penalised_fit():
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(500, 3)), np.array([2.0, -1.0, 0.0])
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ w + 0.5)))).astype(float)
    got = fit_weights(x, y)
    p = 1 / (1 + np.exp(-(x @ got[:-1] + got[-1])))
    assert np.abs(x.T @ (p - y) + got[:-1]).max() < 1e-5


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op10_toxicity"](spark, SF).where("held_out")
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)


def test_long_texts_are_read_to_the_end(monkeypatch):
    from sluice.llm import toxicity

    matcher = Matcher(["zorkface", "grimling"])
    text = "plain words here " * 400 + "zorkface " + "more of it " * 300 + "grimlinng"
    whole = toxicity.features(matcher, [text, None, "", text], 2)
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 97)
    assert (toxicity.features(matcher, [text, None, "", text], 2) == whole).all()
    assert whole[0].tolist()[:4] == [1.0, 0.0, 0.0, 1.0] and not whole[1].any()


def test_any_number_of_letters_and_a_large_lexicon():
    import time

    letters = [chr(0x4E00 + i) for i in range(300)]
    terms = [a + b for a, b in zip(letters[::2], letters[1::2])]
    assert run(terms, [*terms, letters[0] * 2]).tolist() == [3 * i for i in range(150)] + [-1]
    rnd = random.Random(4)
    terms = sorted({"".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(4, 12))) for _ in range(2000)})
    for loose in (False, True):
        t = time.perf_counter()
        Matcher(terms, loose)
        assert time.perf_counter() - t < 5
    words = sorted({w[:i] + rnd.choice("abcxyz") + w[i + rnd.randint(0, 1) :] for w in rnd.sample(terms, 60) for i in range(1, len(w))})
    for w, f in zip(words, run(terms, words)):
        best = min((distance(w, t), i) for i, t in enumerate(terms) if t[0] == w[0] and abs(len(t) - len(w)) <= 2 and distance(w, t) <= edits_allowed(len(t))) if any(
            t[0] == w[0] and distance(w, t) <= edits_allowed(len(t)) for t in terms) else None
        assert (f < 0 and (best is None or best[0] > 0)) or f % 3 == best[0], w


def test_a_full_table_is_started_anew(monkeypatch):
    from sluice.llm import toxicity

    terms = ["abcde*", "zebras", "quizzically"]
    words = ["abxde", "zebrass", "quizically", "abcd", "zebra"] * 3
    want = run(terms, words).tolist()
    monkeypatch.setattr(toxicity, "STATES", 1)
    m = Matcher(terms)
    state = dict(vars(m))
    for _ in range(3):
        again = Matcher.of(state)
        points = np.array([ord(c) for c in "\n".join(words)])
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        assert again.run(again.classes(points), ends - [len(w) for w in words], ends).tolist() == want


def test_long_words_become_terms(docs, spark, prose):
    long = "zork" * 12
    rows = [(i, f"{prose(i, 20)} {long if i % 4 == 0 else ''} {prose((i, 2), 20)}") for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    got = score_toxicity(docs(rows), labels).where("held_out").collect()
    assert got and all(r.predicted == int(r.doc_id % 4 == 0) and r.terms_matched == r.predicted for r in got)
