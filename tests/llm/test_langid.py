import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluice.llm import langid, queries

SF = "/root/testdata/sf0.01"
STEMS = {"xa": "ba do ki lu mer nos", "yb": "tro sche gun wirt pfa zen", "zc": "éau oire quel çon aux vous"}


def text(lang, seed, n=60):
    rnd = random.Random(f"{lang}{seed}")
    parts = STEMS[lang].split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def corpus(docs, n=400, more=()):
    return docs([(i, text(x := list(STEMS)[i % 3], i), x) for i in range(n)] + list(more))


def test_predicts_without_seeing_labels(docs):
    rows = langid.identify_languages(corpus(docs)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.lang_pred == list(STEMS)[r.doc_id % 3] and not r.rejected and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_do_not_matter(docs):
    rows = [(i, text(list(STEMS)[i % 3], i), list(STEMS)[i % 3] if zlib.crc32(str(i).encode()) % 5 else "wrong") for i in range(300)]
    got = langid.identify_languages(docs(rows)).collect()
    assert {r.lang_pred for r in got} == set(STEMS)


def test_undecidable_and_foreign_texts(docs):
    more = [(1000, None), (1001, ""), (1002, "123 %% !!"), (1003, " \n"), (None, text("xa", 1)), (1004, "Ж" + " вщхзфц" * 60), (1005, "qjxwvkqz jqwxvzk " * 40)]
    got = {r.doc_id: r for r in langid.identify_languages(corpus(docs, 2600, more), sample=500).collect()}
    for i in range(1000, 1004):
        assert got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected
    assert got[None].lang_pred == "xa" and not got[None].held_out
    assert got[1004].rejected and got[1005].rejected
    assert not any(r.rejected for r in got.values() if r.doc_id is None or r.doc_id < 1000)


@pytest.mark.parametrize("n", [240, 1200])
def test_foreign_texts_are_rejected_with_few_labelled_rows(docs, n):
    foreign = [(5000, "Ж" + " вщхзфц" * 60), (5001, "qjxwvkqz jqwxvzk " * 40)]
    # a language of which few rows are labelled, least of all enough for a limit of its own
    rare = [(6000 + i, " ".join(f"hyy{'eiou'[(i + k) % 4]}pp{'aeio'[k % 4]}" for k in range(60)), "rare" if i < 6 else None) for i in range(12)]
    got = {r.doc_id: r for r in langid.identify_languages(corpus(docs, n, [(i, t, None) for i, t in foreign] + rare)).collect()}
    assert got[5000].rejected and got[5001].rejected
    assert sum(r.rejected for r in got.values()) == 2


def test_a_language_of_one_labelled_row_is_still_known(docs):
    got = {r.doc_id: r for r in langid.identify_languages(corpus(docs, 90, [(7001, "éhwyx" * 40, "one"), (7002, "éhwyx" * 30, None)])).collect()}
    assert got[7002].lang_pred == "one" and not got[7002].rejected


def test_mixed_texts_and_short_texts_stay(docs):
    more = [(9000 + i, text("xa", i, 20) + " " + text("yb", i, 20)) for i in range(20)] + [(9100 + i, text("zc", i, 2)) for i in range(20)]
    got = {r.doc_id: r for r in langid.identify_languages(corpus(docs, 2600, more), sample=500).collect()}
    assert not any(got[i].rejected for i in got if i >= 9000)


def test_filter_keeps_all_columns_and_empty_tables(docs):
    d = corpus(docs, 60, [(1000, None)]).selectExpr("*", "1 as score", "2 as held_out")
    kept = langid.filter_known(d)
    assert kept.columns == d.columns and kept.count() == 60
    assert langid.identify_languages(docs([])).count() == 0
    none = langid.identify_languages(docs([(1, "text"), (2, None)])).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_probabilities_are_kneser_ney(docs):
    texts = [text("xa", i, 20) for i in range(4)]
    code, n = np.unique(np.concatenate([g for _, g in langid.packed(texts)]), return_counts=True)
    models = langid.LanguageModels({"xa": (code, n)})
    # the same, from the definition, over strings
    grams = [Counter() for _ in range(langid.ORDER + 1)]
    for t in texts:
        s = " " * (langid.ORDER - 1) + t
        grams[langid.ORDER].update(s[i : i + langid.ORDER] for i in range(len(s) - langid.ORDER + 1))
    for k in range(langid.ORDER - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    symbols = len(grams[1]) + 1

    def p(g):
        if not g:
            return 1 / symbols
        k, rows = len(g), defaultdict(int)
        for x, c in grams[k].items():
            if x[:-1] == g[:-1]:
                rows[x] = c
        if not rows:
            return p(g[1:])
        total = sum(rows.values())
        return max(rows.get(g, 0) - 0.75, 0) / total + 0.75 * len(rows) / total * p(g[1:])

    for g in list(grams[langid.ORDER])[::7] + ["zzzzz", "   ba", "qqqba", "bado?"]:
        g = g.replace("?", " ")
        packed = 0
        for c in g:
            packed = packed << langid.BITS | (ord(c) if c != " " else 32)
        assert math.exp(models.log_probs(np.array([packed]))[0, 0]) == pytest.approx(p(g), rel=1e-4)
    row = [p("bado" + c) for c in {x[0] for x in grams[1]}]
    assert sum(row) <= 1 + 1e-9


def test_long_text_equals_its_slices(monkeypatch):
    long = " ".join(text("xa", i) + " --  " for i in range(50))
    whole = np.concatenate([g for _, g in langid.packed([long])])
    monkeypatch.setattr(langid, "SLICE_CHARS", 100)
    parts = np.concatenate([g for _, g in langid.packed([long])])
    assert (whole == parts).all()


def test_accuracy_on_held_out_rows(spark):
    got = queries.QUERIES["op8_language_id"](spark, SF).where("held_out")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) and len(rows) > 100
