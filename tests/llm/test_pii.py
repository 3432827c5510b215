import hashlib
import re

import numpy as np
import pytest

from sluice.llm import pii, queries

SF = "/root/testdata/sf0.01"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            ds = [int(c) for c in digits[::-1]]
            return 14 <= len(ds) <= 19 and (sum(ds[::2]) + sum(sum(divmod(2 * d, 10)) for d in ds[1::2])) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    kinds = list(RULES)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in RULES.items() for m in re.finditer(p, text) if good(k, m[0])]
    return sorted(found)


TRICKY = [
    "", "a@b", "a@b.c", "@b.c x@y.z.", "a@b@c.d", "a@b.c@d.e", "%+-@x-.y..z", "é@b.c aé@b.c", "x@@y.z a.b@c.d-e.f,g@h.i",
    "1.2.3", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.003.0255", "1.2.3.4@x.y", "300.1.2.3.4", "9.9.9.9.9", "1..2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111  1111", "4111111111111111", "4913187196670932 53.121.55.90", "0" * 14, "0" * 20, "1" * 5000,
    "+1 (802) 555-3889", "+1", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++49 170 1234567", "+1 (802) 555-3889+1 (802) 555-3889", "+ 1 802 555 3889", "+1234567890 (",
    "\U0001F600 a@b.co \U0001F600 1.2.3.4", "٣.٣.٣.٣ +٣123456789",
]


@pytest.mark.parametrize("text", TRICKY)
def test_base_rules_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_rules_on_random_strings():
    rng = np.random.default_rng(3)
    for alphabet in ("0123456789. -", "ab@.-_ é1", "+()0123456789 -.", "@.a1+ -"):
        for _ in range(400):
            text = "".join(rng.choice(list(alphabet), rng.integers(1, 60)))
            assert pii.base_spans(text) == brute(text), text


def test_rules_are_linear_on_long_runs():
    for text in ("1" * 400_000, "1." * 200_000, "a" * 400_000 + "@", "+1" * 200_000, "@" * 400_000, "a.b@" * 100_000, "1 " * 200_000):
        pii.base_spans(text)


def test_query_equals_patterns_on_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op3_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        spelled = [f"{list(RULES)[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(spelled) <= set(r.spans.split(",") if r.spans else [])


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger()
    tagger.params = {k: v.astype(np.float64) for k, v in tagger.params.items()}
    x, y = rng.integers(32, 122, (3, 7)), np.zeros((3, 7), int)
    y[0, 2:5], y[1, 3:5] = [1, 2, 2], [7, 8]
    _, grads = tagger.gradients(x, y)
    for name, at in (("in_f", (x[0, 2], 5)), ("in_b", (x[1, 4], 50)), ("rec_f", (3, 20)), ("rec_b", (0, 0)), ("out", (1, 1)), ("move", (0, 1)), ("move", (1, 2)), ("bias", (0,))):
        p, old = tagger.params[name], tagger.params[name][at]
        p[at] = old + 1e-3
        up = tagger.gradients(x, y)[0]
        p[at] = old - 1e-3
        down = tagger.gradients(x, y)[0]
        p[at] = old
        assert (up - down) / 2e-3 == pytest.approx(grads[name][at], rel=2e-2, abs=1e-6)


def test_decode_is_the_best_allowed_path():
    import itertools

    tagger = pii.Tagger(seed=3)
    x = np.array([[97, 64, 49, 46]])
    e, _, _ = tagger.emissions(x)
    move = tagger.params["move"] + pii.allowed_moves()
    best = max(itertools.product(range(pii.TAGS), repeat=4), key=lambda t: move[pii.TAGS, t[0]] + sum(e[i, 0, t[i]] for i in range(4)) + sum(move[a, b] for a, b in zip(t, t[1:])))
    assert tuple(tagger.decode(x)[0][0]) == best


def people(prose, n, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        phone = f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
        mail = f"{prose((seed, i), 1)}.{rng.integers(10, 99)}@mail{rng.integers(9)}.example.com"
        ip = ".".join(str(x) for x in rng.integers(1, 255, 4))
        out.append(f"{prose((seed, i, 1), 12)} {phone} {prose((seed, i, 2), 9)} {mail} {prose((seed, i, 3), 9)} {ip} token={rng.integers(1 << 60):x} end")
    return out


@pytest.fixture(scope="module")
def tagger():
    import random

    from made_up import WORDS

    def prose(seed, n):
        rnd = random.Random(str(seed))
        return " ".join(rnd.choice(WORDS) for _ in range(n))

    texts = people(prose, 150)
    return prose, pii.train([s for t in texts for s in pii.snippets(t, 6)], 350)


def test_model_finds_labelled_spans_of_unseen_texts(tagger):
    prose, model = tagger
    texts = people(prose, 60, seed=9)
    hit = total = extra = 0
    for text, (tags, lead) in zip(texts, pii._tag_texts(model, texts)):
        got = set(pii.model_spans(text, tags, lead, []))
        want = set(pii.base_spans(text))
        hit, total, extra = hit + len(got & want), total + len(want), extra + len(got - want)
    assert hit >= 0.85 * total and extra <= 0.1 * total


def test_model_adds_forms_the_rules_miss(tagger):
    prose, model = tagger
    texts = [f"{prose(('v', i), 10)} (8{i:02d}) 555-12{i:02d} {prose(('w', i), 10)}" for i in range(40)]
    assert not any(pii.base_spans(t) for t in texts)
    added = [pii.model_spans(t, tags, lead, []) for t, (tags, lead) in zip(texts, pii._tag_texts(model, texts))]
    assert sum(any(k == 3 for _, k, _ in a) for a in added) >= 20


def test_windows_agree_with_one_pass_and_span_their_edges(tagger, monkeypatch):
    prose, model = tagger
    text = people(prose, 1, seed=4)[0]
    shifted = [" " * n + text for n in range(0, 200, 7)]
    for t, (tags, lead) in zip(shifted, pii._tag_texts(model, shifted)):
        got = {(s - (len(t) - len(text)), k, e - (len(t) - len(text))) for s, k, e in pii.model_spans(t, tags, lead, [])}
        assert len(got & set(pii.base_spans(text))) >= 2


def test_edges(docs, prose):
    rows = [(1, None), (2, ""), (None, "mail a.b@c.de"), (3, "mail a.b@c.de"), (3, "mail a.b@c.de"), (4, "x " * 100_000 + "1.2.3.4")]
    got = pii.find_personal_data(docs(rows, spans="x", n_ip=1), steps=5).collect()
    by = {(r.doc_id): r for r in got}
    assert len(got) == 6 and by[1].spans == by[2].spans == "" and by[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].n_email == by[3].n_email == 1 and "email:5:13" in by[3].spans
    assert by[4].n_ip == 1 and "ip:200000:200007" in by[4].spans
    assert pii.find_personal_data(docs([])).count() == 0
    assert pii.find_personal_data(docs([(1, "no data"), (2, "7")])).where("spans != ''").count() == 0


def test_rare_kinds_reach_the_model(docs, prose, monkeypatch):
    rows = [(i, f"{prose(i, 8)} {i} {prose(('t', i), 8)}") for i in range(2000)]
    rows += [(3000, f"{prose('m', 8)} a.b@c.de"), (3001, " ".join(f"x{i}@y.zz" for i in range(9)) + " 4111 1111 1111 1111")]
    seen = []
    monkeypatch.setattr(pii, "train", lambda rows, steps: seen.extend(rows))
    pii.find_personal_data(docs(rows).repartition(3), sample=30, steps=5)
    assert {1, 5} <= {t for _, tags in seen for t in tags} and len(seen) <= 30 * 6
    assert sum(not any(tags) for _, tags in seen) >= 5
