"""Personal data: base rules, and a character BiLSTM-CRF that adds to them.

Base rules find emails, IP addresses, card and phone numbers in the whole
text; they run in time linear in its length.  The model is a bidirectional
LSTM over characters with a CRF over tags (begin and inside per kind), trained
in numpy from labelled spans: snippets of a bounded sample of documents that
the rules have labelled, some of them varied in their writing (no plus sign, a
spaced at sign, dots for blanks), so that it learns forms the rules miss.

Texts are tagged in overlapping windows.  Every character takes its tag from
the window in whose core it lies; spans are then read off the whole text's
tags, so no window edge cuts one.  A span must hold a digit or an at sign: the
windows without either cannot hold one and are passed over.  A model span is
added if its tags are probable, if it can be of its kind and if it overlaps no
base span; base spans always stay.

Defined results: a null text is empty; a text without personal data has zero
counts, the digest of the empty string and no spans; a null id is kept; rows
that repeat get the same answer each; without any base match in the sample no
model is trained and only the rules speak; an empty table gives an empty
result; extra input columns are ignored; texts of any length are read whole, in
windows.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, cut, plain_names, table, unit_hash

KINDS = ("email", "ip", "card", "phone")
CORE, CONTEXT = 96, 32
SNIPPET = 64
HIDDEN = 16
SYMBOLS = 130
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside per kind
#: Mean probability of its tags that a model span needs.
SURE = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can start inside a run of digits only if it can at the run's start
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, by start, then kind."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def symbols(text: str) -> np.ndarray:
    """Symbol of each character: ASCII as itself, then other letters, then the rest."""
    point = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(point < 128, point, np.where((point >= 0xC0) & (point < 0x2000), 128, 129)).astype(np.int64)


# -- model -----------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def allowed_moves() -> np.ndarray:
    """0 where tag j may follow tag i, else a large negative number; row TAGS is the start."""
    move = np.zeros((TAGS + 1, TAGS), dtype=np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        move[:, inside] = -1e4
        move[[inside - 1, inside], inside] = 0
    return move


class Tagger:
    def __init__(self, params: dict[str, np.ndarray] | None = None, seed: int = 7):
        if params is None:
            rng = np.random.default_rng(seed)
            params = {}
            for d in "fb":
                params[f"in_{d}"] = rng.normal(0, 0.3, (SYMBOLS, 4 * HIDDEN))
                params[f"rec_{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
                params[f"in_{d}"][:, HIDDEN : 2 * HIDDEN] += 1.0  # remember by default
            params["out"] = rng.normal(0, 0.2, (2 * HIDDEN, TAGS))
            params["bias"] = np.zeros(TAGS)
            params["move"] = np.zeros((TAGS + 1, TAGS))
        self.params = {k: v.astype(np.float32) for k, v in params.items()}

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (time, batch, hidden) of one direction over symbols (batch, time)."""
        w, u = self.params[f"in_{d}"], self.params[f"rec_{d}"]
        steps = range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1)
        h = c = np.zeros((len(x), HIDDEN), dtype=np.float32)
        out = np.empty((x.shape[1], len(x), HIDDEN), dtype=np.float32)
        saved = []
        for t in steps:
            z = w[x[:, t]] + h @ u
            g = z[:, 3 * HIDDEN :]
            gates, cand = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(g)
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before, last = c, h
            c = f * c + i * cand
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                saved.append((t, i, f, o, cand, before, tc, last))
        return out, saved

    def emissions(self, x: np.ndarray, keep: bool = False):
        forth, a = self._lstm(x, "f", keep)
        back, b = self._lstm(x, "b", keep)
        h = np.concatenate([forth, back], axis=2)
        return h @ self.params["out"] + self.params["bias"], h, (a, b)

    @staticmethod
    def _sums(e: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums over all paths up to and from each tag, and over all paths."""
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0] + move[TAGS]
        for t in range(1, len(e)):
            a[t] = e[t] + _log_sum(a[t - 1][:, :, None] + move[None, :TAGS], 1)
        for t in range(len(e) - 2, -1, -1):
            b[t] = _log_sum(move[None, :TAGS] + (e[t + 1] + b[t + 1])[:, None, :], 2)
        return a, b, _log_sum(a[-1], 1)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags (batch, time) and its gradients."""
        e, h, saved = self.emissions(x, keep=True)
        steps, n = e.shape[:2]
        move = self.params["move"] + allowed_moves()
        a, b, z = self._sums(e, move)
        d_e = np.exp(a + b - z[None, :, None])
        d_move = np.zeros_like(move)
        d_move[TAGS] = d_e[0].sum(axis=0)
        for t in range(1, steps):
            pair = a[t - 1][:, :, None] + move[None, :TAGS] + (e[t] + b[t])[:, None, :] - z[:, None, None]
            d_move[:TAGS] += np.exp(pair).sum(axis=0)
        rows = np.arange(n)
        gold = e[0, rows, y[:, 0]] + move[TAGS, y[:, 0]]
        np.add.at(d_move, (TAGS, y[:, 0]), -1)
        for t in range(steps):
            d_e[t, rows, y[:, t]] -= 1
            if t:
                gold = gold + e[t, rows, y[:, t]] + move[y[:, t - 1], y[:, t]]
                np.add.at(d_move, (y[:, t - 1], y[:, t]), -1)
        d_e /= n
        grads = {"move": d_move / n, "bias": d_e.sum(axis=(0, 1)), "out": np.einsum("tbh,tbk->hk", h, d_e)}
        d_h = d_e @ self.params["out"].T
        for part, d in zip(saved, "fb"):
            u = self.params[f"rec_{d}"]
            half = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            g_in, g_rec = np.zeros_like(self.params[f"in_{d}"]), np.zeros_like(u)
            dh = dc = np.zeros((n, HIDDEN), dtype=np.float32)
            for t, i, f, o, cand, before, tc, last in reversed(part):
                dh = dh + d_h[t][:, half]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate(
                    [dc * cand * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - cand * cand)], axis=1
                )
                g_rec += last.T @ dz
                np.add.at(g_in, x[:, t], dz)
                dh, dc = dz @ u.T, dc * f
            grads[f"in_{d}"], grads[f"rec_{d}"] = g_in, g_rec
        return float((z - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int = 48, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over random batches; the loss of every step."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(p) for k, p in self.params.items()}
        losses = []
        for s in range(1, steps + 1):
            pick = rng.integers(0, len(x), batch)
            loss, grads = self.gradients(x[pick], y[pick])
            losses.append(loss)
            now = rate * min(1.0, 2 * (1 - (s - 1) / steps))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.params[k] = (
                    self.params[k] - now * (m[k] / (1 - 0.9**s)) / (np.sqrt(v[k] / (1 - 0.999**s)) + 1e-8)
                ).astype(np.float32)
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (batch, time), and the probability of each."""
        e, _, _ = self.emissions(x)
        move = self.params["move"] + allowed_moves()
        steps, n = e.shape[:2]
        best, back = e[0] + move[TAGS], np.empty((steps, n, TAGS), dtype=np.int8)
        for t in range(1, steps):
            all_ = best[:, :, None] + move[None, :TAGS]
            back[t] = all_.argmax(axis=1)
            best = all_.max(axis=1) + e[t]
        tags = np.empty((n, steps), dtype=np.int64)
        rows = np.arange(n)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t, rows, tags[:, t]]
        a, b, z = self._sums(e, move)
        sure = np.take_along_axis(a + b, tags.T[:, :, None], axis=2)[:, :, 0] - z
        return tags, np.exp(sure).T


def _tag_texts(tagger: Tagger, texts: list[str], windows_at_once: int = 512):
    """Per text its tags and their probabilities, each character from the window in whose core it lies."""
    jobs: list[tuple[int, int]] = []
    codes, tags, sure = [], [], []
    for k, text in enumerate(texts):
        x = symbols(text)
        codes.append(x)
        tags.append(np.zeros(len(x), np.int64))
        sure.append(np.zeros(len(x), np.float32))
        near = np.zeros(-(-len(x) // CORE), bool)
        spots = np.flatnonzero(((x >= 48) & (x <= 57)) | (x == 64))
        for shift in (-CONTEXT, 0, CONTEXT):
            near[np.clip(spots + shift, 0, len(x) - 1) // CORE] = True
        jobs += [(k, int(c) * CORE) for c in np.flatnonzero(near)]
    for lo in range(0, len(jobs), windows_at_once):
        part = jobs[lo : lo + windows_at_once]
        x = np.full((len(part), CORE + 2 * CONTEXT), 10, dtype=np.int64)  # the outside of a text is line ends
        for r, (k, at) in enumerate(part):
            a, b = max(0, at - CONTEXT), min(len(codes[k]), at + CORE + CONTEXT)
            x[r, a - at + CONTEXT : b - at + CONTEXT] = codes[k][a:b]
        t, m = tagger.decode(x)
        for r, (k, at) in enumerate(part):
            n = min(CORE, len(codes[k]) - at)
            tags[k][at : at + n] = t[r, CONTEXT : CONTEXT + n]
            sure[k][at : at + n] = m[r, CONTEXT : CONTEXT + n]
    return zip(tags, sure)


def _possible(kind: int, text: str) -> bool:
    """Whether a model span can be of its kind at all."""
    digits = len(_DIGITS.findall(text))
    if kind == 0:
        return "@" in text and "." in text
    if kind == 1:
        return len(re.findall(r"[0-9]+", text)) == 4 and digits <= 12
    return (12 <= digits <= 19) if kind == 2 else (7 <= digits <= 15)


def model_spans(text: str, tags: np.ndarray, sure: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the stitched tags that add to the base ones."""
    out = []
    taken = np.zeros(len(text) + 1, bool)
    for s, _, e in base:
        taken[s:e] = True
    kind = np.where(tags > 0, (tags - 1) // 2, -1)
    edge = np.flatnonzero((kind[1:] != kind[:-1]) | ((tags[1:] % 2 == 1) & (tags[1:] > 0))) + 1
    cuts = np.concatenate([[0], edge, [len(tags)]])
    for s, e in zip(cuts[:-1], cuts[1:]):
        if s == e or kind[s] < 0 or taken[s:e].any() or sure[s:e].mean() < SURE:
            continue
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        while s < e and not text[e - 1].isalnum():
            e -= 1
        if s < e and _possible(int(kind[s]), text[s:e]):
            out.append((int(s), int(kind[s]), int(e)))
    return out


# -- training data ---------------------------------------------------------------------


def varied(kind: int, text: str, pick: int) -> str:
    """Another way to write a matched text; most stay as they are."""
    if pick % 4:
        return text
    if kind == 0:
        return text.replace("@", " @ ", 1)
    if kind == 3:
        return re.sub(r"^\+[0-9]+[ ]*", "", text) if pick % 8 else text[1:].replace(" ", ".")
    return text.replace(" ", "-") if kind == 2 else text


def snippets(text: str, per_doc: int, first: int | None = None) -> list[tuple[str, list[int]]]:
    """Snippets around base matches (those of kind ``first`` before others) and around other digits, with their tags."""
    spans = base_spans(text)
    spots = [(s, e) for s, _, e in sorted(spans, key=lambda x: x[1] != first)] + [(m.start(), m.end()) for m in re.finditer(r"[0-9]+", text) if not any(s <= m.start() < e for s, _, e in spans)]
    out = []
    for s, e in spots[:per_doc]:
        salt = int.from_bytes(hashlib.sha256(text[max(0, s - 20) : e].encode("utf-8", "surrogatepass")).digest()[:4], "big")
        lo = max(0, s - salt % max(1, SNIPPET - min(e - s, SNIPPET - 1)))
        piece, tags, at = "", [], lo
        for a, kind, b in spans:
            if b <= at or a >= lo + SNIPPET or a < at:
                continue
            new = varied(kind, text[a:b], salt // 64)
            piece += text[at:a] + new
            tags += [0] * (a - at) + [1 + 2 * kind] + [2 + 2 * kind] * (len(new) - 1)
            at = b
        rest = text[at : max(at, lo + SNIPPET)]
        piece, tags = piece + rest, tags + [0] * len(rest)
        out.append((piece[:SNIPPET], tags[:SNIPPET]))
    return out


def _drawn(sample: int, per_doc: int):
    """Per kind, and for texts without a match, snippets of the ``sample`` texts of a task that come first by hash."""

    def run(batches):
        held: list[dict[float, list]] = [{} for _ in range(len(KINDS) + 1)]
        last: list[list[float]] = [[] for _ in held]
        for batch in batches:
            for text, place in zip(batch.column("text").to_pylist(), batch.column("place").to_pylist()):
                if all(len(h) == sample and place >= -h[0] for h in last):
                    continue
                for kind in {k for _, k, _ in base_spans(text)} or {len(KINDS)}:
                    if place in held[kind] or (len(last[kind]) == sample and place >= -last[kind][0]):
                        continue
                    held[kind][place] = snippets(text, per_doc, kind)
                    heapq.heappush(last[kind], -place)
                    if len(last[kind]) > sample:
                        del held[kind][-heapq.heappop(last[kind])]
        rows = [(k, p, x) for k, texts in enumerate(held) for p, x in texts.items()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in rows], pa.int32()),
                pa.array([p for _, p, _ in rows], pa.float64()),
                pa.array([[p for p, _ in x] for _, _, x in rows], pa.list_(pa.string())),
                pa.array([[t for _, t in x] for _, _, x in rows], pa.list_(pa.list_(pa.int64()))),
            ],
            names=["kind", "place", "pieces", "tags"],
        )

    return run


def train(rows: list[tuple[str, list[int]]], steps: int) -> Tagger | None:
    rows = sorted((p, list(t)) for p, t in rows)
    if not any(any(t) for _, t in rows):
        return None
    x, y = np.full((len(rows), SNIPPET), 10, dtype=np.int64), np.zeros((len(rows), SNIPPET), dtype=np.int64)
    for i, (p, t) in enumerate(rows):
        x[i, : len(p)], y[i, : len(t)] = symbols(p), t
    tagger = Tagger()
    tagger.fit(x, y, steps)
    return tagger


def _find(shared):
    def run(batches):
        tagger = Tagger(shared.value) if shared.value else None
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            every = [list(b) for b in base]
            # bounded groups of texts are tagged at once
            todo = [i for i, t in enumerate(texts) if tagger and _TRIGGER.search(t)]
            for lo in range(0, len(todo), 64):
                part = todo[lo : lo + 64]
                for i, (tags, sure) in zip(part, _tag_texts(tagger, [texts[i] for i in part])):
                    every[i] = sorted(base[i] + model_spans(texts[i], tags, sure, base[i]))
            counts = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(spelled(b).encode()).hexdigest() for b in base]),
                    pa.array([spelled(s) for s in every]),
                    pa.array([len(s) - len(b) for s, b in zip(every, base)], pa.int64()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    return run


def find_personal_data(
    docs: DataFrame, sample: int = 400, per_doc: int = 6, steps: int = 350, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans (all), n_added.

    ``sample`` bounds the documents (``per_doc`` snippets of each) from which
    the model is trained.  They are chosen by a hash, in equal shares, among
    the documents in which the base rules find each kind and among those with
    a digit or an at sign and no match, so rare kinds are not missed.
    """
    spark = docs.sparkSession
    d = plain_names(docs, doc_id=doc_id, text=text)
    bound_batches(spark)
    some = d.where(F.col("text").rlike("[0-9@]") & F.lit(sample > 0))
    place = unit_hash(F.col("doc_id"), F.col("text"), F.lit("pii"))
    drawn = cut(
        some.select("text", place.alias("place")).mapInArrow(
            _drawn(sample, per_doc), "kind int, place double, pieces array<string>, tags array<array<long>>"
        )
    )
    kinds = sorted(r.kind for r in drawn.select("kind").distinct().collect())
    rows = []
    for kind in kinds:
        chosen = drawn.where(F.col("kind") == kind).dropDuplicates(["place"]).orderBy("place").limit(max(1, sample // len(kinds)))
        rows += [x for r in chosen.collect() for x in zip(r.pieces, r.tags)]
    tagger = train(rows, steps)
    shared = spark.sparkContext.broadcast(tagger.params if tagger else None)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(
        _find(shared),
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )


def op3_personal_data(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
