"""Toxicity from a learned lexicon, misspellings and context.

1. Lexicon.  On a bounded sample of labelled documents, words and word stems
   are counted per label; those that toxic documents hold far more often
   become terms.  A stem stands for every word that begins with it.
2. Matching.  The terms form a trie.  For every word the Levenshtein automaton
   (one edit for terms of five letters or more, two from ten) is intersected
   with the trie; that intersection is determinised into a table of states as
   words first take its steps, and all words of a batch run through the table
   together, character by character, until they fail.  There the first letter must be right.  Words
   without a match run through a second table, loose, that takes edits at the
   first letter too and one in terms of four letters; a sign before a word may
   stand for its first letter.  Loose matches are features of their own, so the
   weights tell chance from disguise.
3. Context.  A match inside quotation marks or near a word of reporting counts
   less, one near a word of address counts more.
4. Score.  A logistic regression, fitted on the same sample, weighs the
   matches by term, distance and context.

Defined results: null and empty texts have no match and get the score of a
text without any; documents without a label are scored alike; a null label or
id trains nothing; without both labels in the training rows every score is
the share of toxic ones (0 if there are none); rows that repeat get the same
score each; an empty table gives an empty result; words and texts may be of any
length; the letters of the lexicon may be any number; of terms at one distance
the first counts; extra input columns are ignored.
"""

from __future__ import annotations

from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, cut, held_out, plain_names, table, unit_hash

MIN_LENGTH, MAX_STEM = 4, 9
#: Fixed word lists of the context windows, lower-case.
REPORTING = ("said", "says", "wrote", "called", "quoted", "quote", "reported", "according", "replied", "term", "word", "sagte", "dit", "dijo")
ADDRESS = ("you", "your", "youre", "u", "are", "du", "sie", "tu", "vous", "usted", "eres")
QUOTES = '"“”„«»'
WINDOW = 40
QUOTED, ADDRESSED = 0.35, 1.25
SLICE_CHARS = 1 << 18
#: States a task's table may hold before it is started anew.
STATES = 50_000


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 10 else 2


def loose_edits(length: int) -> int:
    return 1 if length == MIN_LENGTH else edits_allowed(length)


# -- lexicon ---------------------------------------------------------------------------


def _candidates(batches):
    """Words and stems of each labelled document, counted per label within a batch."""
    for batch in batches:
        for label in (0, 1):
            seen: Counter = Counter()
            for text, x in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                if x == label:
                    words = set(_plain_words(text or ""))
                    seen.update(words)
                    seen.update({w[:n] + "*" for w in words for n in range(MIN_LENGTH, min(len(w), MAX_STEM + 1))})
            if seen:
                terms, n = zip(*seen.items())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([label] * len(n)), pa.array(n)], ["term", "label", "n"])


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def evidence(a, b, share: float, log=np.log):
    """Lower bound of -ln P(a or more of a + b documents are toxic by chance): a Chernoff bound."""
    n = a + b
    return a * log(a / n / share) + b * log((b + 1e-9) / n / (1 - share))


def choose_terms(found: list[tuple[str, int, int]]) -> list[str]:
    """Terms among (term, toxic documents, clean documents); a stem ends in ``*``.

    A stem is taken if no single next letter (nor the stem as a word) accounts
    for nearly all of it; then the words and longer stems it covers are left out.
    """
    score = {t: a for t, a, _ in found}
    taken: list[str] = []
    for t in sorted((t for t in score if t.endswith("*")), key=lambda t: (len(t), t)):
        stem = t[:-1]
        if any(stem.startswith(x[:-1]) for x in taken):
            continue
        parts = [a for k, a in score.items() if k != t and k.startswith(stem) and len(k.rstrip("*")) <= len(stem) + 1]
        if max(parts, default=0) < 0.9 * score[t]:
            taken.append(t)
    words = [t for t in score if not t.endswith("*") and not any(t.startswith(x[:-1]) for x in taken)]
    return taken + sorted(words)


# -- automaton -------------------------------------------------------------------------


class Matcher:
    """The Levenshtein automata of all terms, intersected with their trie, determinised as words ask for it.

    ``step[state, class]`` is the next state (0: none, negative: not asked for
    yet); ``best[state]`` is the match a word that ends there makes, as
    term * 3 + distance, or -1; in ``stem[state]`` the same holds wherever the
    word goes on.  A state is a set of trie nodes with the fewest edits to each.
    Only the trie is built beforehand; a state's steps are worked out when a
    word first takes them, so the work follows the text, not the lexicon.  Each
    task keeps its own table, which is started anew beyond ``STATES`` states.
    If ``loose``, the first letter may be wrong, and terms of four letters take
    an edit.
    """

    def __init__(self, terms: list[str], loose: bool = False):
        edits = loose_edits if loose else edits_allowed
        self.loose = loose
        letters = sorted({c for t in terms for c in t if c != "*"})
        self.letters = [None, *letters]  # class 0: any other character
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[list[tuple[int, bool]]] = [[]]
        self.limit: list[int] = [0]
        self.allowed = [edits(len(t.rstrip("*"))) for t in terms]
        class_of = {c: i + 1 for i, c in enumerate(letters)}
        for i, t in enumerate(terms):
            at = 0
            for c in t.rstrip("*"):
                self.limit[at] = max(self.limit[at], self.allowed[i])
                if class_of[c] not in self.children[at]:
                    self.children[at][class_of[c]] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.limit.append(0)
                at = self.children[at][class_of[c]]
            self.limit[at] = max(self.limit[at], self.allowed[i])
            self.ends[at].append((i, t.endswith("*")))
        self.codes = np.array([ord(c) for c in letters], dtype=np.int64)
        self._start()

    @classmethod
    def of(cls, state: dict) -> Matcher:
        """The matcher of a broadcast state; one for all tasks of a worker, which so share its table."""
        if "live" not in state:
            m = cls.__new__(cls)
            m.__dict__.update(state)
            m._start()
            state["live"] = m
        return state["live"]

    def _start(self) -> None:
        """The table with no state but the dead one and the start."""
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = [frozenset(), self._closed({0: 0})]
        self.step = np.full((64, len(self.letters)), -1, dtype=np.int32)
        self.best, self.stem = (np.full(64, -1, dtype=np.int32) for _ in range(2))
        self.step[0] = 0
        if not self.loose:
            # the first letter must be right: that keeps chance matches out
            self.step[1] = 0
            for k, child in self.children[0].items():
                self.step[1, k] = self._of(self._closed({child: 0}))

    def classes(self, points: np.ndarray) -> np.ndarray:
        """The class of each character."""
        if not len(self.codes):
            return np.zeros(len(points), np.int32)
        at = np.minimum(np.searchsorted(self.codes, points), len(self.codes) - 1)
        return np.where(self.codes[at] == points, at + 1, 0).astype(np.int32)

    def _closed(self, pairs: dict[int, int]) -> frozenset:
        """Trie nodes reachable by leaving out letters of a term, each with its fewest edits."""
        todo = deque(pairs.items())
        while todo:
            node, e = todo.popleft()
            if e > pairs.get(node, 9):
                continue
            for child in self.children[node].values():
                if e + 1 <= self.limit[child] and e + 1 < pairs.get(child, 9):
                    pairs[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(pairs.items())

    def _read(self, state: frozenset, k: int) -> frozenset:
        """The state after one more character of class ``k``."""
        out: dict[int, int] = {}
        limit = self.limit
        for node, e in state:
            if e + 1 <= limit[node] and e + 1 < out.get(node, 9):
                out[node] = e + 1  # the character is too many
            if e + 1 <= limit[node]:
                for letter, child in self.children[node].items():
                    cost = e if letter == k else e + 1
                    if cost <= limit[child] and cost < out.get(child, 9):
                        out[child] = cost
            elif k in self.children[node]:
                child = self.children[node][k]
                if e <= limit[child] and e < out.get(child, 9):
                    out[child] = e
        return self._closed(out)

    def _of(self, state: frozenset) -> int:
        """The number of a state, new ones at the end of the table."""
        if not state:
            return 0
        n = self.number.get(state)
        if n is None:
            n = self.number[state] = len(self.states)
            self.states.append(state)
            if n >= len(self.step):
                more = len(self.step)
                self.step = np.concatenate([self.step, np.full((more, self.step.shape[1]), -1, dtype=np.int32)])
                self.best, self.stem = (np.concatenate([x, np.full(more, -1, dtype=np.int32)]) for x in (self.best, self.stem))
            for table, stems in ((self.best, False), (self.stem, True)):
                got = [(e, i) for node, e in state for i, is_stem in self.ends[node] if e <= self.allowed[i] and (is_stem or not stems)]
                e, i = min(got, default=(-1, 0))
                table[n] = i * 3 + e
        return n

    def _next(self, state: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The states after these characters; steps taken for the first time are worked out here."""
        after = self.step[state, classes]
        unknown = np.flatnonzero(after < 0)
        if len(unknown):
            width = len(self.letters)
            for pair in np.unique(state[unknown].astype(np.int64) * width + classes[unknown]).tolist():
                s, k = divmod(pair, width)
                self.step[s, k] = self._of(self._read(self.states[s], k))
            after = self.step[state, classes]
        return after

    def run(self, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Match of each word, as term * 3 + distance, or -1; all words take one step at a time."""
        if len(self.states) > STATES:
            self._start()
        found = np.full(len(starts), -1, dtype=np.int32)
        word, at, state = np.arange(len(starts)), starts.copy(), np.ones(len(starts), dtype=np.int32)
        while len(word):
            state = self._next(state, classes[at])
            at += 1
            live = state > 0
            word, at, state = word[live], at[live], state[live]
            over = at >= ends[word]
            hit = np.where(over, self.best[state], self.stem[state])
            better = (hit >= 0) & ((found[word] < 0) | (hit % 3 < found[word] % 3))
            found[word[better]] = hit[better]
            word, at, state = word[~over], at[~over], state[~over]
        return found


class _Letters:
    table = None

    @classmethod
    def kinds(cls) -> np.ndarray:
        """1: letter or digit, 2: a sign that may stand for a letter inside a word."""
        if cls.table is None:
            cls.table = np.fromiter((chr(p).isalnum() for p in range(0x110000)), dtype=np.uint8, count=0x110000)
            for c in "@$*!":
                cls.table[ord(c)] = 2
        return cls.table


def words_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the words: letters and digits, and signs with one of these on both sides."""
    kind = _Letters.kinds()[points]
    solid = kind == 1
    inner = np.flatnonzero(kind == 2)
    inner = inner[(inner > 0) & (inner < len(points) - 1)]
    solid[inner[(kind[inner - 1] == 1) & (kind[inner + 1] == 1)]] = True
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def context_factor(text: str, start: int, end: int) -> float:
    """How much a match counts, from the window around it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    factor = 1.0
    open_at = max(before.rfind(q) for q in QUOTES)
    if (open_at >= 0 and any(q in after for q in QUOTES) and sum(before.count(q) for q in QUOTES) % 2) or any(
        w in REPORTING for w in _plain_words(before)[-4:]
    ):
        factor *= QUOTED
    if any(w in ADDRESS for w in _plain_words(before)[-3:] + _plain_words(after)[:2]):
        factor *= ADDRESSED
    return factor


def _pieces(text: str):
    """(offset, piece) of a long text, cut at white space where there is any."""
    at = 0
    while at < len(text):
        end = at + SLICE_CHARS
        while end < len(text) and not text[end - 1].isspace():
            end += 1
        yield at, text[at:end]
        at = end


def loose_matches(matcher: Matcher, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Match of each word, with or without the sign before it, whichever is closer."""
    classes = matcher.classes(points)
    found = matcher.run(classes, starts, ends)
    signed = np.flatnonzero((starts > 0) & (_Letters.kinds()[points[starts - 1]] == 2))
    other = matcher.run(classes, starts[signed] - 1, ends[signed])
    better = (other >= 0) & ((found[signed] < 0) | (other % 3 < found[signed] % 3))
    found[signed[better]] = other[better]
    return found


def features(matcher: Matcher, texts: list[str | None], n_terms: int, loose: Matcher | None = None) -> np.ndarray:
    """Per text and (term, exact or misspelt): the strongest match; last, the log of the sum of all.

    With ``loose``, per term its strongest loose match and the log of their sum
    stand before the last; of these only the strongest adds to the sum of all,
    so that the chance matches of a long text do not add up.
    """
    out = np.zeros((len(texts), 2 * n_terms + 1 if loose is None else 3 * n_terms + 2))
    total, chance, closest = np.zeros((3, len(texts)))
    part: list[tuple[int, int, str]] = []
    held = 0

    def flush():
        joined = "\n".join(p for _, _, p in part)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts, ends = words_of(points)
        found = matcher.run(matcher.classes(points), starts, ends)
        strict = found >= 0
        if loose is not None and len(starts):
            rest = np.flatnonzero(~strict)
            found[rest] = loose_matches(loose, points, starts[rest], ends[rest])
        hits = np.flatnonzero(found >= 0)
        heads = np.cumsum([0, *[len(p) + 1 for _, _, p in part]])
        for h, k in zip(hits, np.searchsorted(heads, starts[hits], side="right") - 1):
            row, _, piece = part[k]
            term, distance = divmod(int(found[h]), 3)
            value = context_factor(piece, int(starts[h] - heads[k]), int(ends[h] - heads[k]))
            column = 2 * term + (distance > 0) if strict[h] else 2 * n_terms + term
            out[row, column] = max(out[row, column], value)
            if strict[h]:
                total[row] += value / (1 + distance)
            else:
                chance[row] += value / (1 + distance)
                closest[row] = max(closest[row], value / (1 + distance))

    for row, text in enumerate(texts):
        if not text:
            continue
        folded = text.lower()
        for at, piece in _pieces(folded):
            part.append((row, at, piece))
            held += len(piece)
            if held > SLICE_CHARS:
                flush()
                part, held = [], 0
    if part:
        flush()
    if loose is not None:
        out[:, -2] = np.log1p(chance)
    out[:, -1] = np.log1p(total + closest)
    return out


# -- weights ---------------------------------------------------------------------------


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with an L2 penalty (none on the intercept, the last weight)."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _train_rows(shared):
    def run(batches):
        model = shared.value
        matcher, loose = Matcher.of(model["matcher"]), Matcher.of(model["loose"])
        for batch in batches:
            x = features(matcher, batch.column("text").to_pylist(), model["terms"], loose)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])

    return run


def _score(shared):
    def run(batches):
        model = shared.value
        matcher, loose, w = Matcher.of(model["matcher"]), Matcher.of(model["loose"]), model["weights"]
        for batch in batches:
            x = features(matcher, batch.column("text").to_pylist(), model["terms"], loose)
            score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= 0.5).astype(np.int32)),
                    pa.array((x[:, : 3 * model["terms"]] > 0).sum(axis=1)),
                ],
                names=["doc_id", "held_out", "score", "predicted", "terms_matched"],
            )

    return run


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 3000,
    odds: float = 10.0,
    doubt: float = 1e-4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted, terms_matched.

    ``sample`` bounds, per label and in expectation, the labelled documents
    that are not held out from which lexicon and weights are learned; they are
    chosen by a hash of the id.  A term must be in ``odds`` times the share of
    toxic documents that it has of clean ones, and the chance that any such
    term is a coincidence is at most ``doubt``.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    d = plain_names(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out(F.col("doc_id")))
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = n.get(1, 0) / max(1, sum(n.values()))
    flat = d.select(
        "doc_id", "held_out", F.lit(prior).alias("score"), F.lit(int(prior >= 0.5)).alias("predicted"), F.lit(0).cast("long").alias("terms_matched")
    )
    if len(n) < 2:
        return flat
    place = unit_hash(F.col("doc_id"), F.lit("toxicity")) * F.when(F.col("toxic") == 1, n[1]).otherwise(n[0])
    chosen = known.where(place < sample)
    train = d.join(F.broadcast(chosen), "doc_id").select("text", "toxic").distinct()
    counted = (
        train.mapInArrow(_candidates, "term string, label long, n long")
        .groupBy("term")
        .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))
    )
    size = {k: min(v, sample) for k, v in n.items()}
    share = size[1] / (size[0] + size[1])
    counted = cut(counted.where("a > 0"))
    doubts = np.log(max(1, counted.count()) / doubt)
    passing = counted.where(evidence(F.col("a"), F.col("b"), share, F.log) >= float(doubts)).where(
        F.col("a") / size[1] >= odds * F.col("b") / size[0]
    )
    terms = choose_terms([(r.term, r.a, r.b) for r in passing.collect()])
    if not terms:
        return flat
    model = {"matcher": dict(vars(Matcher(terms))), "loose": dict(vars(Matcher(terms, loose=True))), "terms": len(terms)}
    rows = train.mapInArrow(_train_rows(spark.sparkContext.broadcast(model)), "toxic int, x array<double>").toArrow()
    x = np.array(rows.column("x").to_pylist())
    y = rows.column("toxic").to_numpy().astype(np.float64)
    order = np.lexsort([*x.T, y])  # the order of the rows must not matter
    shared = spark.sparkContext.broadcast({**model, "weights": fit_weights(x[order], y[order])})
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.select("doc_id", "text", "held_out").mapInArrow(
        _score(shared), f"doc_id {kind}, held_out boolean, score double, predicted int, terms_matched long"
    )


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels"))
