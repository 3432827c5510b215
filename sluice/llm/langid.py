"""Language ID by character language models.

Per language an interpolated Kneser-Ney model over the last five characters is
fitted on a bounded sample of labelled documents (``sample`` per language,
whole texts, counted in Spark).  Texts are lower-cased and every run of
non-letters is one space.  An n-gram is packed into one 64-bit number (12 bits
a character); per order one sorted array holds the packed n-grams of all
languages, and beside it stand their log probabilities per language and the
log weights of backing off from them.  A document goes to the language with
the lowest cross-entropy per character.

Rejection is calibrated on labelled documents outside the fitted sample, a
quarter of each language's but a bounded number: their cross-entropies under
their own and under the other models give each language the limit, eased for
short texts, beyond which a text is in none of them.  A language with few such
documents gets the widest of its own, the others' and the pooled limit.

Defined results: null texts and texts without a letter are ``und``, with score
0, and rejected; without labelled rows everything is ``und``; ties go to the
language that sorts first; a null id is not held out; rows that repeat get the
same answer each; an empty table gives an empty result; extra input columns are
ignored (``filter_known`` returns them as they are); texts of any length are
read whole, in slices.  Letters from U+0800 on share 2,048 codes, so two of them
can count as one letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, held_out, plain_names, unit_hash

ORDER = 5
BITS = 12
FOLD = 1 << BITS
SPACE = 32
#: Characters decoded at once.
SLICE_CHARS = 1 << 19
#: Cross-entropies per character count at most for this many characters in the score.
SCORE_CHARS = 40
UNKNOWN = "und"
#: Share of a language's labelled documents set aside to calibrate on, and how many of them make a limit of its own.
ASIDE, FEW = 0.25, 8
#: Share of the way from a language's own cross-entropy to that of foreign texts beyond which a text is in none.
REJECT_AT = 0.75
#: Standard errors that a short text may lie beyond the limit, or a language's own documents beyond their mean.
EASE = 8.0


class _Letters:
    """Symbol of each code point: its number, folded, for letters; space for all others."""

    table = None

    @classmethod
    def symbols(cls, text: str) -> np.ndarray:
        if cls.table is None:
            point = np.arange(0x110000, dtype=np.int64)
            letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), dtype=bool, count=0x110000)
            folded = np.where(point < FOLD // 2, point, FOLD // 2 + point % (FOLD // 2))
            cls.table = np.where(letter, folded, SPACE).astype(np.int64)
        return cls.table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end in a letter, so that no run of non-letters is cut."""
    at = 0
    while at < len(text):
        end = at + SLICE_CHARS
        while end < len(text) and not text[end - 1].isalpha():
            end += 1
        yield text[at:end]
        at = end


def packed(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the text, packed n-gram of the full order) for every character of the texts."""
    lead = np.full(ORDER - 1, SPACE, dtype=np.int64)

    def grams(codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes) - ORDER + 1, dtype=np.int64)
        for i in range(ORDER):
            out = (out << BITS) | codes[i : len(codes) - ORDER + 1 + i]
        return out

    def squeeze(codes: np.ndarray) -> np.ndarray:
        keep = codes != SPACE
        keep[1:] |= codes[:-1] != SPACE
        return keep

    many: list[str] = []
    rows: list[int] = []

    def flush():
        codes = _Letters.symbols("".join(f"    {t}" for t in many))
        # each text stands behind a lead of spaces, which is what its first characters see
        starts = np.cumsum([0, *[len(t) + ORDER - 1 for t in many]])
        keep = squeeze(codes)
        place = np.repeat(np.array(rows), np.diff(starts))
        for i in range(ORDER - 1):
            keep[starts[:-1] + i] = True
        first = starts[:-1] + ORDER - 1
        first = first[first < starts[1:]]
        keep[first] = codes[first] != SPACE
        lead_rows = np.zeros(len(codes), bool)
        for i in range(ORDER - 1):
            lead_rows[starts[:-1] + i] = True
        codes, place, lead_rows = codes[keep], place[keep], lead_rows[keep]
        real = ~lead_rows[ORDER - 1 :]
        return place[ORDER - 1 :][real], grams(codes)[real]

    held = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        text = text.lower()
        if len(text) > SLICE_CHARS:
            before = lead
            for piece in _pieces(text):
                codes = _Letters.symbols(piece)
                keep = squeeze(codes)
                keep[0] = codes[0] != SPACE or before[-1] != SPACE
                codes = np.concatenate([before, codes[keep]])
                if len(codes) >= ORDER:
                    g = grams(codes)
                    yield np.full(len(g), i), g
                before = codes[-(ORDER - 1) :]
            continue
        many.append(text)
        rows.append(i)
        held += len(text)
        if held > SLICE_CHARS:
            yield flush()
            many, rows, held = [], [], 0
    if many:
        yield flush()


def _count(batches):
    """Packed n-grams of the sample per language, summed within a batch."""
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            mine = [t for t, x in zip(texts, langs) if x == lang]
            for _, g in packed(mine):
                code, n = np.unique(g, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n)], ["lang", "code", "n"])


class LanguageModels:
    """Sorted n-gram arrays per order with log probabilities per language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], discount: float = 0.75):
        self.langs = sorted(counts)
        n_langs = len(self.langs)
        tables: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for lang in self.langs:
            code, n = counts[lang]
            by_order = [(code, n.astype(np.float64))]
            for k in range(ORDER - 1, 0, -1):
                # below the top, an n-gram counts once for every character seen before it
                code, n = np.unique(by_order[0][0] & ((1 << (BITS * k)) - 1), return_counts=True)
                by_order.insert(0, (code, n.astype(np.float64)))
            tables.append(by_order)
        self.grams: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.back: list[np.ndarray] = []  # per context, log weight of the order below
        symbols = len(np.unique(np.concatenate([t[0][0] for t in tables]))) + 1
        lower = np.full((1, n_langs), 1.0 / symbols)
        for k in range(1, ORDER + 1):
            union = np.unique(np.concatenate([t[k - 1][0] for t in tables]))
            contexts = np.unique(union >> BITS)
            weight = np.ones((len(contexts), n_langs))
            prob = np.zeros((len(union), n_langs))
            for j, t in enumerate(tables):
                code, n = t[k - 1]
                ctx, inverse, types = np.unique(code >> BITS, return_inverse=True, return_counts=True)
                total = np.bincount(inverse, n)
                weight[np.searchsorted(contexts, ctx), j] = discount * types / total
                prob[np.searchsorted(union, code), j] = np.maximum(n - discount, 0) / total[inverse]
            below = np.searchsorted(self.grams[-1], union & ((1 << (BITS * (k - 1))) - 1)) if k > 1 else np.zeros(len(union), np.int64)
            prob += weight[np.searchsorted(contexts, union >> BITS)] * lower[below]
            self.grams.append(union)
            self.contexts.append(contexts)
            self.logp.append(np.log(prob).astype(np.float32))
            self.back.append(np.log(weight).astype(np.float32))
            lower = prob
        self.floor = np.float32(-np.log(symbols))

    @classmethod
    def of(cls, state: dict) -> LanguageModels:
        """From plain arrays, which is what is broadcast."""
        models = cls.__new__(cls)
        models.__dict__.update(state)
        return models

    def log_probs(self, code: np.ndarray) -> np.ndarray:
        """Log probability of each packed n-gram's last character per language."""
        out = np.zeros((len(code), len(self.langs)), dtype=np.float32)
        left = np.arange(len(code))
        for k in range(ORDER, 0, -1):
            grams, g = self.grams[k - 1], code[left] & ((1 << (BITS * k)) - 1)
            at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
            hit = grams[at] == g
            out[left[hit]] += self.logp[k - 1][at[hit]]
            left, g = left[~hit], g[~hit]
            if not len(left):
                return out
            if k > 1:
                ctx = self.contexts[k - 1]
                at = np.minimum(np.searchsorted(ctx, g >> BITS), len(ctx) - 1)
                known = ctx[at] == g >> BITS
                out[left[known]] += self.back[k - 1][at[known]]
            else:
                out[left] += self.back[0][0] + self.floor
        return out

    def entropies(self, texts: list[str | None], spread: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: cross-entropy per character and language, its variance if asked for, and characters counted."""
        shape = (len(texts), len(self.langs))
        total, square, n = np.zeros(shape), np.zeros(shape), np.zeros(len(texts))
        for row, code in packed(texts):
            # a text's characters follow each other
            heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            for lo in range(0, len(heads), 64):
                part = heads[lo : lo + 64]
                end = heads[lo + 64] if lo + 64 < len(heads) else len(row)
                lp = self.log_probs(code[part[0] : end])
                total[row[part]] += np.add.reduceat(lp, part - part[0], axis=0, dtype=np.float64)
                if spread:
                    square[row[part]] += np.add.reduceat(lp * lp, part - part[0], axis=0, dtype=np.float64)
                n[row[part]] += np.diff(np.r_[part, end])
        size = np.maximum(n, 1)[:, None]
        return -total / size, np.maximum(square / size - (total / size) ** 2, 0), n


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _judge(models: LanguageModels, limits: dict, texts: list[str | None]):
    """Per text: language, score, cross-entropy and whether it is in none of the languages."""
    entropy, _, n = models.entropies(texts)
    at, best = np.arange(len(texts)), entropy.argmin(axis=1)
    logit = -(entropy - entropy[at, best][:, None]) * np.minimum(n, SCORE_CHARS)[:, None]
    score = 1 / np.exp(logit).sum(axis=1)
    lettered = np.array([has_letter(t) for t in texts], dtype=bool)
    limit, z, spread = (np.array([limits.get(x, (np.inf, 0.0, 0.0))[i] for x in models.langs]) for i in range(3))
    far = entropy[at, best] > limit[best] + z[best] * np.sqrt(spread[best] / np.maximum(n, 1))
    langs = [models.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    return langs, np.where(lettered, score, 0.0), np.where(lettered, entropy[at, best], np.nan), ~lettered | far


def _score(shared, limits):
    def run(batches):
        models = LanguageModels.of(shared.value)
        for batch in batches:
            langs, score, entropy, rejected = _judge(models, limits, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(langs, pa.string()),
                    pa.array(score),
                    pa.array(entropy, from_pandas=True),
                    pa.array(rejected),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "entropy", "rejected"],
            )

    return run


def _keep(shared, limits, text):
    def run(batches):
        models = LanguageModels.of(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(~_judge(models, limits, batch.column(text).to_pylist())[3]))

    return run


def _calibrate(shared):
    def run(batches):
        models = LanguageModels.of(shared.value)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            entropy, spread, n = models.entropies(batch.column("text").to_pylist(), spread=True)
            own = np.array([models.langs.index(x) for x in langs], dtype=np.int64)
            at = np.flatnonzero(n > 0)
            own = own[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[i] for i in at], pa.string()),
                    pa.array(entropy[at, own]),
                    pa.array((entropy[at].sum(axis=1) - entropy[at, own]) / max(1, len(models.langs) - 1)),
                    pa.array(spread[at, own]),
                    pa.array(n[at]),
                ],
                names=["lang", "entropy", "foreign", "spread", "n"],
            )

    return run


def _limits(rows, langs: list[str]) -> dict[str, tuple[float, float, float]]:
    """Per language: the cross-entropy limit for long texts, and the deviations and variance that short ones add.

    The limit lies three quarters of the way from the language's own documents
    to what its documents score under the other models, so that texts of two
    known languages stay; it never lies within ``EASE`` deviations of the own
    mean.  A language with fewer than ``FEW`` rows takes the widest limit of
    any language or of all rows together.
    """
    if not rows:
        return {}
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r.lang, []).append((r.entropy, r.foreign, r.spread))

    def limit(got: list) -> tuple[float, float, float]:
        entropy, foreign, spread = np.array(got).T
        mean, deviation = np.median(entropy), 1.4826 * np.median(np.abs(entropy - np.median(entropy)))
        most = max(mean + REJECT_AT * (np.median(foreign) - mean), mean + EASE * deviation)
        return float(most), EASE, float(np.median(spread))

    own = {lang: limit(got) for lang, got in by.items()}
    every = [*own.values(), limit([x for got in by.values() for x in got])]
    wide = (max(x[0] for x in every), EASE, max(x[2] for x in every))
    return {lang: own[lang] if len(by.get(lang, ())) >= FEW else wide for lang in langs}


def fit(docs: DataFrame, sample: int, calibration: int):
    """Models (broadcast) and limits from the labelled rows of (doc_id, text, lang), or None without any.

    ``sample`` and ``calibration`` bound, per language and in expectation, the
    documents used; they are chosen by a hash of id and text among the rows
    that are not held out.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    at = unit_hash(F.col("doc_id"), F.col("text"), F.lit("langid"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("last")).collect()
    if not sizes:
        return None

    def of_lang(share: dict[str, float]):
        return F.create_map(*[F.lit(x) for kv in share.items() for x in kv])[F.col("lang")]

    # the first rows by hash are set aside; a language that would have no others is fitted on all of them
    aside = {r.lang: min(ASIDE, calibration / r.n) for r in sizes}
    aside = {r.lang: aside[r.lang] if r.last >= aside[r.lang] else 0.0 for r in sizes}
    fitted = {r.lang: aside[r.lang] + sample / r.n for r in sizes}
    got = (
        known.where((at >= of_lang(aside)) & (at < of_lang(fitted)))
        .select("lang", "text")
        .mapInArrow(_count, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = got.column("lang").to_numpy(zero_copy_only=False)
    codes, sums = got.column("code").to_numpy(), got.column("n").to_numpy()
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for x in sorted(set(names)):
        mine = names == x
        order = np.argsort(codes[mine])
        counts[x] = (codes[mine][order], sums[mine][order])
    if not counts:
        return None
    shared = spark.sparkContext.broadcast(dict(vars(LanguageModels(counts))))
    checked = known.where((at < of_lang(aside)) & F.col("lang").isin(list(counts)))
    rows = checked.select("lang", "text").mapInArrow(_calibrate(shared), "lang string, entropy double, foreign double, spread double, n double")
    return shared, _limits(rows.collect(), sorted(counts))


def identify_languages(
    docs: DataFrame,
    sample: int = 600,
    calibration: int = 200,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1), entropy (nats a character), rejected."""
    d = plain_names(docs, doc_id=doc_id, text=text, lang=lang)
    fitted = fit(d, sample, calibration)
    d = d.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    if fitted is None:
        nothing = F.lit(None).cast("double").alias("entropy")
        return d.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), nothing, F.lit(True).alias("rejected"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(
        _score(*fitted), f"doc_id {kind}, held_out boolean, lang_pred string, score double, entropy double, rejected boolean"
    )


def filter_known(
    docs: DataFrame, sample: int = 600, calibration: int = 200, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected; without labelled rows nothing is known."""
    fitted = fit(plain_names(docs, doc_id=doc_id, text=text, lang=lang), sample, calibration)
    return docs.where(F.lit(False)) if fitted is None else docs.mapInArrow(_keep(*fitted, text), docs.schema)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify_languages(docs)
