"""Cross-entropy difference scoring.

Two word models of the same form score every document: the target model counts
the documents marked as target, the background model all documents.  They share
one vocabulary (every word), one smoothing and one set of bigrams, those that
occur ``min_pair`` times or more, whatever the size of the corpus.  A document's
score is its mean loss per word under the target model minus that under the
background model, in nats: the lower, the more it resembles the target.

    P(w | h) = kept(h, w) * (c(h, w) - D) / c(h) + rest(h) * P(w)
    P(w)     = (c(w) + a) / (N + a * (V + 1))

where ``rest(h)`` is what the kept bigrams leave, so that each row sums to 1.

The models are tables.  A word's loss is a sum of three parts, one of its
history (``-ln rest(h)``), one of the word (``-ln P(w)``) and, where the bigram
is kept, what that changes.  The parts of the most frequent words and bigrams, a
fixed number of each, are broadcast and added up where the text is read; all
others are joined: reading leaves a row per rarer word and per bigram that
passes a bit filter of the kept ones (false hits meet no row and add nothing),
and the joined parts are summed per document.  Words and bigrams are counted in
one scan each, summed within tasks before the shuffle.

Defined results: null and empty texts have 0 words and null losses; rows that
repeat count and score each; null labels and ids mark no target; without any
target document the target model is uniform; words are runs of letters and
digits, A-Z lower-cased; words are told apart by 63 bits of hash; an empty table
gives an empty result; extra input columns are ignored; texts of any length are
read whole, in slices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.collocations import fingerprint_filter, passes
from sluice.llm.common import bound_batches, cut, plain_names, small_side, table
from sluice.llm.words import PUNCTUATION, mix, word_hashes
from sluice.plans.scratch import scratch_path

DISCOUNT, ADD = 0.75, 0.5
#: Words or bigrams counted together within a task, and rows of a batch they leave it in.
CHUNK, ROWS = 1 << 18, 1 << 16
#: The most frequent words and bigrams that are broadcast.
HOT_WORDS, HOT_PAIRS = 1 << 19, 1 << 20
#: Counts up to here have a bin each in the histogram that finds the most frequent; larger ones share bins.
EXACT_BINS = 1 << 14
SIGN = np.uint64(1 << 63)
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: In place of a bigram's word: the key is a rarer word by itself, or a document's own row.
WORD_ROW, OWN_ROW = -2, -1


def _batches(**columns):
    """The columns in batches of ``ROWS`` rows."""
    for lo in range(0, len(next(iter(columns.values()))), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + ROWS]) for x in columns.values()], names=list(columns))


def _word_counts(batches):
    def tally(held):
        codes, flags = (np.concatenate(x) for x in zip(*held))
        unique, place, n = np.unique(codes, return_inverse=True, return_counts=True)
        return _batches(code=unique, n=n, in_target=np.bincount(place, flags, len(unique)).astype(np.int64))

    held, size = [], 0
    for batch in batches:
        target = batch.column("target").to_numpy(zero_copy_only=False)
        for lo, words, bounds in word_hashes(batch.column("text"), PUNCTUATION):
            held.append(((words | SIGN).view(np.int64), np.repeat(target[lo : lo + len(bounds) - 1], np.diff(bounds))))
            size += len(words)
            if size >= CHUNK:
                yield from tally(held)
                held, size = [], 0
    if held:
        yield from tally(held)


def coded(hot: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """History and word of every token: the place among the ``hot`` words, a negative hash for
    others, ``len(hot)`` for the start of a text."""
    code = (words | SIGN).view(np.int64)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, code), len(hot) - 1)
        code = np.where(hot[at] == code, at, code)
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = len(hot)
    return before, code


def pair_print(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h.view(np.uint64) + np.uint64(1)) * _MULT + w.view(np.uint64))


def _pair_counts(shared):
    def tally(held):
        h, w, flags = (np.concatenate(x) for x in zip(*held))
        _, first, place, n = np.unique(pair_print(h, w), return_index=True, return_inverse=True, return_counts=True)
        return _batches(h=h[first], w=w[first], n=n, in_target=np.bincount(place, flags, len(first)).astype(np.int64))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            target = batch.column("target").to_numpy(zero_copy_only=False)
            for lo, words, bounds in word_hashes(batch.column("text"), PUNCTUATION):
                flags = np.repeat(target[lo : lo + len(bounds) - 1], np.diff(bounds))
                held.append((*coded(shared.value, words, bounds), flags))
                size += len(words)
                if size >= CHUNK:
                    yield from tally(held)
                    held, size = [], 0
        if held:
            yield from tally(held)

    return run


def most_frequent(counts: DataFrame, limit: int) -> int:
    """The least count from which on there are at most ``limit`` rows; a histogram of counts comes to the driver."""
    n = F.col("n")
    wide = F.floor(F.log2(n) * 64) + EXACT_BINS
    bins = counts.groupBy(F.when(n < EXACT_BINS, n).otherwise(wide).alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"))
    least, rows = 1 << 62, 0
    for r in sorted(bins.collect(), key=lambda r: -r["least"]):
        rows += r["rows"]
        if rows > limit:
            break
        least = r["least"]
    return least


def _arrays(df: DataFrame, *names: str) -> list[np.ndarray]:
    got = df.select(*names).toArrow()
    return [got.column(c).to_numpy() for c in names]


class Totals:
    """Words of the corpus and of the target, distinct words, texts with words."""

    def __init__(self, words: int, target_words: int, vocabulary: int, texts: int, target_texts: int):
        self.words, self.target_words, self.vocabulary, self.texts, self.target_texts = words, target_words, vocabulary, texts, target_texts

    def word_loss(self, n, total: int, log=np.log):
        """``-ln P(w)`` of a word that occurs ``n`` times among ``total``."""
        return log(float(total + ADD * (self.vocabulary + 1)) / (n + ADD))


def rest_loss(kept, n, log=np.log, larger=np.maximum):
    """``-ln rest(h)`` of a history of count ``n`` whose kept bigrams have the discounted counts ``kept``."""
    return -log(1 - kept / larger(n, 1))


def pair_change(n, history, rest, word, log=np.log, exp=np.exp, larger=np.maximum):
    """What a kept bigram of count ``n`` changes in the loss ``rest + word``."""
    return -log(larger(n - DISCOUNT, 0) / larger(history, 1) + exp(-(rest + word))) - (rest + word)


def _hot_changes(shared):
    """(h, w, d_target, d_background) of kept bigrams of hot words."""

    def run(batches):
        hot = shared.value
        for batch in batches:
            h, w, n, t = (batch.column(c).to_numpy() for c in ("h", "w", "n", "in_target"))
            out = [pair_change(x, hot["count"][m][h], hot["rest"][m][h], hot["word"][m][w]) for m, x in ((0, t), (1, n))]
            arrays = [batch.column("h"), batch.column("w"), *[pa.array(x) for x in out]]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "w", "d_target", "d_background"])

    return run


def _hot_parts(shared):
    """Kept bigrams with a rarer word: what is known of the hot one, null for the rarer one."""
    names = ["h", "w", "n", "in_target", "hn", "ht", "hr_target", "hr_background", "ww_target", "ww_background"]

    def run(batches):
        hot = shared.value
        for batch in batches:
            h, w = (batch.column(c).to_numpy() for c in ("h", "w"))
            at_h, at_w = np.maximum(h, 0), np.maximum(w, 0)
            of_h = [hot["count"][1][at_h], hot["count"][0][at_h], hot["rest"][0][at_h], hot["rest"][1][at_h]]
            of_w = [hot["word"][0][at_w], hot["word"][1][at_w]]
            parts = [pa.array(x, mask=h < 0) for x in of_h] + [pa.array(x, mask=w < 0) for x in of_w]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:4]], *parts], names=names)

    return run


def _prints(batches):
    for batch in batches:
        h, w = (batch.column(c).to_numpy() for c in ("h", "w"))
        yield pa.RecordBatch.from_arrays([pa.array(pair_print(h, w).view(np.int64))], names=["fp"])


READ = "r long, n long, target double, background double, last boolean, h long, w long"


def _read(shared, kind: pa.DataType):
    """A row per document with what the hot words and bigrams add, and one per rarer word and bigram to be joined."""

    def rows(r, h, w, last=None, **own):
        n = len(r)
        nothing = {"doc_id": pa.nulls(n, kind), "n": pa.nulls(n, pa.int64()), "target": pa.nulls(n, pa.float64()), "background": pa.nulls(n, pa.float64())}
        cols = {"doc_id": None, "r": pa.array(r), "n": None, "target": None, "background": None}
        cols |= nothing | {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in own.items()}
        cols |= {"last": pa.array(np.zeros(n, bool) if last is None else last), "h": pa.array(h), "w": pa.array(w)}
        order = ["doc_id", "r", "n", "target", "background", "last", "h", "w"]
        return pa.RecordBatch.from_arrays([cols[c] for c in order], names=order)

    def run(batches):
        hot = shared.value
        width = len(hot["words"]) + 1
        for batch in batches:
            number = batch.column("r").to_numpy()
            n, loss = np.zeros(batch.num_rows, np.int64), np.zeros((2, batch.num_rows))
            for lo, words, bounds in word_hashes(batch.column("text"), PUNCTUATION):
                size = np.diff(bounds)
                n[lo : lo + len(size)] = size
                if not len(words):
                    continue
                h, w = coded(hot["words"], words, bounds)
                doc = np.repeat(np.arange(lo, lo + len(size)), size)
                hot_h, hot_w = h >= 0, w >= 0
                parts = [np.where(hot_h, hot["rest"][m][np.maximum(h, 0)], 0) + np.where(hot_w, hot["word"][m][np.maximum(w, 0)], 0) for m in (0, 1)]
                pair = h * width + w
                at = np.minimum(np.searchsorted(hot["pairs"], pair), max(0, len(hot["pairs"]) - 1))
                known = hot_h & hot_w & (hot["pairs"][at] == pair) if len(hot["pairs"]) else np.zeros(len(h), bool)
                for m in (0, 1):
                    parts[m][known] += hot["change"][m][at[known]]
                    loss[m] += np.bincount(doc, parts[m], batch.num_rows)
                rare = np.flatnonzero(~hot_w)
                if len(rare):
                    is_last = np.zeros(len(w), bool)
                    is_last[bounds[1:][size > 0] - 1] = True
                    yield rows(number[doc[rare]], w[rare], np.full(len(rare), WORD_ROW, np.int64), is_last[rare])
                open_ = np.flatnonzero(~known)
                open_ = open_[passes(hot["filter"], pair_print(h[open_], w[open_]))]
                if len(open_):
                    yield rows(number[doc[open_]], h[open_], w[open_])
            # a key of its own that no bigram has, so that these rows spread over the join
            spread = mix(number.view(np.uint64)).view(np.int64)
            own = dict(doc_id=batch.column("doc_id"), n=n, target=loss[0], background=loss[1])
            yield rows(number, spread, np.full(len(n), OWN_ROW, np.int64), **own)

    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cross_entropy_difference(
    docs: DataFrame,
    target_ids: DataFrame,
    min_pair: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, loss_target, loss_background, score.

    ``target_ids`` has one column, the ids of the target documents.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kind = docs.schema[doc_id].dataType
    ids = cut(target_ids.toDF("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(True)))
    d = (
        plain_names(docs, doc_id=doc_id, text=text)
        .join(small_side(ids, 1_000_000), "doc_id", "left")
        .select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    )
    summed = [F.sum("n").alias("n"), F.sum("in_target").alias("in_target")]
    words = _stored(d.mapInArrow(_word_counts, "code long, n long, in_target long").groupBy("code").agg(*summed), "lm_words")
    n = words.agg(F.sum("n"), F.sum("in_target"), F.count(F.lit(1))).first()
    if not n[2]:
        nothing = [F.lit(None).cast("double").alias(c) for c in ("loss_target", "loss_background", "score")]
        return d.select("doc_id", F.lit(0).cast("long").alias("n_words"), *nothing)
    texts = d.where(F.col("text").rlike("[0-9A-Za-z]|[^\\x00-\\x7F]")).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("target").cast("long")), F.lit(0))
    ).first()
    totals = Totals(*n, *texts)

    # the most frequent words, by hash
    least = most_frequent(words, HOT_WORDS)
    code, count, in_target = _arrays(words.where(F.col("n") >= least), "code", "n", "in_target")
    order = np.argsort(code)
    code, counts = code[order], [np.append(in_target[order], totals.target_texts), np.append(count[order], totals.texts)]
    pairs = d.mapInArrow(_pair_counts(spark.sparkContext.broadcast(code)), "h long, w long, n long, in_target long")
    pairs = _stored(pairs.groupBy("h", "w").agg(*summed).where(F.col("n") >= min_pair), "lm_pairs")

    def discounted(c: str) -> Column:
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))

    kept = pairs.groupBy("h").agg(F.sum(discounted("n")).alias("kept"), F.sum(discounted("in_target")).alias("kept_target"))
    at, k, kt = _arrays(kept.where("h >= 0"), "h", "kept", "kept_target")
    rest = []
    for m, values in ((0, kt), (1, k)):
        full = np.zeros(len(code) + 1)
        full[at] = values
        rest.append(rest_loss(full, counts[m]))
    single = [totals.word_loss(counts[m][:-1], total) for m, total in ((0, totals.target_words), (1, totals.words))]
    hot = {"count": counts, "rest": rest, "word": [np.append(x, 0.0) for x in single]}
    stats = spark.sparkContext.broadcast(hot)

    # rarer words: one row each
    rarer = words.where(F.col("n") < least).join(kept.where("h < 0").withColumnRenamed("h", "code"), "code", "left").na.fill(0.0, ["kept", "kept_target"])
    model = (("target", "in_target", "kept_target", totals.target_words), ("background", "n", "kept", totals.words))
    rarer = _stored(
        rarer.select(
            "code", "n", "in_target",
            *[rest_loss(F.col(kc), F.col(c), F.log, lambda x, y: F.greatest(x, F.lit(y))).alias(f"rest_{name}") for name, c, kc, _ in model],
            *[totals.word_loss(F.col(c), total, lambda x: F.log(x)).alias(f"word_{name}") for name, c, _, total in model],
        ),
        "lm_rarer",
    )

    # bigrams of hot words, the most frequent of them broadcast
    of_hot = pairs.where("h >= 0 and w >= 0")
    least_pair = most_frequent(of_hot, HOT_PAIRS)

    def with_changes(df: DataFrame) -> DataFrame:
        return df.mapInArrow(_hot_changes(stats), "h long, w long, d_target double, d_background double")

    ph, pw, dt, db = _arrays(with_changes(of_hot.where(F.col("n") >= least_pair)), "h", "w", "d_target", "d_background")
    packed = ph * (len(code) + 1) + pw
    order = np.argsort(packed)

    # bigrams with a rarer word: its parts by join, on keys of their own where the side is hot
    parts = "h long, w long, n long, in_target long, hn long, ht long, hr_target double, hr_background double, ww_target double, ww_background double"
    mixed = pairs.where("h < 0 or w < 0").mapInArrow(_hot_parts(stats), parts)
    away = F.bitwise_not(F.abs(F.xxhash64("h", "w") % (1 << 40)))
    as_h = rarer.select(F.col("code").alias("hk"), F.col("n").alias("h_n"), F.col("in_target").alias("h_t"), F.col("rest_target").alias("h_rt"), F.col("rest_background").alias("h_rb"))
    as_w = rarer.select(F.col("code").alias("wk"), F.col("word_target").alias("w_t"), F.col("word_background").alias("w_b"))
    mixed = (
        mixed.withColumn("hk", F.when(F.col("h") < 0, F.col("h")).otherwise(away))
        .withColumn("wk", F.when(F.col("w") < 0, F.col("w")).otherwise(away))
        .join(as_h, "hk", "left")
        .join(as_w, "wk", "left")
    )

    def larger(x, y):
        return F.greatest(x, F.lit(float(y)))

    changes = [
        pair_change(F.col(c).cast("double"), F.coalesce(known, joined).cast("double"), F.coalesce(*r), F.coalesce(*w), F.log, F.exp, larger).alias(name)
        for name, c, known, joined, r, w in (
            ("d_target", "in_target", F.col("ht"), F.col("h_t"), ("hr_target", "h_rt"), ("ww_target", "w_t")),
            ("d_background", "n", F.col("hn"), F.col("h_n"), ("hr_background", "h_rb"), ("ww_background", "w_b")),
        )
    ]
    changed = _stored(
        with_changes(of_hot.where(F.col("n") < least_pair)).unionByName(mixed.select("h", "w", *changes)), "lm_changes"
    )
    zero = F.lit(0.0)
    looked_up = changed.select("h", "w", "d_target", "d_background", zero.alias("rt"), zero.alias("rb")).unionByName(
        rarer.select(
            F.col("code").alias("h"), F.lit(WORD_ROW).cast("long").alias("w"),
            (F.col("rest_target") + F.col("word_target")).alias("d_target"), (F.col("rest_background") + F.col("word_background")).alias("d_background"),
            F.col("rest_target").alias("rt"), F.col("rest_background").alias("rb"),
        )
    )
    hot |= {
        "words": code, "pairs": packed[order], "change": [dt[order], db[order]],
        "filter": fingerprint_filter(changed.select("h", "w").mapInArrow(_prints, "fp long")),
    }
    shared = spark.sparkContext.broadcast(hot)
    # numbered as they are scanned, which a repeated task does alike
    numbered = plain_names(docs, doc_id=doc_id, text=text).withColumn("r", F.monotonically_increasing_id())
    read = numbered.mapInArrow(_read(shared, _arrow(kind)), f"doc_id {kind.simpleString()}, {READ}")
    found = read.join(looked_up, ["h", "w"], "left")

    def part(own: str, change: str, spare: str) -> Column:
        # the last word of a text is no history
        joined = F.coalesce(F.col(change), zero) - F.when(F.col("last"), F.coalesce(F.col(spare), zero)).otherwise(zero)
        return F.sum(F.coalesce(F.col(own), zero) + joined)

    per_row = found.groupBy("r").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.sum("n").alias("n_words"),
        part("target", "d_target", "rt").alias("t"),
        part("background", "d_background", "rb").alias("b"),
    )
    some = F.nullif(F.col("n_words"), F.lit(0))
    return per_row.select(
        "doc_id", "n_words", (F.col("t") / some).alias("loss_target"), (F.col("b") / some).alias("loss_background"),
        ((F.col("t") - F.col("b")) / some).alias("score"),
    )


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op6_cross_entropy_difference(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = cross_entropy_difference(docs, good)
    return scored.select("doc_id", "n_words", *[F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")])


ORACLE = """
with t as (
  select doc_id, doc_id in (select doc_id from labels where quality = 1) as target,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\\x00-\\x7F])+') as w
  from documents),
u as (select doc_id, target, generate_subscripts(w, 1) as i, unnest(w) as x from t),
total as (select count(*) as n, count(*) filter (where target) as nt, count(distinct doc_id) as d, count(distinct doc_id) filter (where target) as dt,
                 count(distinct x) as v from u),
p as (select *, coalesce(lag(x) over (partition by doc_id order by i), '^') as h from u),
kept as (select h, x, count(*) as n, count(*) filter (where target) as nt from p group by h, x having count(*) >= 2),
one as (select x, count(*) as n, count(*) filter (where target) as nt from u group by x
        union all select '^', d, dt from total),
share as (select kept.h, kept.x, greatest(kept.n - 0.75, 0) / greatest(one.n, 1) as s, greatest(kept.nt - 0.75, 0) / greatest(one.nt, 1) as st
          from kept join one on one.x = kept.h),
rest as (select h, 1 - sum(s) as r, 1 - sum(st) as rt from share group by h),
prob as (
  select p.doc_id,
         -ln(coalesce(s, 0) + coalesce(r, 1) * (o.n + 0.5) / (total.n + 0.5 * (v + 1))) as b,
         -ln(coalesce(st, 0) + coalesce(rt, 1) * (o.nt + 0.5) / (total.nt + 0.5 * (v + 1))) as a
  from p join one o on o.x = p.x left join share on share.h = p.h and share.x = p.x left join rest on rest.h = p.h, total),
loss as (select doc_id, avg(a) as a, avg(b) as b from prob group by doc_id)
select t.doc_id, coalesce(len(w), 0)::bigint as n_words, round(a, 6) as loss_target, round(b, 6) as loss_background, round(a - b, 6) as score
from t left join loss using (doc_id)
"""
