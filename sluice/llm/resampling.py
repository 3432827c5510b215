"""Resampling a corpus towards a target distribution.

Features (runs of 1 to ``max_n`` words) are hashed into buckets.  A bucket's
gain is the scaled log of how much likelier its features are in the target
texts than in the corpus; a document's weight is the sum of its features'
gains.  Weight plus a Gumbel number of the id is the score, and the documents
with the highest scores are a sample without replacement in proportion to the
exponential of the weights.

Features are counted by batch concatenation: a batch's texts are joined with a
byte between them that UTF-8 never has, one regex pass finds all words, the
words' places among the documents' offsets (searchsorted) tell which n-grams
cross from one document into the next, and the rest goes into one bincount.
Long texts are read in slices that repeat the last words of the slice before.

The draw sorts only what can be drawn: the scores' histogram gives the bin in
which the draw ends, rows above and in that bin are range-sorted, and a row's
rank is its place in its sorted part plus the sizes of the parts before.

Defined results: a null text has no words; null ids are hashed as the empty id
and rank after all others where scores tie; rows that repeat are drawn each on
its own, in any order among themselves; an empty corpus gives an empty result;
without any target text all gains compare with the uniform distribution; extra
input columns are ignored; a text of any length is read whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, cut, plain_names, table
from sluice.llm.words import buffers, row_slices

#: Joins the texts of a batch: no byte of UTF-8.
SENTINEL = b"\xff"
WORDS = re.compile(rb"[0-9a-z\x80-\xfe]+")
LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))
SLICE_BYTES = 1 << 20
#: Bins of the histogram of scores; it comes to the driver.
SCORE_BINS = 4096
#: Bits of a row's place within its part in ``monotonically_increasing_id``.
PLACE_BITS = 33


def _long_text(text: bytes, keep: int) -> Iterator[tuple[bytes, int]]:
    """Slices of a long text that end between words, and how many words each repeats of the one before."""
    at, tail = 0, []
    while at < len(text):
        end = at + SLICE_BYTES
        cut_word = end < len(text) and WORDS.match(text, end - 1, end) and WORDS.match(text, end)
        if cut_word:
            end = cut_word.end()
        own = text[at:end]
        yield b" ".join([*tail, own]), len(tail)
        if keep:
            tail = (tail + WORDS.findall(own))[-keep:]
        at = end


def _joined(column: pa.Array, keep: int) -> Iterator[tuple[int, list[bytes], int]]:
    """Per slice: the first row, the lower-cased texts, and the words that were counted before (long texts)."""
    offsets, data = buffers(column)
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        texts = [data[offsets[i] : offsets[i + 1]].tobytes().translate(LOWER) for i in range(lo, hi)]
        if hi == lo + 1 and len(texts[0]) > SLICE_BYTES:
            for part, old in _long_text(texts[0], keep):
                yield lo, [part], old
        else:
            yield lo, texts, 0


def features(column: pa.Array, max_n: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice and n: first row, n, each n-gram's row within the slice, its bucket, and the words per row (for n = 1)."""
    for first, texts, old in _joined(column, max_n - 1):
        found = list(WORDS.finditer(SENTINEL.join(texts)))
        ends = np.cumsum([len(t) + 1 for t in texts])
        row = np.searchsorted(ends, np.fromiter((m.start() for m in found), np.int64, len(found)), side="right")
        words = [m.group() for m in found]
        crc: list[int] = []
        for n in range(1, max_n + 1):
            if n == 1:
                crc = list(map(zlib.crc32, words))
                spaced = [b" " + w for w in words] if max_n > 1 else []
            else:
                crc = list(map(zlib.crc32, spaced[n - 1 :], crc))
            if not crc:
                break
            code = np.array(crc, dtype=np.int64) % buckets
            whole = row[: len(code)] == row[n - 1 :]
            # an n-gram of repeated words only has been counted with the slice before
            whole[: max(0, old - n + 1)] = False
            yield first, n, row[: len(code)][whole], code[whole], len(texts)


def _bucket_counts(max_n: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, code, _ in features(batch.column("text"), max_n, buckets):
                total += np.bincount(code, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def _weights(shared, max_n: int, buckets: int):
    def run(batches):
        gain = shared.value
        for batch in batches:
            words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, n, row, code, rows in features(batch.column("text"), max_n, buckets):
                count = np.bincount(row, minlength=rows)
                if n == 1:
                    words[first : first + rows] += count
                n_features[first : first + rows] += count
                # whole numbers far below 2 ** 53: the sum of doubles is exact
                weight[first : first + rows] += np.bincount(row, gain[code], minlength=rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(n_features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def bucket_counts(texts: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(bucket, n) over the column ``text``: one row per task and bucket is shuffled, at most ``buckets`` come out."""
    counted = texts.select("text").mapInArrow(_bucket_counts(max_n, buckets), "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket from the two tables of counts."""
    both = (
        corpus.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full").na.fill(0).toPandas()
    )
    s, t = (np.zeros(buckets, np.float64) for _ in range(2))
    s[both.bucket], t[both.bucket] = both.s, both.t
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))))


def scored(
    docs: DataFrame,
    target: DataFrame,
    max_n: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""
    spark = docs.sparkSession
    bound_batches(spark)
    d = plain_names(docs, doc_id=doc_id, text=text)
    gains = bucket_gains(bucket_counts(d, max_n, buckets), bucket_counts(plain_names(target, text=target_text), max_n, buckets), buckets)
    kind = docs.schema[doc_id].dataType.simpleString()
    weighed = d.mapInArrow(
        _weights(spark.sparkContext.broadcast(gains), max_n, buckets),
        f"doc_id {kind}, n_words long, n_features long, weight long",
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = -1000 * F.log(-F.log((h + 0.5) / 4294967296.0))
    return weighed.withColumn("score", F.col("weight") + F.floor(gumbel))


def ranked(scores: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scores`` with rank, from 1, of the ``floor(percent * n / 100)`` highest of the n rows with enough words."""
    s = cut(scores).withColumn("row", F.monotonically_increasing_id())
    able = F.col("n_words") >= min_words
    n, low, high = s.where(able).agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    draw = percent * n // 100
    none = F.lit(None).cast("long")
    if not draw:
        return s.drop("row").withColumn("rank", none)
    width = (high - low) // SCORE_BINS + 1
    bins = s.where(able).groupBy(F.floor((F.lit(high) - F.col("score")) / width).alias("bin")).count().collect()
    left, floor_score = draw, low
    for b in sorted(bins, key=lambda b: b["bin"]):
        left -= b["count"]
        if left <= 0:
            floor_score = high - (b["bin"] + 1) * width + 1
            break
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    top = able & (F.col("score") >= floor_score)
    # the row number among the keys lets the ranges cut through rows that tie
    parts = cut(s.where(top).repartitionByRange(*order).sortWithinPartitions(*order).drop("row"))
    place = F.monotonically_increasing_id()
    placed = parts.withColumns(
        {"__part": F.shiftright(place, PLACE_BITS), "__place": place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}
    )
    # one number per part of the sort
    sizes = {r["__part"]: r["n"] for r in placed.groupBy("__part").agg((F.max("__place") + 1).alias("n")).collect()}
    before, rows = 0, []
    for part in sorted(sizes):
        rows.append((part, before))
        before += sizes[part]
    starts = scores.sparkSession.createDataFrame(rows, "__part long, __before long")
    rank = F.col("__before") + F.col("__place") + 1
    drawn = placed.join(F.broadcast(starts), "__part").withColumn("rank", F.when(rank <= draw, rank))
    rest = s.where(~F.coalesce(top, F.lit(False))).withColumn("rank", none)
    names = [*scores.columns, "rank"]
    return drawn.select(names).unionByName(rest.select(names))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score and rank (null for rows that are not drawn).

    ``options`` are those of ``scored``.  ``target`` holds the target texts.
    """
    return ranked(scored(docs, target, **options), percent, min_words)


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = """
with recursive steps(i, k, c) as (
  select i, 0, i::bigint from range(256) t(i)
  union all
  select i, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end from steps where k < 8),
crc as (select list(c order by i) as t from steps where k = 8),
texts as (
  select true as corpus, row_number() over () as r, doc_id, text from documents
  union all
  select false, 0, null, text from benchmark),
w as (
  select corpus, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as x
  from texts),
u as (select corpus, r, x, count(*) as c from w group by all),
v as (select x, list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda y: ('0x' || y)::bigint) as b from (select distinct x from u)),
k as (select x, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda a, y: xor(a >> 8, crc.t[xor(a & 255, y) + 1])), 4294967295::bigint) % 10000 as bucket
      from v, crc),
n as (select bucket, coalesce(sum(c) filter (where corpus), 0)::double as s, coalesce(sum(c) filter (where not corpus), 0)::double as t
      from u join k using (x) group by bucket),
g as (select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from n) + 10000) / ((s + 1) * ((select sum(t) from n) + 10000))))::bigint as gain from n),
f as (select r, sum(c)::bigint as n_features, sum(c * gain)::bigint as weight from u join k using (x) join g using (bucket) where corpus group by r),
d as (select doc_id, r, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
             ('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double as h
      from texts left join f using (r) where corpus),
e as (select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::double)))::bigint as score from d),
o as (select r, row_number() over (order by score desc, doc_id nulls last) as place, count(*) over () as n from e where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from e left join o using (r)
"""
