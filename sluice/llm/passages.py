"""Repeated passages by a sparse suffix array.

A suffix of a text is kept only where its first ``anchor`` words are the
minimum, by hash, among all starts of a stretch: the stretch is such that any
passage of ``least`` words holds at least one kept start, and the same one
wherever the passage stands.  Kept suffixes whose first words occur only once
are left out.  The others are sorted by content, word by word (8 bits of each
word's hash): once by first words, the words that follow and the words before,
once with the words before ahead of those that follow, so that texts that agree
on either side of a suffix stand together.  A sort is a range partitioning by the whole
key, which ends with text and place, so even a passage that a third of all
texts share is dealt over many tasks.

Neighbours in that order that agree on their first words are compared: both
texts are aligned at the shared suffix, and the match is extended to the left
and to the right word by word.  Every run of at least ``least`` equal words is
reported in both texts.  Equal texts take part once, and are repeats of each
other as a whole.  Neighbours are compared, not all pairs: where many texts
share a somewhat shorter passage, two of them that agree on a few words more can
be kept apart by others and missed.  All reported passages are exact.

Defined results: null and empty texts, and texts shorter than ``least`` words,
hold no passage; rows with a null id or a null text are not reported; rows that
repeat a text under one id are one document, under several ids they are copies;
a passage that repeats only within one text is no repeat across documents; an
empty table gives an empty result; extra input columns are ignored; texts of any
length are read whole.  Places are
word numbers from 0, ends exclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, cut, plain_names, small_side, table
from sluice.llm.words import block_hashes, word_hashes

#: A kept suffix: hash of its first words, codes of the words after and (backwards) before these, text and place.
SUFFIX = "h long, after binary, before binary, t long, pos long"


def kept_starts(hashes: np.ndarray, stretch: int) -> np.ndarray:
    """Places that hold the minimum of some ``stretch`` neighbouring hashes; the leftmost of equal ones."""
    if len(hashes) < stretch:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, stretch)
    at = np.unique(np.arange(len(views)) + views.argmin(axis=1))
    # a text that goes on repeating itself keeps one start per stretch, and the last
    again = np.r_[False, (hashes[at[1:]] == hashes[at[:-1]]) & (np.diff(at) < stretch)]
    head = at[np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))]
    nth = (at - head) // stretch
    return at[~again | np.r_[True, nth[1:] != nth[:-1]] | ~np.r_[again[1:], False]]


def _binary(rows: np.ndarray) -> pa.Array:
    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])
    return flat.cast(pa.binary())


def _places(anchor: int, least: int):
    """Hash of the first words, text and place of every kept suffix."""

    def run(batches):
        for batch in batches:
            t = batch.column("t").to_numpy()
            for lo, words, bounds in word_hashes(batch.column("text")):
                out = []
                for i in range(len(bounds) - 1):
                    w = words[bounds[i] : bounds[i + 1]]
                    if len(w) >= least:
                        h = block_hashes(w, anchor)
                        at = kept_starts(h, least - anchor + 1)
                        out.append((h[at].view(np.int64), np.full(len(at), t[lo + i]), at))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["h", "t", "pos"])

    return run


def _suffixes(anchor: int, least: int):
    """Every kept suffix as a sort key with its context."""
    reach = least - anchor  # as far as a passage can go on either side of its kept start

    def run(batches):
        for batch in batches:
            t = batch.column("t").to_numpy()
            for lo, words, bounds in word_hashes(batch.column("text")):
                out = []
                for i in range(len(bounds) - 1):
                    w = words[bounds[i] : bounds[i + 1]]
                    if len(w) < least:
                        continue
                    h = block_hashes(w, anchor)
                    at = kept_starts(h, reach + 1)
                    codes = np.zeros(len(w) + 2 * reach, dtype=np.uint8)
                    codes[reach:-reach] = w & np.uint64(255)
                    around = np.lib.stride_tricks.sliding_window_view(codes, reach)
                    out.append((h[at].view(np.int64), around[at + reach + anchor], around[at][:, ::-1], np.full(len(at), t[lo + i]), at))
                if out:
                    h, after, before, text, pos = (np.concatenate(x) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), _binary(after), _binary(before), pa.array(text), pa.array(pos)], names=["h", "after", "before", "t", "pos"]
                    )

    return run


def _neighbours(batches):
    """Suffixes and the nearest ones of other texts before and after, as far as their first words agree.

    The ends of the partition are passed on as they are.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first = last = other = None  # the last row, and the last one of another text before it
    for batch in batches:
        if not batch.num_rows:
            continue
        h, t, pos = (batch.column(c).to_numpy() for c in ("h", "t", "pos"))
        if first is None:
            first = (h[0], t[0], pos[0])
        if last is not None:
            lead = [x for x in (other, last) if x is not None]
            h, t, pos = (np.r_[[x[i] for x in lead], v] for i, v in enumerate((h, t, pos)))
        head = np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]
        start = np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))
        end = np.r_[np.flatnonzero(head)[1:], len(h)][np.cumsum(head) - 1]
        here = np.arange(len(h))
        pairs = []
        for there, ok in ((start - 1, start > 0), (end, end < len(h))):
            x, y = here[ok], there[ok]
            x, y = x[h[x] == h[y]], y[h[x] == h[y]]
            pairs.append((x, y))
        x, y = (np.concatenate(p) for p in zip(*pairs))
        yield _rows(t[x], pos[x], t[y], pos[y], np.zeros(len(x), np.int64), np.full(len(x), -1))
        last = (h[-1], t[-1], pos[-1])
        s = start[-1]
        other = (h[s - 1], t[s - 1], pos[s - 1]) if s > 0 else None
    if first is not None:
        ends = np.array([first, last], dtype=np.int64)
        yield _rows(ends[:, 1], ends[:, 2], ends[:, 1], ends[:, 2], ends[:, 0], np.array([2 * part, 2 * part + 1]))


def _rows(a, pa_, b, pb, h, end):
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, pa_, b, pb, h, end)], names=["a", "pos_a", "b", "pos_b", "h", "end"])


def equal_runs(x: np.ndarray, y: np.ndarray, shift: int, least: int) -> list[tuple[int, int]]:
    """(start, end) in x of the runs of at least ``least`` words with x[i] == y[i + shift]."""
    lo, hi = max(0, -shift), min(len(x), len(y) - shift)
    if hi - lo < least:
        return []
    edge = np.diff(np.r_[0, (x[lo:hi] == y[lo + shift : hi + shift]).astype(np.int8), 0])
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= least
    return [(int(s) + lo, int(e) + lo) for s, e in zip(starts[long], ends[long])]


def _extend(least: int):
    def run(batches):
        cache: dict[int, np.ndarray] = {}

        def words_of(ids: list[int], texts: pa.Array) -> list[np.ndarray]:
            new = [i for i, x in enumerate(ids) if x not in cache]
            for lo, words, bounds in word_hashes(texts.take(pa.array(new, pa.int64()))):
                for i in range(len(bounds) - 1):
                    cache[ids[new[lo + i]]] = words[bounds[i] : bounds[i + 1]]
            return [cache[x] for x in ids]

        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                left = words_of(part.column("a").to_pylist(), part.column("text_a"))
                right = words_of(part.column("b").to_pylist(), part.column("text_b"))
                out = []
                for a, b, x, y, shifts in zip(
                    part.column("a").to_pylist(), part.column("b").to_pylist(), left, right, part.column("shifts").to_pylist()
                ):
                    for shift in shifts:
                        for s, e in equal_runs(x, y, shift, least):
                            out += [(a, s, e), (b, s + shift, e + shift)]
                if out:
                    t, s, e = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (t, s, e)], names=["t", "start", "end"])
                if len(cache) > 512:
                    cache.clear()

    return run


def _lengths(batches):
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        for lo, _, bounds in word_hashes(batch.column("text")):
            n[lo : lo + len(bounds) - 1] = np.diff(bounds)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(n)], names=["doc_id", "t", "n_words"])


def _neighbour_pairs(suffixes: DataFrame, columns: list[str]) -> DataFrame:
    """(a, pos_a, b, pos_b) of suffixes of different texts that are next to each other in the given order."""
    order = [F.col(c) for c in columns]
    found = cut(
        suffixes.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_neighbours, "a long, pos_a long, b long, pos_b long, h long, end long")
    )
    # two rows per partition: where one ends and the next begins
    seam = W.orderBy("end")
    seams = (
        found.where("end >= 0")
        .select("h", "a", "pos_a", F.lead("h").over(seam).alias("h2"), F.lead("a").over(seam).alias("b"), F.lead("pos_a").over(seam).alias("pos_b"), "end")
        .where("end % 2 = 1 and h = h2 and a != b")
    )
    return found.where("end < 0").select("a", "pos_a", "b", "pos_b").unionByName(seams.select("a", "pos_a", "b", "pos_b"))


def repeated_passages(docs: DataFrame, least: int = 50, anchor: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and repeated passage: doc_id, start, end, n_words (of the document).

    Passages of a document that touch or overlap are one row.
    """
    bound_batches(docs.sparkSession)
    d = plain_names(docs, doc_id=doc_id, text=text).where("doc_id is not null and text is not null")
    d = d.withColumn("t", F.xxhash64("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    sizes = cut(d.mapInArrow(_lengths, f"doc_id {kind}, t long, n_words long").distinct())
    copies = sizes.groupBy("t").agg(F.count(F.lit(1)).alias("copies"), F.first("n_words").alias("n_words"))
    whole = d.select("t", "text")
    # first find which first words stand in several texts, then read the texts again for the context of those
    # suffixes: the far larger table of all suffixes is never stored
    places = whole.mapInArrow(_places(anchor, least), "h long, t long, pos long")
    shared = places.groupBy("h").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo != hi").select("h")
    kept = whole.mapInArrow(_suffixes(anchor, least), SUFFIX)
    suffixes = cut(kept.join(small_side(cut(shared), 1_000_000), "h", "left_semi").dropDuplicates(["t", "pos"]))
    pairs = _neighbour_pairs(suffixes, ["h", "after", "before", "t", "pos"]).unionByName(
        _neighbour_pairs(suffixes, ["h", "before", "after", "t", "pos"])
    )
    turned = F.col("a") > F.col("b")
    shift = F.when(turned, F.col("pos_a") - F.col("pos_b")).otherwise(F.col("pos_b") - F.col("pos_a"))
    # texts are aligned once per distance between shared suffixes
    aligned = cut(
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), shift.alias("shift"))
        .distinct()
        .groupBy("a", "b")
        .agg(F.collect_list("shift").alias("shifts"))
    )
    wanted = cut(aligned.select(F.col("a").alias("t")).union(aligned.select("b")).distinct())
    texts = cut(d.select("t", "text").join(small_side(wanted, 1_000_000), "t").groupBy("t").agg(F.first("text").alias("text")))
    runs = (
        aligned.join(texts.toDF("a", "text_a"), "a")
        .join(texts.toDF("b", "text_b"), "b")
        .mapInArrow(_extend(least), "t long, start long, end long")
        .distinct()
    )
    equal = copies.where(F.col("copies") > 1).where(F.col("n_words") >= least).select("t", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))
    every = cut(runs.unionByName(equal))
    # overlapping runs of a text become one
    per_text = W.partitionBy("t").orderBy("start", "end")
    ahead = F.max("end").over(per_text.rowsBetween(W.unboundedPreceding, -1))
    opens = every.withColumn("new", F.coalesce((F.col("start") > ahead).cast("int"), F.lit(1)))
    merged = (
        opens.withColumn("nth", F.sum("new").over(per_text))
        .groupBy("t", "nth")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    return sizes.join(merged, "t").select("doc_id", "start", "end", "n_words")


def op5_repeated_passages(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = """
with t as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents where doc_id is not null and text is not null),
s as (
  select doc_id, len(w) as n_words, generate_subscripts(w, 1) as i, w from t where len(w) >= 50),
p as (select doc_id, n_words, i - 1 as i, md5(array_to_string(w[i:i+49], ' ')) as x from s where i + 49 <= n_words),
r as (select x from p group by x having count(distinct doc_id) > 1),
c as (select doc_id, n_words, i from p where x in (select x from r)),
o as (select *, coalesce((i > lag(i) over (partition by doc_id order by i) + 50)::int, 1) as opens from c),
g as (select *, sum(opens) over (partition by doc_id order by i rows unbounded preceding) as nth from o)
select doc_id, min(i)::bigint as start, (max(i) + 50)::bigint as "end", any_value(n_words)::bigint as n_words from g group by doc_id, nth
"""
