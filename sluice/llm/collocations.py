"""Frequent phrases and their association scores, per language.

A text is split at punctuation and line ends into pieces and those into words;
a phrase is a run of 2 to ``max_words`` words within a piece.  A phrase's score
compares its count with what its two parts would give by chance, at the cut
that makes it look most like chance: ``floor(1000 * count * n / (left * right))``
with ``n`` words in the language.  A phrase that every time is part of one
longer frequent phrase is dropped.

Counting is by Rabin-Karp fingerprints.  Prefix polynomials in numpy give the
64-bit fingerprint of every n-gram of a chunk in a few array operations, each
task counts its own, and a shuffle sums them.  Lengths are counted one after
another: an n-gram can only be frequent if both n-grams one word shorter in it
are, so a length counts only n-grams whose parts pass a bit filter of the
frequent fingerprints of the length before.  The filter has a fixed size; false
hits cost shuffled rows, never a result.

Fingerprints only preselect.  In the last reading each task takes the n-grams
that pass the filter, points at the first occurrence of every fingerprint,
compares all its other occurrences with that place word by word (and the words
byte by byte), and materialises one phrase text per pointer; occurrences that
differ from it in spite of an equal fingerprint get a pointer of their own.
The texts are then summed as texts, so no collision reaches a count.  That
reading has a task per core, not per split of the input, so that a phrase is
handed on once per core as long as a task can hold all its phrases.

Defined results: null texts are empty; a null language is ``und``; rows that
repeat count each; an empty table gives an empty result; extra input columns are
ignored; words and texts may be of any length (long texts are read in slices
that repeat the last words of the slice before); scores are exact whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, cut, plain_names, small_side, table
from sluice.llm.words import _words_of, block_hashes, buffers, mix, row_slices

#: Bytes between words, and those of them that end a piece.
BREAK = np.zeros(256, dtype=bool)
BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True
#: Bytes of texts whose words are found at once.
SLICE_BYTES = 1 << 20
#: Words verified together, and fingerprints counted together, within a task.
CHUNK, COUNTED = 1 << 18, 1 << 20
#: Bits of the filter of frequent fingerprints (16 MB), and bits set per fingerprint.
FILTER_BITS, PROBES = 1 << 27, 2
#: Rows of a record batch; phrases of several chunks, and their bytes, that a task holds to sum them.
ROWS, SUMMED, SUMMED_BYTES = 1 << 17, 1 << 19, 1 << 25
#: Bytes of a held row besides its phrase.
ROW_BYTES = 32
#: Longest word that is compared in numpy, byte by byte.
SHORT_WORD = 64
#: Groups per language of the narrowing steps of a language's head.
NARROWING = (4096, 64, 1)


class Chunk(NamedTuple):
    """Words of some rows: lower-cased bytes, hashes, byte ranges, piece, row, and whether the word is counted here."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    row: np.ndarray
    new: np.ndarray


def _long_slices(text: np.ndarray, keep: int) -> Iterator[tuple[np.ndarray, int]]:
    """Slices of a long text that end between words; each begins with the last ``keep`` words of the one before."""
    at, back = 0, 0
    while at < len(text):
        end = at
        while end < len(text):
            end = min(end + SLICE_BYTES, len(text))
            gaps = np.flatnonzero(GAP[text[at:end]])
            if end < len(text) and len(gaps):
                end = at + int(gaps[-1]) + 1
                break
        part = text[at - back : end]
        yield part, back
        starts = _starts(part)
        back = len(part) - int(starts[-min(keep, len(starts))]) if len(starts) and keep else 0
        at = end


def _starts(data: np.ndarray) -> np.ndarray:
    solid = ~GAP[data]
    solid[1:] &= GAP[data[:-1]]
    return np.flatnonzero(solid)


def _slice(data: np.ndarray, bounds: np.ndarray, back: int) -> tuple[np.ndarray, ...]:
    hashes, starts, ends = _words_of(data, bounds, GAP)
    row = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(BREAK[data], dtype=np.int64)[starts] + row if len(starts) else row
    upper = (data >= 65) & (data <= 90)
    return data + upper.astype(np.uint8) * np.uint8(32), hashes, starts, ends, piece, row, starts >= back


def chunks(batches, keep: int, limit: int) -> Iterator[tuple[Chunk, list[str], np.ndarray]]:
    """Chunks of about ``limit`` words, whole slices at least, with the language and its seed of each of their rows."""
    held: list[tuple] = []
    langs: list[str] = []
    seeds: list[int] = []
    size = at = pieces = 0

    def done():
        chunk = Chunk(*[np.concatenate(x) for x in zip(*held)])
        return chunk, langs, np.array(seeds, np.int64).view(np.uint64)

    for batch in batches:
        offsets, data = buffers(batch.column("text"))
        lang, seed = batch.column("lang").to_pylist(), batch.column("seed").to_pylist()
        for lo, hi in row_slices(offsets, SLICE_BYTES):
            part = data[offsets[lo] : offsets[hi]]
            if hi == lo + 1 and len(part) > SLICE_BYTES:
                slices = ((x, np.array([0, len(x)]), back) for x, back in _long_slices(part, keep))
            else:
                slices = iter([(part, offsets[lo : hi + 1] - offsets[lo], 0)])
            for x, bounds, back in slices:
                if len(x):
                    low, hashes, starts, ends, piece, row, new = _slice(x, bounds, back)
                    if len(hashes):
                        held.append((low, hashes, starts + at, ends + at, piece + pieces, row + len(langs), new))
                        at += len(low)
                        pieces = int(held[-1][4][-1]) + 1
                        size += len(hashes)
                if size >= limit:
                    langs += lang[lo:hi]
                    seeds += seed[lo:hi]
                    yield done()
                    held, langs, seeds = [], [], []
                    size = at = pieces = 0
            else:
                # a long text that goes on after a chunk keeps its language
                langs += lang[lo:hi]
                seeds += seed[lo:hi]
    if held:
        yield done()


def fingerprints(chunk: Chunk, seeds: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of the n words from each place on, different per language and length."""
    own = mix(seeds[chunk.row] + np.uint64(n))
    grams = block_hashes(chunk.hashes, n)
    return mix(grams ^ own[: len(grams)])


def whole(chunk: Chunk, n: int) -> np.ndarray:
    """Whether the n words from each place on lie in one piece."""
    count = max(0, len(chunk.piece) - n + 1)
    return chunk.piece[:count] == chunk.piece[n - 1 : n - 1 + count]


def _probe(fps: np.ndarray, i: int, bits: int) -> np.ndarray:
    return (mix(fps + np.uint64(i)) & np.uint64(bits - 1)).astype(np.int64)


def passes(filter_bytes: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Whether each fingerprint may be in the filter."""
    ok = np.ones(len(fps), bool)
    for i in range(PROBES):
        at = _probe(fps, i, len(filter_bytes) * 8)
        ok &= (filter_bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return ok


def surviving(chunk: Chunk, seeds: np.ndarray, filter_bytes: np.ndarray, upto: int) -> list[np.ndarray]:
    """Per length 1 to ``upto``: at which places an n-gram may be frequent, given the filter and its parts."""
    out: list[np.ndarray] = []
    for n in range(1, upto + 1):
        fps = fingerprints(chunk, seeds, n)
        ok = whole(chunk, n) & passes(filter_bytes, fps)
        if out:
            ok &= out[-1][: len(ok)] & out[-1][1 : len(ok) + 1]
        out.append(ok)
    return out


def _batches(names, *arrays):
    for lo in range(0, len(arrays[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(a[lo : lo + ROWS]) for a in arrays], names=names)


def _language_words(batches):
    total: dict[str, int] = {}
    for chunk, langs, _ in chunks(batches, 0, 1):
        per_row = np.bincount(chunk.row[chunk.new], minlength=len(langs))
        for lang, n in zip(langs, per_row.tolist()):
            total[lang] = total.get(lang, 0) + n
    yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})


def _gram_counts(shared, n: int):
    """Counts of the fingerprints of length n whose parts may be frequent."""

    def counted(held):
        unique, count = np.unique(np.concatenate(held), return_counts=True)
        return _batches(["fp", "n"], unique.view(np.int64), count)

    def run(batches):
        held, size = [], 0
        for chunk, _, seeds in chunks(batches, n - 1, 1):
            fps = fingerprints(chunk, seeds, n)
            ok = whole(chunk, n) & chunk.new[n - 1 :]
            if shared is not None and len(fps):
                part = passes(shared.value, fingerprints(chunk, seeds, n - 1)) & whole(chunk, n - 1)
                ok &= part[: len(ok)] & part[1 : len(ok) + 1]
            held.append(fps[ok])
            size += len(held[-1])
            if size >= COUNTED:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)

    return run


def _exact_words(chunk: Chunk, needed: np.ndarray) -> np.ndarray:
    """A number per word that is equal for equal words only (for the ``needed`` ones)."""
    number = np.zeros(len(chunk.hashes), np.int64)
    at = np.flatnonzero(needed)
    _, first, same = np.unique(chunk.hashes[at], return_index=True, return_inverse=True)
    model = at[first[same]]
    size = chunk.ends[at] - chunk.starts[at]
    differs = size != chunk.ends[model] - chunk.starts[model]
    mine, models, on = chunk.starts[at], chunk.starts[model], np.flatnonzero(~differs)
    for k in range(SHORT_WORD):
        on = on[size[on] > k]
        if not len(on):
            break
        other = chunk.data[mine[on] + k] != chunk.data[models[on] + k]
        differs[on[other]] = True
        on = on[~other]
    for i in np.flatnonzero(~differs & (size > SHORT_WORD)):
        differs[i] = _word(chunk, at[i]) != _word(chunk, model[i])
    number[at] = same
    others: dict[bytes, int] = {}
    for i in np.flatnonzero(differs):
        number[at[i]] = others.setdefault(_word(chunk, at[i]), len(first) + len(others))
    return number


def _word(chunk: Chunk, i: int) -> bytes:
    return chunk.data[chunk.starts[i] : chunk.ends[i]].tobytes()


def pointers(number: np.ndarray, fps: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First places of the different n-grams among ``places``, and how often each occurs.

    Occurrences of one fingerprint are compared with its first place word by
    word; those that differ are told apart by their words.
    """
    _, first, same, count = np.unique(fps, return_index=True, return_inverse=True, return_counts=True)
    model = places[first[same]]
    differs = np.zeros(len(places), bool)
    for k in range(n):
        differs |= number[places + k] != number[model + k]
    if not differs.any():
        return places[first], count
    count = count - np.bincount(same[differs], minlength=len(first))
    others: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(differs):
        key = (int(same[i]), *number[places[i] : places[i] + n].tolist())
        others.setdefault(key, [int(places[i]), 0])[1] += 1
    more = np.array(list(others.values()), np.int64)
    return np.concatenate([places[first], more[:, 0]]), np.concatenate([count, more[:, 1]])


def _summed(batches) -> Iterator[pa.RecordBatch]:
    """Counts with the rows of equal phrases summed, as many as a task holds at once.

    When they are too many the rarer ones are handed on; the frequent ones, which come again most, are held on.
    """
    held: list[pa.RecordBatch] = []

    def merged() -> pa.Table:
        t = pa.Table.from_batches(held).group_by(["lang", "words", "phrase"]).aggregate([("n", "sum")])
        return t.select(["lang", "words", "phrase", "n_sum"]).rename_columns(["lang", "words", "phrase", "n"])

    size = weight = 0
    for batch in batches:
        held.append(batch)
        size, weight = size + len(batch), weight + batch.nbytes
        if size >= SUMMED or weight >= SUMMED_BYTES:
            t = merged()
            held, size, weight = t.to_batches(), len(t), t.nbytes
            if size > SUMMED // 2 or weight > SUMMED_BYTES // 2:
                t = t.take(np.argsort(-t.column("n").to_numpy(), kind="stable"))
                cost = np.cumsum(pc.binary_length(t.column("phrase")).to_numpy().astype(np.int64) + ROW_BYTES)
                keep = min(SUMMED // 2, int(np.searchsorted(cost, SUMMED_BYTES // 2)))
                yield from t.slice(keep).to_batches(ROWS)
                # a copy, so that what was handed on is freed
                t = t.take(np.arange(keep))
                held, size, weight = t.to_batches(), keep, t.nbytes
    if held:
        yield from merged().to_batches(ROWS)


def _phrase_counts(shared, max_words: int):
    """(lang, words, phrase, n): the texts of the n-grams that pass the filter, verified per chunk and counted over chunks."""

    def verified(batches):
        for chunk, langs, seeds in chunks(batches, max_words - 1, CHUNK):
            found = surviving(chunk, seeds, shared.value, max_words)
            codes: dict[str, int] = {}
            language_of = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int64)
            language, data = list(codes), chunk.data.tobytes()
            # equal words of two languages are two words
            number = _exact_words(chunk, found[0])
            number += language_of[chunk.row] * (int(number.max()) + 1)
            for n, ok in enumerate(found, 1):
                places = np.flatnonzero(ok & chunk.new[n - 1 :])
                if not len(places):
                    break
                at, count = pointers(number, fingerprints(chunk, seeds, n)[places], places, n)
                for lo in range(0, len(at), ROWS):
                    some = at[lo : lo + ROWS]
                    bounds = [zip(chunk.starts[some + k].tolist(), chunk.ends[some + k].tolist()) for k in range(n)]
                    texts = [b" ".join(w).decode() for w in zip(*[[data[a:b] for a, b in x] for x in bounds])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([language[x] for x in language_of[chunk.row[some]].tolist()], pa.string()),
                            pa.array(np.full(len(some), n, np.int32)),
                            pa.array(texts, pa.string()),
                            pa.array(count[lo : lo + ROWS]),
                        ],
                        names=["lang", "words", "phrase", "n"],
                    )

    def run(batches):
        yield from _summed(verified(batches))

    return run


def fingerprint_filter(fps: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The bit filter of the column ``fp``; what comes to the driver is bounded by its size."""

    def positions(batches):
        for batch in batches:
            got = batch.column("fp").to_numpy().view(np.uint64)
            at = np.concatenate([_probe(got, i, bits) for i in range(PROBES)])
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    words = (
        fps.mapInArrow(positions, "at long")
        .groupBy(F.shiftright("at", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def few_tasks(texts: DataFrame) -> DataFrame:
    """``texts`` in as many partitions as there are cores, at most.

    Every task hands on each phrase it meets, and a frequent one is met by
    nearly all: with tasks that grow with the input, as its phrases do, the rows
    would grow with its square.
    """
    return texts.coalesce(texts.sparkSession.sparkContext.defaultParallelism)


def phrase_counts(texts: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """(lang, words, phrase, n): all runs of 1 to ``max_words`` words that occur ``min_count`` times or more.

    ``texts`` has (lang, seed, text); the lang is not null.
    """
    spark = texts.sparkSession
    frequent, shared = None, None
    for n in range(1, max_words + 1):
        counted = texts.mapInArrow(_gram_counts(shared, n), "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))
        level = cut(counted.where(F.col("n") >= min_count).select("fp"))
        shared = spark.sparkContext.broadcast(fingerprint_filter(level))
        frequent = level if frequent is None else frequent.union(level)
    shared = spark.sparkContext.broadcast(fingerprint_filter(frequent))
    verified = few_tasks(texts).mapInArrow(_phrase_counts(shared, max_words), "lang string, words int, phrase string, n long")
    # the words are a function of the phrase
    return verified.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _exact(c: str):
    return F.col(c).cast("decimal(19,0)")


def scored_phrases(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, n, score) of every phrase of two words or more, at its lowest-scoring cut."""
    phrases = counts.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    w = F.split("phrase", " ")
    cuts = (
        phrases.withColumns({"w": w, "k": F.explode(F.sequence(F.lit(1), F.col("words") - 1))})
        .withColumns({"left": F.array_join(F.expr("slice(w, 1, k)"), " "), "right": F.array_join(F.expr("slice(w, k + 1, words - k)"), " ")})
        .drop("w")
    )
    part = counts.select("lang", "phrase", "n")
    both = cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
    n = small_side(totals.toDF("lang", "n"))
    # 1000 * a * n and l * r may pass 64 bits
    top = (F.lit(1000).cast("decimal(4,0)") * _exact("a")).cast("decimal(19,0)") * _exact("n")
    score = F.call_function("div", top.cast("decimal(38,0)"), (_exact("l") * _exact("r")).cast("decimal(38,0)"))
    at_cut = both.join(n, "lang").withColumn("score", score)
    return (
        at_cut.groupBy("lang", "words", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select("lang", "words", "phrase", "a", "low.l", "low.r", "n", "low.score")
    )


def without_parts(phrases: DataFrame, percent: int) -> DataFrame:
    """``phrases`` without those inside a longer one that occurs ``percent`` of 100 times as often, or more."""
    inner = (
        phrases.where("words > 2")
        .select("lang", "words", F.col("a").alias("longer"), F.split("phrase", " ").alias("w"))
        .withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("at", F.explode(F.expr("sequence(1, words - size + 1)")))
        .select("lang", F.array_join(F.expr("slice(w, at, size)"), " ").alias("phrase"), "longer")
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    covered = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * percent
    return phrases.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")


def head(phrases: DataFrame, first: int) -> DataFrame:
    """The ``first`` of each language with their rank, by steps that keep the head of ever larger groups."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for groups in NARROWING:
        own = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
        phrases = phrases.withColumn("rank", F.row_number().over(own).cast("long")).where(F.col("rank") <= first)
    return phrases


def collocations(
    docs: DataFrame,
    max_words: int = 5,
    min_count: int = 100,
    percent: int = 100,
    first: int = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Per language its ``first`` phrases: lang, rank, phrase, a (its count), l, r (its parts' counts), n, score."""
    bound_batches(docs.sparkSession)
    t = plain_names(docs, lang=lang, text=text).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text"
    )
    t = t.select("lang", F.xxhash64("lang").alias("seed"), "text")
    # one row per language
    totals = cut(t.mapInArrow(_language_words, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")))
    counts = cut(phrase_counts(t, max_words, min_count))
    kept = without_parts(scored_phrases(counts, totals), percent)
    return head(kept, first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE = """
with d as (select row_number() over () as doc, coalesce(lang, 'und') as lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
           from documents),
p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
total as (select lang, sum(len(w))::bigint as n from w group by lang),
g as (select lang, k as words, array_to_string(w[i : i + k - 1], ' ') as phrase
      from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, range(1, 6) t(k))),
f as (select lang, words, phrase, count(*) as f from g group by all having count(*) >= 100),
c as (select lang, words, phrase, f as a, k, string_split(phrase, ' ') as w
      from (select *, unnest(range(1, words)) as k from f where words > 1)),
s as (select c.lang, c.words, c.phrase, a, k, l.f as l, r.f as r, n, (1000::hugeint * a * n) // (l.f::hugeint * r.f) as score
      from c join total using (lang)
      join f l on l.lang = c.lang and l.phrase = array_to_string(w[1:k], ' ')
      join f r on r.lang = c.lang and r.phrase = array_to_string(w[k + 1:c.words], ' ')),
low as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_parts as (
  select lang, array_to_string(w[i : i + m - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(range(1, words - m + 2)) as i
        from (select lang, words, string_split(phrase, ' ') as w, f as a, unnest(range(2, words)) as m from f where words > 2))
  group by all),
kept as (select low.* from low left join inner_parts using (lang, phrase) where longer is null or 100 * longer < 100 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase collate "binary") as rank, phrase,
       a, l, r, n, score::bigint as score
from kept qualify rank <= 2000
"""
