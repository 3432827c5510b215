"""Benchmark decontamination by BM25 retrieval and overlap checks.

The test items form an inverted index; every item is a unit, and so is its
question part where that is long enough to be recognised alone.  Impacts are
BM25 weights over the unit's own score, so 1 means that a passage holds all
words of the unit.  Units are kept in blocks, and every term knows its largest
impact in each block.

Every document is cut into overlapping passages, twice the longest unit each,
so that a copied unit lies wholly in one of them, and every passage is a query.
Retrieval is block-max WAND over a batch of passages at a time: a passage's
terms are added up by their largest impact per block, blocks that cannot reach
the threshold are skipped, and only in the others the units' own postings are
opened and scored.  All units above the threshold are retrieved.

A copy whose parts stand further apart than a passage is retrieved from the
document as a whole: its words that stand in a run of five found in some item
are one more query.  A unit's threshold is then the least share of its weight
that the words of enough of its shingles can have, so that retrieval leaves out
nothing that the rule below would find.

A retrieved unit is verified on the document's five-word shingles: the item
leaks if 80% of its shingles are there, or 80% of its question's.  An item of
fewer than five words leaks into texts that are nothing else.

An index holds at most ``index_bytes`` of item text; more items make several
indexes, each asked in a pass of its own whose result is stored before the next
index is broadcast.

Defined results: null and empty texts leak nothing; items without a word are
ignored; items that repeat are items of their own; item ids are of any atomic
type and may be null; words are runs of letters
and digits, upper and lower case alike (A-Z); rows that repeat are reported
each; an empty table on either side gives an empty result; extra input columns
are ignored; texts of any length are read whole, in slices.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sluice.llm.common import bound_batches, cut, plain_names, table
from sluice.llm.words import PUNCTUATION, shingles, word_hashes

K1, B = 1.2, 0.75
SHINGLE = 5
BLOCK = 4
#: A term in more than this share of the blocks is a common one.
COMMON = 0.1
#: Cells (steps times blocks) summed at once.
DENSE = 1 << 21
#: A question shorter than this many words is no unit of its own.
LONE_QUESTION = 12
_LAST_SENTENCE = re.compile(r"^(.*[.?!])[ \t\r\n]+([^.?!]*[.?!]*)[ \t\r\n]*$", re.S)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence, if there are several, is the answer."""
    m = _LAST_SENTENCE.match(text)
    return (m[1], m[2]) if m else (text, "")


def _words(text: str) -> np.ndarray:
    return next((w for _, w, _ in word_hashes(pa.array([text]), PUNCTUATION)), np.zeros(0, np.uint64))


def _shingle_set(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words, SHINGLE))


def least_share(words: np.ndarray, terms: np.ndarray, weight: np.ndarray, overlap: float) -> float:
    """The least weight that the words of ``overlap`` of a unit's shingles can have; ``weight`` is that of its sorted ``terms``.

    A word is only absent if all its shingles are, so each of them carries an
    equal share of its weight; what is lost is at most the shares of as many
    shingles as may be absent.
    """
    runs = shingles(words, SHINGLE)
    unique, number = np.unique(runs, return_inverse=True)
    spare = len(unique) - int(np.ceil(overlap * len(unique) - 1e-9))
    if spare <= 0:
        return 1.0
    place = np.searchsorted(terms, words)
    pairs = np.unique(np.concatenate([number * len(terms) + place[i : i + len(runs)] for i in range(SHINGLE)]))
    shingle, term = pairs // len(terms), pairs % len(terms)
    share = np.bincount(shingle, (weight / np.bincount(term, minlength=len(terms)))[term])
    return float(1 - np.sort(share)[-spare:].sum())


def build_index(items: list[tuple[int, str]], overlap: float = 0.8) -> dict | None:
    """Sorted terms, postings with impacts, and the largest impact per block; None without any word."""
    units, parts = [], []
    for n, (item, text) in enumerate(items):
        words = _words(text)
        if not len(words):
            continue
        q, a = (_words(x) for x in split_item(text))
        parts.append((item, _shingle_set(words), _shingle_set(q), _shingle_set(a), len(q)))
        units.append((len(parts) - 1, words))
        if len(a) and len(q) >= LONE_QUESTION:
            units.append((len(parts) - 1, q))
    if not units:
        return None
    n = len(units)
    size = np.array([len(w) for _, w in units], dtype=np.float64)
    terms = np.unique(np.concatenate([w for _, w in units]))
    rows = []
    for u, (_, w) in enumerate(units):
        t, tf = np.unique(w, return_counts=True)
        rows.append(np.column_stack([np.searchsorted(terms, t), np.full(len(t), u), tf]))
    post = np.concatenate(rows)
    post = post[np.lexsort((post[:, 1], post[:, 0]))]
    term, unit, tf = post[:, 0], post[:, 1], post[:, 2].astype(np.float64)
    df = np.bincount(term, minlength=len(terms))
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[unit] / size.mean()))
    impact /= np.bincount(unit, impact, minlength=n)[unit]
    least = np.full((n // BLOCK + 1) * BLOCK, np.inf)
    by_unit = np.argsort(unit, kind="stable")
    for u, own in enumerate(np.split(by_unit, np.cumsum(np.bincount(unit, minlength=n))[:-1])):
        least[u] = least_share(units[u][1], terms[term[own]], impact[own], overlap)
    key = term * (n // BLOCK + 1) + unit // BLOCK
    blocks, first = np.unique(key, return_index=True)
    width = n // BLOCK + 1
    block_at = np.searchsorted(blocks // width, np.arange(len(terms) + 1))
    block_most = np.maximum.reduceat(impact, first)
    often = np.flatnonzero(np.diff(block_at) > COMMON * width)
    common = np.full(len(terms), -1)
    common[often] = np.arange(len(often))
    common_most = np.zeros((len(often), width), dtype=np.float32)
    for row, t in enumerate(often):
        common_most[row, blocks[block_at[t] : block_at[t + 1]] % width] = block_most[block_at[t] : block_at[t + 1]]
    return {
        "parts": parts,
        "part_of": np.array([p for p, _ in units]),
        "window": int(size.max()),
        "least": least.reshape(-1, BLOCK),
        "shingles": np.unique(np.concatenate([x for _, *sets, _ in parts for x in sets[:2]])),
        "terms": terms,
        "unit": unit,
        "impact": impact,
        "block_key": blocks,
        "block_first": np.r_[first, len(unit)],
        "block_at": block_at,
        "block": blocks % width,
        "block_most": block_most,
        "common": common,
        "common_most": common_most,
    }


def _opened(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of postings: which range each posting is of, and its place."""
    n = ends - starts
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)


def retrieve(
    index: dict, cells: tuple[np.ndarray, np.ndarray], passage: np.ndarray, term: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, unit, score) of the pairs that reach the threshold, in the given (passage, block) cells.

    ``passage`` (ascending) and ``term`` list the distinct terms of each passage.
    """
    return _scored(index, cells, passage, term, np.full_like(index["least"], threshold))


def _scored(index: dict, cells: tuple[np.ndarray, np.ndarray], passage: np.ndarray, term: np.ndarray, threshold: np.ndarray):
    """``retrieve`` with a threshold per block and unit."""
    at_passage, at_block = cells
    width = len(index["part_of"]) // BLOCK + 1
    cell, place = _opened(np.searchsorted(passage, at_passage), np.searchsorted(passage, at_passage, side="right"))
    want = term[place] * width + at_block[cell]
    k = np.minimum(np.searchsorted(index["block_key"], want), len(index["block_key"]) - 1)
    hit = index["block_key"][k] == want
    cell, k = cell[hit], k[hit]
    o, at = _opened(index["block_first"][k], index["block_first"][k + 1])
    score = np.bincount(cell[o] * BLOCK + index["unit"][at] % BLOCK, index["impact"][at], minlength=len(at_block) * BLOCK)
    good = np.flatnonzero(score >= threshold[at_block].reshape(-1) - 1e-9)
    return at_passage[good // BLOCK], at_block[good // BLOCK] * BLOCK + good % BLOCK, score[good]


def _held(part: np.ndarray, whole: np.ndarray) -> float | None:
    return None if not len(part) else float(np.isin(part, whole, assume_unique=True).sum() / len(part))


def likely_cells(index: dict, step: np.ndarray, term: np.ndarray, n_steps: int, threshold: float | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, block) wherever the block may hold a unit above the threshold (of all blocks, or of each).

    Passage p covers steps p and p + 1.  The bound sums a block's largest
    impacts over the words of the passage.  The common terms, found in a good
    part of all blocks, are summed by one matrix product, the others by opening
    their postings.
    """
    width = len(index["part_of"]) // BLOCK + 1
    common = index["common"]  # per term: its row among the common ones, or -1
    passages, blocks, chunk = [], [], max(2, DENSE // width)
    for lo in range(0, n_steps, chunk - 1):
        a, b = np.searchsorted(step, [lo, lo + chunk])
        at_step, t = step[a:b] - lo, term[a:b]
        often = common[t] >= 0
        there = np.zeros((chunk, len(index["common_most"])), dtype=np.float32)
        there[at_step[often], common[t[often]]] = 1
        at_step, t = at_step[~often], t[~often]
        o, at = _opened(index["block_at"][t], index["block_at"][t + 1])
        most = np.bincount(at_step[o] * width + index["block"][at], index["block_most"][at], minlength=chunk * width)
        most = most.reshape(chunk, width) + there @ index["common_most"]
        p, b = np.nonzero(most[:-1] + most[1:] >= threshold - 1e-6)
        passages.append(lo + p)
        blocks.append(b)
    return np.concatenate(passages), np.concatenate(blocks)


def _from_passages(index: dict, row: np.ndarray, spot: np.ndarray, term: np.ndarray, bounds: np.ndarray, threshold: float):
    """(row, unit, score) of the units that one passage of the text holds."""
    # steps of the longest unit's length, after an empty one that parts a text from the one before
    first = np.cumsum(np.r_[0, np.diff(bounds) // index["window"] + 2])
    step = first[row] + 1 + (spot - bounds[row]) // index["window"]
    cells = likely_cells(index, step, term, int(first[-1]), threshold)
    if not len(cells[0]):
        return (np.zeros(0, np.int64),) * 3
    # the distinct terms of the passages left; a word is in the passage of its step and in the one before
    mask = np.zeros(int(first[-1]) + 1, bool)
    mask[cells[0]] = True
    own, before = mask[step], mask[step - 1]
    key = np.unique(np.concatenate([step[own], step[before] - 1]) * len(index["terms"]) + np.concatenate([term[own], term[before]]))
    passage, unit, score = retrieve(index, cells, key // len(index["terms"]), key % len(index["terms"]), threshold)
    return np.searchsorted(first, passage, side="right") - 1, unit, score


def _from_whole_texts(index: dict, row: np.ndarray, spot: np.ndarray, term: np.ndarray, words: np.ndarray, bounds: np.ndarray):
    """(row, unit, score) of the units that the text's words in shared shingles may hold together."""
    shared = np.zeros(len(words) + SHINGLE, bool)
    runs = shingles(words, SHINGLE)
    at = np.minimum(np.searchsorted(index["shingles"], runs), len(index["shingles"]) - 1)
    begin = np.flatnonzero(index["shingles"][at] == runs)
    for i in range(SHINGLE):
        shared[begin + i] = True
    # a text of fewer words is one shingle
    stay = shared[spot] | (np.diff(bounds) < SHINGLE)[row]
    key = np.unique(row[stay] * len(index["terms"]) + term[stay])
    if not len(key):
        return (np.zeros(0, np.int64),) * 3
    rows, number = np.unique(key // len(index["terms"]), return_inverse=True)
    # a step with an empty one behind it is a passage of its own
    step, term = 2 * number + 1, key % len(index["terms"])
    at_passage, at_block = likely_cells(index, step, term, 2 * len(rows) + 1, index["least"].min(axis=1))
    odd = at_passage % 2 == 1
    passage, unit, score = _scored(index, (at_passage[odd], at_block[odd]), step, term, index["least"])
    return rows[passage // 2], unit, score


def leaks_of(index: dict, rows: np.ndarray, words: np.ndarray, bounds: np.ndarray, threshold: float, overlap: float):
    """(row, item, score, overlaps) of the verified items of the texts whose words are given."""
    place = np.minimum(np.searchsorted(index["terms"], words), len(index["terms"]) - 1)
    spot = np.flatnonzero(index["terms"][place] == words)
    if not len(spot):
        return
    term, size = place[spot], np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)[spot]
    found = (
        _from_passages(index, row, spot, term, bounds, threshold),
        _from_whole_texts(index, row, spot, term, words, bounds),
    )
    row, unit, score = (np.concatenate(x) for x in zip(*found))
    best: dict[tuple[int, int], float] = {}
    for r, p, s in zip(row, index["part_of"][unit], score):
        best[r, p] = max(best.get((r, p), 0.0), s)
    sets: dict[int, np.ndarray] = {}
    for (r, p), s in sorted(best.items()):
        if r not in sets:
            sets = {r: _shingle_set(words[bounds[r] : bounds[r + 1]])}
        item, whole, question, answer, n_question = index["parts"][p]
        got = [_held(x, sets[r]) for x in (whole, question, answer)]
        if got[0] >= overlap or (n_question >= LONE_QUESTION and got[1] >= overlap):
            yield rows[r], item, s, *got


def _find(shared, threshold: float, overlap: float, id_type: pa.DataType):
    def run(batches):
        index = shared.value
        for batch in batches:
            out = []
            for lo, words, bounds in word_hashes(batch.column("text"), PUNCTUATION):
                out += leaks_of(index, np.arange(lo, lo + len(bounds) - 1), words, bounds, threshold, overlap)
            row, item, score, whole, question, answer = zip(*out) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(item, id_type),
                    *[pa.array(x, pa.float64()) for x in (score, whole, question, answer)],
                ],
                names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return run


def _clean(shared, text: str, threshold: float, overlap: float):
    def run(batches):
        index = shared.value
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for lo, words, bounds in word_hashes(batch.column(text), PUNCTUATION):
                for row, *_ in leaks_of(index, np.arange(lo, lo + len(bounds) - 1), words, bounds, threshold, overlap):
                    clean[row] = False
            yield batch.filter(pa.array(clean))

    return run


def _passes(items: DataFrame, index_bytes: int, item_id: str, text: str) -> list[DataFrame]:
    """The items in shares of at most about ``index_bytes`` of text, one share a pass."""
    bound_batches(items.sparkSession)
    b = plain_names(items, item_id=item_id, text=text).where("text is not null")
    size = b.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = -(-size // index_bytes)
    return [b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) for k in range(passes)]


def _index(share: DataFrame, overlap: float):
    """The share's index as a broadcast, or ``None`` if no item has words."""
    rows = share.collect()
    index = build_index(sorted(((r.item_id, r.text) for r in rows), key=str), overlap)
    return share.sparkSession.sparkContext.broadcast(index) if index else None


def _in_turn(shares: list[DataFrame], overlap: float, apply):
    """``apply(index)`` for every share's index; with several shares each result is
    stored, and its index released, before the next one is built."""
    for share in shares:
        index = _index(share, overlap)
        if index is None:
            continue
        result = apply(index)
        if len(shares) > 1:
            result = cut(result)
            index.destroy()
        yield result


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.65,
    overlap: float = 0.8,
    index_bytes: int = 32 << 20,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, into which no item leaks."""
    left = [docs]

    def clean(index):
        return left[-1].mapInArrow(_clean(index, text, threshold, overlap), docs.schema)

    for result in _in_turn(_passes(items, index_bytes, item_id, item_text), overlap, clean):
        left.append(result)
    return left[-1]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.65,
    overlap: float = 0.8,
    index_bytes: int = 32 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, score, overlap, question_overlap, answer_overlap."""
    d = plain_names(docs, doc_id=doc_id, text=text)
    kind, item_kind = (df.schema[c].dataType for df, c in ((d, "doc_id"), (items, item_id)))
    schema = f"doc_id {kind.simpleString()}, item_id {item_kind.simpleString()}, " + ", ".join(
        f"{c} double" for c in ("score", "overlap", "question_overlap", "answer_overlap")
    )

    def find(index):
        return d.mapInArrow(_find(index, threshold, overlap, to_arrow_type(item_kind)), schema)

    found = list(_in_turn(_passes(items, index_bytes, item_id, "text"), overlap, find))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def op2_bm25_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).drop("score")


ORACLE = """
with b as (
  select item_id, text, regexp_extract(text, '(?s)^(.*[.?!])[ \\t\\r\\n]+([^.?!]*[.?!]*)[ \\t\\r\\n]*$', 1) as q0,
         regexp_extract(text, '(?s)^(.*[.?!])[ \\t\\r\\n]+([^.?!]*[.?!]*)[ \\t\\r\\n]*$', 2) as a0 from benchmark where text is not null),
parts as (
  select item_id, 0 as part, text as t from b union all
  select item_id, 1, case when q0 = '' then text else q0 end from b union all
  select item_id, 2, a0 from b),
w as (select *, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\\x00-\\x7F])+') as w from parts),
s as (select item_id, part, len(w) as words,
             unnest(case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                         when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as x from w),
n as (select item_id, part, count(*) as n, any_value(words) as words from s group by 1, 2),
d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\\x00-\\x7F])+') as w from documents),
ds as (select doc_id, unnest(list_distinct(list_concat(
         case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
              when len(w) > 0 then [array_to_string(w, ' ')] else [] end, []))) as x from d),
h as (select doc_id, item_id, part, count(*) as h from ds join s using (x) group by 1, 2, 3),
p as (select doc_id, item_id,
             coalesce(max(h) filter (where part = 0), 0) as h0, coalesce(max(h) filter (where part = 1), 0) as h1, coalesce(max(h) filter (where part = 2), 0) as h2
      from h group by 1, 2)
select p.doc_id, p.item_id, h0::double / n0.n as overlap, h1::double / n1.n as question_overlap, h2::double / n2.n as answer_overlap
from p join n n0 on n0.item_id = p.item_id and n0.part = 0 join n n1 on n1.item_id = p.item_id and n1.part = 1
       left join n n2 on n2.item_id = p.item_id and n2.part = 2
where h0::double / n0.n >= 0.8 or (n1.words >= 12 and h1::double / n1.n >= 0.8)
"""
