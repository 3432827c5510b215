"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Every text is read once: its distinct shingles are counted, and 144 MinHash
   values (16 bits each) form its signature.  Equal word sequences become one
   node, so a group of exact copies is one row from here on.
2. Signatures are cut into bands; nodes that agree in a band share a bucket.
   In every bucket one node is the pivot, the one that shares the most buckets
   overall (in a family of copies, the one closest to the original), and each
   member is a candidate pair with it.
3. A candidate's signatures are compared batch by batch.  After each batch the
   posterior of the similarity, given the matches so far and a uniform prior,
   decides: if the chance that it reaches the threshold is below ``miss``, the
   pair is dropped.  Survivors are verified exactly on their full sets.
4. Verified links make components.  Buckets that still hold several of them
   get the remaining pairs compared the same two ways, in tiles of bounded size
   inside tasks, skipping pairs that are already in one component; only the
   links that join components leave the tile.

No bucket, group or row is capped.  A tile holds about ``2 * TILE`` rows at
most; a larger bucket is dealt over several tiles.

Defined results: null and empty texts, and texts of white space only, have no
shingles and link with nothing; rows with a null id are returned with a null
component and kept; rows that repeat a text are copies; rows that share an id
but not a text are nodes of their own, reported under that id; an empty table
gives an empty result; extra input columns are ignored; texts of any length are
read whole, in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, cut, plain_names, small_side
from sluice.llm.components import components
from sluice.llm.words import mix, shingles, word_hashes

HASHES = 144
BATCH = 24
TILE = 512
#: Chance that banding gives no common bucket to a pair exactly at the threshold.
BAND_MISS = 1e-4
#: Odd steps that tell the places of a sequence apart.
_PLACE = (np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7))


def band_rows(percent: int) -> int:
    """Rows per band: the most for which a pair at the threshold still shares a band."""
    s = percent / 100
    fits = [r for r in range(1, HASHES + 1) if HASHES % r == 0 and (1 - s**r) ** (HASHES // r) <= BAND_MISS]
    return max(fits, default=1)


def least_matches(percent: int, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to stay): the posterior of s given m of n is Beta(m+1, n-m+1)."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:  # P(s >= t | m of n) = P(Binomial(n + 1, t) <= m)
            m += 1
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per signature and band."""
    bands = sig.reshape(len(sig), -1, rows).astype(np.uint64)
    keys = np.tile(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), (len(sig), 1))
    for i in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return keys


def _sequence(words: np.ndarray) -> list[int]:
    """A 128-bit digest of a word sequence, as two signed numbers."""
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    return [int(np.add.reduce(mix(words ^ mix(at * step))).view(np.int64)) for step in _PLACE]


def _signatures(k: int, rows: int):
    rng = np.random.default_rng(20240611)
    mult = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, n = batch.column("doc_id"), batch.column("text"), batch.num_rows
            count = np.zeros(n, np.int64)
            seq = np.zeros((n, 2), np.int64)
            sig = np.zeros((n, HASHES), np.uint16)
            for lo, words, bounds in word_hashes(texts):
                sets = []
                for i in range(len(bounds) - 1):
                    w = words[bounds[i] : bounds[i + 1]]
                    if len(w):
                        s = np.unique(shingles(w, k))
                        count[lo + i] = len(s)
                        sets.append((lo + i, s))
                        seq[lo + i] = _sequence(w)
                if not sets:
                    continue
                flat = np.concatenate([s for _, s in sets])
                heads = np.cumsum([0, *[len(s) for _, s in sets[:-1]]])
                at, buf = [r for r, _ in sets], np.empty_like(flat)
                for h in range(HASHES):
                    np.multiply(flat, mult[h], out=buf)
                    buf += plus[h]
                    sig[at, h] = (mix(np.minimum.reduceat(buf, heads)) >> np.uint64(48)).astype(np.uint16)
            keys = _band_keys(sig, rows).view(np.int64)
            flat_keys = pa.array(keys.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    batch.column("text_hash"),
                    pa.array(count),
                    pa.array(seq[:, 0]),
                    pa.array(seq[:, 1]),
                    pa.array([r.tobytes() for r in sig], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * keys.shape[1] + 1, keys.shape[1], dtype=np.int32)), flat_keys),
                ],
                names=["doc_id", "text_hash", "n_shingles", "h1", "h2", "sig", "bands"],
            )

    return run


def _own_text(batches):
    """Of texts that share an id, the one whose words are the node's."""
    for batch in batches:
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        same = np.zeros(batch.num_rows, bool)
        for lo, words, bounds in word_hashes(batch.column("text")):
            for i in range(len(bounds) - 1):
                same[lo + i] = _sequence(words[bounds[i] : bounds[i + 1]]) == [h1[lo + i], h2[lo + i]]
        yield batch.select(["node", "text"]).filter(pa.array(same))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, HASHES)


def _survivors(a: np.ndarray, b: np.ndarray, rule: list[tuple[int, int]]) -> np.ndarray:
    """Places of the signature pairs that no batch rules out."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in rule:
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        stay = matches >= least
        alive, matches, done = alive[stay], matches[stay], n
    return alive


def _prune(rule):
    def run(batches):
        for batch in batches:
            keep = _survivors(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), rule)
            yield batch.select(["a", "b"]).take(pa.array(keep))

    return run


def _verify(k: int, percent: int):
    def run(batches):
        cache: dict[int, np.ndarray] = {}

        def sets(ids: pa.Array, texts: pa.Array) -> list[np.ndarray]:
            ids = ids.to_pylist()
            new = [i for i, x in enumerate(ids) if x not in cache]
            for lo, words, bounds in word_hashes(texts.take(pa.array(new, pa.int64()))):
                for i in range(len(bounds) - 1):
                    cache[ids[new[lo + i]]] = np.unique(shingles(words[bounds[i] : bounds[i + 1]], k))
            return [cache[x] for x in ids]

        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                left, right = sets(part.column("a"), part.column("text_a")), sets(part.column("b"), part.column("text_b"))
                linked = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
                if len(cache) > 512:
                    cache.clear()

    return run


def _tiles(k: int, percent: int, rows: int, rule):
    """Links that join components within one tile; each pair is compared in the first band it shares."""

    def run(table: pa.Table) -> pa.Table:
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        part = table.column("part").to_numpy()
        node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy().copy()
        sig = _matrix(table.column("sig").combine_chunks())
        bands = _band_keys(sig, rows).view(np.int64)
        own = (bands == np.int64(table.column("key")[0].as_py())).argmax(axis=1)
        texts, sets = table.column("text").combine_chunks(), {}

        def full(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.unique(shingles(next(word_hashes(texts.slice(i, 1)))[1], k))
            return sets[i]

        left, right = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
        out: list[tuple[int, int]] = []
        for i in left:
            js = right[(comp[right] != comp[i]) & ((node[right] > node[i]) if lo == hi else True)]
            js = js[_survivors(np.broadcast_to(sig[i], (len(js), HASHES)), sig[js], rule)]
            if own[i]:
                js = js[~(bands[js][:, : own[i]] == bands[i, : own[i]]).any(axis=1)]
            for j in js:
                if comp[i] != comp[j]:
                    a, b = full(i), full(j)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        out.append((node[i], node[j]))
                        comp[comp == comp[j]] = comp[i]
            # the sets of the right side are met again by every row, those of the left are not
            if lo != hi:
                sets.pop(i, None)
        a, b = np.array(out, dtype=np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return run


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    percent: int = 85,
    miss: float = 5e-4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links), kept, text_hash (xxhash64).

    Two texts are linked if the Jaccard similarity of their ``words``-word
    shingle sets is at least ``percent`` / 100, checked in whole numbers.
    """
    return _grouped(docs, words, percent, miss, doc_id, text).drop("root")


def _grouped(docs: DataFrame, words: int, percent: int, miss: float, doc_id: str, text: str) -> DataFrame:
    """``near_duplicates`` with the component's own key, ``root``: components that share their smallest id differ in it."""
    bound_batches(docs.sparkSession)
    d = plain_names(docs, doc_id=doc_id, text=text).withColumn("text_hash", F.xxhash64("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    rows, rule = band_rows(percent), least_matches(percent, miss)
    signed = cut(
        d.mapInArrow(_signatures(words, rows), f"doc_id {id_type}, text_hash long, n_shingles long, h1 long, h2 long, sig binary, bands array<long>")
    )
    nodes = cut(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    placed = nodes.select("node", F.explode("bands").alias("key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    member = cut(placed.join(shared, "key"))
    central = member.groupBy("node").agg(F.sum("members").alias("central"))
    pivots = cut(
        member.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("central", -F.col("node"))).alias("pivot"))
    )
    stars = (
        member.join(pivots, "key")
        .where("node != pivot")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    sigs = nodes.select("node", "sig")
    likely = (
        stars.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b").mapInArrow(_prune(rule), "a long, b long")
    )

    def texts_of(wanted: DataFrame) -> DataFrame:
        """(node, text) of the wanted nodes."""
        wanted = cut(wanted.distinct().join(nodes.select("node", "least", "h1", "h2"), "node"))
        return cut(
            d.join(small_side(wanted.withColumnRenamed("least", "doc_id"), 1_000_000), "doc_id")
            .mapInArrow(_own_text, "node long, text string")
            .groupBy("node")
            .agg(F.first("text").alias("text"))
        )

    likely = cut(likely)
    texts = texts_of(likely.select(F.col("a").alias("node")).union(likely.select("b")))
    links = cut(
        likely.join(texts.toDF("a", "text_a"), "a")
        .join(texts.toDF("b", "text_b"), "b")
        .mapInArrow(_verify(words, percent), "a long, b long")
    )
    first = cut(components(links))
    placed = member.join(first, "node", "left").select("key", "node", "members", F.coalesce("root", "node").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    open_ = cut(placed.join(mixed, "key").join(pivots, "key").where("node != pivot"))
    parts = F.ceil(F.col("members") / TILE).cast("int")
    tiles = (
        open_.join(sigs, "node")
        .join(texts_of(open_.select("node")), "node")
        .withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("key", "node", "comp", "sig", "text", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    )
    links = links.unionByName(cut(tiles.groupBy("key", "lo", "hi").applyInArrow(_tiles(words, percent, rows, rule), "a long, b long")))
    roots = cut(components(links))
    groups = nodes.join(roots, "node", "left").select("h1", "h2", "least", F.coalesce("root", "node").alias("root"))
    named = groups.groupBy("root").agg(F.min("least").alias("component_id")).join(groups, "root").select("h1", "h2", "component_id", "root")
    return (
        signed.select("doc_id", "n_shingles", "h1", "h2", "text_hash")
        .join(named, ["h1", "h2"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_hash", "root")
    )


def one_of_each_group(
    docs: DataFrame, words: int = 5, percent: int = 80, miss: float = 5e-4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, but of each group of near-duplicates only the one with the smallest id.

    Of rows of one group that share the smallest id, one stays, of the text
    with the least hash.  Groups that share their smallest id keep a row each.
    Rows with a null id or without words stay all.
    """
    found = cut(_grouped(docs, words, percent, miss, doc_id, text))
    gone = found.where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__t"))
    again = cut(
        found.where("kept and doc_id is not null and n_shingles > 0")
        .groupBy(F.col("doc_id").alias("__id"), F.col("root").alias("__root"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("text_hash").alias("__least"))
        .where("n > 1")
    )
    some = not again.isEmpty()
    if some:
        # within a group, the other texts of the id that stays go too
        held = found.where("kept").join(small_side(again, 1_000_000), (F.col("doc_id") == F.col("__id")) & (F.col("root") == F.col("__root")))
        gone = gone.unionByName(held.where("text_hash != __least").select("__id", F.col("text_hash").alias("__t")))
    gone = small_side(cut(gone.distinct()), 1_000_000)
    left = docs.join(gone, (docs[doc_id] == gone["__id"]) & (F.xxhash64(docs[text]) == gone["__t"]), "left_anti")
    if not some:
        return left
    side = small_side(cut(again.select("__id", F.col("__least").alias("__t")).distinct()), 1_000_000)
    same = (left[doc_id] == side["__id"]) & (F.xxhash64(left[text]) == side["__t"])
    repeats = left.join(side, same).dropDuplicates(["__id", "__t"]).select(*docs.columns)
    return left.join(side, same, "left_anti").unionByName(repeats)


def op4_minhash_near_dup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).drop("text_hash")


ORACLE = """
with recursive t as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
s as (
  select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as sh
  from t),
n as (select doc_id, coalesce(len(sh), 0)::bigint as n_shingles from s),
u as (select doc_id, unnest(sh) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from u a join u b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * common >= 85 * (x.n_shingles + y.n_shingles - common)),
e as (select a, b from l union select b, a from l),
r(doc_id, seen) as (select doc_id, doc_id from n union select r.doc_id, e.b from r join e on r.seen = e.a)
select n.doc_id, n_shingles, c.component_id, n.doc_id = c.component_id as kept
from n join (select doc_id, min(seen) as component_id from r group by doc_id) c on n.doc_id = c.doc_id
"""
