"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors are normalised in double precision; equal vectors become one row.  Each
row is quantised once, to int8 with its own scale, and the exact length of what
quantisation took away, ``r = |x - s * q|``, is kept.  For unit vectors x and y

    | x . y  -  s_x s_y (q_x . q_y) |  <=  r_y |s_x q_x| + r_x |s_y q_y| + r_x r_y

so a pair whose product lies further than that from the threshold is settled.
Rows are dealt into blocks, two blocks at a time meet in one task as a tile, and
the integer product of the tile is one matrix product (exact in float32 while a
row has fewer than 1,040 components, else in float64).  Only int8 rows go to the
tiles.  A tile names the rows that have an open pair; just these are sent to it
once more, as full vectors, and their open pairs are computed in double
precision.

A tile returns per row the number of links and, per row with a link, one link
to the smallest row of its component within the tile; pairs never leave it.
All tiles of all blocks are compared, so nothing is missed; work grows with the
square of the distinct vectors, in products of ``BLOCK`` rows.

Defined results: a null, empty or zero vector, and one with a null or
non-finite component, links with nothing (n_links 0, its own component, kept);
vectors of different lengths do not link; rows with a null id count as links of
others and keep a null component; rows that repeat an id are rows of their own;
an empty table gives an empty result; extra input columns are ignored; vectors
may have any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, plain_names, table
from sluice.llm.components import components

BLOCK = 8192
#: Rows of the left block multiplied at once, which bounds the product in memory.
STRIPE = 256
#: Allowance for rounding in the bound itself, far above what double precision loses.
SLACK = 1e-6


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the exact lengths of the remainders, for rows of unit vectors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - scale[:, None] * q, axis=1)


def unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of length 1, in double precision, of lists that all have the same length."""
    x = vectors.combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(vectors), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


class Rows(NamedTuple):
    """Quantised rows: int8 values, scales, lengths of the remainders and of the quantised rows."""

    q: np.ndarray
    scale: np.ndarray
    rest: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Rows:
        q, scale, rest = quantise(x)
        return cls(q, scale, rest, scale * np.linalg.norm(q.astype(np.float64), axis=1))

    def some(self, at) -> Rows:
        return Rows(*[x[at] for x in self])


def bounded_pairs(x: Rows, y: Rows, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sure) for the pairs of rows that the bound does not rule out; sure ones are links by the bound alone."""
    exact = np.float32 if x.q.shape[1] < 1040 else np.float64
    right = np.ascontiguousarray(y.q.astype(exact).T)
    most_r, most_n = y.rest.max(initial=0), y.length.max(initial=0)
    for lo in range(0, len(x.q), STRIPE):
        part = slice(lo, lo + STRIPE)
        dots = x.q[part].astype(exact) @ right
        # a bound per row first, then the pair's own
        floor = (threshold - SLACK - most_r * x.length[part] - x.rest[part] * most_n - x.rest[part] * most_r) / x.scale[part]
        i, j = np.nonzero(dots * y.scale.astype(exact) >= floor[:, None].astype(exact) - exact(1e-3))
        product = x.scale[lo + i] * y.scale[j] * dots[i, j]
        error = y.rest[j] * x.length[lo + i] + x.rest[lo + i] * y.length[j] + x.rest[lo + i] * y.rest[j]
        keep = product + error >= threshold - SLACK
        yield lo + i[keep], j[keep], (product - error >= threshold + SLACK)[keep]


def possible_pairs(x: np.ndarray, y: np.ndarray, threshold: float):
    """(i, js) for the pairs of rows of unit vectors that the quantised bound does not rule out."""
    for i, j, _ in bounded_pairs(Rows.of(x), Rows.of(y), threshold):
        yield i, j


def _quantised(batches):
    for batch in batches:
        sizes = pa.compute.list_value_length(batch.column("v")).to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            some = batch.take(pa.array(at))
            rows = Rows.of(unit_rows(pa.chunked_array([some.column("v")])))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("node"), some.column("dim"), some.column("copies"),
                    pa.array([x.tobytes() for x in rows.q], pa.binary()), *[pa.array(x) for x in rows[1:]],
                ],
                names=["node", "dim", "copies", "q", "scale", "rest", "length"],
            )


class _Found:
    """Links of one tile: their number per row, and one root per component."""

    def __init__(self, node: np.ndarray, copies: np.ndarray):
        self.node, self.copies = node, copies
        self.links, self.root = np.zeros(len(node), np.int64), np.arange(len(node))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.links, a, self.copies[b])
        np.add.at(self.links, b, self.copies[a])
        # one link per row and root is enough for the components
        for p, q in np.unique(np.column_stack([self.root[a], self.root[b]]), axis=0) if len(a) else ():
            p, q = self.find(p), self.find(q)
            if p != q:
                self.root[max(p, q)] = min(p, q)

    def table(self, rows: pa.Table, open_: np.ndarray) -> pa.Table:
        hit = np.flatnonzero((self.links > 0) | open_)
        place = {c: pa.array(np.full(len(hit), rows.column(c)[0].as_py(), np.int32)) for c in ("dim", "lo", "hi")}
        other = self.node[[self.find(i) for i in hit]] if len(hit) else self.node[:0]
        return pa.table({**place, "node": self.node[hit], "links": self.links[hit], "other": other, "open": open_[hit]})


FOUND = "dim int, lo int, hi int, node long, links long, other long, open boolean"


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    block, lo, hi = rows.column("block").to_numpy(), rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
    return np.flatnonzero(block == lo), np.flatnonzero(block == hi), lo == hi


def _pairs(x: Rows, left: np.ndarray, right: np.ndarray, same: bool, threshold: float):
    for i, j, sure in bounded_pairs(x.some(left), x.some(right), threshold):
        once = j > i if same else np.ones(len(i), bool)
        yield left[i[once]], right[j[once]], sure[once]


def _tile(threshold: float):
    """Links that the bounds settle, and the rows that have open pairs."""

    def run(rows: pa.Table) -> pa.Table:
        found = _Found(rows.column("node").to_numpy(), rows.column("copies").to_numpy())
        q = np.frombuffer(b"".join(rows.column("q").to_pylist()), np.int8).reshape(rows.num_rows, -1)
        x = Rows(q, *[rows.column(c).to_numpy() for c in ("scale", "rest", "length")])
        open_ = np.zeros(rows.num_rows, bool)
        for a, b, sure in _pairs(x, *_sides(rows), threshold):
            found.add(a[sure], b[sure])
            open_[a[~sure]] = open_[b[~sure]] = True
        return found.table(rows, open_)

    return run


def _open_tile(threshold: float):
    """Links among the open pairs of a tile, from the full vectors."""

    def run(rows: pa.Table) -> pa.Table:
        found = _Found(rows.column("node").to_numpy(), rows.column("copies").to_numpy())
        full = unit_rows(rows.column("v"))
        for a, b, sure in _pairs(Rows.of(full), *_sides(rows), threshold):
            a, b = a[~sure], b[~sure]
            true = np.einsum("ij,ij->i", full[a], full[b]) >= threshold
            found.add(a[true], b[true])
        return found.table(rows, np.zeros(rows.num_rows, bool))

    return run


def embedding_links(
    vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (smallest id reachable), kept."""
    d = plain_names(vectors, vec_id=vec_id, v=embedding)
    usable = (
        F.col("v").isNotNull()
        & F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
        & F.exists("v", lambda c: c != 0)
    )
    good = F.coalesce(usable, F.lit(False))
    distinct = cut(
        d.where(good)
        .groupBy("v")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("dim", F.size("v"))
    )
    dims = {r.dim: r.n for r in distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.element_at(F.create_map(*[F.lit(x) for k, n in dims.items() for x in (k, -(-n // block))]), F.col("dim")) if dims else F.lit(1)
    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    schema = "node long, dim int, copies long, q binary, scale double, rest double, length double"
    small = placed(distinct.select("node", "dim", "copies", "v").mapInArrow(_quantised, schema))
    tiles = (
        small.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .drop("blocks", "other")
    )
    settled = cut(tiles.groupBy("dim", "lo", "hi").applyInArrow(_tile(threshold), FOUND))
    full = placed(distinct.select("node", "copies", "v", "dim")).select("node", "copies", "v", "block")
    opened = settled.where("open").select("dim", "lo", "hi", "node").join(full, "node")
    opened = cut(opened.groupBy("dim", "lo", "hi").applyInArrow(_open_tile(threshold), FOUND))
    found = settled.unionByName(opened).where("links > 0")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = distinct.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = cut(named.select("v", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), "root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_vector = named.join(least, "root").select("v", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return (
        d.join(of_vector, "v", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def op7_embedding_links(spark, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings),
g as (
  select vec_id, e, sqrt(list_dot_product(e, e)) as n from v
  where e is not null and len(list_filter(e, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(e, lambda c: c <> 0)) > 0),
l as (
  select a.vec_id as a, b.vec_id as b from g a join g b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r(vec_id, seen) as (select vec_id, vec_id from v union select r.vec_id, l.b from r join l on r.seen = l.a),
c as (select vec_id, min(seen) as component_id from r group by vec_id)
select c.vec_id, coalesce(k.n, 0)::bigint as n_links, c.component_id, c.vec_id = c.component_id as kept
from c left join (select a, count(*) as n from l group by a) k on c.vec_id = k.a
"""
