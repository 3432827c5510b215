"""Connected components of a link table, without collecting links or groups.

The two-step star contraction: every node hands its larger neighbours to the
smallest node it sees, then every node hands its smaller neighbours to the
smallest of them, until the links are stars around each component's smallest
node.  Both steps are a minimum per node (combined map-side) and a join, so a
node with many links never forms a group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another; root is the smallest node reachable.

    ``links`` holds undirected pairs of whole numbers, in any order, repeats
    allowed; pairs with a null or with equal ends link nothing.
    """
    e = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    e = cut(e.distinct())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(low, "a")
        e = cut(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        last, state = state, _state(e)
        if state == last:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
