"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  A document of a source with
``target / size`` = 2.4 is taken twice for certain; the remaining words are
drawn from the source's documents once more, with unequal probabilities: the
inclusion probability grows with the document's weight and is capped at 1.
Pareto order sampling ranks the documents by their random odds over their
inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and takes the head of that
ranking.  The sample size is fixed in words: the head ends where the next
document would pass the remainder, and one rounding document, the one that
fits the gap best, is added if it brings the sum nearer.

Only DataFrame functions are used.  The head of a ranking is found without
sorting a source: words are summed per rank bucket (map-side combined), only
the bucket in which the remainder ends is ordered.

Defined results: a null text has size 0; null sources are a source of their
own, after all others; documents of size 0 take 0 words; the random number comes
from id, size and text, so rows equal in these tie and share their fate; texts
of any length are counted whole; an empty table gives an empty result.
``with_copies`` adds columns that replace input columns of the same name;
``taken_rows`` keeps every input column as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import WORD, cut, small_side

RANK_BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_level(size: Column) -> Column:
    """Whole-number document weight: binary digits of the size (1 for 1, 10 for 1000)."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("long")


def random_number(doc_id: Column, size: Column, text: Column, seed: str) -> Column:
    """Uniform in (0, 1), from id, size and text alone, so reruns agree."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string"), F.lit(":"), digest)
    digits = F.substring(F.md5(name.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_times: int) -> DataFrame:
    """Target words per source: shares by weight, capped at ``max_times`` the size, the excess reshared.

    ``sizes`` has (source, source_size).  Sources in code point order, null
    last, take ``weights`` in turn.  With the sources ordered by cap over
    weight, those before some point are at their cap and the others get the
    common level times their weight; the level is the first one that fits.
    The windows run over one row per source.
    """
    whole = W.partitionBy(F.lit(0))
    everything = whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_name = whole.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * max_times)
    s = s.withColumn("fill", F.col("cap") / F.col("weight"))
    earlier = whole.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))),
    )
    fits = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(everything)
    return s.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(fits["level"], F.col("fill")) * F.col("weight")).alias("target"),
    )


def _draw(size: Column, u: Column, k: Column) -> Column:
    """Place in the ranking: random odds over inclusion odds; null for a document that cannot be drawn."""
    chance = F.least(F.lit(1.0), k * length_level(size))
    return F.when(chance >= 1, 0.0).when(chance > 0, (u / (1 - u)) / (chance / (1 - chance)))


def _bucket(q: Column) -> Column:
    return F.floor(q / (1 + q) * RANK_BUCKETS)


def mix_plan(docs: DataFrame, weights: tuple[float, ...], max_times: int) -> DataFrame:
    """One row per source: its sizes, and where its ranking ends.

    ``docs`` has (source, size, u), u being the random number.  Columns: source, source_size, target,
    whole (certain copies), k (inclusion probability per weight level, at most
    1), last (the last place drawn) and best (the rounding document), both as
    (q, size), null where nothing is drawn.
    """
    d = cut(docs)
    # one row per source and weight level: a few dozen levels at most
    levels = cut(d.groupBy("source", length_level(F.col("size")).alias("lv")).agg(F.sum("size").alias("words")))
    sizes = levels.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = source_targets(sizes, weights, max_times)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # inclusion probability min(1, k * level) whose expected words are the rest
    per_source = W.partitionBy("l.source").orderBy(F.desc("lv"))
    above = per_source.rowsBetween(W.unboundedPreceding, -1)
    onward = per_source.rowsBetween(W.currentRow, W.unboundedFollowing)
    k = (F.col("rest") - F.coalesce(F.sum("words").over(above), F.lit(0))) / F.sum(F.col("lv") * F.col("words")).over(onward)
    solved = (
        levels.alias("l")
        .join(plan.alias("p"), F.col("l.source").eqNullSafe(F.col("p.source")))
        .where("lv > 0")
        .select("l.source", "lv", k.alias("k"))
        .where(F.col("k") * F.col("lv") <= 1)
        .groupBy("source")
        .agg(F.max_by("k", "lv").alias("k"))
    )
    plan = cut(
        plan.alias("p")
        .join(solved.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")), "left")
        .select("p.*", F.coalesce("s.k", F.lit(0.0)).alias("k"))
    )
    ranked = (
        d.alias("d")
        .join(small_side(plan).alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("d.source", "size", "rest", _draw(F.col("size"), F.col("u"), F.col("k")).alias("q"))
        .where("q is not null")
        .withColumn("bucket", _bucket(F.col("q")))
    )
    # the bucket of each source in which the rest ends
    order = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = cut(
        ranked.groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("words").over(order))
        .where("upto > rest")
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
        .select("source", "cut.bucket", "cut.before")
    )
    # only that bucket is ordered; documents that tie share their fate
    in_rank = W.partitionBy("c.source").orderBy("q", "size").rangeBetween(W.unboundedPreceding, W.currentRow)
    fits = F.col("upto") <= F.col("rest")
    last = (
        ranked.alias("c")
        .join(small_side(ends).alias("e"), F.col("c.source").eqNullSafe(F.col("e.source")) & (F.col("c.bucket") == F.col("e.bucket")))
        .select("c.source", "c.bucket", "q", "size", "rest", "before", (F.col("before") + F.sum("size").over(in_rank)).alias("upto"))
        .groupBy("source", "bucket")
        .agg(
            # a bucket of which nothing fits ends before its first place
            F.coalesce(F.max(F.when(fits, F.struct("q", "size"))), F.struct(F.lit(-1.0).alias("q"), F.lit(0).cast("long").alias("size"))).alias("last"),
            (F.first("rest") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.first("before"))).alias("gap"),
        )
    )
    ends = cut(last)
    off = F.abs(F.col("gap") - F.col("size"))
    best = (
        ranked.alias("r")
        .join(small_side(ends).alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")))
        .where(~_drawn(F.col("r.bucket"), F.struct("q", "size"), F.col("e.bucket"), F.col("last")) & (off < F.col("gap")))
        .groupBy("r.source")
        .agg(F.min(F.struct(off.alias("off"), F.col("q"), F.col("size"))).alias("b"))
        .select("source", F.struct("b.q", "b.size").alias("best"))
    )
    return cut(
        plan.alias("p")
        .join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .join(best.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")), "left")
        .select("p.source", "source_size", "target", "whole", "k", F.col("e.bucket").alias("ends_in"), "last", "best")
    )


def _drawn(bucket: Column, place: Column, ends_in: Column, last: Column) -> Column:
    """Whether a place lies in the head of the ranking; without an end the whole ranking is drawn."""
    return F.when(ends_in.isNull(), F.lit(True)).otherwise((bucket < ends_in) | ((bucket == ends_in) & (place <= last)))


def _mixed(
    docs: DataFrame, weights: tuple[float, ...], max_times: int, seed: str, doc_id: str, text: str, source: str
) -> DataFrame:
    """Every input row whole in ``__row``, beside ``__size``, ``__plan`` (its source's) and ``__copies``."""
    size = word_count(F.col(f"`{text}`"))
    u = random_number(F.col(f"`{doc_id}`"), size, F.col(f"`{text}`"), seed)
    named = [size.alias("size"), F.col(f"`{source}`").alias("source"), u.alias("u")]
    plan = small_side(mix_plan(docs.select(*named), weights, max_times))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    row = docs.select(whole.alias("__row"), *[c.alias(f"__{n}") for c, n in zip((size, F.col(f"`{source}`"), u), ("size", "source", "u"))])
    p = plan.select(F.col("source").alias("__of"), F.struct("source_size", "target", "whole", "k", "ends_in", "last", "best").alias("__plan"))
    place = F.struct(F.col("__q").alias("q"), F.col("__size").alias("size"))
    extra = F.col("__q").isNotNull() & (
        _drawn(_bucket(F.col("__q")), place, F.col("__plan.ends_in"), F.col("__plan.last"))
        | F.coalesce(place == F.col("__plan.best"), F.lit(False))
    )
    return (
        row.join(p, F.col("__source").eqNullSafe(F.col("__of")))
        .withColumn("__q", _draw(F.col("__size"), F.col("__u"), F.col("__plan.k")))
        .withColumn("__copies", (F.col("__plan.whole") + F.when(extra, 1).otherwise(0)).cast("long"))
    )


def with_copies(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    max_times: int = 3,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target (words of its source) and copies, the times the mix takes it.

    These columns replace input columns of the same name.
    """
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return _mixed(docs, weights, max_times, seed, doc_id, text, source).select(
        *[F.col(f"__row.`{c}`") for c in names],
        F.col("__size").alias("size"),
        "__plan.source_size",
        "__plan.target",
        F.col("__copies").alias("copies"),
    )


def taken_rows(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    max_times: int = 3,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with just its own columns and values."""
    mixed = _mixed(docs, weights, max_times, seed, doc_id, text, source).where("__copies > 0")
    each = mixed.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__n"))
    return each.select(*[F.col(f"__row.`{c}`") for c in docs.columns])


def op1_pareto_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = with_copies(docs.select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = """
with d as (
  select doc_id, source, coalesce(text, '') as text, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
  from documents),
d1 as (select *, (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || size || ':' || md5(text)), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u from d),
d2 as (select *, case when size > 0 then length(bin(size)) else 0 end as lv from d1),
s0 as (select source, sum(size)::bigint as source_size from d group by source),
s1 as (select *, [5, 2, 1][((row_number() over (order by source collate "binary" nulls last) - 1) % 3 + 1)::int] as weight, source_size * 3 as cap from s0),
s2 as (select *, cap::double / weight as fill from s1),
s3 as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by fill, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
              / (sum(weight) over () - coalesce(sum(weight) over (order by fill, source nulls last rows between unbounded preceding and 1 preceding), 0))::double as level from s2),
lv as (select arg_min(level, fill) as level from s3 where level <= fill),
p0 as (select source, source_size, least(cap::double, (select level from lv) * weight) as target from s3),
p1 as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from p0),
p as (select *, target - whole * source_size as rest from p1),
l0 as (select source, lv, sum(size) as words from d2 where lv > 0 group by source, lv),
l1 as (select l0.source, lv, (rest - coalesce(sum(words) over (partition by l0.source order by lv desc rows between unbounded preceding and 1 preceding), 0)::double)
        / (sum(lv * words) over (partition by l0.source order by lv desc rows between current row and unbounded following))::double as k
       from l0 join p on l0.source is not distinct from p.source),
ks as (select source, arg_max(k, lv) as k from l1 where k * lv <= 1 group by source),
r0 as (select d2.*, source_size, target, whole, rest, least(1.0::double, coalesce(k, 0) * lv) as chance
       from d2 join p on d2.source is not distinct from p.source left join ks on d2.source is not distinct from ks.source),
r1 as (select *, case when chance >= 1 then 0.0 when chance > 0 then (u / (1 - u)) / (chance / (1 - chance)) end as q from r0),
r2 as (select *, rank() over (partition by source order by q, size) as rn,
              sum(size) over (partition by source order by q, size) as upto
       from r1 where q is not null),
f as (select source, min(rn) as first_over from r2 where upto > rest group by source),
g as (select r2.*, coalesce(rn < first_over, false) as extra, first_over from r2 left join f on r2.source is not distinct from f.source),
gap as (select source, rest - coalesce(sum(size) filter (where extra), 0)::double as gap from g where first_over is not null group by source, rest),
b as (select g.source, arg_min(rn, (abs(gap - size), q, size)) as best from g join gap on g.source is not distinct from gap.source
      where not extra and abs(gap - size) < gap group by g.source)
select r1.doc_id, r1.size, r1.source_size, r1.target,
       ((r1.whole + case when coalesce(g.extra, false) or coalesce(g.rn = b.best, false) then 1 else 0 end) * r1.size)::bigint as taken
from r1 left join g on r1.doc_id is not distinct from g.doc_id and r1.source is not distinct from g.source and r1.size = g.size
        left join b on r1.source is not distinct from b.source
"""
