"""Config lookup, cardinality and normalisation (C1-C3), set-based.

The reference fetches one config row per run with SQL built by ``repr`` and
calls ``first()`` twenty times.  Here a table of run requests is joined to the
config table once, with equi-join keys so the plan is a hash join, not a
nested loop:

* a manual request matches on ``(schema_name, table_name)``, and on ``id``
  when it names one, which then is a key of the join too;
* a scheduled request matches on ``cloudwatch_event_name``;
* a scheduled request without an event name matches every active scheduled
  config; it can only run if there is exactly one, so the configs are counted,
  not joined to every such request.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default static predicate and the rewrite of ``+`` in a
# watermark column, as the reference's config step applies them.
DEFAULT_QUERY_PARAMETER = " 1=1 "
PLUS_REWRITE = "||' '||"
# Fixed value: the scheme the reference puts in front of a bare bucket name.
BUCKET_SCHEME = "s3://"
_HAS_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
#: Configs of a lookup key that a request meets.
CONFIGS = "__configs"


def target_path_text(bucket: str | None, prefix: str | None) -> str | None:
    """``{bucket}/{prefix}``; a bare bucket name gets the reference's scheme,
    a URI or an absolute path is kept as given."""
    if not bucket or not prefix:
        return None
    b = str(bucket).rstrip("/")
    if not re.match(_HAS_SCHEME, b) and not b.startswith("/"):
        b = BUCKET_SCHEME + b
    return f"{b}/{str(prefix).strip('/')}"


def target_path_column(bucket: Column, prefix: Column) -> Column:
    """Column form of :func:`target_path_text`."""
    b = F.regexp_replace(bucket, "/+$", "")
    b = F.when(b.rlike(_HAS_SCHEME) | b.startswith("/"), b).otherwise(F.concat(F.lit(BUCKET_SCHEME), b))
    p = F.regexp_replace(prefix, "^/+|/+$", "")
    return F.when(bucket.isNull() | prefix.isNull() | (bucket == "") | (prefix == ""), F.lit(None)).otherwise(
        F.concat(b, F.lit("/"), p)
    )


def lookup_configs(configs: DataFrame, requests: DataFrame, counted: bool = False) -> DataFrame:
    """Configs matched by run requests.

    ``requests`` columns: ``request_id, manual_flag, schema_name, table_name,
    config_id, cloudwatch_event_name`` (the last three may be null).
    Returns the matched config columns plus ``request_id``.  A scheduled
    request without an event name has a row only if exactly one active
    scheduled config exists; ``check_requests`` tells how many there are.

    With ``counted`` the configs of a lookup key stay together: a request has
    one row per key it meets, with the number of its configs in ``__configs``
    and the config columns where there is only one, else null.  These rows
    grow as the requests do; one per match grow with requests times configs.
    """
    active = configs.where(F.col("active_flag") == "Y")
    req = requests.select(
        "request_id",
        F.col("manual_flag").alias("__manual"),
        F.col("schema_name").alias("__schema"),
        F.col("table_name").alias("__table"),
        F.col("config_id").alias("__id"),
        F.col("cloudwatch_event_name").alias("__event"),
    )
    cols = [*configs.columns, *([CONFIGS] if counted else []), "request_id"]
    manual = active.where(F.col("manual_flag") == "Y")
    by_name = req.where(F.col("__manual") == "Y")
    same_name = (F.col("__key_schema_name") == F.col("__schema")) & (F.col("__key_table_name") == F.col("__table"))
    named = _keyed(manual, ["schema_name", "table_name"], counted).join(by_name.where(F.col("__id").isNull()), same_name)
    # joined on the id too: many configs may share a name
    with_id = _keyed(manual, ["schema_name", "table_name", "id"], counted).join(by_name, same_name & (F.col("__key_id") == F.col("__id")))
    scheduled = _keyed(_scheduled(active), ["cloudwatch_event_name"], counted).join(
        req.where((F.col("__manual") != "Y") & F.col("__event").isNotNull()), F.col("__key_cloudwatch_event_name") == F.col("__event")
    )
    wild = req.where((F.col("__manual") != "Y") & F.col("__event").isNull())
    # the only active scheduled config, or null
    only = _scheduled(active).select(
        F.when(F.count(F.lit(1)) == 1, F.first(F.struct(*[F.col(c) for c in configs.columns]))).alias("c")
    )
    lone = wild.select("request_id", only.scalar().alias("__c")).where("__c is not null").select("__c.*", "request_id")
    if counted:
        lone = lone.withColumn(CONFIGS, F.lit(1).cast("long"))
    out = lone.select(*cols)
    for part in (scheduled, with_id, named):
        out = part.select(*cols).unionByName(out)
    return out


def _keyed(configs: DataFrame, columns: list[str], counted: bool) -> DataFrame:
    """``configs`` with their lookup columns as ``__key_*``; ``counted``: one row per key, as ``lookup_configs`` has it."""
    keys = [F.col(c).alias(f"__key_{c}") for c in columns]
    if not counted:
        return configs.select("*", *keys)
    per_key = configs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(CONFIGS), F.first(F.struct(*[F.col(c) for c in configs.columns])).alias("__config")
    )
    one = [F.when(F.col(CONFIGS) == 1, F.col("__config").getField(c)).alias(c) for c in configs.columns]
    return per_key.select(*[f"__key_{c}" for c in columns], CONFIGS, *one)


def _scheduled(active: DataFrame) -> DataFrame:
    return active.where(F.col("manual_flag") == "N")


def config_cardinality(configs: DataFrame, request_columns: list[str]) -> DataFrame:
    """C2 over every request shape: how many configs each one would match,
    with a verdict (exactly one is ``OK``)."""
    return (
        configs.groupBy(*request_columns)
        .agg(F.count(F.lit(1)).alias("n_configs"))
        .withColumn("verdict", F.when(F.col("n_configs") == 1, "OK").otherwise("AMBIGUOUS"))
    )


def check_requests(requests: DataFrame, matches: DataFrame, configs: DataFrame) -> DataFrame:
    """C2 per request: ``MISSING`` (0), ``OK`` (1) or ``AMBIGUOUS`` (>1).

    The reference raises on anything but one match; here every request gets
    its verdict and the caller decides which to run.  ``matches`` may be those
    ``lookup_configs`` returns, ``counted`` or one by one.
    """
    found = F.sum(CONFIGS) if CONFIGS in matches.columns else F.count(F.lit(1))
    counts = matches.groupBy("request_id").agg(found.alias("n_configs"))
    everything = _scheduled(configs.where(F.col("active_flag") == "Y")).select(F.count(F.lit(1)).alias("n")).scalar()
    wild = (F.col("manual_flag") != "Y") & F.col("cloudwatch_event_name").isNull()
    n = F.when(wild, everything).otherwise(F.coalesce(F.col("n_configs"), F.lit(0))).cast("long")
    return (
        requests.join(counts, "request_id", "left")
        .withColumn("n_configs", n)
        .select(
            *requests.columns,
            "n_configs",
            F.when(F.col("n_configs") == 0, "MISSING").when(F.col("n_configs") == 1, "OK").otherwise("AMBIGUOUS").alias("verdict"),
        )
    )


def _split_trim(col: Column) -> Column:
    parts = F.transform(F.split(col, ","), lambda x: F.trim(x))
    return F.when(col.isNull() | (F.trim(col) == ""), F.lit(None)).otherwise(
        F.filter(parts, lambda x: x != "")
    )


def normalise_configs(configs: DataFrame) -> DataFrame:
    """C3 (and P10): usable parameters for every config row.

    * ``query_parameter`` defaults to `` 1=1 ``;
    * ``+`` in ``cdc_column`` becomes ``||' '||`` (concatenate with a space);
    * ``primary_keys``, ``source_partition_column`` and
      ``target_partition_column`` become trimmed arrays (empty -> null);
    * ``cdc_timestamp`` moves back by ``overlap_in_min`` minutes (P10);
    * ``target_path`` joins bucket and prefix.
    """
    out = configs
    cols = set(configs.columns)
    if "query_parameter" in cols:
        out = out.withColumn("query_parameter", F.coalesce(F.col("query_parameter"), F.lit(DEFAULT_QUERY_PARAMETER)))
    if "cdc_column" in cols:
        out = out.withColumn("cdc_column", F.regexp_replace(F.col("cdc_column"), r"\+", PLUS_REWRITE))
    for name in ("primary_keys", "source_partition_column", "target_partition_column"):
        if name in cols:
            out = out.withColumn(name, _split_trim(F.col(name)))
    if "overlap_in_min" in cols and "cdc_timestamp" in cols:
        minutes = F.trim(F.col("overlap_in_min")).try_cast("int")
        out = out.withColumn(
            "cdc_timestamp",
            F.when(
                minutes.isNotNull(),
                F.col("cdc_timestamp") - F.make_dt_interval(mins=minutes),
            ).otherwise(F.col("cdc_timestamp")),
        )
    if "curate_bucket" in cols and "curate_prefix" in cols:
        out = out.withColumn("target_path", target_path_column(F.col("curate_bucket"), F.col("curate_prefix")))
    return out
