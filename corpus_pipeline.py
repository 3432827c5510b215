"""The corpus pipeline: documents in, a mixed and sharded training set out.

Five stages, each over all rows its predecessor kept:

1. language ID: rows that the language models reject go (texts without a
   letter, and texts in none of the known languages);
2. near-dedup: of each group of near-duplicates (five-word shingles, Jaccard
   similarity 0.8 or more) the row with the smallest id stays; texts without
   words are no near-duplicates of anything;
3. decontamination: documents into which a test item of ``benchmark`` leaks go;
4. mixing: the sources reach their target shares of words; a document taken n
   times becomes n equal rows, one taken 0 times goes;
5. sharding: rows are ordered by key and cut into shards of nearly equal bytes.

Stages 1 to 4 return the columns of ``documents`` with the values they came
with, further columns included, whatever their names; the last adds size,
text_crc32, shard and slot, which replace input columns of these names.

Defined results: null and empty texts have no letter and go in stage 1; a null
id or source is a value like any other; rows that repeat are one document in
stage 2, which keeps one of them; an empty table gives an empty result; texts
of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import contamination, langid, mixing, neardup, sharding
from sluice.llm.common import table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.filter_known(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each_group(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES = [
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: Language models and MinHash bands have no SQL form; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs


def stored(docs: DataFrame) -> DataFrame:
    """``docs`` written as Parquet in the shared folder and read again."""
    from sluice.plans.scratch import scratch_path

    path = scratch_path(docs.sparkSession, "pipeline")
    docs.write.parquet(path)
    return docs.sparkSession.read.parquet(path)
