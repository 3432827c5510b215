import pytest

from made_up import WORDS


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text, lang, source) rows."""

    def make(rows, **extra):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        for name, value in extra.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


@pytest.fixture
def prose():
    """Made-up text of n words, the same for the same seed."""
    import random

    def make(seed, n, words=WORDS):
        rnd = random.Random(str(seed))
        return " ".join(rnd.choice(words) for _ in range(n))

    return make
