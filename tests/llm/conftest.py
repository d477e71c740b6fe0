import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def prose(seed, n, words=None):
    rng = random.Random(seed)
    words = words or ["the", "onesh", "thered", "ingly", "Ofthe", "ered", "and", "whou", "éaux", "straße", "of", "a", "thion", "ened", "rest"]
    out = []
    for k in range(n):
        out.append(rng.choice(words) + (rng.choice("aeiou") * rng.randrange(3)) + (". " if k % 9 == 8 else ", " if k % 7 == 6 else " "))
    return "".join(out).strip()


#: Texts that operators have to bear: null, empty, blank, no letters, very long, repeated.
ODD = [None, "", " ", "\n\n", "!!! 123", "x" * 50_000, prose(5, 9_000), "don't <|endoftext|> WE'LL", "a  b\tc\u3000d  ", "日本語のテキスト", "e\u0301te\u0301 ﬁ ǅ"]


def rows_of(texts):
    return [(k, t, ("en", "fr")[k % 2], "s", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts, in three partitions."""
    return lambda texts: spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark):
    """Documents with columns whose names operators might use themselves."""

    def frame(texts):
        df = spark.createDataFrame(rows_of(texts), DOCS)
        for name in ("words", "part", "guest", "key", "keys", "n", "n_tokens", "score", "copy", "rep", "h", "w", "block", "spans", "item_id", "host", "v", "c"):
            df = df.selectExpr("*", f"'clash' AS {name}")
        return df

    return frame
