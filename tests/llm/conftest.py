import random

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997} and" for i in range(20_000))

#: Columns that operators use inside, as extra columns of the input.
CLASHING = ("row", "id", "key", "digest", "tokens", "label", "run", "range", "words", "group", "found", "item")


@pytest.fixture(scope="session")
def prose():
    """Made-up sentences, the same in every run."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(3000)]

    def text(words: int, seed: int) -> str:
        own = random.Random(seed)
        return " ".join(own.choice(vocabulary) for _ in range(words))

    return text


@pytest.fixture(scope="session")
def make_docs(spark):
    def build(rows, extra=False):
        names = ["doc_id", "text", *(CLASHING if extra else ())]
        schema = T.StructType(
            [T.StructField("doc_id", T.LongType())] + [T.StructField(n, T.StringType()) for n in names[1:]]
        )
        return spark.createDataFrame([(i, t, *(["x"] * len(CLASHING) if extra else [])) for i, t in rows], schema)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null id, null and empty texts, white space only, a very long text, repeated rows, ties."""
    return [
        (1, "plain text of a few words here"), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (6, LONG), (None, "no id at all in this row"),
        (7, "plain text of a few words here"), (8, "twice the same row is given"), (8, "twice the same row is given"), (9, "!!! ---"),
    ]


@pytest.fixture(scope="session")
def make_labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build
