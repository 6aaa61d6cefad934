import random

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session", autouse=True)
def packaged(spark):
    from corpusprep.session import ship_package

    ship_package(spark)


def prose(rng, n, words=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(words)}é"[: rng.randint(2, 6)] for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows (doc_id, text) with nulls, empty and very long texts, ties and repeated rows, and the same as a table with clashing extra columns."""
    rng = random.Random(3)
    base = [prose(rng, rng.choice([3, 30, 80, 200])) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(30, None), (31, ""), (32, " \n\t "), (33, "one"), (34, prose(rng, 20_000)), (35, base[3]), (36, base[4] + " tail"), (None, base[5]),
             (7, base[7]), (7, base[7]), (38, "x " * 3000), (39, "é🎉漢" * 40), (40, "\n".join([base[8][:60]] * 5) + "\n" + base[9])]
    names = ["n_words", "row", "class", "text_", "c0", "n", "hits", "key"]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(n) for n in names), F.lit(None).cast("string").alias("lang"))
    return rows, df.repartition(4)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_words int")
