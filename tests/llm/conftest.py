import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """Documents with copies, near copies, shared passages, odd blanks, nulls, empty and long texts, a repeated row and a repeated id."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 15, 25, 60, 200])) for _ in range(60)]
    shared = prose(rng, 55)
    texts = base + [base[3].upper(), base[3], base[5] + " tail", base[7].replace(" ", "\t\n ", 1)]
    texts += [f"{prose(rng, 30)} {shared} {prose(rng, 10)}" for _ in range(6)] + [shared + " " + shared]
    long = base[9].split() * 3
    long[40] = "changed"
    texts += [" ".join(long), prose(rng, 3000), "", None, "   \t", "!!! ...", "é ü ß ñ", "ÀÉ ABC", "x" * 5000, "same", "same", "Same"]
    rows = [(i * 3, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[4], (rows[5][0], "another text under one id", None, None, None), (None, base[3], None, None, None), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5).withColumns({"id": F.lit(1), "size": F.lit("x"), "place": F.lit(2), "n": F.lit(0)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
