from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with nulls, blanks, copies, near copies, shared passages, odd characters and one long text."""
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma.", "délta", "x", "the", "of", "ünd", "漢字", "rho,", "</s>", "it's", "12"] + [f"w{i}" for i in range(400)]
    text = lambda n, sep=" ": sep.join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(70), text(300)
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, base), (4, base), (5, base + " "), (6, text(20) + " " + passage + " " + text(20))]
    rows += [(7, passage), (8, text(49)), (9, text(3)), (10, text(3)), (11, "one"), (12, "one"), (13, text(9000, "\n"))]
    words = base.split(" ")
    for k in range(6):  # near copies: from a few words changed to many
        copy = list(words)
        for at in rng.sample(range(len(copy)), 1 + 3 * k):
            copy[at] = f"edit{k}"
        rows.append((20 + k, " ".join(copy)))
    rows += [(40 + k, text(30) + " " + passage + " " + text(30)) for k in range(5)]
    rows += [(60, text(5) + "  " + text(5) + "\n\n" + text(5) + " z"), (61, "no-words !!! ###"), (62, "!!! ### 12"), (3, base)]
    return rows


@pytest.fixture()
def documents(spark, corpus):
    """The corpus over three partitions, with columns whose names the operators also use."""
    rows = [(*r, "len", 1) for r in corpus]
    schema = StructType([*DOCUMENTS.fields, StructField("words", StringType()), StructField("n_words", LongType())])
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
