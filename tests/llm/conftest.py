from __future__ import annotations

import os
import random

import pytest


@pytest.fixture(scope="session")
def token_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def docs(spark, tables):
    return spark.read.parquet(os.path.join(tables, "documents.parquet")).cache()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(30_000))
    rows = [
        (1, "the same words stand here twice " * 10, "en", "a", 1, "x", 1),
        (2, "the same words stand here twice " * 10, "en", "a", 1, "x", 1),
        (2, "the same words stand here twice " * 10, "en", "a", 1, "x", 1),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "", 2),
        (5, " \t\n ", "en", None, 0, "", 2),
        (6, long, "en", "b", 0, "", 2),
        (None, "a text without an id", "en", "b", 0, "", 2),
        (None, None, "en", "b", 0, "", 2),
        (7, "12 + 34 = 46 ! ?", "en", "c", 0, "", 2),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, anchor string, rank int"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
