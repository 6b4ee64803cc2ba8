from __future__ import annotations

import random
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def texts(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture
def docs(spark):
    """A table of (doc_id, text) with further columns whose names the operators use themselves."""

    def make(rows, partitions: int = 2):
        full = [(i, t, "en", "s", 1, "x", 7, 7, "y") for i, t in rows]
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, hash string, n int, score int, block string"
        )
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, a very long text and signs of many kinds."""
    rnd = random.Random(5)
    long = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta."]) + str(rnd.randint(0, 400)) for _ in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (None, "one text without an id"), (None, None), (5, "a"), (5, "a"), (6, "A"), (7, long),
        (8, long), (9, "日本語 テキスト　です 。"), (10, "x" * 5000), (11, "one two three four five six seven eight nine ten."),
        (12, "one two three four five six seven eight nine ten."), (13, "é́  <s> <|endoftext|> ▁▁ \x00 end"),
    ]
