"""Fixtures for the training-data operators: rows with every awkward case."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 5000}" for i in range(120_000))
#: names that operators use inside or return; extra columns may have them too
CLASHES = "id row rest key word h n class class_id kept score predicted length piece start salt copies rate n_tokens bands weight hi lo batch order label _id _label _text text_ n_lines n_dropped drops rank offset".split()
ROWS = [
    (1, "Hello world, this is a text.\nwith two lines"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "hello World, this is a text.\nwith two lines"),
    (5, "hello World, this is a text.\nwith two lines"),
    (None, "no id here at all"),
    (7, "é́ 日本語 <|endoftext|> it's 'S .,\t\x0b"),
]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
