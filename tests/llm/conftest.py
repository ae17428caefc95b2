from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, digest string, doc string, fp string, `row` long, `group` string, score string, ids string, tokens string, n string"


def prose(rng: random.Random, n: int, words: str) -> str:
    return " ".join(rng.choice(words.split()) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    extra = ("x", "y", "z", 7, None, "s", "i", "t", "n")
    texts = [
        (1, "One two three four five six seven.\nOne two three four five six seven.", "en", "a"),
        (1, "One two three four five six seven.\nOne two three four five six seven.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n\x0b\x0c\r ", "en", None),
        (None, "No id here, and a long enough text to tell.", "en", "a"),
        (None, "No id here, and a long enough text to tell.", None, "b"),
        (5, prose(rng, 60_000, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), "en", "b"),
        (6, "x" * 20_000, "fr", "b"),
        (7, "one  two three four\tfive six seven.\none two three four five six seven.", "fr", "b"),
        (8, "onetwothreefourfivesixseven.onetwothreefourfivesixseven.", "fr", "b"),
        (9, "12345 !!! ###", "fr", "b"),
        (10, "a\0b ▁ é 漢字 😀   ſK", "de", "c"),
    ]
    return [(*t, *extra) for t in texts]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
