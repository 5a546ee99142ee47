import random

import pytest
from llm_cases import PASSAGE, SF, make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties, repeated rows, copies, unusual characters."""
    rng = random.Random(7)
    long_text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(3000)) for _ in range(30_000))
    return [
        (1, None, None), (2, "", "en"), (3, " \t\n\x0b\x0c\r ", None), (4, "a", "en"),
        (5, PASSAGE, "en"), (6, PASSAGE, "fr"), (6, PASSAGE, "fr"), (7, "Intro words here\n" + PASSAGE, None),
        (8, long_text, "en"), (9, long_text + " tail", "en"), (10, "x" * 60_000, None), (11, "7" * 40_000, None),
        (None, PASSAGE, "en"), (None, "a text without an id, long enough to be a line\nsecond line of it", None),
        (12, "a text without an id, long enough to be a line\nsecond line of it", "de"),
        (13, "naïve café — 日本語 😀  ▁ end", None), (14, "line one is here\nLINE ONE IS HERE \nline two is here", "en"),
        (15, "<s> </s> <unk> <|endoftext|> \x00 ok", None), (-5, "Line one is here", "en"),
        (16, "mail a.b@c.org from 10.0.0.255, card 4539 1488 0343 6467, call +49 (30) 123-4567", "de"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make(spark, odd_rows)


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, [])


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def corpus_rows(corpus):
    return [tuple(r) for r in corpus.select("doc_id", "text", "lang").collect()]
