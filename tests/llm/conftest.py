from __future__ import annotations

import random

import pytest

#: Rows that every operator must take: nulls, empty and white-space texts, repeats, ties, a long text.
AWKWARD = [
    (None, "a text without an id", "en", "s", 1),
    (1, None, "en", "s", 0),
    (2, "", None, None, 0),
    (3, " \t\n\x0b ", "en", "s", 5),
    (4, "one two three", "en", "s", 13),
    (4, "one two three", "en", "s", 13),
    (5, "#### 1 !!! ²", "en", "s", None),
    (6, "é 中文 🙂 <|endoftext|> ß", "de", "s", 9),
    (7, "word " * 30_000, "en", "s", 150_000),
    (2**40, "The same thirteen words stand here and there and also in one more place", "en", "s", 3),
    (2**40 + 1, "The same thirteen words stand here and there and also in one more place", "en", "s", 3),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = ("id", "bucket", "score", "n", "length", "key", "word", "n_words", "tile", "path", "group")


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(AWKWARD, COLUMNS)
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def corpus(spark):
    """Random texts over few words, with exact and near copies and shared passages."""
    rng = random.Random(5)
    vocabulary = [a + b for a in "b c d f g h".split() for b in "a e i o u".split()]
    rows = []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if i % 6 == 1:
            words[len(words) // 2 : len(words) // 2] = passage[rng.randint(0, 10) : rng.randint(30, 60)]
        if i % 7 == 3 and rows:
            words = rows[-1][1].split()
        if i % 7 == 4 and rows:
            words = rows[-1][1].split()
            if words:
                words[rng.randrange(len(words))] = "changed"
        rows.append((i * 3 % 61, rng.choice([" ", "\n", "  "]).join(words), "en", "s", 0))
    return spark.createDataFrame(rows, COLUMNS), rows
