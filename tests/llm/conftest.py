import random

import pytest

ODD_COLUMNS = "doc_id long, text string, source string, kept int, row string, body string, words int, node int"


def odd_rows():
    """Nulls, empty, blank and very long texts, repeated rows and ids."""
    draw = random.Random(3)
    long_text = " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "Çé"]) + str(draw.randrange(999)) for _ in range(30_000))
    texts = [
        (1, "One two three four five six seven eight nine ten eleven twelve"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, long_text),
        (6, long_text),
        (7, "one"),
        (8, "one two"),
        (8, "one two"),
        (9, "a b\na b\n\nc d\na b"),
        (None, "one two"),
        (None, None),
        (10, "x y z " * 40),
        (11, "日本語 テキスト 🙂 naïve #$% |<>"),
    ]
    return [(i, t, None if i == 1 else "src/a", 0, "r", "b", 1, 2) for i, t in texts]


@pytest.fixture
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD_COLUMNS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], ODD_COLUMNS)
