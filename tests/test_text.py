import random
import re

import pytest
from pyspark.sql import functions as F

from postgauge.config import FEATURES
from postgauge.functions import text as X
from postgauge.functions.keys import model_slug, run_id, slug


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [
        (None, ""),
        ("  I'm NOT ok\t\nsee https://X.y/a?b=1 now ", "i'm not ok see url_token now"),
        ("a\x00b\x7fc\x85d", "a b c d"),
        ("www.site.org/x　end", "url_token end"),
        ("no\x1cway 😀!", "no way 😀!"),
    ],
)
def test_normalize(spark, raw, wanted):
    assert one(spark, raw, X.normalize_text) == wanted


def test_title_and_body(spark):
    frame = spark.createDataFrame([("A", None), (None, "B")], "title string, text string")
    assert [r[0] for r in frame.select(X.join_title_text()).collect()] == ["A\n", "\nB"]


def brute_char(text, low=3, high=5):
    grams = []
    for word in text.split():
        padded = f" {word} "
        for n in range(low, min(high, len(padded)) + 1):
            grams += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return sorted(grams)


def brute_words(text, high):
    tokens = re.findall(r"(?:[^\W]|_){2,}", text)
    return sorted(
        " ".join(tokens[i : i + n]) for n in range(1, high + 1) for i in range(len(tokens) - n + 1)
    )


@pytest.mark.parametrize("text", ["", "a", "hola", "i am 😀😀 sad ñ no_more 12", "x y zz abcdefgh"])
def test_terms_match_direct_definition(spark, text):
    for name, high in (("word_unigram", 1), ("word_unigram_bigram", 2), ("word_unigram_trigram", 3)):
        found = one(spark, text, lambda c: X.terms(c, FEATURES[name]))
        assert sorted(found) == brute_words(text, high)
    spec = FEATURES["char_wb_3_5"]
    assert sorted(one(spark, text, lambda c: X.terms(c, spec))) == brute_char(text)
    assert sorted(one(spark, text, lambda c: X.distinct_terms(c, spec))) == sorted(set(brute_char(text)))


def test_random_char_ngrams(spark):
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("abñ😀é", k=draw.randint(1, 7))) for _ in range(9)) for _ in range(40)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", X.terms(F.col("t"), FEATURES["char_wb_3_5"]).alias("g")).collect():
        assert sorted(row["g"]) == brute_char(row["t"])


def test_fragment(spark):
    assert one(spark, " a \n b\t", X.fragment) == "a b"
    long = "x" * 316 + " " + "y" * 50
    assert one(spark, long, X.fragment) == "x" * 316 + "..."
    assert one(spark, "z" * 320, X.fragment) == "z" * 320


def test_slugs(spark):
    assert one(spark, " Fase 2B: Prueba! ", slug) == "fase-2b-prueba"
    assert one(spark, "???", slug) == "sin-nombre"
    assert one(spark, "qwen2.5:3b-instruct", model_slug) == "qwen2_5_3b_instruct"
    names = [F.lit(v) for v in ("Phase 2B", "linear_svm", "char_wb_3_5", "2026-01-02T03:04:05Z")]
    found = spark.range(1).select(run_id(*names)).first()[0]
    assert found == "phase-2b__linear-svm__char-wb-3-5__20260102-030405z"
