"""Terms counted by slices of documents, and vocabularies from frequent cells."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postgauge.config import FeatureSpec
from postgauge.functions import text as X
from postgauge.operators import terms as T
from postgauge.operators.tfidf import TfidfModel, count_vectorizer


def char_grams(text):
    padded = [f" {word} " for word in text.split(" ") if word]
    return [p[i : i + n] for p in padded for n in (3, 4, 5) for i in range(len(p) - n + 1)]


def word_grams(text):
    words = [word for word in text.split(" ") if word]
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("marks", [1 << 24, 64])
def test_slices_equal_direct_counts(monkeypatch, marks):
    monkeypatch.setattr(T, "MARKS", marks)
    rng = random.Random(5)
    texts = ["".join(rng.choice("aab c dé😀ñ ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["", "a", "  ", "aaaa aaaa"]
    column, uses = pa.array(texts), dict.fromkeys((1, 2, 3), 1)
    for found, cut in (
        (T._char_counts(column, dict.fromkeys((3, 4, 5), 1)), char_grams),
        (T._word_counts(column, uses, None), word_grams),
    ):
        tf, df = Counter(), Counter()
        for text in texts:
            tf.update(cut(text))
            df.update(set(cut(text)))
        rows = [row for _, *columns in found for row in zip(*(c.tolist() for c in columns), strict=True)]
        assert sorted(rows) == sorted((term, df[term], tf[term]) for term in tf)


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(" ".join(rng.choices(words, weights, k=30)), i % 3 + 1) for i in range(200)]
    return spark.createDataFrame(rows, "normalized string, fold int").repartition(4).cache()


@pytest.mark.parametrize("folds", [0, 3])
@pytest.mark.parametrize("most", [20, 500, 100_000])
def test_rare_runs_left_out_leave_the_vocabulary(posts, folds, most):
    spec = FeatureSpec("x", "word", 1, 3, most)
    shorter = FeatureSpec("y", "word", 1, 2, 10)
    full = T.shared_statistics(posts, [spec, shorter], folds)
    stats = T.vocabulary_statistics(posts, [spec, shorter], folds)
    assert stats.count() <= full.count() and (most > 20 or stats.count() < full.count() / 2)
    for bit, one in enumerate((spec, shorter)):
        for fold in range(folds + 1):
            sides = []
            for frame in (stats, full):
                own, n_docs = T.of_spec(frame, bit), T.counted_documents(frame)
                if fold:
                    own = own.withColumns({c: F.col(c) - F.col(f"{c}_{fold}") for c in ("df", "tf")})
                    n_docs = posts.where(F.col("fold") != fold).count()
                kept = T.most_frequent(T.kept_terms(own, one, n_docs), one.max_features)
                sides.append(sorted(map(tuple, kept.select("term", "df", "tf").collect())))
            assert sides[0] == sides[1]


def test_floor_is_lowered_until_the_vocabulary_is_full(posts, monkeypatch):
    monkeypatch.setattr(T, "CELLS", 4096)
    spec = FeatureSpec("x", "word", 1, 3, 900)
    full = T.shared_statistics(posts, [spec])
    found = [
        T.most_frequent(T.kept_terms(T.of_spec(stats, 0), spec, 200), 900).collect()
        for stats in (T.vocabulary_statistics(posts, [spec]), full)
    ]
    assert sorted(map(tuple, found[0])) == sorted(map(tuple, found[1])) and len(found[0]) == 900


def test_character_vectors_equal_the_library_count(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE_CHARS", 40)
    spec = FeatureSpec("c", "char_wb", 3, 5, 100, 1, 1.0)
    texts = ["ab abc abc", "", "a", "ñandú 😀x😀 ab", "zz " * 70 + "q", "x  y", "𝒳𝒴𝒵"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 20)], "i int, normalized string")
    grams = sorted({r[0] for r in docs.select(F.explode(X.terms(F.col("normalized"), spec))).collect()})
    known = [g for k, g in enumerate(grams) if k % 4]
    model = TfidfModel(spec, 1, known, np.ones(len(known)), np.ones(len(known)))
    library = count_vectorizer(spark, known, "_terms", "want")
    rows = library.transform(model.counts(docs).withColumn("_terms", X.terms(F.col("normalized"), spec)))
    found = rows.select("counts", "want").collect()
    assert len(found) == 140 and any(r["want"].numNonzeros() for r in found)
    assert all(r["counts"] == r["want"] for r in found)
    plan = model.counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
