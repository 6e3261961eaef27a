import numpy as np
import pytest
from pyspark.sql import functions as F

from postgauge.config import CLASSIFIERS, FeatureSpec, Settings, grid_pairs
from postgauge.operators.classifiers import fit_classifier
from postgauge.operators.terms import most_frequent, term_statistics
from postgauge.operators.tfidf import entries, fit_tfidf

TEXTS = [
    ("a", 1, "dark dark night alone"),
    ("b", 1, "alone night empty"),
    ("c", 0, "sun garden friends night"),
    ("d", 0, "sun friends sun"),
    ("e", 1, "dark empty room"),
    ("f", 0, "garden sun room"),
]
SPEC = FeatureSpec("test", "word", 1, 1, 100)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "text_id string, y int, normalized string").repartition(3).cache()


def dense(terms, idf):
    rows = np.array([[t.split().count(w) for w in terms] for _, _, t in TEXTS]) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1), np.array([y for _, y, _ in TEXTS])


def test_tfidf_matches_definition(spark, docs):
    model = fit_tfidf(docs, SPEC)
    assert model.terms == sorted({"dark", "night", "alone", "empty", "sun", "garden", "friends", "room"})
    idf = np.array([np.log(7 / (1 + sum(w in t.split() for _, _, t in TEXTS))) + 1 for w in model.terms])
    wanted, _ = dense(model.terms, idf)
    cells = entries(model.transform(docs), "tfidf", ["text_id"]).collect()
    found = np.zeros_like(wanted)
    for cell in cells:
        found["abcdef".index(cell.text_id), cell.idx] = cell.tfidf
    assert np.allclose(found, wanted)


def test_unseen_text_keeps_a_zero_vector(spark, docs):
    model = fit_tfidf(docs, SPEC)
    fit = fit_classifier(model.transform(docs), "tfidf", Settings(classifier="complement_nb"))
    new = spark.createDataFrame([("x", ""), ("y", "unknown words")], "text_id string, normalized string")
    rows = fit.score(model.transform(new), "tfidf").collect()
    assert [(r.y_pred, r.score) for r in rows] == [(0, 0.5), (0, 0.5)]


def test_vocabulary_limits(spark, docs):
    with pytest.raises(ValueError):
        fit_tfidf(docs, FeatureSpec("none", "word", 1, 1, 100, min_df=5))
    with pytest.raises(ValueError):
        fit_tfidf(docs.limit(1), SPEC)
    stats = term_statistics(docs, SPEC)
    for limit in (1, 2, 3, 5):
        top = [r.term for r in most_frequent(stats, limit).collect()]
        every = sorted(stats.collect(), key=lambda r: (-r.tf, r.term))
        assert top == [r.term for r in every[:limit]]


def test_fold_statistics_subtract(spark, docs):
    folded = docs.withColumn("fold", (F.ascii("text_id") % 2 + 1).cast("int"))
    rows = {r.term: r for r in term_statistics(folded, SPEC, 2).collect()}
    plain = {r.term: r for r in term_statistics(folded.where("fold = 1"), SPEC).collect()}
    for term, row in rows.items():
        assert row.df_1 + row.df_2 == row.df and row.tf_1 + row.tf_2 == row.tf
        if term in plain:
            assert (row.df_1, row.tf_1) == (plain[term].df, plain[term].tf)


def test_char_statistics_match_direct_count(spark, docs):
    spec = FeatureSpec("c", "char_wb", 3, 5, 1000, min_df=1, max_df=1.0)
    from postgauge.operators.terms import term_occurrences

    direct = term_occurrences(docs, spec, ["text_id"]).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf")
    )
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, term_statistics(docs, spec).collect()))


@pytest.mark.parametrize("prior", [True, False])
def test_naive_bayes_closed_form(spark, docs, prior):
    model = fit_tfidf(docs, SPEC)
    x, y = dense(model.terms, model.idf)
    logs = [np.log((x[y == c].sum(0) + 1) / (x[y == c].sum(0) + 1).sum()) for c in (0, 1)]
    name = "multinomial_nb" if prior else "complement_nb"
    fit = fit_classifier(model.transform(docs), "tfidf", Settings(classifier=name))
    assert np.allclose(fit.weights, logs[1] - logs[0])
    assert fit.intercept == pytest.approx(0.0)


def objective_gradient(name, x, y, w, b):
    sign = 2 * y - 1.0
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    margin = x @ w + b
    if name == "linear_svm":
        pull = -2 * weight * np.maximum(0, 1 - sign * margin) * sign
        return np.append(w + x.T @ pull, b + pull.sum())
    pull = -weight * sign / (1 + np.exp(sign * margin))
    if name == "logistic_regression":
        return np.append(w + x.T @ pull, pull.sum())
    return np.append(1e-4 * w + x.T @ pull / len(y), pull.sum() / len(y))


@pytest.mark.parametrize("name", ["logistic_regression", "linear_svm", "sgd_logistic"])
def test_iterative_fits_are_optimal(spark, docs, name):
    uneven = docs.where("text_id <> 'f'").unionByName(docs.where("text_id = 'a'"))
    model = fit_tfidf(docs, SPEC)
    fit = fit_classifier(model.transform(uneven), "tfidf", Settings(classifier=name))
    x, y = dense(model.terms, model.idf)
    rows = [0, 1, 2, 3, 4, 0]
    gradient = objective_gradient(name, x[rows], y[rows], fit.weights, fit.intercept)
    start = objective_gradient(name, x[rows], y[rows], 0 * fit.weights, 0.0)
    assert np.abs(gradient).max() <= 2e-5 * np.abs(start).max()


def test_guards(spark, docs):
    model = fit_tfidf(docs, SPEC)
    vectors = model.transform(docs)
    for name in CLASSIFIERS:
        with pytest.raises(ValueError):
            fit_classifier(vectors.where("y = 1"), "tfidf", Settings(classifier=name))
    with pytest.raises(ValueError):
        fit_classifier(vectors, "tfidf", Settings(classifier="forest"))
    with pytest.raises(ValueError):
        Settings().with_pair("forest", "word_unigram")
    assert len(grid_pairs()) == 20
    assert grid_pairs("linear_svm", "char_wb_3_5") == [("linear_svm", "char_wb_3_5")]
