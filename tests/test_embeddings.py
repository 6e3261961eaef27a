import pytest

from postgauge.operators import embeddings as E
from postgauge.plans.matrices import embedding_matrix
from postgauge.plans.training import normalized
from postgauge.sources.embedding_store import append_store, read_store
from postgauge.sources.posts import decode_labels


@pytest.fixture(scope="module")
def posts(small_posts):
    return normalized(decode_labels(small_posts)).cache()


def test_stored_vectors_are_reused(spark, posts, tmp_path):
    log, path = tmp_path / "calls", str(tmp_path / "store")

    def provider(model, text):
        with open(log, "a") as out:
            out.write("x\n")
        return [float(len(text)), 1.0]

    first, fresh = E.embed(posts, read_store(spark, path), provider, "m", 20)
    assert {len(r.embedding) for r in first.collect()} == {2}
    append_store(fresh, path)
    again, none = E.embed(posts, read_store(spark, path), provider, "m", 20)
    assert again.count() == 60 and none.count() == 0
    assert len(log.read_text().split()) == 60
    append_store(fresh, path)
    assert E.embed(posts, read_store(spark, path), provider, "m", 20)[0].count() == 60
    # Another model, or another cut of the text, is not served from the store.
    requests = E.embedding_requests(posts, "other", 20)
    assert E.cache_misses(requests, read_store(spark, path)).count() == 60
    assert E.cache_misses(E.embedding_requests(posts, "m", 10), read_store(spark, path)).count() == 60


def test_vector_checks(spark, posts):
    empty = read_store(spark, "/nonexistent/store")
    with pytest.raises(ValueError, match="different lengths"):
        E.embed(posts, empty, lambda m, t: [1.0] * (1 + len(t) % 2), "m")
    with pytest.raises(ValueError, match="no posts"):
        E.embed(posts.where("y > 5"), empty, lambda m, t: [1.0], "m")
    bad = spark.createDataFrame([("t1", "m", "h", [])], E.CACHE_SCHEMA)
    with pytest.raises(ValueError, match="t1"):
        E.check_vectors(bad)


def test_dense_matrix(spark, posts):
    def provider(model, text):
        return [1.0 if "dark" in text else -1.0, 0.5]

    vectors, _ = E.embed(posts, read_store(spark, "/nonexistent/store"), provider, "m")
    rows = {r.classifier: r for r in embedding_matrix(vectors, vectors).collect()}
    assert list(sorted(rows)) == ["linear_svm", "logistic_regression", "sgd_logistic"]
    assert all(r.protocol_auc == 1.0 and r.roc_auc == 1.0 for r in rows.values())
    with pytest.raises(ValueError):
        E.fit_dense(vectors, "complement_nb")
