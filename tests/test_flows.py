import pytest
from pyspark.sql import functions as F

from postgauge.config import Settings
from postgauge.operators import comparison, selection, splitting, tracking
from postgauge.plans.cross_validation import cross_validate
from postgauge.plans.experiments import run_grid
from postgauge.plans.training import (
    evaluate_stored,
    fit_model,
    normalized,
    predict_test_fold,
    train_and_validate,
)
from postgauge.sources.posts import decode_labels
from postgauge.sources.results import read_method_metrics, read_run_summary

CNB = Settings(classifier="complement_nb", features="word_unigram")


@pytest.fixture(scope="module")
def posts(small_posts):
    return decode_labels(small_posts).cache()


def test_train_write_and_evaluate_stored(spark, posts, tmp_path):
    done = train_and_validate(posts, CNB)
    assert {r.split for r in done.predictions.collect()} == {"validacion"}
    assert done.metrics.first().protocol_auc == 1.0
    sections = {r.section for r in done.report.select("section").distinct().collect()}
    assert sections == {"terminos_asociados_a_yes", "terminos_asociados_a_no"}
    done.write(str(tmp_path))
    stored = read_method_metrics(spark, str(tmp_path / "metrics.json"), False).first()
    assert stored.confusion_matrix.labels == ["no", "yes"]
    again = evaluate_stored(posts.drop("y", "is_suicide"), str(tmp_path / "model"))
    assert again.metrics is None and again.predictions.columns == ["text_id", "user_id", "y_pred", "score", "split"]
    sections = {r.section for r in again.report.select("section").distinct().collect()}
    assert "predicciones_alta_confianza" in sections


def test_test_fold_labels_are_withheld(spark, posts, small_posts):
    held = predict_test_fold(posts, small_posts, CNB)
    assert held.predictions.columns == ["text_id", "user_id", "y_pred", "label_pred", "score"]
    assert held.metrics is None
    assert held.diagnosis.first().labels_used_for_evaluation is False
    shown = predict_test_fold(posts, small_posts, CNB, evaluate_labels=True)
    assert shown.predictions.columns[-1] == "y_true" and shown.metrics.first().roc_auc is not None
    with pytest.raises(ValueError):
        predict_test_fold(posts, small_posts.drop("is_suicide"), CNB, evaluate_labels=True)


def test_grid_records_success_and_failure(spark, posts, tmp_path):
    base = str(tmp_path / "runs")
    pairs = [("complement_nb", "word_unigram"), ("multinomial_nb", "word_unigram")]
    summary, failures = run_grid(posts, pairs, base, CNB, "Prueba 1", with_model=False)
    rows = summary.collect()
    assert summary.columns == list(tracking.SUMMARY_COLUMNS) and not failures
    assert {r.status for r in rows} == {"completed"} and all(r.protocol_auc is not None for r in rows)
    assert all(r.run_id.startswith("prueba-1__") for r in rows)
    one_class = posts.where("y = 1")
    summary, failures = run_grid(one_class, pairs[:1], base, CNB, "mala", continue_on_error=True)
    assert [f[:2] for f in failures] == pairs[:1]
    assert sorted(r.status for r in summary.collect()) == ["completed", "completed", "failed"]
    with pytest.raises(ValueError):
        run_grid(one_class, pairs[:1], base, CNB, "mala")
    with pytest.raises(ValueError):
        run_grid(posts, pairs, base, CNB, run="x")
    assert read_run_summary(spark, str(tmp_path / "none")).count() == 0


def test_cross_validation_equals_separate_fits(spark, posts):
    """Shared fold features give what a fit on each training side alone gives."""
    folded = splitting.tag_folds(posts, splitting.assign_folds(posts, 3, 42))
    docs = normalized(folded).select("user_id", "y", "normalized", "fold", "text_id").cache()
    pairs = [("complement_nb", "word_unigram"), ("logistic_regression", "word_unigram"), ("multinomial_nb", "char_wb_3_5")]
    found = cross_validate(docs, pairs, 3)
    rows = found.collect()
    assert found.columns == list(selection.FOLD_COLUMNS) and len(rows) == 9
    for row in rows:
        assert row.user_overlap_count == 0 and row.train_rows + row.validation_rows == 60
        alone = fit_model(docs.where(F.col("fold") != row.fold), CNB.with_pair(row.classifier_name, row.feature_config_name))
        held = alone.score(docs.where(F.col("fold") == row.fold))
        tp = held.where("y = 1 and y_pred = 1").count()
        tn = held.where("y = 0 and y_pred = 0").count()
        assert (row.true_positive, row.true_negative) == (tp, tn)
    summary = selection.summarise_folds(found, 3)
    assert summary.columns == list(selection.SUMMARY_CV_COLUMNS)
    assert selection.require_best(summary).count() == 1


def fold_rows(spark, rows):
    zero = {c: 0 for c in selection.FOLD_COLUMNS}
    full = [{**zero, **dict(zip(("classifier_name", "feature_config_name", "fold", "protocol_auc"), r))} for r in rows]
    columns = [
        f"{c} {'string' if c in tracking.PAIR else 'double' if c in selection.METRICS else 'bigint'}"
        for c in selection.FOLD_COLUMNS
    ]
    data = [tuple(float(r[c]) if c in selection.METRICS and r[c] is not None else r[c] for c in selection.FOLD_COLUMNS) for r in full]
    return spark.createDataFrame(data, ", ".join(columns))


def test_summary_statistics_and_ranking(spark):
    rows = [("b", "f", 1, 0.6), ("b", "f", 2, 0.8), ("a", "f", 1, 0.7), ("c", "f", 1, None), ("a", "g", 1, 0.7)]
    summary = selection.summarise_folds(fold_rows(spark, rows), 2).collect()
    assert [(r.classifier_name, r.feature_config_name) for r in summary] == [("a", "f"), ("a", "g"), ("b", "f"), ("c", "f")]
    assert summary[0].std_protocol_auc == 0.0 and summary[2].std_protocol_auc == pytest.approx(0.1414213562)
    assert summary[3].mean_protocol_auc is None and summary[3].std_protocol_auc is None
    empty = fold_rows(spark, rows[3:4])
    with pytest.raises(ValueError):
        selection.require_best(selection.summarise_folds(empty, 2))


def test_latest_runs_prefer_unreadable_times(spark):
    base = {c: None for c in tracking.SUMMARY_COLUMNS}

    def run(run_id, classifier, status, started, auc):
        return {**base, "run_id": run_id, "classifier_name": classifier, "feature_config_name": "f", "status": status, "started_at": started, "protocol_auc": auc}

    rows = [
        run("1", "a", "completed", "2026-01-01T00:00:00Z", 0.9),
        run("2", "a", "completed", "2026-02-01T00:00:00Z", 0.6),
        run("3", "b", "completed", "2026-02-01T00:00:00Z", 0.5),
        run("4", "b", "completed", "soon", 0.7),
        run("5", "c", "failed", "2026-02-01T00:00:00Z", 0.8),
        run("6", "c", "completed", "2026-02-01T00:00:00Z", None),
    ]
    text = ("run_id", "status", "experiment_name", "classifier_name", "feature_config_name", "started_at", "completed_at")
    schema = ", ".join(f"{c} {'string' if c in text else 'double'}" for c in tracking.SUMMARY_COLUMNS)
    frame = spark.createDataFrame([tuple(r[c] for c in tracking.SUMMARY_COLUMNS) for r in rows], schema)
    assert [r.run_id for r in tracking.latest_runs(frame).collect()] == ["4", "2"]
    counts = tracking.run_counters(frame).first()
    assert (counts.registered, counts.completed, counts.pairs, counts.best_protocol_auc) == (6, 5, 2, 0.7)
    with pytest.raises(ValueError):
        tracking.require_comparable(tracking.latest_runs(frame.where("status = 'failed'")))


def test_combined_methods_keep_the_last_row(spark):
    schema = "method string, representation string, classifier string, protocol_auc double"
    first = spark.createDataFrame([("m", "r", "c", 0.1), ("m", "r", "d", 0.2)], schema)
    second = spark.createDataFrame([("m", "r", "c", 0.3, 5)], schema + ", error_count int")
    rows = {r.classifier: r for r in comparison.combine_methods([first, second]).collect()}
    assert rows["c"].protocol_auc == 0.3 and rows["c"].error_count == 5 and rows["d"].error_count is None
    with pytest.raises(ValueError):
        comparison.combine_methods([])


def test_cross_validation_of_posts_is_written(spark, posts, tmp_path):
    from postgauge.plans.cross_validation import cross_validate_posts

    path = str(tmp_path / "cv")
    pairs = [("complement_nb", "word_unigram"), ("multinomial_nb", "word_unigram")]
    done = cross_validate_posts(posts, pairs, 3, CNB, path)
    assert done.folds.count() == 6 and done.summary.count() == 2 and done.best.count() == 1
    users = spark.read.parquet(f"{path}/fold_assignment")
    assert users.count() == posts.select("user_id").distinct().count()
    rows = spark.read.option("header", True).csv(f"{path}/fold_results").collect()
    assert len(rows) == 6 and all(r.user_overlap_count == "0" for r in rows)
    assert spark.read.json(f"{path}/best.json").first().classifier_name in ("complement_nb", "multinomial_nb")
