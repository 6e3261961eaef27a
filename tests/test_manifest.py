"""The incremental run summary, and proof that withheld labels are never read."""

import json
import os

import pytest
from pyspark.sql import functions as F

from postgauge.config import Settings
from postgauge.plans.experiments import run_grid
from postgauge.plans.training import FittedModel, normalized, predict_test_fold, withholds, write_test_fold
from postgauge.sources.posts import decode_labels
from postgauge.sources.results import read_run_summary
from postgauge.sources.run_manifest import stored_run_summary, update_run_summary

CNB = Settings(classifier="complement_nb", features="word_unigram")


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_updates_read_new_runs_only_and_equal_a_rebuild(spark, small_posts, tmp_path):
    base, path = str(tmp_path / "runs"), str(tmp_path / "summary")
    posts = decode_labels(small_posts).cache()
    assert stored_run_summary(spark, path).count() == 0
    empty, read = update_run_summary(spark, base, path)
    assert empty.count() == read == 0
    run_grid(posts, [("complement_nb", "word_unigram")], base, CNB, "one", with_model=False)
    found, read = update_run_summary(spark, base, path)
    assert read == 1 and rows(found) == rows(read_run_summary(spark, base))
    run_grid(posts, [("multinomial_nb", "word_unigram")], base, CNB, "two", with_model=False)
    try:
        run_grid(posts.where("y = 1"), [("complement_nb", "word_unigram")], base, CNB, "bad", with_model=False)
    except Exception:  # noqa: BLE001 - a failed run leaves its record
        pass
    found, read = update_run_summary(spark, base, path)
    assert read == 2 and rows(found) == rows(read_run_summary(spark, base))
    assert {r.status for r in found.collect()} == {"completed", "failed"}
    found, read = update_run_summary(spark, base, path)
    assert read == 0 and rows(found) == rows(stored_run_summary(spark, path)) == rows(read_run_summary(spark, base))
    # A generation that was not finished is no table.
    os.makedirs(f"{path}/generation=99")
    assert rows(stored_run_summary(spark, path)) == rows(found)


def test_changed_and_deleted_runs(spark, tmp_path):
    base, path = tmp_path / "runs", str(tmp_path / "summary")
    for name in ("a", "b"):
        (base / name).mkdir(parents=True)
        (base / name / "run_metadata.json").write_text(json.dumps({"run_id": name, "status": "failed"}))
    assert update_run_summary(spark, str(base), path)[1] == 2
    (base / "a" / "run_metadata.json").write_text(json.dumps({"run_id": "a", "status": "completed"}))
    os.utime(base / "a" / "run_metadata.json", (2e9, 2e9))
    (base / "b" / "run_metadata.json").write_text("{}")
    os.utime(base / "b" / "run_metadata.json", (2e9, 2e9))
    found, read = update_run_summary(spark, str(base), path)
    assert read == 2 and sorted((r.run_id or "", r.status or "") for r in found.collect()) == [("", ""), ("a", "completed")]


def test_plans_that_read_a_label_are_caught(spark, small_posts, tmp_path):
    small_posts.write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    assert withholds(stored.select("user_id", "title"), "is_suicide")
    assert not withholds(stored.where(F.col("is_suicide") == "yes").select("user_id"), "is_suicide")
    train = decode_labels(small_posts)
    held = predict_test_fold(train, stored, CNB)
    assert held.diagnosis.first().labels_withheld is True
    shown = predict_test_fold(train, stored, CNB, evaluate_labels=True)
    assert shown.diagnosis.first().labels_withheld is False
    assert rows(held.predictions) == rows(shown.predictions.drop("y_true"))


def test_the_record_of_a_test_fold(spark, small_posts, tmp_path):
    train = decode_labels(small_posts)
    for labels, models in ((True, True), (False, False)):
        path = str(tmp_path / f"fold{labels}")
        write_test_fold(predict_test_fold(train, small_posts, CNB, labels), path, "in/train", "in/test", models)
        record = spark.read.json(f"{path}/metadata.json").first()
        assert (record.train_input, record.test_input, record.predictions_out) == ("in/train", "in/test", f"{path}/predictions")
        assert record.timestamp.endswith("Z") and record.train_rows == record.test_rows == 60
        assert record.metrics_out == (f"{path}/metrics.json" if labels else None)
        assert record.model_out == (f"{path}/model" if models else None)
        assert record.labels_present_in_test_fold and record.labels_used_for_evaluation is labels
        assert record.diagnostics.unique_test_users == 20 and record.diagnostics.test_label_yes == 20
        assert record.ethical_note and record.test_label_usage_note
        assert os.path.isdir(f"{path}/model") is models


def test_a_fold_whose_predictions_need_the_label_is_refused(spark, small_posts, tmp_path, monkeypatch):
    small_posts.write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    monkeypatch.setattr("postgauge.plans.training.WITHHELD", ())
    score = FittedModel.score
    monkeypatch.setattr(FittedModel, "score", lambda self, posts: score(self, posts).withColumn("y_pred", (F.col("is_suicide") == "yes").cast("int")))
    with pytest.raises(RuntimeError, match="label"):
        predict_test_fold(decode_labels(small_posts), stored, CNB)
    assert normalized(stored).count() == 60
