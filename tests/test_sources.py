import pytest
from pyspark.sql import functions as F

from postgauge.functions.labels import binary_flag
from postgauge.operators.answers import last_answers
from postgauge.operators.metrics import evaluate, metric_record
from postgauge.sources.models import load_model, save_model
from postgauge.sources.posts import prepare_posts, read_csv_columns, read_posts_csv, read_raw_posts
from postgauge.sources.results import (
    coerce_cv_summary,
    coerce_run_summary,
    read_answers,
    read_method_metrics,
    read_summary_csv,
    write_answers,
    write_table,
)

HEADER = "user_id,text_id,title,text,is_suicide\n"


def test_csv_missing_cells_and_multiline(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(HEADER + 'u1,1,None,"line one\nsaid ""hi""", YES \nu2,2,,nan,0\n', encoding="utf-8")
    rows = read_posts_csv(spark, str(path)).orderBy("text_id").collect()
    assert [(r.title, r.text, r.y) for r in rows] == [("", 'line one\nsaid "hi"', 1), ("", "", 0)]
    raw = read_raw_posts(spark, str(path))
    assert raw.columns == ["user_id", "title", "text", "is_suicide"]
    assert raw.where(F.col("text").isNull()).count() == 1


def test_missing_columns_and_bad_labels(spark):
    with pytest.raises(ValueError, match="text"):
        prepare_posts(spark.createDataFrame([("u", "1", "t", "yes")], "user_id string, text_id string, title string, is_suicide string"))
    schema = "user_id string, text_id string, title string, text string, is_suicide string"
    bad = spark.createDataFrame([("u", "1", "t", "x", "maybe"), ("u", "2", "t", "x", None)], schema)
    with pytest.raises(ValueError, match="None, maybe"):
        prepare_posts(bad)
    assert "y" not in prepare_posts(bad.drop("is_suicide"), require_label=False).columns


def test_numeric_labels(spark):
    schema = "user_id string, text_id string, title string, text string, is_suicide double"
    frame = spark.createDataFrame([("u", "1", "t", "x", 1.0), ("u", "2", "t", "x", 0.0)], schema)
    assert sorted(r.y for r in prepare_posts(frame).collect()) == [0, 1]


def test_binary_flag(spark):
    frame = spark.createDataFrame([("yes",), (" NO ",), ("1",), ("0.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in frame.select(binary_flag(F.col("v"))).collect()] == [1.0, 0.0, 1.0, 0.5, None, None]


def test_answers_round_trip(spark, tmp_path):
    rows = [("1", "u", "m", "zero_shot", '{"label":"yes"}', None, 1)]
    schema = "text_id string, user_id string, model string, prompt_mode string, raw_response string, error string, seq bigint"
    path = str(tmp_path / "answers")
    write_answers(spark.createDataFrame(rows, schema), path)
    (row,) = read_answers(spark, path).collect()
    assert row.raw_response == '{"label":"yes"}' and row.model == "m"


def test_non_text_answers_count_as_empty(spark, tmp_path):
    folder = tmp_path / "a" / "model=m" / "prompt_mode=zero_shot"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text('{"text_id":"1","raw_response":{"label":"yes"},"seq":1}\n{"text_id":"2","seq":1}\n')
    found = {r.text_id: r.raw_response for r in read_answers(spark, str(tmp_path / "a")).collect()}
    assert found == {"1": "", "2": ""}


def test_method_metrics(spark, tmp_path):
    scored = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1)], "y_true int, y_pred int, score double")
    path = str(tmp_path / "m")
    write_table(metric_record(evaluate(scored)).coalesce(1), path, "json")
    row = read_method_metrics(spark, path, False).first()
    assert row.roc_auc == 1.0 and row.confusion_matrix.true_positive == 1
    assert read_method_metrics(spark, str(tmp_path / "none"), True) is None
    with pytest.raises(FileNotFoundError):
        read_method_metrics(spark, str(tmp_path / "none"), False)
    (tmp_path / "bad.json").write_text("[1]")
    with pytest.raises(ValueError):
        read_method_metrics(spark, str(tmp_path / "bad.json"), False)


def test_summaries(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("method,representation,classifier,protocol_auc\na,b,c,0.5\n")
    assert read_summary_csv(spark, str(path)).first().protocol_auc == 0.5
    assert read_summary_csv(spark, str(tmp_path / "none.csv")) is None
    cv = spark.createDataFrame(
        [("b", "f", "0.5", "0.1", "0.4", "0.3"), ("a", "f", "x", "0", "0", "0"), ("a", "g", "0.5", "0.1", "1", "1")],
        "classifier_name string, feature_config_name string, mean_protocol_auc string, std_protocol_auc string, mean_roc_auc string, mean_f1 string",
    )
    assert [r.classifier_name for r in coerce_cv_summary(cv).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        coerce_cv_summary(cv.drop("mean_f1"))
    with pytest.raises(ValueError):
        coerce_run_summary(cv)


def test_model_round_trip(spark, small_posts, tmp_path):
    from postgauge.config import Settings
    from postgauge.plans.training import fit_model, normalized
    from postgauge.sources.posts import decode_labels

    model = fit_model(normalized(decode_labels(small_posts)), Settings(classifier="complement_nb"))
    save_model(spark, str(tmp_path), model.features, model.fit)
    features, fit = load_model(spark, str(tmp_path))
    assert features.terms == model.features.terms and features.spec == model.features.spec
    assert fit.weights.tolist() == model.fit.weights.tolist()


def test_a_log_without_numbers_is_read_in_order(spark, tmp_path):
    folder = tmp_path / "a" / "model=m" / "prompt_mode=zero_shot"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text(
        '{"text_id":"1","raw_response":"old"}\n{"text_id":"1","raw_response":"new"}\n{"text_id":"2","raw_response":"only"}\n'
    )
    last = last_answers(read_answers(spark, str(tmp_path / "a")))
    assert {r.text_id: r.raw_response for r in last.collect()} == {"1": "new", "2": "only"}


def test_a_cell_beyond_the_header_is_an_error(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('user_id,text_id,title,text\nu,1,"a, b",c\nu,2,d\n')
    rows = read_csv_columns(spark, str(path)).orderBy("text_id").collect()
    assert [(r.title, r.text) for r in rows] == [("a, b", "c"), ("d", None)]
    path.write_text("user_id,text_id,title,text\nu,1,a,b,extra\n")
    with pytest.raises(Exception, match="more cells"):
        read_csv_columns(spark, str(path)).collect()
