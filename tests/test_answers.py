import json

import pytest
from pyspark.sql import functions as F

from postgauge.functions import prompts
from postgauge.functions.answers import BAD_SCHEMA, NOT_JSON, NOT_OBJECT, evidence_json
from postgauge.operators import answers
from postgauge.plans.matrices import answer_matrix, answer_predictions
from postgauge.plans.training import normalized
from postgauge.sources.posts import decode_labels


def judge(spark, raw):
    frame = spark.createDataFrame([(raw,)], "raw_response string")
    return answers.validate(frame).first()


def test_accepted_answer_is_trimmed(spark):
    raw = {"label": " YES ", "score": 0.8, "evidence": [" a ", "", "b" * 300, "c", "d", "e", "f"], "justification": " x" * 400, "other": 1}
    row = judge(spark, json.dumps(raw))
    assert (row.label_pred, row.y_pred, row.score, row.error) == ("yes", 1, 0.8, None)
    assert [len(e) for e in row.evidence] == [1, 240, 1, 1, 1]
    assert len(row.justification) == 500


@pytest.mark.parametrize(
    ("raw", "score"),
    [
        ('{"label":"no","score":"0.25"}', 0.25),
        ('{"label":"no","score":true}', 1.0),
        ('{"label":"no","score":1}', 1.0),
        ('{"label":"no","score":0.5,"evidence":[]}', 0.5),
        ('{"label":"yes","score":0.1,"label":"no"}', 0.1),
    ],
)
def test_lenient_scores(spark, raw, score):
    row = judge(spark, raw)
    assert (row.label_pred, row.y_pred, row.score, row.justification) == ("no", 0, score, "")


@pytest.mark.parametrize(
    ("raw", "error"),
    [
        (None, NOT_JSON),
        ("", NOT_JSON),
        ("yes", NOT_JSON),
        ('["yes"]', NOT_OBJECT),
        ("null", NOT_OBJECT),
        ("{}", BAD_SCHEMA),
        ('{"label":"maybe","score":0.1}', BAD_SCHEMA),
        ('{"label":1,"score":0.1}', BAD_SCHEMA),
        ('{"label":"yes","score":1.4}', BAD_SCHEMA),
        ('{"label":"yes","score":null}', BAD_SCHEMA),
        ('{"label":"yes","score":"much"}', BAD_SCHEMA),
        ('{"label":"yes","score":0.1,"evidence":null}', BAD_SCHEMA),
        ('{"label":"yes","score":0.1,"evidence":["a",2]}', BAD_SCHEMA),
        ('{"label":"yes","score":0.1,"evidence":"a"}', BAD_SCHEMA),
        ('{"label":"yes","score":0.1,"justification":null}', BAD_SCHEMA),
    ],
)
def test_rejected_answers(spark, raw, error):
    row = judge(spark, raw)
    assert row.error == error
    assert (row.label_pred, row.y_pred, row.score, row.evidence, row.justification) == (None, None, None, [], "")


def test_evidence_json(spark):
    frame = spark.createDataFrame([(['a"b', "ñ"],), ([],)], "e array<string>")
    found = [r[0] for r in frame.select(evidence_json(F.col("e"))).collect()]
    assert found == [json.dumps(['a"b', "ñ"], ensure_ascii=False), "[]"]


def test_prompts(spark):
    frame = spark.createDataFrame([("p" * 7000,)], "t string")
    zero = frame.select(prompts.zero_shot_prompt(F.col("t"))).first()[0]
    assert zero.startswith("You are evaluating") and zero.endswith('Reddit post:\n"""' + "p" * 6000 + '"""')
    few = frame.select(prompts.few_shot_prompt(F.col("t"), [("yes", "e" * 2000), ("no", "f")])).first()[0]
    assert 'Example 1\nReddit post:\n"""' + "e" * 1800 + '"""\nExpected JSON:\n{"label":"yes","score":0.90,' in few
    assert few.index("Example 2") > few.index("Example 1")
    assert few.endswith('Final Reddit post:\n"""' + "p" * 6000 + '"""')
    with pytest.raises(ValueError):
        prompts.prompt_for("few_shot", F.col("t"))
    with pytest.raises(ValueError):
        prompts.prompt_for("other", F.col("t"))


@pytest.fixture(scope="module")
def posts(small_posts):
    return normalized(decode_labels(small_posts)).cache()


def test_classify_retries_then_keeps_the_error(spark, posts, tmp_path):
    log = str(tmp_path / "calls")

    def provider(model, prompt):
        with open(log, "a") as out:
            out.write(f"{abs(hash(prompt))}\n")
        if "title 13 " in prompt:
            raise RuntimeError("service away")
        return '{"label":"yes","score":0.7}' if "dark" in prompt else '{"label":"no","score":0.2}'

    found = answers.classify(posts, provider, "m", max_attempts=3).cache()
    rows = {r.text_id: r for r in found.collect()}
    assert len(rows) == 60 and rows["t13"].error == "service away" and rows["t13"].attempts == 3
    assert all(r.y_pred == r.y_true and r.attempts == 1 for k, r in rows.items() if k != "t13")
    assert len(open(log).read().split()) == 62
    stored = answers.raw_answers(found)
    again = {r.text_id: r for r in answers.replay(posts, stored).collect()}
    assert again["t00"].y_pred == 1 and again["t13"].error == NOT_JSON


def test_replay_keeps_the_last_answer(spark, posts):
    rows = [("t00", "nonsense", 1), ("t00", '{"label":"no","score":0}', 2), ("t01", '{"label":"yes","score":1}', 1), ("t01", None, 2)]
    stored = spark.createDataFrame(rows, "text_id string, raw_response string, seq int")
    found = {r.text_id: r for r in answers.replay(posts, stored).collect()}
    assert len(found) == 60
    assert found["t00"].y_pred == 0 and found["t01"].error == NOT_JSON and found["t02"].error == NOT_JSON


def test_matrix(spark, posts):
    def provider(model, prompt):
        if model == "bad" and "title 7 " in prompt:
            return "?"
        return '{"label":"yes","score":0.7}' if "dark" in prompt.rsplit('"""', 2)[1] else '{"label":"no","score":0.2}'

    long = posts.withColumn("normalized", F.concat("normalized", F.lit(" " + "x" * 90)))
    found = answer_predictions(long, long, provider, models=("good:1", "bad"))
    rows = {(r.model, r.prompt_mode): r for r in answer_matrix(found).collect()}
    assert len(rows) == 4
    assert rows["good:1", "few_shot"].roc_auc == 1.0 and rows["good:1", "zero_shot"].method == "phase3_llm_zero_shot"
    assert rows["bad", "zero_shot"].error_count == 1 and rows["bad", "zero_shot"].f1 is None
    assert rows["good:1", "few_shot"].representation == "ollama_good_1"


def test_a_later_run_wins_over_more_attempts(spark, posts):
    """A rerun with fewer attempts replaces the older answer."""
    from datetime import datetime

    def says(label):
        return lambda model, prompt: f'{{"label":"{label}","score":0.5}}'

    few = posts.where("text_id IN ('t00', 't01')")
    first = answers.classify(few, says("no"), "m", run_started=datetime(2024, 1, 1))
    old = answers.raw_answers(first).withColumn("attempt", F.lit(2))
    new = answers.raw_answers(answers.classify(few, says("yes"), "m", run_started=datetime(2024, 1, 2)))
    found = answers.replay(few, new.unionByName(old)).collect()
    assert [r.y_pred for r in found] == [1, 1]
    with pytest.raises(ValueError, match="run_started"):
        answers.last_answers(new.select("text_id", "raw_response"))
