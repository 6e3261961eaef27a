"""Flows over stored state: answer log, embedding store, grouped calls and the comparison."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postgauge.config import AnswerSettings
from postgauge.operators import embeddings as E
from postgauge.operators.providers import Limits, batched, call_all, groups
from postgauge.plans import answer_runs
from postgauge.plans.answer_runs import AnswerRun, run_answers
from postgauge.plans.comparison_runs import compare_methods, run_embeddings, write_comparison
from postgauge.plans.training import normalized
from postgauge.sources.embedding_store import append_store, compact_store, read_store
from postgauge.sources.posts import decode_labels
from postgauge.sources.results import read_answers


@pytest.fixture(scope="module")
def posts(small_posts):
    return normalized(decode_labels(small_posts)).cache()


def test_groups_keep_places_and_bounds():
    texts = ["x" * n for n in (9, 1, 30, 4, 4, 2, 8)]
    limits = Limits(items=3, chars=10)
    found = list(groups(texts, limits))
    assert sorted(i for g in found for i in g) == list(range(7))
    assert all(len(g) <= 3 and (len(g) == 1 or sum(len(texts[i]) for i in g) <= 10) for g in found)
    calls = []

    def provider(model, some):
        calls.append(len(some))
        if any(len(t) == 4 for t in some):
            raise RuntimeError("four")
        return [len(t) for t in some]

    answers, failures = call_all(provider, "m", texts, limits)
    assert answers == [9, 1, 30, None, None, 2, 8]
    assert [f is not None for f in failures] == [False, False, False, True, True, False, False]
    assert len(calls) <= len(found) + len(texts)
    short, failed = call_all(lambda m, t: [1], "m", ["a", "b"], limits)
    assert short == [1, 1] and failed == [None, None]
    assert call_all(batched(lambda m, t: t.upper()), "m", ["a", "bb"]) == (["A", "BB"], [None, None])


def calls_of(folder):
    return Counter(line for name in os.listdir(folder) for line in (folder / name).read_text().splitlines())


def test_broken_run_asks_for_nothing_twice(spark, posts, tmp_path, monkeypatch):
    monkeypatch.setattr(answer_runs, "TASK_REQUESTS", 4)
    folder, flag = tmp_path / "calls", tmp_path / "broken"
    folder.mkdir()
    test = posts.where("text_id < 't20'")

    def provider(model, prompts):
        for prompt in prompts:
            if model == "b" and "word5" in prompt and not flag.exists():
                flag.write_text("x")
                os._exit(1)
        with open(folder / f"{os.getpid()}", "a") as out:
            out.writelines(f"{model} {abs(hash(p))}\n" for p in prompts)
        bad = lambda p: "word3" in p and model == "a"
        return ["no json" if bad(p) else '{"label":"yes","score":0.9}' for p in prompts]

    monkeypatch.setenv("PYTHONHASHSEED", "0")
    run = AnswerRun(provider, str(tmp_path / "run"), AnswerSettings(), ("a", "b"), ("zero_shot",), limits=Limits(2))
    with pytest.raises(Exception, match=r"."):
        run_answers(posts, test, run)
    assert flag.exists()
    first = read_answers(spark, run.log_path)
    assert first.where("model = 'a'").count() > test.count()
    predictions, summary = run_answers(posts, test, run)
    log = read_answers(spark, run.log_path).collect()
    attempts = Counter((r.model, r.text_id, r.attempt) for r in log)
    assert set(attempts.values()) == {1}
    bad = {r.text_id for r in test.where("normalized LIKE '%word3%'").collect()}
    assert {k for k in attempts if k[2] == 2} == {("a", i, 2) for i in bad} and max(k[2] for k in attempts) == 2
    assert len(log) == 2 * test.count() + len(bad)
    assert predictions.count() == 2 * test.count()
    rows = {r.model: r for r in summary.collect()}
    assert rows["a"].error_count == len(bad) and rows["a"].f1 is None and rows["b"].f1 is not None
    before = sum(calls_of(folder).values())
    run_answers(posts, test, run)
    assert sum(calls_of(folder).values()) == before


def test_few_shot_examples_are_written_with_their_origin(spark, posts, tmp_path):
    long = posts.withColumn("normalized", F.concat("normalized", F.repeat(F.lit(" more words"), 10)))
    run = AnswerRun(batched(lambda m, p: '{"label":"no","score":0.1}'), str(tmp_path), AnswerSettings(), ("m",), ("few_shot",))
    predictions, _ = run_answers(long, long.drop("y").limit(3), run)
    assert predictions.count() == 3 and "y_true" not in predictions.columns
    rows = spark.read.json(f"{tmp_path}/few_shot_examples").collect()
    assert len(rows) == 6 and {r.random_state for r in rows} == {42} and all(r.timestamp and r.text_id for r in rows)


def test_store_reads_touched_shelves_and_compacts(spark, posts, tmp_path):
    path = str(tmp_path / "store")
    requests = E.embedding_requests(posts, "m", 50)
    vectors = requests.select(*E.CACHE_KEY, F.array(F.length("cut").cast("double")).alias("embedding"))
    append_store(vectors, path)
    append_store(vectors, path)
    assert read_store(spark, path).count() == 120
    one = requests.where("text_id = 't07'")
    some = read_store(spark, path, one)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shelf" in plan or "PartitionFilters: [(shelf" in plan
    assert some.where("text_id = 't07'").count() == 2 and some.count() < 12
    compact_store(spark, path)
    assert sorted(map(tuple, read_store(spark, path).collect())) == sorted(map(tuple, vectors.collect()))
    os.makedirs(f"{path}/generation=9/shelf=1")
    assert read_store(spark, path).count() == 60
    append_store(vectors.limit(1), path)
    assert read_store(spark, path).count() == 61


def test_dense_run_from_posts_stores_and_compares(spark, posts, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()

    def provider(model, texts):
        with open(folder / f"{os.getpid()}", "a") as out:
            out.writelines(f"{len(t)}\n" for t in texts)
        return [[1.0 if "dark" in t else -1.0, 0.5] for t in texts]

    path = str(tmp_path / "dense")
    train, test = posts.where("text_id < 't40'"), posts.where("text_id >= 't40'")
    _, summary = run_embeddings(train, test, provider, path, limits=Limits(4))
    assert sum(calls_of(folder).values()) == 60
    assert {r.classifier: r.f1 for r in summary.collect()} == {"linear_svm": 1.0, "logistic_regression": 1.0, "sgd_logistic": 1.0}
    run_embeddings(train, test.drop("y"), provider, path, limits=Limits(4))
    assert sum(calls_of(folder).values()) == 60
    assert compare_methods(spark, {}, [f"{path}/summary"]).count() == 3


def record(f1):
    cells = {"labels": ["no", "yes"], "true_negative": 1, "false_positive": 2, "false_negative": 3, "true_positive": 4}
    return {"protocol_auc": 0.5, "roc_auc": 0.6, "recall": 0.7, "precision": 0.8, "f1": f1, "confusion_matrix": cells}


def test_comparison_of_unlike_sources(spark, tmp_path):
    paths = {name: str(tmp_path / f"{name}.json") for name in ("baseline", "embeddings", "answers")}
    for number, name in enumerate(("baseline", "answers")):
        (tmp_path / f"{name}.json").write_text(json.dumps(record(number / 10)))
    table = tmp_path / "s.csv"
    table.write_text(
        "method,representation,classifier,model,error_count,f1\n"
        "phase3_llm_zero_shot,ollama_qwen2.5_3b_instruct,zero_shot_prompt,q,2,0.3\n"
        "phase3_llm_zero_shot,ollama_qwen2.5_3b_instruct,zero_shot_prompt,q,0,0.9\n"
        "other,r,c,q,1,0.2\n"
    )
    with pytest.raises(FileNotFoundError):
        compare_methods(spark, paths)
    found = compare_methods(spark, paths, [str(table), str(tmp_path / "none.csv")], allow_missing=True)
    rows = found.collect()
    assert [r.method for r in rows] == ["phase2b_baseline", "phase3_llm_zero_shot", "other"]
    assert [r.f1 for r in rows] == [0.0, 0.9, 0.2] and rows[1].model == "q" and rows[0].model is None
    assert rows[0].true_positive == 4 and rows[0].metrics_path == paths["baseline"]
    write_comparison(found, str(tmp_path / "out"))
    written = spark.read.json(str(tmp_path / "out/comparison.json")).first()
    assert [r.method for r in written.rows] == ["phase2b_baseline", "phase3_llm_zero_shot", "other"] and written.timestamp
    assert spark.read.option("header", True).csv(str(tmp_path / "out/comparison")).count() == 3
    (tmp_path / "baseline.json").write_text("[1]")
    with pytest.raises(ValueError, match="invalid"):
        compare_methods(spark, paths, allow_missing=True)
    with pytest.raises(ValueError, match="no metrics"):
        compare_methods(spark, {}, [])
