"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the shared tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postgauge.config import (
    DENSE_CLASSIFIERS,
    FEATURES,
    LABEL,
    TARGET,
    TEXT,
    TEXT_ID,
    TITLE,
    USER,
    VALIDATION_SPLIT,
    Settings,
    grid_pairs,
)
from postgauge.functions import text as X
from postgauge.functions.answers import evidence_json
from postgauge.functions.keys import hash_fold, model_slug, run_id
from postgauge.functions.labels import answer_label, binary_flag
from postgauge.functions.prompts import few_shot_prompt, zero_shot_prompt
from postgauge.operators import answers, comparison, curves, embeddings, explain, metrics
from postgauge.operators import selection, splitting, tracking
from postgauge.operators.classifiers import balanced_weights, class_counts, fit_classifier, optimality
from postgauge.operators.predictions import fold_prediction_table, prediction_table
from postgauge.operators.providers import batched
from postgauge.operators.terms import (
    NORMALIZED,
    counted_documents,
    kept_terms,
    most_frequent,
    of_spec,
    term_occurrences,
    term_statistics,
    vocabulary_statistics,
)
from postgauge.operators.tfidf import entries, fit_tfidf
from postgauge.plans.answer_runs import AnswerRun, ask_cell
from postgauge.plans.cross_validation import cross_validate
from postgauge.plans.matrices import answer_matrix, embedding_matrix, embedding_predictions
from postgauge.plans.training import FittedModel, fit_model, fold_record, predict_test_fold
from postgauge.registry import adapters as A
from postgauge.session import ensure_checkpoint_dir, settle
from postgauge.sources.embedding_store import append_store, compact_store, read_store
from postgauge.sources.posts import decode_labels, read_posts_csv
from postgauge.sources.results import read_answers, write_table

Query = Callable[[SparkSession, str], DataFrame]
BAYES_PAIRS = [("multinomial_nb", "word_unigram"), ("complement_nb", "word_unigram")]


def rounded(frame: DataFrame, *columns: str) -> DataFrame:
    """Sums differ in their last bits with the order of addition."""
    return frame.withColumns({c: F.round(c, 6) for c in columns})


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and validation side of the labelled posts."""
    labelled = A.pool(spark, sf_dir)
    split = splitting.split_by_user(labelled, 0.2, A.SEED)
    return split.train(labelled), split.validation(labelled)


def _fitted(spark: SparkSession, sf_dir: str, classifier: str, features: str) -> tuple[FittedModel, DataFrame]:
    train, validation = _sides(spark, sf_dir)
    return fit_model(train, Settings().with_pair(classifier, features)), validation


def _validated(spark: SparkSession, sf_dir: str, classifier: str, features: str = "word_unigram", keep=()):
    model, validation = _fitted(spark, sf_dir, classifier, features)
    return prediction_table(model.score(validation), VALIDATION_SPLIT, keep=keep)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, fit complement naive Bayes on word unigrams, evaluate the held-out users."""
    found = metrics.evaluate(settle(_validated(spark, sf_dir, "complement_nb")))
    return rounded(found, *metrics.METRICS)


# -- ingest and text -------------------------------------------------------------------


def post_ingest(spark, sf_dir):
    return A.pool(spark, sf_dir).select(
        TEXT_ID, USER, TITLE, TEXT, TARGET, X.join_title_text().alias("joined")
    )


def normalized_text(spark, sf_dir):
    return A.posts(spark, sf_dir).select(TEXT_ID, NORMALIZED)


def normalized_pages(spark, sf_dir):
    pages = A.table(spark, sf_dir, "pages")
    return pages.select("page_id", X.normalized_post("url", "html").alias(NORMALIZED))


def text_fragments(spark, sf_dir):
    return A.posts(spark, sf_dir).select(TEXT_ID, X.fragment(X.join_title_text()).alias("fragmento"))


def truncated_text(spark, sf_dir):
    return A.posts(spark, sf_dir).select(TEXT_ID, X.truncate(F.col(NORMALIZED), 6_000).alias("cut"))


def binary_flags(spark, sf_dir):
    flags = {
        name: binary_flag(F.col(name)) for name in ("lang", "source", "quality_text", "quality_number")
    }
    labels = A.table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, " Yes ").otherwise("NO").alias("quality_text"),
        F.col("quality").cast("string").alias("quality_number"),
    )
    documents = A.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", *(c.alias(n) for n, c in flags.items())
    )


def label_distribution(spark, sf_dir):
    labelled = A.pool(spark, sf_dir).groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return rounded(labelled.withColumn("share", F.col("rows") / total), "share")


# -- features --------------------------------------------------------------------------


def word_term_stats(spark, sf_dir):
    return term_statistics(A.posts(spark, sf_dir), FEATURES["word_unigram"])


def term_frequencies(spark, sf_dir):
    return term_occurrences(A.pool(spark, sf_dir), FEATURES["word_unigram"], [TEXT_ID])


def _vocabulary(name: str) -> Query:
    def query(spark, sf_dir):
        return _vocabularies(spark, sf_dir, [name])[0]

    return query


def _vocabularies(spark: SparkSession, sf_dir: str, names: list[str]) -> list[DataFrame]:
    """Vocabularies of all posts from one pass over the text."""
    specs = [FEATURES[name] for name in names]
    stats = vocabulary_statistics(A.posts(spark, sf_dir), specs)
    n_docs = counted_documents(stats)
    return [
        most_frequent(kept_terms(of_spec(stats, bit), spec, n_docs), spec.max_features)
        for bit, spec in enumerate(specs)
    ]


def shared_vocabularies(spark, sf_dir):
    """The vocabularies of all feature configurations, their text read once."""
    found = _vocabularies(spark, sf_dir, list(FEATURES))
    named = [v.withColumn("feature_config_name", F.lit(n)) for n, v in zip(FEATURES, found, strict=True)]
    return reduce(DataFrame.unionByName, named)


def tfidf_idf(spark, sf_dir):
    train, _ = _sides(spark, sf_dir)
    model = fit_tfidf(train, FEATURES["word_unigram"])
    return rounded(model.vocabulary(spark).select("term", "df", "tf", "idf"), "idf")


def tfidf_vectors(spark, sf_dir):
    train, _ = _sides(spark, sf_dir)
    model = fit_tfidf(train, FEATURES["word_unigram"])
    cells = entries(model.transform(train), "tfidf", [TEXT_ID])
    names = F.broadcast(model.vocabulary(spark).select("idx", "term"))
    return rounded(cells.join(names, "idx").select(TEXT_ID, "term", "tfidf"), "tfidf")


def tfidf_transform(spark, sf_dir):
    train, _ = _sides(spark, sf_dir)
    model = fit_tfidf(train, FEATURES["word_unigram"])
    values = F.unwrap_udt("tfidf").getField("values")
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    seen = model.transform(A.unlabelled(spark, sf_dir))
    return rounded(seen.select(TEXT_ID, F.size(values).alias("n_terms"), total.alias("total")), "total")


# -- splits ----------------------------------------------------------------------------


def group_split(spark, sf_dir):
    labelled = A.pool(spark, sf_dir)
    split = splitting.split_by_user(labelled, 0.2, A.SEED)
    return split.tag(labelled).select(TEXT_ID, USER, "split")


def order_split(spark, sf_dir):
    orders = A.order_posts(spark, sf_dir)
    return splitting.split_by_user(orders, 0.2, A.SEED).tag(orders)


def split_quality(spark, sf_dir):
    labelled = A.pool(spark, sf_dir)
    split = splitting.split_by_user(labelled, 0.2, A.SEED)
    return rounded(splitting.split_quality(split.tag(labelled)), "share_no", "share_yes")


def shared_users(spark, sf_dir):
    return splitting.shared_users(A.pool(spark, sf_dir), A.unlabelled(spark, sf_dir))


def fold_assignment(spark, sf_dir):
    return splitting.assign_folds(A.order_posts(spark, sf_dir), A.FOLDS, A.SEED)


def fold_balance(spark, sf_dir):
    """Totals of the folds, and whether every user is placed once and the folds are even."""
    orders = A.order_posts(spark, sf_dir)
    folds = settle(splitting.assign_folds(orders, A.FOLDS, A.SEED))
    sizes = splitting.fold_integrity(splitting.tag_folds(orders, folds))
    once = folds.groupBy(USER).count().where("count > 1").isEmpty()

    def even(column: str, tolerance: float):
        return (F.max(column) - F.min(column)) <= tolerance * F.avg(column)

    return sizes.agg(
        F.count("fold").alias("folds"),
        F.sum("validation_rows").alias("rows"),
        F.sum("validation_users").alias("users"),
        F.lit(once).alias("users_once"),
        even("validation_rows", 0.05).alias("rows_even"),
        even("count_yes", 0.05).alias("yes_even"),
        even("count_no", 0.05).alias("no_even"),
    )


def fold_integrity(spark, sf_dir):
    orders = A.order_posts(spark, sf_dir)
    tagged = splitting.tag_folds(orders, splitting.assign_folds(orders, A.FOLDS, A.SEED))
    return splitting.fold_integrity(tagged).agg(
        F.count("fold").alias("folds"),
        F.sum("validation_rows").alias("rows"),
        F.sum("validation_users").alias("users"),
        F.sum("count_no").alias("count_no"),
        F.sum("count_yes").alias("count_yes"),
        F.sum("user_overlap_count").alias("overlap"),
    )


def fewshot_sample(spark, sf_dir):
    return splitting.few_shot_examples(A.pool(spark, sf_dir), 3, A.SEED)


def test_fold_diagnostics(spark, sf_dir):
    test = A.raw_posts(spark, sf_dir, False).withColumns(
        {c: F.when(F.col(c) != "", F.col(c)) for c in (TITLE, TEXT)}
    )
    train = A.raw_posts(spark, sf_dir, True)
    return splitting.test_fold_diagnosis(train, test, labels_present=False)


def test_fold_labelled(spark, sf_dir):
    """The diagnosis of a test fold that has labels: the validation side as such a fold."""
    labelled = A.raw_posts(spark, sf_dir, True)
    split = splitting.split_by_user(labelled, 0.2, A.SEED)
    test = split.validation(labelled).withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in (TITLE, TEXT)})
    return splitting.test_fold_diagnosis(split.train(labelled), decode_labels(test), labels_present=True)


def test_fold_record(spark, sf_dir):
    """The record of a run over the validation side as a labelled fold, labels withheld."""
    labelled = A.raw_posts(spark, sf_dir, True)
    split = splitting.split_by_user(labelled, 0.2, A.SEED)
    settings = Settings().with_pair("complement_nb", "word_unigram")
    train = decode_labels(split.train(labelled))
    outcome = predict_test_fold(train, split.validation(labelled), settings)
    found = fold_record(outcome, "out", "train", "test", with_model=False)
    found = found.drop("train_rows", "test_rows").select("*", "diagnostics.*")
    predicted = outcome.predictions.agg(F.count("y_pred").alias("predictions")).first()
    return found.drop("timestamp", "diagnostics").withColumn("predictions", F.lit(predicted[0]).cast("long"))


def class_weights(spark, sf_dir):
    train, _ = _sides(spark, sf_dir)
    weights = balanced_weights(class_counts(train))
    sides = train.groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows"))
    weight = F.when(F.col(TARGET) == 1, weights[1]).otherwise(weights[0])
    return rounded(sides.withColumn("weight", weight), "weight")


# -- models ----------------------------------------------------------------------------


def _predictions(classifier: str, features: str = "word_unigram") -> Query:
    def query(spark, sf_dir):
        return rounded(_validated(spark, sf_dir, classifier, features), "score")

    return query


PROOF = ("classifier_name", "n", "count_0", "count_1", "optimal")


def _optimality(classifier: str) -> Query:
    """Whether a fit on word unigrams is at its optimum, from a gradient computed apart."""

    def query(spark, sf_dir):
        train, _ = _sides(spark, sf_dir)
        settings = Settings().with_pair(classifier, "word_unigram")
        features = fit_tfidf(train, settings.feature_spec)
        vectors = settle(features.transform(train).select("tfidf", TARGET))
        fit = fit_classifier(vectors, "tfidf", settings, len(features.terms))
        return optimality(vectors, "tfidf", fit, settings).select(*PROOF)

    return query


def embedding_optimality(spark, sf_dir):
    """The same proof for the dense classifiers, all fitted in the same passes."""
    train, _ = _embedding_sides(spark, sf_dir)
    vectors = settle(embeddings.dense_vectors(train).select("vector", TARGET))
    found = []
    for fit in embeddings.fit_all_dense(train, DENSE_CLASSIFIERS):
        settings = Settings().with_pair(fit.classifier, Settings().features)
        found.append(optimality(vectors, "vector", fit, settings).select(*PROOF))
    return reduce(DataFrame.unionByName, found)


def conversation_predictions(spark, sf_dir):
    """A fitted model applied to texts that never had labels."""
    model, _ = _fitted(spark, sf_dir, "complement_nb", "word_unigram")
    turns = A.table(spark, sf_dir, "conversations")
    new = turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(TEXT_ID),
        F.col("role").alias(USER),
        X.normalize_text(F.col("text")).alias(NORMALIZED),
    )
    return rounded(fold_prediction_table(model.score(new), include_truth=False), "score")


def _embedding_sides(spark, sf_dir):
    rows = A.embedding_posts(spark, sf_dir)
    split = splitting.split_by_user(rows, 0.2, A.SEED)
    return split.train(rows), split.validation(rows)


def _embedding(classifier: str) -> Query:
    def query(spark, sf_dir):
        train, test = _embedding_sides(spark, sf_dir)
        return embedding_predictions(train, test, classifier).drop("classifier")

    return query


def embedding_methods(spark, sf_dir):
    return embedding_matrix(*_embedding_sides(spark, sf_dir))


def _vector_store(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Requests of all posts, and stored vectors of labelled ones; toxic posts are stale."""
    requests = embeddings.embedding_requests(A.posts(spark, sf_dir), "nomic-embed-text", 6_000)
    toxic = A.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias(TEXT_ID), "toxic")
    stale = F.when(F.col("toxic") == 1, F.sha2(F.lit("old"), 256)).otherwise(F.col("text_hash"))
    store = requests.join(toxic, TEXT_ID).select(
        TEXT_ID, "model", stale.alias("text_hash"),
        F.array(F.length(NORMALIZED).cast("double"), F.lit(1.0)).alias("embedding"),
    )
    return requests, store


def embedding_cache_misses(spark, sf_dir):
    requests, store = _vector_store(spark, sf_dir)
    return embeddings.cache_misses(requests, store).select(TEXT_ID, "model", "text_hash")


def _length_vector(model: str, text: str) -> list[float]:
    return [float(len(text)), 0.0]


def embedding_fill(spark, sf_dir):
    _, store = _vector_store(spark, sf_dir)
    filled, _ = embeddings.embed(A.posts(spark, sf_dir), settle(store), _length_vector, "nomic-embed-text")
    return filled.select(TEXT_ID, F.get("embedding", 0).alias("length"), F.get("embedding", 1).alias("stored"))


# -- evaluation ------------------------------------------------------------------------


def confusion_metrics(spark, sf_dir):
    counts = metrics.confusion_counts(A.order_predictions(spark, sf_dir), ["priority"])
    rates = ("true_positive_rate", "false_positive_rate", "protocol_auc", "recall", "precision", "f1")
    return rounded(metrics.with_rates(counts), *rates)


def roc_auc_exact(spark, sf_dir):
    scored = A.order_predictions(spark, sf_dir).withColumn("score", F.col("price"))
    return rounded(metrics.roc_auc(scored, ["priority"]), "roc_auc").select("priority", "roc_auc")


def metric_records(spark, sf_dir):
    found = metrics.evaluate(A.order_predictions(spark, sf_dir), ["o_custkey"])
    return rounded(found, *metrics.METRICS)


def roc_curve(spark, sf_dir):
    points = curves.roc_curve(A.order_predictions(spark, sf_dir), ["priority"])
    return rounded(points, "fpr", "tpr").select("priority", "threshold", "fpr", "tpr")


def score_histogram(spark, sf_dir):
    scored = A.order_predictions(spark, sf_dir).withColumn("score", F.col("price"))
    per_class = curves.score_histogram(scored, ["y_true"]).withColumn("y_true", F.col("y_true").cast("string"))
    overall = curves.score_histogram(scored).withColumn("y_true", F.lit("all"))
    return rounded(overall.unionByName(per_class), "bin_start", "bin_end")


def prediction_counts(spark, sf_dir):
    return curves.prediction_counts(_validated(spark, sf_dir, "complement_nb"))


# -- model selection -------------------------------------------------------------------


def _folds(spark, sf_dir):
    labelled = A.pool(spark, sf_dir).select(USER, TARGET, NORMALIZED)
    tagged = labelled.withColumn("fold", hash_fold(A.SEED, F.col(USER), A.FOLDS))
    return cross_validate(settle(tagged), BAYES_PAIRS, A.FOLDS)


def cv_nb_folds(spark, sf_dir):
    return rounded(_folds(spark, sf_dir), *metrics.METRICS)


def _grid_folds(spark, sf_dir, pairs) -> DataFrame:
    """Pairs over three of the library's own stratified folds."""
    labelled = settle(A.pool(spark, sf_dir).select(TEXT_ID, USER, TARGET, NORMALIZED))
    tagged = splitting.tag_folds(labelled, splitting.assign_folds(labelled, 3, A.SEED))
    return cross_validate(settle(tagged), pairs, 3)


def cv_grid_folds(spark, sf_dir):
    """All classifiers with all feature sets, the iterative ones solved together."""
    return _grid_folds(spark, sf_dir, grid_pairs())


def cv_grid_shape(spark, sf_dir):
    """What SQL can tell of the grid: every pair on every fold, and the rows of both sides."""
    folds = settle(cv_grid_folds(spark, sf_dir))
    return folds.groupBy("classifier_name", "feature_config_name").agg(
        F.count("fold").alias("folds"),
        F.sum("validation_rows").alias("validation_rows"),
        F.sum("train_rows").alias("train_rows"),
        F.sum("user_overlap_count").alias("overlap"),
        F.sum(F.col("true_positive") + F.col("false_negative")).cast("long").alias("positives"),
    )


def _summary_stats() -> list[str]:
    return [c for c in selection.SUMMARY_CV_COLUMNS if c.startswith(("mean_", "std_"))]


def cv_summary(spark, sf_dir):
    summary = selection.summarise_folds(_folds(spark, sf_dir), A.FOLDS)
    return rounded(summary, *_summary_stats())


def cv_best(spark, sf_dir):
    best = selection.best_pair(selection.summarise_folds(_folds(spark, sf_dir), A.FOLDS))
    return rounded(best, *(c for c in best.columns if c.startswith(("mean_", "std_"))))


def fold_summary(spark, sf_dir):
    summary = selection.summarise_folds(A.order_folds(spark, sf_dir), A.FOLDS)
    return rounded(summary, *_summary_stats())


def cv_ranking(spark, sf_dir):
    """The ranking table of a cross-validation summary, with all its columns."""
    summary = selection.summarise_folds(A.order_folds(spark, sf_dir), A.FOLDS)
    top = tracking.ranking(summary, 10, metric="mean_protocol_auc")
    return rounded(top, *_summary_stats())


def top_error_bars(spark, sf_dir):
    bars = selection.error_bars(selection.summarise_folds(A.order_folds(spark, sf_dir), A.FOLDS))
    return rounded(bars, *(c for c in bars.columns if c.startswith(("mean_", "std_"))))


def run_keys(spark, sf_dir):
    runs = A.run_metadata(spark, sf_dir)
    key = run_id(*(F.col(c) for c in ("experiment_name", "classifier_name", "feature_config_name", "started_at")))
    return runs.select("c_custkey", key.alias("run_key"), model_slug(F.col("started_at")).alias("model_slug"))


# -- interpretability ------------------------------------------------------------------


def top_terms(spark, sf_dir):
    model, _ = _fitted(spark, sf_dir, "complement_nb", "word_unigram")
    weights = explain.term_weights(spark, model.features.terms, model.fit)
    return rounded(weights, "peso")


def error_examples(spark, sf_dir):
    found = settle(_validated(spark, sf_dir, "multinomial_nb"))
    return rounded(explain.error_examples(found, A.raw_posts(spark, sf_dir, True)), "score")


def high_confidence(spark, sf_dir):
    model, _ = _fitted(spark, sf_dir, "multinomial_nb", "word_unigram")
    scored = model.score(A.unlabelled(spark, sf_dir))
    table = fold_prediction_table(scored.select(TEXT_ID, USER, "y_pred", "score"), False)
    return rounded(explain.high_confidence(table, A.raw_posts(spark, sf_dir, False)), "score")


def report(spark, sf_dir):
    """Terms, error examples and the note, as the flows write them."""
    model, validation = _fitted(spark, sf_dir, "multinomial_nb", "word_unigram")
    found = settle(prediction_table(model.score(validation), VALIDATION_SPLIT))
    posts = A.raw_posts(spark, sf_dir, True)
    whole = explain.report(found, posts, model.features.terms, model.fit)
    return rounded(whole, "score", "peso")


# -- runs and methods ------------------------------------------------------------------


def _summary(spark, sf_dir):
    return tracking.run_summary(A.run_metadata(spark, sf_dir), A.run_metrics(spark, sf_dir), "c_custkey")


def run_summary(spark, sf_dir):
    return rounded(_summary(spark, sf_dir), *tracking.RUN_METRICS)


def latest_runs(spark, sf_dir):
    found = tracking.latest_runs(_summary(spark, sf_dir))
    return rounded(found.select(*tracking.PAIR, "run_id", "started_at", *tracking.RUN_METRICS), *tracking.RUN_METRICS)


def run_counters(spark, sf_dir):
    return rounded(tracking.run_counters(settle(_summary(spark, sf_dir))), "best_protocol_auc", "best_roc_auc")


def ranking_top_n(spark, sf_dir):
    top = tracking.ranking(tracking.latest_runs(_summary(spark, sf_dir)), 10)
    return rounded(top, "protocol_auc", "roc_auc", "recall", "precision", "f1")


def auc_matrix(spark, sf_dir):
    matrix = tracking.auc_matrix(tracking.latest_runs(_summary(spark, sf_dir)))
    return rounded(matrix, *FEATURES)


def auc_comparison(spark, sf_dir):
    return rounded(tracking.auc_comparison(tracking.latest_runs(_summary(spark, sf_dir))), "roc_auc", "protocol_auc")


def method_comparison(spark, sf_dir):
    scored = A.order_predictions(spark, sf_dir)
    baseline = metrics.metric_record(metrics.evaluate(scored, ["priority"]))
    first = comparison.method_rows(
        baseline.withColumn("place", F.lit(-1).cast("bigint")),
        F.lit("phase2b_baseline"), F.col("priority"), F.lit("complement_nb"), F.lit("baseline"),
    ).withColumn("place", F.lit(-1).cast("bigint"))
    per_run = A.run_metrics(spark, sf_dir).withColumns(A.pair_columns("c_custkey"))
    cells = [F.col("confusion_matrix").getField(c).alias(c) for c in metrics.COUNTS]
    flat = per_run.select(
        "c_custkey", F.col("feature_config_name").alias("representation"),
        F.col("classifier_name").alias("classifier"), *comparison.METHOD_METRICS, *cells,
    )
    second = flat.withColumns(
        {"method": F.concat(F.lit("phase3_embeddings_"), "classifier"), "place": F.col("c_custkey")}
    ).drop("c_custkey")
    merged = comparison.combine_methods([first, second], order=["place"]).drop("place")
    return rounded(merged, *comparison.METHOD_METRICS)


# -- prompts and answers ---------------------------------------------------------------


def prompts_zero_shot(spark, sf_dir):
    return A.posts(spark, sf_dir).select(TEXT_ID, zero_shot_prompt(F.col(NORMALIZED)).alias("prompt"))


def prompts_few_shot(spark, sf_dir):
    rows = splitting.require_examples(fewshot_sample(spark, sf_dir), 3)
    examples = [(row["label"], row["text"]) for row in rows]
    return A.posts(spark, sf_dir).select(TEXT_ID, few_shot_prompt(F.col(NORMALIZED), examples).alias("prompt"))


def answer_validate(spark, sf_dir):
    judged = answers.validate(A.stored_answers(spark, sf_dir))
    return judged.select(
        TEXT_ID, "model", "prompt_mode", "seq", "label_pred", "y_pred", "score",
        evidence_json(F.col("evidence")).alias("evidence"), "justification", "error",
    )


def answer_replay(spark, sf_dir):
    stored = A.stored_answers(spark, sf_dir).where(
        (F.col("model") == A.ANSWER_MODELS[0]) & (F.col("prompt_mode") == "zero_shot")
    )
    found = answers.replay(A.posts(spark, sf_dir), stored)
    return found.withColumn("evidence", evidence_json(F.col("evidence")))


def answer_matrix_metrics(spark, sf_dir):
    stored = A.stored_answers(spark, sf_dir)
    labelled = A.pool(spark, sf_dir)
    found = settle(answers.replay_matrix(labelled, stored, stored))
    return rounded(answer_matrix(found), *comparison.METHOD_METRICS)


def _offline_answer(model: str, prompt: str) -> str:
    """A stand-in provider: the prompt's length decides, and some answers are invalid."""
    if len(prompt) % 5 == 0:
        return "sin respuesta"
    label = "yes" if len(prompt) % 2 else "no"
    return f'{{"label":"{label}","score":0.{len(prompt) % 10}}}'


def answer_classify(spark, sf_dir):
    found = answers.classify(A.posts(spark, sf_dir), _offline_answer, "gemma3:4b")
    return found.select(TEXT_ID, "y_true", "y_pred", "score", "error", "attempts", answer_label(F.col("label_pred")).alias("label_value"))


# -- flows over stored state -----------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def csv_posts(spark, sf_dir):
    """All posts written as multi-line CSV and read back by byte range."""
    path = _folder(spark, "csv-posts")
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    write_table(A.raw_posts(spark, sf_dir).drop(LABEL), path, "csv", **kept)
    return read_posts_csv(spark, path, require_label=False).select(TEXT_ID, USER, TITLE, TEXT)


def answer_log(spark, sf_dir):
    """The log of a cell asked for twice: the second time nothing is left to ask."""
    run = AnswerRun(batched(_offline_answer), _folder(spark, "answers"))
    posts = settle(A.posts(spark, sf_dir).select(TEXT_ID, USER, NORMALIZED))
    for _ in range(2):
        ask_cell(posts, run, "gemma3:4b", "zero_shot", ())
    return read_answers(spark, run.log_path).select(TEXT_ID, "model", "prompt_mode", "attempt", "raw_response")


def embedding_store(spark, sf_dir):
    """Vectors appended twice, compacted, and looked up on the shelves of labelled posts."""
    path = _folder(spark, "vectors")
    requests = embeddings.embedding_requests(A.posts(spark, sf_dir), "nomic-embed-text", 6_000)
    vector = F.array(F.length("cut").cast("double")).alias("embedding")
    stored = settle(requests.select(*embeddings.CACHE_KEY, vector))
    for _ in range(2):
        append_store(stored, path)
    compact_store(spark, path)
    wanted = settle(
        embeddings.embedding_requests(A.pool(spark, sf_dir), "nomic-embed-text", 6_000).select(*embeddings.CACHE_KEY)
    )
    found = read_store(spark, path, wanted).join(wanted, list(embeddings.CACHE_KEY))
    return found.select(TEXT_ID, "model", F.get("embedding", 0).alias("length"))


QUERIES: dict[str, Query] = {
    "flagship_metrics": flagship,
    "post_ingest": post_ingest,
    "normalized_text": normalized_text,
    "normalized_pages": normalized_pages,
    "text_fragments": text_fragments,
    "truncated_text": truncated_text,
    "binary_flags": binary_flags,
    "label_distribution": label_distribution,
    "word_term_stats": word_term_stats,
    "term_frequencies": term_frequencies,
    "word_unigram_vocab": _vocabulary("word_unigram"),
    "word_bigram_vocab": _vocabulary("word_unigram_bigram"),
    "word_trigram_vocab": _vocabulary("word_unigram_trigram"),
    "char_wb_vocab": _vocabulary("char_wb_3_5"),
    "shared_vocabularies": shared_vocabularies,
    "tfidf_idf": tfidf_idf,
    "tfidf_vectors": tfidf_vectors,
    "tfidf_transform": tfidf_transform,
    "group_split": group_split,
    "order_split": order_split,
    "split_quality": split_quality,
    "shared_users": shared_users,
    "fold_assignment": fold_assignment,
    "fold_balance": fold_balance,
    "fold_integrity": fold_integrity,
    "fewshot_sample": fewshot_sample,
    "test_fold_diagnostics": test_fold_diagnostics,
    "class_weights": class_weights,
    "mnb_predictions": _predictions("multinomial_nb"),
    "cnb_predictions": _predictions("complement_nb"),
    "cnb_char_predictions": _predictions("complement_nb", "char_wb_3_5"),
    "lr_predictions": _predictions("logistic_regression"),
    "svm_predictions": _predictions("linear_svm"),
    "sgd_predictions": _predictions("sgd_logistic"),
    "lr_optimality": _optimality("logistic_regression"),
    "svm_optimality": _optimality("linear_svm"),
    "sgd_optimality": _optimality("sgd_logistic"),
    "embedding_optimality": embedding_optimality,
    "conversation_predictions": conversation_predictions,
    "embedding_lr": _embedding("logistic_regression"),
    "embedding_svm": _embedding("linear_svm"),
    "embedding_sgd": _embedding("sgd_logistic"),
    "embedding_methods": embedding_methods,
    "embedding_cache_misses": embedding_cache_misses,
    "embedding_fill": embedding_fill,
    "confusion_metrics": confusion_metrics,
    "roc_auc_exact": roc_auc_exact,
    "metric_records": metric_records,
    "roc_curve": roc_curve,
    "score_histogram": score_histogram,
    "prediction_counts": prediction_counts,
    "cv_nb_folds": cv_nb_folds,
    "cv_grid_folds": cv_grid_folds,
    "cv_grid_shape": cv_grid_shape,
    "cv_summary": cv_summary,
    "cv_best": cv_best,
    "fold_summary": fold_summary,
    "cv_ranking": cv_ranking,
    "top_error_bars": top_error_bars,
    "run_keys": run_keys,
    "top_terms": top_terms,
    "error_examples": error_examples,
    "high_confidence": high_confidence,
    "report": report,
    "csv_posts": csv_posts,
    "answer_log": answer_log,
    "embedding_store": embedding_store,
    "test_fold_labelled": test_fold_labelled,
    "test_fold_record": test_fold_record,
    "run_summary": run_summary,
    "latest_runs": latest_runs,
    "run_counters": run_counters,
    "ranking_top_n": ranking_top_n,
    "auc_matrix": auc_matrix,
    "auc_comparison": auc_comparison,
    "method_comparison": method_comparison,
    "prompts_zero_shot": prompts_zero_shot,
    "prompts_few_shot": prompts_few_shot,
    "answer_validate": answer_validate,
    "answer_replay": answer_replay,
    "answer_matrix_metrics": answer_matrix_metrics,
    "answer_classify": answer_classify,
}
