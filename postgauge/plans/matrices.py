"""Dense classifiers on embeddings, and generated answers by model and prompt mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.config import DENSE_CLASSIFIERS, TARGET, AnswerSettings, Settings, choose
from postgauge.operators.answers import CELL, Provider, classify
from postgauge.operators.comparison import answer_rows, embedding_rows
from postgauge.operators.embeddings import dense_vectors, fit_all_dense
from postgauge.operators.metrics import evaluate, gated_metrics
from postgauge.operators.predictions import fold_prediction_table
from postgauge.operators.splitting import few_shot_examples, require_examples
from postgauge.session import settle


def embedding_predictions(
    train: DataFrame,
    test: DataFrame,
    classifier: str = "all",
    settings: Settings = Settings(),
    include_truth: bool = True,
) -> DataFrame:
    """Predictions of the chosen dense classifiers, tagged by ``classifier``."""
    vectors = dense_vectors(test)
    parts = []
    for fit in fit_all_dense(train, choose(classifier, DENSE_CLASSIFIERS, "embedding classifier"), settings):
        table = fold_prediction_table(fit.score(vectors, "vector"), include_truth)
        parts.append(table.withColumn("classifier", F.lit(fit.classifier)))
    return reduce(DataFrame.unionByName, parts)


def embedding_matrix(train: DataFrame, test: DataFrame, classifier: str = "all") -> DataFrame:
    """One comparison row per dense classifier, scored in a single grouped job."""
    predictions = settle(embedding_predictions(train, test, classifier))
    return embedding_rows(evaluate(predictions, ["classifier"]))


def answer_predictions(
    train: DataFrame,
    test: DataFrame,
    provider: Provider,
    settings: AnswerSettings = AnswerSettings(),
    models: Sequence[str] = (),
    modes: Sequence[str] = (),
    seed: int = 42,
) -> DataFrame:
    """Answers of every model and prompt mode; both inputs need ``normalized``."""
    modes = modes or settings.prompt_modes
    examples: list[tuple[str, str]] = []
    if "few_shot" in modes:
        rows = require_examples(
            few_shot_examples(train, settings.examples_per_class, seed), settings.examples_per_class
        )
        examples = [(row["label"], row["text"]) for row in rows]
    parts = [
        classify(
            test, provider, model, mode, examples if mode == "few_shot" else (), settings.max_attempts
        )
        for model in (models or settings.matrix_models)
        for mode in modes
    ]
    return reduce(DataFrame.unionByName, parts)


def answer_matrix(predictions: DataFrame) -> DataFrame:
    """One comparison row per model and mode; a cell with errors has no metrics."""
    return answer_rows(gated_metrics(predictions, CELL))
