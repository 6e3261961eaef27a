"""Fit, validate, score and write one model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.config import LABEL, TARGET, TEXT, TEXT_ID, TITLE, USER, VALIDATION_SPLIT, Settings
from postgauge.functions.text import normalized_post
from postgauge.operators.classifiers import LinearFit, fit_classifier
from postgauge.operators.explain import report
from postgauge.operators.metrics import evaluate, metric_record
from postgauge.operators.predictions import fold_prediction_table, prediction_table
from postgauge.operators.splitting import split_by_user, split_quality, test_fold_diagnosis
from postgauge.operators.terms import NORMALIZED
from postgauge.operators.tfidf import TfidfModel, fit_tfidf
from postgauge.session import settle
from postgauge.sources.models import load_model, save_model
from postgauge.sources.posts import decode_labels, fill_text
from postgauge.sources.results import write_table


def normalized(posts: DataFrame) -> DataFrame:
    """Posts with the model input beside the original columns."""
    return posts.withColumn(NORMALIZED, normalized_post())


@dataclass(frozen=True)
class FittedModel:
    """Vocabulary and weights; scoring is a projection over any number of posts."""

    features: TfidfModel
    fit: LinearFit

    def score(self, posts: DataFrame) -> DataFrame:
        """Add ``y_pred`` and ``score`` to posts that have the ``normalized`` column."""
        return self.fit.score(self.features.transform(posts), "tfidf").drop("tfidf")


def fit_model(train: DataFrame, settings: Settings) -> FittedModel:
    """Vocabulary, vectors and classifier from training posts (``normalized``, ``y``).

    The text is tokenised twice: once to count terms and once for the compact vectors,
    which are stored because every classifier reads them several times.
    """
    docs = train.select(NORMALIZED, TARGET)
    features = fit_tfidf(docs, settings.feature_spec)
    vectors = settle(features.transform(docs).select("tfidf", TARGET))
    return FittedModel(features, fit_classifier(vectors, "tfidf", settings, len(features.terms)))


class SharedFeatures:
    """Split, vocabulary and training vectors of one feature configuration, made once.

    All classifiers of a grid fit on the same stored vectors.
    """

    def __init__(self, posts: DataFrame, settings: Settings):
        self.split = split_by_user(posts, settings.validation_size, settings.random_state)
        self.quality = settle(split_quality(self.split.tag(posts)))
        docs = settle(normalized(self.split.train(posts)).select(NORMALIZED, TARGET))
        self.features = fit_tfidf(docs, settings.feature_spec)
        self.vectors = settle(self.features.transform(docs).select("tfidf", TARGET))

    def fit(self, settings: Settings) -> FittedModel:
        size = len(self.features.terms)
        return FittedModel(self.features, fit_classifier(self.vectors, "tfidf", settings, size))


@dataclass(frozen=True)
class Outcome:
    """Result tables of a flow."""

    model: FittedModel
    predictions: DataFrame
    metrics: DataFrame | None
    report: DataFrame | None
    diagnosis: DataFrame | None = None

    def write(self, path: str, with_model: bool = True) -> None:
        """One folder per table; nested tables as JSON, predictions as CSV."""
        write_table(self.predictions, f"{path}/predictions", "csv")
        if self.metrics is not None:
            write_table(metric_record(self.metrics).coalesce(1), f"{path}/metrics.json", "json")
        for name in ("report", "diagnosis"):
            table = getattr(self, name)
            if table is not None:
                write_table(table, f"{path}/{name}", "json")
        if with_model:
            spark = self.predictions.sparkSession
            save_model(spark, f"{path}/model", self.model.features, self.model.fit)


def _outcome(model: FittedModel, posts: DataFrame, split: str | None, **tables) -> Outcome:
    """Score, then evaluate and explain from the stored predictions, which hold no text."""
    predictions = settle(prediction_table(model.score(normalized(posts)), split))
    metrics = evaluate(predictions) if "y_true" in predictions.columns else None
    explained = report(predictions, posts, model.features.terms, model.fit)
    return Outcome(model, predictions, metrics, explained, **tables)


def train_and_validate(
    posts: DataFrame, settings: Settings = Settings(), shared: SharedFeatures | None = None
) -> Outcome:
    """Split by user, fit on one side, evaluate on the other.

    ``shared`` holds the features when several classifiers use them.
    """
    shared = shared or SharedFeatures(posts, settings)
    held_out = shared.split.validation(posts)
    return _outcome(shared.fit(settings), held_out, VALIDATION_SPLIT, diagnosis=shared.quality)


def evaluate_stored(posts: DataFrame, model_path: str) -> Outcome:
    """Score posts with a stored model; metrics only when they carry labels."""
    model = FittedModel(*load_model(posts.sparkSession, model_path))
    return _outcome(model, posts, "evaluacion")


#: Columns of a test fold that leave the plan before anything is fitted or scored.
WITHHELD = (LABEL,)


def withholds(frame: DataFrame, column: str) -> bool:
    """Whether a plan never uses ``column``: above its tables, no step of the optimised plan
    refers to it or hands it on, so a columnar scan does not read it either."""
    todo = [frame._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        children = node.children()
        if children.isEmpty():
            continue
        used = [node.output(), node.references().toSeq()]
        if any(names.apply(i).name() == column for names in used for i in range(names.size())):
            return False
        todo += [children.apply(i) for i in range(children.size())]
    return True


def predict_test_fold(
    train: DataFrame, raw_test: DataFrame, settings: Settings, evaluate_labels: bool = False
) -> Outcome:
    """Fit on all training posts and predict a test fold.

    Labels of the test fold leave the plan before anything is fitted or scored, unless
    evaluation is asked for; ``labels_withheld`` states it after a look at what the plan of
    the predictions reads, and a plan that reads them all the same is refused.
    """
    labelled = LABEL in raw_test.columns
    if evaluate_labels and not labelled:
        raise ValueError("evaluation was requested, but the test fold has no labels")
    shown = evaluate_labels or LABEL not in WITHHELD
    used = [USER, TEXT_ID, TITLE, TEXT, *([LABEL] if shown and labelled else [])]
    test = decode_labels(fill_text(raw_test.select(*used)))
    model = fit_model(normalized(train), settings)
    scored = model.score(normalized(test))
    planned = fold_prediction_table(scored, include_truth=evaluate_labels)
    withheld = withholds(planned, LABEL)
    if labelled and not withheld and not evaluate_labels:
        raise RuntimeError("the predictions would read the label column of the test fold")
    predictions = settle(planned)
    metrics = evaluate(predictions) if evaluate_labels else None
    counted = decode_labels(raw_test) if labelled else raw_test
    diagnosis = test_fold_diagnosis(train, counted, labels_present=labelled)
    provenance = diagnosis.withColumns(
        {
            "classifier_name": F.lit(settings.classifier),
            "feature_config_name": F.lit(settings.features),
            "labels_present_in_test_fold": F.lit(labelled),
            "labels_used_for_evaluation": F.lit(evaluate_labels),
            "labels_withheld": F.lit(withheld),
        }
    )
    return Outcome(model, predictions, metrics, None, provenance)


# The notes of a test-fold record.
ETHICAL_NOTE = (
    "Este flujo genera resultados experimentales del reto académico y no "
    "constituye una herramienta de diagnóstico clínico."
)
TEST_LABEL_NOTE = (
    "Las etiquetas del fold de prueba no se usan para entrenamiento, selección "
    "de modelo ni ajuste de hiperparámetros."
)
_TOP_LEVEL = (
    "classifier_name",
    "feature_config_name",
    "train_rows",
    "test_rows",
    "labels_present_in_test_fold",
    "labels_used_for_evaluation",
)


def fold_record(
    outcome: Outcome, path: str, train_input: str, test_input: str, with_model: bool = True
) -> DataFrame:
    """One record of a test-fold run: when, from what, where to, the notes and the diagnosis.

    ``metrics_out`` and ``model_out`` are null where nothing is written.
    """
    diagnosis = outcome.diagnosis
    facts = [c for c in diagnosis.columns if c not in _TOP_LEVEL[:2] + _TOP_LEVEL[4:]]
    evaluated = f"{path}/metrics.json" if outcome.metrics is not None else None
    texts = {
        "train_input": train_input,
        "test_input": test_input,
        "predictions_out": f"{path}/predictions",
        "metrics_out": evaluated,
        "model_out": f"{path}/model" if with_model else None,
        "ethical_note": ETHICAL_NOTE,
        "test_label_usage_note": TEST_LABEL_NOTE,
    }
    return diagnosis.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        *_TOP_LEVEL,
        *(F.lit(value).cast("string").alias(name) for name, value in texts.items()),
        F.struct(*facts).alias("diagnostics"),
    )


def write_test_fold(
    outcome: Outcome, path: str, train_input: str, test_input: str, with_model: bool = True
) -> None:
    """All tables of a test-fold run and its record."""
    outcome.write(path, with_model)
    record = fold_record(outcome, path, train_input, test_input, with_model)
    write_table(record.coalesce(1), f"{path}/metadata.json", "json")
