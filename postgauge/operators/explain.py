"""Term weights and example posts for error analysis."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.config import TEXT_ID, USER
from postgauge.functions.text import fragment, join_title_text
from postgauge.operators.classifiers import LinearFit
from postgauge.session import settle

# Section names and the note of the report.
POSITIVE_TERMS = "terminos_asociados_a_yes"
NEGATIVE_TERMS = "terminos_asociados_a_no"
FALSE_NEGATIVES = "falsos_negativos_prioritarios"
FALSE_POSITIVES = "falsos_positivos"
HIGH_CONFIDENCE = "predicciones_alta_confianza"
ETHICS_NOTE = (
    "Evidencia exploratoria del modelo; no debe interpretarse como diagnóstico "
    "clínico ni como explicación validada de riesgo individual."
)


def term_weights(spark: SparkSession, terms: list[str], fit: LinearFit, top_n: int = 25) -> DataFrame:
    """The ``top_n`` terms at either end of the weights, with their rank."""
    by_name = np.argsort(np.array(terms, dtype=object), kind="stable")
    # Weights equal up to the order of addition are a tie, which the term breaks.
    level = np.round(fit.weights[by_name], 9)
    rising = by_name[np.argsort(level, kind="stable")]
    falling = by_name[np.argsort(-level, kind="stable")]
    rows = [
        (section, rank, terms[i], float(fit.weights[i]))
        for section, order in ((POSITIVE_TERMS, falling), (NEGATIVE_TERMS, rising))
        for rank, i in enumerate(order[:top_n], start=1)
    ]
    return spark.createDataFrame(rows, "section string, rank int, termino string, peso double")


def _highest(predictions: DataFrame, section: str, limit: int) -> DataFrame:
    columns = [c for c in ("y_true", "y_pred", "score") if c in predictions.columns]
    top = predictions.orderBy(F.desc("score"), TEXT_ID).limit(limit)
    return top.select(F.lit(section).alias("section"), TEXT_ID, USER, *columns)


def with_fragments(examples: DataFrame, posts: DataFrame) -> DataFrame:
    """Examples with an excerpt of their post; only then is any text read.

    Examples are a few rows by construction, so they are stored and sent to the posts; a post
    stored twice gives one excerpt.
    """
    chosen = settle(examples)
    ids = F.broadcast(chosen.select(F.col(TEXT_ID).alias("_id")).distinct())
    texts = (
        posts.join(ids, F.col(TEXT_ID).cast("string") == F.col("_id"), "left_semi")
        .groupBy(F.col(TEXT_ID).cast("string").alias(TEXT_ID))
        .agg(F.min(fragment(join_title_text())).alias("fragmento"))
    )
    return chosen.join(texts, TEXT_ID, "left").select(*chosen.columns, "fragmento")


def error_examples(predictions: DataFrame, posts: DataFrame, limit: int = 5) -> DataFrame:
    """False negatives and false positives with the highest scores."""
    missed = (F.col("y_true") == 1) & (F.col("y_pred") == 0)
    raised = (F.col("y_true") == 0) & (F.col("y_pred") == 1)
    found = _highest(predictions.where(missed), FALSE_NEGATIVES, limit).unionByName(
        _highest(predictions.where(raised), FALSE_POSITIVES, limit)
    )
    return with_fragments(found, posts)


def high_confidence(predictions: DataFrame, posts: DataFrame, limit: int = 5) -> DataFrame:
    """Rows with the highest scores, for posts without a label."""
    return with_fragments(_highest(predictions, HIGH_CONFIDENCE, limit), posts)


def report(
    predictions: DataFrame,
    posts: DataFrame,
    terms: list[str],
    fit: LinearFit,
    top_n: int = 25,
    limit: int = 5,
) -> DataFrame:
    """All sections in one table, with the ethics note on every row.

    ``predictions`` are narrow; ``posts`` give title and text of the few examples.
    """
    weights = term_weights(predictions.sparkSession, terms, fit, top_n)
    if "y_true" in predictions.columns:
        examples = error_examples(predictions, posts, limit)
    else:
        examples = high_confidence(predictions, posts, limit)
    return weights.unionByName(examples, allowMissingColumns=True).withColumn(
        "nota_etica", F.lit(ETHICS_NOTE)
    )
