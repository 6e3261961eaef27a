"""One table of all methods: baseline, embeddings and generated answers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.functions.keys import model_slug
from postgauge.operators.metrics import COUNTS

METHOD_KEY = ("method", "representation", "classifier")
METHOD_METRICS = ("protocol_auc", "roc_auc", "recall", "precision", "f1")

# Names of the three single-method rows.
SINGLE_METHODS = {
    "baseline": ("phase2b_baseline", "tfidf_char_wb_3_5", "complement_nb"),
    "embeddings": ("phase3_embeddings", "ollama_nomic_embed_text", "logistic_regression"),
    "answers": ("phase3_llm_zero_shot", "ollama_qwen2.5_3b_instruct", "zero_shot_prompt"),
}
EMBEDDING_REPRESENTATION = "ollama_nomic_embed_text"


def method_rows(
    metrics: DataFrame,
    method: Column,
    representation: Column,
    classifier: Column,
    metrics_path: Column,
) -> DataFrame:
    """Comparison columns from nested metric records."""
    cells = [F.col("confusion_matrix").getField(c).alias(c) for c in COUNTS]
    return metrics.select(
        method.alias("method"),
        representation.alias("representation"),
        classifier.alias("classifier"),
        metrics_path.alias("metrics_path"),
        *METHOD_METRICS,
        *cells,
    )


def answer_rows(metrics: DataFrame) -> DataFrame:
    """Comparison columns for model and prompt-mode metrics, with the error count."""
    return metrics.select(
        F.concat(F.lit("phase3_llm_"), "prompt_mode").alias("method"),
        "model",
        F.concat(F.lit("ollama_"), model_slug(F.col("model"))).alias("representation"),
        F.concat("prompt_mode", F.lit("_prompt")).alias("classifier"),
        "prompt_mode",
        "error_count",
        *METHOD_METRICS,
        *COUNTS,
    )


def embedding_rows(metrics: DataFrame) -> DataFrame:
    """Comparison columns for the dense classifiers."""
    return metrics.select(
        F.concat(F.lit("phase3_embeddings_"), "classifier").alias("method"),
        F.lit(EMBEDDING_REPRESENTATION).alias("representation"),
        "classifier",
        *METHOD_METRICS,
        *COUNTS,
    )


def combine_methods(sources: Sequence[DataFrame], order: Sequence[str] = ()) -> DataFrame:
    """Union of all sources; a key that occurs again keeps only its last row.

    ``order`` names columns that order rows inside a source. The choice is an aggregate,
    so a key repeated very often is no long group.
    """
    if not sources:
        raise ValueError("no metrics found to compare")
    tagged = [
        source.withColumn(
            "_place",
            F.struct(F.lit(number).alias("source"), *(F.col(c) for c in order if c in source.columns)),
        )
        if order
        else source.withColumn("_place", F.lit(number))
        for number, source in enumerate(sources)
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    others = [c for c in union.columns if c not in (*METHOD_KEY, "_place")]
    last = union.groupBy(*METHOD_KEY).agg(F.max_by(F.struct(*others), "_place").alias("row"))
    return last.select(*METHOD_KEY, "row.*")
