"""Result tables of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.config import EVALUATION_SPLIT, SPLIT, TARGET, TEXT_ID, USER
from postgauge.functions.labels import label_text


def prediction_table(
    scored: DataFrame, split: str | None = None, include_truth: bool = True, keep: tuple = ()
) -> DataFrame:
    """Ids, truth where known, decision, score and split tag."""
    if split is not None:
        tag: Column = F.lit(split)
    else:
        tag = F.col(SPLIT) if SPLIT in scored.columns else F.lit(EVALUATION_SPLIT)
    truth = include_truth and TARGET in scored.columns
    return scored.select(
        TEXT_ID,
        USER,
        *([F.col(TARGET).alias("y_true")] if truth else []),
        "y_pred",
        "score",
        tag.alias(SPLIT),
        *keep,
    )


def fold_prediction_table(scored: DataFrame, include_truth: bool) -> DataFrame:
    """Ids, decision as number and word, score, and the truth only on request."""
    truth = include_truth and TARGET in scored.columns
    return scored.select(
        TEXT_ID,
        USER,
        "y_pred",
        label_text(F.col("y_pred")).alias("label_pred"),
        "score",
        *([F.col(TARGET).alias("y_true")] if truth else []),
    )
