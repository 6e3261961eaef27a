"""Tables behind the evaluation plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.config import NEGATIVE_LABEL, POSITIVE_LABEL
from postgauge.operators.metrics import ALL, ranked_scores, score_counts
from postgauge.session import settle

BINS = 20
CLASSES = ((0, NEGATIVE_LABEL), (1, POSITIVE_LABEL))


def roc_curve(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ROC points from (0, 0) to (1, 1); points on a straight line are dropped."""
    names = [ALL, *keys]
    counts = score_counts(predictions.withColumn(ALL, F.lit(1)), names)
    ranked = ranked_scores(counts, names)
    totals = counts.groupBy(*names).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    both = settle(totals.where((F.col("p") > 0) & (F.col("n") > 0)))
    first = (F.col("pos_above") == 0) & (F.col("neg_above") == 0)
    last = F.col("next_pos").isNull()
    turn = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
    points = ranked.where(first | last | turn).join(both, names).select(
        *keys,
        F.col("score").alias("threshold"),
        ((F.col("neg_above") + F.col("neg")) / F.col("n")).alias("fpr"),
        ((F.col("pos_above") + F.col("pos")) / F.col("p")).alias("tpr"),
    )
    origin = both.select(
        *keys,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def score_histogram(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in 20 equal bins between the smallest and largest score of each group.

    Empty bins stay in the result; the last bin includes its upper edge; a group with
    a single score value gets a range of one around it.
    """
    names = [ALL, *keys]
    scored = predictions.where(F.col("score").isNotNull()).withColumn(ALL, F.lit(1))
    ranges = scored.groupBy(*names).agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ranges = settle(
        ranges.select(
            *names,
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    width = F.col("hi") - F.col("lo")
    step = width / BINS
    guess = F.least(
        F.floor((F.col("score") - F.col("lo")) * (F.lit(float(BINS)) / width)), F.lit(BINS - 1)
    )
    low_edge = F.col("lo") + F.col("guess") * step
    high_edge = F.col("lo") + (F.col("guess") + 1) * step
    placed = (
        scored.join(ranges, names)
        .withColumn("guess", guess)
        .withColumn(
            "bin",
            F.when(F.col("score") < low_edge, F.col("guess") - 1)
            .when((F.col("score") >= high_edge) & (F.col("guess") < BINS - 1), F.col("guess") + 1)
            .otherwise(F.col("guess"))
            .cast("int"),
        )
    )
    found = placed.groupBy(*names, "bin").agg(F.count(F.lit(1)).alias("found"))
    slots = ranges.select(
        *names, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin")
    )
    return slots.join(found, [*names, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_start"),
        F.when(F.col("bin") == BINS - 1, F.col("hi"))
        .otherwise(F.col("lo") + (F.col("bin") + 1) * step)
        .alias("bin_end"),
        F.coalesce("found", F.lit(0)).alias("count"),
    )


def prediction_counts(predictions: DataFrame) -> DataFrame:
    """Rows per predicted class; a class never predicted counts zero."""
    counts = predictions.agg(
        *(F.count_if(F.col("y_pred") == value).alias(label) for value, label in CLASSES)
    )
    rows = (
        F.struct(
            F.lit(value).alias("y_pred"), F.lit(label).alias("label"), F.col(label).alias("count")
        )
        for value, label in CLASSES
    )
    return counts.select(F.inline(F.array(*rows)))
