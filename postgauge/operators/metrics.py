"""Threshold and ranking metrics, for one or many groups of predictions in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postgauge.session import settle

COUNTS = ("true_negative", "false_positive", "false_negative", "true_positive")
# Metric names in result order.
METRICS = (
    "protocol_auc",
    "roc_auc",
    "recall",
    "precision",
    "f1",
    "true_positive_rate",
    "false_positive_rate",
)
ALL = "_all"


def confusion_counts(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The four cells of the confusion matrix per group."""
    cell = {
        name: F.count_if((F.col("y_true") == truth) & (F.col("y_pred") == guess))
        for name, (truth, guess) in zip(COUNTS, ((0, 0), (0, 1), (1, 0), (1, 1)), strict=True)
    }
    return predictions.groupBy(*keys).agg(*(c.alias(name) for name, c in cell.items()))


def _ratio(part: Column, whole: Column) -> Column:
    """Zero where the rate is undefined."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def with_rates(counts: DataFrame) -> DataFrame:
    """Rates, protocol AUC, precision, recall and F1 from the four cells."""
    tn, fp, fn, tp = (F.col(name) for name in COUNTS)
    tpr, fpr = _ratio(tp, tp + fn), _ratio(fp, fp + tn)
    return counts.withColumns(
        {
            "true_positive_rate": tpr,
            "false_positive_rate": fpr,
            "protocol_auc": (F.lit(1.0) + tpr - fpr) / 2,
            "recall": tpr,
            "precision": _ratio(tp, tp + fp),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def score_counts(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score; ties become one row."""
    return predictions.groupBy(*keys, "score").agg(
        F.sum("y_true").alias("pos"), F.sum(1 - F.col("y_true")).alias("neg")
    )


def ranked_scores(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``pos_above``/``neg_above``: totals of strictly higher scores in the group,
    and ``next_pos``/``next_neg``: the counts of the next lower score.

    Rows are range-partitioned by group and score and stored, and the partition serves as
    the band: ranks are taken inside each band and shifted by the totals of the bands
    above, so no task ever sorts more than one range.
    """
    ranges = counts.repartitionByRange(*keys, F.desc("score"))
    banded = settle(ranges.withColumn("band", F.spark_partition_id()))
    order = Window.partitionBy(*keys, "band").orderBy(F.desc("score"))
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = banded.withColumns(
        {
            "pos_above": F.coalesce(F.sum("pos").over(above), F.lit(0)),
            "neg_above": F.coalesce(F.sum("neg").over(above), F.lit(0)),
            "next_pos": F.lead("pos").over(order),
            "next_neg": F.lead("neg").over(order),
        }
    )
    bands = Window.partitionBy(*keys).orderBy("band")
    higher = bands.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        banded.groupBy(*keys, "band")
        .agg(
            F.sum("pos").alias("band_pos"),
            F.sum("neg").alias("band_neg"),
            F.max_by(F.struct("pos", "neg"), "score").alias("head"),
        )
        .select(
            *keys,
            "band",
            F.coalesce(F.sum("band_pos").over(higher), F.lit(0)).alias("shift_pos"),
            F.coalesce(F.sum("band_neg").over(higher), F.lit(0)).alias("shift_neg"),
            F.lead("head").over(bands).alias("next_head"),
        )
    )
    joined = inside.join(totals, [*keys, "band"])
    return joined.withColumns(
        {
            "pos_above": F.col("pos_above") + F.col("shift_pos"),
            "neg_above": F.col("neg_above") + F.col("shift_neg"),
            "next_pos": F.coalesce("next_pos", "next_head.pos"),
            "next_neg": F.coalesce("next_neg", "next_head.neg"),
        }
    ).drop("band", "shift_pos", "shift_neg", "next_head")


def roc_auc(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per group; null unless both classes occur."""
    grouped = predictions.withColumn(ALL, F.lit(1))
    names = [ALL, *keys]
    ranked = ranked_scores(score_counts(grouped, names), names)
    lost = F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0)
    area = ranked.groupBy(*names).agg(
        F.sum(lost).alias("won"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return area.select(*names, F.when(pairs > 0, F.col("won") / pairs).alias("roc_auc"))


def evaluate(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One metrics row per group: rates, AUCs and the confusion counts."""
    grouped = predictions.withColumn(ALL, F.lit(1))
    names = [ALL, *keys]
    rates = with_rates(confusion_counts(grouped, names))
    return rates.join(roc_auc(predictions, keys), names, "left").select(*keys, *METRICS, *COUNTS)


def metric_record(metrics: DataFrame) -> DataFrame:
    """The nested form written to JSON: cells gathered in ``confusion_matrix``."""
    labels = F.array(F.lit("no"), F.lit("yes")).alias("labels")
    others = [c for c in metrics.columns if c not in COUNTS]
    return metrics.select(*others, F.struct(labels, *COUNTS).alias("confusion_matrix"))


def require_no_errors(predictions: DataFrame) -> None:
    """Metrics are refused as long as any answer failed."""
    failed = predictions.where(F.col("error").isNotNull()).count()
    if failed:
        raise ValueError(f"metrics refused: {failed} answers failed")


def gated_metrics(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Error count per group, and metrics for the groups without any error."""
    errors = predictions.groupBy(*keys).agg(
        F.count_if(F.col("error").isNotNull()).alias("error_count")
    )
    errors = settle(errors)
    passed = errors.where("error_count = 0").select(*keys)
    clean = predictions.join(passed, list(keys), "left_semi")
    return errors.join(evaluate(clean, keys), list(keys), "left")
