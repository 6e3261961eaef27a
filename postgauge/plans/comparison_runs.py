"""The comparison of methods from whatever their runs have written, and dense runs from posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.config import TARGET, AnswerSettings, Settings
from postgauge.operators.comparison import SINGLE_METHODS, combine_methods, embedding_rows, method_rows
from postgauge.operators.embeddings import EmbeddingProvider, embed, embedding_requests
from postgauge.operators.metrics import evaluate
from postgauge.operators.providers import BatchProvider, Limits
from postgauge.plans.matrices import embedding_predictions
from postgauge.session import settle
from postgauge.sources.embedding_store import append_store, read_store
from postgauge.sources.results import read_method_metrics, read_summary_csv, write_table


def compare_methods(
    spark: SparkSession,
    metrics: Mapping[str, str],
    summaries: Sequence[str] = (),
    allow_missing: bool = False,
) -> DataFrame:
    """One row per method, representation and classifier; of several the last source wins.

    ``metrics`` maps baseline, embeddings and answers to metric records, which must exist
    unless ``allow_missing``. ``summaries`` are optional tables that already have these
    columns; their others are kept, null where a source lacks them. ``place`` gives the order.
    """
    sources = []
    for name, (method, representation, classifier) in SINGLE_METHODS.items():
        if name not in metrics:
            continue
        found = read_method_metrics(spark, metrics[name], allow_missing)
        if found is not None:
            words = map(F.lit, (method, representation, classifier, metrics[name]))
            sources.append(method_rows(found, *words).withColumn("place", F.lit(0).cast("long")))
    for path in summaries:
        found = read_summary_csv(spark, path)
        if found is not None:
            sources.append(found.withColumn("place", F.monotonically_increasing_id()))
    numbered = [s.withColumn("source", F.lit(number)) for number, s in enumerate(sources)]
    return combine_methods(numbered, order=["place"]).orderBy("source", "place")


def write_comparison(table: DataFrame, path: str) -> None:
    """The table as CSV, and as one JSON record with the time it was written."""
    rows = settle(table)
    shown = rows.orderBy("source", "place").drop("source", "place")
    write_table(shown.coalesce(1), f"{path}/comparison", "csv")
    fields = [c for c in rows.columns if c not in ("source", "place")]
    listed = F.array_sort(F.collect_list(F.struct("source", "place", F.struct(*fields).alias("row"))))
    record = rows.agg(listed.alias("rows")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"),
        F.col("rows.row").alias("rows"),
    )
    write_table(record, f"{path}/comparison.json", "json")


def run_embeddings(
    train: DataFrame,
    test: DataFrame,
    provider: EmbeddingProvider | BatchProvider,
    path: str,
    settings: AnswerSettings = AnswerSettings(),
    limits: Limits | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Dense classifiers from posts: stored vectors, the missing ones, fits and comparison rows.

    Both inputs need ``normalized``. Only the shelves of the requests are read; new vectors are
    stored before anything is fitted, so a rerun asks for nothing again. Predictions
    and, with labels, the summary with its path columns are written below ``path``.
    """
    spark = train.sparkSession
    store = f"{path}/store"
    sides = []
    for posts in (train, test):
        wanted = embedding_requests(posts, settings.embedding_model, settings.embedding_max_chars)
        known = read_store(spark, store, wanted)
        filled, fresh = embed(
            posts, known, provider, settings.embedding_model, settings.embedding_max_chars, limits
        )
        append_store(fresh, store)
        sides.append(settle(filled))
    labelled = TARGET in test.columns
    predictions = settle(
        embedding_predictions(sides[0], sides[1], "all", Settings(), include_truth=labelled)
    )
    write_table(predictions, f"{path}/predictions", "csv")
    if not labelled:
        return predictions, None
    summary = embedding_rows(evaluate(predictions, ["classifier"])).withColumns(
        {
            "metrics_path": F.lit(f"{path}/summary.json"),
            "predictions_path": F.lit(f"{path}/predictions"),
            "cache_path": F.lit(store),
        }
    )
    summary = settle(summary)
    write_table(summary.coalesce(1), f"{path}/summary", "csv")
    write_table(summary.coalesce(1), f"{path}/summary.json", "json")
    return predictions, summary
