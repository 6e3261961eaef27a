"""Tracked runs over the classifier x feature grid."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from postgauge.config import Settings
from postgauge.functions.keys import run_id as run_id_column
from postgauge.plans.training import SharedFeatures, train_and_validate
from postgauge.sources.results import (
    METADATA_FILE,
    METADATA_SCHEMA,
    METRICS_FILE,
    read_run_summary,
    write_table,
)


def utc_now() -> str:
    """UTC time to the second, ending in Z."""
    return datetime.now(tz=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def make_run_id(spark, experiment: str, classifier: str, features: str, started_at: str) -> str:
    names = (F.lit(v) for v in (experiment, classifier, features, started_at))
    return spark.range(1).select(run_id_column(*names)).first()[0]


def run_experiment(
    posts: DataFrame,
    settings: Settings,
    base: str,
    experiment: str = "experiment",
    run: str | None = None,
    input_path: str = "",
    with_model: bool = True,
    shared: Callable[[], SharedFeatures] | None = None,
) -> DataFrame:
    """One run: fit, evaluate and write its tables; a failure is recorded, then raised.

    ``shared`` gives the features when several runs use them; failing to make them is a
    failure of the run.
    """
    spark = posts.sparkSession
    started, clock = utc_now(), time.perf_counter()
    run = run or make_run_id(spark, experiment, settings.classifier, settings.features, started)
    folder = f"{base}/{run}"
    error: Exception | None = None
    try:
        features = shared() if shared else None
        train_and_validate(posts, settings, features).write(folder, with_model)
    except Exception as failure:  # noqa: BLE001 - whatever failed belongs in the record
        error = failure
    record = Row(
        run_id=run,
        status="failed" if error else "completed",
        experiment_name=experiment,
        classifier_name=settings.classifier,
        feature_config_name=settings.features,
        started_at=started,
        completed_at=utc_now(),
        duration_seconds=round(time.perf_counter() - clock, 4),
        random_state=settings.random_state,
        validation_size=settings.validation_size,
        input_path=input_path,
        metrics_path=f"{folder}/{METRICS_FILE}",
        predictions_path=f"{folder}/predictions",
        interpretability_path=f"{folder}/report",
        model_path=f"{folder}/model" if with_model else None,
        error=str(error) if error else None,
    )
    metadata = spark.createDataFrame([record], METADATA_SCHEMA).coalesce(1)
    metadata.write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{folder}/{METADATA_FILE}"
    )
    if error:
        raise error
    return metadata


def run_grid(
    posts: DataFrame,
    pairs: Sequence[tuple[str, str]],
    base: str,
    settings: Settings = Settings(),
    experiment: str = "experiment",
    continue_on_error: bool = False,
    run: str | None = None,
    with_model: bool = True,
) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """All pairs in turn; returns the rebuilt run summary and the failures.

    The pairs of one feature configuration share its split, vocabulary and vectors. The
    summary is also written, as CSV and as JSON.
    """
    if run and len(pairs) > 1:
        raise ValueError("a run name fits a single pair only")
    failures = []
    made: dict[str, SharedFeatures] = {}

    def features_of(chosen: Settings) -> SharedFeatures:
        if chosen.features not in made:
            made[chosen.features] = SharedFeatures(posts, chosen)
        return made[chosen.features]

    for classifier, features in pairs:
        try:
            chosen = settings.with_pair(classifier, features)
            run_experiment(
                posts,
                chosen,
                base,
                experiment,
                run,
                with_model=with_model,
                shared=partial(features_of, chosen),
            )
        except Exception as failure:  # noqa: BLE001 - recorded with its pair
            if not continue_on_error:
                raise
            failures.append((classifier, features, str(failure)))
    summary = read_run_summary(posts.sparkSession, base)
    for kind in ("csv", "json"):
        write_table(summary, f"{base}/run_summary.{kind}", kind)
    return summary, failures
