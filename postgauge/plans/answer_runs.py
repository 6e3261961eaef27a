"""Generated answers of every model and prompt mode, logged before anything reads them.

The log is the only state. An answer is appended under its (model, prompt mode, post, attempt)
as soon as the task that asked for it commits, before it is parsed; what to ask next is always
the requests less what the log answers: nothing logged yet, or fewer invalid answers than
attempts. A rerun after a failure therefore asks only for what no committed task asked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.config import TEXT_ID, USER, AnswerSettings
from postgauge.functions.answers import evidence_json
from postgauge.functions.keys import model_slug
from postgauge.functions.prompts import prompt_for
from postgauge.operators.answers import CELL, replay_matrix, validate
from postgauge.operators.comparison import answer_rows
from postgauge.operators.metrics import gated_metrics
from postgauge.operators.providers import BatchProvider, Limits, call_all
from postgauge.operators.splitting import few_shot_examples, require_examples
from postgauge.operators.terms import NORMALIZED
from postgauge.session import settle
from postgauge.sources.results import path_exists, read_answers, write_table

_LOGGED = "text_id string, user_id string, raw_response string, failure string, attempt long"
#: Requests of one task about, which is what a lost task may ask for again.
TASK_REQUESTS = 512


def logged(spark: SparkSession, path: str) -> DataFrame | None:
    """All answers of the log, judged, or None without a log."""
    if not path_exists(spark, path):
        return None
    judged = validate(read_answers(spark, path).withColumnRenamed("error", "failure"))
    return judged.withColumn("error", F.coalesce("failure", "error"))


def open_requests(
    posts: DataFrame, log: DataFrame | None, model: str, mode: str, max_attempts: int
) -> DataFrame:
    """Posts still to be asked about, with the number of the next ``attempt``."""
    wanted = posts.select(
        F.col(TEXT_ID).cast("string").alias(TEXT_ID), F.col(USER).cast("string").alias(USER), NORMALIZED
    )
    if log is None:
        return wanted.withColumn("attempt", F.lit(1).cast("long"))
    cell = log.where((F.col("model") == model) & (F.col("prompt_mode") == mode))
    known = cell.groupBy(TEXT_ID).agg(
        F.max("attempt").alias("tried"), F.bool_or(F.col("error").isNull()).alias("answered")
    )
    again = wanted.join(known, TEXT_ID, "left").where(
        ~F.coalesce("answered", F.lit(False)) & (F.coalesce("tried", F.lit(0)) < max_attempts)
    )
    return again.select(*wanted.columns, (F.coalesce("tried", F.lit(0)) + 1).alias("attempt"))


def _asked(provider: BatchProvider, model: str, limits: Limits):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers, failures = call_all(provider, model, batch["prompt"].tolist(), limits)
            texts = ["" if answer is None else answer for answer in answers]
            yield batch.drop(columns="prompt").assign(raw_response=texts, failure=failures)[
                [TEXT_ID, USER, "raw_response", "failure", "attempt"]
            ]

    return run


@dataclass(frozen=True)
class AnswerRun:
    """What a run needs besides the posts."""

    provider: BatchProvider
    path: str
    settings: AnswerSettings = AnswerSettings()
    models: tuple[str, ...] = ()
    modes: tuple[str, ...] = ()
    seed: int = 42
    limits: Limits = Limits()

    @property
    def log_path(self) -> str:
        return f"{self.path}/answers"

    @property
    def cells(self) -> list[tuple[str, str]]:
        models = self.models or self.settings.matrix_models
        return [(m, p) for m in models for p in (self.modes or self.settings.prompt_modes)]


def ask_cell(
    posts: DataFrame, run: AnswerRun, model: str, mode: str, examples: Sequence[tuple[str, str]]
) -> int:
    """Ask for all that the log lacks of one cell; gives the number of rounds it took.

    A task's answers stay in the log once it commits, even if the job fails later.
    """
    spark = posts.sparkSession
    started = datetime.now()
    for rounds in range(run.settings.max_attempts + 1):
        log = logged(spark, run.log_path)
        pending = settle(open_requests(posts, log, model, mode, run.settings.max_attempts))
        count = pending.count()
        if not count:
            return rounds
        dealt = pending.repartition(-(-count // TASK_REQUESTS), TEXT_ID)
        prompts = dealt.select(
            TEXT_ID, USER, "attempt", prompt_for(mode, F.col(NORMALIZED), examples).alias("prompt")
        )
        answers = prompts.mapInPandas(_asked(run.provider, model, run.limits), _LOGGED)
        named = answers.withColumns(
            {
                "model": F.lit(model),
                "prompt_mode": F.lit(mode),
                "run_started": F.lit(started).cast("timestamp"),
                "error": F.col("failure"),
            }
        ).drop("failure")
        writer = named.write.mode("append").partitionBy(*CELL)
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(run.log_path)
    return run.settings.max_attempts


def run_answers(train: DataFrame, test: DataFrame, run: AnswerRun) -> tuple[DataFrame, DataFrame]:
    """Ask for all cells, then judge the log: predictions and one comparison row per cell.

    Both inputs need ``normalized``. Predictions, the summary as CSV and JSON and, with a
    few-shot mode, the examples with where they come from are written below ``run.path``.
    """
    spark = test.sparkSession
    examples: list[tuple[str, str]] = []
    size = run.settings.examples_per_class
    if any(mode == "few_shot" for _, mode in run.cells):
        chosen = settle(few_shot_examples(train, size, run.seed))
        examples = [(r["label"], r["text"]) for r in require_examples(chosen, size)]
        origin = chosen.withColumns(
            {
                "examples_per_class": F.lit(size),
                "random_state": F.lit(run.seed),
                "timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"),
            }
        )
        write_table(origin.coalesce(1), f"{run.path}/few_shot_examples", "json")
    for model, mode in run.cells:
        ask_cell(test, run, model, mode, examples if mode == "few_shot" else ())
    stored = read_answers(spark, run.log_path)
    failed = stored.withColumn(
        "raw_response", F.when(F.col("error").isNull(), F.col("raw_response")).otherwise("")
    )
    cells = spark.createDataFrame(run.cells, "model string, prompt_mode string")
    predictions = settle(replay_matrix(test, failed, cells))
    flat = predictions.withColumn("evidence", evidence_json(F.col("evidence")))
    write_table(flat, f"{run.path}/predictions", "csv")
    if "y_true" not in predictions.columns:
        summary = predictions.groupBy(*CELL).agg(F.count("error").alias("error_count"))
    else:
        cell_path = F.concat_ws("_", model_slug(F.col("model")), "prompt_mode")
        summary = answer_rows(gated_metrics(predictions, CELL)).withColumns(
            {
                "predictions_path": F.lit(f"{run.path}/predictions"),
                "raw_responses_path": F.concat(
                    F.lit(f"{run.log_path}/model="), "model", F.lit("/prompt_mode="), "prompt_mode"
                ),
                "cell": cell_path,
            }
        )
    summary = settle(summary)
    write_table(summary.coalesce(1), f"{run.path}/summary", "csv")
    write_table(summary.coalesce(1), f"{run.path}/summary.json", "json")
    return predictions, summary
