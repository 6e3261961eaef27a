"""Generated answers: calling a provider, replaying stored answers, model matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.config import TARGET, TEXT_ID, USER
from postgauge.functions.answers import answer_document, parsed_answer
from postgauge.functions.labels import answer_label
from postgauge.functions.prompts import prompt_for
from postgauge.operators.terms import NORMALIZED
from postgauge.session import settle

Provider = Callable[[str, str], str]
CELL = ("model", "prompt_mode")
ANSWER_ORDER = ("run_started", "attempt", "seq", "position")


def last_answers(stored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The newest answer per post; a missing text is empty.

    Answers are ordered by the start of their run and the attempt, older logs by their
    number or else by their place in the stored files.
    """
    known = [name for name in ANSWER_ORDER if name in stored.columns]
    if not known:
        raise ValueError(f"stored answers need one of: {', '.join(ANSWER_ORDER)}")
    text = F.coalesce("raw_response", F.lit(""))
    return stored.groupBy(*keys, F.col(TEXT_ID).cast("string").alias(TEXT_ID)).agg(
        F.max_by(text, F.struct(*known, text.alias("text"))).alias("raw_response")
    )


def validate(frame: DataFrame) -> DataFrame:
    """Parse ``raw_response`` into prediction columns; a rejected answer has an error text."""
    read = frame.withColumn("_document", answer_document(F.col("raw_response")))
    parsed = read.withColumn("_answer", parsed_answer(F.col("_document")))
    return parsed.withColumns(
        {
            "y_pred": answer_label(F.col("_answer.label")),
            "label_pred": F.col("_answer.label"),
            "score": F.col("_answer.score"),
            "evidence": F.col("_answer.evidence"),
            "justification": F.col("_answer.justification"),
            "error": F.col("_answer.error"),
        }
    ).drop("_document", "_answer")


def _with_truth(posts: DataFrame) -> list:
    return [F.col(TARGET).alias("y_true")] if TARGET in posts.columns else []


def replay(posts: DataFrame, stored: DataFrame) -> DataFrame:
    """Predictions from stored answers; a post without one counts as invalid JSON."""
    keyed = posts.select(F.col(TEXT_ID).cast("string").alias(TEXT_ID), USER, *_with_truth(posts))
    joined = keyed.join(last_answers(stored), TEXT_ID, "left")
    return validate(joined).drop("raw_response")


def replay_matrix(posts: DataFrame, stored: DataFrame, cells: DataFrame) -> DataFrame:
    """Predictions of every model and prompt mode from one stored table.

    The few cells travel inside each post row as an array, so no row product is joined.
    """
    wanted = [tuple(row) for row in cells.select(*CELL).distinct().orderBy(*CELL).collect()]
    pairs = F.array(
        *(F.struct(F.lit(m).alias("model"), F.lit(p).alias("prompt_mode")) for m, p in wanted)
    )
    keyed = posts.select(
        F.col(TEXT_ID).cast("string").alias(TEXT_ID), USER, *_with_truth(posts), F.inline(pairs)
    )
    answers = last_answers(stored, CELL)
    return validate(keyed.join(answers, [*CELL, TEXT_ID], "left")).drop("raw_response")


def _ask(provider: Provider, model: str):
    """Send each prompt to the provider; a raised error becomes the row's error text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers, failures = [], []
            for prompt in batch["prompt"]:
                try:
                    answers.append(provider(model, prompt))
                    failures.append(None)
                except Exception as failure:  # noqa: BLE001 - providers may raise anything
                    answers.append("")
                    failures.append(str(failure))
            yield batch.drop(columns="prompt").assign(raw_response=answers, failure=failures)

    return run


def classify(
    posts: DataFrame,
    provider: Provider,
    model: str,
    prompt_mode: str = "zero_shot",
    examples: Sequence[tuple[str, str]] = (),
    max_attempts: int = 2,
    run_started: datetime | None = None,
) -> DataFrame:
    """Ask for an answer per post and ask again, up to ``max_attempts``, while it is invalid.

    Expects the ``normalized`` column. Each round is judged and stored in one job, so
    later steps never call the provider again; only failed rows keep their prompt.
    ``run_started`` (now, unless given) orders the stored answers of repeated runs.
    """
    started = run_started or datetime.now()
    fields = [
        T.StructField(TEXT_ID, T.StringType()),
        T.StructField(USER, T.StringType()),
        *([T.StructField("y_true", T.IntegerType())] if TARGET in posts.columns else []),
    ]
    sent = ("_sent", "raw_response", "failure")
    asked = T.StructType([*fields, *(T.StructField(name, T.StringType()) for name in sent)])
    columns = [field.name for field in fields]
    pending = posts.select(
        F.col(TEXT_ID).cast("string").alias(TEXT_ID),
        F.col(USER).cast("string").alias(USER),
        *_with_truth(posts),
        prompt_for(prompt_mode, F.col(NORMALIZED), examples).alias("prompt"),
    )
    done = []
    for attempt in range(1, max_attempts + 1):
        raw = pending.select("*", F.col("prompt").alias("_sent")).mapInPandas(
            _ask(provider, model), asked
        )
        error = F.coalesce("failure", "error")
        judged = settle(
            validate(raw)
            .withColumns({"error": error, "attempts": F.lit(attempt)})
            .withColumn("_sent", F.when(F.col("error").isNotNull(), F.col("_sent")))
        )
        if attempt == max_attempts:
            done.append(judged)
            break
        done.append(judged.where(F.col("error").isNull()))
        failed = judged.where(F.col("error").isNotNull())
        pending = failed.select(*columns, F.col("_sent").alias("prompt"))
        if pending.isEmpty():
            break
    answered = reduce(lambda a, b: a.unionByName(b), done).drop("_sent", "failure")
    return answered.withColumns(
        {
            "model": F.lit(model),
            "prompt_mode": F.lit(prompt_mode),
            "run_started": F.lit(started).cast("timestamp"),
        }
    )


def raw_answers(classified: DataFrame) -> DataFrame:
    """The columns stored for a later replay."""
    return classified.select(
        TEXT_ID,
        USER,
        "model",
        "prompt_mode",
        "raw_response",
        "error",
        "run_started",
        F.col("attempts").alias("attempt"),
    )
