"""Embeddings with a table of known vectors, and dense classifiers on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.config import DENSE_CLASSIFIERS, TARGET, TEXT_ID, Settings, choose
from postgauge.functions.text import truncate
from postgauge.operators.classifiers import (
    TOLERANCE,
    LinearFit,
    class_counts,
    iterative_problem,
    vector_length,
)
from postgauge.operators.linear_solver import minimise_all, packed_rows
from postgauge.operators.providers import BatchProvider, Limits, batched, call_all
from postgauge.operators.terms import NORMALIZED
from postgauge.session import settle

EmbeddingProvider = Callable[[str, str], list[float]]
CACHE_KEY = (TEXT_ID, "model", "text_hash")
CACHE_SCHEMA = T.StructType(
    [
        *(T.StructField(name, T.StringType()) for name in CACHE_KEY),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
    ]
)


def embedding_requests(posts: DataFrame, model: str, max_chars: int) -> DataFrame:
    """What each post needs: its cut text and the key a stored vector must match."""
    cut = truncate(F.col(NORMALIZED), max_chars)
    return posts.withColumn("cut", cut).withColumns(
        {"model": F.lit(model), "text_hash": F.sha2("cut", 256)}
    )


def cache_misses(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests without a stored vector for the same post, model and text."""
    return requests.join(cache.select(*CACHE_KEY), list(CACHE_KEY), "left_anti")


def check_vectors(cache: DataFrame) -> DataFrame:
    """Stored vectors must not be empty."""
    bad = cache.where(F.col("embedding").isNull() | (F.size("embedding") == 0)).limit(1).collect()
    if bad:
        raise ValueError(f"invalid stored embedding for text_id={bad[0][TEXT_ID]}")
    return cache


def _embed(provider: BatchProvider, model: str, limits: Limits):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, failures = call_all(provider, model, batch["cut"].tolist(), limits)
            failed = [text for text in failures if text is not None]
            if failed:
                raise RuntimeError(f"embedding failed: {failed[0]}")
            vectors = [[float(x) for x in vector] for vector in found]
            yield batch.drop(columns="cut").assign(embedding=vectors)

    return run


def embed(
    posts: DataFrame,
    cache: DataFrame,
    provider: EmbeddingProvider | BatchProvider,
    model: str,
    max_chars: int = 6_000,
    limits: Limits | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Posts with an ``embedding`` column, and the rows to append to the stored table.

    The provider only sees posts that are not stored yet; all vectors must share one
    length. With ``limits`` it takes many texts at once.
    """
    many = provider if limits else batched(provider)
    requests = embedding_requests(posts.withColumn(TEXT_ID, F.col(TEXT_ID).cast("string")), model, max_chars)
    missing = cache_misses(requests, check_vectors(cache)).select(*CACHE_KEY, "cut")
    fresh = settle(missing.dropDuplicates(list(CACHE_KEY)).mapInPandas(_embed(many, model, limits or Limits()), CACHE_SCHEMA))
    stored = (
        cache.where(F.col("model") == model).groupBy(*CACHE_KEY).agg(F.max("embedding").alias("embedding"))
    )
    known = stored.unionByName(fresh)
    joined = requests.join(known, list(CACHE_KEY), "left").drop("cut", "model", "text_hash")
    lengths = joined.agg(
        F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")
    ).first()
    if lengths["low"] is None:
        raise ValueError("no posts to embed")
    if lengths["low"] != lengths["high"]:
        raise ValueError("embeddings have different lengths")
    return joined, fresh


def dense_vectors(frame: DataFrame) -> DataFrame:
    return frame.withColumn("vector", array_to_vector(F.col("embedding").cast("array<double>")))


def fit_all_dense(
    train: DataFrame, classifiers: Sequence[str], settings: Settings = Settings()
) -> list[LinearFit]:
    """Classifiers over the ``embedding`` and target columns, solved in the same passes."""
    names = [choose(name, DENSE_CLASSIFIERS, "embedding classifier")[0] for name in classifiers]
    vectors = settle(dense_vectors(train).select("vector", TARGET))
    counts, size = class_counts(vectors), vector_length(vectors, "vector")
    problems = [iterative_problem(name, counts, settings, size) for name in names]
    solved = minimise_all([packed_rows(vectors, "vector", TARGET)], problems, tol=TOLERANCE)
    return [LinearFit(n, x[:-1], float(x[-1])) for n, x in zip(names, solved, strict=True)]


def fit_dense(train: DataFrame, classifier: str, settings: Settings = Settings()) -> LinearFit:
    """One classifier over the ``embedding`` and target columns."""
    return fit_all_dense(train, [classifier], settings)[0]
