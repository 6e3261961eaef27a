"""Fitted models as tables."""

from __future__ import annotations

from dataclasses import asdict

import numpy as np
from pyspark.sql import SparkSession

from postgauge.config import FeatureSpec
from postgauge.operators.classifiers import LinearFit
from postgauge.operators.tfidf import TfidfModel

TERMS_SCHEMA = "term string, df double, tf double, weight double"
PARAMS_SCHEMA = (
    "classifier string, intercept double, n_docs bigint, name string, analyzer string, "
    "min_n int, max_n int, max_features int, min_df int, max_df double"
)


def save_model(spark: SparkSession, path: str, features: TfidfModel, fit: LinearFit) -> None:
    """One row per term and one row of parameters; both have bounded size."""
    rows = zip(
        features.terms,
        features.df.tolist(),
        features.tf.tolist(),
        fit.weights.tolist(),
        strict=True,
    )
    params = {
        "classifier": fit.classifier,
        "intercept": fit.intercept,
        "n_docs": features.n_docs,
        **asdict(features.spec),
    }
    names = [field.split()[0] for field in PARAMS_SCHEMA.split(", ")]
    spark.createDataFrame(list(rows), TERMS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/terms"
    )
    spark.createDataFrame([tuple(params[n] for n in names)], PARAMS_SCHEMA).coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/params")


def load_model(spark: SparkSession, path: str) -> tuple[TfidfModel, LinearFit]:
    params = spark.read.parquet(f"{path}/params").first().asDict()
    rows = spark.read.parquet(f"{path}/terms").orderBy("term").collect()
    rows.sort(key=lambda row: row["term"])
    classifier, intercept, n_docs = (params.pop(k) for k in ("classifier", "intercept", "n_docs"))
    features = TfidfModel(
        spec=FeatureSpec(**params),
        n_docs=n_docs,
        terms=[row["term"] for row in rows],
        df=np.array([row["df"] for row in rows]),
        tf=np.array([row["tf"] for row in rows]),
    )
    return features, LinearFit(classifier, np.array([row["weight"] for row in rows]), intercept)
