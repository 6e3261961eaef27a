"""TF-IDF vectors: fit once, then transform any number of rows without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.config import FeatureSpec
from postgauge.functions import text as X
from postgauge.operators.terms import (
    NORMALIZED,
    GramTable,
    check_limits,
    counted_documents,
    gram_vectors,
    kept_terms,
    most_frequent,
    of_spec,
    vocabulary_statistics,
)


def count_vectorizer(
    spark: SparkSession, terms: list[str], input_col: str, output_col: str
) -> CountVectorizerModel:
    """The library's count vectorizer over a given vocabulary.

    The vocabulary goes to the JVM as one string; handing over tens of thousands of
    elements one call at a time takes seconds.
    """
    split = spark._jvm.org.apache.commons.lang3.StringUtils.splitByWholeSeparatorPreserveAllTokens
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", split("\n".join(terms), "\n")
    )
    return model.setInputCol(input_col).setOutputCol(output_col)


def gram_counter(spark: SparkSession, terms: list[str], text: Column) -> Column:
    """Count vector of the character n-grams of a text, over a given vocabulary."""
    table = spark.sparkContext.broadcast(GramTable(terms))

    @F.arrow_udf(VectorUDT())
    def counted(texts: pa.Array) -> pa.Array:
        return gram_vectors(texts, table.value)

    return counted(text)


def scaled(frame: DataFrame, source: str, target: str, factors: np.ndarray) -> DataFrame:
    """Multiply a vector column by one factor per position."""
    return ElementwiseProduct(
        scalingVec=Vectors.dense(factors), inputCol=source, outputCol=target
    ).transform(frame)


def unit_length(frame: DataFrame, source: str, target: str) -> DataFrame:
    return Normalizer(p=2.0, inputCol=source, outputCol=target).transform(frame)


def vector_total(vector: Column) -> Column:
    """Sum of the stored values; zero for an empty vector."""
    values = F.unwrap_udt(vector).getField("values")
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary: at most ``max_features`` terms, in term order."""

    spec: FeatureSpec
    n_docs: int
    terms: list[str]
    df: np.ndarray
    tf: np.ndarray

    @property
    def idf(self) -> np.ndarray:
        return np.log((1.0 + self.n_docs) / (1.0 + self.df)) + 1.0

    def counts(self, docs: DataFrame, target: str = "counts") -> DataFrame:
        """Add the term-count vector of the normalised text."""
        if self.spec.analyzer == "char_wb":
            return docs.withColumn(target, gram_counter(docs.sparkSession, self.terms, F.col(NORMALIZED)))
        model = count_vectorizer(docs.sparkSession, self.terms, "_terms", target)
        tokens = docs.withColumn("_terms", X.terms(F.col(NORMALIZED), self.spec))
        return model.transform(tokens).drop("_terms")

    def weigh(self, counted: DataFrame, source: str = "counts", target: str = "tfidf") -> DataFrame:
        """Turn term counts into TF-IDF vectors of unit length."""
        raised = scaled(counted, source, "_raised", self.idf)
        return unit_length(raised, "_raised", target).drop("_raised")

    def transform(self, docs: DataFrame, target: str = "tfidf") -> DataFrame:
        """Add the TF-IDF vector; a text without known terms keeps a zero vector."""
        return self.weigh(self.counts(docs), target=target).drop("counts")

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """The vocabulary as a table; its size is bounded by ``max_features``."""
        rows = zip(
            self.terms,
            range(len(self.terms)),
            self.df.astype(int).tolist(),
            self.tf.astype(int).tolist(),
            self.idf.tolist(),
            strict=True,
        )
        return spark.createDataFrame(
            list(rows), "term string, idx int, df bigint, tf bigint, idf double"
        )


def entries(frame: DataFrame, vector: str, keys: list[str], value: str = "tfidf") -> DataFrame:
    """Unfold a vector column to ``(keys, idx, value)`` rows; empty vectors vanish."""
    inner = F.unwrap_udt(F.col(vector))
    values = inner.getField("values")
    dense = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1))
    places = F.when(inner.getField("type") == 0, inner.getField("indices")).otherwise(dense)
    pairs = F.arrays_zip(places.alias("i"), values.alias("v"))
    unfolded = frame.select(*keys, F.explode(pairs).alias("_pair"))
    return unfolded.select(
        *keys, F.col("_pair.i").alias("idx"), F.col("_pair.v").alias(value)
    )


def fit_all_tfidf(docs: DataFrame, specs: Sequence[FeatureSpec]) -> list[TfidfModel]:
    """The vocabularies of several configurations from one pass over the documents."""
    stats = vocabulary_statistics(docs, specs)
    n_docs = counted_documents(stats)
    for spec in specs:
        check_limits(spec, n_docs)
    models = []
    for bit, spec in enumerate(specs):
        kept = kept_terms(of_spec(stats, bit), spec, n_docs)
        models.append(model_from_rows(most_frequent(kept, spec.max_features).collect(), spec, n_docs))
    return models


def fit_tfidf(docs: DataFrame, spec: FeatureSpec) -> TfidfModel:
    """Choose the vocabulary of the training documents (column ``normalized``)."""
    return fit_all_tfidf(docs, [spec])[0]


def model_from_rows(rows: list, spec: FeatureSpec, n_docs: int) -> TfidfModel:
    """A model from the bounded list of chosen (term, df, tf) rows."""
    if not rows:
        raise ValueError("no term is left within the document-frequency limits")
    ordered = sorted(rows, key=lambda row: row["term"])
    return TfidfModel(
        spec=spec,
        n_docs=n_docs,
        terms=[row["term"] for row in ordered],
        df=np.array([row["df"] for row in ordered], dtype=float),
        tf=np.array([row["tf"] for row in ordered], dtype=float),
    )
