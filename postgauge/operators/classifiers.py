"""Five linear classifiers with one fitted form: weights, intercept and a link."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.config import CLASSIFIERS, NAIVE_BAYES, TARGET, Settings
from postgauge.operators.linear_solver import Objective, Problem, minimise_all, packed_rows
from postgauge.operators.tfidf import entries, scaled, vector_total

#: Fits stop once no gradient entry exceeds this share of the largest at the start.
TOLERANCE = 1e-5


@dataclass(frozen=True)
class LinearFit:
    """A decision ``x . weights + intercept > 0``; the score is its logistic or itself."""

    classifier: str
    weights: np.ndarray
    intercept: float

    @property
    def probabilistic(self) -> bool:
        return self.classifier != "linear_svm"

    def score(self, frame: DataFrame, vector: str, suffix: str = "") -> DataFrame:
        """Add ``score`` and ``y_pred``; runs inside each row, without a shuffle.

        A margin of exactly zero belongs to class 0.
        """
        weighted = scaled(frame, vector, "_contribution", self.weights)
        margin = vector_total(F.col("_contribution")) + F.lit(float(self.intercept))
        marked = weighted.withColumn("_margin", margin)
        score = 1.0 / (1.0 + F.exp(-F.col("_margin"))) if self.probabilistic else F.col("_margin")
        return marked.withColumns(
            {f"y_pred{suffix}": (F.col("_margin") > 0).cast("int"), f"score{suffix}": score}
        ).drop("_contribution", "_margin")


@dataclass(frozen=True)
class ClassSums:
    """Per class: number of rows and the sum of their vectors."""

    rows: tuple[int, int]
    sums: tuple[np.ndarray, np.ndarray]


def class_counts(frame: DataFrame) -> tuple[int, int]:
    """Rows of class 0 and class 1; one class alone cannot be trained on."""
    rows = frame.groupBy(TARGET).count().collect()
    found = {row[TARGET]: row["count"] for row in rows}
    counts = (found.get(0, 0), found.get(1, 0))
    require_two_classes(counts)
    return counts


def require_two_classes(counts: tuple[int, int]) -> None:
    if min(counts) == 0:
        raise ValueError("training needs at least two classes")


def balanced_weights(counts: tuple[int, int]) -> tuple[float, float]:
    """Weights that give both classes the same total: n / (2 n_c)."""
    total = sum(counts)
    return total / (2.0 * counts[0]), total / (2.0 * counts[1])


def class_sums(frame: DataFrame, vector: str, size: int) -> ClassSums:
    """Sums of vectors of length ``size`` from (class, term) partial sums.

    The shuffle carries one number per class and term; at most ``2 * size`` rows come back.
    """
    counts = class_counts(frame)
    rows = entries(frame, vector, [TARGET]).groupBy(TARGET, "idx").agg(F.sum("tfidf").alias("total"))
    sums = (np.zeros(size), np.zeros(size))
    for row in rows.collect():
        sums[row[TARGET]][row["idx"]] = row["total"]
    return ClassSums(rows=counts, sums=sums)


def vector_length(frame: DataFrame, vector: str) -> int:
    """Length of the vectors in a column, from its first row."""
    inner = F.unwrap_udt(F.col(vector))
    length = F.when(inner.getField("type") == 0, inner.getField("size"))
    return frame.select(F.coalesce(length, F.size(inner.getField("values"))).alias("n")).first()["n"]


def fit_naive_bayes(sums: ClassSums, classifier: str, alpha: float) -> LinearFit:
    """Smoothed log share of each term in class 1 minus class 0.

    With two classes the complement of one class is the other, so both variants share
    their weights; only the multinomial one adds the log ratio of the class sizes.
    """
    logs = [np.log(s + alpha) - np.log((s + alpha).sum()) for s in sums.sums]
    prior = float(np.log(sums.rows[1]) - np.log(sums.rows[0]))
    intercept = prior if classifier == "multinomial_nb" else 0.0
    return LinearFit(classifier, logs[1] - logs[0], intercept)


def fit_classifier(
    frame: DataFrame, vector: str, settings: Settings, size: int | None = None
) -> LinearFit:
    """Fit the classifier named in the settings on ``vector`` and the target column.

    ``size`` is the length of the vectors; a caller that knows it saves a job.
    """
    name = settings.classifier
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier: {name}")
    if name in NAIVE_BAYES:
        size = size or vector_length(frame, vector)
        return fit_naive_bayes(class_sums(frame, vector, size), name, settings.nb_alpha)

    counts = class_counts(frame)
    size = size or vector_length(frame, vector)
    problem = iterative_problem(name, counts, settings, size)
    (solution,) = minimise_all([packed_rows(frame, vector, TARGET)], [problem], tol=TOLERANCE)
    return LinearFit(name, solution[:-1], float(solution[-1]))


def iterative_problem(
    name: str, counts: tuple[int, int], settings: Settings, size: int, **where
) -> Problem:
    """What an iterative classifier minimises, given the class sizes of its training rows.

    ``where`` names the rows: the block set, the fold left out and the scaling.
    """
    require_two_classes(counts)
    weights = balanced_weights(counts) if settings.balanced else (1.0, 1.0)
    total = weights[0] * counts[0] + weights[1] * counts[1]
    objective = {
        "logistic_regression": Objective("logistic", settings.logistic_c, 1.0, False, settings.logistic_max_iter),
        "sgd_logistic": Objective("logistic", 1.0 / total, settings.sgd_alpha, False, settings.sgd_max_iter),
        "linear_svm": Objective("squared_hinge", settings.svm_c, 1.0, True, settings.svm_max_iter),
    }[name]
    return Problem(part=where.pop("part", 0), size=size, objective=objective, weights=weights, **where)


def optimality(frame: DataFrame, vector: str, fit: LinearFit, settings: Settings) -> DataFrame:
    """One row that proves or disproves a fit: classifier_name, n, count_0, count_1,
    first_gradient, last_gradient and optimal.

    The gradients at the start and at the fit come from one aggregate of its own over the
    unfolded vectors, which shares nothing with the solver; only the weights are handed in,
    a table as long as the vocabulary.
    """
    spark = frame.sparkSession
    counts = class_counts(frame)
    problem = iterative_problem(fit.classifier, counts, settings, len(fit.weights))
    goal = problem.objective
    sign = F.when(F.col(TARGET) == 1, 1.0).otherwise(-1.0)
    weight = F.when(F.col(TARGET) == 1, problem.weights[1]).otherwise(problem.weights[0])

    def slope(margin) -> Column:
        if goal.loss == "logistic":
            return -sign / (1.0 + F.exp(sign * margin))
        return -2.0 * sign * F.greatest(F.lit(0.0), 1.0 - sign * margin)

    weighted = scaled(frame.select(vector, TARGET), vector, "_part", fit.weights)
    margin = vector_total(F.col("_part")) + F.lit(float(fit.intercept))
    pulled = weighted.select(
        vector,
        (weight * slope(F.lit(0.0))).alias("first"),
        (weight * slope(margin)).alias("last"),
    )
    constant = pulled.agg(F.sum("first").alias("first"), F.sum("last").alias("last")).select(
        F.lit(len(fit.weights)).alias("idx"), "first", "last"
    )
    pulls = (
        entries(pulled, vector, ["first", "last"], "x")
        .groupBy("idx")
        .agg(F.sum(F.col("x") * F.col("first")).alias("first"), F.sum(F.col("x") * F.col("last")).alias("last"))
        .unionByName(constant)
    )
    solution = [*map(float, fit.weights), float(fit.intercept)]
    shrunk = [goal.penalty * w for w in solution]
    if not goal.penalise_intercept:
        shrunk[-1] = 0.0
    own = spark.createDataFrame(list(enumerate(shrunk)), "idx int, shrunk double")
    largest = own.join(pulls, "idx", "left").agg(
        F.max(F.abs(goal.factor * F.coalesce("first", F.lit(0.0)))).alias("first_gradient"),
        F.max(F.abs(F.col("shrunk") + goal.factor * F.coalesce("last", F.lit(0.0)))).alias("last_gradient"),
    )
    # The sums are added in another order here, which moves the last digits.
    good = F.col("last_gradient") <= 1.01 * TOLERANCE * F.col("first_gradient") + 1e-12
    return largest.select(
        F.lit(fit.classifier).alias("classifier_name"),
        F.lit(sum(counts)).cast("long").alias("n"),
        F.lit(counts[0]).cast("long").alias("count_0"),
        F.lit(counts[1]).cast("long").alias("count_1"),
        "first_gradient",
        "last_gradient",
        good.alias("optimal"),
    )
