import random

import pytest
from pyspark.sql import functions as F

from postgauge.operators import curves
from postgauge.operators.metrics import (
    evaluate,
    gated_metrics,
    ranked_scores,
    require_no_errors,
    roc_auc,
    score_counts,
)

SCHEMA = "y_true int, y_pred int, score double"


def from_cells(spark, tn, fp, fn, tp):
    rows = [(0, 0, 0.0)] * tn + [(0, 1, 1.0)] * fp + [(1, 0, 0.0)] * fn + [(1, 1, 1.0)] * tp
    return spark.createDataFrame(rows, SCHEMA)


def test_golden_cells(spark):
    row = evaluate(from_cells(spark, 97, 38, 54, 112)).first()
    assert row.protocol_auc == pytest.approx(0.6966086568503251, rel=1e-9)
    row = evaluate(from_cells(spark, 89, 33, 46, 84)).first()
    assert [round(row[m], 4) for m in ("protocol_auc", "recall", "precision", "f1")] == [0.6878, 0.6462, 0.7179, 0.6802]


def test_undefined_rates(spark):
    row = evaluate(from_cells(spark, 3, 0, 0, 0)).first()
    assert row.roc_auc is None and row.protocol_auc == 0.5
    assert (row.recall, row.precision, row.f1) == (0.0, 0.0, 0.0)


def brute_auc(rows):
    pos = [s for y, _, s in rows if y]
    neg = [s for y, _, s in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def scored(spark, n=400, values=60):
    draw = random.Random(3)
    rows = [(draw.randint(0, 1), 0, draw.randint(0, values) / 7) for _ in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_auc_with_ties(spark):
    rows, frame = scored(spark)
    assert roc_auc(frame).first().roc_auc == pytest.approx(brute_auc(rows))


def test_ranking_over_ranges(spark):
    _, frame = scored(spark, 3000, 900)
    keyed = frame.withColumn("k", (F.col("score") * 7 % 2).cast("int"))
    counts = score_counts(keyed, ["k"])
    found = {(r.k, r.score): r for r in ranked_scores(counts, ["k"]).collect()}
    for k in (0, 1):
        above = [0, 0]
        ordered = sorted((r for r in found.values() if r.k == k), key=lambda r: -r.score)
        for row, following in zip(ordered, [*ordered[1:], None], strict=True):
            assert [row.pos_above, row.neg_above] == above
            assert (row.next_pos, row.next_neg) == ((following.pos, following.neg) if following else (None, None))
            above = [above[0] + row.pos, above[1] + row.neg]


def test_roc_curve(spark):
    frame = spark.createDataFrame([(1, 1, 0.9), (1, 1, 0.8), (0, 1, 0.7), (1, 0, 0.6), (0, 0, 0.5)], SCHEMA)
    points = sorted((r.fpr, r.tpr) for r in curves.roc_curve(frame).collect())
    flat = [value for point in points for value in point]
    assert flat == pytest.approx([0, 0, 0, 1 / 3, 0, 2 / 3, 0.5, 2 / 3, 0.5, 1, 1, 1])
    assert curves.roc_curve(frame.where("y_true = 1")).count() == 0


def test_histogram(spark):
    frame = spark.createDataFrame([(0, 0, float(v)) for v in range(21)], SCHEMA)
    counts = [r["count"] for r in curves.score_histogram(frame).orderBy("bin").collect()]
    assert counts == [1] * 19 + [2]
    flat = spark.createDataFrame([(0, 0, 0.5)] * 3, SCHEMA)
    rows = curves.score_histogram(flat).orderBy("bin").collect()
    assert sum(r["count"] for r in rows) == 3 and rows[10]["count"] == 3
    assert (rows[0].bin_start, rows[19].bin_end) == (0.0, 1.0)


def test_prediction_counts_fill_zero(spark):
    rows = curves.prediction_counts(from_cells(spark, 4, 0, 0, 0)).orderBy("y_pred").collect()
    assert [(r.label, r["count"]) for r in rows] == [("no", 4), ("yes", 0)]


def test_error_gate(spark):
    rows = [("a", 1, 1, 0.9, None), ("a", 0, 0, 0.1, None), ("b", 1, None, None, "bad"), ("b", 0, 0, 0.2, None)]
    frame = spark.createDataFrame(rows, "cell string, y_true int, y_pred int, score double, error string")
    found = {r.cell: r for r in gated_metrics(frame, ["cell"]).collect()}
    assert found["a"].roc_auc == 1.0 and found["a"].error_count == 0
    assert found["b"].protocol_auc is None and found["b"].error_count == 1
    with pytest.raises(ValueError, match="1 answers"):
        require_no_errors(frame)
