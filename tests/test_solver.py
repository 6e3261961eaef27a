"""The stacked solver, proofs of optimality and statistics shared by configurations."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from postgauge.config import DENSE_CLASSIFIERS, FEATURES, FeatureSpec, Settings
from postgauge.operators import linear_solver as L
from postgauge.operators.classifiers import LinearFit, fit_classifier, iterative_problem, optimality
from postgauge.operators.terms import of_spec, shared_statistics, term_statistics
from postgauge.plans.cross_validation import FoldFeatures, fit_folds, fold_features

SPECS = [
    FeatureSpec("one", "word", 1, 1, 50, min_df=1),
    FeatureSpec("two", "word", 1, 2, 50, min_df=1),
    FeatureSpec("three", "word", 2, 3, 50, min_df=1),
    FeatureSpec("short", "char_wb", 2, 3, 50, min_df=1),
    FeatureSpec("long", "char_wb", 3, 4, 50, min_df=1),
]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(7)
    data = []
    for i in range(240):
        x = draw.standard_normal(12) * (draw.random(12) < 0.5)
        y = int(x[:3].sum() + draw.standard_normal() * 0.8 > 0.4)
        places = np.flatnonzero(x)
        vector = Vectors.sparse(12, places.tolist(), x[places].tolist()) if i % 2 else Vectors.dense(x)
        data.append((vector, y, i % 3 + 1))
    return spark.createDataFrame(data, ["vector", "y", "fold"]).repartition(5).cache()


def matrix(rows):
    found = rows.collect()
    return np.array([r.vector.toArray() for r in found]), np.array([r.y for r in found]), np.array([r.fold for r in found])


def gradient(problem, x, y, fold, solution, scale=None):
    if scale is not None:
        x = x * scale
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        x = x / np.where(norms > 0, norms, 1)
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, problem.weights[1], problem.weights[0]) * (fold != problem.held_out)
    _, slope, _ = L.LOSSES[problem.objective.loss](sign, x @ solution[:-1] + solution[-1])
    pull = problem.objective.factor * weight * slope
    shrunk = problem.objective.penalty * solution
    if not problem.objective.penalise_intercept:
        shrunk[-1] = 0.0
    return shrunk + np.append(x.T @ pull, pull.sum())


@pytest.mark.parametrize("values", [L.BLOCK_VALUES, 7])
def test_all_problems_reach_their_own_optimum(spark, rows, monkeypatch, values):
    monkeypatch.setattr(L, "BLOCK_VALUES", values)
    x, y, fold = matrix(rows)
    scale = np.linspace(0.5, 2, 12)
    problems = [
        iterative_problem(name, (100, 140), Settings(), 12, held_out=out, scale=number)
        for name in DENSE_CLASSIFIERS
        for out, number in ((L.NO_FOLD, None), (1, None), (3, 0))
    ]
    solved = L.minimise_all([L.packed_rows(rows, "vector", "y", "fold")], problems, [scale], tol=1e-7)
    for problem, solution in zip(problems, solved, strict=True):
        used = scale if problem.scale is not None else None
        first = gradient(problem, x, y, fold, np.zeros(13), used)
        last = gradient(problem, x, y, fold, solution, used)
        assert np.abs(last).max() <= 1.01e-7 * np.abs(first).max()


def test_blocks_hold_one_fold_and_left_out_ones_cost_nothing(rows, monkeypatch):
    x, y, fold = matrix(rows)
    packed = [(0, *map(bytes, block)) for block in L.packed_rows(rows, "vector", "y", "fold").collect()]
    blocks = [L._Block(block[1:]) for block in packed]
    assert all(len(set(block.fold.tolist())) == 1 for block in blocks)
    assert all(block.idx.dtype == np.intp for block in blocks)
    assert sum(len(block.y) for block in blocks) == 240
    products = []
    times = L._Block._times
    monkeypatch.setattr(L._Block, "_times", lambda self, *a: (products.append(self.fold[0]), times(self, *a))[1])
    problem = iterative_problem("linear_svm", (100, 140), Settings(), 12, held_out=2)
    point = np.linspace(-0.3, 0.3, 13)
    found = L._answers([problem], [], {0: (point, None)}, packed)[0]
    assert products and 2 not in products
    shrunk = problem.objective.penalty * point
    wanted = gradient(problem, x, y, fold, point) - shrunk
    assert np.allclose(shrunk + problem.objective.factor * found[1:] - shrunk, wanted)


def test_rows_without_values_keep_their_place():
    row = {"indices": [[], [0, 2], [], [1], []], "vals": [[], [1.0, 2.0], [], [3.0], []], "y": [1, 0, 0, 1, 0]}
    batch = pa.record_batch(
        [
            pa.array(row["indices"], pa.list_(pa.int32())), pa.array(row["vals"], pa.list_(pa.float64())),
            pa.array(row["y"], pa.float64()), pa.array([0] * 5, pa.int32()),
        ],
        names=["indices", "vals", "y", "fold"],
    )
    (packed,) = L._pack_blocks(iter([batch]))
    block = L._Block([column[0].as_py() for column in packed.columns])
    assert block._times(block.val, np.array([1.0, 10.0, 100.0, 0.5])).tolist() == [0.5, 201.5, 0.5, 30.5, 0.5]


def test_passes_are_those_of_the_slowest(rows, monkeypatch):
    asked = []
    solver = L.newton

    def counted(problem, tol):
        steps = solver(problem, tol)
        number = len(asked)
        asked.append(0)
        question = next(steps)
        while True:
            asked[number] += 1
            try:
                question = steps.send((yield question))
            except StopIteration as done:
                return done.value

    rounds = []
    monkeypatch.setattr(L, "newton", counted)
    problems = [iterative_problem(name, (100, 140), Settings(), 12) for name in DENSE_CLASSIFIERS]
    context = rows.sparkSession.sparkContext
    sent = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda value: (rounds.append(value), sent(value))[1])
    L.minimise_all([L.packed_rows(rows, "vector", "y")], problems)
    assert len(rounds) - 1 == max(asked) < sum(asked)


def test_blocks_keep_small_numbers_in_few_bytes_and_others_whole():
    for values in ([1.0, 255.0], [0.0, 65_535.0], [65_536.0, 1.0], [0.5, 2.0], [-1.0, 3.0], [float("nan"), 1.0], []):
        wanted = np.array(values)
        narrow = L._narrowed(wanted)
        assert narrow.nbytes == len(values) * (1 if values == [1.0, 255.0] else 2 if values == [0.0, 65_535.0] else 8)
        assert np.array_equal(L._unpacked(narrow.tobytes(), len(values), np.float64), wanted, equal_nan=True)


def test_proof_tells_good_fits_from_bad(rows):
    for name in DENSE_CLASSIFIERS:
        settings = Settings(classifier=name)
        fit = fit_classifier(rows, "vector", settings, 12)
        row = optimality(rows, "vector", fit, settings).first()
        assert row.optimal and row.n == 240 and row.count_0 + row.count_1 == 240
        worse = LinearFit(name, fit.weights * 1.01, fit.intercept)
        assert not optimality(rows, "vector", worse, settings).first().optimal
        x, y, fold = matrix(rows)
        problem = iterative_problem(name, (row.count_0, row.count_1), settings, 12)
        slopes = gradient(problem, x, y, fold, np.append(worse.weights, worse.intercept))
        found = optimality(rows, "vector", worse, settings).first().last_gradient
        assert np.isclose(found, np.abs(slopes).max())


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["dark dark night alone", "alone night", "", "a bb ccc dddd", "night alone dark dark", "ünï cödé 🙂🙂"]
    data = [(t, i % 2, i % 3 + 1) for i, t in enumerate(texts * 3)]
    return spark.createDataFrame(data, "normalized string, y int, fold int").repartition(3).cache()


@pytest.mark.parametrize("folds", [0, 3])
def test_shared_statistics_equal_single_ones(docs, folds):
    shared = shared_statistics(docs, SPECS, folds)
    for bit, spec in enumerate(SPECS):
        wanted = sorted(map(tuple, term_statistics(docs, spec, folds).collect()))
        assert sorted(map(tuple, of_spec(shared, bit).collect())) == wanted and wanted
    assert [r.df for r in shared.where("uses = 0").collect()] == [18]


def test_shared_statistics_read_the_text_once(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    plan = shared_statistics(spark.read.parquet(str(tmp_path / "docs")), list(FEATURES.values()))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Generate") == 2


def test_grid_fits_equal_single_fits(spark, docs):
    more = docs.union(docs).union(docs)
    sizes = {fold: 36 for fold in (1, 2, 3)}
    names = ["word_unigram", "char_wb_3_5"]
    pairs = [(c, n) for c in ("logistic_regression", "linear_svm", "complement_nb") for n in names]
    features = fold_features(more, names, sizes)
    fits = fit_folds(features, pairs, Settings())
    assert set(fits) == {(c, n, fold) for c, n in pairs for fold in sizes}
    for name, one in features.items():
        assert isinstance(one, FoldFeatures)
        for classifier in ("logistic_regression", "linear_svm"):
            train = one.tfidf(one.counts.where(F.col("fold") != 2), 2)
            alone = fit_classifier(train, "tfidf", Settings(classifier=classifier), len(one.terms))
            assert np.allclose(fits[classifier, name, 2].weights, alone.weights, atol=1e-4)


def test_packing_copies_a_block_at_a_time():
    """Beside the batch itself, packing holds no more than some blocks."""
    rows, width = 10_000, 100
    ends = pa.array(np.arange(rows + 1) * width, pa.int32())
    places = pa.array(np.tile(np.arange(width, dtype=np.int32), rows))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(ends, places),
            pa.ListArray.from_arrays(ends, pa.array(np.random.default_rng(5).random(rows * width))),
            pa.array(np.arange(rows) % 3 > 0, pa.bool_()).cast(pa.float64()),
            pa.array(np.arange(rows) // 7 % 2, pa.int32()),
        ],
        names=["indices", "vals", "y", "fold"],
    )
    start, most, found = pa.total_allocated_bytes(), 0, []
    for block in L._pack_blocks(iter([batch])):
        most = max(most, pa.total_allocated_bytes() - start)
        found.append((np.frombuffer(block["fold"][0].as_py(), np.int32), np.frombuffer(block["val"][0].as_py())))
    assert most < batch.nbytes / 2
    for fold in (0, 1):
        values = np.concatenate([v for folds, v in found if folds[0] == fold])
        own = batch.filter(pc.equal(batch["fold"], fold))["vals"].flatten().to_numpy()
        assert (values == own).all()
