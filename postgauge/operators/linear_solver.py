"""Convex linear objectives solved over distributed row blocks, any number of them at once.

The library's linear SVM minimises the plain hinge loss, a different model, and its
logistic regression rescales every column by its deviation, which makes rare TF-IDF
terms converge very slowly. Here a problem is solved by truncated Newton steps: conjugate
gradients ask for products of the curvature with a direction, a line search for losses and
gradients. All problems that are not finished put their question to the same pass over the
cached blocks, so a grid of classifiers and folds needs as many passes as its slowest member.
A task answers with vectors as long as the vocabulary, a tree reduction adds them, and the
driver only ever sees these.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from postgauge.memory import give_back

#: Stored values of a block, about; a block holds whole rows, and its products fit a core's cache.
BLOCK_VALUES = 1 << 16
#: Stored values that are worth a task, and most tasks for each core.
TASK_VALUES, TASKS_A_CORE = 500_000, 3
BLOCK_SCHEMA = "starts binary, idx binary, val binary, y binary, fold binary"
#: Largest share of the gradient that conjugate gradients may leave, and their most steps.
FORCING = 0.3
MAX_INNER = 200
#: Rows that belong to no fold.
NO_FOLD = 0


@dataclass(frozen=True)
class Objective:
    """``penalty/2`` times the squared norm plus ``factor`` times the weighted loss."""

    loss: str
    factor: float
    penalty: float
    penalise_intercept: bool
    max_iter: int


@dataclass(frozen=True)
class Problem:
    """An objective over the rows of one block set outside one fold.

    ``part`` names the block set, ``weights`` are those of class 0 and 1. If ``scale`` is
    given, it names factors of the columns; rows are multiplied by them and brought to unit length.
    """

    part: int
    size: int
    objective: Objective
    weights: tuple[float, float]
    held_out: int = NO_FOLD
    scale: int | None = None


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed blocks of about ``BLOCK_VALUES`` values of one fold: compressed sparse rows as raw bytes.

    Places and values take one or two bytes each if that keeps them.
    """
    held: dict[int, list[pa.RecordBatch]] = {}
    values: dict[int, int] = {}
    for batch in batches:
        folds = batch.column("fold").to_numpy()
        sizes = np.diff(batch.column("vals").offsets.to_numpy())
        for fold in dict.fromkeys(folds.tolist()):
            # Only rows of one block are copied at a time, and what is held back keeps no batch.
            rows = np.flatnonzero(folds == fold)
            lengths = sizes[rows]
            start = 0
            for end in _cuts(lengths, values.get(fold, 0)):
                yield _packed([*held.pop(fold, []), batch.take(pa.array(rows[start:end]))])
                values[fold], start = 0, end
            if start < len(rows):
                held.setdefault(fold, []).append(batch.take(pa.array(rows[start:])))
                values[fold] = values.get(fold, 0) + int(lengths[start:].sum())
    for parts in held.values():
        yield _packed(parts)
    held.clear()
    give_back()


def _cuts(lengths: np.ndarray, before: int) -> list[int]:
    """Row numbers where a block is full, if ``before`` values are held already."""
    filled = (before + np.cumsum(lengths)) // BLOCK_VALUES
    return (np.flatnonzero(np.diff(filled, prepend=0)) + 1).tolist()


def _packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    lengths = rows.column("vals").combine_chunks().value_lengths().to_numpy()
    columns = [
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        _narrowed(rows.column("indices").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32)),
        _narrowed(rows.column("vals").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)),
        np.where(rows.column("y").to_numpy() > 0, 1.0, -1.0),
        rows.column("fold").to_numpy().astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([c.tobytes()], pa.binary()) for c in columns],
        names=["starts", "idx", "val", "y", "fold"],
    )


def _narrowed(values: np.ndarray) -> np.ndarray:
    """The values in one or two bytes if that keeps each of them, or as they are."""
    for kind in (np.uint8, np.uint16):
        if len(values) and values.min() >= 0 and values.max() <= np.iinfo(kind).max:
            narrow = values.astype(kind)
            return narrow if (narrow == values).all() else values
    return values


def _unpacked(data: bytes, count: int, whole: type) -> np.ndarray:
    """The array of ``count`` values that ``_narrowed`` made of values of the kind ``whole``."""
    size = len(data) // count if count else 0
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16}.get(size, whole))


def squared_hinge(y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss per row, its derivative by the margin and its curvature."""
    slack = np.maximum(0.0, 1.0 - y * margin)
    return slack * slack, -2.0 * slack * y, 2.0 * (slack > 0)


def logistic(y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss per row, its derivative by the margin and its curvature."""
    agreement = y * margin
    wrong = np.exp(-np.logaddexp(0.0, agreement))
    return np.logaddexp(0.0, -agreement), -y * wrong, wrong * (1.0 - wrong)


LOSSES = {"squared_hinge": squared_hinge, "logistic": logistic}


class _Block:
    """One unpacked block; ``norms`` are the lengths of its rows under each scaling.

    Places and counts stay in the bytes they are packed in, as every pass moves them.
    """

    def __init__(self, packed: Sequence[bytes], scales: dict[int, np.ndarray] | None = None):
        self.starts = np.frombuffer(packed[0], np.int64)
        self.lengths = np.diff(self.starts)
        self._idx = _unpacked(packed[1], int(self.starts[-1]), np.int32)
        self._val = _unpacked(packed[2], int(self.starts[-1]), np.float64)
        self.y = np.frombuffer(packed[3], np.float64)
        self.fold = np.frombuffer(packed[4], np.int32)
        self.norms: dict[int, np.ndarray] = {}
        for scale, factors in (scales or {}).items():
            raised = self.val * factors[self.idx]
            norms = np.sqrt(self._row_sums(raised * raised))
            self.norms[scale] = np.where(norms > 0, norms, 1.0)

    @property
    def idx(self) -> np.ndarray:
        # Narrower places would be widened again in every product, which takes longer than the sums.
        return self._idx.astype(np.intp)

    @property
    def val(self) -> np.ndarray:
        return self._val.astype(np.float64)

    def counts_for(self, problem: Problem) -> bool:
        """Whether any row is outside the fold that the problem leaves out."""
        return problem.held_out == NO_FOLD or bool((self.fold != problem.held_out).any())

    def answer(self, problems: Sequence[Problem], asked: _Asked, totals: Sequence[np.ndarray]) -> None:
        """Add to each of ``totals`` loss and gradient at a point, or zero and a curvature product.

        A scaling multiplies columns and divides rows, so it is applied to the vectors before the
        products and to the row sums after them; the gradient still lacks the columns' factors.
        """
        idx, val = self.idx, self.val
        products = self._times(val, asked.vectors)
        for problem, (at, along), (base, turn), total in zip(
            problems, asked.columns, asked.intercepts, totals, strict=True
        ):
            norms = 1.0 if problem.scale is None else self.norms[problem.scale]
            weight = np.where(self.y > 0, problem.weights[1], problem.weights[0])
            if problem.held_out != NO_FOLD:
                weight = weight * (self.fold != problem.held_out)
            margin = products[:, at] / norms + base
            value, slope, bend = LOSSES[problem.objective.loss](self.y, margin)
            if along is None:
                total[0] += weight @ value
                pull = weight * slope
            else:
                pull = weight * bend * (products[:, along] / norms + turn)
            total[1:-1] += np.bincount(idx, val * np.repeat(pull / norms, self.lengths), problem.size)
            total[-1] += pull.sum()

    def _times(self, val: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Products of the rows with a vector or the columns of a matrix, plus its last entry."""
        if vectors.ndim == 1 or vectors.shape[1] == 1:
            sums = self._row_sums(val * vectors[:-1].ravel()[self.idx])
            return sums.reshape(-1, *vectors.shape[1:]) + vectors[-1]
        idx, starts = self.idx, self.starts.tolist()
        sums = np.empty((len(self.lengths), vectors.shape[1]))
        for row, (start, end) in enumerate(zip(starts, starts[1:], strict=False)):
            np.dot(val[start:end], vectors.take(idx[start:end], axis=0), out=sums[row])
        return sums + vectors[-1]

    def _row_sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(self.lengths)), self.lengths), values, len(self.lengths))


class _Asked:
    """Questions of some problems over one block set, as the columns of one matrix.

    Its last row is zero: intercepts are added after rows are divided by their lengths.
    """

    def __init__(self, problems: Sequence[Problem], scales: Sequence[np.ndarray], questions: Sequence[tuple]):
        found: list[np.ndarray] = []
        self.columns: list[tuple[int, int | None]] = []
        self.intercepts: list[tuple[float, float]] = []
        for problem, (point, direction) in zip(problems, questions, strict=True):
            places = []
            for vector in (point, direction):
                if vector is not None:
                    places.append(len(found))
                    found.append(vector[:-1] if problem.scale is None else vector[:-1] * scales[problem.scale])
            self.columns.append((places[0], places[1] if direction is not None else None))
            self.intercepts.append((point[-1], 0.0 if direction is None else direction[-1]))
        self.vectors = np.zeros((problems[0].size + 1, len(found)))
        for number, vector in enumerate(found):
            self.vectors[:-1, number] = vector


def _answers(problems, scales, questions, parts) -> dict[int, np.ndarray]:
    """Answers of a partition to every question about its block sets."""
    totals: dict[int, np.ndarray] = {}
    together: dict[tuple[int, ...], _Asked] = {}
    for part, *packed in parts:
        block = packed[0] if isinstance(packed[0], _Block) else _Block(packed)
        numbers = tuple(n for n in questions if problems[n].part == part and block.counts_for(problems[n]))
        if not numbers:
            continue
        own = [problems[n] for n in numbers]
        if numbers not in together:
            together[numbers] = _Asked(own, scales, [questions[n] for n in numbers])
        for n in numbers:
            totals.setdefault(n, np.zeros(problems[n].size + 2))
        block.answer(own, together[numbers], [totals[n] for n in numbers])
    for number, total in totals.items():
        if problems[number].scale is not None:
            total[1:-1] *= scales[problems[number].scale]
    return totals


def _added(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return a | {k: a[k] + v if k in a else v for k, v in b.items()}


def newton(problem: Problem, tol: float) -> Generator[tuple, np.ndarray, np.ndarray]:
    """Truncated Newton steps; yields (point, direction or None) and gets the sums sent."""
    goal = problem.objective
    shrink = np.full(problem.size + 1, goal.penalty)
    if not goal.penalise_intercept:
        shrink[-1] = 0.0
    x = np.zeros(problem.size + 1)

    def at(point: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray]:
        value = 0.5 * float(shrink @ (point * point)) + goal.factor * float(sums[0])
        return value, shrink * point + goal.factor * sums[1:]

    loss, gradient = at(x, (yield x, None))
    first, limit = np.linalg.norm(gradient), tol * float(np.abs(gradient).max())
    for _ in range(goal.max_iter):
        norm = np.linalg.norm(gradient)
        if np.abs(gradient).max() <= limit:
            break
        enough = min(FORCING, float(np.sqrt(norm / first))) * norm
        step, rest = np.zeros_like(x), -gradient
        way, square = rest.copy(), rest @ rest
        for _ in range(MAX_INNER):
            bent = shrink * way + goal.factor * (yield x, way)[1:]
            curve = way @ bent
            if curve <= 0:
                break
            step += square / curve * way
            rest = rest - square / curve * bent
            before, square = square, rest @ rest
            if np.sqrt(square) <= enough:
                break
            way = rest + square / before * way
        slope, length = float(gradient @ step), 1.0
        while True:
            trial = x + length * step
            trial_loss, trial_gradient = at(trial, (yield trial, None))
            if trial_loss <= loss + 1e-4 * length * slope or length < 1e-12:
                break
            length *= 0.5
        if trial_loss >= loss:
            break
        x, loss, gradient = trial, trial_loss, trial_gradient
    return x


def packed_rows(frame: DataFrame, vector: str, label: str, fold: str | None = None) -> DataFrame:
    """Rows of sparse or dense vectors as blocks, in their partitions."""
    inner = F.unwrap_udt(F.col(vector))
    values = inner.getField("values")
    sparse = inner.getField("type") == 0
    places = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1))
    held = F.coalesce(F.col(fold).cast("int"), F.lit(NO_FOLD)) if fold else F.lit(NO_FOLD)
    return frame.select(
        F.coalesce(
            F.when(sparse, inner.getField("indices")).otherwise(places),
            F.array().cast("array<int>"),
        ).alias("indices"),
        values.alias("vals"),
        F.col(label).cast("double").alias("y"),
        held.alias("fold"),
    ).mapInArrow(_pack_blocks, BLOCK_SCHEMA)


def minimise_all(
    blocks: Sequence[DataFrame],
    problems: Sequence[Problem],
    scales: Sequence[np.ndarray] = (),
    tol: float = 1e-5,
) -> list[np.ndarray]:
    """Weights followed by the intercept, for every problem.

    ``blocks`` are block sets of ``packed_rows``. Each problem ends once no gradient entry
    exceeds ``tol`` times the largest first one.
    """
    context = blocks[0].sparkSession.sparkContext
    fixed = context.broadcast((list(problems), [np.asarray(s) for s in scales]))
    used = [sorted({p.scale for p in problems if p.part == part} - {None}) for part in range(len(blocks))]
    cached = [
        b.rdd.map(lambda row, part=part: (part, _Block(row, {s: fixed.value[1][s] for s in used[part]})))
        .persist(StorageLevel.MEMORY_AND_DISK)
        for part, b in enumerate(blocks)
    ]
    counted = context.union([c.map(lambda block: (block[0], int(block[1].starts[-1]))) for c in cached])
    values = dict.fromkeys(range(len(blocks)), 0) | counted.reduceByKey(int.__add__, 1).collectAsMap()
    # A task gets about so many values at least: below that, starting it takes longer. Beyond some
    # tasks a core, more of them only return more vectors as long as the vocabulary.
    least = max(TASK_VALUES, sum(values.values()) // (TASKS_A_CORE * context.defaultParallelism))
    shared = [c.coalesce(max(1, min(c.getNumPartitions(), -(-values[part] // least)))) for part, c in enumerate(cached)]
    solvers = [newton(problem, tol) for problem in problems]
    questions = {number: next(solver) for number, solver in enumerate(solvers)}
    solved: dict[int, np.ndarray] = {}
    try:
        while questions:
            asked = context.broadcast(questions)
            # Block sets whose problems are all solved are not read any more.
            open_sets = [shared[part] for part in sorted({problems[number].part for number in questions})]
            answers = context.union(open_sets).mapPartitions(
                lambda part, asked=asked: [_answers(*fixed.value, asked.value, part)]
            ).treeReduce(_added)
            asked.unpersist()
            ahead = {}
            for number in questions:
                nothing = np.zeros(problems[number].size + 2)
                try:
                    ahead[number] = solvers[number].send(answers.get(number, nothing))
                except StopIteration as done:
                    solved[number] = done.value
            questions = ahead
    finally:
        for rows in cached:
            rows.unpersist()
        fixed.unpersist()
    return [solved[number] for number in range(len(problems))]
