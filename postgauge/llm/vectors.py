"""Near-duplicate vectors by random-hyperplane signs in several tables.

Equal vectors are one class. Classes that share all signs of some set of hyperplanes with the
class first in hash order there, and lie within half the linking angle of it, join its ball:
any two members of a ball are linked by the triangle inequality, so a family of near copies is
settled in linear time. Balls then meet in the tables: a table is a set of hyperplanes, its
buckets hold the balls with a member of that sign pattern, and a second sign sketch of the
centres sorts out most pairs inside the task. Pairs that stay are verified by the exact
cosine of the centres; where the radii leave a doubt, members are compared with centres, and
with each other where that is not enough. Components follow from links between balls.

The tables are as many as bring the chance of missing a pair right at the limit below
``MISS``; a pair closer than the limit is missed more rarely. Links that are reported are
exact. Buckets of more than ``BLOCK`` balls are dealt over pairs of blocks.

Defined cases: a vector that is null, empty, zero or holds a null or a number that is not
finite has no links; vectors of different lengths are not linked; rows that repeat a vector are
linked with each other; a null id is never the smallest unless a component has no other. An
empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.llm.common import maybe_among
from postgauge.llm.neardup import components
from postgauge.session import settle

#: Chance of missing a pair at the limit: by the tables, and by the sketch.
MISS = 1e-6
SKETCH_MISS = 1e-8
#: Hyperplane sets a pass of ball making looks at; passes end once one absorbs so little.
BALL_SETS = 10
BALL_GAIN = 0.02
#: Balls of a bucket that one task compares with each other.
BLOCK = 2048
SKETCH = 256
_WORDS = [f"s{i}" for i in range(SKETCH // 64)]
SALTS = 8
_EPS = 1e-7


def planes(size: int, bits: int, seed: int) -> np.ndarray:
    """Normal vectors of random hyperplanes, as columns."""
    return np.random.default_rng([seed, size, bits]).standard_normal((size, bits))


@dataclass(frozen=True)
class Layout:
    """Bits of a code and number of tables for a number of classes and a cosine."""

    cosine: float
    bits: int
    tables: int
    ball_bits: int

    @property
    def angle(self) -> float:
        return math.acos(self.cosine)


def layout(classes: int, cosine: float) -> Layout:
    """About a thousand classes share a random bucket; tables follow from the miss chance."""
    reach = math.ceil(math.log2(max(classes, 2)))
    bits = max(4, reach - 10)
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return Layout(cosine, bits, math.ceil(math.log(MISS) / math.log1p(-agree)), min(62, reach + 5))


def sketch_limits() -> np.ndarray:
    """Most differing sketch bits allowed, by angle in whole degrees."""
    z = 5.7  # the normal tail beyond it is below SKETCH_MISS
    share = np.minimum(np.arange(182) / 180.0, 0.5)
    limit = np.ceil(SKETCH * share + z * np.sqrt(SKETCH * share * (1 - share)) + 1)
    limit[90:] = SKETCH
    return limit.astype(np.int64)


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the vectors of each length and their matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        yield at, flat[starts[at][:, None] + np.arange(size)]


def _signs(matrix: np.ndarray, bits: int, seed: int) -> np.ndarray:
    return (matrix @ planes(matrix.shape[1], bits, seed)) > 0


def _packed(signs: np.ndarray, groups: int) -> np.ndarray:
    """Signs of equal groups of at most 64 as one number each."""
    each = signs.reshape(len(signs), groups, -1)
    weights = np.uint64(1) << np.arange(each.shape[2], dtype=np.uint64)
    return (each * weights).sum(axis=2, dtype=np.uint64).view(np.int64)


def _coded(rows: DataFrame, groups: int, bits: int, seed: int, sketched: bool = False) -> DataFrame:
    """Add ``codes``, one number of ``bits`` signs for each group, to rows with node and vec.

    The length of the vector is part of a code. ``sketched`` adds the sketch in numbers of 64 signs.
    """
    kept = [c for c in rows.columns if c != "vec"]
    total = groups * bits
    words = _WORDS if sketched else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, groups), np.int64)
            sketches = np.zeros((batch.num_rows, len(words)), np.int64)
            for at, matrix in _by_size(batch.column("vec")):
                matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                own = _packed(_signs(matrix, total, seed), groups)
                codes[at] = own ^ np.int64(matrix.shape[1] << 48)
                if words:
                    sketches[at] = _packed(_signs(matrix, SKETCH, 999), len(words))
            columns = [batch.column(c) for c in kept]
            flat = pa.array(codes.reshape(-1))
            columns.append(pa.ListArray.from_arrays(np.arange(0, codes.size + 1, groups, dtype=np.int32), flat))
            columns += [pa.array(np.ascontiguousarray(sketches[:, i])) for i in range(len(words))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "codes", *words])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, ", ".join([fields, "codes array<long>", *(f"{w} long" for w in words)]))


def _with_cosine(pairs: DataFrame) -> DataFrame:
    """Replace va and vb, vectors of equal length, by their cosine ``cos``."""
    kept = [c for c in pairs.columns if c not in ("va", "vb")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = np.zeros(batch.num_rows)
            for (at, a), (_, b) in zip(_by_size(batch.column("va")), _by_size(batch.column("vb")), strict=True):
                a = a / np.abs(a).max(axis=1, keepdims=True)
                b = b / np.abs(b).max(axis=1, keepdims=True)
                norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
                cos[at] = (a * b).sum(axis=1) / norms
            columns = [batch.column(c) for c in kept] + [pa.array(cos)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "cos"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema if f.name in kept)
    return pairs.mapInArrow(run, f"{fields}, cos double")


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pairs`` of nodes a and b with their cosine; only vectors that are asked for move."""
    asked = maybe_among(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    some = nodes.filter(asked(F.col("node"))).select("node", "vec")
    one = some.select(F.col("node").alias("a"), F.col("vec").alias("va"))
    other = some.select(F.col("node").alias("b"), F.col("vec").alias("vb"))
    both = pairs.join(one, "a").join(other, "b").filter(F.size("va") == F.size("vb"))
    return _with_cosine(both)


def _good(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _leaders(live: DataFrame, nodes: DataFrame, plan: Layout, seed: int) -> DataFrame:
    """Classes of ``live`` absorbed in one pass: node, ball and cos to its centre.

    In each bucket the first class in hash order offers itself; a class goes to the closest
    one that itself goes nowhere.
    """
    coded = _coded(live.select("node", "vec"), BALL_SETS, plan.ball_bits, seed)
    rows = settle(
        coded.select("node", F.posexplode("codes").alias("at", "code")).withColumn(
            "rank", F.struct(F.xxhash64("node").alias("hash"), F.col("node").alias("node"))
        )
    )
    heads = (
        rows.groupBy("at", "code")
        .agg(F.min("rank").alias("head"), F.count("*").alias("size"))
        .filter("size > 1")
        .select("at", "code", F.col("head.node").alias("b"))
    )
    offers = rows.join(heads, ["at", "code"]).filter(F.col("node") != F.col("b"))
    pairs = settle(offers.select(F.col("node").alias("a"), "b").distinct())
    near = settle(
        _verified(pairs, nodes).filter(F.col("cos") >= math.cos(plan.angle / 2 - 1e-6))
    )
    free = near.join(near.select(F.col("a").alias("b")).distinct(), "b", "left_anti")
    best = F.max_by(F.struct("b", "cos"), F.struct("cos", -F.col("b")))
    return settle(
        free.groupBy("a").agg(best.alias("to")).select(
            F.col("a").alias("node"), F.col("to.b").alias("ball"), F.col("to.cos").alias("cos")
        )
    )


def _balls(nodes: DataFrame, count: int, plan: Layout) -> DataFrame:
    """All classes with ``ball``, the node at its centre, and ``away``, the angle to it.

    A centre stays one: later passes look only at classes in no ball.
    """
    live, absorbed, left, seed = nodes, None, count, 1
    while True:
        found = _leaders(live, nodes, plan, seed)
        absorbed = found if absorbed is None else absorbed.unionByName(found)
        gained = found.count()
        left -= gained
        if gained <= BALL_GAIN * max(left, 1):
            break
        taken = found.select("node").union(found.select(F.col("ball"))).distinct()
        live = live.join(taken, "node", "left_anti")
        seed += 1
    absorbed = settle(absorbed)
    maybe = maybe_among(absorbed.select("node"))(F.col("node"))
    joined = nodes.filter(maybe).join(absorbed, "node", "left")
    alone = nodes.filter(~maybe).withColumns(
        {"ball": F.col("node"), "away": F.lit(0.0)}
    )
    return settle(
        alone.unionByName(
            joined.select(
                *nodes.columns,
                F.coalesce("ball", "node").alias("ball"),
                F.coalesce(F.acos(F.least("cos", F.lit(1.0))), F.lit(0.0)).alias("away"),
            )
        )
    )


def _bucket_rows(tagged: DataFrame, balls: DataFrame, plan: Layout) -> DataFrame:
    """One row for each ball, table and code: at, code, ball, radius and the centre's sketch."""
    coded = _coded(tagged.select("node", "ball", "vec"), plan.tables, plan.bits, 0, sketched=True)
    maybe = maybe_among(balls.filter("size > 1").select("ball"))(F.col("ball"))
    codes = F.posexplode("codes").alias("at", "code")
    alone = coded.filter(~maybe).select(codes, "ball", F.lit(0.0).alias("radius"), *_WORDS)
    shared = coded.filter(maybe)
    centres = shared.filter(F.col("node") == F.col("ball")).select("ball", *_WORDS).join(
        balls.select("ball", "radius"), "ball"
    )
    places = shared.select(codes, "ball").distinct()
    return alone.unionByName(places.join(centres, "ball"))


def _pairs_in_task(angle: float):
    limits = sketch_limits()

    def of(group: tuple, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        first, second = group[2], group[3]
        order = np.argsort(rows["ball"])
        rows = {k: v[order] for k, v in rows.items()}
        left = rows["block"] == first
        right = rows["block"] == second
        a, b = ({k: v[m] for k, v in rows.items()} for m in (left, right))
        for start in range(0, len(a["ball"]), 512):
            cut = slice(start, start + 512)
            apart = np.zeros((len(a["ball"][cut]), len(b["ball"])), np.int16)
            for word in _WORDS:
                apart += np.bitwise_count(a[word][cut, None] ^ b[word][None])
            reach = angle + a["radius"][cut, None] + b["radius"][None]
            allowed = limits[np.minimum(np.ceil(np.degrees(reach)) + 1, 181).astype(np.int64)]
            near = apart <= allowed
            if first == second:
                near &= a["ball"][cut, None] < b["ball"][None]
            x, y = np.nonzero(near)
            if len(x):
                one, two = a["ball"][cut][x], b["ball"][y]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if sum(x.num_rows for x in held) > 1:
                whole = pa.Table.from_batches(held)
                rows = {n: whole.column(n).to_numpy() for n in ("ball", "radius", "block")}
                rows |= {n: whole.column(n).to_numpy().view(np.uint64) for n in _WORDS}
                yield from of(key, rows)

        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("at", "code", "first", "second")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                this = tuple(int(x) for x in marks[:, start])
                if this != key:
                    yield from flush()
                    key, held = this, []
                held.append(batch.slice(start, end - start))
        yield from flush()

    return run


def _candidates(rows: DataFrame, plan: Layout) -> DataFrame:
    """Pairs of balls that share a bucket and whose sketches allow a link."""
    crowded = (
        rows.groupBy("at", "code")
        .agg(F.count("*").alias("size"))
        .filter(F.col("size") > BLOCK)
        .select("at", "code", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    crowded = settle(crowded)
    dealt = (
        rows.join(crowded, ["at", "code"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("ball"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "at", "code",
            F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
            "ball", "radius", *_WORDS, "block",
        )
    )
    keys = ["at", "code", "first", "second"]
    found = (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_pairs_in_task(plan.angle), "a long, b long")
    )
    return settle(found.distinct())


@dataclass(frozen=True)
class _Links:
    """Links of whole balls (ball, links), of single classes (node, links), and linked balls."""

    of_balls: DataFrame
    of_nodes: DataFrame
    edges: DataFrame


def _both_ways(pairs: DataFrame) -> DataFrame:
    turned = {"a": "b", "b": "a", "ra": "rb", "rb": "ra", "na": "nb", "nb": "na"}
    swapped = pairs.select(*(F.col(turned.get(c, c)).alias(c) for c in pairs.columns))
    return pairs.unionByName(swapped)


def _resolved(pairs: DataFrame, tagged: DataFrame, balls: DataFrame, plan: Layout) -> _Links:
    """Which members of candidate pairs of balls are linked."""
    info = balls.select("ball", "radius", "vectors")
    one = info.toDF("a", "ra", "na")
    other = info.toDF("b", "rb", "nb")
    angle = F.acos(F.greatest(F.least("cos", F.lit(1.0)), F.lit(-1.0)))
    measured = settle(
        _verified(pairs, tagged.filter(F.col("node") == F.col("ball")))
        .join(one, "a")
        .join(other, "b")
        .withColumn("apart", angle)
        .filter(F.col("apart") <= F.lit(plan.angle + _EPS) + F.col("ra") + F.col("rb"))
    )
    points = (F.col("ra") == 0) & (F.col("rb") == 0)
    linked = points & (F.col("cos") >= plan.cosine)
    sure = ~points & (F.col("apart") + F.col("ra") + F.col("rb") <= plan.angle - _EPS)
    whole = measured.filter(linked | sure)
    doubtful = _both_ways(measured.filter(~points & ~sure)).select("a", "b", "rb", "nb")

    # Members of one ball against the centre of the other.
    members = tagged.select(F.col("ball").alias("a"), "node", "n")
    asked = doubtful.join(members, "a").select(
        F.col("node").alias("a"), "b", F.col("a").alias("ball"), "rb", "nb"
    )
    single = settle(_verified(asked, tagged).withColumn("apart", angle))
    full = (F.col("apart") + F.col("rb") <= plan.angle - _EPS) | (
        (F.col("rb") == 0) & (F.col("cos") >= plan.cosine)
    )
    maybe = ~full & (F.col("rb") > 0) & (F.col("apart") <= F.lit(plan.angle + _EPS) + F.col("rb"))
    # Members against members, where the centre does not decide.
    inner = single.filter(maybe).select("a", F.col("b").alias("to"), "ball").join(
        members.select(F.col("a").alias("to"), F.col("node").alias("b"), "n"), "to"
    )
    exact = settle(_verified(inner, tagged).filter(F.col("cos") >= plan.cosine))
    of_nodes = single.filter(full).select(
        F.col("a").alias("node"), F.col("nb").alias("links"), "ball", F.col("b").alias("to")
    ).unionByName(exact.select(F.col("a").alias("node"), F.col("n").alias("links"), "ball", "to"))
    of_balls = _both_ways(whole.select("a", "b", "ra", "rb", "na", "nb")).select(
        F.col("a").alias("ball"), F.col("nb").alias("links")
    )
    edges = (
        whole.select("a", "b")
        .unionByName(of_nodes.select(F.col("ball").alias("a"), F.col("to").alias("b")))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    return _Links(
        of_balls.groupBy("ball").agg(F.sum("links").alias("ball_links")),
        of_nodes.groupBy("node").agg(F.sum("links").alias("node_links")),
        settle(edges),
    )


def near_vectors(
    rows: DataFrame, cosine: float = 0.9, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    vec = F.transform(F.col(vector), lambda x: x + F.lit(0).cast("float"))
    plain = rows.select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec")).withColumn(
        "good", _good(F.col("vec"))
    )
    good = plain.filter("good").select("vec_id", "vec", F.xxhash64("vec").alias("hash"))
    nodes = settle(
        good.groupBy("vec", "hash")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    count = nodes.count()
    plan = layout(count, cosine)
    tagged = _balls(nodes, count, plan)
    balls = settle(
        tagged.groupBy("ball").agg(
            F.max("away").alias("radius"),
            F.sum("n").alias("vectors"),
            F.count("*").alias("size"),
            F.min("low").alias("low"),
        )
    )
    pairs = _candidates(_bucket_rows(tagged, balls, plan), plan)
    links = _resolved(pairs, tagged, balls, plan)
    joined = components(links.edges).toDF("ball", "root")
    lows = (
        joined.join(balls, "ball").groupBy("root").agg(F.min("low").alias("root_low"))
    )
    of_ball = (
        balls.join(joined.join(lows, "root"), "ball", "left")
        .join(links.of_balls, "ball", "left")
        .select(
            "ball",
            F.coalesce("root_low", "low").alias("component_id"),
            (F.col("vectors") - 1 + F.coalesce("ball_links", F.lit(0))).alias("base"),
        )
    )
    classes = settle(
        tagged.select("node", "hash", "low", "n", "ball")
        .join(of_ball, "ball")
        .join(links.of_nodes, "node", "left")
        .select(
            "node", "hash", "low", "n", "component_id",
            (F.col("base") + F.coalesce("node_links", F.lit(0))).alias("n_links"),
        )
    )
    return (
        plain.filter("NOT good")
        .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        .unionByName(_by_row(good, nodes, classes))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _by_row(good: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes of one vector are its row; rows of the others find their class by the vector."""
    columns = ["vec_id", "n_links", "component_id"]
    alone = classes.filter("n = 1").withColumnRenamed("low", "vec_id").select(*columns)
    repeated = classes.filter("n > 1")
    maybe = maybe_among(repeated.select("hash"))(F.col("hash"))
    held = (
        nodes.filter("n > 1")
        .select("node", "vec", "hash")
        .join(repeated.select("node", "n_links", "component_id"), "node")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    some = good.filter(maybe).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
    return alone.unionByName(some.join(held, ["hash", "salt", "vec"]).select(*columns))
