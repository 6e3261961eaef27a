"""Near-duplicates by bottom-k sketches from one hash function.

Each text becomes the set of its word shingles, each shingle a 64-bit hash, and the ``k``
smallest hashes are its sketch. Texts with equal sets form one class; only classes are
compared, so copies are never expanded into pairs.

Candidates come from inverted lists. A sketch is put in order of frequency (a table of
``CELLS`` bytes counts the retained values of all sketches by hash), rare values first, ties
by value. The key of a list is a run of two values that are neighbours in this order, and runs
start in the rare part only: a passage that many texts share makes no list unless it is most
of a text. Sets below ``EXACT`` shingles that are linked share such a run for certain: the
values not in common are at most a fifth of the union, each breaks at most one run, so a
common run starts in the first two fifths. A larger set starts runs at ``STARTS`` places;
the chance that a pair at similarity 0.8 shares none is estimated at about 1e-7, not proved.

Members of a list first meet two leaders: the member in most lists, which is the least
edited one of a family, and such a one outside the list's largest component; in the second
turn one by hash. That is linear in the lists, and the links give components. Lists of one
component are done. In the others, members outside the largest component meet all members of
other components, however long the list, so no pair is left out; the join keeps only pairs
whose sets can be linked: parity bits of whole sets differ in no more cells than the sets
differ in values, which proves most pairs apart and never loses a link. This last step tests
outside members against a whole list, so its time, not its output, grows with their product.

Overlap of the union sketch (its share of common values, 0.5 or more; a pair at similarity
0.8 is lost with a chance of 2e-8) and the same parity bound filter candidates; links are
confirmed on full sets.

Components come from alternating star contraction of the confirmed links; every step is a
join or a combinable minimum, and no list, link or component is gathered on the driver.

Defined cases: texts without words are empty sets, linked with nothing. A null id belongs to
the component of its text but never names it; a component of null ids only has a null id.
Rows that repeat an id are kept or dropped alike by ``one_per_group``, which decides by id;
``one_row_per_group`` decides by row and leaves one of each component. An empty table gives an empty result. Only
the id and the text are read. One text must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.llm.common import SPACED, Words, maybe_among, mix64, text_slices, without_ids
from postgauge.memory import give_back
from postgauge.session import settle_alone

#: Values kept per sketch.
SKETCH = 64
#: Cells of the frequency table that puts the values of a sketch in order.
CELLS = 1 << 21
#: Sets below this size fit the sketch, and so do all sets they may be linked with.
EXACT = 52
#: Places of a larger set's ordered sketch at which runs of two values start.
STARTS = 36
#: Parity bits of a whole set.
ODD = 1024
#: Rounds in which members of a list meet leaders only.
TURNS = 2
#: Bytes of text and rows handled at once inside a task; their arrays are many times as large.
SLICE_BYTES = 1 << 18
SLICE_ROWS = 1 << 10
#: Links that are worth a task.
TASK_LINKS = 100_000
#: Share of common values in the union sketch below which a candidate is not confirmed.
ESTIMATE = 0.5

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(
    column: pa.Array, width: int
) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, as signed 64-bit numbers."""
    for _, _, data, offsets in text_slices(column, SLICE_BYTES):
        words = Words(data, offsets, SPACED)
        hashes = words.hashes
        folded = hashes.copy()
        with np.errstate(over="ignore"):
            for j in range(1, width):
                if len(hashes) > j:
                    folded[:-j] = mix64(folded[:-j] * _STEP + hashes[j:])
            bounds = words.bounds.tolist()
            for start, end in zip(bounds, bounds[1:], strict=False):
                if end - start >= width:
                    found = folded[start : end - width + 1]
                else:
                    found = hashes[start : start + min(1, end - start)].copy()
                    for j in range(start + 1, end):
                        found = mix64(found * _STEP + hashes[j])
                    found += np.uint64(end - start)
                yield np.unique(found.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _by_slices(
    run: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a few rows at a time; what a task no longer needs leaves its worker."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield run(batch.slice(at, SLICE_ROWS))
        give_back()

    return sliced


def _key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _odd(values: np.ndarray) -> np.ndarray:
    """For each of ``ODD`` cells whether an odd number of the set's values fall in it."""
    cells = mix64(values.view(np.uint64)) % np.uint64(ODD)
    odd = np.bincount(cells.view(np.int64), minlength=ODD) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def sketches(
    docs: DataFrame, width: int = 5, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, row_key (hash of id and text), n_shingles, set_key, sketch and odd.

    ``set_key`` is a digest of the whole set, ``odd`` its ``ODD`` parity bits.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, kept, odd = [], [], [], []
        for values in shingle_sets(batch.column(2), width):
            sizes.append(len(values))
            keys.append(_key(values))
            # A view would keep the whole set.
            kept.append(values[:SKETCH].copy())
            odd.append(_odd(values))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                _lists(kept),
                _lists(odd),
            ],
            names=["doc_id", "row_key", "n_shingles", "set_key", "sketch", "odd"],
        )

    return _keyed(docs, id_column, text).mapInArrow(
        _by_slices(run),
        "doc_id long, row_key long, n_shingles long, set_key binary, sketch array<long>, odd array<long>",
    )


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    number = F.col(id_column).cast("long")
    return docs.select(
        number.alias("doc_id"),
        F.xxhash64(number, F.col(text)).alias("row_key"),
        F.col(text).alias("text"),
    )


def _alike(a: Column, b: Column) -> Column:
    """Set sizes that allow a similarity of 0.8."""
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _frequencies(classes: DataFrame) -> np.ndarray:
    """One byte per hashed value: twice the logarithm of how many sketches hold such values.

    ``CELLS`` bytes whatever the input, collected as packed rows of 4,096.
    """
    cell = F.pmod(F.col("value"), F.lit(CELLS)).cast("int")
    counted = (
        classes.select(F.explode("sketch").alias("value"))
        .groupBy(cell.alias("cell"))
        .agg(F.floor(2 * F.log2(F.count("*"))).cast("int").alias("level"))
        .groupBy(F.floor(F.col("cell") / 4096).cast("int").alias("part"))
        .agg(F.collect_list(F.struct(F.col("cell") % 4096, "level")).alias("held"))
        .select("part", F.transform("held", lambda h: h["level"] * 4096 + h["col1"]).alias("held"))
    )
    levels = np.zeros(CELLS, np.uint8)
    # A job for each partition: a few suffice for this many rows.
    for part, held in counted.coalesce(8).toLocalIterator():
        packed = np.asarray(held, np.int64)
        levels[part * 4096 + packed % 4096] = packed // 4096
    return levels


def _run_rows(classes: DataFrame) -> DataFrame:
    """(key, node, n): runs of two neighbouring values in the rare part of each sketch."""
    sent = classes.sparkSession.sparkContext.broadcast(_frequencies(classes))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        ends = np.asarray(lists.offsets, np.int64)
        values = np.asarray(lists.values, np.int64)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        sizes = np.diff(ends)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((values, sent.value[values % CELLS], rows))
        hashes = mix64(values[order].view(np.uint64))
        starts = np.where(sizes < EXACT, 2 * sizes // 5 + 1, STARTS)
        place = np.arange(len(values)) - ends[rows]
        first = np.flatnonzero((place < starts[rows]) & (place + 1 < sizes[rows]))
        with np.errstate(over="ignore"):
            keys = mix64(hashes[first] * _STEP + hashes[first + 1]).view(np.int64)
        at = rows[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), batch.column(0).take(at), batch.column(1).take(at)],
            names=["key", "node", "n"],
        )

    return (
        classes.filter("n >= 4").select("node", "n", "sketch")
        .mapInArrow(_by_slices(run), "key long, node long, n long")
    )


def _shared_rows(classes: DataFrame) -> DataFrame:
    """Rows (key, node, n, listed) of the lists with two members or more.

    ``listed`` counts a node's lists: the least edited member of a family has most.
    """
    rows = _run_rows(classes)
    shared = rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    rows = settle_alone(rows.join(shared, "key"))
    return rows.join(rows.groupBy("node").agg(F.count("*").alias("listed")), "node")


def _mixed(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, n, listed, root, main): members of lists with several components.

    ``main`` is the largest component of the list.
    """
    rooted = (
        lists.select("key", "node", "n", "listed")
        .join(roots, "node", "left")
        .select("key", "node", "n", "listed", F.coalesce("root", "node").alias("root"))
    )
    found = (
        rooted.groupBy("key", "root")
        .agg(F.count("*").alias("c"))
        .groupBy("key")
        .agg(F.count("*").alias("roots"), F.max(F.struct("c", "root")).alias("most"))
        .filter("roots > 1")
        .select("key", F.col("most.root").alias("main"))
    )
    return rooted.join(found, "key")


def _leader(turn: int, among: Column) -> Column:
    """A member with its size and component: the one in most lists, in later turns a hashed one."""
    first = -F.col("listed") if turn == 0 else F.xxhash64(F.lit(turn), "node")
    return F.min(F.when(among, F.struct(first, F.xxhash64("node"), F.col("node").alias("node"), "n", "root")))


def _led(mixed: DataFrame, turn: int) -> DataFrame:
    """Members with leaders of their list: one of all, one of those outside the main component."""
    leaders = mixed.groupBy("key").agg(
        _leader(turn, F.lit(True)).alias("one"),
        _leader(0, F.col("root") != F.col("main")).alias("two"),
    )
    met = mixed.join(leaders, "key").select("node", "n", "root", F.explode(F.array("one", "two")).alias("led"))
    return (
        met.filter((F.col("root") != F.col("led.root")) & _alike(F.col("n"), F.col("led.n")))
        .select(*_ordered(F.col("node"), F.col("led.node")))
        .distinct()
    )


def _differ(x: str, y: str) -> Column:
    """Cells in which the parities of two sets differ; never more than values not in common."""
    return sum(
        F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}"))) for i in range(ODD // 64)
    )


def _cells(name: str) -> list[Column]:
    return [F.get("odd", F.lit(i)).alias(f"{name}{i}") for i in range(ODD // 64)]


def _outside_pairs(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """Members outside a list's main component with alike members of other components.

    Sets x and y at similarity 0.8 have at most (x + y) / 9 values not in common, and no more
    cells of different parity: the join's condition drops pairs above that and loses no link.
    """
    mixed = settle_alone(
        mixed.drop("listed").join(classes.select("node", *_cells("odd")), "node")
    )
    outside = mixed.filter("root != main").select(
        "key",
        F.col("node").alias("x"),
        F.col("n").alias("nx"),
        F.col("root").alias("rx"),
        *(F.col(f"odd{i}").alias(f"x{i}") for i in range(ODD // 64)),
    )
    # A pair of two outside members comes up twice; it is made from its smaller root.
    once = (F.col("rx") < F.col("root")) | (F.col("root") == F.col("main"))
    near = 9 * _differ("x", "odd") <= F.col("nx") + F.col("n")
    return (
        outside.join(mixed, "key")
        .filter((F.col("rx") != F.col("root")) & once & _alike(F.col("nx"), F.col("n")) & near)
        .select(*_ordered(F.col("x"), F.col("node")))
        .distinct()
    )


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose parities and union sketch allow a link."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    classes = classes.filter(maybe_among(nodes)(F.col("node")))
    x = classes.select(
        F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sketch_a"), *_cells("a")
    )
    y = classes.select(
        F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sketch_b"), *_cells("b")
    )
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    common = F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), F.col("union"))
    return (
        pairs.join(x, "a")
        .join(y, "b")
        .filter(9 * _differ("a", "b") <= F.col("na") + F.col("nb"))
        .withColumn("union", union)
        .filter(F.size(common) >= ESTIMATE * F.size("union"))
        .select("a", "b")
    )


def _full_sets(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, id_column: str, text: str
) -> DataFrame:
    """(node, values) for every node of ``pairs``, read again from one text of its class."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = wanted.join(classes.select("node", "set_key", "row_key"), "node")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(1).to_pylist()
        values = [
            v.tobytes() if _key(v) == k else None
            for v, k in zip(shingle_sets(batch.column(2), width), keys, strict=True)
        ]
        out = pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.binary())], names=["node", "values"]
        )
        return out.filter(pa.array([v is not None for v in values], pa.bool_()))

    named = settle_alone(named)
    texts = _keyed(docs, id_column, text).drop("doc_id")
    texts = texts.filter(maybe_among(named.select("row_key"))(F.col("row_key")))
    return (
        named.join(texts, "row_key")
        .groupBy("row_key", "node")
        .agg(F.first("set_key").alias("set_key"), F.first("text").alias("text"))
        .select("node", "set_key", "text")
        .mapInArrow(_by_slices(run), "node long, values binary")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are at least 0.8 similar."""
    x = sets.select(F.col("node").alias("a"), F.col("values").alias("values_a"))
    y = sets.select(F.col("node").alias("b"), F.col("values").alias("values_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                one = np.frombuffer(left[i].as_buffer(), np.int64)
                two = np.frombuffer(right[i].as_buffer(), np.int64)
                merged = np.sort(np.concatenate([one, two]), kind="stable")
                common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                linked.append(100 * common >= 80 * (len(merged) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return (
        pairs.join(y, "b").join(x, "a").select("a", "b", "values_a", "values_b")
        .mapInArrow(run, "a long, b long")
    )


def _unfinished(links: DataFrame) -> tuple[int, int]:
    """Nodes with several links, or with a link from and a link to another; and all links."""
    roles = links.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    found = roles.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    open_nodes = F.count_if(F.expr("child > 1 OR (child > 0 AND parent > 0)"))
    return tuple(found.agg(open_nodes, F.coalesce(F.sum("child"), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link; ``root`` is the smallest node reachable.

    Large-star and small-star steps in turn until every node has one link, to a node without
    one. Each step joins the links with the smallest neighbour of a node, which is a
    combinable minimum.
    """
    links = settle_alone(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        unfinished, count = _unfinished(links)
        # A task gets about so many links at least: below that, its files take more than they hold.
        links = links.coalesce(-(-count // TASK_LINKS) or 1)
        if not unfinished:
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        links = settle_alone(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _rooted_classes(
    docs: DataFrame, width: int, id_column: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and (set_key, first_id, root) of every class with shingles."""
    base = settle_alone(sketches(docs, width, id_column, text))
    classes = settle_alone(
        base.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min("row_key").alias("row_key"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("odd").alias("odd"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    def confirmed(pairs: DataFrame) -> DataFrame:
        likely = settle_alone(_estimated(settle_alone(pairs), classes))
        sets = settle_alone(_full_sets(likely, classes, docs, width, id_column, text))
        return settle_alone(_confirmed(likely, sets))

    links = compared = None
    roots = classes.select("node", F.col("node").alias("root")).limit(0)
    lists = settle_alone(_shared_rows(classes))
    for turn in range(TURNS + 1):
        # A list whose members are one component is done; the others lose no member.
        lists = settle_alone(_mixed(lists, roots))
        if lists.isEmpty():
            break
        pairs = settle_alone(_led(lists, turn) if turn < TURNS else _outside_pairs(lists, classes))
        if compared is not None:
            pairs = settle_alone(pairs.join(compared, ["a", "b"], "left_anti"))
        compared = pairs if compared is None else compared.union(pairs)
        found = confirmed(pairs)
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            roots = settle_alone(components(links))
    return base, classes.join(roots, "node", "left").select(
        "set_key", "first_id", F.coalesce("root", "node").alias("root")
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (doc_id = component_id) and set_key.

    ``set_key`` names the class of rows with the same set of shingles.
    """
    base, rooted = _rooted_classes(docs, width, id_column, text)
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(firsts, "root").select("set_key", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        base.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            "set_key",
        )
    )


def one_per_group(
    docs: DataFrame, width: int = 5, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that name their component, with their own columns; null ids stay."""
    found = near_duplicates(docs, width, id_column, text)
    gone = found.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return without_ids(docs, settle_alone(gone), id_column)


def one_row_per_group(
    docs: DataFrame, width: int = 5, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Exactly one row of every component, with its own columns.

    The row with the smallest id (nulls last), then the smallest ``row_key``; of rows equal
    in both, one. Rows without words are in no component and all stay.
    """
    base, rooted = _rooted_classes(docs, width, id_column, text)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))
    firsts = base.filter("n_shingles > 0").groupBy("set_key").agg(F.min(order).alias("first"))
    chosen = settle_alone(
        firsts.join(rooted, "set_key")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select("first.row_key")
    )
    number = F.col(id_column).cast("long")
    rows = docs.select(
        F.xxhash64(number, F.col(text)).alias("row_key"),
        F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
        F.struct(*docs.columns).alias("row"),
    )
    # Equal rows are combined before the join, so many copies meet no single task.
    single = (
        rows.filter(F.col("worded") & maybe_among(chosen)(F.col("row_key")))
        .groupBy("row_key")
        .agg(F.first("row").alias("row"))
        .join(chosen, "row_key", "left_semi")
    )
    return rows.filter("NOT worded").select("row.*").union(single.select("row.*"))
