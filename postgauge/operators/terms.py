"""Corpus statistics of terms and the choice of a vocabulary."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.config import FeatureSpec
from postgauge.functions import text as X
from postgauge.memory import give_back
from postgauge.session import settle

NORMALIZED = "normalized"


def term_occurrences(docs: DataFrame, spec: FeatureSpec, keys: Sequence[str]) -> DataFrame:
    """One row per document and term with the count inside the document."""
    return (
        docs.select(*keys, F.explode(X.terms(F.col(NORMALIZED), spec)).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


#: Mark of rows that are no term but count the documents.
DOCUMENT = 0
#: Characters of text that are counted at once inside a task, about.
SLICE_CHARS = 2_000_000
#: Documents whose character n-grams are counted at once, in cells for every term.
DOCS = 64
#: Marks (word, document) that are held at once inside a task.
MARKS = 1 << 24
#: Cells that bound the counts of word runs from above, and cells of a shuffled row.
CELLS, CELL_BLOCK = 1 << 22, 1 << 12


def _uses(specs: Sequence[FeatureSpec], analyzer: str) -> dict[int, int]:
    """For every length of n-gram, which configurations use it, as bits."""
    found: dict[int, int] = {}
    for bit, spec in enumerate(specs):
        if spec.analyzer == analyzer:
            for n in range(spec.min_n, spec.max_n + 1):
                found[n] = found.get(n, 0) | 1 << bit
    return found


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of one fold with about ``SLICE_CHARS`` bytes of text, or a single longer text."""
    folds = batch.column("fold")
    for fold in folds.unique():
        rows = batch.filter(pc.equal(folds, fold))
        lengths = sum(
            pc.binary_length(rows.column(c)).to_numpy().astype(np.int64) for c in ("runs", "text")
        )
        group = np.cumsum(lengths) // SLICE_CHARS
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for start, end in zip(edges, edges[1:], strict=False):
            yield rows.slice(start, end - start)


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct space-separated words of some texts, the code of each word and its text."""
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten()
    doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    real = pc.not_equal(words, "")
    coded = words.filter(real).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    return coded.dictionary, codes, doc[real.to_numpy(zero_copy_only=False)]


def _cells(words: pa.Array, codes: np.ndarray, lengths: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, cell of the run of n words that starts at each place) for every length."""
    hashes = np.array([zlib.crc32(w.encode()) for w in words.to_pylist()], np.uint64)[codes]
    for n in lengths:
        mixed = hashes[: len(codes) - n + 1].copy()
        with np.errstate(over="ignore"):
            for i in range(1, n):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(codes) - n + 1 + i]
            mixed *= np.uint64(0xD6E8FEB86659FD93)
        yield n, ((mixed ^ mixed >> np.uint64(32)) % np.uint64(CELLS)).astype(np.int64)


def _word_counts(texts: pa.Array, uses: dict[int, int], open_cells: np.ndarray | None) -> Iterator[tuple]:
    """(uses, terms, df, tf) of the word n-grams of some documents.

    With ``open_cells`` longer runs than a word are only those of an open cell.
    """
    words, codes, doc = _coded(texts)
    cells = {}
    if open_cells is not None:
        cells = dict(_cells(words, codes, [n for n in uses if 1 < n <= len(codes)]))
    for n in uses:
        at = np.flatnonzero(doc[: max(0, len(codes) - n + 1)] == doc[n - 1 :])
        if n in cells:
            at = at[open_cells[cells[n][at]]]
        if not len(at):
            continue
        grams, size = codes[at], len(words)
        for i in range(1, n):
            grams = grams * len(words) + codes[at + i]
            kept, grams = np.unique(grams, return_inverse=True)
            size = len(kept)
        tf = np.bincount(grams, minlength=size)
        df = np.bincount(np.unique(doc[at] * size + grams) % size, minlength=size)
        place = np.zeros(size, np.int64)
        place[grams] = at
        parts = [words.take(pa.array(codes[place + i])) for i in range(n)]
        terms = pc.binary_join_element_wise(*parts, " ") if n > 1 else words
        yield uses[n], terms, df, tf


def _char_counts(texts: pa.Array, uses: dict[int, int]) -> Iterator[tuple]:
    """(uses, terms, df, tf) of the character n-grams of some documents, n being 2 or more.

    Every distinct word is cut up once, whatever its repetition. A gram is in the documents
    that any of its words is in, so the bits of these words are joined by a logical or.
    """
    words, codes, doc = _coded(texts)
    if not len(codes):
        return
    padded = " ".join(["", *words.to_pylist(), ""])
    points = np.frombuffer(padded.encode("utf-32-le"), np.uint32)
    alphabet, letters = np.unique(points, return_inverse=True)
    space = points == ord(" ")
    word = np.cumsum(space) - 1
    times = np.bincount(codes, minlength=len(words))
    for n, bits in uses.items():
        inside = np.ones(max(0, len(points) - n + 1), bool)
        for i in range(1, n - 1):
            inside &= ~space[i : len(inside) + i]
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        grams, size = letters[at].astype(np.int64), len(alphabet)
        for i in range(1, n):
            if size * len(alphabet) >= 1 << 62:
                kept, grams = np.unique(grams, return_inverse=True)
                size = len(kept)
            grams = grams * len(alphabet) + letters[at + i]
            size *= len(alphabet)
        order = np.argsort(grams, kind="stable")
        grams, at = grams[order], at[order]
        first = np.flatnonzero(np.diff(grams, prepend=-1))
        held = word[at + space[at]]
        tf = np.add.reduceat(times[held], first)
        df = _documents(codes, doc, len(words), held, first)
        terms = points[at[first][:, None] + np.arange(n)].view(f"<U{n}").ravel()
        yield bits, pa.array(terms, pa.string()), df, tf


class GramTable:
    """Character n-grams of a vocabulary, found in words by hash and compared in full."""

    def __init__(self, terms: Sequence[str]):
        self.size = len(terms)
        self.by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        lengths = np.array([len(term) for term in terms])
        for n in sorted(set(lengths.tolist())):
            places = np.flatnonzero(lengths == n)
            points = _points("".join(terms[i] for i in places)).reshape(-1, n)
            hashes = _gram_hashes(points)
            order = np.argsort(hashes, kind="stable")
            self.by_length.append((n, hashes[order], points[order], places[order]))

    def found(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ends, places): the vocabulary's places of every gram of each word, one after the other.

        ``places[ends[i] : ends[i + 1]]`` are those of word i, repeated as often as they occur.
        """
        points = _points(" ".join(["", *words.to_pylist(), ""]))
        space = points == ord(" ")
        word = np.cumsum(space) - 1
        owners, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, hashes, known, numbers in self.by_length:
            inside = np.ones(max(0, len(points) - n + 1), bool)
            for i in range(1, n - 1):
                inside &= ~space[i : len(inside) + i]
            at = np.flatnonzero(inside)
            grams = points[at[:, None] + np.arange(n)]
            wanted = _gram_hashes(grams)
            spot, last = np.searchsorted(hashes, wanted), np.searchsorted(hashes, wanted, side="right")
            # Terms of one hash stand together; there is nearly always one.
            for step in range(int((last - spot).max(initial=0))):
                may = np.flatnonzero(spot + step < last)
                may = may[(known[spot[may] + step] == grams[may]).all(axis=1)]
                owners.append(word[at[may] + space[at[may]]])
                places.append(numbers[spot[may] + step])
        owner, place = np.concatenate(owners), np.concatenate(places)
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(len(words) + 1))
        return ends, place[order]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _gram_hashes(grams: np.ndarray) -> np.ndarray:
    mixed = np.zeros(len(grams), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(grams.shape[1]):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + grams[:, i] + np.uint64(1)
            mixed ^= mixed >> np.uint64(29)
    return mixed


def gram_vectors(texts: pa.Array, table: GramTable) -> pa.Array:
    """Sparse count vectors of texts; every distinct word of a slice is cut up once."""
    texts = pc.fill_null(texts, "")
    group = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // SLICE_CHARS
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    parts = [_slice_vectors(texts.slice(a, b - a), table) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.concat_arrays(parts)


def _slice_vectors(texts: pa.Array, table: GramTable) -> pa.Array:
    rows, size = len(texts), table.size
    words, codes, doc = _coded(texts)
    held, counts = np.zeros(0, np.int64), np.zeros(0)
    if len(codes):
        ends, places = table.found(words)
        pairs, times = np.unique(doc * len(words) + codes, return_counts=True)
        of, code = pairs // len(words), pairs % len(words)
        kept_keys, kept_counts = [], []
        grams = np.diff(ends)[code]
        for low, high in _runs(of):
            many = grams[low:high]
            total = int(many.sum())
            inner = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
            place = places[np.repeat(ends[code[low:high]], many) + inner]
            first = int(of[low])
            keys = np.repeat(of[low:high] - first, many) * size + place
            sums = np.bincount(keys, np.repeat(times[low:high], many))
            found = np.flatnonzero(sums)
            kept_keys.append(found + first * size)
            kept_counts.append(sums[found])
        held, counts = np.concatenate(kept_keys), np.concatenate(kept_counts)
    offsets = pa.array(np.searchsorted(held, np.arange(rows + 1) * size), pa.int32())
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(rows, np.int8)),
            pa.array(np.full(rows, size, np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array((held % size).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(counts)),
        ],
        ["type", "size", "indices", "values"],
    )


def _runs(of: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents with ``DOCS`` documents at most."""
    edges = np.flatnonzero(np.diff(of // DOCS)) + 1
    bounds = [0, *edges.tolist(), len(of)]
    yield from zip(bounds, bounds[1:], strict=False)


def _documents(codes: np.ndarray, doc: np.ndarray, words: int, held: np.ndarray, first: np.ndarray) -> np.ndarray:
    """In how many documents any word of a group is; groups start at ``first`` in ``held``."""
    df = np.zeros(len(first), np.int64)
    step = max(64, min(MARKS // words, 8 * MARKS // len(held)) // 64 * 64)
    for start in range(0, int(doc[-1]) + 1, step):
        low, high = np.searchsorted(doc, (start, start + step))
        marks = np.zeros((words, step), bool)
        marks[codes[low:high], doc[low:high] - start] = True
        bits = np.packbits(marks, axis=1).view(np.uint64)
        df += np.bitwise_count(np.bitwise_or.reduceat(bits[held], first)).sum(axis=1, dtype=np.int64)
    return df


def _texts(docs: DataFrame, specs: Sequence[FeatureSpec], folded: bool) -> DataFrame:
    """Per document its fold, its words as a text, and the text itself if characters count."""
    text = F.col(NORMALIZED)
    word_uses, char_uses = _uses(specs, "word"), _uses(specs, "char_wb")
    return docs.where(text.isNotNull()).select(
        (F.coalesce(F.col("fold").cast("int"), F.lit(0)) if folded else F.lit(0)).alias("fold"),
        (F.array_join(X.words(text), " ") if word_uses else F.lit("")).alias("runs"),
        (text if char_uses else F.lit("")).alias("text"),
    )


def _counted_parts(
    texts: DataFrame, specs: Sequence[FeatureSpec], open_cells: np.ndarray | None = None
) -> DataFrame:
    """Rows of ``(fold, uses, term, df, tf)`` to be added up, from one pass over ``_texts``.

    A task adds up the terms of some hundred documents itself, so the shuffle gets one row
    for each of their distinct terms, and no document is ever regrouped.
    """
    word_uses, char_uses = _uses(specs, "word"), _uses(specs, "char_wb")
    sent = None
    if open_cells is not None:
        sent = texts.sparkSession.sparkContext.broadcast(open_cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                counts = [(DOCUMENT, pa.array([""]), np.array([part.num_rows]), np.array([0]))]
                if word_uses:
                    counts += _word_counts(part.column("runs"), word_uses, sent and sent.value)
                if char_uses:
                    counts += _char_counts(part.column("text"), char_uses)
                yield _one_row(part.column("fold")[0], counts)
        give_back()

    lists = "groups array<struct<uses int, counts array<struct<term string, df bigint, tf bigint>>>>"
    groups = texts.mapInArrow(run, f"fold int, {lists}").select("fold", F.inline("groups"))
    return groups.select("fold", "uses", F.inline("counts"))


def _one_row(fold: pa.Scalar, counts: list[tuple]) -> pa.RecordBatch:
    """What a slice of documents adds to each kind of term, as one row."""
    ends = np.cumsum([0, *(len(terms) for _, terms, _, _ in counts)])
    columns = [
        pa.concat_arrays([terms for _, terms, _, _ in counts]),
        pa.array(np.concatenate([df for _, _, df, _ in counts]).astype(np.int64)),
        pa.array(np.concatenate([tf for _, _, _, tf in counts]).astype(np.int64)),
    ]
    rows = pa.StructArray.from_arrays(columns, ["term", "df", "tf"])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
    uses = pa.array([uses for uses, _, _, _ in counts], pa.int32())
    groups = pa.StructArray.from_arrays([uses, lists], ["uses", "counts"])
    return pa.RecordBatch.from_arrays(
        [pa.array([fold.as_py()], pa.int32()), pa.ListArray.from_arrays([0, len(counts)], groups)],
        names=["fold", "groups"],
    )


def _cell_counts(texts: DataFrame, lengths: Sequence[int]) -> np.ndarray:
    """How often runs of several words fall in each cell: no run returns more often.

    ``CELLS`` numbers whatever the input; tasks count into them, and blocks are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in _slices(batch):
                words, codes, doc = _coded(part.column("runs"))
                for n, cells in _cells(words, codes, [n for n in lengths if n <= len(codes)]):
                    totals += np.bincount(cells[doc[: len(cells)] == doc[n - 1 :]], minlength=CELLS)
        yield from blocks(totals.reshape(-1, CELL_BLOCK))

    def blocks(totals: np.ndarray, numbers: Sequence[int] | None = None) -> Iterator[pa.RecordBatch]:
        for number, block in zip(numbers or range(len(totals)), totals, strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([block.tobytes()], pa.binary())],
                names=["block", "counts"],
            )

    def added(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in rows.column("counts"))
        return pa.Table.from_batches(blocks([total], [rows.column("block")[0].as_py()]))

    schema = "block int, counts binary"
    found = texts.mapInArrow(run, schema).groupBy("block").applyInArrow(added, schema).collect()
    totals = np.zeros((CELLS // CELL_BLOCK, CELL_BLOCK), np.int64)
    for row in found:
        totals[row["block"]] = np.frombuffer(row["counts"], np.int64)
    return totals.reshape(-1)


def vocabulary_statistics(docs: DataFrame, specs: Sequence[FeatureSpec], folds: int = 0) -> DataFrame:
    """Stored ``shared_statistics`` with all the terms that the vocabularies need.

    Most runs of several words return too seldom for a vocabulary. A table of ``CELLS``
    counts bounds how often they do, and only runs of cells that reach a floor are counted.
    If at least ``max_features`` kept terms reach the floor themselves, on every training
    side, no term below it can be chosen; otherwise the floor is lowered. Below the least
    ``min_df`` it leaves nothing out that a vocabulary may keep.
    """
    least = min(spec.min_df for spec in specs)
    useful = (F.col("uses") == DOCUMENT) | (F.col("df") >= least)
    longer = [n for n in _uses(specs, "word") if n > 1]
    if not longer:
        return settle(shared_statistics(docs, specs, folds).where(useful))
    texts = settle(_texts(docs, specs, bool(folds)))
    cells = _cell_counts(texts, longer)
    wanted = 4 * max(spec.max_features for spec in specs)
    floor = int(np.partition(cells, CELLS - wanted)[CELLS - wanted])
    while True:
        floor = max(floor, least)
        counted = _added(_counted_parts(texts, specs, cells >= floor), specs, folds)
        stats = settle(counted.where(useful))
        if floor == least or _reached(stats, specs, folds, floor):
            return stats
        floor //= 8


def _reached(stats: DataFrame, specs: Sequence[FeatureSpec], folds: int, floor: int) -> bool:
    """Whether every vocabulary is full with terms that return ``floor`` times or more."""
    documents = stats.where(F.col("uses") == DOCUMENT).first()
    if documents is None:
        return True
    sides = [(F.col("df"), F.col("tf"), documents["df"])]
    if folds:
        sides = [
            (F.col("df") - F.col(f"df_{k}"), F.col("tf") - F.col(f"tf_{k}"), documents["df"] - documents[f"df_{k}"])
            for k in range(1, folds + 1)
        ]
    full, limits = [], []
    for bit, spec in enumerate(specs):
        if spec.analyzer != "word" or spec.max_n == 1:
            continue
        own = (F.col("uses") > 0) & (F.col("uses").bitwiseAND(1 << bit) != 0)
        for df, tf, n_docs in sides:
            kept = own & (df >= spec.min_df) & (df <= spec.max_df * n_docs) & (tf >= floor)
            full.append(F.count_if(kept))
            limits.append(spec.max_features)
    return all(n >= limit for n, limit in zip(stats.agg(*full).first(), limits, strict=True))


def shared_statistics(docs: DataFrame, specs: Sequence[FeatureSpec], folds: int = 0) -> DataFrame:
    """Document frequency ``df`` and corpus count ``tf`` of the terms of all configurations.

    One pass over the text and one (uses, term) aggregation serve all; bit i of ``uses``
    tells that the i-th configuration has the term, and the row with ``uses`` 0 has the
    number of documents as its df. With ``folds`` the result also has ``df_1 .. df_k`` and
    ``tf_1 .. tf_k`` for the documents whose ``fold`` is that number, so the statistics of any
    training side are a subtraction. Beside character n-grams, word n-grams are only those
    that reach the smallest ``min_df``.
    """
    return _added(_counted_parts(_texts(docs, specs, bool(folds)), specs), specs, folds)


def _added(parts: DataFrame, specs: Sequence[FeatureSpec], folds: int) -> DataFrame:
    sums: list[Column] = [F.sum("df").alias("df"), F.sum("tf").alias("tf")]
    for fold in range(1, folds + 1):
        inside = F.col("fold") == fold
        sums += [
            F.sum(F.when(inside, F.col(c)).otherwise(0)).alias(f"{c}_{fold}") for c in ("df", "tf")
        ]
    counted = parts.groupBy("uses", "term").agg(*sums)
    char_uses = _uses(specs, "char_wb")
    if not char_uses:
        return counted
    least = min(spec.min_df for spec in specs)
    is_char = F.col("uses").isin(*set(char_uses.values()))
    return counted.where((F.col("uses") == DOCUMENT) | is_char | (F.col("df") >= least))


def of_spec(stats: DataFrame, bit: int) -> DataFrame:
    """The terms of one configuration among shared statistics."""
    return stats.where((F.col("uses") > 0) & (F.col("uses").bitwiseAND(1 << bit) != 0)).drop("uses")


def counted_documents(stats: DataFrame) -> int:
    """Number of documents that shared statistics come from."""
    row = stats.where(F.col("uses") == DOCUMENT).select("df").first()
    return row["df"] if row else 0


def term_statistics(docs: DataFrame, spec: FeatureSpec, folds: int = 0) -> DataFrame:
    """Statistics of the terms of one configuration, rare ones included."""
    return of_spec(shared_statistics(docs, [spec], folds), 0)


def kept_terms(stats: DataFrame, spec: FeatureSpec, n_docs: int) -> DataFrame:
    """Terms inside the document-frequency limits."""
    return stats.where((F.col("df") >= spec.min_df) & (F.col("df") <= spec.max_df * n_docs))


def count_band(tf: Column) -> Column:
    """Sixteen bands per doubling of the count: at most about a thousand in all."""
    return F.floor(F.log2(tf.cast("double")) * 16).cast("int")


def band_floor(bands: Sequence[tuple[int, int]], limit: int) -> int:
    """Lowest band needed to reach ``limit`` terms from the top."""
    total = 0
    for band, terms in sorted(bands, reverse=True):
        total += terms
        if total >= limit:
            return band
    return -1


def most_frequent(kept: DataFrame, limit: int) -> DataFrame:
    """Exactly the ``limit`` terms with the highest corpus count, ties by term.

    The band filter leaves little more than ``limit`` rows, so the final top-k does
    not merge one full heap per partition.
    """
    bands = kept.groupBy(count_band(F.col("tf")).alias("band")).count().collect()
    floor = band_floor([(row[0], row[1]) for row in bands], limit)
    top = kept.where(count_band(F.col("tf")) >= floor) if floor >= 0 else kept
    return top.orderBy(F.desc("tf"), "term").limit(limit)


def check_limits(spec: FeatureSpec, n_docs: int) -> None:
    if n_docs * spec.max_df < spec.min_df:
        raise ValueError("max_df allows fewer documents than min_df requires")


