"""Benchmark passages in documents, found with suffix arrays over the documents.

Words are runs of letters and digits, lower-cased. A shard, about a megabyte of whole
documents inside a task, gets an array of its suffixes in the order of their words, sorted
by prefix doubling to the depth a test window has. A window is ten consecutive words of an
item (all words of a shorter item); every window is looked up by binary search, one word at
a time, in the range its prefix has left. The range holds all its occurrences. Windows that
follow each other in document and item merge into the longest verbatim match.

Words are compared by 64-bit hashes in the search; each window found is then compared word
by word with the text.

The test set goes to the tasks in blocks of bounded size, one pass over the documents for
each block, so a large benchmark costs passes and not memory.

Defined cases: a null text has no words, an item without words no windows. An item without
id counts under the empty string, items that repeat an id count once. Rows that repeat a
document id, or have none, get a result each; ``clean_rows`` decides by row, ``without_leaks``
by id. Empty tables give an empty result or no hits.
Only ids and texts are read. One text must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postgauge.llm.common import ALNUM, Words, text_slices, without_ids
from postgauge.session import settle

#: Words of a window.
WINDOW = 10
#: Bytes of item text in a block of the test set.
BLOCK_BYTES = 16 << 20

_SPANS = "spans array<struct<start:long,end:long>>, items array<string>"


class Windows:
    """The distinct windows of a block of items, as word hashes and as words."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        hashes: dict[tuple[bytes, ...], np.ndarray] = {}
        column = pa.array([text for _, text in items], pa.large_string())
        for start, _, data, offsets in text_slices(column):
            words = Words(data, offsets, ALNUM)
            bounds = words.bounds.tolist()
            for row, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
                size = min(window, high - low)
                shown = words.text(low, high)
                for at in range(high - low - size + 1 if size else 0):
                    key = tuple(shown[at : at + size])
                    found.setdefault(key, set()).add(items[start + row][0])
                    hashes[key] = words.hashes[low + at : low + at + size]
        self.words = list(found)
        self.items = [sorted(found[key]) for key in self.words]
        self.lengths = np.array([len(key) for key in self.words], dtype=np.int64)
        self.hashes = np.zeros((len(self.words), window), dtype=np.uint64)
        for i, key in enumerate(self.words):
            self.hashes[i, : len(key)] = hashes[key]


def suffix_array(hashes: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Word positions in the order of the ``depth`` words that start there.

    ``ends`` is the end of each position's text; a text that ends sorts before one that goes
    on. Only positions that share their rank with others are sorted again.
    """
    n = len(hashes)
    order = np.argsort(hashes, kind="stable")
    sorted_hashes = hashes[order]
    new = np.ones(n, dtype=bool)
    new[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    rank = np.empty(n, dtype=np.int64)
    #: A rank is the first slot of its group, plus one.
    slots = np.flatnonzero(new)
    rank[order] = np.repeat(slots, np.diff(np.append(slots, n))) + 1
    width = 1
    while width < depth:
        alone = new & np.append(new[1:], True)
        open_slots = np.flatnonzero(~alone)
        if not len(open_slots):
            break
        at = order[open_slots]
        after = at + width
        inside = after < ends[at]
        follow = np.zeros(len(at), dtype=np.int64)
        follow[inside] = rank[after[inside]]
        key = rank[at] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        order[open_slots] = at = at[by]
        key = key[by]
        starts = np.ones(len(at), dtype=bool)
        starts[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(starts)
        rank[at] = np.repeat(open_slots[first], np.diff(np.append(first, len(at)))) + 1
        new[open_slots] = starts
        width *= 2
    return order


def _bound(
    keys: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool
) -> np.ndarray:
    """For each range [low, high): the first slot whose key is not below (``after``: above)
    ``wanted``. ``keys`` gives the key at slots."""
    low, high = low.copy(), high.copy()
    while True:
        live = low < high
        if not live.any():
            return low
        middle = (low + high) >> 1
        value = keys(middle, live)
        right = live & ((value <= wanted) if after else (value < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(live & ~right, middle, high)


def find_windows(
    hashes: np.ndarray, ends: np.ndarray, order: np.ndarray, windows: Windows
) -> tuple[np.ndarray, np.ndarray]:
    """(word position, window number) of every occurrence."""
    n = len(order)
    numbers = np.arange(len(windows.words))
    low, high = np.zeros(len(numbers), np.int64), np.full(len(numbers), n, np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    depth = 0
    while len(numbers):
        wanted = windows.hashes[numbers, depth]
        if depth == 0:
            first = hashes[order]
            low = np.searchsorted(first, wanted, side="left")
            high = np.searchsorted(first, wanted, side="right")
        else:

            def word(middle, live, depth=depth):
                at = order[np.where(live, middle, 0)] + depth
                return hashes[np.minimum(at, n - 1)]

            # Texts that end here come first in their range; step over them.
            def going_on(middle, live, depth=depth):
                at = order[np.where(live, middle, 0)]
                return (at + depth < ends[at]).astype(np.uint64)

            low = _bound(going_on, low, high, np.ones(len(low), np.uint64), after=False)
            low, high = (
                _bound(word, low, high, wanted, after=False),
                _bound(word, low, high, wanted, after=True),
            )
        depth += 1
        some = low < high
        numbers, low, high = numbers[some], low[some], high[some]
        whole = windows.lengths[numbers] == depth
        done.append((numbers[whole], low[whole], high[whole]))
        numbers, low, high = numbers[~whole], low[~whole], high[~whole]
    found = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    if not len(found):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = np.concatenate([d[1] for d in done]), np.concatenate([d[2] for d in done])
    sizes = high - low
    slots = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return order[slots], np.repeat(found, sizes)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def scan_shard(
    words: Words, windows: Windows, window: int
) -> dict[int, tuple[list[tuple[int, int]], list[str]]]:
    """By row: merged spans of hit words and the items they come from."""
    if not len(words.hashes) or not windows.words:
        return {}
    ends = words.bounds[words.rows + 1]
    order = suffix_array(words.hashes, ends, window)
    at, number = find_windows(words.hashes, ends, order, windows)
    by_row: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    for position, w in zip(at.tolist(), number.tolist(), strict=True):
        size = int(windows.lengths[w])
        if tuple(words.text(position, position + size)) != windows.words[w]:
            continue
        row = int(words.rows[position])
        spans, items = by_row.setdefault(row, ([], set()))
        local = position - int(words.bounds[row])
        spans.append((local, local + size))
        items.update(windows.items[w])
    return {row: (_merged(spans), sorted(items)) for row, (spans, items) in by_row.items()}


def _scan(frame: DataFrame, windows: Windows, window: int, keep_text: bool) -> DataFrame:
    """One pass: adds what this block finds to ``spans`` and ``items``."""
    sent = frame.sparkSession.sparkContext.broadcast(windows)
    rest = StructType.fromDDL(f"{'text string, ' if keep_text else ''}n_words long, {_SPANS}")
    schema = StructType([frame.schema["row"], *rest])
    names = ["row", *(["text"] if keep_text else []), "n_words", "spans", "items"]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            spans, items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            for start, end, data, offsets in text_slices(texts):
                words = Words(data, offsets, ALNUM)
                counts[start:end] = np.diff(words.bounds)
                for row, (new_spans, new_items) in scan_shard(words, sent.value, window).items():
                    old = [(s["start"], s["end"]) for s in spans[start + row]]
                    spans[start + row] = [
                        {"start": a, "end": b} for a, b in _merged(old + new_spans)
                    ]
                    items[start + row] = sorted({*items[start + row], *new_items})
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *([texts] if keep_text else []),
                    pa.array(counts),
                    pa.array(spans, span_type),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=names,
            )

    return frame.select("row", "text", "spans", "items").mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, item_column: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``BLOCK_BYTES``, one collected at a time."""
    items = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for number in range(blocks):
        yield [tuple(r) for r in items.filter(block == number).distinct().collect()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text: str = "text",
    item_text: str = "text",
) -> DataFrame:
    """Per document: doc_id, n_words, spans (merged word ranges that are hit) and items."""
    row = F.struct(F.col(id_column).cast("long").alias("doc_id"))
    found = _scanned(docs, row, benchmark, window, item_column, text, item_text)
    return found.select("row.doc_id", "n_words", "spans", "items")


def _scanned(
    docs: DataFrame,
    row: Column,
    benchmark: DataFrame,
    window: int,
    item_column: str,
    text: str,
    item_text: str,
) -> DataFrame:
    """``row`` of every document with n_words, spans and items over all blocks."""
    frame = docs.select(
        row.alias("row"),
        F.col(text).alias("text"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    block = None
    for more in _blocks(benchmark, item_column, item_text):
        if block is not None:
            frame = settle(_scan(frame, Windows(block, window), window, keep_text=True))
        block = more
    return _scan(frame, Windows(block, window), window, keep_text=False)


def leak_digests(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find_leaks`` as counts and a digest of the item ids."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return find_leaks(docs, benchmark, **options).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options
) -> DataFrame:
    """The documents without any window, with their own columns; rows without id stay."""
    found = find_leaks(docs, benchmark, id_column=id_column, **options)
    hit = found.filter("size(spans) > 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return without_ids(docs, settle(hit), id_column)


def clean_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    item_column: str = "item_id",
    text: str = "text",
    item_text: str = "text",
) -> DataFrame:
    """The rows without any window, with their own columns; ids decide nothing.

    Each row goes through the scan as a struct, so no join is needed afterwards.
    """
    found = _scanned(docs, F.struct(*docs.columns), benchmark, window, item_column, text, item_text)
    return found.filter("size(spans) = 0").select("row.*")
