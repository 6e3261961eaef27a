"""Grouping of spelling variants by dynamic programming over sorted word lists.

Two words are near if one inserted, deleted or replaced code point makes one the other. Such a
pair, the shorter of L code points, has its first or its last L // 2 in common, so words
meet in groups of equal L and half. A group is a sorted list. Each of its words of length L is
compared with the list by rows of an edit matrix cut to a band of three, one row for a code
point of the listed word; the row of a prefix serves all words that share it, and once every
entry of a row exceeds one edit, the scan goes on behind the last word with that prefix.

A group of more than ``GROUP`` words is divided by the same rule applied to what its words do
not have in common, as often as need be; what is left then differs in three code points at
most, which the alphabet bounds. A pair that several groups hold counts in the first of
them, halves from the front going first. Groups report, per word, the number of its near words
and the most frequent one, never pairs.

Defined cases: null texts have no words, a null id is written as nothing in the damage key;
repeated rows count as often as they occur; tables without words give no rows. Other columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.session import settle

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One in so many runs loses a code point.
DAMAGED = 97
#: Words of a group that is compared in one piece.
GROUP = 4096
_LAST = chr(0x10FFFF)


def _damaged(doc_id: Column, run: Column) -> Column:
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(mark, F.char_length(run)).cast("int")
    return F.when(
        mark % DAMAGED == 0,
        F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run))),
    ).otherwise(run)


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """Words of ``documents`` after damage, with the number ``n`` of their occurrences."""
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    runs = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"),
    )
    words = runs.select(_damaged(F.col("doc_id"), F.col("run")).alias("word"))
    return (
        words.filter(F.char_length("word") >= min_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_count)
    )


def scan(query: str, words: list[str], start: int = 0) -> Iterator[int]:
    """Places, from ``start`` on, in a sorted list of what lies within one edit of the query.

    A row of the band holds the edits between a prefix of d code points of the listed word
    and the first d - 1, d and d + 1 of the query. While the prefix is the query's own, the row
    is 1, 0, 1; it serves all words that share the prefix, so only its depth is kept. One
    code point off, it is 1, 1 and 1 or 2: the edit is spent, of all words with that longer prefix
    only those that go on like the query are near, and the scan goes on behind the others.
    """
    length, at, end, depth, cut = len(query), start, len(words), 0, -1
    inserted = replaced = deleted = skipped = ""
    before = ""
    while at < end:
        word = words[at]
        size = len(word)
        if before[:depth] != word[:depth]:
            depth = 0
        before = word
        while depth < size and depth < length and word[depth] == query[depth]:
            depth += 1
        if depth == size:
            if length - depth <= 1:
                yield at
            at += 1
            continue
        if cut != depth:
            cut, inserted, replaced = depth, query[depth:], query[depth + 1 :]
            skipped, deleted = query[depth + 1 : depth + 2], query[depth + 2 :]
        off = depth + 1
        prefix = word[:off]
        if at + 1 == end or not words[at + 1].startswith(prefix):
            rest = word[off:]
            if rest == inserted or depth < length and rest == replaced or skipped == word[depth] and rest == deleted:
                yield at
            at += 1
            continue
        behind = bisect_left(words, prefix + _LAST, at + 1, end)
        near = {prefix + inserted}
        if depth < length:
            near.add(prefix + replaced)
            if skipped == word[depth]:
                near.add(prefix + deleted)
        places = []
        for text in near:
            place = bisect_left(words, text, at, behind)
            if place < behind and words[place] == text:
                places.append(place)
        yield from sorted(places)
        at = behind


def _halves(words: DataFrame) -> DataFrame:
    """Every word in the groups of its halves, as the shorter and as the longer of a pair.

    Columns: word, n, low (length of the shorter), path, head, tail (lengths of what is
    common in front and behind) and key.
    """
    length = F.char_length("word")
    start = words.select(
        "word",
        "n",
        F.explode(F.array(length, length - 1)).alias("low"),
        F.lit("").alias("path"),
        F.lit(0).alias("head"),
        F.lit(0).alias("tail"),
    )
    return _divided(start)


def _divided(rows: DataFrame) -> DataFrame:
    """The groups one level down."""
    half = F.floor((F.col("low") - F.col("head") - F.col("tail")) / 2).cast("int")
    sides = F.array(
        F.struct(F.lit("p").alias("side"), F.lit(1).alias("front")),
        F.struct(F.lit("s").alias("side"), F.lit(0).alias("front")),
    )
    longer = rows.withColumn("half", half).withColumn("way", F.explode(sides))
    head = F.col("head") + F.col("half") * F.col("way.front")
    tail = F.col("tail") + F.col("half") * (1 - F.col("way.front"))
    out = longer.select(
        "word", "n", "low",
        F.concat("path", "way.side").alias("path"), head.alias("head"), tail.alias("tail"),
    )
    common = F.struct(
        "low", "path",
        F.substring("word", F.lit(1), F.col("head")).alias("front"),
        F.right("word", F.col("tail")).alias("back"),
    )
    return out.withColumn("key", common)


def _groups(words: DataFrame, limit: int) -> DataFrame:
    """Words in groups of at most ``limit``, or of words that differ in three places at most."""
    open_rows, done = _halves(words), None
    while True:
        large = settle(
            open_rows.groupBy("key")
            .agg(F.count("*").alias("size"), F.first(F.col("low") - F.col("head") - F.col("tail")).alias("rest"))
            .filter((F.col("size") > limit) & (F.col("rest") > 3))
            .select(F.col("key").alias("large"))
        )
        if large.isEmpty():
            return open_rows if done is None else done.unionByName(open_rows)
        light = open_rows.join(large, F.col("key") == F.col("large"), "left_anti")
        heavy = open_rows.join(large, F.col("key") == F.col("large"), "left_semi")
        done = light if done is None else done.unionByName(light)
        open_rows = _divided(heavy.drop("key"))


def first_group(a: str, b: str, low: int, path: str) -> bool:
    """Whether no group in front of ``path`` holds both words too."""
    head = tail = 0
    for side in path:
        half = (low - head - tail) // 2
        if side == "p":
            head += half
        elif a[head : head + half] == b[head : head + half]:
            return False
        else:
            tail += half
    return True


def _near_in_group(rows: list[tuple[str, int]], low: int, path: str, head: int, tail: int):
    """Words of a group with the number of near words and the most frequent of them."""
    same, longer = (
        sorted((w[head : len(w) - tail], w, n) for w, n in rows if len(w) == size)
        for size in (low, low + 1)
    )
    rests, longer_rests = [x[0] for x in same], [x[0] for x in longer]
    found: dict[str, list] = {}

    def meet(word: str, other: str, n: int) -> None:
        held = found.get(word)
        if held is None:
            found[word] = [1, n, other]
            return
        held[0] += 1
        if n > held[1] or n == held[1] and other < held[2]:
            held[1], held[2] = n, other

    for at, (rest, word, n) in enumerate(same):
        near = [same[i] for i in scan(rest, rests, at + 1)]
        near += [longer[i] for i in scan(rest, longer_rests)]
        for _, other, m in near:
            if first_group(word, other, low, path):
                meet(word, other, m)
                meet(other, word, n)
    return found


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, rows = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        _, low, path, head, tail = key
        found = _near_in_group(rows, low, path, head, tail)
        if found:
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(list(found), pa.string()),
                    "n_near": pa.array([x[0] for x in found.values()], pa.int64()),
                    "near_n": pa.array([x[1] for x in found.values()], pa.int64()),
                    "near": pa.array([x[2] for x in found.values()], pa.string()),
                }
            )

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for mark, word, n, low, path, head, tail in zip(*columns, strict=True):
            this = (mark, low, path, head, tail)
            if this != key:
                yield from flush()
                key, rows = this, []
            rows.append((word, n))
    yield from flush()


def near_words(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """Per word with near words: n_near, and the most frequent near word with its count."""
    front, back = F.col("key.front"), F.col("key.back")
    grouped = (
        _groups(words, limit)
        .select(F.concat(front, F.lit("\t"), back).alias("mark"), "word", "n", "low", "path", "head", "tail")
        .repartition("mark", "low", "path")
        .sortWithinPartitions("mark", "low", "path")
    )
    parts = grouped.mapInArrow(_near, "word string, n_near long, near_n long, near string")
    least = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return (
        parts.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), least.alias("top"))
        .select("word", "n_near", (-F.col("top.less")).alias("near_n"), F.col("top.near").alias("near"))
    )


def variants(words: DataFrame, ratio: int = 2, limit: int = GROUP) -> DataFrame:
    """Words with their form and root: word, form, root, n, n_near, form_n.

    ``words`` have distinct ``word`` and its count ``n``. A form is at least ``ratio`` times as
    frequent as its word, so the way to the root is short; it is found by doubling.
    """
    words = settle(words.select("word", "n"))
    near = near_words(words, limit)
    formed = settle(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("near_n") >= ratio * F.col("n"), F.col("near")).alias("form"),
            F.when(F.col("near_n") >= ratio * F.col("n"), F.col("near_n")).alias("form_n"),
        )
    )
    ways = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = ways.select(F.col("word").alias("at"), F.col("root").alias("further"))
        ways = settle(
            ways.join(onward, F.col("root") == F.col("at"), "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            )
        )
        if ways.filter("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return formed.join(ways.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants of the words of ``documents``."""
    return variants(word_counts(docs))
