"""Multi-line CSV read by many tasks.

A quoted cell may hold line breaks, so where a record starts depends on all quotes before.
Lines are read by byte range; each range reports whether it holds an odd number of quotes, and
whether a record ends in it if it starts outside or inside quotes. The prefix of these bits over
the ranges of a file tells every range how it starts. With that, each range puts its own lines together to records. What a record
has in several ranges, at most one piece at either end of a range, is joined by its first range.

Records end with a line feed or carriage return and line feed. A quote inside a cell that is
not quoted cannot be told from one that opens a cell; such a record is an error here. Line
breaks inside cells stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CELL = r'(?:[^",]*|"(?:[^"]|"")*")'
_RECORD = re.compile(rf"{_CELL}(?:,{_CELL})*", re.DOTALL)
_SCHEMA = "file string, number int, piece int, record string"
#: A byte range: its file and first byte.
Range = tuple[str, int]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Range, pa.Array]]:
    """Neighbouring lines of one range, as Arrow cuts them."""
    for batch in batches:
        files, starts = batch.column(0), batch.column(1).to_numpy()
        codes = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if a < b:
                yield (files[a].as_py(), int(starts[a])), batch.column(2).slice(a, b - a)


def _quote_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: odd number of quotes, and whether a line ends after an even or odd one."""
    found: dict[Range, tuple[bool, bool, bool]] = {}
    for key, lines in _runs(batches):
        odd, even_end, odd_end = found.get(key, (False, False, False))
        counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        after = (int(odd) + np.cumsum(counts)) % 2
        found[key] = (bool(after[-1]), even_end or bool((after == 0).any()), odd_end or bool(after.any()))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([f for f, _ in found], pa.string()),
            pa.array([s for _, s in found], pa.int64()),
            *(pa.array([facts[i] for facts in found.values()], pa.bool_()) for i in range(3)),
        ],
        names=["file", "start", "odd", "even_end", "odd_end"],
    )


def range_states(lines: DataFrame) -> dict[Range, tuple[int, bool, int]]:
    """For every byte range its number in the file, whether it starts inside quotes, and the
    number of the range where the record open at its start began.

    The driver sees three bits for each range.
    """
    schema = "file string, start long, odd boolean, even_end boolean, odd_end boolean"
    rows = lines.mapInArrow(_quote_facts, schema).collect()
    states: dict[Range, tuple[int, bool, int]] = {}
    file, number, inside, began = None, 0, False, 0
    for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if row["file"] != file:
            file, number, inside, began = row["file"], 0, False, 0
        states[row["file"], row["start"]] = (number, inside, began)
        if not inside or row["odd_end"]:
            began = number
        inside ^= row["odd"]
        number += 1
    return states


def _checked(record: str) -> str:
    record = record[:-1] if record.endswith("\r") else record
    if '"' in record and not _RECORD.fullmatch(record):
        raise ValueError("a quote inside an unquoted cell; read this file as a single task")
    return record


def _records(states: dict[Range, tuple[int, bool, int]]):
    """Whole records have a null number; pieces name their record's first range and their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, held, inside, leading, first = None, [], False, False, False

        def finish() -> None:
            if key is not None and held:
                number, _, began = states[key]
                owner = began if leading else number
                out.append((key[0], owner, number, "\n".join(held)))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            types = (pa.string(), pa.int32(), pa.int32(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "number", "piece", "record"])

        for this, lines in _runs(batches):
            if this != key:
                finish()
                key, held = this, []
                number, inside, began = states[key]
                leading, first = inside, number == 0
            turns = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_pylist()
            for line, odd in zip(lines.to_pylist(), turns, strict=True):
                held.append(line)
                inside ^= bool(odd)
                if inside:
                    continue
                text, held = "\n".join(held), []
                if leading:
                    number, _, began = states[key]
                    out.append((key[0], began, number, text))
                    leading = False
                elif first:
                    out.append((key[0], -1, 0, text))
                elif text not in ("", "\r"):
                    out.append((key[0], None, None, _checked(text)))
                first = False
            if len(out) >= 4096:
                yield flush()
                out.clear()
        finish()
        yield flush()

    return run


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Records of all files as ``record``, without headers, and the header of the first file."""
    lines = _lines(spark, path)
    states = range_states(lines)
    found = lines.mapInArrow(_records(states), _SCHEMA)
    joined = (
        found.where("number IS NOT NULL")
        .groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("piece", "record"))).alias("pieces"))
        .select("file", "number", F.array_join(F.col("pieces.record"), "\n").alias("record"))
    )
    check = F.udf(_checked, "string")
    whole = found.where("number IS NULL").select("record")
    # A header that runs over a range's end is the record its first range leaves open.
    headers = joined.where("number = -1").unionByName(
        joined.where("number = 0").join(joined.where("number = -1").select("file"), "file", "left_anti")
    )
    split = joined.where("number >= 0").join(
        headers.where("number = 0").select("file", "number"), ["file", "number"], "left_anti"
    )
    header = headers.orderBy("file").select("record").first()
    text = _checked(header["record"]).removeprefix("\ufeff") if header else ""
    return whole.unionByName(split.select(check("record").alias("record"))), text
