"""Training-order materialisation: packed token sequences in a keyed random order.

Texts become byte tokens, each text closed by ``END``, and the tokens of a partition are
packed into sequences of ``length``; only a partition's last sequence is filled up with
``PAD``. A first pass counts the sequences of each partition, so every sequence has a number
in the whole corpus. A keyed Feistel permutation over the next power of four, walked until
the result is a valid number, turns the number into the sequence's slot. It needs no table,
and the inverse finds the sequence of a slot.

Shard s holds the slots from ``s * rows``; each is one partition of the shuffle, sorted by
slot and written as a file of fixed-stride records, so slot k is at byte
``(k % rows) * length`` and a reader may start anywhere. A task writes under a name of its
own and renames the finished file, so a repeated task replaces it by the same content. Every
file is read again in order for the checksums.

The input must give the same rows per partition whenever it is scanned, as files do; counts
are checked, and a difference raises an error. Store any other input first.

Defined cases: null and empty texts are a lone ``END``. Null ids are carried as null; repeated
rows are packed each. An empty table gives no file and an empty result. Only the id and the
text are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgauge.llm.common import mix64
from postgauge.llm.warc import shared_folder
from postgauge.session import settle

#: Tokens of a sequence, and sequences of a shard.
LENGTH, ROWS = 2048, 8192
#: Tokens after a text and after the last text; neither byte occurs in UTF-8.
END, PAD = 255, 254
ROUNDS = 6
#: Sequences passed on at once.
SEQUENCES_AT_ONCE = 512

_PACKED = "shard int, slot long, n_tokens long, tokens binary, doc_ids array<long>"
_WRITTEN = "slot long, shard int, offset long, n_tokens long, crc32 long, doc_ids array<long>"


class Permutation:
    """A keyed permutation of 0 to ``total`` - 1."""

    def __init__(self, total: int, key: int):
        self.total = total
        self.half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key * ROUNDS % (1 << 63))
        self.keys = mix64(seeds)

    def _pass(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in keys:
            left, right = right, left ^ (mix64(right ^ key) & self.mask)
        return (left << self.half) | right

    def _swap(self, x: np.ndarray) -> np.ndarray:
        return ((x & self.mask) << self.half) | (x >> self.half)

    def _walk(self, numbers: np.ndarray, step) -> np.ndarray:
        x = step(numbers.astype(np.uint64))
        while (out := x >= self.total).any():
            x[out] = step(x[out])
        return x.astype(np.int64)

    def slot(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, lambda x: self._pass(x, self.keys))

    def number(self, slots: np.ndarray) -> np.ndarray:
        """The inverse of ``slot``."""
        return self._walk(slots, lambda x: self._swap(self._pass(self._swap(x), self.keys[::-1])))


def _packed(
    batches: Iterator[pa.RecordBatch], length: int
) -> Iterator[tuple[int, bytes, list[int | None]]]:
    """(tokens before padding, record, ids of the texts in it), in order."""
    buffer, ids = bytearray(), []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = (text.as_py() or "").encode() + bytes([END])
            at = 0
            while at < len(data):
                taken = min(length - len(buffer), len(data) - at)
                buffer += data[at : at + taken]
                ids.append(doc_id)
                at += taken
                if len(buffer) == length:
                    yield length, bytes(buffer), ids
                    buffer, ids = bytearray(), []
    if buffer:
        yield len(buffer), bytes(buffer).ljust(length, bytes([PAD])), ids


def _chunks(items: Iterator, size: int) -> Iterator[list]:
    chunk = []
    for item in items:
        chunk.append(item)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def materialise(
    docs: DataFrame,
    folder: str,
    key: int = 1,
    length: int = LENGTH,
    rows: int = ROWS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write the shards below ``folder``; per sequence: slot, shard, offset, n_tokens, crc32
    of the record as read back, and doc_ids of the texts it has tokens of."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    counted = (
        texts.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.ceil(F.sum(size) / F.lit(length)).cast("long").alias("n"))
        .orderBy("part")
        .collect()
    )
    firsts, total = {}, 0
    for row in counted:
        firsts[row["part"]] = (total, row["n"])
        total += row["n"]
    if not total:
        return texts.sparkSession.createDataFrame([], _WRITTEN)
    order = Permutation(total, key)
    sent = texts.sparkSession.sparkContext.broadcast(firsts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first, expected = sent.value.get(part, (0, 0))
        done = 0
        for chunk in _chunks(_packed(batches, length), SEQUENCES_AT_ONCE):
            slots = order.slot(first + done + np.arange(len(chunk)))
            done += len(chunk)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((slots // rows).astype(np.int32)),
                    pa.array(slots),
                    pa.array([c[0] for c in chunk], pa.int64()),
                    pa.array([c[1] for c in chunk], pa.binary()),
                    pa.array([c[2] for c in chunk], pa.list_(pa.int64())),
                ],
                names=["shard", "slot", "n_tokens", "tokens", "doc_ids"],
            )
        if done != expected:
            raise RuntimeError(f"partition {part} has {done} sequences, {expected} were counted")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        out, held, shard, name = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(path, recursive=True)
                shard = batch.column(0)[0].as_py()
                name = f"{path}/attempt-{uuid.uuid4().hex}"
                out = system.open_output_stream(name)
            for record in batch.column(3):
                out.write(record.as_py())
            held.append(batch.select([1, 2, 4]))
        if out is None:
            return
        out.close()
        slots = np.concatenate([h.column(0).to_numpy() for h in held])
        first = shard * rows
        if not np.array_equal(slots, np.arange(first, min(first + rows, total))):
            raise RuntimeError(f"shard {shard} does not hold its slots")
        system.move(name, shard_path(path, shard))
        sums = (zlib.crc32(r) for r in read_shard(folder, shard, length))
        for batch in held:
            n = batch.num_rows
            at = (batch.column(0).to_numpy() - first) * length
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(n, shard, np.int32)),
                    pa.array(at),
                    batch.column(1),
                    pa.array([next(sums) for _ in range(n)], pa.int64()),
                    batch.column(2),
                ],
                names=["slot", "shard", "offset", "n_tokens", "crc32", "doc_ids"],
            )

    shards = -(-total // rows)
    return settle(
        texts.mapInArrow(pack, _PACKED)
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("slot")
        .mapInArrow(write, _WRITTEN)
    )


def shard_path(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:08d}.bin"


def read_shard(folder: str, shard: int, length: int = LENGTH, start: int = 0) -> Iterator[bytes]:
    """Records of a shard in order, from record ``start`` on."""
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_file(shard_path(path, shard)) as data:
        data.seek(start * length)
        while chunk := data.read(length * 256):
            for at in range(0, len(chunk), length):
                yield chunk[at : at + length]


def training_order(docs: DataFrame, key: int = 1, **options) -> DataFrame:
    """``materialise`` into a new folder of the shared checkpoint folder."""
    return materialise(docs, shared_folder(docs.sparkSession, "order"), key, **options)
