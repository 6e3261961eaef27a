"""Byte-level BPE over Arrow batches with the tokenizers library.

The rank file gives the bytes of every token. Each byte stands for one printable character,
so the library's BPE model merges characters; every split of a token into two tokens is a
merge of that token's rank, and a piece that is itself a token is taken whole. Pieces are
the matches of the split pattern, merged separately. A batch sends only pieces it has not
met before to the library, in one pre-split sequence.

Decoding maps the characters of the tokens back through the byte table. A character whose
bytes are split over tokens comes out whole, as bytes are joined before they are read as
UTF-8; offsets give each token the span of the characters it touches.

Defined cases: null and empty texts have no tokens. Texts are encoded whole; a very long
text is read in parts cut only where a piece certainly ends. Repeated rows are encoded
each, null ids stay null, other columns are not read.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from postgauge.memory import give_back

#: Pieces a task remembers; the memory is emptied when full, which costs only time.
PIECES_KEPT = 400_000
#: Characters read at once from one text.
PART_CHARS = 1 << 20
#: Texts whose new pieces go to the library in one call, if they have ``PART_CHARS`` at most.
TEXTS_AT_ONCE = 128

_CUT = regex.compile(r"(?<=\p{L})(?= \p{L})")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (one base64 token and its rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The library's description of the same encoding."""
    shown = byte_characters()
    spell = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (spell[token[:i]], spell[token[i:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    model = models.BPE(
        vocab={spell[token]: rank for token, rank in ranks.items()},
        merges=merges,
        ignore_merges=True,
        cache_capacity=0,
    )
    return Tokenizer(model).to_str()


class Codec:
    """Encodes and decodes whole texts; one per task."""

    def __init__(self, description: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(description)
        self.pattern = regex.compile(pattern)
        bytes_of = {c: b for b, c in enumerate(byte_characters())}
        self.characters = {b: ord(c) for c, b in bytes_of.items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, rank in vocab.items():
            self.token_bytes[rank] = bytes(bytes_of[c] for c in token)
        #: One object for each id, shared by all pieces that are remembered.
        self.numbers = list(range(len(self.token_bytes)))
        self.known: dict[str, tuple[int, ...]] = {}

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts; a cut lies between a letter and the space before another."""
        start = 0
        while len(text) - start > PART_CHARS:
            cut = _CUT.search(text, start + PART_CHARS)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > PIECES_KEPT:
            self.known = {}
            new = list(pieces)
        spelled = [p.encode().decode("latin-1").translate(self.characters) for p in new]
        found = self.tokenizer.encode(spelled, is_pretokenized=True, add_special_tokens=False)
        ids = list(map(self.numbers.__getitem__, found.ids))
        at = np.searchsorted(np.array(found.word_ids), np.arange(len(new) + 1)).tolist()
        for piece, start, end in zip(new, at, at[1:], strict=False):
            self.known[piece] = tuple(ids[start:end])

    def encode_many(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text."""
        for start, end in self._groups(texts):
            if end - start == 1:
                yield self.encode(texts[start])
                continue
            split = [self.pattern.findall(text or "") for text in texts[start:end]]
            self.learn(set().union(*split))
            yield from map(self._joined, split)

    @staticmethod
    def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
        """Ranges of texts whose pieces are learned in one call.

        Learning may empty the memory, so a group is joined before others are learned: a
        text too long to be learned with others is a group of its own.
        """
        start = held = 0
        for end, text in enumerate(texts):
            size = len(text or "")
            if end > start and (end - start == TEXTS_AT_ONCE or held + size > PART_CHARS):
                yield start, end
                start, held = end, 0
            held += size
        if texts:
            yield start, len(texts)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for part in self.parts(text or ""):
            pieces = self.pattern.findall(part)
            self.learn(set(pieces))
            out += self._joined(pieces)
        return out

    def _joined(self, pieces: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def spans(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """First character and end of the characters each token touches."""
        starts, ends, at = [], [], 0
        for token in ids:
            data = self.token_bytes[token]
            begun = sum(b & 0xC0 != 0x80 for b in data)
            inside = bool(data) and data[0] & 0xC0 == 0x80
            starts.append(at - inside)
            at += begun
            ends.append(at)
        return starts, ends


def _codec(description, pattern: str) -> Codec:
    codec = Codec(description.value, pattern)
    # Reading the description frees several times its size.
    give_back()
    return codec


def _uncollected(run):
    """Pause the collector while a task runs: the remembered pieces are many objects without
    cycles. The worker may serve other operators later, so it is turned on again and the
    memory of the task is given back."""

    def paused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        was = gc.isenabled()
        gc.disable()
        try:
            yield from run(batches)
        finally:
            if was:
                gc.enable()
            gc.collect()
            give_back()

    return paused


def encode(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: id, ids, and the character span each token touches (starts, ends)."""
    description = docs.sparkSession.sparkContext.broadcast(tokenizer_json(read_ranks(path)))

    @_uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(description, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                ids = list(codec.encode_many(part.column(1).to_pylist()))
                spans = [codec.spans(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([s for s, _ in spans], pa.list_(pa.int32())),
                        pa.array([e for _, e in spans], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "ids", "starts", "ends"],
                )

    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return frame.mapInArrow(
        run, "doc_id long, ids array<int>, starts array<int>, ends array<int>"
    )


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of (doc_id, ids): the decoded bytes and text; null ids give null."""
    description = encoded.sparkSession.sparkContext.broadcast(tokenizer_json(read_ranks(path)))

    @_uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(description, pattern)
        for batch in batches:
            raw = [None if x is None else codec.decode(x) for x in batch.column(1).to_pylist()]
            texts = [None if x is None else x.decode("utf-8", "replace") for x in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array(texts, pa.string())],
                names=["doc_id", "decoded", "text"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, decoded binary, text string"
    )


def token_ids(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, and whether the ids decode to the text's bytes."""
    description = docs.sparkSession.sparkContext.broadcast(tokenizer_json(read_ranks(path)))

    @_uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(description, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                texts = part.column(1).to_pylist()
                ids = list(codec.encode_many(texts))
                same = [codec.decode(i) == (t or "").encode() for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(map(len, ids), pa.int64()),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array(same),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decodes"],
                )

    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return frame.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decodes boolean")


def digests(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode, decode again and return per document: doc_id, n_tokens and two SHA-256 values.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the bytes
    decoded from the ids.
    """
    description = docs.sparkSession.sparkContext.broadcast(tokenizer_json(read_ranks(path)))

    @_uncollected
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(description, pattern)
        shown = list(map(str, range(len(codec.token_bytes))))
        for batch in batches:
            counts, id_digests, byte_digests = [], [], []
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                for ids in codec.encode_many(batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()):
                    counts.append(len(ids))
                    line = ",".join(map(shown.__getitem__, ids))
                    id_digests.append(hashlib.sha256(line.encode("ascii")).hexdigest())
                    byte_digests.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(id_digests, pa.string()),
                    pa.array(byte_digests, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return frame.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
