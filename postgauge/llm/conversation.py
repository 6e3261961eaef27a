"""Repair of damaged conversations by a square-root checkpointed dynamic program.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Rows are
kept (0), given the role the place asks for (2), deleted (3, a must for blank rows and
repeats), and empty rows are inserted (2); a truncated row that stays costs 1. The cheapest
edits are found backward: for each place in a conversation, the cost to the end from each of
four states. Of equally cheap edits the letters least in ASCII (D, I, K, R) win, which a walk
forward along tight edits gives.

Only the cost vectors at checkpoints are kept. The outer checkpoints are the edges of range
partitions: a conversation longer than a partition is cut there, each part reports a 4 x 4
min-plus matrix, and composing at most two matrices of each partition on the driver gives the
vector at each edge. The inner ones are every square root of n rows of a part; the vectors
between are recomputed block by block while the walk goes forward. Vectors are held less their
last entry, so few differ, and every step between two is worked out once.

A repeat is found by an aggregate over digests: only rows whose key occurs twice, and those a
bitmap cannot tell from them, are collapsed and compared with the key's first turn; a
row of which there are many copies is one row with a count.

Defined cases: a null role or text counts as one space, a null number as one space in the
damage key. Null ids are one conversation, null turns come first, and rows of one turn stand
by role, then text digest. A conversation without rows gives zeros, an empty audit and
the hash of nothing; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.llm.common import maybe_among
from postgauge.session import settle

#: White space: everything else makes a text not blank.
SPACE = " \t\n\x0b\x0c\r"
_NOT_SPACE = r"[^\x20\x09-\x0D]"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a. Initials: other, s, u, a.
STATES = 4
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_LEGAL = {(1, 2), (2, 3), (3, 2)}
_FAR = 1 << 40
_INITIALS = {"s": 1, "u": 2, "a": 3}
#: A row's code is its initial plus 4 if truncated, or GONE if it has to go.
GONE = 8

#: Copies of the keys of repeated rows, so that one key's rows meet in several tasks.
SALTS = 8
#: Bytes of repaired text in one piece, before they are packed.
PIECE = 1 << 20


def _closed(w: list[int]) -> tuple[int, ...]:
    """Costs once empty rows may be inserted first."""
    a, b = min(w[2], INSERT + w[3]), min(w[3], INSERT + w[2])
    return (min(w[0], INSERT + a), min(w[1], INSERT + a), a, b)


FINAL = _closed([0, _FAR, _FAR, 0])


def _choices(code: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of what can be done with a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if code == GONE:
        return out
    cut = TRUNCATED if code & 4 else 0
    initial = code & 3
    if initial == 1 and state == 0:
        out.append(("K", KEEP + cut, 1))
    elif initial == _NEXT[state]:
        out.append(("K", KEEP + cut, initial))
    out.append(("R", REROLE + cut, _NEXT[state]))
    return out


def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost vector before a row from the one after it."""
    return _closed([min(c + after[s] for _, c, s in _choices(code, q)) for q in range(STATES)])


@dataclass
class Table:
    """Cost vectors met so far, numbered, and the steps between them."""

    vectors: list[tuple[int, ...]] = field(default_factory=list)
    numbers: dict[tuple[int, ...], int] = field(default_factory=dict)
    back: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    acts: dict[tuple[int, int, int], tuple[str, int, int]] = field(default_factory=dict)

    def number(self, vector: tuple[int, ...]) -> tuple[int, int]:
        """Number of a vector less its last entry, and that entry."""
        base = vector[-1]
        key = tuple(x - base for x in vector)
        if key not in self.numbers:
            self.numbers[key] = len(self.vectors)
            self.vectors.append(key)
        return self.numbers[key], base

    def step(self, after: int, code: int) -> tuple[int, int]:
        """Number and added cost of the vector before a row."""
        key = (after, code)
        if key not in self.back:
            self.back[key] = self.number(_before(code, self.vectors[after]))
        return self.back[key]

    def act(self, after: int, code: int, state: int) -> tuple[str, int, int]:
        """Tight letters for a row in a state, the next state, the last state before the row."""
        key = (after, code, state)
        if key not in self.acts:
            vector, letters, at = self.vectors[after], "", state
            costs = _before(code, vector)
            while True:
                tight = [(x, s) for x, c, s in _choices(code, at) if c + vector[s] == costs[at]]
                if INSERT + costs[_NEXT[at]] == costs[at]:
                    tight.append(("I", _NEXT[at]))
                letter, to = min(tight)
                letters += letter
                if letter != "I":
                    break
                at = to
            self.acts[key] = (letters, to, at)
        return self.acts[key]

    def backward(self, codes: bytes, number: int) -> tuple[list[int], int]:
        """Numbers of the vectors after each row, last row first, and of the one before all."""
        out = []
        for code in reversed(codes):
            out.append(number)
            number = self.step(number, code)[0]
        return out, number

    def walk(self, codes: bytes, after: tuple[int, ...], state: int) -> Iterator[tuple[str, int, int]]:
        """Letters, next state and state before the row, for every row in order.

        Vectors are stored at every square root of n rows and recomputed between.
        """
        block = max(1, round(len(codes) ** 0.5))
        number, _ = self.number(after)
        marks = {}
        for start in range((len(codes) - 1) // block * block, -1, -block):
            marks[start] = number
            for code in reversed(codes[start : start + block]):
                number = self.step(number, code)[0]
        for start in range(0, len(codes), block):
            part = codes[start : start + block]
            numbers, _ = self.backward(part, marks.pop(start))
            for code, next_number in zip(part, reversed(numbers), strict=True):
                letters, state, at = self.act(next_number, code, state)
                yield letters, state, at

    def cost(self, codes: bytes, after: tuple[int, ...], state: int) -> int:
        """Cost from a state before all rows."""
        number, total = self.number(after)
        for code in reversed(codes):
            number, added = self.step(number, code)
            total += added
        return total + self.vectors[number][state]


def closing(state: int) -> str:
    """Letters after the last row."""
    return "I" * {0: 0, 1: 2, 2: 1, 3: 0}[state]


def transfer(codes: bytes) -> list[list[int]]:
    """Min-plus matrix of a part: cost from each state before it to each vector entry after."""
    columns = []
    seen: dict[tuple, tuple] = {}
    for to in range(STATES):
        vector = tuple(0 if q == to else _FAR for q in range(STATES))
        total = 0
        for code in reversed(codes):
            key = (vector, code)
            if key not in seen:
                found = _before(code, vector)
                base = min(found)
                seen[key] = tuple(min(x - base, _FAR) for x in found), base
            vector, base = seen[key]
            total += base
        columns.append([min(x + total, _FAR) if x < _FAR else _FAR for x in vector])
    return [[columns[to][q] for to in range(STATES)] for q in range(STATES)]


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` after damage, as conv_id, turn, role, text and ``copies``.

    A dropped row stays with no copies, so that its conversation is not lost.
    """
    key = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    )
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").when(kind == 0, "").otherwise(role).alias("role"),
        F.when(kind <= 1, "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text and copies, equal ones made one, with ``seen``.

    ``seen`` tells that the role and text occur at an earlier turn.
    """
    blank = ~F.col("text").rlike(_NOT_SPACE)
    keyed = rows.withColumns(
        {
            "digest": F.unhex(F.md5("text")),
            "blank": blank,
        }
    ).withColumn("key", F.xxhash64("conv_id", "role", "digest", F.col("copies") == 0))
    repeated = (
        keyed.groupBy("conv_id", "role", "digest", "key")
        .agg(F.min(_turn_order()).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .drop("times")
    )
    repeated = settle(repeated)
    maybe = maybe_among(repeated.select("key"))(F.col("key"))
    salted = repeated.select(
        "first",
        *(F.col(c).alias(f"r_{c}") for c in ("conv_id", "role", "digest", "key")),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("r_salt"),
    )
    doubtful = (
        keyed.filter(maybe)
        .groupBy("conv_id", "turn", "role", "digest", "key", "blank")
        .agg(F.first("text").alias("text"), F.sum("copies").alias("copies"))
        .withColumn("salt", F.pmod(F.xxhash64("turn", F.lit("salt")), F.lit(SALTS)).cast("int"))
    )
    joined = doubtful.join(
        salted,
        (F.col("key") == F.col("r_key"))
        & (F.col("salt") == F.col("r_salt"))
        & F.col("conv_id").eqNullSafe(F.col("r_conv_id"))
        & (F.col("role") == F.col("r_role"))
        & (F.col("digest") == F.col("r_digest")),
        "left",
    )
    columns = ["conv_id", "turn", "role", "digest", "text", "copies", "blank"]
    return keyed.filter(~maybe).select(*columns, F.lit(False).alias("seen")).unionByName(
        joined.select(*columns, F.coalesce(F.col("first") < _turn_order(), F.lit(False)).alias("seen"))
    )


def _turn_order() -> Column:
    return F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows in order over range partitions, stored: the parts that later passes read."""
    order = ["conv_id", "turn", "role", "digest"]
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    return settle(
        _marked(rows)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id", "turn", "role", "text", "copies", "blank", "seen",
            (~last.isin(".", "!", "?")).alias("truncated"),
        )
    )


@dataclass
class Part:
    """Rows of one conversation in one partition, copies told apart."""

    conv_id: object
    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    codes: bytearray = field(default_factory=bytearray)
    copies: list = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    initials: bytearray = field(default_factory=bytearray)

    def add(self, turn, role, text, copies, blank, seen, truncated) -> None:
        if not copies:
            return
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        initial = _INITIALS.get(role[:1], 0)
        self.initials.extend([initial] * copies)
        if blank:
            self.blank += copies
            self.codes.extend([GONE] * copies)
            return
        repeats = copies if seen else copies - 1
        self.duplicate += repeats
        if not seen:
            self.truncated += truncated
            self.codes.append(initial + 4 * truncated)
        self.codes.extend([GONE] * repeats)

    def illegal(self) -> int:
        return sum(p not in _LEGAL for p in zip(self.initials, self.initials[1:], strict=False))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, Part]]:
    """Parts of a partition in order: 0 for its first, else 1, and whether it is the last."""
    part, place = None, 0
    for batch in batches:
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part is None or conv_id != part.conv_id:
                if part is not None:
                    yield place, False, part
                    place = 1
                part = Part(conv_id)
            part.add(*row)
    if part is not None:
        yield place, True, part


def _edge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last part of a partition, which may go on in its neighbours."""
    at = TaskContext.get().partitionId()
    for place, last, part in _parts(batches):
        if place == 0 or last:
            codes = bytes(part.codes)
            yield pa.RecordBatch.from_pydict(
                {
                    "at": pa.array([at], pa.int32()),
                    "place": pa.array([place], pa.int32()),
                    "conv_id": pa.array([str(part.conv_id)], pa.string()),
                    "none": pa.array([part.conv_id is None]),
                    "matrix": pa.array([sum(transfer(codes), [])], pa.list_(pa.int64())),
                    "codes": pa.array([zlib.compress(codes, 1)], pa.binary()),
                }
            )


def _edges(ordered: DataFrame) -> dict[tuple[int, int], tuple[int, tuple[int, ...], bool, bool]]:
    """For edge parts: entry state, cost vector after, whether it starts and ends its conversation.

    The driver sees two matrices of each partition at most.
    """
    found = settle(
        ordered.mapInArrow(
            _edge_parts,
            "at int, place int, conv_id string, none boolean, matrix array<long>, codes binary",
        )
    )
    rows = found.drop("codes").collect()
    rows.sort(key=lambda r: (r["at"], r["place"]))
    names = [(r["conv_id"], r["none"]) for r in rows]
    ends = [i + 1 == len(rows) or names[i + 1] != names[i] for i in range(len(rows))]
    after: dict[tuple[int, int], tuple[int, ...]] = {}
    vector = FINAL
    for row, end in zip(reversed(rows), reversed(ends), strict=True):
        after[row["at"], row["place"]] = vector = FINAL if end else vector
        m = np.array(row["matrix"]).reshape(STATES, STATES)
        vector = tuple(int(x) for x in (m + np.array(vector)).min(axis=1))
    going_on = {(r["at"], r["place"]) for r, end in zip(rows, ends, strict=True) if not end}
    exits = _exit_states(found, {k: v for k, v in after.items() if k in going_on}) if going_on else {}
    out, state, start = {}, 0, True
    for row, end in zip(rows, ends, strict=True):
        key = (row["at"], row["place"])
        out[key] = (state, after[key], start, end)
        state, start = (0, True) if end else (exits[key][state], False)
    return out


def _exit_states(found: DataFrame, after: dict) -> dict[tuple[int, int], list[int]]:
    """State after a part for each state before it."""
    sent = found.sparkSession.sparkContext.broadcast(after)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table()
        for batch in batches:
            out = {"at": [], "place": [], "states": []}
            for row in batch.to_pylist():
                key = (row["at"], row["place"])
                if key not in sent.value:
                    continue
                codes = zlib.decompress(row["codes"])
                states = []
                for state in range(STATES):
                    last = state
                    for _, last, _ in table.walk(codes, sent.value[key], state):
                        pass
                    states.append(last)
                for name, value in zip(out, (*key, states), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(
                {
                    "at": pa.array(out["at"], pa.int32()),
                    "place": pa.array(out["place"], pa.int32()),
                    "states": pa.array(out["states"], pa.list_(pa.int32())),
                }
            )

    rows = found.select("at", "place", "codes").mapInArrow(run, "at int, place int, states array<int>")
    return {(r["at"], r["place"]): r["states"] for r in rows.collect()}


def _repaired(part: Part, table: Table, edge) -> Iterator[tuple[str, str | None, str | None]]:
    """Letter, role and text of every edit of a part; deletions have no role."""
    state, after, _, end = edge
    walk = table.walk(bytes(part.codes), after, state)
    for role, text, copies in zip(part.roles, part.texts, part.copies, strict=True):
        for _ in range(copies):
            came = state
            letters, state, _ = next(walk)
            for letter in letters:
                if letter == "I":
                    yield letter, _ROLE[came], ""
                    came = _NEXT[came]
                elif letter == "D":
                    yield letter, None, None
                else:
                    yield letter, role if letter == "K" else _ROLE[came], text
    if end:
        for _ in closing(state):
            yield "I", _ROLE[state], ""
            state = _NEXT[state]


_WHOLE = (0, FINAL, True, True)


def repair(rows: DataFrame) -> DataFrame:
    """Every edit of every conversation: conv_id, at, place, step, edit, role and text.

    ``rows`` have conv_id, turn, role, text and ``copies`` (see ``damage``). Edits of a
    conversation stand by (at, place, step); deletions have a null role and text.
    """
    ordered = _sorted(rows)
    sent = ordered.sparkSession.sparkContext.broadcast(_edges(ordered))
    kind = ordered.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table = TaskContext.get().partitionId(), Table()
        ids = None
        for place, last, part in _parts(_noted(batches, lambda t: noted.update(ids=t))):
            ids = noted["ids"]
            edge = sent.value[at, place] if place == 0 or last else _WHOLE
            edits = list(_repaired(part, table, edge))
            for start in range(0, len(edits), 4096):
                some = edits[start : start + 4096]
                n = len(some)
                yield pa.RecordBatch.from_pydict(
                    {
                        "conv_id": pa.array([part.conv_id] * n, ids),
                        "at": pa.array([at] * n, pa.int32()),
                        "place": pa.array([place] * n, pa.int32()),
                        "step": pa.array(range(start, start + n), pa.int64()),
                        **{
                            name: pa.array([e[i] for e in some], pa.string())
                            for i, name in enumerate(("edit", "role", "text"))
                        },
                    }
                )

    noted: dict = {}
    schema = f"conv_id {kind.simpleString()}, at int, place int, step long, edit string, role string, text string"
    return ordered.mapInArrow(run, schema)


def _noted(batches: Iterator[pa.RecordBatch], note) -> Iterator[pa.RecordBatch]:
    """The batches, telling the type of the first column."""
    for batch in batches:
        note(batch.schema.field(0).type)
        yield batch


_COUNTS = ("n_turns", "low", "high", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "initial", "final", "cost")


def _facts(part: Part, table: Table, edge) -> dict:
    """What a part adds to the counts of its conversation."""
    state, after, start, _ = edge
    turns = [t for t in part.turns if t is not None]
    codes = bytes(part.codes)
    return {
        "n_turns": len(set(turns)),
        "low": turns[0] if turns else None,
        "high": turns[-1] if turns else None,
        "first_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        "blank": part.blank,
        "duplicate": part.duplicate,
        "truncated": part.truncated,
        "illegal": part.illegal(),
        "initial": part.initials[0] if part.initials else None,
        "final": part.initials[-1] if part.initials else None,
        "cost": table.cost(codes, after, 0) if start else 0,
    }


def _pieces(part: Part, table: Table, edge) -> Iterator[tuple[str, bytes, int]]:
    """Letters, repaired lines and their number, in pieces of bounded size."""
    letters, lines, size = [], [], 0
    for letter, role, text in _repaired(part, table, edge):
        letters.append(letter)
        if role is not None:
            line = f"{role}:{text}".encode()
            lines.append(line)
            size += len(line)
        if size >= PIECE or len(letters) >= PIECE:
            yield "".join(letters), b"\n".join(lines), len(lines)
            letters, lines, size = [], [], 0
    yield "".join(letters), b"\n".join(lines), len(lines)


class _Sum:
    """Running total of the pieces of one conversation."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("n_turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.low = self.high = self.last_turn = self.final = None
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.lines = 0

    def facts(self, facts: dict) -> None:
        for name in self.counts:
            self.counts[name] += facts[name]
        if facts["low"] is not None:
            if self.last_turn is not None and self.last_turn == facts["first_turn"]:
                self.counts["n_turns"] -= 1
            self.low = facts["low"] if self.low is None else self.low
            self.high, self.last_turn = facts["high"], facts["last_turn"]
        if facts["initial"] is not None:
            if self.final is not None and (self.final, facts["initial"]) not in _LEGAL:
                self.counts["illegal"] += 1
            self.final = facts["final"]

    def piece(self, letters: str, data: bytes, lines: int) -> None:
        self.audit.append(letters)
        if lines:
            if self.lines:
                self.hash.update(b"\n")
            self.hash.update(data)
            self.lines += lines

    def row(self) -> dict:
        counts = self.counts
        gaps = 0 if self.low is None else self.high - self.low + 1 - counts["n_turns"]
        return {
            "conv_id": self.conv_id,
            "gaps": gaps,
            **{k: counts[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")},
            "audit": "".join(self.audit),
            "repaired_sha256": self.hash.hexdigest(),
        }


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _result_batch(rows: list[dict], ids: pa.DataType) -> pa.RecordBatch:
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return pa.RecordBatch.from_pydict(
        {
            "conv_id": pa.array([r["conv_id"] for r in rows], ids),
            **{n: pa.array([r[n] for r in rows], pa.int64()) for n in names},
            **{n: pa.array([r[n] for r in rows], pa.string()) for n in ("audit", "repaired_sha256")},
        }
    )


def digests(rows: DataFrame) -> DataFrame:
    """One row for each conversation: faults, cost, audit and the hash of the repaired lines.

    A conversation inside a partition is finished there. One that is cut sends its pieces,
    packed, to one task, which reads them in order: the hash of a text is a chain, so its
    bytes have to pass one after the other, but only a piece at a time is held.
    """
    ordered = _sorted(rows)
    sent = ordered.sparkSession.sparkContext.broadcast(_edges(ordered))
    kind = ordered.schema["conv_id"].dataType.simpleString()
    facts_schema = pa.struct([(n, pa.int64()) for n in _COUNTS])
    noted: dict = {}

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table, done = TaskContext.get().partitionId(), Table(), []
        for place, last, part in _parts(_noted(batches, lambda t: noted.update(ids=t))):
            edge = sent.value[at, place] if place == 0 or last else _WHOLE
            if edge[2] and edge[3]:
                total = _Sum(part.conv_id)
                total.facts(_facts(part, table, edge))
                for piece in _pieces(part, table, edge):
                    total.piece(*piece)
                done.append(total.row())
                if len(done) >= 1024:
                    yield whole(done)
                    done = []
                continue
            for step, (letters, data, lines) in enumerate(_pieces(part, table, edge)):
                yield pa.RecordBatch.from_pydict(
                    {
                        "conv_id": pa.array([part.conv_id], noted["ids"]),
                        "at": pa.array([at], pa.int32()),
                        "place": pa.array([place], pa.int32()),
                        "step": pa.array([step], pa.int64()),
                        "facts": pa.array([_facts(part, table, edge) if step == 0 else None], facts_schema),
                        "letters": pa.array([letters], pa.string()),
                        "data": pa.array([zlib.compress(data, 1)], pa.binary()),
                        "lines": pa.array([lines], pa.int64()),
                        "result": pa.array([None], result_type),
                    }
                )
        if done:
            yield whole(done)

    result_type = pa.struct(
        [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def whole(done: list[dict]) -> pa.RecordBatch:
        n = len(done)
        return pa.RecordBatch.from_pydict(
            {
                "conv_id": pa.array([r["conv_id"] for r in done], noted["ids"]),
                "at": pa.nulls(n, pa.int32()),
                "place": pa.nulls(n, pa.int32()),
                "step": pa.nulls(n, pa.int64()),
                "facts": pa.nulls(n, facts_schema),
                "letters": pa.nulls(n, pa.string()),
                "data": pa.nulls(n, pa.binary()),
                "lines": pa.nulls(n, pa.int64()),
                "result": pa.array([{k: v for k, v in r.items() if k != "conv_id"} for r in done], result_type),
            }
        )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _noted(batches, lambda t: noted.update(ids=t)):
            done = []
            for row in batch.to_pylist():
                if row["result"] is not None:
                    done.append({"conv_id": row["conv_id"], **row["result"]})
                    continue
                if total is None or total.conv_id != row["conv_id"]:
                    if total is not None:
                        done.append(total.row())
                    total = _Sum(row["conv_id"])
                if row["facts"] is not None:
                    total.facts(row["facts"])
                total.piece(row["letters"], zlib.decompress(row["data"]), row["lines"])
            if done:
                yield _result_batch(done, noted["ids"])
        if total is not None:
            yield _result_batch([total.row()], noted["ids"])

    facts = ", ".join(f"{n}: bigint" for n in _COUNTS)
    result = ", ".join(": ".join(x.split()) for x in _RESULT.split(", "))
    pieces = ordered.mapInArrow(
        first,
        f"conv_id {kind}, at int, place int, step long, facts struct<{facts}>, letters string, "
        f"data binary, lines long, result struct<{result}>",
    )
    return (
        pieces.repartition("conv_id")
        .sortWithinPartitions("conv_id", "at", "place", "step")
        .mapInArrow(merged, f"conv_id {kind}, {_RESULT}")
    )
