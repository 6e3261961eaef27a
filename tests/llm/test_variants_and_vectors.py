"""Conversation repair, spelling variants and near vectors against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from postgauge.llm import conversation, spelling, vectors

TURNS = "conv_id long, turn long, role string, text string, source string, copies int, key string"


def damaged(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    return {conv: sorted(kept, key=order) for conv, kept in convs.items()}


def repaired(rows):
    """Cheapest edits by trying, per state, the least (cost, letters) of everything before."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append(
            "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    follow = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
    full = {"u": "user", "a": "assistant"}
    best = {0: (0, "", [])}

    def offer(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted():
        for _ in range(4):
            for state, (cost, letters, lines) in list(best.items()):
                initial, to = follow[state]
                offer(best, to, (cost + 2, letters + "I", [*lines, full[initial] + ":"]))

    for (_, role, text), fault in zip(rows, faults, strict=True):
        inserted()
        after = {}
        for state, (cost, letters, lines) in best.items():
            offer(after, state, (cost + 3, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            initial, to = follow[state]
            if state == 0 and role[:1] == "s":
                offer(after, 1, (more, letters + "K", [*lines, f"{role}:{text}"]))
            if role[:1] == initial:
                offer(after, to, (more, letters + "K", [*lines, f"{role}:{text}"]))
            offer(after, to, (more + 2, letters + "R", [*lines, f"{full[initial]}:{text}"]))
        best = after
    inserted()
    cost, letters, lines = min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture
def uneven(spark):
    """Partitions as small as they come, so that conversations are cut."""
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("false", "7"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def odd_turns():
    draw = random.Random(5)
    texts = ["Hi.", "ok", "Yes!", None, " \n", "no. ", "a\n", "Hi.\x0b", "naïve 🙂?", "w" * 50_000 + "."]
    rows = [
        (c, draw.choice([t, t, None, t + draw.randrange(3)]), draw.choice(["user", "assistant", "system", "tool", None, ""]), draw.choice(texts))
        for c in [*range(40), None]
        for t in range(draw.randrange(1, 12))
    ]
    rows += [(77, i, draw.choice(["user", "assistant"]), draw.choice(["Hi.", f"w{i}.", f"w{i}"])) for i in range(900)]
    rows += [(78, 3, "user", "same.")] * 300 + [(79, None, "user", "x")] * 3
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [1, 30, 10**6])
def test_pieces_of_any_size_give_one_digest(monkeypatch, size):
    monkeypatch.setattr(conversation, "PIECE", size)
    for conv, kept in damaged([r for r in odd_turns() if r[0] in (1, 2, 3, 77)]).items():
        part, seen = conversation.Part(conv), set()
        for turn, role, text in kept:
            solid = text.strip(conversation.SPACE)
            part.add(turn, role, text, 1, not solid, (role, text) in seen, solid[-1:] not in (".", "!", "?"))
            seen.add((role, text))
        total, table = conversation._Sum(conv), conversation.Table()
        whole = (0, conversation.FINAL, True, True)
        total.facts(conversation._facts(part, table, whole))
        pieces = list(conversation._pieces(part, table, whole))
        for piece in pieces:
            total.piece(*piece)
        assert size > 1 or len(pieces) > len(kept) // 2
        row = total.row()
        found = [row[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")]
        assert tuple(found) == repaired(kept)


def test_repair_equals_brute_force_where_conversations_are_cut(spark, uneven):
    rows = odd_turns()
    frame = spark.createDataFrame([(*r, "s", 9, "k") for r in rows], TURNS)
    found = {r.conv_id: tuple(r)[1:] for r in conversation.digests(conversation.damage(frame)).collect()}
    assert found == {c: repaired(kept) for c, kept in damaged(rows).items()}


def test_edits_are_the_audit_and_the_lines(spark, uneven):
    rows = odd_turns()
    frame = spark.createDataFrame([(*r, "s", 9, "k") for r in rows], TURNS)
    edits = {}
    for r in conversation.repair(conversation.damage(frame)).orderBy("conv_id", "at", "place", "step").collect():
        edits.setdefault(r.conv_id, []).append(r)
    for conv, kept in damaged(rows).items():
        mine = edits.get(conv, [])
        text = "\n".join(f"{e.role}:{e.text}" for e in mine if e.role is not None)
        assert "".join(e.edit for e in mine) == repaired(kept)[6]
        assert hashlib.sha256(text.encode()).hexdigest() == repaired(kept)[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(e.role[0] for e in mine if e.role is not None))


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversation.digests(conversation.damage(none)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def test_scan_finds_all_within_one_edit():
    draw = random.Random(2)
    for _ in range(60):
        words = sorted({"".join(draw.choice("abÿ") for _ in range(draw.randrange(6))) for _ in range(40)})
        for query in [*words[:5], "", "abab"]:
            assert list(spelling.scan(query, words)) == [i for i, w in enumerate(words) if distance(query, w) <= 1]


def variants_brute(counts):
    near = {w: [o for o in counts if abs(len(o) - len(w)) < 2 and distance(w, o) == 1] for w in counts}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda o: (-counts[o], o), default=None)
        if top is not None and counts[top] >= 2 * counts[w]:
            form[w] = top
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


@pytest.mark.parametrize("limit", [spelling.GROUP, 5])
def test_variants_equal_brute_force(spark, limit):
    draw = random.Random(4)
    stems = ["".join(draw.choice("abcdéÿ") for _ in range(draw.randrange(4, 12))) for _ in range(12)]
    words = set()
    for stem in stems:
        for _ in range(20):
            at = draw.randrange(len(stem))
            words.add(draw.choice([stem[:at] + stem[at + 1 :], stem[:at] + draw.choice("abÿ") + stem[at:], stem[:at] + "c" + stem[at + 1 :]]))
    words |= {"common" * 3 + a + b for a in "abcd" for b in "abcde"}
    counts = {w: draw.choice([3, 3, 4, 8, 20, 60]) for w in words if len(w) >= 5}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {tuple(r) for r in spelling.variants(frame, limit=limit).collect()}
    assert found == variants_brute(counts)


def test_counts_of_damaged_words(spark, odd_docs, no_docs):
    wanted = Counter()
    for r in odd_docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            at = h % len(run)
            wanted[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    found = {r.word: r.n for r in spelling.word_counts(odd_docs).collect()}
    assert found == {w: n for w, n in wanted.items() if len(w) >= 5 and n >= 3}
    assert spelling.group_variants(no_docs).count() == 0


def near_brute(rows, limit):
    size = len(rows)
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = [
        [
            j
            for j in range(size)
            if i != j and good[i] and good[j] and len(rows[i][1]) == len(rows[j][1])
            and np.dot(rows[i][1], rows[j][1]) / np.linalg.norm(rows[i][1]) / np.linalg.norm(rows[j][1]) >= limit
        ]
        for i in range(size)
    ]
    out, root = [], [None] * size
    for i in range(size):
        reached, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - reached
            reached |= new
            todo += new
        root[i] = min((rows[x][0] for x in reached if rows[x][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), root[i], rows[i][0] == root[i]))
    return Counter(out)


def odd_vectors():
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(12):
        centre = draw.standard_normal(16)
        for _ in range(draw.integers(1, 25)):
            rows.append((len(rows), (centre + draw.standard_normal(16) * draw.choice([0.03, 0.2, 0.3])).astype(np.float32).tolist()))
    rows += [(len(rows) + i, rows[5][1]) for i in range(40)]
    n = len(rows)
    rows += [(n, [0.0] * 16), (n + 1, None), (n + 2, []), (n + 3, [1.0, float("nan")]), (n + 4, [1.0, None]), (n + 5, [float("inf"), 1.0])]
    rows += [(n + 6, [1.0] * 8), (n + 7, [2.0] * 8), (n + 8, [-0.0, 1.0]), (n + 9, [0.0, 1.0]), (None, rows[5][1]), (3, rows[30][1]), (None, [5.0, 1.0])]
    return rows


@pytest.mark.parametrize("block", [vectors.BLOCK, 4])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = odd_vectors()
    frame = spark.createDataFrame([(*r, 1, 2, "b") for r in rows], "vec_id long, embedding array<float>, node int, ball int, hash string")
    found = vectors.near_vectors(frame.repartition(3))
    assert Counter(tuple(r) for r in found.collect()) == near_brute(rows, 0.9)
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_tables_meet_the_stated_miss():
    for classes in (10, 10**4, 10**6, 10**9):
        plan = vectors.layout(classes, 0.9)
        agree = (1 - plan.angle / np.pi) ** plan.bits
        assert (1 - agree) ** plan.tables <= vectors.MISS
