"""Order, sharding, tokens and near-duplicates against brute force."""

import hashlib
import os
import random
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from postgauge.llm import bpe, leaks, neardup, order, shards

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 1000])
def test_permutation_is_a_bijection_with_inverse(total):
    keyed = order.Permutation(total, key=9)
    slots = keyed.slot(np.arange(total))
    assert sorted(slots.tolist()) == list(range(total))
    assert keyed.number(slots).tolist() == list(range(total))
    if total == 1000:
        assert order.Permutation(total, key=10).slot(np.arange(total)).tolist() != slots.tolist()


def test_materialised_order_holds_every_text(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs.coalesce(1)
    folder = f"file://{tmp_path}/order"
    found = order.materialise(docs, folder, key=4, length=64, rows=100).orderBy("slot").collect()
    total = len(found)
    assert [r.slot for r in found] == list(range(total))
    assert all(r.shard == r.slot // 100 and r.offset == r.slot % 100 * 64 for r in found)
    records = [x for s in range(-(-total // 100)) for x in order.read_shard(folder, s, 64)]
    keyed = order.Permutation(total, 4)
    stream = b"".join(records[s] for s in keyed.slot(np.arange(total)))
    texts = [(r.text or "").encode() for r in docs.collect()]
    assert stream.rstrip(bytes([order.PAD])) == b"".join(t + bytes([order.END]) for t in texts)
    assert next(order.read_shard(folder, 1, 64, start=7)) == records[107]
    assert order.materialise(no_docs, folder).count() == 0


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_are_even_and_slots_gapless(spark, odd_docs, no_docs, law):
    draw = random.Random(2)
    rows = [(7 if i % 3 == 0 else None if i % 7 == 0 else i, "w" * draw.randint(0, 90)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = shards.assign_shards(docs, 8, law).collect()
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append(r)
    assert len(found) == 3000 and sorted(by) == list(range(8))
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    if law == "bytes":
        sizes = [sum(r.size for r in part) for part in by.values()]
        assert max(sizes) - min(sizes) <= 2 * 91
    else:
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    odd = shards.assign_shards(odd_docs, 8, law, carry=["source"]).collect()
    assert len(odd) == odd_docs.count() and min(r.size for r in odd) == 1
    assert shards.assign_shards(no_docs, 8, law).count() == 0


def test_tokens_equal_the_other_library(odd_docs, no_docs):
    ranks = bpe.read_ranks(RANKS)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.digests(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    wanted = []
    for r in odd_docs.collect():
        ids = other.encode_ordinary(r.text or "")
        shown = ",".join(map(str, ids)).encode()
        wanted.append((r.doc_id or 0, len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(wanted)
    assert bpe.token_ids(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(odd_docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in odd_docs.collect())


def test_codec_on_random_text_and_parts(monkeypatch):
    codec = bpe.Codec(bpe.tokenizer_json(ranks := bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(4)
    parts = ["a", "the", "ing", "É", "ñ", "日本", "🙂", " ", "  ", "\n", "1", "23", "'s", "!!", "==", "‍", "к", "ا"]
    monkeypatch.setattr(bpe, "PART_CHARS", 40)
    for _ in range(400):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 200)))
        ids = codec.encode(text)
        assert ids == other.encode_ordinary(text) and codec.decode(ids) == text.encode()
        starts, ends = codec.spans(ids)
        assert all(text[a:b].encode().find(codec.token_bytes[i]) >= 0 for i, a, b in zip(ids, starts, ends, strict=True))


def held_by(work):
    """Bytes that ``work`` takes at most, and that its result holds."""
    tracemalloc.start()
    try:
        result = work()
        return tracemalloc.get_traced_memory()[::-1], result
    finally:
        tracemalloc.stop()


def test_remembered_pieces_are_small():
    codec = bpe.Codec(bpe.tokenizer_json(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    pieces = {f" qz{i}x{i * 7919 % 10007}" for i in range(20_000)}
    (_, held), _ = held_by(lambda: codec.learn(pieces))
    assert len(codec.known) == 20_000 and held < 200 * 20_000
    numbers = {id(n) for ids in codec.known.values() for n in ids}
    assert len(numbers) == len({n for ids in codec.known.values() for n in ids})


def test_long_text_among_short_ones_when_the_memory_is_full(monkeypatch):
    """The long text's pieces empty the memory; the short ones after it are still joined."""
    codec = bpe.Codec(bpe.tokenizer_json(ranks := bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "PIECES_KEPT", 300)
    monkeypatch.setattr(bpe, "PART_CHARS", 8_000)
    draw = random.Random(6)
    sizes = [20, 20, 0, 500, 20, 5_000, 20, 20, 0]
    texts = [None, *(" ".join(f"w{draw.randrange(10**6)}" for _ in range(n)) for n in sizes), None]
    found = list(codec.encode_many(texts))
    assert found == [other.encode_ordinary(text or "") for text in texts]
    assert list(codec.encode_many([])) == []


def test_sets_of_many_texts_take_little_memory():
    draw = random.Random(8)
    texts = pa.array([" ".join(f"w{draw.randrange(9999)}" for _ in range(300)) for _ in range(1500)])
    assert texts.nbytes > 2 * neardup.SLICE_BYTES
    (most, _), sizes = held_by(lambda: [len(v) for v in neardup.shingle_sets(texts, 2)])
    assert len(sizes) == 1500 and most < 64 * neardup.SLICE_BYTES


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_components(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


@pytest.mark.parametrize(("width", "seed"), [(2, 1), (5, 2)])
def test_components_equal_brute_force(spark, odd_docs, width, seed):
    """Random texts, chains of edits, small sets, and a group of near copies larger than a list."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def edited(words, share):
        return [draw.choice(vocabulary) if draw.random() < share else w for w in words]

    texts = []
    base = draw.choices(vocabulary, k=150)
    texts += [edited(base, draw.choice([0.01, 0.02, 0.03])) for _ in range(96)]
    for _ in range(30):
        words = draw.choices(vocabulary, k=draw.choice([2, 4, 5, 6, 7, 12, 60, 200]))
        for _ in range(draw.randint(1, 5)):
            texts.append(words)
            words = edited(words, 0.03)
            if draw.random() < 0.4:
                words = words[: max(1, len(words) - 1)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(r.doc_id if r.doc_id is None else 10_000 + r.doc_id, r.text) for r in odd_docs.collect()]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    found = neardup.near_duplicates(docs, width).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=key) == sorted(
        brute_components(rows, width), key=key
    )
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_one_per_group_keeps_columns(spark, odd_docs, no_docs):
    kept = neardup.one_per_group(odd_docs, width=2)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 8, 9, 10, 11]
    assert neardup.near_duplicates(no_docs).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline
    from test_native_and_sql import leak_brute, measures

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["quality_rules"](spark, docs, sf)
    wanted = []
    for i, t in rows:
        n, chars, symbols, dup, rep = measures(t)
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        bad = n < 50 or 100 * rep > 50 * n or 10 * symbols > n or 100 * dup > 30 * len(lines)
        if not (bad or chars < 2 * n or chars > 12 * n):
            wanted.append((i, t))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in wanted)
    single = stages["near_duplicates"](spark, clean, sf)
    wanted = [(i, t) for (i, t), (_, _, least) in zip(wanted, brute_components(wanted, 5), strict=True) if i == least]
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _ in wanted)
    safe = stages["decontaminated"](spark, single, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {r[0] for r in leak_brute(wanted, items, 10) if r[-1]}
    wanted = [(i, t) for i, t in wanted if i not in hit]
    assert sorted((r.doc_id, r.text) for r in safe.collect()) == sorted(wanted)
    hidden = stages["without_secrets"](spark, safe, sf)
    assert hidden.schema == docs.schema
    shown = {i: re.sub(r'(?i)(token = ")[0-9a-f]{40}', r"\1[SECRET]", t) for i, t in wanted}
    assert {r.doc_id: r.text for r in hidden.collect()} == shown
    last = stages["token_ids"](spark, hidden, sf).collect()
    assert sorted(r.doc_id for r in last) == sorted(shown) and all(r.decodes and len(r.ids) == r.n_tokens for r in last)


def test_family_of_scattered_edits_in_long_lists(spark):
    """Near copies that share their runs only in lists longer than ``LIST``, with long runs cut by edits."""
    rows = scattered_families(random.Random(12))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs, 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted(
        (i, least) for i, _, least in brute_components(rows, 2)
    )


def scattered_families(draw, families=6, size=150):
    """Texts of 41 words, each a base without two of the copies' edits in common, base left out."""
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(families):
        base = draw.sample(vocabulary, 41)
        for _ in range(size):
            words = list(base)
            for at in draw.sample(range(41), draw.choice([1, 2, 2, 2])):
                words[at] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    return rows


def test_pipeline_filters_decide_by_row(spark, odd_docs, no_docs):
    """Null and repeated ids: one row of each group, and leaks go with their own row only."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    text = " ".join(f"w{i}" for i in range(60))
    leak = "one two three four five six seven eight nine ten"
    rows = [(None, text, "a"), (None, text, "b"), (3, text, "c"), (3, text, "c"), (None, leak, "d"), (None, leak, "d"), (4, leak + " x y z", "e"), (4, "clean words only", "f"), (None, "", "g"), (None, None, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    single = stages["near_duplicates"](spark, docs, "unused")
    assert single.columns == docs.columns
    key = lambda r: (-1 if r[0] is None else r[0], r[1] or "", r[2])
    wanted = [rows[2], rows[4], rows[6], rows[7], rows[8], rows[9]]
    found = [tuple(r) for r in single.collect()]
    assert sorted(found, key=key) == sorted(wanted, key=key)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    clean = leaks.clean_rows(docs, bench)
    assert clean.schema == docs.schema
    assert sorted(map(tuple, clean.collect()), key=key) == sorted(rows[:4] + rows[7:], key=key)
    kept = neardup.one_row_per_group(odd_docs, width=2)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    assert neardup.one_row_per_group(no_docs).count() == leaks.clean_rows(no_docs, bench).count() == 0


def test_stored_steps_leave_no_shuffle_files(spark):
    def files():
        held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if "shuffle" in held.apply(i).getName()}

    before = files()
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    stored = neardup.settle_alone(links.groupBy((F.col("a") % 7).alias("k")).agg(F.sum("b").alias("n")))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert stored.count() == 7
    assert {r["root"] for r in neardup.components(links).collect()} == {0}
