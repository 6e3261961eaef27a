"""Operators SQL can express, against SQL on the small tables and plain Python on odd rows."""

import os
import re

import pytest
import verify

from postgauge.llm import leaks, quality, warc
from postgauge.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_query_equals_its_sql(spark, name):
    good, detail = verify.compare(spark, verify.duck(SF), SF, name, QUERIES[name], ORACLES[name])
    assert good, detail


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {p + o for found in at.values() if len(found) > 1 for p in found for o in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_measures_of_odd_rows(odd_docs, no_docs):
    found = sorted(
        ((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judge(odd_docs).collect())
    )
    wanted = sorted((r.doc_id or 0, *measures(r.text)) for r in odd_docs.collect())
    assert found == wanted
    assert quality.judge(no_docs).count() == 0


def test_rule_order_changes_no_verdict(odd_docs, no_docs):
    clean = quality.keep_clean(odd_docs)
    assert clean.columns == odd_docs.columns
    kept = sorted(r.doc_id for r in clean.collect())
    judged = quality.judge(odd_docs, quality.RULES[::-1])
    assert kept == sorted(r.doc_id for r in judged.filter("kept").collect()) == [5, 6]
    assert quality.keep_clean(no_docs).count() == 0


def leak_brute(rows, items, window):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    windows = {}
    for item, text in items:
        words = split(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (key := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out.append((doc_id or 0, len(words), len(hit), len(found), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [leaks.BLOCK_BYTES, 60])
def test_leaks_equal_brute_force(spark, odd_docs, no_docs, monkeypatch, block):
    monkeypatch.setattr(leaks, "BLOCK_BYTES", block)
    items = [
        (1, "Two, three FOUR five! six seven eight nine ten eleven"),
        (2, "one two"),
        (2, "one two"),
        (3, None),
        (None, "x y z x y z x y z x y z x y"),
        (5, "b a b c d a"),
        (6, "?!"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = leaks.leak_digests(odd_docs, bench).collect()
    rows = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found)
    assert rows == leak_brute([(r.doc_id, r.text) for r in odd_docs.collect()], items, 10)
    clean = leaks.without_leaks(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 0, 2, 3, 4, 5, 6, 7, 11]
    assert leaks.leak_digests(no_docs, bench).count() == 0
    assert leaks.leak_digests(odd_docs, bench.limit(0)).filter("contaminated").count() == 0


def test_warc_round_trip_of_odd_pages(spark, tmp_path):
    big = "<p>" + "ü" * 200
    rows = [(3, "http://a/b\r\nX: y", big), (1, None, big), (1, None, big), (None, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    folder = f"file://{tmp_path}/archives"
    index = warc.write_archives(pages, folder)
    found = warc.read_records(index, folder).collect()
    assert sorted((r.page_id or 0, r.record_type, r.payload_bytes, r.refers_to) for r in found) == sorted(
        (i or 0, "revisit" if h == big and i != 1 else "response", len((h or "").encode()), 1 if h == big and i != 1 else None)
        for i, _, h in rows
    )
    assert {r.url for r in found if r.page_id == 3} == {"http://a/b\r\nX: y"}
    some = warc.read_records(index.filter("page_id = 6"), folder).collect()
    assert [bytes(r.payload) for r in some] == [b"short"]
    assert warc.round_trip(pages.limit(0)).count() == 0
