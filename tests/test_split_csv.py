"""The splittable CSV reader against the single-task one and Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from postgauge.sources.posts import prepare_posts, read_csv_columns, read_raw_posts
from postgauge.sources.split_csv import csv_records

COLUMNS = ["user_id", "text_id", "title", "text"]


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for name, value in before.items():
        spark.conf.set(name, value)


def made(seed, end):
    draw = random.Random(seed)
    pieces = ["word", '"', '""', "\n", "\r\n", ",", "é🙂", " ", "\n\n", '",\n"', "x" * 40]
    rows = [
        ["".join(draw.choice(pieces) for _ in range(draw.randrange(6))) for _ in COLUMNS] for _ in range(60)
    ]
    rows = [[f"u{i}", str(i), a, b] for i, (_, _, a, b) in enumerate(rows)]
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([COLUMNS, *rows])
    return rows, out.getvalue()


@pytest.mark.parametrize(("seed", "end", "size"), [(1, "\n", 37), (2, "\r\n", 64), (3, "\n", 500), (4, "\r\n", 10**6)])
def test_split_reader_finds_every_record(spark, tmp_path, small_ranges, seed, end, size):
    rows, text = made(seed, end)
    path = tmp_path / "p.csv"
    path.write_bytes(text.encode())
    small_ranges(size)
    found = read_csv_columns(spark, str(path))
    mine = {r.text_id: (r.user_id, r.title, r.text) for r in found.collect()}
    whole = {r.text_id: (r.user_id, r.title, r.text) for r in read_csv_columns(spark, str(path), split=False).collect()}
    plain = lambda x: (x or "").strip()
    assert {k: tuple(map(plain, v)) for k, v in mine.items()} == {r[1]: tuple(map(plain, (r[0], r[2], r[3]))) for r in rows}
    # In a file with CRLF the single-task reader turns the ones inside cells to LF too.
    same = lambda x: x and x.replace("\r\n", "\n")
    assert {k: tuple(map(same, v)) for k, v in mine.items()} == {k: tuple(map(same, v)) for k, v in whole.items()}
    if size < 100:
        assert found.rdd.getNumPartitions() > 20


def test_several_files_headers_and_marks(spark, tmp_path, small_ranges):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_bytes('﻿user_id,text_id,title,text\nu,1,"a\nb",c\n\nu,2,d,e'.encode())
    (folder / "b.csv").write_bytes(b'user_id,text_id,title,text\nu,3,"x ""y"" z",w\n')
    for size in (5, 16, 10**6):
        small_ranges(size)
        records, header = csv_records(spark, str(folder))
        assert header == ",".join(COLUMNS)
        assert sorted(r.record for r in records.collect()) == ['u,1,"a\nb",c', "u,2,d,e", 'u,3,"x ""y"" z",w']


def test_a_header_cell_with_a_line_break(spark, tmp_path, small_ranges):
    path = tmp_path / "h.csv"
    path.write_bytes(b'user_id,text_id,title,text,"a\nlong\nname"\nu,1,t,x,"v\nw"\nu,2,t,"y\n\nz",\n')
    for size in (8, 10**6):
        small_ranges(size)
        rows = read_csv_columns(spark, str(path)).orderBy("text_id").collect()
        assert [(r.text, r["a\nlong\nname"]) for r in rows] == [("x", "v\nw"), ("y\n\nz", None)]


def test_stray_quotes_are_an_error_only_when_split(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('user_id,text_id,title,text\nu,1,5" disk and 3" disk,x\n')
    with pytest.raises(Exception, match="single task"):
        read_csv_columns(spark, str(path)).collect()
    assert read_csv_columns(spark, str(path), split=False).first().title == '5" disk and 3" disk'


def test_raw_posts_with_id_feed_a_test_fold(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("user_id,text_id,title,text,is_suicide\nu,1,NA,x,yes\n")
    raw = read_raw_posts(spark, str(path), with_id=True)
    assert raw.columns == ["user_id", "text_id", "title", "text", "is_suicide"]
    assert raw.where(F.col("title").isNull()).count() == 1 and prepare_posts(raw).first().y == 1
