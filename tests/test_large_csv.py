"""A CSV file read in many splits gives what reading it at once gives."""

import random

import pytest

from kinweld.sources import large_csv
from kinweld.sources.records import parse_csv, read_csv


@pytest.fixture
def small_splits(spark):
    """Splits of 700 bytes, each a task."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "700b")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def texts():
    rng = random.Random(12)
    cells = ["a", "", " b ", '"q"', '"x, y"', '"two\nlines"', '"he said ""no"""', 'in"ner', '""', '"long\r\ncell\nof\nlines' + "\n" * 800 + 'end"', "ünï", '5" pipe', '"closed"more', '""""', "'"]
    out = ["", "﻿a,a, b \n1,2,3\n\n,\n", '"a","b"\n"1', 'h\r"x\ry"\r2\n3']
    for end in ("\n", "\r\n"):
        for rows in (120,):
            out.append("n,m,n, o\n" + "".join(",".join(rng.choice(cells) for _ in range(rng.randint(0, 4))) + end for _ in range(rows)))
    return out


@pytest.mark.parametrize("k", range(len(texts())))
def test_splits_change_nothing(small_splits, tmp_path, k):
    text = texts()[k]
    (tmp_path / "x.csv").write_bytes(text.encode())
    records, bad = read_csv(small_splits, [f"{tmp_path}/x.csv"], large=0)
    rows, error = parse_csv(text)
    assert [r["error"] for r in bad.collect()] == ([error] if error else [])
    got = records.selectExpr("source_id", "row_ord", "transform_values(fields, (k, v) -> CAST(v AS string)) AS cells").orderBy("row_ord").collect()
    assert [(r["source_id"], r["cells"]) for r in got] == [(f"x.csv:{n + 2}", cells) for n, cells in enumerate(rows)]


def test_many_tasks_read_one_file(small_splits, tmp_path):
    (tmp_path / "x.csv").write_text("name,note\n" + "".join(f'p{k},"some\nnote {k}"\n' for k in range(900)))
    assert large_csv.lines_of(small_splits, f"{tmp_path}/x.csv").rdd.getNumPartitions() > 20
    records, _ = read_csv(small_splits, [f"{tmp_path}/x.csv"], large=0)
    assert records.count() == 900


def test_large_files_with_faults(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("a\n" + "1\n" * 500 + "1,2\n" + "1,2,3\n")
    (tmp_path / "b.csv").write_bytes(b"a\n" + b"1\n" * 500 + b"\xff\n")
    (tmp_path / "c.csv").write_text("a\n7\n")
    records, bad = read_csv(small_splits, [f"{tmp_path}/{x}.csv" for x in "abc"], large=100)
    assert {r["path"][-5:]: r["error"] for r in bad.collect()} == {"a.csv": "row 502 has 2 cells, the header 1", "b.csv": "not UTF-8"}
    assert [(r["source_id"], r["file_ord"]) for r in records.collect()] == [("c.csv:2", 2)]
