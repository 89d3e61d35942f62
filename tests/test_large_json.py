"""A JSON file read in many splits gives what reading it at once gives."""

import json
import random

import pytest

from kinweld.sources import large_json
from kinweld.sources.records import read_ats


@pytest.fixture
def small_splits(spark):
    """Splits of 2,500 bytes, each a task."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500b")
    spark.conf.set("spark.sql.files.openCostInBytes", "2500b")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def items(n, seed=5):
    rng = random.Random(seed)
    words = ["a", "}", "{", "]", "[", '"', "\\", '\\"', "ünï", "},{", "\n", ", ", "}" * 40, "long " * 300, '"}', "\\}"]
    value = lambda d: rng.choice([lambda: rng.choice(words), lambda: rng.randint(0, 9), lambda: None, lambda: {} if d else {"k": value(1)}, lambda: [] if d else [value(1), value(1)], lambda: "".join(rng.choices(words, k=4))])()
    return [{"id": rng.choice([None, f"i{k}"]), "x": value(0), rng.choice(words): value(0)} for k in range(n)]


def texts():
    some = items(90)
    other = {"meta": {"a": {"deep": [1, {"b": "}"}]}, "n": [1, 2, [3]]}, "more": items(9, 2), "results": items(4, 3)}
    return {
        "list": json.dumps(some),
        "indented": json.dumps(some, indent=2, ensure_ascii=False) + "\n",
        "wrapper": json.dumps({**other, "candidates": some, "tail": items(5, 4)}),
        "results": json.dumps({"n": 7, "results": some}, indent=1),
        "one": json.dumps({**other, "candidates": some[0]}),
        "record": json.dumps({"id": "r", "work": some}),
        "null": json.dumps({**other, "candidates": None}),
        "empty": " [ ] ",
        "nothing": " \n",
        "scalar": '"' + "x}" * 900 + '"',
        "mixed": json.dumps([*some, 3]),
        "lists": json.dumps([*some, [{"a": 1}], *some]),
        "open": json.dumps(some)[:-1],
        "cut": json.dumps(some)[:-2],
        "cut string": json.dumps(some)[:1900],
        "more": json.dumps(some) + "]",
        "two": json.dumps(some) + json.dumps(some),
        "no comma": json.dumps(some[:40])[:-1] + json.dumps(some)[1:],
        "two commas": json.dumps(some[:40])[:-1] + ",," + json.dumps(some)[1:],
        "keyless": '{"meta": {"a": {}, {"b": 1}}, "candidates": ' + json.dumps(some) + "}",
        "crossed": json.dumps(some)[:-1] + ', {"a": [1}, {"b": 2]}]',
        "null root": "null",
        "word behind": json.dumps(some[:3]) + " x",
        "closed twice": json.dumps({"candidates": some}) + "}",
        "member behind": json.dumps({"candidates": some}) + ', "a": 1',
        "mark": "﻿" + json.dumps(some),
        "twice": '{"candidates": [{"a": 1}], "candidates": ' + json.dumps(some) + "}",
    }


def rows(spark, path, large):
    records, bad = read_ats(spark, [path], large=large)
    got = records.selectExpr("source_id", "file_ord", "row_ord", "transform_values(fields, (k, v) -> to_json(v)) AS fields", "methods").orderBy("row_ord").collect()
    return [tuple(r) for r in got], [r["error"] for r in bad.collect()]


@pytest.mark.parametrize("name", texts())
def test_splits_change_nothing(small_splits, tmp_path, name):
    (tmp_path / "x.json").write_bytes(texts()[name].encode())
    whole = rows(small_splits, f"{tmp_path}/x.json", 1 << 40)
    assert rows(small_splits, f"{tmp_path}/x.json", 0) == whole
    assert whole[1] or len(whole[0]) == {"list": 90, "indented": 90, "wrapper": 90, "results": 90, "one": 1, "record": 1, "empty": 0}[name]


def test_bytes_that_are_not_text(small_splits, tmp_path):
    (tmp_path / "x.json").write_bytes(json.dumps(items(60)).encode()[:-1] + b', {"a": "\xff"}]')
    assert rows(small_splits, f"{tmp_path}/x.json", 0) == ([], ["not JSON"])


def test_one_line_is_read_by_many_tasks(small_splits, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"candidates": [{"id": k, "note": "}" * 20} for k in range(1, 901)]}))
    assert large_json.pieces_of(small_splits, f"{tmp_path}/x.json").rdd.getNumPartitions() > 10
    got, bad = rows(small_splits, f"{tmp_path}/x.json", 0)
    assert bad == [] and [(r[0], r[2]) for r in got] == [(str(k + 1), k) for k in range(900)]


def test_large_and_small_files_keep_their_numbers(small_splits, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": k} for k in range(200)]))
    (tmp_path / "b.json").write_text("[{}, 1]" + " " * 2000)
    (tmp_path / "c.json").write_text('{"id": "one"}')
    records, bad = read_ats(small_splits, [f"{tmp_path}/{x}.json" for x in "abc"], large=1000)
    assert [(r["path"][-6:], r["error"]) for r in bad.collect()] == [("b.json", "items must be objects")]
    assert sorted((r["file_ord"], r["n"]) for r in records.groupBy("file_ord").agg({"*": "count"}).toDF("file_ord", "n").collect()) == [(0, 200), (2, 1)]
