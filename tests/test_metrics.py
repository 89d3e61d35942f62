"""Numbers that writes take on their way."""

import json
import logging

import pytest
from pyspark.sql import functions as F

from kinweld.plans.engine import Engine, PipelineError
from kinweld.sources.storage import materialized


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_measures_of_a_write(spark, rows):
    df = spark.range(rows).repartition(3).withColumn("odd", F.col("id") % 2 == 1)
    back = materialized(df, n=F.count(F.lit(1)), odd=F.count_if("odd"), top=F.max("id"))
    assert back.kinweld_measures == {"n": rows, "odd": rows // 2, "top": rows - 1 if rows else None}
    assert back.count() == rows and materialized(df).kinweld_measures == {}


def test_measures_of_no_relation_and_of_behind_a_shuffle(spark):
    assert materialized(spark.createDataFrame([], "a int"), n=F.count(F.lit(1))).kinweld_measures == {"n": 0}
    assert materialized(spark.range(10).where("false"), n=F.count(F.lit(1))).kinweld_measures == {"n": 0}
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    assert materialized(grouped, n=F.count(F.lit(1)), c=F.sum("c")).kinweld_measures == {"n": 7, "c": 1000}


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "c.csv").write_text("name,email\n" + "".join(f"Person {chr(65 + k)},p{k}@x.io\n" for k in range(5)))
    (tmp_path / "a.json").write_text(json.dumps([{"name": "Person A", "email": "p0@x.io"}, {"name": "Bad", "linkedin": "http://[x"}]))
    (tmp_path / "broken.json").write_text("{")
    return tmp_path


def test_engine_counts_each_step(spark, inputs, caplog):
    engine = Engine(spark)
    with caplog.at_level(logging.INFO, logger="kinweld"):
        rows = engine.run(csv=[f"{inputs}/c.csv"], ats=[f"{inputs}/a.json", f"{inputs}/broken.json", f"{inputs}/gone.json"])
    assert engine.metrics == {"bad_files": 2, "records": 7, "records_csv": 5, "records_resume": 0, "records_ats": 2, "mapped": 6, "rejected": 1, "profiles": 5}
    assert rows.count() == 5 and engine.rejected.count() == 1
    told = caplog.text
    assert "5 csv records" in told and "2 ats records" in told and "7 records make 5 profiles" in told


def test_counts_take_no_scan_of_their_own(spark, inputs, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*_):
        raise AssertionError("a scan that only counts")

    engine = Engine(spark)
    with monkeypatch.context() as patch:
        patch.setattr(DataFrame, "count", refuse)
        patch.setattr(DataFrame, "isEmpty", refuse)
        patch.setattr(DataFrame, "groupBy", refuse)
        loaded = engine.load(csv=[f"{inputs}/c.csv"], ats=[f"{inputs}/broken.json"])
        with pytest.raises(AssertionError):
            loaded.counts()
        engine.profiles_of(loaded.records)
    assert engine.metrics["records_csv"] == engine.metrics["mapped"] == 5
    assert {(r["source"], r["file_ord"]): r["n"] for r in loaded.counts().collect()} == {("csv", 0): 5}


def test_nothing_to_count(spark, inputs):
    (inputs / "empty.csv").write_text("name,email\n")
    engine = Engine(spark)
    with pytest.raises(PipelineError, match="hold no record"):
        engine.run(csv=[f"{inputs}/empty.csv"])
    assert engine.metrics["records"] == 0
    (inputs / "bad.json").write_text('[{"name": "Bad", "linkedin": "http://[x"}]')
    with pytest.raises(PipelineError, match="could be mapped"):
        engine.run(ats=[f"{inputs}/bad.json"])
    assert engine.metrics["rejected"] == 1 and engine.metrics["mapped"] == 0
