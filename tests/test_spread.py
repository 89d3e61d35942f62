"""Work on rows is dealt over tasks, however few files hold the rows."""

from pyspark.sql import functions as F

from kinweld.operators.mapping import map_records
from kinweld.sources.large_csv import HELD
from kinweld.sources.records import csv_records, explode_json, from_resume_texts


def tasks(df):
    """How many tasks have rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def one_file(spark, tmp_path, text):
    """100 texts, in a file of one row group."""
    path = f"{tmp_path}/texts"
    k = F.col("id").cast("string")
    spark.range(100).coalesce(1).select(F.concat(F.lit("/in/f"), k).alias("path"), F.concat(F.lit("f"), k).alias("source_id"), F.col("id").cast("int").alias("file_ord"), F.col("id").alias("row_ord"), F.replace(F.lit(text), F.lit("%s"), k).alias("text")).write.parquet(path)
    files = spark.read.parquet(path)
    assert tasks(files) == 1
    return files


def test_csv_texts(spark, tmp_path):
    records, _ = csv_records(one_file(spark, tmp_path, "name\nAda %s\n"))
    assert tasks(records) > 2 and records.count() == 100


def test_csv_rows_of_several_files_in_a_batch(spark):
    long = "n\n" + "".join(f"{k}\n" for k in range(HELD + 7))
    files = spark.createDataFrame([(0, "/a.csv", "n\nx\n"), (1, "/b.csv", long), (2, "/c.csv", "n\n1,2\n"), (3, "/d.csv", None), (4, "/e.csv", "n\n")], "file_ord int, path string, text string").coalesce(1)
    records, bad = csv_records(files)
    got = records.selectExpr("file_ord", "row_ord", "CAST(fields['n'] AS string) AS n", "source_id").orderBy("file_ord", "row_ord").collect()
    assert [tuple(r) for r in got] == [(0, 0, "x", "a.csv:2"), *[(1, k, str(k), f"b.csv:{k + 2}") for k in range(HELD + 7)]]
    assert {tuple(r) for r in bad.collect()} == {("/c.csv", "row 2 has 2 cells, the header 1"), ("/d.csv", "not UTF-8")}


def test_json_texts(spark, tmp_path):
    records, bad = explode_json(one_file(spark, tmp_path, '[{"name":"Ada %s"}]'))
    assert tasks(records) > 2 and records.count() == 100 and bad.count() == 0


def test_json_texts_are_parsed_once(spark, tmp_path):
    records, _ = explode_json(one_file(spark, tmp_path, '{"results":[{"name":"Ada %s"}]}'))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert sum("parse" in line and "text" in line for line in plan.splitlines()) == 1


def test_resumes(spark, tmp_path):
    records = from_resume_texts(one_file(spark, tmp_path, "Ada Love%s\nSkills\npy\n"))
    assert tasks(records) > 2 and records.count() == 100


def test_mapping(spark, tmp_path):
    files = one_file(spark, tmp_path, "x")
    records = files.select(F.lit("csv").alias("source"), "source_id", F.expr("map('name', CAST(path AS variant))").alias("fields"), F.expr("map('name', 'regex')").alias("methods"), "file_ord", "row_ord")
    mapped = map_records(records, {})
    assert tasks(mapped) > 2 and mapped.count() == 100
