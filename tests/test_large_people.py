"""A person with very many records costs a row for each distinct value only."""

from pyspark.sql import functions as F

from kinweld.operators import merging as A
from kinweld.operators import scoring as C
from kinweld.operators.mapping import map_records


def placed(spark, n):
    """Profiles of one person, every third without an email."""
    k = F.col("id").cast("string")
    fields = F.when(F.col("id") % 3 > 0, F.expr("map('name', CAST('Ada L' AS variant), 'email', CAST('a@x.io' AS variant))")).otherwise(F.expr("map('name', CAST('Ada L' AS variant))"))
    rows = spark.range(n).select(F.lit("csv").alias("source"), F.concat(F.lit("f:"), k).alias("source_id"), fields.alias("fields"), F.expr("map('name', 'structured_column')").alias("methods"), F.lit(0).alias("file_ord"), F.col("id").alias("row_ord"))
    return map_records(rows, {}).withColumn("person", F.lit(7)).localCheckpoint()


def test_merged_rows_do_not_grow_with_records(spark):
    few, many = (len(str(A.merge(placed(spark, n)).first().asDict(recursive=True))) for n in (30, 600))
    assert many < few + 20


def test_evidence_as_rows_and_as_lists(spark):
    profiles = placed(spark, 60)
    evidence = A.distinct_evidence(A.ordered(profiles.unionByName(profiles.limit(5))))
    assert {r["field"]: r["n"] for r in evidence.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()} == {"full_name": 60, "emails": 40, "candidate_id": 60}
    scored = C.score(A.merge(profiles))
    whole = C.canonical(scored.join(A.provenance(evidence), "person", "left")).first()
    lean = C.canonical(scored).first()
    assert set(lean["fields"]) == set(whole["provenance"]) and len(whole["provenance"]["emails"]) == 40
    assert whole["candidate_id"] == lean["candidate_id"] and whole["confidence"] == lean["confidence"]
    ids = [r["source_id"] for r in whole["provenance"]["full_name"]]
    assert ids == [r["source_id"] for r in profiles.orderBy("tmp_id").collect()]
