"""Bounded samples of labelled documents, the only thing that models learn from.

A sample is chosen by the hash of the id, so reruns agree, and holds at most
the given number of documents of each class. Only ids and labels are ranked;
texts are fetched by joining the documents with that short list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 30


def _hash(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(STEPS))


def labelled(labels: DataFrame, label: str, most: int, classes: tuple[int, ...] = (0, 1)) -> tuple[DataFrame, dict[int, int]]:
    """doc_id and label of at most ``most`` rows of each class, from labels
    whose id and label aren't null, and the number of rows of each class. Of
    contradicting rows the largest counts."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(*classes)).select("doc_id", F.col(label).alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    parts = []
    for k in classes:
        share = min(1.0, 1.5 * most / max(1, counts.get(k, 0)))
        some = rows.where((F.col("label") == k) & (_hash("doc_id") < math.ceil(share * STEPS)))
        parts.append(some.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(_hash("doc_id"), "doc_id").limit(most))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("doc_id").agg(F.max("label").alias("label")), counts


def texts_of(docs: DataFrame, sample: DataFrame, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The sampled documents, in one partition: the list is short enough to
    broadcast, and what one task then learns from is bounded by it. Of rows
    that repeat an id one counts, chosen by a hash of the row."""
    narrow = docs.select(*columns).join(F.broadcast(sample), "doc_id")
    rows = F.struct(*[c for c in narrow.columns if c != "doc_id"])
    single = narrow.groupBy("doc_id").agg(F.min_by(rows, F.xxhash64(*[c for c in narrow.columns if c != "doc_id"])).alias("row"))
    return single.select("doc_id", "row.*").select(narrow.columns).repartition(1)
