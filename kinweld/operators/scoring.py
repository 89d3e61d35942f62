"""Confidence of fields and of whole profiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.functions.normalize import let
from kinweld.functions.tables import FIELD_WEIGHTS

LISTS = ("emails", "phones", "skills", "experience", "education")
STRUCTS = {"links": ("linkedin", "github", "portfolio"), "location": ("city", "region", "country")}


@F.pandas_udf(T.DoubleType())
def exact_round(values: pd.Series) -> pd.Series:
    """Three decimals, ties judged on the exact binary value."""
    return values.map(lambda x: None if x is None or x != x else round(x, 3)).astype("float64")


def present(field: str) -> Column:
    """Whether a profile's field counts as filled."""
    if field in LISTS:
        return F.coalesce(F.size(field) > 0, F.lit(False))
    if field in STRUCTS:
        return F.coalesce(*[F.nullif(F.col(field)[m], F.lit("")) for m in STRUCTS[field]]).isNotNull()
    if field == "years_experience":
        return F.col(field).isNotNull()
    return F.coalesce(F.col(field), F.lit("")) != ""


def combined(source_trust: Column, method_trust: Column, sources: Column, several: Column) -> Column:
    """Score of a field from its best source, its best method, the number of
    sources, and whether it is a list of several values."""
    base = source_trust * 0.7 + method_trust * 0.3
    more = F.least(F.lit(0.08), F.lit(0.03) * (sources - 1)) + F.when(several, 0.02).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), base + more), 3)


def field_score(field: str) -> Column:
    several = F.size(field) > 1 if field in LISTS else F.lit(False)
    entry = F.get(F.filter("fields", lambda e: e["field"] == field), F.lit(0))
    score = let(entry, lambda e: combined(e["source_trust"], e["method_trust"], e["sources"], several))
    return F.when(present(field), F.coalesce(score, F.lit(0.0))).otherwise(0.0)


def weighted_mean(scores: dict[str, Column], filled: dict[str, Column]) -> Column:
    """Mean of the filled fields' scores by weight, not rounded; 0 if none is."""
    total = sum((F.when(filled[f], scores[f] * w).otherwise(0.0) for f, w in FIELD_WEIGHTS.items()), F.lit(0.0))
    weights = sum((F.when(filled[f], w).otherwise(0.0) for f, w in FIELD_WEIGHTS.items()), F.lit(0.0))
    return F.when(weights > 0, total / weights).otherwise(0.0)


def score(merged: DataFrame) -> DataFrame:
    """``merged`` plus confidence (a struct of all fields) and
    overall_confidence."""
    scored = merged.withColumn("confidence", F.struct(*[field_score(f).alias(f) for f in FIELD_WEIGHTS]))
    mean = weighted_mean({f: F.col("confidence")[f] for f in FIELD_WEIGHTS}, {f: present(f) for f in FIELD_WEIGHTS})
    return scored.withColumn("overall_confidence", exact_round(mean))


RECORD = "struct<source:string,source_id:string,extraction_method:string,original_field:string,value:variant>"

#: What the engine derives of a profile, and how.
DERIVED = {"candidate_id": "stable_hash", "confidence": "calculated", "overall_confidence": "calculated"}


def canonical(scored: DataFrame) -> DataFrame:
    """Profiles in their final form: provenance as a map of lists, with what
    the engine itself derived. Without a column provenance, the names of its
    fields instead: evidence that wasn't asked for isn't gathered."""
    order = ("candidate_id", "full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education")
    if "provenance" not in scored.columns:
        named = F.transform(F.filter("fields", lambda e: e["field"] != "candidate_id"), lambda e: e["field"])
        return scored.select(*order, F.concat(named, F.array(*map(F.lit, DERIVED))).alias("fields"), "confidence", "overall_confidence")
    record = lambda e: F.struct(e["source"].alias("source"), e["source_id"].alias("source_id"), e["method"].alias("extraction_method"), e["original_field"].alias("original_field"), F.parse_json(e["value"]).alias("value"))
    own = lambda method, value: F.array(F.struct(F.col("primary.source").alias("source"), F.col("primary.source_id").alias("source_id"), F.lit(method).alias("extraction_method"), F.lit(None).cast("string").alias("original_field"), value.alias("value")).cast(RECORD))
    as_variant = lambda c: F.variant_get(F.parse_json(F.to_json(F.struct(c.alias("v")))), "$.v", "variant")
    entries = F.transform(F.filter("provenance", lambda e: e["field"] != "candidate_id"), lambda e: F.struct(e["field"].alias("key"), F.transform(e["records"], record).cast(f"array<{RECORD}>").alias("value")))
    derived = F.array(
        *[F.struct(F.lit(f).alias("key"), own(method, as_variant(F.col(f))).alias("value")) for f, method in DERIVED.items()],
    )
    made = scored.withColumn("provenance", F.map_from_entries(F.concat(F.coalesce(entries, F.array().cast(f"array<struct<key:string,value:array<{RECORD}>>>")), derived)))
    return made.select(*order, "provenance", "confidence", "overall_confidence")
