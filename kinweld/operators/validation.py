"""Rules that profiles and outputs must keep, as a JSON Schema.

The schema of profiles is made here; one of the user's own, from a file, may
take its place. The rules of an output follow from it and the projection.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweld.operators import schema as S
from kinweld.operators.projection import ProjectionConfig, missing
from kinweld.sources.storage import discard, materialized

MOST_SHOWN = 10

#: Forms of values and names of sources.
CANDIDATE = "^cand_[0-9a-f]{32}$"
PHONE = r"^\+[1-9][0-9]{7,14}$"
COUNTRY = "^[A-Z]{2}$"
MONTH = "^[0-9]{4}-(0[1-9]|1[0-2])$"
SOURCES = ("resume", "linkedin", "ats", "csv", "github")


class ValidationError(ValueError):
    """Some profile breaks a rule; the message has the first few."""


def _text(pattern: str | None = None, null: bool = True) -> dict:
    return {"type": ["string", "null"] if null else "string", **({"pattern": pattern} if pattern else {})}


def _closed(**members: Any) -> dict:
    """An object with just these members."""
    return {"type": "object", "properties": members, "required": list(members), "additionalProperties": False}


def _list(item: dict, **more: Any) -> dict:
    return {"type": "array", "items": item, **more}


def profile_schema() -> dict:
    """The schema of a list of profiles."""
    share = {"type": "number", "minimum": 0, "maximum": 1}
    months = {"start_date": _text(MONTH), "end_date": _text(MONTH)}
    evidence = _closed(source={"enum": list(SOURCES)}, source_id=_text(null=False), extraction_method=_text(null=False), original_field=_text(), value={})
    profile = _closed(
        candidate_id=_text(CANDIDATE, null=False), full_name=_text(),
        emails=_list(_text(null=False), uniqueItems=True), phones=_list(_text(PHONE, null=False), uniqueItems=True),
        location={"anyOf": [_closed(city=_text(), region=_text(), country=_text(COUNTRY)), {"type": "null"}]},
        links=_closed(linkedin=_text(), github=_text(), portfolio=_text()),
        headline=_text(), years_experience={"type": ["number", "null"], "minimum": 0}, skills=_list(_text(null=False), uniqueItems=True),
        experience=_list(_closed(company=_text(null=False), title=_text(), **months, description=_text())),
        education=_list(_closed(institution=_text(null=False), degree=_text(), field_of_study=_text(), **months)),
        provenance={"type": "object", "additionalProperties": _list(evidence)}, confidence={"type": "object", "additionalProperties": share}, overall_confidence=share,
    )
    return {"type": "array", "items": profile}


def projected_schema(config: ProjectionConfig, schema: dict | None = None) -> dict:
    """The schema of an output: the fields' rules under their new names. A
    missing value may be null, or left out, as the policy says."""
    whole = schema or profile_schema()
    item = whole.get("items", {})
    while "$ref" in item:
        item = S.resolve(whole, item["$ref"])
    known = item.get("properties", {})
    if absent := [f for f, _ in config.output() if f not in known]:
        raise S.SchemaError(f"schema: no rules for {', '.join(absent)}")
    null = config.missing_value_policy == "null"
    members = {n: {"anyOf": [known[f], {"type": "null"}]} if null else known[f] for f, n in config.output()}
    rest = {k: v for k, v in whole.items() if k not in ("items", "type")}
    required = [] if config.missing_value_policy == "omit" else list(members)
    return {**rest, "type": "array", "items": {"type": "object", "properties": members, "required": required, "additionalProperties": False}}


def _by_rule(rows: DataFrame) -> DataFrame:
    """(candidate_id, path, message), each rule once a row."""
    once = F.array_distinct(F.transform("errors", lambda e: F.struct(e["rule"].alias("path"), e["message"].alias("message"))))
    return rows.select("candidate_id", F.explode(once).alias("x")).select("candidate_id", "x.path", "x.message")


def violations(profiles: DataFrame, schema: dict | None = None) -> DataFrame:
    """(candidate_id, path, message) of the broken rules of the fields that
    ``profiles`` has; paths are the names in the schema, without numbers."""
    return _by_rule(profiles.select("candidate_id", S.errors(schema or profile_schema(), profiles.schema, partial=True).alias("errors")))


#: The name that ids have beside a projected row.
OWN = "_own_candidate_id"


def _projected(profiles: DataFrame, config: ProjectionConfig) -> DataFrame:
    return profiles.select(F.col("candidate_id").alias(OWN), *[F.when(~missing(f, profiles.schema[f].dataType), F.col(f)).alias(n) for f, n in config.output()])


def _projected_errors(profiles: DataFrame, config: ProjectionConfig, schema: dict | None, partial: bool) -> DataFrame:
    rows = _projected(profiles, config)
    kind = rows.drop(OWN).schema
    # What the policy leaves out is null in a table, and no value of the output.
    policy = projected_schema(config if config.missing_value_policy == "error" else ProjectionConfig(**{**vars(config), "missing_value_policy": "null"}), schema)
    return rows.select(F.col(OWN).alias("candidate_id"), S.errors(policy, kind, partial).alias("errors"))


def projected_violations(profiles: DataFrame, config: ProjectionConfig, schema: dict | None = None) -> DataFrame:
    """Broken rules of the selected fields, which a missing value may break only
    where the policy puts no null and leaves nothing out."""
    return _by_rule(_projected_errors(profiles, config, schema, partial=True))


def report(rows: DataFrame) -> DataFrame:
    """(row_no, path, message) of (candidate_id, errors), where rows are
    numbered from 0 by candidate_id and paths start with that number.

    Rows are sorted into ranges and counted by range, so no task sees them all.
    """
    spark = rows.sparkSession
    ordered = rows.orderBy("candidate_id").select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("k"), "errors")
    sorted_rows = materialized(ordered)
    at, offsets = 0, []
    for r in sorted_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        offsets.append((r["part"], at))
        at += r["n"]
    known = F.broadcast(spark.createDataFrame(offsets, "part int, before bigint"))
    found = sorted_rows.join(known, "part").select((F.col("before") + F.col("k")).alias("row_no"), F.explode("errors").alias("e"))
    listed = materialized(found.select("row_no", F.col("e.path").alias("way"), F.concat_ws("/", F.col("row_no").cast("string"), F.nullif(S.shown(F.col("e.path")), F.lit(""))).alias("path"), F.col("e.message").alias("message")))
    discard(sorted_rows)
    return listed.orderBy("row_no", "way", "message").select("row_no", "path", "message")


def canonical_report(profiles: DataFrame, schema: dict | None = None, partial: bool = False) -> DataFrame:
    """The report of whole profiles; ``partial`` as in :func:`schema.errors`."""
    return report(profiles.select("candidate_id", S.errors(schema or profile_schema(), profiles.schema, partial).alias("errors")))


def check(found: DataFrame) -> None:
    """Raise with the first violations, if there are any: (candidate_id, path,
    message) by path, or a report in its order."""
    numbered = "row_no" in found.columns
    first = (found if numbered else found.orderBy("path", "candidate_id")).limit(MOST_SHOWN).collect()
    if first:
        raise ValidationError("invalid output: " + "; ".join(("" if numbered else f"{r['candidate_id']}/") + f"{r['path']}: {r['message']}" for r in first))


def _check(rows: DataFrame) -> None:
    """Rows are numbered only if one of them is wrong."""
    if not rows.where(F.size("errors") > 0).isEmpty():
        check(report(rows))


def validate_canonical(profiles: DataFrame, schema: dict | None = None) -> None:
    _check(profiles.select("candidate_id", S.errors(schema or profile_schema(), profiles.schema).alias("errors")))


def validate_projected(profiles: DataFrame, config: ProjectionConfig, schema: dict | None = None) -> None:
    _check(_projected_errors(profiles, config, schema, partial=False))
