"""Output fields, names and what becomes of missing values."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields as dataclass_fields
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.functions import normalize as N
from kinweld.operators.mapping import normal_dates

CANONICAL = ("candidate_id", "full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education", "provenance", "confidence", "overall_confidence")
DEFAULT = tuple(f for f in CANONICAL if f not in ("provenance", "confidence"))
POLICIES = ("null", "omit", "error")


class ProjectionError(ValueError):
    """A required output field has no value."""


@dataclass(frozen=True)
class ProjectionConfig:
    """Which fields go out, under which names, and the policy for missing
    ones: null, omit or error. Checked when made."""

    fields: tuple[str, ...] = DEFAULT
    rename: dict[str, str] = field(default_factory=dict)
    include_confidence: bool = True
    include_provenance: bool = True
    apply_normalization: bool = True
    missing_value_policy: str = "null"

    def __post_init__(self) -> None:
        object.__setattr__(self, "fields", tuple(self.fields))
        wrong = [
            (set(self.fields) - set(CANONICAL), "unknown fields"),
            (len(self.fields) != len(set(self.fields)), "fields must be unique"),
            (set(self.rename) - set(CANONICAL), "unknown fields in rename"),
            (any(not str(n).strip() for n in self.rename.values()), "new names must not be blank"),
            (len(set(self.rename.values())) != len(self.rename), "new names must be unique"),
            (self.missing_value_policy not in POLICIES, "unknown missing value policy"),
        ]
        for found, what in wrong:
            if found:
                raise ValueError(f"projection: {what}" + (f": {', '.join(sorted(found))}" if isinstance(found, set) else ""))
        listed = [*self.fields, *(f for f, on in self._extra() if on and f not in self.fields)]
        if len({self.rename.get(f, f) for f in listed}) != len(listed):
            raise ValueError("projection: new names collide with other fields")

    def _extra(self) -> tuple[tuple[str, bool], ...]:
        return ("confidence", self.include_confidence), ("provenance", self.include_provenance)

    def output(self) -> list[tuple[str, str]]:
        """(field, output name) in order."""
        off = {f for f, on in self._extra() if not on}
        listed = [*self.fields, *(f for f, on in self._extra() if on and f not in self.fields)]
        return [(f, self.rename.get(f, f)) for f in listed if f not in off]

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> ProjectionConfig:
        known = {f.name for f in dataclass_fields(cls)}
        if extra := set(values) - known:
            raise ValueError(f"projection: unknown settings: {', '.join(sorted(extra))}")
        for name in ("include_confidence", "include_provenance", "apply_normalization"):
            if not isinstance(values.get(name, True), bool):
                raise ValueError(f"projection: {name} must be true or false")
        return cls(**values)

    @classmethod
    def from_file(cls, path: str | None) -> ProjectionConfig:
        if path is None:
            return cls()
        with open(path, encoding="utf-8") as file:
            return cls.from_dict(json.load(file))


def missing(name: str, kind: T.DataType) -> Column:
    """Whether a value is null, '', an empty list or map, or a struct of such."""
    c = F.col(name)
    if isinstance(kind, T.StringType):
        return F.coalesce(c == "", F.lit(True))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.cardinality(c) == 0, F.lit(True))
    if isinstance(kind, T.StructType):
        inside = [missing(f"{name}.{f.name}", f.dataType) for f in kind]
        out = inside[0]
        for more in inside[1:]:
            out &= more
        return c.isNull() | out
    return c.isNull()


def renormalized(profiles: DataFrame, countries: dict[str, str], region: str = "US") -> DataFrame:
    """Normalisers applied once more; without effect on mapped profiles."""
    out = profiles.withColumn("emails", N.unique(F.col("emails"), N.email)).withColumn("phones", N.unique(F.col("phones"), lambda c: N.phone(c, region))).withColumn("skills", N.unique(F.col("skills"), N.skill))
    place = F.struct(F.col("location.city").alias("city"), F.col("location.region").alias("region"), N.country(F.col("location.country"), countries).alias("country"))
    out = out.withColumn("location", F.when(F.col("location").isNotNull(), place))
    for k in ("experience", "education"):
        out = normal_dates(out, k)
    return out


def require(profiles: DataFrame, config: ProjectionConfig) -> None:
    """Raise for the first profile without a required field."""
    checks = F.array_compact(F.array(*[F.when(missing(f, profiles.schema[f].dataType), F.lit(f)) for f, _ in config.output()]))
    bad = profiles.select("candidate_id", F.get(checks, F.lit(0)).alias("field")).where("field IS NOT NULL").orderBy("candidate_id").limit(1).collect()
    if bad:
        raise ProjectionError(f"profile {bad[0]['candidate_id']} has no value for '{bad[0]['field']}'")


def project(profiles: DataFrame, config: ProjectionConfig) -> DataFrame:
    """The selected fields under their names, missing values null. The error
    policy raises instead. A table can't leave out columns row by row, so
    the omit policy shows in :func:`json_rows` only."""
    if config.missing_value_policy == "error":
        require(profiles, config)
    return profiles.select(*[F.when(~missing(f, profiles.schema[f].dataType), F.col(f)).alias(n) for f, n in config.output()])


def _json(name: str) -> Column:
    """A column as JSON, members that are null kept."""
    whole = F.to_json(F.struct(F.col(name).alias("v")), {"ignoreNullFields": "false"})
    return whole.substr(F.lit(6), F.length(whole) - 6)


def json_rows(profiles: DataFrame, config: ProjectionConfig) -> DataFrame:
    """(candidate_id, json): each profile's output object as text, ordered by
    candidate_id."""
    if config.missing_value_policy == "error":
        require(profiles, config)
    members = []
    for f, n in config.output():
        gone = missing(f, profiles.schema[f].dataType)
        label = json.dumps(n, ensure_ascii=False) + ":"
        absent = F.lit(None).cast("string") if config.missing_value_policy == "omit" else F.lit(label + "null")
        members.append(F.when(gone, absent).otherwise(F.concat(F.lit(label), _json(f))))
    text = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))
    return profiles.select("candidate_id", text.alias("json")).orderBy("candidate_id")
