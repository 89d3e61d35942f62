"""From matched profiles to one profile per person.

Profiles of a person are ordered by (source rank, temporary id, input order).
Scalars take the first value in that order (the longest for names);
collections are united, the first spelling first.

Profiles are dealt over tasks, whoever they belong to. There each is exploded
into rows tagged by what they contribute (scalars, a value of a list, an item,
a kind of evidence, an identifier), rows of one person, tag and key become one
before and after an exchange by all of these, and only what is left is gathered
by person: one row for each distinct value, however many records a person has.
Evidence itself isn't, as a person has some of every record: it stays in rows
(:func:`distinct_evidence`), and :func:`provenance` makes lists of it where the
output asks for them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweld.functions.normalize import casefold, let
from kinweld.functions.tables import ID_NAMESPACE, METHOD_RELIABILITY, SOURCE_RANK, SOURCE_RELIABILITY, UNKNOWN_METHOD, UNKNOWN_RANK, UNKNOWN_SOURCE
from kinweld.operators.matching import link_values
from kinweld.sources.storage import spread


def constants(values: dict[str, float | int], key: Column, other: float | int) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(other))


def priority(source: Column, tmp_id: Column, at: Column) -> Column:
    """The order of a person's profiles."""
    return F.struct(constants(SOURCE_RANK, source, UNKNOWN_RANK).alias("rank"), tmp_id.alias("tmp_id"), at.alias("at"))


#: Keys and contents of a tagged row; what isn't needed is null.
KEYS = [f"k{i}" for i in range(1, 6)]
CELLS = [f"c{i}" for i in range(1, 6)]


def tagged(tag: str, keys: list[Column] = (), cells: list[Column] = (), minor: Column | None = None, pos: Column | None = None, longest: bool = False) -> Column:
    """What a profile contributes: of rows of one person, tag and keys, each
    cell is the first one (or the longest one) that isn't null."""
    none = F.lit(None).cast("string")
    named = [c.alias(n) for names, given in ((KEYS, keys), (CELLS, cells)) for n, c in zip(names, [*given, *[none] * 5][:5], strict=True)]
    zero = F.lit(0)
    return F.struct(F.lit(tag).alias("tag"), (zero if minor is None else minor).alias("minor"), (zero if pos is None else pos).alias("pos"), F.lit(longest).alias("longest"), *named)


@dataclass(frozen=True)
class Part:
    """A column of merged people: the rows that a profile gives to it, as an
    array, and how a person's rows are gathered. None: the rows of a part
    before have its cell."""

    name: str
    rows: Column | None
    gathered: Column


def collapse(profiles: DataFrame, parts: list[Part]) -> DataFrame:
    """person and the parts, from profiles with person and o (their order).
    Profiles are dealt over tasks, so that each sorts a share of the rows."""
    empty = F.array().cast(profiles.select(parts[0].rows.alias("r")).schema["r"].dataType)
    rows = F.concat(*[F.coalesce(p.rows, empty) for p in parts if p.rows is not None])
    each = spread(profiles).select("person", "o", F.explode(rows).alias("t")).select("person", F.struct("o", "t.minor", "t.pos").alias("place"), "t.tag", "t.longest", *[f"t.{c}" for c in (*KEYS, *CELLS)])
    best = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(F.when(F.col("longest"), -F.length(c)).otherwise(0).alias("n"), F.col("place").alias("p"))))
    one = each.groupBy("person", "tag", *KEYS).agg(F.min("place").alias("place"), *[best(c).alias(c) for c in CELLS])
    return one.groupBy("person").agg(*[p.gathered.alias(p.name) for p in parts])


def _of(tag: str, value: Column) -> Column:
    """A person's values under a tag."""
    return F.collect_list(F.when(F.col("tag") == tag, value))


def _in_order(tag: str, value: Column) -> Column:
    return F.transform(F.array_sort(_of(tag, F.struct(F.col("place").alias("p"), value.alias("x")))), lambda s: s["x"])


def _only(tag: str, cell: str = "c1") -> Column:
    """The cell of the one row that a person has under a tag."""
    return F.max(F.when(F.col("tag") == tag, F.col(cell)))


def scalar_part(name: str, value: Column, longest: bool = False) -> Part:
    return Part(name, F.array(tagged(name, cells=[value], longest=longest)), _only(name))


def scalar_parts(values: dict[str, Column]) -> list[Part]:
    """Scalars of which each is the first one, in one row of a profile for
    every five."""
    out = []
    for k in range(0, len(values), len(CELLS)):
        some = dict([*values.items()][k : k + len(CELLS)])
        tag = next(iter(some))
        out += [Part(name, F.array(tagged(tag, cells=[*some.values()])) if name == tag else None, _only(tag, c)) for name, c in zip(some, CELLS, strict=False)]
    return out


def list_part(values: str, name: str | None = None) -> Part:
    rows = F.transform(F.filter(F.col(values), lambda v: v.isNotNull()), lambda v, i: tagged(values, [casefold(v)], [v], pos=i))
    return Part(name or values, rows, _in_order(values, F.col("c1")))


def item_part(items: str, key: Callable[[Column], list[Column]], fields: list[str]) -> Part:
    """Items with one key are one, placed where the first stood, each field
    the longest of its texts (the earliest of those)."""
    rows = F.transform(F.col(items), lambda x, i: tagged(items, key(x), [F.nullif(x[f], F.lit("")) for f in fields], pos=i, longest=True))
    whole = F.struct(*[F.col(c).alias(f) for c, f in zip(CELLS, fields, strict=True)])
    return Part(items, rows, _in_order(items, whole))


def united(rows: DataFrame, values: str, name: str) -> DataFrame:
    """(person, name): the values of all profiles in order, the first of each
    spelling. ``rows`` has person, o (the order) and the array ``values``."""
    return collapse(rows, [list_part(values, name)]).where(F.size(name) > 0)


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def experience_key(x: Column) -> list[Column]:
    return [casefold(x["company"]), casefold(_blank(x["title"])), _blank(x["start_date"])]


def education_key(x: Column) -> list[Column]:
    return [casefold(x["institution"]), casefold(_blank(x["degree"]))]


EXPERIENCE_FIELDS = ["company", "title", "start_date", "end_date", "description"]
EDUCATION_FIELDS = ["institution", "degree", "field_of_study", "start_date", "end_date"]


def experience_part() -> Part:
    return item_part("experience", experience_key, EXPERIENCE_FIELDS)


def education_part() -> Part:
    return item_part("education", education_key, EDUCATION_FIELDS)


def coalesced(rows: DataFrame, part: Part) -> DataFrame:
    """(person, items) of an item part alone."""
    return collapse(rows, [part]).where(F.size(part.name) > 0)


SAME = ["source", "source_id", "method", "original_field", "value"]


def fields_part() -> Part:
    """What scoring needs of each field with evidence, in order of the first
    evidence: of the same field, source and method one row is enough."""
    rows = F.transform("evidence", lambda e, i: tagged("evidence", [e["field"], e["source"], e["method"]], minor=e["field_ord"], pos=i))
    whole = F.struct(F.col("place").alias("place"), F.col("k1").alias("field"), F.col("k2").alias("source"), F.col("k3").alias("method"))

    def entry(field: Column, es: Column) -> Column:
        trust = lambda values, key, other: F.array_max(F.transform(es, lambda s: constants(values, s[key], other)))
        return F.struct(
            field.alias("field"),
            trust(SOURCE_RELIABILITY, "source", UNKNOWN_SOURCE).alias("source_trust"),
            trust(METHOD_RELIABILITY, "method", UNKNOWN_METHOD).alias("method_trust"),
            F.size(F.array_distinct(F.transform(es, lambda s: s["source"]))).alias("sources"),
        )

    def by_field(all_: Column) -> Column:
        names = F.array_distinct(F.transform(all_, lambda s: s["field"]))
        return F.transform(names, lambda f: let(F.filter(all_, lambda s: s["field"] == f), lambda es: entry(f, es)))

    return Part("fields", rows, let(F.array_sort(_of("evidence", whole)), by_field))


def fields(rows: DataFrame) -> DataFrame:
    """(person, fields) of profiles with person, o and evidence."""
    return collapse(rows, [fields_part()])


def distinct_evidence(rows: DataFrame) -> DataFrame:
    """Evidence as rows: person, place, field, e; repeats of one record left
    out wherever they stand. No task gathers a person's."""
    each = spread(rows).select("person", "o", F.posexplode("evidence").alias("pos", "e"))
    placed = each.select("person", *[F.col("e")[c].alias(c) for c in SAME], F.struct(F.struct("o", F.col("e.field_ord").alias("minor"), "pos").alias("place"), F.col("e.field").alias("field")).alias("first"))
    one = placed.groupBy("person", *SAME).agg(F.min("first").alias("first"))
    return one.select("person", "first.place", "first.field", F.struct("first.field", F.col("first.place.minor").alias("field_ord"), *SAME).alias("e"))


def provenance(evidence: DataFrame) -> DataFrame:
    """(person, provenance) of distinct evidence: for each field the list of
    its evidence in order, fields in order of their first evidence. A list is
    one value, so it must fit in a task."""
    whole = F.array_sort(F.collect_list(F.struct("place", "e")))
    listed = evidence.groupBy("person", "field").agg(F.min("place").alias("first"), F.transform(whole, lambda s: s["e"]).alias("records"))
    return listed.groupBy("person").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "field", "records"))), lambda p: F.struct(p["field"].alias("field"), p["records"].alias("records"))).alias("provenance"))


def uuid5_hex(name: Column) -> Column:
    """Version 5 UUID of a name, in hex, under the namespace of profiles."""
    h = F.sha1(F.concat(F.unhex(F.lit(ID_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.lower(F.lpad(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F).bitwiseOR(0x80)), 2, "0"))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 19, 14))


def identifiers(emails: Column, phones: Column, links: Column) -> Column:
    named = lambda kind, values: F.transform(values, lambda v: F.concat(F.lit(f"{kind}:"), v))
    return F.concat(named("email", emails), named("phone", phones), named("link", links))


def id_part() -> Part:
    """candidate_id from all identifiers of a person, or else all names, or
    else all temporary ids. A profile with one kind gives no later one, which
    its person has no use for."""
    some = identifiers(F.col("emails"), F.col("phones"), link_values(F.col("links")))
    named = _blank(F.col("full_name")) != ""
    kinds = {
        "id": some,
        "id by name": F.when((F.size(some) == 0) & named, F.array(F.concat(F.lit("name:"), casefold(F.col("full_name"))))),
        "id by record": F.when((F.size(some) == 0) & ~named, F.array("tmp_id")),
    }
    empty = F.array().cast("array<string>")
    keyed = lambda tag, vs: F.transform(F.coalesce(vs, empty), lambda v: tagged(tag, [v]))
    rows = F.concat(*[keyed(tag, vs) for tag, vs in kinds.items()])
    joined = [let(_of(tag, F.col("k1")), lambda vs: F.when(F.size(vs) > 0, F.array_join(F.array_sort(vs), "|"))) for tag in kinds]
    return Part("candidate_id", rows, F.concat(F.lit("cand_"), uuid5_hex(F.coalesce(*joined))))


def person_ids(rows: DataFrame) -> DataFrame:
    """(person, candidate_id) of profiles with person and o."""
    return collapse(rows, [id_part()])


def primary_part() -> Part:
    """The first record of a person."""
    return Part("primary", F.array(tagged("primary", cells=[F.col("source"), F.col("source_id")])), F.struct(_only("primary").alias("source"), _only("primary", "c2").alias("source_id")))


def member(name: str) -> Column:
    """A member of a merged struct: '' hides later values but is itself none."""
    return F.nullif(F.col(name), F.lit("")).alias(name)


PLACE, LINKS = ("city", "region", "country"), ("linkedin", "github", "portfolio")


def parts() -> list[Part]:
    """Every column of a person, location and links as single members."""
    return [
        scalar_part("full_name", F.nullif(F.col("full_name"), F.lit("")), longest=True),
        *scalar_parts({"headline": F.col("headline"), "years_experience": F.col("years_experience").cast("string"), **{f: F.col("location")[f] for f in PLACE}, **{f: F.col("links")[f] for f in LINKS}}),
        primary_part(),
        *[list_part(k) for k in ("emails", "phones", "skills")],
        experience_part(),
        education_part(),
        fields_part(),
        id_part(),
    ]


def ordered(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("o", priority(F.col("source"), F.col("tmp_id"), F.struct("file_ord", "row_ord")))


def merge(profiles: DataFrame) -> DataFrame:
    """One row per person of profiles that have a column ``person``."""
    merged = collapse(ordered(profiles), parts())
    place = F.struct(*[member(f) for f in PLACE])
    some = F.coalesce(*[member(f) for f in PLACE]).isNotNull()
    return merged.select(
        "person", "full_name", "headline", F.col("years_experience").cast("double").alias("years_experience"),
        F.struct(*[member(f) for f in LINKS]).alias("links"), "primary", F.when(some, place).alias("location"),
        "emails", "phones", "skills", "experience", "education", "fields", "candidate_id",
    )
