"""From source records to canonical profiles with evidence.

One select over the records: every field is found through its aliases,
normalised, and noted as evidence with its source, method and original value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweld.functions import normalize as N
from kinweld.functions.tables import ALIASES, EVIDENCE_ORDER
from kinweld.sources.storage import spread

#: A looked-up value and the key it was found under.
HIT = "struct<value:variant,key:string>"
EVIDENCE = "struct<field:string,field_ord:int,source:string,source_id:string,method:string,original_field:string,value:string>"
EXPERIENCE = "array<struct<company:string,title:string,start_date:string,end_date:string,description:string>>"
EDUCATION = "array<struct<institution:string,degree:string,field_of_study:string,start_date:string,end_date:string>>"
_LIST = "array<variant>"


def kind_is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def present(v: Column) -> Column:
    """Neither null nor '', [] or {}; zero and false are present."""
    return ~F.coalesce(F.to_json(v), F.lit("null")).isin("null", '""', "[]", "{}")


def truthy(v: Column) -> Column:
    return ~F.coalesce(F.to_json(v), F.lit("null")).isin("null", '""', "[]", "{}", "0", "0.0", "false")


def folded_entries(fields: Column) -> Column:
    """Entries of a map of variants, each with its key folded once."""
    return F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), N.casefold(e["key"]).alias("folded")))


def _named(entries: Column, part: str) -> Column:
    return F.filter(entries, lambda e: e["folded"] == part.casefold())


def _entries(v: Column) -> Column:
    return N.let(v, lambda x: F.when(kind_is(x, "OBJECT"), folded_entries(x.cast("map<string,variant>"))))


def _hit(entry: Column, alias: str | None) -> Column:
    """A hit if the entry's value is present."""
    key = F.lit(alias) if alias else entry["key"]
    return F.when(present(entry["value"]), F.struct(entry["value"].alias("value"), key.alias("key")).cast(HIT))


def lookup(entries: Column, aliases: tuple[str, ...]) -> Column:
    """In folded entries, the first alias with a present value: along its dotted path, the first
    key that fits in any case, under the alias's own spelling; or as a whole
    key, the last that fits, under the key's spelling."""
    tries = []
    for alias in aliases:
        first, *rest = alias.split(".")
        entry = F.get(_named(entries, first), F.lit(0))
        for part in rest:
            entry = F.get(_named(_entries(entry["value"]), part), F.lit(0))
        tries.append(N.let(entry, lambda e: _hit(e, alias)))  # noqa: B023
        tries.append(N.let(F.try_element_at(_named(entries, alias), F.lit(-1)), lambda e: _hit(e, None)))
    return F.coalesce(*tries)


def text_of(v: Column) -> Column:
    """A string variant's text, else null."""
    return F.when(kind_is(v, "STRING"), v.cast("string"))


def any_text(v: Column) -> Column:
    """Any variant as text: strings bare, the rest as JSON."""
    return F.when(v.isNotNull() & ~F.is_variant_null(v), F.coalesce(text_of(v), F.to_json(v)))


def _array(v: Column) -> Column:
    """The items of an array, else null. Unlike the kind, this doesn't look into
    the items."""
    return F.try_variant_get(v, F.lit("$"), _LIST)


def as_list(v: Column) -> Column:
    return F.when(v.isNull() | F.is_variant_null(v), F.array().cast(_LIST)).otherwise(F.coalesce(_array(v), F.array(v)))


def member(v: Column, key: str) -> Column:
    return F.try_variant_get(v, F.lit(f"$.{key}"), "variant")


def either(v: Column, *keys: str) -> Column:
    """The first truthy member, as text where it is a string."""
    return N.let(_either(v, keys), text_of)


def _either(v: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*[N.let(member(v, k), lambda m: F.when(truthy(m), m)) for k in keys])


def either_any(v: Column, *keys: str) -> Column:
    return N.let(_either(v, keys), any_text)


def split_list(v: Column) -> Column:
    """Texts of a list: strings split at , ; |, objects by name or skill."""

    def one(x: Column) -> Column:
        pieces = F.filter(F.transform(F.split(x.cast("string"), "[,;|]"), N.strip), lambda s: s != "")
        named = F.filter(F.array(either(x, "name", "skill")), lambda s: s.isNotNull())
        return F.when(kind_is(x, "STRING"), pieces).when(kind_is(x, "OBJECT"), named).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(as_list(v), one))


def location(v: Column, fields: Column, countries: dict[str, str]) -> Column:
    """city, region, country from an object, a text or flat fields."""
    flat = lambda *ks: F.coalesce(*[N.let(F.try_element_at(fields, F.lit(k)), lambda m: F.when(truthy(m), m)) for k in ks])

    def of_text(parts: Column) -> Column:
        n = F.size(parts)
        return F.struct(F.when(n >= 2, F.get(parts, F.lit(0))).alias("city"), F.when(n >= 3, F.get(parts, n - 2)).alias("region"), F.get(parts, n - 1).alias("country"))

    of_object = F.struct(N.name(text_of(member(v, "city"))).alias("city"), N.name(either(v, "region", "state")).alias("region"), either(v, "country", "country_code").alias("country"))
    of_flat = F.struct(N.name(N.let(flat("city"), text_of)).alias("city"), N.name(N.let(flat("region", "state"), text_of)).alias("region"), N.let(flat("country", "country_code"), text_of).alias("country"))
    raw = F.when(kind_is(v, "OBJECT"), of_object).when(kind_is(v, "STRING"), N.let(F.transform(F.split(v.cast("string"), ","), N.strip), of_text)).otherwise(of_flat)

    def body(r: Column, country: Column) -> Column:
        some = (F.coalesce(r["city"], F.lit("")) != "") | (F.coalesce(r["region"], F.lit("")) != "") | country.isNotNull()
        return F.when(some, F.struct(r["city"].alias("city"), r["region"].alias("region"), country.alias("country")))

    return N.let(raw, lambda r: N.let(N.country(r["country"], countries), lambda c: body(r, c)))


def _raw_items(v: Column) -> Column:
    return F.coalesce(F.filter(_array(v), lambda x: kind_is(x, "OBJECT")), F.array().cast(_LIST))


def raw_experience(v: Column) -> Column:
    """Items with a company, dates still as written."""
    item = lambda x: F.struct(N.name(either(x, "company", "organization", "employer")).alias("company"), N.name(either(x, "title", "position")).alias("title"), either_any(x, "start_date", "start").alias("start_date"), either_any(x, "end_date", "end").alias("end_date"), N.name(text_of(member(x, "description"))).alias("description"))
    return F.filter(F.transform(_raw_items(v), item), lambda e: e["company"].isNotNull())


def raw_education(v: Column) -> Column:
    item = lambda x: F.struct(N.name(either(x, "institution", "school", "university")).alias("institution"), N.name(text_of(member(x, "degree"))).alias("degree"), N.name(either(x, "field_of_study", "field")).alias("field_of_study"), either_any(x, "start_date", "start").alias("start_date"), either_any(x, "end_date", "end").alias("end_date"))
    return F.filter(F.transform(_raw_items(v), item), lambda e: e["institution"].isNotNull())


def temporary_id(source: Column, source_id: Column) -> Column:
    return F.concat(F.lit("src_"), F.substring(F.sha2(F.concat(source, F.lit(":"), source_id).cast("binary"), 256), 1, 16))


def with_dates(items: str, kind: str) -> str:
    """SQL: ``items`` with their dates replaced from the column <items>_dates,
    which lists start and end of each item in turn."""
    rest = {"experience": "x.company AS company, x.title AS title, {d}, x.description AS description", "education": "x.institution AS institution, x.degree AS degree, x.field_of_study AS field_of_study, {d}"}[kind]
    dates = f"get({items}_dates, 2 * i) AS start_date, get({items}_dates, 2 * i + 1) AS end_date"
    return f"transform({items}, (x, i) -> struct({rest.format(d=dates)}))"


def date_texts(items: Column) -> Column:
    return F.flatten(F.transform(items, lambda x: F.array(x["start_date"], x["end_date"])))


def normal_dates(rows: DataFrame, items: str) -> DataFrame:
    """``rows`` with the dates of experience or education as months. Plain
    forms stay in the JVM; the parser gets lists with other forms only."""
    texts = date_texts(F.col(items))
    plain = F.transform(texts, N.plain_date)
    hard = F.exists(texts, lambda t: t.isNotNull() & N.plain_date(t).isNull())
    dated = rows.withColumn(f"{items}_dates", F.coalesce(N.date_list(F.when(hard, texts)), plain))
    return dated.withColumn(items, F.expr(with_dates(items, items))).drop(f"{items}_dates")


def map_records(records: DataFrame, countries: dict[str, str], region: str = "US") -> DataFrame:
    """Profiles of ``records``, which are dealt evenly over tasks. Those with a broken link have valid = false and
    say so in ``reason``: callers drop them once the profiles are written, since a filter here would
    be pushed below, and so repeat, the lookups it rests on."""
    f = F.col("fields")
    folded = spread(records).withColumn("_entries", folded_entries(f))
    hits = {k: lookup(F.col("_entries"), a) for k, a in ALIASES.items()}
    r = folded.select("*", *[h.alias(f"h_{k}") for k, h in hits.items()])
    value = lambda k: F.col(f"h_{k}.value")
    strings = lambda k: F.transform(as_list(value(k)), any_text)
    texts = lambda k: F.transform(as_list(value(k)), text_of)
    r = r.select(
        "*",
        temporary_id(F.col("source"), F.col("source_id")).alias("tmp_id"),
        N.name(text_of(value("full_name"))).alias("full_name"),
        N.unique(texts("emails"), N.email).alias("emails"),
        N.unique(strings("phones"), lambda c: N.phone(c, region)).alias("phones"),
        N.name(text_of(value("headline"))).alias("headline"),
        N.number(any_text(value("years_experience"))).alias("years_experience"),
        N.unique(split_list(value("skills")), N.skill).alias("skills"),
        location(value("location"), f, countries).alias("location"),
        F.struct(*[N.url(text_of(value(k))).alias(k) for k in ("linkedin", "github", "portfolio")]).alias("links"),
        raw_experience(value("experience")).alias("experience"),
        raw_education(value("education")).alias("education"),
    )
    for k in ("experience", "education"):
        r = normal_dates(r, k)
    return r.select("source", "source_id", "file_ord", "row_ord", "tmp_id", "full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education", evidence().alias("evidence"), _broken().isNull().alias("valid"), _broken().alias("reason"))


def _broken() -> Column:
    """Why a record can't be mapped: the links that can't be parsed, or null."""
    kinds = [F.when(N.broken_url(text_of(F.col(f"h_{k}.value"))), F.lit(f"invalid {k} link")) for k in ("linkedin", "github", "portfolio")]
    return F.nullif(F.concat_ws("; ", *kinds), F.lit(""))


def evidence() -> Column:
    """Evidence of a mapped record, in the order of fields: one entry for each
    field that was found and is valid, several for links and flat locations."""

    def entry(field: str, key: Column, value: Column, when: Column) -> Column:
        method = F.coalesce(F.try_element_at(F.col("methods"), key), F.lit("mapped_field"))
        made = F.struct(F.lit(field).alias("field"), F.lit(EVIDENCE_ORDER.index(field)).alias("field_ord"), F.col("source").alias("source"), F.col("source_id").alias("source_id"), method.alias("method"), key.alias("original_field"), F.to_json(value).alias("value"))
        return F.when(F.coalesce(when, F.lit(False)), made.cast(EVIDENCE))

    def plain(field: str, valid: Column | None = None) -> Column:
        hit = F.col(f"h_{field}")
        found = hit.isNotNull()
        return entry(field, hit["key"], hit["value"], found if valid is None else found & valid)

    some = lambda c: F.size(c) > 0
    entries = [
        plain("full_name"),
        plain("emails", some("emails")),
        plain("phones", some("phones")),
        plain("headline"),
        plain("years_experience", F.col("years_experience").isNotNull()),
        plain("skills", some("skills")),
        plain("location", F.col("location").isNotNull()),
    ]
    for part in ("city", "region", "state", "country", "country_code"):
        flat = F.get(_named(F.col("_entries"), part), F.lit(0))
        there = flat["value"].isNotNull() & ~F.is_variant_null(flat["value"]) & (F.to_json(flat["value"]) != '""')
        entries.append(entry("location", flat["key"], flat["value"], F.col("h_location").isNull() & F.col("location").isNotNull() & there))
    for link in ("linkedin", "github", "portfolio"):
        hit = F.col(f"h_{link}")
        entries.append(entry("links", hit["key"], hit["value"], F.col("links")[link].isNotNull()))
    entries += [plain("experience", some("experience")), plain("education", some("education"))]
    own = F.struct(F.lit("candidate_id").alias("field"), F.lit(EVIDENCE_ORDER.index("candidate_id")).alias("field_ord"), F.col("source").alias("source"), F.col("source_id").alias("source_id"), F.lit("stable_hash").alias("method"), F.lit(None).cast("string").alias("original_field"), F.to_json(F.struct(F.col("tmp_id").alias("v"))).substr(F.lit(6), F.length("tmp_id") + 2).alias("value"))
    return F.filter(F.array(*entries, own.cast(EVIDENCE)), lambda e: e.isNotNull())
