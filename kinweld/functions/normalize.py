"""Normalisers as Column functions: email, phone, date, country, skill, url, name.

All but the free-form part of dates are JVM expressions. Each returns null
for what it can't normalise. Values are strings; callers cast before.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.functions.tables import COUNTRY_ALIASES, COUNTRY_NAMES, NANP, NUMBERING, SKILL_ALIASES

#: White space as Python's str methods see it.
WHITE = r"(?U)[\s\x1c-\x1f]"
# Fixed value: the address pattern.
EMAIL = r"(?i)^[A-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?(?:\.[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?)+\z"
#: What full case folding makes of a lower-case character, where that differs,
#: by the tables of the runtime.
FOLDS = {c: c.casefold() for c in map(chr, range(0x80, 0x1F000)) if c.casefold() != c and c.lower() == c}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which appears once in the plan and is computed
    once, however often the body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def fenced(value: Column) -> Column:
    """``value``, computed in the select that it is in and nowhere else: since
    it counts as not deterministic, the optimizer neither repeats it in what
    uses it nor moves filters, and with them the work, below the select."""
    return F.when(F.spark_partition_id() >= 0, value)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+\\z", "")


def casefold(c: Column) -> Column:
    """Lower case and what full case folding does beyond it. ASCII texts pay
    for one short test, others for a pattern of all characters that fold."""
    single = {a: b for a, b in FOLDS.items() if len(b) == 1}
    longer = F.split(F.lit("|".join(a + b for a, b in FOLDS.items() if len(b) > 1)), r"\|")

    def folded(low: Column) -> Column:
        moved = F.translate(low, "".join(single), "".join(single.values()))
        wide = low.rlike(r"[^\x00-\x7F]") & low.rlike("[" + "".join(FOLDS) + "]")
        return F.when(wide, F.aggregate(longer, moved, lambda acc, p: F.replace(acc, F.left(p, F.lit(1)), F.substring(p, 2, 9)))).otherwise(low)

    return let(F.lower(c), folded)


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"{WHITE}+", " ")


def name(c: Column) -> Column:
    """Single blanks inside, no blanks or commas around; empty is null."""
    return F.nullif(F.regexp_replace(collapse(c), r"^[ ,]+|[ ,]+\z", ""), F.lit(""))


def email(c: Column) -> Column:
    return let(F.lower(strip(c)), lambda low: F.when(low.rlike(EMAIL), low))


def titled(c: Column) -> Column:
    """Each run of cased letters with a capital first and small ones after."""
    runs = F.regexp_extract_all(c, F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))), "")


def _constant_map(values: dict[str, str]) -> Column:
    """A map that the optimizer folds into one literal."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def skill(c: Column) -> Column:

    def body(clean: Column) -> Column:
        known = F.try_element_at(_constant_map(SKILL_ALIASES), casefold(clean))
        return F.when(clean != "", F.coalesce(known, F.when(clean.rlike(r"\p{Lu}"), clean).otherwise(titled(clean))))

    return let(collapse(strip(c)), body)


def url(c: Column) -> Column:
    """https where no scheme is given; scheme and host in small letters; no
    parameters, query, fragment or final slashes. The host needs a dot."""

    def body(full: Column) -> Column:
        scheme = F.lower(F.regexp_extract(full, r"(?i)^(https?)://", 1))
        host = F.lower(F.regexp_extract(full, r"(?is)^https?://([^/?#]*)", 1))
        path = F.regexp_extract(full, r"(?is)^https?://[^/?#]*([^?#]*)", 1)
        path = F.regexp_replace(F.regexp_replace(path, r"(?s);[^/]*\z", ""), r"/+\z", "")
        return let(host, lambda h: F.when(h.contains("."), F.concat(scheme, F.lit("://"), h, path)))

    bare = F.regexp_replace(strip(c), r"[\t\r\n]", "")
    whole = let(bare, lambda b: F.when(b.rlike(r"(?i)^https?://"), b).when(b != "", F.concat(F.lit("https://"), b)))
    return let(whole, body)


def broken_url(c: Column) -> Column:
    """An unfinished IPv6 host, which makes its whole record invalid."""
    host = F.regexp_extract(F.regexp_replace(strip(c), r"(?i)^https?://", ""), r"^([^/?#]*)", 1)
    return let(host, lambda h: F.coalesce(h.contains("[") != h.contains("]"), F.lit(False)))


def phone(c: Column, region: str = "US") -> Column:
    """E.164 of a structurally valid number: digits after the calling code
    fit the numbering plan. Without + the number is one of ``region``."""
    region = region.upper()
    foreign_rules = "|".join(f"{code}[1-9]\\d{{{least - 1},{most - 1}}}" for _, code, _, least, most in NUMBERING)

    def body(bare: Column) -> Column:
        return let(F.regexp_replace(bare, r"\D", ""), lambda digits: valid(bare, digits))

    def valid(bare: Column, digits: Column) -> Column:
        abroad = F.when(digits.rlike(f"^(?:1{NANP}|{foreign_rules})\\z"), F.concat(F.lit("+"), digits))
        if region in ("US", "CA"):
            home = F.when(digits.rlike(f"^1?{NANP}\\z"), F.concat(F.lit("+1"), F.regexp_replace(digits, r"^1", "")))
        else:
            home = F.lit(None).cast("string")
            for _, code, trunk, least, most in (p for p in NUMBERING if p[0] == region):
                national = F.regexp_replace(digits, f"^{trunk}", "") if trunk else digits
                home = let(national, lambda d: F.when(d.rlike(f"^[1-9]\\d{{{least - 1},{most - 1}}}\\z"), F.concat(F.lit(f"+{code}"), d)))  # noqa: B023
        usual = bare.rlike(r"^\+?[\d\s().\-/\u2010-\u2015\xa0]+\z")
        return F.when(usual, F.when(bare.startswith("+"), abroad).otherwise(home))

    return let(F.regexp_replace(strip(c), r"(?i)\s*(?:;?\s*ext\.?|x|#|extension)\s*[:.]?\s*\d{1,7}\z", ""), body)


def country_table(spark: SparkSession) -> dict[str, str]:
    """Folded code or English name of each country to its two-letter code,
    made from the runtime's locale data."""
    locale = spark.sparkContext._jvm.java.util.Locale
    english = locale.ENGLISH
    out: dict[str, str] = {}
    for code in locale.getISOCountries():
        place = locale("", code)
        out |= {place.getDisplayCountry(english).lower(): code, place.getISO3Country().lower(): code, code.lower(): code}
    return out | COUNTRY_NAMES


def country(c: Column, countries: dict[str, str]) -> Column:
    """Alias, two letters, three letters, name, else the one country whose
    name holds the value."""
    entries = F.map_entries(_constant_map({k: v for k, v in countries.items() if len(k) > 3}))

    def body(key: Column) -> Column:
        held = F.array_distinct(F.transform(F.filter(entries, lambda e: e["key"].contains(key)), lambda e: e["value"]))
        fuzzy = F.when(F.length(key) > 3, let(held, lambda h: F.when(F.size(h) == 1, F.get(h, F.lit(0)))))
        return F.when(key != "", F.coalesce(F.try_element_at(_constant_map(countries | COUNTRY_ALIASES), key), fuzzy))

    return let(casefold(strip(c)), body)


@lru_cache(maxsize=1 << 16)
def _parse_date(value: str | None) -> str | None:
    from dateutil import parser

    if value is None or value.strip().lower() in ("", "present", "current", "now"):
        return None
    try:
        found = parser.parse(value, default=datetime(1900, 1, 1))
    except (ValueError, TypeError, OverflowError):
        return None
    return f"{found.year:04d}-{found.month:02d}"


@F.pandas_udf(T.StringType())
def _free_dates(values: pd.Series) -> pd.Series:
    return values.map(_parse_date)


@F.pandas_udf(T.ArrayType(T.StringType()))
def date_list(values: pd.Series) -> pd.Series:
    """Months of a list of date texts, free forms included."""
    return values.map(lambda v: None if v is None else [_parse_date(x) for x in v])


def plain_date(c: Column) -> Column:
    """Months of the forms that need no parser: yyyy, yyyy-mm, yyyy-mm-dd."""

    def body(v: Column) -> Column:
        full = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), F.substring(v, 1, 7))
        short = F.when(v.rlike(r"^\d{4}-(0[1-9]|1[0-2])\z"), v).when(v.rlike(r"^\d{4}\z"), F.concat(v, F.lit("-01")))
        return F.when(~v.startswith("0000"), F.coalesce(full, short))

    return let(strip(c), body)


def date(c: Column) -> Column:
    """YYYY-MM. The parser runs only on what the plain forms leave."""
    plain = plain_date(c)
    return F.coalesce(plain, _free_dates(F.when(plain.isNull(), c)))


def number(c: Column) -> Column:
    """The first number in a text, if it is 80 or less."""
    return let(F.regexp_extract(c, r"(\d+(?:\.\d+)?)", 1).try_cast("double"), lambda found: F.when(found <= 80, found))


def unique(values: Column, normalizer: Callable[[Column], Column]) -> Column:
    """Normalised values in order, the first of each spelling kept: sorted by
    (spelling, place), the first of each run stays and goes back to its place."""
    keyed = F.transform(values, lambda x, i: let(normalizer(x), lambda v: F.struct(casefold(v).alias("k"), i.alias("i"), v.alias("v"))))
    ordered = F.array_sort(F.filter(keyed, lambda s: s["v"].isNotNull()))

    def firsts(rows: Column) -> Column:
        kept = F.filter(rows, lambda s, j: (j == 0) | (F.get(rows, j - 1)["k"] != s["k"]))
        return F.transform(F.array_sort(F.transform(kept, lambda s: F.struct(s["i"].alias("i"), s["v"].alias("v")))), lambda s: s["v"])

    return F.coalesce(let(ordered, firsts), F.array().cast("array<string>"))
