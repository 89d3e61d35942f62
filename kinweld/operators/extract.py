"""Fields of a resume text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweld.functions.normalize import WHITE, casefold, let, strip
from kinweld.functions.tables import SECTIONS

# Patterns of addresses, phone numbers, profile links, dates, degrees.
EMAIL = r"(?iU)([\w.!#$%&'*+/=?^`{|}~-]+@[\w-]+(?:\.[\w-]+)+)"
PHONE = r"(?U)((?<!\w)(?:\+?\d[\d().\-\s]{7,}\d))"
LINK = r"(?iU)((?:https?://)?(?:www\.)?(?:linkedin\.com/in|github\.com)/[\w.%-]+/?)"
DASH = r"(?U)\s+(?:—|–|-|\|)\s+"
RANGE = r"(?iU)((?:[A-Za-z]{3,9}\s+)?\d{4})\s*(?:-|—|–|to)\s*(present|current|(?:[A-Za-z]{3,9}\s+)?\d{4})"
DEGREE = r"(?iU)^((?:B|M)(?:Sc|A|S|E|Tech)|PhD|MBA|Bachelor(?:'s)?(?: of [A-Za-z]+)?|Master(?:'s)?(?: of [A-Za-z]+)?)(?:\s+(?:in\s+)?(.*?))?(?:\s+—\s+\d{4})?\z"
YEAR = r"\b((?:19|20)\d{2})\b"
#: Line ends as splitlines() has them.
LINES = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def lines_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, LINES), strip), lambda x: x != "")


def _all(text: Column, pattern: str, needed: Column) -> Column:
    """All matches in texts with what every match has; others aren't searched."""
    return F.when(needed, F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).when(text.isNotNull(), F.array().cast("array<string>"))


def emails_of(text: Column) -> Column:
    return _all(text, EMAIL, text.contains("@"))


def phones_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PHONE), F.lit(1))


def last_link(text: Column, linkedin: bool) -> Column:
    links = _all(text, LINK, text.contains("/") & F.lower(text).contains(".com/"))
    own = F.filter(links, lambda x: F.lower(x).contains("linkedin.com") == F.lit(linkedin))
    return F.try_element_at(own, F.lit(-1))


def looks_like_name(line: Column) -> Column:
    words = F.size(F.split(line, f"{WHITE}+"))
    return ~line.rlike(r"(?U)[@+|\d]|http") & words.between(2, 5) & (F.length(line) <= 80)


def name_of(lines: Column) -> Column:
    return F.get(F.filter(F.slice(lines, 1, 8), looks_like_name), F.lit(0))


#: What a line that opens a section is like: one of the characters that fold to
#: a section's first, as many more as the longest section has at most (folding
#: makes none fewer), blanks and colons. It ends on long lines after a few steps.
_OPENERS = "".join(c for c in map(chr, range(0x1F000)) if c.casefold()[:1] in {s[0] for s in SECTIONS})
OPENING = f"(?sU)^[\\s\\x1c-\\x1f]*[{_OPENERS}].{{0,{max(map(len, SECTIONS)) - 1}}}[\\s\\x1c-\\x1f:]*\\z"


def heading(line: Column) -> Column:
    """The section that a line opens, else null. Only short lines with a fit
    beginning are folded."""
    key = let(casefold(strip(F.regexp_replace(line, r":+\z", ""))), lambda key: F.when(key.isin(*SECTIONS), key))
    return F.when(line.rlike(OPENING), key)


def sections_of(lines: Column) -> Column:
    """(section, line) of every line under a heading, in order. A heading
    has a null line, so sections without lines are known too. Each line looks
    up the last heading before it, so no list grows line by line."""

    def placed(heads: Column, at: Column) -> Column:
        def entry(line: Column, i: Column) -> Column:
            last = F.array_max(F.filter(at, lambda k: k <= i))
            return let(last, lambda k: F.when(k.isNotNull(), F.struct(F.get(heads, k).alias("section"), F.when(k < i, line).alias("line"))))

        return F.filter(F.transform(lines, entry), lambda x: x.isNotNull())

    def with_heads(heads: Column) -> Column:
        at = F.filter(F.transform(heads, lambda h, i: F.when(h.isNotNull(), i)), lambda i: i.isNotNull())
        return let(at, lambda at: placed(heads, at))

    return let(F.transform(lines, heading), with_heads)


def under(sections: Column, name: str) -> Column:
    return F.transform(F.filter(sections, lambda s: (s["section"] == name) & s["line"].isNotNull()), lambda s: s["line"])


def opened(sections: Column, name: str) -> Column:
    return F.exists(sections, lambda s: s["section"] == name)


def skills_of(sections: Column) -> Column:
    found = F.concat(under(sections, "skills"), under(sections, "technical skills"))
    return F.filter(F.transform(F.flatten(F.transform(found, lambda x: F.split(x, "[,|;•]"))), strip), lambda x: x != "")


def headline_of(sections: Column) -> Column:
    found = F.when(opened(sections, "summary"), under(sections, "summary")).otherwise(under(sections, "profile"))
    return let(found, lambda x: F.when(F.size(x) > 0, F.array_join(F.slice(x, 1, 2), " ")))


def parts_of(line: Column) -> Column:
    return F.filter(F.transform(F.split(line, DASH), strip), lambda x: x != "")


def _found(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def experience_line(line: Column) -> Column:
    """company, title, start_date, end_date; null with less than two parts."""

    def body(parts: Column) -> Column:
        rest = F.array_join(F.slice(parts, 3, 1 << 20), " ")
        item = F.struct(F.get(parts, F.lit(0)).alias("company"), F.get(parts, F.lit(1)).alias("title"), _found(F.regexp_extract(rest, RANGE, 1)).alias("start_date"), _found(F.regexp_extract(rest, RANGE, 2)).alias("end_date"))
        return F.when(F.size(parts) >= 2, item)

    return let(parts_of(line), body)


def education_line(line: Column) -> Column:
    """institution, degree, field_of_study, end_date; null without a name."""

    def body(parts: Column) -> Column:
        second = F.get(parts, F.lit(1))
        degree = _found(F.regexp_extract(second, DEGREE, 1))
        rest = F.array_join(F.slice(parts, 2, 1 << 20), " ")
        item = F.struct(F.get(parts, F.lit(0)).alias("institution"), F.coalesce(degree, second).alias("degree"), _found(F.regexp_extract(second, DEGREE, 2)).alias("field_of_study"), _found(F.regexp_extract(rest, YEAR, 1)).alias("end_date"))
        return F.when(F.length(F.get(parts, F.lit(0))) >= 2, item)

    return let(parts_of(line), body)


def _items(lines: Column, parse) -> Column:
    return F.filter(F.transform(lines, parse), lambda x: x.isNotNull())


#: Field, column of :func:`sectioned` that holds it, and how it was found.
FOUND = (
    ("full_name", "header_heuristic"),
    ("emails", "regex"),
    ("phones", "regex"),
    ("linkedin", "regex"),
    ("github", "regex"),
    ("skills", "section_heuristic"),
    ("headline", "section_heuristic"),
    ("experience", "section_heuristic"),
    ("education", "section_heuristic"),
)


def resume_fields(texts: DataFrame) -> DataFrame:
    """``texts`` (with a column text) plus fields and methods. Lines and
    sections are columns of their own, computed once for all that uses them.
    Fields not found are left out."""
    text, lines, sections = F.col("text"), F.col("_lines"), F.col("_sections")
    staged = texts.withColumn("_lines", lines_of(text)).withColumn("_sections", sections_of(lines))
    filled = lambda a: let(a, lambda x: F.when(F.size(x) > 0, x))
    found = {
        "full_name": name_of(lines),
        "emails": filled(emails_of(text)),
        "phones": filled(phones_of(text)),
        "linkedin": last_link(text, True),
        "github": last_link(text, False),
        "skills": filled(skills_of(sections)),
        "headline": headline_of(sections),
        "experience": filled(_items(F.concat(under(sections, "experience"), under(sections, "work experience")), experience_line)),
        "education": filled(_items(under(sections, "education"), education_line)),
    }
    whole = F.parse_json(F.to_json(F.struct(*[v.alias(k) for k, v in found.items()])))
    names = F.create_map(*[F.lit(x) for pair in FOUND for x in pair])
    staged = staged.withColumn("fields", whole.cast("map<string,variant>"))
    return staged.withColumn("methods", F.map_filter(names, lambda k, v: F.map_contains_key(F.col("fields"), k))).drop("_lines", "_sections")
