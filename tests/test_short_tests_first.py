"""Cheap tests that spare texts and pairs the costly ones, and lose nothing."""

import random

from pyspark.sql import functions as F

from kinweld.functions.similarity import lcs_length
from kinweld.functions.tables import SECTIONS
from kinweld.operators import extract as X
from kinweld.operators import matching as J


def test_headings_in_any_spelling(spark):
    spelt = [s.upper() for s in SECTIONS] + ["ſkills", "SKILLS", "proﬁle", "EXPERIENСE", "work  experience", "summary"]
    lines = [f"{a}{s}{b}" for s in spelt for a in ("", " \t", " ", ":") for b in ("", ":", " :::", ": ", "\x1f::", " x", "s")] + ["", ":", "Se", "technical skills" + " " * 500 + ":" * 500]
    want = {t: key if (key := (t.rstrip(":") if t.endswith(":") else t).strip().casefold()) in SECTIONS else None for t in lines}
    got = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in lines], "t string").select("t", X.heading(F.col("t")).alias("h")).collect()}
    assert got == want and sum(h is not None for h in want.values()) > 50


def test_only_lines_like_headings_are_folded(spark):
    lines = spark.createDataFrame([("Skills and much more than any heading has",), ("der Große Saal",), ("Straße " * 50,), (" Skills ::",)], "t string")
    assert [r["f"] for r in lines.select(F.col("t").rlike(X.OPENING).alias("f")).collect()] == [False, False, False, True]


def test_texts_without_what_a_match_has(spark):
    rows = [("a@b.c d@e.f",), ("none",), (None,), ("see GITHUB.COM/x and linkedin.com/in/y/",), ("a/b .com",)]
    found = spark.createDataFrame(rows, "t string").select(X.emails_of(F.col("t")).alias("e"), X.last_link(F.col("t"), True).alias("l"), X.last_link(F.col("t"), False).alias("g")).collect()
    assert [tuple(r) for r in found] == [(["a@b.c", "d@e.f"], None, None), ([], None, None), (None, None, None), ([], "linkedin.com/in/y/", "GITHUB.COM/x"), ([], None, None)]


def test_letter_counts_differ_by_no_more_than_edits(spark):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice("aabcz é\U0001f600\U0001f601") for _ in range(rng.randint(0, 14)))
    pairs = [(text(), text()) for _ in range(300)] + [("ab" * 9, "ab" * 9 + "\U0001f600"), ("", "")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.bit_count(J.letter_counts("a").bitwiseXOR(J.letter_counts("b"))).alias("n")).collect()
    assert all(r["n"] <= len(r["a"]) + len(r["b"]) - 2 * lcs_length(r["a"], r["b"]) for r in rows)
    assert max(r["n"] for r in rows) > 5
