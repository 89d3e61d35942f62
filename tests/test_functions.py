import pytest
from pyspark.sql import functions as F

from kinweld.functions import normalize as N
from kinweld.functions.similarity import indel_ratio, lcs_length, sorted_tokens


def values(spark, inputs, fn):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], "k int, v string").select("k", fn(F.col("v")).alias("x")).orderBy("k").collect()
    return [r["x"] for r in rows]


def test_email(spark):
    assert values(spark, [" ADA@Example.COM ", "not-an-email", "a@b", "a@x.io;b@x.io", "", None], N.email) == ["ada@example.com", None, None, None, None, None]


def test_phone(spark):
    given = ["(415) 555-2671", "+1 415 555 2671", "+44 20 7946 0958", "555-2671", "+1 111 555 2671", "call me", "", None, "415-555-2671 x12"]
    assert values(spark, given, N.phone) == ["+14155552671", "+14155552671", "+442079460958", None, None, None, None, None, "+14155552671"]
    assert values(spark, ["098765 43210"], lambda c: N.phone(c, "IN")) == ["+919876543210"]


def test_date(spark):
    given = ["February 2024", "present", "2020", "01/02/2020", "13/02/2020", "Mar", "Feb 30 2020", "Spring 2020", "2020-13", "0099-01-01", "2015-06-01", None, ""]
    assert values(spark, given, N.date) == ["2024-02", None, "2020-01", "2020-01", "2020-02", "1900-03", None, None, None, "0099-01", "2015-06", None, None]


def test_country(spark):
    countries = N.country_table(spark)
    given = ["United States", "IND", "UK", "u.s.", "CA", "ZZ", "France", "nowhere", " ", None]
    assert values(spark, given, lambda c: N.country(c, countries)) == ["US", "IN", "GB", "US", "CA", None, "FR", None, None, None]


def test_skill_and_title(spark):
    given = ["CPP", "ReactJS", " data   science ", "node-red", "it's", "e2e tests", "Go", "", None]
    assert values(spark, given, N.skill) == ["C++", "React", "Data Science", "Node-Red", "It'S", "E2E Tests", "Go", None, None]


def test_url(spark):
    given = ["LinkedIn.com/in/Ada/", "http://X.org/a;p?q#f", "https://x.org", "nodots", "", None, "HTTPS://www.X.org/Path//"]
    assert values(spark, given, N.url) == ["https://linkedin.com/in/Ada", "http://x.org/a", "https://x.org", None, None, None, "https://www.x.org/Path"]
    assert values(spark, ["http://[::1/x", "http://x.org"], N.broken_url) == [True, False]


def test_name_casefold_number(spark):
    assert values(spark, [" , Ada   L. ,", " , ", None], N.name) == ["Ada L.", None, None]
    assert values(spark, ["Straße ΣΑΣ ﬁ"], N.casefold) == ["strasse σασ fi"]
    assert values(spark, ["-5", "1,200", "5-7", "81", "8.5 years", "x"], N.number) == [5.0, 1.0, 5.0, None, 8.5, None]


def test_unique_keeps_first_spelling(spark):
    rows = spark.createDataFrame([(["CPP", "c++", None, "ReactJS", "react"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in rows.select(N.unique(F.col("v"), N.skill)).collect()] == [["C++", "React"], [], []]


@pytest.mark.parametrize(("a", "b", "n"), [("", "", 0), ("abc", "abc", 3), ("abcde", "ace", 3), ("kitten", "sitting", 4), ("aaaa", "aa", 2)])
def test_lcs(a, b, n):
    assert lcs_length(a, b) == lcs_length(b, a) == n


def test_token_sort_ratio(spark):
    rows = spark.createDataFrame([("Ada  Lovelace", "lovelace ADA"), ("Jon Smith", "John Smith")], "a string, b string")
    scored = rows.select(indel_ratio(sorted_tokens(F.col("a")), sorted_tokens(F.col("b"))).alias("r")).collect()
    assert scored[0]["r"] == 100.0
    assert scored[1]["r"] == pytest.approx(200 * 9 / 19)


def test_casefold_is_complete(spark):
    from kinweld.functions.normalize import casefold

    texts = ["STRASSE ß ẞ", "µ ϐ ϑ ϕ ς Σ ΑΣ", "ᾳ ᾼ ﬀ ŉ ſ", "İstanbul", "ABC é Ünï", "Ꭰ ꭰ", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", casefold(F.col("t")).alias("f")).collect()
    assert all(r["f"] == r["t"].casefold() for r in rows), [(r["f"], r["t"].casefold()) for r in rows]
