import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators must not trip over.
CLASHING = ("kept", "score", "size", "d", "digest", "bucket", "text_")


def words(rng, n, most=400):
    return [f"w{rng.randint(0, most)}" for _ in range(n)]


def documents(spark, rows, clashing=False):
    """Documents from (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], *(r[2:] + ("en", "s0"))[:2], None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clashing:
        for c in CLASHING:
            df = df.selectExpr("*", f"doc_id AS {c}")
    return df


def awkward():
    """Nulls, empties, blanks, ties, repeated rows, a long text."""
    rng = random.Random(3)
    long = " ".join(words(rng, 30_000, 9_000))
    return [(1, None), (2, ""), (3, " \t\r\n"), (4, "one"), (4, "one"), (5, "o ne"), (None, "one"), (6, "ünï çödé ÄÖ"), (7, long), (8, long), (9, "\U0001f600 日本 \x1c\x85 x"), (None, None)]
