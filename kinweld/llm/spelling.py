"""Spelling variants: words at one edit of each other, and the form they go to.

Words are counted in the workers, combined before the shuffle. Pairs come from
an even partition: a word of length l is indexed by its two halves (the cut
depends on l); a word as long or one longer differs from it by one edit only
if it holds one of the halves, the first in its place, the second moved by the
difference in length. Probes are those substrings; candidates that the join
yields are checked for one edit, then repeats go.

A half that very many words share (``CROWD``) would make pairs of them all.
There the rest of the word joins the key, with one code point left out at a
stated place, so that only words that agree in everything but one place meet.
Both ways are exact and every pair found by either is checked.

Null texts have no words, a null id counts as ''. Rows that repeat an id count
as often as they occur. Equal largest counts go to the smallest word by code
points. Long texts are taken whole; an empty table gives no row; other columns
aren't read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import byte_texts, discard, released, slices, table, written

#: Least code points and occurrences of a word; how much more frequent a form is.
LEAST_LENGTH, LEAST_N, FACTOR = 7, 2, 10
#: One in so many runs of a document loses a code point.
THINNED = 31
#: Words sharing a half from which the rest of the word joins the key.
CROWD = 64
#: Words that a worker counts before it hands them on.
HELD = 200_000
#: Latin-1 letters, A to Z made small; anything else is a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _runs(text: bytes) -> list[bytes]:
    """Runs of letters as Latin-1; characters beyond it end a run."""
    return text.decode("utf-8", "replace").encode("latin-1", "replace").translate(LETTERS).split()


def occurrences(docs: DataFrame) -> DataFrame:
    """(word, n) with one row or more for a word: runs of at least
    LEAST_LENGTH letters, one in THINNED without one of its letters."""
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in totals], pa.string()), "n": pa.array(totals.values(), pa.int64())})
            totals.clear()
            return made

        for whole in batches:
            for batch in slices(whole):
                for doc, text in zip(batch.column(0).to_pylist(), byte_texts(batch), strict=True):
                    seed = zlib.crc32(f"{doc}:".encode())
                    for w, n in Counter(_runs(text)).items():
                        if len(w) < LEAST_LENGTH:
                            continue
                        h = zlib.crc32(w.decode("latin-1").encode(), seed)
                        if h % THINNED == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                            if len(w) < LEAST_LENGTH:
                                continue
                        totals[w] += n
                    if len(totals) > HELD:
                        yield out()
        if totals:
            yield out()

    return narrow.mapInArrow(released(run), "word string, n bigint")


def _from(c: Column, start: Column, size: Column | None = None) -> Column:
    """Code points of ``c`` from a place counted from 0, all or some."""
    return F.substr(c, start + 1, F.length(c) if size is None else size)


def _keys(words: DataFrame, longer: int) -> DataFrame:
    """(l, s, piece, rest, word, n): halves that words of length l would hold,
    seen from words of length l + ``longer``. rest is what isn't the half."""
    w = F.col("word")
    size = F.length(w) - longer
    half = F.floor(size / 2).cast("int")
    first = F.struct(F.lit(1).alias("s"), _from(w, F.lit(0), half).alias("piece"), _from(w, half).alias("rest"))
    second = F.struct(F.lit(2).alias("s"), _from(w, half + longer).alias("piece"), _from(w, F.lit(0), half + longer).alias("rest"))
    return words.select(size.alias("l"), F.explode(F.array(first, second)).alias("k"), "word", "n").select("l", "k.*", "word", "n")


def _left_out(rest: Column) -> Column:
    """``rest`` without each of its code points, with the place."""
    return F.transform(F.sequence(F.lit(1), F.length(rest)), lambda i: F.struct(i.alias("at"), F.concat(F.substr(rest, F.lit(1), i - 1), F.substr(rest, i + 1, F.length(rest))).alias("left")))


def _refined(keys: DataFrame, index: bool, longer: int) -> DataFrame:
    """Keys with (at, left): the place left out, 0 where an index word of the
    full rest meets a longer one, and what is left of the rest."""
    rest = F.col("rest")
    if not longer:
        variants = _left_out(rest)
        if index:
            variants = F.concat(variants, F.array(F.struct(F.lit(0).alias("at"), rest.alias("left"))))
    else:
        variants = F.array_distinct(F.transform(_left_out(rest), lambda v: F.struct(F.lit(0).alias("at"), v["left"].alias("left"))))
    return keys.select("l", "s", "piece", F.explode(variants).alias("v"), "word", "n").select("l", "s", "piece", "v.*", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): both directions of each pair of words of
    (word, n) at exactly one edit."""
    index = _keys(words, 0)
    crowds = written(index.groupBy("l", "s", "piece").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWD).drop("size"))
    key = ["l", "s", "piece"]

    def candidates(longer: int) -> DataFrame:
        probes = _keys(words, longer)
        other = lambda df: df.withColumnsRenamed({"word": "other", "n": "other_n"})
        plain = index.join(crowds, key, "left_anti").drop("rest").join(other(probes.join(crowds, key, "left_anti").drop("rest")), key)
        dense_index = _refined(index.join(crowds, key, "left_semi"), True, 0)
        dense = dense_index.join(other(_refined(probes.join(crowds, key, "left_semi"), False, longer)), [*key, "at", "left"])
        both = plain.select("word", "n", "other", "other_n").unionByName(dense.select("word", "n", "other", "other_n"))
        return both if longer else both.where(F.col("word") < F.col("other"))

    found = candidates(0).unionByName(candidates(1)).where(F.levenshtein("word", "other", 1) == 1).distinct()
    back = found.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.unionByName(back)


def forms(pairs: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of words that have a near one."""
    best = F.min(F.struct((-F.col("other_n")).alias("least"), F.col("other")))
    grouped = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    wins = -F.col("best.least") >= FACTOR * F.col("n")
    return grouped.select("word", "n_near", F.when(wins, F.col("best.other")).alias("form"), F.when(wins, -F.col("best.least")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. A form is FACTOR times as
    frequent, so chains are short and end; each round doubles the stretch."""
    ways = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = ways.select(F.col("word").alias("via"), F.col("root").alias("further"))
        stepped = written(ways.join(on, F.col("root") == F.col("via"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        done = stepped.where("moved").isEmpty()
        discard(ways)
        if done:
            return stepped.drop("moved")
        ways = stepped


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of every word of the documents."""
    words = written(occurrences(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_N))
    found = written(forms(near_pairs(words)))
    last = roots(found)
    known = found.withColumnRenamed("word", "w")
    ends = last.withColumnRenamed("word", "v")
    whole = words.join(known, F.col("word") == F.col("w"), "left").join(ends, F.col("word") == F.col("v"), "left")
    return whole.select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), F.coalesce("n_near", F.lit(0)).alias("n_near"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE crc(k, c, step) AS (
  SELECT range::UBIGINT, range::UBIGINT, 0 FROM range(256)
  UNION ALL
  SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1 FROM crc WHERE step < 8
), lookup AS MATERIALIZED (
  SELECT list(c ORDER BY k) AS t FROM crc WHERE step = 8
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda ch:
      CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::UBIGINT] ELSE [(192 + (unicode(ch) >> 6))::UBIGINT, (128 + (unicode(ch) & 63))::UBIGINT] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS h
  FROM counted, lookup
), thinned AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), ranked AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS r FROM pairs
), forms AS MATERIALIZED (
  SELECT word, n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM ranked WHERE r = 1
), chain(word, via, depth) AS (
  SELECT word, form, 1 FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT chain.word, forms.form, depth + 1 FROM chain JOIN forms ON forms.word = chain.via WHERE forms.form IS NOT NULL
), ends AS (
  SELECT word, max_by(via, depth) AS root FROM chain GROUP BY word
)
SELECT words.word, words.n, form, form_n, coalesce(root, words.word) AS root, coalesce(n_near, 0) AS n_near
FROM words LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""
