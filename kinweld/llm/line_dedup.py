"""Lines that several documents hold stay in the first of them only.

Lines are exploded with their places, hashed by a normalised key (128 bits)
and counted by documents. A line held by two documents or more, by default,
is dropped wherever it stands but in the document with the smallest id; the
others are joined again by position.

What the first count gathers of a hash is four numbers (the smallest and the
largest holder), combined before the shuffle, so a line that a third of all
documents hold is as cheap as any. Marking its many places goes through a
broadcast of the few hot hashes (:func:`~kinweld.llm.common.join_hot`); places
of all other lines meet their hash in a shuffle.

Null and empty texts are one empty line. Rows that repeat a doc_id are one
document: what one of them holds first, all its rows keep. A null id comes
after all others and each distinct text under it is a document. Repeats of a
line inside its first document stay. Lines with fewer code points than
``least_chars`` always stay. An empty table gives no row; other columns pass
through whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.functions.normalize import let
from kinweld.llm.common import BLANK, fresh, hot_rows, join_hot, table, written

LEAST_CHARS = 10
LEAST_DOCS = 2


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Without blanks around, A to Z in small letters."""
    return F.translate(F.regexp_replace(line, rf"^{BLANK}+|{BLANK}+\z", ""), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _places(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc, body, anon, pos, h): every line that counts. body is the text's
    digest; anon stands for a document without an id."""
    body = _digest(F.col("text"))
    anon = F.when(F.col("doc_id").isNull(), F.xxhash64(body))
    # In a select of its own: beside the explode it would be computed for each line.
    whole = docs.select(F.col("doc_id").alias("doc"), body.alias("body"), anon.alias("anon"), lines_of(F.col("text")).alias("lines"))
    each = whole.select("doc", "body", "anon", F.posexplode("lines").alias("pos", "line"))
    keyed = each.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= least_chars)
    return keyed.select("doc", "body", "anon", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("h"))


def repeated(places: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(hash, first_doc, first_anon, n): hashes in at least so many documents,
    their first document and the number of their places."""
    held = places.groupBy("h").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), F.min("anon").alias("first_anon"), F.max("anon").alias("last_anon"), F.count(F.lit(1)).alias("n"))
    several = (F.col("first_doc") != F.col("last_doc")) | (F.col("first_anon") != F.col("last_anon")) | (F.col("first_doc").isNotNull() & F.col("first_anon").isNotNull())
    found = held.where(F.coalesce(several, F.lit(False))).select(F.col("h").alias("hash"), "first_doc", "first_anon", "n")
    if least_docs <= 1:
        return held.select(F.col("h").alias("hash"), "first_doc", "first_anon", "n")
    if least_docs == 2:
        return found
    some = found.where(F.col("n") >= least_docs)
    counted = places.join(some.select("hash"), F.col("h") == F.col("hash"), "left_semi").groupBy("h", "doc", "anon").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("one").alias("docs"))
    return some.join(counted.where(F.col("docs") >= least_docs), F.col("hash") == F.col("h"), "left_semi")


def dropped_places(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc, body, gone): for each document that loses lines, their sorted
    positions. ``body`` is the digest of the text that they are positions in."""
    places = written(_places(docs, least_chars))
    hashes = written(repeated(places, least_docs))
    hot = F.col("n") > hot_rows(places.count())
    met = join_hot(places, hashes, F.col("h") == F.col("hash"), hot)
    away = F.when(F.col("first_doc").isNotNull(), ~F.col("doc").eqNullSafe(F.col("first_doc"))).otherwise(F.col("anon") != F.col("first_anon"))
    return met.where(away).groupBy("doc", "body").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` but those at the sorted positions, as slices between them."""
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(gone, i - 1) + 1)
    end = lambda i: F.coalesce(F.get(gone, i), F.size(lines))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice(lines, before(i) + 1, end(i) - before(i))))


def apply(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, str, str]:
    """``docs`` with the remaining text, and the names of two more columns:
    the number of lines before and of those dropped. Null texts become ''."""
    gone = dropped_places(docs, least_chars, least_docs)
    body, n_lines, n_dropped = fresh(docs, "body"), fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    own = docs.withColumn(body, _digest(F.col("text")))
    at = fresh(own, "gone")
    marks = gone.select(F.col("doc").alias(fresh(own, "doc")), F.col("body").alias(body + "_"), F.col("gone").alias(at))
    on = own["doc_id"].eqNullSafe(marks[fresh(own, "doc")]) & (own[body] == marks[body + "_"])
    joined = own.join(marks.hint("shuffle_hash"), on, "left")
    places = F.coalesce(F.col(at), F.array().cast("array<int>"))
    rest = F.when(F.col(at).isNull(), F.coalesce("text", F.lit(""))).otherwise(let(lines_of(F.col("text")), lambda lines: F.array_join(_without(lines, F.col(at)), "\n")))
    columns = [rest.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.size(lines_of(F.col("text"))).cast("bigint").alias(n_lines), F.size(places).cast("bigint").alias(n_dropped)), n_lines, n_dropped


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, n_lines, n_dropped = apply(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), held AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT doc_id, pos, line, first IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN held USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
