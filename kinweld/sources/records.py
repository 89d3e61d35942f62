"""Source records: what every reader yields.

A record is (source, source_id, fields, methods, file_ord, row_ord): fields is
a map of variants as the file has them, methods names how each field was
extracted, the ordinals keep input order. A reader also yields the files it
couldn't use, as (path, error), instead of failing.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.functions.normalize import fenced
from kinweld.operators.extract import resume_fields
from kinweld.sources import large_csv, large_json
from kinweld.sources.large_csv import HELD, header_names
from kinweld.sources.storage import spread

RECORD = "source string, source_id string, fields map<string,variant>, methods map<string,string>, file_ord int, row_ord bigint"


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/*\z", 1)


def listed(spark: SparkSession, paths: Sequence[str], only: Sequence[int] | None = None) -> DataFrame:
    """(file_ord, path, found) of the paths in order, or of some of them by
    number; found is the path as readers report it."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for k in range(len(paths)) if only is None else only:
        p = str(paths[k])
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        rows.append((k, p, at.getFileSystem(conf).makeQualified(at).toString()))
    return spark.createDataFrame(rows, "file_ord int, path string, found string")


def _contents(spark: SparkSession, paths: Sequence[str], only: Sequence[int] | None = None) -> DataFrame:
    """(file_ord, path, content) of existing files: one scan for all of them,
    one row each, so the plan doesn't grow with their number."""
    plain = F.regexp_replace("found", "^([a-z0-9]+:)/+", "$1/")
    names = listed(spark, paths, only).select("file_ord", F.col("path").alias("own"), plain.alias("found"))
    rows = spark.read.format("binaryFile").load(sorted({str(paths[k]) for k in (range(len(paths)) if only is None else only)})).select(F.regexp_replace("path", "^([a-z0-9]+:)/+", "$1/").alias("at"), "content")
    return rows.join(F.broadcast(names), F.col("at") == F.col("found")).select("file_ord", F.col("own").alias("path"), "content")


def _files(spark: SparkSession, paths: Sequence[str], only: Sequence[int] | None = None) -> DataFrame:
    """(file_ord, path, text) of existing files. Bytes that aren't UTF-8 give
    null."""
    return _contents(spark, paths, only).select("file_ord", "path", F.expr("try_validate_utf8(CAST(content AS STRING))").alias("text"))


def existing(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """Paths that the file system has, and (path, error) of the others."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there, gone = [], []
    for p in map(str, paths):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        (there.append(p) if at.getFileSystem(conf).exists(at) else gone.append((p, "no such file")))
    return there, gone


def parse_csv(text: str) -> tuple[list[dict[str, str]], str | None]:
    """Rows of a CSV text as their non-blank cells, or what is wrong with it.

    The first row names the columns; repeats get .1, .2, ... and names that
    are equal after stripping hold the last value. Rows without any character
    don't count. A row longer than the header spoils the file, as does a file
    without a header.
    """
    rows = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r]
    if not rows:
        return [], "no header"
    header = header_names(rows[0])
    out = []
    for k, row in enumerate(rows[1:], 2):
        if len(row) > len(header):
            return [], f"row {k} has {len(row)} cells, the header {len(header)}"
        out.append({h.strip(): v.strip() for h, v in zip(header, row, strict=False) if v.strip()})
    return out, None


def csv_records(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and bad files of (file_ord, path, text) with CSV texts. A row's
    id is the file's name and the number that the row has when the header is row 1."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for ordinal, path, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    rows, error = parse_csv(text) if text is not None else ([], "not UTF-8")
                except csv.Error as wrong:
                    rows, error = [], str(wrong)
                for k, r in enumerate(rows or [None]):
                    yield ordinal, path, k, None if r is None else list(r.items()), error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"file_ord": pa.int32(), "path": pa.string(), "row_ord": pa.int64(), "cells": pa.map_(pa.string(), pa.string()), "error": pa.string()}
        rows = rows_of(batches)
        while held := list(islice(rows, HELD)):
            yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for (n, t), c in zip(kinds.items(), zip(*held, strict=True), strict=True)})

    parsed = spread(files.select("file_ord", "path", "text")).mapInArrow(run, "file_ord int, path string, row_ord bigint, cells map<string,string>, error string")
    good = parsed.where("error IS NULL AND cells IS NOT NULL")
    return cell_records(good), parsed.where("error IS NOT NULL").select("path", "error").distinct()


def cell_records(rows: DataFrame) -> DataFrame:
    """Records of (file_ord, path, row_ord, cells)."""
    return rows.select(F.lit("csv").alias("source"), F.concat(basename(F.col("path")), F.lit(":"), F.col("row_ord") + 2).alias("source_id"), F.expr("transform_values(cells, (k, v) -> CAST(v AS variant))").alias("fields"), F.expr("transform_values(cells, (k, v) -> 'structured_column')").alias("methods"), "file_ord", "row_ord")


#: Bytes from which a CSV or JSON file is read by many tasks.
LARGE = 64 << 20


def sizes(spark: SparkSession, paths: Sequence[str]) -> list[int]:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(p)) for p in paths]
    return [p.getFileSystem(conf).getFileStatus(p).getLen() for p in at]


def read_csv(spark: SparkSession, paths: Sequence[str], large: int = LARGE) -> tuple[DataFrame, DataFrame]:
    """Records and bad files. Files are rows of one scan, but those of
    ``large`` bytes and more are read one after the other, each by many tasks."""
    big = {k for k, n in enumerate(sizes(spark, paths)) if n >= large}
    named = [str(p) for p in paths]
    parts, bad = [], []
    if len(big) < len(named):
        small = _files(spark, named, [k for k in range(len(named)) if k not in big])
        records, failed = csv_records(small)
        parts.append(records)
        bad.append(failed)
    for k in sorted(big):
        rows, error = large_csv.scan(spark, named[k])
        if error is None:
            parts.append(cell_records(rows.select(F.lit(k).alias("file_ord"), F.lit(named[k]).alias("path"), "row_ord", "cells")))
        else:
            bad.append(spark.createDataFrame([(named[k], error)], "path string, error string"))
    empty = parts[0] if parts else cell_records(spark.createDataFrame([], "file_ord int, path string, row_ord bigint, cells map<string,string>"))
    none = spark.createDataFrame([], "path string, error string")
    return reduce(DataFrame.unionByName, parts[1:], empty), reduce(DataFrame.unionByName, bad, none)


def scan_table_csv(spark: SparkSession, path: str) -> DataFrame:
    """Records of one large, well-formed CSV file or folder, read in splits.
    Ids count rows in file order, as far as the reader's splits keep it."""
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    cells = F.map_filter(F.create_map(*[x for c in rows.columns for x in (F.lit(c.strip()), F.trim(F.col(f"`{c}`")))]), lambda k, v: v.isNotNull() & (v != ""))
    numbered = rows.select(cells.alias("cells"), F.monotonically_increasing_id().alias("row_ord"))
    return numbered.select(F.lit("csv").alias("source"), F.concat(F.lit(path.rstrip("/").rsplit("/", 1)[-1] + ":"), F.col("row_ord") + 2).alias("source_id"), F.expr("transform_values(cells, (k, v) -> CAST(v AS variant))").alias("fields"), F.expr("transform_values(cells, (k, v) -> 'structured_column')").alias("methods"), F.lit(0).alias("file_ord"), "row_ord")


# SQL conditions on a variant.
def is_kind(v: str, kind: str) -> str:
    return f"coalesce(startswith(schema_of_variant({v}), '{kind}'), false)"


def truthy(v: str) -> str:
    return f"({v} IS NOT NULL AND NOT is_variant_null({v}) AND to_json({v}) NOT IN ('\"\"', '[]', '{{}}', '0', '0.0', 'false'))"


def _has_key(v: str, key: str) -> str:
    return f"({is_kind(v, 'OBJECT')} AND coalesce(map_contains_key(try_variant_get({v}, '$', 'map<string,variant>'), '{key}'), false))"


#: The list or object of items in the root v of a JSON file, as SQL.
INNER = f"CASE WHEN {_has_key('v', 'candidates')} THEN variant_get(v, '$.candidates') WHEN {_has_key('v', 'results')} THEN variant_get(v, '$.results') ELSE v END"


def explode_json(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and bad files of (path, file_ord, text) with JSON texts.

    The root is an object, a list, or an object whose ``candidates`` (or else
    ``results``) holds them. One item that isn't an object spoils the file, as does text
    behind the root.
    """
    root = spread(files).withColumn("v", fenced(F.expr(large_json.strict_json("text")))).withColumn("inner", fenced(F.expr(INNER)))
    items = f"CASE WHEN {is_kind('inner', 'ARRAY')} THEN try_variant_get(inner, '$', 'array<variant>') WHEN {is_kind('inner', 'OBJECT')} THEN array(inner) END"
    root = root.withColumn("items", fenced(F.expr(items)))
    root = root.withColumn("error", F.expr(f"CASE WHEN v IS NULL THEN 'not JSON' WHEN items IS NULL OR exists(items, x -> NOT {is_kind('x', 'OBJECT')}) THEN 'items must be objects' END"))
    good = root.where("error IS NULL").select("path", "file_ord", F.posexplode("items").alias("row_ord", "item"))
    return item_records(good), root.where("error IS NOT NULL").select("path", "error")


def item_records(items: DataFrame) -> DataFrame:
    """Records of (path, file_ord, row_ord, item) with objects as items."""
    good = items.withColumn("row_ord", F.col("row_ord").cast("bigint")).withColumn("fields", F.expr("try_variant_get(item, '$', 'map<string,variant>')"))
    pick = lambda k: f"CASE WHEN {truthy(f'try_element_at(fields, {chr(39)}{k}{chr(39)})')} THEN CAST(try_element_at(fields, '{k}') AS string) END"
    own = F.concat(basename(F.col("path")), F.lit(":"), F.col("row_ord") + 1)
    return good.select(F.lit("ats").alias("source"), F.coalesce(F.expr(pick("id")), F.expr(pick("candidate_id")), own).alias("source_id"), "fields", F.expr("transform_values(fields, (k, v) -> 'structured_json')").alias("methods"), "file_ord", "row_ord")


def read_ats(spark: SparkSession, paths: Sequence[str], large: int = LARGE) -> tuple[DataFrame, DataFrame]:
    """Records and bad files. Files are rows of one scan, but lists of
    ``large`` bytes and more are read one after the other, each by many tasks."""
    named = [str(p) for p in paths]
    whole, parts, bad = [], [], []
    for k, size in enumerate(sizes(spark, named)):
        items, error = large_json.scan(spark, named[k], size, INNER, is_kind) if size >= large else (None, None)
        if items is not None:
            parts.append(item_records(items.select(F.lit(named[k]).alias("path"), F.lit(k).alias("file_ord"), "row_ord", "item")))
        elif error is not None:
            bad.append((named[k], error))
        else:
            whole.append(k)
    failed = spark.createDataFrame(bad, "path string, error string")
    if whole or not parts:
        records, wrong = explode_json(_files(spark, named, whole) if whole else spark.createDataFrame([], "path string, file_ord int, text string"))
        parts.append(records)
        failed = failed.unionByName(wrong)
    return reduce(DataFrame.unionByName, parts), failed


def from_resume_texts(texts: DataFrame) -> DataFrame:
    """Records of (source_id, text, file_ord, row_ord); texts without a line
    that isn't blank give none."""
    lined = texts.where(F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"))
    return resume_fields(spread(lined)).select(F.lit("resume").alias("source"), "source_id", "fields", "methods", "file_ord", "row_ord")


@F.pandas_udf(T.StringType())
def pdf_text(contents):
    """Page texts of PDF files joined by line ends; null where unreadable."""
    import io as _io

    from pypdf import PdfReader

    def one(data: bytes) -> str | None:
        try:
            return "\n".join(page.extract_text() or "" for page in PdfReader(_io.BytesIO(data)).pages)
        except Exception:  # any damage makes the file a bad one
            return None

    return contents.map(one)


def have_pdf() -> bool:
    try:
        import pypdf  # noqa: F401
    except ImportError:
        return False
    return True


def read_resumes(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records and bad files of .txt and .pdf resumes, by suffix in any case."""
    order = [str(p) for p in paths]
    text = [p for p in order if p.lower().endswith(".txt")]
    pdf = [p for p in order if p.lower().endswith(".pdf")]
    bad = [(p, "resume must be a .txt or .pdf file") for p in order if not p.lower().endswith((".txt", ".pdf"))]
    frames = []
    if text:
        frames.append(_files(spark, text))
    if pdf and have_pdf():
        frames.append(_contents(spark, pdf).select("file_ord", "path", pdf_text("content").alias("text")))
    else:
        bad += [(p, "no PDF library") for p in pdf]
    failed = spark.createDataFrame(bad, "path string, error string")
    if not frames:
        return spark.createDataFrame([], RECORD.replace("variant", "string")).selectExpr("source", "source_id", "transform_values(fields, (k, v) -> CAST(v AS variant)) fields", "methods", "file_ord", "row_ord"), failed
    places = spark.createDataFrame(list(enumerate(order)), "place int, named string")
    files = reduce(DataFrame.unionByName, frames).join(F.broadcast(places), F.col("path") == F.col("named")).select("path", "text", F.col("place").alias("file_ord")).distinct()
    empty = files.where(F.col("text").isNull() | ~F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"))
    failed = failed.unionByName(empty.select("path", F.lit("no extractable text").alias("error")))
    texts = files.where("text IS NOT NULL").select(basename(F.col("path")).alias("source_id"), "text", "file_ord", F.lit(0).cast("bigint").alias("row_ord"))
    return from_resume_texts(texts), failed
