"""Substring deduplication by sliding sentence spans.

A text is cut into sentences (after . ! ? … before white space, and at line
ends). Every run of ``LEAST`` consecutive sentences that have words is
hashed, to 96 bits, and so is every sentence of ``LONG_WORDS`` words by itself.
A longer run needs no row of its own: where it stands for a second time, so
does each shorter run in it, and the shorter runs cover all its sentences, so
what is covered is exactly what hashing the runs of every length would cover.
Spans are joined globally; of equal ones the first is that with the smallest
doc_id, then the smallest checksum of the text, then position. Sentences
under any other are repeats, within a document too. Neighbouring repeats make
a passage, and a passage goes if it has ``LEAST_WORDS`` words or more: single
phrases that people repeat stay, unless that parameter is lowered to 1.

Spans are written once. Keys are counted by partial aggregation, only
repeated ones are sent back to the spans, and keys with more than a
thousandth of the rows (fewer than 1,000 can be) are broadcast, so a span in
a third of all documents is marked where its rows are and no task gathers it.
Only a document's own spans ever meet.

Null texts count as empty and have no sentence. Rows with a null doc_id take
no part and keep their text. Rows that repeat a doc_id and its text are one
document and lose the same sentences; rows that repeat a doc_id with another
text are documents of their own. An empty table gives an empty result;
other columns pass through :func:`clean` unchanged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.llm.common import discard, fresh, hot_rows, mix64, released, slices, str_texts, table, written

LEAST = 2
LONG_WORDS = 50
LEAST_WORDS = 15
#: What ends a sentence, with the white space behind it.
END = re.compile(r"(?<![.!?…])[.!?…]++[\"')\]»”]*+(?:\s++|\Z)|\n\s*+")
#: A span: its hash, its document, its first and last sentence, and whether it
#: stands earlier in the same document.
SPANS = "h long, g int, doc_id long, crc long, pos int, last int, again boolean"


def sentences_of(text: str) -> list[str]:
    """The sentences of a text; joined they are the text."""
    ends = [m.end() for m in END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False) if a < b]


def spans_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(index of the text, position, last sentence, hash, rest of the hash,
    whether it stands earlier in the text) of every span."""
    owner, place, size, high, low = [], [], [], [], []
    for k, text in enumerate(texts):
        for at, sentence in enumerate(sentences_of(text)):
            if words := sentence.split():
                digest = xxhash.xxh3_128_intdigest(" ".join(words).encode("utf-8", "replace"))
                owner.append(k)
                place.append(at)
                size.append(len(words))
                high.append(digest >> 64)
                low.append(digest & 0xFFFFFFFFFFFFFFFF)
    owner, place, size = (np.array(x, np.int64) for x in (owner, place, size))
    parts = np.array(high, np.uint64), np.array(low, np.uint64)
    n = max(0, len(owner) - LEAST + 1)
    runs = np.flatnonzero(owner[:n] == owner[LEAST - 1 :])
    long = np.flatnonzero(size >= LONG_WORDS)
    hashes = []
    with np.errstate(over="ignore"):
        for part in parts:
            h = np.full(len(runs), LEAST, np.uint64)
            for k in range(LEAST):
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + part[runs + k])
            hashes.append(np.concatenate([h, mix64(part[long])]))
    at, last = np.concatenate([runs, long]), np.concatenate([runs + LEAST - 1, long])
    order = np.lexsort((place[at], hashes[1], hashes[0], owner[at]))
    same = np.ones(max(0, len(order) - 1), bool)
    for x in (owner[at], *hashes):
        same &= x[order][1:] == x[order][:-1]
    again = np.zeros(len(order), bool)
    again[order[1:][same]] = True
    return owner[at], place[at], place[last], hashes[0], hashes[1], again


def cut(text: str, repeats: list[tuple[int, int]], least_words: int) -> tuple[str, int, int]:
    """(text without its repeated passages, sentences and words removed)."""
    sentences = sentences_of(text)
    size = [len(s.split()) for s in sentences]
    gone = [False] * len(sentences)
    for pos, last in repeats:
        gone[pos : last + 1] = [True] * (last + 1 - pos)
    start, words = 0, 0
    for k in range(len(sentences) + 1):
        if k < len(sentences) and gone[k]:
            words += size[k]
            continue
        if words < least_words:
            gone[start:k] = [False] * (k - start)
        start, words = k + 1, 0
    left = "".join(s for s, g in zip(sentences, gone, strict=True) if not g)
    return left, sum(g and n > 0 for g, n in zip(gone, size, strict=True)), sum(n for g, n in zip(gone, size, strict=True) if g)


def spans(docs: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in SPANS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = str_texts(batch)
                crc = np.fromiter((zlib.crc32(t.encode("utf-8", "replace")) for t in texts), np.int64, len(texts))
                owner, pos, last, high, low, again = spans_of(texts)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                columns = (high.view(np.int64), (low >> np.uint64(32)).astype(np.uint32).view(np.int32), ids[owner], crc[owner], pos.astype(np.int32), last.astype(np.int32), again)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    narrow = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(released(run), SPANS)


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, crc of the text, and the (pos, last) of its repeated spans."""
    base = written(spans(docs))
    # Documents in order, as one number: the id, then the checksum.
    order = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("crc").cast("decimal(10,0)")
    found = base.withColumn("o", order.cast("decimal(38,0)"))
    keys = found.where("NOT again").groupBy("h", "g").agg(F.min("o").alias("low"), F.max("o").alias("high"), F.count(F.lit(1)).alias("n"))
    keys = written(keys.where("low < high").select(F.col("h").alias("h2"), F.col("g").alias("g2"), "low", "n"))
    most = hot_rows(base.count())
    same = (F.col("h") == F.col("h2")) & (F.col("g") == F.col("g2"))
    hot, rest = keys.where(F.col("n") > most).drop("n"), keys.where(F.col("n") <= most).drop("n")
    split = found.where("NOT again").join(F.broadcast(hot), same, "left")
    marked = split.where("o > low")
    cold = split.where("low IS NULL").drop("h2", "g2", "low").join(rest.hint("shuffle_hash"), same).where("o > low")
    place = ["doc_id", "crc", "pos", "last"]
    later = found.where("again").select(place).unionByName(marked.select(place)).unionByName(cold.select(place))
    marks = written(later.groupBy("doc_id", "crc").agg(F.collect_set(F.struct("pos", "last")).alias("spans")))
    discard(base, keys)
    return marks


def clean(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with repeated passages of ``least_words`` words or more cut out
    of ``text``, plus the columns n_removed (sentences) and words_removed
    (under other names if taken)."""
    i, c, s = (fresh(docs, f"cut_{x}") for x in ("id", "crc", "spans"))
    counts = [fresh(docs, n) for n in ("n_removed", "words_removed")]
    marks = repeats(docs).toDF(i, c, s)
    own = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    joined = docs.join(marks.hint("shuffle_hash"), (F.col("doc_id") == F.col(i)) & (own == F.col(c)), "left").select(*docs.columns, s)
    schema = T.StructType([*docs.schema, *(T.StructField(n, T.LongType()) for n in counts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                marked = batch.column(batch.num_columns - 1).to_pylist()
                at = batch.schema.get_field_index("text")
                texts = batch.column(at).to_pylist()
                cuts = [cut(t, [(m["pos"], m["last"]) for m in ms], least_words) if t and ms else (t, 0, 0) for t, ms in zip(texts, marked, strict=True)]
                columns = batch.columns[:-1]
                columns[at] = pa.array([x[0] for x in cuts], batch.schema.field(at).type)
                columns += [pa.array([x[k] for x in cuts], pa.int64()) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, names=[*docs_columns, *counts])

    docs_columns = docs.columns
    return joined.mapInArrow(released(run), schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
