"""Exact deduplication against an index of known digests.

Texts are equal when their characters other than ASCII blanks are. The index
of a corpus is cut into buckets by digest; each bucket has a minimal perfect
hash over its distinct digests, whose slots hold the full digest and the
locator of the winner (length, doc_id). Newcomers are first reduced to one
row per digest on the map side, so a group of any number of copies costs one
row per task. Each is then looked up: the slot's digest is compared byte by
byte, members join the known group, nonmembers make groups of their own.

Of equal texts the row with the most code points in the original text stays,
then the smallest doc_id (a null doc_id comes last). Null and empty texts are
equal. Rows that repeat a doc_id and its text are counted in group_size; the
report marks them all like the winner, :func:`keep` leaves one of them, chosen
by a hash of all its columns. Other columns never enter the comparison and pass
through :func:`keep` unchanged. Groups with more than a thousandth of all rows
(fewer than 1,000 can be) are broadcast to their rows, the others are joined.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import BLANK, any_row, fresh, hot_rows, id_remainder, join_hot, table, written

#: Digests in a bucket, about: a bucket is built and read in one task.
BUCKET_DIGESTS = 50_000
GROUP = "digest binary, n_chars int, null_id boolean, keep_id long, copies long"
INDEX = "bucket long, sizes binary, bits binary, digests binary, n_chars binary, null_id binary, keep_id binary, copies binary"
GAMMA = 1.5


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 without ASCII blanks, as 32 bytes."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK + "+", "")
    return F.unhex(F.sha2(bare.cast("binary"), 256))


def groups_of(digests: DataFrame) -> DataFrame:
    """One row per digest: the winner and the number of rows. Partial
    aggregation leaves one row per digest and task before the shuffle."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"))).alias("b")
    grouped = digests.groupBy("digest").agg(best, F.count(F.lit(1)).alias("copies"))
    return grouped.select("digest", (-F.col("b.n")).cast("int").alias("n_chars"), F.col("b.z").alias("null_id"), F.col("b.d").cast("long").alias("keep_id"), "copies")


# --- minimal perfect hash -------------------------------------------------


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Slot of each key at a level: a mix of its first two words."""
    with np.errstate(over="ignore"):
        x = keys[:, 0] ^ (keys[:, 1] * np.uint64(2 * level + 1))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def _keys(digests: list[bytes] | np.ndarray) -> np.ndarray:
    flat = digests if isinstance(digests, np.ndarray) else np.frombuffer(b"".join(digests), np.uint8)
    return flat.reshape(-1, 32).view(np.uint64)


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(size of each level, bits of all levels) of a minimal perfect hash.

    A level keeps the keys that are alone in their slot and hands the others
    to the next; a key's number is the count of set bits before its own.
    """
    sizes, bits, left = [], [], np.arange(len(keys))
    while len(left):
        if len(sizes) > 500:
            raise ValueError("digests are not distinct")
        size = max(64, int(GAMMA * len(left)))
        at = _place(keys[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool)


def find_slots(keys: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Slot of each key: exact for members, for others any slot or -1."""
    rank = np.cumsum(bits) - 1
    slots, open_, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = start + _place(keys[open_], level, int(size))
        hit = bits[at]
        slots[open_[hit]] = rank[at[hit]]
        open_, start = open_[~hit], start + int(size)
    return slots


def _build_bucket(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    digests = np.frombuffer(b"".join(part["digest"]), np.uint8).reshape(-1, 32)
    sizes, bits = build_hash(_keys(digests))
    slots = find_slots(_keys(digests), sizes, bits)
    order = np.empty(len(slots), np.int64)
    order[slots] = np.arange(len(slots))

    def dealt(column: str, kind: str) -> bytes:
        return part[column].to_numpy()[order].astype(kind).tobytes()

    part["keep_id"] = part["keep_id"].fillna(0)
    return pd.DataFrame([{"bucket": key[0], "sizes": sizes.tobytes(), "bits": np.packbits(bits).tobytes(), "digests": digests[order].tobytes(), "n_chars": dealt("n_chars", "<i4"), "null_id": dealt("null_id", "u1"), "keep_id": dealt("keep_id", "<i8"), "copies": dealt("copies", "<i8")}])


def _look_up(newcomers: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Groups of one bucket after the newcomers, one row a digest, have been
    looked up in it: members raise their slot's count and may win it."""
    columns = ["digest", "n_chars", "null_id", "keep_id", "copies"]
    if index.empty:
        return newcomers[columns]
    row = index.iloc[0]
    sizes = np.frombuffer(row["sizes"], np.int64)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
    held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
    n_chars, null_id, keep_id, copies = (np.frombuffer(row[c], kind).copy() for c, kind in (("n_chars", "<i4"), ("null_id", "u1"), ("keep_id", "<i8"), ("copies", "<i8")))
    member = np.zeros(len(newcomers), bool)
    if len(newcomers):
        keys = np.frombuffer(b"".join(newcomers["digest"]), np.uint8).reshape(-1, 32)
        at = find_slots(_keys(keys), sizes, bits)
        member = at >= 0
        member[member] = (held[at[member]] == keys[member]).all(axis=1)
        at, found = at[member], newcomers.loc[member]
        copies[at] += found["copies"].to_numpy(np.int64)
        n, null, own = found["n_chars"].to_numpy(np.int32), found["null_id"].to_numpy(bool).astype(np.uint8), found["keep_id"].fillna(0).to_numpy(np.int64)
        wins = (n > n_chars[at]) | ((n == n_chars[at]) & ((null < null_id[at]) | ((null == null_id[at]) & (own < keep_id[at]))))
        for values, new in ((n_chars, n), (null_id, null), (keep_id, own)):
            values[at[wins]] = new[wins]
    ids = pd.array(keep_id, dtype="Int64")
    ids[null_id == 1] = pd.NA
    slots = pd.DataFrame({"digest": [d.tobytes() for d in held], "n_chars": n_chars, "null_id": null_id.astype(bool), "keep_id": ids, "copies": copies})
    return pd.concat([slots, newcomers.loc[~member, columns]]) if not member.all() else slots


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    head = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    return groups.withColumn("bucket", head % buckets)


def build_index(groups: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: its perfect hash and slots, written durably."""
    return written(_bucketed(groups, buckets).groupBy("bucket").applyInPandas(_build_bucket, INDEX))


def look_up(groups: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """All groups after adding ``groups`` to the index."""
    left = _bucketed(groups, buckets).groupBy("bucket")
    return left.cogroup(index.groupBy("bucket")).applyInPandas(_look_up, GROUP)


def resolve(digests: DataFrame, known: Column) -> DataFrame:
    """The groups of ``digests``: rows where ``known`` holds are the corpus
    that is indexed, the others arrive after it."""
    rows = digests.count()
    buckets = max(1, -(-rows // BUCKET_DIGESTS))
    index = build_index(groups_of(digests.where(known)), buckets)
    return look_up(groups_of(digests.where(~known)), index, buckets)


def digests_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"), F.length(F.coalesce("text", F.lit(""))).alias("n_chars"))


def in_history(column: str = "doc_id") -> Column:
    """Deals documents into the corpus that came first and the newcomers."""
    return id_remainder(column, 2) == 0


def report(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    digests = written(digests_of(docs))
    groups = written(resolve(digests, in_history())).select(F.col("digest").alias("g"), "keep_id", F.col("copies").alias("group_size"))
    joined = join_hot(digests, groups, F.col("digest") == F.col("g"), F.col("group_size") > hot_rows(digests.count()))
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    digests = written(digests_of(docs))
    groups = written(resolve(digests, in_history())).select(F.col("digest").alias("g"), F.col("n_chars").alias("most"), "keep_id", "copies")
    winners = digests.groupBy("digest", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("rows"))
    same = (F.col("digest") == F.col("g")) & (F.col("n_chars") == F.col("most")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    best = join_hot(winners, groups, same, F.col("copies") > hot_rows(digests.count()))
    d, k, i, n, r = (fresh(docs, f"dedup_{x}") for x in "dkinr")
    best = best.select("digest", "doc_id", "n_chars", "rows").toDF(k, i, n, r)
    marked = docs.withColumn(d, digest_of(F.col("text")))
    same = (F.col(d) == F.col(k)) & F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (F.length(F.coalesce("text", F.lit(""))) == F.col(n))
    found = marked.join(best.hint("shuffle_hash"), same)
    single = found.where(F.col(r) == 1).select(*docs.columns)
    repeated = any_row(found.where(F.col(r) > 1), d).select(*docs.columns)
    return single.unionByName(repeated)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS n
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
