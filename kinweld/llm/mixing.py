"""Mixing sources to target weights along a time-varying curriculum.

A document's size is its number of words. Sources in code point order (null
last) weigh 1, 2, 3, 1, 2, 3, ... and share the size of the whole corpus;
none gets more than ``MOST`` times its own size, the excess goes to the
others by weight (water filling, in closed form over the sources sorted by
cap per weight).

Each source's weight over training time t in [0, 1] is a ramp
``w * (1 + s * (2t - 1))``. Its integral, the cumulative demand for the
source's words, is ``target * ((1 - s) * t + s * t * t)``. Documents of a
source stand in a fixed shuffled order (md5 of the id, then the id, the size
and the checksum of the text), repeated from the start when demand exceeds the
source. A copy's position is the time at which demand reaches its middle, by
the inverse of that integral; it is taken if it has one, which demand reaches
within training. Documents are range-sorted by position.

The running sum inside a source is a sum over equal slices of the md5 range,
then a running sum inside each slice, so a source with a third of all rows is
spread like any other. Running sums over sources, which may be many, are taken
inside range partitions and then over one row a partition. Nulls: a null text
has no words, a null source is a source of its own, a null id sorts by the md5
of ''. Texts without a word are never taken; their position is null. Rows with
equal ids, sizes and checksums follow each other in any order and can't be
told apart. An empty table gives an empty mix. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweld.llm.common import fresh, table, written

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
#: Slope of the ramp of each weight class.
RAMPS = (-0.5, 0.0, 0.5)
#: Documents in a slice of the md5 range, about, and the most slices: their
#: sums are added up in one task for each source.
SLICE_ROWS, SLICES = 2_000, 20_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def slice_of(key: Column, slices: int) -> Column:
    """Slices of the md5 range, ascending with the key."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(head * F.lit(slices).cast("long"), 32)


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with, for each name in ``sums``, the sum of that column over all
    rows before this one in ``order``. Rows are dealt into range partitions;
    only one row of totals a partition ever meets in one task."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(df.repartitionByRange(parts, *order).withColumn("run_part", F.spark_partition_id()))
    totals = placed.groupBy("run_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = W.partitionBy(F.lit(0)).orderBy("run_part").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    totals = totals.select(F.col("run_part").alias("run_of"), *[F.coalesce(F.sum(n).over(earlier), zero).alias(f"run_{n}") for n in sums])
    inside = W.partitionBy("run_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = placed.withColumns({n: F.coalesce(F.sum(c).over(inside), zero) for n, c in sums.items()})
    joined = summed.join(F.broadcast(totals), F.col("run_part") == F.col("run_of"))
    return joined.withColumns({n: F.col(n) + F.col(f"run_{n}") for n in sums}).drop("run_part", "run_of", *[f"run_{n}" for n in sums])


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size, weight, ramp, target from (source, source_size)."""
    s = running(sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"nth": "one"})
    s = s.withColumn("weight", F.col("nth") % 3 + 1).withColumn("cap", F.col("source_size") * MOST)
    s = written(running(s, [F.col("cap") / F.col("weight"), F.col("nth")], {"cap_before": "cap", "weight_before": "weight"}))
    big = lambda c: c.cast("decimal(38,0)")
    total, weights = map(F.lit, s.agg(F.sum("source_size"), F.sum("weight")).first())
    s = s.withColumn("free", big(total - F.col("cap_before")) * big(F.col("weight")) <= big(F.col("cap")) * big(weights - F.col("weight_before")))
    left, used = map(F.lit, s.where("free").agg(F.min("cap_before"), F.min("weight_before")).first())
    share = (total - left).cast("double") * F.col("weight").cast("double") / (weights - used).cast("double")
    ramp = F.element_at(F.array(*map(F.lit, RAMPS)), F.col("weight").cast("int"))
    return s.select("source", "source_size", "weight", ramp.alias("ramp"), F.when(F.col("free"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def position_at(share: Column, ramp: Column) -> Column:
    """The time at which cumulative demand reaches this share of the target:
    the inverse of ``(1 - s) * t + s * t * t``; null if training ends first."""
    root = F.sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * share)
    return F.when(share <= 1, F.when(ramp == 0, share).otherwise((ramp - 1 + root) / (2 * ramp)))


#: The columns that a plan adds.
PLAN = ("size", "source_size", "target", "ramp", "middle")


def plan(rows: DataFrame, sizes: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` (with columns named by names: key, size, slice, check, and doc_id,
    source) plus the columns of PLAN, under their names; middle is the demand
    at a document's middle. ``sizes`` has source, slice and size of every
    document, for the sums."""
    spread = sizes.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    aim = targets(spread.groupBy("source").agg(F.sum("words").alias("source_size")))
    before = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    spread = spread.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")))
    n = names
    spread = spread.alias("x").join(aim.alias("y"), F.col("x.source").eqNullSafe(F.col("y.source")))
    spread = spread.select(F.col("x.source").alias(n["src"]), F.col("x.slice").alias(n["part"]), F.col("x.before").alias(n["before"]), F.col("y.source_size").alias(n["source_size"]), F.col("y.ramp").alias(n["ramp"]), F.col("y.target").alias(n["target"]))
    joined = rows.join(spread, F.col("source").eqNullSafe(F.col(n["src"])) & (F.col(n["slice"]) == F.col(n["part"])))
    order = [F.col(n["key"]), F.col("doc_id").asc_nulls_last(), F.col(n["size"]), F.col(n["check"])]
    inside = W.partitionBy("source", n["slice"]).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    begins = F.col(n["before"]) + F.coalesce(F.sum(n["size"]).over(inside), F.lit(0).cast("long"))
    middle = F.when(F.col(n["size"]) > 0, begins + F.col(n["size"]).cast("double") / 2)
    return joined.withColumn(n["middle"], middle).drop(n["src"], n["part"], n["before"])


def position_of(lap: Column | int, n: dict[str, str]) -> Column:
    """Position of a document's copy in the given lap over its source, null
    if it isn't taken."""
    share = (F.col(n["middle"]) + lap * F.col(n["source_size"])) / F.col(n["target"])
    return position_at(share, F.col(n["ramp"]))


def _names(docs: DataFrame) -> dict[str, str]:
    return {k: fresh(docs, f"mix_{k}") for k in ("key", "slice", "check", "src", "part", "before", *PLAN)}


def checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def measured(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, source, size, check, key, slice of every document, written
    durably, and the number of slices."""
    text = F.col("text")
    found = written(docs.select("doc_id", "source", size_of(text).alias("size"), checksum(text).alias("check"), order_key(F.col("doc_id")).alias("key")))
    slices = min(SLICES, max(1, -(-found.count() // SLICE_ROWS)))
    return found.withColumn("slice", slice_of(F.col("key"), slices)), slices


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words,
    with repeats), and position, that of its first copy (null if none is
    taken); range-sorted by position."""
    rows, _ = measured(docs)
    names = {k: k for k in ("key", "slice", "check", "src", "part", "before", *PLAN)}
    planned = plan(rows, rows, names)
    copies = sum((position_of(lap, names).isNotNull().cast("long") for lap in range(MOST)), F.lit(0).cast("long"))
    found = planned.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), position_of(0, names).alias("position"), "key")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("position").asc_nulls_last(), F.col("key")]
    return found.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("key")


def mix(docs: DataFrame, position: str | None = None) -> DataFrame:
    """The mix itself: one row per copy taken, with the columns of ``docs``,
    range-sorted by training position, which goes to the column ``position``
    if that is named."""
    sizes, slices = measured(docs)
    n = _names(docs)
    text = F.col("text")
    rows = docs.withColumns({n["size"]: size_of(text), n["check"]: checksum(text), n["key"]: order_key(F.col("doc_id"))})
    rows = rows.withColumn(n["slice"], slice_of(F.col(n["key"]), slices))
    planned = plan(rows, sizes, n)
    lap, at = fresh(planned, "mix_lap"), fresh(planned, "mix_at")
    copies = planned.withColumn(lap, F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    placed = copies.withColumn(at, position_of(F.col(lap), n)).where(F.col(at).isNotNull())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(at), F.col(n["key"]), F.col(lap)]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ordered.select(*docs.columns, *([F.col(at).alias(position)] if position else []))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS nth
  FROM s),
b AS (
  SELECT *,
         CAST(coalesce(sum(cap) OVER r, 0) AS BIGINT) AS cap_before,
         CAST(coalesce(sum(weight) OVER r, 0) AS BIGINT) AS weight_before,
         CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights
  FROM w
  WINDOW r AS (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (
  SELECT *, (total - cap_before)::HUGEINT * weight <= cap::HUGEINT * (weights - weight_before) AS free FROM b),
t AS (
  SELECT source, source_size, weight,
         CASE WHEN free THEN
           CAST(total - min(cap_before) FILTER (free) OVER () AS DOUBLE) * CAST(weight AS DOUBLE)
             / CAST(weights - min(weight_before) FILTER (free) OVER () AS DOUBLE)
         ELSE CAST(cap AS DOUBLE) END AS target
  FROM f),
c AS (
  SELECT doc_id, size, source_size, target, CASE weight WHEN 1 THEN -0.5::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS ramp,
         CASE WHEN size > 0 THEN CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + CAST(size AS DOUBLE) / 2 END AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, list_transform([(middle + 0 * source_size) / target, (middle + 1 * source_size) / target, (middle + 2 * source_size) / target],
    lambda share: CASE WHEN share > 1 THEN NULL WHEN ramp = 0 THEN share ELSE (ramp - 1 + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * share)) / (2 * ramp) END) AS ps
  FROM c)
SELECT doc_id, size, source_size, target, CAST(size * len(list_filter(ps, lambda x: x IS NOT NULL)) AS BIGINT) AS taken, ps[1] AS position FROM p
"""
