"""Incremental ingestion: new files are mapped as they arrive.

Parsing and mapping need one record at a time, so they run as a stream.
Matching needs all profiles, so each micro-batch adds its mapped profiles to a
table and people are fused from the table whenever that is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinweld.operators.mapping import map_records
from kinweld.plans.engine import Engine
from kinweld.sources.records import explode_json
from kinweld.sources.storage import materialized


def profile_stream(spark: SparkSession, folder: str, engine: Engine) -> DataFrame:
    """Mapped profiles of the JSON files that arrive in ``folder``."""
    files = spark.readStream.option("wholetext", True).text(folder)
    named = files.select(F.col("_metadata.file_path").alias("path"), F.lit(0).alias("file_ord"), F.col("value").alias("text"))
    return map_records(explode_json(named)[0], engine.countries, engine.region)


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, engine: Engine) -> StreamingQuery:
    """Add the profiles of what has arrived to the Parquet folder ``table``;
    each file once, across restarts."""
    stream = profile_stream(spark, folder, engine)
    return stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def people(spark: SparkSession, table: str, engine: Engine) -> DataFrame:
    """Canonical profiles of all that has been ingested. Profiles are written
    once with their ids, so files that arrive meanwhile don't shift them."""
    profiles = materialized(spark.read.parquet(table).withColumn("id", F.monotonically_increasing_id()))
    return engine.fuse(profiles.where("valid").drop("valid", "reason"))
