"""Tables in the shared folder that cut lineage between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, the folder that all executors share.

    Where it is unset, a session on one machine gets a temporary folder; on a
    cluster that would scatter the files, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="kinweld-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialized(df: DataFrame, **measures: Column) -> DataFrame:
    """``df`` written once and read back, so later steps neither recompute it
    nor depend on executors that may be lost.

    ``measures`` are aggregates that the write itself takes, without a scan of
    their own; ``kinweld_measures`` of the result has their values. They are
    taken in the tasks that write, so a task that is repeated counts once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinweld/{uuid.uuid4().hex}"
    seen = Observation()
    observed = df.observe(seen, *[c.alias(name) for name, c in measures.items()]) if measures else df
    observed.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.kinweld_path = path
    back.kinweld_measures = dict(seen.get) if measures else {}
    return back


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over four tasks a core or more, in no order.

    Scans cut files at their row groups, and small files have one: without
    this, all work on the rows of a small file is done by one task.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.kinweld_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
