"""Sources of one's own: a parser function becomes a data source.

A parser takes a path and yields (source_id, fields, methods); it may raise to
reject the file. Files are parsed in parallel, one partition each.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kinweld.functions.tables import SOURCE_RANK

Parser = Callable[[str], Iterable[tuple[str, dict[str, Any], dict[str, str]]]]
ROWS = "path string, file_ord int, row_ord bigint, source_id string, fields string, methods string, error string"


class File(InputPartition):
    def __init__(self, ordinal: int, path: str) -> None:
        self.ordinal, self.path = ordinal, path


def register(spark: SparkSession, name: str, parse: Parser) -> None:
    """Make ``parse`` readable as format ``name``."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]) -> None:
            self.paths = json.loads(options["files"])

        def partitions(self) -> Sequence[InputPartition]:
            return [File(k, p) for k, p in enumerate(self.paths)]

        def read(self, partition: File) -> Iterator[tuple]:
            at = (partition.path, partition.ordinal)
            try:
                rows = list(parse(partition.path))
            except Exception as wrong:  # whatever a parser raises rejects its file only
                yield (*at, 0, None, None, None, str(wrong) or type(wrong).__name__)
                return
            for k, (source_id, fields, methods) in enumerate(rows):
                yield (*at, k, source_id, json.dumps(fields), json.dumps(methods), None)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ROWS

        def reader(self, schema) -> DataSourceReader:
            return Reader(dict(self.options))

    spark.dataSource.register(Source)


def read(spark: SparkSession, name: str, source: str, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records under the label ``source`` and bad files of a registered format."""
    if source not in SOURCE_RANK:
        raise ValueError(f"unknown source {source!r}")
    rows = spark.read.format(name).option("files", json.dumps([str(p) for p in paths])).load()
    good = rows.where("error IS NULL")
    records = good.select(F.lit(source).alias("source"), "source_id", F.parse_json("fields").cast("map<string,variant>").alias("fields"), F.from_json("methods", "map<string,string>").alias("methods"), "file_ord", "row_ord")
    return records, rows.where("error IS NOT NULL").select("path", "error")
