"""The whole way from files to validated output."""

from __future__ import annotations

import json
import logging
import os
import tempfile
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.functions.normalize import country_table
from kinweld.operators.mapping import map_records
from kinweld.operators.matching import check_threshold, match
from kinweld.operators.merging import distinct_evidence, merge, ordered
from kinweld.operators.merging import provenance as gathered
from kinweld.operators.projection import ProjectionConfig, json_rows, renormalized
from kinweld.operators.schema import load_schema
from kinweld.operators.scoring import canonical, score
from kinweld.operators.validation import profile_schema, validate_canonical, validate_projected
from kinweld.sources.records import existing, read_ats, read_csv, read_resumes
from kinweld.sources.storage import materialized

log = logging.getLogger(__name__)


class PipelineError(ValueError):
    """There is nothing to work on."""


@dataclass
class Loaded:
    """Records of all inputs and what had to be left out."""

    records: DataFrame
    bad_files: DataFrame

    def counts(self) -> DataFrame:
        """Number of records of each file: source, file_ord, n."""
        return self.records.groupBy("source", "file_ord").agg(F.count(F.lit(1)).alias("n"))


#: Sources in the order in which they are read.
KINDS = ("csv", "resume", "ats")
#: Files of one kind that can be numbered before those of the next.
KIND = 1 << 40
#: Rejected inputs that are named in the log; tables have all of them.
SHOWN = 20


def _report(what: str, rejected: DataFrame, name: str, number: int) -> None:
    for row in rejected.orderBy(name).limit(SHOWN).collect() if number else ():
        log.warning("%s skipped: %s: %s", what, row[name], row["error"])
    if number > SHOWN:
        log.warning("%d %ss skipped in all", number, what)


def fan_in(read: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Records and bad files of several readers, numbered in their order."""
    records = [r.withColumn("file_ord", F.col("file_ord").cast("bigint") + kind * KIND) for kind, (r, _) in enumerate(read)]
    return reduce(DataFrame.unionByName, records), reduce(DataFrame.unionByName, [b for _, b in read])


class Engine:
    """Settings and the steps, each usable by itself. ``metrics`` has the
    numbers of what the last run of each step wrote, taken by those writes."""

    def __init__(self, spark: SparkSession, phone_region: str = "US", name_threshold: float = 90.0, schema: str | None = None) -> None:
        self.spark, self.region = spark, phone_region.upper()
        self.schema = load_schema(spark, schema) if schema else profile_schema()
        self.threshold = check_threshold(name_threshold)
        self.countries = country_table(spark)
        self.metrics: dict[str, int] = {}

    def load(self, csv: Iterable[str] = (), resumes: Iterable[str] = (), ats: Iterable[str] = ()) -> Loaded:
        """Records of all files, in the order CSV, resumes, ATS. Files that
        can't be used are reported, not fatal: ``bad_files`` has all of them."""
        read, missing = [], []
        for reader, paths in ((read_csv, csv), (read_resumes, resumes), (read_ats, ats)):
            there, gone = existing(self.spark, list(paths))
            missing += gone
            if there:
                read.append(reader(self.spark, there))
        absent = self.spark.createDataFrame(missing, "path string, error string")
        records, bad = fan_in(read) if read else (None, absent.limit(0))
        bad_files = self._written(absent.unionByName(bad), bad_files=F.count(F.lit(1)))
        _report("input", bad_files, "path", self.metrics["bad_files"])
        if records is None:
            raise PipelineError("none of the inputs could be read")
        loaded = Loaded(self._written(records, records=F.count(F.lit(1)), **{f"records_{s}": F.count_if(F.col("source") == s) for s in KINDS}), bad_files)
        for kind in KINDS:
            log.info("%d %s records", self.metrics[f"records_{kind}"], kind)
        return loaded

    def _written(self, df: DataFrame, **measures: Column) -> DataFrame:
        back = materialized(df, **measures)
        self.metrics |= back.kinweld_measures
        return back

    def mapped(self, records: DataFrame) -> DataFrame:
        """Mapped profiles of written records with an id, written once."""
        mapped = map_records(records, self.countries, self.region)
        return self._written(mapped.withColumn("id", F.monotonically_increasing_id()), mapped=F.count_if("valid"), rejected=F.count_if(~F.col("valid")))

    def profiles_of(self, records: DataFrame) -> DataFrame:
        """Valid profiles. ``rejected`` keeps the records that can't be mapped,
        with the reason."""
        mapped = self.mapped(records)
        self.rejected = mapped.where("NOT valid").select("source", "source_id", F.col("reason").alias("error"))
        _report("record", self.rejected, "source_id", self.metrics["rejected"])
        return mapped.where("valid").drop("valid", "reason")

    def fuse(self, profiles: DataFrame, provenance: bool = True) -> DataFrame:
        """Canonical profiles, one per person. ``provenance`` puts all evidence
        of a person into the person's row, so that it must fit in a task;
        without, rows have the names of its fields, and ``evidence`` has it as
        rows, by candidate_id."""
        groups = match(profiles, self.threshold).withColumnRenamed("id", "member")
        placed = profiles.join(groups, F.col("id") == F.col("member")).withColumn("person", F.col("component")).drop("member", "component")
        return self.finished(placed, provenance)

    def finished(self, placed: DataFrame, provenance: bool = True) -> DataFrame:
        """:meth:`fuse` of profiles with a column person."""
        scored, evidence = score(merge(placed)), distinct_evidence(ordered(placed))
        if provenance:
            return canonical(scored.join(gathered(evidence), "person", "left"))
        self.evidence = evidence.join(scored.select("person", "candidate_id"), "person").select("candidate_id", "field", "place", "e")
        return canonical(scored)

    def run(self, csv: Iterable[str] = (), resumes: Iterable[str] = (), ats: Iterable[str] = (), config: ProjectionConfig | None = None) -> DataFrame:
        """(candidate_id, json) of the output, validated before and after
        projection."""
        config = config or ProjectionConfig()
        loaded = self.load(csv, resumes, ats)
        if not self.metrics["records"]:
            raise PipelineError("the inputs hold no record")
        profiles = self.profiles_of(loaded.records)
        if not self.metrics["mapped"]:
            raise PipelineError("no record could be mapped")
        people = self._written(self.fuse(profiles), profiles=F.count(F.lit(1)))
        log.info("%d records make %d profiles", self.metrics["records"], self.metrics["profiles"])
        validate_canonical(people, self.schema)
        if config.apply_normalization:
            people = renormalized(people, self.countries, self.region)
        validate_projected(people, config, self.schema)
        return json_rows(people, config)


def write_json(rows: DataFrame, path: str) -> int:
    """One JSON array with the rows in order, written beside ``path`` and
    moved there when complete. Rows stream through the driver one partition
    at a time. Returns their number."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, part = tempfile.mkstemp(dir=folder, suffix=".tmp")
    try:
        n = 0
        with os.fdopen(handle, "w", encoding="utf-8") as file:
            file.write("[")
            for n, row in enumerate(rows.toLocalIterator(), 1):
                text = json.dumps(json.loads(row["json"]), ensure_ascii=False, indent=2)
                file.write(("," if n > 1 else "") + "\n  " + text.replace("\n", "\n  "))
            file.write("\n]\n" if n else "]\n")
            file.flush()
            os.fsync(file.fileno())
        os.replace(part, path)
        return n
    except BaseException:
        os.unlink(part)
        raise


def write_folder(rows: DataFrame, path: str) -> None:
    """The output as JSON lines, written by all executors."""
    rows.select(F.col("json").alias("value")).write.mode("overwrite").text(path)
