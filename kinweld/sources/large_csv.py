"""One large CSV file, read by many tasks.

The file is read in the splits of Spark's text source, line by line. Whether a
line starts inside a quoted cell depends on all before it, but a stretch of
lines is a function of two states (inside quotes or not), and such functions
compose: a first pass reduces each split to its function, the start of every
split follows by a prefix over the splits, and a second pass parses each split
from its state. What a split cuts (the end of a row that an earlier split
began, and its own last row if that goes on) is put together by the split in
which the row began. Counts a split give exact row numbers.

Rows, names and faults are those of :func:`~kinweld.sources.records.parse_csv`:
one row too long or a text that isn't UTF-8 spoils the file. Besides its rows
a task holds one buffer of ``HELD`` lines or one row, whichever is longer; the
driver gets a few numbers a split.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.functions.normalize import strip
from kinweld.sources.storage import discard, materialized

#: Lines that are parsed at once.
HELD = 4_096
#: Numbers of the rows put together of pieces, behind all others of a split.
BEHIND = 1 << 40
PARSED = "block bigint, idx bigint, part string, cells array<string>, text string"


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of a line is inside a quoted cell. A quote opens one
    only at the start of a cell; inside, two quotes are a quote."""
    at = line.find('"')
    while at >= 0:
        if inside:
            if line[at + 1 : at + 2] == '"':
                at += 1
            else:
                inside = False
        elif at == 0 or line[at - 1] in ",\r":
            inside = True
        at = line.find('"', at + 1)
    return inside


def physical(lines: Iterable[str]) -> Iterator[str]:
    """Lines with their ends; those that hold lone carriage returns cut there."""
    for line in lines:
        if "\r" in line[:-1]:
            yield from io.StringIO(line + "\n", newline="")
        else:
            yield line + "\n"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(block, line): the lines of a file with the split that they start in."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def functions(lines: DataFrame) -> dict[int, tuple[bool, bool]]:
    """For each split, whether its end is inside a quoted cell if its start
    isn't, and if it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, tuple[bool, bool]] = {}
        for batch in batches:
            for block, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out, within = ends.get(block, (False, True))
                if b'"' in line:
                    text = line.decode("utf-8", "replace")
                    if block == 0 and block not in ends:
                        text = text.removeprefix("﻿")
                    out, within = inside_after(text, out), inside_after(text, within)
                ends[block] = out, within
        yield pa.RecordBatch.from_pydict({"block": pa.array(ends, pa.int64()), "out": pa.array([x for x, _ in ends.values()], pa.bool_()), "within": pa.array([x for _, x in ends.values()], pa.bool_())})

    return {r["block"]: (r["out"], r["within"]) for r in lines.mapInArrow(run, "block bigint, out boolean, within boolean").collect()}


def starts_of(ends: dict[int, tuple[bool, bool]]) -> dict[int, bool]:
    """Whether each split starts inside a quoted cell."""
    out, inside = {}, False
    for block in sorted(ends):
        out[block] = inside
        inside = ends[block][inside]
    return out


def _rows(lines: list[str]) -> list[list[str]]:
    return [r for r in csv.reader(physical(lines)) if r]


class Split:
    """The rows of one split: complete ones are parsed, what belongs to other
    splits is handed on as text."""

    def __init__(self, block: int, inside: bool) -> None:
        self.block, self.inside, self.n = block, inside, 0
        self.head: list[str] | None = [] if inside else None
        self.ready: list[str] = []
        self.open: list[str] = []

    def add(self, line: str) -> Iterator[dict]:
        self.inside = inside_after(line, self.inside)
        if self.head is not None:
            self.head.append(line)
            if not self.inside:
                yield self.piece("head", self.head)
                self.head = None
            return
        self.open.append(line)
        if not self.inside:
            self.ready += self.open
            self.open = []
            if len(self.ready) >= HELD:
                yield from self.parsed()

    def end(self) -> Iterator[dict]:
        yield from self.parsed()
        if self.head:
            yield self.piece("head", self.head)
        if self.open:
            yield self.piece("tail", self.open)

    def parsed(self) -> Iterator[dict]:
        for row in _rows(self.ready):
            yield {"block": self.block, "idx": self.n, "part": "row", "cells": row, "text": None}
            self.n += 1
        self.ready = []

    def piece(self, part: str, lines: list[str]) -> dict:
        return {"block": self.block, "idx": 0, "part": part, "cells": None, "text": "\n".join(lines)}


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows; an error ends them with a row that tells it."""
    schema = pa.schema([("block", pa.int64()), ("idx", pa.int64()), ("part", pa.string()), ("cells", pa.list_(pa.string())), ("text", pa.string())])
    held = []
    try:
        for row in rows:
            held.append(row)
            if len(held) >= HELD:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
    except UnicodeDecodeError:
        held.append({"block": -1, "idx": 0, "part": "bad", "cells": None, "text": "not UTF-8"})
    except csv.Error as wrong:
        held.append({"block": -1, "idx": 0, "part": "bad", "cells": None, "text": str(wrong)})
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def parsed(lines: DataFrame, starts: dict[int, bool]) -> DataFrame:
    """PARSED rows of all splits."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        split = None
        for batch in batches:
            for block, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = line.decode()
                if split is None or split.block != block:
                    if split is not None:
                        yield from split.end()
                    split = Split(block, starts[block])
                    if block == 0:
                        text = text.removeprefix("﻿")
                yield from split.add(text)
        if split is not None:
            yield from split.end()

    return lines.mapInArrow(lambda batches: _batches(rows(batches)), PARSED)


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """PARSED rows of what several splits hold, under the split of the start."""
    spark, owner, owners = pieces.sparkSession, None, []
    for r in sorted(pieces.select("block", "part").collect()):
        owner = r["block"] if r["part"] == "tail" else owner
        owners.append((r["block"], r["part"], owner))
    known = spark.createDataFrame(owners, "b bigint, p string, owner bigint")
    whole = pieces.join(F.broadcast(known), (F.col("block") == F.col("b")) & (F.col("part") == F.col("p"))).groupBy("owner").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("texts"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                for k, row in enumerate(_rows("\n".join(t["text"] for t in r["texts"]).split("\n"))):
                    yield {"block": r["owner"], "idx": BEHIND + k, "part": "row", "cells": row, "text": None}

    return whole.mapInArrow(lambda batches: _batches(rows(batches)), PARSED)


def header_names(cells: list[str]) -> list[str]:
    """Names of columns: blank ones by number, repeats with .1, .2, ..."""
    seen: dict[str, int] = {}
    out = []
    for k, column in enumerate(cells):
        column = column or f"Unnamed: {k}"
        times = seen.get(column, 0)
        seen[column] = times + 1
        out.append(f"{column}.{times}" if times else column)
    return out


def numbered(rows: DataFrame) -> DataFrame:
    """(row_no, cells): rows numbered from 0 through all splits."""
    own = F.count(F.when(F.col("idx") < BEHIND, 1))
    counts = sorted((r["block"], r["own"], r["n"]) for r in rows.groupBy("block").agg(own.alias("own"), F.count(F.lit(1)).alias("n")).collect())
    at, offsets = 0, []
    for block, mine, n in counts:
        offsets.append((block, at, mine))
        at += n
    known = F.broadcast(rows.sparkSession.createDataFrame(offsets, "b bigint, before bigint, own bigint"))
    place = F.when(F.col("idx") < BEHIND, F.col("idx")).otherwise(F.col("own") + F.col("idx") - BEHIND)
    return rows.join(known, F.col("block") == F.col("b")).select((F.col("before") + place).alias("row_no"), "cells")


def scan(spark: SparkSession, path: str) -> tuple[DataFrame | None, str | None]:
    """(row_ord, cells as a map of the cells that aren't blank) of a file, or
    what is wrong with it."""
    lines = lines_of(spark, path)
    starts = starts_of(functions(lines))
    found = materialized(parsed(lines, starts))
    pieces = found.where("part IN ('head', 'tail')")
    both = materialized(found.where("part IN ('row', 'bad')").unionByName(joined_pieces(pieces)))
    discard(found)
    wrong = both.where("part = 'bad'").agg(F.min("text")).first()[0]
    if wrong is not None:
        return None, wrong
    rows = materialized(numbered(both.where("part = 'row'")))
    discard(both)
    first = rows.where("row_no = 0").first()
    if first is None:
        return None, "no header"
    names = header_names(first["cells"])
    long = rows.where(F.size("cells") > len(names)).agg(F.min_by(F.struct("row_no", F.size("cells").alias("n")), "row_no").alias("r")).first()["r"]
    if long is not None:
        return None, f"row {long['row_no'] + 1} has {long['n']} cells, the header {len(names)}"
    at: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        at.setdefault(name.strip(), []).append(k)
    value = lambda ks: F.coalesce(*[F.nullif(strip(F.get("cells", F.lit(k))), F.lit("")) for k in reversed(ks)])
    cells = F.map_filter(F.create_map(*[x for name, ks in at.items() for x in (F.lit(name), value(ks))]), lambda k, v: v.isNotNull())
    return rows.where("row_no > 0").select((F.col("row_no") - 1).alias("row_ord"), cells.alias("cells")), None
