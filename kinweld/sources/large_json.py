"""One large JSON file, read by many tasks.

The file is read in the splits of Spark's text source with ``}`` as the end of
a line, so that one long line is split like any other text and no piece is
longer than what lies between two ``}``. Whether a piece starts inside a
string, and how deep, depends on all before it; but a stretch of pieces takes
each of the two states (inside a string or not) to a state and a change of
depth, and these compose. A first pass reduces each split to that, the start
of every split follows by a prefix over the splits, and a second pass cuts
each split from its state.

It cuts out the lists and objects that start at the depth of items (in a root
list, or in what a root object holds) and replaces each run of them, with
nothing but commas between, by a placeholder with their number. What is left
is the frame of the file: it says which runs are the items, and with them
their numbers. An item over several splits is put together by the split in
which it began. A file is JSON if its frame is and all that was cut out is.

A task holds one item, or the frame: so what isn't in items must fit in a
task, as must one item. The driver gets a few numbers a run; a list is one run
a split. Files that are one object, not a list, are left to the reader of
whole files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.sources.storage import discard, materialized

#: Rows an Arrow batch.
HELD = 1_024
CUT = "block bigint, idx bigint, run bigint, part string, text string"
SCHEMA = pa.schema([("block", pa.int64()), ("idx", pa.int64()), ("run", pa.int64()), ("part", pa.string()), ("text", pa.string())])
NOT_JSON, NOT_OBJECTS = "not JSON", "items must be objects"

STRING = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
STRING_END = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
#: A string, a string that doesn't end, or a bracket.
TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*(?:"|\Z|\\\Z)|[\[\]{}]', re.DOTALL)
COMMA = re.compile(rb"[ \t\r\n]*,[ \t\r\n]*")


def strict_json(text: str) -> str:
    """SQL: the value of a JSON text, null if anything follows it. The parser
    stops behind a value; but what may follow in a list and in an object alike
    is nothing."""
    return f"""CASE WHEN try_parse_json(concat('{{"v":', {text}, '}}')) IS NOT NULL THEN variant_get(try_parse_json(concat('[', {text}, ']')), '$[0]') END"""


def advance(text: bytes, inside: bool) -> tuple[int, bool]:
    """The change of depth over a piece, and whether it ends inside a string."""
    if inside:
        end = STRING_END.match(text)
        if end is None:
            return 0, True
        text = text[end.end() :]
    text = STRING.sub(b"", text)
    cut = text.find(b'"')
    if cut >= 0:
        text = text[:cut]
    return text.count(b"{") + text.count(b"[") - text.count(b"}") - text.count(b"]"), cut >= 0


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """(block, piece): what stands before each ``}``, with the split that it
    starts in."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))


def effects(pieces: DataFrame) -> list[tuple]:
    """For each split (block, depth and state after it if it starts outside of
    strings, the same if inside, bytes, first byte that isn't blank)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for block, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = found.setdefault(block, [0, False, 0, True, 0, ""])
                text = piece + b"}"
                for k in (0, 2):
                    change, at[k + 1] = advance(text, at[k + 1])
                    at[k] += change
                at[4] += len(text)
                if not at[5]:
                    at[5] = text.lstrip(b" \t\r\n")[:1].decode("latin-1")
        columns = list(zip(*([b, *x] for b, x in found.items()), strict=True)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "d0", "s0", "d1", "s1", "bytes", "first"])

    return sorted(tuple(r) for r in pieces.mapInArrow(run, "block bigint, d0 bigint, s0 boolean, d1 bigint, s1 boolean, bytes bigint, first string").collect())


def starts_of(found: list[tuple]) -> dict[int, tuple[int, bool]]:
    """Depth and state at the start of each split."""
    out, depth, inside = {}, 0, False
    for block, d0, s0, d1, s1, _, _ in found:
        out[block] = depth, inside
        depth, inside = (depth + d1, s1) if inside else (depth + d0, s0)
    return out


class Split:
    """Cuts one split. ``level`` is the depth at which items start."""

    def __init__(self, block: int, depth: int, inside: bool, level: int) -> None:
        self.block, self.depth, self.inside, self.level = block, depth, inside, level
        self.open: list[bytes] | None = [] if depth > level else None
        self.headed = depth > level
        self.gap: list[bytes] = []
        self.frame: list[bytes] = []
        self.idx = self.run = self.size = 0

    def add(self, text: bytes) -> Iterator[dict]:
        at = 0
        if self.inside:
            end = STRING_END.match(text)
            if end is None:
                (self.gap if self.open is None else self.open).append(text)
                return
            at, self.inside = end.end(), False
        begin = 0
        for token in TOKEN.finditer(text, at):
            kind = token[0][:1]
            if kind == b'"':
                self.inside = len(token[0]) < 2 or not STRING.fullmatch(token[0])
            elif kind in b"{[":
                if self.depth == self.level and self.open is None:
                    self.gap.append(text[begin : token.start()])
                    self.begin()
                    begin = token.start()
                self.depth += 1
            else:
                self.depth -= 1
                if self.depth == self.level and self.open is not None:
                    self.open.append(text[begin : token.end()])
                    begin = token.end()
                    yield self.close()
        (self.gap if self.open is None else self.open).append(text[begin:])

    def begin(self) -> None:
        """A run goes on after a comma; anything else ends it."""
        gap = b"".join(self.gap)
        self.gap, self.open = [], []
        if not self.size or not COMMA.fullmatch(gap):
            self.end_run()
            self.frame.append(gap)
        self.size += 1

    def end_run(self) -> None:
        if self.size:
            self.frame.append(b'{"%d:%d":%d}' % (self.block, self.run, self.size) + (b',{"":0}' if self.size > 1 else b""))
            self.run += 1
            self.size = 0

    def close(self) -> dict:
        text, self.open = b"".join(self.open or ()), None
        if self.headed:
            self.headed = False
            return self.row(0, 0, "head", text)
        self.idx += 1
        return self.row(self.idx - 1, self.run, "item", text)

    def end(self) -> Iterator[dict]:
        if self.open is not None:
            yield self.row(self.idx, self.run, "head" if self.headed else "tail", b"".join(self.open))
        self.end_run()
        yield self.row(0, 0, "frame", b"".join([*self.frame, *self.gap]))

    def row(self, idx: int, run: int, part: str, text: bytes) -> dict:
        return {"block": self.block, "idx": idx, "run": run, "part": part, "text": text.decode()}


def cut(pieces: DataFrame, starts: dict[int, tuple[int, bool]], level: int, closed: bool) -> DataFrame:
    """CUT rows of all splits. ``closed`` says whether the file ends with the
    ``}`` of its last piece."""
    last = max(starts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        split, held = None, None
        for batch in batches:
            for block, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if split is None or split.block != block:
                    if split is not None:
                        yield from finish(split, held)
                    split, held = Split(block, *starts[block], level), None
                if held is not None:
                    yield from split.add(held + b"}")
                held = piece
        if split is not None:
            yield from finish(split, held)

    def finish(split: Split, held: bytes) -> Iterator[dict]:
        yield from split.add(held + (b"" if split.block == last and not closed else b"}"))
        yield from split.end()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        try:
            for row in rows(batches):
                held.append(row)
                if len(held) >= HELD:
                    yield pa.RecordBatch.from_pylist(held, SCHEMA)
                    held = []
        except UnicodeDecodeError:
            held.append({"block": -1, "idx": 0, "run": 0, "part": "bad", "text": None})
        if held:
            yield pa.RecordBatch.from_pylist(held, SCHEMA)

    return pieces.mapInArrow(run, CUT)


def joined(parts: DataFrame) -> DataFrame:
    """Items that several splits hold, as (block, idx, run, text) of the split
    in which each began."""
    ends = sorted((r["block"], r["part"], r["idx"], r["run"]) for r in parts.select("block", "part", "idx", "run").collect())
    owner, owners = None, []
    for block, part, idx, run in ends:
        owner = (block, idx, run) if part == "tail" else owner
        owners.append((block, part, *(owner or (-1, 0, 0))))
    known = parts.sparkSession.createDataFrame(owners, "b bigint, p string, ob bigint, oi bigint, orun bigint")
    placed = parts.join(F.broadcast(known), (F.col("block") == F.col("b")) & (F.col("part") == F.col("p")))
    texts = F.array_sort(F.collect_list(F.struct("block", "text")))
    return placed.groupBy("ob", "oi", "orun").agg(texts.alias("texts")).select(F.col("ob").alias("block"), F.col("oi").alias("idx"), F.col("orun").alias("run"), F.array_join(F.transform("texts", lambda x: x["text"]), "").alias("text"))


def frame_of(found: DataFrame) -> DataFrame:
    """The one row (v): the frame of the file, null if that isn't JSON."""
    blocks = found.where("part = 'frame'").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("f"))
    return blocks.select(F.array_join(F.transform("f", lambda x: x["text"]), "").alias("t")).select(F.expr(strict_json("t")).alias("v"))


def scan(spark: SparkSession, path: str, size: int, inner: str, is_kind) -> tuple[DataFrame | None, str | None]:
    """(row_ord, item) of the list that ``inner``, an SQL expression, finds in
    the root ``v``; or what is wrong with the file; or (None, None) if the file
    isn't a list of items."""
    pieces = pieces_of(spark, path)
    known = effects(pieces)
    if not known:
        return None, NOT_JSON
    over = sum(k[5] for k in known) - size
    if over not in (0, 1):  # the reader leaves a byte order mark out, which JSON mustn't have
        return None, NOT_JSON
    first = next((k[6] for k in known if k[6]), "")
    if first not in ("[", "{"):
        return None, None
    found = materialized(cut(pieces, starts_of(known), 1 if first == "[" else 2, over == 0))
    if not found.where("part = 'bad'").isEmpty():
        discard(found)
        return None, NOT_JSON
    frame = frame_of(found).withColumn("inner", F.expr(inner)).selectExpr("v IS NOT NULL AS json", f"CASE WHEN {is_kind('inner', 'ARRAY')} THEN 'list' WHEN {is_kind('inner', 'OBJECT')} THEN 'object' END AS kind", f"CASE WHEN {is_kind('inner', 'ARRAY')} THEN transform(try_variant_get(inner, '$', 'array<variant>'), x -> try_variant_get(x, '$', 'map<string,bigint>')) END AS runs").first()
    if not frame["json"]:
        return None, NOT_JSON
    if frame["kind"] == "object":
        discard(found)
        return None, None
    whole = found.where("part = 'item'").select("block", "idx", "run", "text").unionByName(joined(found.where("part IN ('head', 'tail')")))
    items = materialized(whole.select("block", "idx", "run", F.expr("try_parse_json(text)").alias("item")))
    discard(found)
    if not items.where("item IS NULL").isEmpty():
        return None, NOT_JSON
    if frame["kind"] is None or any(r is None for r in frame["runs"]):
        return None, NOT_OBJECTS
    offsets, at, firsts = [], 0, {}
    for runs in frame["runs"]:
        for key, n in runs.items():
            if key:
                block, run = map(int, key.split(":"))
                offsets.append((block, run, at))
                at += n
    # Numbers of a split count all its runs, so each run starts from its own first.
    for r in items.groupBy("block", "run").agg(F.min("idx").alias("first")).collect():
        firsts[r["block"], r["run"]] = r["first"]
    places = spark.createDataFrame([(b, r, n - firsts[b, r]) for b, r, n in offsets], "b bigint, r bigint, shift bigint")
    chosen = items.join(F.broadcast(places), (F.col("block") == F.col("b")) & (F.col("run") == F.col("r"))).select((F.col("idx") + F.col("shift")).alias("row_ord"), "item")
    if not chosen.where(f"NOT {is_kind('item', 'OBJECT')}").isEmpty():
        return None, NOT_OBJECTS
    return chosen, None
