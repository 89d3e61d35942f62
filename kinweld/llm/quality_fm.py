"""Quality classifier: a factorisation machine.

Features of a text: its words hashed into ``BUCKETS`` (log counts, scaled to
unit length), statistics of its structure, and the recorded length as
metadata. Every feature has a weight and a vector of ``RANK`` numbers; pairs
interact by the product of their vectors. The sum over all pairs is half of
the squared sum less the sum of squares, so scoring is linear in the number
of features.

The model learns from at most ``DOCS_PER_CLASS`` documents of each label, by
AdaGrad in a fixed order, so reruns agree. Without labels of both classes the
score is the share of good labels (0.5 if there are none). Null and empty
texts have structure features only and are scored like any other. A null
recorded length counts as missing, which is a feature. Repeated rows get
equal scores, an empty table an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import by_document, byte_texts, id_remainder, slices, table
from kinweld.llm.quality_rules import repeated_lines, repeated_words
from kinweld.llm.sampling import labelled, texts_of

BUCKETS = 1 << 16
RANK = 6
DOCS_PER_CLASS = 3_000
EPOCHS = 6
RATE = 0.08
DECAY = 1e-4
GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:!?", b"!", b"|", b"\n", bytes(range(128, 256)), b"()[]{}\"'=+-_/\\@^~`")
#: Structure statistics: 9 shares of characters, 8 of words and lines, 2 of metadata.
DENSE = len(GROUPS) + 8 + 2


def dense_of(text: bytes, words: list[bytes], n_chars: int | None) -> list[float]:
    size, n = max(1, len(text)), max(1, len(words))
    shares = [(len(text) - len(text.translate(None, g))) / size for g in GROUPS]
    lines = text.count(b"\n") + 1
    shares += [
        math.log1p(len(words)) / 10,
        len(set(words)) / n,
        repeated_words(words) / n,
        repeated_lines(text) / lines,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(map(len, words)) / n / 20,
        math.log1p(len(words) / lines) / 10,
        float(not words),
    ]
    return shares + [math.log1p(max(0, n_chars)) / 15 if n_chars is not None else 0.0, float(n_chars is None)]


def words_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's words."""
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    hashed = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS
    buckets, counts = np.unique(hashed, return_counts=True)
    values = 1 + np.log(counts)
    return buckets, values / np.sqrt((values * values).sum())


def features(text: bytes, n_chars: int | None) -> tuple[list[float], np.ndarray, np.ndarray]:
    words = text.split()
    return (dense_of(text, words, n_chars), *words_of([w.lower() for w in words]))


class Machine:
    """Weights and factors: hashed words first, then the DENSE statistics,
    which are standardised by ``mean`` and ``scale``."""

    def __init__(self, bias: float) -> None:
        rng = np.random.default_rng(7)
        self.bias = bias
        self.weight = np.zeros(BUCKETS + DENSE)
        self.factor = rng.normal(0, 0.05, (BUCKETS + DENSE, RANK))
        self.mean, self.scale = np.zeros(DENSE), np.ones(DENSE)

    def inputs(self, found: tuple[list[float], np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        dense, buckets, values = found
        stats = np.clip((np.array(dense) - self.mean) / self.scale, -6, 6) / 3
        return np.concatenate([buckets, np.arange(BUCKETS, BUCKETS + DENSE)]), np.concatenate([values, stats])

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        v = self.factor[at]
        summed = x @ v
        pairs = 0.5 * (summed @ summed - (x * x) @ (v * v).sum(axis=1))
        return self.bias + self.weight[at] @ x + pairs, summed, v

    def score(self, text: bytes, n_chars: int | None) -> float:
        value = self.raw(*self.inputs(features(text, n_chars)))[0]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))

    def train(self, rows: list[tuple[tuple[list[float], np.ndarray, np.ndarray], int]]) -> None:
        dense = np.array([f[0] for f, _ in rows])
        self.mean, self.scale = dense.mean(axis=0), dense.std(axis=0) + 1e-3
        data = [(*self.inputs(f), y) for f, y in rows]
        moved_w, moved_v, moved_b = np.full_like(self.weight, 1e-2), np.full_like(self.factor, 1e-2), 1e-2
        order = np.random.default_rng(11)
        for _ in range(EPOCHS):
            for k in order.permutation(len(data)):
                at, x, y = data[k]
                value, summed, v = self.raw(at, x)
                slope = 1 / (1 + math.exp(-max(-30.0, min(30.0, value)))) - y
                step_w = slope * x + DECAY * self.weight[at]
                step_v = slope * (x[:, None] * summed - v * (x * x)[:, None]) + DECAY * v
                moved_b += slope * slope
                moved_w[at] += step_w * step_w
                moved_v[at] += step_v * step_v
                self.bias -= RATE * slope / math.sqrt(moved_b)
                self.weight[at] -= RATE * step_w / np.sqrt(moved_w[at])
                self.factor[at] -= RATE * step_v / np.sqrt(moved_v[at])

    def packed(self) -> bytes:
        return np.concatenate([[self.bias], self.mean, self.scale, self.weight, self.factor.ravel()]).astype("<f4").tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Machine:
        flat = np.frombuffer(data, "<f4").astype(float)
        self = cls(float(flat[0]))
        self.mean, self.scale = flat[1 : 1 + DENSE], flat[1 + DENSE : 1 + 2 * DENSE]
        rest = flat[1 + 2 * DENSE :]
        self.weight, self.factor = rest[: BUCKETS + DENSE], rest[BUCKETS + DENSE :].reshape(-1, RANK)
        return self


def fit(docs: DataFrame, labels: DataFrame, label: str) -> bytes | float:
    """A packed machine, or the share of good labels if it can't be learned."""
    sample, counts = labelled(labels, label, DOCS_PER_CLASS)
    odds = math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
    rows = texts_of(docs, sample, ("doc_id", "text", "n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for whole in batches:
            for batch in slices(whole):
                columns = {n: batch.column(k).to_pylist() for k, n in enumerate(batch.schema.names) if n != "text"}
                for i, text, n, y in zip(columns["doc_id"], byte_texts(batch), columns["n_chars"], columns["label"], strict=True):
                    held.append((i, zlib.crc32(text), features(text, n), int(y)))
        held.sort(key=lambda r: r[:2])
        rows = [(f, y) for _, _, f, y in held]
        good = sum(y for _, y in rows)
        if not 0 < good < len(rows):
            share = good / len(rows) if rows else 0.5
            yield pa.RecordBatch.from_pydict({"share": pa.array([share], pa.float64()), "model": pa.array([None], pa.binary())})
            return
        machine = Machine(math.log(good / (len(rows) - good)))
        machine.train(rows)
        # From the odds in the sample, which is level by class, to those of all labels.
        machine.bias += odds - math.log(good / (len(rows) - good))
        yield pa.RecordBatch.from_pydict({"share": pa.array([good / len(rows)], pa.float64()), "model": pa.array([machine.packed()], pa.binary())})

    found = rows.mapInArrow(run, "share double, model binary").collect()
    best = next((r for r in found if r["model"]), None)
    return bytes(best["model"]) if best else (found[0]["share"] if found else 0.5)


def classify(docs: DataFrame, model: bytes | float) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text, n_chars)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value
        machine = Machine.unpacked(held) if isinstance(held, bytes) else None

        def score(batch: pa.RecordBatch) -> dict[str, object]:
            lengths = batch.column(batch.schema.get_field_index("n_chars")).to_pylist()
            return {"score": pa.array([machine.score(t, n) if machine else held for t, n in zip(byte_texts(batch), lengths, strict=True)], pa.float64())}

        return score

    return by_document(docs, make, "score double", ("doc_id", "n_chars")).select("doc_id", "score")


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(id_remainder("doc_id", 5) != 0), "quality")
    found = classify(docs, model)
    return found.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
