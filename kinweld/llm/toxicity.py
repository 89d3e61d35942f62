"""Toxicity by compression distance.

Two zstandard dictionaries are trained apart, one on the ordinary and one on
the toxic texts of a labelled sample, by zstandard's own trainer. A window is
a run of letters (a longer one is cut at ``WINDOW`` bytes) between blanks; its
gain is its compressed length under the ordinary dictionary less that under
the toxic one. Since zstandard neither matches the last bytes of an input nor
compresses tiny ones, a filler that both dictionaries hold follows each window.
A text is described by how many windows, and what share of them, reach each
gain. This is done ``FOLDS`` times, each time without one part of the sample;
the weights of the gains are calibrated by logistic regression on the parts
left out, all together, and a text's score is the mean over the pairs. The
score is 0.5 where F2 on those parts is the greatest.

Windows of several words were tried: on the labelled documents of check_s, with
one pair of dictionaries, runs of two find 0.91 and runs of three 0.78 of
held-out toxic texts, single ones 0.94, since what surrounds a toxic word
costs more by chance than the word gains.

The model learns from at most ``DOCS_PER_CLASS`` documents of each label, one
text an id. Without labels of both classes the score is the share of toxic
labels (0 if there are none). Texts without a letter, null and empty ones have
no window and get the score of a text without gains. Gains are cached on the
worker, at most ``CACHED`` of them, so a very long text costs only its distinct
windows. A score of 0.5 counts as toxic. Repeated rows get equal scores, an
empty table an empty result, other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import by_document, id_remainder, released, slices, str_texts, table
from kinweld.llm.sampling import labelled, texts_of

DOCS_PER_CLASS = 4_000
WINDOW = 64
CACHED = 300_000
FOLDS = 3
#: Bytes of the ordinary and the toxic dictionary, and of the segments and
#: the strings in them that the trainer counts.
SIZES, SEGMENT, STRING = (262_144, 32_768), 24, 6
#: Bytes of text a byte of dictionary stands for at least.
SHARES = (64, 192)
#: Bytes that the trainer is asked for at once: it stops early at a stretch of
#: text without news, so a large dictionary is made of parts, each from its
#: share of the texts.
PART = 32_768
#: The highest gain, in bytes, that is told apart.
TOP = 13
FILLER = bytes(range(0xC0, 0x100))
RIDGE = 1.0


LETTERS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[bytes]:
    """The windows of a text: its runs of letters, lower-cased."""
    words = [w.encode() for w in LETTERS(text.lower())]
    if words and max(map(len, words)) > WINDOW:
        words = [w[k : k + WINDOW] for w in words for k in range(0, len(w), WINDOW)]
    return words


def train_dictionary(texts: list[list[bytes]], label: int) -> bytes:
    """A dictionary of the windows of texts of one class. Where there are too
    few for the trainer, their own text is the dictionary."""
    samples = [b" " + b" ".join(words) + b" " for words in texts if words]
    size = min(SIZES[label], max(1_024, sum(map(len, samples)) // SHARES[label]))
    parts, out = max(1, size // PART), []
    for k in range(parts):
        some = samples[k::parts]
        try:
            out.append(zstandard.train_dictionary(size // parts, some, k=SEGMENT, d=STRING).as_bytes())
        except zstandard.ZstdError:
            out.append(b"".join(some)[-size // parts :])
    return b" ".join([*out, FILLER])


def train_dictionaries(texts: list[list[bytes]], toxic: list[int]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary."""
    return tuple(train_dictionary([t for t, y in zip(texts, toxic, strict=True) if y == label], label) for label in (0, 1))


class Gains(dict):
    """Gains of each window seen under each pair of dictionaries, four bits a
    pair: 0 to TOP. A missing window is compressed every way."""

    def __init__(self, pairs: list[tuple[bytes, bytes]]) -> None:
        super().__init__()
        self.pairs = [tuple(map(self.compressor, pair)) for pair in pairs]

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters(window_log=19, chain_log=17, hash_log=17, search_log=7, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        return zstandard.ZstdCompressor(compression_params=parameters, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        window, packed = b" " + word + b" " + FILLER, 0
        for k, (ordinary, toxic) in enumerate(self.pairs):
            packed |= max(0, min(TOP, len(ordinary.compress(window)) - len(toxic.compress(window)))) << 4 * k
        self[word] = packed
        return packed

    def describe(self, words: list[bytes]) -> np.ndarray:
        """A row of features for each pair of dictionaries."""
        packed = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        out = []
        for k in range(len(self.pairs)):
            counts = np.bincount((packed >> 4 * k) & 15, minlength=TOP + 1)
            reached = counts[::-1].cumsum()[::-1][1:]
            highest = np.flatnonzero(counts)[-1] if words else 0
            out.append(np.concatenate([np.log1p(reached), 10 * reached / max(1, len(words)), [highest / 10]]))
        return np.array(out)


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float], list[float]]:
    """Mean, scale and weights (bias last) of a ridge logistic regression."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + ridge * w
        w -= np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge), slope)
    return mean.tolist(), scale.tolist(), w.tolist()


def best_cut(values: np.ndarray, y: np.ndarray) -> float:
    """The value from which on calling texts toxic has the greatest F2: a toxic
    text missed weighs more than an ordinary one flagged."""
    order = np.argsort(-values, kind="stable")
    values, hits = values[order], np.cumsum(y[order])
    f2 = 5 * hits / (np.arange(1, len(y) + 1) + 4 * hits[-1])
    f2[:-1][values[1:] == values[:-1]] = -1
    k = int(f2.argmax())
    return float(values[k] + values[min(k + 1, len(y) - 1)]) / 2


def learn(rows: list[tuple[int, list[bytes], int]]) -> dict | None:
    """The dictionaries and weights from (id, windows, label) sorted by id, or
    None if some part of them lacks a class."""
    fold = [zlib.crc32(f"fold {i}".encode()) % FOLDS for i, _, _ in rows]
    pairs, x, known = [], [], []
    for f in range(FOLDS):
        seen = [r for r, k in zip(rows, fold, strict=True) if k != f]
        left = [r for r, k in zip(rows, fold, strict=True) if k == f]
        if {y for _, _, y in seen} != {0, 1}:
            return None
        pairs.append(train_dictionaries([w for _, w, _ in seen], [y for _, _, y in seen]))
        gains = Gains(pairs[-1:])
        x += [gains.describe(w)[0] for _, w, _ in left]
        known += [y for _, _, y in left]
    mean, scale, weights = calibrate(np.array(x), np.array(known, float))
    weights[-1] -= best_cut(((np.array(x) - mean) / scale) @ weights[:-1] + weights[-1], np.array(known))
    return {"mean": mean, "scale": scale, "weights": weights, "pairs": pairs}


def scores(model: dict, gains: Gains, texts: list[str]) -> np.ndarray:
    mean, scale, weights = (np.array(model[k]) for k in ("mean", "scale", "weights"))
    x = np.array([gains.describe(words_of(t)) for t in texts]).reshape(len(texts), len(model["pairs"]), len(mean))
    value = (((x - mean) / scale) @ weights[:-1]).mean(axis=1) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str) -> dict | float:
    """The dictionaries and weights, or the share of toxic labels."""
    sample, _ = labelled(labels, label, DOCS_PER_CLASS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for whole in batches:
            for batch in slices(whole):
                ids, ys = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "label"))
                held += [(i, words_of(t), int(y)) for i, t, y in zip(ids, str_texts(batch), ys, strict=True)]
        held.sort(key=lambda r: r[0])
        model = learn(held)
        columns = {
            "share": pa.array([sum(y for _, _, y in held) / len(held) if held else 0.0], pa.float64()),
            "weights": pa.array([json.dumps({k: v for k, v in model.items() if k != "pairs"}) if model else None], pa.string()),
            "contents": pa.array([[c for pair in model["pairs"] for c in pair] if model else None], pa.list_(pa.binary())),
        }
        yield pa.RecordBatch.from_pydict(columns)

    found = texts_of(docs, sample).mapInArrow(released(run), "share double, weights string, contents array<binary>").collect()
    best = next((r for r in found if r["weights"]), None)
    if best is None:
        return found[0]["share"] if found else 0.0
    contents = list(map(bytes, best["contents"]))
    return json.loads(best["weights"]) | {"pairs": list(zip(contents[::2], contents[1::2], strict=True))}


#: The gains that this worker knows, under the dictionaries it saw last.
_known: dict[int, Gains] = {}


def known_gains(model: dict) -> Gains:
    key = zlib.crc32(b"".join(c for pair in model["pairs"] for c in pair))
    if key not in _known:
        _known.clear()
        _known[key] = Gains(model["pairs"])
    return _known[key]


def classify(docs: DataFrame, model: dict | float) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value
        if isinstance(held, float):
            return lambda batch: {"score": pa.array([held] * batch.num_rows, pa.float64())}
        gains = known_gains(held)
        return lambda batch: {"score": pa.array(scores(held, gains, str_texts(batch)), pa.float64())}

    return by_document(docs, make, "score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(id_remainder("doc_id", 5) != 0), "toxic")
    found = classify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
