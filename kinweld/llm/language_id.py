"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Letters are lower-cased, everything else becomes a blank; the n-grams of
``ORDERS`` characters are hashed into ``BUCKETS``, or fewer if there are so many
languages that the matrix of log probabilities (buckets by languages) would
have more than ``CELLS`` cells. The matrix is broadcast; a batch of texts is scored at once by gathering the
rows of its n-grams and summing them text by text.

The model learns from ``DOCS_PER_LANGUAGE`` documents, in expectation, of each
language, rare ones included; rows that repeat an id and its text count once,
rows with a null id, text or language teach nothing. A text that is null or has no letter
gets ``und`` and score 0, as does every text when nothing could be learned.
Ties go to the language that sorts first. Very long texts are scored whole, in
blocks of bounded size. Repeated rows get equal answers, an empty table gives
an empty one, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import by_document, id_remainder, released, slices, str_texts, table, written

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
DOCS_PER_LANGUAGE = 1_500
#: Cells of the matrix: 64 MB.
CELLS = 1 << 24
SMOOTHING = 0.5
#: Characters times languages that are scored in one block.
BLOCK = 4_000_000
PAD = max(ORDERS)


@cache
def folded() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            out[c] = ord(s.lower()[0])
    return out


def codes_of(text: str) -> np.ndarray:
    return folded()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def buckets_for(languages: int) -> int:
    """Buckets that keep the matrix within its size, a power of two."""
    return min(BUCKETS, max(64, 1 << (CELLS // max(1, languages)).bit_length() - 1))


def buckets_of(codes: np.ndarray, order: int, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of the n-gram that starts at each position but the last few."""
    n = len(codes) - order + 1
    h = np.full(n, 0x811C9DC5 + order, np.uint32)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    return (h % np.uint32(buckets)).astype(np.int32)


def count_ngrams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    codes = np.concatenate([np.full(1, 32, np.uint32), codes_of(text), np.full(PAD, 32, np.uint32)])
    out = np.zeros(buckets, np.int64)
    for order in ORDERS:
        out += np.bincount(buckets_of(codes, order, buckets)[: len(codes) - PAD], minlength=buckets)
    return out


class Model:
    """Sorted languages, log probabilities (buckets x languages), log priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, docs: np.ndarray) -> None:
        self.languages, self.buckets = languages, counts.shape[1]
        totals = counts.sum(axis=1, keepdims=True)
        self.matrix = np.ascontiguousarray((np.log(counts + SMOOTHING) - np.log(totals + SMOOTHING * self.buckets)).T.astype(np.float64 if counts.size < CELLS // 4 else np.float32))
        self.prior = np.log(docs + 1.0) - np.log((docs + 1.0).sum())

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(summed log probabilities, whether it has a letter) of each text."""
        pieces, starts, ends, at = [], [], [], 0
        for text in texts:
            codes = codes_of(text)
            pieces += [np.full(1, 32, np.uint32), codes, np.full(PAD, 32, np.uint32)]
            starts.append(at)
            ends.append(at + 1 + len(codes))
            at += 1 + len(codes) + PAD
        codes = np.concatenate(pieces)
        letters = np.concatenate([[0], np.cumsum(codes != 32)])
        starts, ends = np.array(starts), np.array(ends)
        lettered = letters[ends] > letters[starts]
        out = np.zeros((len(texts), len(self.languages)))
        bounds = np.stack([starts, ends], 1).ravel()
        for order in ORDERS:
            values = self.matrix[buckets_of(codes, order, self.buckets)]
            out += np.add.reduceat(values, bounds, axis=0, dtype=np.float64)[::2]
        return out + self.prior, lettered

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        most = max(1_000, BLOCK // max(1, len(self.languages)))
        for block in _blocks(texts, most):
            totals, lettered = self.long_totals(block[0], most) if len(block) == 1 else self.totals(block)
            best = totals.argmax(axis=1)
            shifted = np.exp(totals - totals.max(axis=1, keepdims=True))
            top = shifted.max(axis=1) / shifted.sum(axis=1)
            names += [self.languages[b] if has else "und" for b, has in zip(best, lettered, strict=True)]
            scores += [float(t) if has else 0.0 for t, has in zip(top, lettered, strict=True)]
        return names, scores

    def long_totals(self, text: str, most: int) -> tuple[np.ndarray, np.ndarray]:
        """As totals() of one text, whose n-grams are taken block by block."""
        if len(text) <= most:
            return self.totals([text])
        codes = np.concatenate([np.full(1, 32, np.uint32), codes_of(text), np.full(PAD, 32, np.uint32)])
        n, out = len(codes) - PAD, np.zeros(len(self.languages))
        for start in range(0, n, most):
            part = codes[start : min(n, start + most) + PAD]
            for order in ORDERS:
                out += self.matrix[buckets_of(part, order, self.buckets)[: len(part) - PAD]].sum(axis=0, dtype=np.float64)
        return (out + self.prior)[None], np.array([(codes != 32).any()])


def _blocks(texts: list[str], most: int) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def _summed(part: pd.DataFrame) -> pd.DataFrame:
    """The counts of one language over all tasks."""
    total = sum(np.frombuffer(c, "<i8") for c in part["counts"])
    return pd.DataFrame([{"lang": part["lang"].iloc[0], "docs": int(part["docs"].sum()), "counts": total.astype("<u4").tobytes()}])


def fit(docs: DataFrame) -> Model | None:
    """Learn from ``docs`` (doc_id, text, lang)."""
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    counts = written(rows.groupBy("lang").count())
    buckets = buckets_for(counts.count())
    steps = 1 << 30
    chosen = F.ceil(F.least(F.lit(1.0), DOCS_PER_LANGUAGE / F.col("count")) * steps)
    check = F.crc32(F.col("text").cast("binary"))
    sample = rows.join(F.broadcast(counts), "lang").where(F.pmod(F.xxhash64("doc_id", check), F.lit(steps)) < chosen)
    sample = sample.groupBy("lang", "doc_id", check.alias("check")).agg(F.min("text").alias("text")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for whole in batches:
            for batch in slices(whole):
                for lang, text in zip(batch.column(0).to_pylist(), str_texts(batch), strict=True):
                    held[lang] = held.get(lang, 0) + count_ngrams(text, buckets)
                    seen[lang] = seen.get(lang, 0) + 1
                if len(held) > 64:
                    yield from told(held, seen)
        yield from told(held, seen)

    def told(held: dict[str, np.ndarray], seen: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang in sorted(held):
            yield pa.RecordBatch.from_pydict({"lang": [lang], "docs": pa.array([seen[lang]], pa.int64()), "counts": pa.array([held[lang].astype("<i8").tobytes()], pa.binary())})
        held.clear()
        seen.clear()

    parts = sample.mapInArrow(released(run), "lang string, docs long, counts binary")
    found = sorted(parts.groupBy("lang").applyInPandas(_summed, "lang string, docs long, counts binary").collect(), key=lambda r: r["lang"])
    if not found:
        return None
    return Model([r["lang"] for r in found], np.stack([np.frombuffer(r["counts"], "<u4") for r in found]).astype(np.int64), np.array([float(r["docs"]) for r in found]))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def score(batch: pa.RecordBatch) -> dict[str, object]:
            texts = str_texts(batch)
            names, scores = known.score(texts) if known else (["und"] * len(texts), [0.0] * len(texts))
            return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

        return score

    return by_document(docs, make, "lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(id_remainder("doc_id", 4) != 2))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
