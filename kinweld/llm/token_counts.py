"""Token counts by looking up pre-tokens, without shuffling any of them.

The first tier is a compact table of frequent pre-tokens and their lengths,
of at most ``FREQUENT`` entries, broadcast to the workers. A pre-token that
isn't in it is looked up in the worker's own cache, which is emptied before it
holds more than ``CACHE_BYTES``; what neither holds is encoded by the library in
one batch. Both tiers only save time: every length comes from the library. The
frequent table is filled from a sample of ``SAMPLE_DOCS`` documents, about.

Pre-tokens are cut by a pattern where texts keep to the Latin blocks; others
are cut by the library's own pre-tokenizer, and their pieces go through the
same two tiers. Special strings inside a text count as the library counts
them: one token each. Null and empty texts have no bytes and no tokens. Rows
are counted one by one; repeated rows get equal counts, an empty table gives
an empty one, other columns are not read. Pre-tokens of more than ``LONG``
characters, which very long texts without blanks have, are never kept.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kinweld.llm.common import by_document, released, slices, str_texts, table

FREQUENT = 30_000
#: What the cache may hold, in bytes of pieces and the objects around them;
#: pieces of more than ``LONG`` characters never enter it.
CACHE_BYTES, ENTRY_BYTES, LONG = 64 << 20, 160, 100
SAMPLE_DOCS = 2_000
LIMIT = 512

# The pre-token pattern of the tokenizer, and the letters,
# numbers and blanks of the Latin blocks that it refers to.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t-\\r \\xa0"
PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
UNUSUAL = re.compile("[^\\x00-ɏ]|[\\x1c-\\x1f\\x85]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _load(path: str):
    """(the tokenizer, one that takes a whole string as one pre-token, the
    pattern of its special strings); kept for the life of the worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    piece = Tokenizer.from_file(path)
    piece.no_truncation()
    piece.no_padding()
    piece.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    piece.encode_special_tokens = True
    special = [re.escape(t.content) for t in whole.get_added_tokens_decoder().values()]
    return whole, piece, re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None


_known: dict[str, dict[str, int]] = {}


class Counts:
    def __init__(self, path: str, frequent: dict[str, int]) -> None:
        self.whole, self.piece, self.special = _load(path)
        self.frequent, self.cache = frequent, _known.setdefault(path, {})
        self.held = sum(4 * len(w) + ENTRY_BYTES for w in self.cache)
        self.find = re.compile(PATTERN).findall

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if not UNUSUAL.search(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and the number of special strings."""
        if self.special and (parts := self.special.split(text))[1:]:
            return [x for part in parts for x in self.cut(part)], len(parts) - 1
        return self.cut(text), 0

    def lengths(self, words: set[str]) -> dict[str, int]:
        """Tokens of each of these words, from the tiers or the library."""
        found = {w: n for w in words if (n := self.frequent.get(w) or self.cache.get(w))}
        missing = [w for w in words if w not in found]
        for start in range(0, len(missing), 10_000):
            some = missing[start : start + 10_000]
            new = {w: len(e.ids) for w, e in zip(some, self.piece.encode_batch(some, add_special_tokens=False), strict=True)}
            found |= new
            short = {w: n for w, n in new.items() if len(w) <= LONG}
            size = sum(4 * len(w) + ENTRY_BYTES for w in short)
            if self.held + size > CACHE_BYTES:
                self.cache.clear()
                self.held = 0
            self.cache.update(short)
            self.held += size
        return found

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces(t) for t in texts]
        get = self.lengths({w for s, _ in split for w in s}).__getitem__
        return [extra + sum(map(get, s)) for s, extra in split]


def frequent_lengths(docs: DataFrame, path: str | None) -> dict[str, int]:
    """The broadcast tier: the most frequent pre-tokens of a sample of
    documents with their lengths, counted on a worker, at most FREQUENT rows
    returned. Only the sample moves, about SAMPLE_DOCS rows and at most twice that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = Counts(path or default_path(), {}), Counter()
        for whole in batches:
            for batch in slices(whole):
                for text in str_texts(batch):
                    seen.update(w for w in counts.pieces(text)[0] if len(w) <= LONG)
                for word in [w for w, _ in seen.most_common()[4 * FREQUENT :]]:
                    del seen[word]
        words = [w for w, _ in seen.most_common(FREQUENT)]
        known = counts.lengths(set(words))
        yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array([known[w] for w in words], pa.int32())})

    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    few = docs.select("text").sample(share, 11).limit(2 * SAMPLE_DOCS).mapInArrow(released(run), "word string, n int")
    return {r["word"]: r["n"] for r in few.collect()}


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row. Without a path the default file
    is looked for on each worker."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def make():
        counts = Counts(path or default_path(), shared.value)

        def score(batch: pa.RecordBatch) -> dict[str, object]:
            texts = str_texts(batch)
            return {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": pa.array(counts.count(texts), pa.int64())}

        return score

    return by_document(docs, make, "n_bytes long, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"))
    return counted.selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {LIMIT} AS over_limit")
