"""BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a slice of a partition are laid out as one linked
sequence of symbols. An index maps the rank of each mergeable pair to all its
positions; ranks that have positions are taken in ascending order, all
positions of a rank are merged, and the lists of the pairs to the left and
right of each merge are updated. The result of a pre-token is kept in a cache
of the worker; before it holds more than ``CACHE_BYTES`` it is cut to what the
slice at work uses, which the size of a slice bounds.

Decoding maps ids to their symbols and joins them by spaces, which is what a
tokenizer file without a decoder asks for.

Special strings inside a text are one id each. Texts are normalised as the
file says; texts with characters outside the Latin blocks are normalised and
split by the library and merged here. Null counts as the empty text, which
has no ids and decodes to ''. Rows are encoded one by one, so repeated rows
give equal results and an empty table an empty one; other columns are not
read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import by_document, str_texts, table

#: What the cache may hold, in bytes of words, ids and the objects around
#: them; longer words than ``LONG`` characters never enter it.
CACHE_BYTES, ENTRY_BYTES, LONG = 72 << 20, 180, 1_000
#: Bytes of text, and of pre-tokens, that are worked on at once.
SLICE, LAID_OUT = 3 << 20, 200_000
#: Symbols are below 2 to this power; the last of them is none and parts words.
BITS = 24
END = (1 << BITS) - 1

# The letters, numbers and blanks of the Latin blocks, and the
# split pattern of the tokenizer over them.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t-\\r \\xa0"
PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+"
#: Beyond these, or where lower-casing takes more than one character.
UNUSUAL = re.compile("[^\\x00-ɏ]|[\\x1c-\\x1f\\x85İ]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it prints, else the
    next free character from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


class Bpe:
    """Ranks and symbols of a tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.symbols = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols |= {i: s for s, i in self.special.items()}
        #: Rank of a pair of symbols, keyed by both in one number.
        self.rank: dict[int, int] = {}
        self.pair: dict[int, tuple[int, int]] = {}
        self.made: list[int] = []
        for k, (a, b) in enumerate(model["merges"]):
            self.rank[vocab[a] << BITS | vocab[b]] = k
            self.pair[k] = vocab[a], vocab[b]
            self.made.append(vocab[a + b])
        stand_in = byte_symbols()
        self.inner = [vocab[s] for s in stand_in]
        self.last = [vocab[s + self.suffix] for s in stand_in]
        self.byte = {s: b for b, s in enumerate(stand_in)}
        self.library = Tokenizer.from_file(path)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find = re.compile(PATTERN).findall
        self.cache: dict[str | int, bytes] = {}
        self.held = 0

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if not UNUSUAL.search(text):
            return self.find(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.byte[c] for c in piece).decode("utf-8", "surrogateescape") for piece, _ in found]

    def split(self, text: str) -> list[str | int]:
        """Pre-tokens and, for special strings, ids."""
        if not self.split_special or not self.split_special.search(text):
            return self.pieces(text)
        parts = self.split_special.split(text)
        return [x for k, part in enumerate(parts) for x in ((self.special[part],) if k % 2 else self.pieces(part))]

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, as many words at once as LAID_OUT allows."""
        out, some, size = [], [], 0
        for word in words:
            some.append(word)
            size += len(word)
            if size >= LAID_OUT:
                out += self.merge_at_once(some)
                some, size = [], 0
        return out + self.merge_at_once(some)

    def merge_at_once(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words at once, by the occurrence index."""
        symbol, starts = [END], []
        for word in words:
            data = word.encode("utf-8", "surrogateescape")
            starts.append(len(symbol))
            symbol += [self.inner[b] for b in data[:-1]]
            symbol += [self.last[data[-1]], END]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, where = self.rank, {}
        for at in range(n - 1):
            r = rank.get(symbol[at] << BITS | symbol[at + 1])
            if r is not None:
                where.setdefault(r, []).append(at)
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            places = where.pop(r, None)
            if places is None:
                continue
            places.sort()
            a, b = self.pair[r]
            new = self.made[r]
            for k, at in enumerate(places):
                if symbol[at] != a or symbol[gone := after[at]] != b:
                    continue
                symbol[at], symbol[gone] = new, END
                right = after[at] = after[gone]
                before[right] = at
                left = before[at]
                lower = False
                for key, place in ((symbol[left] << BITS | new, left), (new << BITS | symbol[right], at)):
                    s = rank.get(key)
                    if s is not None:
                        if s not in where:
                            where[s] = []
                            heapq.heappush(active, s)
                        where[s].append(place)
                        lower |= s < r
                if lower and k + 1 < len(places):
                    # A lower rank woke up: it goes first, the rest of this one waits.
                    where.setdefault(r, []).extend(places[k + 1 :])
                    heapq.heappush(active, r)
                    break
        out = []
        for start in starts:
            ids, at = [], start
            while symbol[at] != END:
                ids.append(symbol[at])
                at = after[at]
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        distinct = set(chain.from_iterable(split))
        missing = distinct.difference(self.cache)
        words = [w for w in missing if isinstance(w, str)]
        found = {w: array("i", ids).tobytes() for w, ids in zip(words, self.merge(words), strict=True)}
        found |= {w: array("i", [w]).tobytes() for w in missing if isinstance(w, int)}
        long = {w: found.pop(w) for w in words if len(w) > LONG}
        size = self.size_of(found)
        if self.held + size > CACHE_BYTES:
            # What this slice uses stays, and is used by the next ones most likely.
            self.cache = {w: self.cache[w] for w in distinct.difference(missing)}
            self.held = self.size_of(self.cache)
        self.cache.update(found)
        self.held += size
        get = (self.cache | long if long else self.cache).__getitem__
        return [np.frombuffer(b"".join(map(get, s)), np.int32) for s in split]

    @staticmethod
    def size_of(entries: dict[str | int, bytes]) -> int:
        return ENTRY_BYTES * len(entries) + sum(map(len, entries.values())) + sum(2 * len(w) for w in entries if isinstance(w, str))

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.symbols.__getitem__, ids.tolist()))


@cache
def load(path: str) -> Bpe:
    return Bpe(path)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32()))


def apply(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and the text decoded from them. Without a path the default
    file is looked for on each worker."""

    def make():
        bpe = load(path or default_path())

        def score(batch: pa.RecordBatch) -> dict[str, object]:
            ids = bpe.encode(str_texts(batch))
            return {"ids": _lists(ids), "decoded": pa.array([bpe.decode(x) for x in ids], pa.string())}

        return score

    return by_document(docs, make, "ids array<int>, decoded string", size=SLICE)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the rows of apply()."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(apply(table(spark, sf_dir, "documents")))
