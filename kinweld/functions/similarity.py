"""Token-sort similarity of names: 200 * LCS / (sum of lengths)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.functions.normalize import WHITE, casefold


def sorted_tokens(c: Column) -> Column:
    """Case-folded words in order, joined by blanks."""
    words = F.filter(F.split(casefold(c), f"{WHITE}+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by the bit-parallel recurrence: a bit of
    ``row`` falls where the length grows."""
    masks: dict[str, int] = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hits = row & masks.get(x, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - row.bit_count()


#: Texts up to this length are compared many pairs at once.
WORD = 64
#: The lowest n bits.
FULL = np.array([(1 << n) - 1 for n in range(WORD + 1)], np.uint64)
#: Pairs compared at once.
PAIRS = 1 << 13


def codes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the lengths of the texts."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    if pc.all(pc.string_is_ascii(texts)).as_py():
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], lengths
    return np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32), lengths


def code_matrix(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, back: bool = False) -> tuple[np.ndarray, int]:
    """Texts as rows of numbers from 1, with 0 behind their ends, and a bound
    of the numbers; ``back``: from the last character to the first."""
    k = np.arange(max(1, int(lengths.max(initial=0))))
    there = k < lengths[:, None]
    at = offsets[:, None] + (lengths[:, None] - 1 - k if back else k)
    found = flat[at[there]]
    if len(found) and found.max() >= 128:
        known, found = np.unique(found, return_inverse=True)
        found, size = found + 1, len(known) + 1
    else:
        numbers = np.cumsum(np.bincount(found, minlength=128) > 0)
        found, size = numbers[found], int(numbers[-1]) + 1
    codes = np.zeros(there.shape, np.int64)
    codes[there] = found
    return codes, size


def masks_of(codes: np.ndarray, size: int) -> np.ndarray:
    """For each row and number, the places of the number as bits, in a row."""
    masks, rows = np.zeros((len(codes), size), np.uint64), np.arange(len(codes))
    for k in range(codes.shape[1]):
        masks[rows, codes[:, k]] |= np.uint64(1 << k)
    masks[:, 0] = 0
    return masks.ravel()


def fallen(masks: np.ndarray, base: np.ndarray, columns: np.ndarray, j: np.ndarray, first: int, last: int, row: np.ndarray) -> np.ndarray:
    """The recurrence of :func:`lcs_length` for many pairs: texts with their
    masks from ``base`` on, and columns ``first`` to ``last`` of texts ``j``."""
    for k in range(first, last):
        hits = masks[base + columns[k][j]] & row
        row = (row + hits) | (row ^ hits)
    return row


def lcs_lengths(left: pa.Array, right: pa.Array) -> np.ndarray:
    """:func:`lcs_length` of pairs."""
    (a, n), (b, m) = codes_of(left), codes_of(right)
    found = np.zeros(len(n), np.int64)
    at_a, at_b = np.cumsum(n) - n, np.cumsum(m) - m + len(a)
    both, short = np.concatenate([a, b]), np.maximum(n, m) <= WORD
    for k in np.flatnonzero(~short):
        found[k] = lcs_length(left[k].as_py(), right[k].as_py())
    rows = np.flatnonzero(short)
    for k in range(0, len(rows), PAIRS):
        r = rows[k : k + PAIRS]
        codes, size = code_matrix(both, np.r_[at_a[r], at_b[r]], np.r_[n[r], m[r]])
        j = np.arange(len(r))
        row = fallen(masks_of(codes[: len(r)], size), j * size, codes[len(r) :].T, j, 0, int(m[r].max()), FULL[n[r]])
        found[r] = n[r] - np.bitwise_count(row & FULL[n[r]])
    return found


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """0 to 100; texts without characters are equal."""
    a, b = pa.array(left, pa.string()), pa.array(right, pa.string())
    total = (pc.utf8_length(a).to_numpy(zero_copy_only=False) + pc.utf8_length(b).to_numpy(zero_copy_only=False)).astype("float64")
    lcs = lcs_lengths(a, b)
    return pd.Series(np.where(total > 0, 200.0 * lcs / np.maximum(total, 1), 100.0))
