"""Names that many others share a piece with are compared where they meet."""

import random
from itertools import product

import pyarrow as pa
import pytest

from kinweld.functions.similarity import lcs_length, lcs_lengths
from kinweld.operators import matching as J
from kinweld.operators import meeting as E


def similar(a, b, threshold):
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) >= threshold


def ordered(a, b):
    return (len(a), a) < (len(b), b)


def letters(name, first):
    word = 0
    for c in name:
        b = ord(c) % J.PLACES - first
        if 0 <= b <= 20:
            word |= (2 * (word >> 3 * b & 7) + 1 & 7) << 3 * b
    return word


def names(seed, tail):
    """Numbers before, words after; odd characters and long names among them."""
    draw = random.Random(seed)
    some = [f"{draw.randrange(10**6):06d} {draw.choice(('ada lovelace', 'éva lovelace', 'grace hopper'))}" for _ in range(150)]
    some += [f"{draw.randrange(300)} ada lovelace" for _ in range(30)] + ["x" * k + " and a name" * 6 for k in range(8)] + ["a\0b lovelace", "ab lovelace", "ada", "😀 ada lovelace"]
    some = list(dict.fromkeys(some))
    return some if tail else [n[::-1] for n in some]


@pytest.mark.parametrize("threshold, many, most, tail", [(90.0, 5, 5, True), (90.0, 5, 5, False), (70.0, 5, 5, True), (90.0, 10**6, 10**6, True), (90.0, 5, 10**6, True), (100.0, 5, 5, True)])
def test_similar_where_met_is_all_pairs(monkeypatch, threshold, many, most, tail):
    monkeypatch.setattr(E, "MANY", many)
    monkeypatch.setattr(E, "MOST", most)
    monkeypatch.setattr(E, "CHUNK", 8)
    monkeypatch.setattr(E, "PAIRS", 1000)
    monkeypatch.setattr(E, "HELD", 100)
    keys = [(1, names(1, tail)), (2, names(2, tail)), (3, names(3, tail)[:2])]
    rows = [(k, probe, n, i % 3, 0, letters(n, 0), letters(n, 21)) for k, given in keys for probe in (False, True) for i, n in enumerate(given)]
    columns = ["key", "probe", "name", "mask", "p", "letters", "letters_too"]
    kinds = [pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], columns)
    got = [tuple(r.values()) for b in E.similar_where_met(threshold)(iter(table.to_batches(max_chunksize=40))) for r in b.to_pylist()]
    want = [(a, i % 3, b, j % 3) for _, given in keys for (i, a), (j, b) in product(enumerate(given), enumerate(given)) if i % 3 & j % 3 == 0 and ordered(a, b) and similar(a, b, threshold)]
    assert sorted(got) == sorted(want) and (want or threshold == 100)


def test_lcs_of_many_pairs():
    draw = random.Random(4)
    text = lambda: "".join(draw.choice("abé\0😀") for _ in range(draw.choice((0, 1, 9, 63, 64, 65, 90))))
    left, right = ([text() for _ in range(300)] for _ in range(2))
    assert lcs_lengths(pa.array(left, pa.string()), pa.array(right, pa.string())).tolist() == list(map(lcs_length, left, right))


def test_names_of_one_end_leave_similar_pairs_only(spark, monkeypatch):
    """700 names share their end, in several pieces each; that makes no row for
    each two of them."""
    draw = random.Random(7)
    given = [(f"{k:06d} ada lovelace", 0) for k in draw.sample(range(10**6), 700)]
    met, dealt = [], J._in_blocks

    def noted(*args):
        rows = dealt(*args)
        met.append(rows.count())
        return rows

    monkeypatch.setattr(J, "_in_blocks", noted)
    found = [tuple(sorted((r["name"], r["name2"]))) for r in J.similar_names(spark.createDataFrame(given, "name string, mask int").localCheckpoint(), 90.0).collect()]
    want = {tuple(sorted((a, b))) for (a, _), (b, _) in product(given, given) if ordered(a, b) and similar(a, b, 90.0)}
    assert len(found) == len(set(found)) and set(found) == want and want
    assert met[0] <= 5 * len(want)
