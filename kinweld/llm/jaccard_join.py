"""N-gram Jaccard self-join by universe partition and pigeonhole.

A document's set holds its distinct 5-word shingles (ASCII lower case). Sets
of sizes a and b with Jaccard 3/4 or more differ in at most (a + b) / 7
elements. Sizes fall into bands, each with a partition of the universe of
shingles into segments by hash; a pair uses the partition of the smaller
set's band, so a set is indexed for its own band and for the one below if a
partner can lie there.

*Allocation.* Each segment of a set gets a weight: 0 if it is skipped, 1 if
its subset is indexed, 2 if the subsets with one element less are as well. A
segment is found by its weight if the sets differ in fewer elements there, so
if the weights sum to more than the possible difference, similar sets meet in
some segment. :func:`allocate` picks for each band the number of segments and
whether they start from weight 1 or 2 by the least expected cost, from the
number of sets counted in the band and the posting lengths of their shingles,
counted for every ``PROBE`` th hash over all documents: rows to index, and
comparisons in the posting lists of empty subsets and of single shingles. Within a band each set spends what its own size leaves over on its
smallest segments, whose postings are the longest: they go from 1 to 0, or
from 2 to 1. All sets do so in one order, by (elements, signature). From 1 to
0: segments that agree come in the same order in both sets, so the last of
them is never skipped by either. From 2 to 1: a segment in which one set has
one element more is lost only if that set lowers it; if each set lost one this
way, each would hold fewer elements than the other's, which can't be.

*Matching.* Signatures are shuffled in binary blocks by bucket, as many
buckets as rows ask for. In a bucket, the sets with one signature are linked
to the smallest of them as candidates (a star, never all pairs). Candidates
are filtered by size and by an odd sketch kept with each class, whose distance
is a lower bound of the difference; what is left is verified exactly on the words of the
texts. Two sets with a common signature are both in the star of its
smallest set; where the members of a star end up in different components, the
pairs across components are compared as well, by size and sketch and at
last exactly, as long as their components haven't met. Large stars are
compared block by block in tasks of their own. Connected components of the
verified links give the result; links between sets that are in one component
already are not looked for.

Texts to verify are found by id and digest. A bitmap of the wanted ids, of
at most 2 to the power ``MAP_BITS`` bits whatever their number, is broadcast and
drops most other documents before the join.

Equal sets are one class, found by a 128-bit digest, and enter once. Null and
empty texts and texts without words have empty sets and link with nothing.
The component of a class is the smallest doc_id reachable; null ids count
last, a component of null ids only is null, except that an empty set's
component is its own doc_id. A class is a node of its own, whatever its ids: rows
that repeat a doc_id are judged by their own text, and a class of null ids
links others. An empty table gives an empty result; other columns are not read by
:func:`report` and pass through :func:`keep`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweld.llm.common import any_row, byte_texts, discard, fresh, release, released, slices, table, written
from kinweld.llm.common import mix64 as mix

WORDS = 5
#: Link where PERCENT[1] * intersection >= PERCENT[0] * union.
PERCENT = (75, 100)
#: Bytes of text that are hashed at once.
SLICE = 1 << 20
#: Sets of a star that are compared in one block.
BLOCK_SETS = 1_000
#: Shingles of those sets, about.
BLOCK_SHINGLES = 2_000_000
#: Signatures that a task holds before it sends them out.
FLUSH = 1_000_000
#: Signatures in a bucket, about.
BUCKET_ROWS = 4_000_000
#: Bits of the map of wanted ids: 4 MB.
MAP_BITS = 25
#: Posting lengths are counted for the shingles of every PROBEth hash.
PROBE = 16
#: Cost of a comparison of two sets in a star, and of a candidate, in rows.
COMPARISON, CANDIDATE = 0.03, 10.0
#: Seed and number of the draws that the cost of a band is estimated from.
DRAWS = (11, 200)

U = np.uint64


# Random odd base of the polynomial over bytes, its inverse, and a random
# number for each byte.
_rng = np.random.default_rng(20_240_501)
BASE = U(int(_rng.integers(0, 1 << 62)) * 4 + 5)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def forget_powers() -> None:
    """Free the powers that the longest text of a task asked for."""
    _powers[:] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            out = np.full(n + n // 4, base, U)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text.

    All texts are hashed at once: a word's hash is a difference of prefix
    sums of a polynomial over the bytes, brought back to its start.
    """
    data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    blank = IS_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = powers(len(data) + 1)
    width_all = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first_byte = np.cumsum(width_all) - width_all
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, U), np.cumsum(BYTES[data] * up[: len(data)])])
        word = mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U))
        del prefix
        bounds = np.searchsorted(start, np.concatenate([first_byte, [len(data)]]))
        run = np.full(max(0, len(word) - WORDS + 1), WORDS, U)
        for k in range(WORDS):
            run = run * U(0x9E3779B97F4A7C15) + word[k : k + len(run)]
        run = mix(run)
        out = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo >= WORDS:
                out.append(np.unique(run[lo : hi - WORDS + 1]))
            elif hi == lo:
                out.append(np.empty(0, U))
            else:
                short = np.full(1, hi - lo, U)
                for k in range(lo, hi):
                    short = short * U(0x9E3779B97F4A7C15) + word[k]
                out.append(mix(short))
    return out


def numbered(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of texts as numbers, equal where the words are:
    words are numbered exactly, then runs of two, three, ... words are."""
    number: dict[bytes, int] = {}
    words = [np.fromiter((number.setdefault(w, len(number)) for w in t.lower().split()), np.int64) for t in texts]
    if any(len(w) < WORDS for w in words):
        # Short texts are one shingle each, of all their words.
        whole = {tuple(w.tolist()): k for k, w in enumerate(words)}
        return [np.array([whole[tuple(w.tolist())]] if len(w) else [], np.int64) if len(w) < WORDS else len(words) + np.arange(len(w)) for w in words]
    every = np.concatenate(words)
    runs = every
    for k in range(1, WORDS):
        runs = np.unique(runs[:-1] * len(number) + every[k:], return_inverse=True)[1]
    ends = np.cumsum([len(w) for w in words])
    return [np.unique(runs[end - len(w) : end - WORDS + 1]) for end, w in zip(ends, words, strict=True)]


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets that aren't empty link."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return PERCENT[1] * both >= PERCENT[0] * (len(x) + len(y) - both)


def similar(a: bytes, b: bytes) -> bool:
    """Whether two texts with words link."""
    return alike(*numbered([a, b]))


# --- bands and allocation ---------------------------------------------------


def difference(a: np.ndarray | int, b: np.ndarray | int):
    """The most elements in which linked sets of sizes a and b differ."""
    need, per = PERCENT
    return (per - need) * (a + b) // (per + need)


def largest_partner(a: np.ndarray | int):
    return a * PERCENT[1] // PERCENT[0]


def smallest_partner(b: np.ndarray | int):
    return -(-b * PERCENT[0] // PERCENT[1])


def band_starts_of(bands: int) -> np.ndarray:
    """First size of each band, and that of the one beyond."""
    starts = [1]
    while len(starts) <= bands:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * PERCENT[1] // PERCENT[0])))
    return np.array(starts, np.int64)


def bands_up_to(most: int) -> int:
    """Number of bands that hold all sizes up to ``most``."""
    bands = 1
    while band_starts_of(bands)[-1] <= most:
        bands += 1
    return bands


def _expected(top: int, segments: int, weight: int, spare: int) -> tuple[float, float, float]:
    """(rows, rows of empty subsets, rows of one element) that a set of ``top``
    elements costs in ``segments`` segments, ``spare`` of them lowered."""
    if weight == 1 and top > 512:
        mean = top / segments
        empty = segments * math.exp(-mean)
        single = segments * mean * math.exp(-mean)
        return float(segments - spare), max(0.0, empty - spare), single - min(single, max(0.0, spare - empty))
    draws = np.random.default_rng(DRAWS[0]).multinomial(top, np.full(segments, 1 / segments), DRAWS[1])
    near = np.sort(draws, axis=1)[:, spare:]
    of = lambda x, k: float((x == k).sum(axis=1).mean())
    if weight == 1:
        return float(near.shape[1]), of(near, 0), of(near, 1)
    return segments + float(near.sum(axis=1).mean()), of(draws, 0) + of(near, 1), of(draws, 1) + 2 * of(near, 2)


def allocate(sets: np.ndarray, alike: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segments, weight of a segment) of each band, by the least cost for the
    number of sets that lie in it and the next, given in ``sets``, and for the
    sum of squared posting lengths of single shingles, given in ``alike``."""
    starts = band_starts_of(len(sets))
    out = np.ones((2, len(sets)), np.int64)
    for band in range(len(sets)):
        top = int(starts[band + 1] - 1)
        n, equal = float(sets[band : band + 2].sum()), float(alike[band : band + 2].sum())
        units = int(difference(top, largest_partner(top))) + 1
        best = math.inf
        for weight in (1, 2):
            # Neighbourhoods of large sets have more rows than any chance match.
            if weight == 2 and top > 256:
                break
            base = -(-units // weight)
            for more in sorted({0, 1, 2, 1 + units // 16, 1 + units // 8, 1 + units // 4}):
                segments = base + more
                rows, empty, single = _expected(top, segments, weight, min(segments, weight * segments - units))
                pairs = (n * empty) ** 2 / segments + (single / top) ** 2 * equal
                cost = n * rows + CANDIDATE * n * empty + COMPARISON * pairs / 2
                if cost < best * 0.999:
                    best, out[0, band], out[1, band] = cost, segments, weight
    return out[0], out[1]


def signatures(sets: list[np.ndarray], plan: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, 64-bit signature) of all rows to be indexed, with
    the segments and weights of each band in ``plan``. Sets that only link
    with equal ones have no rows."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return np.empty(0, np.int64), np.empty(0, U)
    starts = band_starts_of(len(plan[0]))
    own = np.searchsorted(starts, sizes, "right") - 1
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    out_set, out_sig = [np.empty(0, np.int64)], [np.empty(0, U)]
    for below in range(3):
        band = own - below
        at_band = np.clip(band, 0, len(plan[0]) - 1)
        top = starts[at_band + 1] - 1
        bound = np.where(below == 0, difference(sizes, largest_partner(sizes)), difference(sizes, top))
        used = (sizes > 0) & (band >= 0) & (bound > 0) & ((below == 0) | (top >= smallest_partner(sizes)))
        if not used.any():
            continue
        weight = plan[1][at_band]
        segments = np.where(used, plan[0][at_band], 0)
        spare = np.minimum(segments, weight * segments - bound - 1)
        offset = np.cumsum(segments) - segments
        total = int(segments.sum())
        mine = used[owner]
        x, d = tokens[mine], owner[mine]
        with np.errstate(over="ignore"):
            salted = mix(x ^ (U(0xD6E8FEB86659FD93) * (band[d] + 1).astype(U)))
        at = offset[d] + (salted % segments[d].astype(U)).astype(np.int64)
        high, low = (salted >> U(38)).astype(np.float64), ((salted >> U(12)) & U((1 << 26) - 1)).astype(np.float64)
        count = np.bincount(at, minlength=total)
        sums = np.bincount(at, high, total), np.bincount(at, low, total)
        of = np.repeat(np.arange(len(sets)), segments)
        tag = ((band[of] + 1) << 40) + (np.arange(total) - offset[of])

        def sign(s_high: np.ndarray, s_low: np.ndarray, n: np.ndarray, tag: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                h = mix(s_high.astype(np.int64).astype(U) * U(0x9E3779B97F4A7C15) + s_low.astype(np.int64).astype(U))
                return mix(h ^ mix(tag.astype(U) * U(0xA24BAED4963EE407) + n.astype(U)))

        sig = sign(*sums, count, tag)
        # Lowered: the first ``spare`` segments of each set in the common order.
        rank_key = (np.minimum(count, 65535).astype(U) << U(48)) | (sig >> U(16))
        order = np.lexsort((rank_key, of))
        lowered = np.zeros(total, bool)
        lowered[order] = np.arange(total) - offset[of[order]] < spare[of[order]]
        kept = ~(lowered & (weight[of] == 1))
        out_set.append(of[kept])
        out_sig.append(sig[kept])
        near = (weight[d] == 2) & ~lowered[at]
        if near.any():
            a, f, g = at[near], high[near], low[near]
            out_set.append(d[near])
            out_sig.append(sign(sums[0][a] - f, sums[1][a] - g, count[a] - 1, tag[a]))
    return np.concatenate(out_set), np.concatenate(out_sig)


# --- odd sketches ------------------------------------------------------------


def odd_sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of elements in each cell, 8 to 16 cells an element.
    Sets that differ in d elements differ in at most d bits, and mostly in that."""
    bits = 1 << max(6, int(8 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch folded to ``size`` bytes; cells meet modulo the new length."""
    x = np.frombuffer(sketch, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def may_link(a: bytes, b: bytes, n: int, m: int) -> bool:
    """False only if sets of sizes n and m with these sketches can't link."""
    size = min(len(a), len(b))
    x, y = folded(a, size).view(U), folded(b, size).view(U)
    return int(np.bitwise_count(x ^ y).sum()) <= difference(n, m)


# --- the plan ----------------------------------------------------------------

SETS = "doc_id long, body binary, n_shingles long, d long, e long, sketch binary, first boolean, probe array<long>"


def halves(tokens: np.ndarray) -> tuple[int, int]:
    """The digest of a set, as two numbers."""
    digest = xxhash.xxh3_128_digest(tokens.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def set_table(docs: DataFrame) -> DataFrame:
    """The class digest (d, e), size and odd sketch of each document's set;
    whether the task hadn't seen it before, and then its probe of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int | None] = {None}
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                sets = shingles(byte_texts(batch))
                digests = [halves(s) if len(s) else (None, None) for s in sets]
                arrays = [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64())]
                arrays += [pa.array([x[k] for x in digests], pa.int64()) for k in (0, 1)]
                arrays.append(pa.array([odd_sketch(s) if len(s) else None for s in sets], pa.binary()))
                first = [x not in seen and not seen.add(x) for x, _ in digests]
                probes = [s[s % U(PROBE) == 0].view(np.int64) if new else np.empty(0, np.int64) for s, new in zip(sets, first, strict=True)]
                ends = np.cumsum([0, *map(len, probes)]).astype(np.int32)
                arrays += [pa.array(first, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(probes)))]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SETS.split(", ")])
        forget_powers()

    return keyed(docs).mapInArrow(released(run), SETS)


def body_of(text: str) -> Column:
    """128 bits that stand for a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body_of("text").alias("body"), "text")


def planned(sets: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """The allocation for the sizes and shingles of all sets, and the number of
    signatures it makes, about. Posting lengths are those of the shingles in
    the probes, counted over all sets. One row a band comes to the driver."""
    starts = band_starts_of(96)
    band = (F.size(F.filter(F.array(*map(F.lit, starts.tolist())), lambda s: s <= F.col("n_shingles"))) - 1).alias("band")
    found = {r["band"]: r["count"] for r in sets.where("first").groupBy(band).count().collect()}
    lengths = sets.where("first").select(band, F.explode("probe").alias("x")).groupBy("band", "x").agg(F.count(F.lit(1)).cast("double").alias("c"))
    alike = {r["band"]: r["sum"] for r in lengths.where("c > 1").groupBy("band").agg(F.sum(F.col("c") * F.col("c")).alias("sum")).collect()}
    bands = range(max(found, default=0) + 1)
    counts = np.array([found.get(k, 0) for k in bands], np.int64)
    plan = allocate(counts, PROBE * np.array([alike.get(k, 0.0) for k in bands]))
    rows = np.where(plan[1] == 1, plan[0], plan[0] + starts[1 : len(counts) + 1] - 1)
    return plan, int(2 * (counts * rows).sum())


def blocks(docs: DataFrame, plan: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(bucket, block): the signatures of many documents, set by set. Copies
    within a task enter once."""

    def pack(ds: list[int], owners: list[np.ndarray], sigs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        d = np.array(ds, np.int64)
        owner, sig = np.concatenate(owners), np.concatenate(sigs)
        bucket = ((sig & U(0xFFFFFFFF)) % U(buckets)).astype(np.int64)
        order = np.lexsort((owner, bucket))
        owner, sig, bucket = owner[order], (sig[order] >> U(32)).astype("<u4"), bucket[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
        keys, values = [], []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            held, counts = np.unique(owner[lo:hi], return_counts=True)
            keys.append(int(bucket[lo]))
            values.append(np.array([len(held)], "<i8").tobytes() + d[held].astype("<i8").tobytes() + counts.astype("<i4").tobytes() + sig[lo:hi].tobytes())
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys, pa.int64()), "block": pa.array(values, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        ds, owners, sigs, rows = [], [], [], 0
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                sets = []
                for s in shingles(byte_texts(batch)):
                    if len(s):
                        d = halves(s)[0]
                        if d not in seen:
                            seen.add(d)
                            sets.append((d, s))
                owner, sig = signatures([s for _, s in sets], plan)
                owners.append(owner + len(ds))
                sigs.append(sig)
                ds += [d for d, _ in sets]
                rows += len(sig)
                if rows >= FLUSH:
                    yield from pack(ds, owners, sigs)
                    ds, owners, sigs, rows = [], [], [], 0
        if rows:
            yield from pack(ds, owners, sigs)
        forget_powers()

    return docs.select("text").mapInArrow(released(run), "bucket long, block binary")


def _match(part: pd.DataFrame) -> pd.DataFrame:
    """Of each signature in a bucket that several sets have: the smallest of
    them with each other one."""
    ds, sigs = [], []
    for block in part["block"]:
        k = int(np.frombuffer(block, "<i8", 1)[0])
        ds.append(np.repeat(np.frombuffer(block, "<i8", k, 8), np.frombuffer(block, "<i4", k, 8 + 8 * k)))
        sigs.append(np.frombuffer(block, "<u4", -1, 8 + 12 * k))
    d, sig = np.concatenate(ds), np.concatenate(sigs)
    del ds, sigs, part
    order = np.argsort(sig, kind="stable")
    sig = sig[order]
    shared = np.zeros(len(sig), bool)
    same = sig[1:] == sig[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    d, sig = d[order[shared]], sig[shared]
    del order, same, shared
    order = np.lexsort((d, sig))
    d, sig = d[order], sig[order]
    lead = np.maximum.accumulate(np.where(np.concatenate([[True], sig[1:] != sig[:-1]]), np.arange(len(sig)), 0)) if len(sig) else np.empty(0, np.int64)
    pairs = np.stack([d[lead], d], 1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    del d, sig, order, lead
    release()
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (doc_id, body, text) of ``docs`` that may be in ``ids`` (c): those
    whose digest has its bit in a map of all wanted ones. The map has at most
    2 to the power MAP_BITS bits, however many ids there are."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << MAP_BITS))
    places = ids.select(bit("c").alias("p")).distinct()
    rows = places.groupBy(F.shiftright("p", 15).alias("page")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(32767)).alias("map"))
    found = keyed(docs).withColumn("p", bit("body")).join(F.broadcast(rows), F.shiftright("p", 15) == F.col("page"))
    at = F.col("p").bitwiseAND(32767)
    byte = F.conv(F.hex(F.substring("map", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    power = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), at.bitwiseAND(7).cast("int") + 1)
    return found.where(byte.bitwiseAND(power) != 0).select("doc_id", "body", "text")


def fetch(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(k, text) of the nodes in ``ids`` (k, i, c), by id and digest. Texts
    without an id are found by their digest alone, which stands for one text."""
    ids = ids.distinct()
    rows = wanted(docs, ids)
    found = rows.join(ids.hint("shuffle_hash"), (F.col("doc_id") == F.col("i")) & (F.col("body") == F.col("c"))).select("k", "body", "text")
    bare = rows.where("doc_id IS NULL").join(ids.where("i IS NULL").hint("shuffle_hash"), F.col("body") == F.col("c")).select("k", "body", "text")
    return found.unionByName(bare).groupBy("k").agg(F.max("text").alias("text"))


def near_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of class digests that may link by size and sketch, as
    (u, v) of the classes' nodes with their ids and digests."""
    side = lambda x, y: classes.select(F.col("d").alias(x), *[F.col(c).alias(c + y) for c in ("node", "rep", "body", "n", "sketch")])
    named = pairs.join(side("a", "_a").hint("merge"), "a").join(side("b", "_b").hint("merge"), "b")
    sizes = PERCENT[1] * F.least("n_a", "n_b") >= PERCENT[0] * F.greatest("n_a", "n_b")
    named = named.where(sizes & (F.col("node_a") != F.col("node_b")))
    out = ["node_a", "rep_a", "body_a", "node_b", "rep_b", "body_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(k).to_pylist() for k in range(6, 10))
            hit = [may_link(*row) for row in zip(x, y, n, m, strict=True)]
            yield batch.select(range(6)).filter(pa.array(hit, pa.bool_()))

    return named.select(*out, "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(released(run), ", ".join(f"{c} binary" if c.startswith("body") else f"{c} long" for c in out))


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class digests whose texts link, as (u, v) of the
    classes' nodes. Texts of representatives are compared, word by word."""
    named = written(near_pairs(pairs, classes))
    ids = named.selectExpr("node_a AS k", "rep_a AS i", "body_a AS c").unionByName(named.selectExpr("node_b AS k", "rep_b AS i", "body_b AS c"))
    texts = written(fetch(docs, ids))
    # The text of the leaf comes first: a leaf has few pairs, a centre may have many.
    right = named.select("node_a", "node_b").join(texts.select(F.col("k").alias("node_b"), F.col("text").alias("tb")).hint("merge"), "node_b")
    both = right.join(texts.select(F.col("k").alias("node_a"), F.col("text").alias("ta")).hint("merge"), "node_a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ta"):
                us, vs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                hit = [similar(*row) for row in zip(byte_texts(batch, "ta"), byte_texts(batch, "tb"), strict=True)]
                keep = [k for k, h in enumerate(hit) if h]
                yield pa.RecordBatch.from_pydict({"u": pa.array([max(us[k], vs[k]) for k in keep], pa.int64()), "v": pa.array([min(us[k], vs[k]) for k in keep], pa.int64())})

    links = written(both.select("node_a", "node_b", "ta", "tb").mapInArrow(released(run), "u long, v long").distinct())
    discard(named, texts)
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u > v), by large and
    small stars until nothing changes. Minima are aggregated before each
    join, and no node's neighbours are ever gathered."""
    edges, last = links, None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("w"), "m")
        large = both.join(low, F.col("u") == F.col("w")).where("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        joined = large.join(low, F.col("u") == F.col("w"))
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()
        following = written(small)
        if edges is not links:
            discard(edges)
        edges = following
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))
    discard(edges)
    return found


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The groups of rows sorted by their first ``keys`` columns."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        changes = np.zeros(max(0, batch.num_rows - 1), bool)
        for k in range(keys):
            changes |= np.diff(batch.column(k).to_numpy()) != 0
        start = 0
        for end in (np.flatnonzero(changes) + 1).tolist():
            yield batch.slice(start, end - start)
            start = end
        held = batch.slice(start)
    if held is not None and held.num_rows:
        yield held


def apart_pairs(group: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of rows of a group, sorted by size, that lie in different
    components and, by size and sketch, may link. Of two blocks only pairs across."""
    n, comp, block = (group.column(c).to_numpy() for c in ("n", "comp", "block"))
    if comp.min() == comp.max():
        return
    sketches = group.column("sketch").to_pylist()
    # Folded to two cells an element for all pairs; the whole sketch for the few left.
    size = max(8, min(map(len, sketches)) // 4)
    words = np.stack([folded(x, size) for x in sketches]).view(U)
    mixed = block.min() != block.max()
    lo = 0
    while lo < len(n):
        # In order of size, a set's partners end with the largest it can link to.
        last = np.searchsorted(n, largest_partner(n[lo]), "right")
        hi = min(len(n), lo + max(1, 2_000_000 // ((last - lo) * words.shape[1] + 1)))
        last = np.searchsorted(n, largest_partner(n[hi - 1]), "right")
        apart = np.bitwise_count(words[lo:hi, None, :] ^ words[None, lo:last, :]).sum(axis=2, dtype=np.int64)
        may = (apart <= difference(n[lo:hi, None], n[None, lo:last])) & (comp[lo:hi, None] != comp[None, lo:last])
        if mixed:
            may &= block[lo:hi, None] != block[None, lo:last]
        for i, j in np.argwhere(may).tolist():
            if j > i and may_link(sketches[lo + i], sketches[lo + j], int(n[lo + i]), int(n[lo + j])):
                yield lo + i, lo + j
        lo = hi


MEMBERS = "a long, p long, q long, n long, node long, comp long, block long, rep long, body binary, sketch binary"


def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that may link with one of another component of their group."""
    for group in runs_of(batches, 3):
        marked = np.zeros(group.num_rows, bool)
        for i, j in apart_pairs(group):
            marked[i] = marked[j] = True
        if marked.any():
            yield group.filter(pa.array(marked))


def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links (u, v) between components of each group: texts are
    compared word by word until no two components are left that link, and no
    more links are given than components."""
    for group in runs_of(batches, 3):
        sets = numbered(byte_texts(group))
        node, comp = (group.column(c).to_pylist() for c in ("node", "comp"))
        over = {c: c for c in comp}

        def root(c: int, over: dict[int, int] = over) -> int:
            while over[c] != c:
                over[c] = over[over[c]]
                c = over[c]
            return c

        found = []
        for i, j in apart_pairs(group):
            x, y = root(comp[i]), root(comp[j])
            if x != y and alike(sets[i], sets[j]):
                over[max(x, y)] = min(x, y)
                found.append((max(node[i], node[j]), min(node[i], node[j])))
        if found:
            yield pa.RecordBatch.from_pydict({"u": pa.array([f[0] for f in found], pa.int64()), "v": pa.array([f[1] for f in found], pa.int64())})


def across_links(stars: DataFrame, classes: DataFrame, parts: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links (u, v) of nodes that share a star and lie in different
    components, enough to connect all that such links connect.

    The sets of a star's largest component are never compared with each other:
    they and the others are dealt into blocks of BLOCK_SETS sets and
    BLOCK_SHINGLES shingles, about, and each pair of blocks with one of the
    others is a group, so a star in which few sets are left out costs little more than its
    rows. Only members that pass the sketches bring their texts.
    """
    parallel = int(stars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labelled = classes.join(parts, "node", "left").select(F.col("d").alias("b"), "n", F.coalesce("component", "node").alias("comp"))
    placed = written(stars.join(labelled.hint("merge"), "b").select("a", F.col("b").alias("d"), "comp", "n"))
    each = placed.groupBy("a", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("size"))
    largest = each.groupBy("a").agg(F.max(F.struct("n", "size", "comp")).alias("m"), F.sum("n").alias("many"), F.sum("size").alias("size")).where("m.n < many")
    dealt = lambda n, size: F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(size / BLOCK_SHINGLES)).cast("long")
    split = largest.select("a", F.col("m.comp").alias("major"), dealt(F.col("m.n"), F.col("m.size")).alias("x"), dealt(F.col("many") - F.col("m.n"), F.col("size") - F.col("m.size")).alias("y"))
    members = placed.drop("n").join(split, "a").join(classes.select("d", "n", "node", "rep", "body", "sketch").hint("merge"), "d")
    major, x, y = F.col("comp") == F.col("major"), F.col("x"), F.col("y")
    block = F.when(major, F.pmod(F.xxhash64("d"), x)).otherwise(x + F.pmod(F.xxhash64("d"), y))
    spread = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.when(major, x).otherwise(0), x + y - 1)))
    rows = spread.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")}).select([c.split()[0] for c in MEMBERS.split(", ")])
    # Work grows with the square of a group, so groups are dealt by number, not by bytes.
    order = ["a", "p", "q", "n", "node"]
    rows = rows.repartition(parallel, "a", "p", "q").sortWithinPartitions(*order)
    found = written(rows.mapInArrow(released(active), MEMBERS))
    texts = written(fetch(docs, found.selectExpr("node AS k", "rep AS i", "body AS c")))
    held = found.join(texts.withColumnRenamed("k", "node").hint("merge"), "node").select([c.split()[0] for c in MEMBERS.split(", ")] + ["text"])
    held = held.repartition(parallel, "a", "p", "q").sortWithinPartitions(*order)
    links = written(held.mapInArrow(released(spanned), "u long, v long").distinct())
    discard(placed, found, texts)
    return links


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes with the id and digest of their component, set table)."""
    spark = docs.sparkSession
    sets = written(set_table(docs))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "body", "n_shingles", "sketch")).alias("r")
    grouped = sets.where("d IS NOT NULL").groupBy("d", "e").agg(rep)
    classes = written(grouped.select(F.monotonically_increasing_id().alias("node"), "d", "e", F.col("r.n_shingles").alias("n"), F.col("r.doc_id").alias("rep"), F.col("r.body").alias("body"), F.col("r.sketch").alias("sketch")))
    plan, rows = planned(sets)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
    pairs = written(blocks(docs, plan, buckets).groupBy("bucket").applyInPandas(_match, "a long, b long").distinct())
    # A star holds its centre as well.
    stars = pairs.unionByName(pairs.select("a", F.col("a").alias("b")).distinct())
    links = verify(pairs, classes, docs)
    parts = components(links)
    more = across_links(stars, classes, parts, docs)
    if not more.isEmpty():
        discard(parts)
        parts = components(links.unionByName(more).distinct())
    discard(pairs, more, links)
    # Nodes are numbers without meaning; a component is named by its least id.
    names = parts.join(classes.select("node", "rep", "body"), "node")
    least = names.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("z"), "rep", "body")).alias("low"))
    named = parts.join(least, "component").select("node", "low")
    final = classes.drop("sketch").join(named, "node", "left")
    own = F.col("low").isNull()
    final = written(final.select("d", "e", F.when(own, F.col("rep")).otherwise(F.col("low.rep")).alias("component_id"), F.when(own, F.col("body")).otherwise(F.col("low.body")).alias("component_body")))
    discard(parts, classes)
    return final, sets


def placed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, body, n_shingles, component_id and component_body, the id and the
    text's digest of the first row of the component, of every row."""
    classes, sets = linked(docs)
    c = classes.withColumnsRenamed({"d": "cd", "e": "ce"})
    joined = sets.drop("sketch", "first", "probe").join(c.hint("merge"), (F.col("d") == F.col("cd")) & (F.col("e") == F.col("ce")), "left")
    own = lambda mine, other: F.when(F.col("d").isNull(), F.col(mine)).otherwise(F.col(other)).alias(other)
    return joined.select("doc_id", "body", "n_shingles", own("doc_id", "component_id"), own("body", "component_body"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    return placed_rows(docs).select("doc_id", "n_shingles", "component_id")


def keep(docs: DataFrame) -> DataFrame:
    """One document of each component (the smallest id, of its texts the one
    with the smallest digest), with all columns. Rows with a null id can't be
    told apart by it and stay."""
    found = written(placed_rows(docs)).where("doc_id IS NULL OR doc_id = component_id AND body = component_body")
    i, c, r = (fresh(docs, f"keep_{x}") for x in ("id", "body", "rows"))
    ids = found.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias(r)).withColumnsRenamed({"doc_id": i, "body": c})
    body = body_of("text")
    joined = docs.join(ids.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (body == F.col(c)))
    single = joined.where((F.col(r) == 1) | F.col("doc_id").isNull()).select(*docs.columns)
    repeated = any_row(joined.where((F.col(r) > 1) & F.col("doc_id").isNotNull()), i, c).select(*docs.columns)
    return single.unionByName(repeated)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
