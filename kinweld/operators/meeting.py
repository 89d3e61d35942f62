"""Names that have a piece in common, compared in the task where they meet.

Rows of pieces (of the shorter name) and of probes (of the longer one) come
sorted by their key. Of a key with few pairs, all are judged, those of many
such keys at once. Of a key with very many, as the end of a name that thousands have, both sides are sorted
by the end that more of them share and cut into chunks: two chunks whose common
letters differ by more than the edits allowed are left out as a whole, those
left are judged by one bit operation a pair, and of pairs that pass, only what
lies beyond the part that both chunks share is compared. Nothing is left out
that may be similar.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kinweld.functions.similarity import FULL, WORD, code_matrix, codes_of, fallen, lcs_lengths, masks_of

#: Columns of the rows that meet; letters: two words of letter counts.
ROWS = "key long, probe boolean, name string, mask int, p int, letters long, letters_too long"
FOUND = "name string, mask int, name2 string, mask2 int"
#: Rows read before their keys are compared, if a key ends there.
HELD = 1 << 17
#: A key with more pairs has all of them judged as a table.
MANY = 2_000
#: A key with more pairs is compared by chunks of so many names.
MOST, CHUNK = 1 << 23, 128
#: Pairs judged at once.
PAIRS = 1 << 18


class Meeting:
    """Some rows with all rows of their keys."""

    def __init__(self, table: pa.Table, threshold: float) -> None:
        names = table["name"].combine_chunks().dictionary_encode()
        self.threshold, self.names = threshold, names.dictionary
        self.u = names.indices.to_numpy()
        self.flat, self.lengths = codes_of(self.names)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.n = self.lengths.astype(np.int32)[self.u]
        rank = np.empty(len(self.names), np.int32)
        rank[pc.sort_indices(self.names).to_numpy()] = np.arange(len(self.names))
        self.rank = rank[self.u]
        self.key, self.probe, self.mask, self.p = (table[c].to_numpy() for c in ("key", "probe", "mask", "p"))
        self.letters, self.letters_too = (table[c].to_numpy().view(np.uint64) for c in ("letters", "letters_too"))
        self.allowed = np.floor(np.arange(2 * max(self.lengths, default=0) + 1) * ((100 - threshold) / 100) + 1e-9).astype(np.int32)

    def likely(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of a piece and a probe have nearly all letters and the
        place of the piece in common, the first name not being longer."""
        n, m = self.n[i], self.n[j]
        gap = m - n
        deleted = (self.allowed[n + m] - gap) >> 1
        ok = (gap >= 0) & (deleted >= 0)
        ok &= np.bitwise_count(self.letters[i] ^ self.letters[j]) + np.bitwise_count(self.letters_too[i] ^ self.letters_too[j]) <= 2 * deleted + gap
        ok &= (gap > 0) | (self.rank[i] < self.rank[j])
        left = np.flatnonzero(ok)
        i, j, deleted, gap = i[left], j[left], deleted[left], gap[left]
        moved = self.p[j] - self.p[i]
        return left[(moved >= -deleted) & (moved <= deleted + gap) & (self.mask[i] & self.mask[j] == 0)]

    def reached(self, i: np.ndarray, j: np.ndarray, lcs: np.ndarray) -> np.ndarray:
        return 200.0 * lcs / (self.n[i] + self.n[j]) >= self.threshold

    def one_by_one(self, starts: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Similar pairs of keys: ``n1`` pieces from ``starts`` on, then ``n2``
        probes."""
        ends = np.cumsum(n1 * n2)
        for at in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            pair = np.arange(at, min(at + PAIRS, ends[-1]))
            g = np.searchsorted(ends, pair, side="right")
            rest = pair - (ends[g] - n1[g] * n2[g])
            i, j = starts[g] + rest // n2[g], starts[g] + n1[g] + rest % n2[g]
            alike = np.flatnonzero(np.bitwise_count(self.letters[i] ^ self.letters[j]) <= self.allowed[self.n[i] + self.n[j]])
            yield from self.judged(i[alike], j[alike])

    def judged(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ok = self.likely(i, j)
        i, j = i[ok], j[ok]
        if len(i):
            ok = self.reached(i, j, lcs_lengths(self.names.take(self.u[i]), self.names.take(self.u[j])))
            yield i[ok], j[ok]

    def as_table(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Similar pairs of rows of pieces and rows of probes."""
        if not len(one) or not len(two):
            return
        most = np.uint8(min(int(self.allowed[self.n[one].max() + self.n[two].max()]), 126))
        step = max(1, PAIRS // len(two))
        for k in range(0, len(one), step):
            alike = np.flatnonzero(np.bitwise_count(self.letters[one[k : k + step]][:, None] ^ self.letters[two]) <= most)
            i, j = np.divmod(alike, len(two))
            yield from self.judged(one[k + i], two[j])

    def by_chunks(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """:meth:`as_table` of a key with very many."""
        long = self.n > WORD
        yield from self.as_table(one[long[one]], two)
        yield from self.as_table(one[~long[one]], two[long[two]])
        one, two = one[~long[one]], two[~long[two]]
        if not len(one) or not len(two):
            return
        held = np.unique(self.u[np.r_[one, two]])
        codes, size = code_matrix(self.flat, self.offsets[held], self.lengths[held])
        back, _ = code_matrix(self.flat, self.offsets[held], self.lengths[held], back=True)
        kind = ">u1" if size <= 256 else ">u4"
        plain, turned = (_as_bytes(c, kind) for c in (codes, back))
        ends = [len(np.unique(_as_bytes(c[:, :8], kind))) for c in (codes, back)]
        ordered = np.argsort(turned if ends[1] < ends[0] else plain, kind="stable")
        codes = (back if ends[1] < ends[0] else codes)[ordered]
        place = np.empty(len(self.names), np.int64)
        place[held[ordered]] = np.arange(len(held))
        sides = []
        for rows in (one, two):
            rows = rows[np.argsort(place[self.u[rows]], kind="stable")]
            at = np.arange(0, len(rows), CHUNK)
            c = codes[place[self.u[rows]]]
            lasts = np.minimum(at + CHUNK, len(rows)) - 1
            words = [[f.reduceat(w[rows], at) for f in (np.bitwise_and, np.bitwise_or)] for w in (self.letters, self.letters_too)]
            sides.append((rows, at, c, words, _shared(c[at], c[lasts]), np.minimum.reduceat(self.n[rows], at), np.maximum.reduceat(self.n[rows], at)))
        (xs, xat, xc, xw, xs_shared, xleast, xmost), (ys, yat, yc, yw, ys_shared, _, ymost) = sides
        columns, letters = np.ascontiguousarray(yc.T), self.letters[ys]
        chunk_of = np.arange(len(ys)) // CHUNK
        for a, first in enumerate(xat):
            mine = xs[first : first + CHUNK]
            most = self.allowed[xmost[a] + ymost]
            bound = sum(np.bitwise_count(w[0][a] & ~v[1]).astype(np.int64) + np.bitwise_count(v[0] & ~w[1][a]) for w, v in zip(xw, yw, strict=True))
            met = np.flatnonzero((bound <= most) & (ymost >= xleast[a]))
            if not len(met):
                continue
            shared = np.minimum(np.minimum(xs_shared[a], ys_shared), _shared(xc[first], yc[yat]))
            masks = masks_of(xc[first : first + CHUNK], size)
            for k in range(0, len(met), 16):
                those = met[k : k + 16]
                cols = np.flatnonzero(np.isin(chunk_of, those)) if len(those) < 3 else np.concatenate([np.arange(yat[t], min(yat[t] + CHUNK, len(ys))) for t in those])
                alike = np.flatnonzero(np.bitwise_count(self.letters[mine][:, None] ^ letters[cols]) <= np.uint8(min(most[those].max(), 126)))
                i, j = np.divmod(alike.astype(np.uint32), np.uint32(len(cols)))
                j = cols[j]
                ok = self.likely(mine[i], ys[j])
                i, j = i[ok], j[ok]
                n, m = self.n[mine[i]], self.n[ys[j]]
                same = np.minimum(shared[chunk_of[j]], n)
                for s in np.unique(same):
                    here = same == s
                    x, y = i[here], j[here]
                    full = FULL[n[here]] & ~FULL[s]
                    row = fallen(masks, x * size, columns, y, int(s), int(m[here].max()), full)
                    ok = self.reached(mine[x], ys[y], n[here] - np.bitwise_count(row & full))
                    yield mine[x[ok]], ys[y[ok]]

    def similar(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.r_[True, self.key[1:] != self.key[:-1]])
        sizes = np.diff(np.r_[starts, len(self.key)])
        n2 = np.add.reduceat(self.probe.astype(np.int64), starts)
        n1 = sizes - n2
        few = (n1 * n2 > 0) & (n1 * n2 <= MANY)
        yield from self.one_by_one(starts[few], n1[few], n2[few])
        for g in np.flatnonzero(n1 * n2 > MANY):
            one, two = np.split(np.arange(starts[g], starts[g] + sizes[g]), [n1[g]])
            yield from (self.as_table if n1[g] * n2[g] <= MOST else self.by_chunks)(one, two)

    def batches(self) -> Iterator[pa.RecordBatch]:
        for i, j in self.similar():
            if len(i):
                yield pa.RecordBatch.from_arrays([self.names.take(self.u[i]), pa.array(self.mask[i], pa.int32()), self.names.take(self.u[j]), pa.array(self.mask[j], pa.int32())], ["name", "mask", "name2", "mask2"])


def _as_bytes(codes: np.ndarray, kind: str) -> np.ndarray:
    """Rows as values that sort as the rows do."""
    rows = np.ascontiguousarray(codes.astype(kind))
    return rows.view(f"S{rows.dtype.itemsize * rows.shape[1]}").ravel()


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes rows have in common from the first on."""
    return np.logical_and.accumulate(a == b, axis=1).sum(axis=1)


def similar_where_met(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over :data:`ROWS` sorted by key and probe, with all rows
    of a key in one task: similar pairs, once for each key that they share."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, HELD
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            whole = int(np.searchsorted(key, key[-1]))
            if whole:
                yield from Meeting(table.slice(0, whole), threshold).batches()
            held, n = table.slice(whole).to_batches(), n - whole
            enough = max(HELD, 2 * n)
        if n:
            yield from Meeting(pa.Table.from_batches(held), threshold).batches()

    return over
