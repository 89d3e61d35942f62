"""Operators that compare documents with each other."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from helpers import awkward, documents, words
from pyspark.sql import functions as F

from kinweld.llm import exact_dedup, jaccard_join, mixing, substring_dedup

BLANK = re.compile("[\x20\x09-\x0d]")


def as_sql(docs, sql):
    db = duckdb.connect()
    db.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    return db


# --- exact dedup ---------------------------------------------------------------


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 5000):
        digests = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        keys = exact_dedup._keys(digests)
        sizes, bits = exact_dedup.build_hash(keys)
        assert sorted(exact_dedup.find_slots(keys, sizes, bits)) == list(range(n))
        others = exact_dedup._keys(rng.integers(0, 256, (50, 32), dtype=np.uint8))
        assert all(-1 <= s < n for s in exact_dedup.find_slots(others, sizes, bits))


def exact_by_force(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[hashlib.sha256(BLANK.sub("", t or "").encode()).hexdigest()].append((-len(t or ""), d is None, d))
    return groups


def test_exact_dedup(spark):
    rng = random.Random(2)
    rows = awkward() + [(100 + k, " ".join(words(rng, rng.randint(0, 3), 4))) for k in range(300)]
    rng.shuffle(rows)
    got = Counter(map(tuple, exact_dedup.report(documents(spark, rows)).collect()))
    want = Counter()
    for digest, group in exact_by_force(rows).items():
        keep = min(group, key=lambda g: (g[0], g[1], g[2] or 0))[2]
        want.update((d, keep, len(group), d == keep, digest) for _, _, d in group)
    assert got == want


def test_exact_dedup_against_a_given_history(spark):
    docs = documents(spark, [(1, "a b"), (2, "ab"), (3, "x")])
    digests = exact_dedup.digests_of(docs)
    for known in (F.lit(True), F.lit(False), F.col("doc_id") == 2):
        found = {bytes(r["digest"]): (r["keep_id"], r["copies"]) for r in exact_dedup.resolve(digests, known).collect()}
        assert sorted(found.values()) == [(1, 2), (3, 1)]


def test_exact_keep(spark):
    docs = documents(spark, awkward(), clashing=True)
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect())) == [3, 5, 6, 7, 9]
    assert exact_dedup.keep(docs.limit(0)).count() == 0


# --- similar texts -------------------------------------------------------------


def shingle_set(text):
    """The shingles of a text, word by word."""
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def components_by_force(rows):
    """Component of each doc_id; texts and ids must be unique or equal."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def family(rng, rows, base, copies, edits, start):
    for k in range(copies):
        found = list(base)
        for _ in range(rng.randint(0, edits)):
            found[rng.randrange(len(found))] = f"z{rng.randint(0, 10**6)}"
        rows.append((start + k, " ".join(found)))


def test_jaccard_components(spark):
    rng = random.Random(7)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one "), (6, "a b c"), (7, "a b c d"), (8, "a b c d e"), (9, "A B c d E")]
    for j, n in enumerate((5, 6, 8, 12, 20, 40, 90, 200, 600)):
        family(rng, rows, words(rng, n, 10**6), 14, max(1, n // 18), 100 * (j + 1))
    shared = words(rng, 60, 10**6)
    rows += [(2000 + k, " ".join(words(rng, rng.randint(5, 80), 10**6) + shared + words(rng, 40, 10**6))) for k in range(60)]
    rng.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.report(documents(spark, rows)).collect()}
    assert got == components_by_force(rows)


def plans():
    """Allocations that differ in weights and in what is left over."""
    bands = jaccard_join.bands_up_to(1000)
    counted = [jaccard_join.allocate(np.full(bands, n), np.full(bands, a)) for n, a in ((10, 0.0), (10**6, 1e9), (10**9, 1e14))]
    tops = jaccard_join.band_starts_of(bands)[1:] - 1
    units = jaccard_join.difference(tops, jaccard_join.largest_partner(tops)) + 1
    for weight in (1, 2):
        counted += [(-(-units // weight) + more, np.full(bands, weight)) for more in (0, 1, 4)]
    return counted


def test_allocation_weighs_costs():
    few, many, most = plans()[:3]
    assert set(few[1]) == {1} and 2 in most[1]
    popular = jaccard_join.allocate(np.full(20, 1000), np.full(20, 1e12))
    rare = jaccard_join.allocate(np.full(20, 1000), np.zeros(20))
    assert (popular[0][:16] <= rare[0][:16]).all() and (popular[0] < rare[0]).any()


def test_allocation_covers_every_difference():
    """Sets that differ as much as linked ones may always share a signature."""
    rng = np.random.default_rng(3)
    for plan in plans():
        for n in (3, 4, 6, 7, 9, 14, 15, 20, 27, 33, 36, 47, 48, 64, 100, 333, 640):
            for extra in {0, 1, n // 7, int(jaccard_join.largest_partner(n)) - n}:
                b = n + extra
                if b > jaccard_join.largest_partner(n):
                    continue
                most = int(jaccard_join.difference(n, b))
                swap = (most - extra) // 2
                for _ in range(12 if n < 50 else 3):
                    pool = np.unique(jaccard_join.mix(rng.integers(0, 1 << 62, 4 * b + 8).astype(np.uint64)))
                    pool = rng.permutation(pool)
                    x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[swap:n], pool[n : n + swap + extra]]))
                    owner, sig = jaccard_join.signatures([x, y], plan)
                    assert set(sig[owner == 0]) & set(sig[owner == 1]), (n, b)


def test_tiny_sets_share_no_signature():
    rng = np.random.default_rng(8)
    sets = [np.unique(jaccard_join.mix(rng.integers(0, 1 << 62, n).astype(np.uint64))) for n in rng.integers(1, 21, 4000)]
    plan = jaccard_join.allocate(np.bincount(np.searchsorted(jaccard_join.band_starts_of(12), [len(x) for x in sets], "right") - 1, minlength=12), np.zeros(12))
    owner, sig = jaccard_join.signatures(sets, plan)
    assert not {k for k, x in enumerate(sets) if len(x) < 3} & set(owner.tolist())
    pairs = np.unique(np.stack([sig, owner.astype(np.uint64)], 1), axis=0)
    assert np.unique(pairs[:, 0], return_counts=True)[1].max() < 120


def test_verification_counts_words():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (" ".join(words(rng, rng.randint(1, 40), 3)) for _ in range(2))
        x, y = shingle_set(a), shingle_set(b)
        assert jaccard_join.similar(a.encode(), b.encode()) == (100 * len(x & y) >= 75 * len(x | y)), (a, b)


def test_jaccard_in_small_pieces(spark, monkeypatch):
    """Many buckets, many blocks of signatures, stars in several blocks."""
    monkeypatch.setattr(jaccard_join, "FLUSH", 200)
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", 50)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 3)
    rng = random.Random(21)
    rows = []
    for j, n in enumerate((9, 40, 120)):
        base = words(rng, n, 10**6)
        for k in range(40):
            found = list(base)
            for _ in range(rng.randint(0, max(1, n // 12))):
                found[rng.randrange(n)] = f"z{rng.randint(0, 10**6)}"
            rows.append((1000 * j + k, " ".join(found)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.report(documents(spark, rows)).collect()}
    assert got == components_by_force(rows)


def test_jaccard_awkward_rows(spark):
    docs = documents(spark, awkward(), clashing=True)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.report(docs).collect())
    big = next(n for d, n, _ in got if d == 7)
    assert got == Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 5), (None, 1, 4), (6, 1, 6), (7, big, 7), (8, big, 7), (9, 1, 9), (None, 0, None)])
    kept = jaccard_join.keep(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert jaccard_join.report(docs.limit(0)).count() == 0


def test_jaccard_null_and_repeated_ids(spark):
    rng = random.Random(13)
    base, other = words(rng, 60, 10**6), words(rng, 60, 10**6)
    left, right = ["z1", "z2", "z3", "z4", "z5", *base[5:]], [*base[:-5], "y1", "y2", "y3", "y4", "y5"]
    say = " ".join
    # 1 and 2 link with the text of null ids only, not with each other.
    rows = [(1, say(left)), (None, say(base)), (None, say(base)), (2, say(right)), (5, "another text of some words here"), (5, say(other)), (7, say([*other[:-1], "x"])), (5, say(other)), (None, "lone words without any id at all")]
    assert components_by_force([(1, say(left)), (2, say(right))])[2][1] == 2
    docs = documents(spark, rows)
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.report(docs).collect())
    assert got == Counter({(1, 1): 1, (None, 1): 2, (2, 1): 1, (5, 5): 3, (7, 5): 1, (None, None): 1})
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard_join.keep(docs).collect())
    assert kept == Counter({rows[0]: 1, rows[1]: 2, rows[4]: 1, rows[5]: 1, rows[8]: 1}), kept


def colliding(a, b):
    """Endings that give two texts one CRC-32."""
    rng = random.Random(1)
    endings = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=9)) for _ in range(300_000)]
    seen = {zlib.crc32(f" {e}".encode(), zlib.crc32(a.encode())): e for e in endings}
    found = next((seen[h], e) for e in endings if (h := zlib.crc32(f" {e}".encode(), zlib.crc32(b.encode()))) in seen)
    return f"{a} {found[0]}", f"{b} {found[1]}"


@pytest.mark.parametrize("ids", [(None, None), (9, 10), (9, 9)])
def test_jaccard_texts_of_one_checksum(spark, ids):
    """Texts of null or repeated ids are told apart whatever their checksums."""
    rng = random.Random(21)
    a, b = colliding(" ".join(words(rng, 60, 9_000)), " ".join(words(rng, 60, 9_000)))
    near = lambda t: t.rsplit(" ", 2)[0] + " other end"
    rows = [(ids[0], a), (5, near(a)), (ids[1], b), (6, near(b))]
    for given in (rows, rows[::-1]):
        found = Counter(r["component_id"] for r in jaccard_join.report(documents(spark, given)).collect())
        assert found == {5: 2, 6: 2}


def test_jaccard_repeated_id_joins_nothing_by_itself(spark):
    rng = random.Random(17)
    a, b = words(rng, 60, 10**6), words(rng, 60, 10**6)
    rows = [(3, " ".join(a)), (9, " ".join([*a[:-1], "x"])), (9, " ".join(b)), (12, " ".join([*b[:-1], "x"]))]
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.report(documents(spark, rows)).collect())
    assert got == Counter([(3, 3), (9, 3), (9, 9), (12, 9)])


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(50):
        pool = jaccard_join.mix(rng.integers(0, 1 << 62, 900).astype(np.uint64))
        a, b = np.unique(pool[: rng.integers(1, 600)]), np.unique(pool[rng.integers(0, 300) :])
        x, y = jaccard_join.odd_sketch(a), jaccard_join.odd_sketch(b)
        size = min(len(x), len(y))
        apart = np.bitwise_count(jaccard_join.folded(x, size) ^ jaccard_join.folded(y, size)).sum()
        assert apart <= len(np.setxor1d(a, b))
        assert jaccard_join.may_link(x, y, len(a), len(b)) == (apart <= jaccard_join.difference(len(a), len(b)))


# --- substrings ----------------------------------------------------------------


def split_by_force(text):
    """Sentences, character by character."""
    out, at, k = [], 0, 0
    while k < len(text):
        end = None
        if text[k] == "\n":
            end = k + 1
        elif text[k] in ".!?…":
            j = k
            while j < len(text) and text[j] in ".!?…":
                j += 1
            while j < len(text) and text[j] in "\"')]»”":
                j += 1
            if j == len(text) or text[j].isspace():
                end = j
            k = max(k, j - 1)
        if end is not None:
            while end < len(text) and text[end].isspace():
                end += 1
            out.append(text[at:end])
            at = end
            k = end - 1
        k += 1
    return out + [text[at:]] if at < len(text) else out


def cleaned_by_force(rows, least=15):
    """Text of each (doc_id, text) without its repeated passages: runs of two
    sentences and more, of every length, and sentences of 50 words, that stand
    at an earlier (doc_id, checksum, place)."""
    docs = sorted({(d, zlib.crc32((t or "").encode()), t or "") for d, t in rows if d is not None})
    first, places = {}, []
    for d, c, t in docs:
        said = split_by_force(t)
        filled = [(k, tuple(s.split())) for k, s in enumerate(said) if s.split()]
        for i in range(len(filled)):
            for j in range(i + 1, min(len(filled), i + 40) + 1):
                if j - i > 1 or len(filled[i][1]) >= 50:
                    run = tuple(w for _, w in filled[i:j])
                    first.setdefault(run, (d, c, i))
                    places.append((d, c, t, i, run, [k for k, _ in filled[i:j]]))
    gone = defaultdict(set)
    for d, c, t, i, run, ks in places:
        if first[run] != (d, c, i):
            gone[d, t] |= set(range(ks[0], ks[-1] + 1))
    out = {}
    for d, _, t in docs:
        said, block, left = split_by_force(t), [], []
        for k, s in enumerate([*said, None]):
            if k in gone[d, t]:
                block.append(s)
                continue
            if sum(len(x.split()) for x in block) < least:
                left += block
            block = []
            left.append(s or "")
        out[d, t] = "".join(left)
    return out


def test_substring_dedup(spark):
    rng = random.Random(5)
    passage = " ".join(" ".join(words(rng, 9)).capitalize() + "." for _ in range(7))
    rows = awkward()
    for k in range(30):
        own = lambda: " ".join(" ".join(words(rng, rng.randint(1, 12))) + rng.choice(".!?\n") for _ in range(6))
        rows.append((100 + k, own() + " " + (passage if k % 3 == 0 else "") + " " + own()))
    rows.append((200, f"{passage} middle words here. {passage}"))
    docs = documents(spark, rows, clashing=True)
    got = substring_dedup.clean(docs).collect()
    want = cleaned_by_force(rows)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r["doc_id"] is not None and texts[r["doc_id"]] is not None:
            assert r["text"] == want[r["doc_id"], texts[r["doc_id"]]]
    held = {r["doc_id"]: r["text"] for r in got}
    middle = " ".join(passage.split(". ")[1:-1])
    assert middle.split()[0] in held[100]
    assert passage[20:-60] in held[100] and all(passage[80:-80] not in held[d] for d in (103, 106, 127, 200))
    assert held[1] is None and substring_dedup.clean(docs.limit(0)).count() == 0


def said_of(rng, sizes, most=10**6):
    return " ".join(" ".join(words(rng, n, most)) + "." for n in sizes)


def test_substring_dedup_finds_every_run(spark):
    rng = random.Random(11)
    passages = [said_of(rng, sizes) for sizes in ([20, 7, 7], [7, 7, 20], [3, 3, 3, 3, 3], [1, 14], [9, 2, 2, 9], [60], [4, 5], [7, 1, 7])]
    rows = [(k, p) for k, p in enumerate(passages)] + [(20 + k, p) for k, p in enumerate(passages)]
    for k in range(60):
        own = lambda: said_of(rng, [rng.randint(1, 12) for _ in range(rng.randint(0, 4))])
        rows.append((100 + k, f"{own()} {rng.choice(passages)} {own()} {rng.choice(passages)}"))
    rows += [(300 + k, said_of(rng, [rng.randint(1, 9) for _ in range(rng.randint(1, 14))], 1)) for k in range(40)]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.clean(documents(spark, rows)).collect()}
    want = cleaned_by_force(rows)
    for d, t in rows:
        assert got[d] == want[d, t], (d, t)
    for least in (1, 40):
        got = {r["doc_id"]: r["text"] for r in substring_dedup.clean(documents(spark, rows), least).collect()}
        want = cleaned_by_force(rows, least)
        assert all(got[d] == want[d, t] for d, t in rows)


def test_substring_dedup_short_tail_and_repeated_ids(spark):
    rng = random.Random(19)
    run = said_of(rng, [10, 10, 3])
    rows = [(1, f"{run} {said_of(rng, [8, 9])}"), (2, f"{run} {said_of(rng, [9, 7])}")]
    other = said_of(rng, [12, 12])
    rows += [(5, f"{other} one."), (5, f"{other} two."), (5, f"{other} two.")]
    got = Counter((r["doc_id"], r["text"], r["n_removed"]) for r in substring_dedup.clean(documents(spark, rows)).collect())
    want = cleaned_by_force(rows)
    assert {(d, t) for d, t, _ in got} == {(d, want[d, t]) for d, t in rows}
    assert run not in want[2, rows[1][1]] and sum(n for (d, _, k), n in got.items() if d == 5 and k) in (1, 2)


def test_substring_dedup_hot_spans(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "hot_rows", lambda rows: 20)
    rng = random.Random(23)
    common, rare = said_of(rng, [9, 9, 9]), said_of(rng, [9, 9, 9])
    rows = [(k, f"{said_of(rng, [8])} {common} {said_of(rng, [8])} {rare if k in (3, 9) else ''}") for k in range(60)]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.clean(documents(spark, rows)).collect()}
    want = cleaned_by_force(rows)
    assert all(got[d] == want[d, t] for d, t in rows)


def test_sentences_make_up_the_text():
    for text in ("", "a. b! c?\n\nd", "no end", "x...y. \n z", "\n\n", "e.g. this. \"Quoted.\" Then"):
        assert "".join(substring_dedup.sentences_of(text)) == text
        assert substring_dedup.sentences_of(text) == split_by_force(text)


# --- mixing ----------------------------------------------------------------------


def targets_by_force(sizes):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            free.discard(s)


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(words(rng, rng.randint(0, 60) * (40 if k % 97 == 0 else 1))) if k % 11 else None, "en", rng.choice([None, "", "a", "b", "B", "é", "big", "big", "big"])) for k in range(400)]
    rows += [(1000, "lone", "en", "tiny")]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in mixing.report(docs).collect()}
    assert len(got) == len(rows)
    size = {d: len((t or "").split()) for d, t, _, _ in rows}
    by_source = defaultdict(int)
    for d, _, _, s in rows:
        by_source[s] += size[d]
    want = targets_by_force(dict(by_source))
    taken, largest = defaultdict(int), defaultdict(int)
    for d, _, _, s in rows:
        r = got[d]
        assert (r["size"], r["source_size"]) == (size[d], by_source[s]) and r["target"] == pytest.approx(want[s])
        assert r["taken"] <= 3 * size[d]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], size[d])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    assert {d: r["taken"] for d, r in got.items()} == {r["doc_id"]: r["taken"] for r in mixing.report(docs.orderBy(F.rand())).collect()}
    same = duckdb.connect()
    same.register("documents", docs.toPandas())
    assert sorted(same.sql(mixing.OP10_SQL).fetchall()) == sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"], r["position"]) for r in got.values())
    spots = [r["position"] for r in mixing.report(docs).collect()]
    placed = [x for x in spots if x is not None]
    assert placed == sorted(placed) and spots[len(placed) :] == [None] * (len(spots) - len(placed))


def test_mix_rows_and_order(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(words(rng, 30)), "en", "abc"[k % 3]) for k in range(120)] + [(500, None, "en", "a"), (501, "", "en", None)]
    docs = documents(spark, rows, clashing=True)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    taken = {r["doc_id"]: r["taken"] for r in mixing.report(docs).collect()}
    assert all(copies.get(d, 0) * len((t or "").split()) == taken[d] for d, t, _, _ in rows)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.report(docs.limit(0)).count() == 0


def test_mix_follows_the_curriculum(spark, monkeypatch):
    """Another ramp gives other positions and another order; a source whose
    weight rises comes later on average."""
    rng = random.Random(31)
    docs = documents(spark, [(k, " ".join(words(rng, 20)), "en", "abc"[k % 3]) for k in range(300)])
    found = [(r["source"], r["at"]) for r in mixing.mix(docs, "at").collect()]
    assert [x for _, x in found] == sorted(x for _, x in found) and 0 < found[0][1] and found[-1][1] <= 1
    mean = lambda rows, s: np.mean([x for y, x in rows if y == s])
    assert mean(found, "a") < mean(found, "b") < mean(found, "c")
    monkeypatch.setattr(mixing, "RAMPS", (0.5, 0.0, -0.5))
    turned = [(r["source"], r["at"]) for r in mixing.mix(docs, "at").collect()]
    assert mean(turned, "a") > mean(turned, "b") > mean(turned, "c")


def test_mix_repeated_ids_agree(spark):
    rows = [(7, " ".join(["w"] * n), "en", "ab"[n % 2]) for n in range(1, 60)] + [(7, None, "en", "a"), (None, "x y", "en", None)]
    docs = documents(spark, rows)
    runs = [Counter(map(tuple, mixing.report(docs.orderBy(F.rand(s)).repartition(3)).collect())) for s in range(3)]
    assert runs[0] == runs[1] == runs[2]


def test_running_sums(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 13).alias("v"))
    rows = sorted(mixing.running(df, [F.col("k")], {"s": "v"}).collect())
    total = 0
    for r in rows:
        assert r["s"] == total
        total += r["v"]


def test_positions_invert_demand(spark):
    rows = spark.range(101).select((F.col("id") / 100).alias("t"))
    for ramp in mixing.RAMPS:
        r = F.lit(ramp)
        demand = (1 - r) * F.col("t") + r * F.col("t") * F.col("t")
        for x in rows.select("t", mixing.position_at(demand, r).alias("back")).collect():
            assert x["back"] == pytest.approx(x["t"], abs=1e-9)
