"""Ranked search, repeated lines and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, documents, words

from kinweld.llm import lexical_search, line_dedup, spelling

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    """Awkward rows, topics with common words, copies with one score."""
    rng = random.Random(5)
    rows = [(i, t) for i, t in awkward() if not t or len(t) < 100_000]
    for k in range(300):
        topic = k % 6
        own = [f"T{topic}x{rng.randint(0, 40)}" for _ in range(rng.randint(3, 60))]
        rows.append((1000 - k, " ".join([*own, *words(rng, rng.randint(3, 40), 30), *["the"] * rng.randint(0, 9)])))
    rows += [(2000 + k, "The same, the same T0x1 rare-word") for k in range(30)] + [(2000, "The same, the same T0x1 rare-word")]
    rows += [(k, "Alone the End") for k in (3000, None, None)]
    return rows


def ranked(rows, items, top=10):
    """By the definition, in Python integers."""
    docs = [(i, Counter(TERM.findall((t or "").translate(SMALL)))) for i, t in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, length = len(docs), sum(n for *_, n in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for w, k in df.items()}
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(SMALL)))
        scored = []
        for i, c, n in docs:
            m = 25 + 75 * n * n_docs // length
            if (s := sum(q * weight[w] * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w, q in asked.items() if w in c)) > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


ITEMS = [(1, "The T0x1 same t0x1"), (2, "T1x3 T1x4 w7 w7 w8"), (3, None), (4, "unknown only"), (5, ""), (6, "rare-word"), (7, "alone the end"), (8, "ünï 日本 \U0001f600"), (None, "T5x5 T4x4 the")]


@pytest.mark.parametrize("shard", [16, 1024])
def test_search_by_force(spark, monkeypatch, shard):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical_search, "BLOCK", 20 if shard == 16 else 1000)
    monkeypatch.setattr(lexical_search, "PROBES", 1)
    rows = corpus()
    items = spark.createDataFrame([*ITEMS, ITEMS[0]], "item_id long, text string").withColumnRenamed("n", "m")
    found = lexical_search.search(documents(spark, rows, clashing=True), items.selectExpr("*", "text AS term", "1 AS score"))
    assert Counter(map(tuple, found.collect())) == ranked(rows, ITEMS)


def test_search_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, [(1, None), (2, ", ;")])
    assert lexical_search.search(docs, items).count() == 0
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(documents(spark, corpus()), items.limit(0)).count() == 0


def test_search_of_a_very_long_text(spark):
    rng = random.Random(2)
    long = " ".join(words(rng, 700_000, 50_000))
    rows = [(1, long), (2, "w1 w2 w3"), (3, "w4")]
    items = [(1, "w1 w2 w49999 w7"), (2, "w4")]
    found = lexical_search.search(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, found.collect())) == ranked(rows, items)


def test_shards_stop_early():
    """A shard visits only the clusters whose bound reaches the floor."""
    rows = [(k, f"common w{k % 4}" + (" special" * (k % 3) if k < 64 else "")) for k in range(640)]
    import pyarrow as pa

    table = pa.table({"shard": [0] * len(rows), "row": list(range(len(rows))), "doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    made = lexical_search._inverted(table)
    shard = lexical_search.Shard(made.select(["shard", "term", "ords", "tfs", "docs", "ns"]), 640, 2000)
    seen = []
    scores = shard._scores
    shard._scores = lambda lists, clusters: (seen.append(len(clusters)), scores(lists, clusters))[1]
    assert len(shard.best([(b"special", 5000), (b"common", 1)], 0, 3)) == 3
    assert sum(seen) < shard.clusters == 10


def test_bisection_brings_likes_together():
    rng = np.random.default_rng(3)
    topics = rng.integers(0, 4, 512)
    docs = [np.unique(np.concatenate([t * 100 + rng.integers(0, 100, 20), 400 + rng.integers(0, 50, 10)])) for t in topics]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    order = lexical_search.bisected(starts, np.concatenate(docs), 450)
    assert sorted(order) == list(range(512))
    pure = [Counter(topics[order[k : k + 64]]).most_common(1)[0][1] for k in range(0, 512, 64)]
    assert sum(pure) > 400


def without_repeats(rows, least=2):
    """(doc_id, n_lines, n_dropped, kept text) by the definition."""
    key = lambda x: x.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(SMALL)
    who = lambda i, t: (i is None, i or 0, t or "" if i is None else "")
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(who(i, t))
    firsts = {k: min(v) if all(x[0] is False for x in v) or any(not x[0] for x in v) else None for k, v in holders.items()}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < least or firsts[key(x)] == who(i, t)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lined():
    rng = random.Random(8)
    pool = [f"  line number {k} of all \t" for k in range(40)] + ["short", "", " ", "123456789", "1234567890", "ÄÖ wide line", "日本語の十文字ぐらいの行です"]
    rows = [(i, t) for i, t in awkward() if i is not None]
    for k in range(120):
        own = [rng.choice(pool).swapcase() if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.randint(0, 12))]
        rows.append((k, "\n".join([*own, f"own line of {k}", *(["THE License Line"] if k % 3 else [])])))
    rows += [(200, "one of two rows\nthe license line"), (200, "one of two rows\nother row of it"), (201, "one of two rows\r\nx\n")]
    return rows


@pytest.mark.parametrize("hot", [1, 1000])
def test_lines_by_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "hot_rows", lambda n: hot)
    rows = lined()
    found, n_lines, n_dropped = line_dedup.apply(documents(spark, rows, clashing=True).selectExpr("*", "1 AS n_lines", "2 AS gone", "3 AS body", "4 AS h", "5 AS pos"))
    assert n_lines != "n_lines"
    assert Counter((r["doc_id"], r[n_lines], r[n_dropped], r["text"]) for r in found.collect()) == Counter(without_repeats(rows))


def test_lines_of_more_documents(spark):
    rows = [(k, f"held by many documents\nheld by pair {k // 2} of them") for k in range(5)] + [(4, "held by pair 1 of them")]
    found, _, n = line_dedup.apply(documents(spark, rows), least_docs=3)
    assert sorted((r["doc_id"], r[n]) for r in found.collect()) == sorted((i, d) for i, _, d, _ in without_repeats(rows, 3))


def test_lines_without_ids(spark):
    same = "a line that repeats"
    rows = [(None, f"{same}\nx"), (None, f"{same}\nx"), (None, f"{same}\ny"), (7, f"{same}\nseven"), (None, "no other has this\nno other has this")]
    found, _, n = line_dedup.apply(documents(spark, rows))
    assert sorted((r["text"], r[n]) for r in found.collect()) == [("a line that repeats\nseven", 0), ("no other has this\nno other has this", 0), ("x", 1), ("x", 1), ("y", 1)]


def test_long_text_of_lines(spark):
    long = "\n".join(f"this is line {k % 150_000}" for k in range(300_000))
    rows = [(1, "this is line 77\nthis is line 78"), (2, long)]
    found, n, d = line_dedup.apply(documents(spark, rows))
    got = {r["doc_id"]: (r[n], r[d], hashlib.md5(r["text"].encode()).digest()) for r in found.collect()}
    assert got == {i: (a, b, hashlib.md5(t.encode()).digest()) for i, a, b, t in without_repeats(rows)}


def test_no_lines(spark):
    assert line_dedup.apply(documents(spark, lined()).limit(0))[0].count() == 0


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(rows):
    """(word, n, form, form_n, root, n_near) by the definition."""
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if k >= 2 and len(w) >= 7}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: v for w in n if near[w] and n[v := min(near[w], key=lambda v: (-n[v], v))] >= 10 * n[w]}
    out = Counter()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w, n[w], form.get(w), n[form[w]] if w in form else None, root, len(near[w])] += 1
    return out


def misspelled():
    rng = random.Random(11)
    bases = ["".join(rng.choices("abcdé", k=rng.randint(7, 12))) for _ in range(25)] + ["aaaaaaa", "abababab"]
    pool = []
    for b in bases:
        pool += [b] * 60
        for _ in range(6):
            i = rng.randrange(len(b))
            v = rng.choice([b[:i] + b[i + 1 :], b[:i] + rng.choice("abcdéß") + b[i + 1 :], b[:i] + rng.choice("abcde") + b[i:]])
            pool += [v] * rng.choice([2, 2, 3, 30])
    pool += [f"prefix{a}{b}" for a in "abcdefghij" for b in "abcdefghij"] * 2
    rng.shuffle(pool)
    rows = [(k, " ".join(w.upper() if rng.random() < 0.2 else w for w in pool[40 * k : 40 * k + 40])) for k in range(len(pool) // 40 + 1)]
    return rows + [(i, t) for i, t in awkward() if not t or len(t) < 100_000] + [(None, "nullity nullity"), (5, "x×y÷zabcdefgh ÀÉabcdefg")]


@pytest.mark.parametrize("crowd", [3, 64])
def test_spelling_by_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    monkeypatch.setattr(spelling, "HELD", 50)
    rows = misspelled()
    found = spelling.variants(documents(spark, rows, clashing=True).selectExpr("*", "1 AS word", "2 AS n"))
    assert Counter(map(tuple, found.select("word", "n", "form", "form_n", "root", "n_near").collect())) == spelled(rows)


def test_spelling_chains(spark, monkeypatch):
    """Forms of forms, over more steps than one round takes."""
    steps = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx"]
    rows = [(None, f"{w} " * (2 * 20**k)) for k, w in enumerate(steps)]
    got = {r["word"]: r["root"] for r in spelling.variants(documents(spark, rows)).collect()}
    assert got == {r[0]: r[4] for r in spelled(rows)} and len(set(got.values())) == 1


def test_no_words(spark):
    assert spelling.variants(documents(spark, [(1, None), (2, "short words only")])).count() == 0
    assert spelling.variants(documents(spark, []).limit(0)).count() == 0
