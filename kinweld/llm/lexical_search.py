"""Ranked lexical search over an index whose documents are reordered.

Recursive graph bisection brings documents that share terms together: a set of
documents is halved, and pairs that gain by it swap sides, until the halves
settle; then each half is halved. Its upper levels are fitted on a bounded
sample (``SAMPLE`` documents in expectation, at most ``BUCKETS`` hashed terms
each) and kept as a tree of term weights that routes every document to a leaf.
A leaf is dealt into shards of about ``SHARD_DOCS`` documents or
``SHARD_BYTES`` bytes by a hash of the row, so no shard grows with the data or
with a group of copies; each shard is bisected on its own terms, down to
clusters of ``CLUSTER`` neighbours, and inverted. The sample moves only the
order, never a result; every document is indexed with all its terms.

A search gives every shard a bound for every query, from the largest term
frequency and the shortest document of each posting list. The ``PROBES``
shards with the highest bound are visited first; their results are the floor
of the query, and of all other shards only those whose bound reaches it are
visited. Inside a shard clusters are visited by their bounds (block maxima of
the exact impacts) and left out when they stay below the floor. A bound equal
to the floor is always visited, since a smaller doc_id wins a tie; so the
stopping is exact.

Queries are worked on in blocks of a bounded number of terms; a block is what
workers hold of the queries. Null texts have no terms and rank nowhere. Rows
are documents: repeats rank beside each other, null ids after the others of
equal score. Of benchmark rows that repeat an item_id one counts, chosen by a
hash of the row; null is an id like others. Empty tables give no row.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweld.llm.common import any_row, byte_texts, release, released, slices, table, written

TOP = 10
SAMPLE, LEVELS, BUCKETS, ROUNDS = 4_096, 5, 1 << 15, 8
SHARD_DOCS, SHARD_BYTES, CLUSTER = 1_024, 4 << 20, 64
PROBES = 4
#: Terms of queries in one block.
BLOCK = 100_000
STEPS = 1 << 30
#: Bytes that belong to terms, A to Z made small; the others are blanks.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


# --- Recursive graph bisection over documents as arrays of term numbers -----


def _cost(degree: np.ndarray, size: int) -> np.ndarray:
    """Bits that the gaps of posting lists of these lengths take in a half."""
    return degree * np.log2((size + 1) / (degree + 1))


def _flat(starts: np.ndarray, ids: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of the documents ``part`` and whose they are, as their place in it."""
    sizes = starts[part + 1] - starts[part]
    owner = np.repeat(np.arange(len(part)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return ids[starts[part][owner] + within], owner


def halves(starts: np.ndarray, ids: np.ndarray, part: np.ndarray, n_terms: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """``part`` in two, ``first`` documents in the first half."""
    flat, owner = _flat(starts, ids, part)
    right = np.arange(len(part)) >= first
    total = np.bincount(flat, minlength=n_terms)
    n_left, n_right = first, len(part) - first
    for _ in range(ROUNDS):
        b = np.bincount(flat[right[owner]], minlength=n_terms)
        a = total - b
        now = _cost(a, n_left) + _cost(b, n_right)
        to_right = now - _cost(np.maximum(a - 1, 0), n_left) - _cost(b + 1, n_right)
        to_left = now - _cost(a + 1, n_left) - _cost(np.maximum(b - 1, 0), n_right)
        gain = np.bincount(owner, np.where(right[owner], to_left[flat], to_right[flat]), len(part))
        l, r = np.flatnonzero(~right), np.flatnonzero(right)
        l, r = l[np.argsort(-gain[l], kind="stable")], r[np.argsort(-gain[r], kind="stable")]
        k = min(len(l), len(r))
        swaps = int(np.count_nonzero(gain[l[:k]] + gain[r[:k]] > 1e-9))
        if not swaps:
            break
        right[l[:swaps]], right[r[:swaps]] = True, False
    return part[~right], part[right]


def bisected(starts: np.ndarray, ids: np.ndarray, n_terms: int) -> np.ndarray:
    """The order of all documents, neighbours alike, down to clusters."""
    done, open_ = [], [np.arange(len(starts) - 1)]
    while open_:
        part = open_.pop()
        if len(part) <= CLUSTER:
            done.append(part)
            continue
        left, right = halves(starts, ids, part, n_terms, CLUSTER * max(1, math.ceil(len(part) / CLUSTER) // 2))
        open_ += [right, left]
    return np.concatenate(done) if done else np.empty(0, np.int64)


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Starts, hashed distinct terms and numbers of terms of texts."""
    starts, parts, sizes = [0], [], []
    for text in texts:
        words = terms_of(text)
        sizes.append(len(words))
        found = np.unique(np.fromiter((zlib.crc32(w) for w in set(words)), np.int64) % BUCKETS)
        parts.append(found)
        starts.append(starts[-1] + len(found))
    return np.array(starts), np.concatenate(parts) if parts else np.empty(0, np.int64), sizes


def fit_tree(starts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of buckets and the threshold at each node; node k's children
    are 2k + 1 (above its threshold) and 2k + 2."""
    nodes = (1 << LEVELS) - 1
    weights, thresholds = np.zeros((nodes, BUCKETS), np.float32), np.zeros(nodes)
    parts = {0: np.arange(len(starts) - 1)}
    for node in range(nodes):
        part = parts.pop(node, np.empty(0, np.int64))
        if len(part) < 4:
            continue
        left, right = halves(starts, ids, part, BUCKETS, len(part) // 2)
        a, b = (np.bincount(_flat(starts, ids, half)[0], minlength=BUCKETS) for half in (left, right))
        weights[node] = np.log2((a + 1) / (len(left) + 1)) - np.log2((b + 1) / (len(right) + 1))
        flat, owner = _flat(starts, ids, part)
        score = np.bincount(owner, weights[node][flat], len(part))
        thresholds[node] = np.median(score)
        above = score > thresholds[node]
        parts[2 * node + 1], parts[2 * node + 2] = part[above], part[~above]
    return weights, thresholds


def _learned(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tree, from a sample by a hash of the row's place."""
    n = docs.count()
    share = min(STEPS, math.ceil(STEPS * SAMPLE / max(1, n)))
    some = docs.select("text", F.monotonically_increasing_id().alias("row")).where(F.pmod(F.xxhash64("row"), F.lit(STEPS)) < share).select("row", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                starts, ids, _ = _features(byte_texts(batch))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))], ["row", "ids"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r, np.array(ids, np.int64)) for b in batches for r, ids in zip(b.column(0).to_pylist(), (x.values.to_numpy() for x in b.column(1)), strict=True))
        starts = np.concatenate([[0], np.cumsum([len(x) for _, x in rows])]).astype(np.int64)
        weights, thresholds = fit_tree(starts, np.concatenate([x for _, x in rows] or [np.empty(0, np.int64)]))
        yield pa.RecordBatch.from_pydict({"weights": pa.array([zlib.compress(weights.astype(np.float16).tobytes(), 1)]), "thresholds": pa.array([thresholds.tobytes()])})

    row = some.mapInArrow(released(features), "row long, ids array<int>").repartition(1).mapInArrow(released(fit), "weights binary, thresholds binary").first()
    weights = np.frombuffer(zlib.decompress(row["weights"]), np.float16).reshape(-1, BUCKETS)
    return weights, np.frombuffer(row["thresholds"])


# --- The index --------------------------------------------------------------

INDEX = "shard bigint, term binary, df int, best_tf int, least_n int, ords array<int>, tfs array<int>, docs array<bigint>, ns array<int>"


def _routed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row, leaf, n) of all documents."""
    tree = docs.sparkSession.sparkContext.broadcast(_learned(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = tree.value
        for whole in batches:
            for batch in slices(whole):
                starts, ids, sizes = _features(byte_texts(batch))
                node = np.zeros(batch.num_rows, np.int64)
                owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))
                for _ in range(LEVELS):
                    score = np.bincount(owner, weights[node[owner], ids].astype(np.float64), batch.num_rows)
                    node = np.where(score > thresholds[node], 2 * node + 1, 2 * node + 2)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((node - len(thresholds)).astype(np.int32)), pa.array(sizes, pa.int32())], ["doc_id", "text", "row", "leaf", "n"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    return narrow.mapInArrow(released(run), "doc_id bigint, text string, row bigint, leaf int, n int")


def _inverted(group: pa.Table) -> pa.Table:
    """Rows of INDEX of one shard: one with its documents in order, one for
    each term."""
    group = group.combine_chunks()
    group = group.take(pa.compute.sort_indices(group, [("row", "ascending")]))
    texts = [x for b in group.select(["text"]).to_batches() for x in byte_texts(b)]
    vocabulary: dict[bytes, int] = {}
    of: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for text in texts:
        found = Counter(terms_of(text))
        of.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), np.int64, len(found)))
        counts.append(np.fromiter(found.values(), np.int64, len(found)))
    starts = np.concatenate([[0], np.cumsum([len(x) for x in of])]).astype(np.int64)
    ids, tfs = np.concatenate(of), np.concatenate(counts)
    df = np.bincount(ids, minlength=len(vocabulary))
    # A term of one document moves nothing.
    shared = df[ids] > 1
    kept = np.concatenate([[0], np.cumsum(shared)])[starts]
    order = bisected(kept, ids[shared], len(vocabulary))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ns = np.add.reduceat(np.append(tfs, 0), starts[:-1]) * (np.diff(starts) > 0) if len(texts) else np.empty(0, np.int64)
    ords = place[np.repeat(np.arange(len(texts)), np.diff(starts))]
    by = np.lexsort((ords, ids))
    ids, ords, tfs = ids[by], ords[by], tfs[by]
    at = np.concatenate([[0], np.cumsum(df)])
    owner_n = ns[order][ords]
    first = at[:-1]
    best, least = (np.maximum.reduceat(tfs, first), np.minimum.reduceat(owner_n, first)) if len(first) else (tfs, owner_n)
    shard = group.column("shard")[0].as_py()
    v, i32 = len(vocabulary), pa.int32()
    ints = lambda x: pa.array(x.astype(np.int32))
    lists = lambda x: pa.ListArray.from_arrays(ints(at), ints(x))
    words = pa.table([pa.array([shard] * v, pa.int64()), pa.array(list(vocabulary), pa.binary()), ints(df), ints(best), ints(least), lists(ords), lists(tfs), pa.nulls(v, pa.list_(pa.int64())), pa.nulls(v, pa.list_(i32))], names=NAMES)
    ids_in_order = group.column("doc_id").combine_chunks().take(pa.array(order))
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(order)], i32), x)
    head = pa.table([pa.array([shard], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, i32), pa.nulls(1, i32), pa.nulls(1, i32), pa.nulls(1, pa.list_(i32)), pa.nulls(1, pa.list_(i32)), whole(ids_in_order), whole(ints(ns[order]))], names=NAMES)
    release()
    return pa.concat_tables([words, head])


NAMES = ["shard", "term", "df", "best_tf", "least_n", "ords", "tfs", "docs", "ns"]


def build(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """The index of all documents, as a table of the shared folder, the number
    of documents with a term, and of all terms."""
    routed = written(_routed(docs.select("doc_id", "text")))
    leaves = routed.groupBy("leaf").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text")).alias("bytes"), F.count(F.when(F.col("n") > 0, 1)).alias("some"), F.sum("n").alias("terms")).orderBy("leaf").collect()
    pieces = {r["leaf"]: max(1, math.ceil(r["docs"] / SHARD_DOCS), math.ceil((r["bytes"] or 0) / SHARD_BYTES)) for r in leaves}
    sizes, offsets, at = [1] * (1 << LEVELS), [0] * (1 << LEVELS), 0
    for leaf, k in pieces.items():
        sizes[leaf], offsets[leaf], at = k, at, at + k
    listed = lambda xs: F.get(F.lit(xs).cast("array<bigint>"), F.col("leaf"))
    dealt = routed.withColumn("shard", listed(offsets) + F.pmod(F.xxhash64("row"), listed(sizes)))
    index = written(dealt.select("shard", "row", "doc_id", "text").groupBy("shard").applyInArrow(_inverted, INDEX))
    return index, sum(r["some"] for r in leaves), sum(r["terms"] for r in leaves)


# --- The search -------------------------------------------------------------


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, qf) of every item's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(byte_texts(batch)):
                found = Counter(terms_of(text))
                if found:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(found))), pa.array(list(found), pa.binary()), pa.array(found.values(), pa.int64())], ["item_id", "term", "qf"])

    one = any_row(items.select("item_id", "text"), "item_id").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    return one.mapInArrow(released(run), "item_id bigint, term binary, qf bigint")


def _visit(index: DataFrame, asked: DataFrame, terms: DataFrame, block: dict[int | None, list[tuple[bytes, int]]], documents: int, length: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each pair (shard,
    item_id, floor) of ``asked``. ``terms`` are the terms of the block."""
    queries = index.sparkSession.sparkContext.broadcast(block)

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and pairs.num_rows:
            shard = Shard(rows, documents, length)
            for item, floor in zip(pairs.column("item_id").to_pylist(), pairs.column("floor").to_pylist(), strict=True):
                for doc, score in shard.best(queries.value[item], floor, top):
                    out[0].append(item), out[1].append(doc), out[2].append(score)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["item_id", "doc_id", "score"])

    shards = asked.select("shard").distinct()
    few = index.select("shard", "term", "ords", "tfs", "docs", "ns").join(shards, "shard", "left_semi")
    needed = few.where(F.col("term").isNull()).unionByName(few.join(terms, "term", "left_semi"))
    return needed.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(run, "item_id bigint, doc_id bigint, score bigint")


class Shard:
    """The posting lists of one shard that the queries need, with impacts and
    the largest impact of each list in each cluster."""

    def __init__(self, rows: pa.Table, documents: int, length: int) -> None:
        rows = rows.combine_chunks()
        terms = rows.column("term").to_pylist()
        head = terms.index(None)
        self.docs = rows.column("docs")[head].values
        ns = rows.column("ns")[head].values.to_numpy().astype(np.int64)
        m = 25 + 75 * ns * documents // length
        self.lists: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for term, ords, tfs in zip(terms, rows.column("ords"), rows.column("tfs"), strict=True):
            if term is None:
                continue
            at, tf = ords.values.to_numpy(), tfs.values.to_numpy().astype(np.int64)
            impact = 1_000_000_000 * tf // (1_000 * tf + 8 * m[at])
            cluster = at // CLUSTER
            first = np.flatnonzero(np.diff(cluster, prepend=-1))
            self.lists[term] = at, impact, cluster[first], np.maximum.reduceat(impact, first)
        self.clusters = -(-len(ns) // CLUSTER)

    def best(self, query: list[tuple[bytes, int]], floor: int, top: int) -> list[tuple[int | None, int]]:
        """Up to ``top`` documents with at least the floor and more than 0."""
        lists = [(w, *self.lists[t]) for t, w in query if w > 0 and t in self.lists]
        bound = np.zeros(self.clusters, np.int64)
        for w, _, _, cluster, most in lists:
            bound[cluster] += w * most
        order = np.argsort(-bound, kind="stable")
        found_at, found = np.empty(0, np.int64), np.empty(0, np.int64)
        floor = max(floor, 1)
        done, step = 0, 1
        while done < len(order) and bound[order[done]] >= floor:
            now = order[done : done + step]
            now = now[bound[now] >= floor]
            score = self._scores(lists, now)
            hit = np.flatnonzero(score >= floor)
            found_at, found = np.append(found_at, hit), np.append(found, score[hit])
            if len(found) >= top:
                floor = max(floor, int(np.partition(found, len(found) - top)[len(found) - top]))
                keep = found >= floor
                found_at, found = found_at[keep], found[keep]
            done, step = done + step, 4 * step
        ids = self.docs.take(pa.array(found_at)).to_pylist()
        ranked = sorted(zip(ids, found.tolist(), strict=True), key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        return ranked[:top]

    def _scores(self, lists: list[tuple], clusters: np.ndarray) -> np.ndarray:
        """Scores of the documents of some clusters, 0 elsewhere."""
        chosen = np.zeros(self.clusters, bool)
        chosen[clusters] = True
        score = np.zeros(len(self.docs), np.int64)
        for w, at, impact, _, _ in lists:
            within = chosen[at // CLUSTER]
            score[at[within]] += w * impact[within]
        return score


def _search_block(index: DataFrame, terms: DataFrame, documents: int, length: int, top: int) -> DataFrame:
    """(item_id, doc_id, score) of one block of query terms; a superset of the
    results, at most ``top`` for a query and shard."""
    vocabulary = terms.select("term").distinct()
    heads = written(index.select("shard", "term", "df", "best_tf", "least_n").join(vocabulary, "term", "left_semi"))
    df = heads.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * documents + 2)).cast("double") / (2 * F.col("df") + 1))).cast("bigint")
    weighed = written(terms.join(df, "term").select("item_id", "term", (F.col("qf") * weight).alias("w")))
    block: dict[int | None, list[tuple[bytes, int]]] = {}
    for r in weighed.collect():
        block.setdefault(r["item_id"], []).append((bytes(r["term"]), r["w"]))
    m = f"(25 + (75L * least_n * {documents}L) div {length}L)"
    impact = F.expr(f"w * ((1000000000L * best_tf) div (1000L * best_tf + 8L * {m}))")
    bounds = written(heads.join(weighed, "term").groupBy("shard", "item_id").agg(F.sum(impact).alias("bound")).where("bound > 0"))
    ranked = Window.partitionBy("item_id").orderBy(F.col("bound").desc(), "shard")
    first = written(bounds.withColumn("k", F.row_number().over(ranked)).where(F.col("k") <= PROBES).select("shard", "item_id", F.lit(0).cast("bigint").alias("floor")))
    probed = written(_visit(index, first, vocabulary, block, documents, length, top))
    score = Window.partitionBy("item_id").orderBy(F.col("score").desc())
    floors = probed.withColumn("k", F.row_number().over(score)).where(F.col("k") == top).select(F.col("item_id").alias("i"), F.col("score").alias("floor"))
    seen = first.select(F.col("shard").alias("s"), F.col("item_id").alias("j"))
    rest = bounds.join(floors, F.col("item_id").eqNullSafe(F.col("i")), "left").where(F.col("bound") >= F.coalesce("floor", F.lit(0)))
    rest = rest.join(seen, (F.col("shard") == F.col("s")) & F.col("item_id").eqNullSafe(F.col("j")), "left_anti")
    rest = written(rest.select("shard", "item_id", F.coalesce("floor", F.lit(0).cast("bigint")).alias("floor")))
    return probed.unionByName(_visit(index, rest, vocabulary, block, documents, length, top))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's best documents."""
    terms = written(query_terms(items))
    n = terms.count()
    index, documents, length = build(docs)
    blocks = max(1, math.ceil(n / BLOCK))
    if not documents or not n:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    found = None
    for b in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        more = _search_block(index, part, documents, length, top)
        found = more if found is None else found.unionByName(more)
    ranked = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
  GROUP BY ALL
), sizes AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), whole AS (
  SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM sizes
), m AS (
  SELECT doc_id, 25 + (75 * n * documents) // length AS m FROM sizes, whole
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term
), asked AS (
  SELECT item_id, term, count(*) AS qf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, sum(qf * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""
