"""Which profiles describe the same person.

Two profiles match if they share an email, a phone or a link, or else if
their names are similar enough and, for each kind of identifier, at least one
of them has none. Matches are closed transitively.

Shared identifiers: every profile is tied to the smallest profile with the
same value, which gives the same components as all pairs. Values are counted
with partial aggregation; hot ones are broadcast, so a value that a third of
all profiles share moves none of them. Similar names: the distinct (name,
kinds present) are compared, not profiles. Each name gives one piece more than
the edits allowed, pieces that don't overlap, and of all such choices the one
whose pieces are rarest among all names. An edit touches one piece at most, so
one of them stands, near its place, in any similar longer name: the join is an
equality join on pieces and loses nothing. The mask of the longer name is part
of the key, and pieces are chosen for each mask that a name may match: names
that can't match don't meet, however much alike they are. Pieces that are
frequent for all that are met in blocks of bounded size.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.functions.similarity import sorted_tokens
from kinweld.operators.components import components
from kinweld.operators.meeting import FOUND, similar_where_met
from kinweld.operators.skew import hot_bound, join_hot
from kinweld.sources.storage import discard, materialized, spread

log = logging.getLogger(__name__)


def check_threshold(threshold: float) -> float:
    if not 0 <= threshold <= 100:
        raise ValueError("name threshold must be between 0 and 100")
    return threshold


def link_values(links: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(links["linkedin"], links["github"], links["portfolio"])))


def keys_of(profiles: DataFrame) -> DataFrame:
    """What matching needs of profiles: id, emails, phones, links (values of
    all kinds of link), name (case-folded, words sorted), mask of kinds."""
    links = link_values(F.col("links"))
    mask = F.when(F.size("emails") > 0, 1).otherwise(0) + F.when(F.size("phones") > 0, 2).otherwise(0) + F.when(F.size(links) > 0, 4).otherwise(0)
    return profiles.select("id", "emails", "phones", links.alias("links"), F.when(F.coalesce("full_name", F.lit("")) != "", sorted_tokens(F.col("full_name"))).alias("name"), mask.alias("mask"))


def identifier_edges(keys: DataFrame, kind: str) -> DataFrame:
    """(a, b): each profile and the smallest one with the same value."""
    values = keys.select("id", F.explode(kind).alias("value")).where("value <> ''")
    least = values.groupBy("value").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("value", "shared")
    least = materialized(least)
    rows = least.agg(F.sum("n")).first()[0] or 0
    joined = join_hot(values, least, F.col("value") == F.col("shared"), F.col("n") > hot_bound(rows))
    return joined.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))


def _edits(lengths: Column, threshold: float) -> Column:
    """The most insertions and deletions between similar names of this length
    together."""
    return F.floor(lengths * ((100 - threshold) / 100) + 1e-9).cast("int")


def edits_allowed(shorter: Column, threshold: float) -> Column:
    """The most insertions and deletions between a name of this length and
    any similar one that isn't shorter."""
    return _edits(shorter + longest_partner(shorter, threshold), threshold)


def longest_partner(shorter: Column, threshold: float) -> Column:
    """The greatest length that can be similar to this one or a shorter one."""
    return F.floor(shorter * ((200 - threshold) / threshold) + 1e-9).cast("int")


def _sized(names: DataFrame, threshold: float) -> DataFrame:
    """``names`` as the shorter of a pair, with the edits allowed and the size
    of pieces: as large as leaves two places to choose from."""
    n = F.length("name")
    sized = names.withColumn("edits", edits_allowed(n, threshold))
    return sized.withColumn("q", F.greatest(F.lit(1), F.floor((n - 2) / (F.col("edits") + 1)).cast("int")))


def _grams(size: Column) -> Column:
    """Every piece of a name of a size, with its place from 0."""
    return F.transform(F.sequence(F.lit(0), F.length("name") - size), lambda p: F.struct(p.alias("p"), F.substr(F.col("name"), p + 1, size).alias("gram")))


def rarest_cut(costs: list[int], pieces: int, size: int) -> list[int]:
    """So many places, ``size`` apart at least, with the least sum of costs;
    the first of equal choices."""
    n = len(costs)
    # best[j][p]: the least sum of j pieces that start at p or later.
    best = [[0.0] * (n + size)]
    for _ in range(pieces):
        below, row = best[-1], [math.inf] * (n + size)
        for p in range(n - 1, -1, -1):
            row[p] = min(row[p + 1], costs[p] + below[p + size])
        best.append(row)
    chosen, p = [], 0
    for j in range(pieces, 0, -1):
        while best[j][p] != costs[p] + best[j - 1][p + size]:
            p += 1
        chosen.append(p)
        p += size
    return chosen


def _cut_where_met(held: list[dict[str, int]], places: int, pieces: int, size: int) -> list[int]:
    costs = [0] * places
    for x in held:
        costs[x["p"]] = x["n"]
    return [p for p in rarest_cut(costs, pieces, size) if costs[p]]


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def rarest_places(held: pd.Series, places: pd.Series, edits: pd.Series, size: pd.Series) -> pd.Series:
    """:func:`rarest_cut` of each list of (p, n), less the places that it has
    not: their pieces stand in no name, and so meet none."""
    return pd.Series([_cut_where_met(f, k, e + 1, q) for f, k, e, q in zip(held, places, edits, size, strict=True)], dtype=object)


def masks_to_meet(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``names`` as the shorter of a pair, once for each mask2 in the table
    that has no kind in common with their own; and as the longer, those that
    such a mask leaves. There are eight masks at most."""
    there = [r["mask"] for r in names.select("mask").distinct().collect()]
    met = F.filter(F.array(*map(F.lit, there)).cast("array<int>"), lambda m: m.bitwiseAND(F.col("mask").cast("int")) == 0)
    return names.withColumn("mask2", F.explode(met)), names.where(F.size(met) > 0)


def letter_counts(name: str, first: int = 0, places: int = 21) -> Column:
    """How often a name has each character, up to three, in 63 bits: characters
    share ``places`` places by their code, 21 of which, from ``first`` on, have
    as many bits set as their characters have been seen. An insertion or
    deletion changes one bit at most, in all words together."""
    of = f"filter(transform(regexp_extract_all({name}, '(?s).', 0), x -> pmod(ascii(x), {places}) - {first}), b -> b BETWEEN 0 AND 20)"
    return F.expr(f"aggregate({of}, 0L, (s, b) -> s | shiftleft((2 * (shiftright(s, 3 * b) & 7L) + 1L) & 7L, 3 * b))")


#: Places for characters in two words: digits and small letters don't share any.
PLACES = 39
#: Columns of the two words; names without them are cut all the same.
LETTERS = ("letters", "letters_too")


def _probes(names: DataFrame, threshold: float) -> DataFrame:
    """(name2, mask2, q, gram, p2) of names as the longer of a pair:
    all their pieces of the sizes that similar shorter names are cut into.
    Names too short for pieces have size 0 and their length."""
    longer = F.length("name")
    least = F.ceil(longer * (threshold / (200 - threshold)) - 1e-9).cast("int")
    lengths = F.sequence(F.greatest(F.lit(1), least), longer)
    edits = lambda n: edits_allowed(n, threshold)
    size = lambda n: F.greatest(F.lit(1), F.floor((n - 2) / (edits(n) + 1)).cast("int"))
    sizes = F.array_distinct(F.transform(F.filter(lengths, lambda n: n > edits(n)), size))
    cut = names.withColumn("q", F.explode(sizes)).withColumn("g", F.explode(_grams(F.col("q"))))
    short = names.withColumn("n", F.explode(F.filter(lengths, lambda n: n <= edits(n))))
    own = [F.col("name").alias("name2"), F.col("mask").cast("int").alias("mask2"), *[c for c in LETTERS if c in names.columns]]
    return cut.select(*own, "q", "g.gram", F.col("g.p").alias("p2")).unionByName(short.select(*own, F.lit(0).alias("q"), F.col("n").cast("string").alias("gram"), F.lit(0).alias("p2")))


def _pieces(names: DataFrame, threshold: float, counts: DataFrame, hot: int) -> DataFrame:
    """(name, mask, mask2, edits, q, gram, p) of names as the shorter of a pair
    with names of mask2: the rarest pieces by ``counts`` (q, gram, mask2, n),
    without those that stand in no such name."""
    sized = _sized(names, threshold)
    cut = sized.where(F.length("name") > F.col("edits"))
    own = ["name", "mask", "mask2", "edits", "q", *[c for c in LETTERS if c in names.columns]]
    grams = cut.withColumn("g", F.explode(_grams(F.col("q")))).select(*own, "g.gram", "g.p")
    known = counts.select(F.col("q").alias("cq"), F.col("gram").alias("cg"), F.col("mask2").alias("cm"), "n")
    counted = join_hot(grams, known, (F.col("q") == F.col("cq")) & (F.col("gram") == F.col("cg")) & (F.col("mask2") == F.col("cm")), F.col("n") > hot)
    whole = counted.groupBy(*own).agg(F.collect_list(F.struct("p", "n")).alias("held"))
    chosen = whole.select(*own, F.explode(rarest_places("held", F.length("name") - F.col("q") + 1, "edits", "q")).alias("p"))
    picked = chosen.select(*own, F.substr(F.col("name"), F.col("p") + 1, F.col("q")).alias("gram"), "p")
    short = sized.where(F.length("name") <= F.col("edits"))
    return picked.unionByName(short.select(*own[:4], F.lit(0).alias("q"), *own[5:], F.length("name").cast("string").alias("gram"), F.lit(0).alias("p")))


#: What a piece and a probe have in common.
MET = ["q", "gram", "mask2"]


def _in_blocks(pieces: DataFrame, probes: DataFrame, counts: DataFrame, hot: int, threshold: float) -> DataFrame:
    """(name, mask, name2, mask2) of similar pairs of a piece and a probe of the
    same (q, gram, mask2), once for each such piece. Of a piece with more than
    ``hot`` rows on a side, both sides are dealt into blocks of that many rows,
    and each block meets each block of the other side in a task."""
    own = pieces.groupBy(*[F.col(c).alias(f"h{c}") for c in MET]).agg(F.count(F.lit(1)).alias("n1"))
    on = reduce(Column.__and__, [F.col(f"h{c}") == F.col(c) for c in MET])
    both = own.join(counts, on).where((F.col("n1") > hot) | (F.col("n") > hot))
    parts = lambda c: F.ceil(F.col(c) / hot).cast("int")
    few = F.broadcast(both.select(*[f"h{c}" for c in MET], parts("n1").alias("b1"), parts("n").alias("b2")))

    def dealt(rows: DataFrame, name: str, mask: str, p: str, mine: str, others: str) -> DataFrame:
        block = F.pmod(F.xxhash64(name), F.coalesce(F.col(mine), F.lit(1))).cast("int")
        met = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(others), F.lit(1)) - 1))
        placed = rows.join(few, on, "left").withColumn(mine + "k", block).withColumn(others + "k", met)
        # Keys that happen to have one hash meet too: all that is found is tested.
        key = F.xxhash64(*MET, "b1k", "b2k").alias("key")
        return placed.select(key, F.lit(name == "name2").alias("probe"), F.col(name).alias("name"), F.col(mask).cast("int").alias("mask"), F.col(p).alias("p"), *LETTERS)

    rows = dealt(pieces, "name", "mask", "p", "b1", "b2").unionByName(dealt(probes, "name2", "mask2", "p2", "b2", "b1"))
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "key").sortWithinPartitions("key", "probe").mapInArrow(similar_where_met(threshold), FOUND)


def _any_names(names: DataFrame) -> DataFrame:
    """Pairs that connect what a threshold of 0 does, where all names of two
    compatible masks match: each with the least name of the other mask."""
    least = names.groupBy(F.col("mask").alias("mask2")).agg(F.min("name").alias("name2"))
    asked = names.withColumn("mask2", F.explode(F.sequence(F.lit(0), F.lit(7)))).where(F.col("mask").bitwiseAND(F.col("mask2")) == 0)
    found = asked.join(least, "mask2").where((F.col("name") != F.col("name2")) | (F.col("mask") != F.col("mask2")))
    return found.select("name", "mask", "name2", "mask2")


def similar_names(names: DataFrame, threshold: float) -> DataFrame:
    """Pairs (name, mask, name2, mask2) of distinct (name, mask) rows that may
    match by name: no kind of identifier is present in both, and the ratio
    reaches the threshold. ``names`` are distinct rows of a written table.

    Pairs are compared in the task in which their pieces meet, so that only
    similar ones are ever written or shuffled."""
    names = names.select("name", "mask")
    if threshold <= 0:
        return _any_names(names)
    lettered = materialized(spread(names).withColumns({c: letter_counts("name", 21 * k, PLACES) for k, c in enumerate(LETTERS)}))
    shorter, longer = masks_to_meet(lettered)
    probes = _probes(longer, threshold)
    counts = materialized(probes.groupBy(*MET).agg(F.count(F.lit(1)).alias("n")))
    hot = hot_bound(counts.agg(F.sum("n")).first()[0] or 0)
    pieces = materialized(_pieces(shorter, threshold, counts, hot))
    met = _in_blocks(pieces, probes, counts, hot, threshold)
    kinds = {f.name: f.dataType for f in names.schema}
    found = materialized(met.select("name", F.col("mask").cast(kinds["mask"]), "name2", "mask2").distinct())
    log.info("%d similar of %d pairs of names", found.count(), pairs_compared(names.count()))
    discard(lettered, counts, pieces)
    return found.unionByName(_equal_names(names))


def _equal_names(names: DataFrame) -> DataFrame:
    """Pairs of one name under two masks that have no kind in common. A name
    has eight masks at most, so they meet as one list."""
    masks = names.groupBy("name").agg(F.collect_set("mask").alias("masks"))
    each = masks.select("name", F.explode("masks").alias("mask"), "masks").select("name", "mask", F.explode("masks").alias("mask2"))
    return each.where((F.col("mask") < F.col("mask2")) & (F.col("mask").bitwiseAND(F.col("mask2")) == 0)).select("name", "mask", F.col("name").alias("name2"), "mask2")


def name_edges(keys: DataFrame, threshold: float) -> DataFrame:
    """(a, b) edges between profiles of similar names. Of two matching names
    every profile of one is tied to the smallest profile of the other, which
    connects them all, as all pairs would."""
    named = keys.where("name IS NOT NULL").select("id", "name", "mask")
    distinct = materialized(named.groupBy("name", "mask").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("held")))
    hot = F.col("held") > hot_bound(distinct.agg(F.sum("held")).first()[0] or 0)
    pairs = materialized(similar_names(distinct, threshold))
    least = distinct.select(F.col("name").alias("n"), F.col("mask").alias("m"), "least", "held")
    ways = pairs.unionByName(pairs.select(F.col("name2").alias("name"), F.col("mask2").alias("mask"), F.col("name").alias("name2"), F.col("mask2").alias("mask2")))
    # One row a name: the least profile of all names that it matches is enough
    # for all its profiles; the names themselves are tied by their least ones.
    targets = ways.join(least.select("n", "m", F.col("least").alias("other")), (F.col("name2") == F.col("n")) & (F.col("mask2") == F.col("m"))).select("name", "mask", "other")
    nearest = targets.groupBy(F.col("name").alias("n1"), F.col("mask").alias("m1")).agg(F.min("other").alias("other"))
    nearest = materialized(nearest.join(least.select("n", "m", "held"), (F.col("n1") == F.col("n")) & (F.col("m1") == F.col("m"))).select("n1", "m1", "other", "held"))
    across = join_hot(named, nearest, (F.col("name") == F.col("n1")) & (F.col("mask") == F.col("m1")), hot).select(F.col("other").alias("a"), F.col("id").alias("b"))
    between = targets.join(least, (F.col("name") == F.col("n")) & (F.col("mask") == F.col("m"))).select(F.col("other").alias("a"), F.col("least").alias("b"))
    free = join_hot(named.where("mask = 0"), least.where("m = 0"), F.col("name") == F.col("n"), hot).where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
    return across.unionByName(between).unionByName(free)


def match(profiles: DataFrame, threshold: float = 90.0) -> DataFrame:
    """(id, component) of profiles (with id, emails, phones, links, full_name)."""
    check_threshold(threshold)
    keys = materialized(keys_of(profiles))
    edges = identifier_edges(keys, "emails").unionByName(identifier_edges(keys, "phones")).unionByName(identifier_edges(keys, "links")).unionByName(name_edges(keys, threshold))
    return components(keys, edges)


def pairs_compared(n: int) -> int:
    """What comparing all pairs would take."""
    return math.comb(n, 2)
