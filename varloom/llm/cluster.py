"""Components of near duplicates from buckets of candidates, with work near linear in a group's size."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import broadcast_if_small, cut, stored


#: Words of a sketch.
WORDS = 4
#: Words of a whole set's sketch.
SKETCH = 16
#: So many members of a hub meet each other whatever their sizes; so many of a band of sizes where sketches tell their sets apart.
FEW, PAIRED = 4, 16_000


def sketch(token: Column) -> list[Column]:
    """Aggregates s0, s1, ...: SKETCH * 64 bits, each the parity of a part of a set's tokens. Sets differ in no fewer tokens than
    their sketches in bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(token, 8), F.lit(64)).cast("int"))
    return [F.bit_xor(F.when(F.pmod(token, F.lit(SKETCH)) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{w}") for w in range(SKETCH)]


def _may_be_alike(x: str, y: str, least: int) -> Column:
    """Whether the sizes and sketches of the columns with the suffixes x and y allow a similarity of least / 100."""
    m, n = F.col(f"size{x}"), F.col(f"size{y}")
    most = (100 - least) * (m + n)
    # a part of the words says no to most pairs
    return (100 * F.least(m, n) >= least * F.greatest(m, n)) & ((100 + least) * _bits(x, y, SKETCH // 4) <= most) & ((100 + least) * _bits(x, y) <= most)


def _bits(x: str, y: str, words: int = SKETCH) -> Column:
    """The number of bits in which the first words of the sketches with the suffixes x and y differ."""
    return sum((F.bit_count(F.col(f"s{w}{x}").bitwiseXOR(F.col(f"s{w}{y}"))) for w in range(words)), F.lit(0))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (id, component): the smallest id that each end of an edge reaches.

    Alternates large stars (neighbours above a node hang on the smallest of its neighbourhood) and small stars (neighbours
    below it do); each round is two sums by key and two joins, and the number of rounds is logarithmic. No edge leaves Spark.
    """
    near = edges.where(F.col("a") != F.col("b"))
    now = cut(near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(lowest, "a")
        now = cut(hung.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b"))).distinct())
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one smaller node, which hangs on none, or is such a node."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    return ends.groupBy("id").agg(F.sum("up").alias("u"), F.min("up").alias("l")).where((F.col("u") > 1) | ((F.col("u") == 1) & (F.col("l") == 0))).isEmpty()


def linked(
    members: DataFrame, facts: Callable[[DataFrame], DataFrame], verify: Callable[[DataFrame], DataFrame], diffs: Callable[[DataFrame], DataFrame], least: int
) -> DataFrame:
    """Components of all pairs that share a bucket and have a Jaccard similarity of least / 100 or more, as (id, component).

    members: bucket, id, each pair once; stored, as it is read several times.
    facts: (id) -> (id, size, s0, s1, ...), the size and the sketch of each one's set.
    verify: (a, b) -> those of the pairs whose sets are similar.
    diffs: (a, b) -> (a, b, size, token), the elements that only one of the two sets has; size: that of b's set.

    Each member first meets its buckets' hubs alone: sets that share most, in a group of near copies one near to them all (any
    set would do). Members of a hub that stand in one component then need no more. The others are compared by what sets
    them apart from the hub: two sets differ in so many elements as their differences from the hub do, so similar ones share
    some, and at least one among the first few when these are sorted by how rare they are among the hub's members (prefix
    filter). Where a hub has PAIRED members of a band of sizes or fewer, their sketches meet directly, PAIRED looks a member or so at
    most, and then the sets of the pairs that these leave; sketches of very large sets tell nothing, so pairs of these are left to the filter. Pairs of small differences, which need not share any, are similar to the hub and so in one component already.
    Work is near linear in a group's size, and no pair is lost.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    degree = members.join(sizes, "bucket").groupBy("id").agg(F.sum("_n").alias("_d"))
    # a bucket's hub: of the members with most company in its members' buckets the first, so that buckets of one group agree
    most = members.join(degree, "id").groupBy("bucket").agg(F.max(F.struct("_d", "id")).alias("_h"))
    best = members.join(most, "bucket").groupBy("id").agg(F.max("_h").alias("_h"))
    hubs = members.join(best, "id").groupBy("bucket").agg(F.max("_h").alias("_h")).select("bucket", F.col("_h.id").alias("hub"))
    near = stored(members.join(hubs, "bucket").where(F.col("hub") != F.col("id")).select("hub", "id").distinct())
    links = cut(verify(near.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()))
    known = cut(components(links))
    named = near.join(known, "id", "left").select("hub", "id", F.coalesce("component", "id").alias("c"))
    apart = named.groupBy("hub").agg(F.min("c").alias("_x"), F.max("c").alias("_y")).where(F.col("_x") != F.col("_y")).select("hub")
    rest = cut(named.join(apart, "hub", "left_semi"))
    if rest.isEmpty():
        return known
    seen = cut(rest.join(facts(rest.select("id").distinct()), "id"))
    # pairs that no sketch tells apart are of sets nearly as large as half its bits' worth both
    vague = (100 - least) * 2 * F.col("size") * 100 > (100 + least) * (64 * SKETCH * 2 // 5) * least
    # similar sets stand in one band of sizes or in neighbouring ones
    seen = seen.withColumn("vague", vague).withColumn("band", F.floor(F.log("size") / (math.log(100 / least) * 1.0001)))
    bands = seen.groupBy("hub", "band").agg(F.count(F.lit(1)).alias("_n"), F.count_if("vague").alias("_v"))
    hubs = bands.groupBy("hub").agg(F.sum("_n").alias("_n"), F.max("_n").alias("_most"), F.sum("_v").alias("_v"))
    marks = cut(hubs.select("hub", (F.col("_most") > PAIRED).alias("wide"), (F.col("_v") * F.col("_v") > FEW * F.greatest("_n", F.lit(FEW))).alias("long")))
    marked = cut(seen.join(marks, "hub"))
    many = cut(marked.where(F.col("wide") | F.col("long") & F.col("vague")).select("hub", "id", "c"))
    found = _pair_links(marked.where(~F.col("wide")), verify, least)
    more = cut(found if many.isEmpty() else found.union(_prefix_links(many, verify, diffs, least)).distinct())
    return known if more.isEmpty() else cut(_renamed(known, components(more)))


def _renamed(known: DataFrame, joined: DataFrame) -> DataFrame:
    """known (id, component) after components were joined; joined: (id, component) of components, those of one id alone among them."""
    to = joined.select(F.col("id").alias("component"), F.col("component").alias("_to"))
    moved = known.join(to, "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
    return moved.union(joined.join(known.select("id"), "id", "left_anti").select("id", "component"))


def _pair_links(seen: DataFrame, verify: Callable[[DataFrame], DataFrame], least: int) -> DataFrame:
    """seen: hub, id, c, facts, band, vague, long -> (a, b): the components c that similar pairs among a hub's members join, but those of
    two vague ones where these are long. Each pair is verified once for all hubs."""
    left, right = (seen.select("hub", "band", *[F.col(c).alias(f"{c}_{x}") for c in seen.columns if c not in ("hub", "band", "wide")]) for x in "ab")
    left = left.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_up")).withColumn("band", F.col("band") + F.col("_up"))
    told = ((F.col("_up") == 1) | (F.col("id_a") < F.col("id_b"))) & (F.col("c_a") != F.col("c_b")) & ~(F.col("long_a") & F.col("vague_a") & F.col("vague_b"))
    met = left.join(right, ["hub", "band"]).where(told & _may_be_alike("_a", "_b", least))
    turned = F.col("id_a") > F.col("id_b")
    ends = [F.when(turned, F.col(y)).otherwise(F.col(x)).alias(z) for x, y, z in (("id_a", "id_b", "a"), ("id_b", "id_a", "b"), ("c_a", "c_b", "c_a"), ("c_b", "c_a", "c_b"))]
    pairs = cut(met.select(*ends, _bits("_a", "_b").alias("_bits")).distinct())
    # each meets the nearest first; what that joins needs no more
    ends = pairs.select("a", F.struct("_bits", "b").alias("_to")).union(pairs.select("b", F.struct("_bits", F.col("a").alias("b"))))
    best = ends.groupBy("a").agg(F.min("_to").alias("_to")).select(F.least("a", "_to.b").alias("a"), F.greatest("a", "_to.b").alias("b")).distinct()
    links = cut(_joined(pairs, verify(cut(best))))
    to = cut(components(links))
    for x in ("a", "b"):
        pairs = pairs.join(broadcast_if_small(to.select(F.col("id").alias(f"c_{x}"), F.col("component").alias(f"_{x}"))), f"c_{x}", "left").withColumn(f"_{x}", F.coalesce(f"_{x}", f"c_{x}"))
    left = cut(pairs.where(F.col("_a") != F.col("_b")).select("a", "b", "c_a", "c_b").join(best, ["a", "b"], "left_anti"))
    return links.union(_joined(left, verify(left.select("a", "b")))).distinct()


def _joined(pairs: DataFrame, similar: DataFrame) -> DataFrame:
    """(a, b): the components of those pairs that are similar."""
    return similar.join(pairs, ["a", "b"]).select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct()


def _prefix_links(rest: DataFrame, verify: Callable[[DataFrame], DataFrame], diffs: Callable[[DataFrame], DataFrame], least: int) -> DataFrame:
    """rest: hub, id, c -> (a, b): the components c that similar pairs among a hub's members join.

    Sets of sizes m, n are similar if they differ in H(m, n) = (100 - least) (m + n) / (100 + least) elements at most. Members
    that differ from the hub in x >= y elements then share o = (x + y - H) / 2 of these or more, so one that they share is
    among the first x - o + 1 of the one and y - o + 1 of the other. A sketch of WORDS * 64 bits, each the parity of a part of
    the differences, keeps off most others that meet: two sets differ in no fewer elements than their sketches in bits. Those
    that are left are similar if the atoms that they share weigh o, which needs no look at the sets themselves.
    """
    apart = stored(diffs(rest.select(F.col("hub").alias("a"), F.col("id").alias("b"))).select(F.col("a").alias("hub"), F.col("b").alias("id"), "size", "token"))
    # elements that the same members have are one atom of their number's weight
    who = F.bit_xor(F.xxhash64("id"))
    often = apart.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("n"), who.alias("_w")).where("n > 1")
    often = cut(often.select("hub", "token", "n", F.xxhash64("n", "_w").alias("atom")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright("token", 8), F.lit(64)).cast("int"))
    odd = lambda w: F.bit_xor(F.when(F.pmod("token", F.lit(WORDS)) == w, bit).otherwise(F.lit(0).cast("long")))
    sums = apart.groupBy("hub", "id").agg(F.count(F.lit(1)).alias("x"), F.first("size").alias("size"), F.array(*[odd(w) for w in range(WORDS)]).alias("sketch"))
    # what one member alone has stands first and finds nobody; it counts in ranks
    own = Window.partitionBy("hub", "id")
    shared = stored(apart.select("hub", "token", "id").join(broadcast_if_small(often), ["hub", "token"]).groupBy("hub", "id", "n", "atom").agg(F.count(F.lit(1)).alias("_k")))
    before = F.sum("_k").over(own.orderBy("n", "atom").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_k")
    shared = shared.withColumn("_before", before).withColumn("_all", F.sum("_k").over(own))
    reach = F.floor((100 - least) * (F.col("size") + F.floor(F.col("size") * 100 / least)) / (100 + least))
    ranked = shared.join(sums, ["hub", "id"]).withColumn("rank", F.col("x") - F.col("_all") + F.col("_before") + 1).where(F.col("rank") <= reach + 1)
    rows = stored(ranked.join(rest, ["hub", "id"]).select("hub", "atom", "id", "c", "x", "size", "rank", "sketch", (F.col("rank") <= F.floor(reach / 2) + 1).alias("low")))
    def mixed(of: DataFrame) -> DataFrame:
        """Rows of atoms whose members stand in several components; others join nothing."""
        groups = of.groupBy("hub", "atom").agg(F.min("c").alias("_x"), F.max("c").alias("_y")).where(F.col("_x") != F.col("_y")).select("hub", "atom")
        return of.join(groups, ["hub", "atom"], "left_semi")

    def near(size: Column, sketch: Column, other_size: Column, other_sketch: Column) -> Column:
        bits = sum((F.bit_count(sketch[w].bitwiseXOR(other_sketch[w])) for w in range(WORDS)), F.lit(0))
        return ((100 + least) * bits <= (100 - least) * (size + other_size)) & (100 * F.least(size, other_size) >= least * F.greatest(size, other_size))

    first = rows.groupBy("hub", "atom").agg(F.min(F.struct("id", "c", "size", "sketch")).alias("f"))
    starred = rows.select("hub", "atom", "id", "c", "size", "sketch").join(first, ["hub", "atom"]).where((F.col("c") != F.col("f.c")) & near(F.col("size"), F.col("sketch"), F.col("f.size"), F.col("f.sketch")))
    starred = cut(starred.select(F.least("id", "f.id").alias("a"), F.greatest("id", "f.id").alias("b")).distinct())
    of = rest.select("id", "c").distinct()
    stars = cut(verify(starred).join(of.select(F.col("id").alias("a"), F.col("c").alias("_a")), "a").join(of.select(F.col("id").alias("b"), F.col("c").alias("_b")), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    if not stars.isEmpty():
        to = components(stars).select(F.col("id").alias("c"), F.col("component").alias("_to"))
        rows = rows.join(broadcast_if_small(cut(to)), "c", "left").withColumn("c", F.coalesce("_to", "c")).drop("_to")
    rows = mixed(rows)
    names = ("id", "c", "x", "size", "rank", "sketch")
    big = rows.select("hub", "atom", *[F.col(c).alias(f"{c}_i") for c in names])
    low = rows.where("low").select("hub", "atom", *[F.col(c).alias(f"{c}_j") for c in names])
    over = (100 + least) * (F.col("x_i") + F.col("x_j")) - (100 - least) * (F.col("size_i") + F.col("size_j"))
    o = F.ceil(over / (2 * (100 + least)))
    may = (
        (F.col("c_i") != F.col("c_j"))
        & (F.col("x_i") >= F.col("x_j"))
        & (F.col("rank_i") <= F.col("x_i") - o + 1)
        & (F.col("rank_j") <= F.col("x_j") - o + 1)
        & near(F.col("size_i"), F.col("sketch_i"), F.col("size_j"), F.col("sketch_j"))
    )
    met = cut(big.join(low, ["hub", "atom"]).where(may).select("hub", F.col("id_i").alias("i"), F.col("id_j").alias("j"), "c_i", "c_j", o.alias("o")).distinct())
    # an atom weighs the same wherever it is; lists of atoms, of a text's length at most, meet in place of their elements
    lists = stored(shared.groupBy("hub", "id").agg(F.collect_list(F.struct("atom", "_k")).alias("l")).select("hub", "id", F.col("l.atom").alias("atoms"), F.col("l._k").alias("ks")))
    both = met.join(lists.select("hub", F.col("id").alias("i"), F.col("atoms").alias("_a"), F.col("ks").alias("_w")), ["hub", "i"])
    both = both.join(lists.select("hub", F.col("id").alias("j"), F.col("atoms").alias("_b")), ["hub", "j"]).withColumn("_c", F.array_intersect("_a", "_b"))
    held = F.zip_with("_a", "_w", lambda x, k: F.when(F.array_contains(F.col("_c"), x), k).otherwise(F.lit(0).cast("long")))
    similar = both.where(F.aggregate(held, F.lit(0).cast("long"), lambda s, k: s + k) >= F.col("o"))
    return stars.union(similar.select(F.col("c_i").alias("a"), F.col("c_j").alias("b"))).distinct()
