"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are laid out shard by shard in a seeded order and cut into blocks of equal length. Seats (one seat
takes one block once) go to sources, then to each source's bundles of shards, then to a bundle's shards, by highest quotients
w / (2 j - 1). A shard takes its seats from its blocks evenly, starting at a seeded block; with more seats than blocks every
block repeats first.

Only totals are ranked in windows: a bundle has BUNDLE shards at most, and bundles are BUNDLE times fewer than shards, which
have one length at every size. Documents meet others of their shard alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import WORD, cut, read_table, row_key

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MOST = 2
BLOCK = 64
#: Words of a shard, or so, and shards of a bundle.
SHARD = 1 << 17
BUNDLE = 1 << 12
SEED = 20240229


def apportion(parties: DataFrame, group: list[str], key: list[str], weight: str, seats: str, most: str) -> DataFrame:
    """Adds `quota`: the party's seats by highest quotients weight / (2 j - 1), `most` of them at most.

    group: columns of a contest; seats: its number of seats, the same in all its rows; key: breaks ties.
    A contest's fair divisor is near D = sum of weights / seats: with n parties, none is further from weight / D than
    n / 2 times its share, and one for rounding. So only the quotients in that reach are ranked, 4 to a party or so.
    """
    own = Window.partitionBy(*group)
    fair = F.col(weight) * F.col(seats) / F.col("_w")
    held = (
        parties.withColumn("_w", F.sum(weight).over(own))
        .withColumn("_n", F.count(F.lit(1)).over(own))
        .withColumn("_fair", F.when(F.col("_w") > 0, fair).otherwise(0.0))
        .withColumn("_reach", F.when(F.col("_w") > 0, F.ceil((F.col("_n") / 2 + 1) * F.col(weight) / F.col("_w")) + 2).otherwise(0))
        .withColumn("_sure", F.least(F.greatest(F.floor(F.col("_fair") + 0.5) - F.col("_reach"), F.lit(0)), F.col(most)).cast("long"))
        .withColumn("_last", F.least(F.col("_sure") + 2 * F.col("_reach") + 1, F.col(most)).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_sure").over(own))
    )
    ranked = Window.partitionBy(*group).orderBy(F.desc("_q"), *[F.asc_nulls_last(k) for k in key], "_j")
    won = (
        held.where(F.col("_last") > F.col("_sure"))
        .select(*group, *key, weight, "_left", F.explode(F.sequence(F.col("_sure") + 1, F.col("_last"))).alias("_j"))
        .withColumn("_q", F.col(weight) / (2 * F.col("_j") - 1))
        .withColumn("_r", F.row_number().over(ranked))
        .groupBy(*group, *key)
        .agg(F.sum(F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0)).alias("_won"))
    )
    names = [*group, *key]
    won = won.select(*[F.col(c).alias(f"_k_{c}") for c in names], "_won")
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in names]
    return (
        held.join(won, on, "left")
        .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .select(*parties.columns, "quota")
    )


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """source, source_size -> and target: shares of budget * all words by weight, none above most * its source's size.

    Sources take the weights in turn, by code point, null last. A share that its source cannot fill goes to the others by
    weight: sources fill up in order of room per weight, so the level is the first in that order that its source can hold
    (later ones are never higher).
    """
    one = F.lit(0)
    by_name = Window.partitionBy(one).orderBy(F.asc_nulls_last("source"))
    everyone = Window.partitionBy(one)
    by_room = Window.partitionBy(one).orderBy("_r", "si")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("_turn"))
    level = (F.col("_goal") - F.col("_full")) / F.col("_open")
    return (
        sources.withColumn("si", F.row_number().over(by_name))
        .withColumn("_turn", ((F.col("si") - 1) % len(weights) + 1).cast("int"))
        .withColumn("weight", w)
        .withColumn("_room", (F.col("source_size") * most).cast("double"))
        .withColumn("_r", F.col("_room") / F.col("weight"))
        .withColumn("_goal", F.sum("source_size").over(everyone) * float(budget))
        .withColumn("_full", F.coalesce(F.sum("_room").over(before), F.lit(0.0)))
        .withColumn("_open", F.sum("weight").over(onwards))
        .withColumn("_level", F.when(F.col("_r") >= level, level))
        .withColumn("_level", F.max("_level").over(everyone))
        .withColumn("target", F.least(F.col("_room"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_room"))))
        .select("source", "source_size", "si", "weight", "target")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, key, source, size, source_size, target, taken, shard, quota, blocks for every row of docs.

    key: a hash of doc_id, source and text, to find the row again.

    size: words of the text. taken: how many of them the mix takes, counting a repeated block each time.
    Null, empty and blank texts have size 0 and take 0; null sources are a source of their own, the last; null doc_ids are
    dealt by the hash of the row, like any other. Repeated rows are rows of their own, counted first and dealt by number. An empty table gives no rows. Other columns are not read.
    """
    named = docs.select("doc_id", row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    counted = named.groupBy("doc_id", "key", "source", "size").agg(F.count(F.lit(1)).alias("_n"))
    sizes = cut(counted.select("doc_id", "key", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_copy")))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    goals = (
        source_targets(sources, weights, budget, most)
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)).cast("long"))
        .select(F.col("source").alias("_source"), "si", "source_size", "target", "shards")
    )
    goals = cut(goals)
    dealt = (
        sizes.join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_h", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("key"), F.col("_copy")))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("key"), F.col("_copy")), F.col("shards")))
        .select("doc_id", "key", "source", "size", "_copy", "si", "_h", "shard")
    )
    held = (
        dealt.groupBy("si", "shard")
        .agg(F.sum("size").alias("words"))
        .withColumn("blocks", F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / block))).otherwise(0).cast("long"))
    )
    held = cut(held.withColumn("bundle", F.expr(f"shard div {BUNDLE}")))
    in_blocks = held.groupBy("si").agg(F.sum("blocks").alias("n"))
    contest = (
        goals.join(in_blocks, "si")
        .withColumn("_share", F.when(F.col("source_size") > 0, F.col("target") * F.col("n") / F.col("source_size")).otherwise(0.0))
        .withColumn("_most", F.col("n") * most)
        .withColumn("_all", F.lit(0))
        .withColumn("_seats", F.round(F.sum("_share").over(every)).cast("long"))
    )
    seats = apportion(contest, ["_all"], ["si"], "_share", "_seats", "_most").select("si", F.col("quota").alias("_seats"), "source_size", "target")
    # a contest reads its parties twice: what the next one reads is cut, or plans double with each
    seats = cut(seats)
    bundles = held.groupBy("si", "bundle").agg(F.sum("blocks").alias("blocks")).join(seats, "si").withColumn("_most", F.col("blocks") * most)
    bundled = apportion(bundles, ["si"], ["bundle"], "blocks", "_seats", "_most").select("si", "bundle", "source_size", "target", F.col("quota").alias("_seats"))
    bundled = cut(bundled)
    quotas = apportion(held.join(bundled, ["si", "bundle"]).withColumn("_most", F.col("blocks") * most), ["si", "bundle"], ["shard"], "blocks", "_seats", "_most")
    # what a document needs of its shard is worked out there, a row a shard, and cut: a filter on what follows is then short
    n, q = F.col("blocks"), F.col("quota")
    quotas = (
        quotas.select("si", "shard", "words", "blocks", "source_size", "target", "quota")
        .withColumn("_each", F.when(q > 0, F.floor(q / F.greatest(n, F.lit(1)))).otherwise(0).cast("long"))
        .withColumn("_more", q - F.col("_each") * n)
        .withColumn("_len", F.when(n > 0, _div(F.col("words"), n)).otherwise(0).cast("long"))
        .withColumn("_long", F.col("words") - F.col("_len") * n)
        .withColumn("_from", F.when(n > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "si", "shard"), F.greatest(n, F.lit(1)))).otherwise(0))
        .withColumn("_skip", _div(F.col("_from") * F.col("_more"), n))
    )
    quotas = cut(quotas)

    line = Window.partitionBy("si", "shard").orderBy("_h", "doc_id", "key", "_copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("_end", F.sum("size").over(line)).withColumn("_begin", F.col("_end") - F.col("size")).join(quotas, ["si", "shard"])
    taken = _with_upto(_with_upto(placed, "_begin", "_before"), "_end", "_after")
    return taken.withColumn("taken", (F.col("_after") - F.col("_before")).cast("long")).select(
        "doc_id", "key", "source", "size", "source_size", "target", "taken", "shard", "quota", "blocks"
    )


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of longs that aren't negative; b is taken as 1 at least. Each is named once, so that nested quotients stay short."""
    return F.call_function("div", a, F.greatest(b, F.lit(1).cast("long")))


def _picked(k: Column) -> Column:
    """How many of a shard's first k blocks get one seat more: systematic picking from block `_from`, in a circle."""
    n, more, at = F.col("blocks"), F.col("_more"), F.col("_from") + k
    return F.when(at <= n, _div(at * more, n) - F.col("_skip")).otherwise(more - F.col("_skip") + _div((at - n) * more, n))


def _with_upto(df: DataFrame, x: str, name: str) -> DataFrame:
    """Adds the words taken of a shard's first x: its first `_long` blocks have `_len` + 1 words, the others `_len`.

    In steps, each on columns of the one before, as written out in one expression it grows beyond what can be compiled.
    """
    at, size, long, n, k = F.col(x), F.col("_len"), F.col("_long"), F.col("blocks"), F.col("_k")
    edge = long * (size + 1)
    return (
        df.withColumn("_k", F.when(at < edge, _div(at, size + 1)).otherwise(long + _div(at - edge, F.greatest(size, F.lit(1)))))
        .withColumn("_k", F.least("_k", "blocks"))
        .withColumn("_next", F.least(k + 1, n))
        .withColumn("_head", F.least(k, long))
        .withColumns({"_pk": _picked(k), "_pn": _picked(F.col("_next")), "_ph": _picked(F.col("_head"))})
        .withColumn(name, F.when(n > 0, F.col("_each") * at + size * F.col("_pk") + F.col("_ph") + (F.col("_pn") - F.col("_pk")) * (at - k * size - F.col("_head"))).otherwise(0))
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).drop("key")
