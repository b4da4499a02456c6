"""Validation: truth sets from an assertion file, and global rank correlations of points with an external score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.expr import AMINO, SO_TERMS, lookup
from varloom.operators.evidence import CHANGE

#: Pairs that a correlation needs, and blocks of values that are ranked in parallel.
LEAST_PAIRS, BLOCKS = 20, 4096
# What an assertion's text says, and names of consequences that only assertion files use.
SAYS_PLP, SAYS_BLB = "pathogenic", "benign"
MORE_TERMS = {"nonsense": "stop_gained", "initiator_codon_variant": "start_lost"}


def first_consequence(mc: Column) -> Column:
    """The first known consequence of an assertion's molecular consequences, SO:number|term joined by commas; null if none is known."""
    terms = F.transform(F.split(mc, "[|;,]"), lambda t: lookup(SO_TERMS | MORE_TERMS, F.trim(t)))
    return F.get(F.filter(terms, lambda c: c.isNotNull()), F.lit(0))


def truth_set(assertions: DataFrame) -> DataFrame:
    """variant_key, gene, consequence, protein_pos, alt_aa, filtering_af, variant_kind, truth (P/LP or B/LB) of an assertion file's rows that an
    expert panel reviewed: single nucleotides with one alternative, a gene and a known consequence.

    assertions: variant_key, ref, alt, n_alts, gene, clnsig, review_status, mc, hgvs, af_esp, af_exac, af_tgp.
    """
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    sig = F.lower("clnsig")
    truth = F.when(sig.contains(SAYS_PLP), "P/LP").when(sig.contains(SAYS_BLB), "B/LB")
    kept = assertions.where(F.col("review_status").ilike("%expert%panel%") & (F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("n_alts") == 1) & (F.coalesce("gene", F.lit("")) != ""))
    rows = kept.select(
        "variant_key", F.split_part("gene", F.lit(":"), F.lit(1)).alias("gene"), first_consequence(F.col("mc")).alias("consequence"), F.regexp_extract("hgvs", CHANGE, 2).try_cast("int").alias("protein_pos"),
        lookup(AMINO, F.regexp_extract("hgvs", CHANGE, 3)).alias("alt_aa"), F.greatest(number("af_esp"), number("af_exac"), number("af_tgp")).alias("filtering_af"), F.lit("snv").alias("variant_kind"), truth.alias("truth"),
    )
    return rows.where(F.col("truth").isNotNull() & F.col("consequence").isNotNull())


def average_ranks(counts: DataFrame, value: str, blocks: int = BLOCKS) -> DataFrame:
    """value, rank: the rank of each value over the whole column, ties sharing the mean of theirs.

    counts: value (numbers, each once), n. Values are ranked within blocks of equal width, and one row a block carries how many come
    before; a column of heavy tails makes unequal blocks, never wrong ranks.
    """
    v = F.col(value).cast("double")
    ends = counts.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))  # one row
    share = F.when(F.col("_hi") > F.col("_lo"), F.floor((v - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * blocks)).otherwise(0)
    placed = counts.crossJoin(F.broadcast(ends)).withColumn("_block", share.cast("long")).drop("_lo", "_hi")
    along = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_block").agg(F.sum("n").alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(along), F.lit(0))).drop("_k")
    own = Window.partitionBy("_block").orderBy(v).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(own), F.lit(0))
    return placed.withColumn("_in", inside).join(before, "_block").select(value, (F.col("_before") + F.col("_in") + (F.col("n") + 1) / 2).alias("rank"))


def correlations(rows: DataFrame, x: str, y: str, least: int = LEAST_PAIRS) -> DataFrame:
    """n, pearson, spearman of all rows that have both numbers, in one row; null for fewer than `least`, or without spread.

    Equal pairs are counted first, so ties cost nothing, and ranks come by value; sums are of ranks less their mean.
    """
    pairs = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    ranks = lambda c: average_ranks(pairs.groupBy(c).agg(F.sum("n").alias("n")), c)
    middle = pairs.agg(((F.sum("n") + 1) / 2).alias("_m"))  # one row
    a, b = F.col("_rx") - F.col("_m"), F.col("_ry") - F.col("_m")
    both = pairs.join(ranks(x).withColumnRenamed("rank", "_rx"), x).join(ranks(y).withColumnRenamed("rank", "_ry"), y).crossJoin(F.broadcast(middle))
    mean = lambda c: F.sum(F.col(c) * F.col("n"))
    sums = both.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * a * b).alias("_ab"), F.sum(F.col("n") * a * a).alias("_aa"), F.sum(F.col("n") * b * b).alias("_bb"),
        mean(x).alias("_x"), mean(y).alias("_y"),
    )
    means = pairs.agg((mean(x) / F.sum("n")).alias("_mx"), (mean(y) / F.sum("n")).alias("_my"))
    p, q = F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")
    raw = pairs.crossJoin(F.broadcast(means)).agg(F.sum(F.col("n") * p * q).alias("_pq"), F.sum(F.col("n") * p * p).alias("_pp"), F.sum(F.col("n") * q * q).alias("_qq"))
    ratio = lambda top, s, t: F.when((F.col("n") >= least) & (F.col(s) > 0) & (F.col(t) > 0), F.col(top) / F.sqrt(F.col(s) * F.col(t)))
    return sums.crossJoin(raw).select(F.coalesce("n", F.lit(0)).cast("long").alias("n"), ratio("_pq", "_pp", "_qq").alias("pearson"), ratio("_ab", "_aa", "_bb").alias("spearman"))
