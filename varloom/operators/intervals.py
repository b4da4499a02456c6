"""Intervals: islands and merging by blocks of places, range joins by nested bins, and order over the genome."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Bases of a block: what is sorted together, whatever the chromosome's size.
BLOCK = 1 << 20


def _stitched(islands: DataFrame, gap: int) -> DataFrame:
    """chrom, start_pos, end_pos, loci: islands of blocks (chrom, block, i from 0, s, e, n) joined over the blocks' borders.

    A prefix scan over one row a block: an island's number is that of its block's first one, and each block whose first island
    goes on with what came before starts one lower. There are as many such rows as blocks, however many islands.
    """
    borders = islands.groupBy("chrom", "block").agg(F.min("s").alias("_s"), F.max("e").alias("_e"), F.count(F.lit(1)).alias("_k"))
    along = Window.partitionBy("chrom").orderBy("block")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = F.coalesce((F.col("_s") - F.lag("_e").over(along) <= gap).cast("int"), F.lit(0))
    base = borders.withColumn("_j", joined).withColumn("_base", F.sum(F.col("_k") - F.col("_j")).over(upto) - F.col("_k")).select("chrom", "block", "_base")
    numbered = islands.join(base, ["chrom", "block"]).withColumn("_id", F.col("_base") + F.col("i"))
    return numbered.groupBy("chrom", "_id").agg(F.min("s").alias("start_pos"), F.max("e").alias("end_pos"), F.sum("n").alias("loci")).drop("_id")


def merge_regions(loci: DataFrame, gap: int, width: int = BLOCK) -> DataFrame:
    """chrom, start_pos, end_pos, loci: runs of places no more than `gap` apart.

    Places are sorted within blocks of `width` bases, of which there are more as there is more genome, and blocks are stitched.
    """
    placed = loci.select("chrom", "pos").distinct().withColumn("block", F.floor(F.col("pos") / width))
    order = Window.partitionBy("chrom", "block").orderBy("pos")
    step = placed.withColumn("_new", F.when(F.col("pos") - F.lag("pos").over(order) > gap, 1).otherwise(0)).withColumn("i", F.sum("_new").over(order))
    return _stitched(step.groupBy("chrom", "block", "i").agg(F.min("pos").alias("s"), F.max("pos").alias("e"), F.count(F.lit(1)).alias("n")), gap)


def interval_merge(rows: DataFrame, pad: int = 0, width: int = BLOCK) -> DataFrame:
    """chrom, start_pos, end_pos: the union of padded intervals; touching ones merge.

    Intervals are cut at the borders of blocks, a border in both parts, merged within each block and stitched. Ones that end
    before they start stand for nothing.
    """
    wide = rows.select("chrom", (F.col("start_pos") - pad).alias("_s"), (F.col("end_pos") + pad).alias("_e")).where(F.col("_s") <= F.col("_e"))
    first, last = F.floor(F.col("_s") / width), F.floor(F.col("_e") / width)
    cut = wide.select("chrom", "_s", "_e", F.explode(F.sequence(first, last)).alias("block"))
    cut = cut.select("chrom", "block", F.greatest("_s", F.col("block") * width).alias("s"), F.least("_e", (F.col("block") + 1) * width).alias("e"))
    order = Window.partitionBy("chrom", "block").orderBy("s", "e")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = cut.withColumn("_new", F.when(F.col("s") > F.max("e").over(before), 1).otherwise(0)).withColumn("i", F.sum("_new").over(upto))
    return _stitched(step.groupBy("chrom", "block", "i").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("n")), 0).drop("loci")


#: Bins of a level are STEP times as wide as those below; the lowest ones.
LOWEST, STEP, LEVELS = 1 << 10, 8, 12


def span_join(points: DataFrame, spans: DataFrame, pad: int = 0) -> DataFrame:
    """points (chrom, pos, ...) with each padded span (chrom, start_pos, end_pos, ...) that they lie in; a pair once.

    Nested bins: a span stands in the one or two bins that it touches at the lowest level whose bins are no narrower, however
    long it is, and a point asks for one bin at each level that spans use.
    """
    s, e = F.col("start_pos") - pad, F.col("end_pos") + pad
    level = F.lit(LEVELS - 1)
    for i in reversed(range(LEVELS - 1)):
        level = F.when(e - s < LOWEST * STEP**i, i).otherwise(level)
    width = lambda c: F.lit(LOWEST) * F.pow(F.lit(STEP), F.col(c)).cast("long")
    placed = spans.where(s <= e).withColumns({"_s": s, "_e": e, "_level": level}).withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_s") / width("_level")), F.floor(F.col("_e") / width("_level")))))
    used = placed.agg(F.collect_set("_level").alias("_levels"))  # one row of LEVELS numbers at most
    asked = points.crossJoin(F.broadcast(used)).withColumn("_level", F.explode("_levels")).drop("_levels").withColumn("_bin", F.floor(F.col("pos") / width("_level")))
    met = asked.join(placed, ["chrom", "_level", "_bin"]).where(F.col("pos").between(F.col("_s"), F.col("_e")))
    return met.drop("_level", "_bin", "_s", "_e")


def inside(points: DataFrame, spans: DataFrame, pad: int = 0) -> DataFrame:
    """points (chrom, pos, ...) that lie in a padded span (chrom, start_pos, end_pos); spans are merged first, so a point meets one at most."""
    return span_join(points, interval_merge(spans, pad)).drop("start_pos", "end_pos")


def genomic_order(rows: DataFrame) -> list:
    """Sort columns: numbered chromosomes first by number, then the others by name, then places."""
    return [F.col("chrom").try_cast("int").asc_nulls_last(), F.col("chrom"), F.col("pos"), F.col("variant_key")]


def genomic_rank(rows: DataFrame, width: int = BLOCK) -> DataFrame:
    """rows with nth, the place in genomic order over the whole genome, from 1.

    Rows are counted within blocks of places in parallel, and one row a block carries how many come before it.
    """
    placed = rows.withColumn("_block", F.floor(F.col("pos") / width))
    before = Window.orderBy(F.col("chrom").try_cast("int").asc_nulls_last(), "chrom", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("chrom", "_block").agg(F.count(F.lit(1)).alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0))).drop("_k")
    own = F.row_number().over(Window.partitionBy("chrom", "_block").orderBy("pos", "variant_key"))
    return placed.join(starts, ["chrom", "_block"]).withColumn("nth", F.col("_before") + own).drop("_block", "_before")
