"""Writers: sorted VCF, BED, and append-only JSON lines."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.operators.intervals import genomic_order
from varloom.operators.text import cnv_direction


def write_vcf(loci: DataFrame, path: str) -> None:
    """Loci (chrom, pos, ref, alt) in genomic order; parts in the order of their names make one file, the header in the first."""
    keyed = loci.withColumn("variant_key", F.concat_ws("-", "chrom", "pos", "ref", "alt"))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "variant_key", "ref", "alt", F.lit("."), F.lit("."), F.lit("."))
    head = loci.sparkSession.createDataFrame([(0, "##fileformat=VCFv4.2"), (1, "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")], "i int, value string").coalesce(1).orderBy("i").select("value")
    head.union(keyed.orderBy(*genomic_order(keyed)).select(line.alias("value"))).write.text(path)


def write_bed(cnvs: DataFrame, path: str) -> None:
    """CNVs with a direction as chrom, start, end, DEL or DUP."""
    rows = cnvs.withColumn("d", cnv_direction(F.col("svtype"), F.col("cn"))).where(F.col("d").isNotNull())
    rows.select("chrom", "start_pos", "end_pos", "d").write.csv(path, sep="\t")


def write_top(ranked: DataFrame, path: str, n: int = 10) -> None:
    """The n best candidates of each case (case_id, rank, ...) as CSV with a header, a folder per case."""
    ranked.where(F.col("rank") <= n).repartition("case_id").sortWithinPartitions("case_id", "rank").write.partitionBy("case_id").csv(path, header=True)


def append_event(path: str, event: dict) -> dict:
    """One line of JSON; one writer at a time."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("a", encoding="utf-8") as f:
        f.write(json.dumps(event, sort_keys=True, ensure_ascii=False) + "\n")
    return event
