"""Composition of local evidence onto annotator rows: one pipeline of left joins, ready for the kernel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.operators import evidence

#: Columns that the kernel reads, and their types.
KERNEL = {
    "variant_key": "string", "gene": "string", "consequence": "string", "variant_kind": "string", "filtering_af": "double", "gnomad_mis_z": "double",
    "revel": "double", "spliceai": "double", "clinvar_same_aa": "int", "clinvar_same_codon_lp": "int", "nmd_escaping": "int", "pm1": "int",
    "loeuf": "double", "cadd_phred": "double", "clinvar_classification": "string",
}


def kernel_columns(rows: DataFrame) -> DataFrame:
    """rows with the kernel's columns in their types; what is missing is null, and the kernel abstains on it."""
    return rows.select(*[(F.col(c).cast(kind) if c in rows.columns else F.lit(None).cast(kind)).alias(c) for c, kind in KERNEL.items()])


def annotate_hybrid(rows: DataFrame, *, protein: DataFrame | None = None, codons: DataFrame | None = None, constraint: DataFrame | None = None, exons: DataFrame | None = None) -> DataFrame:
    """Kernel columns of annotator rows (variant_key, gene, consequence, protein_pos, alt_aa, transcript_id and scores), one row per key.

    protein gives PS1 and PM5, codons PM1, constraint the gene's scores, exons the decay rule, which fills gaps only. Each is
    optional; rows without a gene, a residue or a transcript have 0, 0 and null there.
    """
    done = rows
    if protein is not None:
        found = evidence.ps1_pm5(done.select("variant_key", "gene", "protein_pos", "alt_aa"), protein).select("variant_key", F.col("same_aa").alias("clinvar_same_aa"), F.col("same_codon").alias("clinvar_same_codon_lp"))
        done = done.join(found, "variant_key", "left").fillna(0, ["clinvar_same_aa", "clinvar_same_codon_lp"])
    if codons is not None:
        done = evidence.pm1_hotspot(done, codons)
    if constraint is not None:
        have = done if "gnomad_mis_z" in done.columns else done.withColumn("gnomad_mis_z", F.lit(None).cast("double"))
        done = evidence.constraint_join(have, constraint)
    if exons is not None:
        own = F.col("nmd_escaping") if "nmd_escaping" in done.columns else F.lit(None).cast("int")
        placed = done.withColumn("_own", own).drop("nmd_escaping").withColumn("pos", F.split_part("variant_key", F.lit("-"), F.lit(2)).try_cast("long"))
        done = evidence.nmd_escaping(placed, exons).withColumn("nmd_escaping", F.coalesce("_own", "nmd_escaping"))
    return kernel_columns(done)


def fill_site_scores(rows: DataFrame, scores: DataFrame, columns: tuple[str, ...] = ("filtering_af", "revel", "spliceai")) -> DataFrame:
    """rows with gaps in the columns filled from a table of site scores (chrom, pos, ref, alt and any of the columns); own values stay.

    Columns that neither side has are null, so the kernel abstains on them. A site that is told twice counts by its largest values.
    """
    key = F.concat_ws("-", F.regexp_replace(F.col("chrom").cast("string"), "^chr", ""), F.col("pos").cast("string"), "ref", "alt").alias("variant_key")
    have = [c for c in columns if c in scores.columns]
    sites = scores.select(key, *have).groupBy("variant_key").agg(*[F.max(F.col(c).cast("double")).alias(f"_s_{c}") for c in have]) if have else None
    joined = rows if sites is None else rows.join(sites, "variant_key", "left")
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("double")
    return joined.withColumns({c: F.coalesce(own(c), F.col(f"_s_{c}")) if c in have else own(c) for c in columns}).drop(*[f"_s_{c}" for c in have])


def assemble_site_scores(loci: DataFrame, sources: dict[str, DataFrame | None], key: str = "variant_key") -> DataFrame:
    """loci (chrom, pos, ref, alt, variant_key) with one column per source (variant_key, that column), null for a source that is absent; sorted by place."""
    done = loci
    for name, source in sources.items():
        done = done.withColumn(name, F.lit(None).cast("double")) if source is None else done.join(source.select(key, name), key, "left")
    return done.orderBy(F.col("chrom").try_cast("int").asc_nulls_last(), "chrom", "pos", "ref", "alt")


def concordance(truth: DataFrame, classified: DataFrame) -> DataFrame:
    """truth (variant_key, truth: P/LP or B/LB) against the kernel's classes: truth, one column of counts per call, agreement and contradictions."""
    cls = F.col("acmg_class")
    called = F.when(cls.isin("Pathogenic", "Likely Pathogenic"), "P/LP").when(cls.isin("Benign", "Likely Benign"), "B/LB").otherwise("VUS")
    rows = truth.join(classified.select("variant_key", called.alias("called")), "variant_key", "left").fillna("VUS", ["called"])
    opposite = ((F.col("truth") == "P/LP") & (F.col("called") == "B/LB")) | ((F.col("truth") == "B/LB") & (F.col("called") == "P/LP"))
    n = F.count(F.lit(1))
    return rows.groupBy("truth").agg(
        *[F.count_if(F.col("called") == c).alias(name) for c, name in (("P/LP", "called_plp"), ("VUS", "called_vus"), ("B/LB", "called_blb"))],
        (F.count_if(F.col("called") == F.col("truth")) / n).alias("agree"),
        F.count_if(opposite).alias("contradictions"),
    )
