"""Readers: tables of any format to canonical calls, VCF, pedigree, exon and annotation text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.expr import safe_int, variant_key, variant_kind

# Canonical columns and their types, and default source names.
CALL_TYPES = {
    "case_id": "string", "family_id": "string", "member_id": "string", "proband_status": "string", "relationship": "string", "family_size": "int",
    "chrom": "string", "pos": "long", "ref": "string", "alt": "string", "gene": "string", "gt": "string", "gq": "int", "dp": "int", "phase_set": "int",
}
REQUIRED = ("case_id", "chrom", "pos", "ref", "alt", "gt")
FORMATS = {
    ".vcf": "vcf", ".vcf.gz": "vcf", ".bcf": "bcf", ".parquet": "parquet", ".tsv": "tsv", ".tsv.gz": "tsv", ".txt": "tsv", ".csv": "csv", ".csv.gz": "csv", ".xlsx": "excel", ".xls": "excel",
}


def detect_format(path: str) -> str:
    for ending in sorted(FORMATS, key=len, reverse=True):
        if path.lower().endswith(ending):
            return FORMATS[ending]
    raise ValueError(f"{path}: unknown format; known endings: {', '.join(FORMATS)}")


def read_source(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A table in any of the formats; text columns stay text."""
    fmt = fmt or detect_format(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt in ("tsv", "csv"):
        return spark.read.csv(path, sep="\t" if fmt == "tsv" else ",", header=True)
    if fmt == "vcf":
        return read_vcf(spark, path)
    if fmt == "excel":
        import pandas as pd

        try:
            return spark.createDataFrame(pd.read_excel(path, dtype=str))
        except ImportError as error:
            raise ValueError(f"{path}: reading Excel needs openpyxl") from error
    raise ValueError(f"{path}: format {fmt} isn't supported; convert BCF to VCF first")


def canonical_calls(source: DataFrame, columns: dict[str, str] | None = None, *, snv_only: bool = True) -> DataFrame:
    """Canonical calls from any table. columns: canonical name -> source name (default: the same).

    Optional columns that are missing become typed nulls; missing required ones raise. Of a list of alternatives, by commas,
    the first counts.
    """
    names = {c: (columns or {}).get(c, c) for c in CALL_TYPES}
    absent = [c for c in REQUIRED if names[c] not in source.columns]
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    out = []
    for c, kind in CALL_TYPES.items():
        if names[c] not in source.columns:
            out.append(F.lit(None).cast(kind).alias(c))
            continue
        x = F.col(f"`{names[c]}`")
        if c == "chrom":
            x = F.regexp_replace(x.cast("string"), "^chr", "")
        elif c == "alt":
            x = F.split_part(x.cast("string"), F.lit(","), F.lit(1))
        elif kind == "int":
            x = safe_int(x.cast("string"))
        else:
            x = x.cast("string") if kind == "string" else x.try_cast(kind)
        out.append(x.alias(c))
    calls = source.select(*out)
    calls = calls.withColumn("variant_kind", variant_kind(F.col("ref"), F.col("alt"))).withColumn("variant_key", variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")))
    return calls.where(F.col("variant_kind") == "snv") if snv_only else calls


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """One row per sample and line of a text VCF: case_id, chrom, pos, ref, alt, gt, gq, dp, phase_set, info (a map).

    One scan; samples are exploded, not united. Fields that the line's format lacks are null.
    """
    lines = spark.read.text(path)
    head = lines.where(F.col("value").startswith("#CHROM")).first()
    samples = head["value"].rstrip("\r").split("\t")[9:] if head else []
    if not samples:
        raise ValueError(f"{path}: no samples in the header")
    return vcf_rows(lines, samples)


def vcf_rows(lines: DataFrame, samples: list[str]) -> DataFrame:
    """The same of lines (value) with such samples."""
    cells = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select(cells.alias("c"))
    per = rows.select("c", F.split(F.col("c")[8], ":").alias("f"), F.posexplode(F.slice("c", 10, len(samples))).alias("i", "s")).withColumn("v", F.split("s", ":"))

    def field(name: str):
        value = F.get(F.col("v"), F.array_position("f", name).cast("int") - 1)
        return F.when((F.array_position("f", name) > 0) & (value != ".") & (value != ""), value)

    names = F.array(*[F.lit(s) for s in samples])
    return per.select(
        F.get(names, F.col("i")).alias("case_id"),
        F.regexp_replace(F.col("c")[0], "^chr", "").alias("chrom"),
        F.col("c")[1].try_cast("long").alias("pos"),
        F.col("c")[3].alias("ref"),
        F.col("c")[4].alias("alt"),
        field("GT").alias("gt"),
        safe_int(field("GQ")).alias("gq"),
        safe_int(field("DP")).alias("dp"),
        safe_int(field("PS")).alias("phase_set"),
        F.expr("str_to_map(c[7], ';', '=')").alias("info"),
    )


def read_ped(spark: SparkSession, path: str) -> DataFrame:
    """family_id, individual_id, father_id, mother_id, sex, affected of a pedigree file; parent 0 is null."""
    c = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(c.alias("c")).where(F.size("c") >= 6)
    parent = lambda i: F.when(F.col("c")[i] != "0", F.col("c")[i])
    return rows.select(
        F.col("c")[0].alias("family_id"), F.col("c")[1].alias("individual_id"), parent(2).alias("father_id"), parent(3).alias("mother_id"),
        F.col("c")[4].try_cast("int").alias("sex"), F.col("c")[5].try_cast("int").alias("affected"),
    )


def read_exons(spark: SparkSession, path: str) -> DataFrame:
    """transcript_id (without version), gene, exon_number, chrom, start_pos, end_pos, strand and tags of a GTF file's exons."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(c.alias("c")).where(F.col("c")[2] == "exon")
    more = F.col("c")[8]
    attribute = lambda n: F.regexp_extract(more, rf'{n} "([^"]*)"', 1)
    return rows.select(
        F.split_part(attribute("transcript_id"), F.lit("."), F.lit(1)).alias("transcript_id"), attribute("gene_name").alias("gene"),
        F.regexp_extract(more, r'exon_number "?(\d+)', 1).try_cast("int").alias("exon_number"), F.regexp_replace(F.col("c")[0], "^chr", "").alias("chrom"),
        F.col("c")[3].try_cast("long").alias("start_pos"), F.col("c")[4].try_cast("long").alias("end_pos"), F.col("c")[6].alias("strand"),
        more.contains("MANE_Select").alias("mane_select"), more.contains("MANE_Plus_Clinical").alias("mane_plus_clinical"),
        more.contains('tag "basic"').alias("basic"), more.contains("appris_principal").alias("appris_principal"),
    )


def _table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Columns of a tab-separated file by the names in its header, all text; quotes are letters, short rows end in nulls."""
    df = spark.read.csv(path, sep="\t", header=True, quote="", enforceSchema=False)
    return df.select(*[(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast("string").alias(n) for n in names])


def read_variant_summary(spark: SparkSession, path: str, assembly: str = "GRCh37") -> DataFrame:
    """variant_key, chrom, pos, ref, alt, gene, name, clnsig, review_status, submitters of an assertion summary, one assembly.

    A gzip file is read by one task; deal its rows out before heavy work.
    """
    names = ["Assembly", "Chromosome", "PositionVCF", "ReferenceAlleleVCF", "AlternateAlleleVCF", "GeneSymbol", "Name", "ClinicalSignificance", "ReviewStatus", "NumberSubmitters"]
    rows = _table(spark, path, names).where(F.col("Assembly") == assembly)
    chrom, pos = F.regexp_replace("Chromosome", "^chr", ""), F.col("PositionVCF").try_cast("long")
    return rows.select(
        variant_key(chrom, pos, F.col("ReferenceAlleleVCF"), F.col("AlternateAlleleVCF")).alias("variant_key"), chrom.alias("chrom"), pos.alias("pos"),
        F.col("ReferenceAlleleVCF").alias("ref"), F.col("AlternateAlleleVCF").alias("alt"), F.col("GeneSymbol").alias("gene"), F.col("Name").alias("name"),
        F.col("ClinicalSignificance").alias("clnsig"), F.col("ReviewStatus").alias("review_status"), F.col("NumberSubmitters").try_cast("int").alias("submitters"),
    )


def read_assertion_vcf(spark: SparkSession, path: str) -> DataFrame:
    """variant_key, ref, alt, n_alts, gene, clnsig, composition, review_status, mc, hgvs, af_esp, af_exac, af_tgp of a VCF without samples, a row per allele."""
    c = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.col("value") != "")).select(c.alias("c"))
    rows = rows.select("c", F.expr("str_to_map(c[7], ';', '=')").alias("info"), F.split(F.col("c")[4], ",").alias("alts"))
    info = lambda n: F.col("info")[n]
    each = rows.select("c", "info", F.size("alts").alias("n_alts"), F.explode("alts").alias("alt"))
    return each.select(
        variant_key(F.col("c")[0], F.col("c")[1].try_cast("long"), F.col("c")[3], F.col("alt")).alias("variant_key"), F.col("c")[3].alias("ref"), "alt", "n_alts",
        F.split_part(info("GENEINFO"), F.lit(":"), F.lit(1)).alias("gene"), info("CLNSIG").alias("clnsig"), info("CLNSIGCONF").alias("composition"),
        info("CLNREVSTAT").alias("review_status"), info("MC").alias("mc"), info("CLNHGVS").alias("hgvs"), *[info(f"AF_{p}").try_cast("double").alias(f"af_{p.lower()}") for p in ("ESP", "EXAC", "TGP")],
    )


def read_constraint(spark: SparkSession, path: str) -> DataFrame:
    """gene, mis_z, loeuf, pli of a constraint table; text that is no number is null. See evidence.constraint_dedup for one row per gene."""
    rows = _table(spark, path, ["gene", "mis_z", "oe_lof_upper", "pLI"]).where(F.col("gene").isNotNull())
    return rows.select("gene", F.col("mis_z").try_cast("double").alias("mis_z"), F.col("oe_lof_upper").try_cast("double").alias("loeuf"), F.col("pLI").try_cast("double").alias("pli"))


def read_scoresheet(spark: SparkSession, path: str) -> DataFrame:
    """A copy number scoresheet: its columns with `Total score` as total_score, a number."""
    df = spark.read.csv(path, sep="\t", header=True)
    return df.withColumn("total_score", F.col("`Total score`").try_cast("double")).drop("Total score")


# Columns of the annotator's table, in the order of its command.
TAB = ("uploaded", "location", "symbol", "consequence", "amino_acids", "protein_position", "feature", "max_af", "gnomad_af", "max_af_pop", "nmd")


def read_annotator_tab(spark: SparkSession, path: str) -> DataFrame:
    """An annotator's tab-separated rows as text.vep_rows takes them; lines that start with # are dropped, short ones padded."""
    return annotator_rows(spark.read.text(path))


def annotator_rows(lines: DataFrame) -> DataFrame:
    """The same of lines (value)."""
    kept = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    cells = kept.select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("c"))
    return cells.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(TAB)])


def read_cnvs(spark: SparkSession, path: str, columns: dict[str, str] | None = None, fmt: str | None = None, *, cnv_only: bool = True) -> DataFrame:
    """chrom, start_pos, end_pos, svtype, cn of a table in any format. columns: name -> source name, the last two optional.

    A source with variant_kind gives its cnv rows alone, if cnv_only.
    """
    # fixed values: the source's usual names
    names = {"chrom": "CHROM", "start_pos": "POS", "end_pos": "INFO_END", "svtype": "INFO_SVTYPE", "cn": "FORMAT_CN"} | (columns or {})
    source = read_source(spark, path, fmt)
    absent = [names[c] for c in ("chrom", "start_pos", "end_pos") if names[c] not in source.columns]
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    if cnv_only and "variant_kind" in source.columns:
        source = source.where(F.col("variant_kind") == "cnv")
    own = lambda c: F.col(f"`{names[c]}`") if names[c] in source.columns else F.lit(None)
    return source.select(
        F.regexp_replace(own("chrom").cast("string"), "^chr", "").alias("chrom"), own("start_pos").cast("string").try_cast("long").alias("start_pos"),
        own("end_pos").cast("string").try_cast("long").alias("end_pos"), own("svtype").cast("string").alias("svtype"), safe_int(own("cn").cast("string")).alias("cn"),
    )


def pick_transcript(consequences: Column) -> Column:
    """Of an array of structs with mane_select and canonical, the first with the one, else with the other, else the first."""
    first = lambda test: F.get(F.filter(consequences, test), F.lit(0))
    return F.coalesce(first(lambda t: F.coalesce(t["mane_select"] != "", F.lit(False))), first(lambda t: F.coalesce(t["canonical"] == 1, F.lit(False))), F.get(consequences, F.lit(0)))


def reshape_bundle(source: DataFrame) -> dict[str, DataFrame]:
    """cases, snv and cnv of a monolithic table of calls, as distinct rows of the columns that each is about."""
    cases = source.select("case_id", "family_id", "member_id", "family_size", "proband_status", "relationship", "clinical_indication_text", "ancestry").distinct()
    cnv = source.where(F.col("variant_kind") == "cnv").select(
        "case_id", "family_id", "member_id", F.regexp_replace(F.col("chrom").cast("string"), "^chr", "").alias("chrom"), F.col("pos").cast("long").alias("start_pos"),
        F.col("end").cast("string").try_cast("long").alias("end_pos"), "svtype", F.col("cn").cast("string").try_cast("int").alias("cn"), "gt",
    )
    return {"cases": cases, "snv": canonical_calls(source.where(F.coalesce(F.col("variant_kind") != "cnv", F.lit(True)))), "cnv": cnv}


def read_curation_csv(spark: SparkSession, path: str, preamble: int = 4) -> DataFrame:
    """A curation feed: lines before the header and lines of plus signs are skipped; all text. The header is read on the driver."""
    lines = spark.read.text(path, wholetext=False).withColumn("_i", F.monotonically_increasing_id())
    head = lines.orderBy("_i").limit(preamble + 1).collect()[-1]["value"]
    names = next(iter(__import__("csv").reader([head])))
    rows = lines.where((F.col("_i") > preamble) & ~F.col("value").rlike(r'^[",+]*\+{3}') & (F.col("value") != ""))
    schema = ", ".join(f"`{n}` string" for n in names)
    parsed = rows.select(F.from_csv("value", schema).alias("r")).select("r.*")
    return parsed.where(F.col(f"`{names[0]}`").isNotNull())
