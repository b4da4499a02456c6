"""Phenotypes and gene names in clinical notes, copy number picks, and annotation text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.expr import most_severe

# How clauses end, and what marks absence and relatives.
BREAKS = ("but", "however", "except", "although", "though")
NEGATIONS = ("no", "not", "without", "denies", "denied", "absent", "negative for", "ruled out", "non", "resolved")
RELATIVES = (
    "family history", "fh of", "mother", "father", "sister", "brother", "sibling", "maternal", "paternal", "cousin", "aunt", "uncle", "grandmother", "grandfather",
)
_EDGE, _END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
CLAUSE = rf"[.,;]|{_EDGE}(?:{'|'.join(BREAKS)}){_END}"
NEGATION = rf"{_EDGE}(?:{'|'.join(NEGATIONS)}){_END}"
FAMILY = rf"{_EDGE}(?:{'|'.join(RELATIVES)}){_END}"


def extract_terms(notes: DataFrame, terms: dict[str, str]) -> DataFrame:
    """note_id, term, scope (observed, excluded, family): a term's first clause decides; family goes before negation.

    terms: term -> word that names it, as a whole word without case. notes: note_id, text.
    """
    clauses = notes.select("note_id", F.posexplode(F.split(F.lower(F.coalesce("text", F.lit(""))), CLAUSE)).alias("pos", "clause"))
    found = F.filter(F.array(*[F.when(F.col("clause").rlike(rf"(?<![A-Za-z0-9_]){word}(?![A-Za-z0-9_])"), F.lit(term)) for term, word in terms.items()]), lambda x: x.isNotNull())
    scope = F.when(F.col("clause").rlike(FAMILY), "family").when(F.col("clause").rlike(NEGATION), "excluded").otherwise("observed")
    return clauses.select("note_id", "pos", scope.alias("scope"), F.explode(found).alias("term")).groupBy("note_id", "term").agg(F.min_by("scope", "pos").alias("scope"))


def referral_genes(notes: DataFrame, known: DataFrame) -> DataFrame:
    """note_id, gene: known genes that a note writes in capitals, as whole words of two to ten characters."""
    tokens = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(rf"{_EDGE}[A-Z][A-Z0-9]{{1,9}}{_END}"), F.lit(0)))).alias("gene")
    return notes.select("note_id", tokens).join(known.select("gene").distinct(), "gene", "left_semi")


def cnv_direction(svtype: Column, cn: Column) -> Column:
    """DEL or DUP from the type, else from the copy number; null if neither says."""
    t = F.upper(svtype)
    return F.when(t.isin("DEL", "DUP"), t).when(cn < 2, "DEL").when(cn > 2, "DUP")


def pick_gene(genes: Column, svtype: Column, hi: Column, ts: Column) -> Column:
    """The first listed gene that is dosage sensitive in the CNV's direction, else the first. hi, ts: arrays of genes."""
    listed = F.filter(F.split(F.coalesce(genes, F.lit("")), r"[,;|\s]+"), lambda g: g != "")
    wanted = F.when(F.upper(svtype) == "DEL", hi).otherwise(ts)
    return F.coalesce(F.get(F.filter(listed, lambda g: F.array_contains(wanted, g)), F.lit(0)), F.get(listed, F.lit(0)))


def vep_rows(rows: DataFrame) -> DataFrame:
    """variant_key, gene, consequence, protein_pos, alt_aa, transcript_id, filtering_af (the largest population's), gnomad_af,
    max_af_pop, nmd_escaping of annotator rows in text form.

    nmd_escaping: 1 where the annotator says so, 0 for other stops and frameshifts, null elsewhere. - stands for nothing.
    """
    some = lambda c: F.when(~F.col(c).isin("-", ".", ""), F.col(c))
    part = lambda c, sep, i: F.split_part(c, F.lit(sep), F.lit(i))
    alleles = part(F.col("uploaded"), "_", 3)
    key = F.concat_ws("-", part(F.col("uploaded"), "_", 1), part(F.col("uploaded"), "_", 2), part(alleles, "/", 1), part(alleles, "/", 2))
    stops = F.col("consequence").contains("stop_gained") | F.col("consequence").contains("frameshift")
    return rows.select(
        key.alias("variant_key"),
        some("symbol").alias("gene"),
        most_severe(F.col("consequence")).alias("consequence"),
        some("protein_position").try_cast("int").alias("protein_pos"),
        F.when(F.col("amino_acids").contains("/"), part(F.col("amino_acids"), "/", 2)).alias("alt_aa"),
        some("feature").alias("transcript_id"),
        part(some("max_af"), "&", 1).try_cast("double").alias("filtering_af"),
        some("gnomad_af").try_cast("double").alias("gnomad_af"),
        some("max_af_pop").alias("max_af_pop"),
        F.when(F.col("nmd") == "NMD_escaping_variant", 1).when(stops, 0).alias("nmd_escaping"),
    )
