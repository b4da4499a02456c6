"""Reusable column expressions of the variant engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Point bands, severity order, consequence names, class ordinals and validity ordinals of the classification.
BANDS = ((10, "Pathogenic"), (6, "Likely Pathogenic"), (0, "VUS"), (-6, "Likely Benign"))
CNV_BANDS = ((">=", 0.99, "Pathogenic"), (">=", 0.90, "Likely Pathogenic"), (">", -0.90, "VUS"), (">", -0.99, "Likely Benign"))
SEVERITY = (
    "frameshift", "stop_gained", "splice_donor", "splice_acceptor", "start_lost", "stop_lost",
    "inframe_deletion", "inframe_insertion", "missense", "splice_region", "synonymous", "intron", "utr",
)
SO_TERMS = {
    "missense_variant": "missense", "synonymous_variant": "synonymous", "frameshift_variant": "frameshift", "stop_gained": "stop_gained",
    "start_lost": "start_lost", "stop_lost": "stop_lost", "splice_donor_variant": "splice_donor", "splice_acceptor_variant": "splice_acceptor",
    "splice_region_variant": "splice_region", "inframe_deletion": "inframe_deletion", "inframe_insertion": "inframe_insertion",
    "intron_variant": "intron", "5_prime_UTR_variant": "utr", "3_prime_UTR_variant": "utr",
}
TIERS = {"Pathogenic": 5, "Likely Pathogenic": 4, "VUS": 3, "Likely Benign": 2, "Benign": 1}
PATHOGENICITY = {"Pathogenic": 1.0, "Likely Pathogenic": 0.9, "VUS": 0.5, "Likely Benign": 0.1, "Benign": 0.0}
GENOTYPE_BOOST = {
    "biallelic_homozygous": 3, "biallelic_candidate": 2, "monoallelic_dominant": 1, "monoallelic_carrier": -1,
    "biallelic_loss": 3, "dominant_loss": 3, "dominant_gain": 2, "uncertain_dosage": 0,
}
VALIDITY = {"Definitive": 6, "Strong": 5, "Moderate": 4, "Limited": 3, "Disputed": 2, "Refuted": 1}
AMINO = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I", "Leu": "L",
    "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Ter": "*", "Sec": "U",
}
NOT_EVALUATED = "Not evaluated (non-SNV/indel — see Riggs 2020)"
NO_CRITERIA = "(none — abstained)"


def lookup(table: dict, key: Column, default: Column | None = None) -> Column:
    """A small fixed table as an expression; null or default for other keys."""
    chain = None
    for k, v in table.items():
        chain = F.when(key == k, F.lit(v)) if chain is None else chain.when(key == k, F.lit(v))
    return chain if default is None else chain.otherwise(default)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """chrom-pos-ref-alt without a chr prefix; null if any part is."""
    return F.concat(F.regexp_replace(chrom.cast("string"), "^chr", ""), F.lit("-"), pos.cast("string"), F.lit("-"), ref, F.lit("-"), alt)


def variant_kind(ref: Column, alt: Column) -> Column:
    return F.when((F.length(ref) == 1) & (F.length(alt) == 1) & (ref != "-") & (alt != "-"), "snv").otherwise("indel")


def safe_int(text: Column) -> Column:
    """A whole number from text that may be written as a decimal; null where it is none."""
    return F.round(text.try_cast("double")).cast("int")


def band(points: Column) -> Column:
    chain = F.when(points >= BANDS[0][0], BANDS[0][1])
    for least, name in BANDS[1:]:
        chain = chain.when(points >= least, name)
    return F.when(points.isNotNull(), chain.otherwise("Benign"))


def cnv_band(score: Column) -> Column:
    chain = F
    for op, least, name in CNV_BANDS:
        chain = chain.when(score >= least if op == ">=" else score > least, name)
    return F.when(score.isNotNull(), chain.otherwise("Benign"))


def review_stars(status: Column) -> Column:
    s = F.lower(status)
    return (
        F.when(s.contains("practice guideline"), 4)
        .when(s.contains("expert panel"), 3)
        .when(s.contains("multiple submitters") & ~s.contains("conflict"), 2)
        .when(s.contains("criteria provided"), 1)
        .otherwise(0)
    )


def carried_gt(gt: Column) -> Column:
    """Called, and not homozygous reference."""
    return called_gt(gt) & ~gt.isin("0/0", "0|0")


def zygosity(gt: Column) -> Column:
    """hom for two equal called alleles other than the reference, else het."""
    a = F.split(F.regexp_replace(F.coalesce(gt, F.lit("")), r"\|", "/"), "/")
    same = (F.size(a) == 2) & (F.get(a, F.lit(0)) == F.get(a, F.lit(1))) & ~F.get(a, F.lit(0)).isin("0", ".", "")
    return F.when(same, "hom").otherwise("het")


def zygosity_on(chrom: Column, gt: Column) -> Column:
    """Zygosity as a report shows it: hom on X may be hemizygous; a genotype that is neither is shown as it is."""
    x = F.regexp_replace(chrom, "^chr", "") == "X"
    return F.when(gt.isin("1/1", "1|1"), F.when(x, "hom/hemi(X)").otherwise("hom")).when(gt.isin("0/1", "1/0", "0|1", "1|0"), "het").otherwise(F.coalesce(gt, F.lit("")))


def called_gt(gt: Column) -> Column:
    return gt.isNotNull() & ~gt.contains(".")


def passes(value: Column, least: int) -> Column:
    return value.isNull() | (value >= least)


def most_severe(terms: Column) -> Column:
    """The most severe known consequence of a list of terms joined by & or commas, null if none is known."""
    mapped = F.transform(F.split(terms, "[&,]"), lambda t: lookup(SO_TERMS, F.trim(t)))
    order = F.array(*[F.lit(s) for s in SEVERITY])
    return F.get(F.filter(order, lambda s: F.array_contains(mapped, s)), F.lit(0))


def is_recessive(moi: Column) -> Column:
    m = F.lower(F.coalesce(moi, F.lit("")))
    return F.exists(F.split(m, ","), lambda t: F.trim(t).isin("ar", "xlr") | t.contains("recessive"))


def is_dominant(moi: Column) -> Column:
    m = F.lower(F.coalesce(moi, F.lit("")))
    return F.exists(F.split(m, ","), lambda t: F.trim(t).isin("ad", "sd", "xld") | t.contains("dominant"))
