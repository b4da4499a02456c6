"""The rule kernel: thresholds and frequencies as data, all rules in one pass over the variants, then points to classes.

A variant's evidence is an array within its row, so rules neither scan twice nor shuffle; the specification's tables are
aggregated or keyed before they join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.expr import NO_CRITERIA, NOT_EVALUATED, VALIDITY, band, lookup, nan_to_null

NUMBERS = ("filtering_af", "gnomad_mis_z", "revel", "spliceai", "loeuf", "cadd_phred")


@dataclass(frozen=True)
class KernelConfig:
    """Rules that only count when asked for."""

    pm1: bool = False
    pvs1_constraint: bool = False
    cadd: bool = False


def resolve_spec(annotations: DataFrame, thresholds: DataFrame, frequency: DataFrame) -> DataFrame:
    """Adds ba1_maf, bs1_maf, pm2_maf (a gene's own over the default) and the filtering frequency.

    The frequency is the largest over populations with 2000 alleles or more, else the variant's own. NaN counts as null.
    """
    clean = annotations.withColumns({c: nan_to_null(F.col(c)) for c in NUMBERS if c in annotations.columns})
    largest = frequency.where(F.col("af").isNotNull() & (F.col("an") >= 2000)).groupBy("variant_key").agg(F.max("af").alias("_af"))
    names = ("ba1_maf", "bs1_maf", "pm2_maf")
    default = thresholds.where(F.col("gene").isNull()).agg(*[F.first(c).alias(f"_d_{c}") for c in names])
    own = thresholds.where(F.col("gene").isNotNull()).groupBy("gene").agg(*[F.max(c).alias(f"_g_{c}") for c in names])
    return (
        clean.join(largest, "variant_key", "left")
        .join(own, "gene", "left")
        .crossJoin(default)  # one row
        .withColumns({"filtering_af": F.coalesce("_af", "filtering_af"), **{c: F.coalesce(f"_g_{c}", f"_d_{c}") for c in names}})
        .select(*annotations.columns, *names)
    )


def rule_table(config: KernelConfig) -> list[tuple[str, str, int, Column]]:
    """criterion, direction, points and condition of every rule."""
    c = F.col
    af, revel, splice, cadd = c("filtering_af"), c("revel"), c("spliceai"), c("cadd_phred")
    missense, kind = c("consequence") == "missense", c("consequence")
    common = ~c("_excepted")
    spliced = kind.isin("splice_region", "splice_donor", "splice_acceptor", "intron", "synonymous")
    lof = kind.isin("stop_gained", "frameshift", "splice_donor", "splice_acceptor")
    mechanism = c("_lof") | (F.lit(config.pvs1_constraint) & (c("loeuf") < 0.35))
    unclaimed = (
        F.lit(config.cadd)
        & c("clinvar_classification").isNull()
        & ~(missense & revel.isNotNull())
        & ~(spliced & splice.isNotNull())
        & ~kind.isin("stop_gained", "frameshift", "splice_donor", "splice_acceptor", "inframe_deletion", "inframe_insertion", "stop_lost")
    )
    return [
        ("BA1", "B", -8, common & (af > c("ba1_maf"))),
        ("BS1", "B", -4, common & (af > c("bs1_maf")) & (af <= c("ba1_maf"))),
        ("PM2_Supporting", "P", 1, af <= c("pm2_maf")),
        ("PP2", "P", 1, missense & (c("gnomad_mis_z") >= 3.09)),
        ("BP4_VeryStrong", "B", -8, missense & (revel <= 0.003)),
        ("BP4_Strong", "B", -4, missense & (revel > 0.003) & (revel <= 0.016)),
        ("BP4_Moderate", "B", -2, missense & (revel > 0.016) & (revel <= 0.183)),
        ("BP4", "B", -1, missense & (revel > 0.183) & (revel <= 0.290)),
        ("PP3", "P", 1, missense & (revel >= 0.644) & (revel < 0.773)),
        ("PP3_Moderate", "P", 2, missense & (revel >= 0.773) & (revel < 0.932)),
        ("PP3_Strong", "P", 4, missense & (revel >= 0.932)),
        ("PP3", "P", 1, spliced & (splice >= 0.2)),
        ("BP7", "B", -1, (kind == "synonymous") & (splice < 0.2)),
        ("PM4", "P", 2, kind.isin("inframe_deletion", "inframe_insertion", "stop_lost")),
        ("PS1", "P", 4, c("clinvar_same_aa") == 1),
        ("PM5", "P", 2, c("clinvar_same_codon_lp") == 1),
        ("PM1", "P", 2, F.lit(config.pm1) & missense & (c("pm1") == 1)),
        ("PVS1_VeryStrong", "P", 8, lof & (c("nmd_escaping") == 0) & mechanism),
        ("PVS1_Strong", "P", 4, lof & (c("nmd_escaping") == 1) & mechanism),
        ("PP3", "P", 1, unclaimed & (cadd >= 20)),
        ("BP4", "B", -1, unclaimed & (cadd <= 10)),
    ]


def with_evidence(spec: DataFrame, curation: DataFrame, exceptions: DataFrame, config: KernelConfig) -> DataFrame:
    """Adds `evidence`, the distinct (criterion, direction, points) that hold for the variant; unknown conditions don't."""
    lof = curation.where(F.col("lof_mechanism")).select("gene", F.lit(True).alias("_lof")).distinct()
    spared = exceptions.select("variant_key", F.lit(True).alias("_excepted")).distinct()
    known = spec.join(lof, "gene", "left").join(spared, "variant_key", "left")
    known = known.withColumns({"_lof": F.coalesce("_lof", F.lit(False)), "_excepted": F.coalesce("_excepted", F.lit(False))})
    held = [F.when(when, F.struct(F.lit(name).alias("criterion"), F.lit(way).alias("direction"), F.lit(points).alias("points"))) for name, way, points, when in rule_table(config)]
    return known.withColumn("evidence", F.array_distinct(F.filter(F.array(*held), lambda x: x.isNotNull()))).select(*spec.columns, "evidence")


def applied_criteria(evidence: DataFrame) -> DataFrame:
    """variant_key, criterion, direction, points: one row per rule that holds."""
    return evidence.select("variant_key", F.explode("evidence").alias("e")).select("variant_key", "e.*")


def strongest_validity(curation: DataFrame) -> DataFrame:
    rank = lookup(VALIDITY, F.col("gene_disease_validity"), F.lit(0))
    return curation.groupBy("gene").agg(F.max_by("gene_disease_validity", rank).alias("validity"))


def combine(evidence: DataFrame, curation: DataFrame) -> DataFrame:
    """variant_key, gene, variant_kind, total_points, criteria, validity, raw_class, acmg_class, pm1_hotspot.

    One row per variant_key is expected; classify() sees to it.
    """
    names = F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["criterion"])))
    scored = evidence.select(
        "variant_key",
        "gene",
        "variant_kind",
        F.coalesce("pm1", F.lit(0)).alias("pm1_hotspot"),
        F.aggregate("evidence", F.lit(0).cast("long"), lambda a, e: a + e["points"]).alias("total_points"),
        F.when(F.size("evidence") > 0, F.array_join(names, ", ")).otherwise(NO_CRITERIA).alias("criteria"),
        F.exists("evidence", lambda e: e["criterion"] == "BA1").alias("_ba1"),
    ).withColumn("raw_class", F.when(F.col("_ba1"), "Benign").otherwise(band(F.col("total_points"))))
    kind, raw, validity = F.col("variant_kind"), F.col("raw_class"), F.col("validity")
    likely = raw.isin("Pathogenic", "Likely Pathogenic")
    capped = (
        F.when(kind.isNotNull() & ~kind.isin("snv", "indel"), NOT_EVALUATED)
        .when(validity.isin("Limited", "Disputed", "Refuted") & likely, "VUS")
        .when((validity == "Moderate") & (raw == "Pathogenic"), "Likely Pathogenic")
        .otherwise(raw)
    )
    return scored.join(strongest_validity(curation), "gene", "left").withColumn("acmg_class", capped).drop("_ba1")


def classify(annotations: DataFrame, thresholds: DataFrame, frequency: DataFrame, curation: DataFrame, exceptions: DataFrame, config: KernelConfig = KernelConfig()) -> DataFrame:
    """The whole kernel over one row per variant_key: of repeated keys the row that is least in the order of its columns stays."""
    others = [c for c in annotations.columns if c != "variant_key"]
    one = annotations.groupBy("variant_key").agg(F.min(F.struct(*others)).alias("_a")).select("variant_key", *[f"_a.{c}" for c in others])
    spec = resolve_spec(one.select(*annotations.columns), thresholds, frequency)
    return combine(with_evidence(spec, curation, exceptions, config), curation)


def ranked(classified: DataFrame) -> DataFrame:
    """Most points first, then by key."""
    return classified.orderBy(F.desc("total_points"), "variant_key")


#: Columns of the specification's tables.
SPEC_TABLES = {
    "gene_curation": ("gene", "disease_id", "mode_of_inheritance", "hi_score", "lof_mechanism", "gene_disease_validity", "source", "ts_score"),
    "acmg_thresholds": ("gene", "ba1_maf", "bs1_maf", "pm2_maf"),
    "variant_frequency": ("variant_key", "population", "af", "an"),
    "ba1_exceptions": ("variant_key", "gene", "note"),
}


def override(name: str, given: DataFrame | None, default: DataFrame) -> DataFrame:
    """The given table in place of the default one, by name: columns that it lacks are null, unknown ones raise."""
    if given is None:
        return default
    unknown = [c for c in given.columns if c not in SPEC_TABLES[name]]
    if unknown:
        raise ValueError(f"{name} has no such columns: {', '.join(unknown)}")
    kinds = {f.name: f.dataType for f in default.schema}
    return given.select(*[(F.col(c) if c in given.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in default.columns])
