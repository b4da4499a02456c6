"""Evidence joins: protein neighbours, hotspots, nonsense-mediated decay, constraint and clinical assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.expr import AMINO, lookup, nan_to_null, review_stars


def ps1_pm5(query: DataFrame, protein: DataFrame) -> DataFrame:
    """query with same_aa and same_codon: does another pathogenic variant give the same residue, or another one there?

    query: variant_key, gene, protein_pos, alt_aa; protein: pathogenic rows of the same shape with ref_aa, of which missense
    ones count. A stop ('*') in the query has neither. Per residue the pathogenic side becomes a list of amino acids, each with
    its smallest and largest key, so one join and no shuffle of what it finds are enough.
    """
    missense = (F.col("ref_aa") != F.col("alt_aa")) & (F.col("ref_aa") != "*") & (F.col("alt_aa") != "*")
    known = protein.where(missense).groupBy("gene", "protein_pos", "alt_aa").agg(F.min("variant_key").alias("lo"), F.max("variant_key").alias("hi"))
    codon = known.groupBy("gene", "protein_pos").agg(F.collect_list(F.struct("alt_aa", "lo", "hi")).alias("_known"))
    key, aa = F.col("variant_key"), F.col("alt_aa")
    other = lambda x: (x["lo"] != key) | (x["hi"] != key)
    found = lambda same: F.coalesce((aa != "*") & F.exists("_known", lambda x: other(x) & ((x["alt_aa"] == aa) if same else (x["alt_aa"] != aa))), F.lit(False)).cast("int")
    return query.join(codon, ["gene", "protein_pos"], "left").withColumns({"same_aa": found(True), "same_codon": found(False)}).select(*query.columns, "same_aa", "same_codon")


def pm1_hotspot(query: DataFrame, codons: DataFrame, window: int = 3, least: int = 2) -> DataFrame:
    """query with pm1: `least` pathogenic and no benign variants within `window` codons. codons: gene, protein_pos, n_plp, n_blb.

    Each codon is spread over the places in its reach, which makes a band join an equi-join of a fixed growth.
    """
    spread = codons.select("gene", F.explode(F.sequence(F.col("protein_pos") - window, F.col("protein_pos") + window)).alias("protein_pos"), "n_plp", "n_blb")
    sums = spread.groupBy("gene", "protein_pos").agg(F.sum("n_plp").alias("_p"), F.sum("n_blb").alias("_b"))
    joined = query.join(sums, ["gene", "protein_pos"], "left")
    return joined.withColumn("pm1", F.when((F.col("_p") >= least) & (F.col("_b") == 0), 1).otherwise(0)).drop("_p", "_b")


def exon_order(exons: DataFrame) -> DataFrame:
    """exons with rank (in reading direction) and n (exons of the transcript)."""
    along = F.when(F.col("strand") == "+", F.col("start_pos")).otherwise(-F.col("start_pos"))
    own = Window.partitionBy("transcript_id")
    return exons.withColumn("rank", F.row_number().over(own.orderBy(along, "end_pos"))).withColumn("n", F.count(F.lit(1)).over(own))


def nmd_escaping(variants: DataFrame, exons: DataFrame, tail: int = 50, width: int = 1024) -> DataFrame:
    """variants with nmd_escaping: 1 in a single or last exon or the last `tail` bases of the one before, else 0; null outside exons.

    Exons stand in each bin of `width` bases that they touch, gathered per transcript and bin, so each variant meets one row.
    """
    ordered = exon_order(exons)
    bins = F.explode(F.sequence(F.floor(F.col("start_pos") / width), F.floor(F.col("end_pos") / width))).alias("_bin")
    near = ordered.select("transcript_id", bins, F.struct("strand", "start_pos", "end_pos", "rank", "n").alias("e")).groupBy("transcript_id", "_bin").agg(F.collect_list("e").alias("_exons"))
    pos = F.col("pos")
    near_end = lambda e: F.when(e["strand"] == "+", pos >= e["end_pos"] - tail).otherwise(pos <= e["start_pos"] + tail)
    escapes = lambda e: ((e["n"] == 1) | (e["rank"] == e["n"]) | ((e["rank"] == e["n"] - 1) & near_end(e))).cast("int")
    hits = F.transform(F.filter("_exons", lambda e: pos.between(e["start_pos"], e["end_pos"])), escapes)
    joined = variants.withColumn("_bin", F.floor(pos / width)).join(near, ["transcript_id", "_bin"], "left")
    return joined.select(*variants.columns, F.array_max(hits).alias("nmd_escaping"))


def gene_spans(exons: DataFrame) -> DataFrame:
    """chrom, gene, start_pos, end_pos: from the first base of a gene's exons on a chromosome to the last."""
    return exons.where(F.col("gene").isNotNull()).groupBy("chrom", "gene").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))


def select_transcript(exons: DataFrame) -> DataFrame:
    """gene, transcript_id, n (its exons): one per gene, by tags first (MANE Select, MANE Plus Clinical, APPRIS principal, basic), then exons, then name."""
    tags = ("mane_select", "mane_plus_clinical", "appris_principal", "basic")
    has = lambda t: F.bool_or(F.col(t)).cast("int") if t in exons.columns else F.lit(0)
    sizes = exons.groupBy("gene", "transcript_id").agg(F.count(F.lit(1)).alias("n"), *[has(t).alias(f"_{t}") for t in tags])
    rank = F.struct(*[-F.coalesce(f"_{t}", F.lit(0)) for t in tags], -F.col("n"), "transcript_id")
    return sizes.groupBy("gene").agg(F.min_by(F.struct("transcript_id", "n"), rank).alias("_t")).select("gene", "_t.transcript_id", "_t.n")


def constraint_dedup(rows: DataFrame) -> DataFrame:
    """One row per gene: the largest mis_z, by number, nulls last."""
    others = [c for c in rows.columns if c != "gene"]
    z = F.col("mis_z").try_cast("double")
    order = F.struct(z.isNull(), -F.coalesce(z, F.lit(0.0)), "loeuf")
    best = rows.groupBy("gene").agg(F.min_by(F.struct(*[z.alias(c) if c == "mis_z" else F.col(c) for c in others]), order).alias("_b"))
    return best.select("gene", *[f"_b.{c}" for c in others])


def constraint_join(annotations: DataFrame, constraint: DataFrame) -> DataFrame:
    """gnomad_mis_z is the gene's, where it has one, else the row's own; loeuf is the gene's."""
    by_gene = constraint.select("gene", F.col("mis_z").alias("_z"), F.col("loeuf").alias("_l"))
    joined = annotations.drop("loeuf").join(by_gene, "gene", "left")
    return joined.withColumns({"gnomad_mis_z": F.coalesce("_z", "gnomad_mis_z"), "loeuf": F.col("_l")}).drop("_z", "_l")


def pathogenic(clnsig: Column) -> Column:
    """Says pathogenic, and neither conflict nor benign."""
    return clnsig.ilike("%pathogenic%") & ~clnsig.ilike("%conflict%") & ~clnsig.ilike("%benign%")


def settled(clnsig: Column, composition: Column) -> Column:
    """Pathogenic, or conflicting with a composition that has pathogenic calls and no benign ones."""
    return pathogenic(clnsig) | (clnsig.ilike("%conflicting%") & composition.ilike("%pathogenic%") & ~composition.ilike("%benign%"))


def conflict_gate(rows: DataFrame) -> DataFrame:
    """Clean pathogenic rows, and conflicting ones whose composition has pathogenic calls and no benign ones."""
    return rows.where(settled(F.col("clnsig"), F.col("composition")))


CHANGE = r"p\.([A-Za-z]{3})([0-9]+)([A-Za-z]{3})"


def protein_changes(rows: DataFrame, least_stars: int = 1, gate: DataFrame | None = None) -> DataFrame:
    """gene, protein_pos, ref_aa, alt_aa, variant_key of pathogenic rows with review stars, parsed from their names.

    gate: variant_key, clnsig, composition of an assertion file. With it, a row need only speak of pathogenic, and counts if
    the file's entry for its key is clean or a settled conflict.
    """
    says = pathogenic(F.col("clnsig")) if gate is None else F.col("clnsig").ilike("%pathogenic%")
    kept = rows.where(says & (review_stars(F.col("review_status")) >= least_stars))
    if gate is not None:
        kept = kept.join(conflict_gate(gate).select("variant_key").distinct(), "variant_key", "left_semi")
    parsed = kept.select(
        "variant_key",
        "gene",
        F.regexp_extract("name", CHANGE, 2).try_cast("int").alias("protein_pos"),
        lookup(AMINO, F.regexp_extract("name", CHANGE, 1)).alias("ref_aa"),
        lookup(AMINO, F.regexp_extract("name", CHANGE, 3)).alias("alt_aa"),
    )
    return parsed.where(F.col("protein_pos").isNotNull() & F.col("ref_aa").isNotNull() & F.col("alt_aa").isNotNull() & (F.col("gene") != ""))


def codon_counts(rows: DataFrame, least_stars: int = 1) -> DataFrame:
    """gene, protein_pos, n_plp, n_blb over pathogenic and benign rows with review stars."""
    rated = rows.where((review_stars(F.col("review_status")) >= least_stars) & (F.col("gene") != "")).withColumn("protein_pos", F.regexp_extract("name", CHANGE, 2).try_cast("int"))
    benign = F.col("clnsig").ilike("%benign%") & ~F.col("clnsig").ilike("%conflict%")
    counted = rated.where(F.col("protein_pos").isNotNull() & (pathogenic(F.col("clnsig")) | benign))
    return counted.groupBy("gene", "protein_pos").agg(F.count_if(pathogenic(F.col("clnsig"))).alias("n_plp"), F.count_if(benign).alias("n_blb"))


def exact_assertion(loci: DataFrame, clinvar: DataFrame) -> DataFrame:
    """loci with the most authoritative assertion of their key: stars, then submitters, then the text itself."""
    stars = review_stars(F.col("review_status"))
    order = F.struct(-stars, -F.coalesce("submitters", F.lit(-1)), "clnsig")
    best = clinvar.groupBy("variant_key").agg(F.min_by(F.struct("clnsig", stars.alias("stars")), order).alias("_b")).select("variant_key", "_b.clnsig", "_b.stars")
    return loci.join(best, "variant_key", "left")


def ba1_exceptions(clinvar: DataFrame, least_af: float = 0.01) -> DataFrame:
    """variant_key, gene, max_af, note of well reviewed pathogenic single nucleotide variants that are common in one of three panels.

    clinvar: variant_key, ref, alt, gene (a name, or name:number), clnsig, review_status, af_esp, af_exac, af_tgp.
    """
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    review = F.col("review_status")
    trusted = review.ilike("%expert%panel%") | review.ilike("%practice%guideline%") | (review.ilike("%multiple%submitters%") & ~review.ilike("%conflict%"))
    snv = (F.length("ref") == 1) & (F.length("alt") == 1)
    rows = clinvar.where(snv & pathogenic(F.col("clnsig")) & trusted).withColumn("_af", F.greatest(number("af_esp"), number("af_exac"), number("af_tgp"))).where(F.col("_af") > least_af)
    gene = F.split_part("gene", F.lit(":"), F.lit(1)).alias("gene")
    common = rows.groupBy("variant_key", gene).agg(F.max("_af").alias("max_af"))
    return common.withColumn("note", F.lit(f"reviewed as pathogenic by two stars or more, but more common than {least_af}: exempt from BA1 and BS1"))


def dosage_score(text: Column) -> Column:
    """Evidence text of a dosage curation as its score."""
    t = F.lower(F.trim(text))
    # fixed values: the feed's wording
    return (
        F.when(t.startswith("sufficient evidence"), 3)
        .when(t.startswith("emerging evidence") | t.startswith("some evidence"), 2)
        .when(t.startswith("little evidence"), 1)
        .when(t.startswith("no evidence"), 0)
        .when(t.contains("autosomal recessive"), 30)
        .when(t.startswith("dosage sensitivity unlikely"), 40)
    )


def load_curation(validity: DataFrame, dosage: DataFrame) -> DataFrame:
    """gene, disease_id, mode_of_inheritance, hi_score, ts_score, lof_mechanism, gene_disease_validity.

    validity: gene, disease_id, moi, classification; dosage: gene, haploinsufficiency, triplosensitivity.
    """
    scores = dosage.select("gene", dosage_score(F.col("haploinsufficiency")).alias("hi_score"), F.when(dosage_score(F.col("triplosensitivity")) != 30, dosage_score(F.col("triplosensitivity"))).alias("ts_score"))
    moi = F.regexp_extract("moi", "^(AD|AR|XL|MT|SD)", 1)
    joined = validity.join(scores, "gene", "left")
    return joined.select("gene", "disease_id", moi.alias("mode_of_inheritance"), "hi_score", "ts_score", F.col("hi_score").isin(3, 30).alias("lof_mechanism"), F.col("classification").alias("gene_disease_validity"))


def dosage_sets(dosage: DataFrame) -> DataFrame:
    """gene, hi, ts: genes of the whole dosage feed that are sensitive to loss or gain, by its words, whatever else is known of them.

    dosage: gene, haploinsufficiency, triplosensitivity; a gene of several rows is sensitive if one says so.
    """
    says = lambda c: F.coalesce(F.lower(F.trim(c)).startswith("sufficient evidence"), F.lit(False))
    return dosage.where(F.col("gene").isNotNull()).groupBy("gene").agg(F.bool_or(says("haploinsufficiency")).alias("hi"), F.bool_or(says("triplosensitivity")).alias("ts"))


def gene_modes(curation: DataFrame) -> DataFrame:
    """gene, moi: a gene's modes of inheritance, each once, sorted and joined by commas; null ones and '' say nothing."""
    said = curation.where(F.coalesce("mode_of_inheritance", F.lit("")) != "")
    return said.groupBy("gene").agg(F.array_join(F.array_sort(F.collect_set("mode_of_inheritance")), ",").alias("moi"))


def splice_max_delta(text: Column) -> Column:
    """The largest of the four deltas in ALT|SYMBOL|d|d|d|d|...; a field that is no number counts as 0, no text as 0."""
    fields = F.slice(F.split(F.coalesce(text, F.lit("")), r"\|"), 3, 4)
    return F.coalesce(F.array_max(F.transform(fields, lambda x: F.coalesce(nan_to_null(x.try_cast("double")), F.lit(0.0)))), F.lit(0.0))
