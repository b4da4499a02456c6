"""Per-case folding, ranking, triage and re-analysis, for all cases at once: every window is partitioned by case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.expr import GENOTYPE_BOOST, PATHOGENICITY, TIERS, band, carried_gt, is_dominant, is_recessive, lookup, zygosity
from varloom.operators import evidence, family, phenotype, text
from varloom.operators.ledger import APPROVAL, latest

# Points of case criteria, structures that support them, boosts and thresholds.
CASE_POINTS = {
    "PS2": 4, "PM6": 2, "PM3": 2, "PP1": 1, "PP1_Moderate": 2, "PP1_Strong": 4, "BS4": -4,
    "PP4": 1, "PP4_Moderate": 2, "PS3": 4, "PS3_Moderate": 2, "PS3_Supporting": 1, "PS4": 4,
}
FAMILY_CRITERIA = ("PS2", "PM6", "PM3", "PP1", "PP1_Moderate", "PP1_Strong", "BS4")
FAMILY_STRUCTURES = ("duo", "trio", "quad", "multiplex")
NAMED_GENE_BOOST = 8
STRONG_PHENOTYPE = 0.5
WEIGHTS = {"phenotype": 0.5, "genotype": 0.4, "inheritance": 0.1}


def genotype_fit(variants: DataFrame, moi: DataFrame) -> DataFrame:
    """variants (case_id, gene, zygosity, ...) with genotype_fit. moi: gene, moi (AD, AR and others, by commas)."""
    known = moi.groupBy("gene").agg(F.max("moi").alias("_moi"))
    joined = variants.join(known, "gene", "left").withColumns({"_ar": is_recessive(F.col("_moi")), "_ad": is_dominant(F.col("_moi"))})
    hets = F.count_if(F.col("_ar") & (F.col("zygosity") == "het")).over(Window.partitionBy("case_id", "gene"))
    fit = (
        F.when(F.col("_ar") & (F.col("zygosity") == "hom"), "biallelic_homozygous")
        .when(F.col("_ar") & (F.col("zygosity") == "het") & (F.col("_hets") >= 2), "biallelic_candidate")
        .when(F.col("_ar") & (F.col("zygosity") == "het") & ~F.col("_ad"), "monoallelic_carrier")
        .otherwise("monoallelic_dominant")
    )
    return joined.withColumn("_hets", hets).withColumn("genotype_fit", fit).drop("_moi", "_ar", "_ad", "_hets")


def approved_facts(judgments: DataFrame, ledger: DataFrame) -> DataFrame:
    """judgments (digest, ...) whose exact digest the ledger's last event approves. ledger: digest, event, ts."""
    return judgments.join(latest(ledger).where(F.col("status") == APPROVAL).select("digest"), "digest", "left_semi")


def classify_case(variants: DataFrame, facts: DataFrame | None, structures: DataFrame, judgments: DataFrame | None = None) -> DataFrame:
    """variants with case_points, case_criteria, case_total_points, case_class.

    facts: case_id, variant_key, criterion, each once (PS2, PM3 or PP1 from the pedigree); none: variants has them as a list, `facts`
    (see with_facts). judgments: the same with points (null: the criterion's own), approved ones alone (see approved_facts), each of
    which counts. Criteria that need a family count in families only, whoever says them. structures: case_id, structure. BA1 stays
    benign whatever the points.
    """
    families = _families(structures)
    said = None if facts is None else facts.select("case_id", "variant_key", "criterion", F.lit(None).cast("double").alias("points")).distinct()
    if judgments is not None:
        judged = judgments.select("case_id", "variant_key", "criterion", F.col("points").cast("double").alias("points"))
        said = judged if said is None else said.unionByName(judged)
    joined = variants
    if said is not None:
        points = F.coalesce("points", lookup(CASE_POINTS, F.col("criterion"), F.lit(0)).cast("double"))
        folded = (
            said.join(families, "case_id", "left")
            .where(~F.col("criterion").isin(*FAMILY_CRITERIA) | F.col("_family"))
            .withColumn("_points", points)
            .where("_points <> 0")
            .groupBy("case_id", "variant_key")
            .agg(F.sum("_points").alias("_p"), F.array_sort(F.collect_list("criterion")).alias("_l"))
        )
        joined = joined.join(folded, ["case_id", "variant_key"], "left")
    if facts is None:
        none = F.array().cast("array<string>")
        told = F.coalesce(F.when(F.col("_family"), F.col("facts")), none)
        also = (F.lit(0.0), none) if said is None else (F.coalesce("_p", F.lit(0.0)), F.coalesce("_l", none))
        joined = joined.join(families, "case_id", "left").withColumns({"_p": _points(told) + also[0], "_l": F.array_sort(F.concat(told, also[1]))}).drop("_family", "facts")
    return _with_class(joined.withColumn("_c", F.array_join("_l", ",")).drop("_l"))


def _families(structures: DataFrame) -> DataFrame:
    return structures.where(F.col("structure").isin(*FAMILY_STRUCTURES)).select("case_id", F.lit(True).alias("_family")).distinct()


def _points(told: Column) -> Column:
    return F.aggregate(F.transform(told, lambda c: lookup(CASE_POINTS, c, F.lit(0)).cast("double")), F.lit(0.0), lambda s, p: s + p)


def _with_class(joined: DataFrame) -> DataFrame:
    """joined, which has _p and _c, points and names of case criteria, with the columns of classify_case."""
    joined = joined.withColumns({"case_points": F.coalesce("_p", F.lit(0.0)), "case_criteria": F.coalesce("_c", F.lit(""))})
    total = joined.withColumn("case_total_points", F.coalesce("total_points", F.lit(0)) + F.col("case_points"))
    return total.withColumn("case_class", F.when(F.coalesce("criteria", F.lit("")).contains("BA1"), "Benign").otherwise(band(F.col("case_total_points")))).drop("_p", "_c")


def phenotype_edges(knowledge: DataFrame) -> DataFrame:
    """gene, hpo_id: the distinct gene to phenotype edges of a knowledge graph's rows (subject_label, object)."""
    rows = knowledge.select(F.col("subject_label").alias("gene"), F.col("object").alias("hpo_id"))
    return rows.where(F.col("gene").isNotNull() & F.col("hpo_id").startswith("HP:")).distinct()


def ic_weights(edges: DataFrame, terms: DataFrame, universe: int | None = None) -> DataFrame:
    """hpo_id, ic: -log2 of the share of genes that have the term; universe: number of genes, else those of edges."""
    genes = F.lit(universe) if universe else F.col("_all")
    total = edges.agg(F.greatest(F.countDistinct("gene"), F.lit(1)).alias("_all"))
    counts = edges.join(terms.select("hpo_id").distinct(), "hpo_id").groupBy("hpo_id").agg(F.greatest(F.countDistinct("gene"), F.lit(1)).alias("_g"))
    return counts.crossJoin(total).select("hpo_id", (-F.log2(F.col("_g") / genes)).alias("ic"))  # one row


def phenotype_scores(edges: DataFrame, patient_terms: DataFrame, weighted: bool = True) -> DataFrame:
    """case_id, gene, phenotype_score: weights of the case's terms that the gene has."""
    genes = F.collect_set("gene").alias("_genes")  # of one term
    by_term = edges.groupBy("hpo_id").agg(genes)
    if weighted:
        total = edges.agg(F.greatest(F.countDistinct("gene"), F.lit(1)).alias("_all"))  # one row
        by_term = by_term.crossJoin(F.broadcast(total)).withColumn("ic", -F.log2(F.size("_genes") / F.col("_all"))).drop("_all")
    else:
        by_term = by_term.withColumn("ic", F.lit(1.0))
    # to its case before genes are spelled out: rows of a term, which stand together here, have equal lists
    met = patient_terms.distinct().join(by_term, "hpo_id").select("case_id", "_genes", "ic").repartition("case_id").select("case_id", F.explode("_genes").alias("gene"), "ic")
    return met.groupBy("case_id", "gene").agg(F.sum("ic").alias("phenotype_score"))


def _norm(score: Column) -> Column:
    top = F.max(score).over(Window.partitionBy("case_id"))
    return F.when(top > 0, score / top).otherwise(0.0)


def rerank(variants: DataFrame, phenotype: DataFrame, inheritance: DataFrame | None = None) -> DataFrame:
    """variants with phenotype_score, phenotype_norm, pathogenicity and combined_score within each case."""
    v = variants.join(phenotype, ["case_id", "gene"], "left").withColumn("phenotype_score", F.coalesce("phenotype_score", F.lit(0.0)))
    if inheritance is not None:
        v = v.join(inheritance.select("case_id", "variant_key", "inheritance_score"), ["case_id", "variant_key"], "left")
    else:
        v = v.withColumn("inheritance_score", F.lit(0.0))
    v = v.withColumns({"phenotype_norm": _norm(F.col("phenotype_score")), "pathogenicity": lookup(PATHOGENICITY, F.col("acmg_class"), F.lit(0.5)), "inheritance_score": F.coalesce("inheritance_score", F.lit(0.0))})
    score = WEIGHTS["phenotype"] * F.col("phenotype_norm") + WEIGHTS["genotype"] * F.col("pathogenicity") + WEIGHTS["inheritance"] * F.col("inheritance_score")
    return v.withColumn("combined_score", score)


def cnv_genotype_fit(cnv: DataFrame, hi_genes: DataFrame, ts_genes: DataFrame) -> DataFrame:
    """cnv (svtype, cn, gene) with genotype_fit from copy number and the gene's dosage sensitivity."""
    flag = lambda df, c: df.select("gene", F.lit(True).alias(c)).distinct()
    joined = cnv.join(flag(hi_genes, "_hi"), "gene", "left").join(flag(ts_genes, "_ts"), "gene", "left")
    sv = F.upper(F.coalesce("svtype", F.lit("")))
    fit = F.when((sv == "DEL") & (F.col("cn") == 0), "biallelic_loss").when((sv == "DEL") & F.col("_hi"), "dominant_loss").when((sv == "DUP") & F.col("_ts"), "dominant_gain").otherwise("uncertain_dosage")
    return joined.withColumn("genotype_fit", fit).drop("_hi", "_ts")


def rank_candidates(rows: DataFrame, named_genes: DataFrame | None = None) -> DataFrame:
    """rows (case_id, candidate_id, gene, acmg_class, phenotype_score, genotype_fit) with class_tier, combined_score, rank.

    The tier counts tenfold, then the phenotype within the case, the genotype and a gene that the clinician named.
    """
    rows = rows.withColumns({"phenotype_score": F.coalesce("phenotype_score", F.lit(0.0)), "class_tier": lookup(TIERS, F.col("acmg_class"), F.lit(3))})
    score = F.col("class_tier") * 10 + _norm(F.col("phenotype_score")) * 5 + lookup(GENOTYPE_BOOST, F.col("genotype_fit"), F.lit(0))
    if named_genes is not None:
        rows = rows.join(named_genes.select("case_id", "gene", F.lit(NAMED_GENE_BOOST).alias("_named")).distinct(), ["case_id", "gene"], "left")
        score = score + F.coalesce("_named", F.lit(0))
    order = Window.partitionBy("case_id").orderBy(F.desc("combined_score"), "candidate_id")
    ranked = rows.withColumn("combined_score", score).withColumn("rank", F.row_number().over(order))
    return ranked.drop("_named")


_CANDIDATE = ["case_id", "candidate_id", "kind", "gene", "acmg_class", "class_tier", "phenotype_score", "genotype_fit", "combined_score", "rank"]


def candidate_table(snv: DataFrame, cnv: DataFrame, named_genes: DataFrame | None = None) -> DataFrame:
    """case_id, candidate_id, kind, gene, acmg_class, class_tier, phenotype_score, genotype_fit, combined_score, rank of both kinds together."""
    names = ["case_id", "candidate_id", "kind", "gene", "acmg_class", "phenotype_score", "genotype_fit"]
    return rank_candidates(snv.select(*names).unionByName(cnv.select(*names)), named_genes).select(*_CANDIDATE)


def top_n(candidates: DataFrame, n: int) -> DataFrame:
    return candidates.where(F.col("rank") <= n)


def triage(rows: DataFrame) -> DataFrame:
    """rows (acmg_class, phenotype_norm, clinvar, biallelic, gene_ar, gene_ad) with decision and review."""
    likely = F.coalesce(F.col("acmg_class").isin("Pathogenic", "Likely Pathogenic"), F.lit(False))
    pheno = F.coalesce("phenotype_norm", F.lit(0.0))
    carrier = F.coalesce("gene_ar", F.lit(False)) & ~F.coalesce("gene_ad", F.lit(False)) & ~F.coalesce("biallelic", F.lit(False))
    decision = (
        F.when(F.lower(F.coalesce("clinvar", F.lit(""))).contains("conflict"), "mixed")
        .when(likely & (pheno > 0) & carrier, "mixed")
        .when(likely & (pheno > 0), "reportable")
        .when(likely & (pheno == 0), "mixed")
        .when(~likely & (pheno >= STRONG_PHENOTYPE), "mixed")
        .otherwise("not_enough_evidence")
    )
    review = lookup({"reportable": "confirm", "mixed": "adjudicate"}, F.col("decision"), F.lit("none"))
    return rows.withColumn("decision", decision).withColumn("review", review)


def case_decision(triaged: DataFrame) -> DataFrame:
    """case_id, go, lead, human_review: the leading variant decides; a case without any gets a targeted look."""
    priority = lookup({"reportable": 2, "mixed": 1}, F.col("decision"), F.lit(0))
    order = Window.partitionBy("case_id").orderBy(F.desc("_p"), F.desc("combined_score"), "variant_key")
    lead = triaged.withColumn("_p", priority).withColumn("_r", F.row_number().over(order)).where("_r = 1")
    review = F.when(F.col("decision") == "not_enough_evidence", "targeted").otherwise(F.col("review"))
    return lead.select("case_id", F.col("decision").alias("go"), F.col("variant_key").alias("lead"), review.alias("human_review"))


def reanalysis_diff(current: DataFrame, prior: DataFrame) -> DataFrame:
    """variant_key, prior_class, current_class, status: new, upgraded, downgraded, unchanged or dropped.

    A prior row without a class counts as none; repeated prior keys count once.
    """
    before = prior.where(F.col("acmg_class").isNotNull()).groupBy("variant_key").agg(F.max("acmg_class").alias("prior_class"))
    now = current.select("variant_key", F.col("acmg_class").alias("current_class"), F.lit(True).alias("_now"))
    rank = lambda c: lookup(TIERS, F.col(c), F.lit(-1))
    status = (
        F.when(F.col("_now").isNull(), "dropped")
        .when(F.col("prior_class").isNull(), "new")
        .when(rank("current_class") > rank("prior_class"), "upgraded")
        .when(rank("current_class") < rank("prior_class"), "downgraded")
        .otherwise("unchanged")
    )
    return now.join(before, "variant_key", "full").select("variant_key", "prior_class", "current_class", status.alias("status"))


def newly_reportable(diff: DataFrame) -> DataFrame:
    return diff.where(F.col("status").isin("new", "upgraded") & F.col("current_class").isin("Pathogenic", "Likely Pathogenic"))


def biallelic_flag(variants: DataFrame) -> DataFrame:
    """variants with biallelic: homozygous, or one of two likely pathogenic ones or more in the gene of the case."""
    likely = F.col("acmg_class").isin("Pathogenic", "Likely Pathogenic")
    both = F.size(F.collect_set(F.when(likely, F.col("variant_key"))).over(Window.partitionBy("case_id", "gene"))) >= 2
    return variants.withColumn("biallelic", (F.col("zygosity") == "hom") | both)


def pedigree_facts(variants: DataFrame, table: DataFrame, moi: DataFrame) -> DataFrame:
    """case_id, variant_key, criterion: PS2, PM3 and PP1 for variants that are uncertain or worse; PM3 in recessive genes alone.

    table: family.trios, which is read once. Of a case's variants in a gene, one from the father is in trans with one from the
    mother that comes after it by key, and the other way round, so the first of the one side and the last of the other decide
    for all, and no pairs are made.
    """
    live = variants.where(F.col("acmg_class").isin("Pathogenic", "Likely Pathogenic", "VUS")).select("case_id", "family_id", "variant_key").distinct()
    recessive = moi.where(is_recessive(F.col("moi"))).select("gene", F.lit(True).alias("_ar")).distinct()
    says = table.select("family_id", "variant_key", "gene", family.is_new().alias("_new"), family.is_shared().alias("_shared"), family.inherited_from().alias("_from"))
    rows = live.join(says.where(F.col("_new") | F.col("_shared") | F.col("_from").isNotNull()), ["family_id", "variant_key"]).join(recessive, "gene", "left")
    own = Window.partitionBy("case_id", "family_id", "gene")
    first, last = F.min(F.when(F.col("_from") == "f", F.col("variant_key"))).over(own), F.max(F.when(F.col("_from") == "m", F.col("variant_key"))).over(own)
    trans = ((F.col("_from") == "f") & (F.col("variant_key") < last)) | ((F.col("_from") == "m") & (F.col("variant_key") > first))
    met = F.filter(F.array(F.when(F.col("_new"), "PS2"), F.when(F.col("_shared"), "PP1"), F.when(trans & F.col("_ar"), "PM3")), lambda c: c.isNotNull())
    return rows.withColumn("_c", met).select("case_id", "variant_key", F.explode("_c").alias("criterion"))


def called_variants(calls: DataFrame, asked: Column, classes: DataFrame, pedigree: DataFrame, labels: tuple[str, ...] = (), statuses: tuple[str, ...] = ()) -> DataFrame:
    """The calls that are asked for, with their class and with what their family says of them, from one read of calls.

    case_id, family_id, variant_key, gene, total_points, criteria, acmg_class and _gene, _new, _shared, _from of trios' row.
    classes: variant_key, total_points, criteria, acmg_class. A case stands in one family.
    """
    own = _members(family.trios(calls, pedigree, labels, statuses, asked))
    return own.join(classes.select("variant_key", "total_points", "criteria", "acmg_class"), "variant_key")


def _members(table: DataFrame) -> DataFrame:
    """Of trios with asked: a row for each call asked for, with family_id, variant_key, and _gene, _new, _shared, _from of the family's row."""
    says = [F.col("gene").alias("_gene"), family.is_new().alias("_new"), family.is_shared().alias("_shared"), family.inherited_from().alias("_from")]
    return table.select("family_id", "variant_key", *says, F.explode("asked").alias("_own")).select("_own.*", "family_id", "variant_key", "_gene", "_new", "_shared", "_from")


def with_facts(variants: DataFrame, moi: DataFrame) -> DataFrame:
    """variants (see called_variants) with facts, a list: those of pedigree_facts, but on the variant's own row."""
    recessive = moi.where(is_recessive(F.col("moi"))).select(F.col("gene").alias("_gene"), F.lit(True).alias("_ar")).distinct()
    live = F.coalesce(F.col("acmg_class").isin("Pathogenic", "Likely Pathogenic", "VUS"), F.lit(False)) & F.col("family_id").isNotNull()
    own, gene = Window.partitionBy("case_id", "family_id", "_gene", "variant_key"), Window.partitionBy("case_id", "family_id", "_gene")
    rows = variants.join(recessive, "_gene", "left").withColumn("_live", F.bool_or(live).over(own))
    side = lambda who: F.when(F.col("_live") & (F.col("_from") == who), F.col("variant_key"))
    rows = rows.withColumns({"_first": F.min(side("f")).over(gene), "_last": F.max(side("m")).over(gene)})
    trans = ((F.col("_from") == "f") & (F.col("variant_key") < F.col("_last"))) | ((F.col("_from") == "m") & (F.col("variant_key") > F.col("_first")))
    met = F.array(F.when(F.col("_new"), "PS2"), F.when(F.col("_shared"), "PP1"), F.when(trans & F.col("_ar"), "PM3"))
    said = F.when(F.col("_live"), F.filter(met, lambda c: c.isNotNull())).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("facts", said).drop("_ar", "_live", "_first", "_last")


def classify_called(variants: DataFrame, moi: DataFrame, structures: DataFrame) -> DataFrame:
    """What classify_case returns for variants (see called_variants) and the facts of their families, without a look at calls for each."""
    rows = with_facts(variants.join(_families(structures), "case_id", "left"), moi)
    told = F.when(F.col("_family"), F.array_sort("facts"))
    done = _with_class(rows.withColumns({"_p": _points(told), "_c": F.array_join(told, ",")}))
    return done.drop("_family", "facts", "_gene", "_new", "_shared", "_from")


def without_ba1(variants: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """variants that BA1 doesn't rule out, and all in genes that the case's referral names. named: case_id, gene."""
    clear = ~F.coalesce("criteria", F.lit("")).contains("BA1")
    if named is None:
        return variants.where(clear)
    asked = named.select("case_id", "gene", F.lit(True).alias("_asked")).distinct()
    return variants.join(asked, ["case_id", "gene"], "left").where(clear | F.col("_asked")).drop("_asked")


def prepared_candidates(variants: DataFrame, moi: DataFrame, *, cnv: DataFrame | None = None, hi_genes: DataFrame | None = None, ts_genes: DataFrame | None = None, named: DataFrame | None = None) -> DataFrame:
    """case_id, candidate_id, kind, gene, genotype_fit, total_points, criteria, acmg_class: what doesn't change while a case is worked on.

    variants: case_id, variant_key, gene, zygosity, total_points, criteria, acmg_class, and `facts` where they have it; cnv: case_id, cnv_key, gene, svtype, cn,
    cnv_class (rows without a class are left out).
    """
    fit = genotype_fit(without_ba1(variants, named), moi)
    also = ["facts"] if "facts" in variants.columns else []
    names = ["case_id", "candidate_id", "kind", "gene", "genotype_fit", "total_points", "criteria", "acmg_class", *also]
    rows = fit.select("case_id", F.col("variant_key").alias("candidate_id"), F.lit("snv").alias("kind"), "gene", "genotype_fit", "total_points", "criteria", "acmg_class", *also)
    if cnv is None:
        return rows
    rated = cnv_genotype_fit(cnv.where(F.col("cnv_class").isNotNull()), hi_genes, ts_genes)
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    return rows.unionByName(rated.select("case_id", F.col("cnv_key").alias("candidate_id"), F.lit("cnv").alias("kind"), "gene", "genotype_fit", none("total_points"), none("criteria"), F.col("cnv_class").alias("acmg_class"), *map(none, also)).select(*names))


def ranked_cases(
    prepared: DataFrame,
    structures: DataFrame,
    *,
    facts: DataFrame | None = None,
    scores: DataFrame | None = None,
    named: DataFrame | None = None,
    judgments: DataFrame | None = None,
    n: int | None = 10,
) -> DataFrame:
    """The n best (null: all) candidates of every case with case_points and case_criteria beside candidate_table's columns.

    prepared: see prepared_candidates; facts: case_id, variant_key, criterion, unless prepared has them; scores: case_id, gene, phenotype_score; named: case_id,
    gene. The fold's class is the one that ranks; copy numbers keep theirs. Without scores all phenotypes count 0.
    """
    if facts is None and "facts" not in prepared.columns:
        facts = prepared.select("case_id", F.col("candidate_id").alias("variant_key"), F.lit("").alias("criterion")).limit(0)
    folded = classify_case(prepared.withColumnRenamed("candidate_id", "variant_key"), facts, structures, judgments)
    rows = folded.withColumn("acmg_class", F.when(F.col("kind") == "cnv", F.col("acmg_class")).otherwise(F.col("case_class"))).withColumnRenamed("variant_key", "candidate_id")
    rows = rows.withColumn("phenotype_score", F.lit(0.0)) if scores is None else rows.join(scores, ["case_id", "gene"], "left")
    ranked = rank_candidates(rows, named).select(*_CANDIDATE, "case_points", "case_criteria")
    return ranked if n is None else top_n(ranked, n)


def cnv_genes(cnv: DataFrame, hi_genes: DataFrame, ts_genes: DataFrame) -> DataFrame:
    """cnv (case_id, cnv_key, svtype, genes, ...) with gene: the first of its listed genes that is sensitive in its direction, else the first.

    The sets are tables of any size; each listed gene meets them in a join, and the best one comes back by an aggregate.
    """
    listed = F.filter(F.split(F.coalesce("genes", F.lit("")), r"[,;|\s]+"), lambda g: g != "")
    each = cnv.select("case_id", "cnv_key", F.upper("svtype").alias("_sv"), F.posexplode(listed).alias("_at", "gene"))
    both = hi_genes.select("gene", F.lit(True).alias("_loss")).distinct().join(ts_genes.select("gene", F.lit(True).alias("_gain")).distinct(), "gene", "full")
    fits = F.coalesce(F.when(F.col("_sv") == "DEL", F.col("_loss")).otherwise(F.col("_gain")), F.lit(False))
    best = each.join(both, "gene", "left").groupBy("case_id", "cnv_key").agg(F.min_by("gene", F.struct(~fits, "_at")).alias("gene"))
    return cnv.drop("gene").join(best, ["case_id", "cnv_key"], "left")


def compose_cases(
    notes: DataFrame,
    phrases: DataFrame,
    calls: DataFrame,
    classes: DataFrame,
    ped: DataFrame,
    curation: DataFrame,
    dosage: DataFrame,
    edges: DataFrame,
    *,
    cnv: DataFrame | None = None,
    pedigree: DataFrame | None = None,
    affected: tuple[tuple[str, ...], tuple[str, ...]] = ((), ()),
    judgments: DataFrame | None = None,
    n: int | None = 10,
) -> DataFrame:
    """From notes to a ranking, for all cases of notes (case_id, text) in one plan: what ranked_cases returns.

    Terms that a note observes (phrases: phrase, hpo_id) meet edges (gene, hpo_id); genes that it names in capitals keep variants
    that BA1 rules out; ped gives structures and, with pedigree or its own best rows, facts of segregation; curation (gene,
    mode_of_inheritance) gives modes, dosage (see evidence.dosage_sets) the sets for copy numbers (case_id, cnv_key, svtype, cn,
    genes, cnv_class). calls: canonical; classes: variant_key, gene, total_points, criteria, acmg_class. affected: labels and
    statuses of those who count for shared variants. Genes that many cases share are few rows on the side that is joined to them.
    """
    cases = notes.select("case_id").distinct()
    gt = F.col("gt")
    pedigree = family.pedigree_from_ped(ped) if pedigree is None else pedigree
    table = family.trios(calls, pedigree, *affected, asked=family.is_called() & carried_gt(gt), own=("case_id", zygosity(gt).alias("zygosity")))
    own = _members(table).join(cases, "case_id", "left_semi")
    variants = own.join(classes.select("variant_key", "gene", "total_points", "criteria", "acmg_class"), "variant_key").repartition("case_id")  # for all that is done by case
    modes, sets = evidence.gene_modes(curation), evidence.dosage_sets(dosage)
    hi_genes, ts_genes = sets.where("hi").select("gene"), sets.where("ts").select("gene")
    asked = notes.select(F.col("case_id").alias("note_id"), "text")
    terms = phenotype.scoped_terms(asked, phrases).where("scope = 'observed'").select(F.col("note_id").alias("case_id"), "hpo_id")
    named = text.referral_genes(asked, classes.where(F.col("gene").isNotNull())).withColumnRenamed("note_id", "case_id")
    # what the families of a case that stands in several say counts for each of its rows
    facts = F.array_distinct(F.flatten(F.collect_list("facts").over(Window.partitionBy("case_id", "variant_key"))))
    variants = with_facts(variants, modes).withColumn("facts", facts)
    structures = family.case_structure(ped).withColumnRenamed("individual_id", "case_id")
    copies = None if cnv is None else cnv_genes(cnv.join(cases, "case_id", "left_semi"), hi_genes, ts_genes)
    prepared = prepared_candidates(variants, modes, cnv=copies, hi_genes=hi_genes, ts_genes=ts_genes, named=named)
    return ranked_cases(prepared, structures, scores=phenotype_scores(edges, terms), named=named, judgments=judgments, n=n)


def prioritize_cases(variants: DataFrame, moi: DataFrame, facts: DataFrame, structures: DataFrame, *, cnv: DataFrame | None = None, hi_genes: DataFrame | None = None, ts_genes: DataFrame | None = None, scores: DataFrame | None = None, named: DataFrame | None = None, judgments: DataFrame | None = None, n: int = 10) -> DataFrame:
    """The n best candidates of every case at once, single variants and copy numbers in one ranking, as candidate_table returns them."""
    prepared = prepared_candidates(variants, moi, cnv=cnv, hi_genes=hi_genes, ts_genes=ts_genes, named=named)
    return ranked_cases(prepared, structures, facts=facts, scores=scores, named=named, judgments=judgments, n=n).select(*_CANDIDATE)
