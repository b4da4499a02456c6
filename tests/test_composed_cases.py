"""Cases composed from one read of calls, against the operators that take calls, variants and facts apart."""

from pyspark.sql import functions as F

from varloom.functions.expr import zygosity
from varloom.operators import case, evidence, family, phenotype, text
from varloom.plans import registry


def test_cases_are_composed_from_one_read_of_calls(spark):
    plan = registry.queries()["composed_cases"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert sum("l_returnflag" in leaf.toString() for leaf in [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]) == 1


def test_composed_cases_are_those_of_the_parts(spark):
    """Also with judgments, bad calls, two classes of a variant, a case in two families and a family without a name."""
    rows = []
    for f, name in enumerate(["F0", "F1", None]):
        child, mother, father = (f"C{f}{m}" for m in "cmf")
        who = {child: ("child", "proband"), mother: ("mother", "relative"), father: ("affected_father", "relative")}
        calls = {
            "v1": {child: "0/1", mother: "0/0", father: "0/0"}, "v2": {child: "0/1", mother: "0/0", father: "0/1"}, "v3": {child: "0/1", mother: "0/1", father: "0/0"},
            "v4": {child: "1/1", mother: "0/1", father: "1/1"}, "v5": {child: "1/1", father: "./."}, "v6": {mother: "0/1"}, "v7": {child: "0/0", father: "1/1"},
        }
        rows += [(c, name, *who[c], 3, k, "G1" if k < "v4" else "G2", gt, 30, 5 if k == "v5" else 20) for k, by in calls.items() for c, gt in by.items()]
    rows.append(("C0c", "F9", "child", "proband", 1, "v1", "G1", "0/1", 30, 20))
    calls = spark.createDataFrame(rows, "case_id string, family_id string, relationship string, proband_status string, family_size int, variant_key string, gene string, gt string, gq int, dp int")
    classes = spark.createDataFrame(
        [("v1", "G1", 1, None, "VUS"), ("v2", "G1", 7, "PS1", "Likely Pathogenic"), ("v2", "G1", -7, "BA1", "Benign"), ("v3", "G1", 0, "", "VUS"), ("v4", "G2", 10, "PVS1", "Pathogenic"), ("v5", "G2", None, None, None), ("v6", "G3", 2, "BA1", "Benign"), ("v7", "G2", 0, None, "VUS")],
        "variant_key string, gene string, total_points int, criteria string, acmg_class string",
    )
    notes = spark.createDataFrame([("C0c", "fits, G1 asked"), ("C0m", "no fits"), ("C1c", "Ataxia and fits"), ("C1f", None), ("C2c", "ataxia"), ("none", "fits")], "case_id string, text string")
    phrases = spark.createDataFrame([("fits", "HP:1"), ("ataxia", "HP:2")], "phrase string, hpo_id string")
    ped = spark.createDataFrame([(f"F{i}", f"C{i}{m}", f"C{i}f" if m == "c" else None, f"C{i}m" if m == "c" else None, 2) for i in (0, 1) for m in "cmf"], "family_id string, individual_id string, father_id string, mother_id string, affected int")
    curation = spark.createDataFrame([("G1", "AR"), ("G2", "AD")], "gene string, mode_of_inheritance string")
    dosage = spark.createDataFrame([("G2", "sufficient evidence", None)], "gene string, haploinsufficiency string, triplosensitivity string")
    edges = spark.createDataFrame([("G1", "HP:1"), ("G2", "HP:1"), ("G2", "HP:2"), ("G4", "HP:3")], "gene string, hpo_id string")
    cnv = spark.createDataFrame([("C0c", "d1", "DEL", 1, "G9;G2", "VUS"), ("C1c", "d2", "DUP", 3, "", None), ("C8", "d3", "DEL", 0, "G1", "VUS")], "case_id string, cnv_key string, svtype string, cn int, genes string, cnv_class string")
    judgments = spark.createDataFrame([("C0c", "v1", "PP4", None), ("C0c", "v1", "PS2", 1.0), ("C2c", "v3", "PM3", None), ("C2c", "v3", "PS3", 3.0), ("C0c", "v2", "PP4", 0.0)], "case_id string, variant_key string, criterion string, points double")
    affected = (("affected_father",), ("proband",))
    text_of = lambda df: sorted(str(tuple(r)) for r in df.select(sorted(df.columns)).collect())

    pedigree, modes, sets = family.pedigree_from_labels(calls), evidence.gene_modes(curation), evidence.dosage_sets(dosage)
    asked = notes.select(F.col("case_id").alias("note_id"), "text")
    own = family.carried(calls).join(notes.select("case_id").distinct(), "case_id", "left_semi").select("case_id", "family_id", "variant_key", zygosity(F.col("gt")).alias("zygosity"))
    variants = own.join(classes, "variant_key")
    facts = case.pedigree_facts(variants, family.trios(calls, pedigree, *affected), modes)
    named = text.referral_genes(asked, classes).withColumnRenamed("note_id", "case_id")
    terms = phenotype.scoped_terms(asked, phrases).where("scope = 'observed'").select(F.col("note_id").alias("case_id"), "hpo_id")
    copies = case.cnv_genes(cnv.join(notes.select("case_id").distinct(), "case_id", "left_semi"), sets.where("hi").select("gene"), sets.where("ts").select("gene"))
    prepared = case.prepared_candidates(variants, modes, cnv=copies, hi_genes=sets.where("hi").select("gene"), ts_genes=sets.where("ts").select("gene"), named=named)
    structures = family.case_structure(ped).withColumnRenamed("individual_id", "case_id")
    for judged in (None, judgments):
        parts = case.ranked_cases(prepared, structures, facts=facts, scores=case.phenotype_scores(edges, terms), named=named, judgments=judged, n=None)
        done = case.compose_cases(notes, phrases, calls, classes, ped, curation, dosage, edges, cnv=cnv, pedigree=pedigree, affected=affected, judgments=judged, n=None)
        ours = text_of(done.drop("rank"))  # equal scores and keys, as of a variant's two classes, have no order
        assert ours == text_of(parts.drop("rank")) and len(ours) > 9
        assert {"PS2", "PM3", "PP1"} <= {c for r in done.collect() for c in r.case_criteria.split(",")} and ("PP4" in str(ours)) == (judged is not None)
