"""Operators whose rules are easier to see in small cases than in the queries' SQL twins."""

import json

import pytest
from pyspark.sql import functions as F

from varloom.functions import expr
from varloom.operators import annotate, case, evidence, kernel, phenotype, session, text, validation
from varloom.sources import readers, sinks


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.select(*names).collect())


def test_scopes_of_clauses(spark):
    notes = [(1, "No fever, has seizures"), (2, "Ataxia ruled out although tremor"), (3, "grandmother had seizures. fever resolved"), (4, "fh of tremor; seizures denied"), (5, None)]
    found = text.extract_terms(spark.createDataFrame(notes, "note_id long, text string"), {w: w for w in ("fever", "seizures", "ataxia", "tremor")})
    assert rows(found, "note_id", "term", "scope") == [
        (1, "fever", "excluded"), (1, "seizures", "observed"), (2, "ataxia", "excluded"), (2, "tremor", "observed"), (3, "fever", "excluded"), (3, "seizures", "family"),
        (4, "seizures", "excluded"), (4, "tremor", "family"),
    ]


def test_referral_genes_are_whole_words(spark):
    notes = spark.createDataFrame([(1, "test SCN5A, not xSCN5A2 or ABCDEFGHIJKL"), (2, "xSCN5A SCN5Ax")], "note_id long, text string")
    assert rows(text.referral_genes(notes, spark.createDataFrame([("SCN5A",), ("ABCDEFGHIJKL",)], "gene string")), "note_id", "gene") == [(1, "SCN5A")]


def test_stars_and_zygosity(spark):
    said = {"practice guideline": 4, "criteria provided, multiple submitters, conflicting": 1, "criteria provided, multiple submitters, no problem": 2, "no assertion criteria provided": 1, "none": 0}
    df = spark.createDataFrame([(x,) for x in said], "s string")
    assert dict(rows(df.select("s", expr.review_stars(F.col("s")).alias("n")), "s", "n")) == said
    gts = {"2/2": "hom", "1|1": "hom", "0/0": "het", "1/2": "het", "./.": "het", "1": "het"}
    df = spark.createDataFrame([(x,) for x in gts], "s string")
    assert dict(rows(df.select("s", expr.zygosity(F.col("s")).alias("z")), "s", "z")) == gts


def test_protein_changes_and_transcripts(spark):
    named = [("k1", "G", "Pathogenic", "reviewed by expert panel", "NM(G):c.1 (p.Arg10Sec)"), ("k2", "G", "Conflicting classifications of pathogenicity", "criteria provided", "p.Ala7Val"), ("k3", "G", "Benign", "criteria provided", "p.Ala7Val")]
    df = spark.createDataFrame(named, "variant_key string, gene string, clnsig string, review_status string, name string")
    assert rows(evidence.protein_changes(df), "variant_key", "protein_pos", "ref_aa", "alt_aa") == [("k1", 10, "R", "U")]
    gate = df.withColumn("composition", F.when(F.col("variant_key") == "k2", "Pathogenic(2)|Uncertain(1)"))
    assert [r[0] for r in rows(evidence.protein_changes(df, gate=gate), "variant_key")] == ["k1", "k2"]
    assert rows(evidence.codon_counts(df), "protein_pos", "n_plp", "n_blb") == [(7, 0, 1), (10, 1, 0)]
    exons = [("G", "A", False, False, False, True), ("G", "B", False, False, False, False), ("G", "B", False, False, False, False), ("H", "C", False, True, False, False), ("H", "D", True, False, False, False)]
    df = spark.createDataFrame(exons, "gene string, transcript_id string, mane_select boolean, mane_plus_clinical boolean, appris_principal boolean, basic boolean")
    assert rows(evidence.select_transcript(df), "gene", "transcript_id") == [("G", "A"), ("H", "D")]


def test_exceptions_are_common_reviewed_snvs(spark):
    data = [("a", "A", "G", "X:1", "Pathogenic", "reviewed by expert panel", "0.02"), ("b", "AT", "G", "X:1", "Pathogenic", "reviewed by expert panel", "0.02"),
            ("c", "A", "G", "X:1", "Pathogenic", "criteria provided, single submitter", "0.02"), ("d", "A", "G", "X:1", "Pathogenic", "practice guideline", "0.01")]
    df = spark.createDataFrame(data, "variant_key string, ref string, alt string, gene string, clnsig string, review_status string, af_esp string").withColumns({"af_exac": F.lit(None).cast("string"), "af_tgp": F.lit(None).cast("string")})
    assert rows(evidence.ba1_exceptions(df), "variant_key", "gene") == [("a", "X")]


def test_overrides_raise_on_unknown_columns(spark):
    default = spark.createDataFrame([("g", 0.05)], "gene string, ba1_maf double")
    assert rows(kernel.override("acmg_thresholds", spark.createDataFrame([("h",)], "gene string"), default), "gene", "ba1_maf") == [("h", None)]
    with pytest.raises(ValueError, match="wrong"):
        kernel.override("acmg_thresholds", spark.createDataFrame([("h", 1)], "gene string, wrong int"), default)


CASES = "case_id string, variant_key string, gene string, zygosity string, total_points int, criteria string, acmg_class string"


def test_gated_facts(spark):
    variants = spark.createDataFrame([("c", "v1", "G", "het", 5, "PM2", "VUS"), ("c", "v2", "G", "het", 2, "BA1", "Benign"), ("s", "v1", "G", "het", 5, "PM2", "VUS")], CASES)
    none = spark.createDataFrame([], "case_id string, variant_key string, criterion string")
    structures = spark.createDataFrame([("c", "trio"), ("s", "singleton")], "case_id string, structure string")
    told = [("c", "v1", "PP4", None, "d1"), ("c", "v2", "PS3", 4.0, "d1"), ("s", "v1", "PM3", 2.0, "d1"), ("s", "v1", "PS3", 4.0, "d2"), ("s", "v1", "PP4", 1.0, "d3")]
    told = spark.createDataFrame(told, "case_id string, variant_key string, criterion string, points double, digest string")
    ledger = spark.createDataFrame([("d1", "proposal", 1.0), ("d1", "approval", 2.0), ("d2", "approval", 1.0), ("d2", "rejection", 2.0), ("d3", "approval", 3.0)], "digest string, event string, ts double")
    done = case.classify_case(variants, none, structures, case.approved_facts(told, ledger))
    assert rows(done, "case_id", "variant_key", "case_points", "case_criteria", "case_class") == [
        ("c", "v1", 1.0, "PP4", "Likely Pathogenic"), ("c", "v2", 4.0, "PS3", "Benign"), ("s", "v1", 1.0, "PP4", "Likely Pathogenic"),
    ]


def test_session_and_review(spark, tmp_path):
    variants = spark.createDataFrame([("c", "v1", "G", "het", 5, "PM2", "VUS"), ("c", "v2", "H", "het", 5, "PM2", "VUS")], CASES)
    moi = spark.createDataFrame([("G", "AD"), ("H", "AD")], "gene string, moi string")
    edges = spark.createDataFrame([("H", "HP:1"), ("G", "HP:2"), ("X", "HP:2")], "gene string, hpo_id string")
    one = session.CaseSession(spark, "c", case.prepared_candidates(variants, moi), edges, log=str(tmp_path / "log"))
    assert [r.candidate_id for r in one.top().collect()] == ["v1", "v2"]
    assert one.refine_hpo(add=["HP:1"]).first().candidate_id == "v2"
    with pytest.raises(ValueError, match="pedigree"):
        one.propose_fact("v1", "PS2", 4)
    before = one.state()
    key = one.propose_fact("v1", "PS3", 4)
    assert one.state() == before and one.top().first().acmg_class == "VUS"
    done = one.approve_fact(key, "reviewer").where("candidate_id = 'v1'").first()
    assert (done.acmg_class, done.case_points, done.case_criteria) == ("Likely Pathogenic", 4.0, "PS3")
    assert one.state() != before and one.sql("SELECT count(*) FROM case_candidates").first()[0] == 2
    asked = []

    def model(prompt):
        asked.append(prompt)
        return 'so: {"add_phrases": ["tremor"], "pp4": [{"candidate_id": "v2", "criterion": "PP4"}, {"candidate_id": "no", "criterion": "PP4"}, {"candidate_id": "v1", "criterion": "PS4"}]}' if len(asked) == 1 else "none"

    session.agent_review(one, "tremor", model, spark.createDataFrame([("tremor", "HP:2")], "phrase string, hpo_id string"))
    assert len(asked) == 2 and rows(session.terms_of(one.events), "hpo_id") == [("HP:1",), ("HP:2",)]
    assert {r.candidate_id: r.acmg_class for r in one.top().collect()} == {"v1": "Likely Pathogenic", "v2": "Likely Pathogenic"}
    log = spark.read.json(str(tmp_path / "log")).orderBy("seq").collect()
    assert log[-1].state == one.state() != log[0].state
    # the log alone brings the ranking back
    again = session.ranked_sessions(spark.read.schema(session.EVENT).json(str(tmp_path / "log")), one.prepared, edges, one.structures)
    assert rows(again, "candidate_id", "acmg_class", "rank") == rows(one.candidates, "candidate_id", "acmg_class", "rank")
    assert [r.action for r in log] == ["open", "refine_hpo", "propose_fact", "approve_fact", "sql", "refine_hpo", "propose_fact", "approve_fact"]


def test_session_terms_and_facts_follow_their_last_word(spark):
    said = [
        ("s", 0, "open", {"add": ["A", "B"]}), ("s", 1, "refine_hpo", {"add": ["C", "D"], "remove": ["A", "D"]}), ("s", 2, "refine_hpo", {"add": ["A"]}),
        ("s", 3, "propose_fact", {"digest": "d", "variant_key": "v", "criterion": "PS3", "points": 4.0}), ("s", 4, "approve_fact", {"digest": "d"}), ("s", 5, "approve_fact", {"digest": "unknown"}),
        ("t", 0, "open", {}), ("t", 1, "approve_fact", {"digest": "e"}), ("t", 2, "propose_fact", {"digest": "e", "variant_key": "v", "criterion": "PS3", "points": 4.0}),
    ]
    events = spark.createDataFrame([(s, i, "c" + s, a, json.dumps(d)) for s, i, a, d in said], session.EVENT)
    assert rows(session.terms_of(events), "session_id", "hpo_id") == [("s", "A"), ("s", "B"), ("s", "C")]
    assert rows(session.facts_of(events), "session_id", "digest", "approved") == [("s", "d", True), ("t", "e", False)]
    assert len({r.state for r in session.states(events).collect()}) == 2


PHRASES = [("seizures", "HP:1"), ("fits", "HP:1"), ("ataxia", "HP:2"), ("short  stature", "HP:3"), ("short", "HP:4"), ("(Type-2) rash!", "HP:5"), ("?", "HP:6"), (None, "HP:7")]


def test_phenotype_modes(spark):
    phrases = spark.createDataFrame(PHRASES, "phrase string, hpo_id string")
    note = spark.createDataFrame([("n", "Seizures, no ataxia")], "note_id string, text string")
    reply = '```json\n{"decisions": [{"candidate_id": "n:0000", "decision": "keep", "patient_context": "patient"}, {"candidate_id": "n:0001", "decision": "drop", "patient_context": "negated"}, {"hpo_id": "HP:1", "decision": "drop", "patient_context": "negated"}]}\n```'
    terms = lambda df: rows(df, "note_id", "hpo_id", "scope")
    want = [("n", "HP:1", "observed"), ("n", "HP:2", "excluded")]
    assert terms(phenotype.extract(note, phrases, mode="candidates_model", model=lambda p: reply)) == want
    offered = phenotype.candidates(note, phrases)
    assert terms(phenotype.decided_terms(offered, phenotype.decisions(spark.createDataFrame([("n", reply)], "note_id string, reply string")))) == want
    assert terms(phenotype.extract(note, phrases, mode="tool_only")) == want

    def model(prompt):
        return '{"phrases": ["fits", "made up", " "]}' if prompt.startswith(phenotype.ASK_PHRASES) else {"text": '{"decisions": [{"candidate_id": "n:aug0000", "decision": "keep", "patient_context": "patient"}]}'}

    spells = spark.createDataFrame([("n", "spells"), ("m", None)], "note_id string, text string")
    assert terms(phenotype.extract(spells, phrases, mode="model_only", model=model)) == [("n", "HP:1", "observed")]
    runs = {r.note_id: r for r in phenotype.extraction_runs(spells, phrases, model=model).collect()}
    assert set(runs) == {"n", "m"} and runs["n"].note_len == 6 and [c.candidate_id for c in runs["n"].candidates] == ["n:aug0000"]
    assert terms(phenotype.extract(spells, phrases, mode="candidates_model", model=lambda p: "no JSON")) == []
    with pytest.raises(ValueError, match="mode"):
        phenotype.extract(note, phrases, mode="other")
    with pytest.raises(ValueError, match="needs a model"):
        phenotype.extract(note, phrases)


def test_what_meets_the_dictionary_is_mentions_not_first_words(spark):
    phrases = spark.createDataFrame([(f"the w{i}", f"HP:{i}") for i in range(100, 300)], "phrase string, hpo_id string")
    notes = spark.createDataFrame([(0, " ".join(f"The w{i}" for i in range(200))), (1, "the the. w100"), (2, None)], "note_id int, text string")
    assert rows(phenotype.mentions(notes, phrases), "note_id", "at", "hpo_id", "span") == [(0, 4 * i, f"HP:{i}", f"The w{i}") for i in range(100, 200)]
    assert phenotype._occurrences(notes, phenotype.phrase_index(phrases)).count() < 110


def test_decisions_of_a_note_without_a_name_find_its_candidates(spark):
    offered = spark.createDataFrame([(None, ":0000", "HP:1"), (1, "1:0000", "HP:2")], "note_id long, candidate_id string, hpo_id string")
    made = offered.select("note_id", "candidate_id", F.lit("").alias("hpo_id"), F.lit("keep").alias("decision"), F.lit("patient").alias("patient_context"), F.lit(0).alias("place"))
    assert {(r.note_id, r.hpo_id, r.scope) for r in phenotype.decided_terms(offered, made).collect()} == {(None, "HP:1", "observed"), (1, "HP:2", "observed")}


def test_mentions_have_their_own_places(spark):
    phrases = spark.createDataFrame(PHRASES, "phrase string, hpo_id string")
    texts = [("n", "Fits and SEIZURES; fits again"), ("m", None), ("o", "short  stature, short stature, xshort, a type-2) RASH"), ("o", ""), ("p", "fits_ fits2 seizuresé")]
    notes = spark.createDataFrame(texts, "note_id string, text string")
    assert rows(phenotype.mentions(notes, phrases), "note_id", "at", "hpo_id", "span") == [
        ("n", 0, "HP:1", "Fits"), ("n", 4, "HP:1", "SEIZURES"), ("n", 6, "HP:1", "fits"), ("o", 0, "HP:3", "short  stature"), ("o", 0, "HP:4", "short"), ("o", 4, "HP:4", "short"), ("o", 12, "HP:5", "type-2) RASH"), ("p", 4, "HP:1", "seizures"),
    ]
    assert rows(phenotype.candidates(notes, phrases), "candidate_id", "span", "hpo_id")[:2] == [("n:0000", "Fits", "HP:1"), ("n:0001", "SEIZURES", "HP:1")]
    assert phenotype.mentions(notes, phrases.limit(0)).count() == 0 and phenotype.candidates(notes.limit(0), phrases).count() == 0


def test_feeds(spark, tmp_path):
    head = "Assembly\tChromosome\tPositionVCF\tReferenceAlleleVCF\tAlternateAlleleVCF\tGeneSymbol\tName\tClinicalSignificance\tReviewStatus\tNumberSubmitters\n"
    (tmp_path / "s.txt").write_text(head + 'GRCh37\tchr1\t5\tA\tG\tX\t"p.Arg1Gly\tPathogenic\tcriteria provided\t2\nGRCh38\t1\t6\tA\tG\tX\tn\tBenign\tnone\t1\n')
    assert rows(readers.read_variant_summary(spark, str(tmp_path / "s.txt")), "variant_key", "name", "submitters") == [("1-5-A-G", '"p.Arg1Gly', 2)]
    (tmp_path / "c.vcf").write_text("##x\n#CHROM\n1\t5\t.\tA\tG,T\t.\t.\tCLNSIG=Pathogenic;GENEINFO=X:1;AF_ESP=0.02\n")
    assert rows(readers.read_assertion_vcf(spark, str(tmp_path / "c.vcf")), "variant_key", "gene", "af_esp", "n_alts") == [("1-5-A-G", "X", 0.02, 2), ("1-5-A-T", "X", 0.02, 2)]
    (tmp_path / "g.txt").write_text("gene\tother\tmis_z\toe_lof_upper\tpLI\nA\tx\t3.1\tNA\t1\n")
    assert rows(readers.read_constraint(spark, str(tmp_path / "g.txt")), "gene", "mis_z", "loeuf") == [("A", 3.1, None)]
    (tmp_path / "o.txt").write_text("VariantID\tTotal score\nv\t0.95\n")
    assert rows(readers.read_scoresheet(spark, str(tmp_path / "o.txt")), "VariantID", "total_score") == [("v", 0.95)]
    (tmp_path / "v.tsv").write_text("## x\n#Uploaded\n1_5_A/G\t1:5\tX\tstop_gained\tR/*\t12\tT1\t0.1&0.2\t-\tAFR\t-\n1_6_A/C\t1:6\t-\tmissense_variant\n")
    done = text.vep_rows(readers.read_annotator_tab(spark, str(tmp_path / "v.tsv")))
    assert rows(done, "variant_key", "gene", "alt_aa", "protein_pos", "filtering_af", "nmd_escaping") == [("1-5-A-G", "X", "*", 12, 0.1, 0), ("1-6-A-C", None, None, None, None, None)]
    (tmp_path / "n.csv").write_text("CHROM,POS,INFO_END,variant_kind\nchr2,10,20,cnv\n2,1,2,snv\n")
    assert rows(readers.read_cnvs(spark, str(tmp_path / "n.csv")), "chrom", "start_pos", "end_pos", "cn") == [("2", 10, 20, None)]
    picked = spark.sql("SELECT array(named_struct('id', 'a', 'mane_select', '', 'canonical', 0), named_struct('id', 'b', 'mane_select', '', 'canonical', 1)) AS t").select(readers.pick_transcript(F.col("t"))["id"])
    assert picked.first()[0] == "b"
    sinks.write_top(spark.createDataFrame([("c", 1, "x"), ("c", 2, "y"), ("d", 1, "z")], "case_id string, rank int, candidate_id string"), str(tmp_path / "top"), 1)
    assert rows(spark.read.csv(str(tmp_path / "top"), header=True), "case_id", "candidate_id") == [("c", "x"), ("d", "z")]


def test_ranked_rows_come_in_order(spark):
    from varloom.plans import registry

    found = [(r.total_points, r.variant_key) for r in registry.queries()["kernel_ranked"](spark, "/root/testdata/sf0.001").collect()]
    assert len(found) > 100 and [p for p, _ in found] == sorted((p for p, _ in found), reverse=True)


def test_lists_of_consequences(spark):
    terms = {"stop_gained,splice_region_variant": "stop_gained", "intron_variant, missense_variant&NMD_transcript_variant": "missense", "splice_region_variant&stop_gained": "stop_gained", "unknown,other": None, "": None}
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    assert dict((r.t, r.c) for r in df.select("t", expr.most_severe(F.col("t")).alias("c")).collect()) == terms


def test_dosage_sets_hold_genes_of_the_feed_alone(spark):
    feed = [("A", "Sufficient evidence for dosage pathogenicity", None), ("B", "Gene associated with autosomal recessive phenotype", " Sufficient Evidence"), ("C", None, "No evidence"), (None, "Sufficient evidence", None), ("A", None, None)]
    df = spark.createDataFrame(feed, "gene string, haploinsufficiency string, triplosensitivity string")
    assert rows(evidence.dosage_sets(df), "gene", "hi", "ts") == [("A", True, False), ("B", False, True), ("C", False, False)]
    cnv = spark.createDataFrame([("c", "k1", "DEL", "C; B|A"), ("c", "k2", "DUP", "C; B|A"), ("c", "k3", "DUP", "C,A"), ("c", "k4", "DEL", "")], "case_id string, cnv_key string, svtype string, genes string")
    sets = evidence.dosage_sets(df)
    done = case.cnv_genes(cnv, sets.where("hi").select("gene"), sets.where("ts").select("gene"))
    assert {r.cnv_key: r.gene for r in done.collect()} == {"k1": "A", "k2": "B", "k3": "C", "k4": None}


def test_truth_and_correlations(spark):
    names = "variant_key string, ref string, alt string, n_alts int, gene string, clnsig string, review_status string, mc string, hgvs string, af_esp string, af_exac string, af_tgp string"
    said = [("k1", "A", "G", 1, "X:1", "Likely_pathogenic", "reviewed_by_expert_panel", "SO:1|odd,SO:2|nonsense", "NM:p.Arg10Ter", "0.1", None, "x"), ("k2", "A", "G", 2, "X", "Benign", "reviewed_by_expert_panel", "SO:1|missense_variant", None, None, None, None),
            ("k3", "A", "G", 1, "X", "Likely benign", "reviewed by expert panel", "SO:1|missense_variant", None, None, "0.2", None), ("k4", "A", "G", 1, "X", "Benign", "practice guideline", "SO:1|missense_variant", None, None, None, None), ("k5", "A", "G", 1, "X", "drug response", "reviewed by expert panel", "SO:1|missense_variant", None, None, None, None)]
    done = validation.truth_set(spark.createDataFrame(said, names))
    assert [(r.variant_key, r.consequence, r.protein_pos, r.alt_aa, r.filtering_af, r.truth) for r in done.orderBy("variant_key").collect()] == [("k1", "stop_gained", 10, "*", 0.1, "P/LP"), ("k3", "missense", None, None, 0.2, "B/LB")]
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": rng.integers(-8, 12, 500).astype(float), "y": rng.normal(size=500) ** 3})
    pdf["y"] += pdf["x"] / 10
    pdf.loc[::7, "y"] = None
    row = validation.correlations(spark.createDataFrame(pdf).replace(float("nan"), None), "x", "y").first()
    left = pdf.dropna()
    assert row.n == len(left) and row.pearson == pytest.approx(left["x"].corr(left["y"])) and row.spearman == pytest.approx(left["x"].rank().corr(left["y"].rank()))
    few = validation.correlations(spark.createDataFrame(left.head(19)), "x", "y").first()
    assert (few.n, few.pearson, few.spearman) == (19, None, None)


def test_site_scores_fill_gaps(spark):
    own = spark.createDataFrame([("1-5-A-G", 0.5, None), ("2-6-C-T", None, 0.1)], "variant_key string, revel double, spliceai double")
    sites = spark.createDataFrame([("chr1", 5, "A", "G", 0.9, 0.01), ("2", 6, "C", "T", 0.7, None)], "chrom string, pos long, ref string, alt string, revel double, filtering_af double")
    assert rows(annotate.fill_site_scores(own, sites), "variant_key", "revel", "spliceai", "filtering_af") == [("1-5-A-G", 0.5, None, 0.01), ("2-6-C-T", 0.7, 0.1, None)]
    loci = spark.createDataFrame([("10", 1, "A", "G", "10-1-A-G"), ("2", 9, "A", "G", "2-9-A-G"), ("X", 1, "A", "G", "X-1-A-G")], "chrom string, pos long, ref string, alt string, variant_key string")
    done = annotate.assemble_site_scores(loci, {"af": spark.createDataFrame([("X-1-A-G", 0.2)], "variant_key string, af double"), "cadd": None})
    assert [(r.chrom, r.af, r.cadd) for r in done.collect()] == [("2", None, None), ("10", None, None), ("X", 0.2, None)]
