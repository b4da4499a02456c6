import pytest
from pyspark.sql import functions as F

from varloom.operators import ledger
from varloom.sources import readers, sinks

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tPROB\tMOM\tDAD
chr1\t100\t.\tA\tG\t.\tPASS\tAC=1;DB\tGT:GQ:DP:PS\t0/1:40:30:.\t0/0:50:20:.\t0/0:50:22:.
1\t200\t.\tC\tT\t.\tPASS\tAC=2\tGT:DP\t0/1:30\t0/1:28\t./.:.
2\t300\t.\tG\tGA,T\t.\tPASS\t.\tGT:GQ:DP\t0/1:40\t0/0:50:20\t0/1:50:22
"""


@pytest.mark.parametrize("name, fmt", [("a.vcf.gz", "vcf"), ("a.VCF", "vcf"), ("x.parquet", "parquet"), ("x.tsv", "tsv"), ("x.csv", "csv"), ("x.xlsx", "excel")])
def test_formats(name, fmt):
    assert readers.detect_format(name) == fmt


def test_unknown_format():
    with pytest.raises(ValueError, match="unknown format"):
        readers.detect_format("calls.doc")


def test_vcf_is_unpivoted(spark, tmp_path):
    (tmp_path / "trio.vcf").write_text(VCF)
    df = readers.read_source(spark, str(tmp_path / "trio.vcf"))
    rows = {(r.case_id, r.chrom, r.pos): r for r in df.collect()}
    assert len(rows) == 9
    first = rows["PROB", "1", 100]
    assert (first.gt, first.gq, first.dp, first.phase_set) == ("0/1", 40, 30, None)
    assert rows["PROB", "1", 200].gq is None and rows["PROB", "1", 200].dp == 30
    assert rows["DAD", "1", 200].dp is None
    assert rows["PROB", "2", 300].dp is None  # trailing fields may be left out
    calls = readers.canonical_calls(df, snv_only=False)
    assert {r.variant_kind for r in calls.where("pos = 300").collect()} == {"indel"}
    assert readers.canonical_calls(df).count() == 6


def test_vcf_without_samples(spark, tmp_path):
    (tmp_path / "none.vcf").write_text("##fileformat=VCFv4.2\n#CHROM\tPOS\n")
    with pytest.raises(ValueError, match="no samples"):
        readers.read_vcf(spark, str(tmp_path / "none.vcf"))


def test_tsv_with_names_of_its_own(spark, tmp_path):
    (tmp_path / "tidy.tsv").write_text("sample_id\tchr\tposition\tref_allele\talt_allele\tgenotype\tgeno_qual\nP\tchr1\t100\tA\tG\t0/1\t40\nM\t1\tx\tA\tG\t0/0\tbad\n")
    names = {"case_id": "sample_id", "chrom": "chr", "pos": "position", "ref": "ref_allele", "alt": "alt_allele", "gt": "genotype", "gq": "geno_qual"}
    calls = {r.case_id: r for r in readers.canonical_calls(readers.read_source(spark, str(tmp_path / "tidy.tsv")), names).collect()}
    assert (calls["P"].chrom, calls["P"].pos, calls["P"].gq, calls["P"].dp) == ("1", 100, 40, None)
    assert calls["M"].pos is None and calls["M"].gq is None
    with pytest.raises(ValueError, match="required columns"):
        readers.canonical_calls(readers.read_source(spark, str(tmp_path / "tidy.tsv")))


def test_pedigree(spark, tmp_path):
    (tmp_path / "trio.ped").write_text("FAM PROB DAD MOM 1 2\nFAM\tMOM\t0\t0\t2\t1\n\nFAM DAD 0 0 1 1\n")
    rows = {r.individual_id: r for r in readers.read_ped(spark, str(tmp_path / "trio.ped")).collect()}
    assert (rows["PROB"].father_id, rows["PROB"].mother_id, rows["PROB"].affected) == ("DAD", "MOM", 2)
    assert rows["MOM"].father_id is None and len(rows) == 3


def test_exons(spark, tmp_path):
    line = 'chr7\tx\t{}\t10\t90\t.\t-\t.\tgene_id "g"; transcript_id "T1.4"; gene_name "ABC"; exon_number 3; tag "basic"; tag "MANE_Select";'
    (tmp_path / "m.gtf").write_text("#!genome\n" + line.format("exon") + "\n" + line.format("gene") + "\n")
    assert [tuple(r) for r in readers.read_exons(spark, str(tmp_path / "m.gtf")).collect()] == [("T1", "ABC", 3, "7", 10, 90, "-", True, False, True, False)]


def test_curation_feed(spark, tmp_path):
    text = '"FEED"\n"a"\n"b"\n"c"\n"GENE SYMBOL","MOI","CLASSIFICATION"\n"+++++","++++","+++"\n"TP53","AD","Definitive"\n"X, Y","AR","Limited"\n'
    (tmp_path / "gv.csv").write_text(text)
    rows = readers.read_curation_csv(spark, str(tmp_path / "gv.csv")).collect()
    assert [tuple(r) for r in rows] == [("TP53", "AD", "Definitive"), ("X, Y", "AR", "Limited")]


def test_sorted_vcf_and_bed(spark, tmp_path):
    loci = spark.createDataFrame([("X", 5, "A", "T"), ("10", 1, "C", "G"), ("2", 9, "A", "C"), ("2", 3, "G", "T")], "chrom string, pos long, ref string, alt string")
    sinks.write_vcf(loci, str(tmp_path / "v"))
    lines = [x for p in sorted((tmp_path / "v").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines[0].startswith("##fileformat") and lines[1].startswith("#CHROM")
    assert [tuple(x.split("\t")[:2]) for x in lines[2:]] == [("2", "3"), ("2", "9"), ("10", "1"), ("X", "5")]
    cnvs = spark.createDataFrame([("1", 1, 9, "DEL", 1), ("1", 20, 30, None, 3), ("1", 40, 50, None, 2)], "chrom string, start_pos long, end_pos long, svtype string, cn int")
    sinks.write_bed(cnvs, str(tmp_path / "b"))
    assert sorted(x for p in (tmp_path / "b").glob("part-*") for x in p.read_text().splitlines()) == ["1\t1\t9\tDEL", "1\t20\t30\tDUP"]


def test_ledger_counts_only_what_was_approved(spark, tmp_path):
    book = ledger.Ledger(str(tmp_path / "l" / "events"))
    contexts = spark.createDataFrame([('{"case": "C1"}',), ('{"case": "C2"}',)], "context string")
    made = ledger.propose(contexts, lambda prompt: "PP4", kind="phenotype", name="m").withColumn("points", F.lit(1.0))
    counted = lambda df=made: {r.context[-4:-2]: r.counted for r in ledger.approved_points(df, book.records(spark)).collect()}
    assert counted() == {"C1": 0.0, "C2": 0.0}  # before the first event
    assert {r.status for r in ledger.statuses(made, book.records(spark)).collect()} == {"absent"}
    book.append(ledger.proposed(made))
    assert counted() == {"C1": 0.0, "C2": 0.0}
    first = made.where("context like '%C1%'")
    book.append(ledger.decided(first, "reviewer"))
    assert counted() == {"C1": 1.0, "C2": 0.0}
    other = made.withColumn("response", F.lit("other"))
    assert counted(other) == {"C1": 0.0, "C2": 0.0}
    with pytest.raises(Exception, match="changed"):
        ledger.decided(other, "reviewer").collect()
    with pytest.raises(ValueError, match="approver"):
        ledger.decided(made, "")
    book.append(ledger.decided(first, "reviewer", approve=False, reason="no"))
    assert counted() == {"C1": 0.0, "C2": 0.0}
    events = book.records(spark).orderBy("ts", "event").collect()
    assert [r.event for r in events] == ["proposal", "proposal", "approval", "rejection"] and all(r.digest.startswith("sha256:") for r in events) and events[0].response == "PP4"


def test_digests_follow_content():
    import datetime

    assert ledger.digest({"b": 1, "a": datetime.date(2020, 1, 2)}) == ledger.digest({"a": "2020-01-02", "b": 1}) != ledger.digest({"a": 1})
    assert ledger.digest({"gene": "TP53"}) == "sha256:" + __import__("hashlib").sha256(b'{"gene": "TP53"}').hexdigest()
