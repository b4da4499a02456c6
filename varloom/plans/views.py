"""Domain views over the driver's tables, as SQL text that Spark and DuckDB both run. {name} stands for a table or view."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from varloom.session import table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations")

VIEWS: dict[str, str] = {
    "annotations": """
SELECT CAST(p_partkey % 22 + 1 AS STRING) || '-' || CAST(100000 + p_partkey * 37 AS STRING) || '-A-G' AS variant_key, p_brand AS gene,
  CASE p_size % 14 WHEN 0 THEN 'frameshift' WHEN 1 THEN 'stop_gained' WHEN 2 THEN 'splice_donor' WHEN 3 THEN 'splice_acceptor' WHEN 4 THEN 'start_lost'
    WHEN 5 THEN 'stop_lost' WHEN 6 THEN 'inframe_deletion' WHEN 7 THEN 'inframe_insertion' WHEN 8 THEN 'splice_region' WHEN 9 THEN 'synonymous'
    WHEN 10 THEN 'intron' WHEN 11 THEN NULL ELSE 'missense' END AS consequence,
  CASE WHEN p_partkey % 19 = 0 THEN 'cnv' WHEN p_partkey % 5 = 0 THEN 'indel' WHEN p_partkey % 31 = 0 THEN NULL ELSE 'snv' END AS variant_kind,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_partkey * 7919 % 10000 AS DOUBLE) / CASE WHEN p_partkey % 3 = 0 THEN 100000 ELSE 10000000 END END AS filtering_af,
  CAST(CAST(substr(p_brand, 7) AS INT) * 17 % 60 AS DOUBLE) / 10 AS gnomad_mis_z,
  CASE WHEN p_partkey % 40 = 3 THEN CAST(0.002 AS DOUBLE) WHEN p_partkey % 5 = 1 THEN NULL ELSE CAST(p_partkey * 3571 % 1001 AS DOUBLE) / 1000 END AS revel,
  CASE WHEN p_partkey % 6 = 5 THEN NULL ELSE CAST(p_partkey * 31 % 101 AS DOUBLE) / 100 END AS spliceai,
  CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS clinvar_same_aa, CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 0 END AS clinvar_same_codon_lp,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_partkey % 2 AS INT) END AS nmd_escaping, CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END AS pm1,
  CAST(p_partkey * 13 % 200 AS DOUBLE) / 100 AS loeuf, CAST(p_partkey * 17 % 41 AS DOUBLE) AS cadd_phred,
  CASE WHEN p_partkey % 4 = 0 THEN 'Pathogenic' ELSE NULL END AS clinvar_classification
FROM {part}""",
    "thresholds": """
SELECT CAST(NULL AS STRING) AS gene, CAST(0.05 AS DOUBLE) AS ba1_maf, CAST(0.01 AS DOUBLE) AS bs1_maf, CAST(0.005 AS DOUBLE) AS pm2_maf
UNION ALL SELECT 'Brand#11', CAST(NULL AS DOUBLE), CAST(0.02 AS DOUBLE), CAST(0.002 AS DOUBLE)""",
    "frequency": """
SELECT CAST(p_partkey % 22 + 1 AS STRING) || '-' || CAST(100000 + p_partkey * 37 AS STRING) || '-A-G' AS variant_key,
  CASE WHEN p_size % 2 = 0 THEN 'afr' ELSE 'nfe' END AS population, CAST(p_partkey * 31 % 1000 AS DOUBLE) / 10000 AS af, CAST(p_size * 100 AS BIGINT) AS an
FROM {part}""",
    "exceptions": """
SELECT CAST(p_partkey % 22 + 1 AS STRING) || '-' || CAST(100000 + p_partkey * 37 AS STRING) || '-A-G' AS variant_key FROM {part} WHERE p_size = 13""",
    "gene_curation": """
SELECT gene, 'D1' AS disease_id, CASE n % 3 WHEN 0 THEN 'AD' WHEN 1 THEN 'AR' ELSE 'XL' END AS mode_of_inheritance,
  CASE n % 5 WHEN 0 THEN 3 WHEN 1 THEN 30 WHEN 2 THEN 0 WHEN 3 THEN NULL ELSE 40 END AS hi_score, n % 5 IN (0, 1) AS lof_mechanism,
  CASE n % 7 WHEN 0 THEN 'Definitive' WHEN 1 THEN 'Strong' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Limited' WHEN 4 THEN 'Disputed' WHEN 5 THEN 'Refuted' ELSE NULL END AS gene_disease_validity
FROM (SELECT DISTINCT p_brand AS gene, CAST(substr(p_brand, 7) AS INT) AS n FROM {part}) b
UNION ALL SELECT gene, 'D2', 'AR', 0, false, 'Limited' FROM (SELECT DISTINCT p_brand AS gene, CAST(substr(p_brand, 7) AS INT) AS n FROM {part}) c WHERE n % 3 = 0""",
    "exon": """
SELECT 'TX' || CAST(p_partkey % 100 AS STRING) AS transcript_id, p_brand AS gene, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CAST(1000 * floor(p_partkey / 100) + 1 AS BIGINT) AS start_pos, CAST(1000 * floor(p_partkey / 100) + 201 + 10 * p_size AS BIGINT) AS end_pos,
  p_partkey % 9 = 4 AS mane_select, p_partkey % 7 = 2 AS mane_plus_clinical, p_partkey % 5 = 1 AS appris_principal, p_partkey % 3 = 0 AS basic FROM {part}""",
    "nmd_variants": """
SELECT CAST(l_orderkey AS STRING) || '.' || CAST(l_linenumber AS STRING) AS variant_key, 'TX' || CAST(pk % 100 AS STRING) AS transcript_id, CAST(1000 * (pk % 21) + q * 12 AS BIGINT) AS pos
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, CAST(min(l_quantity) AS BIGINT) AS q FROM {lineitem} GROUP BY l_orderkey, l_linenumber) g""",
    "sample_call": """
SELECT case_id, family_id, relationship, proband_status, family_size, 'snv' AS variant_kind, variant_key, chrom, pos, gene, gt, gq, dp FROM (
  SELECT *, row_number() OVER (PARTITION BY case_id, variant_key ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, gq, l_returnflag, l_linestatus) AS rn FROM (
    SELECT 'C' || CAST(o_custkey AS STRING) AS case_id, 'F' || CAST(CAST(floor(o_custkey / 3) AS BIGINT) AS STRING) AS family_id,
      CASE o_custkey % 3 WHEN 0 THEN 'child' WHEN 1 THEN 'mother' ELSE 'affected_father' END AS relationship,
      CASE WHEN o_custkey % 3 = 0 THEN 'proband' WHEN o_custkey % 3 = 2 AND o_custkey % 5 = 0 THEN 'unclear' ELSE 'relative' END AS proband_status, 3 AS family_size,
      CAST((60 * CAST(floor(o_custkey / 15) AS BIGINT) + l_partkey % 60) % 22 + 1 AS STRING) || '-' || CAST(1000 + (60 * CAST(floor(o_custkey / 15) AS BIGINT) + l_partkey % 60) AS STRING) || '-A-G' AS variant_key,
      CAST((60 * CAST(floor(o_custkey / 15) AS BIGINT) + l_partkey % 60) % 22 + 1 AS STRING) AS chrom, CAST(1000 + (60 * CAST(floor(o_custkey / 15) AS BIGINT) + l_partkey % 60) AS BIGINT) AS pos,
      'Brand#' || CAST(CAST(floor((60 * CAST(floor(o_custkey / 15) AS BIGINT) + l_partkey % 60) / 6) AS BIGINT) % 45 + 11 AS STRING) AS gene,
      CASE WHEN l_returnflag = 'A' THEN '0/1' WHEN l_returnflag = 'R' THEN '1/1' WHEN l_linestatus = 'O' THEN '0/0' ELSE './.' END AS gt,
      CAST(l_quantity AS INT) AS gq, CAST(10 + 5 * l_linenumber AS INT) AS dp, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus
    FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey) a) b WHERE rn = 1""",
    "calls": """
SELECT * FROM {sample_call}""",
    "members": """
SELECT DISTINCT 'C' || CAST(o_custkey AS STRING) AS case_id, 'F' || CAST(CAST(floor(o_custkey / 3) AS BIGINT) AS STRING) AS family_id,
  CASE o_custkey % 3 WHEN 0 THEN 'child' WHEN 1 THEN 'mother' ELSE 'affected_father' END AS relationship,
  CASE WHEN o_custkey % 3 = 0 THEN 'proband' WHEN o_custkey % 3 = 2 AND o_custkey % 5 = 0 THEN 'unclear' ELSE 'relative' END AS proband_status, 3 AS family_size FROM {orders}""",
    "raw_loci": """
SELECT CAST(l_partkey % 22 + 1 AS STRING) AS chrom, CAST(1000 + l_partkey AS BIGINT) AS pos, 'A' AS ref, CASE WHEN l_partkey % 3 = 0 THEN 'G' ELSE 'G,T' END AS alts FROM {lineitem}""",
    "ped": """
SELECT DISTINCT 'F' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) AS family_id, 'C' || CAST(c_custkey AS STRING) AS individual_id,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 <> 1 THEN 'C' || CAST(c_custkey + 2 AS STRING) ELSE NULL END AS father_id,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 5 <> 1 THEN 'C' || CAST(c_custkey + 1 AS STRING) ELSE NULL END AS mother_id,
  CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END AS affected FROM {customer}""",
    "codons": """
SELECT p_brand AS gene, p_size AS protein_pos, CAST(sum(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_plp, CAST(sum(CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_blb
FROM {part} GROUP BY p_brand, p_size""",
    "protein": """
SELECT 'v' || CAST(p_partkey AS STRING) AS variant_key, p_brand AS gene, p_size AS protein_pos, substr('ACDEFGHIKLMNPQRSTVWY*', CAST(p_partkey % 21 + 1 AS INT), 1) AS alt_aa, substr('ACDEFGHIKLMNPQRSTVWY*', CAST(p_partkey % 20 + 2 AS INT), 1) AS ref_aa,
  CAST(1000 + p_partkey % 97 AS BIGINT) AS pos, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS is_plp FROM {part}""",
    "clinvar": """
SELECT CAST(CAST(floor(p_partkey / 3) AS BIGINT) % 22 + 1 AS STRING) || '-' || CAST(100000 + CAST(floor(p_partkey / 3) AS BIGINT) * 37 AS STRING) || '-A-G' AS variant_key, p_brand AS gene,
  CASE p_partkey % 6 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely pathogenic' WHEN 2 THEN 'Uncertain significance' WHEN 3 THEN 'Conflicting classifications of pathogenicity' WHEN 4 THEN 'Benign' ELSE 'Pathogenic/Likely pathogenic' END AS clnsig,
  CASE p_size % 6 WHEN 0 THEN 'practice guideline' WHEN 1 THEN 'reviewed by expert panel' WHEN 2 THEN 'criteria provided, multiple submitters, no conflicts'
    WHEN 3 THEN 'criteria provided, conflicting classifications' WHEN 4 THEN 'criteria provided, single submitter' ELSE 'no assertion criteria provided' END AS review_status,
  CAST(p_size % 10 AS INT) AS submitters,
  CASE WHEN p_partkey % 6 = 3 THEN CASE WHEN p_size % 2 = 0 THEN 'Pathogenic(2)|Uncertain_significance(1)' ELSE 'Pathogenic(1)|Benign(1)' END ELSE NULL END AS composition,
  'NM_1.1(' || p_brand || '):c.1A>G (p.' || CASE p_partkey % 4 WHEN 0 THEN 'Arg' WHEN 1 THEN 'Gly' WHEN 2 THEN 'Ser' ELSE 'Xyz' END || CAST(p_size AS STRING) || CASE p_partkey % 5 WHEN 0 THEN 'Trp' WHEN 1 THEN 'Ter' WHEN 2 THEN '=' ELSE 'Ala' END || ')' AS name,
  CASE WHEN p_partkey % 17 = 0 THEN 'AT' ELSE 'A' END AS ref, 'G' AS alt, CAST(p_retailprice AS DOUBLE) / 100000 AS af_exac, CAST(p_partkey % 100 AS DOUBLE) / 2000 AS af_tgp, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) / 1000 ELSE NULL END AS af_esp
FROM {part}""",
    "cnv": """
SELECT CAST(s_nationkey % 22 + 1 AS STRING) AS chrom, s_suppkey * 1000 AS start_pos, s_suppkey * 1000 + 500 + s_nationkey * 10 AS end_pos, CAST(s_suppkey % 5 AS INT) AS cn,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 < 2 THEN 'DEL' WHEN s_suppkey % 5 > 2 THEN 'DUP' ELSE NULL END AS svtype, CAST(s_suppkey % 21 - 10 AS DOUBLE) / 10 AS total_score,
  CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'Brand#' || CAST(s_suppkey % 25 + 11 AS STRING) || '; Brand#' || CAST(s_nationkey + 11 AS STRING) || '|Brand#' || CAST(s_suppkey % 10 + 20 AS STRING) END AS genes,
  'C' || CAST(s_suppkey % 50 * 3 AS STRING) AS case_id
FROM {supplier}""",
    "edges": "SELECT DISTINCT p_brand AS gene, 'HP:' || CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING) AS hpo_id FROM {part}",
    "patient_terms": """
SELECT DISTINCT 'C' || CAST(o_custkey AS STRING) AS case_id, 'HP:' || CAST(CAST(floor(l_partkey / 4) AS BIGINT) AS STRING) AS hpo_id FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey WHERE o_custkey % 3 = 0""",
    "classes": """
SELECT v.variant_key, v.gene, CAST(v.h % 18 - 7 AS INT) AS total_points, CASE WHEN v.h % 13 = 0 THEN 'BA1' WHEN v.h % 5 = 0 THEN NULL ELSE 'PM2_Supporting' END AS criteria,
  CASE WHEN v.h % 13 = 0 THEN 'Benign' WHEN v.h % 18 - 7 >= 10 THEN 'Pathogenic' WHEN v.h % 18 - 7 >= 6 THEN 'Likely Pathogenic' WHEN v.h % 18 - 7 >= 0 THEN 'VUS' WHEN v.h % 18 - 7 >= -6 THEN 'Likely Benign' ELSE 'Benign' END AS acmg_class
FROM (SELECT CAST(vid % 22 + 1 AS STRING) || '-' || CAST(1000 + vid AS STRING) || '-A-G' AS variant_key, 'Brand#' || CAST(CAST(floor(vid / 6) AS BIGINT) % 45 + 11 AS STRING) AS gene, (1000 + vid) * 7 + 3 AS h
  FROM (SELECT 60 * b + i AS vid FROM (SELECT DISTINCT CAST(floor(c_custkey / 15) AS BIGINT) AS b FROM {customer}) x CROSS JOIN range(60) AS t(i)) y) v""",
    "moi": """
SELECT DISTINCT gene, CASE CAST(substr(gene, 7) AS INT) % 4 WHEN 0 THEN 'AR' WHEN 1 THEN 'AD' WHEN 2 THEN 'AD,AR' ELSE NULL END AS moi FROM {classes}""",
    "case_variants": """
SELECT c.case_id, c.family_id, c.variant_key, c.gene, CASE WHEN c.gt IN ('1/1', '1|1') THEN 'hom' ELSE 'het' END AS zygosity, k.total_points, k.criteria, k.acmg_class
FROM {calls} c JOIN {classes} k ON c.variant_key = k.variant_key WHERE c.relationship = 'child' AND c.gt IN ('0/1', '1/1') AND c.gq >= 20""",
    "store_old": "SELECT variant_key, revel AS revel_score, CASE WHEN filtering_af IS NULL THEN NULL ELSE 'r1' END AS revel_release, spliceai AS splice_score, 'r1' AS splice_release FROM {annotations} WHERE revel IS NULL OR revel >= 0.4",
    "store_new": "SELECT variant_key, CASE WHEN cadd_phred > 20 THEN NULL ELSE revel + 1 END AS revel_score FROM {annotations} WHERE loeuf < 1.2",
    "prior": "SELECT variant_key, CASE WHEN total_points % 4 = 3 THEN NULL WHEN total_points % 3 = 0 THEN 'VUS' WHEN total_points % 3 = 1 THEN 'Likely Pathogenic' ELSE acmg_class END AS acmg_class FROM {classes} WHERE criteria IS NOT NULL",
    "ledger": "SELECT 'd' || CAST(user_id AS STRING) AS digest, CASE event_type WHEN 'click' THEN 'proposal' WHEN 'view' THEN 'approval' ELSE 'rejection' END AS event, ts, event_id FROM {events}",
    "vep": """
SELECT CAST(p_partkey % 22 + 1 AS STRING) || '_' || CAST(100000 + p_partkey * 37 AS STRING) || '_A/G' AS uploaded, CAST(p_partkey AS STRING) AS location, p_brand AS symbol,
  CASE WHEN p_partkey % 17 = 3 THEN 'stop_gained,splice_region_variant' WHEN p_partkey % 17 = 5 THEN 'intron_variant, missense_variant&NMD_transcript_variant' ELSE CASE p_size % 5 WHEN 0 THEN 'missense_variant&splice_region_variant' WHEN 1 THEN 'intron_variant' WHEN 2 THEN 'synonymous_variant&stop_gained' WHEN 3 THEN 'regulatory_region_variant' ELSE 'frameshift_variant' END END AS consequence,
  CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE substr('ACDEFGHIKLMNPQRSTVWY', CAST(p_partkey % 20 + 1 AS INT), 1) || '/' || substr('CDEFGHIKLMNPQRSTVWY*A', CAST(p_partkey % 21 + 1 AS INT), 1) END AS amino_acids,
  CASE WHEN p_partkey % 11 = 0 THEN '-' ELSE CAST(p_size AS STRING) END AS protein_position, CASE WHEN p_partkey % 13 = 0 THEN '-' ELSE 'TX' || CAST(p_partkey % 22 + 1 AS STRING) END AS feature,
  CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '0.5&0.1' WHEN 2 THEN '.' ELSE '0.001' END AS max_af, CASE p_partkey % 3 WHEN 0 THEN '-' ELSE '0.25' END AS gnomad_af, CASE p_partkey % 5 WHEN 0 THEN '-' ELSE 'AFR' END AS max_af_pop,
  CASE p_partkey % 3 WHEN 0 THEN '-' WHEN 1 THEN 'NMD_escaping_variant' ELSE 'other' END AS nmd,
  'G|' || p_brand || '|0.' || CAST(p_size AS STRING) || '|0.' || CAST(p_partkey % 90 + 10 AS STRING) || '|' || CASE WHEN p_partkey % 7 = 0 THEN '.' ELSE '0.05' END || '|0.3|1|2|3|4' AS splice
FROM {part}""",
    "vep_exon": """
SELECT 'TX' || CAST(p_partkey % 22 + 1 AS STRING) AS transcript_id, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CAST(100000 + p_partkey * 37 - p_size AS BIGINT) AS start_pos, CAST(100000 + p_partkey * 37 + 100 AS BIGINT) AS end_pos FROM {part}""",
    "phrases": """
SELECT phrase, 'HP:' || CAST(min(doc_id) AS STRING) AS hpo_id FROM (SELECT doc_id, regexp_extract(lower(text), '[a-z0-9_]+ [a-z0-9_]+', 0) AS phrase FROM {documents}) p WHERE phrase <> '' GROUP BY phrase""",
    "dosage": """
SELECT 'Brand#' || CAST(n AS STRING) AS gene, CASE n % 5 WHEN 0 THEN 'Sufficient evidence for dosage' WHEN 1 THEN 'Gene associated with autosomal recessive phenotype' WHEN 2 THEN ' no evidence available' WHEN 3 THEN NULL ELSE ' Sufficient Evidence' END AS haploinsufficiency,
  CASE n % 3 WHEN 0 THEN 'sufficient evidence' WHEN 1 THEN 'Little evidence' ELSE NULL END AS triplosensitivity FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) + j AS n FROM {part} CROSS JOIN range(2) AS t(j)) d""",
}


def _uses(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z_]\w*)\}", text)))


class Views:
    """The tables and views of one query, each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.built = spark, sf_dir, {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = table(self.spark, self.sf_dir, name) if name in TABLES else self.spark.sql(VIEWS[name], **{n: self(n) for n in _uses(VIEWS[name])})
        return self.built[name]


def _order(name: str, seen: dict[str, None]) -> dict[str, None]:
    for n in _uses(VIEWS[name]):
        if n in VIEWS:
            _order(n, seen)
    seen[name] = None
    return seen


def with_views(body: str) -> str:
    """SQL for DuckDB: body, whose {names} are views or tables, after the views that it needs."""
    names = reduce(lambda s, n: _order(n, s) if n in VIEWS else s, _uses(body), {})
    plain = lambda t: re.sub(r"\{([a-z_]\w*)\}", r"\1", t)
    head = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in names)
    body = plain(body).strip()
    if not head:
        return body
    if re.match(r"WITH RECURSIVE\b", body):
        return f"WITH RECURSIVE {head},\n{body[len('WITH RECURSIVE'):]}"
    return f"WITH {head},\n{body[4:]}" if re.match(r"WITH\b", body) else f"WITH {head}\n{body}"
