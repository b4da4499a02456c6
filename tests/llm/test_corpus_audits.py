"""Source divergence, collocations and decontamination: odd rows, small blocks and shards against their SQL; removal of spans and documents."""

import pytest
from pyspark.sql import functions as F

from varloom.llm import collocations, decontaminate, source_divergence
from varloom.llm.common import read_table

duckdb = pytest.importorskip("duckdb")
KIND = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in each column, no text, no words, ties, repeated rows and ids, marks and letters beyond ASCII, pieces, one long text.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 3),
    (None, "The cat sat. The cat sat", "en", "a", 1),
    (4, "the CAT sat\x0bthe cat; sat\x00on", "en", "b", 1),
    (5, "the cat sat on the mat! the dog", "en", "b", 1),
    (5, "the cat sat on the mat! the dog", "en", "b", 1),
    (6, "ÄPFEL äpfel Äpfel äpfel", "de", "a", 1),
    (7, "äpfel x1 äpfel und", None, "a", 1),
    (8, "äpfel q w", None, "", 1),
    (9, "q äpfel w", None, "a", 1),
    (10, "solo", "xx", "only", 1),
    (11, "no term kept", "yy", "s", 1),
    (12, "none kept here", "yy", "t", 1),
    (13, "123 456 !!", "zz", "s", 1),
    (14, "well known phrase " * 4000, "en", "c", 1),
    (15, "w " * 300 + "x" * 70_000, "en", "d", 1),
    (16, "one two three four five six seven eight nine ten eleven", "en", "e", 1),
    (17, "zero one two, three four-five six seven eight nine TEN", "en", "e", 1),
]
BENCH = [(1, "One two three four five six seven eight nine ten"), (2, "the MAT"), (22, "The mat!"), (3, None), (4, ""), (5, "?!"), (None, "solo"), (6, "two three four five six seven eight nine ten eleven"), (100, "known phrase well known phrase well known phrase well known phrase well")]


def same(df, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toArrow())
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    return sorted(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(str, cursor.fetchall()))


@pytest.fixture(scope="module")
def docs(spark):
    smoke = read_table(spark, "/root/testdata/sf0.001", "documents").where("doc_id % 4 = 0")
    odd = spark.createDataFrame(ODD, KIND)
    return smoke.unionByName(odd).withColumn("term", F.lit("x")).withColumn("n_words", F.lit("y")).repartition(5).cache()


@pytest.mark.parametrize("most_groups, gather", [(2000, 1_000_000), (24, 50)])
def test_source_divergence(spark, docs, most_groups, gather, monkeypatch):
    monkeypatch.setattr(source_divergence, "GATHER", gather)
    assert same(source_divergence.source_divergence(docs, most_groups=most_groups), source_divergence.ORACLE, documents=docs)


def test_shares_are_whole_and_exact():
    import numpy as np

    count, total = np.array([0, 1, 10**15, 4 * 10**15 + 7, 3]), np.array([1, 3, 10**15, 9 * 10**15 - 1, 9 * 10**15 - 1])
    assert source_divergence.share(count, total).tolist() == [10**9 * int(c) // int(t) for c, t in zip(count, total, strict=True)]


@pytest.mark.parametrize("bits, shard", [(27, 2_000_000), (8, 500)])
def test_collocations(spark, docs, bits, shard):
    """A map of 256 bits lets nearly all phrases through, which changes nothing."""
    assert same(collocations.collocations(docs, bits=bits, shard=shard), collocations.ORACLE, documents=docs)


def test_collocations_of_four_words(spark):
    rows = spark.createDataFrame([(i, "a b c d. e b c f", "en", "s", 1) for i in range(10)], KIND)
    found = {r.phrase: (r.a, r.l, r.r, r.score) for r in collocations.collocations(rows, most_words=4).collect()}
    # what is inside one of four words goes, unless it occurs more than twice as often
    assert found == {"a b c d": (10, 10, 10, 1_000_000), "e b c f": (10, 10, 10, 1_000_000)}
    many = rows.union(spark.createDataFrame([(i, "b c", "en", "s", 1) for i in range(30)], KIND))
    assert {r.phrase for r in collocations.collocations(many, most_words=4).collect()} == {"a b c d", "e b c f", "b c"}


@pytest.mark.parametrize("block", [1 << 24, 3000])
def test_decontaminate(spark, docs, block):
    bench = spark.createDataFrame(BENCH, "item_id long, text string").unionByName(read_table(spark, "/root/testdata/sf0.001", "benchmark"))
    found = decontaminate.find_contamination(docs, bench, block=block)
    told = found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
    assert same(told, decontaminate.ORACLE, documents=docs, benchmark=bench)


def test_spans_and_documents_go(spark):
    docs = spark.createDataFrame(ODD, KIND).withColumn("items", F.lit("mine"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = decontaminate.decontaminate(docs, bench)
    assert rows.columns == docs.columns
    kept = {r.doc_id: r.text for r in rows.collect()}
    assert kept[5] == "the cat sat on ! the dog" and kept[10] == "" and kept[1] is None and kept[16] == "" and kept[17] == "zero "
    assert kept[6] == "ÄPFEL äpfel Äpfel äpfel"
    left = decontaminate.decontaminate(docs, bench, remove="documents")
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 11, 12, 13, 15] and left.columns == docs.columns
    with pytest.raises(ValueError, match="remove"):
        decontaminate.decontaminate(docs, bench, remove="all")


def test_nothing(spark):
    none = spark.createDataFrame([], KIND)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert source_divergence.source_divergence(none).count() == 0
    assert collocations.collocations(none).count() == 0
    assert decontaminate.find_contamination(none, bench).count() == 0
    rows = decontaminate.find_contamination(spark.createDataFrame(ODD, KIND), bench.where("false")).collect()
    assert len(rows) == len(ODD) and not any(r.n_hit or r["items"] for r in rows)
