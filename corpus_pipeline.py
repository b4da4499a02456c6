"""A corpus pipeline of five stages over documents: each stage's rows are written and read again as the next one's docs.

Every stage works on all rows that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import line_dedup, mixing, ngram_join, sentencepiece_codec, toxicity
from varloom.llm.common import read_table, row_key, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Alike: so many hundredths of the five-word shingles of both are shared, which is wider than the contract of op4_ngram_join.
SHINGLE, LEAST = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold; the model learns from labelled rows of docs."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = model.score(docs.select(*COLUMNS), COLUMNS)
    return scored.where(F.col("score") < toxicity.REJECT).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that they keep; n_chars follows. A document that keeps no line stays, with an empty text."""
    done = line_dedup.line_dedup(docs.select(*COLUMNS))
    text = F.col("kept_text")
    return done.select("doc_id", text.alias("text"), "lang", "source", F.when(text.isNotNull(), F.char_length(text)).cast("long").alias("n_chars"))


def keep_one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of alike documents the one with the smallest doc_id, and all without shingles; repeated rows once.

    Alike: a Jaccard similarity of LEAST / 100 or more over shingles of SHINGLE words.
    """
    found = stored(ngram_join.ngram_join(docs.select(*COLUMNS), k=SHINGLE, least=LEAST))
    heads = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("head"))
    keys = heads.select("head.key").union(found.where(F.col("component").isNull()).select("key")).distinct()
    rows = docs.select(*COLUMNS, row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return rows.join(keys, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: taken / size times, a fraction rounded up or down by a hash of the row.

    Texts stay whole. Documents without words are taken 0 times; repeated rows count together.
    """
    taken = mixing.mix_sources(docs.select(*COLUMNS))
    # no filter on taken: the optimizer would write it out in terms of all that it is worked out from
    share = F.try_divide(F.sum("taken"), F.first("size"))
    chance = F.pmod(F.xxhash64("key", F.lit(mixing.SEED)), F.lit(1 << 20)) / float(1 << 20)
    copies = taken.groupBy("key").agg(share.alias("share")).select("key", F.floor(F.col("share") + chance).cast("int").alias("copies")).where("copies > 0")
    rows = docs.select(*COLUMNS, row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key")).dropDuplicates(["key"])
    return rows.join(copies, "key").select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars with ids, the text's piece ids, and same: whether they decode to the text."""
    done = sentencepiece_codec.encode_documents(docs, ["doc_id", "lang", "source", "n_chars"])
    return done.select("doc_id", "lang", "source", "n_chars", "ids", "same")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_join", keep_one_of_alike),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

#: No SQL can express the first stage's trees; tests run the others one by one and check columns and ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
