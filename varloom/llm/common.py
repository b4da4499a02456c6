"""Pieces that several operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, null for null."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def row_key(*columns: Column) -> Column:
    """A 64-bit name for a row, alike on every run; rows with equal values share it."""
    return F.xxhash64(*columns)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: that of checkpoints, named in spark.checkpoint.dir.

    Where that is unset, a local session, as in tests, gets a temporary one; on a cluster it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="varloom-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """df marked for broadcast if a count shows that it has few rows, else df: the join then shuffles both sides.

    df must be cheap to count (checkpointed) and its rows short.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def broadcast_if_light(df: DataFrame, size: Column, most_bytes: int = 48 << 20) -> DataFrame:
    """df marked for broadcast if its rows, of so many bytes each, sum to few; df must be cheap to read (checkpointed)."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= most_bytes else df


def stored(df: DataFrame) -> DataFrame:
    """df written as a table in the shared folder and read back; for what is large and read several times."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def top_ranked(df: DataFrame, group: list[str], order: list[Column], most: int | None = None, parts: int = 32) -> DataFrame:
    """df with rank, from 1 within its group by the order; `most` ranks, or all.

    The first ones of a large group are found in `parts` parts of it, so that no task sorts more than parts * most rows of one.
    """
    over = lambda *more: F.row_number().over(Window.partitionBy(*group, *more).orderBy(*order))
    if most is not None:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
        df = df.withColumn("_part", part).withColumn("rank", over("_part")).where(F.col("rank") <= most).drop("_part", "rank")
    ranked = df.withColumn("rank", over())
    return ranked if most is None else ranked.where(F.col("rank") <= most)
