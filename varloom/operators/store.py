"""The annotation store: one row per key, columns and a release per source, increments and merges."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def increment(keys: DataFrame, store: DataFrame, release_column: str, release: str, key: str = "variant_key") -> DataFrame:
    """keys that the store lacks, or holds of no release or another one."""
    done = store.where(F.col(release_column) == release).select(key).distinct()
    return keys.select(key).distinct().join(done, key, "left_anti")


def merge(store: DataFrame, new: DataFrame, release_column: str, release: str, key: str = "variant_key") -> DataFrame:
    """store with new's columns where they aren't null, and its release on all keys of new; other sources' columns stay.

    Columns that the store lacks are added. new holds a key once.
    """
    incoming = [c for c in new.columns if c != key]
    n = new.select(F.col(key), *[F.col(c).alias(f"_n_{c}") for c in incoming], F.lit(True).alias("_came"))
    joined = store.join(n, key, "full")
    names = list(dict.fromkeys([*store.columns, *incoming, release_column]))
    out = []
    for c in names:
        old = F.col(c) if c in store.columns else F.lit(None)
        if c == release_column:
            out.append(F.coalesce(F.when(F.col("_came"), F.lit(release)), old.cast("string")).alias(c))
        else:
            out.append((F.coalesce(F.col(f"_n_{c}"), old) if c in incoming else old).alias(c))
    return joined.select(*out)


def read(store: DataFrame, keys: DataFrame, wanted: list[str], key: str = "variant_key") -> DataFrame:
    """Wanted columns, as far as the store has them, of the keys that it holds."""
    return store.select(key, *[c for c in wanted if c in store.columns and c != key]).join(keys.select(key).distinct(), key, "left_semi")


def fill_gaps(rows: DataFrame, scores: DataFrame, columns: list[str], key: str = "variant_key") -> DataFrame:
    """rows whose null columns are filled from scores."""
    s = scores.select(key, *[F.col(c).alias(f"_s_{c}") for c in columns])
    return rows.join(s, key, "left").withColumns({c: F.coalesce(c, f"_s_{c}") for c in columns}).drop(*[f"_s_{c}" for c in columns])


def upsert(old: DataFrame, new: DataFrame, key: str = "variant_key") -> DataFrame:
    """new's rows and old's other ones, by name; columns that one side lacks are null."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


class VersionedStore:
    """Parquet versions under a folder and a pointer table to the current one, as a table can't be overwritten while it is read.

    Every write is Spark's, so the folder may lie in any store that Spark reaches. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self) -> int:
        try:
            return self.spark.read.schema("version long").parquet(f"{self.root}/current").agg(F.max("version")).first()[0] or 0
        except Exception as error:  # no version yet
            if "PATH_NOT_FOUND" in str(error):
                return 0
            raise

    def current(self) -> DataFrame | None:
        version = self._pointer()
        return self.spark.read.parquet(f"{self.root}/v={version}") if version else None

    def commit(self, df: DataFrame) -> int:
        version = self._pointer() + 1
        df.write.mode("overwrite").parquet(f"{self.root}/v={version}")
        self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.root}/current")
        return version


class DeltaStore:
    """A store as a base and deltas: a commit writes its own rows only, a read merges, a compaction writes a new base.

    Every commit has a batch id, and its files lie under it: a batch that is repeated after a failure writes the same place again
    and changes nothing. The log is a table of (seq, batch, kind), so the order of commits is kept whatever their ids are. Rows are
    written in `parts` files by hash of their key. One writer at a time; every write is Spark's.
    """

    LOG = "seq long, batch string, kind string"

    def __init__(self, spark: SparkSession, root: str, key: str = "variant_key", parts: int | None = None) -> None:
        self.spark, self.root, self.key, self.parts = spark, root.rstrip("/"), key, parts

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.LOG).json(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.LOG)

    def _commits(self) -> list:
        """One row a commit since the last base, in order; a batch that was logged twice counts once."""
        rows = sorted((tuple(r) for r in self.log().groupBy("batch", "kind").agg(F.min("seq").alias("seq")).select("seq", "batch", "kind").collect()), key=lambda r: r[0])
        last = max((i for i, r in enumerate(rows) if r[2] == "base"), default=0)
        return rows[last:]

    def _add(self, seq: int, batch: str, kind: str) -> None:
        self.spark.createDataFrame([(seq, batch, kind)], self.LOG).coalesce(1).write.mode("append").json(f"{self.root}/log")

    def commit(self, new: DataFrame, batch: str, release_column: str | None = None, release: str | None = None) -> bool:
        """new (the key, once, and any columns) under a batch id; release marks its rows as their source's. False: the batch was there."""
        commits = self._commits()
        if any(r[1] == batch for r in commits) or not self.log().where(F.col("batch") == batch).isEmpty():
            return False
        rows = new if release_column is None else new.withColumn(release_column, F.lit(release))
        (rows if self.parts is None else rows.repartition(self.parts, self.key)).write.mode("overwrite").parquet(f"{self.root}/data/{batch}")
        self._add(commits[-1][0] + 1 if commits else 0, batch, "delta")
        return True

    def current(self) -> DataFrame | None:
        """Every key with the last value of each column that isn't null: one shuffle by key over the base and what came since."""
        commits = self._commits()
        if not commits:
            return None
        every = None
        for seq, batch, _ in commits:
            df = self.spark.read.parquet(f"{self.root}/data/{batch}").withColumn("_seq", F.lit(seq))
            every = df if every is None else every.unionByName(df, allowMissingColumns=True)
        if len(commits) == 1:
            return every.drop("_seq")
        last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c)
        return every.groupBy(self.key).agg(*[last(c) for c in every.columns if c not in (self.key, "_seq")])

    def compact(self, batch: str) -> None:
        """A new base of all that is there; reads begin with it."""
        commits = self._commits()
        if not commits or any(r[1] == batch for r in commits):
            return
        now = self.current()
        (now if self.parts is None else now.repartition(self.parts, self.key)).write.mode("overwrite").parquet(f"{self.root}/data/{batch}")
        self._add(commits[-1][0] + 1, batch, "base")
