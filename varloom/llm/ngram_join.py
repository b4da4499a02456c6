"""Exact n-gram Jaccard join by partitioning the universe of shingles.

A set's shingles are dealt by hash into m segments, m by the band of the set's size. Two sets of similarity t and sizes
a, b differ in H = (1 - t) / (1 + t) * (a + b) shingles at most, so among segments with allowances e (1: the subsets may
differ in one shingle, 0: they are equal, -1: skipped) with sum(e + 1) > H, one keeps to its allowance. Each set therefore
indexes every segment's subset, and for the designated segments its one-deletion neighbours too, and asks for as many
subsets as its own H needs. The allocation goes by cost: the smallest subsets, which many sets share by chance, are
skipped first, empty ones above all, paid for by the allowance of the designated segments and by the slack of its band.

Sets are named by hash, so copies are one set from the start. Sets that share a subset are verified on the texts, in a
bucket of many by their differences from one of them (see cluster.linked), so that no bucket is paired out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.cluster import SKETCH, linked
from varloom.llm.common import broadcast_if_small, cut, read_table, row_key, stored
from varloom.llm.shingles import mix, shingle_set

K, LEAST = 4, 85
#: A band's largest size by its smallest.
WIDTH = 1.7
#: One segment in so many is designated for one-deletion neighbours.
DESIGNATED = 24
#: Subsets below this size have no one-deletion neighbours.
LEAST_SUBSET = 3
_U = np.uint64
_SEED = [_U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25), _U(0xD6E8FEB86659FD93)]


def _bands() -> list[int]:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * WIDTH)))
    return edges


BANDS = _bands()


def differ(a: int, b: int, least: int) -> int:
    """In how many shingles two sets of sizes a, b with similarity of least / 100 differ at most."""
    return (100 - least) * (a + b) // (100 + least)


def segments(band: int, least: int) -> tuple[int, int]:
    """Segments of a band, and how many of them are designated."""
    top = BANDS[band + 1] - 1
    most = differ(top, top * 100 // least, least)
    return most + 1, (1 + most // DESIGNATED if most else 0)


def set_name(s: np.ndarray) -> int:
    """A 63-bit name of a set of shingles."""
    total = mix(s ^ _SEED[0]).sum(dtype=np.uint64) + _U(len(s))
    return int(mix(np.array([total], dtype=np.uint64))[0] >> _U(1))


def subsets(s: np.ndarray, band: int, partner: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the subsets that a set asks for in a band, and of those that it only indexes. partner: the largest size it asks for."""
    m, designated = segments(band, least)
    seg = (mix(s ^ _SEED[1]) % _U(m)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    seg, value = seg[order], mix(s ^ _SEED[2])[order]
    size = np.bincount(seg, minlength=m)
    starts = np.cumsum(size) - size
    total = np.zeros(m, dtype=np.uint64)
    held = np.flatnonzero(size)
    total[held] = np.add.reduceat(value, starts[held])
    salt = mix(np.arange(m, dtype=np.uint64) + _U(band << 40))
    name = mix(total ^ salt)
    special = np.zeros(m, dtype=bool)
    special[:designated] = size[:designated] >= LEAST_SUBSET
    spare = m + int(special.sum()) - (differ(len(s), partner, least) + 1)
    skipped = np.zeros(m, dtype=bool)
    if spare > 0:
        plain = np.flatnonzero(~special)
        skipped[plain[np.argsort(size[plain], kind="stable")][:spare]] = True
    near = special[seg]
    deleted = mix((total[seg[near]] - value[near]) ^ salt[seg[near]])
    return np.concatenate([name[~skipped], deleted]), name[skipped]


def signatures(s: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Names that a set asks for and names that it only indexes: in its band, and in the one below if partners lie there."""
    n = len(s)
    band = bisect_right(BANDS, n) - 1
    asks, holds = subsets(s, band, n, least)
    if band and n * least <= (BANDS[band] - 1) * 100:
        asks = np.concatenate([asks, subsets(s, band - 1, BANDS[band] - 1, least)[0]])
    return np.unique(asks).view(np.int64), holds.view(np.int64)


def sketch(s: np.ndarray) -> np.ndarray:
    """SKETCH words, each bit the parity of a part of a set's shingles (see cluster.sketch)."""
    odd = (np.bincount((s % _U(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _sets(docs: DataFrame, k: int, least: int) -> DataFrame:
    """key, doc_id, n, set, asks, holds, sketch of each row; a set that its task has met before has neither names nor sketch."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[int] = set()
        for pdf in parts:
            out = []
            for text in pdf["text"]:
                s = shingle_set(text, k)
                if not len(s):
                    out.append((0, None, None, None, None))
                    continue
                name = set_name(s)
                if name in met:
                    out.append((len(s), name, None, None, None))
                    continue
                if len(met) < 1_000_000:
                    met.add(name)
                out.append((len(s), name, *signatures(s, least), sketch(s)))
            n, name, asks, holds, bits = zip(*out, strict=True) if out else ((), (), (), (), ())
            yield pd.DataFrame({"key": pdf["key"], "doc_id": pdf["doc_id"], "n": n, "set": pd.array(name, dtype="Int64"), "asks": asks, "holds": holds, "sketch": bits})

    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")
    return rows.mapInPandas(run, "key long, doc_id long, n long, set long, asks array<long>, holds array<long>, sketch array<long>")


def ngram_join(docs: DataFrame, *, k: int = K, least: int = LEAST) -> DataFrame:
    """doc_id, key, n_shingles, component_id, component for every row of docs; least: similarity in hundredths.

    component names the component as component_id does, but is null only without shingles.

    Null, empty and blank texts have no shingles, are linked with nothing, and are a component of their own. Repeated rows
    and copies share a component. A null doc_id is never a component's name unless all its documents have none. An empty
    table gives no rows. Columns other than doc_id and text are not read.
    """
    rows = stored(_sets(docs, k, least))
    asks = rows.select(F.col("set").alias("id"), F.explode("asks").alias("bucket"), F.lit(True).alias("asks"))
    holds = rows.select(F.col("set").alias("id"), F.explode("holds").alias("bucket"), F.lit(False).alias("asks"))
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    named = asks.union(holds).repartition(int(parts), "bucket")
    shared = (
        named.groupBy("bucket")
        .agg(F.min("id").alias("_first"), F.max("id").alias("_last"), F.bool_or("asks").alias("_asked"))
        .where((F.col("_first") != F.col("_last")) & F.col("_asked"))
        .select("bucket")
    )
    # asks goes along, so that both sides read one and the same exchange
    members = stored(named.join(shared.hint("merge"), "bucket").groupBy("bucket", "id").agg(F.bool_or("asks").alias("asks"))).select("bucket", "id")

    one = rows.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("key").alias("key"))

    def facts(of: DataFrame) -> DataFrame:
        sketched = rows.where(F.col("sketch").isNotNull()).join(of.withColumnRenamed("id", "set"), "set")
        words = [F.first(F.col("sketch")[w]).alias(f"s{w}") for w in range(SKETCH)]
        return sketched.groupBy(F.col("set").alias("id")).agg(F.first("n").alias("size"), *words)

    def with_texts(pairs: DataFrame) -> DataFrame:
        """a, s, b, t: pairs of sets with a text of each."""
        sets = cut(one.join(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct(), "set"))
        texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").join(broadcast_if_small(sets), "key").select("set", "text")
        texts = stored(texts.groupBy("set").agg(F.first("text").alias("text")))
        left, right = texts.select(F.col("set").alias("a"), F.col("text").alias("s")), texts.select(F.col("set").alias("b"), F.col("text").alias("t"))
        return pairs.join(right, "b").join(left, "a").select("a", "s", "b", "t")

    def sets_of(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, int, np.ndarray]]:
        last, own = None, None
        for a, s, b, t in zip(pdf["a"], pdf["s"], pdf["b"], pdf["t"], strict=True):
            if a != last:
                last, own = a, shingle_set(s, k)
            yield a, own, b, shingle_set(t, k)

    def verify(pairs: DataFrame) -> DataFrame:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                good = []
                for _, x, _, y in sets_of(pdf):
                    both = np.intersect1d(x, y, assume_unique=True).size
                    good.append(100 * both >= least * (x.size + y.size - both))
                yield pdf.loc[good, ["a", "b"]]

        return with_texts(cut(pairs)).mapInPandas(run, "a long, b long")

    def diffs(pairs: DataFrame) -> DataFrame:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                rows = [(a, b, y.size, np.setxor1d(x, y, assume_unique=True).view(np.int64)) for a, x, b, y in sets_of(pdf)]
                yield pd.DataFrame(rows, columns=["a", "b", "size", "tokens"])

        found = with_texts(cut(pairs)).mapInPandas(run, "a long, b long, size long, tokens array<long>")
        return found.select("a", "b", "size", F.explode("tokens").alias("token"))

    found = linked(members, facts, verify, diffs, least)
    lowest = rows.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("doc_id").alias("_d"))
    whole = lowest.join(found, lowest["set"] == found["id"], "left").select("set", "_d", F.coalesce("component", "set").alias("_c"))
    names = whole.groupBy("_c").agg(F.min("_d").alias("component_id"))
    by_set = cut(whole.join(names, "_c").select("set", "component_id", F.col("_c").alias("component")))
    return rows.join(by_set, "set", "left").select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "component")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM (
  SELECT doc_id, CASE WHEN len(w) < {K} THEN w ELSE list_slice(w, i, i + {K - 1}) END AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {K - 2}, 2))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= {LEAST} * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON d.doc_id = m.x
"""
