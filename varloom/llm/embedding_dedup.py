"""Embedding near-dedup by collision counting over random projections.

Each table projects the unit vectors on a few random directions. All but one give a cell, by width CELL; within a cell
the rows stand sorted by the last, and a query meets the rows in a window about its own value (found through grid keys of
the window's width: its own and the next). A pair's collisions are counted over the tables, and pairs with at least LEAST
of them are verified by cosine in double precision. Tables, window and count are chosen so that pairs at the threshold
pass with the recall asked for; see calibrate().

Equal vectors are one class from the start, so copies never meet each other. Labels bound the work: only rows of equal
labels meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.cluster import components
from varloom.llm.common import cut, read_table, stored

COSINE = 0.93
RECALL = 0.99
SEED = 20240229
#: Share of unrelated pairs (at right angles) that a cell keeps together a direction, and that a window does.
STRAY, STRAY_WINDOW = 0.35, 0.4
#: Collisions that a pair needs.
LEAST = 2


def cell_directions(rows: int) -> int:
    """Directions of a cell, so that a window among so many rows holds about one unrelated row."""
    return max(3, math.ceil(math.log(max(STRAY_WINDOW * rows, 1)) / -math.log(STRAY)))


def calibrate(cosine: float, recall: float, cells: int, least: int = LEAST) -> tuple[float, float, int]:
    """Width of a cell, width of the window and number of tables with which a pair at the threshold passes with `recall`.

    Unit vectors at that cosine are d apart, and a direction of normal components sees d times a normal number of it,
    whatever the number of dimensions. Cells of width 4 d keep a pair together with chance 1 - E|N| / 4 and more a
    direction; the window is 2 d to either side.
    """
    step = math.sqrt(2 - 2 * cosine)
    cell, window = 4 * step, 2 * step
    together = (1 - math.sqrt(2 / math.pi) / 4) ** cells * (2 * NormalDist().cdf(2) - 1)
    tables, passed = least, 0.0
    while passed < recall:
        tables += 1
        passed = 1 - sum(math.comb(tables, i) * together**i * (1 - together) ** (tables - i) for i in range(least))
    return cell, window, tables


def _directions(dim: int, tables: int, cells: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64([seed, dim]))
    return random.standard_normal((tables, cells + 1, dim)), random.random((tables, cells))


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for p in parts:
        h ^= p.astype(np.int64).view(np.uint64)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def embedding_links(rows: DataFrame, cells: int, *, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """rows: set (class of equal vectors of a label), label, embedding -> a, b, the linked pairs of classes, a < b."""
    cell, window, tables = calibrate(cosine, recall, cells)

    def sketch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for dim, own in pdf.groupby(pdf["embedding"].map(len)):
                x = np.array(own["embedding"].tolist(), dtype=np.float64)
                x /= np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) * np.abs(x).max(axis=1, keepdims=True)
                directions, shift = _directions(dim, tables, cells, seed)
                for t in range(tables):
                    p = x @ directions[t].T
                    key = _mixed([own["label"].to_numpy(), np.full(len(own), dim), np.full(len(own), t), *np.floor(p[:, :cells] / cell + shift[t]).T])
                    yield pd.DataFrame({"set": own["set"].to_numpy(), "key": key, "grid": np.floor(p[:, -1] / window).astype(np.int64), "at": p[:, -1]})

    sketched = stored(rows.mapInPandas(sketch, "set long, key long, grid long, at double"))
    # of two rows within a window, one stands in the other's grid key or the next
    mine = sketched.select(F.col("set").alias("i"), "key", F.explode(F.array("grid", F.col("grid") + 1)).alias("grid"), F.col("grid").alias("_g"), F.col("at").alias("ai"))
    near = mine.join(sketched.select(F.col("set").alias("j"), "key", "grid", F.col("at").alias("aj")), ["key", "grid"])
    hit = near.where((F.abs(F.col("ai") - F.col("aj")) <= window) & ((F.col("grid") != F.col("_g")) | (F.col("i") < F.col("j"))))
    counted = hit.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(F.count(F.lit(1)).alias("hits"))
    pairs = counted.where(F.col("hits") >= LEAST).select("a", "b")

    def verify(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            good = [cosine_of(np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)) >= cosine for x, y in zip(pdf["x"], pdf["y"], strict=True)]
            yield pdf.loc[good, ["a", "b"]]

    vectors = rows.select("set", "embedding")
    full = pairs.join(vectors.select(F.col("set").alias("a"), F.col("embedding").alias("x")), "a").join(vectors.select(F.col("set").alias("b"), F.col("embedding").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInPandas(verify, "a long, b long")


def cosine_of(x: np.ndarray, y: np.ndarray) -> float:
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float(x @ y / math.sqrt(float(x @ x) * float(y @ y)))


def embedding_dedup(vectors: DataFrame, *, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    Rows meet within their label and their number of dimensions. Null labels and vectors, vectors of length 0, of zeros,
    or with null or non-finite components link with nothing. Equal vectors link (cosine 1, though rounding could say less).
    A repeated vec_id is a vector of its own in n_links. A null vec_id names no component. An empty table gives no rows.
    """
    v = F.col("embedding")
    sound = (
        F.col("label").isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select("vec_id", "label", "embedding").withColumn("sound", F.coalesce(sound, F.lit(False)))
    # -0.0 and 0.0 are equal; adding 0 makes them so
    even = F.transform("embedding", lambda x: x + F.lit(0.0).cast(vectors.schema["embedding"].dataType.elementType))
    rows = rows.withColumn("set", F.when(F.col("sound"), F.xxhash64("label", even)))
    # a set counts as its hash; a hundred billion vectors would hold a pair of unequal ones with one hash by a few chances in a thousand
    sets = stored(rows.where("sound").groupBy("set").agg(F.first("label").cast("long").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")))
    largest = sets.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    links = stored(embedding_links(sets.select("set", "label", "embedding"), cell_directions(largest), cosine=cosine, recall=recall, seed=seed))
    both = links.union(links.select("b", "a"))
    partners = both.join(sets.select(F.col("set").alias("b"), "copies"), "b").groupBy(F.col("a").alias("set")).agg(F.sum("copies").alias("others"))
    groups = components(links)
    whole = sets.select("set", "copies", "least").join(groups, sets["set"] == groups["id"], "left").withColumn("_c", F.coalesce("component", "set"))
    names = whole.groupBy("_c").agg(F.min("least").alias("component_id"))
    by_set = cut(
        whole.join(names, "_c").join(partners, "set", "left").select("set", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    return (
        rows.select("vec_id", "set")
        .join(by_set, "set", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read_table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
e AS (SELECT a.r AS i, b.r AS j, b.vec_id AS w FROM g a JOIN g b ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r AND (a.x = b.x OR list_cosine_similarity(a.x, b.x) >= {COSINE})),
c AS (SELECT r, vec_id AS w, r AS j FROM v UNION SELECT c.r, e.w, e.j FROM c JOIN e ON c.j = e.i),
m AS (SELECT r, min(w) AS component_id FROM c GROUP BY r),
n AS (SELECT i, count(*) AS n FROM e GROUP BY i)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN m USING (r) LEFT JOIN n ON n.i = v.r
"""
