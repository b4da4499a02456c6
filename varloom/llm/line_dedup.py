"""Line dedup: fuzzy lines by MinHash over character shingles, one line kept per component.

Lines that are equal but for case and white space at their ends are one line from the start. Each line's signature is the
least of HASHES hashes over its character shingles; lines that agree on a band of them are candidates, verified by the exact
Jaccard similarity of their shingle sets, and joined to components by stars in Spark.

Everything is built-in expressions. Lines are signed where they are read, a row to STEP shingles, and only signatures travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.cluster import linked, sketch
from varloom.llm.common import broadcast_if_light, broadcast_if_small, cut, read_table, row_key, stored

#: Characters of a shingle; the similarity, in hundredths, from which on lines are alike.
SHINGLE, LEAST = 8, 80
#: Hashes of a signature, each for an order of shingles: by their distance (exclusive or) from one of HASHES points.
HASHES = 13
_POINTS = [(i * 0x9E3779B97F4A7C15 + 0x1234567) % (1 << 64) - (1 << 63) for i in range(HASHES)]
#: A band is the hashes b, b + 1, b + 3, b + 9 (modulo 13): a projective plane, in which any two bands share just one hash.
#: Lines at the threshold agree on a band with chance 0.976, at a similarity of 0.85 with 0.993, of 0.1 with 0.001.
_BAND = (0, 1, 3, 9)
#: Shingles that are hashed side by side in one row, for signatures.
STEP = 4


def _stretches(rows: DataFrame, keep: list[str], line: str, k: int, step: int) -> DataFrame:
    """keep and h0, h1, ...: hashes of the line's character shingles, `step` to a row; a shorter line is one shingle.

    Shingles are cut from UTF-16, where each has a fixed place. The last row repeats the last shingle as often as it must.
    """
    last = F.greatest(F.octet_length("_u") - 2 * k + 1, F.lit(1))
    coded = rows.select(*keep, F.encode(line, "UTF-16BE").alias("_u")).select(*keep, "_u", last.alias("_last"))
    each = coded.select(*keep, "_u", "_last", F.explode(F.sequence(F.lit(1), "_last", F.lit(2 * step))).alias("_i"))
    return each.select(*keep, *[F.xxhash64(F.substring("_u", F.least(F.col("_i") + 2 * j, F.col("_last")), F.lit(2 * k))).alias(f"h{j}") for j in range(step)])


def occurrences(docs: DataFrame) -> DataFrame:
    """key, doc_id, pos, line, id of each line with a word; id names lines that are equal but for case and outer white space."""
    lines = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "_raw"))
    # trimming copies a line however little it cuts, so it is for lines that need it
    blank = (" ", "\t", "\r", "\x0b", "\x0c")
    line = F.when(F.left("_raw", F.lit(1)).isin(*blank) | F.right("_raw", F.lit(1)).isin(*blank), F.btrim("_raw", F.lit("".join(blank)))).otherwise(F.col("_raw"))
    return lines.select("key", "doc_id", "pos", F.lower(line).alias("line")).where(F.col("line") != "").withColumn("id", F.xxhash64("line"))


def signatures(lines: DataFrame, k: int = SHINGLE) -> DataFrame:
    """id and m0, m1, ...: for each line the least value of each hash over its shingles. lines: id, line; ids may repeat."""
    least = [F.min(F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(p)) for j in range(STEP)])).alias(f"m{i}") for i, p in enumerate(_POINTS)]
    return _stretches(lines, ["id"], "line", k, STEP).groupBy("id").agg(*least)


def bands() -> Column:
    """Names of a signature's bands."""
    return F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{(b + d) % HASHES}") for d in _BAND]) for b in range(HASHES)])


def shingle_set(line: Column, k: int = SHINGLE) -> Column:
    """The distinct shingles of a line, as hashes; transform over a one-element array binds the encoded line once for all."""
    cut_at = lambda u: F.sequence(F.lit(1), F.greatest(F.octet_length(u) - 2 * k + 1, F.lit(1)), F.lit(2))
    every = F.transform(F.array(F.encode(line, "UTF-16BE")), lambda u: F.transform(cut_at(u), lambda i: F.xxhash64(F.substring(u, i, F.lit(2 * k)))))
    return F.array_distinct(every[0])


def line_dedup(docs: DataFrame, *, k: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """docs' columns with n_lines, n_removed, removed (places of lines, from 0) and kept_text, for every row of docs.

    A component of alike lines keeps its first line: that of the smallest doc_id (null before all), then key, then place.
    Lines without a word are kept and not compared; null and empty texts stay as they are. Rows that repeat doc_id and
    text are one document. An empty table gives no rows. A document may lose all its lines and is returned all the same.
    Columns of docs that are named like one of the four give way to it.
    """
    found = stored(occurrences(docs))
    places = found.drop("line")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # each task signs its lines where it reads them; signatures of equal lines are equal, and the texts stay
    banded = signatures(found.select("id", "line"), k).select("id", F.explode(bands()).alias("bucket")).repartition(parts, "bucket")
    shared = banded.groupBy("bucket").agg(F.min("id").alias("_first"), F.max("id").alias("_last")).where(F.col("_first") != F.col("_last")).select("bucket")
    members = stored(banded.join(shared.hint("shuffle_hash"), "bucket").select("bucket", "id"))

    # the texts of candidates alone, once; a pair's sets are made where its lines meet, as they are larger than these
    ids = cut(members.select("id").distinct())
    lines = stored(found.select("id", "line").join(broadcast_if_small(ids, 500_000), "id", "left_semi").groupBy("id").agg(F.first("line").alias("line")))

    def facts(of: DataFrame) -> DataFrame:
        shingles = lines.join(of, "id").select("id", F.explode(shingle_set(F.col("line"), k)).alias("t"))
        return shingles.groupBy("id").agg(F.count(F.lit(1)).alias("size"), *sketch(F.col("t")))

    def sets(pairs: DataFrame) -> DataFrame:
        left, right = lines.select(F.col("id").alias("a"), F.col("line").alias("_x")), lines.select(F.col("id").alias("b"), F.col("line").alias("_y"))
        both = F.struct(shingle_set(F.col("_x"), k).alias("x"), shingle_set(F.col("_y"), k).alias("y"))
        return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", F.array(both).alias("s"))

    def verify(pairs: DataFrame) -> DataFrame:
        shared = F.transform("s", lambda s: F.struct(F.size(s["x"]).alias("m"), F.size(s["y"]).alias("n"), F.size(F.array_intersect(s["x"], s["y"])).alias("both")))
        similar = F.exists(shared, lambda c: 100 * c["both"] >= least * (c["m"] + c["n"] - c["both"]))
        return sets(pairs).where(similar).select("a", "b")

    def diffs(pairs: DataFrame) -> DataFrame:
        apart = F.transform("s", lambda s: F.struct(F.size(s["y"]).cast("long").alias("size"), F.concat(F.array_except(s["x"], s["y"]), F.array_except(s["y"], s["x"])).alias("t")))
        rows = sets(pairs).select("a", "b", F.explode(apart).alias("d"))
        return rows.select("a", "b", "d.size", F.explode("d.t").alias("token"))

    groups = linked(members, facts, verify, diffs, least)
    place = F.struct("doc_id", "key", "pos")
    firsts = places.groupBy("id").agg(F.min(place).alias("first"), F.max(place).alias("_last"))
    named = firsts.join(groups, "id", "left").withColumn("_c", F.coalesce("component", "id"))
    heads = named.groupBy("_c").agg(F.min("first").alias("head"), F.count(F.lit(1)).alias("_n"), F.max("_last").alias("_l")).where((F.col("_n") > 1) | (F.col("head") != F.col("_l")))
    by_id = cut(named.select("id", "_c").join(heads, "_c").select("id", F.col("head.key").alias("_k"), F.col("head.pos").alias("_p")))
    gone = cut(
        places.select("id", "key", "pos")
        .join(by_id, "id")
        .where(~((F.col("key") == F.col("_k")) & (F.col("pos") == F.col("_p"))))
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("pos")).alias("removed"))
    )
    new = ("n_lines", "n_removed", "removed", "kept_text")
    old = [c for c in docs.columns if c not in new]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in old]).alias("_doc"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return (
        rows.join(broadcast_if_light(gone, 40 + 4 * F.size("removed")), "key", "left")
        .withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
        .withColumn("_lines", F.split("_doc.text", "\n"))
        .select(
            "_doc.*",
            F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.size("removed").cast("long").alias("n_removed"),
            "removed",
            F.when(F.size("removed") == 0, F.col("_doc.text")).otherwise(F.array_join(_without("_lines", "removed"), "\n")).alias("kept_text"),
        )
    )


def _without(lines: str, places: str) -> Column:
    """The lines at other places; transform over a one-element array binds them once for all."""
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    return F.transform(F.array(F.col(lines)), lambda ls: F.transform(rest, lambda i: F.get(ls, i)))[0]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "removed", "kept_text")
