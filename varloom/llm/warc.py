"""WARC archives on Spark: writing pages as records, and reading records back by boundary-chain verification.

Writing is a text write of whole records. Reading lets Spark split the files wherever the magic stands, also inside
payloads: each task turns its stretches into candidates that name their own place and their successor's. Which candidates
are records is then decided by reachability from the start of the file: within one stretch of a file a task follows the
chain to where it leaves the stretch, and pointer jumping over these few exits finds the true entry of every stretch.
A magic inside a payload is never reached.
"""

from __future__ import annotations

import uuid
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import broadcast_if_small, cut, read_table, shared_folder, stored

MAGIC = "WARC/1.0\r\n"
SIZE = len(MAGIC)
#: A header is looked for in so many bytes after its magic first, and if it doesn't end there in all of them.
HEADER = 1 << 16
#: Pieces of records that hold magics find them by bins of so many bytes.
BIN = 1 << 20
#: Bytes of a payload from which on an equal one is written as revisit.
LEAST_REVISIT = 0
DATE = "1970-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: each 5 hex digits are 4 digits of base 32."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, digest, refers_to for every row of pages (null html: empty).

    Of rows with equal payloads of at least `least` bytes, those with the smallest page_id are responses and refers_to is
    null; the others refer to it. Rows that repeat that page_id are responses too; a null page_id counts as the largest.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", base32_sha1(F.encode("html", "UTF-8")))
    first = cut(
        rows.where(F.octet_length("html") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select("digest", "_first")
    )
    big = F.octet_length("html") >= least
    return (
        rows.join(broadcast_if_small(first), "digest", "left")
        .withColumn("refers_to", F.when(big & F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first")))
        .select("page_id", "url", "html", "digest", "refers_to")
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write rows of plan_records as WARC 1.0 files under path. A revisit has no body; line breaks in a url become %0A."""
    target = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", "%0A")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        name("page_id"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), name("refers_to"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r"),  # the writer adds the last \n
    )
    records.select(record.alias("value")).write.option("lineSep", "\n").text(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, i, raw, n: what lies between two magics, in the order (block, i) within a file; n counts the magic after it."""
    top = F.decode(F.substring("raw", 1, HEADER), "ISO-8859-1")  # a character for a byte
    whole = F.decode("raw", "ISO-8859-1")
    end = F.coalesce(F.nullif(F.locate("\r\n\r\n", top), F.lit(0)), F.when(F.octet_length("raw") > HEADER, F.locate("\r\n\r\n", whole)), F.lit(0))
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("i"),
            F.col("value").cast("binary").alias("raw"),
        )
        .withColumn("n", (F.octet_length("raw") + SIZE).cast("long"))
        .withColumn("h", (end - 1).cast("long"))
        .withColumn("head", F.when(F.col("h") >= 0, F.expr("cast(substring(raw, 1, int(h)) as string)")))
    )


def _field(name: str) -> Column:
    value = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", F.trim(value))


def _length() -> Column:
    return F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*(\d{1,15})[ \t]*\r?$", 1).try_cast("long")


def _places(lines: DataFrame) -> DataFrame:
    """file, block, i, n, start, body, len, next of each candidate (lines must be kept, as they are read twice): where its header starts and its body, and its successor's start."""
    slim = lines.select("file", "block", "i", "n", "h", "len")
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = slim.groupBy("file", "block").agg(F.sum("n").alias("_bytes"))
    base = base.withColumn("_base", F.coalesce(F.sum("_bytes").over(along), F.lit(0))).drop("_bytes")
    inside = Window.partitionBy("file", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slim.withColumn("_off", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(base, ["file", "block"])
        .withColumn("start", F.col("_off") + F.col("_base"))
        .withColumn("body", F.col("start") + F.col("h") + 4)
        # after the body come an empty line and the successor's magic
        .withColumn("next", F.col("body") + F.col("len") + 4 + SIZE)
        .select("file", "block", "i", "n", "start", "body", "len", "next")
    )


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of one stretch, the first place of its chain that isn't a candidate of the stretch."""
    out: dict[int, int] = {}
    for start, after in sorted(zip(pdf["start"], pdf["next"], strict=True), reverse=True):
        out[start] = out.get(after, after)
    return pd.DataFrame({"file": pdf["file"].iloc[0], "block": pdf["block"].iloc[0], "start": list(out), "exit": list(out.values())})


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one stretch that the chain from its entry meets."""
    after, at, met = dict(zip(pdf["start"], pdf["next"], strict=True)), int(pdf["enter"].iloc[0]), []
    while at in after:
        met.append(at)
        at = after[at]
    return pd.DataFrame({"file": pdf["file"].iloc[0], "block": pdf["block"].iloc[0], "start": met})


def _reached(places: DataFrame) -> DataFrame:
    """file, block, start of the candidates that the chain from the start of their file reaches."""
    linked = places.where(F.col("next").isNotNull()).select("file", "block", "start", "next")
    exits = cut(linked.groupBy("file", "block").applyInPandas(_exits, "file string, block long, start long, exit long"))
    first = exits.where(F.col("start") == SIZE).select("file", "start")
    doors = exits.select("file", F.col("exit").alias("start")).union(first).distinct()
    jump = cut(exits.join(doors, ["file", "start"], "left_semi").select("file", "start", "exit"))
    reached = first
    while not jump.isEmpty():
        hop = reached.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
        reached = cut(reached.union(hop).distinct())
        again = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("_exit"))
        jump = cut(jump.join(again, ["file", "exit"]).select("file", "start", F.col("_exit").alias("exit")))
    enter = exits.join(reached, ["file", "start"], "left_semi").select("file", "block", F.col("start").alias("enter"))
    return linked.join(enter, ["file", "block"]).groupBy("file", "block").applyInPandas(_follow, "file string, block long, start long")


def read_warc(spark: SparkSession, path: str, derive: dict[str, Column] | None = None) -> DataFrame:
    """record_id, type, url, digest, refers_to, payload (binary) for each record of the WARC files under path.

    derive: columns to return in place of payload, as expressions on it; they are computed where a payload is read, so that
    payloads needn't travel to meet the places of verified records.

    Files are split by Spark's reader; records can lie across splits, and payloads can hold anything, the magic and whole
    records included. What follows a broken record in a file is left out, as nothing in it can be reached from the start.
    Empty files give no rows. Each scan is kept before it is used twice, as another one may be split in another way.
    """
    at = ["file", "block", "i"]
    names = [
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Type").alias("type"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Payload-Digest").alias("digest"),
        _field("WARC-Refers-To").alias("refers_to"),
    ]
    values = [v.alias(k) for k, v in (derive or {"payload": F.col("payload")}).items()]
    columns = ["record_id", "type", "url", "digest", "refers_to", *(derive or ["payload"])]
    lines = _lines(spark, path).withColumn("len", _length()).withColumn("payload", F.expr("substring(raw, int(h + 5), int(len))"))
    found = stored(lines.select(*at, "n", "h", "len", *names, *values))
    places = cut(_places(found))
    records = places.join(cut(_reached(places)), ["file", "block", "start"], "left_semi")
    single = F.col("n") - SIZE >= F.col("body") - F.col("start") + F.col("len")
    plain = found.join(records.where(single).select(*at), at).select(*columns)
    # A record that holds magics is in pieces: those between its start and its successor's.
    broken = cut(records.where(~single).select("file", F.col("start").alias("rec"), F.col("len").alias("blen"), F.col("next").alias("stop")))
    if broken.isEmpty():
        return plain
    again = stored(_lines(spark, path).join(broadcast_if_small(broken.select("file").distinct()), "file", "left_semi"))
    spans = broken.withColumn("bin", F.explode(F.sequence(F.floor(F.col("rec") / BIN), F.floor(F.col("stop") / BIN))))
    owned = (
        _places(again.withColumn("len", _length()))
        .select(*at, F.col("start").alias("at"), F.floor(F.col("start") / BIN).alias("bin"))
        .join(broadcast_if_small(cut(spans)), ["file", "bin"])
        .where((F.col("at") >= F.col("rec")) & (F.col("at") < F.col("stop")))
        .select(*at, "at", "rec", F.col("blen").alias("len"))
    )
    pieces = (
        again.drop("n")
        .join(owned, at)
        .groupBy("file", "rec")
        .agg(F.sort_array(F.collect_list(F.struct("at", "raw", "h", "head"))).alias("_p"), F.first("len").alias("len"))
        .withColumn("h", F.col("_p")[0]["h"])
        .withColumn("head", F.col("_p")[0]["head"])
        .withColumn("raw", F.aggregate("_p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["raw"], F.lit(MAGIC).cast("binary"))))
        .where(F.octet_length("raw") >= F.col("h") + 4 + F.col("len"))
        .withColumn("payload", F.expr("substring(raw, int(h + 5), int(len))"))
        .select(*names, *values)
    )
    return plain.unionByName(pieces)


def archive_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write pages under path, read the archives back: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Digest and length are of the payload as read: a revisit's are those of the response that it names.
    """
    write_warc(plan_records(pages), path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) AS BIGINT)")
    read = (
        read_warc(pages.sparkSession, path, {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
        .withColumn("page_id", number("record_id"))
        .withColumn("refers_to", F.when(F.col("type") == "revisit", number("refers_to")))
        .withColumn("said", F.regexp_replace("digest", "^sha1:", ""))
        .select("page_id", "url", F.col("type").alias("record_type"), "refers_to", "said", "payload_bytes", "payload_digest")
    )
    read = cut(read)
    response, revisit = read.where(F.col("record_type") == "response"), read.where(F.col("record_type") == "revisit")
    named = (
        response.join(revisit.select(F.col("refers_to").alias("page_id"), F.col("said").alias("payload_digest")).distinct(), ["page_id", "payload_digest"], "left_semi")
        .select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said"), "payload_bytes", "payload_digest")
        .distinct()
    )
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return response.select(*columns).unionByName(revisit.drop("payload_bytes", "payload_digest").join(named, ["refers_to", "said"], "left").select(*columns))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    return archive_pages(read_table(spark, sf_dir, "pages"), path)


ORACLE = """
WITH rows AS (SELECT page_id, url, sha1(coalesce(html, '')) AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
first AS (SELECT h, min(page_id) AS f FROM rows GROUP BY h)
SELECT page_id, coalesce(url, '') AS url, n::BIGINT AS payload_bytes,
  translate(list_aggregate(list_transform(range(8), lambda i: lpad(to_base(('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT, 32, 4), 4, '0')), 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f <> page_id THEN f END AS refers_to
FROM rows JOIN first USING (h)
"""
