"""Quality rules with thresholds that follow the data: quantile sketches per language and source, then filtering.

A sketch is a histogram over buckets of growing width (DDSketch): a bucket's values differ by at most a factor GAMMA, and
sketches merge by adding counts, so a hot language or source is summed in part on every task, results are the same on
every run, and small groups borrow their language's sketch or the whole corpus's. All expressions are built in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import WORD, cut, read_table, words

#: Values of one bucket are within this factor.
GAMMA = 1.02
#: A group's own sketch counts from so many texts on.
LEAST_TEXTS = 100
#: A value is out of bounds beyond its group's quartile by so many times the distance between quartiles, or the metric's
#: least spread, if that is more: (metric, side, least spread). Groups that hardly vary keep ordinary texts.
FENCE = 3.0
RULES = (
    ("symbol_ratio", "high", 0.03),
    ("dup_line_ratio", "high", 0.1),
    ("repeat_ratio", "high", 0.07),
    ("mean_chars", "high", 1.0),
    ("mean_chars", "low", 1.0),
)
WINDOW = 5


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """How many of the words lie in a run of `window` words that the text holds twice or more.

    Sorts the runs' hashes with their places; a run that equals a neighbour is repeated. The repeated runs, in order of
    place, cover `window` words each, less what the next one covers too.
    """
    # transform over a one-element array binds a value once; a column named twice would be computed for each element
    bind = lambda value, use: F.transform(F.array(value), use)[0]

    def runs(ws: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(1), F.size(ws) - window + 1), lambda i: F.xxhash64(F.slice(ws, i, window))))

    def places(ws: Column) -> Column:
        found = F.transform(
            F.sequence(F.lit(1), F.size(ws) - window + 1), lambda i: F.struct(F.xxhash64(F.slice(ws, i, window)).alias("h"), i.alias("i"))
        )

        def kept(s: Column) -> Column:
            same = F.filter(
                s,
                lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"]),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        return bind(F.sort_array(found), kept)

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def counted(ws: Column) -> Column:
        twice = bind(runs(ws), lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda k: F.get(s, k) == F.get(s, k - 1)))
        some = bind(places(ws), covered)
        return F.when(F.size(ws) <= window, 0).when(twice, some).otherwise(0)

    return bind(w, counted).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """docs' doc_id, lang, source with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda line: line.rlike(WORD)
    lines = F.filter(F.split(text, "\n"), has_word)
    return (
        docs.select("doc_id", "lang", "source", text.alias("_t"), words(text).alias("_w"), lines.alias("_l"))
        .select(
            "doc_id",
            "lang",
            "source",
            F.size("_w").cast("long").alias("n_words"),
            F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
            F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            F.size("_l").cast("long").alias("n_lines"),
            repeated_words(F.col("_w")).alias("n_repeat_words"),
        )
    )


def metrics() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbol_ratio": per("n_symbols", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "repeat_ratio": per("n_repeat_words", "n_words"),
        "mean_chars": per("word_chars", "n_words"),
    }


def bucket(x: Column, gamma: float = GAMMA) -> Column:
    """A value's bucket; values up to 1e-9 share one."""
    return F.when(x > 1e-9, F.ceil(F.ln(x) / F.lit(float(_ln(gamma))))).otherwise(F.lit(-100000)).cast("int")


def _ln(x: float) -> float:
    import math

    return math.log(x)


def sketches(rows: DataFrame, group: list[str], gamma: float = GAMMA) -> DataFrame:
    """group, metric, bucket, n over rows that hold the metrics; merge with merged()."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.col(m), gamma).alias("bucket")) for m in metrics()]))
    return rows.select(*group, values.alias("_v")).groupBy(*group, F.col("_v.metric").alias("metric"), F.col("_v.bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, group: list[str]) -> DataFrame:
    return sketch.groupBy(*group, "metric", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, group: list[str], gamma: float = GAMMA) -> DataFrame:
    """group, metric, texts, q1, q3: the middle of the bucket in which the quartile lies."""
    own = [*group, "metric"]
    along = Window.partitionBy(*own).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.when(F.col("bucket") == -100000, 0.0).otherwise(F.pow(F.lit(gamma), F.col("bucket")) * (2 / (1 + gamma)))
    at = lambda q: F.min(F.when(F.col("_upto") >= q * F.col("_all"), middle))
    return (
        sketch.withColumn("_upto", F.sum("n").over(along))
        .withColumn("_all", F.sum("n").over(Window.partitionBy(*own)))
        .groupBy(*own)
        .agg(F.sum("n").alias("texts"), at(0.25).alias("q1"), at(0.75).alias("q3"))
    )


def thresholds(rows: DataFrame, gamma: float = GAMMA, least: int = LEAST_TEXTS) -> DataFrame:
    """lang, source and one bound per rule: from the group's own sketch, its language's below `least` texts, or the corpus's."""
    by_both = sketches(rows, ["lang", "source"], gamma)
    by_lang = merged(by_both, ["lang"])
    own = quartiles(by_both, ["lang", "source"], gamma)
    lang = quartiles(by_lang, ["lang"], gamma).select(F.col("lang").alias("_lang"), F.col("metric").alias("_m1"), F.col("texts").alias("_t1"), F.col("q1").alias("_a1"), F.col("q3").alias("_b1"))
    every = quartiles(merged(by_lang, []), [], gamma).select(F.col("metric").alias("_m2"), F.col("q1").alias("_a2"), F.col("q3").alias("_b2"))
    joined = own.join(lang, own.lang.eqNullSafe(F.col("_lang")) & (own.metric == F.col("_m1"))).join(every, own.metric == F.col("_m2"))
    pick = lambda a, b, c: F.when(F.col("texts") >= least, F.col(a)).when(F.col("_t1") >= least, F.col(b)).otherwise(F.col(c))
    q1, q3 = pick("q1", "_a1", "_a2"), pick("q3", "_b1", "_b2")
    bounds = []
    for metric, side, least_spread in RULES:
        spread = FENCE * F.greatest(q3 - q1, F.lit(least_spread))
        fence = q3 + spread if side == "high" else q1 - spread
        bounds.append(F.max(F.when(F.col("metric") == metric, fence)).alias(f"{metric}_{side}"))
    return joined.groupBy("lang", "source").agg(*bounds)


def quality_rules(docs: DataFrame, *, gamma: float = GAMMA, least: int = LEAST_TEXTS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and the metrics, per row of docs.

    base_failed: under 10 words, or over a fifth of the words in repeated runs. Other texts stay unless a metric is out of
    its group's bounds; the sketches are of those other texts. Null and empty texts have no words and fail; null
    languages and sources are groups of their own; repeated rows count each; an empty table gives no rows.
    """
    rows = text_counts(docs).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = cut(rows.withColumns(metrics()))
    limits = thresholds(rows.where(~F.col("base_failed")), gamma, least)
    limits = limits.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    inside = F.lit(True)
    for metric, side, _ in RULES:
        bound = F.col(f"{metric}_{side}")
        inside = inside & (F.col(metric) <= bound if side == "high" else F.col(metric) >= bound)
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(limits, on, "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))).drop("_lang", "_source")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _oracle() -> str:
    c = repr(_ln(GAMMA))
    quart = lambda src, by, t: f"""(SELECT {by} metric, sum(n) AS texts,
      min(CASE WHEN upto >= 0.25::DOUBLE * every THEN mid END) AS q1, min(CASE WHEN upto >= 0.75::DOUBLE * every THEN mid END) AS q3
      FROM (SELECT *, sum(n) OVER (PARTITION BY {by} metric ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {by} metric) AS every,
        CASE WHEN bucket = -100000 THEN 0.0::DOUBLE ELSE pow({GAMMA}::DOUBLE, bucket) * {2 / (1 + GAMMA)!r}::DOUBLE END AS mid FROM {src}) GROUP BY {by} metric) {t}"""  # noqa: E731
    bound = []
    for metric, side, least in RULES:
        spread = f"{FENCE}::DOUBLE * greatest(q3 - q1, {least}::DOUBLE)"
        bound.append(f"max(CASE WHEN metric = '{metric}' THEN {'q3 + ' if side == 'high' else 'q1 - '}{spread} END) AS {metric}_{side}")
    inside = " AND ".join(f"{m} {'<=' if side == 'high' else '>='} {m}_{side}" for m, side, _ in RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
runs AS (SELECT r, i, list_slice(w, i, i + {WINDOW - 1}) AS k FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM runs) WHERE c > 1),
rep AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
c AS (SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rep USING (r)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbol_ratio, CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_ratio,
  CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_ratio, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_chars FROM c),
v AS (SELECT lang, source, metric, CASE WHEN x > 1e-9 THEN ceil(ln(x) / {c}::DOUBLE)::INT ELSE -100000 END AS bucket FROM (
  {" UNION ALL ".join(f"SELECT lang, source, '{k}' AS metric, {k} AS x FROM m WHERE NOT base_failed" for k in ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "mean_chars"))})),
s2 AS (SELECT lang, source, metric, bucket, count(*) AS n FROM v GROUP BY ALL),
s1 AS (SELECT lang, metric, bucket, sum(n) AS n FROM s2 GROUP BY ALL),
s0 AS (SELECT metric, bucket, sum(n) AS n FROM s1 GROUP BY ALL),
q AS (SELECT a.lang, a.source, a.metric,
  CASE WHEN a.texts >= {LEAST_TEXTS} THEN a.q1 WHEN b.texts >= {LEAST_TEXTS} THEN b.q1 ELSE e.q1 END AS q1,
  CASE WHEN a.texts >= {LEAST_TEXTS} THEN a.q3 WHEN b.texts >= {LEAST_TEXTS} THEN b.q3 ELSE e.q3 END AS q3
  FROM {quart("s2", "lang, source,", "a")} JOIN {quart("s1", "lang,", "b")} ON a.lang IS NOT DISTINCT FROM b.lang AND a.metric = b.metric
  JOIN {quart("s0", "", "e")} ON a.metric = e.metric),
lim AS (SELECT lang, source, {", ".join(bound)} FROM q GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({inside}, true) AS kept
FROM m LEFT JOIN lim ON m.lang IS NOT DISTINCT FROM lim.lang AND m.source IS NOT DISTINCT FROM lim.source
"""


ORACLE = _oracle()
