"""Source divergence audit: how far each source's terms stray from those of the other sources of its language.

Sort-based: each task sorts the terms of its documents by (term, language, source, document) and a run-length scan gives
document frequencies and counts; a document never leaves its task, so what travels is one row for each term and source of a
task. These are repartitioned by term and language and sorted within the partitions, where a second run-length scan, over a
stream that holds one term at a time, sums them and keeps the terms of enough documents. A third scan over the kept runs
emits partial sums for pairs of sources, one row a task and pair, and the terms that a source uses more than its language.

Pairs need not meet in terms that neither source has: all of these have the same two values, whose share is known from
the number of kept terms. All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import read_table, stored, top_ranked
from varloom.llm.wordscan import byte_class, chunks, find_words

LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A))
#: Documents of its language that a kept term stands in, the whole that parts are of, and the terms of a source that are told.
LEAST_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
#: Rows that a task gathers before it sends them on, groups (language, source) whose sums are broadcast together, and cells of a matrix.
GATHER, MOST_GROUPS, CELLS = 600_000, 2000, 1 << 20


def _partial(docs: DataFrame) -> DataFrame:
    """lang, source, term, df, n: documents and occurrences, one row or a few from each task."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        parts: list[pa.Table] = []
        held = 0

        def summed() -> pa.Table:
            return pa.concat_tables(parts).group_by(["g", "term"], use_threads=False).aggregate([("df", "sum"), ("n", "sum")]).rename_columns(["g", "term", "df", "n"])

        def told(table: pa.Table) -> Iterator[pa.RecordBatch]:
            lang, source = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
            g = table["g"]
            columns = [lang.take(g.combine_chunks()), source.take(g.combine_chunks()), table["term"].cast(pa.string()), table["df"], table["n"]]
            yield from pa.table(columns, schema=schema).to_batches(max_chunksize=50_000)

        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            group = np.array([names.setdefault((a or "", b or ""), len(names)) for a, b in pairs], dtype=np.int64)
            rank = np.empty(len(group), dtype=np.int64)
            rank[np.argsort(group, kind="stable")] = np.arange(len(group))  # documents by group
            by_rank = np.sort(group)
            for first, data, at in chunks(batch.column("text"), 3 << 20):
                words = find_words(data, at, LETTERS, first)
                if not len(words):
                    continue
                terms = words.strings().dictionary_encode()
                key = terms.indices.to_numpy().astype(np.int64) * len(group) + rank[words.text]
                key, n = np.unique(key, return_counts=True)  # sorted by term, group, document
                term, g = key // len(group), by_rank[key % len(group)]
                begin = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (g[1:] != g[:-1])]))
                df = np.diff(np.append(begin, len(term)))
                parts.append(pa.table({"g": g[begin], "term": terms.dictionary.take(pa.array(term[begin])), "df": df, "n": np.add.reduceat(n, begin)}))
                held += len(begin)
                if held > GATHER:
                    parts = [summed()]
                    held = parts[0].num_rows
                    pa.default_memory_pool().release_unused()
                    if 2 * held > GATHER:
                        yield from told(parts[0])
                        parts, held = [], 0
        if parts:
            yield from told(summed())

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, df long, n long")


def _kept_runs(partial: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, sources, counts: a row for each kept term of a language."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def begins(table: pa.Table, names: list[str]) -> np.ndarray:
            new = np.zeros(table.num_rows, dtype=bool)
            new[0] = True
            for name in names:
                column = table[name].combine_chunks()
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            return np.flatnonzero(new)

        def scan(table: pa.Table) -> pa.RecordBatch:
            at = begins(table, ["term", "lang", "source"])
            df, n = (np.add.reduceat(table[c].to_numpy(), at) for c in ("df", "n"))
            table = table.take(pa.array(at))
            runs = begins(table, ["term", "lang"])
            keep = np.add.reduceat(df, runs) >= least_docs
            length = np.diff(np.append(runs, len(at)))
            rows = np.flatnonzero(np.repeat(keep, length))
            offsets = pa.array(np.concatenate([[0], np.cumsum(length[keep])]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (table["source"].combine_chunks().take(pa.array(rows)), pa.array(n[rows]))]
            heads = pa.array(runs[keep])
            return pa.record_batch([table["lang"].combine_chunks().take(heads), table["term"].combine_chunks().take(heads), *lists], schema=schema)

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            last = int(begins(table, ["term", "lang"])[-1])
            if last:
                yield scan(table.slice(0, last).combine_chunks())
            # a term's rows are summed by source before more come
            rest = table.slice(last).combine_chunks()
            at = begins(rest, ["source"])
            rest = rest.take(pa.array(at)).set_column(3, "df", pa.array(np.add.reduceat(rest["df"].to_numpy(), at))).set_column(4, "n", pa.array(np.add.reduceat(rest["n"].to_numpy(), at)))
        if rest is not None:
            yield scan(rest)

    # the term comes first, as its first bytes decide most comparisons
    dealt = partial.select("term", "lang", "source", "df", "n").repartition("term", "lang").sortWithinPartitions("term", "lang", "source")
    return dealt.mapInArrow(run, "lang string, term string, sources array<string>, counts array<long>")


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """floor(SCALE * count / total) for 0 <= count <= total < 9e15, three digits at a time, so that nothing passes 64 bits."""
    out, rest = np.zeros(np.broadcast(count, total).shape, dtype=np.int64), np.asarray(count, dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        digits = rest // total
        out, rest = out * 1000 + digits, rest - digits * total
    return out


def _f(p, q):
    d = p - q
    return d * d // q


def _scan(runs: DataFrame, own: list, other: list, terms: bool) -> DataFrame:
    """lang, source, part, item, value. pair: what the runs with source or item in them add to the sum of the two's values in
    runs with neither; source is of own, item of other. term: of the sources of own, if asked for.

    own and other: rows of _groups, MOST_GROUPS each at most.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def by_lang(groups: list) -> dict:
        out: dict = {}
        for lang, source, n, v, lang_n in groups:
            out.setdefault(lang, []).append((source, n, v, lang_n))
        return out

    sides = by_lang(own), by_lang(other)

    class Side:
        def __init__(self, groups: list) -> None:
            self.names = [g[0] for g in groups]
            self.total = np.array([g[1] + g[2] for g in groups], dtype=np.int64)
            self.none = 1 + share(np.ones(len(groups), dtype=np.int64), self.total)
            self.index = pa.array(self.names, pa.string())

        def values(self, rows: int, row: np.ndarray, source: pa.Array, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The sources' values in each run, and which of them are in it."""
            at = pc.fill_null(pc.index_in(source, self.index), -1).to_numpy(zero_copy_only=False)
            ok = at >= 0
            p, held = np.tile(self.none, (rows, 1)), np.zeros((rows, len(self.names)), dtype=bool)
            p[row[ok], at[ok]] = 1 + share(count[ok] + 1, self.total[at[ok]])
            held[row[ok], at[ok]] = True
            return p, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                if lang not in sides[0] or lang not in sides[1]:
                    continue
                if lang not in known:
                    a, b = Side(sides[0][lang]), Side(sides[1][lang])
                    known[lang] = a, b, _f(a.none[:, None], b.none[None, :]), np.zeros((len(a.names), len(b.names)), dtype=np.int64)
                a, b, neither, sums = known[lang]
                all_rows = np.flatnonzero(codes == code)
                step = max(1, CELLS // max(len(a.names), len(b.names)))
                for i in range(0, len(all_rows), step):
                    rows = batch.take(pa.array(all_rows[i : i + step]))
                    sources, counts = rows.column("sources"), rows.column("counts")
                    row = pc.list_parent_indices(sources).to_numpy()
                    source, count = pc.list_flatten(sources), pc.list_flatten(counts).to_numpy()
                    pa_, in_a = a.values(len(rows), row, source, count)
                    pb, in_b = b.values(len(rows), row, source, count)
                    for x in np.flatnonzero(in_a.any(0)):
                        r = np.flatnonzero(in_a[:, x])
                        sums[x] += _f(pa_[r, x][:, None], pb[r]).sum(0) - len(r) * neither[x]
                    for y in np.flatnonzero(in_b.any(0)):
                        r = np.flatnonzero(in_b[:, y])
                        sums[:, y] += ((_f(a.none[None, :], pb[r, y][:, None]) - neither[:, y][None, :]) * ~in_a[r]).sum(0)
                    if terms:
                        _, _, v, lang_n = sides[0][lang][0]
                        q = 1 + share(np.add.reduceat(count, np.flatnonzero(np.diff(row, prepend=-1))) + 1, lang_n + v)
                        r, x = np.nonzero(in_a & (pa_ > q[:, None]))
                        if len(r):
                            told = [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(r), dtype=np.int64))), a.index.take(pa.array(x)), pa.array(["term"] * len(r)), rows.column("term").take(pa.array(r)), pa.array(_f(pa_[r, x], q[r]))]
                            yield pa.record_batch(told, schema=schema)
        for lang, (a, b, _, sums) in known.items():
            x, y = np.nonzero(sums)
            if len(x):
                told = [pa.array([lang] * len(x), pa.string()), a.index.take(pa.array(x)), pa.array(["pair"] * len(x)), b.index.take(pa.array(y)), pa.array(sums[x, y])]
                yield from pa.Table.from_batches([pa.record_batch(told, schema=schema)]).to_batches(max_chunksize=50_000)

    return runs.mapInArrow(run, "lang string, source string, part string, item string, value long")


def _groups(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """lang, source, n, v, lang_n: a source's occurrences of kept terms, and how many its language keeps and has of them."""
    every = docs.select("lang", "source").distinct()
    counted = runs.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    langs = runs.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("lang_n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.join(counted, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("n"), zero("v"), zero("lang_n"))


def _blocks(groups: DataFrame, most: int) -> Iterator[tuple[Column, list, list, bool]]:
    """What to scan together: which runs, groups in the place of the source and of the item, and whether they are the same.

    Few groups are one block. More are dealt by language, and a language of more sources than fit by source, too.
    """
    n = groups.count()
    if n <= most:
        rows = [tuple(r) for r in groups.collect()]
        yield F.lit(True), rows, rows, True
        return
    deal = lambda parts: F.pmod(F.xxhash64("lang"), F.lit(parts))
    parts = 2 * n // most + 1
    for part, size in sorted(tuple(r) for r in groups.groupBy(deal(parts)).count().collect()):
        here = groups.where(deal(parts) == part)
        cuts = 1 if size <= most else 2 * size // most + 1
        piece = lambda i: [tuple(r) for r in here.where(F.pmod(F.xxhash64("source"), F.lit(cuts)) == i).collect()]  # noqa: B023, E731
        for i in range(cuts):
            own = piece(i)
            for j in range(cuts):
                yield deal(parts) == part, own, own if i == j else piece(j), i == j


def source_divergence(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP, most_groups: int = MOST_GROUPS) -> DataFrame:
    """lang, source, part, item, value, rank: see the module. part pair: item is each other source of the language, value the
    sum over all kept terms, all ranks; part term: item is a term that the source has more of than its language, `top` ranks.

    Each row of docs is a document, rows with a repeated doc_id too. Null text, lang and source are read as ''. Groups without
    terms, and without any text, take part with counts of 0; a language without kept terms has pairs of value 0. Ties go to the
    smaller item in UTF-8. Texts of any length are read whole; other columns of docs are ignored; an empty table gives no rows.
    Occurrences of kept terms in a language may be 9e15 at most.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = stored(_kept_runs(_partial(named), least_docs))
    groups = stored(_groups(named, runs))
    found = None
    for which, own, other, same in _blocks(groups, most_groups):
        part = _scan(runs.where(which), own, other, same)
        found = part if found is None else found.union(part)
    found = stored(found)
    none = F.expr("1 + 1000000000 div (n + v)").alias("p")
    side = lambda name: groups.where("v > 0").select("lang", F.col("source").alias(name), "v", none)
    a, b = side("source").alias("a"), side("item").drop("v").alias("b")
    apart = F.expr("v * ((a.p - b.p) * (a.p - b.p) div b.p)")
    both = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("source") != F.col("item"))).select("a.lang", "source", "item", apart.alias("value"))
    bare = groups.where("v = 0").select("lang", "source")
    both = both.union(bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source != item").select("lang", "source", "item", F.lit(0).cast("long")))
    pairs = both.union(found.where("part = 'pair' AND source != item").select("lang", "source", "item", "value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = [F.desc("value"), F.asc("item")]
    ranked = top_ranked(pairs, ["lang", "source"], order).withColumn("part", F.lit("pair"))
    terms = top_ranked(found.where("part = 'term'").select("lang", "source", "item", "value"), ["lang", "source"], order, top).withColumn("part", F.lit("term"))
    return ranked.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(df) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN (c SEMI JOIN k USING (lang, term)) c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, 1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (gn.n + v.v) AS p,
  1 + {SCALE}::HUGEINT * (k.n::HUGEINT + 1) // (v.n + v.v) AS q
  FROM gn JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
tm AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
