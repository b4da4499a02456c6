"""Benchmark decontamination: windows of benchmark words in training texts, found by a broadcast set of hashes and verified.

The benchmark's n-grams go to every task as sorted hashes with the items' words beside them; a text's windows are hashed in
bulk, looked up, and compared word by word where they hit. A benchmark of more than BLOCK bytes is dealt into blocks of that
size, each broadcast on its own and dropped again. Texts never shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import read_table, stored
from varloom.llm.shingles import mix
from varloom.llm.wordscan import byte_class, chunks, find_words

#: Words of a window, and bytes of benchmark texts that are broadcast together.
WINDOW, BLOCK = 10, 16 << 20
#: A word is made of digits, letters and what is beyond ASCII.
LETTERS = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_U = np.uint64
_BASE = 0xA0761D6478BD642F
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
#: Buckets of the first look at a hash.
_BITS = 22


def _upto(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 20), base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


class _Sums:
    """Hashes of all windows of a sequence of words."""

    def __init__(self, w: np.ndarray) -> None:
        self.power, self.unpower = _upto(len(w) + 1)
        self.sums = np.zeros(len(w) + 1, dtype=np.uint64)
        np.cumsum(w * self.power[: len(w)], out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.unpower[:n] + _U(length)) if n > 0 else np.zeros(0, dtype=np.uint64)


class Needles:
    """The windows of a block of benchmark items. ids: what names the items, any values."""

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW) -> None:
        self.ids, self.window = ids, window
        self.letters: list[np.ndarray] = []
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        offsets, base, first_word = [np.zeros(1, dtype=np.int64)], 0, 0
        for first, data, at in chunks(pa.array(texts, pa.large_string())):
            words = find_words(data, at, LETTERS, first)
            if not len(words):
                continue
            self.letters.append(words.letters)
            offsets.append(words.offsets[1:] + base)
            base += int(words.offsets[-1])
            sums = _Sums(words.hashes())
            items, begin, count = np.unique(words.text, return_index=True, return_counts=True)
            length = np.minimum(count, window)
            for size in np.unique(length):
                of, b, c = (x[length == size] for x in (items, begin, count))
                n = c - size + 1
                place = np.repeat(b - np.cumsum(n) + n, n) + np.arange(n.sum())
                found.setdefault(int(size), []).append((sums.windows(int(size))[place], np.repeat(of, n), place + first_word))
            first_word += len(words)
        self.offsets = np.concatenate(offsets)
        self.letters = np.concatenate(self.letters) if self.letters else np.zeros(0, dtype=np.uint8)
        #: length of a window -> sorted hashes, items and first words
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, parts in found.items():
            h, of, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.by_size[size] = h[order], of[order], place[order]

    def filters(self) -> dict[int, np.ndarray]:
        out = {}
        for size, (h, _, _) in self.by_size.items():
            out[size] = np.zeros(1 << _BITS, dtype=bool)
            out[size][h >> _U(64 - _BITS)] = True
        return out

    def hits(self, words, filters: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, first words and items of the windows that stand in a text, by the words themselves."""
        if not self.by_size or not len(words):
            return
        sums = _Sums(words.hashes())
        for size, (h, of, place) in self.by_size.items():
            w = sums.windows(size)
            may = np.flatnonzero(filters[size][w >> _U(64 - _BITS)])
            may = may[words.text[may] == words.text[may + size - 1]]
            low, high = np.searchsorted(h, w[may], side="left"), np.searchsorted(h, w[may], side="right")
            n = high - low
            if not n.sum():
                continue
            at = np.repeat(may, n)
            which = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            same = self._same(words, at, place[which], size)
            yield size, at[same], of[which[same]]

    def _same(self, words, at: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        ok = np.ones(len(at), dtype=bool)
        for k in range(size):
            a, b = at + k, place + k
            ok &= words.offsets[a + 1] - words.offsets[a] == self.offsets[b + 1] - self.offsets[b]
        for i in np.flatnonzero(ok):  # few: hashes agree
            for k in range(size):
                a, b = at[i] + k, place[i] + k
                if not np.array_equal(words.letters[words.offsets[a] : words.offsets[a + 1]], self.letters[self.offsets[b] : self.offsets[b + 1]]):
                    ok[i] = False
                    break
        return ok


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) of the runs of sorted distinct numbers."""
    new = np.flatnonzero(np.diff(words) != 1) + 1
    return words[np.concatenate([[0], new])], words[np.concatenate([new - 1, [len(words) - 1]])] + 1


def _blocks(benchmark: DataFrame, most: int) -> Iterator[DataFrame]:
    """The benchmark in parts of about `most` bytes, dealt by hash; an item stays whole."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // most + 1
    for i in range(parts):
        yield benchmark if parts == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """docs' columns with n_words, n_hit, items (array of strings, sorted as strings) and spans: the runs of hit words, as places of bytes in the UTF-8
    text, [begin, end), that include what stands between the words of one run.

    A window is `window` consecutive words of an item, of an item with fewer, but not none, all of them; a word inside any
    occurrence of one is hit. Null and empty texts and texts without words have no hits; so have all where the benchmark is
    empty. Items with a null item_id are named ''. Items that share an item_id count as one, and a window of several items
    counts for all. Rows of docs may repeat and are each looked at; texts of any length are read whole. Columns of docs that
    are named like the new ones give way.
    """
    new = ("n_words", "n_hit", "items", "spans")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<begin:long,end:long>>").alias("spans"))
    kind = rows.schema
    parts = list(_blocks(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"), block))
    for i, part in enumerate(parts):
        items = part.collect()  # of a block
        shared = docs.sparkSession.sparkContext.broadcast(Needles([r["item_id"] for r in items], [r["text"] for r in items], window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            needles: Needles = shared.value
            filters = needles.filters()
            for batch in batches:
                names = batch.schema.names
                n_words, n_hit = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
                items, spans = batch.column(names.index("items")).to_pylist(), batch.column(names.index("spans")).to_pylist()
                for first, data, at in chunks(batch.column(names.index("text"))):
                    words = find_words(data, at, LETTERS, first)
                    n_words[first : first + len(at) - 1] = np.bincount(words.text - first, minlength=len(at) - 1)
                    hit = [(np.repeat(a, size) + np.tile(np.arange(size), len(a)), words.text[a], of) for size, a, of in needles.hits(words, filters)]
                    old = [j for j in range(first, first + len(at) - 1) if spans[j]]
                    if not hit and not old:
                        continue
                    mark = np.zeros(len(words), dtype=bool)
                    for j in old:  # by earlier blocks
                        begin = np.searchsorted(words.text, j)
                        own = words.starts[begin : begin + n_words[j]] - at[j - first]
                        for s in spans[j]:
                            mark[begin + np.searchsorted(own, s["begin"]) : begin + np.searchsorted(own, s["end"])] = True
                    for placed, text, of in hit:
                        mark[placed] = True
                        for j, item in set(zip(text.tolist(), of.tolist(), strict=True)):
                            items[j].append(needles.ids[item])
                    marked = np.flatnonzero(mark)
                    for j, begin, count in zip(*np.unique(words.text[marked], return_index=True, return_counts=True), strict=True):
                        low, high = _runs(marked[begin : begin + count])
                        base = at[j - first]
                        spans[j] = [{"begin": int(words.starts[x] - base), "end": int(words.ends[y - 1] - base)} for x, y in zip(low, high, strict=True)]
                        n_hit[j] = count
                items = [sorted(set(x), key=lambda s: s.encode("utf-8", "surrogatepass")) if len(x) > 1 else x for x in items]
                made = {"n_words": pa.array(n_words), "n_hit": pa.array(n_hit), "items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, batch.schema.field("spans").type)}
                yield pa.record_batch([made.get(c, batch.column(k)) for k, c in enumerate(names)], names=names)

        rows = rows.mapInArrow(run, kind)
        if i + 1 < len(parts):
            rows = stored(rows)
            shared.destroy()
    return rows


def _without_spans(text: Column, spans: Column) -> Column:
    @F.pandas_udf("string")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in parts:
            out = []
            for text, gone in zip(texts, lists, strict=True):
                if text is not None and len(gone):
                    data, at, left = text.encode("utf-8", "surrogatepass"), 0, []
                    for s in gone:
                        left.append(data[at : s["begin"]])
                        at = s["end"]
                    text = b"".join([*left, data[at:]]).decode("utf-8", "surrogatepass")
                out.append(text)
            yield pd.Series(out, dtype=object)

    return cut(text, spans)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "spans", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """docs' columns, cleaned. remove "documents": only texts without a hit; "spans": all texts, each without its runs of hit words.

    What surrounds a run stays as it is, white space too. A text that is all hit becomes empty or keeps its marks. Edge rows as
    in find_contamination; columns of docs named like its new ones are kept here.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    found = find_contamination(held, benchmark, window=window, block=block)
    if remove == "documents":
        return found.where("n_hit = 0").select("_doc.*")
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(_without_spans(F.col("text"), F.col("spans")))
    return found.select("_doc", clean.alias("_clean")).select(*[F.col("_clean").alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS w FROM benchmark),
needles AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), {WINDOW}) - 1) AS k FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(k) AS n FROM needles),
windows AS (SELECT r, n, i, list_slice(w, i, i + n - 1) AS k FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n)),
found AS (SELECT r, i, n, item_id FROM windows JOIN needles USING (k)),
places AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS i FROM found),
h AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)
"""
