"""Substring dedup by sliding sentence spans.

A text is cut into sentences. Every run of three sentences is a span, whatever its words, and so is a run of two that has
PAIR_WORDS words; longer runs repeat where these do. Spans are compared by hash over the whole corpus, and every sentence that
lies in a span which is not that span's first place goes. Sentences without stops are cut at words chosen by their own hash,
so that a passage is cut alike wherever it stands.

Only hashes and places are shuffled to compare spans: a hot passage is counted in part on every task, and each of its
places then meets one row, its first place.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import read_table, row_key, stored
from varloom.llm.shingles import mix, word_places

#: Sentences of a span, and words of one that has but two; 0: however few, and pairs alone cover all longer runs.
SENTENCES, PAIR_WORDS = 3, 20
#: A sentence is cut where it has so many words and the next word's hash allows it, one in CUT.
LONG, CUT = 24, 4
_U = np.uint64
#: A sentence: up to a stop with white space after it, a line's end, or the text's; its white space goes with it.
_SENTENCE = re.compile(r"[^.!?…\n]*(?:[.!?…](?![\s])[^.!?…\n]*)*(?:[.!?…]+[\"'»”)\]]*(?=\s|\Z))?\s*", re.S)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentences(text: str | None) -> list[str]:
    """The pieces of a text, which give the text again when joined."""
    out: list[str] = []
    for m in _SENTENCE.finditer(text or ""):
        if not (piece := m.group()):
            continue
        # split() knows more white space, so it never finds fewer words
        if len(piece) <= 2 * LONG or len(piece.split()) <= LONG or len(words := list(_WORD.finditer(piece))) <= LONG:
            out.append(piece)
            continue
        begin, count = 0, 0
        for w in words:
            if count >= LONG // 3 and w.start() > begin and zlib.crc32(w.group().encode("utf-8", "surrogatepass").lower()) % CUT == 0:
                out.append(piece[begin : w.start()])
                begin, count = w.start(), 0
            count += 1
        out.append(piece[begin:])
    return out


_kept = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of a base and of its inverse, and more."""
    if len(_kept[0]) < n:
        for i, base in enumerate((0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64))):
            steps = np.full(max(n, 4096), base, dtype=np.uint64)
            steps[0] = 1
            _kept[i] = np.multiply.accumulate(steps)
    return _kept


def spans(pieces: list[str], length: int = SENTENCES, pair_words: int = PAIR_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First piece, last piece and hash of each span; words count without case and white space."""
    places, w = word_places("".join(pieces))
    bounds = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in pieces])
    counts = np.bincount(np.searchsorted(bounds, places, side="right"), minlength=len(pieces))
    held = np.flatnonzero(counts)  # blank pieces belong to no span
    if not len(held):
        return held, held, np.zeros(0, dtype=np.int64)
    power, unpower = _powers(len(w) + 1)
    sums = np.zeros(len(w) + 1, dtype=np.uint64)
    np.cumsum(w * power[: len(w)], out=sums[1:])
    ends = np.cumsum(counts)[held]
    begins = ends - counts[held]
    at = np.arange(len(held))
    pair = at[:-1][ends[1:] - begins[:-1] >= pair_words]
    run = at[: max(0, len(held) - length + 1)] if pair_words else at[:0]
    first, last = np.concatenate([run, pair]), np.concatenate([run + length - 1, pair + 1])
    a, b = begins[first], ends[last]
    name = mix((sums[b] - sums[a]) * unpower[a] + (b - a).astype(np.uint64))
    return held[first], held[last], name.view(np.int64)


def find_spans(docs: DataFrame, length: int = SENTENCES, pair_words: int = PAIR_WORDS) -> DataFrame:
    """doc_id, key, first, last, hash of every span of every row of docs; rows with equal doc_id and text have one key."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for at in range(0, len(pdf), 256):
                some = pdf.iloc[at : at + 256]
                found = [spans(sentences(t), length, pair_words) for t in some["text"]]
                counts = [len(f[0]) for f in found]
                first, last, name = (np.concatenate([f[i] for f in found]) for i in range(3))
                ids = some[["doc_id", "key"]].iloc[np.repeat(np.arange(len(some)), counts)]
                yield pd.DataFrame({"doc_id": ids["doc_id"].array, "key": ids["key"].array, "first": first, "last": last, "hash": name})

    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    return rows.mapInPandas(run, "doc_id long, key long, first int, last int, hash long")


def repeated(docs: DataFrame, length: int = SENTENCES, pair_words: int = PAIR_WORDS) -> DataFrame:
    """key, first, last, of: every span that isn't the first of its hash, and the doc_id of the first.

    First: the smallest doc_id (null before all), then the smallest key, then the earliest place.
    """
    found = find_spans(docs, length, pair_words)
    place = F.struct("doc_id", "key", F.col("first"))
    # counted in part on every task; written, so that the join deals both sides anew and Spark can split a hot passage
    lead = stored(
        found.groupBy("hash")
        .agg(F.min(place).alias("lead"), F.max(place).alias("_last"))
        .where(F.col("lead") != F.col("_last"))
        .select("hash", F.col("lead.doc_id").alias("of"), F.col("lead.key").alias("_key"), F.col("lead.first").alias("_first"))
    )
    # a row with a repeated doc_id and text stands at the same place; it is the same document
    other = found.join(lead, "hash").where(~((F.col("key") == F.col("_key")) & (F.col("first") == F.col("_first"))))
    return other.select("key", "first", "last", "of")


def substring_dedup(docs: DataFrame, *, length: int = SENTENCES, pair_words: int = PAIR_WORDS) -> DataFrame:
    """doc_id, text, n_sentences, n_removed, removed_words, first_docs, kept_text for every row of docs.

    kept_text is the text without the sentences of repeated spans; first_docs are the documents that keep them (the own
    one for a repetition within). Null and empty texts stay as they are. Rows that repeat doc_id and text are one document
    and all keep what it keeps; copies under other ids lose what the smallest id keeps. An empty table gives no rows.
    """
    gone = stored(
        repeated(docs, length, pair_words)
        .groupBy("key")
        .agg(F.collect_set(F.struct("first", "last")).alias("gone"), F.sort_array(F.collect_set("of")).alias("first_docs"))
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            n, n_gone, words, kept = [], [], [], []
            for text, gone in zip(pdf["text"], pdf["gone"], strict=True):
                pieces = sentences(text)
                out = set() if gone is None else {i for g in gone for i in range(g["first"], g["last"] + 1)}
                n.append(len(pieces))
                n_gone.append(len(out))
                words.append(sum(len(_WORD.findall(pieces[i])) for i in out))
                kept.append("".join(p for i, p in enumerate(pieces) if i not in out) if out else text)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": pdf["text"], "n_sentences": n, "n_removed": n_gone, "removed_words": words, "first_docs": pdf["first_docs"], "kept_text": kept})

    rows = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return rows.join(gone, "key", "left").select("doc_id", "text", "gone", "first_docs").mapInPandas(
        run, "doc_id long, text string, n_sentences long, n_removed long, removed_words long, first_docs array<long>, kept_text string"
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_sentences", "n_removed", "removed_words", "first_docs", "kept_text")
