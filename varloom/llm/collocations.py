"""Phrase collocation mining: counts of all phrases up to a depth, scores of how firmly their parts stick together.

Each shard of texts becomes a generalised suffix automaton of its words, cut at the depth: a state is what ends at the same
places, its count the number of these places (endpos), its suffix link the state without the first word. Two scans:

1. the states of two words, by a 64-bit hash, summed over all shards; those that may have enough occurrences set a bit in a
   map of a fixed size, which is broadcast. A phrase is no more frequent than its suffix link or its first words, so ones
   with a rarer pair inside can't be candidates. Hashes and bits that meet only let more phrases through.
2. the states whose pairs all have their bits, spelled out, summed over all shards: exact counts.

A phrase inside a longer one is inside one that has one word more and is at least as frequent, so subsumption needs each
candidate's suffix link and the phrase without its last word alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import read_table, stored, top_ranked
from varloom.llm.shingles import mix
from varloom.llm.wordscan import Words, byte_class, chunks, find_words

#: Occurrences and words of a candidate; hundredths of its occurrences in a longer one that make it go; phrases told of each language.
LEAST_COUNT, MOST_WORDS, SHARE, TOP, SCALE = 10, 3, 50, 2000, 1_000_000
#: Words of a shard, at least (a text is never cut), and bits of the map of pairs: 16 MB.
SHARD, BITS = 500_000, 27
_STOPS = ((0x0A, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
STOPS = byte_class(*_STOPS, beyond=False)
LETTERS = ~byte_class(*_STOPS, (0x09, 0x09), (0x20, 0x20), beyond=False)
_U = np.uint64
_FIRST, _SECOND = _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3)


class Shard:
    """Words of whole texts in order: their hashes, which depend on the language, and whether each follows the one before in its piece."""

    def __init__(self, spelled: bool) -> None:
        self.spelled = spelled
        self.hashes: list[np.ndarray] = []
        self.follows: list[np.ndarray] = []
        self.langs: list[np.ndarray] = []
        self.words: list[pa.LargeStringArray] = []
        self.size = 0

    def add(self, words: Words, data: np.ndarray, lang: np.ndarray, salt: np.ndarray) -> None:
        if not len(words):
            return
        piece = np.searchsorted(np.flatnonzero(STOPS[data]), words.starts)
        follows = np.zeros(len(words), dtype=bool)
        follows[1:] = (piece[1:] == piece[:-1]) & (words.text[1:] == words.text[:-1])
        self.hashes.append(mix(words.hashes() ^ salt[words.text]))
        self.follows.append(follows)
        if self.spelled:
            self.langs.append(lang[words.text])
            self.words.append(words.strings())
        self.size += len(words)


class SuffixAutomaton:
    """The states of one to `depth` symbols of a sequence. follows: whether a symbol follows the one before; may: which such pairs count."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, follows: np.ndarray, depth: int, may: np.ndarray | None = None) -> None:
        #: of each depth, for each state: the last place of one occurrence, number of occurrences, suffix link
        self.states: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        of = symbols  # the state of each end
        ends = np.arange(len(symbols))
        valid = np.ones(len(symbols), dtype=bool)
        for size in range(1, depth + 1):
            if size > 1:
                before = np.zeros(len(symbols), dtype=bool)
                before[1:] = valid[:-1]
                valid = (follows if may is None else follows & may) if size == 2 else valid & before
                ends = np.flatnonzero(valid)
            key = of[ends] * n_symbols + symbols[ends - size + 1] if size > 1 else of
            _, place, state, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            self.states.append((ends[place], count, of[ends[place]] if size > 1 else np.zeros(0, dtype=np.int64)))
            if size < depth:
                of = np.full(len(symbols), -1, dtype=np.int64)
                of[ends] = state


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """A hash for each word and the one before it."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    out[1:] = mix(hashes[:-1] * _FIRST + hashes[1:] * _SECOND)
    return out


def _shards(batches: Iterator[pa.RecordBatch], spelled: bool, size: int) -> Iterator[tuple[Shard, list[str]]]:
    names: dict[str, int] = {}
    shard = Shard(spelled)
    for batch in batches:
        lang = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], dtype=np.int64)
        heads = find_words(*_joined(list(names)), np.ones(256, dtype=bool))
        salt = np.zeros(len(names), dtype=np.uint64)  # an empty name has no word
        salt[heads.text] = heads.hashes()
        for first, data, at in chunks(batch.column("text"), 2 << 20):
            words = find_words(data, at, LETTERS, first)
            shard.add(words, data, lang, salt[lang])
            if shard.size >= size:
                yield shard, list(names)
                shard = Shard(spelled)
                pa.default_memory_pool().release_unused()
    if shard.size:
        yield shard, list(names)


def _joined(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    coded = [x.encode("utf-8", "surrogatepass") for x in names]
    return np.frombuffer(b"".join(coded), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in coded])]).astype(np.int64)


def _pair_map(docs: DataFrame, least: int, bits: int, size: int) -> np.ndarray:
    """The bits of all pairs of words that occur `least` times or more, as 64-bit numbers; others may be set too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, _ in _shards(batches, False, size):
            hashes, follows = np.concatenate(shard.hashes), np.concatenate(shard.follows)
            known, symbols = np.unique(hashes, return_inverse=True)
            end, count, _ = SuffixAutomaton(symbols.astype(np.int64), len(known), follows, 2).states[1]
            rows = {"h": pa.array(_pairs(hashes)[end].view(np.int64)), "n": pa.array(count.astype(np.int32))}
            yield from pa.table(rows).to_batches(max_chunksize=100_000)

    often = docs.mapInArrow(run, "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    cell = F.shiftrightunsigned("h", 64 - (bits - 6)).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("h", 64 - bits).bitwiseAND(F.lit(63)).cast("int"))
    # as many rows as the map has cells at most
    rows = often.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows["cell"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def phrase_counts(docs: DataFrame, *, least: int = LEAST_COUNT, most_words: int = MOST_WORDS, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """lang, phrase, size, n: the words of each language (size 1), its phrases of 2 to most_words words with n >= least, and the
    number of its words (size 0, phrase '')."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(_pair_map(rows, least, bits, shard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_map = shared.value
        for part, names in _shards(batches, True, shard):
            pairs = _pairs(np.concatenate(part.hashes))
            may = (pair_map[pairs >> _U(64 - (bits - 6))] >> ((pairs >> _U(64 - bits)) & _U(63))) & _U(1) == 1
            lang = np.concatenate(part.langs)
            words = pa.concat_arrays(part.words)
            coded = words.dictionary_encode()
            symbols = coded.indices.to_numpy().astype(np.int64) * len(names) + lang
            automaton = SuffixAutomaton(symbols, len(coded.dictionary) * len(names), np.concatenate(part.follows), most_words, may)
            langs = pa.array(names, pa.string())
            n = np.bincount(lang, minlength=len(names))
            held = np.flatnonzero(n)
            yield pa.record_batch([langs.take(pa.array(held)), pa.array([""] * len(held)), pa.array(np.zeros(len(held), dtype=np.int32)), pa.array(n[held].astype(np.int64))], names=["lang", "phrase", "size", "n"])
            for size, (end, count, _) in enumerate(automaton.states, 1):
                for i in range(0, len(end), 50_000):
                    e = end[i : i + 50_000]
                    spelled = [words.take(pa.array(e - size + 1 + j)) for j in range(size)]
                    phrase = pc.binary_join_element_wise(*spelled, pa.scalar(" ", pa.large_string())) if size > 1 else spelled[0]
                    yield pa.record_batch([langs.take(pa.array(lang[e])), phrase.cast(pa.string()), pa.array(np.full(len(e), size, dtype=np.int32)), pa.array(count[i : i + 50_000].astype(np.int64))], names=["lang", "phrase", "size", "n"])

    found = rows.mapInArrow(run, "lang string, phrase string, size int, n long").groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return found.where((F.col("size") < 2) | (F.col("n") >= least))


def collocations(
    docs: DataFrame, *, least: int = LEAST_COUNT, most_words: int = MOST_WORDS, share: int = SHARE, top: int | None = TOP, bits: int = BITS, shard: int = SHARD
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases of 2 to most_words words by score, `top` of them or all.

    a: occurrences; l, r: those of the parts on the two sides of the cut with the lowest score, ties to the shortest first part;
    score: floor(SCALE * a * a / (l * r)); n: words of the language. Phrases lie within pieces between . , ; : ! ? and line
    ends; A-Z count as a-z. A phrase goes if a longer one that occurs `least` times, itself kept or not, holds share
    hundredths of its occurrences. Ties in the score go to the larger a, then to the smaller phrase in UTF-8.
    A null language is 'und', and one with it; null and empty texts, and texts without words, add nothing, and a language of
    such texts alone has no rows. Texts of any length are read whole, repeated rows count each, other columns are ignored, an
    empty table gives no rows. Counts may be up to 1e14.
    """
    counts = stored(phrase_counts(docs, least=least, most_words=most_words, bits=bits, shard=shard))
    known = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    candidates = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    w = F.split("phrase", " ")
    first = lambda k: F.array_join(F.slice(w, F.lit(1), k), " ")
    rest = lambda k: F.array_join(F.slice(w, k + 1, F.col("size") - k), " ")
    sides = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.array(F.struct(k.alias("k"), F.lit(True).alias("left"), first(k).alias("part")), F.struct(k.alias("k"), F.lit(False).alias("left"), rest(k).alias("part"))))
    cuts = candidates.select("lang", "phrase", "size", "a", F.explode(F.flatten(sides)).alias("s")).select("lang", "phrase", "size", "a", "s.*")
    of = lambda k, left: F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f")))
    parts = [(k, of(k, True).alias(f"l{k}"), of(k, False).alias(f"r{k}")) for k in range(1, most_words)]
    both = cuts.join(known, ["lang", "part"]).groupBy("lang", "phrase", "size", "a").agg(*[c for _, left, right in parts for c in (left, right)])
    score = lambda k: F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))) div (CAST(l{k} AS DECIMAL(19,0)) * CAST(r{k} AS DECIMAL(19,0)))")
    lowest = F.array_min(F.array(*[F.when(F.col("size") > k, F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, most_words)]))
    scored = both.select("lang", "phrase", "a", lowest.alias("_x")).select("lang", "phrase", "a", "_x.l", "_x.r", "_x.score")
    # suffix links, and phrases without their last word
    inside = F.array(rest(F.lit(1)), first(F.col("size") - 1))
    longer = candidates.where("size > 2").select("lang", "a", F.explode(inside).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a"))).drop("_longer")
    ranked = top_ranked(kept, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    words = counts.where("size = 0").select("lang", "n")
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, list_slice(w, i, i + k - 1) AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {MOST_WORDS} + 1)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len(phrase) = 1 GROUP BY lang),
c AS (SELECT lang, phrase, f AS a FROM f WHERE len(phrase) > 1 AND f >= {LEAST_COUNT}),
cuts AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, {SCALE}::HUGEINT * a * a // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(phrase))) AS k FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = list_slice(c.phrase, 1, k) JOIN f y ON y.lang = c.lang AND y.phrase = list_slice(c.phrase, k + 1, len(c.phrase))),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
gone AS (SELECT DISTINCT s.lang, s.phrase FROM (SELECT lang, a AS more, list_slice(phrase, i, i + k - 1) AS phrase FROM
  (SELECT lang, phrase, a, k, unnest(range(1, len(phrase) - k + 2)) AS i FROM c, (SELECT unnest(range(2, {MOST_WORDS})) AS k) WHERE len(phrase) > k)) s JOIN c USING (lang, phrase) WHERE 100 * more >= {SHARE} * a),
kept AS (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score FROM best ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang) WHERE rank <= {TOP}
"""
