"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learnt from labelled texts: words and word beginnings that toxic texts hold far more often than others, with
public swear words to start from. Every whole text then becomes a short vector (densities, nearness to a second person,
capitals, punctuation, disguised words), on which trees vote; the isotonic fit turns votes into probabilities, to which a hundredth of the vote is added.

Only labelled rows are sampled (MOST_LABELLED of each label, by hash); every text is scored whole. Texts are read where
they lie and never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import cut, read_table

#: Labelled texts to learn from, of each label at most.
MOST_LABELLED = 4000
#: A term is in the lexicon if so many toxic texts hold it, and at least this share of them, and if a toxic text holds it
#: so many times as likely as another.
LEAST_TEXTS = 3
LEAST_SHARE = 0.008
LEAST_RATIO = 12.0
#: Letters of the word beginnings that count as terms.
STEMS = (4, 5, 6)
REJECT = 0.7
#: Share of the trees' vote in a score, which keeps the votes' order where the calibration has one value for many; it moves no score across REJECT.
VOTE = 0.01
SEED_WORDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting", "clown", "bastard", "asshole", "bitch", "shit", "fuck")
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus vosotros usted".split())
FEATURES = ("lexicon", "stems", "distinct", "log_hits", "strongest", "near_you", "second_person", "capitals", "shouted", "exclaimed", "punctuation", "disguised", "disguised_hits", "log_words")

_INNER = re.compile(r"[^\W\d_](?:[\W\d_]+)[^\W\d_]")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_LEET = str.maketrans("013457@$!", "oieastasi")


def normal(token: str) -> tuple[str, bool]:
    """The letters of a token in lower case, and whether other characters stood among them (leet digits become letters)."""
    core = token.strip("\"'.,;:!?()[]{}<>«»„“”‘’¿¡…-–—*_#")
    if core.isalpha():
        return core.lower(), False
    if not _INNER.search(core) and not any(c.isdigit() for c in core):
        return _NOT_LETTER.sub("", core).lower(), False
    return _NOT_LETTER.sub("", core.lower().translate(_LEET)), True


def terms_of(text: str | None) -> set[str]:
    found: set[str] = set()
    for token in set((text or "").split()):
        word, _ = normal(token)
        if len(word) > 2:
            found.add(word)
            found.update(word[:n] + "*" for n in STEMS if len(word) > n)
    return found


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """term -> log ratio of its frequencies in toxic and other texts.

    A term stands in a share of the toxic texts, of which there are MOST_LABELLED at most, so their terms bound its size.
    """

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            counts: dict[str, list[int]] = {}
            for text, y in zip(pdf["text"], pdf["toxic"], strict=True):
                for term in terms_of(text):
                    counts.setdefault(term, [0, 0])[int(y)] += 1
            yield pd.DataFrame({"term": list(counts), "clean": [v[0] for v in counts.values()], "toxic": [v[1] for v in counts.values()]})

    totals = labelled.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    ratio = ((F.col("t") + 0.5) / (totals["t"] + 1)) / ((F.col("c") + 0.5) / (totals["c"] + 1))
    rows = (
        labelled.select("text", "toxic")
        .mapInPandas(spread, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        .withColumn("ratio", ratio)
        .where((F.col("t") >= max(LEAST_TEXTS, LEAST_SHARE * totals["t"])) & (F.col("ratio") >= LEAST_RATIO))
        .collect()
    )
    return {r["term"]: float(np.log(r["ratio"])) for r in rows}


class Reader:
    """Turns whole texts into dense vectors; remembers what it found out about tokens, up to MOST_TOKENS of them, and then forgets all."""

    MOST_TOKENS = 200_000
    NOTHING = (False,)

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon, self.known = lexicon, {}

    def look(self, token: str) -> tuple:
        """Anything to count?, then lexicon value and term, stem?, disguised?, second person?, capital?, shouted?, exclaimed?"""
        word, odd = normal(token)
        value, term, stem = self.lexicon.get(word, 0.0), word, False
        if not value:
            for k in STEMS:
                if len(word) > k and (v := self.lexicon.get(word[:k] + "*", 0.0)) > value:
                    value, term, stem = v, word[:k], True
        you, capital, shouted, exclaimed = word in SECOND_PERSON, token[0].isupper(), len(word) > 2 and token.isupper(), token[-1] in "!?"
        some = value or odd or you or capital or shouted or exclaimed
        found = (True, value, term, stem, odd, you, capital, shouted, exclaimed) if some else self.NOTHING
        if len(self.known) >= self.MOST_TOKENS:
            self.known.clear()
        if len(token) <= 40:
            self.known[token] = found
        return found

    def vector(self, text: str | None) -> list[float]:
        """Zeros for null, empty and blank texts."""
        tokens = (text or "").split()
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        known, look = self.known, self.look
        words = stems = disguised = disguised_hits = yous = capitals = shouts = exclaims = near = 0
        strongest, last_you, last_hit, seen = 0.0, -10, -10, set()
        for i, token in enumerate(tokens):
            found = known.get(token) or look(token)
            if not found[0]:
                continue
            _, value, term, stem, odd, you, capital, shouted, exclaimed = found
            capitals += capital
            shouts += shouted
            exclaims += exclaimed
            disguised += odd
            if value:
                stems += stem
                words += not stem
                seen.add(term)
                strongest = max(strongest, value)
                disguised_hits += odd
                near += i - last_you <= 5
                last_hit = i
            if you:
                yous += 1
                near += i - last_hit <= 5
                last_you = i
        hits = words + stems
        marks = sum(map(text.count, "!?*#@$%&"))
        return [words / n, stems / n, len(seen) / n, float(np.log1p(hits)), strongest, near / n, yous / n, capitals / n, shouts / n, exclaims / n, marks / len(text), disguised / n, disguised_hits / n, float(np.log1p(n))]


def features(spark: SparkSession, lexicon: dict[str, float]) -> Callable[[Column], Column]:
    """text -> the vector of the text. Only texts travel to Python, and only vectors back."""
    words = lexicon | {w: max(lexicon.get(w, 0.0), 2.5) for w in SEED_WORDS}
    shared = spark.sparkContext.broadcast(words)  # bounded by the labelled sample

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(shared.value)
        for texts in parts:
            yield pd.Series([reader.vector(t) for t in texts], dtype=object)

    return run.asNondeterministic()  # else a filter on the score would read each text again


class ToxicityModel:
    """A lexicon, trees and their calibration; score() adds a probability to any table with a text."""

    def __init__(self, lexicon: dict[str, float], trees, calibration, prior: float) -> None:
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior

    def score(self, docs: DataFrame, columns: list[str]) -> DataFrame:
        """columns of docs with score, 0 to 1, for every row of docs; docs' own score gives way.

        Null, empty and blank texts have the score of a vector of zeros; equal texts have equal scores, so repeated rows and
        ties do too. Very long texts are read whole. An empty table gives no rows. Without two labels to learn from, all
        scores are the share of toxic rows.
        """
        kept = [c for c in columns if c != "score"]
        if self.trees is None:
            return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(self.prior).alias("score"))
        vector = array_to_vector(features(docs.sparkSession, self.lexicon)(F.col("text")))
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), vector.alias("features"))
        rows = self.trees.transform(rows).select("_row", vector_to_array("probability")[1].alias("_vote"))
        rows = self.calibration.transform(rows)
        flat = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
        blend = (1 - VOTE) * flat + VOTE * F.col("_vote")
        kept = F.when(flat >= REJECT, F.greatest(blend, F.lit(REJECT))).otherwise(F.least(blend, F.lit(math.nextafter(REJECT, 0))))
        return rows.select("_row.*", kept.alias("score"))


def held_out(doc_id):
    """Rows that no model may learn from: crc32 of the id as text leaves 1 on division by 3 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, most: int = MOST_LABELLED, seed: int = 7) -> ToxicityModel:
    """Learn from labelled rows that aren't held out: `most` of each label, those with the smallest hashes.

    Two halves, by hash: the vectors of each are made with the lexicon of the other, and the votes on each that are
    calibrated are those of trees fitted on the other. The model's own lexicon and trees are then fitted on both.
    Null labels and labels of unknown documents are left out, as are rows whose document is labelled both ways.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_m")).where(F.col("toxic") == F.col("_m")).drop("_m")
    known = known.where(~held_out("doc_id")).withColumn("_h", F.xxhash64("doc_id", F.lit(seed)))
    chosen = [known.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(most) for y in (0, 1)]
    sample = cut(docs.select("doc_id", "text").join(chosen[0].unionByName(chosen[1]), "doc_id"))
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return ToxicityModel({}, None, None, float(counts.get(1, 0) > 0))
    halves = [sample.where(F.pmod("_h", F.lit(2)) == i) for i in (0, 1)]
    rows = [
        half.select(F.lit(i).alias("half"), F.col("toxic").cast("double").alias("label"), array_to_vector(features(docs.sparkSession, learn_lexicon(other))(F.col("text"))).alias("features"))
        for i, (half, other) in enumerate(zip(halves, reversed(halves), strict=True))
    ]
    train = cut(rows[0].unionByName(rows[1]).coalesce(4))
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, subsamplingRate=0.8, seed=seed, maxBins=32)
    both = {tuple(r) for r in train.select("half", "label").distinct().collect()}
    if len(both) == 4:
        votes = [trees.fit(train.where(F.col("half") == 1 - i)).transform(train.where(F.col("half") == i)) for i in (0, 1)]
        voted = votes[0].unionByName(votes[1])
    else:  # too few rows for halves with two labels each
        voted = trees.fit(train).transform(train)
    voted = voted.select("label", vector_to_array("probability")[1].alias("_vote"))
    calibration = IsotonicRegression(featuresCol="_vote", labelCol="label", predictionCol="score").fit(voted)
    return ToxicityModel(learn_lexicon(sample), trees.fit(train), calibration, counts[1] / (counts[0] + counts[1]))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return model.score(docs, ["doc_id"]).select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= REJECT, 1).otherwise(0).alias("predicted"))
