"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is read once from left to right. Each place keeps the best last piece that ends there, and only places within the
longest piece's reach can still be left by a later piece; what lies before them is a window of bounded size. Whenever the
backpointer paths of all these live places meet in one boundary, the ids up to it are final and are given out. A space after
other characters, which no piece holds, is such a boundary at once, so texts are read in segments that begin there.

For a unigram model the best last piece is that of the highest total score. For a BPE model it is the one piece that merging
in order of rank leaves there: a split is the merges' result exactly if each pair of neighbours is left alone when merged on
its own, so every place has a single such piece, and it follows from those before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import read_table

#: The model's file; on the driver only, tasks get the vocabulary.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: What the search found for segments up to this length is remembered, for so many of them.
SHORT, MOST_KNOWN = 40, 1_000_000
#: Lengths that may end at the first places, and where no longer piece ends.
FEW = ((), (), (2,), (3, 2))


@dataclass
class Vocabulary:
    """Pieces with scores. kind: bpe or unigram. Its size bounds what is broadcast."""

    pieces: list[str]
    scores: list[float]
    special: set[int]
    bytes_: dict[int, int]
    unknown: int
    kind: str
    prefix: bool = True
    ids: dict[str, int] = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.special}
        self.longest = max(map(len, self.ids), default=1)
        spanned = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        #: for the last four characters of a piece, the lengths of pieces that end so, the longest first, and shorter ones
        ends: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 3:
                ends.setdefault(p[-4:], set()).add(len(p))
        self.ends = {k: (*sorted(v, reverse=True), *((3,) if k[1:] in self.ids else ()), *((2,) if k[2:] in self.ids else ())) for k, v in ends.items()}
        #: a space after anything else starts a segment, as no piece holds one there
        self.space_starts = not any(b[1] == SPACE and b[0] != SPACE for b in spanned)


def _model_type(path: str) -> int:
    """The model's kind as its file says it."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    return model.trainer_spec.model_type


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file. Its normalisation must leave characters as they are, but for spaces and one put in front."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
    made = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    for raw in ("①ﬁ", "a  b", "x\ty\n"):
        if sp.decode(sp.encode(raw)) != raw:
            raise ValueError(f"{path}: models that normalise texts aren't supported")
    scores = [sp.get_score(i) for i in range(n)]
    kinds = {1: "unigram", 2: "bpe"}
    if (kind := _model_type(path)) not in kinds:
        raise ValueError(f"{path}: only unigram and BPE models are supported")
    return Vocabulary(pieces, scores, special, made, sp.unk_id(), kinds[kind], sp.encode("a", out_type=str)[0].startswith(SPACE))


class Encoder:
    """Ids of texts; keeps what it has learnt about segments and pairs of pieces, within bounds."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.bpe = vocabulary.kind == "bpe"
        self.segment = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
        lowest = min((vocabulary.scores[i] for i in vocabulary.ids.values()), default=0.0)
        self.penalty = lowest - 10.0  # score of a character without a piece
        self.widest = 0  # the largest window so far

    def merged(self, text: str) -> list[str]:
        """BPE by its definition, for short texts: merge the pair of the best score, the first of equals."""
        parts, ids, scores = list(text), self.v.ids, self.v.scores
        none = float("-inf")
        score = lambda x: none if (k := ids.get(x)) is None else scores[k]
        joined = [score(a + b) for a, b in zip(parts, parts[1:])]  # of each pair of neighbours
        while joined and (best := max(joined)) > none:
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at:
                joined[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(joined):
                joined[at] = score(parts[at] + parts[at + 1])
        return parts

    def text_of(self, last: int) -> str:
        """The piece that a place's mark names: an id, -2 less a character's code for one without a piece, -1 for none."""
        return "" if last == -1 else self.v.pieces[last] if last >= 0 else chr(-2 - last)

    def fits(self, last: int, right: str) -> bool:
        """Does merging leave the piece behind the one that `last` marks?"""
        left = self.text_of(last)
        return self.merged(left + right) == ([left, right] if left else [right])

    def give(self, piece: str) -> list[int]:
        k = self.v.ids.get(piece)
        if k is not None:
            return [k]
        if self.v.bytes_:
            return [self.v.bytes_[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.v.unknown]

    def stream(self, characters: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters, each as soon as it is final."""
        ids, ends, longest, scores, pairs, bpe = self.v.ids, self.v.ends, self.v.longest, self.v.scores, self.pairs, self.bpe
        # from the last final boundary on: the text, and for each place the mark and the length of its last piece, and its score
        window, last, back, best = "", [-1], [0], [0.0]
        for c in characters:
            window += c
            i = len(window)
            if bpe:
                for n in ends.get(window[-4:], FEW[3]) if i > 3 else FEW[i]:
                    if n > i or (k := ids.get(window[i - n :])) is None:
                        continue
                    key = last[i - n] << 20 | k
                    fit = pairs.get(key)
                    if fit is None:
                        fit = pairs[key] = self.fits(last[i - n], window[i - n :])
                    if fit:
                        last.append(k)
                        back.append(n)
                        break
                else:
                    last.append(ids.get(c, -2 - ord(c)))
                    back.append(1)
            else:
                top, chosen = best[i - 1] + (scores[ids[c]] if c in ids else self.penalty), 1
                for n in range(2, min(longest, i) + 1):
                    if (k := ids.get(window[i - n :])) is not None and best[i - n] + scores[k] > top:
                        top, chosen = best[i - n] + scores[k], n
                last.append(-1)
                back.append(chosen)
                best.append(top)
            if i >= 2 * longest and i % longest == 0:
                self.widest = max(self.widest, i)
                live = set(range(i - longest + 1, i + 1))  # where a later piece can begin
                while len(live) > 1:
                    end = max(live)
                    live.remove(end)
                    live.add(end - back[end])
                if (at := live.pop()) > 0:
                    yield from self._path(window, back, at)
                    window, last, back = window[at:], last[at:], [0, *back[at + 1 :]]
                    best = best if bpe else [b - best[at] for b in best[at:]]
        self.widest = max(self.widest, len(window))
        if len(pairs) > MOST_KNOWN:
            pairs.clear()
        yield from self._path(window, back, len(window))

    def search(self, text: str) -> list[int]:
        """The same search for BPE in a short text, which is one window: its only final boundary is its end."""
        ids, ends, pairs, fits = self.v.ids.get, self.v.ends.get, self.pairs, self.fits
        known, few, last, back = pairs.get, FEW[3], [-1], [0]
        for i, c in enumerate(text, 1):
            for n in ends(text[i - 4 : i], few) if i > 3 else FEW[i]:
                if n > i or (k := ids(text[i - n : i])) is None:
                    continue
                key = last[i - n] << 20 | k
                fit = known(key)
                if fit is None:
                    fit = pairs[key] = fits(last[i - n], text[i - n : i])
                if fit:
                    last.append(k)
                    back.append(n)
                    break
            else:
                last.append(ids(c, -2 - ord(c)))
                back.append(1)
        self.widest = max(self.widest, len(text))
        if len(pairs) > MOST_KNOWN:
            pairs.clear()
        out, end = [], len(text)
        while end > 0:
            k = last[end]
            out.append([k] if k >= 0 else self.give(chr(-2 - k)))
            end -= back[end]
        return [k for p in reversed(out) for k in p]

    def _path(self, window: str, back: list[int], end: int) -> list[int]:
        """Ids of the pieces on the way back from a place."""
        ids, pieces = self.v.ids, []
        while end > 0:
            piece = window[end - back[end] : end]
            k = ids.get(piece)
            pieces.append([k] if k is not None else self.give(piece))
            end -= back[end]
        return [k for p in reversed(pieces) for k in p]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text; none for null and empty texts."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.v.prefix:
            text = SPACE + text
        if not self.v.space_starts:
            return list(self.stream(text))
        out: list[int] = []
        known = self.known
        for part in self.segment.findall(text) if len(text) < 1 << 16 else (m.group() for m in self.segment.finditer(text)):
            found = known.get(part)
            if found is None:
                if len(part) > SHORT:
                    out += self.stream(part)
                    continue
                found = tuple(self.search(part) if self.bpe else self.stream(part))
                if len(known) >= MOST_KNOWN:
                    known.clear()
                known[part] = found
            out += found
        return out


_encoders: dict[str, "Encoder"] = {}


def encoder_of(vocabulary: Vocabulary) -> "Encoder":
    """This worker's encoder for a vocabulary: what it knows serves all its tasks."""
    name = f"{vocabulary.kind} {len(vocabulary.pieces)} {hash(tuple(vocabulary.pieces))}"
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


class Decoder:
    """Texts of ids; control ids give nothing, bytes that aren't UTF-8 give U+FFFD."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        raw = {i: bytes([b]) for b, i in vocabulary.bytes_.items()}
        plain = lambda i: b"" if i in vocabulary.special else vocabulary.pieces[i].replace(SPACE, " ").encode()
        self.table = [raw[i] if i in raw else plain(i) for i in range(len(vocabulary.pieces))]
        self.prefix = vocabulary.prefix

    def decode(self, ids: Iterable[int] | None) -> str:
        text = b"".join(map(self.table.__getitem__, () if ids is None else ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode_documents(docs: DataFrame, columns: list[str], *, model: str = MODEL) -> DataFrame:
    """columns of docs with ids (array<int>), same (do the ids decode to the text?) and window (the widest so far).

    Null and empty texts have no ids; same is null for null texts. A text that itself holds the space mark is encoded as
    the library does, and decodes to a space. Very long texts are read once; nothing but their ids grows with them. Repeated
    rows are rows of their own; an empty table gives no rows; columns that are named like one of the three give way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))  # one vocabulary
    kept = [c for c in columns if c not in ("ids", "same", "window")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, decoder = encoder_of(shared.value), Decoder(shared.value)
        for pdf in parts:
            for at in range(0, len(pdf), 256):
                some = pdf.iloc[at : at + 256]
                texts = some.iloc[:, -1]
                ids = [encoder.encode(t) for t in texts]
                out = some.iloc[:, :-1].copy()
                out["ids"] = [np.array(x, dtype=np.int32) for x in ids]
                out["same"] = pd.array([None if t is None else decoder.decode(x) == t for x, t in zip(ids, texts, strict=True)], dtype="boolean")
                out["window"] = encoder.widest
                yield out

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    read = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("ids"))  # a name that no kept column has
    return read.mapInPandas(run, f"{kinds + ', ' if kinds else ''}ids array<int>, same boolean, window int")


def decode_documents(rows: DataFrame, columns: list[str], *, model: str = MODEL) -> DataFrame:
    """columns of rows with text, decoded from ids (null: '')."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(shared.value)
        for pdf in parts:
            out = pdf[columns].copy()
            out["text"] = [decoder.decode(x) for x in pdf["ids"]]
            yield out

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema)
    return rows.select(*dict.fromkeys([*columns, "ids"])).mapInPandas(run, f"{kinds}, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_digest (xxhash64 of the ids), same."""
    rows = encode_documents(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_digest"), "same")
