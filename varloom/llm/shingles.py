"""Word shingles as 64-bit hashes, computed in bulk over bytes. Equal hashes stand for equal shingles."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACE = (_RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) << _U(1)) | _U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed at once; a longer text is cut at white space.
CHUNK = 1 << 20
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 4096)
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """A hash of each word, in order; A-Z count as a-z if lower."""
    return word_places(text, lower)[1]


def word_places(text: str | None, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The place in UTF-8 at which each word starts, and its hash."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out, places, at = [], [], 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        if end < len(raw):
            spaces = np.flatnonzero(_SPACE[raw[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:  # a word longer than the chunk stays whole
                more = np.flatnonzero(_SPACE[raw[end:]])
                end = end + int(more[0]) if len(more) else len(raw)
        part, base = raw[at:end], at
        at = end
        inside = ~_SPACE[part]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, unpower = _upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[_LOWER[part] if lower else part] * power[: len(part)], out=sums[1:])
        out.append(mix((sums[ends] - sums[starts]) * unpower[starts]))
        places.append(starts + base)
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(places), np.concatenate(out)


def shingle_set(text: str | None, k: int, lower: bool = True) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles; of fewer words, the whole sequence is one; none without words."""
    w = word_hashes(text, lower)
    if not len(w):
        return w
    if len(w) < k:
        return mix(np.array([(w * _PLACE[: len(w)]).sum(dtype=np.uint64) + _U(len(w))], dtype=np.uint64))
    n = len(w) - k + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += w[i : i + n] * _PLACE[i]
    return np.unique(mix(total))
