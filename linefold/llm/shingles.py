"""Five-word shingle sets of whole texts as sorted 64-bit hashes, for a batch of texts at a time in numpy."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Bytes of text handled at a time (a longer text is alone).
SLICE = 1_500_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a byte string (words: runs of anything but ASCII blanks)."""
    blank = _BLANK[raw]
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = np.flatnonzero(~blank)
    powers = np.full(lengths.max() + 1, _MULTIPLIER, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    first = np.cumsum(lengths) - lengths
    terms = (raw[inside].astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(inside)) - np.repeat(first, lengths)]
    return starts, mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def _some(texts: list[bytes]) -> list[np.ndarray]:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts, words = _word_hashes(raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, ends)
    n = len(words)
    rows = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        rows = rows * _MULTIPLIER + words[k : n - SHINGLE + 1 + k]
    rows = mix(rows)
    out, at = [], 0
    for end in upto.tolist():
        if end - at >= SHINGLE:
            out.append(np.unique(rows[at : end - SHINGLE + 1]))
        elif end > at:
            h = np.uint64(end - at)
            for w in words[at:end]:
                h = h * _MULTIPLIER + w
            out.append(mix(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at = end
    return out


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer than five words all of them make one; no words, none.

    A-Z are folded to a-z and nothing else, as only ASCII bytes can be letters A-Z in UTF-8.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        some, size = [], 0
        for t in raw:
            if some and size + len(t) > SLICE:
                out += _some(some)
                some, size = [], 0
            some.append(t)
            size += len(t)
        if some:
            out += _some(some)
    return out
