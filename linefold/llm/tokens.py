"""Token ids of whole texts by the tokenizers library, each distinct word encoded once.

The word-level vocabulary drops white space and encodes each pre-token alone,
so the ids of a text are those of its pieces between ASCII blanks, one after
another. Each distinct piece of a slice of texts is looked at once; pre-tokens
are kept in a bounded dictionary, and only new ones go through the library. A piece outside the plain range (anything but printable
ASCII and Latin-1 letters, or what looks like a special token) goes to the
library as it is, any other separators in it included.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Entries a dictionary may hold before it is emptied.
CACHE = 300_000
#: Characters encoded at a time (bytes of an Arrow column).
SLICE = 4_000_000
#: New pre-tokens that go to the library as one text; longer texts cost it more a pre-token.
TOGETHER = 500

#: What keeps a piece from being plain.
_ODD = "[^!-~À-ÖØ-öø-ÿ]|<[|]|^$"
#: Fixed value: the pre-token pattern of the vocabulary, restricted to the plain range; plain pieces end in line breaks.
_PRETOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Numbered(dict):
    """Numbers its keys as they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start+1, ..`` of all runs, one run after another."""
    ends = np.cumsum(lengths)
    out = np.repeat(starts - (ends - lengths), lengths)
    out += np.arange(len(out))
    return out


def numbered(lists: list[list[str]], numbers: Numbered) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all pieces in one array, and where each list's begin (one entry more than lists)."""
    counts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))]).astype(np.int64)
    every = map(numbers.__getitem__, chain.from_iterable(lists))
    return np.fromiter(every, dtype=np.int64, count=int(counts[-1])), counts


def _joined(values: pa.Array, between: str) -> pa.StringScalar:
    """All values in one."""
    one = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pc.binary_join(one, pa.scalar(between, values.type))[0]


class PieceMemo:
    """Ids of pre-tokens, each distinct one encoded once while it is remembered."""

    def __init__(self, learn: Callable[[list[str]], list[list[int]]], cache: int = CACHE):
        self.learn, self.cache = learn, cache
        self.forget()

    def forget(self) -> None:
        self._pieces = Numbered()
        self._ids, self._starts, self._lengths = array("I"), array("q"), array("q")

    def encode(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in one array, and where each list's begin (one entry more than lists)."""
        if len(self._pieces) > self.cache:
            self.forget()
        return self._encode(*numbered(lists, self._pieces))

    def encode_parted(self, pieces: list[str], end: str) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode`` of lists that are given in one, each followed by ``end``."""
        if len(self._pieces) > self.cache:
            self.forget()
        every = np.fromiter(map(self._pieces.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        ends = np.flatnonzero(every == self._pieces[end])
        counts = np.concatenate([[0], ends - np.arange(len(ends))])
        return self._encode(np.delete(every, ends), counts)

    def _encode(self, which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self._pieces.new:
            learnt = self.learn(self._pieces.new)
            sizes = np.fromiter(map(len, learnt), dtype=np.int64, count=len(learnt))
            self._starts.frombytes((len(self._ids) + np.cumsum(sizes) - sizes).tobytes())
            self._lengths.frombytes(sizes.tobytes())
            self._ids.extend(chain.from_iterable(learnt))
            self._pieces.new = []
        starts, lengths = np.array(self._starts, dtype=np.int64)[which], np.array(self._lengths, dtype=np.int64)[which]
        ids = np.array(self._ids, dtype=np.uint32)[ragged(starts, lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[counts]


class WordTokenizer:
    """Encodes texts with a word-level vocabulary (every pre-token ends in a word-end piece)."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # the same model without the steps that do nothing to lower-cased plain pre-tokens: they are cut at blanks only
        self._plain = Tokenizer(self.library.model)
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), in_bytes])
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self._ends = np.zeros(max(vocabulary.values()) + 64, dtype=bool)
        self._ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._pretokens = PieceMemo(self._learn_pretokens, cache)

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pretokens(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens: many go to the library as one text, and are told apart by their word ends."""
        out: list[list[int]] = []
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            ids = self._plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            cuts = np.flatnonzero(self._ends[np.asarray(ids, dtype=np.int64)]) + 1 if ids else np.zeros(0, int)
            if len(cuts) == len(some):
                out += [ids[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]
            else:
                out += self._library_ids(some)
        return out

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``pieces`` in one array, and where each one's begin (one entry more than pieces)."""
        odd = pc.match_substring_regex(pieces, _ODD).to_numpy(zero_copy_only=False)
        some = pieces.filter(pa.array(~odd)) if odd.any() else pieces
        plain = pc.utf8_lower(_joined(some, "\n")).as_py()
        ids, at = self._pretokens.encode_parted(_PRETOKEN.findall(plain + "\n") if plain else [], "\n")
        if not odd.any():
            return ids, at
        found = self._library_ids(pieces.filter(pa.array(odd)).to_pylist())
        # the odd ones' ids lie behind all others
        starts, lengths = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        starts[~odd], lengths[~odd] = at[:-1], np.diff(at)
        lengths[odd] = list(map(len, found))
        starts[odd] = len(ids) + np.cumsum(lengths[odd]) - lengths[odd]
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(found), dtype=np.uint32)])
        return ids[ragged(starts, lengths)], np.concatenate([[0], np.cumsum(lengths)])

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (one entry more than texts)."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
        words = split.flatten().dictionary_encode()
        known, at = self._distinct(words.dictionary)
        which = words.indices.to_numpy()
        lengths = np.diff(at)[which]
        ids = known[ragged(at[:-1][which], lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[split.offsets.to_numpy()]


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file; loaded once, its dictionaries serve later tasks too."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def slices(texts: list[str] | pa.Array, most: int = SLICE):
    """Ranges ``(from, to)`` of about ``most`` characters each (bytes of an Arrow column; a longer text is alone)."""
    start = size = 0
    for i, n in enumerate(map(len, texts) if isinstance(texts, list) else pc.binary_length(texts).to_pylist()):
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` behind each text's, and where each text's begin then."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))
