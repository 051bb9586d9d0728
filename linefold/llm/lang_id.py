"""Language identification by segmentation-marginalised unigrams.

Per language, every piece of a fixed public vocabulary has a probability. The
probability of a word (a run of letters, lower-cased, with a word-start mark)
is the sum over all its segmentations into pieces, by the forward algorithm; a
text's is the product over its words. The predicted language has the largest
posterior under equal priors; ``score`` is that posterior.

The probabilities are fitted by expectation maximisation on a bounded sample
of labelled rows: ``per_language`` texts of each label, those with the smallest
hash of their id, whose counts of words come to the driver; more than ``LABELS`` labels are an error. A word is scored once per worker dictionary, whole words and
whole texts always.

Defined results: ``und`` with score 0 for a null text, a text without letters,
or if there was nothing to learn from. Ties go to the first language in
alphabetical order. A null id counts as the empty text where rows are split.
Characters outside the vocabulary have one small fixed probability, the same in every language, so a text in an
unlearnt script has a very low mean log probability a letter (``fit``), whatever its score.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from linefold.llm.common import give_back, materialize, ship
from linefold.llm.tokens import Numbered, slices, vocabulary_path

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
PER_LANGUAGE = 200
ROUNDS = 3
SMOOTHING = 0.1
#: Probability of a character outside the vocabulary, the same in every language.
UNKNOWN = 1e-6
#: Letters of a part of a word that the fit takes at a time, and labels that it can tell apart.
PART, LABELS = 60, 500
#: Entries a worker's dictionary of pieces of text may hold before it is emptied.
CACHE = 300_000
UND = "und"

_LETTERS = regex.compile(r"\p{L}+")
_START = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: list[str], n: int) -> np.ndarray:
    """Code points of words of ``n`` characters, a row each."""
    return np.array(words, dtype=f"<U{n}").view(np.uint32).reshape(len(words), n).astype(np.uint64)


def _prefix_hashes(codes: np.ndarray) -> list[np.ndarray]:
    hashes = [np.zeros(len(codes), np.uint64)]
    for j in range(codes.shape[1]):
        hashes.append(hashes[-1] * _BASE + codes[:, j] + np.uint64(1))
    return hashes


def vocabulary_pieces(path: str) -> list[str]:
    """Lower-cased pieces of letters (with or without the word-start mark) of a sentencepiece vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not model.is_byte(i)}
    return sorted(p for p in pieces if p and _LETTERS.fullmatch(p.removeprefix(_START) or "a"))


class Unigrams:
    """Piece probabilities per language, and the forward sums over segmentations."""

    def __init__(self, pieces: list[str], languages: list[str]):
        self.languages = languages
        self.longest = max(map(len, pieces))
        self._powers = [np.uint64(pow(int(_BASE), k, 2**64)) for k in range(self.longest + 1)]
        keys = np.zeros(len(pieces), np.uint64)
        for n in {len(p) for p in pieces}:
            at = [i for i, p in enumerate(pieces) if len(p) == n]
            keys[at] = _prefix_hashes(_codes([pieces[i] for i in at], n))[-1]
        order = np.argsort(keys)
        self.keys = keys[order]
        if (np.diff(self.keys) == 0).any():
            raise ValueError("two pieces share a hash")
        # row -1: not a piece; row -2: a character that is no piece
        self.p = np.full((len(pieces) + 2, len(languages)), 1.0 / (len(pieces) + 1))
        self.p[-2], self.p[-1] = UNKNOWN, 0.0

    def _rows(self, hashes: list[np.ndarray], i: int, j: int) -> np.ndarray:
        """Row of the piece from ``i`` to ``j`` in every word."""
        with np.errstate(over="ignore"):
            h = hashes[j] - hashes[i] * self._powers[j - i]
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, len(self.p) - (2 if j - i == 1 else 1))

    def log_words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), len(self.languages)))
        marked = [_START + w for w in words]
        lengths = np.array([len(w) for w in marked])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            with np.errstate(over="ignore"):
                hashes = _prefix_hashes(_codes([marked[i] for i in at], int(n)))
            alpha: dict[int, np.ndarray] = {0: np.ones((len(at), len(self.languages)))}
            scale = np.zeros_like(alpha[0])
            for j in range(1, n + 1):
                total = np.zeros_like(scale)
                for i in range(max(0, j - self.longest), j):
                    total += alpha[i] * self.p[self._rows(hashes, i, j)]
                alpha[j] = total
                alpha.pop(j - self.longest, None)
                if j % 16 == 0:  # keeps long words in range; each language has its own scale
                    scale += np.log(total)
                    alpha = {i: a / total for i, a in alpha.items()}
            out[at] = np.log(alpha[n]) + scale
        return out

    def fit(self, words: list[str], counts: np.ndarray, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> None:
        """Expectation maximisation over words and their counts per language (a very long word is learnt in parts)."""
        parts = [(w[i : i + PART], k) for k, w in enumerate(words) for i in range(0, len(w), PART)]
        marked, counts = [_START + w for w, _ in parts], counts[[k for _, k in parts]]
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(marked):
            groups.setdefault(len(w), []).append(k)
        prepared = []
        for n, at in sorted(groups.items()):
            with np.errstate(over="ignore"):
                hashes = _prefix_hashes(_codes([marked[k] for k in at], n))
            spans = []
            for j in range(1, n + 1):
                for i in range(max(0, j - self.longest), j):
                    rows = self._rows(hashes, i, j)
                    hit = np.flatnonzero(rows < len(self.p) - 1)
                    if len(hit):
                        spans.append((i, j, hit, rows[hit]))
            prepared.append((n, np.array(at), spans))
        for _ in range(rounds):
            expected = np.zeros_like(self.p)
            for n, at, spans in prepared:
                alpha = np.zeros((n + 1, len(at), len(self.languages)))
                beta = np.zeros_like(alpha)
                alpha[0] = beta[n] = 1.0
                for i, j, hit, rows in spans:  # by ascending end
                    alpha[j, hit] += alpha[i, hit] * self.p[rows]
                for i, j, hit, rows in sorted(spans, key=lambda s: -s[0]):
                    beta[i, hit] += beta[j, hit] * self.p[rows]
                weight = counts[at] / np.maximum(alpha[n], 1e-300)
                for i, j, hit, rows in spans:
                    np.add.at(expected, rows, alpha[i, hit] * self.p[rows] * beta[j, hit] * weight[hit])
            smoothed = expected[:-2] + smoothing
            self.p[:-2] = smoothed / smoothed.sum(axis=0)  # a character outside the vocabulary speaks for no language


class Scorer:
    """Sums the words of whole texts, with a bounded dictionary of blank-separated pieces of text."""

    def __init__(self, model: Unigrams, cache: int = CACHE):
        self.model, self.cache = model, cache
        self._forget()

    def _forget(self) -> None:
        self._pieces = Numbered()
        # of a piece: a sum for each language, its words and its letters
        self._logs = np.zeros((0, len(self.model.languages) + 2))

    def _learn(self, pieces: list[str]) -> None:
        words = Numbered()
        which, counts, letters = array("q"), [], []
        for p in pieces:
            found = _LETTERS.findall(p.lower())
            which.extend(map(words.__getitem__, found))
            counts.append(len(found))
            letters.append(sum(map(len, found)))
        logs = np.zeros((len(pieces), self._logs.shape[1]))
        if words:
            per_word = self.model.log_words(words.new)
            rows = np.repeat(np.arange(len(pieces)), counts)
            at = np.frombuffer(which, dtype=np.int64)
            for k in range(per_word.shape[1]):
                logs[:, k] = np.bincount(rows, per_word[at, k], minlength=len(pieces))
            logs[:, -2], logs[:, -1] = counts, letters
        self._logs = np.concatenate([self._logs, logs])

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, posterior, and mean log probability a letter of each text."""
        texts = [t or "" for t in texts]
        languages = self.model.languages
        names, scores, fits = [], np.zeros(len(texts)), np.zeros(len(texts))
        for a, b in slices(texts):
            if len(self._pieces) > self.cache:
                self._forget()
            number, numbers, counts = self._pieces.__getitem__, array("q"), []
            for t in texts[a:b]:
                pieces = t.split()
                numbers.extend(map(number, pieces))
                counts.append(len(pieces))
            if self._pieces.new:
                self._learn(self._pieces.new)
                self._pieces.new = []
            rows = np.repeat(np.arange(b - a), counts)
            at = np.frombuffer(numbers, dtype=np.int64) if numbers else np.zeros(0, np.int64)
            sums = np.stack([np.bincount(rows, self._logs[at, k], minlength=b - a) for k in range(self._logs.shape[1])], 1)
            best = sums[:, :-2].argmax(axis=1) if languages else np.zeros(b - a, int)
            for i in range(a, b):
                if not languages or sums[i - a, -1] == 0:
                    names.append(UND)
                else:
                    names.append(languages[best[i - a]])
                    logs = sums[i - a, :-2]
                    scores[i] = 1.0 / np.exp(logs - logs.max()).sum()
                    fits[i] = logs.max() / sums[i - a, -1]
        return names, scores, fits


def is_held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 1 by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    vocabulary: str | None = None,
) -> Unigrams:
    """Fit on at most ``per_language`` rows of each label, none of them held out.

    Hashes of id and text are ranked without the texts, and Spark keeps the first ``per_language`` of a label in each
    task before the shuffle. The chosen rows' words are counted in tasks, and the counts come to the driver.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"))
    labelled = rows.filter(F.col("l").isNotNull() & ~is_held_out(F.col("i")) & (F.length(F.col("t")) > 0))
    labelled = labelled.withColumns({"hi": F.xxhash64("i"), "ht": F.xxhash64("t")})
    first = F.row_number().over(Window.partitionBy("l").orderBy("hi", "ht"))
    ranked = labelled.select("l", "hi", "ht").withColumn("n", first).filter(F.col("n") <= per_language)
    ranked = materialize(ranked.select("l", "hi", "ht").distinct(), "sample")  # per_language rows a label
    languages = sorted(r["l"] for r in ranked.select("l").distinct().limit(LABELS + 1).collect())
    if len(languages) > LABELS:
        raise ValueError(f"more than {LABELS} labels in {lang_col}")
    chosen = labelled.join(F.broadcast(ranked), ["l", "hi", "ht"]).groupBy("l", "hi", "ht").agg(F.min("t").alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(_LETTERS.findall(text.as_py().lower()))
                columns = [pa.array([label] * len(found), pa.string()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["l", "w", "c"])

    ship(docs.sparkSession)
    found = chosen.select("l", "t").mapInArrow(count, "l string, w string, c long").groupBy("l", "w").agg(F.sum("c").alias("c"))
    words = Numbered()
    seen = [(words[r["w"]], languages.index(r["l"]), r["c"]) for r in sorted(found.collect())]
    counts = np.zeros((len(words), len(languages)))
    for n, k, c in seen:
        counts[n, k] = c
    model = Unigrams(vocabulary_pieces(vocabulary or vocabulary_path(DEFAULT_VOCABULARY)), languages)
    if words:
        model.fit(words.new, counts)
    return model


def predict(
    docs: DataFrame, model: Unigrams, text_col: str = "text", lang: str = "lang_pred", score: str = "score", fit: str | None = None
) -> DataFrame:
    """``docs`` with the predicted language and its posterior (in place of columns that are called so already).

    With ``fit`` also the mean log probability a letter in that language, an absolute measure of how well the text is
    explained (0 for ``und``).
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # vocabulary size times languages, whatever the input

    @pandas_udf("lang string, score double, fit double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # a task's own dictionary: a worker that serves other stages later does not keep it
        scorer = Scorer(shared.value)
        for text in texts:
            names, scores, fits = scorer(text.tolist())
            yield pd.DataFrame({"lang": names, "score": scores, "fit": fits})
        scorer = text = names = scores = fits = None
        give_back()

    found = scored.asNondeterministic()(F.col(text_col))  # so that a filter above does not run it twice
    added = [lang, score, *([fit] if fit else [])]
    kept = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), found.alias("_found"))
    return out.select("_row.*", *[F.col(f"_found.{c}").alias(a) for c, a in zip(("lang", "score", "fit"), added)])
