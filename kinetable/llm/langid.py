"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability
of a word is the sum over all its segmentations into pieces, by the forward algorithm; a text
is the product of its words. The piece probabilities are fitted by expectation maximisation:
the expected piece counts of all segmentations, by forward and backward sums, over the words
of a bounded sample of the labelled texts. Prediction covers every whole text.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import map_texts, stored

MARK = "▁"
UNKNOWN = "und"
#: labelled texts that the fit reads at most; the caller takes the sample
MAX_TRAIN_DOCS = 20_000
#: more languages than this are refused: the model of languages x vocabulary goes to every task
MAX_LANGUAGES = 500
EM_STEPS = 2
SMOOTH = 0.05
#: words of this length are scored many at a time; of a longer one only the sums over the longest piece are held
MAX_WORD = 64
KEPT_WORDS, KEPT_CHARS = 600_000, 200

#: letters with the marks that belong to them, by their Unicode classes: no digits, fractions, or numbers made of letters
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    """Lower-case stretches of letters and marks, marked at the start; other characters say nothing about a language."""
    return [MARK + w for w in _WORD.findall(text.lower())]


def fitted_parts(text: str) -> list[str]:
    """``words_of`` for the fit, which takes a long stretch in parts; only the first one starts a word."""
    out = []
    for w in words_of(text):
        out += [w] if len(w) <= MAX_WORD else [w[i : i + MAX_WORD] for i in range(0, len(w), MAX_WORD)]
    return out


class Vocabulary:
    """Lower-case pieces of a model file, as a number each; single characters outside share one number each by class."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                p = model.id_to_piece(i)
                if regex.fullmatch(MARK + r"?[\p{L}\p{M}]*", p) and p == p.lower() and p:
                    pieces.append(p)
        self.ids = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        #: a character that is no piece
        self.other = len(self.ids)
        self.size = len(self.ids) + 1
        self.longest = max(map(len, self.ids))
        # pieces by a rolling hash, so that all parts of many words are looked up at once
        hashes = np.array([int(_rolling(_codes([p]))[0, -1]) for p in self.ids], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.piece_of = hashes[order], order.astype(np.int32)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.taken = np.zeros(1 << _SLOT_BITS, bool)
        self.taken[_slot(hashes)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of every hash, ``size`` where there is none."""
        out = np.full(hashes.shape, self.size, np.int32)
        maybe = self.taken[_slot(hashes)]
        some = hashes[maybe]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == some, self.piece_of[at], self.size)
        return out


_BASE, _SPREAD, _SLOT_BITS = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93), 22


def _codes(words: list[str]) -> np.ndarray:
    """Code points plus one of words of equal length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64) + np.uint64(1)


def _rolling(codes: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes; that of a part follows from the prefixes at its ends."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * np.uint64(_BASE) + codes[:, j]
    return out


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _SPREAD) >> np.uint64(64 - _SLOT_BITS)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """The lattices of many words of one length as arrays: for each (end, width) the piece of every word, or none."""

    def __init__(self, vocab: Vocabulary, words: list[str]) -> None:
        self.length, self.count = len(words[0]), len(words)
        width = min(self.length, vocab.longest)
        # the last row of the tables has probability 0: no such piece
        self.piece = np.full((self.length + 1, width + 1, self.count), vocab.size, np.int32)
        prefixes = _rolling(_codes(words))
        for k in range(1, width + 1):
            found = vocab.find(prefixes[:, k:] - prefixes[:, :-k] * np.uint64(pow(_BASE, k, 1 << 64)))
            if k == 1:
                # every character has a piece
                found[found == vocab.size] = vocab.other
            self.piece[k:, k] = found.T
        some = (self.piece != vocab.size).any(axis=2)
        self.used = [np.flatnonzero(row).tolist() for row in some]

    def forward(self, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward sums (position, word, language), rescaled at each position, and the log of the scale."""
        alpha = np.zeros((self.length + 1, self.count, probs.shape[1]))
        scale = np.zeros((self.length + 1, self.count))
        alpha[0] = 1.0
        for j in range(1, self.length + 1):
            for k in self.used[j]:
                alpha[j] += alpha[j - k] * np.exp(scale[j - k] - scale[j - 1])[:, None] * probs[self.piece[j, k]]
            top = alpha[j].max(axis=1)
            alpha[j] /= top[:, None]
            scale[j] = scale[j - 1] + np.log(top)
        return alpha, scale

    def log_probs(self, probs: np.ndarray) -> np.ndarray:
        """Log probability of every word in every language, all segmentations together."""
        alpha, scale = self.forward(probs)
        return np.log(np.maximum(alpha[-1], 1e-300)) + scale[-1][:, None]

    def expected(self, probs: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
        """Add the expected piece counts; ``counts`` (word, language) says how often each word occurs."""
        alpha, scale = self.forward(probs)
        beta, back = np.zeros_like(alpha), np.zeros_like(scale)
        beta[-1] = 1.0
        for i in range(self.length - 1, -1, -1):
            for k in range(1, self.piece.shape[1]):
                if i + k <= self.length and k in self.used[i + k]:
                    beta[i] += beta[i + k] * np.exp(back[i + k] - back[i + 1])[:, None] * probs[self.piece[i + k, k]]
            top = beta[i].max(axis=1)
            beta[i] /= top[:, None]
            back[i] = back[i + 1] + np.log(top)
        whole = np.maximum(alpha[-1], 1e-300)
        for j in range(1, self.length + 1):
            for k in self.used[j]:
                shift = np.exp(scale[j - k] + back[j] - scale[-1])[:, None]
                share = alpha[j - k] * probs[self.piece[j, k]] * beta[j] * shift / whole * counts
                np.add.at(out, self.piece[j, k], share)


def long_log_probs(vocab: Vocabulary, word: str, probs: np.ndarray, step: int = 4096) -> np.ndarray:
    """``Lattices.log_probs`` of one word of any length: the sums over the last positions that a piece can reach are held."""
    width, languages = vocab.longest, probs.shape[1]
    powers = np.array([pow(_BASE, k, 1 << 64) for k in range(1, width + 1)], np.uint64)
    # row k - 1: the sums k positions before the next one
    held, scale = np.zeros((width, languages)), np.zeros(languages)
    held[0] = 1.0
    for start in range(0, len(word), step):
        stop = min(len(word), start + step)
        first = max(0, start - width)
        prefixes = _rolling(_codes([word[first:stop]]))[0]
        pieces = np.full((stop - start, width), vocab.size, np.int32)
        for k in range(1, width + 1):
            ends = np.arange(max(start + 1, k), stop + 1)
            if len(ends):
                found = vocab.find(prefixes[ends - first] - prefixes[ends - first - k] * powers[k - 1])
                if k == 1:
                    found[found == vocab.size] = vocab.other
                pieces[ends - start - 1, k - 1] = found
        for row in pieces:
            new = np.einsum("kl,kl->l", held, probs[row])
            held[1:] = held[:-1]
            held[0] = new
            # each language by its own scale: over a long word they drift apart without end
            if new.min() < 1e-100:
                held /= new
                scale += np.log(new)
    return np.log(held[0]) + scale


def by_length(words: list[str], most: int = 4096) -> Iterator[list[int]]:
    """Places of words of equal length, some thousand at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, places in groups.items():
        step = max(64, most * 8 // length)
        for at in range(0, len(places), step):
            yield places[at : at + step]


def blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Pieces of about ``size`` characters, cut at white space."""
    at, end = 0, len(text)
    while at < end:
        stop = min(end, at + size)
        while stop < end and not text[stop].isspace():
            stop += 1
        yield text[at:stop]
        at = stop


class Scorer:
    """Scores of one model, remembered in a Python worker.

    Everything between white space is looked up as a whole; what is remembered is the sum over
    its words. The last column of a row counts the words, so a text without letters shows.
    """

    def __init__(self, path: str, languages: list[str], log_table: np.ndarray, prior: np.ndarray) -> None:
        self.vocab, self.languages, self.prior = vocabulary(path), languages, prior
        self.probs = np.exp(np.vstack([log_table, np.full((1, len(languages)), -np.inf)]))
        self.forget()

    def forget(self) -> None:
        # row 0: no word
        self.rows, self.used = np.zeros((1024, len(self.languages) + 1)), 1
        self.words: dict[str, int] = {}
        self.index: dict[str, int] = {}

    def _add(self, rows: np.ndarray) -> int:
        first, self.used = self.used, self.used + len(rows)
        if self.used > len(self.rows):
            self.rows = np.vstack([self.rows[:first], np.zeros((max(len(self.rows), len(rows)), self.rows.shape[1]))])
        self.rows[first : self.used] = rows
        return first

    def learn(self, tokens: list[str]) -> None:
        parts = [words_of(t) for t in tokens]
        fresh = list({w for words in parts for w in words if w not in self.words})
        long = [w for w in fresh if len(w) > MAX_WORD]
        if long:
            logs = np.array([long_log_probs(self.vocab, w, self.probs) for w in long])
            first = self._add(np.hstack([logs, np.ones((len(long), 1))]))
            self.words.update(zip(long, range(first, first + len(long)), strict=True))
            fresh = [w for w in fresh if len(w) <= MAX_WORD]
        for places in by_length(fresh):
            some = [fresh[i] for i in places]
            logs = Lattices(self.vocab, some).log_probs(self.probs)
            first = self._add(np.hstack([logs, np.ones((len(some), 1))]))
            self.words.update(zip(some, range(first, first + len(some)), strict=True))
        joined = [(t, words) for t, words in zip(tokens, parts, strict=True) if len(words) > 1]
        if joined:
            first = self._add(np.array([self.rows[[self.words[w] for w in words]].sum(axis=0) for _, words in joined]))
            self.index.update((t, first + i) for i, (t, _) in enumerate(joined))
        self.index.update((t, self.words[words[0]] if words else 0) for t, words in zip(tokens, parts, strict=True) if len(words) < 2)

    def predict(self, texts: list[str | None]) -> list[list]:
        langs, scores = [], []
        split = [t.split() if t and len(t) < 1 << 20 else None for t in texts]
        self.learn(list({w for tokens in split if tokens for w in tokens if w not in self.index}))
        for text, tokens in zip(texts, split, strict=True):
            total = np.zeros(len(self.languages) + 1)
            for some in [tokens] if tokens else map(str.split, blocks(text or "")):
                if tokens is None:
                    self.learn(list({w for w in some if w not in self.index}))
                total += self.rows[list(map(self.index.__getitem__, some))].sum(axis=0)
                if tokens is None and len(self.index) > 2 * KEPT_WORDS:
                    # only inside a single huge text; the texts around it are learned anew when needed
                    self.forget()
                    self.learn(list({w for rest in split if rest for w in rest}))
            if not total[-1]:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            logs = total[:-1] + self.prior
            best = int(logs.argmax())
            langs.append(self.languages[best])
            scores.append(float(1 / np.exp(np.minimum(logs - logs[best], 0)).sum()))
        if len(self.index) > KEPT_WORDS:
            self.forget()
        for known in (self.words, self.index):
            for w in [w for w in known if len(w) > KEPT_CHARS]:
                del known[w]
        return [langs, scores]


_SCORERS: dict[str, Scorer] = {}


def train(labelled: DataFrame, vocab_path: str, text: str = "text", lang: str = "lang", steps: int = EM_STEPS):
    """Languages, log piece table (pieces x languages) and log prior from labelled texts.

    ``labelled`` is a bounded sample (MAX_TRAIN_DOCS). The words are counted by Spark, the
    expected counts of every step are summed by Spark; the driver holds languages x vocabulary
    numbers. Null languages and texts are left out.
    """
    sampled = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                totals: dict[str, Counter] = {}
                for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    totals.setdefault(name, Counter()).update(fitted_parts(value))
                rows = [(name, w, n) for name, c in totals.items() for w, n in c.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())],
                    names=["lang", "word", "n"],
                )

    partial = sampled.mapInArrow(count, "lang string, word string, n bigint")
    words = stored(partial.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in sizes]
    vocab = vocabulary(vocab_path)
    # start: a piece is as likely as its length makes it, alike in all languages
    start = np.array([0.02 ** len(p) for p in vocab.ids] + [1e-6])
    table = np.repeat(np.log(start / start.sum())[:, None], len(languages), axis=1)
    for _ in range(steps if languages else 0):
        shared = words.sparkSession.sparkContext.broadcast(table)

        def expect(frames: Iterator[pd.DataFrame], shared=shared, languages=tuple(languages)) -> Iterator[pd.DataFrame]:
            own = vocabulary(vocab_path)
            probs = np.exp(np.vstack([shared.value, np.full((1, len(languages)), -np.inf)]))
            column = {name: i for i, name in enumerate(languages)}
            total, any_rows = np.zeros((own.size + 1, len(languages))), False
            for frame in frames:
                any_rows = True
                names = frame["word"].tolist()
                which, counts = frame["lang"].map(column).to_numpy(), frame["n"].to_numpy()
                for places in by_length(names):
                    weight = np.zeros((len(places), len(languages)))
                    weight[np.arange(len(places)), which[places]] = counts[places]
                    Lattices(own, [names[i] for i in places]).expected(probs, weight, total)
            if any_rows:
                at, of = np.nonzero(total[:-1])
                yield pd.DataFrame({"piece": at.astype("int32"), "of": of.astype("int32"), "n": total[at, of]})

        summed = words.select("lang", "word", "n").mapInPandas(expect, "piece int, of int, n double").groupBy("piece", "of").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full(table.shape, SMOOTH)
        counts[summed["piece"], summed["of"]] += summed["n"]
        table = np.log(counts / counts.sum(axis=0))
        shared.destroy()
    total = sum(r["n"] for r in sizes)
    prior = np.log(np.array([r["n"] for r in sizes], float) / total) if languages else np.zeros(0)
    return languages, table, prior


def predict(docs: DataFrame, keep: list[str], model, vocab_path: str, text: str = "text") -> DataFrame:
    """``keep``, lang_pred, score: one row per row of ``docs``, no shuffle.

    Null texts and texts without a letter (a character of the Unicode class L) are ``und`` with score 0,
    and so is everything when the model has no language. A stretch of letters of any length is one word.
    Equal posteriors go to the language first in order; repeated rows get the same. The score is the posterior probability of the language.
    """
    languages, table, prior = model
    shared = docs.sparkSession.sparkContext.broadcast((languages, table.astype(np.float32), prior))
    name = uuid.uuid4().hex

    def score(texts: list[str | None]) -> list[list]:
        if not languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        if name not in _SCORERS:
            _SCORERS.clear()
            langs, logs, start = shared.value
            _SCORERS[name] = Scorer(vocab_path, langs, logs, start)
        return _SCORERS[name].predict(texts)

    return map_texts(docs, text, keep, [("lang_pred", "string", pa.string()), ("score", "double", pa.float64())], score)
