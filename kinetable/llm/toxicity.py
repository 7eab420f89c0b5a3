"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns words into classes: insult, threat, target, intent, negation,
report, other. Small transducers then mark what surrounds an insult or threat in its clause
(negated, reported, aimed at someone) and are composed into one machine, whose best path is
taken. What counts are the matched clauses with their marks, not isolated words.

Insults and their stems with their weights are learned from labelled texts, and so is what each
kind of clause adds to the score (a logistic fit). The small word lists below only seed the
closed classes.
"""

from __future__ import annotations

import math
import re
import uuid
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import SPACE, map_texts, stored

#: labelled texts that the fit reads at most, and lexemes that it keeps at most
MAX_TRAIN_DOCS, MAX_LEXEMES = 20_000, 20_000
#: a lexeme is rarer than this (log 10) by chance, and at least so often toxic
SURPRISE, PRECISION = -5.0, 0.35
STEMS = (4, 5, 6)
THRESHOLD = 0.3
#: words on either side of a match that can change what it counts as: the transducers together reach no farther
REACH = 16
#: words of one clause that are looked at together; a longer one is looked at in parts that overlap by REACH
RUN = 2000

# seeds of the closed classes, in four languages
TARGETS = "you your yours u ur yourself du dich dir dein deine ihr euch tu toi ton ta vous votre te tú ti usted ustedes vosotros".split()
INTENTS = "will gonna shall going must werde werden va vais vas voy vamos".split()
THREATS = "kill hurt destroy punch beat stab shoot burn töten schlagen tuer frapper matar golpear".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = "said says say saying claimed wrote called quote quoted sagte sagt schrieb dit disait écrit dijo dice escribió".split()

KINDS = ("insult", "threat")
MARKS = ("aimed", "negated", "reported")
#: kinds of matched clauses, the features of the score
CLAUSES = ("plain", "aimed", "negated", "reported", "threat")

_CLAUSE_END = re.compile(r"[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»„]")


@dataclass
class Transducer:
    """Letter-to-letter weighted transducer. ``step(state, symbol)`` gives (state, symbol, weight) choices."""

    start: object
    step: object
    final: object = field(default=lambda state: True)

    def compose(self, other: Transducer) -> Transducer:
        """Reads what this reads and writes what ``other`` makes of this one's output."""

        def step(state, symbol):
            a, b = state
            return [((na, nb), out, wa + wb) for na, mid, wa in self.step(a, symbol) for nb, out, wb in other.step(b, mid)]

        return Transducer((self.start, other.start), step, lambda s: self.final(s[0]) and other.final(s[1]))

    def best(self, symbols: list) -> list:
        """Output of the heaviest accepted path."""
        paths = {self.start: (0.0, ())}
        for symbol in symbols:
            after: dict = {}
            for state, (weight, out) in paths.items():
                for new, made, w in self.step(state, symbol):
                    if new not in after or weight + w > after[new][0]:
                        after[new] = (weight + w, (out, made))
            paths = after
        out = max((p for s, p in paths.items() if self.final(s)), key=lambda p: p[0])[1]
        made = []
        while out:
            out, last = out
            made.append(last)
        return made[::-1]


def _before(cue: str, mark: str, reach: int) -> Transducer:
    """Marks an insult or threat that stands at most ``reach`` words after a cue. State: words left."""

    def step(left, symbol):
        kind, marks = symbol
        if kind == cue:
            return [(reach, symbol, 0.0)]
        if kind in KINDS and left:
            return [(left, (kind, marks | {mark}), 0.0)]
        return [(max(0, left - 1), symbol, 0.0)]

    return Transducer(0, step)


def _after(cue: str, mark: str, reach: int) -> Transducer:
    """Marks an insult or threat when a cue follows within ``reach`` words: guesses, and drops wrong guesses.

    State: words left in which the promised cue must come, 0 when none is promised.
    """

    def step(due, symbol):
        kind, marks = symbol
        if kind == cue:
            return [(0, symbol, 0.0)]
        if due == 1:
            return []
        keep = [(max(0, due - 1), symbol, 0.0)]
        if kind in KINDS and mark not in marks:
            keep.append((max(1, due - 1) if due else reach + 1, (kind, marks | {mark}), 1.0))
        return keep

    return Transducer(0, step, lambda due: due == 0)


def _threats() -> Transducer:
    """A harm verb is a threat only when aimed at someone or intended; else it is an ordinary word."""

    def step(left, symbol):
        kind, marks = symbol
        if kind == "intent":
            return [(4, symbol, 0.0)]
        if kind == "threat" and not (left or "aimed" in marks):
            return [(max(0, left - 1), ("other", frozenset()), 0.0)]
        return [(max(0, left - 1), symbol, 0.0)]

    return Transducer(0, step)


GRAMMAR = (
    _before("negation", "negated", 3)
    .compose(_before("report", "reported", 6))
    .compose(_before("target", "aimed", 4))
    .compose(_after("target", "aimed", 3))
    .compose(_threats())
)


class Lexicon:
    """Word to (class, weight): whole words first, else the longest stem."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.words, self.stems = words, stems
        self.closed = {}
        for kind, entries in (("target", TARGETS), ("intent", INTENTS), ("negation", NEGATIONS), ("report", REPORTS)):
            self.closed.update(dict.fromkeys(entries, kind))
        self.harm = set(THREATS)
        self.finder = ahocorasick.Automaton()
        for entry in {*stems, *(w for w, v in words.items() if v > 0), *self.harm}:
            self.finder.add_word(entry, len(entry))
        self.finder.make_automaton()

    def look(self, word: str) -> tuple[str, float]:
        if word in self.words:
            weight = self.words[word]
            return ("insult", weight) if weight > 0 else ("other", 0.0)
        for k in STEMS[::-1]:
            if word[:k] in self.stems and len(word) >= k:
                return "insult", self.stems[word[:k]]
        if word in self.harm:
            return "threat", 2.0
        if word in '"“”«»„':
            return "report", 0.0
        return self.closed.get(word, "other"), 0.0

    def clauses(self, text: str | None) -> np.ndarray:
        """Summed weights of the matched clauses of a text by kind (CLAUSES)."""
        out = np.zeros(len(CLAUSES))
        if not text or not len(self.finder):
            return out
        text = text.lower()
        done = 0
        for end, size in self.finder.iter(text):
            begin = end - size + 1
            # a lexeme starts a word
            if begin < done or (begin and text[begin - 1].isalpha()):
                continue
            found = self._before(text, begin)
            fresh = len(found)
            looked = [self.look(m[0]) for m in found]
            last = fresh
            for m in _WORD.finditer(text, begin):
                if _CLAUSE_END.search(text, found[-1].end() if len(found) > fresh else begin, m.start()):
                    break
                found.append(m)
                looked.append(self.look(m[0]))
                if looked[-1][0] in KINDS:
                    last = len(found) - 1
                # no match for so many words, or a clause that does not end
                if len(found) - 1 - last >= REACH or len(found) - fresh >= RUN:
                    break
            # what stands near the end of a run that goes on is counted with the next
            counted = len(found) - REACH if len(found) - fresh >= RUN else len(found)
            done = found[counted - 1].end()
            if not any(kind in KINDS for kind, _ in looked[fresh:counted]):
                continue
            best = GRAMMAR.best([(k, frozenset()) for k, _ in looked])
            for (kind, marks), (_, weight) in list(zip(best, looked, strict=True))[fresh:counted]:
                if kind == "threat":
                    out[4] += weight
                elif kind == "insult":
                    place = 2 if "negated" in marks else 3 if "reported" in marks else 1 if "aimed" in marks else 0
                    out[place] += weight
        return out

    @staticmethod
    def _before(text: str, begin: int) -> list[re.Match]:
        """The last REACH words of the clause before a place; they are context and were counted before."""
        span = REACH * 12
        while True:
            low = max(0, begin - span)
            left = max(text.rfind(c, low, begin) for c in ".!?;:\n") + 1
            found = list(_WORD.finditer(text, max(left, low), begin))
            if left or not low:
                return found[-REACH:]
            # the first word may be cut
            if len(found) > REACH:
                return found[-REACH:]
            span *= 2


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    weights: np.ndarray

    def score(self, features: np.ndarray) -> float:
        z = float(self.weights[0] + np.log1p(np.maximum(features, 0)) @ self.weights[1:])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _log10_tail(hits: int, total: int, base: float) -> float:
    """Upper bound (Chernoff) of log 10 of the chance of so many hits at rate ``base``."""
    rate = hits / total
    if rate <= base:
        return 0.0
    kl = rate * math.log(rate / base) + (0.0 if rate == 1 else (1 - rate) * math.log((1 - rate) / (1 - base)))
    return -total * kl / math.log(10)


def learn_lexicon(counts: list[tuple[str, bool, int, int]], toxic: int, clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with weights from (lexeme, is_stem, toxic texts, clean texts)."""
    if not toxic or not clean:
        return {}, {}
    base = toxic / (toxic + clean)
    prior = math.log(base / (1 - base))

    def weight(p: float) -> float:
        return math.log(p / (1 - p)) - prior

    def good(a: int, b: int) -> bool:
        return a / (a + b) >= PRECISION and _log10_tail(a, a + b, base) <= SURPRISE

    stems: dict[str, float] = {}
    for name, is_stem, a, b in sorted(counts, key=lambda r: (len(r[0]), r[0])):
        # a longer stem is kept only where it is purer than the one it extends
        if is_stem and good(a, b):
            p = (a + 0.5) / (a + b + 1)
            if weight(p) > 0.5 + max([stems[name[:k]] for k in STEMS if k < len(name) and name[:k] in stems], default=0.0):
                stems[name] = weight(p)
    words = {}
    for name, is_stem, a, b in counts:
        if not is_stem:
            stem = next((stems[name[:k]] for k in STEMS[::-1] if len(name) >= k and name[:k] in stems), None)
            if stem is not None and a + b >= 3:
                p_stem = 1 / (1 + math.exp(-(stem + prior)))
                words[name] = weight((a + 2 * p_stem) / (a + b + 2))
            elif stem is None and good(a, b):
                words[name] = weight((a + 0.5) / (a + b + 1))
    return words, stems


def fit_weights(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic fit by Newton steps; first weight is the bias."""
    x = np.hstack([np.ones((len(labels), 1)), np.log1p(np.maximum(features, 0))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + keep * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(keep), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(labelled: DataFrame, text: str = "text", label: str = "toxic") -> Model:
    """Model from labelled texts (a bounded sample: the caller gives at most MAX_TRAIN_DOCS).

    Copies count once, else the words of a copied toxic text would look toxic. Lexeme counts are
    made and summed by Spark; the driver sees the significant lexemes and five numbers per
    training text. Null labels and texts are left out. Without texts of both labels nothing is
    toxic.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(text).alias("text"), (F.col(label) > 0).alias("toxic"))
    rows = without_copies(rows)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Model({}, {}, np.array([-4.0] + [1.0] * len(CLAUSES)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for value, is_toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in re.findall(r"[^\W\d_]{3,30}", value.lower())}
                totals[is_toxic].update(words)
                totals[is_toxic].update({w[:k] + "*" for w in words for k in STEMS if len(w) >= k})
            if len(totals[0]) + len(totals[1]) > 500_000:
                yield from emit(totals)
        yield from emit(totals)

    def emit(totals: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        names = list({*totals[0], *totals[1]})
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([totals[1][n] for n in part], pa.int64()), pa.array([totals[0][n] for n in part], pa.int64())],
                names=["name", "a", "b"],
            )
        totals[0].clear()
        totals[1].clear()

    summed = rows.mapInArrow(count, "name string, a bigint, b bigint").groupBy("name").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # three texts and the wanted precision at least; significance is looked at on the driver
    likely = summed.where((F.col("a") >= 3) & (F.col("a") >= (F.col("a") + F.col("b")) * PRECISION / 2))
    kept = likely.orderBy(F.desc(F.col("a") * F.col("a") / (F.col("a") + F.col("b"))), "name").limit(MAX_LEXEMES + 1).collect()
    if len(kept) > MAX_LEXEMES:
        kept.pop()
        warnings.warn(f"toxicity: {likely.count() - MAX_LEXEMES} lexemes beyond the first {MAX_LEXEMES} are left out of the lexicon", stacklevel=2)
    words, stems = learn_lexicon([(r["name"].rstrip("*"), r["name"].endswith("*"), r["a"], r["b"]) for r in kept], toxic, clean)
    matched = _features(rows, ["toxic"], words, stems).collect()
    features = np.array([r["features"] for r in matched])
    return Model(words, stems, fit_weights(features, np.array([r["toxic"] for r in matched], float)))


def _salted(k: int):
    return lambda h: F.xxhash64(F.lit(k), h)


def without_copies(rows: DataFrame, signatures: int = 3) -> DataFrame:
    """One row of each group of exact copies, and of most near copies: those that share a least hash of three words.

    Three least hashes are looked at one after the other; the groups are formed on hashes, and
    the texts that stay are written once.
    """
    words = F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "")
    marked = rows.withColumn("_hash", F.xxhash64("text")).dropDuplicates(["_hash"])
    marked = marked.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    marked = stored(marked.withColumn("_windows", windows).drop("_words"), "toxicity")
    least = [F.coalesce(F.array_min(F.transform("_windows", _salted(k))), "_hash") for k in range(signatures)]
    kept = marked.select("_hash", *[x.alias(f"_m{k}") for k, x in enumerate(least)])
    for k in range(signatures):
        # the smallest hash of a group stays, whatever the order of the rows
        kept = kept.groupBy(f"_m{k}").agg(F.min_by(F.struct(*kept.columns), "_hash").alias("_row")).select("_row.*")
    return marked.join(kept.select("_hash"), "_hash").select("text", "toxic")


_LEXICONS: dict[str, Lexicon] = {}


def _features(rows: DataFrame, keep: list[str], words: dict, stems: dict) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((words, stems))
    name = uuid.uuid4().hex

    def find(texts: list[str | None]) -> list[list]:
        if name not in _LEXICONS:
            _LEXICONS.clear()
            _LEXICONS[name] = Lexicon(*shared.value)
        own = _LEXICONS[name]
        return [[own.clauses(t).tolist() for t in texts]]

    return map_texts(rows, "text", keep, [("features", "array<double>", pa.list_(pa.float64()))], find)


def score(docs: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``keep``, clauses (array of weights by CLAUSES), score, predicted: one row per row, no shuffle.

    A null or empty text matches no clause and gets the score of such a text. Every matched word counts
    once, however long its clause; a long text is read in runs of bounded length. Repeated rows get the
    same score; columns of ``keep`` may have any names but those three.
    """
    found = _features(docs.withColumn("text", F.col(text)), keep, model.words, model.stems)
    z = F.lit(float(model.weights[0]))
    for i, w in enumerate(model.weights[1:]):
        z = z + F.log1p(F.greatest(F.lit(0.0), F.get("features", F.lit(i)))) * float(w)
    score_col = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    scored = found.withColumn("score", score_col)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).withColumnRenamed("features", "clauses")
