"""Token counts by rank-synchronous array merging.

The words of a batch are held as ragged numpy arrays of symbols. In every round each sequence
merges its lowest-rank pair, all sequences at the same time, until no pair is left; what is
counted are the surviving symbols. A long word is cut between characters that no piece holds side by
side, and what is still long merges by a heap over its arrays, in n log n. The vocabulary and its ranks come from a SentencePiece BPE
model file; the merging is done here. Words never join over a space, so a word is merged once
per worker and looked up afterwards.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import map_texts

MARK = "▁"
NONE = np.iinfo(np.int64).max
#: words kept with their count in each Python worker, and the longest word kept
KEPT_WORDS, KEPT_CHARS = 400_000, 200

#: a word longer than this is cut where no piece can join, and a part longer than this merges by a heap
CUT, LONG = 64, 512

_WORDS = re.compile(r" *[^ ]+| +")


class PieceMerger:
    """Pairs, ranks and symbol costs of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        pieces = {model.id_to_piece(i): i for i in range(size) if not special[i]}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece joins words over a space")
        scores = {i: model.get_score(i) for i in pieces.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = np.full(size, NONE)
        for i, s in scores.items():
            rank[i] = order[s]
        shared = np.bincount(rank[list(scores)].astype(np.int64), minlength=len(order)) > 1
        # characters that occur in pieces without being one
        symbols = dict(pieces)
        for p in pieces:
            for ch in p:
                symbols.setdefault(ch, len(symbols) + size)
        self.width = max(symbols.values()) + 2
        pairs = {}
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.out = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.rank = rank
        # pieces whose neighbours may merge with them at a better rank, or that share a rank: one merge at a time
        left, right = self.keys // self.width, self.keys % self.width
        self.single = np.zeros(size, bool)
        for side in (left, right):
            own = side < size
            better = rank[self.out[own]] < rank[side[own]]
            self.single[side[own][better]] = True
        self.single[list(scores)] |= shared[rank[list(scores)].astype(np.int64)]
        chars = sorted(ord(s) for s in symbols if len(s) == 1)
        self.chars = np.array(chars, np.int64)
        self.char_symbol = np.array([symbols[chr(c)] for c in chars], np.int64)
        self.size = size
        # pairs of characters that stand side by side in some piece
        points = len(chars) + 1
        beside = {self._place(a) * points + self._place(b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.beside, self.points = np.array(sorted(beside), np.int64), points
        self.pairs: dict[int, int] | None = None
        runs = self._counts([MARK * m for m in range(1, 97)])
        #: a run of spaces this long more is one token more
        self.period = next((q for q in range(1, 33) if all(runs[m + q] == runs[m] + 1 for m in range(32, 96 - q))), 0)
        self.known: dict[str, int] = {}

    def _place(self, char: str) -> int:
        return int(np.searchsorted(self.chars, ord(char)))

    def _symbols(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, symbol, cost) of each character; one outside every piece has the last place."""
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        known = self.chars[at] == points
        sym = np.where(known, self.char_symbol[at], self.width - 1)
        utf8 = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        return np.where(known, at, len(self.chars)), sym, np.where(sym < self.size, 1, utf8)

    def _cut(self, word: str) -> list[str]:
        """Parts of a word that no merge can join: no piece holds the characters at a border side by side."""
        place = self._symbols(word)[0]
        pair = place[:-1] * self.points + place[1:]
        near = self.beside[np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)] == pair
        at = [0, *(np.flatnonzero(~near) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _count_long(self, word: str) -> int:
        """Tokens of one long part: its pairs in a heap by rank, the leftmost first."""
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), self.out.tolist(), strict=True))
        _, symbols, costs = self._symbols(word)
        n, width, rank, pairs = len(symbols), self.width, self.rank.tolist(), self.pairs
        key = symbols[:-1] * width + symbols[1:]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[place] == key)
        heap = (self.rank[self.out[place[hit]]] * n + hit).tolist()
        heapq.heapify(heap)
        sym, cost = symbols.tolist(), costs.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            found = heapq.heappop(heap)
            i = found % n
            j = after[i]
            # a symbol that was merged away has no pair; one that changed has another rank
            if sym[i] < 0 or j == n:
                continue
            made = pairs.get(sym[i] * width + sym[j])
            if made is None or rank[made] != found // n:
                continue
            sym[i], cost[i] = made, 1
            sym[j], cost[j] = -1, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = pairs.get(made * width + sym[k])
                if new is not None:
                    heapq.heappush(heap, rank[new] * n + i)
            h = before[i]
            if h >= 0:
                new = pairs.get(sym[h] * width + made)
                if new is not None:
                    heapq.heappush(heap, rank[new] * n + h)
        return sum(cost)

    def _counts(self, words: list[str]) -> np.ndarray:
        """Number of tokens of every word (spaces already marks)."""
        if all(len(w) <= CUT for w in words):
            return self._merged(words)
        parts = [self._cut(w) if len(w) > CUT else [w] for w in words]
        flat = [p for part in parts for p in part]
        counts = np.zeros(len(flat), np.int64)
        # parts repeat: each different one is merged once
        short = sorted({p for p in flat if len(p) <= LONG})
        known = dict(zip(short, self._merged(short).tolist(), strict=True)) if short else {}
        for i, p in enumerate(flat):
            if p not in known:
                known[p] = self._count_long(p)
            counts[i] = known[p]
        return np.add.reduceat(counts, np.cumsum([0, *[len(p) for p in parts[:-1]]]))

    def _merged(self, words: list[str]) -> np.ndarray:
        """Number of tokens of every word, all merged at once."""
        seq = np.repeat(np.arange(len(words)), [len(w) for w in words])
        _, sym, cost = self._symbols("".join(words))
        total = np.zeros(len(words), np.int64)
        while len(sym):
            key = sym[:-1] * self.width + sym[1:]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = np.flatnonzero((self.keys[place] == key) & (seq[1:] == seq[:-1]))
            busy = np.zeros(len(words), bool)
            busy[seq[hit]] = True
            stay = busy[seq]
            np.add.at(total, seq[~stay], cost[~stay])
            if not len(hit):
                break
            made = self.out[place[hit]]
            rank, owner = self.rank[made], seq[hit]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(hit)]))
            best = rank == least
            hit, made, owner = hit[best], made[best], owner[best]
            leftmost = np.r_[True, owner[1:] != owner[:-1]]
            take = leftmost | ~self.single[made]
            hit, made = hit[take], made[take]
            # of pairs that overlap in a run every other one merges, from the left
            start = np.flatnonzero(np.r_[True, hit[1:] != hit[:-1] + 1])
            odd = (np.arange(len(hit)) - np.repeat(start, np.diff(np.r_[start, len(hit)]))) % 2 == 1
            hit, made = hit[~odd], made[~odd]
            sym[hit], cost[hit] = made, 1
            stay[hit + 1] = False
            sym, cost, seq = sym[stay], cost[stay], seq[stay]
        return total

    def _words(self, text: str) -> tuple[list[str], int]:
        """The words after their first space, and the tokens of long runs of spaces that were shortened."""
        text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" "), 0
        words, extra = [w[1:] for w in _WORDS.findall(" " + text)], 0
        for i, w in enumerate(words):
            lead = len(w) - len(w.lstrip(" "))
            if self.period and lead > 160:
                cut = (lead - 96) // self.period
                words[i], extra = w[cut * self.period :], extra + cut
        return words, extra

    def count_texts(self, texts: list[str | None]) -> list[int]:
        split = [self._words(t) if t else ([], 0) for t in texts]
        known = self.known
        missing = list({w for words, _ in split for w in words if w not in known})
        if missing:
            # some thousand words at a time bound the arrays
            for at in range(0, len(missing), 20_000):
                part = missing[at : at + 20_000]
                known.update(zip(part, self._counts([MARK + w.replace(" ", MARK) for w in part]).tolist(), strict=True))
        out = [sum(map(known.__getitem__, words)) + extra for words, extra in split]
        if len(known) > KEPT_WORDS:
            known.clear()
        else:
            for w in missing:
                if len(w) > KEPT_CHARS:
                    del known[w]
        return out


@lru_cache(maxsize=2)
def merger(path: str) -> PieceMerger:
    return PieceMerger(path)


def count_tokens(docs: DataFrame, keep: list[str], model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``keep``, n_bytes, n_tokens, over_limit: one row per row of ``docs``, no shuffle.

    Counts are those of the model file's library without begin and end tokens; null counts as
    empty and has 0 tokens. Characters outside the vocabulary count their UTF-8 bytes.
    ``model_path`` must exist on every executor. Repeated rows give repeated rows, an empty table an
    empty one; columns of ``keep`` may have any names but those three. A word of any length costs
    n log n.
    """
    sized = docs.withColumn("n_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"))
    counted = map_texts(
        sized, text, [*keep, "n_bytes"], [("n_tokens", "bigint", pa.int64())], lambda texts: [merger(model_path).count_texts(texts)]
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
