"""Byte-level BPE encoding and decoding with overlapping chunks.

A long text is cut into chunks that overlap. Every chunk is pre-tokenised on its own, in
parallel; neighbours are stitched at the first pre-token boundary of the overlap that both
see, from where their boundaries agree (a boundary's continuation depends only on the text
after it). Then the pieces are encoded, those not seen before in arrays of equal length, which
merge one pair each per round. A text of one chunk needs no stitching and no shuffle.
Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import map_texts, steps

CHUNK, OVERLAP = 16_384, 512
#: a boundary this near to the end of a view may depend on what follows
MARGIN = 8
KEPT_PIECES, KEPT_CHARS = 150_000, 200
#: characters of texts whose pieces are held at a time, and bytes of a piece that goes into an array
HELD_CHARS, ARRAY_BYTES = 1 << 20, 48
#: rank of a pair that is no token
NONE = 1 << 40


class ByteEncoder:
    """Ranks of one file, the pre-token pattern, and pieces encoded so far."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.raw = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.raw[rank] = token
        self.split = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def piece(self, data: bytes) -> list[int]:
        """Ids of one pre-token: the lowest rank merges first, the left one of equals."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        if len(data) > ARRAY_BYTES:
            return self._long_piece(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i : i + 2], NONE) for i in range(len(data) - 1)]
        while pairs and (low := min(pairs)) != NONE:
            at = pairs.index(low)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NONE)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], NONE)
        return [ranks[p] for p in parts]

    def _long_piece(self, data: bytes) -> list[int]:
        """The same with a heap over a linked list, n log n."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop or not alive[end[i]]:
                continue
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (j := before[i]) >= 0 and (r := ranks.get(data[j:stop])) is not None:
                heapq.heappush(heap, (r, j, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    @cached_property
    def single(self) -> np.ndarray | None:
        """Ranks of the 256 bytes; None when some byte is no token."""
        found = [self.ranks.get(bytes([b])) for b in range(256)]
        return None if None in found else np.array(found, np.int64)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of all pairs of tokens that are a token together, and that token's rank."""
        ranks, n, keys, made = self.ranks, len(self.raw), [-1], [NONE]
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * n + right)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        return np.array(keys, np.int64)[order], np.array(made, np.int64)[order]

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair of ids, NONE for a pair that is no token."""
        keys, made = self.pairs
        wanted = left * len(self.raw) + right
        at = np.searchsorted(keys, wanted, "right") - 1
        return np.where(keys[at] == wanted, made[at], NONE)

    def _merge(self, data: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, ids of these) of pieces of one length as ``piece`` gives them: a round merges one pair of each that has one."""
        places = np.arange(len(data))
        ids = self.single[np.frombuffer(b"".join(data), np.uint8).reshape(len(data), -1)]
        joined = self._joined(ids[:, :-1], ids[:, 1:])
        while joined.shape[1]:
            low = joined.argmin(1)
            rank = joined[np.arange(len(low)), low]
            done = rank == NONE
            if done.any():
                yield places[done], ids[done]
                places, ids, joined, low, rank = places[~done], ids[~done], joined[~done], low[~done], rank[~done]
            rows, width = np.arange(len(low)), joined.shape[1]
            # the right one of the two goes, and their pair; the pairs to the left and right change
            ids[rows, low] = rank
            ids = ids[np.arange(width + 1) != low[:, None] + 1].reshape(len(low), width)
            joined = joined[np.arange(width) != low[:, None]].reshape(len(low), width - 1)
            some = rows[low > 0]
            joined[some, low[some] - 1] = self._joined(ids[some, low[some] - 1], rank[some])
            some = rows[low < width - 1]
            joined[some, low[some]] = self._joined(rank[some], ids[some, low[some] + 1])
        if len(places):
            yield places, ids

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pieces into ``known``; those of one length are merged together."""
        known, ranks = self.known, self.ranks
        sized: dict[int, tuple[list[str], list[bytes]]] = defaultdict(lambda: ([], []))
        for p in pieces:
            data = p.encode("utf-8", "surrogatepass")
            if data in ranks or len(data) > ARRAY_BYTES or self.single is None:
                known[p] = np.array(self.piece(data), "<u4").tobytes()
            else:
                names, raw = sized[len(data)]
                names.append(p)
                raw.append(data)
        for names, raw in sized.values():
            for places, ids in self._merge(raw):
                rows = np.ascontiguousarray(ids, "<u4").view(f"V{4 * ids.shape[1]}").ravel().tolist()
                known.update(zip(map(names.__getitem__, places.tolist()), rows, strict=True))

    def encode_pieces(self, texts: list[list[str]]) -> list[list[bytes]]:
        """Little-endian 32-bit ids of every piece of every text."""
        known = self.known
        out = [list(map(known.get, pieces)) for pieces in texts]
        missed = [[i for i, x in enumerate(ids) if x is None] if None in ids else [] for ids in out]
        new = {pieces[i] for pieces, at in zip(texts, missed, strict=True) for i in at}
        self._learn(new)
        for pieces, ids, at in zip(texts, out, missed, strict=True):
            for i in at:
                ids[i] = known[pieces[i]]
        if len(known) > KEPT_PIECES:
            known.clear()
        else:
            for p in new:
                if len(p) > KEPT_CHARS:
                    del known[p]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text; new pieces of several texts are merged together."""
        out: list[bytes] = []
        for at, rows in steps(np.array([len(t or "") for t in texts], np.int64), limit=HELD_CHARS):
            found = self.encode_pieces([self.split.findall(t or "") for t in texts[at : at + rows]])
            out.extend(map(b"".join, found))
        return out

    @cached_property
    def tokens(self) -> pa.Array:
        return pa.array(self.raw, pa.large_binary())

    def decode(self, ids: bytes | None) -> bytes | None:
        """The raw bytes of the ids, gathered by Arrow into one buffer."""
        if not ids:
            return ids
        found = self.tokens.take(pa.array(np.frombuffer(ids, "<u4")))
        _, ends, data = found.buffers()
        return data.slice(0, int(np.frombuffer(ends, np.int64)[len(found)])).to_pybytes()

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.split.finditer(text)]

    def chunk(self, window: str, next_at: int | None) -> tuple[bytes, list[int], list[int], int]:
        """One chunk on its own."""
        return self.chunks([window], [next_at])[0]

    def chunks(self, windows: list[str], next_at: list[int | None]) -> list[tuple[bytes, list[int], list[int], int]]:
        """Chunks, each on its own; their new pieces are merged together."""
        pieces = list(map(self.split.findall, windows))
        return list(map(self._cut, windows, next_at, pieces, self.encode_pieces(pieces)))

    def _cut(self, window: str, next_at: int | None, pieces: list[str], ids: list[bytes]) -> tuple[bytes, list[int], list[int], int]:
        """The part of a chunk that is its own.

        Returns the ids from the window's first boundary up to the stitch with the next chunk,
        the head's boundaries and the number of ids before each, and the place of the stitch in
        the next window (-1 without one). ``next_at`` is where the next window begins, None for
        the last chunk.
        """
        begins = np.cumsum([0, *map(len, pieces)])
        before = np.cumsum([0, *[len(x) // 4 for x in ids]])
        stop, stitch = len(pieces), 0
        if next_at is not None:
            limit = len(window) - next_at - MARGIN
            first = int(np.searchsorted(begins, next_at))
            own = {b - next_at: i for i, b in enumerate(begins[first:].tolist(), first)}
            # the next chunk's own view of the overlap
            stitch = next((p for p in self.starts(window[next_at:]) if 0 < p <= limit and p in own), -1)
            stop = own[stitch] if stitch >= 0 else stop
        head = int(np.searchsorted(begins, 2 * OVERLAP, "right"))
        return b"".join(ids[:stop]), begins[:head].tolist(), before[:head].tolist(), stitch


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


def encode(docs: DataFrame, keep: list[str], ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``keep`` and ``ids`` (BINARY, little-endian unsigned 32-bit), one row per row of ``docs``.

    Null and empty texts give empty ids. Texts above one chunk are dealt out chunk by chunk:
    repeated rows are encoded once and repeated again at the end. ``keep`` columns must be
    groupable. ``ranks_path`` must exist on every executor.
    """
    short = docs.where(F.coalesce(F.length(text), F.lit(0)) <= CHUNK)
    done = map_texts(
        short, text, keep, [("ids", "binary", pa.binary())], lambda texts: [encoder(ranks_path, pattern).encode(texts)]
    )
    return done.unionByName(_encode_long(docs.where(F.length(text) > CHUNK), keep, ranks_path, pattern, text))


def _encode_long(docs: DataFrame, keep: list[str], ranks_path: str, pattern: str, text: str) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema.fields}
    kept = ", ".join(f"`{k}` {types[k]}" for k in keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                whole = batch.column(len(keep))[i].as_py()
                mark = hashlib.blake2b(whole.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                count = -(-len(whole) // CHUNK)
                for first in range(0, count, 64):
                    at = range(first, min(count, first + 64))
                    windows = [whole[max(0, c * CHUNK - OVERLAP) : (c + 1) * CHUNK + OVERLAP] for c in at]
                    row = batch.slice(i, 1).select(range(len(keep)))
                    columns = [pa.concat_arrays([row.column(k)] * len(windows)) for k in range(len(keep))]
                    columns += [pa.array([mark] * len(windows)), pa.array(list(at), pa.int32()), pa.array([count] * len(windows), pa.int32()), pa.array(windows)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keep, "_mark", "_no", "_count", "_window"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = part.select(["_no", "_count", "_window"]).to_pylist()
                next_at = [None if r["_no"] == r["_count"] - 1 else CHUNK - OVERLAP + (OVERLAP if r["_no"] else 0) for r in rows]
                made = own.chunks([r["_window"] for r in rows], next_at)
                # the chunk's own text, for a text whose chunks find no common boundary
                cores = [r["_window"][OVERLAP if r["_no"] else 0 :][:CHUNK] for r in rows]
                columns = [part.column(c) for c in (*keep, "_mark", "_copies", "_no")]
                ints = pa.list_(pa.int32())
                columns += [pa.array([m[0] for m in made]), pa.array([m[1] for m in made], ints), pa.array([m[2] for m in made], ints)]
                columns += [pa.array([m[3] for m in made], pa.int32()), pa.array(cores)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "_mark", "_copies", "_no", "_ids", "_begins", "_before", "_stitch", "_core"])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks_path, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                chunks = batch.column(len(keep))[i].as_py()
                ids = join_chunks(own, chunks)
                columns = [batch.column(k).slice(i, 1) for k in range(len(keep))]
                copies = batch.column(len(keep) + 1)[i].as_py()
                row = pa.RecordBatch.from_arrays([*columns, pa.array([ids])], names=[*keep, "ids"])
                for _ in range(copies):
                    yield row

    chunks = docs.select(*keep, text).mapInArrow(cut, f"{kept}, _mark binary, _no int, _count int, _window string")
    # one row per different chunk, spread by its number too; copies of a text meet here
    dealt = chunks.groupBy(*keep, "_mark", "_no").agg(F.first("_count").alias("_count"), F.first("_window").alias("_window"), F.count(F.lit(1)).alias("_copies"))
    encoded = dealt.mapInArrow(
        work, f"{kept}, _mark binary, _copies bigint, _no int, _ids binary, _begins array<int>, _before array<int>, _stitch int, _core string"
    )
    parts = F.sort_array(F.collect_list(F.struct("_no", "_ids", "_begins", "_before", "_stitch", "_core")))
    whole = encoded.groupBy(*keep, "_mark").agg(parts.alias("_parts"), F.first("_copies").alias("_copies"))
    return whole.select(*keep, "_parts", "_copies").mapInArrow(stitch, f"{kept}, ids binary")


def join_chunks(own: ByteEncoder, chunks: list[dict]) -> bytes:
    """Ids of a whole text from its chunks in order; encoded in one go where two find no common boundary."""
    out, place = [], 0
    for c in chunks:
        at = dict(zip(c["_begins"], c["_before"], strict=True)).get(place)
        if at is None or c["_stitch"] < 0:
            return own.encode(["".join(c["_core"] for c in chunks)])[0]
        out.append(c["_ids"][4 * at :])
        place = c["_stitch"]
    return b"".join(out)


def decode(encoded: DataFrame, keep: list[str], ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``keep``, ``ids`` and ``decoded`` (BINARY), one row per row; null ids give null. No shuffle."""
    return map_texts(
        encoded, ids, [*keep, ids], [("decoded", "binary", pa.binary())], lambda values: [list(map(encoder(ranks_path, pattern).decode, values))]
    )
