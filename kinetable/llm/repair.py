"""Conversation structure repair by a parallel Viterbi search with rank convergence.

A repaired conversation has the role initials ``(s?(ua)+)?``. Rows are kept (0), given another role
(2) or deleted (3; blank and duplicate rows must be), empty turns are inserted (2), and every
truncated row that stays costs 1. The cheapest edits, and of equally cheap ones the ASCII-least
string of their initials, are wanted.

The search runs over four states (start, after s, after u, after a). A conversation is cut into
chunks of ``CHUNK`` rows, so a long one is spread over tasks. Backward: each chunk starts from
speculative cost vectors, one for each state at its right end; where the vectors they lead to differ
only by constants, the chunk's left vector is known whatever follows. Fix-up passes extend the
others to the right, twice as far each time, until theirs differ only by constants too. Forward:
with the stitched vectors each chunk maps its state of entry to one of exit; where that still depends
on the entry, the same passes run to the left. Then every chunk traces its edits on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.llm.common import BLANKS, Stored, stored
from kinetable.operators.ordered import number_rows, plan_split

#: rows of a conversation that one task searches at once, and rows whose texts stand in one row
CHUNK, PIECE = 4096, 64
#: chunks times rows of one search
CELLS = 1 << 18

RELABEL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 40
#: cost vectors of what follows never differ by more than 7 between two states
SPREAD = 8
START, SYSTEM, USER, ASSISTANT = range(4)
#: cost of the end from each state: nothing, or the inserts that are due
END = [0, 2 * INSERT, INSERT, 0]
#: state after an insert or a relabelled row
_NEXT = np.array([USER, USER, ASSISTANT, USER])
#: (state, role) to the state after a kept row; roles s, u, a, any other
_KEPT = np.full((4, 4), -1)
_KEPT[START, 0] = SYSTEM
_KEPT[[START, SYSTEM, ASSISTANT], 1] = USER
_KEPT[USER, 2] = ASSISTANT
#: a row's code: role number, fault number in letters; fault 0 none, 1 truncated, 2 must go
CODES = "suaxSUAX0123"
_ROLE, _FAULT = np.zeros(128, np.int64), np.zeros(128, np.int64)
for _i, _c in enumerate(CODES):
    _ROLE[ord(_c)], _FAULT[ord(_c)] = _i % 4, _i // 4
_INSERTED = ["", "u", "a", "ua"]


def _closed(cost: np.ndarray) -> np.ndarray:
    """Costs (..., 4) with inserts before the next row."""
    out = cost.copy()
    user, assistant = cost[..., USER], cost[..., ASSISTANT]
    for q in (START, SYSTEM):
        out[..., q] = np.minimum(np.minimum(cost[..., q], INSERT + user), 2 * INSERT + assistant)
    out[..., USER] = np.minimum(user, INSERT + assistant)
    out[..., ASSISTANT] = np.minimum(assistant, INSERT + user)
    return out


class Search:
    """Backward costs of chunks of codes, all at once: ``cost[i, t]`` is the vector before row t of chunk i."""

    def __init__(self, chunks: list[str], right: np.ndarray) -> None:
        self.sizes = np.array([len(c) for c in chunks], np.int64)
        width = int(self.sizes.max(initial=0))
        codes = np.full((len(chunks), width), ord("x"), np.uint8)
        for i, c in enumerate(chunks):
            codes[i, : len(c)] = np.frombuffer(c.encode(), np.uint8)
        self.role, self.fault = _ROLE[codes], _FAULT[codes]
        self.cost = np.empty((len(chunks), width + 1, 4), np.int64)
        self.cost[:, width] = right
        for t in range(width - 1, -1, -1):
            on = t < self.sizes
            self.cost[:, t] = np.where(on[:, None], self._before(t), right)

    def _before(self, t: int) -> np.ndarray:
        after = self.cost[:, t + 1]
        lines, late = np.arange(len(after)), (self.fault[:, t] == 1) * TRUNCATED
        must = self.fault[:, t] == 2
        cost = DELETE + after
        for q in range(4):
            relabelled = RELABEL + late + after[:, _NEXT[q]]
            state = _KEPT[q, self.role[:, t]]
            kept = np.where(state >= 0, late + after[lines, state], FAR)
            cost[:, q] = np.where(must, cost[:, q], np.minimum(cost[:, q], np.minimum(relabelled, kept)))
        return _closed(cost)

    def trace(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(exit state, inserts before, edit, state before the row's own edit) of the ASCII-least cheapest edits.

        Inserts are numbers into ``_INSERTED``; edits are the letters' codes. Inserts at the right end
        belong to what follows.
        """
        n, width = self.role.shape
        before, edit, states = np.zeros((n, width), np.int8), np.zeros((n, width), np.uint8), np.zeros((n, width), np.int8)
        state, lines = entry.astype(np.int64), np.arange(n)
        for t in range(width):
            on, now, after = t < self.sizes, self.cost[:, t], self.cost[:, t + 1]
            gone = DELETE + after[lines, state] == now[lines, state]
            for _ in range(2):
                step = on & ~gone & (INSERT + now[lines, _NEXT[state]] == now[lines, state])
                before[:, t] |= np.where(step, np.where(_NEXT[state] == USER, 1, 2), 0).astype(np.int8)
                state = np.where(step, _NEXT[state], state)
            states[:, t] = state
            late = (self.fault[:, t] == 1) * TRUNCATED
            kept = _KEPT[state, self.role[:, t]]
            keep = ~gone & (self.fault[:, t] != 2) & (kept >= 0) & (late + after[lines, kept] == now[lines, state])
            edit[:, t] = np.where(gone, ord("D"), np.where(keep, ord("K"), ord("R")))
            state = np.where(on & ~gone, np.where(keep, kept, _NEXT[state]), state)
        return state, before, edit, states


def _illegal(role: np.ndarray) -> int:
    """Neighbours whose roles are neither su, ua nor au."""
    a, b = role[:-1], role[1:]
    return int((~(((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))).sum())


def _groups(chunks: list[str]) -> Iterator[list[int]]:
    """Indices of chunks of like sizes that are searched together."""
    order = sorted(range(len(chunks)), key=lambda i: len(chunks[i]))
    held: list[int] = []
    for i in order:
        if held and (len(held) + 1) * len(chunks[i]) > CELLS:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def transfer(chunks: list[str]) -> np.ndarray:
    """(chunk, state left, state right): costs of the cheapest way; entries that can never be used are cut to SPREAD."""
    out = np.empty((len(chunks), 4, 4), np.int64)
    for group in _groups(chunks):
        part = [chunks[i] for i in group]
        for q in range(4):
            right = np.full((len(part), 4), FAR)
            right[:, q] = 0
            # before any row the vector stands without inserts: those are the right part's
            out[group, :, q] = Search(part, right).cost[:, 0]
    return capped(out)


def capped(costs: np.ndarray) -> np.ndarray:
    return np.minimum(costs, costs.min(-1, keepdims=True) + SPREAD)


def converged(costs: np.ndarray) -> np.ndarray:
    """True where the vectors to the right-hand states differ only by constants."""
    shape = costs - costs.min(-1, keepdims=True)
    return (shape == shape[:, :1]).all((1, 2))


def compose(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return capped((left[:, :, :, None] + right[:, None, :, :]).min(2))


def _mapped(df: DataFrame, fn: Callable[[dict], dict], keep: list[str], new: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    """``keep`` columns and new ones from ``fn`` over lists of the batch's columns."""
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} {t}" for n, (t, _) in new.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: batch.column(name) for name in batch.schema.names}
            made = fn({name: column.to_pylist() for name, column in rows.items() if name != "conv"})
            columns = [rows[c] for c in keep] + [pa.array(made[n], kind) for n, (_, kind) in new.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *new])

    return df.mapInArrow(run, schema)


_LONGS = ("array<bigint>", pa.list_(pa.int64()))


def _stitch(parts: DataFrame, value: str, step: int, join: Callable[[list, list], list], done: Callable[[list], bool]) -> DataFrame:
    """Fix-up passes: (conv, chunk, value) extended by its neighbour ``step`` chunks away, twice as far each pass, until done."""
    reach, state, spent = step, parts, []
    while True:
        open_ = state.where(~F.col("fixed"))
        if open_.isEmpty():
            for old in spent[:-1]:
                old.drop()
            return state.drop("fixed")
        near = state.select(F.col("conv").alias("_conv"), (F.col("chunk") - reach).alias("_chunk"), F.col(value).alias("_near"))
        joined = open_.join(near, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))).select("conv", "chunk", value, "_near")

        def pass_(rows: dict) -> dict:
            made = [join(a, b) for a, b in zip(rows[value], rows["_near"], strict=True)]
            return {value: made, "fixed": [done(v) for v in made]}

        fixed = _mapped(joined, pass_, ["conv", "chunk"], {value: _LONGS, "fixed": ("boolean", pa.bool_())})
        held = Stored(state.where("fixed").unionByName(fixed), "repair")
        spent.append(held)
        state, reach = held.df, reach * 2


def _vector_join(a: list[int], b: list[int]) -> list[int]:
    return compose(np.array(a).reshape(1, 4, 4), np.array(b).reshape(1, 4, 4)).ravel().tolist()


def _vector_done(a: list[int]) -> bool:
    return bool(converged(np.array(a).reshape(1, 4, 4))[0])


def _long_conversations(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, last, codes, right, entry) of the chunks of conversations that have several."""

    def matrices(rows: dict) -> dict:
        found = transfer(rows["codes"])
        for i, last in enumerate(rows["last"]):
            if last:
                # the end is known: its vector stands for every state to the right
                right = np.array([END])
                found[i] = np.repeat(Search([rows["codes"][i]], right).cost[:, 0].T, 4, 1)
        return {"costs": found.reshape(-1, 16).tolist(), "fixed": converged(found).tolist()}

    new = {"costs": _LONGS, "fixed": ("boolean", pa.bool_())}
    costs = stored(_mapped(chunks, matrices, ["conv", "chunk"], new), "repair")
    left = _stitch(costs, "costs", 1, _vector_join, _vector_done)
    # of converged vectors any will do: the one that ends in the first state
    vector = F.transform(F.array(*[F.lit(i * 4) for i in range(4)]), lambda i: F.get("costs", i))
    left = left.select(F.col("conv").alias("_conv"), (F.col("chunk") - 1).alias("_chunk"), vector.alias("right"))
    placed = chunks.join(left, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")), "left")
    placed = stored(placed.select("conv", "chunk", "last", "codes", F.coalesce("right", F.array(*[F.lit(c).cast("bigint") for c in END])).alias("right")), "repair")

    def exits(rows: dict) -> dict:
        out = np.empty((len(rows["codes"]), 4), np.int64)
        for group in _groups(rows["codes"]):
            search = Search([rows["codes"][i] for i in group], np.array([rows["right"][i] for i in group]))
            for q in range(4):
                out[group, q] = search.trace(np.full(len(group), q))[0]
        for i, chunk in enumerate(rows["chunk"]):
            if chunk == 0:
                out[i] = out[i, START]
        return {"exits": out.tolist(), "fixed": (out == out[:, :1]).all(1).tolist()}

    ways = stored(_mapped(placed, exits, ["conv", "chunk"], {"exits": _LONGS, "fixed": ("boolean", pa.bool_())}), "repair")
    ways = _stitch(ways, "exits", -1, lambda a, b: [a[q] for q in b], lambda a: len(set(a)) == 1)
    entries = ways.select(F.col("conv").alias("_conv"), (F.col("chunk") + 1).alias("_chunk"), F.col("exits")[0].alias("entry"))
    joined = placed.join(entries, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")), "left")
    return joined.select("conv", "chunk", "last", "codes", "right", F.coalesce("entry", F.lit(START).cast("bigint")).alias("entry"))


_EDIT = pa.struct([("inserted", pa.string()), ("edit", pa.string()), ("role", pa.string())])


def _traced(chunks: DataFrame, piece: int) -> DataFrame:
    """(conv, piece, audit, cost, illegal, edits, tail): the edits of the rows of each piece."""
    schema = (
        f"conv {chunks.schema['conv'].dataType.simpleString()}, piece BIGINT, audit STRING, cost BIGINT, illegal BIGINT, first STRING, "
        "final STRING, edits ARRAY<STRUCT<inserted: STRING, edit: STRING, role: STRING>>, tail STRING"
    )
    names = ["conv", "piece", "audit", "cost", "illegal", "first", "final", "edits", "tail"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(_EDIT), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("chunk", "chunk_rows", "last", "codes", "right", "entry")}
            for group in _groups(rows["codes"]):
                search = Search([rows["codes"][i] for i in group], np.array([rows["right"][i] for i in group]))
                states, before, edit, at = search.trace(np.array([rows["entry"][i] for i in group]))
                out: list[list] = [[] for _ in names]
                for k, i in enumerate(group):
                    codes = rows["codes"][i]
                    for start in range(0, len(codes), piece):
                        stop = min(len(codes), start + piece)
                        edits, audit, cost = [], [], 0
                        for t in range(start, stop):
                            inserted, own = _INSERTED[before[k, t]], chr(edit[k, t])
                            role = None if own != "R" else "user" if _NEXT[at[k, t]] == USER else "assistant"
                            edits.append((inserted, own, role))
                            audit.append("I" * len(inserted) + own)
                            cost += INSERT * len(inserted) + {"D": DELETE, "R": RELABEL, "K": 0}[own] + TRUNCATED * (own != "D" and search.fault[k, t] == 1)
                        tail = ["ua", "ua", "a", ""][states[k]] if rows["last"][i] and stop == len(codes) and states[k] != START else ""
                        cost, audit = cost + INSERT * len(tail), [*audit, "I" * len(tail)]
                        part = search.role[k, start:stop]
                        row = [i, (rows["chunk"][i] * rows["chunk_rows"][i] + start) // piece, "".join(audit), cost, _illegal(part)]
                        row += [CODES[part[0]], CODES[part[-1]], edits, tail]
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                convs = batch.column("conv").take(pa.array(out[0]))
                yield pa.RecordBatch.from_arrays([convs, *[pa.array(c, k) for c, k in zip(out[1:], kinds[1:], strict=True)]], names=names)

    return chunks.mapInArrow(run, schema)


def faulted(rows: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """(conv, turn, role, text, pos, code): rows in order with their first fault; ``rows`` has conv, turn, role, text.

    The order is by turn (nulls first); rows of the same turn stand in the order of the md5 of role
    and text. Nulls of role and text count as one space.
    """
    rows = rows.withColumn("role", F.coalesce("role", F.lit(" "))).withColumn("text", F.coalesce("text", F.lit(" ")))
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    rows = rows.withColumns({"_same": same, "_row": F.monotonically_increasing_id()})
    order = ["turn", "_same", "_row"]
    split = plan_split(rows, ["conv"], order, hot_rows)
    rows = number_rows(rows, ["conv"], order, "pos", split=split)
    if split.hot:
        rows = stored(rows, "repair")
        first = rows.groupBy("conv", "_same").agg(F.min("pos").alias("_first")).withColumnsRenamed({"conv": "_c", "_same": "_s"})
        rows = rows.join(first, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("_same") == F.col("_s")))
    else:
        rows = rows.withColumn("_first", F.min("pos").over(Window.partitionBy("conv", "_same")))
    end = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(end == "", "blank")
        .when(F.col("pos") > F.col("_first"), "duplicate")
        .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated")
    )
    role = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    code = F.when(fault == "truncated", F.upper(role)).when(fault.isNotNull(), F.translate(role, "suax", "0123")).otherwise(role)
    return rows.select("conv", "turn", "role", "text", "pos", fault.alias("fault"), code.alias("code"))


def search_edits(rows: DataFrame, chunk: int = CHUNK, piece: int = PIECE) -> DataFrame:
    """Pieces of edits of ``rows(conv, pos, code)``; ``chunk`` is a multiple of ``piece``."""
    if chunk % piece:
        raise ValueError("a chunk is made of whole pieces")
    codes = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda r: r["code"]), "")
    chunks = rows.groupBy("conv", F.floor(F.col("pos") / chunk).alias("chunk")).agg(codes.alias("codes"))
    sizes = rows.groupBy(F.col("conv").alias("_conv")).agg(F.floor(F.max("pos") / chunk).alias("_last"))
    chunks = chunks.join(sizes, F.col("conv").eqNullSafe(F.col("_conv")))
    chunks = stored(chunks.select("conv", "chunk", "codes", (F.col("chunk") == F.col("_last")).alias("last"), (F.col("_last") > 0).alias("long")), "repair")
    short = chunks.where("NOT long").select(
        "conv", "chunk", "last", "codes", F.array(*[F.lit(c).cast("bigint") for c in END]).alias("right"), F.lit(START).cast("bigint").alias("entry")
    )
    long = chunks.where("long").drop("long")
    every = short if long.isEmpty() else short.unionByName(_long_conversations(long))
    # small rows of much work: a number of tasks is given, else their few bytes would stand in one
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return _traced(every.withColumn("chunk_rows", F.lit(chunk).cast("bigint")).repartition(tasks, "conv", "chunk"), piece)


def _lines(edits: Column) -> Column:
    """Lines of a piece: inserted turns, then the row unless it is deleted."""

    def inserted(letters: Column) -> Column:
        return F.when(letters == "u", F.array(F.lit("user:"))).when(letters == "a", F.array(F.lit("assistant:"))).when(
            letters == "ua", F.array(F.lit("user:"), F.lit("assistant:"))
        ).otherwise(F.array().cast("array<string>"))

    own = F.flatten(
        F.transform(
            edits,
            lambda e: F.concat(
                inserted(e["inserted"]),
                F.when(e["edit"] == "D", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.coalesce(e["new_role"], e["role"]), F.lit(":"), e["text"]))),
            ),
        )
    )
    return F.concat(own, inserted(F.col("tail")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, repaired_sha256) of pieces that come in order; only the digest's state is held."""
    held, kind, digest, some = [], None, None, False

    def ended() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held, kind), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, body in zip(batch.column("conv").to_pylist(), batch.column("body").to_pylist(), strict=True):
            if digest is None or [conv] != held:
                if digest is not None:
                    yield ended()
                held, digest, some = [conv], hashlib.sha256(), False
            if body is not None:
                digest.update((b"\n" if some else b"") + body.encode("utf-8", "surrogatepass"))
                some = True
    if digest is not None:
        yield ended()


class Repaired:
    """Rows with their faults, pieces of edits, and what follows from both."""

    def __init__(self, rows: DataFrame, hot_rows: int | None = None, chunk: int = CHUNK, piece: int = PIECE) -> None:
        self.piece = piece
        self.rows = stored(faulted(rows, hot_rows), "repair")
        self.pieces = stored(search_edits(self.rows.select("conv", "pos", "code"), chunk, piece), "repair")
        group = self.rows.groupBy("conv", F.floor(F.col("pos") / piece).alias("piece"))
        found = group.agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "role", "text"))).alias("rows"))
        edits = self.pieces.select(F.col("conv").alias("_conv"), F.col("piece").alias("_piece"), "edits", "tail")
        both = F.zip_with(
            "rows", "edits", lambda r, e: F.struct(r["pos"].alias("pos"), r["turn"].alias("turn"), r["role"].alias("role"), r["text"].alias("text"), e["inserted"].alias("inserted"), e["edit"].alias("edit"), e["role"].alias("new_role"))
        )
        joined = found.join(edits, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece")))
        self.edited = joined.select("conv", "piece", both.alias("edits"), "tail")

    def edits(self) -> DataFrame:
        """One row per row of the conversations: its edit, its role after it and the roles inserted before it (``ua``: two)."""
        rows = self.edited.select("conv", F.explode("edits").alias("e"))
        return rows.select("conv", "e.pos", "e.turn", "e.role", "e.text", "e.edit", F.coalesce("e.new_role", "e.role").alias("repaired_role"), "e.inserted")

    def digests(self) -> DataFrame:
        """(conv, repaired_sha256) of the repaired lines ``role:text``.

        A digest is made in order, so the texts of a long conversation stream through one task,
        piece by piece; others are hashed where they stand.
        """
        lines = _lines(F.col("edits"))
        bodies = self.edited.select("conv", "piece", lines.alias("lines"))
        bodies = bodies.select("conv", "piece", F.when(F.size("lines") > 0, F.array_join("lines", "\n")).alias("body"))
        long = self.rows.groupBy("conv").agg((F.max("pos") >= self.piece).alias("long"))
        told = bodies.join(long.withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
        short = told.where("NOT long").select("conv", F.sha2(F.coalesce("body", F.lit("")), 256).alias("repaired_sha256"))
        ordered = told.where("long").select("conv", "piece", "body").repartition("conv").sortWithinPartitions("conv", "piece")
        kind = self.rows.schema["conv"].dataType.simpleString()
        return short.unionByName(ordered.mapInArrow(_digests, f"conv {kind}, repaired_sha256 STRING"))

    def summary(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row per conversation with rows."""
        faults = ("blank", "duplicate", "truncated")
        turns = self.rows.groupBy("conv", "turn").agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in faults])
        turns = turns.groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"), *[F.sum(f).alias(f) for f in faults]
        )
        legal = (
            ((F.col("final") == "s") & (F.col("first_next") == "u")) | ((F.col("final") == "u") & (F.col("first_next") == "a")) | ((F.col("final") == "a") & (F.col("first_next") == "u"))
        )
        following = self.pieces.select(F.col("conv").alias("_conv"), (F.col("piece") - 1).alias("_piece"), F.col("first").alias("first_next")).where("_piece >= 0")
        pieces = self.pieces.join(following, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece")), "left")
        borders = F.when(F.col("first_next").isNotNull() & ~legal, 1).otherwise(0)
        audits = pieces.groupBy("conv").agg(
            F.sum(F.col("illegal") + borders).alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda p: p["audit"]), "").alias("audit"),
        )
        parts = [turns, audits, self.digests()]
        values = ["gaps", *faults, "illegal", "cost", "audit", "repaired_sha256"]
        # every column has one value per conversation: one grouping instead of joins by a key that may be null
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return stacked.groupBy("conv").agg(*[F.max(v).alias(v) for v in values])


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with planted faults, told by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes its sentence ends out, 3 repeats it, 4 makes its
    role user. Nulls, in the key too, are one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce("text", space)
    told = conversations.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).when(kind != 0, F.array(F.lit(0))).alias("_copies"),
    )
    return told.select("conv", "turn", "role", "text", F.explode("_copies").alias("_copy")).drop("_copy")


def repair_summary(conversations: DataFrame, rows: DataFrame, **options) -> DataFrame:
    """``Repaired.summary`` of ``rows`` for every conv_id of ``conversations``; one without rows has zeros, no audit and the digest of nothing."""
    found = Repaired(rows, **options).summary()
    every = conversations.select(F.col("conv_id").alias("conv")).distinct()
    joined = every.join(found.withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return joined.select(F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
