"""Conversation repair against a search over all edits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.llm import repair
from kinetable.llm.common import table
from kinetable.llm.queries import QUERIES

from . import brute

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _rows(seed, convs=20, most=12):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "Yes.", "No!", "why", "", " \t\n", None, "one. two", "Ends well?  \n", "né.", "x" * 300 + "."]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, most)):
            turn = rng.choice([t, t, t, t + 1, None])
            rows.append((rng.choice([c, c, c, None]) if c == 3 else c, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"line {rng.random()}."))
    return rows


def _found(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize(("chunk", "piece", "hot"), [(4096, 64, None), (4, 2, None), (2, 1, 3)])
def test_equals_search_over_all_edits(spark, chunk, piece, hot):
    rows = _rows(chunk)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("conv", "pos", "code", "piece", "audit", "edit")})
    got = _found(repair.repair_summary(df, repair.damage(df), chunk=chunk, piece=piece, hot_rows=hot))
    assert got == brute.repair(rows)


@pytest.mark.parametrize("kind", ["unknown roles", "copies", "alternating"])
def test_chunks_that_do_not_converge(spark, kind):
    """Whole chunks whose vectors keep the state of entry need the fix-up passes."""
    make = {
        "unknown roles": lambda t: ("tool", f"call {t}."),
        "copies": lambda t: ("user", "same."),
        "alternating": lambda t: (["user", "assistant"][t % 2], f"turn {t}"),
    }[kind]
    rows = [(7, t, *make(t)) for t in range(33)] + [(8, t, *make(t)) for t in range(14)] + [(9, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.col("conv_id"))
    got = repair.Repaired(df.select("conv", "turn", "role", "text"), chunk=4, piece=2).summary()
    want = {c: brute.repaired([r for r in rows if r[0] == c]) for c in (7, 8, 9)}
    assert {r["conv"]: tuple(r[c] for c in COLUMNS) for r in got.collect()} == want


def test_edits_make_the_repaired_conversation(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "So"), (1, 2, "user", "So"), (1, 3, "tool", "Done.")]
    done = repair.Repaired(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("conv_id", "conv"))
    got = [(r["pos"], r["edit"], r["repaired_role"], r["inserted"]) for r in done.edits().orderBy("pos").collect()]
    audit = done.summary().first()["audit"]
    assert audit == brute.repaired(rows)[6]
    assert audit.startswith("".join("I" * len(i) + e for _, e, _, i in got))


def test_capped_matrices_and_convergence():
    keeps = repair.transfer(["uauaua"])
    assert repair.converged(keeps)[0]
    assert not repair.converged(repair.transfer(["111"]))[0] and not repair.converged(repair.transfer(["xxx"]))[0]
    whole = repair.transfer(["uxsa1Ua"])
    parts = repair.compose(repair.transfer(["uxs"]), repair.transfer(["a1Ua"]))
    end = np.array(repair.END)
    assert ((whole[0] + end).min(1) == (parts[0] + end).min(1)).all()


def test_empty_and_rowless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_summary(none, repair.damage(none)).count() == 0
    # the crc32 of 25:0 and the like drops some single rows: such conversations have zeros
    rows = [(c, 0, "user", "Hi.") for c in range(60)]
    got = _found(repair.repair_summary(df := spark.createDataFrame(rows, SCHEMA), repair.damage(df)))
    assert got == brute.repair(rows) and any(v[6] == "" and v[5] == 0 for v in got.values())


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _found(QUERIES["op13_conversation_repair"](spark, sf)) == brute.repair(rows)
