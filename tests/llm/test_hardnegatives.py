"""Hard negatives against scoring every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.llm import hardnegatives as hn
from kinetable.llm.common import table
from kinetable.llm.queries import QUERIES

from . import brute

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _whole(rows, label=lambda i, g: g):
    seen = {}
    for i, v, g in rows:
        if i is not None and v is not None and g is not None and all(x is not None and math.isfinite(x) for x in v):
            seen[i, g, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = (i, label(i, g), [math.floor(256 * float(np.float32(x))) for x in v])
    return list(seen.values())


def _found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def _clusters(seed, n=700, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(int(i), (centres[i % 6] + 0.4 * rng.normal(size=dim)).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    pick = random.Random(seed)
    for i in range(0, n, 9):
        # ties: copies of a vector under other ids and labels
        rows[i] = (i, list(rows[pick.randrange(n)][1]), pick.randrange(4))
    return rows


@pytest.mark.parametrize(("rows_per_block", "anchors_per_block"), [(4096, 256), (40, 3)])
def test_equals_scoring_every_pair(spark, rows_per_block, anchors_per_block):
    rows = _clusters(rows_per_block)
    rows += [rows[5], rows[10], (None, [1.0] * 8, 1), (701, None, 1), (702, [1.0, None] + [0.0] * 6, 1), (703, [float("nan")] * 8, 1), (704, [float("inf")] * 8, 2)]
    rows += [(10, [0.5] * 8, 1), (20, [0.0] * 8, 1), (705, [0.0] * 8, 2), (706, [1.0, 2.0], 1), (30, [2.0, 1.0], 1), (707, [1.0, 1.0], 2), (708, [], 0), (710, rows[3][1], None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(3) for c in ("id", "block", "dim", "cell", "norm", "low", "high", "score", "rank")})
    got = hn.hard_negatives(df, F.pmod("id", F.lit(10)) == 0, rows_per_block=rows_per_block, anchors_per_block=anchors_per_block)
    assert got.columns == COLUMNS
    assert _found(got) == brute.hard_negatives(_whole(rows), lambda i: i % 10 == 0)


def test_large_numbers_are_exact(spark):
    rng = random.Random(3)
    # products beyond 53 bits, which doubles would round
    rows = [(i, [rng.choice([1.0, -1.0]) * rng.randint(1, 1 << 20) for _ in range(4)], i % 3) for i in range(60)]
    got = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.pmod("id", F.lit(10)) == 0)
    assert _found(got) == brute.hard_negatives(_whole(rows), lambda i: i % 10 == 0)


def test_windows_hold_every_row_they_must():
    rng = np.random.default_rng(1)
    q = np.floor(256 * rng.normal(size=(300, 6)))
    refs = hn.fit_references(q, 4)
    unit, norms = hn._scaled(q)
    angles = np.arccos(np.clip(unit @ refs.T, -1, 1))
    order = np.argsort(angles[:, 1])
    row = {"ids": order.astype(np.int64).tobytes(), "labels": np.zeros(300, np.int64).tobytes(), "norms": norms[order].tobytes(), "angles": angles[order].tobytes(), "q": q[order].tobytes(), "cell": 1, "block": 0}
    block, narrowed = hn.Block(row), 0
    for a in range(0, 300, 7):
        score = hn.scores(block, 0, 300, q[a])
        for low, high in [(score.max() * 0.5, np.inf), (-np.inf, score.min() * 0.5), (score.max() * 0.8, score.max())]:
            start, stop = hn.window(block, angles[a, 1], norms[a], low, high)
            narrowed += stop - start < 300
            inside = np.flatnonzero((score >= low) & (score <= high))
            assert not len(inside) or (start <= inside.min() and inside.max() < stop)
    assert narrowed > 40


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(none, F.pmod("id", F.lit(10)) == 0).count() == 0
    single = spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    assert hn.hard_negatives(single, F.pmod("id", F.lit(10)) == 0).count() == 0
    assert hn.hard_negatives(single, F.pmod("id", F.lit(1)) == 0).count() == 0


def test_query_equals_brute_force(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, sf, "embeddings").collect()]
    whole = _whole(rows, lambda i, g: (g + 1) % 10 if i % 7 == 0 else g)
    assert _found(QUERIES["op12_hard_negatives"](spark, sf)) == brute.hard_negatives(whole, lambda i: i % 100 == 0)
