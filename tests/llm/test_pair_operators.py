"""SimHash, lattice hashing and components."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.llm import lattice, simhash
from kinetable.llm.components import components

from . import brute


def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(501, 560)] + [(9, 9)] + [(900, 901)] * 3
    edges += [tuple(map(int, e)) for e in rng.integers(1000, 1100, (60, 2))]
    flipped = [(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(edges)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(flipped, "a LONG, b LONG")).collect()}
    linked = {frozenset(e) for e in edges}
    want = brute.groups({n for e in edges for n in e if e[0] != e[1]}, lambda a, b: frozenset((a, b)) in linked)
    assert got == want
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_simhash_equals_brute_force(docs, small_docs):
    got = simhash.near_duplicates(docs).collect()
    prints = {i: brute.simhash(t) for i, t, _, _ in small_docs}
    roots = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == sorted((i, prints[i], roots[i]) for i, *_ in small_docs)


def test_simhash_links_within_two_bits_only(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 62, 40)]
    prints = set(base)
    for i, p in enumerate(base):
        prints |= {p ^ (1 << i), p ^ (1 << i) ^ (1 << 63), p ^ (1 << 31) ^ (1 << 32), p ^ 7, p ^ (1 << (i % 32)) ^ (1 << (40 + i % 20)) ^ 1}
    signed = sorted(p - (1 << 64) if p >= 1 << 63 else p for p in prints)
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp LONG")).collect()}
    assert got == {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) % (1 << 64)).bit_count() <= 2}


def test_simhash_keeps_one_of_each_group(spark, docs, no_docs, small_docs):
    kept = simhash.drop_near_duplicates(docs)
    prints = {i: brute.simhash(t) for i, t, _, _ in small_docs}
    roots = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))
    # rows without an id: one of a group stays, behind any row with an id
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "e f g h"), (None, "e f g h"), (-3, "i j k l"), (2, "i j k l")]
    left = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("-3", "i j k l"), ("5", "e f g h"), ("None", "a b c d")]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.drop_near_duplicates(no_docs).count() == 0


def test_simhash_blocks_give_the_same_print(monkeypatch):
    text = " ".join(f"w{i % 97} x{i % 31}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 50)
    assert simhash.fingerprint(text) == whole and whole % (1 << 64) == brute.simhash(text)


def test_e8_points_are_nearest():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)) * 2
    got = lattice.decode_e8(x)
    doubled = np.rint(got * 2)
    assert np.allclose(got * 2, doubled) and (got.sum(axis=1) % 2 == 0).all()
    assert (((doubled % 2) == 0).all(axis=1) | ((doubled % 2) == 1).all(axis=1)).all()
    near = ((x[:, None] - (got[:, None] + lattice.minimal_vectors())) ** 2).sum(axis=2).min(axis=1)
    assert (((x - got) ** 2).sum(axis=1) <= near + 1e-9).all()
    assert len(lattice.minimal_vectors()) == 240


def spread(rng, base, cosine):
    noise = rng.normal(size=base.shape)
    noise -= (noise @ base) * base
    return cosine * base + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    unit = lambda d: (lambda v: v / np.linalg.norm(v))(rng.normal(size=d))
    out = [unit(64) for _ in range(150)]
    hub = unit(64)
    out += [spread(rng, hub, 0.985) for _ in range(120)] + [hub * 3, hub * 3, hub * 3]
    for c in (0.94, 0.951, 0.96, 0.98):
        out += [spread(rng, v, c) for v in out[:30]]
    out += [unit(16) for _ in range(5)] + [unit(3)] * 2
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 64), (n + 2, [float("nan")] * 64), (n + 3, [float("inf")] + [0.0] * 63), (n + 4, []), (n + 5, [None] * 64)]
    return rows


def test_lattice_equals_brute_force(spark, vectors, monkeypatch):
    # small units: hot cells are cut into many blocks, and pairs come in many parts
    monkeypatch.setattr(lattice, "UNIT", 16)
    monkeypatch.setattr(lattice, "QUERIES", 20)
    df = spark.createDataFrame(vectors + [vectors[0], vectors[-6]], "vec_id LONG, embedding ARRAY<FLOAT>").repartition(4)
    got = {r["vec_id"]: r for r in lattice.near_duplicates(df.withColumns({"id": F.lit(1), "node": F.lit(2), "label": F.lit(3)})).collect()}
    good = {i: np.array(v, np.float64) for i, v in vectors if v and None not in v and np.isfinite(v).all() and any(v)}
    cosine = lambda a, b: len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.95
    near = {a: {b for b in good if b != a and cosine(a, b)} for a in good}
    roots = brute.groups(good, lambda a, b: b in near[a])
    wrong = [i for i, _ in vectors if (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) != (len(near.get(i, ())), roots.get(i, i), roots.get(i, i) == i)]
    # the index may miss a pair near the limit
    links, found = sum(map(len, near.values())), sum(got[i]["n_links"] for i, _ in vectors)
    assert links > 10_000 and 0.9995 * links <= found <= links and len(wrong) <= 4, (links, found, wrong)
    assert all(got[i]["n_links"] <= len(near.get(i, ())) for i, _ in vectors)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_lattice_recall_near_the_limit():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = np.array([spread(rng, v, 0.95) for v in a])
    (ha, pa), (hb, pb) = lattice.cells(a), lattice.cells(b)
    met = (ha == hb) | (pa == hb[:, :, None]).any(axis=2) | (pb == ha[:, :, None]).any(axis=2)
    assert met.any(axis=1).mean() >= 0.99
