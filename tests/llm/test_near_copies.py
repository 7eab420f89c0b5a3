"""Near copies of the pipeline's stage: five-word Jaccard of 0.8 or more, against all pairs."""

import random

import corpus_pipeline
from kinetable.llm import nearcopies

from . import brute


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(11)
    texts = {}
    for _ in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))]
        for share in (0, 0.005, 0.01, 0.02, 0.03):
            texts[len(texts)] = edited(rng, words, int(share * len(words)))
    # a large group of near copies, some of which are linked over others only
    words = [f"v{i}" for i in range(200)]
    for i in range(80):
        texts[len(texts)] = edited(rng, words, i % 8)
    df = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(df).collect()}
    assert got == brute.near_groups(texts)


def test_stage_equals_brute_force(spark, small_docs):
    rows = [(i, t, g, s, len(t) if t is not None else None) for i, t, g, s in small_docs[:-3]]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    kept = stage(spark, df, "")
    assert kept.columns == df.columns
    prints = {i: brute.simhash(t) for i, t, *_ in rows}
    first = set(brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2).values())
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute.near_groups({i: t for i, t, *_ in rows if i in first}).values()))


def test_rows_without_id_and_empty_tables(spark, no_docs):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "e f g h"), (None, "E f g  h"), (-3, "i j k l"), (2, "i j k l")]
    left = nearcopies.drop_near_copies(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("-3", "i j k l"), ("5", "e f g h"), ("None", "a b c d")]
    assert nearcopies.drop_near_copies(no_docs).count() == 0


def test_blocks_give_the_same_shingles(monkeypatch):
    text = " ".join(f"w{i % 97} x{i % 31}" for i in range(3000))
    keys, found, mark = nearcopies.band_keys(text), nearcopies.shingle_set(text), nearcopies.text_hash(text)
    monkeypatch.setattr("kinetable.llm.simhash.BLOCK_BYTES", 50)
    assert (nearcopies.band_keys(text), nearcopies.shingle_set(text), nearcopies.text_hash(text)) == (keys, found, mark)
    assert len(found) == len(brute.shingles(text))
