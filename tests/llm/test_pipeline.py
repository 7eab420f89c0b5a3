"""The corpus pipeline against plain Python, stage by stage, and the registration of the queries."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from kinetable.llm.common import stored

from . import brute


def test_stages_equal_brute_force(spark, small_docs, tmp_path):
    rows = [(i, t, g, s, len(t) if t is not None else None) for i, t, g, s in small_docs[:-3]]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    after = {}
    for name, stage in steps.items():
        before, docs = docs, stored(stage(spark, docs, str(tmp_path)), name)
        after[name] = docs
        if name != "byte_bpe":
            assert docs.columns == before.columns

    good = {r[0] for r in brute.quality([(i, t, s) for i, t, _, s, _ in rows]) if r[-1]}
    cleaned = brute.without_frequent_lines([(i, t, s) for i, t, _, s, _ in rows])
    cleaned = {i: t for i, t in cleaned.items() if i in good}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after["quality_rules"].collect()} == {i: (t, len(t)) for i, t in cleaned.items()}
    lines = brute.clean_lines(list(cleaned.items()), every=True)
    size = lambda t: len(brute.WORD.findall(t))
    lines = {i: t for (i, before), t in lines.items() if t == before or size(t) >= max(50, 0.5 * size(before))}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after["line_dedup"].collect()} == {i: (t, len(t)) for i, t in lines.items()}
    prints = {i: brute.simhash(t) for i, t in lines.items()}
    roots = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    first = {i: lines[i] for i in set(roots.values())}
    left = {r["doc_id"]: r for r in after["simhash_near_dedup"].collect()}
    assert set(left) == set(brute.near_groups(first).values()) and len(left) <= len(first) <= len(lines) < len(cleaned)

    size = {i: len(brute.WORD.findall(r["text"])) for i, r in left.items()}
    sizes, longest, taken = {}, {}, {}
    for i, r in left.items():
        sizes[r["source"]] = sizes.get(r["source"], 0) + size[i]
        longest[r["source"]] = max(longest.get(r["source"], 0), size[i])
    mixed = after["mix_sources"].collect()
    for r in mixed:
        assert r == left[r["doc_id"]]
        taken[r["source"]] = taken.get(r["source"], 0) + size[r["doc_id"]]
    for s, goal in brute.targets(sizes).items():
        assert abs(taken.get(s, 0) - goal) <= longest[s]

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r["doc_id"], hashlib.sha256(np.array(tik.encode_ordinary(r["text"]), "<u4").tobytes()).hexdigest()) for r in mixed)
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in after["byte_bpe"].collect()) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, after["byte_bpe"].collect()))


def test_empty_documents_go_through(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "empty")
    assert docs.count() == 0


def test_all_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))


def test_whole_texts_are_read(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.encode(spark, docs, sf).agg(F.sum("n_tokens"), F.count("*")).first()
    assert got[1] == docs.count() and got[0] > docs.agg(F.sum(F.length("text"))).first()[0] / 6
