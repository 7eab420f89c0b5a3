"""Token counts, byte-level BPE, toxicity and language ID."""

import base64
import hashlib
import itertools
import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from kinetable.llm import bytebpe, langid, queries, sampling, tokens, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["a", "the ", " ", "  ", "\n", "\t", "▁", "中文", "😀", "ﬁ", "0", "12", "<s>", "</s>", "<0x41>", "É", "\x00", "\x1c", "\xa0", " " * 40, "'s", "'re", ".", "ß", "x" * 30]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 50))) for _ in range(400)]
    return texts + [None, "", " " * 500, "中文" * 2000, "ab" * 3000, "xyz" + " " * 3000 + "q"]


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_equal_the_library(spark, odd_texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id LONG, text STRING").withColumn("n_tokens", F.lit("x"))
    for r in tokens.count_tokens(df.drop("n_tokens"), ["doc_id"], PIECES).collect():
        text = odd_texts[r["doc_id"]] or ""
        want = len(model.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), want, want > 4096)


def test_byte_bpe_equals_the_library(spark, odd_texts, tik):
    rng = random.Random(4)
    # many chunks; and a run longer than the overlap, over which no boundary is found
    long = ["".join(rng.choices(ODD, k=9000)), "z" * 60_000, " " * 40_000 + "q", "word " * 10_000 + "y" * 20_000 + " end" * 5000]
    texts = odd_texts + long + [long[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    # repeated rows come out as often as they go in
    df = df.union(df.where(F.col("doc_id") >= len(odd_texts)))
    got = queries.encode_digest(df).collect()
    assert len(got) == len(texts) + len(long) + 1
    for r in got:
        text = texts[r["doc_id"]] or ""
        ids = tik.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_small_chunks_stitch_where_boundaries_agree(odd_texts, tik, monkeypatch):
    monkeypatch.setattr(bytebpe, "CHUNK", 200)
    monkeypatch.setattr(bytebpe, "OVERLAP", 32)
    own, stitched = bytebpe.ByteEncoder(RANKS, public_tokenizers.PATTERN), 0
    for text in filter(None, odd_texts):
        parts = []
        for c in range(-(-len(text) // 200)):
            window = text[max(0, c * 200 - 32) : (c + 1) * 200 + 32]
            last = (c + 1) * 200 >= len(text)
            ids, begins, before, stitch = own.chunk(window, None if last else 168 + (32 if c else 0))
            parts.append({"_ids": ids, "_begins": begins, "_before": before, "_stitch": stitch, "_core": window[32 if c else 0 :][:200]})
        stitched += len(parts) > 1 and all(p["_stitch"] >= 0 for p in parts)
        assert bytebpe.join_chunks(own, parts) == np.array(tik.encode_ordinary(text), "<u4").tobytes()
    assert stitched > 20


def test_language_forward_sums_all_segmentations():
    vocab = langid.vocabulary(PIECES)
    rng = np.random.default_rng(0)
    probs = np.vstack([rng.uniform(1e-5, 1e-3, (vocab.size, 2)), np.zeros((1, 2))])

    def total(word, lang):
        if not word:
            return 1.0
        parts = {k: vocab.ids[word[:k]] for k in range(1, len(word) + 1) if word[:k] in vocab.ids}
        return sum(probs[p, lang] * total(word[k:], lang) for k, p in ({1: vocab.other} | parts).items())

    for words in (["▁the", "▁der"], ["▁straße", "▁éclair"], ["▁zzz中文"]):
        for word in words:
            got = langid.Lattices(vocab, [word]).log_probs(probs)[0]
            assert got == pytest.approx([math.log(total(word, 0)), math.log(total(word, 1))])
    # expected counts: every character is covered once
    out = np.zeros((vocab.size + 1, 2))
    langid.Lattices(vocab, ["▁the"]).expected(probs, np.array([[2.0, 3.0]]), out)
    lengths = np.array([len(p) for p in vocab.ids] + [1, 0])
    assert lengths @ out == pytest.approx([8.0, 12.0])


def test_language_id_on_held_out_texts(spark):
    got = queries.op9(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    right = held.where("lang = lang_pred").count()
    assert right >= 0.97 * held.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_id_edges(spark, docs, no_docs):
    found = langid.predict(docs, ["doc_id"], langid.train(docs, PIECES), PIECES).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        if not (r["text"] and any(map(str.isalpha, r["text"]))):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    empty = langid.train(no_docs, PIECES)
    assert langid.predict(no_docs, ["doc_id"], empty, PIECES).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, ["doc_id"], empty, PIECES).collect()} == {"und"}


def marks(text):
    kinds = {"idiot": ("insult", 1.0), "kill": ("threat", 1.0)}
    closed = {"you": "target", "not": "negation", "said": "report", "will": "intent"}
    symbols = [(kinds.get(w, (closed.get(w, "other"),))[0], frozenset()) for w in text.split()]
    return [(k, set(m)) for k, m in toxicity.GRAMMAR.best(symbols) if k in toxicity.KINDS]


def test_grammar_marks_clauses():
    assert marks("such an idiot here") == [("insult", set())]
    assert marks("you are an idiot") == [("insult", {"aimed"})]
    assert marks("idiot that you are") == [("insult", {"aimed"})]
    assert marks("idiot a b c d you") == [("insult", set())]
    assert marks("he is not an idiot") == [("insult", {"negated"})]
    assert marks("he said that idiot") == [("insult", {"reported"})]
    assert marks("i will kill it") == [("threat", set())]
    assert marks("kill you") == [("threat", {"aimed"})]
    assert marks("to kill time") == []
    # the best path equals the heaviest of all paths
    symbols = [("other", frozenset()), ("insult", frozenset()), ("target", frozenset())]
    paths = [(toxicity.GRAMMAR.start, 0.0)]
    for s in symbols:
        paths = [(n, w + x) for state, w in paths for n, _, x in toxicity.GRAMMAR.step(state, s)]
    assert max(w for s, w in paths if toxicity.GRAMMAR.final(s)) == 1.0


def test_toxicity_on_held_out_texts(spark):
    got = queries.op4(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = [r for r in held if r["toxic"]], [r for r in held if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic) > 0
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in held)


def test_toxicity_edges(spark, docs, no_docs):
    model = toxicity.train(no_docs.withColumn("toxic", F.lit(1)))
    got = toxicity.score(docs, ["doc_id"], model).collect()
    assert len(got) == docs.count() and all(r["score"] is not None and not r["predicted"] for r in got)
    assert toxicity.score(no_docs, ["doc_id"], model).count() == 0
    # null labels and texts are left out; words that only toxic texts hold are learned
    rng = random.Random(6)
    filler = lambda: " ".join("".join(rng.choices("abcdefgh", k=3)) for _ in range(12))
    rows = [(filler(), 0) for _ in range(70)] + [(f"{filler()} gromf {filler()}", 1) for _ in range(25)] + [(None, 1), ("x", None)]
    # copies of one toxic text, whose words are no insults
    rows += [("copied rare wordings stand here", 1)] * 40
    model = toxicity.train(spark.createDataFrame(rows, "text STRING, toxic INT"))
    assert "gromf" in model.words or "grom" in model.stems
    assert not {"copied", "rare", "wordings"} & set(model.words) and not {"copi", "word"} & set(model.stems)
    test = spark.createDataFrame([(1, "a gromf here"), (2, "plain words")], "doc_id LONG, text STRING")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(test, ["doc_id"], model).collect()} == {1: 1, 2: 0}


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    first = {r[0] for r in sampling.sample_ids(rows, "doc_id", 1000).collect()}
    assert first == {r[0] for r in sampling.sample_ids(rows.repartition(7), "doc_id", 1000).collect()}
    assert 800 < len(first) < 1200
    assert sampling.sample_ids(rows, "doc_id", 20_000).count() == 20_000


def test_long_pieces_merge_like_short_ones():
    own = bytebpe.ByteEncoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(9)
    for size in itertools.chain(range(49, 60), (300,)):
        data = "".join(rng.choice("abethn") for _ in range(size)).encode()
        if data not in own.ranks:
            short = [bytes([b]) for b in data]
            while True:
                best = min(((own.ranks[short[i] + short[i + 1]], i) for i in range(len(short) - 1) if short[i] + short[i + 1] in own.ranks), default=None)
                if best is None:
                    break
                short[best[1] : best[1] + 2] = [short[best[1]] + short[best[1] + 1]]
            assert own._long_piece(data) == [own.ranks[s] for s in short]


def test_batches_are_cut_by_rows_and_bytes():
    from kinetable.llm.common import steps

    assert steps(np.array([], int)) == []
    assert steps(np.array([1] * 5), rows=2) == [(0, 2), (2, 2), (4, 1)]
    assert steps(np.array([50, 5, 5, 100, 1]), limit=20) == [(0, 1), (1, 2), (3, 1), (4, 1)]
