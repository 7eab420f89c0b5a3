"""Text operators at their edges: very long words and texts, letters of all scripts, clauses of any length, odd tables."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from kinetable.llm import bytebpe, langid, tokens, toxicity

PIECES, RANKS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_a_million_letters_without_a_space(library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(LETTERS, k=1_000_000)), "".join(rng.choices("etaoin", k=200_000)), "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(200_000))]
    start = time.monotonic()
    got = tokens.merger(PIECES).count_texts(texts)
    assert time.monotonic() - start < 60
    assert got == [len(library.encode(t, num_threads=1)) for t in texts]


def test_long_words_count_like_the_library(library, monkeypatch):
    monkeypatch.setattr(tokens, "CUT", 10)
    monkeypatch.setattr(tokens, "LONG", 24)
    rng = random.Random(2)
    alphabets = [LETTERS, "ethan", "ab", "a", "aé日́", LETTERS.upper() + "0123456789+/", "the▁ "]
    texts = ["".join(rng.choices(a, k=rng.randint(5, 900))) for a in alphabets for _ in range(12)]
    assert tokens.PieceMerger(PIECES).count_texts(texts) == [len(library.encode(t, num_threads=1)) for t in texts]


def test_token_counts_of_odd_tables(spark, no_docs, library):
    rows = [(1, "one two"), (1, "one two"), (None, "x" * 3000), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({c: F.lit("z") for c in ("n_bytes", "n_tokens", "over_limit", "_text")})
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(df, ["doc_id"], PIECES).collect())
    count = lambda t: len(library.encode(t, num_threads=1)) if t else 0
    assert got == sorted((str(i), len(t or ""), count(t), False) for i, t in rows)
    assert tokens.count_tokens(no_docs, ["doc_id"], PIECES).count() == 0


def test_encoding_of_odd_tables(spark, no_docs):
    rows = [(1, "one two"), (1, "one two"), (None, "x y " * 500), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({c: F.lit("z") for c in ("ids", "decoded", "_chunk", "_core", "_text")})
    coded = bytebpe.encode(df, ["doc_id"], RANKS, public_tokenizers.PATTERN)
    back = bytebpe.decode(coded, ["doc_id"], RANKS, public_tokenizers.PATTERN)
    assert sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in back.collect()) == sorted((str(i), t or "") for i, t in rows)
    assert bytebpe.decode(bytebpe.encode(no_docs, ["doc_id"], RANKS, public_tokenizers.PATTERN), ["doc_id"], RANKS, public_tokenizers.PATTERN).count() == 0


def _whole_clauses(lexicon, text):
    """The features by the grammar over every whole clause."""
    out = np.zeros(len(toxicity.CLAUSES))
    for clause in re.split(r"[.!?;:\n]", text.lower()):
        looked = [lexicon.look(w) for w in toxicity._WORD.findall(clause)]
        for (kind, marks), (_, weight) in zip(toxicity.GRAMMAR.best([(k, frozenset()) for k, _ in looked]), looked, strict=True):
            if kind == "threat":
                out[4] += weight
            elif kind == "insult":
                out[2 if "negated" in marks else 3 if "reported" in marks else 1 if "aimed" in marks else 0] += weight
    return out


@pytest.mark.parametrize("run", [2000, 40])
def test_clauses_equal_the_grammar_over_whole_texts(monkeypatch, run):
    monkeypatch.setattr(toxicity, "RUN", run)
    lexicon = toxicity.Lexicon({"gromf": 2.0, "blarg": 1.5}, {"snork": 1.0})
    rng = random.Random(run)
    words = ["gromf", "blarg", "snorky", "you", "not", "said", "will", "kill", "va", "“"] + [f"w{LETTERS[i]}{'x' * (i * i % 90)}" for i in range(26)]
    for _ in range(300):
        text = " ".join(rng.choice(words[: rng.choice([10, 36])] if rng.random() < 0.5 else words[10:]) + rng.choice(["", "", "", "", ".", ",", "\n"]) for _ in range(rng.randint(1, 160)))
        assert lexicon.clauses(text) == pytest.approx(_whole_clauses(lexicon, text)), text


def test_every_insult_counts_once():
    lexicon = toxicity.Lexicon({"gromf": 1.0}, {})
    for n in (1, 3, 5, 500, 5000):
        assert lexicon.clauses(" gromf word" * n).sum() == n
        assert lexicon.clauses(f"gromf {'y' * 500} " * n).sum() == n
    assert lexicon.clauses("xgromf gromfy GROMF").sum() == 1


def test_marks_of_learned_insults_end_to_end(spark):
    rng = random.Random(6)
    filler = lambda: " ".join("".join(rng.choices("bcdfgh", k=4)) for _ in range(12))
    rows = [(filler(), 0) for _ in range(90)] + [(f"{filler()} gromf {filler()}", 1) for _ in range(30)]
    model = toxicity.train(spark.createDataFrame(rows, "text STRING, toxic INT"))
    planted = ["so gromf it is", "you are gromf", "he is not gromf", "she said gromf", "i will kill you", "time to kill", "x" * 300_000 + " gromf", "", None]
    df = spark.createDataFrame(list(enumerate([*planted, planted[0], planted[0]])), "doc_id LONG, text STRING").withColumns({c: F.lit(1) for c in ("clauses", "score", "predicted", "features")})
    got = {r["doc_id"]: r for r in toxicity.score(df, ["doc_id"], model).collect()}
    places = {i: [k for k, v in zip(toxicity.CLAUSES, r["clauses"], strict=True) if v] for i, r in got.items()}
    assert [places[i] for i in range(9)] == [["plain"], ["aimed"], ["negated"], ["reported"], ["threat"], [], ["plain"], [], []]
    assert got[0]["score"] == got[9]["score"] == got[10]["score"] == got[6]["score"] and got[7]["score"] == got[8]["score"]


@pytest.mark.parametrize("text", ["½", "②", "Ⅷ", "²", "123 _ - ٣", "", " \n", "́", "😀"])
def test_no_letter_no_language(text):
    assert langid.words_of(text) == []


def test_words_are_letters_with_their_marks():
    assert langid.words_of("हिन्दी Straße, état x²y") == ["▁हिन्दी", "▁straße", "▁état", "▁x", "▁y"]


def _model(rng, languages=2):
    vocab = langid.vocabulary(PIECES)
    table = np.log(rng.dirichlet(np.full(vocab.size, 0.05), languages).T + 1e-9)
    return [f"l{i}" for i in range(languages)], table, np.log(np.full(languages, 1 / languages))


def test_long_words_are_sums_over_all_segmentations():
    vocab, rng = langid.vocabulary(PIECES), np.random.default_rng(3)
    probs = np.exp(np.vstack([_model(rng)[1], np.full((1, 2), -np.inf)]))
    pick = random.Random(4)
    for size in (1, 2, 17, 63, 200):
        word = "▁" + "".join(pick.choices(LETTERS + "éß中", k=size))
        whole = langid.Lattices(vocab, [word]).log_probs(probs)[0]
        for step in (4096, 7, 1):
            assert langid.long_log_probs(vocab, word, probs, step) == pytest.approx(whole)


def test_prediction_is_the_product_of_the_words(spark, monkeypatch):
    """Whole texts against the words' sums, also above the size that is read in blocks and for words of any length."""
    rng, pick = np.random.default_rng(5), random.Random(5)
    languages, table, prior = _model(rng, 3)
    vocab = langid.vocabulary(PIECES)
    probs = np.exp(np.vstack([table.astype(np.float32), np.full((1, 3), -np.inf)]).astype(float))
    texts = [" ".join("".join(pick.choices(LETTERS, k=pick.randint(1, 9))) for _ in range(n)) for n in (1, 3, 40)]
    texts += ["".join(pick.choices(LETTERS, k=400)), "ab cd " * 200_000, "x-y 5 ½", "½"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({c: F.lit(2) for c in ("lang_pred", "score", "_text")})
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(df, ["doc_id"], (languages, table, prior), PIECES).collect()}
    for i, text in enumerate(texts[:-1]):
        counts = {}
        for w in langid.words_of(text):
            counts[w] = counts.get(w, 0) + 1
        logs = prior + sum(n * langid.Lattices(vocab, [w]).log_probs(probs)[0] for w, n in counts.items())
        assert got[i][0] == languages[int(logs.argmax())]
        assert got[i][1] == pytest.approx(1 / np.exp(logs - logs.max()).sum(), abs=1e-6)
    assert got[len(texts) - 1] == got[None] == ("und", 0.0)


def test_a_long_word_takes_linear_time():
    vocab = langid.vocabulary(PIECES)
    probs = np.exp(np.vstack([_model(np.random.default_rng(1))[1], np.full((1, 2), -np.inf)]))
    start = time.monotonic()
    assert np.isfinite(langid.long_log_probs(vocab, "▁" + "".join(random.Random(1).choices(LETTERS, k=200_000)), probs)).all()
    assert time.monotonic() - start < 60
