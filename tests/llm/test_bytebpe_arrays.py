"""New pieces of byte BPE: merged in arrays, equal to the merge of one piece alone."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest

from kinetable.llm import bytebpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture
def own():
    return bytebpe.ByteEncoder(RANKS, public_tokenizers.PATTERN)


def _ids(own, text):
    return b"".join(np.array(own.piece(p.encode()), "<u4").tobytes() for p in own.split.findall(text))


def test_new_pieces_are_merged_in_arrays_like_alone(own, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abethnoré漢🙂") for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(60)] + ["", None, " ", "aaaa" * 12, "\n\n x"]
    want = [_ids(own, t or "") for t in texts]
    alone = []
    piece = own.piece
    monkeypatch.setattr(own, "piece", lambda data: alone.append(data) or piece(data))
    assert own.encode(texts) == want
    # one at a time only what is a token, or too long for an array
    assert all(data in own.ranks or len(data) > bytebpe.ARRAY_BYTES for data in alone)
    assert own.encode(texts) == want
    assert [own.decode(ids) for ids in want] == [(t or "").encode() for t in texts]


def test_forgotten_pieces_do_not_change_ids(own, monkeypatch):
    monkeypatch.setattr(bytebpe, "KEPT_PIECES", 5)
    monkeypatch.setattr(bytebpe, "HELD_CHARS", 50)
    texts = [f"zq{i} wvx{i % 3} the end, " * 3 for i in range(40)] + ["q" * 300]
    assert own.encode(texts) == [_ids(own, t) for t in texts]
    assert len(own.known) <= 5 + 50


def test_ranks_without_all_bytes(tmp_path):
    tokens = [b"a", b"b", b"c", b"ab", b"abc", b"cab"]
    path = tmp_path / "few.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)))
    few = bytebpe.ByteEncoder(str(path), public_tokenizers.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in few.encode(["cabcabba", "ab"])] == [few.piece(b"cabcabba"), [3]]
    with pytest.raises(KeyError):
        few.encode(["abx"])
