"""BSON frames of one layout are read by one form, with the rows that reading element by element gives."""

import random
import struct

import pyarrow as pa
import pytest

from kinetable.plans import sources
from kinetable.sources import binary


@pytest.fixture
def layouts(monkeypatch):
    known = {}
    monkeypatch.setattr(binary, "_LAYOUTS", known)
    return known


def _rows(content):
    rows = []
    try:
        for row in binary.bson_frames(content):
            rows.append((row[0], row[1], [float(v) for v in row[2]]))
    except (ValueError, TypeError, AttributeError) as exc:
        rows.append(str(exc))
    return rows


def _plain(content, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(binary, "_known_frame", lambda *_: None)
        return _rows(content)


def test_frames_of_a_layout_are_not_read_element_by_element(layouts, monkeypatch):
    content = sources.encode_bson({"data": {"/a": [{"t": 2**40 + i, "data": {"pos": [i / 2, 1.0], "name": "é"}} for i in range(500)]}})
    want = _plain(content, monkeypatch)
    reads = []
    read = binary._read
    monkeypatch.setattr(binary, "_read", lambda *a: reads.append(a) or read(*a))
    assert _rows(content) == want and len(want) == 500
    # the document, its topics and the list of frames
    assert len(reads) == 3


ODD = [
    {"data": {"x": [1.0, 2], "y": []}}, {"data": {"x": [1.0, "2"]}}, {"data": {"x": [True, 1.5]}}, {"data": {"x": [[1.0]]}}, {"data": 5}, {"data": [1.0]},
    {"data": {}}, {"o": {"l": [1.0], "r": [2**40]}, "ok": True}, {"o": {"l": [3.0], "r": [2**41]}, "ok": False}, {"o": [1.0], "p": {"q": {"z": [1.0]}}},
    {"o": {"l": [{"data": {"x": [1.0]}}]}}, {}, {"s": "ab", "data": {"x": [0.0]}}, {"s": "cd", "data": {"x": [0.5]}},
]


def test_odd_and_damaged_frames_give_the_same_rows(layouts, monkeypatch):
    rng, errors = random.Random(4), 0
    for n in range(1500):
        frames = rng.choices(ODD, k=rng.randint(0, 6))
        if n % 3 == 0:
            frames += [[1.0], "text", 3][: rng.randint(0, 3)]
        content = sources.encode_bson(rng.choice([{"data": {"/a": frames, "/b": frames[:2], "c": 1}}, {"frames": frames}, {"frames": frames, "data": {"/a": frames}}, {"data": frames}]))
        if n % 2:
            damaged = bytearray(content)
            for _ in range(rng.randint(1, 3)):
                damaged[rng.randrange(4, len(damaged))] = rng.choice([0, 1, 2, 3, 4, 8, 16, 18, 97, 255])
            content = bytes(damaged)
        want = _plain(content, monkeypatch)
        assert repr(_rows(content)) == repr(want)
        errors += bool(want) and isinstance(want[-1], str)
    assert errors > 50 and layouts


def test_kept_layouts_are_bounded(layouts):
    for n in range(600):
        _rows(sources.encode_bson({"frames": [{"o" * (n % 400 + 1): {"l": [1.0]}, "s": struct.pack("<I", n).hex()}]}))
    assert len(layouts) == binary.KEPT_SIZES and max(map(len, layouts.values())) <= binary.KEPT_LAYOUTS


def test_a_document_may_go_on_in_the_next_batch():
    rows = [{"e": e, "part": p, "q": float(i), "p": i / 2, "d": i / 4} for e in (2, 3, 22) for p in (0, 1) for i in range(5)]
    whole = pa.RecordBatch.from_pylist(rows)
    for size in (1, 3, 7, 30):
        made = sources._encode_orders(iter([whole.slice(a, size) for a in range(0, 30, size)] + [whole.slice(0, 0)]))
        got = {r["path"]: r["content"] for b in made for r in b.to_pylist()}
        assert list(got) == [f"/ep/{e}_{p}.bson" for e in (2, 3, 22) for p in (0, 1)]
        assert _rows(got["/ep/2_1.bson"]) == [("/arm/left.pos", i, [i, i / 2]) for i in range(5)]
        assert _rows(got["/ep/3_0.bson"]) == [("observation.left_hand", i, [i / 4]) for i in range(5)]
        assert _rows(got["/ep/22_0.bson"]) == ["no data and no frames"]
