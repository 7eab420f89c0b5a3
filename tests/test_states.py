"""Mergeable timing states, keys of a batch against a large table, variants, and BSON cut at frame boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from kinetable.operators import catalog as ct
from kinetable.operators import moments as mo
from kinetable.operators import timing as tm
from kinetable.plans.sources import encode_bson
from kinetable.sources import binary, bsonranges, variants, walk

MESSAGES = "episode_id LONG, topic STRING, seq LONG, ts_ns LONG"


def _recordings(seed):
    rng = random.Random(seed)
    out = []
    for part in range(4):
        rows = []
        for e in range(3):
            for t in ("a", "b", "c")[: rng.randint(1, 3)]:
                at = part * 10**9
                for n in range(rng.choice([1, 2, 40])):
                    rows.append((e, t, n, at))
                    at += rng.choice([0, 1, 33_000_000 // 7, rng.randint(1, 10**7)])
        out.append(rows)
    return out


def _close(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for a, b in zip(got, want, strict=True):
        assert list(a[3:]) == pytest.approx(list(b[3:]), rel=1e-6, abs=1e-6)


def test_merged_states_equal_the_whole(spark, tmp_path):
    parts = _recordings(3)
    store = mo.TimingStore(spark, str(tmp_path / "states"))
    for i, rows in enumerate(parts):
        store.add(f"r{i}", spark.createDataFrame(rows, MESSAGES))
    rows = [(e, t, 100 * i + n, ts) for i, part in enumerate(parts) for e, t, n, ts in part]
    want = sorted(map(tuple, tm.topic_timing(spark.createDataFrame(rows, MESSAGES)).collect()))
    _close(sorted(map(tuple, store.timing().collect())), want)
    # a recording added again replaces itself
    store.add("r2", spark.createDataFrame(parts[2], MESSAGES))
    _close(sorted(map(tuple, store.timing().collect())), want)
    assert store.timing().columns == tm.topic_timing(spark.createDataFrame(rows, MESSAGES)).columns


def test_merging_is_associative_and_does_not_depend_on_order(spark):
    parts = [mo.timing_states(spark.createDataFrame(rows, MESSAGES)) for rows in _recordings(5)]
    first = mo.merge_states(parts[0].unionByName(parts[1])).drop("overlaps")
    rest = mo.merge_states(parts[3].unionByName(parts[2])).drop("overlaps")
    every = parts[2].unionByName(parts[0]).unionByName(parts[3]).unionByName(parts[1])
    assert sorted(map(str, mo.merge_states(first.unionByName(rest)).select(*mo.merge_states(every).columns).collect())) == sorted(map(str, mo.merge_states(every).collect()))


def test_overlapping_recordings_are_refused(spark, tmp_path):
    store = mo.TimingStore(spark, str(tmp_path / "states"))
    store.add("x", spark.createDataFrame([(1, "a", 0, 0), (1, "a", 1, 100)], MESSAGES))
    store.add("y", spark.createDataFrame([(1, "a", 0, 100), (1, "b", 0, 50)], MESSAGES))
    assert store.timing().where("topic = 'a'").first()["n"] == 3
    store.add("z", spark.createDataFrame([(1, "a", 0, 99)], MESSAGES))
    with pytest.raises(ValueError, match="overlap"):
        store.timing()
    store.add("z", spark.createDataFrame([], MESSAGES))
    assert store.timing().count() == 2


def _keys(rows):
    return {(r["value"], r["rows"]) for r in rows.collect()}


def test_batch_keys_equal_the_full_check(spark):
    rng = random.Random(1)
    old = [(rng.randrange(3000), rng.choice("xyz")) for _ in range(6000)] + [(None, "x"), (5, None)]
    new = [(rng.randrange(6000), rng.choice("xyz")) for _ in range(200)] + [(None, "x"), (None, "x"), (9999, "q"), (9999, "q"), (8888, "q")]
    table, batch = spark.createDataFrame(old, "k LONG, t STRING"), spark.createDataFrame(new, "k LONG, t STRING")
    full = ct.violations(table.unionByName(batch), [["k", "t"]])
    mine = {f"{k}|{t}" for k, t in new if k is not None}
    assert _keys(ct.batch_violations(batch, table, ["k", "t"])) == {(v, n) for v, n in _keys(full) if v in mine}
    assert ct.batch_violations(batch.limit(0), table, ["k", "t"]).count() == 0
    assert _keys(ct.batch_violations(batch, table.limit(0), ["k", "t"])) == {("9999|q", 2)} | {(f"{k}|{t}", n) for (k, t) in set(new) if k is not None and k < 9999 and (n := new.count((k, t))) > 1}


def test_the_filter_lets_few_other_keys_through(spark):
    batch = spark.range(1000).withColumnRenamed("id", "k")
    bits = 1 << 14
    words = ct.key_filter(batch, ["k"], bits)
    assert len(words.first()["words"]) == bits // 64
    passed = spark.range(0, 101_000).withColumnRenamed("id", "k").where(ct.may_contain(words.scalar(), ["k"], bits))
    kept = {r["k"] for r in passed.collect()}
    assert set(range(1000)) <= kept and len(kept) < 1000 + 0.02 * 100_000


def test_a_small_filter_gives_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(ct, "MAX_BITS", 1 << 10)
    table, batch = spark.range(5000).withColumnRenamed("id", "k"), spark.range(4000, 6000).withColumnRenamed("id", "k")
    assert ct.batch_violations(batch, table, ["k"]).count() == 1000


def test_variants_without_a_schema(spark):
    texts = ['{"data": [{"a": 1}, {"a": [1.5, null, "x"]}, 3]}', '{"data": 5}', '{"data": [', "", "null", None, '{"data": []}', "[1]"]
    documents = variants.parse_texts(spark.createDataFrame(list(enumerate(texts)), "no LONG, value STRING"))
    assert {r["no"] for r in documents.where("document is null").collect()} == {2, 3, 5}
    frames = variants.document_frames(documents).select("no", "frame_index", F.to_json("frame").alias("frame")).collect()
    assert sorted(map(tuple, frames)) == [(0, 0, '{"a":1}'), (0, 1, '{"a":[1.5,null,"x"]}'), (0, 2, "3")]
    rows = sorted((r["no"], r["leaf"], r["value"]) for r in variants.leaves(documents.where("no in (0, 7)"), "document", ["no"]).collect() if r["value"] is not None)
    assert rows == [(0, "$.data[0].a", "1"), (0, "$.data[1].a[0]", "1.5"), (0, "$.data[1].a[2]", "x"), (0, "$.data[2]", "3"), (7, "$[0]", "1")]
    shallow = {r["leaf"]: r["value"] for r in variants.leaves(documents.where("no = 0"), "document", ["no"], depth=1).collect()}
    assert set(shallow) == {"$.data"} and shallow["$.data"].startswith('[{"a":1}')


def _frames(n, kind):
    if kind == "main":
        return {"id": 1, "name": "é" * 200, "data": {"/arm": [{"t": i, "data": {"pos": [float(i), 0.5], "skip": "s"}} for i in range(n)], "/empty": []}, "z": True}
    return {"frames": [{"observation": {"left": [float(i)]}, "ok": True, "n": 2**40} for i in range(n)]}


def test_ranges_give_the_rows_of_whole_contents(spark, tmp_path, monkeypatch):
    bodies = {f"{kind}{n}.bson": encode_bson(_frames(n, kind)) for kind in ("main", "hand") for n in (0, 1, 7, 1200)}
    bodies |= {"cut.bson": bodies["main1200.bson"][:3000], "none.bson": encode_bson({"x": 1}), "empty.bson": b"", "unknown.bson": (20).to_bytes(4, "little") + b"\x7fname\x00" + b"x" * 9 + b"\x00"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    listing = walk.walk(spark, [str(tmp_path)])
    ranges = bsonranges.bson_ranges(listing)
    got = bsonranges.ingest_ranges(ranges)
    whole = binary.ingest_bson(binary.read_binary(spark, str(tmp_path)))
    rows = lambda df: sorted((r["path"].rsplit("/", 1)[1], str(r["data_path"]), r["frame_index"], r["values"]) for r in df.where("error is null").collect())
    assert rows(got) == rows(whole) and len(rows(got)) > 2400
    assert {r["path"].rsplit("/", 1)[1] for r in got.where("error is not null").collect()} == {"cut.bson", "none.bson", "empty.bson", "unknown.bson"}
    # frames of another shape are passed over, not an error for the file
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd/odd.bson").write_bytes(encode_bson({"data": {"/odd": [1, {"data": 3}, {"data": {"x": [2], "y": 1}}]}}))
    odd = bsonranges.ingest_ranges(bsonranges.bson_ranges(walk.walk(spark, [str(tmp_path / "odd")])))
    assert [tuple(r)[1:] for r in odd.collect()] == [("/odd.x", 2, [2.0], None)]
    runs = ranges.where("path like '%main1200.bson' and topic = '/arm'").orderBy("first").collect()
    assert [(r["first"], r["frames"]) for r in runs] == [(0, 500), (500, 500), (1000, 200)]


def test_one_large_file_is_decoded_by_several_tasks(spark, tmp_path):
    (tmp_path / "one.bson").write_bytes(encode_bson(_frames(6000, "hand")))
    rows = bsonranges.ingest_ranges(bsonranges.bson_ranges(walk.walk(spark, [str(tmp_path)])))
    tasks = rows.select(F.spark_partition_id().alias("task"), "frame_index").groupBy("task").count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 6000


def test_walking_holds_little_of_a_file():
    body = encode_bson(_frames(4000, "main"))
    asked = []

    def read(path, offset, length):
        asked.append(length)
        return body[offset : offset + length]

    runs = list(bsonranges.frame_runs("x", len(body), read))
    assert sum(r[2] for r in runs if r[0] == "/arm") == 4000 and max(asked) <= bsonranges.AHEAD
    long = encode_bson({"k" * 50_000: 1, "frames": [{"a": {"b": [1.0]}}]})
    assert list(bsonranges.frame_runs("x", len(long), lambda p, o, n: long[o : o + n]))[0][1:3] == (0, 1)
