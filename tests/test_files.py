"""Readers, writers and stream jobs on small files, with exact expected rows."""

import json

import pytest
from pyspark.sql import functions as F

from kinetable.functions.tags import tag_map
from kinetable.operators import catalog as ct
from kinetable.operators import paths as pt
from kinetable.operators import records as rc
from kinetable.plans.sources import encode_bson
from kinetable.sources import binary, boxes, files, walk, writers
from kinetable.streaming import jobs


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content) if isinstance(content, bytes) else path.write_text(content, encoding="utf-8")


def test_listing_and_dataset_roots(spark, tmp_path):
    for name in ["a/local_dataset_info.yml", "a/local_dataset_info.yml.yml", "a/x/local_dataset.yml", "b/c/d/local_dataset_info .yml", "b/e/f.txt"]:
        put(tmp_path / name, "x")
    listing = files.list_files(spark, str(tmp_path))
    assert listing.count() == 5
    roots = [tuple(r) for r in pt.dataset_roots(listing, [str(tmp_path)]).orderBy("copy_name").collect()]
    assert roots == [
        (f"{tmp_path}/a", f"{tmp_path}/a/local_dataset_info.yml", "local_dataset_info_0.yml"),
        (f"{tmp_path}/b/c/d", f"{tmp_path}/b/c/d/local_dataset_info .yml", "local_dataset_info_1.yml"),
    ]


def test_json_episodes_skip_the_broken_file(spark, tmp_path):
    frame = {"states": {"left_arm": {"qpos": [1, 2]}}, "actions": {"left_arm": {"qpos": [3]}}}
    put(tmp_path / "ep1/data.json", json.dumps({"data": [frame, frame]}))
    put(tmp_path / "ep2/data.json", '{"data": [')
    episodes = files.read_json_episodes(spark, str(tmp_path))
    assert sorted((r["path"][-13:], r["data"] is None) for r in episodes.collect()) == [("ep1/data.json", False), ("ep2/data.json", True)]
    rows = files.json_frames(episodes).select("frame_index", "states.left_arm.qpos").orderBy("frame_index").collect()
    assert [tuple(r) for r in rows] == [(0, [1.0, 2.0]), (1, [1.0, 2.0])]


def test_jsonl_blank_lines_and_broken_line(spark, tmp_path):
    put(tmp_path / "good/episodes.jsonl", '{"episode_index": 0, "length": 5}\n\n{"episode_index": 1, "length": 7}\n')
    rows = files.read_jsonl(spark, str(tmp_path / "good"), files.EPISODES_SCHEMA).orderBy("episode_index").collect()
    assert [(r["episode_index"], r["length"]) for r in rows] == [(0, 5), (1, 7)]
    put(tmp_path / "bad/tasks.jsonl", '{"task_index": 0, "task": "a"}\n{broken\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad"), files.TASKS_SCHEMA).collect()


def test_info_and_device_files(spark, tmp_path):
    info = {"total_episodes": 2, "total_frames": 9, "fps": 25, "features": {"states": {"dtype": "float32", "shape": [2], "name": ["a", "b"]}, "next.done": {"dtype": "bool", "shape": [1], "names": None}}}
    put(tmp_path / "meta/info.json", json.dumps(info, indent=2))
    read = files.read_json_documents(spark, str(tmp_path / "meta"), files.INFO_SCHEMA)
    assert read.first()["total_frames"] == 9
    rows = {r["feature"]: r for r in files.info_features(read).collect()}
    assert rows["states"]["names"] == ["a", "b"] and rows["next.done"]["names"] is None
    device = {"device_list": [{"device_id": "d", "device_type": "t", "device_info": {"cam": {"type": "x"}, "arm": {"type": "y", "dimension": {"j": "rad"}, "description": {"j": None}}}}]}
    put(tmp_path / "device/device_info.json", json.dumps(device))
    joints = files.device_joints(files.read_json_documents(spark, str(tmp_path / "device"), files.DEVICE_SCHEMA))
    assert sorted((r["part"], r["joint"], r["unit"]) for r in joints.collect()) == [("arm", "j", "rad"), ("cam", None, None)]


def test_registry_rejects(spark, tmp_path):
    put(tmp_path / "a.yml", "dataset_name: n\ndataset_uuid: u\ndevice_model: m\nobjects:\n- object_name: table\n  level1: furniture\n- banana peel:\noperation_platform_heigth: 77.2\n")
    put(tmp_path / "b.yaml", "# only a comment\n")
    put(tmp_path / "c.yml", "dataset_name: n\n")
    put(tmp_path / "d.yml", "a: [1\n")
    put(tmp_path / "e.yml", "- 1\n")
    records = files.read_registry(spark, str(tmp_path))
    good, bad = records.where("reject_reason IS NULL"), records.where("reject_reason IS NOT NULL")
    row = good.first()
    assert good.count() == 1 and row["device_model"] == ["m"] and row["operation_platform_height"] == 77.2
    assert row["objects"] == [{"object_name": "table", "level1": "furniture"}, {"banana peel": None}]
    reasons = {r["path"][-6:]: r["reject_reason"] for r in bad.collect()}
    assert reasons["b.yaml"] == "empty" and reasons["/c.yml"] == "missing dataset_uuid" and reasons["/e.yml"] == "not a mapping"
    assert reasons["/d.yml"].startswith("not YAML")
    cleaned = rc.normalise_records(good).first()["objects"]
    assert [o["object_name"] for o in cleaned] == ["table", "banana_peel"]


def test_tag_csv(spark, tmp_path):
    put(tmp_path / "tags.csv", 'id,address_nas,tags\n1,/x/task_a,"size: 3\ncolour：red、blue"\n2,  ,"size: 1"\n3,/x/short\n4,/x/task_b,\n')
    rows = files.read_tag_csv(spark, str(tmp_path)).withColumn("m", tag_map(F.col("tags"))).orderBy("address_nas").collect()
    assert [(r["address_nas"], r["m"]) for r in rows] == [("/x/task_a", {"size": ["3"], "colour": ["red", "blue"]}), ("/x/task_b", {})]
    put(tmp_path / "other/bad.csv", "id,tags\n1,x\n")
    with pytest.raises(ValueError, match="address_nas"):
        files.read_tag_csv(spark, str(tmp_path / "other"))
    # another order of the columns must not exchange addresses and tags
    put(tmp_path / "mixed/a.csv", "id,address_nas,tags\n1,/x/a,t\n")
    put(tmp_path / "mixed/b.csv", "id,tags,address_nas\n1,t,/x/b\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_tag_csv(spark, str(tmp_path / "mixed")).collect()


def test_bson_values_and_faults():
    doc = {"d": 1.5, "s": "hé", "doc": {"x": 1}, "a": [1, 2.5, "z"], "t": True, "i": -3, "l": 2**40}
    raw = encode_bson(doc)
    assert binary.decode_bson(raw) == doc
    assert binary.decode_bson(raw[:-3]) is None and binary.decode_bson(b"") is None
    unknown = encode_bson({"a": 1})[:-1] + b"\x07oid\x00" + b"\x00" * 12 + b"\x00"
    unknown = len(unknown).to_bytes(4, "little") + unknown[4:]
    assert binary.decode_bson(unknown) == {"a": 1}


def test_bson_files(spark, tmp_path):
    put(tmp_path / "e0/main.bson", encode_bson({"data": {"/arm": [{"data": {"pos": [1.0, 2.0]}}, {"data": {"pos": [3.0, 4.0]}}]}}))
    put(tmp_path / "e0/hand.bson", encode_bson({"frames": [{"observation": {"left_hand": [7]}, "action": {"left_hand": [8]}}]}))
    put(tmp_path / "e1/main.bson", b"\xff\xff\xff\x7fxx")
    rows = binary.ingest_bson(binary.read_binary(spark, str(tmp_path), "*.bson"))
    good, bad = rows.where("error IS NULL"), rows.where("error IS NOT NULL")
    assert sorted((r["data_path"], r["frame_index"], r["values"]) for r in good.collect()) == [
        ("/arm.pos", 0, [1.0, 2.0]),
        ("/arm.pos", 1, [3.0, 4.0]),
        ("action.left_hand", 0, [8.0]),
        ("observation.left_hand", 0, [7.0]),
    ]
    assert [r["path"][-12:] for r in bad.collect()] == ["e1/main.bson"]
    plugged = binary.ingest_bson(binary.read_binary(spark, str(tmp_path), "*.bson"), lambda content: iter([("size", 0, [len(content)])]))
    assert plugged.count() == 3


def test_media_check(spark, tmp_path):
    ftyp = (12).to_bytes(4, "big") + b"ftypisom"
    moov = (8).to_bytes(4, "big") + b"moov"
    put(tmp_path / "ok.mp4", ftyp + moov)
    put(tmp_path / "cut.MOV", ftyp + moov[:6])
    put(tmp_path / "x.webm", b"\x1a\x45\xdf\xa3...")
    put(tmp_path / "y.flv", b"no")
    put(tmp_path / "z.txt", b"no")
    found = {r["path"].rsplit("/", 1)[1]: r["errors"] for r in binary.bad_media(binary.read_binary(spark, str(tmp_path))).collect()}
    assert set(found) == {"cut.MOV", "y.flv"}

    def crash(path, content):
        raise RuntimeError("codec")

    assert binary.bad_media(binary.read_binary(spark, str(tmp_path)), crash).first()["errors"] == ["unhandled error: codec"]


FTYP, MOOV = (12).to_bytes(4, "big") + b"ftypisom", (8).to_bytes(4, "big") + b"moov"


def test_boxes_by_ranges_find_what_the_whole_content_shows(spark, tmp_path):
    wide = (1).to_bytes(4, "big") + b"mdat" + (20).to_bytes(8, "big") + b"four"
    bodies = {
        "ok.mp4": FTYP + MOOV, "open.mp4": FTYP + MOOV + (0).to_bytes(4, "big") + b"mdat" + b"x" * 50, "wide.mov": FTYP + wide + MOOV, "cut.MOV": FTYP + MOOV[:6],
        "short.mp4": FTYP + MOOV + b"tail", "late.mp4": MOOV + FTYP, "none.m4v": FTYP + wide, "long.mp4": FTYP + (99).to_bytes(4, "big") + b"moov", "tiny.mp4": b"abc",
        "small.mp4": FTYP + (3).to_bytes(4, "big") + b"moov", "half.mp4": FTYP + wide[:12], "empty.mp4": b"", "x.webm": b"\x1a\x45\xdf\xa3...", "y.flv": b"no", "void.avi": b"", "z.txt": b"no",
    }
    for name, body in bodies.items():
        put(tmp_path / name, body)
    listing = walk.walk(spark, [str(tmp_path)])
    found = {r["path"].rsplit("/", 1)[1]: r["errors"] for r in boxes.box_findings(boxes.read_boxes(listing)).collect()}
    assert set(found) == set(bodies) - {"z.txt"}
    whole = {n: binary.check_container(n, b) for n, b in bodies.items() if n != "z.txt"}
    # a box that ends within its header is bytes after the last box there, and a cut box here
    assert {n: e for n, e in found.items() if n != "half.mp4"} == {n: e for n, e in whole.items() if n != "half.mp4"}
    assert found["half.mp4"] == ["box at 12 is cut"]
    rows = boxes.read_boxes(listing).where("path like '%wide.mov'").orderBy("no").collect()
    assert [(r["no"], r["offset"], r["kind"], r["size"]) for r in rows] == [(0, 0, "ftyp", 12), (1, 12, "mdat", 20), (2, 32, "moov", 8)]


def test_a_file_of_three_gigabytes_is_checked(spark, tmp_path):
    for name, end in {"large.mp4": MOOV, "broken.mp4": b""}.items():
        with open(tmp_path / name, "wb") as file:
            size = 3 << 30
            file.write(FTYP + (1).to_bytes(4, "big") + b"mdat" + size.to_bytes(8, "big"))
            file.seek(12 + size)
            file.write(end)
            file.truncate(12 + size + len(end))
    found = {r["path"].rsplit("/", 1)[1]: (r["boxes"], r["errors"]) for r in boxes.box_findings(boxes.read_boxes(walk.walk(spark, [str(tmp_path)]))).collect()}
    assert found == {"large.mp4": (3, []), "broken.mp4": (2, ["no moov box"])}


def test_a_file_that_is_gone_is_an_error(spark):
    listing = spark.createDataFrame([("/no/such/file.mp4", 20), ("/no/such/file.txt", 20)], "path string, length long")
    assert boxes.box_findings(boxes.read_boxes(listing)).first()["errors"] == ["not readable: FileNotFoundError"]


def test_walk_lists_a_deep_tree_in_tasks(spark, tmp_path):
    deep = tmp_path / "root" / "/".join(f"d{i}" for i in range(12))
    names = {"root/a.txt": 3, "root/d0/b.txt": 5, f"{deep.relative_to(tmp_path)}/c.txt": 7}
    for i in range(40):
        names[f"root/wide/e{i}/f{i}.json"] = i
    for name, size in names.items():
        put(tmp_path / name, "x" * size)
    (tmp_path / "root/round").symlink_to(tmp_path / "root", target_is_directory=True)
    (tmp_path / "root/nothing").mkdir()
    found = {r["path"]: (r["length"], r["level"]) for r in walk.walk(spark, [str(tmp_path / "root")]).collect()}
    wanted = {f"{tmp_path}/{n}": (size, n.count("/") - 1) for n, size in names.items()}
    assert {p: v for p, v in found.items() if not p.endswith("/round")} == wanted
    listing = files.list_files(spark, str(tmp_path / "root/wide"))
    # the listing of the file source leaves out empty files
    assert {(r["path"], r["length"]) for r in listing.collect()} == {(p, v[0]) for p, v in wanted.items() if "/wide/" in p and v[0]}
    # a table of roots, one of them not there, and one as a URI
    roots = spark.createDataFrame([(f"{tmp_path}/root/wide/e1",), (f"{tmp_path}/gone",), (f"file://{tmp_path}/root/d0",)], "path string")
    assert sorted(r["path"].rsplit("/", 1)[1] for r in walk.walk(spark, roots).collect()) == ["b.txt", "c.txt", "f1.json"]
    assert walk.walk(spark, []).count() == 0


def test_walk_stops_below_a_marker(spark, tmp_path):
    for name in ["a/local_dataset_info.yml", "a/x/local_dataset.yml", "a/x/y/z.txt", "b/c/d/local_dataset_info .yml", "b/e/f.txt"]:
        put(tmp_path / name, "x")
    log = tmp_path.parent / f"{tmp_path.name}-asked"
    log.mkdir()

    def lister(path):
        # tasks run in other processes: each leaves a mark for what it lists
        (log / path[len(str(tmp_path)) :].replace("/", "_")[:50].ljust(1, "_")).touch()
        return walk.list_directory(path)

    found = walk.walk(spark, [str(tmp_path)], marker=pt.DATASET_MARKER, lister=lister)
    assert sorted(r["path"][len(str(tmp_path)) :] for r in found.collect()) == ["/a/local_dataset_info.yml", "/b/c/d/local_dataset_info .yml", "/b/e/f.txt"]
    # below a marker nothing was even listed
    assert sorted(p.name for p in log.iterdir()) == ["_", "_a", "_b", "_b_c", "_b_c_d", "_b_e"]
    roots = pt.dataset_roots(found, [str(tmp_path)]).collect()
    assert sorted(r["dataset_dir"][len(str(tmp_path)) :] for r in roots) == ["/a", "/b/c/d"]


def test_files_written_in_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"12"), ("b/c", b""), ("b/d", None)], "name string, body binary")
    written = walk.write_files(rows, F.concat(F.lit(f"{tmp_path}/out/"), "name"), F.col("body"))
    assert sorted((r["path"][len(f"{tmp_path}/out/") :], r["length"]) for r in written.collect()) == [("a", 2), ("b/c", 0), ("b/d", 0)]
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()} == {"a": b"12", "c": b"", "d": b""}


def test_trajectory_round_trip(spark, tmp_path):
    frames = spark.createDataFrame(
        [(e, f, e % 3, [float(f)]) for e in (0, 1, 1500, 2) for f in range(4)],
        "episode_index long, frame_index long, task_index long, state array<double>",
    )
    tasks = spark.createDataFrame([(0, "task 0"), (1, "task 1")], "task_index long, task string")
    features = spark.createDataFrame([("state", "float32", [1], ["x"]), ("cam", "video", [480, 640, 3], None)], "feature string, dtype string, shape array<int>, names array<string>")
    root = str(tmp_path / "out")
    writers.write_trajectory(frames, root, tasks, fps=25, features=features)
    back = spark.read.parquet(f"{root}/data")
    assert sorted((r["episode_chunk"], r["episode_index"], r["frame_index"]) for r in back.collect()) == sorted(
        (e // 1000, e, f) for e in (0, 1, 1500, 2) for f in range(4)
    )
    info = files.read_jsonl(spark, f"{root}/meta/info", files.INFO_SCHEMA, "*.json").first()
    counts = ("total_episodes", "total_frames", "total_chunks", "total_tasks", "total_videos", "chunks_size", "fps")
    assert tuple(info[c] for c in counts) == (4, 16, 2, 2, 4, 1000, 25.0)
    assert info["splits"] == {"train": "0:4"} and info["features"]["cam"]["shape"] == [480, 640, 3] and info["features"]["state"]["names"] == ["x"]
    # an episode of an unknown task is kept, without a text
    episodes = spark.read.schema("episode_index long, tasks array<string>, length long").json(f"{root}/meta/episodes")
    assert {(r["episode_index"], *r["tasks"], r["length"]) for r in episodes.collect()} == {(0, "task 0", 4), (1, "task 1", 4), (1500, "task 0", 4), (2, 4)}
    # written again: the same metadata once, and no appending
    writers.write_trajectory(frames, root, tasks, fps=25, features=features, mode="overwrite")
    assert [spark.read.json(f"{root}/meta/{n}").count() for n in ("info", "tasks", "episodes")] == [1, 2, 4]
    with pytest.raises(ValueError, match="appended"):
        writers.write_trajectory(frames, root, tasks, mode="append")


def _trajectory(spark, episodes):
    rows = [(e, f, e % 3, [float(f)]) for e in episodes for f in range(e % 4 + 1)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, task_index long, state array<double>")


def _tasks(spark, *numbers):
    return spark.createDataFrame([(n, f"task {n}") for n in numbers], "task_index long, task string")


def test_two_writes_equal_one_write_of_both(spark, tmp_path):
    first, second = [0, 1, 2, 1500], [3, 4, 999, 1501, 7000]
    both, one = writers.TrajectoryStore(spark, str(tmp_path / "two")), writers.TrajectoryStore(spark, str(tmp_path / "one"))
    assert both.versions() == [] and both.parts() == [] and both.totals().first()[:] == (0, 0, 0, 0)
    assert both.add(_trajectory(spark, first), _tasks(spark, 0, 1)) == 0
    # a text that only comes now, one that is known, episodes of chunks that are there
    assert both.add(_trajectory(spark, second), _tasks(spark, 1, 2)) == 1
    one.add(_trajectory(spark, first + second), _tasks(spark, 0, 1, 2))

    def rows(store, name):
        return sorted(map(str, store.summary(name).drop("part").collect()))

    assert sorted(map(str, both.frames().drop("part").collect())) == sorted(map(str, one.frames().drop("part").collect()))
    assert rows(both, "tasks") == rows(one, "tasks") and both.totals().first() == one.totals().first()
    assert both.totals().first()[:] == (9, sum(e % 4 + 1 for e in first + second), 3, 3)
    # episode 2 was written before its task had a text
    known = {r["episode_index"]: r["tasks"] for r in both.summary("episodes").collect()}
    assert known[2] == [] and known[7000] == ["task 1"] and known[999] == ["task 0"]
    # the version before is still there
    assert both.frames(0).select("episode_index").distinct().count() == 4 and both.totals(0).first()["total_episodes"] == 4


def test_a_failed_addition_is_not_seen_and_written_over(spark, tmp_path):
    store = writers.TrajectoryStore(spark, str(tmp_path / "t"))
    store.add(_trajectory(spark, [0, 1]), _tasks(spark, 0, 1))
    with pytest.raises(ValueError, match="there already"):
        store.add(_trajectory(spark, [1, 2]), _tasks(spark, 2))
    with pytest.raises(ValueError, match="two texts"):
        store.add(_trajectory(spark, [5]), spark.createDataFrame([(0, "other")], "task_index long, task string"))
    assert store.versions() == [0] and store.frames().select("episode_index").distinct().count() == 2
    assert (tmp_path / "t/data/part=1").exists()
    assert store.add(_trajectory(spark, [2]), _tasks(spark, 2)) == 1
    assert sorted(r[0] for r in store.frames().select("episode_index").distinct().collect()) == [0, 1, 2]


def test_topic_csv_folders(spark, tmp_path):
    df = spark.createDataFrame([("/a/b", 1, 2.0), ("/a/b", 0, 1.0), ("/c", 5, 3.0)], "topic string, ts_ns long, value double")
    writers.write_topic_csv(df, str(tmp_path / "csv"))
    assert sorted(p.name for p in (tmp_path / "csv").iterdir() if p.is_dir()) == ["topic_folder=a_b", "topic_folder=c"]


def test_upsert_is_idempotent_and_keeps_values(spark):
    target = spark.createDataFrame([("a", "pending", "m", None, 1), ("b", "failed", None, "/p", 1)], jobs.STATUS_SCHEMA)
    changes = spark.createDataFrame([("a", "completed", None, "/q", 2), ("c", "failed", "x", None, 3), ("c", "completed", None, None, 4)], jobs.STATUS_SCHEMA)
    once = ct.status_upsert(target, changes)
    rows = {r["dataset_uuid"]: tuple(r)[1:4] for r in once.collect()}
    assert rows == {"a": ("completed", "m", "/q"), "b": ("failed", None, "/p"), "c": ("completed", "x", None)}
    assert sorted(map(tuple, ct.status_upsert(once, changes).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_get_or_create_keeps_ids(spark):
    existing = spark.createDataFrame([(7, "kitchen")], "id long, name string")
    values = spark.createDataFrame([("b",), ("kitchen",), ("a",), ("b",), (None,)], "name string")
    got = ct.get_or_create(existing, values, "id", "name")
    assert sorted(map(tuple, got.collect())) == [(7, "kitchen"), (8, "a"), (9, "b")]
    again = ct.get_or_create(got, values, "id", "name")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_stream_of_status_files(spark, tmp_path):
    table = jobs.StatusTable(spark, str(tmp_path / "table"))
    table.initialise(spark.createDataFrame([("a", "pending", "first", None, 0)], jobs.STATUS_SCHEMA))
    batches = [[("a", "failed", "why", "/x", 1), ("b", "completed", None, None, 1)], [("a", "completed", None, None, 2)]]
    for rows in batches:
        spark.createDataFrame(rows, jobs.STATUS_SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(jobs.STATUS_SCHEMA).json(str(tmp_path / "in"))
        jobs.fold_status(stream, table, str(tmp_path / "check")).awaitTermination()
    final = {r["dataset_uuid"]: tuple(r)[1:4] for r in table.read_newest().collect()}
    assert table.newest() == 2 and not (tmp_path / "table/manifest/version=0").exists()
    assert final == {"a": ("completed", "why", "/x"), "b": ("completed", None, None)}
    # a replayed batch gives the same version
    table.apply(spark.createDataFrame(batches[1], jobs.STATUS_SCHEMA), 1)
    assert {r["dataset_uuid"]: tuple(r)[1:4] for r in table.read(2).collect()} == final


def _parquet_files(folder):
    return {p.relative_to(folder) for p in folder.rglob("*.parquet")}


def test_a_small_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    table = jobs.StatusTable(spark, str(tmp_path / "table"), buckets=16)
    rows = [(f"d{i}", "pending", None, None, 0) for i in range(400)]
    table.initialise(spark.createDataFrame(rows, jobs.STATUS_SCHEMA))
    before = _parquet_files(tmp_path / "table/data")
    assert len(before) == 16 and table.read_newest().count() == 400
    table.apply(spark.createDataFrame([("d7", "completed", None, "/p", 5), ("d7", "failed", "x", None, 6)], jobs.STATUS_SCHEMA), 0)
    new = _parquet_files(tmp_path / "table/data") - before
    assert len(new) == 1 and table.manifest(1) != table.manifest(0)
    assert sum(written == 1 for written in table.manifest(1).values()) == 1
    final = {r["dataset_uuid"]: tuple(r)[1:4] for r in table.read_newest().collect()}
    assert len(final) == 400 and final["d7"] == ("failed", "x", "/p")
    # the version before is still whole, an empty batch writes no file, a new key may fill an empty bucket
    assert {r["convert_status"] for r in table.read(0).collect()} == {"pending"}
    files_before = _parquet_files(tmp_path / "table/data")
    table.apply(spark.createDataFrame([], jobs.STATUS_SCHEMA), 1)
    assert _parquet_files(tmp_path / "table/data") < files_before | {None} and table.read(2).count() == 400
    table.apply(spark.createDataFrame([("e", "completed", None, None, 1)], jobs.STATUS_SCHEMA), 2)
    assert table.read_newest().count() == 401
    # the bucket that version 1 replaced is gone with version 0
    assert len(_parquet_files(tmp_path / "table/data")) == 17


def test_initialising_again_forgets_the_older_run(spark, tmp_path):
    table = jobs.StatusTable(spark, str(tmp_path / "table"), buckets=4)
    table.initialise(spark.createDataFrame([("a", "pending", None, None, 0)], jobs.STATUS_SCHEMA))
    for n in range(3):
        table.apply(spark.createDataFrame([("a", "failed", None, None, n + 1)], jobs.STATUS_SCHEMA), n)
    table.initialise(spark.createDataFrame([("b", "pending", None, None, 0)], jobs.STATUS_SCHEMA))
    assert table.newest() == 0 and [r["dataset_uuid"] for r in table.read_newest().collect()] == ["b"]
    table.initialise(spark.createDataFrame([], jobs.STATUS_SCHEMA))
    assert table.read_newest().count() == 0
    with pytest.raises(FileNotFoundError):
        jobs.StatusTable(spark, str(tmp_path / "nowhere")).newest()


def test_late_pong_is_counted_and_corrected(spark, tmp_path):
    schema = "client string, kind string, s long"
    batches = [
        [("c", "ping", 0), ("d", "ping", 5)],
        [("z", "ping", 9000), ("z", "pong", 9000)],
        [("y", "ping", 9500), ("y", "pong", 9500)],
        # behind the watermark by now: the gap of c is out, this pong is dropped, and so is the ping of f
        [("c", "pong", 10), ("f", "ping", 20), ("z", "ping", 9600), ("z", "pong", 9600)],
    ]
    # a watermark starts at 1970, so nothing in the test may be as old as that
    ts = F.timestamp_seconds(F.col("s") + 100_000)

    def sides(df):
        return df.where("kind = 'ping'").select("client", ts.alias("ping_ts")), df.where("kind = 'pong'").select("client", ts.alias("pong_ts"))

    late = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        gaps = jobs.heartbeat_gaps(*sides(stream), "30 SECONDS", "1 MINUTE")
        query = gaps.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()
        late.append(jobs.late_events(query))
    assert late[:3] == [0, 0, 0] and late[3] >= 2
    out = spark.read.schema("client string, ping_ts timestamp").parquet(str(tmp_path / "out"))
    stored = sides(spark.read.schema(schema).json(str(tmp_path / "in")))
    fixes = jobs.correct_gaps(out.unionByName(out.where("client = 'd'")), *stored, "30 SECONDS", F.timestamp_seconds(F.lit(108_000)))
    found = {(r["client"], int(r["ping_ts"].timestamp()) - 100_000, r["change"]) for r in fixes.collect()}
    assert found == {("c", 0, "retract"), ("d", 5, "retract"), ("f", 20, "add")}


def test_heartbeat_stream_agrees_with_batch(spark, tmp_path):
    pings = [("c1", 0), ("c1", 100), ("c2", 5), ("c1", 900)]
    pongs = [("c1", 3), ("c2", 40), ("c1", 100), ("c1", 2000), ("c9", 2000)]
    schema = "client string, kind string, s long"
    rows = [(c, "ping", s) for c, s in [*pings, ("c9", 2000)]] + [(c, "pong", s) for c, s in pongs]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in"))

    def sides(df):
        ts = F.timestamp_seconds("s")
        return df.where("kind = 'ping'").select("client", ts.alias("ping_ts")), df.where("kind = 'pong'").select("client", ts.alias("pong_ts"))

    wanted = {("c2", 5), ("c1", 900)}
    batch = jobs.heartbeat_gaps_batch(*sides(spark.read.schema(schema).json(str(tmp_path / "in"))), "30 SECONDS")
    assert {(r["client"], int(r["ping_ts"].timestamp())) for r in batch.collect()} == wanted

    def stream():
        return spark.readStream.schema(schema).json(str(tmp_path / "in"))

    gaps = jobs.heartbeat_gaps(sides(stream())[0], sides(stream())[1], "30 SECONDS", "0 SECONDS", salts=3)
    query = (
        gaps.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    out = spark.read.schema("client string, ping_ts timestamp").parquet(str(tmp_path / "out"))
    assert {(r["client"], int(r["ping_ts"].timestamp())) for r in out.collect()} == wanted


def test_heartbeat_stream_waits_for_late_pongs(spark, tmp_path):
    schema = "client string, kind string, s long"
    batches = [[("c", "ping", 0), ("d", "ping", 5)], [("c", "ping", 500), ("e", "pong", 600)], [("c", "pong", 10)], [("c", "pong", 505), ("z", "ping", 9000), ("z", "pong", 9000)]]

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))

    ts = F.timestamp_seconds("s")
    for no, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        pings = stream().where("kind = 'ping'").select("client", ts.alias("ping_ts"))
        pongs = stream().where("kind = 'pong'").select("client", ts.alias("pong_ts"))
        gaps = jobs.heartbeat_gaps(pings, pongs, "30 SECONDS", "1 HOUR")
        gaps.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(
            availableNow=True
        ).start().awaitTermination()
    out = spark.read.schema("client string, ping_ts timestamp").parquet(str(tmp_path / "out"))
    # the pong of c came two batches late, that of d never
    assert {(r["client"], int(r["ping_ts"].timestamp())) for r in out.collect()} == {("d", 5)}


def test_event_stream_reads_a_folder_of_files(spark, tmp_path):
    from kinetable.plans import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    rows = sorted(map(tuple, QUERIES["stream_heartbeat_gap"](spark, str(tmp_path)).collect()))
    assert rows and rows == sorted(map(tuple, QUERIES["heartbeat_gap_batch"](spark, str(tmp_path)).collect()))


def test_pending_filters_outside_the_anti_join(spark):
    datasets = spark.createDataFrame([("u1", "m1"), ("u2", "m1"), ("u3", "m2")], "dataset_uuid string, device_model string")
    status = spark.createDataFrame([("u1",)], "dataset_uuid string")
    assert [r["dataset_uuid"] for r in ct.pending(datasets, status, "m1").collect()] == ["u2"]


def test_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v long")
    assert sorted(tuple(r) for r in ct.violations(df, [["k"], ["v"]], ["k"]).collect()) == sorted([("unique", "k", "a", 2), ("not_null", "k", None, 2)])
