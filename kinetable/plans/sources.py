"""Queries of the file sources, sinks and stream jobs.

The files are written by Spark from the driver tables into a scratch folder and read back, so
the SQL twin runs on the tables themselves.
"""

from __future__ import annotations

import bisect
import itertools
import struct
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.functions import flatten as fl
from kinetable.functions import names as nm
from kinetable.functions import tags as tg
from kinetable.operators.features import nested_path
from kinetable.operators.ordered import number_rows
from kinetable.plans.catalog import STATUS_SQL, old_status, status_events
from kinetable.plans.registry import Tables, query, r6
from kinetable.plans.standin import FRAMES_TASK_SQL, frames, frames_with_task, messages, messages_sql
from kinetable.plans.vectors import FLAT_COLUMNS, MSG_KEYS, typed_messages
from kinetable.session import local_partitions, scratch_dir
from kinetable.sources import binary, boxes, bsonranges, files, variants, walk, writers
from kinetable.streaming import jobs


@query(
    "json_episode_scan",
    """SELECT conv_id, turn // 200 AS part, CAST(row_number() OVER (PARTITION BY conv_id, turn // 200 ORDER BY turn) - 1 AS BIGINT) AS frame_index, role, CAST(turn * 1.5 AS DOUBLE) AS q0, CAST(length(text) AS DOUBLE) AS q1
FROM conversations WHERE conv_id % 9 > 0""",
)
def _json_episodes(t: Tables) -> DataFrame:
    """A text per 200 turns of a conversation, read without a schema; those of every ninth conversation are broken."""
    root = scratch_dir(t.spark, "json-episodes") + "/texts"
    frame = F.struct(
        "turn", F.col("role").alias("role"), F.struct(F.struct(F.array(F.col("turn") * 1.5, F.length("text").cast("double")).alias("qpos")).alias("left_arm")).alias("states")
    )
    part = F.expr("turn div 200").alias("part")
    episode = t.conversations.groupBy("conv_id", part).agg(F.array_sort(F.collect_list(frame)).alias("data"))
    text = F.to_json(F.struct("data"))
    broken = F.when(F.col("conv_id") % 9 == 0, F.concat(F.lit('{"data": [1, '), text)).otherwise(text)
    # a table of texts: as many files as tasks, however many episodes
    episode.select("conv_id", "part", broken.alias("value")).write.parquet(root)
    texts = t.spark.read.schema("conv_id LONG, part LONG, value STRING").parquet(root)
    rows = variants.document_frames(variants.parse_texts(texts))
    qpos = F.try_variant_get("frame", "$.states.left_arm.qpos", "array<double>")
    return rows.select(
        "conv_id", "part", F.col("frame_index").cast("long").alias("frame_index"), F.try_variant_get("frame", "$.role", "string").alias("role"), F.get(qpos, F.lit(0)).alias("q0"), F.get(qpos, F.lit(1)).alias("q1")
    )


@query(
    "json_episode_files",
    """SELECT conv_id % 8 AS episode, CAST(row_number() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn) - 1 AS BIGINT) AS frame_index, CAST(turn * 1.5 AS DOUBLE) AS q0
FROM conversations WHERE turn < 2 AND conv_id % 8 <> 3 AND conv_id % 5 = 0""",
)
def _json_files(t: Tables) -> DataFrame:
    """Eight files of episodes with a given schema, of which one is broken."""
    root = scratch_dir(t.spark, "json-files")
    frame = F.struct("conv_id", "turn", F.struct(F.struct(F.array(F.col("turn") * 1.5).alias("qpos")).alias("left_arm")).alias("states"))
    few = t.conversations.where("turn < 2 AND conv_id % 5 = 0").groupBy((F.col("conv_id") % 8).alias("episode"))
    text = F.to_json(F.struct(F.array_sort(F.collect_list(frame)).alias("data")))
    broken = few.agg(text.alias("value")).withColumn("value", F.when(F.col("episode") == 3, F.concat(F.lit("{"), "value")).otherwise(F.col("value")))
    walk.write_files(broken, F.concat(F.lit(f"{root}/in/episode_"), "episode", F.lit(".json")), F.encode("value", "UTF-8")).write.parquet(f"{root}/listing")
    schema = "STRUCT<conv_id: LONG, turn: LONG, states: STRUCT<left_arm: STRUCT<qpos: ARRAY<DOUBLE>>>>"
    rows = files.json_frames(files.read_json_episodes(t.spark, f"{root}/in", _type(t, schema)))
    return rows.select(F.regexp_extract("path", "episode_([0-9]+)", 1).cast("long").alias("episode"), F.col("frame_index").cast("long").alias("frame_index"), nested_path("states", "left_arm.qpos")[0].alias("q0"))


@query(
    "json_leaves",
    """SELECT conv_id, '$.turns[' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) || '].role' AS leaf, role AS value FROM conversations WHERE conv_id % 3 = 0 AND turn < 50
UNION ALL SELECT conv_id, '$.turns[' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) || '].size.chars', CAST(length(text) AS VARCHAR) FROM conversations WHERE conv_id % 3 = 0 AND turn < 50
UNION ALL SELECT DISTINCT conv_id, '$.name', 'conversation ' || conv_id FROM conversations WHERE conv_id % 3 = 1
UNION ALL SELECT DISTINCT conv_id, '$', CAST(conv_id AS VARCHAR) FROM conversations WHERE conv_id % 3 = 2""",
)
def _json_leaves(t: Tables) -> DataFrame:
    """Documents of three layouts, opened without naming any."""
    turn = F.struct("turn", F.struct("role", F.struct(F.length("text").alias("chars")).alias("size")).alias("t"))
    turns = F.transform(F.array_sort(F.collect_list(turn)), lambda x: x["t"])
    lists = t.conversations.where("conv_id % 3 = 0 AND turn < 50").groupBy("conv_id").agg(F.to_json(F.struct(turns.alias("turns"))).alias("value"))
    ids = t.conversations.select("conv_id").distinct()
    named = ids.where("conv_id % 3 = 1").select("conv_id", F.to_json(F.struct(F.concat(F.lit("conversation "), "conv_id").alias("name"))).alias("value"))
    plain = ids.where("conv_id % 3 = 2").select("conv_id", F.col("conv_id").cast("string").alias("value"))
    documents = variants.parse_texts(lists.unionByName(named).unionByName(plain))
    return variants.leaves(documents, "document", ["conv_id"], depth=4).select("conv_id", "leaf", "value")


def _type(t: Tables, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(f"x {ddl}")["x"].dataType


@query(
    "jsonl_meta_scan",
    """SELECT 'episode' AS kind, o_orderkey AS no, o_custkey % 50 AS length, o_orderpriority AS task FROM orders
UNION ALL SELECT DISTINCT 'task', o_custkey % 3, NULL, 'task ' || (o_custkey % 3) FROM orders""",
)
def _jsonl(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "jsonl")
    # every line is followed by a blank one, which the reader must skip
    episodes = t.orders.select(
        F.col("o_orderkey").alias("episode_index"), F.array("o_orderpriority").alias("tasks"), (F.col("o_custkey") % 50).alias("length")
    )
    lines = episodes.select(F.concat(F.to_json(F.struct("*")), F.lit("\n")).alias("value"))
    lines.write.text(f"{root}/episodes")
    tasks = t.orders.select((F.col("o_custkey") % 3).alias("task_index")).distinct()
    tasks.withColumn("task", F.concat(F.lit("task "), "task_index")).write.json(f"{root}/tasks")
    read = files.read_jsonl(t.spark, f"{root}/episodes", files.EPISODES_SCHEMA, "*.txt")
    named = files.read_jsonl(t.spark, f"{root}/tasks", files.TASKS_SCHEMA, "*.json")
    return read.select(F.lit("episode").alias("kind"), F.col("episode_index").alias("no"), "length", F.col("tasks")[0].alias("task")).unionByName(
        named.select(F.lit("task").alias("kind"), F.col("task_index").alias("no"), F.lit(None).cast("long").alias("length"), "task")
    )


@query(
    "json_meta_scan",
    """WITH n AS (SELECT n_name, n_regionkey, n_nationkey FROM nation)
SELECT n_name, 'feature' AS kind, 'states' AS name, 'float32' AS detail, 'a,b' AS elements, CAST(n_nationkey AS DOUBLE) AS number FROM n
UNION ALL SELECT n_name, 'feature', 'camera', 'video', 'h,w,c', CAST(n_nationkey AS DOUBLE) FROM n
UNION ALL SELECT n_name, 'device', 'arm', 'model ' || n_regionkey, unnest(['joint_1=rad', 'joint_2=m']), NULL FROM n
UNION ALL SELECT n_name, 'device', 'head', 'cam', NULL, NULL FROM n
UNION ALL SELECT n_name, 'camera', 'top', 'PINHOLE', 'brown', 600.5 + n_nationkey FROM n""",
)
def _json_meta(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "json-meta")
    n = F.col("n_nationkey")
    none = F.lit(None).cast("array<string>")
    info = F.struct(
        n.cast("double").alias("fps"),
        F.create_map(
            F.lit("states"),
            F.struct(F.lit("float32").alias("dtype"), F.array(F.lit(2)).alias("shape"), none.alias("names"), F.array(F.lit("a"), F.lit("b")).alias("name")),
            F.lit("camera"),
            F.struct(F.lit("video").alias("dtype"), F.array(F.lit(4), F.lit(6), F.lit(3)).alias("shape"), F.array(F.lit("h"), F.lit("w"), F.lit("c")).alias("names"), none.alias("name")),
        ).alias("features"),
    )
    joints = F.create_map(F.lit("joint_1"), F.lit("rad"), F.lit("joint_2"), F.lit("m"))
    parts = F.create_map(
        F.lit("arm"), F.struct(F.concat(F.lit("model "), "n_regionkey").alias("type"), joints.alias("dimension")),
        F.lit("head"), F.struct(F.lit("cam").alias("type"), F.lit(None).cast("map<string,string>").alias("dimension")),
    )
    device = F.struct(F.array(F.struct(F.lit("d").alias("device_id"), parts.alias("device_info"))).alias("device_list"))
    lens = F.struct(
        F.lit("PINHOLE").alias("model"), F.struct((F.lit(600.5) + n).alias("fx")).alias("parameters"), F.struct(F.lit("brown").alias("model")).alias("distortion")
    )
    camera = F.struct(F.array(F.struct(F.lit("d").alias("device_id"), F.create_map(F.lit("top"), lens).alias("camera_intrinsics"))).alias("device_list"))
    for name, doc in (("info", info), ("device", device), ("camera", camera)):
        t.nation.select(F.col("n_name").alias("dataset"), F.to_json(doc).alias("value")).write.partitionBy("dataset").text(f"{root}/{name}")

    def read(name: str, schema: str) -> DataFrame:
        return files.read_json_documents(t.spark, f"{root}/{name}", schema, "*.txt")

    dataset = F.regexp_extract("path", "dataset=([^/]+)/", 1).alias("n_name")
    none_d = F.lit(None).cast("double").alias("number")
    infos = read("info", files.INFO_SCHEMA)
    features = files.info_features(infos).join(infos.select("path", "fps"), "path")
    devices = files.device_joints(read("device", files.DEVICE_SCHEMA))
    cameras = files.camera_intrinsics(read("camera", files.CAMERA_SCHEMA))
    return (
        features.select(dataset, F.lit("feature").alias("kind"), F.col("feature").alias("name"), F.col("dtype").alias("detail"), F.array_join("names", ",").alias("elements"), F.col("fps").alias("number"))
        .unionByName(devices.select(dataset, F.lit("device").alias("kind"), F.col("part").alias("name"), F.col("part_type").alias("detail"), F.concat("joint", F.lit("="), "unit").alias("elements"), none_d))
        .unionByName(cameras.select(dataset, F.lit("camera").alias("kind"), F.col("camera").alias("name"), F.col("model").alias("detail"), F.col("distortion_model").alias("elements"), F.col("fx").alias("number")))
    )


@query(
    "yaml_registry_scan",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 10 NOT IN (3, 7) THEN s_name END AS dataset_name, CASE WHEN s_suppkey % 10 NOT IN (3, 7) THEN 'NATION_' || s_nationkey END AS device_model,
 CASE WHEN s_suppkey % 10 NOT IN (3, 7) THEN s_acctbal END AS height, CASE WHEN s_suppkey % 10 NOT IN (3, 7) THEN 'pick ' || s_suppkey || '|place' END AS tasks,
 CASE WHEN s_suppkey % 10 NOT IN (3, 7) THEN 'box ' || s_nationkey END AS object, CASE s_suppkey % 10 WHEN 3 THEN 'missing dataset_uuid' WHEN 7 THEN 'empty' END AS reject_reason FROM supplier""",
)
def _yaml(t: Tables) -> DataFrame:
    """A YAML file per supplier; some lack the id, some are empty, a model is a text or a list."""
    root = scratch_dir(t.spark, "yaml")
    uuid = F.when(F.col("s_suppkey") % 10 == 3, F.lit("")).otherwise(F.concat(F.lit("dataset_uuid: u-"), "s_suppkey", F.lit("\n")))
    model = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("device_model: NATION_"), "s_nationkey", F.lit("\n"))).otherwise(
        F.concat(F.lit("device_model:\n- NATION_"), "s_nationkey", F.lit("\n- other\n"))
    )
    text = F.concat(
        F.lit("# a comment\ndataset_name: '"), "s_name", F.lit("'\n"), uuid, model,
        F.lit("task_descriptions:\n- pick "), "s_suppkey", F.lit("\n- place\nobjects:\n- object_name: box "), "s_nationkey",
        F.lit("\n  level1: container\n  level2: null\noperation_platform_heigth: "), "s_acctbal",
    )
    body = F.when(F.col("s_suppkey") % 10 == 7, F.lit("# nothing here")).otherwise(text)
    # a supplier that comes twice has two files; their numbers do not depend on the order of rows
    texts = number_rows(t.supplier.select("s_suppkey", F.concat(F.coalesce(body, F.lit("")), F.lit("\n")).alias("value")), ["s_suppkey"], ["value"], "no")
    dealt = texts.repartition(walk.tasks(t.spark), "s_suppkey", "no")
    path = F.concat(F.lit(f"{root}/in/s_suppkey="), F.coalesce(F.col("s_suppkey").cast("string"), F.lit("none")), F.lit("/part-"), "no", F.lit(".txt"))
    walk.write_files(dealt, path, F.encode("value", "UTF-8")).write.parquet(f"{root}/listing")
    records = files.read_registry(t.spark, f"{root}/in", "*.txt")
    good = F.col("reject_reason").isNull()
    return records.select(
        F.regexp_extract("path", "s_suppkey=([0-9]+)/", 1).cast("long").alias("s_suppkey"),
        *[
            F.when(good, value).alias(name)
            for name, value in {
                "dataset_name": F.col("dataset_name"),
                "device_model": F.get("device_model", F.lit(0)),
                "height": F.col("operation_platform_height"),
                "tasks": F.array_join("task_descriptions", "|"),
                "object": F.get("objects", F.lit(0))["object_name"],
            }.items()
        ],
        "reject_reason",
    )


@query(
    "csv_tags_scan",
    """WITH c AS (SELECT p_partkey, p_partkey % 6 AS k FROM part WHERE p_partkey % 6 <> 2)
SELECT 'task_' || p_partkey || '_x' AS dataset_name, CASE WHEN k = 4 THEN 0 ELSE 3 END AS tags, CASE WHEN k <> 4 THEN p_name || ' "quoted"' END AS note
FROM c JOIN part USING (p_partkey)""",
)
def _csv(t: Tables) -> DataFrame:
    """Rows of three kinds: tags over several quoted lines, an empty address, no tags."""
    root = scratch_dir(t.spark, "csv") + "/out"
    kind = F.col("p_partkey") % 6
    address = F.concat(F.lit("/docker/data "), "p_brand", F.lit("/task_"), "p_partkey", F.lit("_x y"))
    tags = F.concat(F.lit("size: "), "p_size", F.lit("\nbrand："), "p_brand", F.lit("\nnote: "), F.regexp_replace("p_name", " ", "_"), F.lit(' "quoted"\nno colon'))
    rows = t.part.select(
        F.lit("x").alias("id"), F.when(kind == 2, F.lit("  ")).otherwise(address).alias("address_nas"), F.when(kind != 4, tags).alias("tags")
    )
    rows.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(root)
    parsed = files.read_tag_csv(t.spark, root).select(
        nm.clean_dataset_name(F.col("address_nas")).alias("dataset_name"), tg.tag_map(F.col("tags")).alias("m")
    )
    note = F.regexp_replace(F.array_join(F.col("m")["note"], " "), "_", " ")
    return parsed.select("dataset_name", F.size("m").alias("tags"), note.alias("note"))


def _bson_element(kind: int, name: str, body: bytes) -> bytes:
    return bytes([kind]) + name.encode() + b"\x00" + body


def _bson_doc(elements: list[bytes]) -> bytes:
    body = b"".join(elements)
    return struct.pack("<I", len(body) + 5) + body + b"\x00"


def encode_bson(value: dict) -> bytes:
    """Stand-in encoder for the types the decoder knows."""

    def element(name: str, v) -> bytes:
        if isinstance(v, bool):
            return _bson_element(binary.BOOL, name, bytes([v]))
        if isinstance(v, int):
            small = -(2**31) <= v < 2**31
            return _bson_element(binary.INT32 if small else binary.INT64, name, struct.pack("<i" if small else "<q", v))
        if isinstance(v, float):
            return _bson_element(binary.DOUBLE, name, struct.pack("<d", v))
        if isinstance(v, str):
            raw = v.encode() + b"\x00"
            return _bson_element(binary.STRING, name, struct.pack("<I", len(raw)) + raw)
        if isinstance(v, list):
            return _bson_element(binary.ARRAY, name, _bson_doc([element(str(i), x) for i, x in enumerate(v)]))
        return _bson_element(binary.DOCUMENT, name, encode_bson(v))

    return _bson_doc([element(k, v) for k, v in value.items()])


#: bytes of one batch of encoded documents, and frames that are Python objects at a time
ENCODED_BYTES, ENCODED_FRAMES = 4 << 20, 20_000


def _frame_encoder(frame: Callable[..., dict], values: int) -> Callable[..., list[bytes]]:
    """Elements of an array of frames that differ by their numbers only: ``frame`` is encoded once, the numbers are put into it."""
    marks = [1e300 + k * 1e290 for k in range(values)]
    raw, form, given = encode_bson(frame(*marks)), "<", []
    for mark in marks:
        head, raw = raw.split(struct.pack("<d", mark))
        form, given = f"{form}{len(head)}sd", [*given, head]
    pack = struct.Struct(f"{form}{len(raw)}s").pack
    if values == 1:
        return lambda a: [b"\x03%d\x00" % i + pack(given[0], x, raw) for i, x in enumerate(a)]
    return lambda a, b: [b"\x03%d\x00" % i + pack(given[0], x, given[1], y, raw) for i, (x, y) in enumerate(zip(a, b, strict=True))]


def _frames_document(before: bytes, frames_: list[bytes], name: str, topic: str | None = None) -> bytes:
    """A document of some encoded fields and an array of encoded frames, below a topic if one is given."""
    body = _bson_element(binary.ARRAY, topic or name, _bson_doc(frames_))
    if topic is not None:
        body = _bson_element(binary.DOCUMENT, name, _bson_doc([body]))
    return _bson_doc([before, body])


def _contents(held: list[tuple], names: tuple[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held]), pa.array([h[1] for h in held], pa.binary())], names=list(names))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """(keys, values of the other columns) of runs of equal leading columns in sorted rows; a run may go on in the next batch."""
    rest: list[list] = []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        if rest:
            columns = [a + b for a, b in zip(rest, columns, strict=True)]
        marks = list(zip(*columns[:keys], strict=True))
        starts = [i for i, mark in enumerate(marks) if i == 0 or mark != marks[i - 1]]
        for start, stop in itertools.pairwise(starts):
            yield marks[start], [c[start:stop] for c in columns[keys:]]
        rest = [c[starts[-1] :] for c in columns] if starts else []
    if rest:
        yield tuple(c[0] for c in rest[:keys]), rest[keys:]


def _encoded(batches: Iterator[pa.RecordBatch], names: tuple[str, str], encode: Callable[[dict, dict[str, list]], tuple[object, bytes]]) -> Iterator[pa.RecordBatch]:
    """Documents of rows (keys..., rows ARRAY<STRUCT>); a task holds few frames as Python objects, or those of one document."""

    for given in batches:
        rows = given.column("rows")
        offsets, flat = rows.offsets.to_pylist(), rows.values
        fields = dict(zip(flat.type.names, flat.flatten(), strict=True))
        held, size, first, end, lists = [], 0, 0, -1, {}
        for no, key in enumerate(given.drop_columns(["rows"]).to_pylist()):
            start, stop = offsets[no], offsets[no + 1]
            if stop > end:
                until = bisect.bisect_right(offsets, start + ENCODED_FRAMES) - 1
                first, end = start, max(stop, offsets[until])
                lists = {name: values.slice(first, end - first).to_pylist() for name, values in fields.items()}
            held.append(encode(key, {name: values[start - first : stop - first] for name, values in lists.items()}))
            size += len(held[-1][1])
            if size >= ENCODED_BYTES:
                yield _contents(held, names)
                held, size = [], 0
        if held:
            yield _contents(held, names)


def _encode_orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arm = _frame_encoder(lambda q, p: {"t": 2**40, "data": {"pos": [q, p]}}, 2)
    hand = _frame_encoder(lambda d: {"observation": {"left_hand": [d]}, "ok": True, "note": "hé"}, 1)

    held, size = [], 0
    for (key, part), (q, p, d) in _runs(batches, 2):
        if key % 2 == 0:
            raw = _frames_document(b"", arm(q, p), "data", "/arm/left")
        else:
            raw = _frames_document(b"", hand(d), "frames")
        held.append((f"/ep/{key}_{part}.bson", raw[: len(raw) // 2] if key % 11 == 0 else raw))
        size += len(raw)
        if size >= ENCODED_BYTES:
            yield _contents(held, ("path", "content"))
            held, size = [], 0
    if held:
        yield _contents(held, ("path", "content"))


@query(
    "bson_episode_ingest",
    """WITH f AS (SELECT l_orderkey AS e, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS frame_index, l_quantity, l_extendedprice, l_discount FROM lineitem)
SELECT e AS episode, CASE WHEN e % 2 = 0 THEN '/arm/left.pos' ELSE 'observation.left_hand' END AS data_path, frame_index, CASE WHEN e % 2 = 0 THEN l_quantity ELSE l_discount END AS v0, CASE WHEN e % 2 = 0 THEN l_extendedprice END AS v1 FROM f WHERE e % 11 > 0
UNION ALL SELECT DISTINCT e, 'unreadable', frame_index // 500 * 500, NULL, NULL FROM f WHERE e % 11 = 0""",
)
def _bson(t: Tables) -> DataFrame:
    """500 frames of an order as a BSON document, of the main or of the hand kind; some are cut."""
    part = F.expr("frame_index div 500").alias("part")
    dealt = frames(t).select("episode_index", part, "frame_index", "l_quantity", "l_extendedprice", "l_discount").repartition("episode_index", "part")
    # the frames of a document follow each other: no lists are built before they are encoded
    sorted_ = dealt.sortWithinPartitions("episode_index", "part", "frame_index").drop("frame_index")
    rows = binary.ingest_bson(sorted_.mapInArrow(_encode_orders, "path STRING, content BINARY"))
    first = F.regexp_extract("path", "_([0-9]+)", 1).cast("long") * 500
    return rows.select(
        F.regexp_extract("path", "/ep/([0-9]+)_", 1).cast("long").alias("episode"),
        F.coalesce("data_path", F.lit("unreadable")).alias("data_path"),
        (first + F.coalesce("frame_index", F.lit(0))).alias("frame_index"),
        F.get("values", F.lit(0)).alias("v0"),
        F.get("values", F.lit(1)).alias("v1"),
    )


def _encode_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arm = _frame_encoder(lambda q, p: {"t": 2**40, "data": {"pos": [q, p], "name": "é"}}, 2)
    hand = _frame_encoder(lambda q: {"observation": {"left_hand": [q]}, "ok": True}, 1)

    def encode(row: dict, rows: dict[str, list]) -> tuple[int, bytes]:
        key, q = row["no"], rows["q"]
        if key % 2 == 0:
            raw = _frames_document(encode_bson({"id": key})[4:-1], arm(q, rows["p"]), "data", "/arm/left")
        else:
            raw = _frames_document(encode_bson({"note": "x"})[4:-1], hand(q), "frames")
        return key, raw[: len(raw) // 2] if key % 7 == 5 else raw

    return _encoded(batches, ("no", "content"), encode)


@query(
    "bson_range_ingest",
    """WITH f AS (SELECT l_orderkey // 2000 AS no, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY no ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS BIGINT) AS frame_index FROM f)
SELECT no, CASE WHEN no % 2 = 0 THEN '/arm/left.pos' ELSE 'observation.left_hand' END AS data_path, frame_index, l_quantity AS v0, CASE WHEN no % 2 = 0 THEN l_extendedprice END AS v1 FROM n WHERE no % 7 <> 5
UNION ALL SELECT DISTINCT no, 'no data and no frames', CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM f WHERE no % 7 = 5""",
)
def _bson_ranges(t: Tables) -> DataFrame:
    """Files of thousands of frames each, cut at frame boundaries and decoded by several tasks; some files are cut short."""
    root = scratch_dir(t.spark, "bson")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    groups = t.lineitem.groupBy(F.expr("l_orderkey div 2000").alias("no")).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("rows"))
    # only what the files hold goes to Python
    values = F.transform("rows", lambda r: F.struct(r["l_quantity"].alias("q"), r["l_extendedprice"].alias("p")))
    contents = groups.select("no", values.alias("rows")).mapInArrow(_encode_groups, "no LONG, content BINARY")
    walk.write_files(contents, F.concat(F.lit(f"{root}/in/ep_"), "no", F.lit(".bson")), F.col("content")).write.parquet(f"{root}/listing")
    ranges = bsonranges.bson_ranges(walk.walk(t.spark, [f"{root}/in"]))
    rows = bsonranges.ingest_ranges(ranges)
    return rows.select(
        F.regexp_extract("path", "ep_([0-9]+)", 1).cast("long").alias("no"), F.coalesce("data_path", "error").alias("data_path"), "frame_index", F.get("values", F.lit(0)).alias("v0"), F.get("values", F.lit(1)).alias("v1")
    )


@query(
    "media_integrity",
    """WITH v AS (SELECT doc_id, doc_id % 8 AS k, CASE WHEN doc_id % 8 < 5 THEN '.MP4' WHEN doc_id % 8 = 5 THEN '.webm' WHEN doc_id % 8 = 6 THEN '.avi' ELSE '.txt' END AS ext FROM documents)
SELECT '/videos/' || doc_id || ext AS path, CASE k WHEN 1 THEN 'no ftyp box at the start' WHEN 2 THEN 'no moov box' WHEN 3 THEN 'box at 12 is cut' WHEN 4 THEN 'empty file' WHEN 6 THEN 'no avi signature' END AS errors
FROM v WHERE k IN (1, 2, 3, 4, 6)""",
)
def _media(t: Tables) -> DataFrame:
    """Documents as video files: good ones, wrong or missing boxes, a cut box, an empty file."""
    kind = F.col("doc_id") % 8
    ext = F.when(kind < 5, ".MP4").when(kind == 5, ".webm").when(kind == 6, ".avi").otherwise(".txt")
    body = F.encode("text", "UTF-8")
    size = F.length(body) + 8

    def box(name: str, length, data):
        return F.concat(F.unhex(F.lpad(F.hex(length), 8, "0")), F.encode(F.lit(name), "UTF-8"), data)

    head = box("ftyp", F.lit(12), F.encode(F.lit("isom"), "UTF-8"))
    content = (
        F.when(kind == 0, F.concat(head, box("moov", size, body)))
        .when(kind == 1, F.concat(body, head))
        .when(kind == 2, F.concat(head, box("mdat", size, body)))
        .when(kind == 3, F.concat(head, box("moov", size + 5, body)))
        .when(kind == 4, F.encode(F.lit(""), "UTF-8"))
        .when(kind == 5, F.concat(F.unhex(F.lit("1A45DFA3")), body))
        .otherwise(body)
    )
    docs = t.documents.select(F.concat(F.lit("/videos/"), "doc_id", ext).alias("path"), content.alias("content"))
    return binary.bad_media(docs).withColumn("errors", F.array_join("errors", "; "))


@query(
    "write_trajectory",
    f"""WITH {FRAMES_TASK_SQL} SELECT episode_index // 1000 AS episode_chunk, episode_index, frame_index, task_index, l_quantity AS s0, l_tax AS a1 FROM frames_t""",
)
def _write(t: Tables) -> DataFrame:
    _, back = _written(t)
    return back.select(
        F.col("episode_chunk").cast("long").alias("episode_chunk"), "episode_index", "frame_index", "task_index", F.col("state")[0].alias("s0"), F.col("action")[1].alias("a1")
    )


def _written(t: Tables) -> tuple[str, DataFrame]:
    root = scratch_dir(t.spark, "trajectory") + "/out"
    rows = frames_with_task(t).select("episode_index", "frame_index", "task_index", "state", "action")
    tasks = t.orders.select((F.col("o_custkey") % 3).alias("task_index")).distinct()
    features = t.spark.createDataFrame(
        [("observation.state", "float32", [4], ["a", "b", "c", "d"]), ("action", "float32", [2], ["a", "d"]), ("observation.images.cam_high", "video", [480, 640, 3], None)],
        "feature STRING, dtype STRING, shape ARRAY<INT>, names ARRAY<STRING>",
    )
    tasks = tasks.withColumn("task", F.concat(F.lit("task "), "task_index"))
    return root, writers.write_trajectory(rows, root, tasks, fps=25, robot_type="arm", features=features)


@query(
    "write_trajectory_meta",
    f"""WITH {FRAMES_TASK_SQL} SELECT 'episode' AS kind, episode_index AS no, count(*) AS length, 'task ' || task_index AS task FROM frames_t GROUP BY episode_index, task_index
UNION ALL SELECT DISTINCT 'task', o_custkey % 3, NULL, 'task ' || (o_custkey % 3) FROM orders
UNION ALL SELECT 'layout', count(DISTINCT episode_index), NULL, 'v2.1 arm 25.0 train 0:' || count(DISTINCT episode_index) || ' data/episode_chunk={{episode_chunk}} videos/chunk-{{episode_chunk:03d}}/{{video_key}}/episode_{{episode_index:06d}}.mp4 action,observation.images.cam_high,observation.state 480' FROM frames_t
UNION ALL SELECT 'info', count(DISTINCT episode_index), count(*), 'chunks ' || count(DISTINCT episode_index // 1000) || ' tasks ' || (SELECT count(DISTINCT o_custkey % 3) FROM orders) FROM frames_t""",
)
def _write_meta(t: Tables) -> DataFrame:
    root, _ = _written(t)
    episodes = files.read_jsonl(t.spark, f"{root}/meta/episodes", files.EPISODES_SCHEMA, "*.json")
    tasks = files.read_jsonl(t.spark, f"{root}/meta/tasks", files.TASKS_SCHEMA, "*.json")
    info = files.read_jsonl(t.spark, f"{root}/meta/info", files.INFO_SCHEMA, "*.json")
    names = F.array_join(F.array_sort(F.map_keys("features")), ",")
    layout = F.concat_ws(
        " ", "codebase_version", "robot_type", F.col("fps").cast("string"), F.lit("train"), F.col("splits")["train"], "data_path", "video_path", names,
        F.col("features")["observation.images.cam_high"]["shape"][0].cast("string"),
    )
    return (
        episodes.select(F.lit("episode").alias("kind"), F.col("episode_index").alias("no"), "length", F.array_join("tasks", ",").alias("task"))
        .unionByName(tasks.select(F.lit("task").alias("kind"), F.col("task_index").alias("no"), F.lit(None).cast("long").alias("length"), "task"))
        .unionByName(info.select(F.lit("layout").alias("kind"), F.col("total_videos").alias("no"), F.lit(None).cast("long").alias("length"), layout.alias("task")))
        .unionByName(
            info.select(
                F.lit("info").alias("kind"), F.col("total_episodes").alias("no"), F.col("total_frames").alias("length"),
                F.concat(F.lit("chunks "), "total_chunks", F.lit(" tasks "), "total_tasks").alias("task"),
            )
        )
    )


@query(
    "write_topic_csv",
    f"""WITH {messages_sql()} SELECT trim(replace(topic, '/', '_'), '_') AS topic_folder, episode_id, topic, seq, ts_ns, round(value, 6) AS value FROM messages""",
)
def _write_csv(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "topic-csv") + "/out"
    df = messages(t, payload=("value",))[0].select("episode_id", "topic", "seq", "ts_ns", "value")
    writers.write_topic_csv(df, root)
    back = t.spark.read.schema("episode_id LONG, topic STRING, seq LONG, ts_ns LONG, value DOUBLE, topic_folder STRING").option("header", "true").csv(root)
    return back.withColumn("value", r6(F.col("value")))


@query(
    "write_trajectory_parts",
    f"""WITH {FRAMES_TASK_SQL}, e AS (SELECT episode_index, task_index, count(*) AS n FROM frames_t GROUP BY 1, 2)
SELECT 'chunk' AS kind, episode_index // 1000 AS no, count(*) AS episodes, CAST(sum(n) AS BIGINT) AS frames, 'v1' AS note FROM e GROUP BY 2
UNION ALL SELECT 'before', NULL, count(*), CAST(sum(n) AS BIGINT), 'v0' FROM e WHERE episode_index % 3 < 2
UNION ALL SELECT 'total', count(DISTINCT episode_index // 1000), count(*), CAST(sum(n) AS BIGINT), 'tasks ' || count(DISTINCT task_index) FROM e
UNION ALL SELECT 'read', NULL, count(DISTINCT episode_index), CAST(sum(n) AS BIGINT), string_agg(DISTINCT 'task ' || task_index, ',' ORDER BY 'task ' || task_index) FROM e""",
)
def _write_parts(t: Tables) -> DataFrame:
    """Two thirds of the orders, then the last third; what is read is one trajectory, and the first version is still there."""
    store = writers.TrajectoryStore(t.spark, scratch_dir(t.spark, "trajectory-parts") + "/out")
    rows = frames_with_task(t).select("episode_index", "frame_index", "task_index", "state", "action")
    for own in (F.col("episode_index") % 3 < 2, F.col("episode_index") % 3 == 2):
        part = rows.where(own)
        tasks = part.select("task_index").distinct().withColumn("task", F.concat(F.lit("task "), "task_index"))
        store.add(part, tasks)
    chunks = store.summary("chunks").groupBy(F.col("episode_chunk").alias("no")).agg(F.sum("episodes").alias("episodes"), F.sum("frames").alias("frames"))
    none = F.lit(None).cast("bigint")
    now, before = store.totals(), store.totals(0)
    read = store.frames().agg(F.count_distinct("episode_index").alias("episodes"), F.count(F.lit(1)).alias("frames"))
    texts = store.summary("episodes").select(F.explode("tasks").alias("task")).distinct().agg(F.array_join(F.array_sort(F.collect_list("task")), ",").alias("note"))
    return (
        chunks.select(F.lit("chunk").alias("kind"), "no", "episodes", "frames", F.lit("v1").alias("note"))
        .unionByName(before.select(F.lit("before").alias("kind"), none.alias("no"), F.col("total_episodes").alias("episodes"), F.col("total_frames").alias("frames"), F.lit("v0").alias("note")))
        .unionByName(now.select(F.lit("total").alias("kind"), F.col("total_chunks").alias("no"), F.col("total_episodes").alias("episodes"), F.col("total_frames").alias("frames"), F.concat(F.lit("tasks "), "total_tasks").alias("note")))
        .unionByName(read.select(F.lit("read").alias("kind"), none.alias("no"), "episodes", "frames", texts.scalar().alias("note")))
    )


_WALK_DIR = "'source=' || source || '/task=' || (doc_id % 3) || '/episode=' || (doc_id % 12)"


@query(
    "scan_tree_walk",
    f"""WITH d AS (SELECT source, doc_id, CAST(substring(source, 4) AS BIGINT) % 2 = 0 AS marked FROM documents)
SELECT DISTINCT 'source=' || source AS directory, 1 AS level, CAST(1 AS BIGINT) AS files FROM d WHERE marked
UNION ALL SELECT DISTINCT {_WALK_DIR}, 3, CAST(1 AS BIGINT) FROM d WHERE NOT marked""",
)
def _walked(t: Tables) -> DataFrame:
    """A tree of real directories, walked in tasks; even sources have a file above, below which the walk does not go."""
    root = scratch_dir(t.spark, "tree") + "/root"
    docs = t.documents.select("source", F.expr("doc_id % 3").alias("task"), F.expr("doc_id % 12").alias("episode"), F.col("doc_id").cast("string").alias("value"))
    keys = ["source", "task", "episode"]
    lists = docs.groupBy(*keys).agg(F.max("value").alias("value"))
    lists.write.partitionBy(*keys).text(root)
    marked = docs.where("cast(substring(source, 4) as bigint) % 2 = 0").groupBy("source").agg(F.max("value").alias("value"))
    marked.write.mode("append").partitionBy("source").text(root)
    found = walk.walk(t.spark, [root], marker="part-")
    inside = found.where(F.startswith(walk.file_name(F.col("path")), F.lit("part-")))
    directory = F.regexp_replace(F.substring_index("path", root + "/", -1), "/[^/]*$", "")
    return inside.groupBy(directory.alias("directory"), "level").agg(F.count(F.lit(1)).alias("files"))


@query(
    "media_box_scan",
    """WITH f AS (SELECT doc_id // 64 AS no, (doc_id // 64) % 6 AS k, count(*) AS n, count(text) AS t FROM documents GROUP BY 1, 2)
SELECT 'video_' || no || CASE WHEN k = 5 THEN '.webm' ELSE '.mp4' END AS file, CASE k WHEN 0 THEN n + 2 WHEN 1 THEN n + 1 WHEN 2 THEN n + 1 WHEN 3 THEN n + 2 WHEN 4 THEN n + 2 ELSE 0 END AS boxes,
  CASE k WHEN 1 THEN 'no ftyp box at the start' WHEN 2 THEN 'no moov box' WHEN 3 THEN 'cut' WHEN 4 THEN '5 bytes after the last box' WHEN 5 THEN 'no webm signature' ELSE '' END AS errors FROM f""",
)
def _boxes(t: Tables) -> DataFrame:
    """Files of a box for each of 64 documents, some with faults, checked by reading their headers alone."""
    root = scratch_dir(t.spark, "videos")
    no, kind = F.expr("doc_id div 64"), F.expr("(doc_id div 64) % 6")
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")

    def box(name: str, size, data):
        return F.concat(F.unhex(F.lpad(F.hex(size), 8, "0")), F.encode(F.lit(name), "UTF-8"), data)

    nothing = F.encode(F.lit(""), "UTF-8")
    data = F.sort_array(F.collect_list(F.struct("doc_id", box("mdat", F.length(body) + 8, body).alias("box"))))
    files_ = t.documents.groupBy(no.alias("no"), kind.alias("k")).agg(F.transform(data, lambda d: d["box"]).alias("boxes"))
    joined = F.aggregate("boxes", nothing, lambda a, b: F.concat(a, b))
    # the last box of the third kind says that it is longer than it is
    moov = F.when(F.col("k") == 2, nothing).otherwise(box("moov", F.when(F.col("k") == 3, 99).otherwise(8), nothing))
    head = F.when(F.col("k").isin(1, 5), nothing).otherwise(box("ftyp", F.lit(12), F.encode(F.lit("isom"), "UTF-8")))
    tail = F.when(F.col("k") == 4, F.encode(F.lit("tail!"), "UTF-8")).otherwise(nothing)
    name = F.concat(F.lit("video_"), "no", F.when(F.col("k") == 5, ".webm").otherwise(".mp4"))
    written = walk.write_files(files_, F.concat(F.lit(root + "/"), name), F.concat(head, joined, moov, tail))
    # written before it is walked: the files are what the check reads, not these rows
    written.write.parquet(root + "/.listing")
    found = boxes.box_findings(boxes.read_boxes(walk.walk(t.spark, [root])))
    errors = F.regexp_replace(F.array_join("errors", "; "), "box at [0-9]+ is cut", "cut")
    return found.select(walk.file_name(F.col("path")).alias("file"), "boxes", errors.alias("errors"))


@query("stream_status_fold", STATUS_SQL)
def _stream_status(t: Tables) -> DataFrame:
    """Three runs of the stream over files that arrive one after the other."""
    root = scratch_dir(t.spark, "status-stream")
    table = jobs.StatusTable(t.spark, f"{root}/table")
    table.initialise(old_status(t))
    events = status_events(t)
    top = events.agg(F.max("updated_at")).first()[0] + 1
    cuts = [0, top // 3, 2 * top // 3, top]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        events.where((F.col("updated_at") >= lo) & (F.col("updated_at") < hi)).write.mode("append").json(f"{root}/in")
        stream = t.spark.readStream.schema(jobs.STATUS_SCHEMA).json(f"{root}/in")
        jobs.fold_status(stream, table, f"{root}/checkpoint").awaitTermination()
    return table.read_newest()


TIMEOUT, DELAY = "1 DAY", "1 HOUR"
# pings whose interval ends before the last event on either side, less the delay; later ones cannot be judged yet
_CUT = "(SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'click')) - INTERVAL 1 DAY - INTERVAL 1 HOUR - INTERVAL 1 SECOND FROM events)"
_GAP_SQL = f"""WITH p AS (SELECT user_id, ts FROM events WHERE event_type = 'view'), q AS (SELECT user_id, ts FROM events WHERE event_type = 'click')
SELECT user_id AS client, epoch_us(ts) AS ping_us FROM p WHERE ts <= {_CUT} AND NOT EXISTS (SELECT 1 FROM q WHERE q.user_id = p.user_id AND q.ts >= p.ts AND q.ts <= p.ts + INTERVAL 1 DAY)"""


def _heartbeats(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    # an instant that does not depend on the session time zone
    ts = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    return (
        events.where("event_type = 'view'").select(F.col("user_id").alias("client"), ts.alias("ping_ts")),
        events.where("event_type = 'click'").select(F.col("user_id").alias("client"), ts.alias("pong_ts")),
    )


def _judged(t: Tables, gaps: DataFrame) -> DataFrame:
    pings, pongs = _heartbeats(t.events)
    ends = pings.agg(F.max("ping_ts").alias("a")).scalar(), pongs.agg(F.max("pong_ts").alias("b")).scalar()
    cut = F.least(*ends) - F.expr(f"INTERVAL {TIMEOUT}") - F.expr(f"INTERVAL {DELAY}") - F.expr("INTERVAL 1 SECOND")
    return gaps.where(F.col("ping_ts") <= cut).select("client", F.unix_micros("ping_ts").alias("ping_us"))


@query("heartbeat_gap_batch", _GAP_SQL)
def _gap_batch(t: Tables) -> DataFrame:
    return _judged(t, jobs.heartbeat_gaps_batch(*_heartbeats(t.events), TIMEOUT))


@query("stream_heartbeat_gap", _GAP_SQL)
def _gap_stream(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "heartbeat-stream")
    schema = t.events.schema
    if t.events.isEmpty():
        raise ValueError("no events to stream")

    def stream() -> DataFrame:
        # the table's own path as a pattern: it may be a file or a folder of files
        return t.spark.readStream.schema(schema).parquet(t.path("event[s]"))

    gaps = jobs.heartbeat_gaps(_heartbeats(stream())[0], _heartbeats(stream())[1], TIMEOUT, DELAY, salts=2)
    with local_partitions(t.spark):
        running = (
            gaps.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    return _judged(t, t.spark.read.schema("client LONG, ping_ts TIMESTAMP").parquet(f"{root}/out"))


_TOPIC_OF_KIND = ["/arm/joint", "/chassis/imu", "/cmd/twist", "/tool/pose"]


@query(
    "write_topic_csv_flat",
    "SELECT "
    + ", ".join(MSG_KEYS)
    + ", CASE l_linenumber % 4 "
    + " ".join(f"WHEN {i} THEN '{topic.strip('/').replace('/', '_')}'" for i, topic in enumerate(_TOPIC_OF_KIND))
    + " END AS topic_folder, "
    + ", ".join(f"CASE WHEN l_linenumber % 4 = {kind} THEN {value} END AS {name}" for kind, value, name in FLAT_COLUMNS)
    + " FROM lineitem",
)
def _write_flat_csv(t: Tables) -> DataFrame:
    """Messages of four kinds; the joints are found from the data; every kind has its own columns."""
    root = scratch_dir(t.spark, "flat-csv") + "/out"
    df = typed_messages(t).withColumn("topic", F.array(*[F.lit(x) for x in _TOPIC_OF_KIND])[F.col("l_linenumber") % 4])
    payload = F.col("payload")
    kinds = {
        "joint": fl.joint_columns(payload, fl.joint_names(df)),
        "imu": fl.imu_columns(payload),
        "twist": fl.twist_columns(payload),
        "pose": fl.pose_columns(payload),
    }
    writers.write_flat_topic_csv(df, root, kinds, [*MSG_KEYS, "topic"], ts="l_linenumber")
    keys = "l_orderkey LONG, l_linenumber INT, l_partkey LONG, l_suppkey LONG, l_extendedprice DOUBLE, topic STRING"
    parts = []
    for name, columns in kinds.items():
        schema = f"{keys}, " + ", ".join(f"{c} DOUBLE" for c in columns) + ", topic_folder STRING"
        part = t.spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(f"{root}/{name}").drop("topic")
        parts.append(part.withColumnsRenamed({c: f"pose_{c}" for c in columns if name == "pose" and c.startswith("orient_")}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
