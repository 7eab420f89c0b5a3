"""What a task holds or does must not grow with the table: plans, batches and listings of the larger jobs."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinetable.operators import ordered
from kinetable.operators import profile as pf
from kinetable.operators.frames import nearest_image
from kinetable.plans import sources
from kinetable.sources import binary, files, writers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_intersection_combines_keys_before_the_shuffle(spark):
    left = spark.range(400).select(F.expr("""concat('{"a', id % 7, '":1, "n', id % 3, '":{"c":2}}')""").alias("content"))
    right = spark.range(300).select(F.expr("""concat('{"a', id % 5, '":1, "m', id % 4, '":[3]}')""").alias("content"))
    odd = spark.createDataFrame([(None,), ("{}",), ("no json",), ('{"only": 1, "a0": null}',)], "content STRING")
    found = pf.key_intersection(left.unionByName(odd), right)
    assert sorted(r[0] for r in found.collect()) == ["a0", "a1", "a2", "a3", "a4"]
    assert "Join" not in plan_of(found) and "partial_bool_or" in plan_of(found).replace("partial_max", "partial_bool_or")


def test_encoded_documents_leave_in_small_batches(monkeypatch):
    monkeypatch.setattr(sources, "ENCODED_BYTES", 1000)
    monkeypatch.setattr(sources, "ENCODED_FRAMES", 5)
    rows = [{"no": n, "rows": [{"q": n + i / 4, "p": float(i)} for i in range(n)]} for n in range(20)]
    batches = list(sources._encode_groups(iter([pa.RecordBatch.from_pylist(rows).slice(3)])))
    assert len(batches) > 5 and all(b.nbytes < 4000 for b in batches)
    found = {n: content for b in batches for n, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    assert sorted(found) == list(range(3, 20))
    for n, content in found.items():
        if n % 7 == 5:
            assert binary.decode_bson(content) is None
        elif n % 2 == 0:
            assert binary.decode_bson(content) == {"id": n, "data": {"/arm/left": [{"t": 2**40, "data": {"pos": [n + i / 4, float(i)], "name": "é"}} for i in range(n)]}}
        else:
            assert binary.decode_bson(content) == {"note": "x", "frames": [{"observation": {"left_hand": [n + i / 4]}, "ok": True} for i in range(n)]}


def test_registry_files_are_listed_and_read_in_tasks(spark, tmp_path):
    body = "dataset_name: n\ndataset_uuid: u\n"
    for name in ("a/x 1.yml", "a/deep=1/y.yaml", "_hidden/z.yml", ".z.yml", "b/z.txt", "b/_z.yml", "b/é%.yml"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(body)
    (tmp_path / "in/b/empty.yml").write_text("")
    (tmp_path / "away/c").mkdir(parents=True)
    (tmp_path / "away/c/linked.yml").write_text(body)
    (tmp_path / "in/c").symlink_to(tmp_path / "away/c")
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.y{ml,aml}")
    for paths in (str(tmp_path / "in"), [str(tmp_path / "in/*"), str(tmp_path / "in/a/x 1.yml")], f"file://{tmp_path}/in"):
        found = files.read_texts(spark, paths, "*.y{ml,aml}")
        plain = files._with_path(reader.text(paths, wholetext=True)).select("path", "value")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
        assert files.read_registry(spark, paths, "*.y{ml,aml}").where("reject_reason IS NULL").count() == plain.count() > 3
        # no file scan over the files themselves: their number does not reach the driver
        assert not any("in/" in f for f in found.inputFiles())
    with pytest.raises(FileNotFoundError):
        files.read_registry(spark, str(tmp_path / "none"))


def test_large_tables_have_partitions_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 100)
    for hot_rows in (None, 50):
        frames = spark.range(3000).selectExpr("if(id < 900, 0, id % 40) AS episode_index", "id AS frame_index", "id * 2 AS v")
        split = ordered.plan_split(frames, ["episode_index"], ["frame_index"], hot_rows)
        assert split.rows == 3000 and split.hot == (hot_rows is not None)
        assert "REPARTITION_BY_NUM" in plan_of(ordered.number_rows(frames, ["episode_index"], ["frame_index"], "no", split=split))
        found = nearest_image(frames.drop("v"), frames.where("frame_index % 3 = 0"), ["v"], split)
        assert "REPARTITION_BY_NUM" in plan_of(found)
        rows = frames.collect()
        images = {}
        for r in rows:
            if r["frame_index"] % 3 == 0:
                images.setdefault(r["episode_index"], []).append(r["frame_index"])
        want = {(r["episode_index"], r["frame_index"], min(images[r["episode_index"]], key=lambda i: (abs(i - r["frame_index"]), i))) for r in rows}
        assert {(r["episode_index"], r["frame_index"], r["image_frame_index"]) for r in found.collect()} == want
    assert ordered.plan_split(frames.limit(0), ["episode_index"], ["frame_index"]).rows == 0


def test_adding_reads_the_table_of_tasks_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frames = spark.range(2400).selectExpr("id div 2 AS episode_index", "id % 2 AS frame_index", "id % 3 AS task_index")
    tasks = spark.range(3, numPartitions=1).selectExpr("id AS task_index", "concat('t', id) AS task").mapInArrow(counted, "task_index LONG, task STRING")
    store = writers.TrajectoryStore(spark, str(tmp_path / "out"))
    store.add(frames, tasks)
    assert seen.value == 3
    assert tuple(store.totals().first()) == (1200, 2400, 2, 3)


def test_a_chunk_is_one_file(spark, tmp_path):
    frames = spark.range(200_000).selectExpr("id div 20 AS episode_index", "id % 20 AS frame_index", "id % 3 AS task_index", "array(rand(1), rand(2), rand(3)) AS state")
    tasks = spark.range(3).selectExpr("id AS task_index", "concat('t', id) AS task")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        written = writers.write_trajectory(frames, str(tmp_path / "out"), tasks)
    finally:
        spark.conf.set(name, before)
    assert written.count() == 200_000 and len(written.inputFiles()) == 10
