"""Queries of the listing operators; documents stand in for files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.functions import names as nm
from kinetable.operators import paths as pt
from kinetable.plans.registry import Tables, query

IMAGE_PATH = (
    "concat('/root/', source, '/task_', doc_id % 3, '/episode_', doc_id % 12, '/camera_', doc_id % 3, '/', doc_id, '_color_', doc_id % 4, '.jpg')"
)


def image_listing(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.col("source").alias("dataset_id"),
        F.expr("doc_id % 12").alias("episode"),
        F.expr(IMAGE_PATH).alias("path"),
    )


IMAGES_SQL = f"images AS (SELECT doc_id, source AS dataset_id, doc_id % 12 AS episode, {IMAGE_PATH} AS path FROM documents)"

# a marker for even sources, a second one in the same directory for some, and deeper ones:
# those below a marked source must go, those of odd sources stay
_MARKERS = """
SELECT concat('/root/', source, '/local_dataset_info.yml') AS path FROM src WHERE n % 2 = 0
UNION ALL SELECT concat('/root/', source, '/local_dataset_info.yml.yml') FROM src WHERE n % 4 = 0
UNION ALL SELECT concat('/root/', source, '/task_', n % 3, '/local_dataset_info .yml') FROM src WHERE n % 3 = 0
UNION ALL SELECT concat('/root/', source, '/other/deep/local_dataset.yml') FROM src WHERE n % 5 = 0
UNION ALL SELECT path FROM images"""
_SRC = "src AS (SELECT DISTINCT source, CAST(substring(source, 4) AS BIGINT) AS n FROM documents)"
_LISTING = f"{IMAGES_SQL}, {_SRC}, listing AS ({_MARKERS})"


def listing(t: Tables) -> DataFrame:
    """Images and markers in one listing."""
    docs = t.documents
    src = docs.select("source").distinct().withColumn("n", F.expr("cast(substring(source, 4) as bigint)"))

    def marker(tail: str, cond: str) -> DataFrame:
        return src.where(cond).select(F.expr(f"concat('/root/', source, {tail})").alias("path"))

    return (
        image_listing(t)
        .select("path")
        .unionByName(marker("'/local_dataset_info.yml'", "n % 2 = 0"))
        .unionByName(marker("'/local_dataset_info.yml.yml'", "n % 4 = 0"))
        .unionByName(marker("'/task_', n % 3, '/local_dataset_info .yml'", "n % 3 = 0"))
        .unionByName(marker("'/other/deep/local_dataset.yml'", "n % 5 = 0"))
    )


@query(
    "scan_dataset_tree",
    f"""WITH {_LISTING}, m AS (SELECT regexp_replace(path, '/[^/]*$', '') AS dataset_dir, min(path) AS marker FROM listing
  WHERE regexp_extract(path, '[^/]*$') LIKE 'local_dataset%' GROUP BY 1),
k AS (SELECT * FROM m a WHERE NOT EXISTS (SELECT 1 FROM m b WHERE starts_with(a.dataset_dir, b.dataset_dir || '/')))
SELECT dataset_dir, marker, 'local_dataset_info_' || (row_number() OVER (ORDER BY len(string_split(dataset_dir, '/')), dataset_dir) - 1) || '.yml' AS copy_name FROM k""",
)
def _tree(t: Tables) -> DataFrame:
    return pt.dataset_roots(listing(t), ["/root"])


_TASKS = """tm AS (SELECT DISTINCT '/root/' || source AS dataset_dir, '/root/' || source || '/task_' || (doc_id % 3) AS task_dir, doc_id % 4 AS task_index
  FROM documents WHERE doc_id % 3 = doc_id % 4
  UNION SELECT DISTINCT '/root/' || source, '/root/' || source || '/task_0/deeper', 1 FROM documents WHERE doc_id % 3 = 0)"""


@query(
    "scan_task_dirs",
    f"""WITH {_TASKS}, kept AS (SELECT * FROM tm a WHERE NOT EXISTS (SELECT 1 FROM tm b WHERE starts_with(a.task_dir, b.task_dir || '/')))
SELECT dataset_dir, task_dir, task_index, CASE task_index WHEN 0 THEN 'pick in ' || dataset_dir WHEN 1 THEN 'place in ' || dataset_dir END AS task FROM kept""",
)
def _tasks(t: Tables) -> DataFrame:
    docs = t.documents
    root = F.concat(F.lit("/root/"), F.col("source"))
    direct = docs.where("doc_id % 3 = doc_id % 4").select(
        root.alias("dataset_dir"),
        F.concat(root, F.lit("/task_"), F.col("doc_id") % 3, F.lit("/" + pt.TASK_MARKER)).alias("path"),
        (F.col("doc_id") % 4).alias("task_index"),
    )
    deeper = docs.where("doc_id % 3 = 0").select(
        root.alias("dataset_dir"), F.concat(root, F.lit("/task_0/deeper/" + pt.TASK_MARKER)).alias("path"), F.lit(1).cast("long").alias("task_index")
    )
    datasets = docs.select(root.alias("dataset_dir")).distinct()
    texts = F.array(F.concat(F.lit("pick in "), F.col("dataset_dir")), F.concat(F.lit("place in "), F.col("dataset_dir")))
    return pt.task_dirs(direct.unionByName(deeper).distinct(), datasets.withColumn("task_descriptions", texts))


def _natural_sql(col: str) -> str:
    # padded to one width, wider than any digit run of the test tables
    width = 80
    return f"regexp_replace(regexp_replace({col}, '([0-9]+)', '{'0' * width}\\1', 'g'), '[0-9]*([0-9]{{{width}}})', '\\1', 'g')"


@query(
    "episode_files",
    f"""WITH f AS (SELECT source AS dataset_id, doc_id % 3 AS task, '/root/' || source || '/ep' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.h5' WHEN doc_id % 5 = 0 THEN '.txt' ELSE '.hdf5' END AS path FROM documents)
SELECT dataset_id, task, path, CAST(row_number() OVER (PARTITION BY dataset_id, task ORDER BY CASE WHEN path LIKE '%.h5' THEN 0 ELSE 1 END, {_natural_sql('path')}, path) - 1 AS BIGINT) AS episode
FROM f WHERE path NOT LIKE '%.txt'""",
)
def _episode_files(t: Tables) -> DataFrame:
    path = "concat('/root/', source, '/ep', doc_id, CASE WHEN doc_id % 2 = 0 THEN '.h5' WHEN doc_id % 5 = 0 THEN '.txt' ELSE '.hdf5' END)"
    files = t.documents.select(F.col("source").alias("dataset_id"), F.expr("doc_id % 3").alias("task"), F.expr(path).alias("path"))
    return pt.number_episode_files(files, ["dataset_id", "task"])


_DIR_NAME = "CASE doc_id % 6 WHEN 0 THEN concat('episode', doc_id % 24) WHEN 1 THEN concat('Episode_', doc_id % 24) WHEN 2 THEN concat('ep', doc_id % 24) WHEN 3 THEN concat('EP_', doc_id % 24) WHEN 4 THEN concat('00', doc_id % 24) ELSE concat('run', doc_id % 24) END"
_JSON_PATH = f"concat('/root/', source, CASE WHEN doc_id % 10 = 0 THEN '/a/b/c/' WHEN doc_id % 7 = 0 THEN '/a/' ELSE '/' END, {_DIR_NAME}, '/', CASE WHEN doc_id % 11 = 0 THEN 'x.txt' WHEN doc_id % 4 = 0 THEN 'meta_info.json' WHEN doc_id % 4 = 1 THEN concat('Data', doc_id % 3, '.json') WHEN doc_id % 4 = 2 THEN concat('episode_', doc_id, '.json') ELSE concat('z', doc_id, '.json') END)"
_JSON_SQL = f"files AS (SELECT concat('/root/', source) AS task_dir, {_JSON_PATH} AS path FROM documents)"


def _json_files(t: Tables) -> DataFrame:
    return t.documents.select(F.expr("concat('/root/', source)").alias("task_dir"), F.expr(_JSON_PATH).alias("path"))


@query(
    "episode_dirs",
    f"""WITH {_JSON_SQL}, d AS (SELECT task_dir, regexp_replace(path, '/[^/]*$', '') AS episode_dir FROM files WHERE path LIKE '%.json'),
n AS (SELECT DISTINCT task_dir, episode_dir, regexp_extract(episode_dir, '[^/]*$') AS name FROM d),
e AS (SELECT *, CAST(regexp_extract(name, '[0-9]+$') AS BIGINT) AS number FROM n WHERE regexp_matches(name, '(?i)^(episode_?|ep_?)?[0-9]+$')
  AND len(string_split(episode_dir, '/')) - len(string_split(task_dir, '/')) <= 3)
SELECT task_dir, episode_dir, number, CAST(row_number() OVER (PARTITION BY task_dir ORDER BY number, name, episode_dir) - 1 AS BIGINT) AS episode FROM e""",
)
def _episode_dirs(t: Tables) -> DataFrame:
    return pt.episode_dirs(_json_files(t))


_TASK_FILES = f"files AS (SELECT task_dir, CASE WHEN task_dir LIKE '%src1_' THEN regexp_replace(path, '/(episode_?|Episode_|ep_?|EP_|00)([0-9]+)/', '/take_\\2/') ELSE path END AS path FROM (SELECT concat('/root/', source) AS task_dir, {_JSON_PATH} AS path FROM documents))"


@query(
    "episode_json_files",
    f"""WITH {_TASK_FILES}, j AS (SELECT task_dir, path, regexp_extract(path, '[^/]*$') AS name, regexp_replace(path, '/[^/]*$', '') AS dir FROM files WHERE path LIKE '%.json'),
d AS (SELECT DISTINCT task_dir, dir, regexp_extract(dir, '[^/]*$') AS dname FROM j WHERE regexp_matches(regexp_extract(dir, '[^/]*$'), '(?i)^(episode_?|ep_?)?[0-9]+$') AND len(string_split(dir, '/')) - len(string_split(task_dir, '/')) <= 3),
e AS (SELECT *, CAST(row_number() OVER (PARTITION BY task_dir ORDER BY CAST(regexp_extract(dname, '[0-9]+$') AS BIGINT), dname, dir) - 1 AS BIGINT) AS episode FROM d),
r AS (SELECT j.task_dir, episode, path, row_number() OVER (PARTITION BY j.task_dir, episode ORDER BY CASE WHEN contains(lower(name), 'data') THEN 1 WHEN contains(lower(name), 'episode') THEN 2 ELSE 3 END,
  CASE WHEN contains(lower(name), 'data') OR contains(lower(name), 'episode') THEN 0 ELSE len(name) END, path) AS rn FROM j JOIN e ON e.task_dir = j.task_dir AND e.dir = j.dir)
SELECT task_dir, episode, path FROM r WHERE rn = 1
UNION ALL SELECT task_dir, CAST(row_number() OVER (PARTITION BY task_dir ORDER BY {_natural_sql('path')}, path) - 1 AS BIGINT), path FROM j WHERE task_dir NOT IN (SELECT task_dir FROM d)""",
)
def _episode_json(t: Tables) -> DataFrame:
    """Sources 10 to 19 have no episode directories, so their files count one by one."""
    renamed = F.regexp_replace("path", "/(episode_?|Episode_|ep_?|EP_|00)([0-9]+)/", "/take_$2/")
    files = _json_files(t).withColumn("path", F.when(F.col("task_dir").rlike("src1.$"), renamed).otherwise(F.col("path")))
    return pt.episode_json_files(files)


@query(
    "main_file_pick",
    f"""WITH {_JSON_SQL}, f AS (SELECT regexp_replace(path, '/[^/]*$', '') AS episode_dir, path, regexp_extract(path, '[^/]*$') AS name FROM files WHERE path LIKE '%.json'),
r AS (SELECT *, CASE WHEN contains(lower(name), 'data') THEN 1 WHEN contains(lower(name), 'episode') THEN 2 ELSE 3 END AS p FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY episode_dir ORDER BY p, CASE WHEN p = 3 THEN len(name) ELSE 0 END, path) AS rn FROM r)
SELECT episode_dir, path FROM o WHERE rn = 1""",
)
def _main_file(t: Tables) -> DataFrame:
    files = _json_files(t).where(F.col("path").endswith(".json"))
    return pt.main_file(files.withColumn("episode_dir", nm.parent_dir(F.col("path"))), ["episode_dir"])


@query(
    "sidecar_metadata",
    """WITH rec AS (SELECT doc_id, concat('/root/', source, '/rec', doc_id, '.bag') AS recording FROM documents),
side AS (SELECT concat('/root/', source, '/rec', doc_id, '.json') AS path, concat('{"chars": ', n_chars, '}') AS content FROM documents WHERE doc_id % 4 = 0
  UNION ALL SELECT concat('/root/', source, '/rec', doc_id, '_metadata.json'), concat('{"chars": ', n_chars + 1, '}') FROM documents WHERE doc_id % 6 = 0
  UNION ALL SELECT concat('/root/', source, '/rec', doc_id, '.bag_metadata.json'), concat('{"chars": ', n_chars + 2, '}') FROM documents WHERE doc_id % 5 = 0)
SELECT r.recording, CAST(json_extract(coalesce(a.content, b.content, c.content), '$.chars') AS BIGINT) AS chars FROM rec r
LEFT JOIN side a ON a.path = replace(recording, '.bag', '.json') LEFT JOIN side b ON b.path = replace(recording, '.bag', '_metadata.json')
LEFT JOIN side c ON c.path = recording || '_metadata.json'""",
)
def _sidecar(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "source", "n_chars")
    rec = docs.select(F.expr("concat('/root/', source, '/rec', doc_id, '.bag')").alias("recording"))

    def side(tail: str, add: int, every: int) -> DataFrame:
        return docs.where(f"doc_id % {every} = 0").select(
            F.expr(f"concat('/root/', source, '/rec', doc_id, '{tail}')").alias("path"),
            F.expr(f"concat('{{\"chars\": ', n_chars + {add}, '}}')").alias("content"),
        )

    files = side(".json", 0, 4).unionByName(side("_metadata.json", 1, 6)).unionByName(side(".bag_metadata.json", 2, 5))
    found = pt.sidecar_metadata(rec, files)
    return found.select("recording", F.from_json("metadata", "chars BIGINT")["chars"].alias("chars"))


@query(
    "camera_from_filename",
    f"""WITH {IMAGES_SQL}, named AS (SELECT dataset_id, episode, path, regexp_extract(path, '[^/]*$') AS name FROM images),
c AS (SELECT *, CAST(regexp_extract(name, '([0-9])\\.jpg$', 1) AS BIGINT) AS camera FROM named)
SELECT dataset_id, episode, camera, path, CAST(row_number() OVER (PARTITION BY dataset_id, episode, camera ORDER BY {_natural_sql('name')}, path) - 1 AS BIGINT) AS position FROM c""",
)
def _by_camera(t: Tables) -> DataFrame:
    out = pt.images_by_camera(image_listing(t).select("dataset_id", "episode", "path"), ["dataset_id", "episode"])
    return out.withColumn("camera", F.col("camera").cast("long"))


@query(
    "camera_detect",
    f"""WITH {IMAGES_SQL}, f AS (SELECT dataset_id, CASE WHEN dataset_id = 'src7' THEN replace(path, '.jpg', '.png') ELSE path END AS path FROM images),
j AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY path) AS rn FROM f WHERE path LIKE '%.jpg'),
c AS (SELECT dataset_id, string_agg(DISTINCT 'color_' || regexp_extract(path, '([0-9])\\.jpg$', 1), ',' ORDER BY 'color_' || regexp_extract(path, '([0-9])\\.jpg$', 1)) AS cameras FROM j WHERE rn <= 20 GROUP BY 1)
SELECT d.dataset_id, coalesce(cameras, 'color_0') AS cameras FROM (SELECT DISTINCT dataset_id FROM f) d LEFT JOIN c USING (dataset_id)""",
)
def _detect(t: Tables) -> DataFrame:
    path = F.when(F.col("dataset_id") == "src7", F.regexp_replace("path", r"\.jpg$", ".png")).otherwise(F.col("path"))
    files = image_listing(t).select("dataset_id", path.alias("path"))
    return pt.detect_cameras(files, ["dataset_id"]).withColumn("cameras", F.array_join("cameras", ","))


_CONFIGURED = """cfg AS (SELECT DISTINCT source AS dataset_id, unnest(['observations/images/camera_0', 'observations/images/camera_1', 'observations/images/camera_8']) AS h5_path FROM documents)"""


def _configured(t: Tables) -> DataFrame:
    paths = F.array(*[F.lit(f"observations/images/camera_{i}") for i in (0, 1, 8)])
    return t.documents.select(F.col("source").alias("dataset_id")).distinct().withColumn("h5_path", F.explode(paths))


def _available(t: Tables) -> DataFrame:
    return t.documents.select(F.col("source").alias("dataset_id"), F.expr("concat('camera_', doc_id % 7)").alias("camera"))


@query(
    "camera_prune",
    f"""WITH {_CONFIGURED}, have AS (SELECT DISTINCT source AS dataset_id, 'camera_' || (doc_id % 7) AS camera FROM documents),
c AS (SELECT *, regexp_extract(h5_path, '[^/]*$') AS camera FROM cfg)
SELECT c.dataset_id, c.camera, c.h5_path, h.camera IS NOT NULL AS kept FROM c LEFT JOIN have h ON h.dataset_id = c.dataset_id AND h.camera = c.camera""",
)
def _prune(t: Tables) -> DataFrame:
    return pt.prune_cameras(_configured(t), _available(t))


@query(
    "config_diff",
    f"""WITH {_CONFIGURED}, c AS (SELECT dataset_id, regexp_extract(h5_path, '[^/]*$') AS camera FROM cfg),
have AS (SELECT source AS dataset_id, 'camera_' || (doc_id % 7) AS camera FROM documents)
SELECT *, 'missing' AS side FROM (SELECT * FROM c EXCEPT SELECT * FROM have) UNION ALL SELECT *, 'unused' FROM (SELECT * FROM have EXCEPT SELECT * FROM c)""",
)
def _diff(t: Tables) -> DataFrame:
    configured = _configured(t).select("dataset_id", nm.base_name(F.col("h5_path")).alias("camera"))
    return pt.config_diff(configured, _available(t))


_FILE_KIND = "CASE WHEN quality = 1 AND toxic = 0 THEN 'meta/info.json' WHEN quality = 1 THEN 'device/device_info.json' WHEN toxic = 1 THEN 'README.md' ELSE 'label/data_annotation.json' END"


@query(
    "required_files",
    f"""WITH have AS (SELECT DISTINCT doc_id, {_FILE_KIND} AS file FROM labels UNION SELECT doc_id, 'label/data_annotation.json' FROM labels WHERE doc_id % 2 = 0),
want AS (SELECT doc_id, unnest(['meta/info.json', 'label/data_annotation.json', 'device/device_info.json', 'README.md']) AS file FROM documents)
SELECT doc_id, string_agg(file, ',' ORDER BY file) AS missing FROM want w ANTI JOIN have h ON h.doc_id = w.doc_id AND h.file = w.file GROUP BY 1""",
)
def _required(t: Tables) -> DataFrame:
    kinds = t.labels.select("doc_id", F.expr(_FILE_KIND).alias("file"))
    more = t.labels.where("doc_id % 2 = 0").select("doc_id", F.lit("label/data_annotation.json").alias("file"))
    out = pt.missing_files(t.documents.select("doc_id"), kinds.unionByName(more), "doc_id", ["README.md"])
    return out.withColumn("missing", F.array_join("missing", ","))


# every fifth name has a digit run of up to some sixty digits
_LONG_NAMES = "concat('ep', doc_id % 37, CASE WHEN doc_id % 5 = 0 THEN concat(repeat('0', cast(doc_id % 60 as int)), doc_id % 3) ELSE '' END, '_part', doc_id, '.jpg')"


@query(
    "natural_sort",
    f"""WITH n AS (SELECT doc_id, 'ep' || (doc_id % 37) || CASE WHEN doc_id % 5 = 0 THEN repeat('0', CAST(doc_id % 60 AS INTEGER)) || (doc_id % 3) ELSE '' END || '_part' || doc_id || '.jpg' AS name FROM documents)
SELECT doc_id, name, CAST(row_number() OVER (ORDER BY {_natural_sql('name')}, doc_id) - 1 AS BIGINT) AS position FROM n""",
)
def _natural(t: Tables) -> DataFrame:
    from kinetable.operators.ordered import number_rows

    names = t.documents.select("doc_id", F.expr(_LONG_NAMES).alias("name"))
    return number_rows(names.withColumn("_key", nm.natural_key(F.col("name"))), [], ["_key", "doc_id"], "position", stored=True).drop("_key")


@query(
    "frames_by_imagecount",
    f"""WITH {IMAGES_SQL}, e AS (SELECT dataset_id, regexp_extract(path, '^(.*?/episode[^/]*)/', 1) AS episode, regexp_replace(path, '/[^/]*$', '') AS dir, count(*) AS n FROM images GROUP BY 1, 2, 3),
f AS (SELECT dataset_id, episode, arg_min(n, dir) AS n_frames FROM e GROUP BY 1, 2),
c AS (SELECT dataset_id, regexp_replace(path, '/camera_0/[^/]*$', '') AS episode, count(*) AS n_frames FROM images WHERE contains(path, '/camera_0/') GROUP BY 1, 2)
SELECT 'first_dir' AS rule, * FROM f UNION ALL SELECT 'camera_0', * FROM c""",
)
def _image_counts(t: Tables) -> DataFrame:
    files = image_listing(t).select("dataset_id", "path")
    first = pt.frames_by_images(files).withColumn("rule", F.lit("first_dir"))
    return first.unionByName(pt.frames_by_images(files, camera_dir="camera_0").withColumn("rule", F.lit("camera_0")))
