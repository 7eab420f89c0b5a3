"""Discovery on file listings: a listing is a DataFrame with a ``path`` column.

Directories are never walked one by one. The listing is a table, and "do not look below a
marker" is an anti join of marker directories against their own ancestors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.functions import names as nm
from kinetable.operators.ordered import number_rows
from kinetable.session import staged

# fixed values: marker names
DATASET_MARKER = "local_dataset"
TASK_MARKER = "local_task_info.yml"
REQUIRED_FILES = ["meta/info.json", "label/data_annotation.json", "device/device_info.json"]
DEFAULT_CAMERA = "color_0"


def shallowest(marked: DataFrame, directory: str) -> DataFrame:
    """Rows whose directory has no marked proper ancestor."""
    dirs = marked.select(F.col(directory).alias("_dir")).distinct()
    below = (
        dirs.select("_dir", F.explode(nm.ancestors(F.col("_dir"))).alias("_up"))
        .join(dirs.select(F.col("_dir").alias("_up")), "_up", "left_semi")
        .select(F.col("_dir").alias(directory))
        .distinct()
    )
    return marked.join(below, directory, "left_anti")


def _under(path: Column, roots: Sequence[str] | None) -> Column:
    if not roots:
        return F.lit(True)
    cond = F.lit(False)
    for root in roots:
        cond = cond | path.startswith(root.rstrip("/") + "/")
    return cond


def dataset_roots(listing: DataFrame, roots: Sequence[str] | None = None) -> DataFrame:
    """(dataset_dir, marker, copy_name): the first marker file of a directory, none below another."""
    path = F.col("path")
    markers = (
        listing.where(_under(path, roots) & nm.base_name(path).startswith(DATASET_MARKER))
        .groupBy(nm.parent_dir(path).alias("dataset_dir"))
        .agg(F.min("path").alias("marker"))
    )
    found = shallowest(markers, "dataset_dir").withColumn("_depth", nm.depth(F.col("dataset_dir")))
    numbered = number_rows(staged(found, "dataset-roots"), [], ["_depth", "dataset_dir"], "_no", stored=True)
    copy_name = F.concat(F.lit("local_dataset_info_"), F.col("_no"), F.lit(".yml"))
    return numbered.select("dataset_dir", "marker", copy_name.alias("copy_name"))


def task_dirs(task_markers: DataFrame, datasets: DataFrame) -> DataFrame:
    """Task directories with their task text.

    ``task_markers`` (dataset_dir, path, task_index) are the parsed task files, ``datasets``
    (dataset_dir, task_descriptions) the ordered texts. An index outside the list gives null.
    """
    marked = task_markers.withColumn("task_dir", nm.parent_dir(F.col("path")))
    kept = shallowest(marked, "task_dir")
    tasks = datasets.select("dataset_dir", F.posexplode("task_descriptions").alias("task_index", "task"))
    return kept.join(tasks, ["dataset_dir", "task_index"], "left").select("dataset_dir", "task_dir", "task_index", "task")


def number_episode_files(files: DataFrame, by: Sequence[str], extensions: Sequence[str] = (".h5", ".hdf5"), natural: bool = True) -> DataFrame:
    """Episode number of every file: extension groups in the given order, natural order inside."""
    path = F.col("path")
    group: Column | None = None
    for i, ext in enumerate(extensions):
        group = F.when(path.endswith(ext), i) if group is None else group.when(path.endswith(ext), i)
    keyed = files.withColumn("_group", group).where(F.col("_group").isNotNull())
    keyed = keyed.withColumn("_natural", nm.natural_key(path) if natural else path)
    # the listing may be the result of joins: staged, it is counted and numbered without running them again
    keyed = staged(keyed, "episode-files")
    return number_rows(keyed, by, ["_group", "_natural", "path"], "episode", stored=True).drop("_group", "_natural")


def episode_dirs(files: DataFrame, task: str = "task_dir", max_depth: int = 3) -> DataFrame:
    """Numbered episode directories of a task: named like an episode and with a JSON file below."""
    json = files.where(F.col("path").endswith(".json"))
    dirs = json.select(task, F.explode(nm.ancestors(F.col("path"))).alias("episode_dir")).where(
        F.col("episode_dir").startswith(F.concat(F.col(task), F.lit("/")))
        & (nm.depth(F.col("episode_dir")) - nm.depth(F.col(task)) <= max_depth)
    )
    name = nm.base_name(F.col("episode_dir"))
    number = F.regexp_extract(name, nm.EPISODE_DIR, 1)
    found = (
        dirs.where(name.rlike(nm.EPISODE_DIR))
        .distinct()
        .withColumn("number", number.cast("long"))
        .withColumn("_name", name)
    )
    found = staged(found, "episode-dirs")
    return number_rows(found, [task], ["number", "_name", "episode_dir"], "episode", stored=True).drop("_name")


def main_file(files: DataFrame, by: Sequence[str]) -> DataFrame:
    """One data file per episode: named with 'data', else with 'episode', else the shortest name."""
    name = nm.base_name(F.col("path"))
    lower = F.lower(name)
    rank = F.when(lower.contains("data"), 1).when(lower.contains("episode"), 2).otherwise(3)
    length = F.when(rank == 3, F.length(name)).otherwise(0)
    return files.groupBy(*by).agg(F.min_by("path", F.struct(rank, length, "path")).alias("path"))


def episode_json_files(files: DataFrame, task: str = "task_dir") -> DataFrame:
    """(task, episode, path): the JSON data file of every episode.

    A task with episode directories has the main file of each, in their order. Any other task has
    all its JSON files in natural order.
    """
    json = files.where(F.col("path").endswith(".json")).select(task, "path")
    dirs = episode_dirs(json, task)
    below = json.withColumn("episode_dir", F.explode(nm.ancestors(F.col("path"))))
    picked = main_file(below.join(dirs.select(task, "episode_dir", "episode"), [task, "episode_dir"]), [task, "episode"])
    flat = json.join(dirs.select(task), task, "left_anti")
    return picked.select(task, "episode", "path").unionByName(
        number_episode_files(flat, [task], (".json",)).select(task, "episode", "path")
    )


def images_by_camera(files: DataFrame, by: Sequence[str]) -> DataFrame:
    """Images per camera (last digit of the name) in natural order."""
    name = nm.base_name(F.col("path"))
    images = files.withColumn("camera", nm.camera_index(name)).where(F.col("camera").isNotNull())
    images = images.withColumn("_natural", nm.natural_key(name))
    return number_rows(images, [*by, "camera"], ["_natural", "path"], "position", stored=True).drop("_natural")


def detect_cameras(files: DataFrame, by: Sequence[str], sample: int | None = 20) -> DataFrame:
    """Camera keys found per dataset, from the first ``sample`` image names; one default without any.

    The sample is the feature: the config is proposed from a few images. None looks at all.
    """
    from pyspark.sql import Window

    name = nm.base_name(F.col("path"))
    jpg = files.withColumn("_jpg", name.rlike(nm.JPG_NAME))
    wanted = jpg.where("_jpg")
    if sample is not None:
        # row_number <= n is cut before the shuffle, so a large dataset sends n rows per task
        w = Window.partitionBy(*by).orderBy("path")
        wanted = wanted.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample)
    found = wanted.withColumn("_cam", nm.camera_index(name)).groupBy(*by).agg(F.collect_set("_cam").alias("_cams"))
    keys = F.transform(F.array_sort("_cams"), lambda c: F.concat(F.lit("color_"), c))
    default = F.array(F.lit(DEFAULT_CAMERA))
    return (
        files.select(*by)
        .distinct()
        .join(found, list(by), "left")
        .select(*by, F.when(F.col("_cams").isNull(), default).otherwise(keys).alias("cameras"))
    )


def prune_cameras(configured: DataFrame, available: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Configured cameras, ``kept`` where they exist; the name is the last path part."""
    named = configured.withColumn("camera", nm.base_name(F.col("h5_path")))
    keys = [dataset, "camera"]
    have = available.select(*keys).distinct().withColumn("kept", F.lit(True))
    return named.join(have, keys, "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def config_diff(configured: DataFrame, available: DataFrame) -> DataFrame:
    """Rows of one set that the other lacks, labelled ``missing`` or ``unused``."""
    columns = configured.columns
    missing = configured.select(*columns).subtract(available.select(*columns)).withColumn("side", F.lit("missing"))
    unused = available.select(*columns).subtract(configured.select(*columns)).withColumn("side", F.lit("unused"))
    return missing.unionByName(unused)


def missing_files(datasets: DataFrame, files: DataFrame, key: str, extra: Sequence[str] = ()) -> DataFrame:
    """Required files that a dataset lacks, as a sorted list; complete datasets do not appear.

    ``files`` holds (key, file). The fixed required list is exploded per dataset, not joined.
    """
    required = F.array(*[F.lit(f) for f in [*REQUIRED_FILES, *extra]])
    wanted = datasets.select(key, F.explode(required).alias("file"))
    have = files.select(key, "file")
    return wanted.join(have, [key, "file"], "left_anti").groupBy(key).agg(F.array_sort(F.collect_list("file")).alias("missing"))


def select_subdirs(children: DataFrame, name: str, wanted: Sequence[str] | None = None, ignored: Sequence[str] = ()) -> DataFrame:
    """All children, or the named ones that exist, without the ignored."""
    out = children.where(~F.col(name).isin(list(ignored))) if ignored else children
    return out.where(F.col(name).isin(list(wanted))) if wanted is not None else out


def sidecar_metadata(recordings: DataFrame, files: DataFrame) -> DataFrame:
    """Metadata text of a recording from the first existing of three names, null without any.

    ``files`` (path, content) are the JSON files. The three candidate names are exploded, so
    the lookup is one equi-join on the path.
    """
    path = F.col("recording")
    base = F.concat(nm.parent_dir(path), F.lit("/"), nm.stem(path))
    candidates = F.array(
        F.concat(base, F.lit(".json")), F.concat(base, F.lit("_metadata.json")), F.concat(path, F.lit("_metadata.json"))
    )
    wanted = recordings.select("recording", F.posexplode(candidates).alias("_priority", "path"))
    found = wanted.join(files.select("path", "content"), "path")
    best = found.groupBy("recording").agg(F.min_by("content", "_priority").alias("metadata"), F.min("_priority").alias("candidate"))
    return recordings.select("recording").join(best, "recording", "left")


def frames_by_images(files: DataFrame, dataset: str = "dataset_id", camera_dir: str | None = None) -> DataFrame:
    """Frames of an episode = JPG files of its first image directory.

    ``camera_dir`` names that directory (its parent is the episode). Without it the episode is
    the outermost directory called ``episode*`` and the first directory by depth and name counts.
    """
    path = F.col("path")
    directory = nm.parent_dir(path)
    jpg = files.where(nm.base_name(path).rlike(nm.JPG_NAME))
    if camera_dir is not None:
        return (
            jpg.where(nm.base_name(directory) == camera_dir)
            .groupBy(F.col(dataset).alias("dataset_id"), nm.parent_dir(directory).alias("episode"))
            .agg(F.count(F.lit(1)).alias("n_frames"))
        )
    episode = F.regexp_extract(path, r"^(.*?/episode[^/]*)/", 1)
    per_dir = (
        jpg.withColumn("_ep", episode)
        .where(F.col("_ep") != "")
        .groupBy(F.col(dataset).alias("dataset_id"), F.col("_ep").alias("episode"), directory.alias("_dir"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return per_dir.groupBy("dataset_id", "episode").agg(F.min_by("_n", F.struct(nm.depth(F.col("_dir")), "_dir")).alias("n_frames"))
