"""Queries of the tag, record and catalogue operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.functions import names as nm
from kinetable.functions import tags as tg
from kinetable.operators import catalog as ct
from kinetable.operators import records as rc
from kinetable.operators.ordered import number_rows
from kinetable.operators.stats import size_label
from kinetable.plans.registry import Tables, query
from kinetable.session import staged

_TAG_TEXT = (
    "concat('category: ', p_type, '-', p_brand, '\\n  size：', p_size, ' \\nno colon here\\ncolours : ', replace(p_name, ' ', '、'), "
    "'\\nmix: ', p_size, ', ', p_retailprice, '; -', p_partkey, ' x', CASE WHEN p_partkey % 5 = 0 THEN '\\nsize: 7' ELSE '' END)"
)
_TAG_SQL = _TAG_TEXT.replace("\\n", "' || chr(10) || '")
_TEXT_SQL = f"tagged AS (SELECT p_partkey, p_type, p_brand, p_size, p_name, p_retailprice, {_TAG_SQL} AS text FROM part)"


def tag_texts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_TAG_TEXT).alias("text"))


@query(
    "tag_lines_parse",
    f"""WITH {_TEXT_SQL}, l AS (SELECT p_partkey, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM tagged),
m AS (SELECT p_partkey, no, regexp_extract(trim(line), '^([^:：]+?)\\s*[:：]\\s*(.+)$', 1) AS key, regexp_extract(trim(line), '^([^:：]+?)\\s*[:：]\\s*(.+)$', 2) AS value
  FROM l WHERE regexp_matches(trim(line), '^([^:：]+?)\\s*[:：]\\s*(.+)$')),
k AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, key ORDER BY no DESC) AS rn FROM m)
SELECT p_partkey, key, array_to_string(list_filter(regexp_split_to_array(value, '[、，,\\s;；]+'), lambda x: x <> ''), '|') AS values FROM k WHERE rn = 1""",
)
def _parse(t: Tables) -> DataFrame:
    parsed = tag_texts(t).select("p_partkey", F.explode(tg.tag_map(F.col("text"))).alias("key", "v"))
    return parsed.select("p_partkey", "key", F.array_join("v", "|").alias("values"))


@query(
    "tag_numeric",
    f"""WITH v AS (SELECT p_partkey, unnest([CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR), '-' || p_partkey, p_name, '1e' || (p_partkey % 5), '1d', ' .5 ', '-1234567890123456789' || p_partkey, repeat('7', CAST(39 + p_partkey % 9 AS INTEGER))]) AS raw FROM part),
s AS (SELECT p_partkey, trim(raw) AS text FROM v)
SELECT p_partkey, text, CASE WHEN regexp_matches(text, '^-?[0-9]+$') THEN try_cast(text AS BIGINT) END AS integer,
 CASE WHEN regexp_matches(text, '^-?[0-9]+$') AND try_cast(text AS BIGINT) IS NULL THEN CAST(try_cast(text AS DECIMAL(38,0)) AS VARCHAR) END AS big,
 CASE WHEN NOT regexp_matches(text, '^-?[0-9]+$') OR try_cast(text AS DECIMAL(38,0)) IS NULL THEN try_cast(text AS DOUBLE) END AS decimal FROM s""",
)
def _numeric(t: Tables) -> DataFrame:
    raw = F.expr("explode(array(cast(p_size as string), cast(p_retailprice as string), concat('-', p_partkey), p_name, concat('1e', p_partkey % 5), '1d', ' .5 ', concat('-1234567890123456789', p_partkey), repeat('7', cast(39 + p_partkey % 9 as int))))")
    return t.part.select("p_partkey", raw.alias("raw")).select("p_partkey", tg.tag_numeric(F.col("raw")).alias("n")).select("p_partkey", "n.*").withColumn("big", F.col("big").cast("string"))


@query(
    "tag_hierarchy",
    """WITH h AS (SELECT p_partkey, list_filter(list_transform(string_split(' ' || p_type || ' - ' || p_brand || '--' || p_size || CASE WHEN p_partkey % 3 = 0 THEN '-a-b-c' ELSE '' END, '-'), lambda x: trim(x)), lambda x: x <> '') AS p FROM part)
SELECT p_partkey, p[1] AS level1, p[2] AS level2, p[3] AS level3, p[4] AS level4, p[5] AS level5 FROM h""",
)
def _hierarchy(t: Tables) -> DataFrame:
    path = F.expr("concat(' ', p_type, ' - ', p_brand, '--', p_size, CASE WHEN p_partkey % 3 = 0 THEN '-a-b-c' ELSE '' END)")
    return t.part.select("p_partkey", tg.tag_hierarchy(path).alias("h")).select("p_partkey", "h.*")


@query(
    "dataset_name_clean",
    """WITH c AS (SELECT page_id, url, coalesce(nullif(regexp_extract(regexp_extract(regexp_replace(trim(url), '/+$', ''), '[^/]*$'), '^[a-zA-Z0-9_.\\-]+'), ''), 'unknown_dataset') AS dataset_name FROM pages)
SELECT dataset_name, count(*) AS rows, max(page_id) AS last_page, arg_max(url, page_id) AS last_url FROM c GROUP BY 1""",
)
def _clean(t: Tables) -> DataFrame:
    named = t.pages.select("page_id", "url", nm.clean_dataset_name(F.col("url")).alias("dataset_name"))
    return named.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("rows"), F.max("page_id").alias("last_page"), F.max_by("url", "page_id").alias("last_url")
    )


@query(
    "record_normalise",
    """SELECT p_partkey, regexp_replace(p_name || '__' || p_type, '\\s+', '_', 'g').regexp_replace('_+', '_', 'g') AS title, replace(p_name, ' ', '_') AS name0, p_type AS level1_0, replace(p_brand, ' ', '_') AS name1,
  CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', '_') || '__key' ELSE 'box' END AS name2, 3 AS objects FROM part""",
)
def _normalise(t: Tables) -> DataFrame:
    # a well-formed object, a single unknown key, and an object where the later name counts
    later = "CASE WHEN p_partkey % 2 = 0 THEN map('object_name', 'box', concat(p_name, '  _key'), null) ELSE map(concat(p_name, '_key'), null, 'object_name', 'box') END"
    objects = f"array(map('object_name', p_name, 'level1', p_type), map(p_brand, cast(null as string)), null, {later})"
    df = t.part.select("p_partkey", F.expr("concat(p_name, '__', p_type)").alias("title"), F.expr(objects).alias("objects"))
    out = rc.normalise_records(df)
    return out.select(
        "p_partkey",
        "title",
        F.get("objects", F.lit(0))["object_name"].alias("name0"),
        F.get("objects", F.lit(0))["level1"].alias("level1_0"),
        F.get("objects", F.lit(1))["object_name"].alias("name1"),
        F.get("objects", F.lit(2))["object_name"].alias("name2"),
        F.size("objects").alias("objects"),
    )


_UUID_SQL = "concat_ws('-', sha256({0})[1:8], sha256({0})[9:12], sha256({0})[13:16], sha256({0})[17:20], sha256({0})[21:32])"


@query(
    "uuid_assign",
    f"""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'given-' || s_suppkey ELSE {_UUID_SQL.format("s_name || '/' || s_suppkey")} END AS dataset_uuid FROM supplier""",
)
def _uuid(t: Tables) -> DataFrame:
    given = F.expr("CASE WHEN s_suppkey % 4 = 0 THEN concat('given-', s_suppkey) WHEN s_suppkey % 4 = 1 THEN '' END")
    return rc.assign_uuid(t.supplier.withColumn("dataset_uuid", given), ["s_name", "s_suppkey"]).select("s_suppkey", "dataset_uuid")


def registry(t: Tables) -> DataFrame:
    """Suppliers as datasets: model = nation, scene = region, effector by key."""
    joined = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    return joined.select(
        F.col("s_suppkey"),
        F.col("s_name").alias("dataset_name"),
        F.sha2(F.col("s_suppkey").cast("string"), 256).alias("dataset_uuid"),
        F.array("n_name", "r_name").alias("device_model"),
        F.expr("concat('effector_', s_suppkey % 3)").alias("end_effector_type"),
        F.col("s_acctbal").alias("operation_platform_height"),
        F.col("r_name").alias("scene_type"),
    )


_REG = """reg AS (SELECT s_suppkey, s_name AS dataset_name, sha256(CAST(s_suppkey AS VARCHAR)) AS dataset_uuid, n_name AS device_model, r_name AS scene_type,
  'effector_' || (s_suppkey % 3) AS end_effector_type, s_acctbal AS operation_platform_height FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""


@query("device_filter", f"WITH {_REG} SELECT s_suppkey, 'one' AS mode FROM reg WHERE device_model = 'NATION_3' UNION ALL SELECT s_suppkey, 'all' FROM reg")
def _device(t: Tables) -> DataFrame:
    reg = registry(t)
    one = ct.filter_device(reg, "NATION_3").select("s_suppkey", F.lit("one").alias("mode"))
    return one.unionByName(ct.filter_device(reg, "").select("s_suppkey", F.lit("all").alias("mode")))


@query(
    "output_names",
    f"""WITH {_REG} SELECT s_suppkey, '/out/' || device_model || '_' || dataset_name AS output_path, 'platform/' || lower(device_model || '_' || dataset_name) AS repo_id,
 lower(device_model || '_' || dataset_name) AS log_name FROM reg""",
)
def _output_names(t: Tables) -> DataFrame:
    names = ct.output_names(F.col("device_model")[0], F.col("dataset_name"), "/out/", "platform")
    return registry(t).select("s_suppkey", *[c.alias(n) for n, c in names.items()])


_CONFIG = "cfg AS (SELECT n_name AS device_model, 'config_' || lower(n_name) || '.yaml' AS config FROM nation WHERE n_nationkey % 3 > 0)"


@query(
    "config_match",
    f"""WITH {_REG}, {_CONFIG} SELECT s_suppkey, device_model, config, config IS NOT NULL AS matched FROM reg LEFT JOIN cfg USING (device_model)""",
)
def _config(t: Tables) -> DataFrame:
    datasets = registry(t).select("s_suppkey", F.col("device_model")[0].alias("device_model"))
    configs = t.nation.where("n_nationkey % 3 > 0").select(
        F.col("n_name").alias("device_model"), F.expr("concat('config_', lower(n_name), '.yaml')").alias("config")
    )
    return ct.match_configs(datasets, configs)


@query(
    "pending_work",
    """SELECT c_custkey, c_mktsegment, 'all' AS mode FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT c_custkey, c_mktsegment, 'one' FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def _pending(t: Tables) -> DataFrame:
    datasets = t.customer.select(F.col("c_custkey").alias("dataset_uuid"), F.col("c_mktsegment").alias("device_model"))
    status = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("dataset_uuid"))
    both = ct.pending(datasets, status).withColumn("mode", F.lit("all")).unionByName(ct.pending(datasets, status, "MACHINERY").withColumn("mode", F.lit("one")))
    return both.select(F.col("dataset_uuid").alias("c_custkey"), F.col("device_model").alias("c_mktsegment"), "mode")


@query(
    "changed_since_upload",
    """WITH c AS (SELECT o_orderkey, o_orderstatus || (o_custkey % 5) AS commit FROM orders), h AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN '' ELSE o_orderstatus || (o_custkey % 4) END AS commit FROM orders WHERE o_orderkey % 3 > 0)
SELECT c.o_orderkey, c.commit FROM c LEFT JOIN h USING (o_orderkey) WHERE h.commit IS NULL OR h.commit = '' OR h.commit <> c.commit""",
)
def _changed(t: Tables) -> DataFrame:
    current = t.orders.select("o_orderkey", F.expr("concat(o_orderstatus, o_custkey % 5)").alias("commit"))
    history = t.orders.where("o_orderkey % 3 > 0").select(
        "o_orderkey", F.expr("CASE WHEN o_custkey % 7 = 0 THEN '' ELSE concat(o_orderstatus, o_custkey % 4) END").alias("commit")
    )
    return ct.changed_since(current, history, "o_orderkey", "commit")


@query(
    "invalid_episode_info",
    """WITH l AS (SELECT o_custkey, count(*) FILTER (WHERE o_totalprice > 400000) AS n FROM orders GROUP BY 1)
SELECT c_custkey AS dataset_id, '/root/' || c_name AS source_path FROM customer LEFT JOIN l ON o_custkey = c_custkey WHERE n IS NULL OR n = 0""",
)
def _invalid(t: Tables) -> DataFrame:
    datasets = t.customer.select(F.col("c_custkey").alias("dataset_id"), F.concat(F.lit("/root/"), F.col("c_name")).alias("source_path"))
    lists = t.orders.groupBy(F.col("o_custkey").alias("dataset_id")).agg(
        F.collect_list(F.when(F.col("o_totalprice") > 400000, F.col("o_orderkey"))).alias("episode_frames_num")
    )
    return ct.invalid_frame_lists(datasets, lists, "dataset_id")


@query("skip_existing", f"WITH {_REG} SELECT dataset_name, device_model FROM reg WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_tax = 0)")
def _skip(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_quantity = 50 AND l_tax = 0").select(F.col("l_suppkey").alias("s_suppkey"))
    return ct.skip_existing(registry(t), done, "s_suppkey").select("dataset_name", F.col("device_model")[0].alias("device_model"))


@query(
    "dim_get_or_create",
    """WITH ex AS (SELECT row_number() OVER (ORDER BY v) + 4 AS id, v AS value FROM (SELECT DISTINCT p_type AS v FROM part)),
new AS (SELECT DISTINCT p_brand || ' ' || p_type AS value FROM part UNION SELECT p_type FROM part),
fresh AS (SELECT value FROM new ANTI JOIN ex USING (value))
SELECT id, value FROM ex UNION ALL SELECT (SELECT max(id) FROM ex) + row_number() OVER (ORDER BY value), value FROM fresh""",
)
def _dim(t: Tables) -> DataFrame:
    types = staged(t.part.select(F.col("p_type").alias("value")).distinct(), "types")
    existing = number_rows(types, [], ["value"], "id", start=5, stored=True)
    values = t.part.select(F.concat_ws(" ", "p_brand", "p_type").alias("value")).unionByName(t.part.select(F.col("p_type").alias("value")))
    return ct.get_or_create(existing, values, "id", "value")


@query(
    "object_levels",
    """WITH ex AS (SELECT row_number() OVER (ORDER BY p_type) AS object_id, p_type AS object_name FROM (SELECT DISTINCT p_type FROM part)),
rec AS (SELECT p_partkey, p_type AS object_name, p_brand AS level1, p_name AS level2 FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_brand, p_type, NULL FROM part),
last AS (SELECT object_name, arg_max_null(level1, p_partkey) AS level1, arg_max_null(level2, p_partkey) AS level2 FROM rec GROUP BY 1),
fresh AS (SELECT DISTINCT object_name FROM rec ANTI JOIN ex USING (object_name)),
ids AS (SELECT object_id, object_name FROM ex UNION ALL SELECT (SELECT max(object_id) FROM ex) + row_number() OVER (ORDER BY object_name), object_name FROM fresh)
SELECT object_id, object_name, level1, level2 FROM ids JOIN last USING (object_name)""",
)
def _objects(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    types = staged(t.part.select(F.col("p_type").alias("object_name")).distinct(), "types")
    existing = number_rows(types, [], ["object_name"], "object_id", start=1, stored=True)
    existing = existing.withColumns({c: none for c in ct.LEVEL_COLUMNS})
    rest = {c: none for c in ct.LEVEL_COLUMNS[2:]}
    seen = t.part.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_type").alias("object_name"), F.col("p_brand").alias("level1"), F.col("p_name").alias("level2"))
    new = t.part.select("p_partkey", F.col("p_brand").alias("object_name"), F.col("p_type").alias("level1"), none.alias("level2"))
    objects = seen.unionByName(new).withColumns(rest)
    return ct.upsert_objects(existing, objects, ["p_partkey"]).select("object_id", "object_name", "level1", "level2")


@query(
    "dataset_upsert",
    f"""WITH {_REG}, old AS (SELECT dataset_uuid, 'old ' || dataset_name AS dataset_name, 'none' AS device_model, end_effector_type, 1.0::DOUBLE AS operation_platform_height FROM reg WHERE s_suppkey % 3 > 0),
new AS (SELECT dataset_uuid, dataset_name, device_model, end_effector_type, CASE WHEN s_suppkey % 5 > 0 THEN operation_platform_height END AS operation_platform_height FROM reg WHERE s_suppkey % 2 = 0)
SELECT * FROM old WHERE dataset_uuid NOT IN (SELECT dataset_uuid FROM new) UNION ALL SELECT * FROM new""",
)
def _upsert(t: Tables) -> DataFrame:
    reg = registry(t)
    columns = ["dataset_uuid", "dataset_name", "device_model", "end_effector_type", "operation_platform_height"]
    target = reg.where("s_suppkey % 3 > 0").select(
        "dataset_uuid", F.concat(F.lit("old "), "dataset_name").alias("dataset_name"), F.lit("none").alias("device_model"), "end_effector_type", F.lit(1.0).alias("operation_platform_height")
    )
    height = F.when(F.col("s_suppkey") % 5 > 0, F.col("operation_platform_height"))
    changes = reg.where("s_suppkey % 2 = 0").withColumn("operation_platform_height", height)
    # an older change of the same key must lose
    older = changes.withColumn("dataset_name", F.lit("stale")).withColumn("_no", F.lit(1))
    return ct.upsert_datasets(target, changes.withColumn("_no", F.lit(2)).unionByName(older).select(*columns, "_no"), ["_no"])


@query(
    "dataset_bridge",
    """WITH old AS (SELECT DISTINCT l_suppkey AS dataset_id, p_type AS object_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey % 3 > 0),
new AS (SELECT DISTINCT l_suppkey AS dataset_id, p_brand AS object_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey % 2 = 0)
SELECT * FROM old WHERE dataset_id NOT IN (SELECT dataset_id FROM new) UNION ALL SELECT * FROM new""",
)
def _bridge(t: Tables) -> DataFrame:
    joined = t.lineitem.select("l_suppkey", "l_partkey").join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    old = joined.where("l_suppkey % 3 > 0").select(F.col("l_suppkey").alias("dataset_id"), F.col("p_type").alias("object_name")).distinct()
    new = joined.where("l_suppkey % 2 = 0").select(F.col("l_suppkey").alias("dataset_id"), F.col("p_brand").alias("object_name"))
    return ct.replace_links(old, new, "dataset_id")


STATUS_EVENT = {
    "dataset_uuid": "concat('ds-', o_custkey)",
    "convert_status": "CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'completed' END",
    "update_message": "CASE WHEN o_orderkey % 3 = 0 THEN concat('message ', o_orderkey) END",
    "convert_path": "CASE WHEN o_orderkey % 4 = 0 THEN concat('/out/', o_orderkey) END",
    "updated_at": "o_orderkey",
}
_EVENTS_SQL = "ev AS (SELECT o_custkey AS c, o_orderkey AS k, " + ", ".join(f"{e} AS {n}" for n, e in STATUS_EVENT.items()) + " FROM orders)"
_OLD_STATUS = "old AS (SELECT c_custkey AS c, CAST(-1 AS BIGINT) AS k, concat('ds-', c_custkey) AS dataset_uuid, 'processing' AS convert_status, concat('old ', c_custkey) AS update_message, CAST(NULL AS VARCHAR) AS convert_path, CAST(-1 AS BIGINT) AS updated_at FROM customer WHERE c_custkey % 2 = 0)"
STATUS_SQL = f"""WITH {_EVENTS_SQL}, {_OLD_STATUS}, a AS (SELECT * FROM ev UNION ALL SELECT * FROM old)
SELECT dataset_uuid, arg_max(convert_status, k) AS convert_status, arg_max(update_message, k) FILTER (WHERE update_message IS NOT NULL) AS update_message,
 arg_max(convert_path, k) FILTER (WHERE convert_path IS NOT NULL) AS convert_path, max(updated_at) AS updated_at FROM a GROUP BY 1"""


def status_events(t: Tables) -> DataFrame:
    events = t.orders.select(*[F.expr(e).alias(n) for n, e in STATUS_EVENT.items() if n != "convert_status"], F.expr("CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'success' END").alias("result"))
    return events.withColumn("convert_status", ct.result_status(F.col("result"))).drop("result")


def old_status(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey % 2 = 0").select(
        F.expr("concat('ds-', c_custkey)").alias("dataset_uuid"),
        F.lit(ct.PROCESSING).alias("convert_status"),
        F.expr("concat('old ', c_custkey)").alias("update_message"),
        F.lit(None).cast("string").alias("convert_path"),
        F.lit(-1).cast("long").alias("updated_at"),
    )


@query("status_upsert", STATUS_SQL)
def _status(t: Tables) -> DataFrame:
    return ct.status_upsert(old_status(t), status_events(t))


@query(
    "unique_check",
    f"""WITH {_REG}, r AS (SELECT device_model, end_effector_type, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE dataset_uuid END AS dataset_uuid FROM reg)
SELECT 'unique' AS rule, 'device_model,end_effector_type' AS columns, device_model || '|' || end_effector_type AS value, count(*) AS rows FROM r GROUP BY device_model, end_effector_type HAVING count(*) > 1
UNION ALL SELECT 'not_null', 'dataset_uuid', NULL, count(*) FROM r WHERE dataset_uuid IS NULL HAVING count(*) > 0""",
)
def _unique(t: Tables) -> DataFrame:
    reg = registry(t).select(
        F.col("device_model")[0].alias("device_model"),
        "end_effector_type",
        F.when(F.col("s_suppkey") % 10 > 0, F.col("dataset_uuid")).alias("dataset_uuid"),
    )
    return ct.violations(reg, [["dataset_uuid"], ["device_model", "end_effector_type"]], ["dataset_uuid", "device_model"])


@query(
    "unique_check_batch",
    """WITH b AS (SELECT o_custkey, CASE WHEN o_orderkey % 11 > 0 THEN o_orderpriority END AS p FROM orders WHERE o_orderkey % 40 = 0),
t AS (SELECT o_custkey, CASE WHEN o_orderkey % 11 > 0 THEN o_orderpriority END AS p FROM orders WHERE o_orderkey % 40 > 0),
k AS (SELECT DISTINCT o_custkey, p FROM b WHERE p IS NOT NULL)
SELECT 'unique' AS rule, 'o_custkey,o_orderpriority' AS columns, o_custkey || '|' || p AS value, count(*) AS rows
FROM (SELECT * FROM b UNION ALL SELECT * FROM t) JOIN k USING (o_custkey, p) GROUP BY o_custkey, p HAVING count(*) > 1""",
)
def _unique_batch(t: Tables) -> DataFrame:
    """A fortieth of the orders as new rows, against all others."""
    priority = F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderpriority")).alias("o_orderpriority")
    rows = t.orders.select("o_orderkey", "o_custkey", priority)
    return ct.batch_violations(rows.where("o_orderkey % 40 = 0"), rows.where("o_orderkey % 40 > 0"), ["o_custkey", "o_orderpriority"])


# a neutral template; a user passes the defaults of their own
DEFAULTS = {
    "license": "apache-2.0",
    "homepage": "https://example.org/",
    "paper": "none",
    "config_name": "default",
    "data_files": "data/*/*.parquet",
}


def _generated(t: Tables) -> DataFrame:
    """Totals and tasks of a supplier's lines; some records lack a field."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("frames_num"), F.count_distinct("l_orderkey").alias("episodes_num"))
    reg = registry(t).join(per, F.col("l_suppkey") == F.col("s_suppkey"))
    return reg.select(
        "s_suppkey",
        "dataset_name",
        "frames_num",
        "episodes_num",
        size_label(F.col("frames_num")).alias("size_categories"),
        F.expr("CASE WHEN s_suppkey % 4 = 0 THEN 'cc-by-4.0' END").alias("license"),
        F.concat(F.lit("sort "), "scene_type").alias("tasks"),
        F.concat(F.lit("grasp with "), "end_effector_type").alias("sub_tasks"),
    )


def _merged(t: Tables) -> DataFrame:
    tags = t.part.where("p_partkey % 3 > 0").select(
        F.format_string("Supplier#%09d", "p_partkey").alias("dataset_name"), tg.tag_map(F.expr(_TAG_TEXT)).alias("dataset_tags")
    )
    return ct.merge_info(_generated(t), {k: F.lit(v) for k, v in DEFAULTS.items()}, tags)


_GEN = f"""per AS (SELECT l_suppkey, count(*) AS frames_num, count(DISTINCT l_orderkey) AS episodes_num FROM lineitem GROUP BY 1),
gen AS (SELECT s_suppkey, dataset_name, frames_num, episodes_num, CASE WHEN frames_num < 1000 THEN '<1K' WHEN frames_num < 10000 THEN '1K-10K' ELSE '10K-100K' END AS size_categories,
 CASE WHEN s_suppkey % 4 = 0 THEN 'cc-by-4.0' ELSE 'apache-2.0' END AS license, 'sort ' || scene_type AS tasks, 'grasp with ' || end_effector_type AS sub_tasks FROM reg JOIN per ON l_suppkey = s_suppkey)"""


@query(
    "info_merge",
    f"""WITH {_REG}, {_GEN} SELECT g.s_suppkey, g.dataset_name, frames_num, episodes_num, size_categories, license, 'https://example.org/' AS homepage, tasks, sub_tasks,
 CASE WHEN p.p_partkey IS NOT NULL THEN CASE WHEN p_partkey % 5 = 0 THEN '7' ELSE CAST(p_size AS VARCHAR) END END AS size_tag,
 CASE WHEN p.p_partkey IS NOT NULL THEN 4 ELSE 0 END AS tag_count FROM gen g LEFT JOIN part p ON p.p_partkey = g.s_suppkey AND p.p_partkey % 3 > 0""",
)
def _info(t: Tables) -> DataFrame:
    return _merged(t).select(
        "s_suppkey",
        "dataset_name",
        "frames_num",
        "episodes_num",
        "size_categories",
        "license",
        "homepage",
        "tasks",
        "sub_tasks",
        F.get(F.col("dataset_tags")["size"], F.lit(0)).alias("size_tag"),
        F.size("dataset_tags").alias("tag_count"),
    )


@query(
    "card_render",
    f"""WITH {_REG}, {_GEN} SELECT dataset_name, '---
license: ' || license || '
language:
  - en
  - zh
task_categories:
  - robotics
tags:
  - ' || size_categories || '
  - recorded
size_categories: ' || size_categories || '
configs:
- config_name: default
  data_files: data/*/*.parquet
---

## Dataset Authors
This dataset is contributed by [[' || dataset_name || '](https://example.org/' || s_suppkey || '), [second](https://example.org/second)]

This dataset is annotated by [[' || dataset_name || '](https://example.org/' || s_suppkey || ')]

## Dataset Description
About ' || dataset_name || '

- **Homepage:** https://example.org/
- **Paper:** none
- **License:** ' || license || '

## Dataset Tags

- ' || size_categories || '

- recorded


## Task Descriptions
### tasks
' || tasks || '

### sub_tasks
' || sub_tasks || '

## Dataset Structure

[meta/info.json](meta/info.json):
```json
{{"total_episodes":' || episodes_num || ',"total_frames":' || frames_num || '}}
```

## Citation
```bibtex

```' AS card FROM gen""",
)
def _card(t: Tables) -> DataFrame:
    own = F.struct(F.col("dataset_name").alias("name"), F.concat(F.lit("https://example.org/"), "s_suppkey").alias("url"))
    second = F.struct(F.lit("second").alias("name"), F.lit("https://example.org/second").alias("url"))
    fields = {c: F.col(c) for c in ["license", "size_categories", "config_name", "data_files", "homepage", "paper", "tasks", "sub_tasks"]}
    fields |= {
        "language": F.array(F.lit("en"), F.lit("zh")),
        "task_categories": F.array(F.lit("robotics")),
        "tags": F.array(F.col("size_categories"), F.lit("recorded")),
        "contributed_by": F.array(own, second),
        "annotated_by": F.array(own),
        "dataset_description": F.concat(F.lit("About "), "dataset_name"),
        "meta_info": F.to_json(F.struct(F.col("episodes_num").alias("total_episodes"), F.col("frames_num").alias("total_frames"))),
        "citation_bibtex": F.lit(None).cast("string"),
    }
    return _merged(t).select("dataset_name", rc.card_text(fields).alias("card"))
