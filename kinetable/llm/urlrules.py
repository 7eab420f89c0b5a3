"""URL filters by explicit rules and mined association rules; DataFrame functions and Spark ML only.

Explicit rules name a host and a path. For URLs that none of them fits, FP-growth mines
combinations of URL tokens from labelled pages; rules with enough support and confidence are
kept. A mined rule is found by an inverted index on its rarest token and then verified.

An antecedent holds one word of the host, one segment of the path and one query key at most, besides
scheme, top-level label and fragment. That bounds it by six tokens, so neither deep paths nor long
queries make combinations without end: each URL is mined as one basket for each choice of the three,
and a combination counts in the baskets that chose just its tokens, once for each URL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import stored

#: labelled URLs in which a combination must occur, whatever their number; share of them that must have the label
MIN_COUNT, MIN_CONFIDENCE = 20, 0.9
#: a longer rule must beat the confidence of every shorter one inside it by so much
LIFT = 0.01
DEFAULT = "allow"
_LABEL = "label="


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to / ? # or the end; then up to ? or #. Empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://((?s:.*))$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the longest that fits, else null) and _decided (its verdict).

    ``rules`` are (``host/path``, verdict). A rule fits its host and all subdomains when the path
    starts with the rule's; of equally long ones the first by code point wins. The list is small
    and part of the plan.
    """
    host, path = url_parts(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # tried from the shortest to the longest, so the outermost test is that of the longest
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        own_host, _, rest = text.partition("/")
        own_host = own_host.lower()
        fits = ((F.col("host") == own_host) | F.col("host").endswith("." + own_host)) & F.col("path").startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return out.withColumns({"rule": rule, "_decided": verdict})


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, host suffixes and labels, path segments with digits generalised, query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    shapes = F.transform(segments, lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1)))
    scheme = F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))
    # the public suffix label tells apart what the words of the host share
    last = F.concat(F.lit("top="), F.element_at(labels, -1))
    words = F.transform(F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0))), lambda x: F.concat(F.lit("host="), x))
    tail = F.when(F.size(labels) > 0, F.array(last)).otherwise(F.array().cast("array<string>"))
    fragment = F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(F.array(scheme), tail, words, shapes, keys, fragment)))


#: kinds of tokens of which an antecedent holds one at most
KINDS = ("host=", "path=", "query=")
MAX_TOKENS = 6


def _of_kind(kind: str):
    return lambda token: F.startswith(token, F.lit(kind))


def baskets_of(labelled: DataFrame, min_count: int) -> DataFrame:
    """(view, items) of (tokens, verdict): a basket for each choice of a host word, a path segment and a query key, or none.

    The view names the kinds that were chosen and is part of every item, so combinations of different
    views never meet. Tokens below the count cannot be in a rule and are left out first.
    """
    rows = labelled.where(F.size("tokens") > 0).withColumn("_row", F.monotonically_increasing_id())
    rows = stored(rows.select("_row", "tokens", "verdict"), "urlrules")
    often = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    kept = rows.select("_row", "verdict", F.explode("tokens").alias("token")).join(often.select("token"), "token", "left_semi")
    kept = kept.groupBy("_row").agg(F.first("verdict").alias("verdict"), F.collect_set("token").alias("tokens"))
    one = F.lit(None).cast("string")
    for i, kind in enumerate(KINDS):
        own = F.filter("tokens", _of_kind(kind))
        kept = kept.withColumn(f"_own{i}", F.array_append(own, one))
    kept = kept.withColumn("_rest", F.filter("tokens", lambda t: ~t.rlike("^(" + "|".join(KINDS) + ")")))
    for i in range(len(KINDS)):
        kept = kept.withColumn(f"_one{i}", F.explode(f"_own{i}"))
    view = F.concat(*[F.when(F.col(f"_one{i}").isNull(), "").otherwise(kind[0]) for i, kind in enumerate(KINDS)], F.lit("|"))
    items = F.array_append(F.concat("_rest", F.array_compact(F.array(*[F.col(f"_one{i}") for i in range(len(KINDS))]))), F.concat(F.lit(_LABEL), "verdict"))
    return kept.select(view.alias("view"), items.alias("items")).select("view", F.transform("items", lambda t: F.concat("view", t)).alias("items"))


def mine(labelled: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, tokens, size, verdict, confidence, anchor) mined from (tokens, verdict).

    A rule's tokens occur together in ``min_count`` labelled URLs with its verdict, which is a number of
    rows and not a share: a site that is mined in a small table is mined in a large one. A rule stays
    when no rule with fewer of its tokens gives the same verdict with nearly the same confidence. The
    anchor is the token of the rule that is rarest among the labelled URLs.
    """
    spark = labelled.sparkSession
    baskets = stored(baskets_of(labelled, min_count), "urlrules")
    count = baskets.count()
    if not count:
        rules = spark.createDataFrame([], "tokens array<string>, size int, verdict string, confidence double")
    else:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / count, minConfidence=min_confidence, numPartitions=partitions).fit(baskets.select("items"))
        result = F.col("consequent")[0]
        view = F.substring_index(result, "|", 1)
        bare = lambda item: F.substring(item, F.length(view) + 2, F.length(item))
        found = model.associationRules.select(
            F.sort_array(F.transform("antecedent", bare)).alias("tokens"), view.alias("view"), bare(result).alias("_verdict"), "confidence"
        )
        found = found.where(F.startswith("_verdict", F.lit(_LABEL)) & ~F.exists("tokens", lambda t: F.startswith(t, F.lit(_LABEL))))
        # a combination counts in the view that chose just its kinds
        whole = [F.exists("tokens", _of_kind(kind)) == F.contains("view", F.lit(kind[0])) for kind in KINDS]
        found = found.where(whole[0] & whole[1] & whole[2])
        rules = found.select("tokens", F.size("tokens").alias("size"), F.substring("_verdict", len(_LABEL) + 1, 1000).alias("verdict"), "confidence")
    rules = stored(rules.withColumn("rule_id", F.xxhash64("tokens", "verdict")), "urlrules")
    # rules that a part of them makes needless: each names its parts, at most 2 ** MAX_TOKENS, and looks them up
    places = F.sequence(F.lit(0), F.lit(MAX_TOKENS - 1))
    masks = F.sequence(F.lit(1), F.expr("cast(shiftleft(1, size) - 2 AS int)"))
    parts = rules.where("size > 1").select("rule_id", "tokens", "verdict", "confidence", F.explode(masks).alias("_mask"))
    inside = F.filter(F.transform(places, lambda i: F.when(F.getbit("_mask", i) == 1, F.get("tokens", i))), lambda t: t.isNotNull())
    parts = parts.select("rule_id", "confidence", F.xxhash64(inside, "verdict").alias("_part"))
    known = rules.select(F.col("rule_id").alias("_part"), F.col("confidence").alias("_confidence"))
    needless = parts.join(known, "_part").where(F.col("confidence") < F.col("_confidence") + LIFT).select("rule_id").distinct()
    pruned = rules.join(needless, "rule_id", "left_anti")
    frequency = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    anchors = pruned.select("rule_id", F.explode("tokens").alias("token")).join(frequency, "token")
    anchors = anchors.groupBy("rule_id").agg(F.min_by("token", F.struct("n", "token")).alias("anchor"))
    return stored(pruned.join(anchors, "rule_id"), "urlrules")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url: str = "url", min_count: int = MIN_COUNT) -> DataFrame:
    """(id, host, path, rule, verdict), one row per row of ``pages``; only the id and the url are read.

    ``labels`` are (id, verdict) of some pages, one row per id; rows with a null are left out.
    The verdict is the explicit rule's, else that of the mined rule with the highest confidence
    (ties: more tokens, then block, then the tokens in order), else ``allow``. Only distinct token
    sets are matched, not every page.
    """
    own = with_rule(pages.select(F.col(id_col).alias("id"), F.col(url).alias("url")), rules)
    own = own.select("id", "host", "path", "rule", "_decided", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    own = stored(own, "urlrules")
    known = labels.where(F.col("id").isNotNull() & F.col("verdict").isNotNull())
    mined = mine(own.join(known, "id").select("tokens", "verdict"), min_count)
    # the open URLs by their different token sets
    key = F.xxhash64("tokens")
    open_ = own.where(F.col("_decided").isNull()).groupBy(key.alias("key")).agg(F.first("tokens").alias("tokens"))
    index = mined.select(F.col("anchor").alias("token"), F.col("tokens").alias("_rule"), "size", "verdict", "confidence")
    matched = open_.select("key", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    matched = matched.where(F.size(F.array_except("_rule", "tokens")) == 0)
    order = F.struct(-F.col("confidence"), -F.col("size"), F.when(F.col("verdict") == "block", 0).otherwise(1), F.array_join("_rule", "\n"))
    # stored, so that the join below is a plain one, whose hot keys Spark can split
    best = stored(matched.groupBy("key").agg(F.min_by("verdict", order).alias("_mined")), "urlrules")
    joined = own.withColumn("key", key).join(best, "key", "left")
    return joined.select("id", "host", "path", "rule", F.coalesce("_decided", "_mined", F.lit(DEFAULT)).alias("verdict"))
