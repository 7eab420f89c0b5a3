"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Every source gets a target number of words. The document rates that stay closest (in relative
entropy, rates bounded by ``CAP``) to equal rates and meet the target are tilted exponentially
by document size: rate = CAP * sigmoid(log(1 / (CAP - 1)) + t * size / mean), one t for each
source. Newton iterations on the convex dual find all t at once, each iteration one aggregate
over the (source, size) histogram. Rates become copies by systematic rounding in the order of
size: running totals of the fractions never differ by a whole document from the copies, so a
source misses its target by about its longest document at most. Of several starts of the
rounding the one that misses it least is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.llm.common import SPACE, Stored, join_on, stored
from kinetable.operators.ordered import number_rows

#: copies of a document at most, and words of a source at most as a multiple of what it has
CAP = 3
#: weights of the sources in the order of their names, repeating
WEIGHTS = (1, 2, 3)
MAX_STEPS, TOLERANCE = 60, 1e-10
#: starts of the rounding that are tried for each source
STARTS = 64
#: documents of one source and size are ranked in so many parts
PARTS = 1024


def word_count(text: Column) -> Column:
    """Number of stretches without ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight, stopped at CAP times the size.

    Weights go round in the order of the source's code points, null last. What a stopped source
    leaves is shared among the others by weight until none is above its limit.
    """
    named = stored(sources.withColumn("_null", F.col("source").isNull()), "mixing")
    ranked = number_rows(named, [], ["_null", "source"], "_rank", stored=True).drop("_null")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    state = stored(
        ranked.select("source", "source_size", F.get(weights, F.pmod(F.col("_rank"), F.lit(len(WEIGHTS))).cast("int")).alias("w"), F.lit(False).alias("full")),
        "mixing",
    )
    limit = F.col("source_size") * F.lit(float(CAP))
    while True:
        full = F.sum(F.when(F.col("full"), limit).otherwise(0.0)).alias("full")
        sums = state.agg(F.sum("source_size").alias("all"), full, F.sum(F.when(~F.col("full"), F.col("w"))).alias("open")).first()
        share = ((sums["all"] or 0) - (sums["full"] or 0.0)) / sums["open"] if sums["open"] else 0.0
        over = ~F.col("full") & (F.col("w") * F.lit(float(share)) > limit)
        if not sums["open"] or state.where(over).isEmpty():
            target = F.when(F.col("full"), limit).otherwise(F.col("w") * F.lit(float(share)))
            return state.select("source", "source_size", target.alias("target"))
        state = stored(state.withColumn("full", F.col("full") | over), "mixing")


def _rate(tilt: Column, x: Column) -> Column:
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt * x))
    return F.lit(float(CAP)) / (F.lit(1.0) + F.lit(float(CAP - 1)) * F.exp(-z))


def balance(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, size, n, rate) from the histogram (source, size, n) and (source, source_size, target).

    The dual of a source is one-dimensional and convex; a Newton step that leaves the bracket
    known so far is replaced by its middle. Sources at their limit get CAP, empty ones 0.
    """
    sized = join_on(histogram.where("size > 0"), goals, ["source"], nulls=("source",))
    mean = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    sized = join_on(sized, mean, ["source"], nulls=("source",)).withColumn("x", F.col("size") / F.col("mean"))
    sized = stored(sized.select("source", "size", "n", "x", (F.col("target") / F.col("mean")).alias("goal")), "mixing")
    # goals (in mean documents) below the limit; at it every rate is CAP
    sums = sized.groupBy("source").agg(F.sum(F.col("n") * F.col("x")).alias("has"), F.first("goal").alias("goal"))
    open_ = (F.col("goal") > 0) & (F.col("goal") < CAP * F.col("has") * (1 - 1e-12))
    first = sums.select("source", "goal", open_.alias("open"), F.lit(0.0).alias("t"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"), F.lit(1.0).alias("miss"))
    state = Stored(first, "mixing")
    for _ in range(MAX_STEPS):
        if state.df.where(F.col("open") & (F.abs("miss") > TOLERANCE)).isEmpty():
            break
        at = join_on(sized.drop("goal"), state.df.where("open").select("source", "t"), ["source"], nulls=("source",))
        rate = _rate(F.col("t"), F.col("x"))
        weight = F.col("n") * F.col("x")
        step = at.groupBy("source").agg(F.sum(weight * rate).alias("got"), F.sum(weight * F.col("x") * rate * (1 - rate / CAP)).alias("slope"))
        joined = join_on(state.df, step, ["source"], "left", nulls=("source",))
        gap = F.col("got") - F.col("goal")
        low, high = F.when(gap < 0, F.col("t")).otherwise(F.col("low")), F.when(gap > 0, F.col("t")).otherwise(F.col("high"))
        joined = joined.withColumns({"_low": low, "_high": high, "_newton": F.when(F.col("slope") > 0, F.col("t") - gap / F.col("slope")), "_miss": gap / F.col("goal")})
        inside = (F.col("_newton") > F.col("_low")) & (F.col("_newton") < F.col("_high"))
        moved = F.when(F.abs("_miss") <= TOLERANCE, F.col("t")).when(inside, F.col("_newton")).otherwise((F.col("_low") + F.col("_high")) / 2)
        # sources without a step keep their state
        keep = lambda new, old: F.when(F.col("got").isNull(), F.col(old)).otherwise(new).alias(old)
        after = joined.select("source", "goal", "open", keep(moved, "t"), keep(F.col("_low"), "low"), keep(F.col("_high"), "high"), keep(F.col("_miss"), "miss"))
        after = Stored(after, "mixing")
        state.drop()
        state = after
    tilts = state.df.select("source", "open", "t", F.col("goal").alias("_goal"))
    rated = join_on(sized, tilts, ["source"], nulls=("source",))
    rate = F.when(F.col("_goal") <= 0, F.lit(0.0)).when(F.col("open"), _rate(F.col("t"), F.col("x"))).otherwise(F.lit(float(CAP)))
    return rated.select("source", "size", "n", rate.alias("rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, source, hash, size, source_size, target, copies, taken), one row per row of ``docs``.

    ``copies`` says how often the mix takes the row. Null texts have size 0 and are not taken.
    Rows that repeat id and text are ranked in any order among each other. Only ids and numbers
    are shuffled; a hot source spreads over its sizes and PARTS.
    """
    sizes = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("hash"), word_count(F.col(text)).alias("size"))
    rows = stored(sizes, "mixing")
    part = F.pmod(F.xxhash64("id", "hash"), F.lit(PARTS)).alias("part")
    cells = stored(rows.groupBy("source", "size", part).agg(F.count(F.lit(1)).alias("n")), "mixing")
    histogram = stored(cells.groupBy("source", "size").agg(F.sum("n").alias("n")), "mixing")
    goals = stored(targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "mixing")
    rated = stored(balance(histogram, goals), "mixing")

    # copies beyond the whole ones of each (source, size), by running totals in the order of size
    base = F.floor(F.col("rate") + 1e-9)
    extra = F.greatest(F.col("rate") - base, F.lit(0.0)) * F.col("n")
    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(extra).over(before), F.lit(0.0))
    running = rated.select("source", "size", "n", base.alias("base"), total.alias("_from"), (total + extra).alias("_to"))
    # where the rounding starts is free: of STARTS places the one whose words come nearest to the target
    tried = running.withColumn("_start", F.explode(F.sequence(F.lit(0), F.lit(STARTS - 1))))
    at = F.col("_start") / F.lit(float(STARTS))
    words = F.sum((F.col("base") * F.col("n") + F.floor(F.col("_to") + at) - F.floor(F.col("_from") + at)) * F.col("size"))
    sums = join_on(tried.groupBy("source", "_start").agg(words.alias("_words")), goals.drop("source_size"), ["source"], nulls=("source",))
    best = sums.groupBy("source").agg(F.min_by("_start", F.struct(F.abs(F.col("_words") - F.col("target")), "_start")).alias("_best"))
    whole = join_on(running, best, ["source"], nulls=("source",)).withColumn("_at", F.col("_best") / F.lit(float(STARTS)))
    more = F.floor(F.col("_to") + F.col("_at")) - F.floor(F.col("_from") + F.col("_at"))
    whole = whole.select("source", "size", "base", more.alias("more"))
    # then by rank: parts first, then rows inside a part
    ahead = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cells.select("source", "size", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    plan = join_on(join_on(parts, whole, ["source", "size"], nulls=("source",)), goals, ["source"], nulls=("source",))
    inside = Window.partitionBy("source", "size", "part").orderBy("id", "hash")
    ranked = rows.withColumn("part", part).withColumn("_rank", F.row_number().over(inside))
    taken = join_on(ranked, plan, ["source", "size", "part"], "left", nulls=("source",)).drop("source_size", "target")
    copies = F.coalesce(F.col("base") + F.when(F.col("_rank") + F.col("offset") <= F.col("more"), 1).otherwise(0), F.lit(0)).cast("int")
    named = join_on(taken.withColumn("copies", copies), goals, ["source"], "left", nulls=("source",))
    return named.select("id", "source", "hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with their columns."""
    found = mix(docs, id_col, text, source)
    copies = stored(found.groupBy("id", "source", "hash").agg(F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).alias("_rows")), "mixing")
    marked = docs.withColumns({"_id": F.col(id_col), "_source": F.col(source), "_hash": F.xxhash64(text)})
    if not copies.where("_rows > 1").isEmpty():
        # rows that repeat id, source and text are one row here: it is taken as often as all of them
        marked = marked.dropDuplicates(["_id", "_source", "_hash"])
    copies = copies.where("_copies > 0").select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("hash").alias("_hash"), "_copies")
    joined = join_on(marked, copies, ["_id", "_source", "_hash"], nulls=("_id", "_source"))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
