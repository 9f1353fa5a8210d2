"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Targets. Sources, ordered by code point with null last, weigh 3, 1, 2 and again; together they
share ``budget`` times all words. A target stops at ``cap`` times its source's words and the
excess is shared again by weight: a water level over the sources sorted by cap / weight.

Balancing. Each document may be taken 0..cap times; with no constraint each would be taken ``budget``
times. Of all document rates that meet a source's token constraint the ones nearest to that, in
entropy, are the exponential tilt ``cap * p``, ``p = 1 / (1 + exp(-(a + l * z)))``: a is the logit of
budget / cap, z the document's size over the mean size of its source, l the source's multiplier. So
a source that must give less gives up its long documents first, one that must give more takes them
more often, and the rate is a document's own. The dual ``sum(cap * log(1 + exp(a + l * z))) - l *
target / mean`` is convex in l. Newton steps run for all sources at once; a step sums gradient and
Hessian over the documents (gathered into counts of equal sizes first, which are the same sums),
and one that leaves the bracket of the gradient's signs is halved into it. Steps end when every
source is within ``TOLERANCE`` of its target, a check of one number.

Rounding. A rate r becomes floor(r) copies of its document, and one more for those with the least
``u - (r - floor(r))``, u being a hash of doc_id in [0, 1), up to the point where their words come
nearest to what is still due. The point is found by two levels of 256 ranges and then inside one
range of 1/65536, so no task meets a whole source. Two passes then flip the one document whose
size best cancels the source's remaining error.

Edge cases: a null source is a source; null or empty texts have size 0 and are taken 0 words;
repeated rows share a hash and are rounded alike; rows with a null doc_id hash as the empty text
and do too; a table without words has targets 0; an empty table gives none; other columns of any name
pass through ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
NEWTON_STEPS = 96
STEPS_A_JOB = 4
TOLERANCE = 1e-9
FLIPS = 2


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key) of every row, written once; the texts are read only here."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return cut_lineage(docs.select("doc_id", "source", words.alias("size"), key.alias("key")))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(source, source_size, target), one row a source; the windows run over that table alone."""
    table = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = table.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    due = F.sum("source_size").over(everything) * F.lit(budget)
    # with all smaller levels capped, what the others get for each unit of weight
    level = (due - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = weighed.withColumn("level", level).withColumn("order", F.row_number().over(by_level))
    is_open = F.col("most") / F.col("weight") > F.col("level")
    first_open = F.min(F.when(is_open, F.struct("order", "level"))).over(everything)["level"]
    target = F.least(F.col("most"), F.col("weight") * F.coalesce(first_open, F.lit(float("inf"))))
    return levels.select("source", "source_size", target.alias("target"))


def _tilted(z: Column, multiplier: Column, budget: float, cap: int) -> Column:
    """The share p of the cap that a document of relative size ``z`` gets."""
    share = min(max(budget / cap, 1e-6), 1 - 1e-6)
    return F.lit(1.0) / (F.lit(1.0) + F.lit((1 - share) / share) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -multiplier * z))))


def _newton_step(sizes: DataFrame, plan: DataFrame, budget: float, cap: int) -> DataFrame:
    """``plan`` (source, source_size, target, mean, l, low, high, gap) after one damped step of every source."""
    names = ["source", "source_size", "target", "mean", "l", "low", "high"]
    met = sizes.alias("d").join(plan.alias("p"), _same_source("d", "p"))
    p = _tilted(F.col("d.z"), F.col("p.l"), budget, cap)
    n, z = F.col("d.n") * F.lit(float(cap)), F.col("d.z")
    sums = met.groupBy(*[F.col(f"p.{c}").alias(c) for c in names]).agg(F.sum(n * z * p).alias("_taken"), F.sum(n * z * z * p * (F.lit(1.0) - p)).alias("_hessian"))
    gradient = F.col("_taken") - F.col("target") / F.col("mean")
    low = F.when(gradient < 0, F.col("l")).otherwise(F.col("low"))
    high = F.when(gradient > 0, F.col("l")).otherwise(F.col("high"))
    sums = sums.withColumns({"_gradient": gradient, "low": low, "high": high})
    step = F.col("l") - F.col("_gradient") / F.greatest(F.col("_hessian"), F.lit(1e-300))
    wide = F.when(F.col("_gradient") > 0, F.col("l") - F.lit(1.0) - F.abs("l")).otherwise(F.col("l") + F.lit(1.0) + F.abs("l"))
    halved = F.when(F.col("low").isNull() | F.col("high").isNull(), wide).otherwise((F.col("low") + F.col("high")) / 2)
    inside = (step > F.coalesce("low", F.col("l") - F.lit(1.0) - F.abs("l"))) & (step < F.coalesce("high", F.col("l") + F.lit(1.0) + F.abs("l")))
    gap = F.abs(F.col("_gradient")) * F.col("mean") / F.col("source_size")
    moved = F.when(gap <= TOLERANCE, F.col("l")).when(inside, step).otherwise(halved)
    return sums.select("source", "source_size", "target", "mean", moved.alias("l"), "low", "high", gap.alias("gap"))


def balanced(rows: DataFrame, targets: DataFrame, budget: float = BUDGET, cap: int = CAP, steps: int = NEWTON_STEPS) -> DataFrame:
    """``targets`` with ``mean`` and the multiplier ``l`` of each source; null where all of it is taken ``cap`` times, or none."""
    sizes = rows.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    table = sizes.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    share = F.try_divide(F.col("t.target"), F.col("t.source_size") * F.lit(float(cap)))
    free = (share > 1e-9) & (share < 1 - 1e-9)
    every = targets.alias("t").join(table.alias("m"), _same_source("t", "m"), "left").select("t.*", "m.mean", F.coalesce(free, F.lit(False)).alias("free"))
    every = cut_lineage(every)
    nothing = F.lit(None).cast("double")
    plan = every.filter("free").select("source", "source_size", "target", "mean", F.lit(0.0).alias("l"), nothing.alias("low"), nothing.alias("high"), nothing.alias("gap"))
    sizes = cut_lineage(sizes.alias("d").join(table.alias("m"), _same_source("d", "m")).select("d.source", "d.n", (F.col("d.size") / F.col("m.mean")).alias("z")))
    for _ in range(0, steps, STEPS_A_JOB):
        for _ in range(STEPS_A_JOB):
            plan = _newton_step(sizes, plan, budget, cap)
        plan = cut_lineage(plan)
        if (plan.agg(F.max("gap")).first()[0] or 0.0) <= TOLERANCE:
            break
    # rounded, so that the order of a sum cannot show in the rates
    solved = plan.select("source", F.round("l", 9).alias("l"))
    return every.alias("t").join(solved.alias("p"), _same_source("t", "p"), "left").select("t.source", "t.source_size", "t.target", "t.mean", "p.l")


def rated(rows: DataFrame, multipliers: DataFrame, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``rows`` with their ``rate``, ``base`` (its whole copies) and a ``key`` that orders them for the one more."""
    met = rows.alias("r").join(multipliers.alias("p"), _same_source("r", "p"))
    tilt = _tilted(F.col("r.size") / F.col("p.mean"), F.col("p.l"), budget, cap) * F.lit(float(cap))
    edge = F.when(F.coalesce(F.col("p.target"), F.lit(0.0)) > 0, F.lit(float(cap))).otherwise(F.lit(0.0))
    rate = F.when(F.col("p.l").isNull(), edge).otherwise(tilt)
    out = met.select("r.doc_id", "r.source", "r.size", F.col("r.key").alias("_hash"), rate.alias("rate"))
    out = out.withColumn("base", F.floor(F.col("rate") + F.lit(1e-9)))
    u = F.conv(F.substring("_hash", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    late = (u - (F.col("rate") - F.col("base")) + F.lit(1.0)) / F.lit(2.0)
    place = F.lpad(F.hex(F.floor(F.greatest(F.lit(0.0), F.least(late, F.lit(1.0))) * F.lit(float((1 << 48) - 1))).cast("long")), 12, "0")
    return out.select("doc_id", "source", "size", "rate", "base", F.concat(F.lower(place), F.col("_hash")).alias("key"))


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def _cut(sums: DataFrame, plan: DataFrame, due: str, part: str) -> DataFrame:
    """``plan`` with the range ``part`` in which the running words reach ``due``, and ``due`` from there."""
    running = Window.partitionBy("source").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("_before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    met = placed.alias("s").join(plan.alias("p"), _same_source("s", "p")).filter(F.col("_before") <= F.col(due))
    last = met.groupBy(F.col("s.source").alias("source")).agg(F.max(F.struct(part, "_before")).alias("_at"))
    return (
        plan.alias("p")
        .join(last.alias("l"), _same_source("p", "l"), "left")
        .select("p.*", F.col(f"_at.{part}").alias(part), (F.col(due) - F.col("_at._before")).alias(f"{due}_{part}"))
    )


def _thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``upto``: documents with a key up to it get the extra copy (null: none does)."""
    rows = rows.select("source", "size", "key", F.substring("key", 1, 2).alias("b1"), F.substring("key", 3, 2).alias("b2"))
    first = rows.groupBy("source", "b1").agg(F.sum("size").alias("words"))
    plan = _cut(first, plan, "due", "b1")
    inside = rows.alias("r").join(plan.alias("p"), _same_source("r", "p") & (F.col("r.b1") == F.col("p.b1")))
    inside = inside.select("r.source", "r.size", "r.key", "r.b2")
    second = inside.groupBy("source", "b2").agg(F.sum("size").alias("words"))
    plan = _cut(second, plan, "due_b1", "b2")
    near = inside.alias("r").join(plan.alias("p"), _same_source("r", "p") & (F.col("r.b2") == F.col("p.b2")))
    near = near.groupBy(F.col("r.source").alias("source"), F.col("r.key").alias("key"), F.col("p.due_b1_b2").alias("left")).agg(F.sum("r.size").alias("words"))
    running = Window.partitionBy("source").orderBy("key")
    near = near.withColumn("upto_words", F.sum("words").over(running))
    # a key joins if that brings the running words nearer to what is left
    taken = near.filter(F.col("upto_words") - F.col("words") / 2.0 <= F.col("left")).groupBy("source").agg(F.max("key").alias("key_in"))
    # if none of the range joins, all smaller ranges still do
    return (
        plan.alias("p")
        .join(taken.alias("t"), _same_source("p", "t"), "left")
        .select("p.source", "p.source_size", "p.target", F.coalesce("t.key_in", F.concat("p.b1", "p.b2")).alias("upto"))
    )


def _counted(rows: DataFrame, plan: DataFrame, cap: int) -> DataFrame:
    extra = F.coalesce((F.col("key") <= F.col("upto")).cast("long"), F.lit(0))
    copies = F.least(F.col("base") + extra, F.lit(cap).cast("long"))
    joined = rows.alias("r").join(plan.alias("p"), _same_source("r", "p"))
    return joined.select("r.doc_id", "r.source", "r.size", "r.key", "p.source_size", "p.target", copies.alias("copies"))


def _flip(counted: DataFrame, cap: int) -> DataFrame:
    """Moves one document of each source by one copy if that brings the source nearer to its target."""
    error = counted.groupBy("source").agg((F.sum(F.col("copies") * F.col("size")) - F.first("target")).alias("over"))
    over = F.col("over")
    fits = F.when(over > 0, F.col("copies") > 0).otherwise(F.col("copies") < cap) & (F.col("size") < 2 * F.abs(over)) & (F.col("size") > 0)
    near = counted.alias("c").join(error.alias("e"), _same_source("c", "e")).filter(fits)
    # rows that share a key move together, so only keys of one row may move
    single = near.groupBy(F.col("c.source").alias("source"), "key", "over").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")).filter("n = 1")
    pick = single.groupBy("source", "over").agg(F.min(F.struct(F.abs(F.col("size") - F.abs(over)).alias("gap"), "key")).alias("best"))
    pick = pick.select("source", F.col("best.key").alias("key"), F.when(over > 0, -1).otherwise(1).alias("move"))
    joined = counted.alias("c").join(pick.alias("e"), _same_source("c", "e") & (F.col("c.key") == F.col("e.key")), "left")
    return joined.select("c.doc_id", "c.source", "c.size", "c.key", "c.source_size", "c.target", (F.col("copies") + F.coalesce("move", F.lit(0))).alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row; ``copies`` is 0..cap."""
    rows = sized(docs)
    targets = cut_lineage(source_targets(rows, weights, budget, cap))
    rows = cut_lineage(rated(rows, balanced(rows, targets, budget, cap), budget, cap))
    whole = rows.groupBy("source").agg(F.sum(F.col("base") * F.col("size")).alias("words"))
    due = F.greatest(F.col("p.target") - F.coalesce("w.words", F.lit(0)), F.lit(0.0))
    plan = targets.alias("p").join(whole.alias("w"), _same_source("p", "w"), "left").select("p.*", due.alias("due"))
    plan = cut_lineage(plan)
    counted = _counted(rows, cut_lineage(_thresholds(rows, plan)), cap)
    for _ in range(FLIPS):
        counted = cut_lineage(_flip(counted, cap))
    return counted.select("doc_id", "source", "size", "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    copies = mix(docs, weights, budget, cap).filter("copies > 0").select("doc_id", "source", "size", "copies").distinct()
    size = F.coalesce(F.regexp_count("d.text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & _same_source("d", "c") & (size == F.col("c.size"))
    times = F.explode(F.sequence(F.lit(1), F.col("c.copies").cast("int")))
    taken = docs.alias("d").join(copies.alias("c"), same)
    # the row as one value, so that none of its columns can clash with the copy number
    return taken.select(F.struct("d.*").alias("_row"), times.alias("_copy")).select("_row.*")
