"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Among all document rates, those closest to one copy each (in relative entropy) that give every source its target of words are
exponential in the size: rate = exp(lambda * size), at most ``cap``. One lambda a source solves the convex dual; Newton steps
find it, each step an aggregation over the sizes' histogram. Rates are then rounded into whole copies by carrying the
error from document to document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..stored import keep
from .common import materialize

WEIGHTS, TOTAL, CAP = (5, 2, 1), 1.5, 2.0
BUCKET_DOCS, STEPS, EXACT, TOLERATED = 256, 80, 1e-12, 1e-6
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key() -> Column:
    """Tells a null source from every name."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def lane_of() -> Column:
    """Equal for rows of one id, text and source, which are told apart by nothing."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"), source_key())


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source_key, size and lane of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key().alias("source_key"), size_of(F.col("text")).alias("size"), lane_of().alias("lane"))


def _exact(x: Column) -> Column:
    """A decimal, whose sums do not depend on the order of rows."""
    return x.cast("decimal(38,9)")


def targets(histogram: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """source_key, source_size, n_docs, target. Works on one row a source.

    A source's target is the lesser of ``cap`` times its size and its weight times a common level; resharing the excess by
    weight until none is above ends there. Sources are taken by the level at which they fill: the first at which all
    later ones stay below their own gives the level."""
    sources = histogram.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    name = Window.orderBy((F.col("source_key") == "n"), F.col("source_key"))  # names by code point, null last
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(name) - 1) % len(weights) + 1).cast("double"))
    filling = Window.orderBy("fills_at", "source_key")
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("fills_at", cap * F.col("source_size") / F.col("weight"))
        .withColumn("level", (total * F.sum("source_size").over(all_rows) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "source_key", "level"))).over(all_rows)["level"])
    )
    target = F.when(F.col("level").isNull() | (F.col("weight") * F.col("level") >= cap * F.col("source_size")), cap * F.col("source_size")).otherwise(F.col("weight") * F.col("level"))
    return levels.select("source_key", "source_size", "n_docs", target.cast("double").alias("target"))


def rate_of(tilt: Column, size: Column, cap: float = CAP) -> Column:
    return F.when(tilt * size >= math.log(cap), F.lit(cap)).otherwise(F.exp(F.greatest(tilt * size, F.lit(-700.0))))


def solve_tilts(histogram: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """goals with ``tilt``: the lambda at which the source's expected words meet its target.

    Expected words rise with lambda, so each step also narrows a bracket; a Newton step that leaves it is replaced by the
    bracket's middle. The histogram has a row for each source and size; lambdas are a table, joined by source."""
    words = F.greatest(F.col("source_size").cast("double"), F.lit(1.0))
    spread = histogram.groupBy("source_key").agg(F.sum(_exact(F.col("size") * F.col("size") * F.col("n").cast("double"))).cast("double").alias("squares"))
    state = goals.join(spread, "source_key").select(
        "source_key", "source_size", "n_docs", "target",
        F.lit(-700.0).alias("low"), F.lit(math.log(cap)).alias("high"),
        (F.log(F.greatest(F.col("target") / words, F.lit(1e-12))) * words / F.greatest("squares", F.lit(1.0))).alias("tilt"),
        F.lit(False).alias("done"),
    )
    state, held = keep(state.withColumn("tilt", F.when(F.col("target") >= cap * F.col("source_size"), F.lit(math.log(cap))).otherwise(F.col("tilt"))).withColumn("off", F.lit(1.0)), "tilt_0")
    for step in range(1, STEPS + 1):
        size, n = F.col("size").cast("double"), F.col("n").cast("double")
        rate = rate_of(F.col("tilt"), size, cap)
        slope = F.when(rate < cap, size * size * n * rate).otherwise(0.0)
        sums = histogram.join(state.select("source_key", "tilt"), "source_key").groupBy("source_key").agg(F.sum(_exact(size * n * rate)).cast("double").alias("mass"), F.sum(_exact(slope)).cast("double").alias("slope"))
        gap = F.col("mass") - F.col("target")
        low = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        done = F.col("done") | (F.abs(gap) <= EXACT * F.greatest(F.col("target"), F.lit(1.0))) | (F.col("target") >= cap * F.col("source_size")) | (high - low <= 1e-15 * F.abs(low))
        off = F.when(F.col("target") >= cap * F.col("source_size"), 0.0).otherwise(F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0)))
        moved = state.join(sums, "source_key").select(
            "source_key", "source_size", "n_docs", "target", low.alias("low"), high.alias("high"),
            F.when(done, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"), done.alias("done"), off.alias("off"),
        )
        before = held
        state, held = keep(moved, f"tilt_{step}")
        before.release()
        if not state.where(~F.col("done")).limit(1).count():
            break
    if missed := state.where(~F.col("done") & (F.col("off") > TOLERATED)).select("source_key", "off").take(5):
        raise ArithmeticError(f"targets not met after {STEPS} steps: {missed}")
    return state.select("source_key", "source_size", "n_docs", "target", "tilt")


def round_copies(rated: DataFrame, cap: float = CAP) -> DataFrame:
    """Whole copies for rates: within a bucket of about 256 documents of a source, from the longest to the shortest, a
    document gets as many copies (``cap`` at most) as bring the bucket's words nearest to what was expected so far. Long documents
    decide first, so what is left over at the end is about half the size of a short one.

    Rows of one lane are counted before the shuffle and rounded as one item, whose copies are then dealt evenly among them, so that
    no bucket grows with repeated rows. Gives a row a lane with its ``repeats`` and the copies of all of them."""
    distinct = rated.groupBy("source_key", "lane", "doc_id", "size", "source_size", "target", "rate", "n_docs").agg(F.count(F.lit(1)).alias("repeats"))
    bucket = F.pmod(F.col("lane"), F.ceil(F.col("n_docs") / BUCKET_DOCS))
    item = F.struct((-F.col("size")).alias("order"), "doc_id", "lane", "size", "rate", "repeats")
    groups = distinct.groupBy("source_key", "source_size", "target", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<bigint>").alias("copies"))

    def step(s: Column, x: Column) -> Column:
        words = x["size"].cast("double")
        owed = s["owed"] + F.round(x["rate"] * words * x["repeats"] * 1024) / 1024
        fit = F.when(x["size"] == 0, 0.0).otherwise(F.floor(owed / F.greatest(words, F.lit(1.0)) + 0.5))
        copies = F.least(F.greatest(fit, F.lit(0.0)), F.lit(cap) * x["repeats"]).cast("bigint")
        return F.struct((owed - copies * words).alias("owed"), F.concat(s["copies"], F.array(copies)).alias("copies"))

    copies = F.aggregate("items", start, step, lambda s: s["copies"])
    pairs = groups.withColumn("copies", copies).select("source_size", "target", F.explode(F.arrays_zip("items", "copies")).alias("x"))
    return pairs.select(
        F.col("x.items.doc_id").alias("doc_id"), F.col("x.items.size").alias("size"), F.col("x.items.lane").alias("lane"), "source_size", "target",
        F.col("x.copies").alias("copies"), F.col("x.items.rate").alias("rate"), F.col("x.items.repeats").alias("repeats"),
    )


def mixed_lanes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """What ``mix`` gives, a row for each id, text and source: ``repeats`` rows, of which ``copies`` are taken in all."""
    rows = materialize(sized(docs), "sizes")
    histogram = materialize(rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n")), "sizes_by_source")
    tilts = solve_tilts(histogram, materialize(targets(histogram, weights, total, cap), "targets"), cap)
    rated = rows.join(tilts, "source_key").withColumn("rate", F.when(F.col("target") <= 0, 0.0).otherwise(rate_of(F.col("tilt"), F.col("size").cast("double"), cap)))
    return round_copies(rated, cap)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate, lane for every document.

    Null text has size 0 and is never taken; documents without words get no copy. An empty table gives an empty result.
    Null sources are a source of their own; null and repeated ids are rows like others. Rows that are equal in all of these share
    their copies evenly. Reruns agree: all sums are of whole numbers or decimals, and expected words are rounded to 1/1024 before they are carried."""
    lanes = mixed_lanes(docs, weights, total, cap)
    share = lambda i: F.expr(f"({i}) * copies div repeats")
    each = lanes.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("repeats")))).withColumn("copies", (share("i") - share("i - 1")).cast("int"))
    return each.select("doc_id", "size", "lane", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "rate")
