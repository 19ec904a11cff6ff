"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 60-bit hash of its id and text. Sizes (word counts) are
summed by source and by the hash's leading 12 bits; a running sum over at most
4,096 buckets a source finds the bucket in which the source's budget ends.
Only the rows of that bucket are summed again, by the next 12 bits, and so on:
nested thresholds that end at one hash. A row is taken if its hash lies below
its source's threshold. No step sorts rows, and a source holding a third of
all rows is pre-aggregated in the map tasks like any other.

Targets: sources in code-point order (null last) weigh ``weights``, repeating;
together they share ``ratio`` times all sizes; a target stops at ``cap`` times
its source's size and the excess goes to the others by weight (the level of a
water filling: target = min(cap * size, level * weight)).

Defined cases: a null text has size 0; a null source is a source of its own;
rows that agree in id and text have one hash and are taken or left together;
an empty table gives an empty result; existing columns named like the added
ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clientlens.llm.shared import WORD, temp_name, written

BITS, STEP = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """First 60 bits of the md5 of id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 0, in code-point order of ``source``, null
    last: range-sorted, numbered within each range, and moved on by the sizes of
    the ranges before it (one row per range)."""
    rows = written(sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
                   .withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    sizes = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, ahead = 0, []
    for p, n in sizes:
        ahead.append((p, before))
        before += n
    ahead = sources.sparkSession.createDataFrame(ahead, "part long, ahead long")
    return rows.join(F.broadcast(ahead), part == F.col("part")) \
        .withColumn("place", F.col("ahead") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at", "part", "ahead")


def source_targets(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), ratio: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, target. ``sized`` has source
    and size. However many sources there are, no task holds all of them: they are
    numbered by ranges, and the level of the sources that stay below their limit
    is found by sharing again until none is above, one sum over all sources a time."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = numbered(s).withColumn("w", w).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("r", F.col("limit") / F.col("w"))
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("r") < F.lit(level)
        t = s.agg(F.sum("source_size").alias("all"), F.sum(F.when(above, F.col("limit"))).alias("used"),
                  F.sum(F.when(~above, F.col("w"))).alias("open"), F.count(F.when(above, 1)).alias("full")).first()
        if t.all is None or t.full == full or not t.open:
            break
        level, full = (t.all * float(ratio) - (t.used or 0.0)) / t.open, t.full
    share = F.col("limit") if level is None or not (t.open or 0) else F.lit(level) * F.col("w")
    return s.select("source", "source_size", F.least("limit", share).alias("target"))


def mix_to_targets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                   weights: Sequence[float] = (3, 1, 2), ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and
    ``mix_copies`` (how often the mix repeats the row: 0 up to ``cap``).

    Runs one job over the texts for sizes and hashes (kept as 3 slim columns
    in the shared folder) and up to five small jobs over them."""
    size, h = word_count(F.col(text)), row_hash(F.col(doc_id), F.col(text))
    slim = written(docs.select(F.col(source).alias("source"), size.alias("size"), h.alias("h")), "mix-sizes")
    targets = source_targets(slim, weights, ratio, cap) \
        .withColumn("q", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("rest", F.col("target") - F.col("q") * F.col("source_size"))
    targets = written(targets, "mix-targets")

    # edge: per source the hash prefix in which the budget ends, and what is left of it there
    edge = targets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("rest").alias("left"))
    rows, used = slim, 0
    while used < BITS:
        e = edge.select(F.col("source").alias("e_source"), "prefix", "left")
        rows_in = rows.join(e, F.col("source").eqNullSafe(F.col("e_source"))
                            & (F.shiftright("h", BITS - used) == F.col("prefix")))
        used += STEP
        hist = rows_in.groupBy("source", F.shiftright("h", BITS - used).alias("b")) \
            .agg(F.sum("size").alias("s"), F.max("left").alias("left"), F.count(F.lit(1)).alias("n"))
        run = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.coalesce(F.sum("s").over(run), F.lit(0)))
        last = hist.filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("s")))
        edge = written(last.select("source", F.col("b").alias("prefix"),
                                   (F.col("left") - F.col("before")).alias("left"), "s", "n"), "mix-edge")
        if not edge.filter("n > 1").take(1):
            break
    # what is left ends inside the rows of the last prefix: take them if that comes nearer
    near = F.col("s") - F.col("left") < F.col("left")
    edge = edge.select(F.col("source").alias("e_source"),
                       F.shiftleft(F.col("prefix") + F.when(near, 1).otherwise(0), BITS - used).alias("below"))
    plan = targets.join(edge, F.col("source").eqNullSafe(F.col("e_source")), "left") \
        .select(F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
                F.col("target").alias("mix_target"), "q", "below")
    out = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_copies")
    own, at = out.columns, temp_name(out, "mix_hash")
    plan = plan.select(*[F.col(c).alias(temp_name(out, f"p_{c}")) for c in plan.columns])
    of, total, target, q, below = (F.col(c) for c in plan.columns)
    out = out.withColumn("mix_size", size).withColumn(at, h)
    out = out.join(plan, F.col(source).eqNullSafe(of), "left")
    copies = q + F.when(F.col(at) < below, 1).otherwise(0)
    return out.select(*own, "mix_size", total.alias("mix_source_size"), target.alias("mix_target"), copies.cast("int").alias("mix_copies"))
