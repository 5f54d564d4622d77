"""Mixing sources to target weights along a curriculum that changes with training time.

Every source has a weight schedule over the training time 0..1, linear between equally spaced
knots.  Its integral, scaled to the source's target, is the cumulative demand of words.  The
documents of a source, shuffled by a seeded hash and read up to ``max_repeats`` times, supply
words in that order; the time at which the demand reaches the middle of a document is its
training position.  Inverting the integral gives that time in closed form, and the mix is the
range sort of all copies by position.

Defined cases: a null text has size 0, a null source is a source of its own, sources without
words take none.  Rows that tie in the shuffle (equal ids) follow by size and text hash; equal
rows are interchangeable.  Other columns are passed on; those of ``NAMES`` and ``positions`` are
replaced in a plan and kept in a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import group_key, running_before, seeded_order, text_of, unpacked, whole_rows, word_count

NAMES = ("size", "source_size", "target", "copies", "taken", "position")


@dataclass(frozen=True)
class MixPlan:
    """Weights go to the sources in code point order, null last, again and again.

    ``schedules`` has the knots for each weight in the same order: how a source's share
    develops during training.  Only their proportions count.
    """

    weights: Sequence[int] = (3, 1, 2)
    schedules: Sequence[Sequence[float]] = ((3.0, 1.0), (1.0, 1.0), (1.0, 3.0))
    total_share: float = 1.5
    max_repeats: int = 2
    seed: int = 42
    size: Column = field(default_factory=lambda: word_count(text_of()))
    tie: Column = field(default_factory=lambda: F.xxhash64("text"))


def source_targets(sizes: DataFrame, plan: MixPlan) -> DataFrame:
    """One row per source (``_g``, ``source_size``) with its ``target`` and ``_turn``.

    The shares of the weights are filled like connected vessels: sources are taken by the
    weight level at which they are full; each full one leaves its excess to the rest.
    The windows see one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("_g") == "", "_g")
    n = len(plan.weights)
    weight = F.element_at(F.array(*map(F.lit, plan.weights)), F.col("_turn") + 1)
    by_level = Window.orderBy(F.col("_full") / F.col("_weight"), "_g")
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("_left") - F.coalesce(F.sum("_full").over(earlier), F.lit(0))) / (
        F.col("_all") - F.coalesce(F.sum("_weight").over(earlier), F.lit(0))
    )
    return (
        sizes
        .withColumn("_turn", ((F.row_number().over(by_name) - 1) % n).cast("int"))
        .withColumn("_weight", weight)
        .withColumn("_full", plan.max_repeats * F.col("source_size"))
        .withColumn("_left", plan.total_share * F.sum("source_size").over(everything))
        .withColumn("_all", F.sum("_weight").over(everything))
        .withColumn("_level", level)
        .withColumn("_over", F.col("_full") <= F.col("_weight") * F.col("_level"))
        .withColumn("_common", F.max(F.when(~F.col("_over"), F.col("_level"))).over(everything))
        .select(
            "_g", "_turn", "source_size",
            F.when(F.col("_over"), F.col("_full").cast("double"))
            .otherwise(F.col("_weight") * F.col("_common")).alias("target"),
        )
    )


def time_of(demand: Column, knots: Sequence[float]) -> Column:
    """The time at which a schedule has asked for the share ``demand`` (0..1) of its words."""
    steps = len(knots) - 1
    areas = [(a + b) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    asked = demand * F.lit(float(sum(areas)))
    result, done = None, 0.0
    for place, (a, b) in enumerate(zip(knots, knots[1:], strict=False)):
        rest = F.greatest(asked - F.lit(done), F.lit(0.0))
        root = F.sqrt(F.lit(float(a * a)) + F.lit(2.0 * (b - a)) * rest)
        inside = F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(float(a)) + root))
        here = (F.lit(float(place)) + F.least(inside, F.lit(1.0))) / F.lit(float(steps))
        done += areas[place]
        result = here if result is None else F.when(asked <= F.lit(done - areas[place]), result).otherwise(here)
    return result


def _planned(docs: DataFrame, plan: MixPlan) -> DataFrame:
    rows = whole_rows(
        docs, group_key("source").alias("_g"), seeded_order(plan.seed, "doc_id").alias("_order"),
        plan.size.alias("size"), plan.tie.alias("_tie"),
    ).withColumn("_bucket", F.substring("_order", 1, 3))
    sums = rows.groupBy("_g", "_bucket").agg(F.sum("size").alias("total"))
    sizes = sums.groupBy("_g").agg(F.sum("total").alias("source_size"))
    targets = source_targets(sizes, plan)
    rows = running_before(
        rows, sums.join(targets, "_g"), "_g", "_bucket", F.col("size"),
        [F.col("_order"), F.col("size"), F.col("_tie")], "_start",
    )
    middle = F.col("_start") + F.col("size") / 2
    passes = F.ceil((F.col("target") - middle) / F.col("source_size"))
    copies = F.when(F.col("source_size") == 0, 0).otherwise(
        F.least(F.greatest(passes, F.lit(0)), F.lit(plan.max_repeats))
    ).cast("int")
    demand = lambda i: (middle + i * F.col("source_size")) / F.col("target")
    turns = [time_of(F.col("_d"), knots) for knots in plan.schedules]
    when = turns[0]
    for turn, time in enumerate(turns[1:], start=1):
        when = F.when(F.col("_turn") % len(turns) == turn, time).otherwise(when)
    rows = rows.withColumn("copies", copies)
    names = []
    for i in range(plan.max_repeats):
        rows = rows.withColumn("_d", F.when(F.col("copies") > i, demand(i))).withColumn(
            f"_at{i}", F.when(F.col("_d").isNotNull(), when))
        names.append(f"_at{i}")
    return (
        rows.withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("position", F.col("_at0"))
        .withColumn("positions", F.filter(F.array(*names), lambda x: x.isNotNull()))
    )


def plan_mix(docs: DataFrame, plan: MixPlan | None = None) -> DataFrame:
    """Every document with its size, its source's target, how often it is taken and when first.

    ``position`` is the training time (0..1) of the first copy, null for documents left out;
    a further copy comes at ``positions[1]``.  A document is taken once more for every pass in
    which the middle of its words lies before the source's target.
    """
    return unpacked(_planned(docs, plan or MixPlan()), docs, *NAMES, "positions")


def training_stream(docs: DataFrame, plan: MixPlan | None = None) -> DataFrame:
    """All copies of the mix in training order, with the columns of ``docs`` only."""
    copies = _planned(docs, plan or MixPlan()).select("_row", F.explode("positions").alias("_at"))
    return unpacked(copies.orderBy("_at", "_row.doc_id"), docs)
