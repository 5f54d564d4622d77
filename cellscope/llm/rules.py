"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects documents whose measure lies in a bin at or above a cutoff.  The cutoffs of all
rules move together along one path from the mildest to the strictest (``joint_steps``): a step
is a share of bad documents among those of a rule's tail, and has for every rule the lowest
cutoff whose tail reaches it.  The path is made of all documents, labelled or not, but for the good
ones that test it: three quarters of the good labels test, by a hash of the id, and the others and
all bad ones make the path.  For every stratum (source) it is walked while the exact binomial
tail says that the union of all rules loses at most ``max_loss`` of the good documents, at the
level ``risk / strata``.  Testing in a fixed order and stopping at the first failure needs no
correction for the number of steps, so with probability ``1 - risk`` no stratum loses more than
``max_loss`` of the good documents that pass the base rules, as far as its labelled documents are
drawn like the others.  Of the certified steps the one with
the largest difference of the shares of bad and good documents rejected is used, the milder of
equals.  A source with too few testing labels to certify even a step without losses
(``0.95^n > risk / strata``, 118 at 20 strata and one pooled) is judged in one pooled stratum with others like it,
whose bound holds for them together; without labels there, it rejects nothing beyond the base.

Defined cases: a null text has no words and fails the base; a null source is a stratum of its
own; labels that are null or contradict each other for an id are not used; repeated rows are
judged alike.  Everything is a map over the documents but for histograms of bounded size per
stratum.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import HAS_WORD, SPACE, group_key, text_of, unpacked, whole_rows, word_list

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("symbols", "repeated_lines", "repeated_words", "capitals", "short_words", "long_words")
BINS = 40


@dataclass(frozen=True)
class RuleConfig:
    max_loss: float = 0.05
    risk: float = 0.05
    min_words: int = 20
    max_repeat_percent: int = 30


def _repeats(df: DataFrame, n: int = WINDOW) -> DataFrame:
    """Add ``n_words`` and ``n_repeat_words``: words inside n-word windows found twice or more.

    A window's hash is built from those of its words; with 64 bits the chance that two windows
    of one text of a million words collide is below 1e-7.  Only texts with an equal pair of
    hashes are sorted: equal neighbours are repeats, and the words that windows starting at
    the sorted places p cover are the sum of ``min(n, p - previous p)``.
    """
    ints, longs = "array<int>", "array<bigint>"
    window = F.transform(
        F.sequence(F.lit(1), F.size("_hash") - (n - 1)),
        lambda i: F.xxhash64(*(F.element_at(F.col("_hash"), i + k) for k in range(n))),
    )
    pairs = F.sort_array(F.arrays_zip(
        F.col("_window").alias("h"), F.sequence(F.lit(1), F.size("_window")).alias("i")))
    no_pairs = F.array().cast("array<struct<h:bigint,i:int>>")
    same = lambda x, k: (
        F.get("_sorted", k - 1)["h"].eqNullSafe(x["h"]) | F.get("_sorted", k + 1)["h"].eqNullSafe(x["h"]))
    gained = F.transform("_place", lambda p, k: F.least(
        F.lit(n), p - F.coalesce(F.get("_place", k - 1), p - n)))
    return (
        df.withColumn("_hash", F.transform(word_list(F.col("_text")), lambda w: F.xxhash64(w)))
        .withColumn("n_words", F.size("_hash").cast("long"))
        .withColumn("_window", F.when(F.size("_hash") >= n, window).otherwise(F.array().cast(longs)))
        .withColumn("_sorted", F.when(
            F.size(F.array_distinct("_window")) < F.size("_window"), pairs).otherwise(no_pairs))
        .withColumn("_place", F.array_sort(F.transform(F.filter("_sorted", same), lambda x: x["i"])).cast(ints))
        .withColumn("n_repeat_words", F.aggregate(gained, F.lit(0).cast("long"), lambda s, x: s + x))
        .drop("_hash", "_window", "_sorted", "_place")
    )


def base_measures(docs: DataFrame, config: RuleConfig | None = None) -> DataFrame:
    """Add the counts of every whole text and ``base_failed``."""
    config = config or RuleConfig()
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(HAS_WORD))
    failed = (F.col("n_words") < config.min_words) | (
        100 * F.col("n_repeat_words") > config.max_repeat_percent * F.col("n_words"))
    return (
        _repeats(docs.withColumn("_text", text_of()))
        .withColumn("word_chars", F.length(F.regexp_replace("_text", SPACE, "")).cast("long"))
        .withColumn("n_symbols", (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("_n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", F.col("_n_lines") - F.size(F.array_distinct("_lines")))
        .withColumn("_n_upper", F.length(F.regexp_replace("_text", "[^A-Z]", "")).cast("long"))
        .withColumn("base_failed", failed)
        .drop("_text", "_lines")
    )


def bins() -> Column:
    """For each of MEASURES the bin (0 to BINS) of a measured document; higher is worse."""
    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.least(F.floor(part * BINS / whole), F.lit(BINS))).otherwise(0).cast("int")

    words, chars = F.col("n_words"), F.col("word_chars")
    return F.array(
        share(F.col("n_symbols"), chars),
        share(F.col("n_dup_lines"), F.col("_n_lines")),
        share(F.col("n_repeat_words"), words),
        share(F.col("_n_upper"), chars),
        # words of 10 letters and more fall into bin 0, of none into the last
        share(F.greatest(10 * words - chars, F.lit(0)), 10 * words),
        # a mean of 40 letters and more falls into the last bin
        share(chars, 40 * words),
    )


def allowed_losses(n: Column, loss: float, level: Column) -> Column:
    """The largest k for which P(Bin(n, loss) <= k) <= level, or -1: exact, summed in logarithms."""
    odds = F.lit(loss / (1 - loss))

    def add(s: Column, i: Column) -> Column:
        term = F.when(i == 0, n * F.log(F.lit(1 - loss))).otherwise(
            s["term"] + F.log((n - i + 1) / i * odds))
        high, low = F.greatest(term, s["sum"]), F.least(term, s["sum"])
        total = F.when(i == 0, term).otherwise(high + F.log1p(F.exp(low - high)))
        return F.struct(term.alias("term"), total.alias("sum"),
                        F.when(total <= F.log(level), i).otherwise(s["k"]).alias("k"))

    start = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("k"))
    tries = F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(loss)))
    return F.aggregate(tries, start, add, lambda s: s["k"])


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, good, tests): ids whose labels agree, and whether they are kept from the path to test it."""
    return (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("_most"))
        .filter("good = _most").drop("_most")
        .withColumn("tests", (F.col("good") == 1) & (F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1) >= "4"))
    )


def joint_steps(measured: DataFrame, labels: DataFrame) -> list[list[int]]:
    """For each rule and bin the first step of the path that rejects it; the largest number is never.

    What reaches the driver is one row per rule and bin.
    """
    rows = (
        measured.filter(~F.col("base_failed")).join(_known(labels), "doc_id", "left")
        .filter(~F.coalesce("tests", F.lit(False)))
        .select("good", F.posexplode("_bins").alias("rule", "bin"))
        .groupBy("rule", "bin").agg(F.count("*").alias("docs"), F.count(F.when(F.col("good") != 1, 1)).alias("bad"))
        .collect()
    )
    docs, bad = ([[0] * (BINS + 1) for _ in MEASURES] for _ in range(2))
    for row in rows:
        docs[row.rule][row.bin], bad[row.rule][row.bin] = row.docs, row.bad
    all_bad = Fraction(sum(bad[0]), max(sum(docs[0]), 1))
    tail: list[dict[int, Fraction]] = [{} for _ in MEASURES]
    for rule in range(len(MEASURES)):
        for cutoff in range(BINS + 1):
            n = sum(docs[rule][cutoff:])
            share = Fraction(sum(bad[rule][cutoff:]), max(n, 1))
            if share > all_bad:
                tail[rule][cutoff] = share
    order = {share: i for i, share in enumerate(sorted({x for t in tail for x in t.values()}, reverse=True))}
    return [
        [min((order[share] for cutoff, share in t.items() if cutoff <= at), default=len(order)) for at in range(BINS + 1)]
        for t in tail
    ]


def step_of(steps: list[list[int]]) -> Column:
    """The first step of the path that rejects a measured document."""
    return F.least(*(
        F.get(F.array(*(F.lit(s) for s in of_rule)), F.get("_bins", F.lit(i))) for i, of_rule in enumerate(steps)))


POOLED = "*"  # the group keys of sources are empty or begin with "="


def certified_steps(
    measured: DataFrame, labels: DataFrame, steps: list[list[int]], config: RuleConfig | None = None
) -> DataFrame:
    """One row per stratum ``_g`` with ``last``: the last step of the path used there, or -1.

    Strata are the sources with labels enough for a bound of their own, and POOLED for all others.
    """
    config = config or RuleConfig()
    never = max(max(s) for s in steps)
    per_step = (
        measured.filter(~F.col("base_failed")).join(_known(labels).filter("tests or good != 1"), "doc_id")
        .groupBy("_g", step_of(steps).alias("step"))
        .agg(F.count(F.when(F.col("good") == 1, 1)).alias("good"), F.count(F.when(F.col("good") != 1, 1)).alias("bad"))
    )
    sizes = per_step.groupBy("_g").agg(F.sum("good").alias("n"))
    # the largest sources that can all be tested beside the pooled one; it depends on their numbers of labels only
    largest_first = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = (
        sizes.groupBy("n").agg(F.count("*").alias("_sources"))
        .withColumn("_strata", F.sum("_sources").over(largest_first) + 1)
        .filter(F.col("n") * F.log(F.lit(1 - config.max_loss)) <= F.log(F.lit(config.risk) / F.col("_strata")))
        .agg(F.min("n").alias("_least"), F.coalesce(F.max("_strata"), F.lit(1)).alias("_strata"))
    )
    own = sizes.join(enough).select(  # one row
        "_g", "_strata", F.when(F.col("n") >= F.col("_least"), F.col("_g")).otherwise(F.lit(POOLED)).alias("_stratum"))
    pooled = (
        per_step.join(own, "_g")
        .groupBy(F.col("_stratum").alias("_g"), "_strata", "step").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )
    limits = (
        pooled.groupBy("_g", "_strata").agg(F.sum("good").alias("n_good"))
        .select("_g", allowed_losses(F.col("n_good"), config.max_loss, F.lit(config.risk) / F.col("_strata")).alias("_allowed"))
    )
    whole = Window.partitionBy("_g")
    milder = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gain = F.sum("bad").over(milder) * F.sum("good").over(whole) - F.sum("good").over(milder) * F.sum("bad").over(whole)
    usable = (F.col("_lost") <= F.col("_allowed")) & (F.col("_gain") > 0) & (F.col("step") < never)
    return (
        pooled.withColumn("_lost", F.sum("good").over(milder)).withColumn("_gain", gain)
        .join(limits, "_g")
        .groupBy("_g").agg(F.coalesce(
            F.max_by(F.when(usable, F.col("step")), F.when(usable, F.struct("_gain", -F.col("step")))), F.lit(-1)).alias("last"))
    )


def judge(docs: DataFrame, labels: DataFrame, config: RuleConfig | None = None, keep_text: bool = False) -> DataFrame:
    """The base counts, ``base_failed`` and ``kept`` of every document.

    Every text is measured once: the measures are written, with ``keep_text`` beside the whole rows
    in ``_row``, a column that the path and its tests do not read.  The certified steps are a small
    table whose size Spark knows when it plans the join.
    """
    config = config or RuleConfig()
    rows = whole_rows(docs, "doc_id", "text", group_key("source").alias("_g"))
    measured = stage_table(base_measures(rows, config).select(
        *(["_row"] if keep_text else []), "doc_id", "_g", bins().alias("_bins"), "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words", "base_failed"), "rules-measures")
    steps = joint_steps(measured, labels)
    strata = stage_table(certified_steps(measured, labels, steps, config), "rules-steps")
    pooled = strata.agg(F.max(F.when(F.col("_g") == POOLED, F.col("last"))).alias("_pooled"))  # one row
    worse = F.coalesce(step_of(steps) <= F.coalesce("last", "_pooled"), F.lit(False))
    return (
        measured.join(strata, "_g", "left").join(F.broadcast(pooled))
        .withColumn("kept", ~F.col("base_failed") & ~worse)
        .drop("_g", "_bins", "last", "_pooled")
    )


def keep_good(docs: DataFrame, labels: DataFrame, config: RuleConfig | None = None) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    return unpacked(judge(docs, labels, config, keep_text=True).filter("kept"), docs)
