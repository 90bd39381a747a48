"""Mixing sources to target weights by Pareto order sampling.

Method. Every source has a target in words. Within a source a document's expected number of copies grows with the square
root of its size, up to `MOST_COPIES`, and is scaled so that expected words meet the target. Whole copies are certain. For the fraction that
is left, documents are ranked by their random odds u / (1 - u) divided by their inclusion odds p / (1 - p), and the first
are taken until the words still needed are reached: a sample of fixed size with unequal probabilities, in which size is
counted in words. Of the documents behind the first that does not fit, smaller ones then fill the gap in the same order.
u is a hash of the id, so reruns and other layouts agree.

All is DataFrame expressions. Texts are read once to be counted and not moved. A source's ranking is cut by sums over
`BUCKETS` ranges of the rank; only the range with the cut in it is sorted, so that a source with a third of all rows is
no task's alone. What is shared is one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import SPACE, fresh, write_shared

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # the mix has 3 / 2 of all words
MOST_COPIES = 2
BUCKETS = 1 << 14
SALT = "mix:"
_BLANKS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; none in a null text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, SPACE))).cast("long")


def _rank(key: Column, p: Column) -> Column:
    """q / (1 + q) for the ratio q of odds, which keeps the order and lies between 0 and 1."""
    digits = F.substring(F.md5(F.concat(F.lit(SALT), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return u * (1 - p) / (u * (1 - p) + p * (1 - u))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): sources by code point, null last, take `weights` in turn and share the mix by them.

    Nobody's target exceeds `MOST_COPIES` times its size; what is over is shared by the others. One row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    exact = "decimal(38,0)"
    ranked = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST_COPIES).withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up, down = SHARE
    rest = (F.sum("source_size").over(everything) * up - F.coalesce(F.sum("cap").over(before), F.lit(0)) * down).cast(exact)
    left = F.sum("weight").over(onward).cast(exact) * down
    filled = ranked.withColumn("rest", rest).withColumn("left", left).withColumn(
        "full", F.col("rest") * F.col("weight") >= F.col("left") * F.col("cap"))
    level = F.min(F.when(~F.col("full"), F.struct("place", "rest", "left"))).over(everything)
    share = level["rest"].cast("double") / level["left"].cast("double") * F.col("weight")
    return filled.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _scaled(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """`goals` with `scale`, so that the words of copies min(MOST_COPIES, scale * sqrt(size)) sum to the target."""
    by_size = sizes.where("size > 0").groupBy("source", "size").agg(F.sum("size").alias("words"))
    by_size = by_size.join(goals, by_size["source"].eqNullSafe(goals["source"])).select(by_size["source"], "size", "words", "target")
    largest_first = Window.partitionBy("source").orderBy(F.desc("size"))
    smallest_first = Window.partitionBy("source").orderBy("size")
    capped = F.sum("words").over(largest_first) - F.col("words")
    pull = F.sum(F.col("words") * F.sqrt(F.col("size").cast("double"))).over(smallest_first)
    scale = (F.col("target") - MOST_COPIES * capped) / pull
    tried = by_size.withColumn("scale", scale).where(F.col("scale") * F.sqrt(F.col("size").cast("double")) < MOST_COPIES)
    found = tried.groupBy(F.col("source").alias("s")).agg(F.max_by("scale", "size").alias("scale"))
    return goals.join(found, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _copies(size: Column, scale: Column) -> Column:
    """Expected copies. Where no document stays below the most copies there is no scale, and all have the most."""
    return F.least(F.lit(float(MOST_COPIES)), F.coalesce(scale * F.sqrt(size.cast("double")), F.lit(float(MOST_COPIES))))


def _cut(ranked: DataFrame, need: str, name: str) -> DataFrame:
    """For each source where its order is cut: those below `<name>_below` or at most `<name>_last` have at most `need` words."""
    bucket = F.floor(F.col("rank") * BUCKETS)
    sums = ranked.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.first(need).alias("need"))
    order = Window.partitionBy("source").orderBy("bucket")
    edges = (sums.withColumn("upto", F.sum("words").over(order)).where(F.col("upto") > F.col("need"))
             .groupBy(F.col("source").alias("s")).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("edge"))
             .select("s", "edge.bucket", "edge.before"))
    edges = write_shared(edges, "mix-edges")
    at_edge = ranked.join(edges, ranked["source"].eqNullSafe(edges["s"])).where(bucket == F.col("bucket"))
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("rank")) + F.col("before")
    last = (at_edge.withColumn("so_far", so_far).where(F.col("so_far") <= F.col(need))
            .groupBy(F.col("source").alias("t")).agg(F.max("rank").alias(f"{name}_last")))
    return edges.join(last, F.col("s").eqNullSafe(F.col("t")), "left").select(
        "s", (F.col("bucket") / BUCKETS).alias(f"{name}_below"), f"{name}_last")


def _within(name: str) -> Column:
    """Whether a rank is in front of the cut; all are where a source has no cut."""
    below, last = F.col(f"{name}_below"), F.col(f"{name}_last")
    return below.isNull() | (F.col("rank") < below) | F.coalesce(F.col("rank") <= last, F.lit(False))


def _ranked(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """`sized` with its source's plan, the certain copies and the rank for the uncertain one (null where there is none)."""
    joined = sized.join(plan.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source")), "left")
    copies = F.when(F.col("size") > 0, _copies(F.col("size"), F.col("scale"))).otherwise(0.0)
    part = F.col("copies") - F.col("certain")
    return (joined.drop("plan_source").withColumn("copies", copies).withColumn("certain", F.floor("copies"))
            .withColumn("rank", F.when(part > 0, _rank(F.col("doc_id"), part))))


def _joined(plan, cut, name):
    return plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mixing_plan(sizes: DataFrame) -> DataFrame:
    """One row per source: its size and target, and all that decides on its documents."""
    plan = write_shared(_scaled(sizes, write_shared(targets(sizes), "mix-targets")), "mix-scale")
    certain = _ranked(sizes, plan).groupBy(F.col("source").alias("s")).agg(F.sum(F.col("certain") * F.col("size")).alias("certain_words"))
    plan = write_shared(_joined(plan, certain, "").withColumn("need", F.col("target") - F.col("certain_words")), "mix-need")
    uncertain = _ranked(sizes, plan).where("rank is not null")
    plan = write_shared(_joined(plan, _cut(uncertain, "need", "cut"), "cut"), "mix-cut")
    uncertain = _ranked(sizes, plan).where("rank is not null")
    taken = uncertain.where(_within("cut")).groupBy(F.col("source").alias("s")).agg(F.sum("size").alias("sampled"))
    plan = write_shared(_joined(plan, taken, "").withColumn("gap", F.col("need") - F.coalesce("sampled", F.lit(0))), "mix-gap")
    behind = _ranked(sizes, plan).where("rank is not null").where(~_within("cut") & (F.col("size") <= F.col("gap")))
    return write_shared(_joined(plan, _cut(behind, "gap", "fill"), "fill"), "mix-plan")


def _taken_copies() -> Column:
    sampled = _within("cut") | ((F.col("size") <= F.col("gap")) & _within("fill"))
    return (F.col("certain") + F.when(F.col("rank").isNotNull() & sampled, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, copies, taken (words, repeats counted).

    Null texts and those without words have size 0 and no copies. Null is a source of its own. Rows that repeat an id, or lack one, and have the same
    size and source share one fate. An empty table gives an empty result.
    """
    sizes = write_shared(
        docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "mix-sizes")
    decided = _ranked(sizes, mixing_plan(sizes)).withColumn("n", _taken_copies())
    return decided.select("doc_id", "source", "size", "source_size", "target", F.col("n").alias("copies"), (F.col("n") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it is taken; all columns stay. Null and empty texts have no words and are never taken; a null source is a source of its
    own, a null id draws like any; rows that repeat draw alike. An empty table gives an empty result."""
    columns = docs.columns
    whole, = fresh(docs, "whole")
    sized = docs.select(F.struct(*columns).alias(whole), F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    plan = mixing_plan(write_shared(sized.select("doc_id", "source", "size"), "mix-sizes"))
    taken = _ranked(sized, plan).withColumn("n", _taken_copies()).where("n > 0")
    return taken.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(f"{whole}.*")
