"""Exact quantiles of groups of any size, by counting.

`percentile` gathers the distinct values of a group in one task. Here a mergeable sketch first tells, for each probability,
between which two values the quantile must lie; then the values in between are counted one by one, and all that lie
below together, in parts before the shuffle. A task sees a bracket, some ten-thousandths of a group however its values are
spread, and never the group. The result is that of `percentile`, not an estimate. The input is read twice, so callers cut its
lineage first where it is costly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w

ACCURACY = 10_000  # the sketch's ranks are off by at most a share of 1 / ACCURACY
#: With fewer values the sketch's margin is less than four ranks, while its ranks and those of an interpolated quantile differ by up to two: such a group is one
#: bracket. The shares asked of a sketch are constants, so they cannot widen with the group.
BRACKET = 2 * ACCURACY


def exact_quantiles(df: DataFrame, keys, columns, probabilities, bracket: int = BRACKET) -> DataFrame:
    """One row per group: its keys and for each column an array in the order of the probabilities. `columns` is a name, or a mapping
    from names to those of the arrays; of a single column the array is called `quantiles`."""
    columns = {columns: "quantiles"} if isinstance(columns, str) else dict(columns)
    keys = w.keys(keys)
    by = [*keys, "_c"]
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns]))
    values = df.select(*keys, each).where(F.col("_v").isNotNull())
    margin = 2 / ACCURACY

    def sketch(shares):
        return F.percentile_approx("_v", [min(1.0, max(0.0, s)) for s in shares], ACCURACY)

    ends = values.groupBy(*by).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"),
        sketch(p - margin for p in probabilities).alias("_low"), sketch(p + margin for p in probabilities).alias("_high"))
    small = F.col("_n") <= bracket
    places = F.array(*[
        F.struct(
            (F.lit(float(p)) * (F.col("_n") - 1)).alias("place"),
            F.when(small | F.lit(p <= margin), F.col("_lo")).otherwise(F.col("_low")[i]).alias("low"),
            F.when(small | F.lit(p >= 1 - margin), F.col("_hi")).otherwise(F.col("_high")[i]).alias("high"))
        for i, p in enumerate(probabilities)])
    ends = ends.select(*by, places.alias("_places"))
    brackets = F.array_distinct(F.transform("_places", lambda p: F.struct(p["low"].alias("low"), p["high"].alias("high"))))
    placed = values.join(ends.withColumn("_brackets", brackets), by)
    # Null stands for everything below the bracket.
    inside = placed.select(*by, "_places", "_v", F.inline("_brackets")).where(F.col("_v") <= F.col("high"))
    counted = inside.groupBy(*by, "low", "high", F.when(F.col("_v") >= F.col("low"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_same"), F.first("_places").alias("_places"))
    upto = F.sum("_same").over(
        Window.partitionBy(*by, "low", "high").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("_from", upto - F.col("_same"))
    picks = []
    for i in range(len(probabilities)):
        p = F.col("_places")[i]
        mine = (p["low"] == F.col("low")) & (p["high"] == F.col("high"))

        def at(rank, mine=mine):
            return F.max(F.when(mine & (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_same")), F.col("_v")))

        low, high = at(F.floor(p["place"])), at(F.ceil(p["place"]))
        picks.append(low + (high - low) * F.max(p["place"] - F.floor(p["place"])))
    found = ranked.groupBy(*by).agg(F.array(*picks).alias("_q"))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == c, F.col("_q"))).alias(name) for c, name in columns.items()])


def add_quantiles(df: DataFrame, keys, columns, probabilities) -> DataFrame:
    """`df` with arrays of group quantiles, named as `columns` maps them.

    The table of quantiles has one row per group; whether it is broadcast is left to the size check of the
    planner, and adaptive execution splits a hot group.
    """
    keys = w.keys(keys)
    return df.join(exact_quantiles(df, keys, columns, probabilities), keys, "left")
