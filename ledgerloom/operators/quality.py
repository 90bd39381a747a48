"""Validation, splits and quality reports of a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.params import DATE, FX, MEASURES, OPEX, SALES, SERIES, LedgerError, Rules


def rule_predicates(rules: Rules = Rules()) -> dict[str, Column]:
    """What breaks each rule; a null breaks none."""
    return {
        "sales_below_min": F.col(SALES) < rules.min_sales,
        "opex_negative": F.col(OPEX) < 0,
        "fx_negative": F.col(FX) < 0,
        "date_before_min": F.col(DATE) < F.lit(rules.min_date).cast("date"),
        "fx_above_max": F.col(FX) > rules.max_fx,
    }


def rule_violations(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per series, the number of rows breaking each rule, in one pass."""
    counts = [F.count_if(p).alias(name) for name, p in rule_predicates(rules).items()]
    return df.groupBy(SERIES).agg(*counts)


def require_valid(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Strict mode: raise where any rule is broken, else hand the ledger on. Runs one job."""
    missing = [c for c in (DATE, *MEASURES) if c not in df.columns]
    if missing:
        raise LedgerError(f"missing required columns {missing}")
    counts = [F.count_if(p).alias(name) for name, p in rule_predicates(rules).items()]
    broken = {k: v for k, v in df.agg(*counts).first().asDict().items() if v}
    if broken:
        raise LedgerError(f"rows break validation rules: {broken}")
    return df


def quarantine(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows breaking any rule, with the names of the rules."""
    named = [F.when(p, F.lit(name)) for name, p in rule_predicates(rules).items()]
    marked = df.withColumn("broken_rules", F.array_compact(F.array(*named)))
    return marked.filter(F.size("broken_rules") > 0)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per series and column, from one pass over the rows."""
    columns = [c for c in df.columns if c != SERIES]
    counted = df.groupBy(SERIES).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot(SERIES, columns, "column_name", "null_count")


def date_gaps(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per series, how many consecutive dates lie more than `max_gap_days` apart."""
    dates = df.select(SERIES, DATE).distinct()
    gap = F.datediff(DATE, F.lag(DATE).over(w.ordered()))
    return (
        dates.withColumn("gap", gap)
        .groupBy(SERIES)
        .agg(F.count_if(F.col("gap") > rules.max_gap_days).alias("large_gaps"))
    )


def trim_dates(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows dated from `first` to `last`, both included."""
    return df.filter(F.col(DATE).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def mark_holdout(df: DataFrame, periods: int = 6) -> DataFrame:
    """Flag the last `periods` rows of each series."""
    return df.withColumn("is_test", F.row_number().over(w.latest_first()) <= periods)


def split_last_n(df: DataFrame, periods: int = 6) -> tuple[DataFrame, DataFrame]:
    """Train and test sets, the test set being the last `periods` rows of each series."""
    marked = mark_holdout(df, periods)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def split_by_date(df: DataFrame, first_test_date: str) -> tuple[DataFrame, DataFrame]:
    """Train rows before the date, test rows from it on."""
    d = F.lit(first_test_date).cast("date")
    return df.filter(F.col(DATE) < d), df.filter(F.col(DATE) >= d)


def quality_flags(df: DataFrame) -> DataFrame:
    """Flag each row MISSING, OUTLIER or OK, and name how it was repaired."""
    span = w.whole()
    marked = df.withColumns(
        {
            "_p95": F.percentile(SALES, 0.95).over(span),
            "_mid": F.percentile(FX, 0.5).over(span),
            "_std": F.stddev_samp(FX).over(span),
        }
    )
    missing = F.col(SALES).isNull() | F.col(OPEX).isNull() | F.col(FX).isNull()
    outlier = (F.col(SALES) > F.col("_p95")) | (F.abs(F.col(FX) - F.col("_mid")) > 2 * F.col("_std"))
    return marked.withColumns(
        {
            "data_quality_flag": F.when(missing, "MISSING").when(outlier, "OUTLIER").otherwise("OK"),
            "imputation_method": F.when(missing, "forward_fill").when(outlier, "winsorized").otherwise("original"),
        }
    ).drop("_p95", "_mid", "_std")


def iqr_outliers(df: DataFrame) -> DataFrame:
    """Per series, how many sales and FX values lie outside the quartiles by 1.5 times their distance."""
    quartiles = {
        f"_{c}": F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).over(w.whole()) for c in (SALES, FX)
    }

    def outside(c):
        q1, q3 = F.col(f"_{c}")[0], F.col(f"_{c}")[1]
        return (F.col(c) < q1 - 1.5 * (q3 - q1)) | (F.col(c) > q3 + 1.5 * (q3 - q1))

    return (
        df.withColumns(quartiles)
        .groupBy(SERIES)
        .agg(
            F.count_if(outside(SALES)).alias("sales_outliers"),
            F.count_if(outside(FX)).alias("fx_outliers"),
        )
    )


def quality_assessment(df: DataFrame, min_completeness: float = 95.0) -> DataFrame:
    """Completeness of every column, three consistency checks and the grade they give."""
    columns = [c for c in df.columns if c != SERIES]
    share = {c: F.count(c) / F.count(F.lit(1)) * 100 for c in columns}

    def always(p):
        return F.bool_and(F.coalesce(p, F.lit(False)))

    checked = df.groupBy(SERIES).agg(
        *[share[c].alias(f"{c}_complete_pct") for c in columns],
        always(F.col(DATE).isNotNull()).alias("monotonic_dates"),
        always(F.col(SALES) >= 0).alias("positive_sales"),
        always((F.col(FX) > 0) & (F.col(FX) < 100)).alias("reasonable_fx"),
    )
    worst = F.array_min(F.array(*[f"{c}_complete_pct" for c in columns]))
    good = F.col("monotonic_dates") & F.col("positive_sales") & F.col("reasonable_fx") & (worst > min_completeness)
    return checked.withColumn("overall_quality", F.when(good, "Good").otherwise("Needs Review"))


def ledger_summary(df: DataFrame) -> DataFrame:
    """Row count, dates covered, and the spread of sales and FX, per series."""
    return df.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        F.avg(SALES).alias("sales_mean"),
        F.percentile(SALES, 0.5).alias("sales_median"),
        F.stddev_samp(SALES).alias("sales_std"),
        F.min(SALES).alias("sales_min"),
        F.max(SALES).alias("sales_max"),
        F.avg(FX).alias("fx_mean"),
        F.percentile(FX, 0.5).alias("fx_median"),
        F.min(FX).alias("fx_min"),
        F.max(FX).alias("fx_max"),
    )


def describe(df: DataFrame, columns=MEASURES) -> DataFrame:
    """Count, mean, std, min, quartiles and max of each measure, one row per series and measure."""

    def facts(c):
        return F.struct(
            F.lit(c).alias("measure"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
            F.max(c).alias("max"),
        )

    described = df.groupBy(SERIES).agg(F.array(*[facts(c) for c in columns]).alias("facts"))
    return described.select(SERIES, F.inline("facts")).select(
        SERIES, "measure", "count", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max",
    )


def integrity_report(df: DataFrame) -> DataFrame:
    """Rows, dates covered, extremes of the measures and nulls of every column, per series."""
    return df.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        *[F.min(c).alias(f"{c}_min") for c in MEASURES],
        *[F.max(c).alias(f"{c}_max") for c in MEASURES],
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns if c != SERIES],
    )
