"""How the driver's tables stand in for ledgers. Each is given twice: as a DataFrame and as an SQL view."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.params import DATE, FX, OPEX, SALES, SERIES, Rules
from ledgerloom.sources.rollup import monthly_ledger

# The tables' dates lie in 1992-2001, so the trimming bounds move there.
RULES = Rules(min_date="1995-03-01", first_date="1995-01-01", last_date="2001-06-01", max_fx=60.0)
# Features come from a ledger cleaned over its whole range.
WHOLE_RANGE = replace(RULES, first_date="1900-01-01", last_date="2999-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, by: str = "c_mktsegment") -> DataFrame:
    """One row per order line: series, ship date, sales, opex, FX.

    Orders meet customers first, so that the wide table is joined once, on the order key. Which side to
    broadcast and how to split a hot key is left to the size checks of adaptive execution.
    """
    customer = table(spark, sf_dir, "customer")
    if by == "n_name":
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        customer = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    owner = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(customer.select("c_custkey", F.col(by).alias(SERIES)), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", SERIES)
    )
    return table(spark, sf_dir, "lineitem").join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
        SERIES,
        F.to_date("l_shipdate").alias(DATE),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias(SALES),
        (F.col("l_extendedprice") * (0.20 + F.col("l_tax"))).alias(OPEX),
        F.col("l_quantity").alias(FX),
    )


def ledger(spark: SparkSession, sf_dir: str, by: str = "c_mktsegment") -> DataFrame:
    """Sums are rounded, so that what follows does not depend on the order in which tasks finish."""
    monthly = monthly_ledger(transactions(spark, sf_dir, by))
    return monthly.withColumns({c: F.round(c, 4) for c in (SALES, OPEX)})


def ledger_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger damaged by rule: gaps, outliers, wrong signs and double rows."""
    k = (F.year(DATE) - 1995) * 12 + F.month(DATE) - 1
    damaged = (
        ledger(spark, sf_dir)
        .withColumn("k", k)
        .filter(F.col("k") % 17 != 6)
        .withColumn("copies", F.when(F.col("k") % 31 == 10, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .withColumn("dup_no", F.explode("copies"))
    )
    sales = (
        F.when(F.col("k") % 11 == 4, None)
        .when(F.col("k") % 19 == 7, F.col(SALES) * 8)
        .when(F.col("k") % 29 == 9, -F.col(SALES))
        .otherwise(F.col(SALES))
    )
    fx = F.when(F.col("k") % 13 == 5, None).when(F.col("k") % 23 == 8, 75.0).otherwise(F.col(FX))
    return damaged.select(SERIES, DATE, (sales + F.col("dup_no")).alias(SALES), OPEX, fx.alias(FX), "dup_no")


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as loose text: foreign column names, mixed date formats, values that are no numbers."""
    k = (F.year(DATE) - 1995) * 12 + F.month(DATE) - 1
    fmt = (
        F.when(F.col("k") % 7 == 0, F.date_format(DATE, "yyyy/MM/dd"))
        .when(F.col("k") % 7 == 1, F.date_format(DATE, "MM/dd/yyyy"))
        .when(F.col("k") % 7 == 2, F.date_format(DATE, "yyyyMMdd"))
        .when(F.col("k") % 7 == 3, F.concat(F.date_format(DATE, "yyyy-MM-dd"), F.lit(" 00:00:00")))
        .when(F.col("k") % 41 == 40, F.lit("no date"))
        .otherwise(F.date_format(DATE, "yyyy-MM-dd"))
    )
    sales = F.when(F.col("k") % 9 == 3, "n/a").otherwise(F.col(SALES).cast("decimal(20,4)").cast("string"))
    return ledger(spark, sf_dir).withColumn("k", k).select(
        SERIES,
        fmt.alias("Timestamp"),
        sales.alias("Sales"),
        F.col(OPEX).cast("decimal(20,4)").cast("string").alias("Operating_Expenses"),
        F.round(FX, 3).cast("string").alias("FX_rate"),
    )


def events_daily(spark: SparkSession, sf_dir: str, by: str = "user_id") -> DataFrame:
    """An irregular daily series per user or event type."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col(by).cast("string").alias(SERIES), F.to_date("ts").alias(DATE))
        .agg(F.round(F.sum("value"), 4).alias("value"))
    )


# --- The same inputs as SQL views -----------------------------------------------------------------

K = "((year(date) - 1995) * 12 + month(date) - 1)"


def ledger_sql(name: str, by: str) -> str:
    nation = "JOIN nation ON c_nationkey = n_nationkey" if by == "n_name" else ""
    return f"""
SELECT {by} AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sales_total_try,
       round(sum(l_extendedprice * (0.20 + l_tax)), 4) AS opex_try,
       avg(l_quantity) AS usdtry
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey {nation}
GROUP BY 1, 2"""


VIEWS = {
    "ledger": ledger_sql("ledger", "c_mktsegment"),
    "ledger_nation": ledger_sql("ledger_nation", "n_name"),
    "ledger_dirty": f"""
SELECT series_id, date,
       CASE WHEN k % 11 = 4 THEN NULL WHEN k % 19 = 7 THEN sales_total_try * 8
            WHEN k % 29 = 9 THEN -sales_total_try ELSE sales_total_try END + dup_no AS sales_total_try,
       opex_try,
       CASE WHEN k % 13 = 5 THEN NULL WHEN k % 23 = 8 THEN 75.0::DOUBLE ELSE usdtry END AS usdtry,
       dup_no
FROM (SELECT *, {K} AS k FROM ledger) JOIN (VALUES (0), (1)) d(dup_no)
  ON dup_no = 0 OR k % 31 = 10
WHERE k % 17 <> 6""",
    "raw_text": f"""
SELECT series_id,
       CASE WHEN k % 7 = 0 THEN strftime(date, '%Y/%m/%d') WHEN k % 7 = 1 THEN strftime(date, '%m/%d/%Y')
            WHEN k % 7 = 2 THEN strftime(date, '%Y%m%d') WHEN k % 7 = 3 THEN strftime(date, '%Y-%m-%d') || ' 00:00:00'
            WHEN k % 41 = 40 THEN 'no date' ELSE strftime(date, '%Y-%m-%d') END AS "Timestamp",
       CASE WHEN k % 9 = 3 THEN 'n/a' ELSE CAST(CAST(sales_total_try AS DECIMAL(20,4)) AS VARCHAR) END AS "Sales",
       CAST(CAST(opex_try AS DECIMAL(20,4)) AS VARCHAR) AS "Operating_Expenses",
       CAST(round(usdtry, 3) AS VARCHAR) AS "FX_rate"
FROM (SELECT *, {K} AS k FROM ledger)""",
    "events_daily": """
SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date, round(sum(value), 4) AS value
FROM events GROUP BY 1, 2""",
}
