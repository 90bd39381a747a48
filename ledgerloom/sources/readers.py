"""Reading loose CSV ledgers: text in, typed ledger rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import finite
from ledgerloom.params import DATE, FX, MEASURES, OPEX, SALES, SERIES, LedgerError

# Accepted column names, lower case, and the name each stands for.
ALIASES = {
    "date": DATE,
    "timestamp": DATE,
    "sales": SALES,
    "sales_try": SALES,
    "sales_total_try": SALES,
    "opex": OPEX,
    "opex_try": OPEX,
    "operating_expenses": OPEX,
    "usdtry": FX,
    "fx": FX,
    "fx_rate": FX,
    "usd_try": FX,
}

# Tried in order; a date such as 03/04/2020 is read month first, and day first where that fails.
DATE_FORMATS = (
    "yyyy-M-d",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
    "yyyy/M/d",
    "yyyyMMdd",
    "M/d/yyyy",
    "d/M/yyyy",
    "M.d.yyyy",
    "d.M.yyyy",
    "M-d-yyyy",
    "d-M-yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
)
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_date(text: Column) -> Column:
    """A date from text in any of the accepted formats, else null."""
    trimmed = F.trim(text)
    return F.coalesce(*[F.try_to_date(trimmed, fmt) for fmt in DATE_FORMATS])


def parse_number(df: DataFrame, name: str) -> Column:
    """A double; text that is no number, NaN and infinities become null."""
    c = F.col(name)
    if dict(df.dtypes)[name] == "string":
        return F.when(c.rlike(NUMBER), c.try_cast("double"))
    return finite(c.cast("double"))


def standardize_schema(df: DataFrame, drop_undated: bool = True) -> DataFrame:
    """Rename aliases in any letter case, check the required columns, and type the measures."""
    names = {c: ALIASES[c.lower()] for c in df.columns if c.lower() in ALIASES}
    clashes = {n for n in names.values() if list(names.values()).count(n) > 1}
    if clashes:
        raise LedgerError(f"several columns stand for {sorted(clashes)}")
    missing = [c for c in (DATE, *MEASURES) if c not in names.values()]
    if missing:
        raise LedgerError(f"missing required columns {missing}")
    df = df.withColumnsRenamed(names)
    typed = {c: parse_number(df, c) for c in MEASURES}
    is_text = dict(df.dtypes)[DATE] == "string"
    typed[DATE] = parse_date(F.col(DATE)) if is_text else F.to_date(DATE)
    if SERIES not in df.columns:
        typed[SERIES] = F.lit("ledger")
    df = df.withColumns(typed)
    return df.dropna(subset=[DATE]) if drop_undated else df


def undated_rows(df: DataFrame) -> DataFrame:
    """Per series, how many raw rows there are and how many have a date that cannot be parsed."""
    typed = standardize_schema(df, drop_undated=False)
    return typed.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col(DATE).isNull()).alias("undated_rows"),
    )


def ledger_from_lines(lines: DataFrame, header: list[str], line: str = "line") -> DataFrame:
    """A ledger from lines of CSV text that are rows already, as from a log or a topic; `header` names their fields."""
    schema = ", ".join(f"`{name}` string" for name in header)
    return standardize_schema(lines.select(F.from_csv(line, schema).alias("fields")).select("fields.*"))


MALFORMED = "malformed"


def read_text(spark: SparkSession, path) -> DataFrame:
    """A CSV ledger as text, all rows, with a column `malformed`: whether a line has more or fewer fields than the header.

    What a short line lacks is null; what a long one has too many is lost, which is why it is marked.
    """
    names = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False).columns
    fields = ", ".join(f"`{n}` string" for n in (*names, "_line"))
    text = spark.read.csv(path, header=True, schema=fields, enforceSchema=False, columnNameOfCorruptRecord="_line")
    return text.withColumn(MALFORMED, F.col("_line").isNotNull()).drop("_line")


def read_ledger(spark: SparkSession, path) -> DataFrame:
    """A CSV ledger as typed rows; rows whose date cannot be parsed are dropped. `plans.pipelines.ingest` counts them in the same pass."""
    return standardize_schema(read_text(spark, path).drop(MALFORMED))
