"""From a sales forecast to profit and loss, working capital and free cash flow.

Input rows: series_id, date, sales, and optionally opex and usdtry_rate (plus `scenario` among the keys).
A plan is computed per group of keys; all keys begin with the series, so its one shuffle serves every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import ratio
from ledgerloom.operators.cleaning import sanitize_forecast
from ledgerloom.params import DATE, SERIES, Finance

RATE = "usdtry_rate"
# The columns of a plan, in their order.
PLAN_COLUMNS = (
    "date", "sales", "cogs", "gross_profit", "opex", "ebit", "tax", "nopat", "accounts_receivable", "accounts_payable",
    "inventory", "working_capital", "wc_change", "depreciation", "capex", "free_cash_flow", "usdtry_rate",
)


def default_opex(df: DataFrame, by=(SERIES,), finance: Finance = Finance()) -> DataFrame:
    """Where no opex is given: a share of the first sales that grows by a step each period."""
    k = w.position(by).cast("double")
    level = w.first_of(F.col("sales"), by) * finance.opex_share
    return df.withColumn("opex", level * F.pow(F.lit(1.0 + finance.opex_step), k))


def default_fx(df: DataFrame, finance: Finance = Finance()) -> DataFrame:
    return df.withColumn(RATE, F.lit(finance.default_fx))


def cogs_passthrough(df: DataFrame, by=(SERIES,), finance: Finance = Finance(), anchor: str = RATE) -> DataFrame:
    """Cost of goods: a share of sales that moves with FX against its first value.

    `anchor` names the column whose first value FX is held against. A plan shocked as a whole is held
    against its own first rate, so that a constant shock moves nothing; with the unshocked rate as the
    anchor it does.
    """
    drift = ratio(F.col(RATE), w.first_of(F.col(anchor), by)) - 1.0
    return df.withColumn("cogs", F.col("sales") * finance.cogs_share * (1.0 + finance.beta_fx * drift))


def pnl(df: DataFrame, finance: Finance = Finance()) -> DataFrame:
    """Gross profit, operating result, tax (none on a loss) and result after tax."""
    df = df.withColumn("gross_profit", F.col("sales") - F.col("cogs"))
    df = df.withColumn("ebit", F.col("gross_profit") - F.col("opex"))
    df = df.withColumn("tax", F.greatest(F.lit(0.0), F.col("ebit") * finance.tax_rate))
    return df.withColumn("nopat", F.col("ebit") - F.col("tax"))


def working_capital(df: DataFrame, by=(SERIES,), finance: Finance = Finance()) -> DataFrame:
    """Receivables, payables, inventory, and how the capital they bind changes from period to period."""
    df = df.withColumns(
        {
            "accounts_receivable": F.col("sales") * finance.dso / 30.0,
            "accounts_payable": F.col("cogs") * finance.dpo / 30.0,
            "inventory": F.col("cogs") * finance.dio / 30.0,
        }
    )
    bound = F.col("accounts_receivable") + F.col("inventory") - F.col("accounts_payable")
    df = df.withColumn("working_capital", bound)
    before = F.lag("working_capital").over(w.ordered(by))
    return df.withColumn("wc_change", F.coalesce(F.col("working_capital") - before, F.lit(0.0)))


def free_cash_flow(df: DataFrame, finance: Finance = Finance()) -> DataFrame:
    df = df.withColumns({"depreciation": F.lit(finance.depreciation), "capex": F.lit(finance.capex)})
    flow = F.col("nopat") + F.col("depreciation") - F.col("capex") - F.col("wc_change")
    return df.withColumn("free_cash_flow", flow)


def financial_plan(
    forecast: DataFrame, by=(SERIES,), finance: Finance = Finance(), fx_anchor: str = RATE
) -> DataFrame:
    """The full plan of each group of keys: the keys, 17 plan columns, then any other column of the input."""
    by = w.keys(by)
    df = sanitize_forecast(forecast, "sales", DATE, by, finance)
    if "opex" not in df.columns:
        df = default_opex(df, by, finance)
    if RATE not in df.columns:
        df = default_fx(df, finance)
    df = cogs_passthrough(df, by, finance, fx_anchor)
    df = free_cash_flow(working_capital(pnl(df, finance), by, finance), finance)
    rest = [c for c in df.columns if c not in (*by, *PLAN_COLUMNS)]
    return df.select(*by, *PLAN_COLUMNS, *rest)


def plan_metrics(plan: DataFrame, by=(SERIES,)) -> DataFrame:
    """Totals, margins, and the spread and low point of free cash flow."""
    sales = F.sum("sales")
    return plan.groupBy(*w.keys(by)).agg(
        sales.alias("total_sales"),
        F.sum("free_cash_flow").alias("total_free_cash_flow"),
        (ratio(F.sum("gross_profit"), sales) * 100).alias("gross_margin_percent"),
        (ratio(F.sum("ebit"), sales) * 100).alias("ebit_margin_percent"),
        F.stddev_samp("free_cash_flow").alias("fcf_volatility"),
        F.min("free_cash_flow").alias("minimum_fcf"),
        ratio(F.max_by("working_capital", DATE), F.max_by("sales", DATE)).alias("working_capital_intensity"),
        F.count(F.lit(1)).alias("periods"),
    )


def discounted_fcf(plan: DataFrame, by=(SERIES,), finance: Finance = Finance()) -> DataFrame:
    """Present value of free cash flow at a yearly rate, the first period falling due after one month."""
    by = w.keys(by)
    months = (w.position(by) + 1).cast("double")
    factor = F.pow(F.lit(1.0 + finance.discount_rate), -months / 12.0)
    valued = plan.withColumn("_pv", F.col("free_cash_flow") * factor)
    return valued.groupBy(*by).agg(F.sum("_pv").alias("discounted_fcf"))
