"""Calendar, growth and explanatory columns. Input: one row per series and date."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import draws
from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import clip
from ledgerloom.params import DATE, FX, RANDOM_SEED, SALES, SERIES, Finance


def calendar_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year(DATE), "month": F.month(DATE), "quarter": F.quarter(DATE)})


def calendar_flags(df: DataFrame) -> DataFrame:
    """0/1 flags of the year end, the last quarter and the retail seasons (Ramadan taken as May)."""
    month = F.month(DATE)
    flags = {
        "is_q4": month >= 10,
        "is_year_end": month == 12,
        "is_black_friday": month == 11,
        "is_ramadan": month == 5,
        "is_back_to_school": month == 9,
        "is_holiday_peak": month >= 11,
    }
    return df.withColumns({name: cond.cast("int") for name, cond in flags.items()})


def growth_mom(df: DataFrame) -> DataFrame:
    return df.withColumns({"sales_growth_mom": w.change(F.col(SALES)), "fx_change_mom": w.change(F.col(FX))})


def growth_yoy(df: DataFrame) -> DataFrame:
    return df.withColumn("sales_growth_yoy", w.change(F.col(SALES), 12))


def growth_acceleration(df: DataFrame) -> DataFrame:
    """The change of the monthly growth; needs `growth_mom`."""
    growth = F.col("sales_growth_mom")
    return df.withColumn("growth_acceleration", growth - F.lag(growth).over(w.ordered()))


def add_growth(df: DataFrame) -> DataFrame:
    return df.transform(calendar_parts).transform(growth_mom).transform(growth_yoy).transform(growth_acceleration)


def _noise(df: DataFrame, stream: str, scale: float, seed: int | None):
    if seed is None:
        return F.lit(0.0)
    return scale * draws.standard_normal(seed, SERIES, "0", "_pos", stream)


def _placed(df: DataFrame) -> DataFrame:
    """Add the row position, its share of the series length, and FX relative to the first rate."""
    return df.withColumns(
        {
            "_pos": w.position(),
            "_n": F.count(F.lit(1)).over(w.whole()),
            "_fx_rel": F.try_divide(F.col(FX), w.first_of(F.col(FX))),
        }
    ).withColumn("_elapsed", F.col("_pos") / F.col("_n"))


_SCRATCH = ("_pos", "_n", "_fx_rel", "_elapsed")


def price_units(df: DataFrame, seed: int | None = RANDOM_SEED) -> DataFrame:
    """A price that follows FX and a slow trend, and the units it implies. `seed=None` adds no noise."""
    df = _placed(df)
    price = (
        50_000.0
        * (0.6 + 0.4 * clip(F.col("_fx_rel"), 0.5, 3.0))
        * (1.0 + 0.02 * F.col("_elapsed"))
        * (1.0 + _noise(df, draws.PRICE_STREAM, 0.05, seed))
    )
    df = df.withColumn("avg_price_try", price)
    df = df.withColumn("avg_price_try", F.avg("avg_price_try").over(w.near(1, 1)))
    units = clip(F.try_divide(F.col(SALES), F.col("avg_price_try")), 0.0, float("inf"))
    return df.withColumn("units_sold", units).drop(*_SCRATCH)


def cogs_margin(df: DataFrame, finance: Finance = Finance()) -> DataFrame:
    """Cost of goods that moves with FX, and the margin it leaves."""
    df = _placed(df)
    impact = 1.0 + finance.beta_fx * (F.col("_fx_rel") - 1.0)
    df = df.withColumn("cogs_try", F.col(SALES) * finance.cogs_share * impact)
    return df.withColumn("gross_margin_try", F.col(SALES) - F.col("cogs_try")).drop(*_SCRATCH)


def promo_intensity(df: DataFrame, seed: int | None = RANDOM_SEED) -> DataFrame:
    """A seasonal 0..1 signal with peaks in May, September and November."""
    df = _placed(df)
    month = F.month(DATE)
    peak = F.when(month == 11, 0.3).when(month == 9, 0.2).when(month == 5, 0.15).otherwise(0.0)
    base = 0.2 + 0.15 * F.sin(2 * math.pi * (month - 3) / 12)
    noise = _noise(df, draws.PROMO_STREAM, 0.03, seed)
    return df.withColumn("promo_intensity", clip(base + peak + noise, 0.0, 1.0)).drop(*_SCRATCH)


def competitor_index(df: DataFrame, seed: int | None = RANDOM_SEED) -> DataFrame:
    """A seasonal, slowly rising 0..100 signal."""
    df = _placed(df)
    season = 10 * F.sin(2 * math.pi * (F.month(DATE) - 1) / 12 + math.pi)
    level = 50.0 + season + 5.0 * F.col("_elapsed") + _noise(df, draws.COMPETITOR_STREAM, 8.0, seed)
    return df.withColumn("competitor_index", clip(level, 0.0, 100.0)).drop(*_SCRATCH)


def optional_features(df: DataFrame, finance: Finance = Finance(), seed: int | None = RANDOM_SEED) -> DataFrame:
    """Every explanatory column of a cleaned ledger."""
    df = cogs_margin(price_units(df, seed), finance)
    return calendar_flags(competitor_index(promo_intensity(df, seed), seed))


def forecast_growth(df: DataFrame) -> DataFrame:
    """Growth of a forecast in percent, and its level against the first step set to 100."""
    f = F.col("forecast")
    return df.withColumns(
        {
            "mom_growth": w.change(f) * 100,
            "yoy_growth": w.change(f, 12) * 100,
            "cumulative_index": F.round(F.try_divide(f, w.first_of(f)) * 100, 1),
        }
    )
