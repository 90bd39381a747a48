"""Default parameters, as plain frozen dataclasses passed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

SERIES = "series_id"
DATE = "date"
SALES = "sales_total_try"
OPEX = "opex_try"
FX = "usdtry"
MEASURES = (SALES, OPEX, FX)

RANDOM_SEED = 42


@dataclass(frozen=True)
class Rules:
    """Validation thresholds of a ledger."""

    min_sales: float = 0.0
    max_fx: float = 60.0
    min_fx: float = 3.5
    min_date: str = "2018-01-01"
    first_date: str = "2018-01-01"
    last_date: str = "2025-09-01"
    max_gap_days: int = 45


@dataclass(frozen=True)
class Finance:
    tax_rate: float = 0.22
    cogs_share: float = 0.65
    beta_fx: float = 0.15
    dso: float = 45.0
    dpo: float = 30.0
    dio: float = 60.0
    depreciation: float = 50_000.0
    capex: float = 100_000.0
    discount_rate: float = 0.20
    opex_share: float = 0.20
    opex_step: float = 0.05
    default_fx: float = 30.0
    emergency_sales: float = 3_000_000.0
    floor_sales: float = 1_000_000.0


@dataclass(frozen=True)
class Risk:
    runs: int = 1000
    sales_vol: float = 0.12
    fx_vol: float = 0.15
    sales_ar: float = 0.3
    fx_ar: float = 0.7
    confidence: float = 0.95
    correlation: float = -0.2
    lower_tail: float = 0.005
    upper_tail: float = 0.995
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class Forecasting:
    horizon: int = 18
    confidence: float = 0.95
    season: int = 12
    holdout: int = 6
    window: int = 36
    step: int = 1
    min_r2: float = 0.85
    max_mape: float = 15.0
    grid: tuple[float, ...] = (0.1, 0.3, 0.5, 0.7, 0.9)
    ets_forms: tuple[str, ...] = ("AAA", "AAM", "ANA", "ANN")
    fourier_pairs: int = 3
    knots: int = 6
    knot_penalties: tuple[float, ...] = (0.001, 0.1, 10.0)


@dataclass(frozen=True)
class Scenario:
    name: str
    sales_change: float
    fx_change: float
    opex_change: float
    description: str = ""


# The nine planning scenarios (level multipliers on the forecast path).
SCENARIOS = (
    Scenario("base", 0.00, 0.00, 0.00, "Baseline scenario - Current trajectory with no changes"),
    Scenario("optimistic", 0.25, -0.10, -0.06, "Optimistic growth - Market expansion with operational efficiency"),
    Scenario("best", 0.15, -0.05, -0.04, "Best case - Strong growth with favorable FX and cost management"),
    Scenario("moderate_growth", 0.08, 0.02, -0.02, "Moderate growth - Steady expansion with minor FX pressure"),
    Scenario("fx_shock", -0.05, 0.20, 0.00, "FX crisis - Currency devaluation impact on import costs"),
    Scenario("cost_cut", -0.02, 0.00, -0.08, "Cost optimization - Efficiency improvements and OpEx reduction"),
    Scenario("recession", -0.12, 0.15, 0.02, "Economic recession - Reduced demand with increased costs"),
    Scenario("stress", -0.20, 0.25, 0.03, "Severe stress test - Major market contraction and currency crisis"),
    Scenario("recovery", 0.18, -0.08, -0.03, "Post-crisis recovery - Strong rebound with stabilizing conditions"),
)

# The four deterministic stress tests.
STRESS_TESTS = (
    Scenario("severe_downturn", -0.30, 0.40, 0.0),
    Scenario("moderate_stress", -0.15, 0.20, 0.0),
    Scenario("fx_crisis", -0.10, 0.50, 0.0),
    Scenario("demand_shock", -0.25, 0.10, 0.0),
)


@dataclass(frozen=True)
class Settings:
    rules: Rules = field(default_factory=Rules)
    finance: Finance = field(default_factory=Finance)
    risk: Risk = field(default_factory=Risk)
    forecasting: Forecasting = field(default_factory=Forecasting)


class LedgerError(ValueError):
    """A ledger, column or scenario does not meet what an operator needs."""


def select_scenarios(names=None, available=SCENARIOS):
    """The scenarios of the given names, in the order asked for; an unknown name is an error."""
    if names is None:
        return tuple(available)
    by_name = {s.name: s for s in available}
    unknown = [n for n in names if n not in by_name]
    if unknown:
        raise LedgerError(f"unknown scenarios {unknown}; available: {sorted(by_name)}")
    return tuple(by_name[n] for n in names)
