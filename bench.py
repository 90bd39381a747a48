"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every job runs once to warm up and three times timed, of which the median counts, driven to completion
by the no-op sink, which reads every column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import inputs  # noqa: E402
from ledgerloom.operators import forecasting, models, risk, scenarios  # noqa: E402
from ledgerloom.operators.cleaning import clean_ledger  # noqa: E402
from ledgerloom.params import SALES, Risk  # noqa: E402
from ledgerloom.plans.pipelines import forecast_measures, plan_from_forecast, plan_job  # noqa: E402
from ledgerloom.plans.lineage import cut  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402
from ledgerloom.sources.rollup import extract_series  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")

    def nations():
        return inputs.ledger(spark, sf_dir, "n_name")

    def sales():
        return extract_series(nations(), SALES)

    def measures():
        return forecast_measures(nations(), 18)

    jobs = {
        "monthly_ledger": nations,
        "clean_ledger": lambda: clean_ledger(inputs.ledger_dirty(spark, sf_dir), inputs.RULES, "dup_no"),
        "scenario_plans": lambda: scenarios.run_scenarios(measures()),
        "scenario_comparison": lambda: scenarios.scenario_comparison(scenarios.run_scenarios(measures())),
        "model_tournament": lambda: models.fit_models(models.pack_series(sales())),
        "forecast_horizon": lambda: forecasting.forecast_horizon(sales()),
        "rolling_backtest": lambda: forecasting.rolling_backtest(sales()),
        "monte_carlo": lambda: risk.var_cvar(cut(risk.simulate_plans(measures(), Risk(runs=1000)))),
        "plan_job": lambda: plan_job(nations()).kpis,
        "executive_kpis": lambda: plan_from_forecast(measures().select("series_id", "date", "sales")).kpis,
    }
    wanted = sys.argv[1:]
    times = {}
    for name, job in jobs.items():
        if wanted and name not in wanted:
            continue
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs[1:]), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
