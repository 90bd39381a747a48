"""Reading, validation, cleaning and edge series."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning as c
from ledgerloom.operators import features as f
from ledgerloom.operators import profiling as pr
from ledgerloom.operators import quality as q
from ledgerloom.params import LedgerError, Risk, Rules, Settings
from ledgerloom.plans import pipelines
from ledgerloom.sources import readers, rollup, scenarios, sinks
from tests.conftest import month


def test_read_csv_with_aliases_and_mixed_dates(spark, tmp_path):
    file = tmp_path / "ledger.csv"
    file.write_text(
        "Timestamp,SALES,operating_expenses,FX\n2020-01-01,100,25,30\n02/01/2020,1e2,x,31\n"
        "13/03/2020,300,75,32\nnever,400,100,33\n20200501,500,125,34\n"
    )
    rows = readers.read_ledger(spark, str(file)).orderBy("date").collect()
    assert [str(r["date"]) for r in rows] == ["2020-01-01", "2020-02-01", "2020-03-13", "2020-05-01"]
    assert rows[1]["sales_total_try"] == 100.0 and rows[1]["opex_try"] is None


def test_ingest_counts_what_it_leaves_out(spark, tmp_path):
    file = tmp_path / "ledger.csv"
    file.write_text(
        "Timestamp,SALES,operating_expenses,FX\n2020-01-01,100,25,30\n2020-02-01,-5,25,99\n2020-02-01,7,25,31\n"
        "13/03/2020,300,75,32,too,many\nnever,400,100,33\n20200501,500\n2020-02-01,-5,25,99\n"
    )
    made = pipelines.ingest(readers.read_text(spark, str(file)))
    rows = {str(r["date"]): r["sales_total_try"] for r in made.ledger.collect()}
    assert rows == {"2020-01-01": 100.0, "2020-02-01": -5.0, "2020-03-13": 300.0, "2020-05-01": 500.0}
    counts = made.counts.first().asDict()
    assert {k: v for k, v in counts.items() if v and k != "series_id"} == {
        "raw_rows": 7, "undated_rows": 1, "malformed_rows": 2, "repeated_rows": 2, "sales_below_min": 2, "fx_above_max": 2}
    assert readers.read_ledger(spark, str(file)).count() == 6
    with pytest.raises(LedgerError, match="fx_above_max"):
        pipelines.load_ledger(readers.read_ledger(spark, str(file)))
    empty = pipelines.ingest(readers.read_text(spark, str(file)).limit(0))
    assert empty.ledger.count() == 0 == empty.counts.count()


def test_source_is_read_once(make_ledger):
    made = pipelines.ingest(make_ledger({"a": [1e6] * 5, "b": [2e6]}))
    for df in (made.ledger, made.counts):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "LocalRelation" not in plan and "LogicalRDD" not in plan.split("InMemoryRelation")[0]


def test_jobs_cover_every_series(make_ledger):
    df = make_ledger(EDGES)
    cleaned = pipelines.clean_job(df)
    assert {r["series_id"] for r in cleaned.ledger.collect()} == set(EDGES) == {r["series_id"] for r in cleaned.report.collect()}
    report = pipelines.profile_job(df).report
    assert {r["series_id"] for r in report.collect()} == set(EDGES)
    forecast = df.selectExpr("series_id", "date", "sales_total_try as sales").where("series_id in ('year', 'eleven')")
    study = pipelines.risk_job(forecast, Settings(risk=Risk(runs=30)))
    assert study.summary.count() == study.distribution.count() == 2 and study.simulations.count() == 60


def test_schema_errors(spark, make_ledger):
    df = make_ledger({"a": [1.0]})
    with pytest.raises(LedgerError):
        readers.standardize_schema(df.drop("usdtry"))
    with pytest.raises(LedgerError):
        readers.standardize_schema(df.withColumn("Sales", F.lit(1.0)))
    with pytest.raises(LedgerError):
        rollup.extract_series(df, "nothing")
    with pytest.raises(LedgerError):
        q.require_valid(df.drop("usdtry"))


def test_strict_mode(make_ledger):
    good = make_ledger({"a": [(1e6, 2e5, 30.0)] * 3})
    assert pipelines.load_ledger(good).count() == 3
    bad = make_ledger({"a": [(-1e6, 2e5, 30.0), (1e6, 2e5, 30.0)]})
    with pytest.raises(LedgerError, match="sales_below_min"):
        q.require_valid(bad)
    assert q.quarantine(bad).first()["broken_rules"] == ["sales_below_min"]


def test_scenario_table(spark):
    assert scenarios.scenario_table(spark).count() == 9
    assert scenarios.scenario_table(spark, ["stress"]).first()["fx_change"] == 0.25
    with pytest.raises(LedgerError):
        scenarios.scenario_table(spark, ["x"])


def test_dedup_keeps_one_row_of_a_hot_date(spark):
    rows = spark.range(5000).select(
        F.lit("a").alias("series_id"), F.lit(month(0)).alias("date"), (F.col("id") + 1.0).alias("sales_total_try"),
        F.lit(1.0).alias("opex_try"), F.lit(30.0).alias("usdtry"), (5000 - F.col("id")).alias("dup_no"),
    )
    assert rollup.dedup_first(rows, "dup_no").collect()[0]["sales_total_try"] == 5000.0


def test_interpolation_matches_pandas(spark):
    values = [None, None, 3.0, None, None, 9.0, 4.0, None, 6.0, None]
    days = pd.to_datetime(["2024-01-01", "2024-01-03", "2024-01-04", "2024-01-10", "2024-01-11", "2024-01-20",
                           "2024-02-01", "2024-02-02", "2024-02-09", "2024-02-20"])
    rows = [("a", d.date(), v) for d, v in zip(days, values)]
    df = spark.createDataFrame(rows, "series_id string, date date, value double")
    series = pd.Series(values, index=days, dtype=float)
    by_time = [r["value"] for r in c.interpolate_time(df, "value").orderBy("date").collect()]
    np.testing.assert_allclose(np.array(by_time, dtype=float), series.interpolate("time").values)
    by_row = [r["value"] for r in c.interpolate_linear(df, "value").orderBy("date").collect()]
    np.testing.assert_allclose(by_row, series.reset_index(drop=True).interpolate("linear", limit_direction="both").values)
    smooth = [r["value"] for r in c.smooth_median_mean(df, "value").orderBy("date").collect()]
    want = series.rolling(7, min_periods=1, center=True).median().rolling(3, min_periods=1, center=True).mean()
    np.testing.assert_allclose(smooth, want.values)


def test_calendar_is_completed_and_can_be_stretched(make_ledger):
    df = make_ledger({"a": [1.0, 2.0, 3.0, 4.0]}).filter(F.month("date") != 3)
    filled = c.reindex_calendar(df).orderBy("date").collect()
    assert [r["sales_total_try"] for r in filled] == [1.0, 2.0, None, 4.0]
    assert c.reindex_calendar(df, "2019-11-01", "2020-06-01").count() == 8


def test_impute_ladder_on_edge_series(make_ledger):
    df = make_ledger({"none": [None, None], "some": [None, 5.0, None], "zero": [0.0, None]})
    got = {}
    for r in c.impute_ladder(df).orderBy("series_id", "date").collect():
        got.setdefault(r["series_id"], []).append(r["sales_total_try"])
    assert got == {"none": [2.5e6, 2.5e6], "some": [5.0, 5.0, 5.0], "zero": [0.0, 0.0]}


def test_sanitize_forecast(spark):
    inf = float("inf")
    rows = [(n, month(i), v) for n, vs in {
        "ok": [1.0, 2.0], "none": [None, None], "gap": [None, 4.0, None, 8.0], "inf": [2e6, inf],
        "low": [5e6, -1.0], "nan": [1.0, float("nan"), 3.0],
    }.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "series_id string, date date, sales double")
    got = {}
    for r in c.sanitize_forecast(df).orderBy("series_id", "date").collect():
        got.setdefault(r["series_id"], []).append(r["sales"])
    assert got == {"ok": [1.0, 2.0], "none": [3e6, 3e6], "gap": [4.0, 4.0, 6.0, 8.0], "inf": [2e6, 3e6],
                   "low": [5e6, 1e6], "nan": [1.0, 2.0, 3.0]}


EDGES = {
    "one": [5.0], "constant": [7.0] * 30, "zeros": [0.0] * 24, "none": [None] * 13, "mixed": [1.0, 0.0, -2.0, 4.0],
    "eleven": list(map(float, range(1, 12))), "year": list(map(float, range(1, 13))),
}


@pytest.mark.parametrize("operator", [
    c.prepare_ledger, lambda d: c.clean_ledger(d, Rules(max_fx=60.0)), f.optional_features, f.add_growth, q.quality_flags,
    q.describe, q.ledger_summary, q.quality_assessment, q.iqr_outliers, pr.linear_trend, pr.correlation_matrix,
    pr.lagged_correlation, pr.month_profile, pr.quarter_profile, pr.annual_growth, pr.detrended_strength,
    lambda d: pr.volatility_persistence(pr.add_rolling_volatility(f.add_growth(d))),
    lambda d: pr.growth_stats(f.add_growth(d)), lambda d: pr.sensitivity_labels(f.add_growth(d)),
])
def test_edge_series_do_not_fail(make_ledger, operator):
    df = make_ledger(EDGES)
    # A single row has no lag to correlate with.
    expected = set(EDGES) - ({"one"} if operator is pr.lagged_correlation else set())
    assert {r["series_id"] for r in operator(df).collect()} == expected
    assert operator(df.limit(0)).count() == 0


def test_result_does_not_depend_on_partitioning(make_ledger):
    rng = np.random.default_rng(5)
    df = make_ledger({"a": rng.uniform(1e6, 2e6, 40).tolist(), "b": rng.uniform(1e6, 2e6, 40).tolist()})
    outs = [sorted(map(tuple, c.clean_ledger(df.repartition(k)).collect())) for k in (1, 7)]
    assert outs[0] == outs[1]


def test_growth_and_trend_against_numpy(make_ledger):
    rng = np.random.default_rng(3)
    v = rng.uniform(1e6, 2e6, 20)
    row = pr.linear_trend(make_ledger({"a": v.tolist()})).first()
    slope, _ = np.polyfit(np.arange(20), v, 1)
    assert row["sales_trend_slope"] == pytest.approx(slope)
    # Two-sided tail of t with 18 degrees of freedom by numeric integration.
    t, dof = abs(row["sales_trend_t"]), 18
    x = np.linspace(t, t + 400, 4_000_001)
    const = math.gamma((dof + 1) / 2) / (math.sqrt(dof * math.pi) * math.gamma(dof / 2))
    tail = 2 * np.trapezoid(const * (1 + x * x / dof) ** (-(dof + 1) / 2), x)
    assert row["sales_trend_p_value"] == pytest.approx(tail, abs=1e-7)


def test_sinks(spark, tmp_path, make_ledger):
    df = make_ledger({"a": [1.23456, 2.0], "b": [3.0]}).withColumn("scenario", F.lit("base"))
    sinks.write_plan(df, str(tmp_path / "plan"))
    back = spark.read.parquet(str(tmp_path / "plan")).filter("scenario = 'base'")
    assert sorted(r["sales_total_try"] for r in back.collect()) == [1.23, 2.0, 3.0]
    sinks.write_plan(df, str(tmp_path / "csv"), fmt="csv")
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3
    schema = df.schema
    sinks.write_plan(df.withColumn("scenario", F.lit("stress")).limit(1), str(tmp_path / "plan"))
    assert sinks.read_plan(spark, str(tmp_path / "plan"), schema).groupBy("scenario").count().count() == 2
    assert sinks.plan_problems(spark, str(tmp_path / "plan"), schema).count() == 0
    df.limit(1).write.mode("append").partitionBy("scenario").parquet(str(tmp_path / "plan"))
    found = [tuple(r) for r in sinks.plan_problems(spark, str(tmp_path / "plan"), schema).collect()]
    assert found == [("base", 3, 4)]
    sections = {"summary": q.ledger_summary(df), "outliers": q.iqr_outliers(df)}
    sinks.write_report(sections, str(tmp_path / "report"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert {x["series_id"]: x["summary"]["total_records"] for x in lines} == {"a": 2, "b": 1}


def test_cut_uses_the_session_folder(spark):
    from ledgerloom.plans.lineage import cut

    folder = spark.conf.get("spark.checkpoint.dir", None)
    df = cut(spark.range(3))
    assert df.count() == 3
    if folder is None:
        assert df.is_cached
    else:
        assert all(f.startswith(("file:", folder)) and "/cut-" in f for f in df.inputFiles())
