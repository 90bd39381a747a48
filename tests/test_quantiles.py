"""The counting quantiles against `percentile`, on a hot group, a heavy tail, ties and degenerate groups."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import quantiles
from ledgerloom.operators import feeds
from ledgerloom.operators import risk as r
from ledgerloom.params import Risk
from ledgerloom.plans.lineage import cut
from tests.conftest import month

SHARES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.773, 0.95, 1.0)


@pytest.mark.parametrize("bracket", [100, 20_000])
def test_counting_equals_percentile(spark, bracket):
    unit = F.abs(F.hash("id")) / 2147483648.0
    hot = spark.range(60_000).select(F.lit("hot").alias("k"), F.exp(unit * 200).alias("v"))  # all but a few in the first millionth of the range
    ties = spark.range(5000).select(F.lit("ties").alias("k"), (F.col("id") % 3).cast("double").alias("v"))
    odd = spark.createDataFrame([("one", 4.0), ("same", 2.0), ("same", 2.0), ("two", 1.0), ("two", 9.0), ("one", None), ("none", None)], "k string, v double")
    df = hot.unionByName(ties).unionByName(odd).withColumn("u", -F.col("v"))
    points = F.array(*[F.lit(p) for p in SHARES])
    want = {x["k"]: (x["v"], x["u"]) for x in df.groupBy("k").agg(F.percentile("v", points).alias("v"), F.percentile("u", points).alias("u")).collect()}
    got = {x["k"]: (x["qv"], x["qu"]) for x in quantiles.exact_quantiles(df, "k", {"v": "qv", "u": "qu"}, SHARES, bracket).collect()}
    assert set(got) == set(want) - {"none"}
    for k, both in got.items():
        for q, wanted in zip(both, want[k]):
            assert q == pytest.approx(wanted, rel=1e-12, abs=1e-15)


def test_no_task_sees_a_hot_group(spark):
    """Of 300,000 values the brackets hold a few hundred."""
    df = spark.range(300_000).select(F.lit("hot").alias("k"), F.exp(F.abs(F.hash("id")) / 2147483648.0 * 50).alias("v"))
    low, high = df.agg(F.percentile_approx("v", 0.5 - 2 / quantiles.ACCURACY, quantiles.ACCURACY), F.percentile_approx("v", 0.5 + 2 / quantiles.ACCURACY, quantiles.ACCURACY)).first()
    assert df.where(F.col("v").between(low, high)).count() < 1000


def test_risk_reads_the_simulations_once(spark):
    df = spark.createDataFrame([(s, month(i), 3e6) for s in "ab" for i in range(6)], "series_id string, date date, sales double")
    risk = Risk(runs=300)
    sims = cut(r.simulate_plans(df, risk))
    for frame in (r.var_cvar(sims, risk), r.distribution_report(sims), r.var_cvar(r.winsorize_tails(sims, risk), risk), feeds.risk_histogram(sims), feeds.box_stats(sims, "total_fcf")):
        assert "md5" not in frame._jdf.queryExecution().toString()
    assert feeds.risk_histogram(sims).count() == 100
    assert feeds.risk_histogram(sims).agg(F.sum("count")).first()[0] == 600


def test_one_digest_serves_both_shocks(spark):
    df = spark.createDataFrame([("a", month(i), 3e6, 30.0 + i) for i in range(6)], "series_id string, date date, sales double, usdtry_rate double")
    plan = r.simulate_plans(df, Risk(runs=20))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
