"""Random draws addressed by key.

`rand(seed)` depends on how rows are partitioned, and a retried task on a new layout would draw anew.
Here a draw is a hash of (seed, series, simulation, period, stream): any executor, retry or layout gives
the same number. Box-Muller turns sixteen hex digits of a digest into one standard normal; a digest has
thirty-two, which serve the two shocks of one period.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_STREAM, PROMO_STREAM, COMPETITOR_STREAM = "price", "promo", "competitor"
SHOCK_STREAM = "shock"
# Where the digits of each shock begin in the digest of the shock stream.
SHOCK_START = {"sales": 1, "fx": 17}


def _uniform(digest: str, start: int) -> str:
    """Eight hex digits as a number strictly between 0 and 1."""
    return f"((cast(conv(substring({digest}, {start}, 8), 16, 10) as double) + 0.5D) / 4294967296D)"


def normal_of(digest: str, start: int = 1) -> str:
    """SQL text: one standard normal from the digits of a digest beginning at `start`."""
    return f"(sqrt(-2D * ln({_uniform(digest, start)})) * cos(2D * pi() * {_uniform(digest, start + 8)}))"


def digest_of(seed: int, series: str, sim: str, period: str, stream: str) -> str:
    return f"md5(concat_ws('|', '{int(seed)}', {series}, cast({sim} as string), cast({period} as string), '{stream}'))"


def standard_normal(seed: int, series: str, sim: str, period: str, stream: str) -> Column:
    """One draw per row; series, sim and period are SQL expressions."""
    return F.expr(normal_of(digest_of(seed, series, sim, period, stream)))


def normal_pairs(seed: int, series: str, sim: str, periods: str) -> str:
    """SQL text: an array over periods 1.. of the draws for sales and FX, from one digest each."""
    digest = digest_of(seed, series, sim, "t", SHOCK_STREAM)
    pair = ", ".join(f"'{name}', {normal_of('d', start)}" for name, start in SHOCK_START.items())
    return f"transform(sequence(1, {periods}), t -> get(transform(array({digest}), d -> named_struct({pair})), 0))"


def normals(seed: int, series: str, sim: str, periods: str, name: str) -> str:
    """SQL text: an array over periods 1.. of the draws of one shock."""
    digest = digest_of(seed, series, sim, "t", SHOCK_STREAM)
    return f"transform(sequence(1, {periods}), t -> get(transform(array({digest}), d -> {normal_of('d', SHOCK_START[name])}), 0))"
