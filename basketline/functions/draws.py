"""Pseudo-random draws as functions of a row key.

A draw is a hash of (key, seed, purpose), so it is the same on every run and for every
partitioning, and lost tasks recompute the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

_STEPS = float(1 << 53)


def uniform(seed: int, purpose: str, *key: Column) -> Column:
    """A double in [0, 1)."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(purpose), *key), 11)
    return bits.cast("double") / F.lit(_STEPS)


def uniform_int(u: Column, low: int | Column, high: int | Column) -> Column:
    """An integer in [low, high], both included."""
    low, high = (F.lit(v) if isinstance(v, int) else v for v in (low, high))
    return (low + F.floor(u * (high - low + 1))).cast("int")


def choice(u: Column, values: Sequence) -> Column:
    """One of ``values``, each equally likely."""
    options = F.array(*(F.lit(v) for v in values))
    return F.element_at(options, uniform_int(u, 1, len(values)))


def weighted_choice(u: Column, values: Sequence, weights: Sequence[float]) -> Column:
    """One of ``values`` with the given relative weights."""
    total = float(sum(weights))
    bounds = [running / total for running in accumulate(weights)]
    chain = F.when(u < bounds[0], F.lit(values[0]))
    for value, bound in zip(values[1:-1], bounds[1:-1]):
        chain = chain.when(u < bound, F.lit(value))
    return chain.otherwise(F.lit(values[-1])) if len(values) > 1 else F.lit(values[0])


def normal(seed: int, purpose: str, *key: Column) -> Column:
    """A standard normal draw from two uniform ones (Box and Muller, 1958)."""
    u1 = uniform(seed, purpose + "/radius", *key)
    u2 = uniform(seed, purpose + "/angle", *key)
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(6.283185307179586) * u2)


def with_distinct_picks(
    df: DataFrame, name: str, seed: int, purpose: str, key: Column, count: Column, domain: int, most: int
) -> DataFrame:
    """Add an array of ``count`` (at most ``most``) different integers from 1..``domain``.

    Floyd's sampling: the i-th draw comes from 1..(domain - count + i), and a value already
    taken is replaced by the upper end of that range, which no earlier draw could reach.
    Each step is a column of its own, so a later one does not evaluate the earlier again.
    """
    if most > domain:
        raise ValueError(f"cannot pick {most} different values out of {domain}")
    steps: list[str] = []
    for i in range(1, most + 1):
        # Steps beyond ``count`` are cut off below; the clamp only keeps them in range.
        top = F.least(F.lit(domain) - count + i, F.lit(domain))
        drawn = uniform_int(uniform(seed, f"{purpose}/{i}", key), F.lit(1), top)
        if steps:
            drawn = F.when(drawn.isin(*(F.col(step) for step in steps)), top).otherwise(drawn)
        steps.append(f"__{name}_{i}")
        df = df.withColumn(steps[-1], drawn)
    return df.withColumn(name, F.slice(F.array(*steps), 1, count)).drop(*steps)
