"""Business rules as expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from ..fixed_values import VALID_STATUSES


def valid_order(status: Column) -> Column:
    """1 for a paid, shipped or received order, else 0 (also for an unknown state)."""
    return F.when(status.isin(*VALID_STATUSES), 1).otherwise(0)


def bucketize(value: Column, bins: Sequence[tuple], rest: str) -> Column:
    """Label of the first bin whose upper bound is not below ``value``."""
    (bound, label), *others = bins
    chain = F.when(value <= bound, label)
    for bound, label in others:
        chain = chain.when(value <= bound, label)
    return chain.otherwise(rest)


def bucketize_at_least(value: Column, bins: Sequence[tuple], rest: str) -> Column:
    """Label of the first bin whose lower bound ``value`` reaches."""
    (bound, label), *others = bins
    chain = F.when(value >= bound, label)
    for bound, label in others:
        chain = chain.when(value >= bound, label)
    return chain.otherwise(rest)


def rfm_score(r: Column, f: Column, m: Column) -> Column:
    """The three digits side by side; NULL when one is missing."""
    return F.concat(*(score.cast("string") for score in (r, f, m)))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment code. Any score of 3, users without scores, and (low, low, low) fall to ``H_Churned``."""
    high, low = (lambda score: score >= 4), (lambda score: score <= 2)
    patterns = {
        "A_Important_Value": (high, high, high), "B_Important_Develop": (low, high, high),
        "C_Important_Keep": (high, low, high), "D_Important_Recover": (low, low, high),
        "E_General_Value": (high, high, low), "F_General_Develop": (low, high, low),
        "G_General_Keep": (high, low, low),
    }
    rules = [
        (r_test(r) & f_test(f) & m_test(m), code) for code, (r_test, f_test, m_test) in patterns.items()
    ]
    chain = reduce(lambda acc, rule: acc.when(*rule), rules[1:], F.when(*rules[0]))
    return chain.otherwise("H_Churned")


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(value, F.lit(high)))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number with leading zeros; a longer number keeps its digits."""
    digits = number.cast("bigint").cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))
