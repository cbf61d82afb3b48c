"""Recharges around the month of a loan, by the amount a subscriber qualified for in it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from airlend.operators.cohorts import in_period, period_recharges, with_amount_bucket


def month_period(m0: str, offset: int = 0) -> tuple[str, str]:
    """First day of the month `offset` months after that of `m0`, and of the month after it."""
    first = date.fromisoformat(m0)
    months = first.year * 12 + first.month - 1 + offset

    def day_one(n: int) -> str:
        return date(n // 12, n % 12 + 1, 1).isoformat()

    return day_one(months), day_one(months + 1)


def offset_name(offset: int) -> str:
    return f"m_minus_{-offset}" if offset < 0 else f"m_plus_{offset}" if offset else "m0"


def cohort_bucket_recharges(
    finance: DataFrame, ledger: DataFrame, m0: str, offsets: Sequence[int] = (-1, 0, 1, 2)
) -> DataFrame:
    """msisdn, qualified_bucket and the customer recharges of each month around M0.

    A subscriber who qualified for amounts in several buckets has one row in each. Only the cohort's recharges
    are compared and summed; they are a row per subscriber before they meet the buckets.
    """
    cohort = with_amount_bucket(in_period(finance, "advance_ts", *month_period(m0)))
    periods = {offset_name(offset): month_period(m0, offset) for offset in offsets}
    buckets = cohort.select("msisdn", "qualified_bucket").distinct()
    sums = period_recharges(ledger, periods, buckets.select("msisdn").distinct())
    return sums.join(buckets, "msisdn").select("msisdn", "qualified_bucket", *periods)
