"""Cohorts of subscribers by the amount they qualified for, and what they recharged around that month."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.functions import columns as C
from airlend.operators.skew import filter_by_subscribers
from airlend.schemas import BUCKET_EDGES, CUSTOMER_PARTY, RECHARGE, REVERSAL_TEXT

SALTS = 64


def in_period(df: DataFrame, ts: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Rows with lo <= ts < hi."""
    return df.filter(C.period(ts, lo, hi))


def customer_recharges(
    ledger: DataFrame, party: str = CUSTOMER_PARTY, exclude_text: str = REVERSAL_TEXT
) -> DataFrame:
    """Recharges a customer paid for; rows without a transaction text do not count."""
    return ledger.filter(
        (F.col("operation_type") == RECHARGE)
        & (F.col("other_party") == party)
        & (F.col("transaction_text") != exclude_text)
    )


def with_amount_bucket(
    df: DataFrame, col: str = "qualified_amount", edges: Sequence[float] = BUCKET_EDGES
) -> DataFrame:
    return df.withColumn("qualified_bucket", C.amount_bucket(col, edges))


def subscribers_with_amount(finance: DataFrame, amount: int) -> DataFrame:
    """The subscribers who chose this amount."""
    return finance.filter(F.col("chosen_amount") == amount).select("msisdn").distinct()


def period_recharges(
    ledger: DataFrame, periods: Mapping[str, tuple[str, str]], members: DataFrame | None = None
) -> DataFrame:
    """Per subscriber, the customer recharges of each period, for subscribers with any. Repeated ledger rows
    count once. `members` (distinct msisdn) limits it to these subscribers before rows are compared."""
    tests = {name: C.period("event_ts", lo, hi) for name, (lo, hi) in periods.items()}
    rows = customer_recharges(ledger).filter(reduce(operator.or_, tests.values()))
    if members is not None:
        rows = filter_by_subscribers(rows, members, "left_semi")
    return (
        rows.dropDuplicates()
        .groupBy("msisdn")
        .agg(*(F.sum(F.when(test, F.col("amount"))).alias(name) for name, test in tests.items()))
    )


def cohort_recharges(
    cohort: DataFrame, ledger: DataFrame, periods: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Per cohort member, the customer recharges of each period; members without any are left out.

    The cohort is small beside the ledger, so its rows are picked first, with salts: only they are compared
    and summed, and a member with very many rows never lands in one task.
    """
    return period_recharges(ledger, periods, cohort.select("msisdn").distinct())


def m0_daily_recharges(finance: DataFrame, ledger: DataFrame, m0: tuple[str, str]) -> DataFrame:
    """Customer recharges per subscriber and day of the month, for those with an advance in it."""
    daily = (
        in_period(customer_recharges(ledger), "event_ts", *m0)
        .groupBy("msisdn", C.day("event_ts").alias("day"))
        .agg(F.sum("amount").alias("amount_sum"))
    )
    members = in_period(finance, "advance_ts", *m0).select("msisdn").distinct()
    return daily.join(members, "msisdn", "left_semi")


def amount_peers(df: DataFrame, key: str = "qualified_amount", salts: int = SALTS) -> DataFrame:
    """Who has the same amount as whom, counted: key, msisdn, the subscriber's rows with that amount, all
    rows with it, and the pairs they make.

    A self-join would write every pair out, k * k rows for an amount that k rows share. The counts say the
    same in one row per subscriber and amount. Common amounts are spread over `salts` join tasks.
    """
    own = df.filter(F.col(key).isNotNull()).groupBy(key, "msisdn").agg(F.count(F.lit(1)).alias("n_rows"))
    total = own.groupBy(key).agg(F.sum("n_rows").alias("peer_rows"))
    salted_total = total.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_own = own.withColumn("salt", F.pmod(F.hash("msisdn"), F.lit(salts)))
    return salted_own.join(salted_total, [key, "salt"]).select(
        key, "msisdn", "n_rows", "peer_rows", (F.col("n_rows") * F.col("peer_rows")).alias("n_pairs")
    )
