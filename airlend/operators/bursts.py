"""Loans granted to one subscriber within the same minute are one loan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.operators.repayment import paid_per_loan


def collapse_bursts(repaid: DataFrame, unit: str = "minute") -> DataFrame:
    """One row per subscriber and minute: the first loan's columns and the burst's totals.

    The first loan is the earliest, of equally early ones that with the smallest id. It is found by an
    aggregate, not a window, so a crowded minute is combined on the map side.
    """
    attributes = [c for c in repaid.columns if c not in ("msisdn", "loan_ts", "loan_id", "total_paid")]
    first = F.min(F.struct("loan_ts", "loan_id", *attributes))
    return (
        repaid.groupBy("msisdn", F.date_trunc(unit, "loan_ts").alias("burst_start"))
        .agg(
            first.alias("first"),
            F.sum("loan_amount").alias("burst_amount"),
            F.sum("service_fee").alias("burst_fee"),
            F.count(F.lit(1)).alias("burst_size"),
            F.sum("total_paid").alias("total_paid"),
        )
        .select("msisdn", "first.*", "burst_amount", "burst_fee", "burst_size", "total_paid")
    )


def merge_loan_bursts(loans: DataFrame, payments: DataFrame, unit: str = "minute") -> DataFrame:
    """Bursts with what was paid on all their loans and the first loan's own last payment time."""
    return collapse_bursts(loans.join(paid_per_loan(payments), "loan_id", "left"), unit)
