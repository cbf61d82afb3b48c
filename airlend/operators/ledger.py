"""Daily and per-type summaries of the transaction ledger.

All are one grouped aggregate with a partial aggregate before the shuffle: what is shuffled is one row per
group and map task, however many rows a group has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.functions import columns as C
from airlend.schemas import LOAN, PAYMENT, RECHARGE


def daily_counts(ledger: DataFrame) -> DataFrame:
    """Rows per day; rows without a date form a group whose count is 0."""
    return ledger.groupBy(C.day("event_ts").alias("day")).agg(F.count("event_ts").alias("n"))


def _loans(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("operation_type") == LOAN)


def loan_daily(ledger: DataFrame) -> DataFrame:
    """Loan sum and number per day."""
    return (
        _loans(ledger)
        .groupBy(C.day("event_ts").alias("day"))
        .agg(F.sum("amount").alias("loan_sum"), F.count("event_ts").alias("loan_count"))
    )


def loan_amount_daily(ledger: DataFrame) -> DataFrame:
    """Loan sum and number per amount and day."""
    return (
        _loans(ledger)
        .groupBy("amount", C.day("event_ts").alias("day"))
        .agg(F.sum("amount").alias("loan_sum"), F.count("event_ts").alias("loan_count"))
    )


def recharge_profile(ledger: DataFrame) -> DataFrame:
    """Recharge sum per party, transaction text and eligibility."""
    return (
        ledger.filter(F.col("operation_type") == RECHARGE)
        .groupBy("other_party", "transaction_text", "profile_eligibility")
        .agg(F.sum("amount").alias("amount_sum"))
    )


def _recharges_and_payments(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("operation_type").isin(RECHARGE, PAYMENT))


def recharge_payment_daily(ledger: DataFrame) -> DataFrame:
    """Number and sum of recharges and of payments per day."""
    return (
        _recharges_and_payments(ledger)
        .groupBy(C.day("event_ts").alias("day"), "operation_type")
        .agg(F.count("amount").alias("n"), F.sum("amount").alias("amount_sum"))
    )


def recharge_type_daily(ledger: DataFrame) -> DataFrame:
    """Sum and number per transaction text, day and eligibility, eligible and not eligible in one result."""
    return (
        _recharges_and_payments(ledger)
        .groupBy("transaction_text", C.day("event_ts").alias("day"), "profile_eligibility")
        .agg(F.sum("amount").alias("amount_sum"), F.count("transaction_text").alias("n"))
    )
