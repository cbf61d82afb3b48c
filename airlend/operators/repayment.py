"""Loans and their repayments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlend.operators.rolling import rolling


def paid_per_loan(payments: DataFrame, *keys: str) -> DataFrame:
    """total_paid and last_pay_ts per loan id (and further keys).

    Payments that name no loan cannot be joined and are left out before the shuffle.
    """
    return (
        payments.filter(F.col("loan_id").isNotNull())
        .groupBy("loan_id", *keys)
        .agg(F.sum("pay_amount").alias("total_paid"), F.max("pay_ts").alias("last_pay_ts"))
    )


def paid_totals(payments: DataFrame) -> DataFrame:
    """Per loan: total paid, last payment time and the subscriber of that payment (of several at that time
    the last by number).

    Payments are first reduced per loan and subscriber by a hash aggregate; only the few rows left, mostly one
    per loan, are compared as structs.
    """
    per_payer = paid_per_loan(payments, "msisdn")
    last = F.max(F.struct("last_pay_ts", "msisdn"))
    return (
        per_payer.groupBy("loan_id")
        .agg(F.sum("total_paid").alias("total_paid"), last.alias("last"))
        .select("loan_id", "last.msisdn", "total_paid", "last.last_pay_ts")
    )


def loan_repayment(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Loans with total paid, last payment time and days to pay, NULL where nothing was paid.

    A loan and its payments must agree on loan id and subscriber. The totals have one row per loan id, so
    joining on the id and blanking the rows of another subscriber gives the same rows, and the totals need
    no second shuffle.
    """
    paid = paid_totals(payments).withColumnRenamed("msisdn", "payer")
    same = F.col("payer") == F.col("msisdn")
    return (
        loans.join(paid, "loan_id", "left")
        .select(
            *loans.columns,
            F.when(same, F.col("total_paid")).alias("total_paid"),
            F.when(same, F.col("last_pay_ts")).alias("last_pay_ts"),
        )
        .withColumn("days_to_pay", F.datediff("last_pay_ts", "loan_ts"))
    )


def target(
    days: int, require_full_repayment: bool, loan_amount: str = "loan_amount", total_paid: str = "total_paid"
) -> Column:
    """1 if the last payment came within `days` days (and, on request, all was paid), else 0."""
    paid = F.col("days_to_pay") <= days
    if require_full_repayment:
        paid = paid & (F.col(total_paid) >= F.col(loan_amount))
    return F.when(paid, 1).otherwise(0)


def repayment_targets(
    repayment: DataFrame,
    windows: Sequence[int],
    require_full_repayment: bool = False,
    loan_amount: str = "loan_amount",
    total_paid: str = "total_paid",
) -> DataFrame:
    return repayment.withColumns(
        {f"target_{n}": target(n, require_full_repayment, loan_amount, total_paid) for n in windows}
    )


# What a loan adds to the pay-day aggregates: whole days, so sums and squares are exact.
DAY_PARTIALS = {"days_n": "sum", "days_sum": "sum", "days_sq": "sum", "days_min": "min", "days_max": "max"}


# The same as SQL over days_to_pay.
DAY_CELLS = (
    "CASE WHEN days_to_pay IS NOT NULL THEN 1L END AS days_n",
    "CAST(days_to_pay AS BIGINT) AS days_sum",
    "CAST(days_to_pay AS BIGINT) * days_to_pay AS days_sq",
    "CAST(days_to_pay AS BIGINT) AS days_min",
    "CAST(days_to_pay AS BIGINT) AS days_max",
)


def pay_day_columns(windows: Sequence[int]) -> list[str]:
    """{mean,max,min,std}_pay_days_N; the sample deviation is NULL below two values."""
    cells = []
    for n in windows:
        number, total, square = (f"days_{part}_back_{n}" for part in ("n", "sum", "sq"))
        # n * sum(x^2) - sum(x)^2 in whole numbers: no digits cancel.
        wide = "CAST({} AS DECIMAL(19, 0))".format
        spread = f"{wide(number)} * {wide(square)} - {wide(total)} * {wide(total)}"
        pairs = f"(CAST({number} AS DOUBLE) * ({number} - 1))"
        cells += [
            f"CASE WHEN {number} > 0 THEN CAST({total} AS DOUBLE) / {number} END AS mean_pay_days_{n}",
            f"days_max_back_{n} AS max_pay_days_{n}",
            f"days_min_back_{n} AS min_pay_days_{n}",
            f"CASE WHEN {number} > 1 THEN sqrt(CAST({spread} AS DOUBLE) / {pairs}) END AS std_pay_days_{n}",
        ]
    return cells


def repayments_as_points(repayment: DataFrame) -> DataFrame:
    """Days to pay at the second of the last payment, as points for `rolling`."""
    paid = repayment.filter(F.col("last_pay_ts").isNotNull())
    return paid.selectExpr("msisdn", "unix_seconds(last_pay_ts) AS epoch", *DAY_CELLS)


def pay_day_features(
    repayment: DataFrame,
    windows: Sequence[int],
    known_by_loan_date: bool = False,
    block_days: int | None = None,
) -> DataFrame:
    """The loans with {mean,max,min,std}_pay_days_N over the subscriber's loans of the N days before.

    An earlier loan may have been repaid after the current one was taken. With `known_by_loan_date` the look
    back is by payment time instead, so that only repayments made before the current loan count.
    """
    at_loan = ["msisdn", "unix_seconds(loan_ts) AS epoch", f"struct({', '.join(repayment.columns)}) AS payload"]
    if known_by_loan_date:
        points, results = repayments_as_points(repayment), repayment.selectExpr(*at_loan)
    else:
        points, results = repayment.selectExpr(*at_loan, *DAY_CELLS), None
    rolled = rolling(points, DAY_PARTIALS, windows, results=results, block_days=block_days)
    return rolled.selectExpr(*repayment.columns, *pay_day_columns(windows))
