"""Profiles of loans, payments and recharges: distributions and averages per subscriber, loan and time.

Every profile reduces to one row per subscriber (or loan) and period before anything else, so subscribers and
amounts with very many rows are combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airlend.functions import columns as C
from airlend.operators.cohorts import in_period
from airlend.operators.dataset import next_day
from airlend.operators.skew import filter_by_subscribers


#: Loans and months are nearly as many as payments, so they are counted in so many times the usual number of tasks.
LOAN_MONTH_TASKS = 4


def _mean(total: Column, n: Column) -> Column:
    return total.cast("double") / n


def monthly_loan_value(loans: DataFrame) -> DataFrame:
    """month, n_loans, loan_sum, mean_loan."""
    return (
        loans.groupBy(C.month("loan_ts").alias("month"))
        .agg(F.count("loan_amount").alias("n_loans"), F.sum("loan_amount").alias("loan_sum"))
        .withColumn("mean_loan", _mean(F.col("loan_sum"), F.col("n_loans")))
    )


def loans_per_subscriber_month(loans: DataFrame) -> DataFrame:
    """month, n_loans, n_subscribers: how many subscribers took that many loans in the month."""
    per_subscriber = loans.groupBy("msisdn", C.month("loan_ts").alias("month")).agg(
        F.count("*").alias("n_loans")
    )
    return per_subscriber.groupBy("month", "n_loans").agg(F.count("*").alias("n_subscribers"))


def days_between_loans(loans: DataFrame) -> DataFrame:
    """days, n: days from a loan to the subscriber's next one, and how often.

    Loans of a day are counted first: all but one of them follow at 0 days, and only one row per subscriber
    and day is ordered.
    """
    days = loans.groupBy("msisdn", F.to_date("loan_ts").alias("date")).agg(F.count("*").alias("n"))
    previous = F.lag("date").over(Window.partitionBy("msisdn").orderBy("date"))
    gaps = days.select("n", F.datediff("date", previous).alias("gap"))
    steps = gaps.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("days"), (F.col("n") - 1).alias("n")),
                F.struct(F.col("gap").alias("days"), F.lit(1).cast("bigint").alias("n")),
            )
        )
    )
    counted = steps.filter(F.col("days").isNotNull() & (F.col("n") > 0))
    return counted.groupBy("days").agg(F.sum("n").alias("n"))


def repayment_time(repayment: DataFrame, within: int = 30) -> DataFrame:
    """days_to_pay (NULL for unpaid), n_loans, loan_sum, recovered (within the days given)."""
    return repayment.groupBy("days_to_pay").agg(
        F.count("*").alias("n_loans"),
        F.sum("loan_amount").alias("loan_sum"),
        F.sum("total_paid").alias("paid_sum"),
        F.coalesce(F.max(F.col("days_to_pay") <= within), F.lit(False)).alias("recovered"),
    )


def payment_timing(payments: DataFrame) -> DataFrame:
    """day_of_month, hour, n, paid_sum, mean_paid: when payments come and how large they are."""
    return (
        payments.groupBy(F.dayofmonth("pay_ts").alias("day_of_month"), F.hour("pay_ts").alias("hour"))
        .agg(F.count("pay_amount").alias("n"), F.sum("pay_amount").alias("paid_sum"))
        .withColumn("mean_paid", _mean(F.col("paid_sum"), F.col("n")))
    )


def loan_size_repayment(repayment: DataFrame, step: int) -> DataFrame:
    """loan_size (lower end of a band `step` wide), n_loans, n_paid, loan_sum, paid_sum."""
    band = (F.floor(F.col("loan_amount") / step) * step).cast("bigint")
    return repayment.groupBy(band.alias("loan_size")).agg(
        F.count("*").alias("n_loans"),
        F.count("total_paid").alias("n_paid"),
        F.sum("loan_amount").alias("loan_sum"),
        F.sum("total_paid").alias("paid_sum"),
    )


def payments_per_loan_month(payments: DataFrame) -> DataFrame:
    """month, n_loans, n_payments, mean_payments: payments per loan paid on in the month.

    The payments are dealt out by loan first. Where they come from a join on the loan, their counts would else be kept
    in the join's own tasks, beside its sorts.
    """
    tasks = LOAN_MONTH_TASKS * int(payments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_loan = (
        payments.filter(F.col("loan_id").isNotNull())
        .select("loan_id", C.month("pay_ts").alias("month"))
        .repartition(tasks, "loan_id")
        .groupBy("loan_id", "month")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_loan.groupBy("month")
        .agg(F.count("*").alias("n_loans"), F.sum("n").alias("n_payments"))
        .withColumn("mean_payments", _mean(F.col("n_payments"), F.col("n_loans")))
    )


def recharges_per_subscriber_month(recharges: DataFrame, *by: str) -> DataFrame:
    """month, n_subscribers, mean_amount, mean_number: recharges of a subscriber in the month, averaged; for
    each value of the columns `by` (eligibility, kind of row) on its own."""
    per_subscriber = recharges.groupBy("msisdn", C.month("recharge_ts").alias("month"), *by).agg(
        F.sum("recharge_amount").alias("amount"), F.count("*").alias("n")
    )
    totals = per_subscriber.groupBy("month", *by).agg(
        F.count("*").alias("n_subscribers"),
        F.sum("amount").alias("amount"),
        F.sum("n").alias("n"),
    )
    return totals.select(
        "month",
        *by,
        "n_subscribers",
        _mean(F.col("amount"), F.col("n_subscribers")).alias("mean_amount"),
        _mean(F.col("n"), F.col("n_subscribers")).alias("mean_number"),
    )


def recharge_amounts(recharges: DataFrame) -> DataFrame:
    """recharge_amount, n: the denominations and how often they are bought."""
    return recharges.groupBy("recharge_amount").agg(F.count("*").alias("n"))


def recharges_before_loan_month(loans: DataFrame, recharges: DataFrame, m0: str, months: int = 3) -> DataFrame:
    """msisdn and, for each of the months before M0, recharge sum, number and mean, for subscribers who took a
    loan in M0. Recharges become a row per subscriber before they meet the loans."""
    first = F.lit(m0).cast("timestamp")
    periods = {k: (F.add_months(first, -k), F.add_months(first, 1 - k)) for k in range(1, months + 1)}
    # One range over all the months, so the scan reads no others.
    near = recharges.filter((F.col("recharge_ts") >= periods[months][0]) & (F.col("recharge_ts") < first))
    cells = []
    for k, (lo, hi) in periods.items():
        amount = F.when((F.col("recharge_ts") >= lo) & (F.col("recharge_ts") < hi), F.col("recharge_amount"))
        cells += [F.sum(amount).alias(f"sum_m_minus_{k}"), F.count(amount).alias(f"n_m_minus_{k}")]
    sums = near.groupBy("msisdn").agg(*cells)
    borrowers = loans.filter(
        (F.col("loan_ts") >= first) & (F.col("loan_ts") < F.add_months(first, 1))
    ).select("msisdn")
    means = {
        f"mean_m_minus_{k}": F.when(
            F.col(f"n_m_minus_{k}") > 0, _mean(F.col(f"sum_m_minus_{k}"), F.col(f"n_m_minus_{k}"))
        )
        for k in periods
    }
    return sums.join(borrowers.distinct(), "msisdn", "left_semi").withColumns(means)


def recharge_days(recharges: DataFrame) -> DataFrame:
    """day_of_week (1 is Sunday), day_of_month, n, n_subscriber_days: when people recharge."""
    per_day = recharges.groupBy("msisdn", F.to_date("recharge_ts").alias("date")).agg(F.count("*").alias("n"))
    return per_day.groupBy(
        F.dayofweek("date").alias("day_of_week"), F.dayofmonth("date").alias("day_of_month")
    ).agg(F.sum("n").alias("n"), F.count("*").alias("n_subscriber_days"))


def cohort_extract(
    loans: DataFrame,
    payments: DataFrame,
    recharges: DataFrame,
    suffixes: Sequence[str],
    loan_period: tuple[str, str],
    history: tuple[str, str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loans, payments and recharges of the history for subscribers with one of the number endings who took a
    loan in the loan period. Periods are first and last day.

    The ending is tested on every table before the join, so only matching rows are shuffled, and the rows of
    one subscriber are spread over several join tasks.
    """

    def ending(df: DataFrame) -> DataFrame:
        return df.filter(F.substring("msisdn", -len(suffixes[0]), len(suffixes[0])).isin(list(suffixes)))

    def days(df: DataFrame, ts: str, span: tuple[str, str]) -> DataFrame:
        return in_period(df, ts, span[0], next_day(span[1]))

    if len({len(suffix) for suffix in suffixes}) != 1:
        raise ValueError("the number endings must have one length")
    cohort = ending(days(loans, "loan_ts", loan_period)).select("msisdn").distinct()
    tables = ((loans, "loan_ts"), (payments, "pay_ts"), (recharges, "recharge_ts"))
    return tuple(
        filter_by_subscribers(ending(days(df, ts, history)), cohort, "left_semi") for df, ts in tables
    )


def entity_daily_recharges(recharges: DataFrame) -> DataFrame:
    """msisdn, entity_type, day, amount_sum."""
    return recharges.groupBy("msisdn", "entity_type", C.day("recharge_ts").alias("day")).agg(
        F.sum("recharge_amount").alias("amount_sum")
    )


def subscribers_per_amount(loans: DataFrame, amount: str = "loan_amount") -> DataFrame:
    """The amount and how many subscribers took it. Repeated takers are removed by amount and subscriber
    first, which spreads a common amount over all tasks."""
    return loans.groupBy(amount).agg(F.count_distinct("msisdn").alias("n_subscribers"))
