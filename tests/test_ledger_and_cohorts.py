from datetime import datetime

import pytest

from airlend.operators import cohorts
from airlend.operators import ledger as lg
from airlend.plans.cohort import cohort_bucket_recharges, month_period
from tests.helpers import by, ledger, utc


def day(n, month=1):
    return datetime(2023, month, n, 10)


def finance(spark, rows):
    """Rows (msisdn, ts, qualified amount, chosen amount)."""
    schema = "msisdn string, advance_ts timestamp, qualified_amount double, chosen_amount int"
    return spark.createDataFrame([(m, utc(t), q, c) for m, t, q, c in rows], schema)


ROWS = [
    ("a", day(1), 10.0, "Customer", "Recharge", 0, 1),
    ("a", day(1), 5.0, "Customer", "Recharge", 0, 0),
    ("a", day(2), 20.0, "SP", "Loan", 1, 1),
    ("b", day(2), 20.0, "SP", "Loan", 1, 1),
    ("b", day(2), None, "Organization", None, 2, 1),
]


def test_daily_summaries(spark):
    df = ledger(spark, ROWS)
    assert {r.day.day: r.n for r in lg.daily_counts(df).collect()} == {1: 2, 2: 3}
    (loan,) = lg.loan_daily(df).collect()
    assert (loan.loan_sum, loan.loan_count) == (40.0, 2)
    (loan,) = lg.loan_amount_daily(df).collect()
    assert (loan.amount, loan.loan_sum, loan.loan_count) == (20.0, 40.0, 2)
    assert {(r.profile_eligibility, r.amount_sum) for r in lg.recharge_profile(df).collect()} == {(1, 10.0), (0, 5.0)}
    rows = by(lg.recharge_payment_daily(df).collect(), "operation_type")
    assert (rows[0].n, rows[0].amount_sum) == (2, 15.0) and (rows[2].n, rows[2].amount_sum) == (0, None)
    kinds = by(lg.recharge_type_daily(df).collect(), "transaction_text", "profile_eligibility")
    assert kinds["Recharge", 0].n == 1 and kinds[None, 1].n == 0


def test_rows_without_a_date_count_zero(spark):
    df = ledger(spark, ROWS[:1]).selectExpr("cast(null as timestamp) AS event_ts", "amount")
    (row,) = lg.daily_counts(df).collect()
    assert (row.day, row.n) == (None, 0)


def test_buckets(spark):
    amounts = [50.0, 50.01, 100.0, 150.0, 200.0, 200.01, None]
    df = spark.createDataFrame(list(enumerate(amounts)), "n int, qualified_amount double")
    rows = by(cohorts.with_amount_bucket(df).collect(), "n")
    buckets = [rows[n].qualified_bucket for n in range(len(amounts))]
    assert buckets == ["50", "50-100", "50-100", "100-150", "150-200", "> 200", None]


def test_period_is_half_open_and_may_be_open(spark):
    df = ledger(spark, [("a", datetime(2023, 1, d), 1.0, "x", "x", 0, 0) for d in (1, 2, 3)])
    assert cohorts.in_period(df, "event_ts", "2023-01-01", "2023-01-03").count() == 2
    assert cohorts.in_period(df, "event_ts", hi="2023-01-02").count() == 1
    assert cohorts.in_period(df, "event_ts").count() == 3


def test_period_reaches_the_scan(spark, tmp_path):
    ledger(spark, ROWS).write.parquet(str(tmp_path / "ledger"))
    df = cohorts.in_period(spark.read.parquet(str(tmp_path / "ledger")), "event_ts", "2023-01-01", "2023-02-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in plan


def test_customer_recharges_drop_missing_text(spark):
    rows = [
        ("a", day(1), 1.0, "Customer", "Recharge", 0, 1),
        ("a", day(1), 2.0, "Customer", "B2C Reversal", 0, 1),
        ("a", day(1), 4.0, "Customer", None, 0, 1),
        ("a", day(1), 8.0, "SP", "Recharge", 0, 1),
        ("a", day(1), 16.0, "Customer", "Recharge", 1, 1),
    ]
    assert [r.amount for r in cohorts.customer_recharges(ledger(spark, rows)).collect()] == [1.0]


def recharge(msisdn, ts, amount):
    return (msisdn, ts, amount, "Customer", "Recharge", 0, 1)


def test_cohort_bucket_recharges(spark):
    advances = finance(
        spark,
        [("a", day(3), 40.0, 20), ("a", day(9), 60.0, 20), ("a", day(9), 61.0, 20), ("b", day(3, 2), 40.0, 20)],
    )
    rows = [
        recharge("a", datetime(2022, 12, 31, 23), 1.0),
        recharge("a", day(1), 2.0),
        recharge("a", day(1), 2.0),  # a repeated row counts once
        recharge("a", day(31), 4.0),
        recharge("a", day(1, 3), 8.0),
        recharge("b", day(1), 16.0),
    ]
    found = cohort_bucket_recharges(advances, ledger(spark, rows), "2023-01-01").collect()
    assert {r.qualified_bucket for r in found} == {"50", "50-100"} and len(found) == 2
    assert {tuple(r)[2:] for r in found} == {(1.0, 6.0, None, 8.0)}


def test_m0_daily_recharges_are_not_multiplied_by_loans(spark):
    advances = finance(spark, [("a", day(3), 40.0, 20), ("a", day(9), 60.0, 20)])
    rows = [recharge("a", day(1), 2.0), recharge("a", day(1), 2.0), recharge("b", day(1), 2.0)]
    (row,) = cohorts.m0_daily_recharges(advances, ledger(spark, rows), month_period("2023-01-01")).collect()
    assert (row.msisdn, row.amount_sum) == ("a", 4.0)


def test_amount_peers_counts_the_pairs_of_a_self_join(spark):
    data = [("a", 20.0), ("a", 20.0), ("b", 20.0), ("c", 30.0), ("d", None)]
    advances = finance(spark, [(m, day(1), q, 1) for m, q in data])
    pairs = advances.alias("x").join(advances.alias("y"), "qualified_amount")
    expected = {(r[0], r[1]): r[2] for r in pairs.groupBy("qualified_amount", "y.msisdn").count().collect()}
    found = cohorts.amount_peers(advances, salts=3).collect()
    assert {(r.qualified_amount, r.msisdn): r.n_pairs for r in found} == expected


def test_subscribers_with_amount(spark):
    advances = finance(spark, [("a", day(1), 1.0, 20), ("a", day(2), 1.0, 20), ("b", day(1), 1.0, 30)])
    assert [r.msisdn for r in cohorts.subscribers_with_amount(advances, 20).collect()] == ["a"]


@pytest.mark.parametrize(
    "offset, expected",
    [(0, ("2023-01-01", "2023-02-01")), (-1, ("2022-12-01", "2023-01-01")), (12, ("2024-01-01", "2024-02-01"))],
)
def test_month_period(offset, expected):
    assert month_period("2023-01-01", offset) == expected
