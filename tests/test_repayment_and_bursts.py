import statistics

import pytest

from airlend.operators import bursts, repayment
from tests.helpers import at, by, loans, money, payments


def test_paid_totals(spark):
    rows = [("a", 1, at(1), 3), ("b", 1, at(2), 4), ("a", 1, at(0), 5), ("a", None, at(9), 9), ("a", 2, at(1), None)]
    found = by(repayment.paid_totals(payments(spark, rows)).collect(), "loan_id")
    assert set(found) == {1, 2}
    assert (found[1].total_paid, found[1].last_pay_ts, found[1].msisdn) == (12, at(2), "b")
    assert found[2].total_paid is None


def test_days_and_targets(spark):
    taken = loans(spark, [("a", i, at(10, 3600), 10) for i in range(1, 7)])
    paid = [("a", 1, at(10, 7200), 10), ("a", 2, at(17), 10), ("a", 3, at(18), 10), ("a", 4, at(5), 10)]
    paid += [("x", 6, at(11), 10)]
    found = repayment.repayment_targets(repayment.loan_repayment(taken, payments(spark, paid)), [7])
    rows = by(found.collect(), "loan_id")
    assert [rows[i].days_to_pay for i in range(1, 7)] == [0, 7, 8, -5, None, None]
    assert [rows[i].target_7 for i in range(1, 7)] == [1, 1, 0, 1, 0, 0]
    assert rows[6].total_paid is None  # paid by another subscriber


def test_full_repayment(spark):
    taken = loans(spark, [("a", 1, at(1), 10), ("a", 2, at(1), 10)])
    repaid = repayment.loan_repayment(taken, payments(spark, [("a", 1, at(2), 10), ("a", 2, at(2), 9)]))
    rows = by(repayment.repayment_targets(repaid, [7], require_full_repayment=True).collect(), "loan_id")
    assert (rows[1].target_7, rows[2].target_7) == (1, 0)


@pytest.mark.parametrize("block_days", [None, 1])
def test_pay_day_features(spark, block_days):
    taken = loans(spark, [("a", i, at(10 * i), 10) for i in range(5)])
    days = {0: 1, 1: 4, 2: 9}
    paid = payments(spark, [("a", i, at(10 * i + d), 10) for i, d in days.items()])
    repaid = repayment.loan_repayment(taken, paid)
    found = repayment.pay_day_features(repaid, [10, 40], block_days=block_days)
    rows = by(found.collect(), "loan_id")
    assert rows[0].mean_pay_days_40 is None and rows[0].std_pay_days_40 is None
    assert (rows[1].mean_pay_days_10, rows[1].std_pay_days_10) == (1.0, None)
    assert (rows[4].min_pay_days_40, rows[4].max_pay_days_40) == (1, 9)
    assert rows[4].std_pay_days_40 == pytest.approx(statistics.stdev(days.values()))
    assert rows[4].mean_pay_days_10 is None  # the only loan in reach is not repaid
    assert found.columns[: len(repaid.columns)] == repaid.columns


@pytest.mark.parametrize("block_days", [None, 1])
def test_pay_days_known_by_the_loan_date(spark, block_days):
    taken = loans(spark, [("a", 1, at(0), 10), ("a", 2, at(5), 10), ("a", 3, at(9), 10)])
    repaid = repayment.loan_repayment(taken, payments(spark, [("a", 1, at(8), 10)]))
    later = by(repayment.pay_day_features(repaid, [30], False, block_days).collect(), "loan_id")
    known = by(repayment.pay_day_features(repaid, [30], True, block_days).collect(), "loan_id")
    assert later[2].mean_pay_days_30 == 8.0 and known[2].mean_pay_days_30 is None
    assert known[3].mean_pay_days_30 == 8.0


def test_burst_within_a_minute(spark):
    taken = loans(spark, [("a", 3, at(0, 5), 10), ("a", 1, at(0, 40), 20), ("a", 2, at(0, 60), 5)])
    paid = payments(spark, [("a", 1, at(3), 7), ("a", 3, at(2), 1)])
    rows = by(bursts.merge_loan_bursts(taken, paid).collect(), "loan_id")
    assert set(rows) == {3, 2}
    assert (rows[3].burst_amount, rows[3].burst_size, rows[3].burst_fee) == (30, 2, money("2.20"))
    assert (rows[3].loan_amount, rows[3].total_paid, rows[3].last_pay_ts) == (10, 8, at(2))
    assert (rows[2].burst_amount, rows[2].total_paid) == (5, None)


def test_burst_tie_takes_the_smaller_id(spark):
    taken = loans(spark, [("a", 8, at(0, 5), 10), ("a", 7, at(0, 5), 20), ("b", 9, at(0, 5), 1)])
    rows = by(bursts.merge_loan_bursts(taken, payments(spark, [])).collect(), "msisdn")
    assert (rows["a"].loan_id, rows["a"].burst_amount) == (7, 30)
    assert sum(r.burst_amount for r in rows.values()) == 31
