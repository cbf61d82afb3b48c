"""Look-back and look-ahead frames: edges, ties, NULLs, and blocks of several lengths."""

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from airlend.operators import rolling
from airlend.operators import timeline as tl
from tests.helpers import START, at, by, loans, timeline

DAY = 86_400
WAYS = pytest.mark.parametrize("block_days", [None, 1, 5])


@WAYS
def test_frame_edges(spark, block_days):
    n = 7
    loan = at(20, 500)
    rows = [("a", 1, loan, 10, "L")]
    rows += [
        ("a", 0, loan + timedelta(seconds=s), 2**k, "R")
        for k, s in enumerate((-n * DAY - 1, -n * DAY, -1, 0, n * DAY, n * DAY + 1))
    ]
    (row,) = tl.timeline_features(timeline(spark, rows), None, [n], block_days=block_days).collect()
    assert row.count_spend_7 == 2 and row.sum_spend_7 == 2 + 4
    assert row.min_spend_7 == 2 and row.max_spend_7 == 4 and row.mean_spend_7 == 3.0
    assert row.future_spend_sum_7 == 8 + 16
    assert row.count_loan_7 == 0 and row.future_loan_sum_7 == 10 and row.future_loan_count_7 == 1


@WAYS
def test_first_loan_has_counts_and_no_sums(spark, block_days):
    line = timeline(spark, [("a", 1, at(3), 5, "L")])
    (row,) = tl.lookback_features(line, None, [1, 30], block_days=block_days).collect()
    for n in (1, 30):
        for kind in ("loan", "spend"):
            assert row[f"count_{kind}_{n}"] == 0
            assert all(row[f"{part}_{kind}_{n}"] is None for part in ("sum", "mean", "max", "min"))


@WAYS
def test_forward_counts_loans_only_and_knows_missing_amounts(spark, block_days):
    rows = [
        ("a", 1, at(0, 1000), 5, "L"),
        ("a", 0, at(0, 1000), 7, "R"),
        ("a", 0, at(0, 1001), None, "R"),
        ("a", 2, at(0, 1002), 3, "L"),
        ("a", 3, at(0, 1002), 4, "L"),
        ("b", 4, at(0, 1000), None, "L"),
    ]
    ahead = tl.forward_features(timeline(spark, rows), None, [1], block_days=block_days)
    found = by(ahead.collect(), "loan_id")
    assert found[1].future_loan_count_1 == 3 and found[1].future_loan_sum_1 == 12
    assert found[1].future_spend_sum_1 == 7
    assert found[2].future_loan_count_1 == found[3].future_loan_count_1 == 2
    assert found[2].future_spend_sum_1 == 0
    assert found[4].future_loan_sum_1 is None and found[4].future_spend_sum_1 == 0
    back = tl.lookback_features(timeline(spark, rows), None, [1], block_days=block_days)
    found = by(back.collect(), "loan_id")
    assert found[2].count_spend_1 == 2 and found[2].sum_spend_1 == 7 and found[2].mean_spend_1 == 7.0


@WAYS
def test_model_loans_restrict_rows_and_give_amounts(spark, block_days):
    rows = [("a", 1, at(0), 5, "L"), ("a", 2, at(1), 6, "L"), ("a", 3, at(2), 7, "L")]
    model = loans(spark, [("a", 3, at(2), 20), ("a", 9, at(2), 1)])
    found = tl.lookback_features(timeline(spark, rows), model, [7], block_days=block_days).collect()
    assert [(r.loan_id, r.amount, r.count_loan_7, r.sum_loan_7) for r in found] == [(3, 20, 2, 11)]


def random_rows(seed, n=400, days=40, subscribers=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Few distinct seconds of the day, so that frames end on rows and seconds repeat.
        ts = START + timedelta(days=rng.randrange(days), seconds=rng.choice((0, 1, 43_200, 43_201, 86_399)))
        ts += timedelta(microseconds=rng.choice((0, 999_999)))
        amount = None if rng.random() < 0.1 else Decimal(rng.randrange(-500, 5000)) / 100
        op = rng.choice("LR")
        rows.append((f"m{rng.randrange(subscribers)}", i + 1 if op == "L" else 0, ts, amount, op))
    return rows


def brute_force(rows, windows):
    second = lambda ts: int((ts - START).total_seconds() // 1)
    found = {}
    for msisdn, loan_id, ts, _, op in rows:
        if op != "L":
            continue
        t, cells = second(ts), {}
        for n in windows:
            mine = [(second(r[2]) - t, r[3], r[4]) for r in rows if r[0] == msisdn]
            for kind, code in (("loan", "L"), ("spend", "R")):
                back = [a for s, a, o in mine if o == code and -n * DAY <= s < 0]
                known = [a for a in back if a is not None]
                cells[f"count_{kind}_{n}"] = len(back)
                cells[f"sum_{kind}_{n}"] = sum(known) if known else None
                cells[f"max_{kind}_{n}"] = max(known, default=None)
                cells[f"min_{kind}_{n}"] = min(known, default=None)
                cells[f"mean_{kind}_{n}"] = float(sum(known)) / len(known) if known else None
            ahead = [(a, o) for s, a, o in mine if 0 <= s <= n * DAY]
            for kind, code in (("loan", "L"), ("spend", "R")):
                values = [a if o == code else 0 for a, o in ahead]
                values = [v for v in values if v is not None]
                cells[f"future_{kind}_sum_{n}"] = sum(values) if values else None
            cells[f"future_loan_count_{n}"] = sum(o == "L" for _, o in ahead)
        found[loan_id] = cells
    return found


@pytest.mark.parametrize("block_days", [None, 1, 7, 1000])
def test_against_brute_force(spark, block_days):
    windows = [1, 2, 7, 30]
    rows = random_rows(3) + random_rows(4, n=60, subscribers=1)
    rows = [(m, i if i == 0 else k + 1, ts, a, op) for k, (m, i, ts, a, op) in enumerate(rows)]
    ours = tl.timeline_features(timeline(spark, rows), None, windows, block_days=block_days).collect()
    expected = brute_force(rows, windows)
    assert len(ours) == len(expected)
    for row in ours:
        for name, value in expected[row.loan_id].items():
            assert row[name] == value, (row.loan_id, name)


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_while(spark, name: str, build):
    """What `build` returns, and the jobs that it started."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        made = build()
        return made, spark.sparkContext.statusTracker().getJobIdsForGroup(name)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_before_the_action(spark):
    line = timeline(spark, random_rows(8, n=90))
    model = line.filter("op = 'L'").selectExpr("msisdn", "loan_id", "ts AS loan_ts", "amount AS loan_amount")
    for loans_wanted in (None, model):
        build = lambda: tl.timeline_features(line, loans_wanted, [1, 7])  # noqa: B023, E731
        features, jobs = jobs_while(spark, f"features-{loans_wanted is None}", build)
        assert list(jobs) == []
    _, jobs = jobs_while(spark, "features-action", features.collect)
    assert len(jobs) > 0


def test_one_shuffle_by_subscriber_and_block(spark):
    plan = executed_plan(tl.timeline_features(timeline(spark, random_rows(7, n=30)), None, [1, 7, 30]))
    assert plan.count("Exchange hashpartitioning(msisdn") == plan.count("Exchange") == 1
    assert plan.count("Window [") == 2 and "Python" not in plan
    ahead = executed_plan(tl.forward_features(timeline(spark, random_rows(7, n=30)), None, [1, 7, 30]))
    assert ahead.count("Exchange") == 1 and ahead.count("Window [") == 1


def test_a_subscriber_is_spread_over_blocks(spark):
    line = timeline(spark, [("a", k + 1, at(k), 1, "L") for k in range(400)])
    points = line.selectExpr("msisdn", "unix_seconds(ts) AS epoch", "1L AS n", "struct(loan_id) AS payload")
    frames = rolling._Frames({"n": "sum"}, [7], [], True, ["n"])
    sent = frames.blocked(points, 14)
    blocks = [r["count"] for r in sent.groupBy("block").count().collect()]
    assert len(blocks) >= 28 and max(blocks) <= 14 + 7 and sum(blocks) <= 400 * 1.6
    assert sent.filter("payload IS NOT NULL").count() == 400


def test_work_does_not_grow_with_the_rows_in_a_frame(spark):
    """A subscriber with 60,000 rows in one window: frames over all of them would be thousands of millions of steps."""
    n = 60_000
    line = spark.range(n).selectExpr(
        "'a' AS msisdn", "id AS loan_id", "timestamp_seconds(1640995200 + id * 10) AS ts",
        "CAST(id % 97 AS DECIMAL(18, 2)) AS amount", "IF(id % 2 = 0, 'L', 'R') AS op",
    )
    found = tl.timeline_features(line, None, [7, 30])
    last = found.filter(f"loan_id = {n - 2}").first()
    back = range(max(0, n - 2 - 7 * DAY // 10), n - 2)
    assert last.count_loan_7 == len([k for k in back if k % 2 == 0])
    assert last.sum_spend_30 == sum(k % 97 for k in range(n - 2) if k % 2) and last.max_loan_7 == 96
    assert last.min_spend_7 == 0 and last.future_loan_count_30 == 1


def test_later_rows_do_not_change_the_look_back(spark):
    rows = random_rows(5, n=120)
    cut = START + timedelta(days=20)
    early = [r for r in rows if r[2] < cut]
    windows = [1, 7, 30]
    whole = by(tl.lookback_features(timeline(spark, rows), None, windows).collect(), "loan_id")
    part = by(tl.lookback_features(timeline(spark, early), None, windows).collect(), "loan_id")
    assert part and all(whole[k] == row for k, row in part.items())


def test_future_loan_sums_grow_with_the_window(spark):
    rows = [(m, i, ts, abs(a or 0), op) for m, i, ts, a, op in random_rows(6, n=150)]
    for row in tl.forward_features(timeline(spark, rows), None, [1, 7, 30]).collect():
        assert row.future_loan_sum_1 <= row.future_loan_sum_7 <= row.future_loan_sum_30
        assert row.future_loan_count_1 <= row.future_loan_count_7 <= row.future_loan_count_30


def test_future_spend_corrected(spark):
    rows = [("a", 1, at(0), 5, "L"), ("a", 2, at(1), 5, "L"), ("a", 0, at(2), 30, "R")]
    ahead = tl.forward_features(timeline(spark, rows), None, [7])
    found = by(tl.future_spend_corrected(ahead, [7]).collect(), "loan_id")
    assert found[1].future_service_fee_sum_7 == pytest.approx(2.2)
    assert found[1].future_spend_sum_corrected_7 == pytest.approx(30 - 10 - 2.2)


@WAYS
@pytest.mark.parametrize("with_model", [False, True])
def test_loans_without_time_come_back_with_empty_frames(spark, block_days, with_model):
    rows = [("a", 1, at(0), 5, "L"), ("a", 2, None, 6, "L"), (None, 3, at(1), 7, "L"), ("a", 4, at(1), 8, "L")]
    line = timeline(spark, rows)
    model = loans(spark, [("a", 2, None, 6), ("a", 4, at(1), 8)]) if with_model else None
    found = by(tl.timeline_features(line, model, [7], block_days=block_days).collect(), "loan_id")
    assert set(found) == ({2, 4} if with_model else {1, 2, 3, 4})
    assert found[4].count_loan_7 == 1 and found[4].sum_loan_7 == 5
    assert found[2].count_loan_7 == 0 and found[2].sum_loan_7 is None and found[2].amount == 6


def test_inexact_amounts_give_the_same_rows_in_all_blocks(spark):
    rows = [(m, k, ts, a, op) for k, (m, _, ts, a, op) in enumerate(random_rows(12, n=399, subscribers=1))]
    line = timeline(spark, rows).withColumn("amount", F.col("amount").cast("double") * 1.1)
    one, other, both = (
        sorted(map(str, tl.timeline_features(line, None, [1, 7, 30], block_days=d).collect())) for d in (None, 1, 2000)
    )
    assert one == other == both


@WAYS
@pytest.mark.parametrize("kind", ["double", "decimal(30,4)", "decimal(9,3)"])
def test_other_amount_types(spark, kind, block_days):
    rows = [("a", 1, at(0), 5.25, "L"), ("a", 2, at(1), 6.5, "L")]
    line = timeline(spark, rows).selectExpr("msisdn", "loan_id", "ts", f"cast(amount as {kind}) amount", "op")
    found = by(tl.timeline_features(line, None, [7], block_days=block_days).collect(), "loan_id")
    assert float(found[2].sum_loan_7) == 5.25 and float(found[1].future_loan_sum_7) == 11.75


def test_windows_need_a_day(spark):
    with pytest.raises(ValueError):
        tl.lookback_features(timeline(spark, [("a", 1, at(0), 5, "L")]), None, [0, 7])


def test_amounts_that_do_not_fit_raise_an_error(spark):
    line = timeline(spark, [("a", 1, at(0), 20_000_000_000, "L"), ("a", 2, at(1), 5, "L")])
    with pytest.raises(Exception, match="too large"):
        tl.lookback_features(line, None, [7]).collect()


@pytest.mark.parametrize("paired", [0, 3, 32])
def test_pairs_and_frames_give_the_same(spark, monkeypatch, paired):
    monkeypatch.setattr(rolling, "PAIRED", paired)
    windows = [1, 2, 7, 30]
    rows = random_rows(21, n=300) + random_rows(22, n=60, subscribers=1) + [(f"few{k}", 1, at(k, 5), k, "L") for k in range(9)]
    rows += [(f"few{k}", 0, at(k + d, 4), 7, "R") for k in range(9) for d in (-30, -2, 0, 3)]
    rows = [(m, i if i == 0 else k + 1, ts, a, op) for k, (m, i, ts, a, op) in enumerate(rows)]
    line = timeline(spark, rows)
    model = line.filter("op = 'L'").selectExpr("msisdn", "loan_id", "ts AS loan_ts", "amount AS loan_amount")
    ours = tl.timeline_features(line, model, windows, block_days=7).collect()
    expected = brute_force(rows, windows)
    assert len(ours) == len(expected)
    for row in ours:
        for name, value in expected[row.loan_id].items():
            assert row[name] == value, (row.loan_id, name)


def test_few_loans_of_a_block_are_paired_with_its_points_in_one_shuffle(spark):
    line = timeline(spark, random_rows(23, n=200))
    model = line.filter("op = 'L'").selectExpr("msisdn", "loan_id", "ts AS loan_ts", "amount AS loan_amount")
    found = tl.timeline_features(line, model, [1, 7])
    found.collect()
    plan = executed_plan(found).split("Initial Plan")[0]
    assert "ShuffledHashJoin [msisdn" in plan and "BuildLeft" in plan and "ReusedExchange" in plan


def test_payloads_that_grouping_would_change_take_frames(spark):
    points = spark.sql("SELECT 'a' AS msisdn, 100L AS epoch, 5L AS n")
    wanted = spark.sql("SELECT 'a' AS msisdn, 200L AS epoch, named_struct('x', -0.0D) AS payload")
    (row,) = rolling.rolling(points, {"n": "sum"}, [1], results=wanted).collect()
    assert str(row.x) == "-0.0" and row.n_back_1 == 5
