import random
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.operators import censoring, dataset, profiles
from airlend.operators import timeline as tl
from airlend.plans.feature_table import FeatureConfig, build_feature_table, prepare_sources
from airlend.sources.staging import Run
from airlend.sources.tables import write_features
from tests.helpers import START, at, by, loans, money, payments, recharges, utc


def test_model_loans_include_the_last_day(spark):
    taken = loans(spark, [("a", 1, at(0), 1), ("a", 2, at(1, 86_399), 1), ("a", 3, at(2), 1)])
    found = dataset.model_loans(taken, "2022-04-01", "2022-04-02")
    assert {r.loan_id for r in found.collect()} == {1, 2}
    assert dataset.model_loans(taken, "2022-04-01", "2022-04-02", tiers=[5]).count() == 0
    assert [r.tier_id for r in dataset.model_tiers(found).collect()] == [1]


def test_feasible_windows(spark):
    history = (date(2022, 4, 1), date(2022, 10, 1))
    rows = [("a", 1, at(60), 1), ("a", 2, at(61), 1), ("a", 3, at(151, 86_399), 1), ("a", 4, at(152), 1)]
    found = dataset.feasible_windows(loans(spark, rows), history, [7, 14, 30, 45, 60], 30, 2).collect()
    rows = by(found, "max_window")
    assert (rows[60].start_date, rows[60].end_date) == (date(2022, 6, 1), date(2022, 8, 31))
    assert (rows[7].start_date, rows[7].end_date) == (date(2022, 4, 9), date(2022, 8, 31))
    assert (rows[60].n_rows, rows[60].ok, rows[60].chosen) == (2, True, True)
    assert rows[45].n_rows == 3 and rows[45].ok and not rows[45].chosen


def test_infeasible_windows_choose_the_smallest(spark):
    history = (date(2022, 4, 1), date(2022, 10, 1))
    found = dataset.feasible_windows(loans(spark, [("a", 1, at(60), 1)]), history, [7, 60], 30, 2).collect()
    assert [(r.max_window, r.ok, r.chosen) for r in found] == [(60, False, False), (7, False, True)]
    short = (date(2022, 4, 1), date(2022, 5, 1))
    found = dataset.feasible_windows(loans(spark, [("a", 1, at(9), 1)]), short, [7], 30, 0).collect()
    assert [r.ok for r in found] == [False]


def test_spans_must_agree(spark):
    taken = loans(spark, [("a", 1, at(0), 1), ("a", 2, at(9), 1)])
    paid = payments(spark, [("a", 1, at(0), 1), ("a", 1, at(9), 1)])
    spent = recharges(spark, [("a", at(0), 1), ("a", at(9, 5), 1)])

    def spans(recharged, model=taken):
        return dataset.date_spans(
            loans=(taken, "loan_ts"),
            payments=(paid, "pay_ts"),
            recharges=(recharged, "recharge_ts"),
            model_loans=(model, "loan_ts"),
        )

    assert dataset.history_span(spans(spent)) == (date(2022, 4, 1), date(2022, 4, 10))
    assert {r.dataset: r.n for r in spans(spent).collect()}["recharges"] == 2
    with pytest.raises(ValueError):
        dataset.history_span(spans(recharges(spark, [("a", at(1), 1)])))
    with pytest.raises(ValueError):
        dataset.history_span(spans(spent, loans(spark, [("a", 1, at(10), 1)])))
    with pytest.raises(ValueError):
        dataset.history_span(spans(recharges(spark, [])))


def features(spark, rows):
    """Rows (msisdn, loan_id, ts, amount, target)."""
    schema = "msisdn string, loan_id bigint, loan_ts timestamp, burst_amount decimal(18,2), target_7 int"
    return spark.createDataFrame([(m, i, utc(t), money(a), x) for m, i, t, a, x in rows], schema)


def test_daily_sample(spark):
    rows = [("a", 1, at(0, 10), 10, 1), ("a", 2, at(0, 20), 5, 0), ("a", 3, at(1), 1, 1), ("b", 4, at(0), 2, 1)]
    found = by(dataset.daily_sample(features(spark, rows)).collect(), "msisdn", "date")
    day = found["a", START.date()]
    assert len(found) == 3
    assert (day.loan_id, day.total_loan_amount, day.target_7, day.target_7_min) == (2, 15, 0, 0)


def brute_sample(rows):
    best = {}
    for msisdn, loan_id, ts, _, _ in rows:
        mine = [r for r in rows if r[0] == msisdn and r[2].date() == ts.date() and r[2] <= ts]
        amounts = [r[3] for r in mine if r[3] is not None]
        cell = (sum(amounts) if amounts else None, ts, loan_id, min(r[4] for r in mine))
        rank = (cell[0] is not None, cell[0] or 0, ts, -loan_id)
        key = (msisdn, ts.date())
        if key not in best or rank > best[key][0]:
            best[key] = (rank, cell)
    return {key: cell for key, (_, cell) in best.items()}


def test_daily_sample_with_reversals_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        micros = rng.choice((0, 1, 500_000))
        ts = START + timedelta(days=rng.randrange(4), seconds=rng.randrange(6), microseconds=micros)
        amount = None if rng.random() < 0.1 else Decimal(rng.randrange(-300, 500)) / 100
        rows.append((f"m{rng.randrange(3)}", i, ts, amount, rng.randrange(2)))
    df = features(spark, rows)
    for parts in (1, 7):
        found = by(dataset.daily_sample(df.repartition(parts)).collect(), "msisdn", "date")
        ours = {k: (r.total_loan_amount, r.loan_ts, r.loan_id, r.target_7_min) for k, r in found.items()}
        assert ours == brute_sample(rows)


def test_subscriber_history(spark):
    found = dataset.subscriber_history(
        loans(spark, [("a", 1, at(0), 1), ("b", 2, at(0), 1)]),
        payments(spark, [("a", 1, at(1), 2)]),
        recharges(spark, [("a", at(2), 3), ("c", at(2), 3)]),
        ["a"],
    )
    rows = sorted((r.source, r.loan_id, r.amount) for r in found.collect() if r.msisdn == "a")
    assert found.count() == 3 and rows[0] == ("loan", 1, 1)


HISTORY = ("2022-04-01", "2022-06-30")


def lending(spark, seed=2):
    rng = random.Random(seed)
    taken, paid, spent = [], [], []
    for i in range(1, 120):
        msisdn, day = f"m{rng.randrange(6)}", rng.randrange(90)
        taken.append((msisdn, i, at(day, rng.randrange(0, 86_400, 30)), rng.randrange(1, 50)))
        if rng.random() < 0.3:
            taken.append((msisdn, 1000 + i, taken[-1][2] + timedelta(seconds=1), 2))
        for _ in range(rng.randrange(3)):
            paid.append((msisdn, i, at(day + rng.randrange(40)), 10))
    for _ in range(200):
        spent.append((f"m{rng.randrange(6)}", at(rng.randrange(90), rng.randrange(86_400)), rng.randrange(1, 30)))
    spent.append(("m0", at(90), 1))  # the last day of the history
    return loans(spark, taken), payments(spark, paid), recharges(spark, spent)


def config(**changes):
    settings = dict(
        model_period=("2022-04-11", "2022-06-25"), history=HISTORY, windows=(3, 10, 60), target_days=5, min_rows=60,
        restrict_rows=True,
    )
    return FeatureConfig(**settings | changes)


def test_feature_table(spark):
    tables = lending(spark)
    table = build_feature_table(*tables, config())
    rows = table.collect()
    # 60 days of history leave too few loans, so 10 is the largest window and its first day the 12th.
    assert not any(name.endswith("_60") for name in table.columns)
    assert len({(r.msisdn, r.loan_id) for r in rows}) == len(rows) >= 60
    assert min(r.loan_ts for r in rows).date() >= date(2022, 4, 12)
    assert max(r.loan_ts for r in rows).date() < date(2022, 6, 24)
    assert any(r.burst_size == 2 and r.burst_amount == r.loan_amount + 2 for r in rows)
    for changes in ({"block_days": 1}, {"block_days": 40}, {"block_days": None}):
        other = build_feature_table(*tables, config(**changes)).collect()
        assert sorted(map(str, other)) == sorted(map(str, rows))


def test_amounts_of_different_scale(spark):
    taken, paid, spent = lending(spark)
    finer = spent.selectExpr("msisdn", "recharge_ts", "cast(recharge_amount + 0.125 as decimal(18,3)) recharge_amount")
    cfg = config(restrict=False, windows=(10,))
    rows = by(build_feature_table(taken, paid, finer, cfg).collect(), "msisdn", "loan_id")
    plain = build_feature_table(taken, paid, spent, cfg).collect()
    for row in plain:
        if row.count_spend_10:
            more = row.count_spend_10 * Decimal("0.125")
            assert rows[row.msisdn, row.loan_id].sum_spend_10 == row.sum_spend_10 + more


def test_feature_table_options(spark):
    tables = lending(spark)
    whole = build_feature_table(*tables, config(restrict=False, windows=(3, 10)))
    period = dataset.model_loans(tables[0], "2022-04-11", "2022-06-25")
    minutes = period.selectExpr("msisdn", "date_trunc('minute', loan_ts)").distinct().count()
    assert whole.count() == minutes
    strict = build_feature_table(*tables, config(require_full_repayment=True, censor=False)).collect()
    loose = by(build_feature_table(*tables, config(censor=False)).collect(), "msisdn", "loan_id")
    assert all(r.target_10 <= loose[r.msisdn, r.loan_id].target_10 for r in strict)
    known = build_feature_table(*tables, config(known_by_loan_date=True))
    assert known.columns == build_feature_table(*tables, config()).columns
    with pytest.raises(ValueError):
        build_feature_table(*tables, config(history=None))


def test_prepare_sources(spark):
    advances = spark.createDataFrame(
        [("0", " 123456789", "1", "2022-04-01", "5"), ("0", "123456789", "2", "2022-04-01", "5"), ("0", "12", "3", "", "")],
        ["_c0", "MSISDN", "ADVANCE_ID", "LOAN_DATE", "LOAN_AMOUNT"],
    )
    advances = advances.unionByName(advances)
    paid = spark.createDataFrame(
        [("123456789", "1", "2022-04-02", "5")], ["MSISDN", "ADVANCE_ID", "IN_DATE", "PAYMENT_AMOUNT"]
    )
    spent = spark.createDataFrame(
        [("123456789", "2022-04-02", "5", "x")], ["MSISDN", "DP_DATE", "RECHARGE_AMOUNT", "DP_ENTITY_TYPE"]
    )
    taken, paid, spent = prepare_sources(advances, paid, spent)
    assert sorted((r.msisdn, r.loan_id) for r in taken.collect()) == [("0123456789", 1), ("0123456789", 2)]
    assert paid.first().pay_amount == 5 and spent.first().recharge_ts == at(1)


def test_write_features_by_month(spark, tmp_path):
    path = str(tmp_path / "features")
    for _ in range(2):
        write_features(loans(spark, [("a", 1, at(0), 1), ("a", 2, at(40), 1)]), path)
    back = spark.read.parquet(path)
    assert {(r.loan_id, r.loan_month) for r in back.collect()} == {(1, "2022-04"), (2, "2022-05")}
    plan = back.filter("loan_month = '2022-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(loan_month" in plan


def test_days_between_loans(spark):
    rows = [("a", 1, at(0), 1), ("a", 2, at(0, 9), 1), ("a", 3, at(3), 1), ("b", 4, at(1), 1), ("b", 5, at(4), 1)]
    found = profiles.days_between_loans(loans(spark, rows)).collect()
    assert {r.days: r.n for r in found} == {0: 1, 3: 2}


def test_cohort_extract(spark):
    taken, paid, spent = profiles.cohort_extract(
        loans(spark, [("x06", 1, at(5), 1), ("x06", 2, at(0), 1), ("y06", 3, at(0), 1), ("z07", 4, at(5), 1)]),
        payments(spark, [("x06", 1, at(6), 1), ("y06", 3, at(6), 1)]),
        recharges(spark, [("x06", at(7), 1), ("x06", at(99), 1), ("z07", at(7), 1)]),
        ["06", "08"],
        ("2022-04-05", "2022-04-06"),
        ("2022-04-01", "2022-04-30"),
    )
    assert {r.loan_id for r in taken.collect()} == {1, 2}
    assert paid.count() == 1 and spent.count() == 1
    with pytest.raises(ValueError):
        profiles.cohort_extract(taken, paid, spent, ["6", "08"], HISTORY, HISTORY)


def test_copies_with_another_index_or_blanks_are_one_row(spark):
    schema = "_c0 string, MSISDN string, ADVANCE_ID string, LOAN_DATE string, LOAN_AMOUNT string"
    rows = [("0", "123456789", "1", "2022-04-01 00:00:00", "5"), ("1", " 123456789", "1.0", "2022-04-01 00:00:00", "5")]
    advances = spark.createDataFrame(rows, schema)
    payment = spark.createDataFrame([], "MSISDN string, ADVANCE_ID string, IN_DATE string, PAYMENT_AMOUNT string")
    recharge = spark.createDataFrame([], "MSISDN string, DP_DATE string, RECHARGE_AMOUNT string, DP_ENTITY_TYPE string")
    assert prepare_sources(advances, payment, recharge)[0].count() == 1


def test_the_window_choice_cuts_no_rows_unless_asked(spark):
    tables = lending(spark)
    whole = build_feature_table(*tables, config(restrict=False, windows=(3, 10)))
    assert build_feature_table(*tables, config(restrict_rows=False)).count() == whole.count()
    with pytest.raises(ValueError, match="no window"):
        build_feature_table(*tables, config(min_rows=10_000))


def test_further_attributes_reach_the_table(spark):
    taken, paid, spent = lending(spark)
    taken = taken.selectExpr("*", "concat('s', loan_id) AS service_type")
    cfg = config(restrict=False, windows=(10,), attributes=("service_type",))
    rows = build_feature_table(taken, paid, spent, cfg).collect()
    assert rows and all(r.service_type == f"s{r.loan_id}" for r in rows)


def test_attributes_of_the_advances_are_kept_and_typed(spark):
    schema = "MSISDN string, ADVANCE_ID string, LOAN_DATE string, LOAN_AMOUNT string, QUALIFIED string"
    advances = spark.createDataFrame([("123456789", "1", "2022-04-01", "5", " 7.50 ")], schema)
    payment = spark.createDataFrame([], "MSISDN string, ADVANCE_ID string, IN_DATE string, PAYMENT_AMOUNT string")
    recharge = spark.createDataFrame([], "MSISDN string, DP_DATE string, RECHARGE_AMOUNT string, DP_ENTITY_TYPE string")
    more = {"QUALIFIED": ("qualified_amount", T.DecimalType(18, 2))}
    assert prepare_sources(advances, payment, recharge, more)[0].first().qualified_amount == Decimal("7.50")


def test_a_stated_history_must_be_reached_by_the_payments(spark):
    taken, paid, spent = lending(spark)
    early = paid.filter("pay_ts < '2022-05-01'")
    for changes in ({}, {"restrict": False}):
        with pytest.raises(ValueError, match="last payment"):
            build_feature_table(taken, early, spent, config(**changes))
    with pytest.raises(ValueError, match="within the history"):
        build_feature_table(taken, paid, spent, config(model_period=("2022-03-01", "2022-06-25")))


def test_recharges_by_a_further_column(spark):
    spent = recharges(spark, [("a", at(0), 1), ("a", at(1), 3), ("b", at(2), 2)])
    spent = spent.withColumn("eligible", F.when(F.col("msisdn") == "a", 1))
    found = {r.eligible: r for r in profiles.recharges_per_subscriber_month(spent, "eligible").collect()}
    assert (found[1].n_subscribers, found[1].mean_amount, found[1].mean_number) == (1, 4.0, 2.0)
    assert (found[None].n_subscribers, found[None].mean_amount) == (1, 2.0)


def test_open_windows_are_null_unless_decided(spark):
    """A loan of 2024-05-20 in a history to 2024-06-30: 41 days were seen after it."""
    start = date(2024, 1, 1)
    at_day = lambda d: at((d - at().date()).days, 3600)
    taken = [("a", 1, at_day(date(2024, 5, 20)), 5), ("b", 2, at_day(date(2024, 5, 20)), 5), ("c", 3, at_day(start), 1)]
    taken += [("c", 4, at_day(date(2024, 6, 30)), 1)]
    paid = [("b", 2, at_day(date(2024, 5, 25)), 5), ("c", 3, at_day(start), 1), ("c", 4, at_day(date(2024, 6, 30)), 1)]
    spent = [("a", at_day(date(2024, 5, 21)), 3), ("c", at_day(start), 1), ("c", at_day(date(2024, 6, 30)), 1)]
    tables = loans(spark, taken), payments(spark, paid), recharges(spark, spent)
    cfg = FeatureConfig(
        model_period=("2024-05-01", "2024-05-31"), history=("2024-01-01", "2024-06-30"), windows=(7, 41, 42, 60),
        target_days=30, min_rows=1, restrict=False,
    )
    rows = by(build_feature_table(*tables, cfg).collect(), "msisdn")
    assert [rows["a"][f"target_{n}"] for n in (7, 41, 42, 60)] == [0, 0, None, None]
    assert [rows["b"][f"target_{n}"] for n in (7, 41, 42, 60)] == [1, 1, 1, 1]
    assert [rows["a"][f"future_spend_sum_{n}"] for n in (7, 41, 42, 60)] == [3, 3, None, None]
    assert [rows["a"][f"future_loan_count_{n}"] for n in (7, 60)] == [1, None]
    assert rows["a"].days_seen_payments == rows["a"].days_seen_loans == rows["a"].days_seen_recharges == 41
    plain = by(build_feature_table(*tables, replace(cfg, censor=False)).collect(), "msisdn")
    assert plain["a"].target_60 == 0 and plain["a"].future_spend_sum_60 == 3
    assert not any(name.startswith("days_seen") for name in build_feature_table(*tables, replace(cfg, censor=False)).columns)


def test_a_stated_history_must_have_all_sources(spark):
    taken, paid, spent = lending(spark)
    with pytest.raises(ValueError, match="no recharges"):
        build_feature_table(taken, paid, spent.limit(0), config(restrict=False))
    with pytest.raises(ValueError, match="last recharge"):
        build_feature_table(taken, paid, spent.filter("recharge_ts < '2022-05-01'"), config())
    with pytest.raises(ValueError, match="first payment"):
        build_feature_table(taken, paid.filter("pay_ts > '2022-05-01'"), spent, config())
    with pytest.raises(ValueError, match="last loan"):
        build_feature_table(taken.filter("loan_ts < '2022-05-01'"), paid, spent, config())


def test_known_spans_are_used_instead_of_the_tables(spark):
    tables = lending(spark)
    spans = {name: HISTORY for name in ("loans", "payments", "recharges")}
    cfg = config(restrict=False, windows=(3, 10), spans=spans)
    found = build_feature_table(*tables, cfg).collect()
    assert found and all(r.days_seen_loans == (date(2022, 6, 30) - r.loan_ts.date()).days for r in found)
    with pytest.raises(ValueError, match="last payment"):
        build_feature_table(*tables, replace(cfg, spans=spans | {"payments": ("2022-04-01", "2022-05-01")}))


def test_spans_within_a_history(spark, tmp_path):
    rows = [("a", k, at(k), 1) for k in range(0, 30)]
    whole, part = loans(spark, rows), loans(spark, rows[5:20])
    whole.write.parquet(f"{tmp_path}/loans")
    stored = spark.read.parquet(f"{tmp_path}/loans")
    first, last = date(2022, 4, 2), date(2022, 4, 28)
    tables = {"whole": (stored, "loan_ts"), "part": (part, "loan_ts"), "none": (whole.limit(0), "loan_ts")}
    assert dataset.spans_within(first, last, **tables) == {
        "whole": (first, last),
        "part": (date(2022, 4, 6), date(2022, 4, 20)),
    }
    probe = stored.select("loan_ts").filter("loan_ts >= '2022-04-02' AND loan_ts < '2022-04-03'").limit(1)
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(loan_ts), GreaterThanOrEqual" in plan and "ReadSchema: struct<loan_ts:timestamp>" in plan


def test_censoring_of_corrected_spend(spark):
    rows = [(at(0), 1.0, 2.0, 3.0, 0), (at(8), 1.0, 2.0, 3.0, 1)]
    names = "loan_ts timestamp, future_spend_sum_7 double, future_loan_sum_7 double, future_spend_sum_corrected_7 double, target_7 int"
    frame = spark.createDataFrame([(utc(r[0]), *r[1:]) for r in rows], names)
    last = {"loans": at(10).date(), "payments": at(9).date(), "recharges": at(20).date()}
    early, late = censoring.censored(censoring.with_days_seen(frame, last), [7]).orderBy("loan_ts").collect()
    assert tuple(early[1:5]) == (1.0, 2.0, 3.0, 0) and tuple(early[5:]) == (10, 9, 20)
    assert tuple(late[1:5]) == (1.0, None, None, 1)


def test_model_loans_without_subscriber_or_number_come_back(spark):
    taken = loans(spark, [("a", 1, at(5), 3), (None, 2, at(5), 4), ("a", None, at(6), 5)])
    line = tl.loan_recharge_timeline(taken, recharges(spark, [("a", at(4), 9)]))
    for look in (tl.lookback_features, tl.forward_features):
        found = {r.amount: r for r in look(line, taken, [7]).collect()}
        assert sorted(found) == [3, 4, 5]
    back = {r.amount: r for r in tl.lookback_features(line, taken, [7]).collect()}
    assert back[3].sum_spend_7 == 9 and back[4].count_spend_7 == 0 and back[5].sum_spend_7 is None
    assert back[5].ts is not None and back[4].loan_id == 2


def test_payments_per_loan_month_are_not_counted_in_the_join_s_tasks(spark):
    paid = payments(spark, [("a", 1, at(0), 1), ("a", 1, at(1), 1), ("a", 1, at(40), 1), ("b", 2, at(2), 1), ("b", None, at(2), 1)])
    taken = loans(spark, [("a", 1, at(0), 1), ("b", 2, at(0), 1)]).select("loan_id").hint("merge")
    found = profiles.payments_per_loan_month(paid.join(taken, "loan_id"))
    assert sorted((r.month, r.n_loans, r.n_payments, r.mean_payments) for r in found.collect()) == [
        (at(0), 2, 3, 1.5), (at(30), 1, 1, 1.0)
    ]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.index("keys=[loan_id") < plan.index("REPARTITION_BY_NUM") < plan.index("SortMergeJoin")


def test_model_loans_are_put_together_once(spark):
    """The window check, the pairs and the frames all read them."""
    with Run(spark, "tests-model-loans", keep_failed=False) as run:
        table = build_feature_table(*lending(spark), config(), run=run)
        assert run.tables() == ["model-loans", "repaid-loans"]
        assert table.count() > 0
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "date_trunc" not in plan and "burst_start" not in plan
