"""The registered queries. Each takes (spark, sf_dir) and runs over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend import schemas as S
from airlend.operators import bursts, cleaning, cohorts, dataset, ledger, profiles, repayment, sketches
from airlend.operators import timeline as tl
from airlend.plans.cohort import cohort_bucket_recharges, month_period
from airlend.plans.feature_table import FeatureConfig, build_feature_table, prepare_sources
from airlend.plans.ledger import prepare_ledger
from airlend.sources import tables
from checks import roles

EVENT_WINDOWS = (1, 3, 7, 14)
ORDER_WINDOWS = (90, 180, 365)
PAY_DAY_WINDOWS = (365, 730, 1095)
M0 = "1997-01-01"
MODEL_PERIOD = ("1995-06-01", "2001-06-30")
HISTORY = ("1995-01-01", "2001-11-30")
LOCAL_FOLDER = "/tmp/checkpoints/airlend"
TARGET_DAYS = 90
MIN_ROWS = 100
EVENT_MODEL_PERIOD = ("2024-01-08", "2024-01-24")
EVENT_MIN_ROWS = 50
SUBSCRIBERS = ("1", "7", "42", "99", "100")

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Types that compare across engines: times without zone, money as double, whole numbers as BIGINT."""

    def cell(field: T.StructField) -> str:
        if isinstance(field.dataType, (T.TimestampType, T.DateType)):
            return f"CAST({field.name} AS TIMESTAMP_NTZ) AS {field.name}"
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST({field.name} AS DOUBLE) AS {field.name}"
        if isinstance(field.dataType, T.IntegralType):
            return f"CAST({field.name} AS BIGINT) AS {field.name}"
        return field.name

    return df.selectExpr(*(cell(field) for field in df.schema))


def _rounded(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.selectExpr(*(f"round({c}, 6) AS {c}" if c.startswith(prefixes) else c for c in df.columns))


def q_typed_ledger(spark, d):
    raw = roles.raw_ledger(spark, d).drop("raw_record")
    typed = cleaning.with_day(cleaning.with_year_month(cleaning.type_ledger(raw)))
    return cohorts.in_period(typed, "event_ts", hi="2024-01-25")


def q_prepared_ledger(spark, d):
    raw = roles.raw_ledger(spark, d).withColumns({"created_on": F.lit("x"), "file_name": F.lit("y")})
    return prepare_ledger(raw, cut_over="2024-01-25")


def q_type_template(spark, d):
    raw = roles.raw_advances(spark, d)
    return cleaning.dedupe(cleaning.type_template(cleaning.to_template(raw, S.LOAN_COLUMNS), S.LOANS))


def q_rejected_values(spark, d):
    """How many texts of each column could not be typed, by reason, over the three raw tables."""
    finance = cleaning.to_template(roles.raw_finance(spark, d), S.FINANCE_COLUMNS)
    advances = cleaning.to_template(roles.raw_advances(spark, d), S.LOAN_COLUMNS)
    parts = [
        cleaning.rejected_values(cleaning.type_with_rejects(df, schema, truncated))
        .groupBy(F.lit(name).alias("source"), "column", "reason")
        .agg(F.count("*").alias("n"))
        for name, df, schema, truncated in (
            ("ledger", roles.raw_ledger(spark, d), S.LEDGER, ()),
            ("finance", finance, S.FINANCE_ADVANCES, ("chosen_amount",)),
            ("advances", advances, S.LOANS, ()),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_csv_roundtrip(spark, d):
    """The event ledger as gzip CSV with other header names, read back by position and summed up by day."""
    folder = f"{tables.shared_folder(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    rows = roles.ledger(spark, d).select(
        F.col("msisdn").alias("msidn"),
        F.col("advance_id").alias("advanceId"),
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("eventDate"),
        "amount",
        F.col("advance_id").alias("transactionId"),
        F.col("other_party").alias("otherParty"),
        F.col("operation_type").alias("operationType"),
        F.col("profile_eligibility").alias("profileEligibility"),
    )
    rows.write.csv(folder, header=True, compression="gzip")
    return cleaning.type_ledger(tables.read_ledger(spark, folder)).drop("transaction_id")


def q_wide_csv(spark, d):
    """The raw ledger as CSV of 15 columns with quoted raw records, read by position and prepared."""
    folder = f"{tables.shared_folder(spark).rstrip('/')}/wide-{uuid.uuid4().hex}"
    raw = roles.raw_ledger(spark, d)
    rows = raw.select(
        *(F.col(c) if c in raw.columns else F.lit("x").alias(c) for c in S.WIDE_LEDGER_COLUMNS)
    )
    # Commas in the raw record are why it is quoted; blanks before a number are kept as they are.
    rows.write.csv(folder, header=True, ignoreLeadingWhiteSpace=False)
    wide = tables.read_ledger(spark, folder, names=S.WIDE_LEDGER_COLUMNS)
    return prepare_ledger(wide, cut_over="2024-01-25").drop("transaction_id", "other_party")


def _ledger_recharges(spark, d):
    rows = roles.ledger(spark, d)
    return rows.withColumnsRenamed({"event_ts": "recharge_ts", "amount": "recharge_amount"})


def q_recharges_by_eligibility(spark, d):
    recharges = _ledger_recharges(spark, d).filter(F.col("operation_type") == S.RECHARGE)
    return profiles.recharges_per_subscriber_month(recharges, "profile_eligibility")


def q_events_without_payments(spark, d):
    rows = _ledger_recharges(spark, d).filter(F.col("operation_type") != S.PAYMENT)
    return profiles.recharges_per_subscriber_month(rows)


def q_write_features(spark, d):
    """Loans written by month and read back with the folder's month."""
    folder = f"{tables.shared_folder(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
    tables.write_features(roles.loans(spark, d).select("msisdn", "loan_id", "loan_ts", "loan_amount"), folder)
    return spark.read.parquet(folder).withColumn("loan_month", F.col("loan_month").cast("string"))


def q_read_sources(spark, d):
    """The three extracts written under their source names, read, prepared and counted by subscriber."""
    folder = f"{tables.shared_folder(spark).rstrip('/')}/sources-{uuid.uuid4().hex}"
    padded = F.format_string("%09d", F.col("msisdn").cast("bigint")).alias("MSISDN")
    roles.raw_advances(spark, d).withColumn(
        "MSISDN", F.format_string("%09d", F.trim("MSISDN").cast("bigint"))
    ).write.parquet(f"{folder}/advances")
    roles.payments(spark, d).select(
        padded,
        F.col("loan_id").alias("ADVANCE_ID"),
        F.col("pay_ts").alias("IN_DATE"),
        F.col("pay_amount").alias("PAYMENT_AMOUNT"),
    ).write.parquet(f"{folder}/payments")
    roles.recharges(spark, d).select(
        padded,
        F.col("recharge_ts").alias("DP_DATE"),
        F.col("recharge_amount").alias("RECHARGE_AMOUNT"),
        F.col("entity_type").alias("DP_ENTITY_TYPE"),
    ).write.parquet(f"{folder}/recharges")
    extracts = tables.read_sources(spark, *(f"{folder}/{n}" for n in ("advances", "payments", "recharges")))
    taken, paid, spent = prepare_sources(*extracts)
    parts = [
        df.groupBy("msisdn").agg(F.count(F.lit(1)).alias("n"), F.sum(a).alias("amount")).select(
            F.lit(name).alias("source"), "msisdn", "n", "amount"
        )
        for name, df, a in (
            ("loans", taken, "loan_amount"),
            ("payments", paid, "pay_amount"),
            ("recharges", spent, "recharge_amount"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _periods() -> dict[str, tuple[str, str]]:
    return {f"month_{k}": month_period(M0, k) for k in range(3)}


def q_loan_repayment(spark, d):
    repaid = repayment.loan_repayment(roles.loans(spark, d), roles.payments(spark, d))
    kept = repaid.select("msisdn", "loan_id", "loan_ts", "loan_amount", "total_paid", "last_pay_ts", "days_to_pay")
    return repayment.repayment_targets(kept, PAY_DAY_WINDOWS)


def q_full_repayment_targets(spark, d):
    repaid = repayment.loan_repayment(roles.loans(spark, d), roles.payments(spark, d))
    targets = repayment.repayment_targets(repaid, PAY_DAY_WINDOWS, require_full_repayment=True)
    return targets.select("msisdn", "loan_id", *(f"target_{n}" for n in PAY_DAY_WINDOWS))


def _pay_days(known: bool) -> Query:
    def query(spark, d):
        repaid = repayment.loan_repayment(roles.loans(spark, d), roles.payments(spark, d))
        kept = repaid.select("msisdn", "loan_id", "loan_ts", "last_pay_ts", "days_to_pay")
        features = repayment.pay_day_features(kept, PAY_DAY_WINDOWS, known_by_loan_date=known)
        return _rounded(features, "mean_", "std_")

    return query


def q_merge_loan_bursts(spark, d):
    merged = bursts.merge_loan_bursts(roles.loans(spark, d), roles.payments(spark, d))
    return merged.drop("channel_id")


def q_merge_event_bursts(spark, d):
    return bursts.merge_loan_bursts(roles.event_loans(spark, d), roles.event_payments(spark, d), unit="hour")


def q_timeline_union(spark, d):
    return tl.loan_recharge_timeline(roles.loans(spark, d), roles.recharges(spark, d))


def q_order_lookback(spark, d):
    line = tl.loan_recharge_timeline(roles.loans(spark, d), roles.recharges(spark, d))
    model = dataset.model_loans(roles.loans(spark, d), *MODEL_PERIOD)
    return tl.lookback_features(line, model, ORDER_WINDOWS)


def q_future_spend_corrected(spark, d):
    ahead = tl.forward_features(roles.event_timeline(spark, d), None, EVENT_WINDOWS)
    return _rounded(
        tl.future_spend_corrected(ahead, EVENT_WINDOWS), "future_spend_sum_corrected", "future_service"
    )


def q_date_spans(spark, d):
    return dataset.date_spans(
        loans=(roles.loans(spark, d), "loan_ts"),
        payments=(roles.payments(spark, d), "pay_ts"),
        recharges=(roles.recharges(spark, d), "recharge_ts"),
        model_loans=(dataset.model_loans(roles.loans(spark, d), *MODEL_PERIOD), "loan_ts"),
    )


def q_feasible_windows(spark, d):
    taken = roles.event_loans(spark, d)
    model = dataset.model_loans(taken, *EVENT_MODEL_PERIOD)
    spans = dataset.date_spans(
        loans=(taken, "loan_ts"),
        payments=(roles.event_payments(spark, d), "pay_ts"),
        recharges=(roles.event_recharges(spark, d), "recharge_ts"),
        model_loans=(model, "loan_ts"),
    )
    return dataset.feasible_windows(model, spans, (1, 3, 7, 14, 21), 3, EVENT_MIN_ROWS)


def _feature_table(spark, d, **settings):
    cfg = FeatureConfig(
        model_period=MODEL_PERIOD,
        history=HISTORY,
        windows=ORDER_WINDOWS,
        target_days=TARGET_DAYS,
        min_rows=MIN_ROWS,
        attributes=("qualified_amount", "service_type"),
        **settings,
    )
    features = build_feature_table(
        roles.qualified_loans(spark, d), roles.payments(spark, d), roles.recharges(spark, d), cfg
    )
    return _rounded(features, "mean_", "std_")


def q_build_feature_table(spark, d):
    """The model loans that the largest window leaves, with what was seen of windows that are still open."""
    return _feature_table(spark, d, restrict_rows=True, censor=False)


def q_feature_table_all_loans(spark, d):
    """All model loans, with NULL for what was not seen to its end."""
    return _feature_table(spark, d)


def q_sketched_months(spark, d):
    """Months put together from the sketches of their days, beside the exact figures: how many rows, and whether the
    estimates keep their bounds."""
    rows = roles.recharges(spark, d).withColumn("month", F.date_trunc("month", "recharge_ts"))
    days = sketches.daily_sketches(rows, "recharge_ts", "msisdn", "recharge_amount")
    months = sketches.merged(days.withColumn("month", F.date_trunc("month", "day")), "month")
    found = sketches.estimates(months, (0.5,), "month")
    rank = F.count(F.when(F.col("recharge_amount") <= F.col("median"), 1)) / F.count("recharge_amount")
    exact = rows.join(F.broadcast(found.select("month", F.col("amount_50").alias("median"))), "month")
    exact = exact.groupBy("month").agg(F.count_distinct("msisdn").alias("subscribers"), rank.alias("rank"))
    near = F.abs(F.col("n_subscribers") - F.col("subscribers")) <= sketches.SUBSCRIBER_ERROR * F.col("subscribers") + 1
    return found.join(exact, "month").select(
        "month",
        "n",
        near.alias("subscribers_near"),
        (F.abs(F.col("rank") - 0.5) <= sketches.RANK_ERROR + 0.01).alias("median_near"),
    )


def q_subscriber_history(spark, d):
    return dataset.subscriber_history(
        roles.loans(spark, d), roles.payments(spark, d), roles.recharges(spark, d), SUBSCRIBERS
    )


def q_cohort_extract(spark, d):
    taken, paid, spent = profiles.cohort_extract(
        roles.loans(spark, d),
        roles.payments(spark, d),
        roles.recharges(spark, d),
        ("06", "08", "22", "39", "42"),
        ("1997-01-01", "1997-03-31"),
        ("1996-01-01", "1998-12-31"),
    )
    none = F.lit(None).cast("bigint").alias("loan_id")
    return (
        taken.select(F.lit("loan").alias("source"), "msisdn", "loan_id", F.col("loan_ts").alias("ts"))
        .unionByName(paid.select(F.lit("payment").alias("source"), "msisdn", "loan_id", F.col("pay_ts").alias("ts")))
        .unionByName(spent.select(F.lit("recharge").alias("source"), "msisdn", none, F.col("recharge_ts").alias("ts")))
    )


def _repaid(spark, d):
    return repayment.loan_repayment(roles.loans(spark, d), roles.payments(spark, d))


QUERIES: dict[str, Query] = {
    "daily_counts": lambda s, d: ledger.daily_counts(roles.ledger(s, d)),
    "loan_daily": lambda s, d: ledger.loan_daily(roles.ledger(s, d)),
    "loan_amount_daily": lambda s, d: ledger.loan_amount_daily(roles.ledger(s, d)),
    "recharge_profile": lambda s, d: ledger.recharge_profile(roles.ledger(s, d)),
    "recharge_payment_daily": lambda s, d: ledger.recharge_payment_daily(roles.ledger(s, d)),
    "recharge_type_daily": lambda s, d: ledger.recharge_type_daily(roles.ledger(s, d)),
    "split_raw_record": lambda s, d: cleaning.split_raw_record(roles.raw_ledger(s, d)),
    "typed_ledger": q_typed_ledger,
    "prepared_ledger": q_prepared_ledger,
    "typed_finance": lambda s, d: cleaning.type_finance(roles.raw_finance(s, d)),
    "normalise_msisdn": lambda s, d: cleaning.normalise_msisdn(roles.numbers(s, d)),
    "type_template": q_type_template,
    "amount_buckets": lambda s, d: cohorts.with_amount_bucket(
        cohorts.in_period(roles.finance(s, d), "advance_ts", *month_period(M0))
    ),
    "cohort_recharges": lambda s, d: cohorts.cohort_recharges(
        cohorts.in_period(roles.finance(s, d), "advance_ts", *month_period(M0)), roles.line_ledger(s, d), _periods()
    ),
    "cohort_bucket_recharges": lambda s, d: cohort_bucket_recharges(roles.finance(s, d), roles.line_ledger(s, d), M0),
    "m0_daily_recharges": lambda s, d: cohorts.m0_daily_recharges(
        roles.finance(s, d), roles.line_ledger(s, d), month_period(M0)
    ),
    "amount_peers": lambda s, d: cohorts.amount_peers(
        cohorts.in_period(roles.finance(s, d), "advance_ts", *month_period(M0)), "tier_id"
    ),
    "subscribers_with_amount": lambda s, d: cohorts.subscribers_with_amount(roles.finance(s, d), 20),
    "rejected_values": q_rejected_values,
    "csv_roundtrip": q_csv_roundtrip,
    "wide_csv_ledger": q_wide_csv,
    "write_features": q_write_features,
    "read_sources": q_read_sources,
    "paid_totals": lambda s, d: repayment.paid_totals(roles.payments(s, d)),
    "loan_repayment": q_loan_repayment,
    "pay_day_features": _pay_days(known=False),
    "pay_day_features_known": _pay_days(known=True),
    "merge_loan_bursts": q_merge_loan_bursts,
    "merge_event_bursts": q_merge_event_bursts,
    "timeline_union": q_timeline_union,
    "lookback_features": lambda s, d: tl.lookback_features(roles.event_timeline(s, d), None, EVENT_WINDOWS),
    "forward_features": lambda s, d: tl.forward_features(roles.event_timeline(s, d), None, EVENT_WINDOWS),
    "timeline_features": lambda s, d: tl.timeline_features(roles.event_timeline(s, d), None, EVENT_WINDOWS),
    "timeline_features_by_day": lambda s, d: tl.timeline_features(
        roles.event_timeline(s, d), None, EVENT_WINDOWS, block_days=3
    ),
    "order_lookback_features": q_order_lookback,
    "future_spend_corrected": q_future_spend_corrected,
    "date_spans": q_date_spans,
    "model_loans": lambda s, d: dataset.model_loans(roles.loans(s, d), *MODEL_PERIOD, tiers=(1, 2)).drop("channel_id"),
    "model_tiers": lambda s, d: dataset.model_tiers(dataset.model_loans(roles.loans(s, d), *MODEL_PERIOD)),
    "feasible_windows": q_feasible_windows,
    "daily_sample": lambda s, d: dataset.daily_sample(roles.sample_features(s, d), amount="loan_amount"),
    "subscriber_history": q_subscriber_history,
    "build_feature_table": q_build_feature_table,
    "feature_table_all_loans": q_feature_table_all_loans,
    "t1_monthly_loan_value": lambda s, d: profiles.monthly_loan_value(roles.loans(s, d)),
    "t2_loans_per_subscriber_month": lambda s, d: profiles.loans_per_subscriber_month(roles.loans(s, d)),
    "t3_days_between_loans": lambda s, d: profiles.days_between_loans(roles.loans(s, d)),
    "t4_repayment_time": lambda s, d: profiles.repayment_time(_repaid(s, d)),
    "t5_payment_timing": lambda s, d: profiles.payment_timing(roles.event_payments(s, d)),
    "t6_loan_size_repayment": lambda s, d: profiles.loan_size_repayment(_repaid(s, d), 10_000),
    "t7_payments_per_loan_month": lambda s, d: profiles.payments_per_loan_month(roles.payments(s, d)),
    "t8_recharges_per_subscriber_month": lambda s, d: profiles.recharges_per_subscriber_month(roles.recharges(s, d)),
    "t8_recharges_by_eligibility": q_recharges_by_eligibility,
    "t8_without_payments": q_events_without_payments,
    "t9_recharge_amounts": lambda s, d: profiles.recharge_amounts(roles.event_recharges(s, d)),
    "sketched_months": q_sketched_months,
    "t10_recharges_before_loan_month": lambda s, d: profiles.recharges_before_loan_month(
        roles.loans(s, d), roles.recharges(s, d), M0
    ),
    "t11_recharge_days": lambda s, d: profiles.recharge_days(roles.recharges(s, d)),
    "t12_cohort_extract": q_cohort_extract,
    "t13_entity_daily_recharges": lambda s, d: profiles.entity_daily_recharges(roles.event_recharges(s, d)),
    "t14_full_repayment_targets": q_full_repayment_targets,
    "t15_subscribers_per_amount": lambda s, d: profiles.subscribers_per_amount(roles.event_loans(s, d)),
}


def name_local_folder(spark) -> None:
    """Name a checkpoint folder in a session on one machine that has none."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.master.startswith("local["):
        if not context.getCheckpointDir():
            context.setCheckpointDir(LOCAL_FOLDER)


def queries() -> dict[str, Query]:
    def with_plain_types(query: Query) -> Query:
        def run(spark, sf_dir):
            name_local_folder(spark)
            return plain(query(spark, sf_dir))

        return run

    return {name: with_plain_types(query) for name, query in QUERIES.items()}
