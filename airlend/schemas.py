"""Canonical tables, source column names and code values."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


LOANS = _schema(
    msisdn=T.StringType(),
    loan_id=T.LongType(),
    channel_id=T.IntegerType(),
    loan_amount=MONEY,
    service_fee=MONEY,
    loan_ts=T.TimestampType(),
    status_id=T.IntegerType(),
    tier_id=T.IntegerType(),
)

PAYMENTS = _schema(
    msisdn=T.StringType(),
    loan_id=T.LongType(),
    pay_ts=T.TimestampType(),
    pay_amount=MONEY,
)

RECHARGES = _schema(
    msisdn=T.StringType(),
    recharge_ts=T.TimestampType(),
    recharge_amount=MONEY,
    entity_type=T.StringType(),
)

LEDGER = _schema(
    msisdn=T.StringType(),
    advance_id=T.IntegerType(),
    event_ts=T.TimestampType(),
    amount=T.DoubleType(),
    transaction_id=T.StringType(),
    other_party=T.StringType(),
    operation_type=T.IntegerType(),
    profile_eligibility=T.IntegerType(),
)

FINANCE_ADVANCES = _schema(
    msisdn=T.StringType(),
    advance_ts=T.TimestampType(),
    advance_status=T.IntegerType(),
    qualified_amount=T.DoubleType(),
    chosen_amount=T.IntegerType(),
    due_ts=T.TimestampType(),
    repay_ts=T.TimestampType(),
)

# Source column names and their canonical names. They must equal the extracts' own names.
LOAN_COLUMNS = {
    "MSISDN": "msisdn",
    "ADVANCE_ID": "loan_id",
    "CHANNEL_ID": "channel_id",
    "LOAN_DATE": "loan_ts",
    "LOAN_AMOUNT": "loan_amount",
    "STATUS_ID": "status_id",
    "PROFILE_TIER_ID": "tier_id",
    "SERVICE_FEE": "service_fee",
}
PAYMENT_COLUMNS = {
    "MSISDN": "msisdn",
    "ADVANCE_ID": "loan_id",
    "IN_DATE": "pay_ts",
    "PAYMENT_DATE": "pay_ts",
    "PAYMENT_AMOUNT": "pay_amount",
}
RECHARGE_COLUMNS = {
    "MSISDN": "msisdn",
    "DP_DATE": "recharge_ts",
    "RECHARGE_AMOUNT": "recharge_amount",
    "DP_ENTITY_TYPE": "entity_type",
}
LEDGER_COLUMNS = [
    "msisdn",
    "advance_id",
    "event_ts",
    "amount",
    "transaction_id",
    "other_party",
    "operation_type",
    "profile_eligibility",
]
WIDE_LEDGER_COLUMNS = [
    "msisdn",
    "advance_id",
    "event_ts",
    "amount",
    "transaction_id",
    "created_on",
    "other_party",
    "operation_type",
    "loan_amount",
    "service_fee_amount",
    "in_loan_balance",
    "in_service_fee_balance",
    "file_name",
    "profile_eligibility",
    "raw_record",
]
UNUSED_LEDGER_COLUMNS = [
    "created_on",
    "loan_amount",
    "service_fee_amount",
    "in_loan_balance",
    "in_service_fee_balance",
    "file_name",
]
FINANCE_COLUMNS = {
    "advancedate": "advance_ts",
    "advancestatus": "advance_status",
    "qualifiedamount": "qualified_amount",
    "amount": "chosen_amount",
    "duedate": "due_ts",
    "repaydate": "repay_ts",
}

# Codes found in the data.
RECHARGE, LOAN, PAYMENT = 0, 1, 2
CUSTOMER_PARTY = "Customer"
REVERSAL_TEXT = "B2C Reversal"
LOAN_OP, RECHARGE_OP = "L", "R"

# Default run parameters.
BUCKET_EDGES = (50, 100, 150, 200)
RAW_RECORD_ITEMS = {"transaction_text": 3, "entity": 6, "entity_name": 10}
WINDOWS = (7, 14, 30, 45, 60)
TARGET_DAYS = 30
MIN_MODEL_LOANS = 60_000
SERVICE_FEE = 1.1
