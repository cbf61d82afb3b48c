"""Small tables for tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from airlend import schemas as S

START = datetime(2022, 4, 1)


def at(days: float = 0, seconds: int = 0) -> datetime:
    return START + timedelta(days=days, seconds=seconds)


def utc(ts: datetime | None) -> datetime | None:
    return ts and ts.replace(tzinfo=timezone.utc)


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def timeline(spark, rows):
    """Rows (msisdn, loan_id, ts, amount, op)."""
    schema = "msisdn string, loan_id bigint, ts timestamp, amount decimal(18,2), op string"
    return spark.createDataFrame([(m, i, utc(t), money(a), op) for m, i, t, a, op in rows], schema)


def loans(spark, rows):
    """Rows (msisdn, loan_id, ts, amount); fee 1.10, tier 1."""
    data = [(m, i, 1, money(a), money("1.10"), utc(t), 1, 1) for m, i, t, a in rows]
    return spark.createDataFrame(data, S.LOANS)


def payments(spark, rows):
    """Rows (msisdn, loan_id, ts, amount)."""
    return spark.createDataFrame([(m, i, utc(t), money(a)) for m, i, t, a in rows], S.PAYMENTS)


def recharges(spark, rows):
    """Rows (msisdn, ts, amount)."""
    return spark.createDataFrame([(m, utc(t), money(a), "x") for m, t, a in rows], S.RECHARGES)


def ledger(spark, rows):
    """Rows (msisdn, ts, amount, party, text, operation type, eligibility)."""
    schema = (
        "msisdn string, event_ts timestamp, amount double, other_party string, transaction_text string,"
        " operation_type int, profile_eligibility int"
    )
    return spark.createDataFrame([(m, utc(t), *rest) for m, t, *rest in rows], schema)


def by(rows, *keys):
    return {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row for row in rows}
