"""Column expressions: periods, days, amount buckets, record items, MSISDN padding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlend.schemas import BUCKET_EDGES

DAY_SECONDS = 86_400


def period(ts: str | Column, lo: str | None = None, hi: str | None = None) -> Column:
    """lo <= ts < hi. The bounds are timestamp literals, so the test reaches the parquet scan."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    test = F.lit(True)
    if lo is not None:
        test = test & (ts >= F.lit(lo).cast("timestamp"))
    if hi is not None:
        test = test & (ts < F.lit(hi).cast("timestamp"))
    return test


def day(ts: str) -> Column:
    return F.date_trunc("day", F.col(ts))


def month(ts: str) -> Column:
    return F.date_trunc("month", F.col(ts))


def epoch(ts: str | Column) -> Column:
    """Whole seconds since 1970, rounded down."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(ts.cast("timestamp"))


def amount_bucket(amount: str, edges: Sequence[float] = BUCKET_EDGES) -> Column:
    """'50', '50-100', ..., '> 200'; an amount on an edge belongs to the lower bucket, NULL stays NULL."""
    value, (first, *rest) = F.col(amount), edges
    bucket = F.when(value <= first, f"{first}")
    for lower, upper in zip(edges, rest):
        bucket = bucket.when(value <= upper, f"{lower}-{upper}")
    return bucket.when(value > edges[-1], f"> {edges[-1]}")


def record_item(record: str | Column, item: int, sep: str = ",") -> Column:
    """Item of a delimited text; NULL where the record is too short."""
    return F.get(F.split(record, sep), F.lit(item))


def padded_msisdn(msisdn: str, width: int = 10, pad: str = "0") -> Column:
    """A number one character short gets the pad in front; other lengths are left alone."""
    number = F.col(msisdn)
    return F.when(F.length(number) == width - 1, F.concat(F.lit(pad), number)).otherwise(number)
