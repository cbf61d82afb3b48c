"""What a loan's look-ahead features and targets can know: the days after it that the sources were seen.

A window that reaches past the last day of its source is unfinished. Its sums and counts are NULL, and so is a target
that was not reached yet; a target that was reached is known whatever comes later.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The source that each look-ahead feature is made of.
SOURCES = {
    "future_spend_sum": "recharges",
    "future_loan_sum": "loans",
    "future_loan_count": "loans",
    "future_service_fee_sum": "loans",
}


def with_days_seen(df: DataFrame, last_days: Mapping[str, date], ts: str = "loan_ts") -> DataFrame:
    """Adds days_seen_{source}: whole days after the row's own day up to the source's last day."""
    return df.withColumns(
        {f"days_seen_{source}": F.datediff(F.lit(last), F.to_date(ts)) for source, last in last_days.items()}
    )


def censored(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Look-ahead features and targets of `windows` that are not decided within the days seen become NULL.

    `df` has days_seen_{loans,payments,recharges}. Features that it does not have are passed over.
    """
    changed = {}
    for n in windows:
        for feature, source in SOURCES.items():
            name = f"{feature}_{n}"
            if name in df.columns:
                changed[name] = F.when(F.col(f"days_seen_{source}") >= n, F.col(name))
        name = f"future_spend_sum_corrected_{n}"
        if name in df.columns:
            seen = F.least("days_seen_loans", "days_seen_recharges") >= n
            changed[name] = F.when(seen, F.col(name))
        name = f"target_{n}"
        if name in df.columns:
            changed[name] = F.when((F.col(name) == 1) | (F.col("days_seen_payments") >= n), F.col(name))
    return df.withColumns(changed)
