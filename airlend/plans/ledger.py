"""A raw ledger made ready for the summaries and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from airlend.operators import cleaning
from airlend.operators.cohorts import in_period
from airlend.schemas import UNUSED_LEDGER_COLUMNS


def prepare_ledger(raw: DataFrame, cut_over: str | None = None) -> DataFrame:
    """Typed ledger with year, month and day, the items of the raw record if there is one, and without the
    rows from the cut-over day on. All of it is one projection over the scan."""
    ledger = cleaning.type_ledger(raw.drop(*UNUSED_LEDGER_COLUMNS))
    ledger = cleaning.with_day(cleaning.with_year_month(ledger))
    if "raw_record" in ledger.columns:
        ledger = cleaning.split_raw_record(ledger)
    return in_period(ledger, "event_ts", hi=cut_over)
