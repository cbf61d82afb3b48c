"""Date spans, model loans, feasible windows, samples and single-subscriber views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airlend.functions import columns as C

HISTORY = ("loans", "payments", "recharges")


def date_spans(**tables: tuple[DataFrame, str]) -> DataFrame:
    """dataset, min_ts, max_ts, n for each table given as name=(df, timestamp column), in one job."""
    spans = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.min(ts).alias("min_ts"),
            F.max(ts).alias("max_ts"),
            F.count(F.lit(1)).alias("n"),
        )
        for name, (df, ts) in tables.items()
    ]
    return reduce(DataFrame.unionByName, spans)


def spans_within(first: date, last: date, **tables: tuple[DataFrame, str]) -> dict[str, tuple[date, date]]:
    """The days of a history that each table given as name=(df, timestamp column) was seen on: from `first` if it has
    rows on that day or before, else from its first day, and likewise to `last`. A table that has no rows in the
    history and does not reach over it is missing.

    Whether a table reaches an edge is asked with a filter that the statistics of row groups answer for most of
    them, and one row is enough. Only tables that do not reach both edges are read, one column.
    """
    edges = {"first": (None, next_day(first.isoformat())), "last": (last.isoformat(), None)}
    probes = [
        df.select(ts).filter(C.period(ts, *edge)).limit(1).select(F.lit(name).alias("dataset"), F.lit(side).alias("side"))
        for name, (df, ts) in tables.items()
        for side, edge in edges.items()
    ]
    met = {(row.dataset, row.side) for row in reduce(DataFrame.unionByName, probes).collect()}
    found = {name: (first, last) for name in tables if {(name, "first"), (name, "last")} <= met}
    others = {
        name: (df.filter(C.period(ts, first.isoformat(), next_day(last.isoformat()))), ts)
        for name, (df, ts) in tables.items()
        if name not in found
    }
    if others:
        for row in date_spans(**others).collect():
            if row.min_ts is not None:
                lo = first if (row.dataset, "first") in met else row.min_ts.date()
                hi = last if (row.dataset, "last") in met else row.max_ts.date()
                found[row.dataset] = (lo, hi)
    return found


def next_day(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()


def model_loans(loans: DataFrame, lo: str, hi: str, tiers: Sequence[int] | None = None) -> DataFrame:
    """Loans from the day `lo` to the day `hi`, both included, and of these tiers only if any are given."""
    chosen = loans.filter(C.period("loan_ts", lo, next_day(hi)))
    return chosen if tiers is None else chosen.filter(F.col("tier_id").isin(list(tiers)))


def model_tiers(loans: DataFrame) -> DataFrame:
    return loans.select("tier_id").distinct()


def history_span(spans: DataFrame) -> tuple[date, date]:
    """First and last day of the history, on which loans, payments and recharges must agree and within which
    the model loans must lie."""
    rows = spans.collect()
    empty = [row.dataset for row in rows if row.min_ts is None]
    if empty:
        raise ValueError(f"no dates in {empty}")
    return agreed_span({row.dataset: (row.min_ts.date(), row.max_ts.date()) for row in rows})


def model_span(model_loans: DataFrame, ts: str = "loan_ts") -> dict[str, tuple[date, date]]:
    """First and last day of the model loans, under their name."""
    row = date_spans(model_loans=(model_loans, ts)).first()
    if row.min_ts is None:
        raise ValueError("no dates in ['model_loans']")
    return {"model_loans": (row.min_ts.date(), row.max_ts.date())}


def agreed_span(found: Mapping[str, tuple[date, date]]) -> tuple[date, date]:
    """The days that all of `HISTORY` start and end on."""
    first, *others = (found[name] for name in HISTORY)
    if any(other != first for other in others):
        raise ValueError(f"loans, payments and recharges must start and end on the same days: {found}")
    if "model_loans" in found:
        lo, hi = found["model_loans"]
        if lo < first[0] or hi > first[1]:
            raise ValueError(f"the model loans must lie within the history: {found}")
    return first


def feasible_windows(
    model_loans: DataFrame,
    spans: DataFrame | tuple[date, date],
    windows: Sequence[int],
    target_days: int,
    min_rows: int,
) -> DataFrame:
    """One row per candidate largest window, with the model loans that have enough history before them for it
    and enough after them for the target: max_window, start_date, end_date (not included), n_rows, ok, chosen.

    The largest window that leaves at least `min_rows` loans is chosen; if none does, the smallest, not ok.
    `spans` is a result of `date_spans` (one row per table, the only rows that come to the driver), or the
    first and last day of the history. All candidates are counted in one pass.
    """
    first, last = history_span(spans) if isinstance(spans, DataFrame) else spans
    candidates = sorted(set(windows), reverse=True)
    end = last - timedelta(days=target_days + 1)
    starts = {n: first + timedelta(days=n + 1) for n in candidates}

    counted = model_loans.agg(
        *(
            F.count(F.when(C.period("loan_ts", start.isoformat(), end.isoformat()), 1)).alias(f"n_{n}")
            for n, start in starts.items()
        )
    )
    ok = {n: (F.lit(start < end)) & (F.col(f"n_{n}") >= min_rows) for n, start in starts.items()}
    best = F.coalesce(*(F.when(ok[n], n) for n in candidates), F.lit(candidates[-1]))
    rows = [
        F.struct(
            F.lit(n).alias("max_window"),
            F.lit(start).alias("start_date"),
            F.lit(end).alias("end_date"),
            F.col(f"n_{n}").alias("n_rows"),
            ok[n].alias("ok"),
            (best == n).alias("chosen"),
        )
        for n, start in starts.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def daily_sample(features: DataFrame, ts: str = "loan_ts", amount: str = "burst_amount") -> DataFrame:
    """One row per subscriber and day: the loan at which the day's running total is largest (of several the
    latest, then the smallest loan id, then one by a hash of the row), with that total and the least of each target
    so far.

    The choice is made on narrow rows: subscriber, time, loan id, amount, targets and a hash of the whole row. The
    features themselves are read again and joined with the chosen hashes, so they go through one shuffle and no
    aggregate but that which leaves one of equal rows.

    Loans are combined per subscriber and time first, on the map side; running totals are then taken within a
    second and over the seconds of a day, so no task gets more than a million times or 86,400 seconds of one
    subscriber at once, whatever a day holds.
    """
    targets = [name for name in features.columns if name.startswith("target_")]
    so_far = Window.unboundedPreceding
    # 128 bits of hash stand for the row.
    row = {"_row_1": F.xxhash64(*features.columns), "_row_2": F.xxhash64(F.lit(1), *features.columns)}

    narrow = features.select("msisdn", F.col(ts).alias("_ts"), "loan_id", F.col(amount).alias("_amount"), *targets, *(
        column.alias(name) for name, column in row.items()
    ))
    times = (
        narrow.withColumns({"date": F.to_date("_ts"), "_second": F.date_trunc("second", "_ts")})
        .groupBy("msisdn", "date", "_second", "_ts")
        .agg(
            F.sum("_amount").alias("total"),
            *(F.min(name).alias(f"{name}_min") for name in targets),
            F.min(F.struct("loan_id", *row)).alias("loan"),
        )
    )
    in_second = Window.partitionBy("msisdn", "date", "_second").orderBy("_ts").rowsBetween(so_far, 0)
    running = times.select(
        "msisdn",
        "date",
        "_second",
        "total",
        *(f"{name}_min" for name in targets),
        F.struct(
            F.sum("total").over(in_second).alias("total"),
            F.col("_ts"),
            F.col("loan"),
            *(F.min(f"{name}_min").over(in_second).alias(f"{name}_min") for name in targets),
        ).alias("best"),
    )
    seconds = running.groupBy("msisdn", "date", "_second").agg(
        F.sum("total").alias("total"),
        *(F.min(f"{name}_min").alias(f"{name}_min") for name in targets),
        F.max("best").alias("best"),
    )
    earlier = Window.partitionBy("msisdn", "date").orderBy("_second").rowsBetween(so_far, -1)
    before, here = F.sum("total").over(earlier), F.col("best.total")
    at_day = seconds.select(
        "msisdn",
        "date",
        F.struct(
            F.coalesce(before + here, before, here).alias("total"),
            F.col("best._ts"),
            F.col("best.loan"),
            *(
                F.least(F.min(f"{name}_min").over(earlier), F.col(f"best.{name}_min")).alias(f"{name}_min")
                for name in targets
            ),
        ).alias("best"),
    )
    days = at_day.groupBy("msisdn", "date").agg(F.max("best").alias("best"))
    chosen = days.select(
        "date",
        F.col("best.total").alias("total_loan_amount"),
        *(F.col(f"best.{name}_min") for name in targets),
        *(F.col(f"best.loan.{name}") for name in row),
    )
    wide = features.select("*", *(column.alias(name) for name, column in row.items()))
    return wide.join(chosen, list(row)).dropDuplicates(list(row)).drop(*row)


def subscriber_history(
    loans: DataFrame, payments: DataFrame, recharges: DataFrame, msisdns: Sequence[str]
) -> DataFrame:
    """Everything known about some subscribers: source, msisdn, ts, loan_id, amount. The test on the
    subscriber reaches each table's scan."""
    wanted = F.col("msisdn").isin(list(msisdns))
    no_loan = F.lit(None).cast("bigint").alias("loan_id")

    def part(df: DataFrame, source: str, ts: str, loan_id, amount: str) -> DataFrame:
        return df.filter(wanted).select(
            F.lit(source).alias("source"), "msisdn", F.col(ts).alias("ts"), loan_id, F.col(amount).alias("amount")
        )

    return (
        part(loans, "loan", "loan_ts", F.col("loan_id"), "loan_amount")
        .unionByName(part(payments, "payment", "pay_ts", F.col("loan_id"), "pay_amount"))
        .unionByName(part(recharges, "recharge", "recharge_ts", no_loan, "recharge_amount"))
    )
