"""One row per model loan with look-back, look-ahead and pay-day features and repayment targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend import schemas as S
from airlend.operators import censoring, cleaning, dataset, repayment
from airlend.operators import timeline as tl
from airlend.operators.bursts import collapse_bursts
from airlend.operators.cohorts import in_period
from airlend.operators.rolling import rolling
from airlend.sources.staging import Run
from airlend.sources.tables import stage


@dataclass(frozen=True)
class FeatureConfig:
    """model_period   first and last day of the model loans
    history        first and last day of the history; None takes them from the tables, which must agree
    spans          first and last day of loans, payments and recharges, if they are known; None asks the tables
    censor         look-ahead features and targets of windows that reach past the last day of their source are NULL
                   unless decided, and days_seen_{loans,payments,recharges} tell how far each loan was seen.
                   Without it they hold what was seen: 0 for a target that may still be reached
    windows        look-back and look-ahead windows in days, also the days of the targets
    target_days    days after a loan that the history must cover
    min_rows       model loans that a largest window must leave
    restrict       keep the windows that the history can support; an error if none leaves enough loans
    restrict_rows  with `restrict`, also leave out the model loans that the largest window kept can't support
    tiers          tiers of the model loans, None for all
    burst_unit     loans within this unit of time are one loan
    known_by_loan_date, require_full_repayment   see `pay_day_features` and `repayment_targets`
    attributes     further columns of the loans that the table keeps, of a burst those of its first loan
    block_days     see `rolling`
    """

    model_period: tuple[str, str]
    history: tuple[str, str] | None = None
    spans: Mapping[str, tuple[str, str]] | None = None
    censor: bool = True
    windows: Sequence[int] = S.WINDOWS
    target_days: int = S.TARGET_DAYS
    min_rows: int = S.MIN_MODEL_LOANS
    restrict: bool = True
    restrict_rows: bool = False
    tiers: Sequence[int] | None = None
    burst_unit: str = "minute"
    known_by_loan_date: bool = False
    require_full_repayment: bool = False
    attributes: Sequence[str] = ()
    block_days: int | None = None


def prepare_sources(
    advances: DataFrame,
    payments: DataFrame,
    recharges: DataFrame,
    attributes: Mapping[str, tuple[str, T.DataType]] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three extracts as canonical tables: renamed, trimmed, typed, without invalid numbers and repeated
    rows. `attributes` names further columns of the advances to keep: source name to name and type."""
    more = attributes or {}
    columns = S.LOAN_COLUMNS | {source: name for source, (name, _) in more.items()}
    schema = T.StructType([*S.LOANS, *(T.StructField(name, kind) for name, kind in more.values())])

    def prepare(df: DataFrame, mapping: dict[str, str], schema) -> DataFrame:
        typed = cleaning.type_template(cleaning.to_template(df, mapping), schema)
        # Rows are compared as they are used: without the index column, trimmed and typed.
        return cleaning.normalise_msisdn(cleaning.dedupe(typed))

    return (
        prepare(advances, columns, schema),
        prepare(payments, S.PAYMENT_COLUMNS, S.PAYMENTS),
        prepare(recharges, S.RECHARGE_COLUMNS, S.RECHARGES),
    )


LOAN_FIELDS = (
    "msisdn",
    "loan_id",
    "loan_ts",
    "channel_id",
    "status_id",
    "tier_id",
    "service_fee",
    "loan_amount",
    "burst_amount",
    "burst_fee",
    "burst_size",
)


def build_feature_table(
    loans: DataFrame, payments: DataFrame, recharges: DataFrame, cfg: FeatureConfig, run: Run | None = None
) -> DataFrame:
    """The feature table. The inputs should be stored tables: they are scanned more than once.

    Payments meet loans once; the result is staged in the shared folder, since the loan history, the model
    loans and their targets all come from it. So are the model loans, which the window check and both ways of
    `rolling` read. Loans, recharges and days to pay then go through one `rolling` pass, to which the model loans are
    rows with a payload, so there is no join back. With a `run` what is staged
    belongs to it: it is reused if the run starts again and removed when it ends.
    """
    fields = [*LOAN_FIELDS, *cfg.attributes]
    spans = _spans(loans, payments, recharges, cfg)
    if cfg.history:
        _check_history(spans, cfg)
        lo, hi = cfg.history[0], dataset.next_day(cfg.history[1])
        loans = in_period(loans, "loan_ts", lo, hi)
        payments = in_period(payments, "pay_ts", lo, hi)
        recharges = in_period(recharges, "recharge_ts", lo, hi)

    loans = tl.exact_amounts(loans, "loan_amount")
    recharges = tl.exact_amounts(recharges, "recharge_amount")
    keep = run.stage if run else stage
    repaid = keep(repayment.loan_repayment(loans, payments), "repaid-loans")
    model = collapse_bursts(dataset.model_loans(repaid, *cfg.model_period, cfg.tiers), cfg.burst_unit)
    model = keep(model.select(*fields, "total_paid", "days_to_pay"), "model-loans")
    windows = sorted(cfg.windows)
    lo, hi = cfg.model_period[0], dataset.next_day(cfg.model_period[1])
    if cfg.restrict:
        chosen = _chosen_window(model, spans, cfg)
        windows = [n for n in windows if n <= chosen.max_window]
        if not chosen.ok:
            raise ValueError(f"no window leaves {cfg.min_rows} model loans with enough history: {chosen}")
        if cfg.restrict_rows:
            lo, hi = max(lo, chosen.start_date.isoformat()), min(hi, chosen.end_date.isoformat())
            model = in_period(model, "loan_ts", lo, hi)

    # Only what lies within the longest window of a model loan can matter to it.
    reach = timedelta(days=windows[-1])
    near = ((date.fromisoformat(lo) - reach).isoformat(), (date.fromisoformat(hi) + reach).isoformat())
    units, money = tl.minor_units(
        repaid.schema["loan_amount"].dataType, recharges.schema["recharge_amount"].dataType
    )
    rolled = rolling(
        _points(repaid, recharges, near, units, cfg.known_by_loan_date),
        tl.AMOUNT_PARTIALS | repayment.DAY_PARTIALS,
        windows,
        tl.AHEAD,
        results=model.selectExpr(
            "msisdn",
            "unix_seconds(loan_ts) AS epoch",
            f"struct({', '.join(fields)}, total_paid, days_to_pay) AS payload",
        ),
        block_days=cfg.block_days,
    )
    paid = "days_to_pay <= {n} AND total_paid >= burst_amount" if cfg.require_full_repayment else "days_to_pay <= {n}"
    table = rolled.selectExpr(
        *fields,
        *tl.lookback_columns(windows, money),
        *tl.forward_columns(windows, money),
        *repayment.pay_day_columns(windows),
        *(f"CASE WHEN {paid.format(n=n)} THEN 1 ELSE 0 END AS target_{n}" for n in windows),
    )
    if not cfg.censor:
        return table
    last_days = {name: last for name, (_, last) in spans.items()}
    return censoring.censored(censoring.with_days_seen(table, last_days), windows)


def _spans(
    loans: DataFrame, payments: DataFrame, recharges: DataFrame, cfg: FeatureConfig
) -> dict[str, tuple[date, date]]:
    """First and last day of each source, within the history if one is stated."""
    tables = {"loans": (loans, "loan_ts"), "payments": (payments, "pay_ts"), "recharges": (recharges, "recharge_ts")}
    if cfg.spans:
        found = {name: tuple(map(date.fromisoformat, cfg.spans[name])) for name in tables}
        if not cfg.history:
            return found
        first, last = map(date.fromisoformat, cfg.history)
        return {name: (max(lo, first), min(hi, last)) for name, (lo, hi) in found.items() if lo <= last and hi >= first}
    if cfg.history:
        return dataset.spans_within(*map(date.fromisoformat, cfg.history), **tables)
    if not cfg.restrict and not cfg.censor:
        return {}
    rows = dataset.date_spans(**tables).collect()
    empty = [row.dataset for row in rows if row.min_ts is None]
    if empty:
        raise ValueError(f"no dates in {empty}")
    return {row.dataset: (row.min_ts.date(), row.max_ts.date()) for row in rows}


def _check_history(spans: Mapping[str, tuple[date, date]], cfg: FeatureConfig) -> None:
    """A stated history must be one that all sources have. Where payments end before the last day on which a model
    loan's target is open, loans would pass for unpaid; where a source starts after the first day of the model loans
    or ends before the last, subscribers would pass for silent. Without `censor` that holds for recharges as long as
    targets are open, since nothing tells then how far they were seen."""
    first, last = map(date.fromisoformat, cfg.history)
    lo, hi = map(date.fromisoformat, cfg.model_period)
    if lo < first or hi > last:
        raise ValueError(f"the model period {cfg.model_period} must lie within the history {cfg.history}")
    open_until = min(last, hi + timedelta(days=cfg.target_days))
    for name, needed in (("loans", hi), ("payments", open_until), ("recharges", hi if cfg.censor else open_until)):
        if name not in spans:
            raise ValueError(f"the history is said to reach from {first} to {last}, but has no {name}")
        begin, end = spans[name]
        if end < needed:
            raise ValueError(
                f"the history is said to reach {last}, but the last {name[:-1]} is of {end}, before {needed}"
            )
        if begin > lo:
            raise ValueError(
                f"the history is said to start on {first}, but the first {name[:-1]} is of {begin}, after {lo}"
            )


def _chosen_window(model: DataFrame, spans: Mapping[str, tuple[date, date]], cfg: FeatureConfig):
    if cfg.history:
        history = tuple(map(date.fromisoformat, cfg.history))
    else:
        history = dataset.agreed_span({**spans, **dataset.model_span(model)})
    candidates = dataset.feasible_windows(model, history, cfg.windows, cfg.target_days, cfg.min_rows)
    return candidates.filter("chosen").first()


def _points(
    repaid: DataFrame, recharges: DataFrame, near: tuple[str, str], units: str, known_by_loan_date: bool
) -> DataFrame:
    """Loans with their days to pay, and recharges, as points for `rolling`."""

    def amounts(df: DataFrame, ts: str, amount: str, op: str, more: Sequence[str] = ()) -> DataFrame:
        cells = tl.amount_cells(units.format(amount), f"'{op}'")
        return in_period(df, ts, *near).selectExpr("msisdn", f"unix_seconds({ts}) AS epoch", *cells, *more)

    days = () if known_by_loan_date else repayment.DAY_CELLS
    points = amounts(repaid, "loan_ts", "loan_amount", S.LOAN_OP, days).unionByName(
        amounts(recharges, "recharge_ts", "recharge_amount", S.RECHARGE_OP), allowMissingColumns=True
    )
    if known_by_loan_date:
        paid = repayment.repayments_as_points(in_period(repaid, "last_pay_ts", *near))
        points = points.unionByName(paid, allowMissingColumns=True)
    return points
