"""Loans and recharges of a subscriber on one time line, and features looking back and ahead from a loan."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.functions.columns import epoch
from airlend.operators.rolling import rolling
from airlend.schemas import LOAN_OP, RECHARGE_OP, SERVICE_FEE

KINDS = {"loan": LOAN_OP, "spend": RECHARGE_OP}
#: Digits after the point that amounts of an inexact type are kept with.
FRACTION_DIGITS = 6


def loan_recharge_timeline(loans: DataFrame, recharges: DataFrame) -> DataFrame:
    """msisdn, loan_id (0 for recharges), ts, amount, op 'L' or 'R'."""
    taken = loans.select(
        "msisdn",
        "loan_id",
        F.col("loan_ts").alias("ts"),
        F.col("loan_amount").alias("amount"),
        F.lit(LOAN_OP).alias("op"),
    )
    spent = recharges.select(
        "msisdn",
        F.lit(0).cast("bigint").alias("loan_id"),
        F.col("recharge_ts").alias("ts"),
        F.col("recharge_amount").alias("amount"),
        F.lit(RECHARGE_OP).alias("op"),
    )
    return taken.unionByName(spent)


# What a row of the time line adds to the aggregates of its kind: rows, rows with an amount, and the amount.
AMOUNT_PARTIALS = {
    f"{kind}_{part}": how
    for kind in KINDS
    for part, how in (("rows", "sum"), ("n", "sum"), ("sum", "sum"), ("min", "min"), ("max", "max"))
}
AHEAD = ("loan_rows", "loan_n", "loan_sum", "spend_rows", "spend_sum")


def exact_amounts(df: DataFrame, *names: str) -> DataFrame:
    """Amounts of type DOUBLE or FLOAT as decimals, rounded to FRACTION_DIGITS digits.

    Sums of doubles depend on the order of addition, so the same rows could give different results. What does
    not fit (no number, infinite, too large) raises an error.
    """
    inexact = [n for n in names if isinstance(df.schema[n].dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.col(n).cast(T.DecimalType(28, FRACTION_DIGITS)) for n in inexact}) if inexact else df


def minor_units(*dtypes: T.DataType) -> tuple[str, str]:
    """From amounts of these types to whole minor units (cents), and back, as SQL with {} for the amount.

    Sums of whole numbers are as exact as decimal sums and much cheaper; one that leaves the BIGINT range
    raises an error. Amounts that have too many digits or different scales are left as they are.
    """
    dtype = dtypes[0]
    if not all(isinstance(d, T.DecimalType) and d.precision <= 18 and d.scale == dtype.scale for d in dtypes):
        return "{}", "{}"
    unit = f"{Decimal(1).scaleb(-dtype.scale):f}BD"
    return (
        f"CAST({{}} * {10**dtype.scale} AS BIGINT)",
        f"CAST(CAST({{}} AS DECIMAL(19, 0)) * {unit} AS DECIMAL({19 + dtype.scale}, {dtype.scale}))",
    )


def amount_cells(amount: str, op: str) -> list[str]:
    """The partials of `AMOUNT_PARTIALS` for rows with this amount and kind (both SQL)."""
    cells = []
    for kind, code in KINDS.items():
        cells += [
            f"CASE WHEN {op} = '{code}' THEN 1L END AS {kind}_rows",
            f"CASE WHEN {op} = '{code}' AND {amount} IS NOT NULL THEN 1L END AS {kind}_n",
            *(f"CASE WHEN {op} = '{code}' THEN {amount} END AS {kind}_{part}" for part in ("sum", "min", "max")),
        ]
    return cells


def lookback_columns(windows: Sequence[int], money: str) -> list[str]:
    """{count,sum,mean,max,min}_{loan,spend}_N. Over no rows the count is 0 and the others are NULL."""
    cells = []
    for n in windows:
        for kind in KINDS:
            number = f"{kind}_n_back_{n}"
            total = f"CASE WHEN {number} > 0 THEN {money.format(f'{kind}_sum_back_{n}')} END"
            cells += [
                f"{kind}_rows_back_{n} AS count_{kind}_{n}",
                f"{total} AS sum_{kind}_{n}",
                f"CASE WHEN {number} > 0 THEN CAST({total} AS DOUBLE) / {number} END AS mean_{kind}_{n}",
                f"{money.format(f'{kind}_max_back_{n}')} AS max_{kind}_{n}",
                f"{money.format(f'{kind}_min_back_{n}')} AS min_{kind}_{n}",
            ]
    return cells


def forward_columns(windows: Sequence[int], money: str) -> list[str]:
    """future_{spend_sum,loan_sum,loan_count}_N.

    A row of the other kind counts as 0 in a sum. The loan itself lies ahead, so the spend sum is never NULL;
    the loan sum is where there are only loans ahead and none has an amount.
    """
    cells = []
    for n in windows:
        known = f"loan_n_ahead_{n} > 0 OR spend_rows_ahead_{n} > 0"
        cells += [
            f"{money.format(f'spend_sum_ahead_{n}')} AS future_spend_sum_{n}",
            f"CASE WHEN {known} THEN {money.format(f'loan_sum_ahead_{n}')} END AS future_loan_sum_{n}",
            f"loan_rows_ahead_{n} AS future_loan_count_{n}",
        ]
    return cells


def _results(timeline: DataFrame, model_loans: DataFrame) -> DataFrame:
    """The time line's loans that are among the model loans, with the model loan's (merged) amount.

    A model loan without subscriber or number can't be found in the time line; it comes back with empty frames.
    """
    merged = "burst_amount" if "burst_amount" in model_loans.columns else "loan_amount"
    loan_ts = F.col("loan_ts") if "loan_ts" in model_loans.columns else F.lit(None).cast("timestamp")
    model = model_loans.select("msisdn", "loan_id", loan_ts.alias("ts"), F.col(merged).alias("amount"))
    named = "msisdn IS NOT NULL AND loan_id IS NOT NULL"
    wanted = model.filter(named).select("msisdn", "loan_id", "amount").distinct()
    loans = timeline.filter(F.col("op") == LOAN_OP).select("msisdn", "loan_id", "ts")
    found = loans.join(wanted, ["msisdn", "loan_id"]).withColumn("epoch", epoch("ts"))
    unnamed = model.filter(f"NOT ({named})").withColumn("epoch", F.lit(None).cast("bigint"))
    return found.unionByName(unnamed).select(
        "msisdn", "epoch", F.struct("msisdn", "loan_id", "ts", "amount").alias("payload")
    )


def timeline_features(
    timeline: DataFrame,
    model_loans: DataFrame | None,
    windows: Sequence[int],
    back: bool = True,
    ahead: bool = True,
    block_days: int | None = None,
) -> DataFrame:
    """Look-back and look-ahead features of the time line's loans, or of those among the model loans, in one
    pass over the time line."""
    timeline = exact_amounts(timeline, "amount")
    units, money = minor_units(timeline.schema["amount"].dataType)
    columns = ["msisdn", "unix_seconds(ts) AS epoch", *amount_cells(units.format("amount"), "op")]
    if model_loans is None:
        loan = "named_struct('msisdn', msisdn, 'loan_id', loan_id, 'ts', ts, 'amount', amount)"
        columns.append(f"CASE WHEN op = '{LOAN_OP}' THEN {loan} END AS payload")
    rolled = rolling(
        timeline.selectExpr(*columns),
        AMOUNT_PARTIALS,
        windows,
        AHEAD if ahead else (),
        back,
        None if model_loans is None else _results(timeline, model_loans),
        block_days,
    )
    return rolled.selectExpr(
        "msisdn",
        "loan_id",
        "ts",
        "amount",
        *(lookback_columns(windows, money) if back else []),
        *(forward_columns(windows, money) if ahead else []),
    )


def lookback_features(
    timeline: DataFrame,
    model_loans: DataFrame | None,
    windows: Sequence[int],
    block_days: int | None = None,
) -> DataFrame:
    """Loan rows with {count,sum,mean,max,min}_{loan,spend}_N over the N days before, their own second not
    included."""
    return timeline_features(timeline, model_loans, windows, ahead=False, block_days=block_days)


def forward_features(
    timeline: DataFrame,
    model_loans: DataFrame | None,
    windows: Sequence[int],
    block_days: int | None = None,
) -> DataFrame:
    """Loan rows with future_{spend_sum,loan_sum,loan_count}_N from their own second to N days later, both
    included; the loan itself counts."""
    return timeline_features(timeline, model_loans, windows, back=False, block_days=block_days)


def future_spend_corrected(df: DataFrame, windows: Sequence[int], fee: float = SERVICE_FEE) -> DataFrame:
    """Look-ahead spend less the loans and their service fees."""
    fees = {f"future_service_fee_sum_{n}": F.lit(fee) * F.col(f"future_loan_count_{n}") for n in windows}
    corrected = {
        f"future_spend_sum_corrected_{n}": F.col(f"future_spend_sum_{n}").cast("double")
        - F.col(f"future_loan_sum_{n}").cast("double")
        - fees[f"future_service_fee_sum_{n}"]
        for n in windows
    }
    return df.withColumns({**fees, **corrected})
