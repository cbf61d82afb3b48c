"""Summaries of a day that can be put together to any period: distinct subscribers and quantiles of amounts.

The exact forms read all rows of a period again. A day's sketches are some kilobytes, are written once, and any months
or weeks are merged from them. The subscriber sketch is off by SUBSCRIBER_ERROR at most in 99 of 100 cases, the
amount sketch by RANK_ERROR in rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.functions import columns as C

#: 2^14 registers: a standard error of 0.8 percent.
LG_REGISTERS = 14
SUBSCRIBER_ERROR = 0.025
#: The size of a quantile sketch; twice the items give about half the error.
QUANTILE_ITEMS = 400
RANK_ERROR = 0.01


def daily_sketches(df: DataFrame, ts: str, subscriber: str, amount: str) -> DataFrame:
    """day, n, subscribers and amounts (both sketches). Rows without time belong to no day."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(C.day(ts).alias("day"))
        .agg(
            F.count("*").alias("n"),
            F.hll_sketch_agg(subscriber, LG_REGISTERS).alias("subscribers"),
            F.kll_sketch_agg_double(F.col(amount).cast("double"), QUANTILE_ITEMS).alias("amounts"),
        )
    )


def merged(days: DataFrame, *keys: str) -> DataFrame:
    """The sketches of all rows with the same keys as one: keys, n, subscribers, amounts."""
    return days.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("subscribers").alias("subscribers"),
        F.kll_merge_agg_double("amounts").alias("amounts"),
    )


def estimates(sketched: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), *keys: str) -> DataFrame:
    """keys, n, n_subscribers and amount_{percent} of each quantile; NULL quantiles where no row has an amount."""
    some = F.kll_sketch_get_n_double("amounts") > 0
    return sketched.select(
        *keys,
        "n",
        F.hll_sketch_estimate("subscribers").alias("n_subscribers"),
        *(
            F.when(some, F.kll_sketch_get_quantile_double("amounts", F.lit(q))).alias(f"amount_{round(100 * q)}")
            for q in quantiles
        ),
    )
