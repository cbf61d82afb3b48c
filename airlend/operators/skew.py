"""Joins that hold when one subscriber has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def filter_by_subscribers(
    df: DataFrame, subscribers: DataFrame, how: str, salts: int = SALTS
) -> DataFrame:
    """Rows of the subscribers given (`left_semi`) or of all others (`left_anti`).

    `subscribers` has distinct msisdn. Each is repeated once per salt and the rows of one subscriber are
    spread over the salts by their other columns, so no join task gets all of them.
    """
    salted = subscribers.select("msisdn", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    spread = df.withColumn("_salt", F.pmod(F.hash(*df.columns), F.lit(salts)))
    return spread.join(salted, ["msisdn", "_salt"], how).drop("_salt")
