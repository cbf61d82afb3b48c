"""Run-scoped staging, mergeable sketches, the reject channel, and the plan of the daily sample."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.operators import cleaning, dataset, sketches
from airlend.sources.staging import Run
from tests.helpers import at, recharges


def folder_of(run: Run) -> str:
    return run.folder.removeprefix("file:")


def test_a_run_leaves_nothing_behind(spark):
    with Run(spark, "tests-clean") as run:
        staged = run.stage(spark.range(5), "numbers")
        assert staged.count() == 5 and os.path.isdir(folder_of(run)) and run.tables() == ["numbers"]
    assert not os.path.exists(folder_of(run)) and run.tables() == []


def test_a_run_that_starts_again_reuses_complete_tables(spark):
    counted = spark.sparkContext.accumulator(0)

    def rows(schema="id long"):
        def count(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        return spark.range(5).mapInArrow(count, schema)

    with pytest.raises(RuntimeError), Run(spark, "tests-again") as run:
        run.stage(rows(), "first")
        raise RuntimeError("the driver is lost")
    assert counted.value == 5 and run.tables() == ["first"]
    os.remove(f"{folder_of(run)}/first/schema/_SUCCESS")
    with pytest.raises(RuntimeError), Run(spark, "tests-again") as run:
        assert run.tables() == []  # not complete: written anew
        run.stage(rows(), "first")
        raise RuntimeError("lost again")
    assert counted.value == 10
    with Run(spark, "tests-again") as run:
        assert sorted(r.id for r in run.stage(rows(), "first").collect()) == [0, 1, 2, 3, 4]
        assert run.reused == ["first"] and counted.value == 10
        other = run.stage(spark.range(3).withColumn("x", F.lit("a")), "first")  # another schema
        assert run.reused == ["first"] and other.columns == ["id", "x"] and other.count() == 3
    with pytest.raises(RuntimeError), Run(spark, "tests-again", keep_failed=False) as run:
        run.stage(spark.range(1), "first")
        raise RuntimeError("lost")
    assert not os.path.exists(folder_of(run))
    with pytest.raises(ValueError):
        Run(spark, "../elsewhere")


def test_days_merge_to_the_sketches_of_a_period(spark):
    n = 60_000
    rows = spark.range(n).selectExpr(
        "cast(id % 7001 as string) msisdn", "timestamp_seconds(1648771200 + id % 40 * 86400) ts",
        "cast(id * 7919 % 10007 as decimal(18,2)) amount",
    )
    days = sketches.daily_sketches(rows.unionByName(rows.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))), "ts", "msisdn", "amount")
    assert days.count() == 40
    parts = days.withColumn("half", F.col("day") < "2022-04-20")
    whole = sketches.estimates(sketches.merged(sketches.merged(parts, "half")), (0.1, 0.5, 0.9)).first()
    assert whole.n == n and abs(whole.n_subscribers - 7001) <= sketches.SUBSCRIBER_ERROR * 7001
    for q, found in ((0.1, whole.amount_10), (0.5, whole.amount_50), (0.9, whole.amount_90)):
        rank = rows.filter(F.col("amount") <= found).count() / n
        assert abs(rank - q) <= sketches.RANK_ERROR + 1 / n
    none = recharges(spark, [("a", at(0), None), (None, at(0), None)])
    row = sketches.estimates(sketches.daily_sketches(none, "recharge_ts", "msisdn", "recharge_amount")).first()
    assert (row.n, row.n_subscribers, row.amount_50) == (2, 1, None)


def test_rejects(spark):
    schema = T.StructType.fromDDL("a int, b decimal(4,2), c timestamp, d string, e int, f int")
    text = [(" 1 ", "1.5", "2022-04-01", "x", "2.7", None), ("1.5", "999.99", "soon", "", "x", ""), ("99999999999", "b", "", None, "3", None)]
    rows = spark.createDataFrame(text, "a string, b string, c string, d string, e string, g string")
    typed = cleaning.type_with_rejects(rows, schema, truncated=("e",)).cache()
    assert typed.columns == ["a", "b", "c", "d", "e", "f", "rejects"]
    assert typed.drop("rejects").collect() == cleaning.type_template(rows, schema, ("e",)).collect()
    found = {tuple(r) for r in cleaning.rejected_values(typed).collect()}
    assert found == {
        ("a", "1.5", "fraction"), ("a", "99999999999", "range"), ("b", "999.99", "range"), ("b", "b", "format"),
        ("c", "soon", "format"), ("e", "x", "format"),
    }
    keyed = cleaning.rejected_values(typed, "d").columns
    assert keyed == ["d", "column", "value", "reason"]


def test_the_daily_sample_decides_on_narrow_rows(spark):
    names = "msisdn string, loan_id long, loan_ts timestamp, burst_amount decimal(18,2), target_7 int"
    wide = ", ".join(f"feature_{k} double" for k in range(30))
    rows = [("a", k % 3, at(0, k % 3), Decimal(1), 1, *[float(k % 3)] * 30) for k in range(9)]
    features = spark.createDataFrame(rows, f"{names}, {wide}")
    found = dataset.daily_sample(features)
    (row,) = found.collect()
    assert (row.loan_id, row.total_loan_amount, row.feature_29) == (2, 9, 2.0)
    assert found.columns == [*features.columns, "date", "total_loan_amount", "target_7_min"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    carrying = [line for line in plan.split("\n") if "feature_7" in line and any(op in line for op in ("Aggregate", "Window"))]
    # Only where one of equal rows is left, after the join by the rows' hashes.
    assert all("key=[_row_1" in line for line in carrying) and len(carrying) == 4  # partial and final, in the first and the adapted plan
    assert not [line for line in plan.split("\n") if "feature_7" in line and "Sort [msisdn" in line]
