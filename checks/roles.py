"""The driver's tables in the roles of loans, payments, recharges, ledger and finance advances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(name: str) -> Column:
    return F.col(name).cast("timestamp")


def _money(name: str | Column) -> Column:
    return (F.col(name) if isinstance(name, str) else name).cast(MONEY)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("msisdn"),
        F.col("o_orderkey").alias("loan_id"),
        F.lit(1).alias("channel_id"),
        _money("o_totalprice").alias("loan_amount"),
        _money(_money("o_totalprice") * F.lit("0.1").cast("decimal(2,1)")).alias("service_fee"),
        _ts("o_orderdate").alias("loan_ts"),
        F.ascii("o_orderstatus").alias("status_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tier_id"),
    )


def qualified_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans with two more attributes: the amount qualified for and the service type."""
    attributes = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        _money(_money("o_totalprice") * 2).alias("qualified_amount"),
        F.col("o_orderpriority").alias("service_type"),
    )
    return loans(spark, sf_dir).join(attributes, "loan_id")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("msisdn"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        "msisdn",
        F.col("l_orderkey").alias("loan_id"),
        _ts("l_shipdate").alias("pay_ts"),
        _money("l_extendedprice").alias("pay_amount"),
    )


def recharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        "msisdn",
        _ts("l_shipdate").alias("recharge_ts"),
        _money("l_extendedprice").alias("recharge_amount"),
        F.col("l_returnflag").alias("entity_type"),
    )


def line_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger that goes with the finance advances."""
    number = F.col("l_linenumber")
    return _lines(spark, sf_dir).select(
        "msisdn",
        _ts("l_shipdate").alias("event_ts"),
        _money("l_extendedprice").alias("amount"),
        F.when(F.col("l_returnflag") == "R", "Organization").otherwise("Customer").alias("other_party"),
        F.when(F.col("l_linestatus") == "F", "B2C Reversal").otherwise("Recharge").alias("transaction_text"),
        F.when(number <= 5, 0).when(number == 6, 1).otherwise(2).alias("operation_type"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
    )


def finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("msisdn"),
        _ts("o_orderdate").alias("advance_ts"),
        (F.col("o_totalprice") / 1000).alias("qualified_amount"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("chosen_amount"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tier_id"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("msisdn"),
        F.col("event_id").alias("advance_id"),
        _ts("ts").alias("event_ts"),
        _money("value").alias("amount"),
        kind.alias("other_party"),
        kind.alias("transaction_text"),
        F.when(kind == "purchase", 1).when(kind == "signup", 2).otherwise(0).alias("operation_type"),
        (F.get_json_object("props", "$.k").cast("int") >= 50).cast("int").alias("profile_eligibility"),
    )


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as text, with a raw record of 11 items; every seventh record stops after the third item,
    and every eleventh amount is no number."""
    number = F.col("event_id")
    kind = F.col("event_type")
    head = [F.col("event_id"), F.col("user_id"), F.lit("x")]
    tail = [kind, F.lit("a"), F.lit("b"), F.concat(F.lit("e-"), kind), *[F.lit("c")] * 3]
    entity_name = F.concat(F.lit("n-"), "user_id", F.lit("-z"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("msisdn"),
        F.concat(F.lit(" "), number.cast("string")).alias("advance_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_ts"),
        F.when(number % 11 == 0, "n/a").otherwise(F.format_string("%.2f", "value")).alias("amount"),
        F.lit("0").alias("operation_type"),
        F.when(number % 2 == 0, "1").otherwise("").alias("profile_eligibility"),
        F.when(number % 7 == 0, F.concat_ws(",", *head))
        .otherwise(F.concat_ws(",", *head, *tail, entity_name))
        .alias("raw_record"),
    )


def raw_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finance advances as text under their source names; every ninth chosen amount is no number."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("msisdn"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("advancedate"),
        (key % 4).cast("string").alias("advancestatus"),
        F.format_string("%.2f", price).alias("qualifiedamount"),
        F.when(key % 9 == 0, "none").otherwise(F.floor(price / 1000).cast("string")).alias("amount"),
        F.date_format(F.date_add("o_orderdate", 7), "yyyy-MM-dd").alias("duedate"),
        F.when(key % 5 > 0, F.date_format(F.date_add("o_orderdate", 3), "yyyy-MM-dd")).alias("repaydate"),
    )


def raw_advances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as padded text under their source names, each row twice, with an index column; every tenth fee is
    no number."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    once = table(spark, sf_dir, "orders").select(
        (2 * key).cast("string").alias("_c0"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("MSISDN"),
        F.concat(F.lit("  "), key.cast("string")).alias("ADVANCE_ID"),
        F.lit("3 ").alias("CHANNEL_ID"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("LOAN_DATE"),
        F.format_string("%.2f", price).alias("LOAN_AMOUNT"),
        F.ascii("o_orderstatus").cast("string").alias("STATUS_ID"),
        F.substring("o_orderpriority", 1, 1).alias("PROFILE_TIER_ID"),
        F.when(key % 10 == 0, "-").otherwise("1.10").alias("SERVICE_FEE"),
    )
    again = once.withColumns({"_c0": F.concat("_c0", F.lit("1")), "MSISDN": F.trim("MSISDN")})
    return once.unionByName(again)


def event_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    loan = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("msisdn"),
        F.when(loan, F.col("event_id")).otherwise(0).alias("loan_id"),
        _ts("ts").alias("ts"),
        _money("value").alias("amount"),
        F.when(loan, "L").otherwise("R").alias("op"),
    )


def event_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    loan = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return loan.select(
        F.col("user_id").cast("string").alias("msisdn"),
        F.col("event_id").alias("loan_id"),
        _money("value").alias("loan_amount"),
        F.lit(1.1).cast(MONEY).alias("service_fee"),
        _ts("ts").alias("loan_ts"),
    )


def event_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signup pays the purchase with the number just before its own, where there is one."""
    paid = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    return paid.select(
        F.col("user_id").cast("string").alias("msisdn"),
        (F.col("event_id") - 1).alias("loan_id"),
        _ts("ts").alias("pay_ts"),
        _money("value").alias("pay_amount"),
    )


def event_recharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = table(spark, sf_dir, "events").filter(~F.col("event_type").isin("purchase", "signup"))
    return spent.select(
        F.col("user_id").cast("string").alias("msisdn"),
        _ts("ts").alias("recharge_ts"),
        _money("value").alias("recharge_amount"),
        F.col("event_type").alias("entity_type"),
    )


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber numbers of 9, 10 and 7 characters."""
    kind = F.col("c_custkey") % 3
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(kind == 0, F.substring(name, 10, 9))
        .when(kind == 1, F.concat(F.lit("27"), F.substring(name, 11, 8)))
        .otherwise(F.substring(name, 12, 7))
        .alias("msisdn"),
    )


def sample_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with two targets from their own rows, for the daily sample."""
    return event_loans(spark, sf_dir).select(
        "msisdn",
        "loan_id",
        "loan_ts",
        "loan_amount",
        (F.col("loan_amount") > 20).cast("int").alias("target_7"),
        (F.col("loan_amount") > 5).cast("int").alias("target_30"),
    )
