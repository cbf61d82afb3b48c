from datetime import datetime
from decimal import Decimal

from airlend import schemas as S
from airlend.operators import cleaning
from airlend.plans.ledger import prepare_ledger
from airlend.sources.tables import read_ledger
from tests.helpers import by


def test_msisdn_lengths(spark):
    numbers = ["12345678", "123456789", "1234567890", "12345678901", None]
    df = spark.createDataFrame([(n,) for n in numbers], "msisdn string")
    assert {r.msisdn for r in cleaning.normalise_msisdn(df).collect()} == {"0123456789", "1234567890"}


def test_template_trims_types_and_drops_the_rest(spark):
    columns = ["_c0", "MSISDN", "ADVANCE_ID", "CHANNEL_ID", "LOAN_DATE", "LOAN_AMOUNT", "SERVICE_FEE", "OTHER"]
    rows = [
        ("0", " 0123 ", " 7 ", "x", "2022-08-01 10:00:00", "5.50", " 1.1", "z"),
        ("1", "0124", "8.0", "3", "no date", "five", None, "z"),
    ]
    df = spark.createDataFrame(rows, columns)
    typed = cleaning.type_template(cleaning.to_template(df, S.LOAN_COLUMNS), S.LOANS)
    assert typed.schema.names == S.LOANS.names
    first, second = typed.orderBy("msisdn").collect()
    assert (first.msisdn, first.loan_id, first.channel_id) == ("0123", 7, None)
    assert first.loan_amount == Decimal("5.50") and first.service_fee == Decimal("1.10")
    assert first.loan_ts == datetime(2022, 8, 1, 10) and first.tier_id is None
    assert (second.loan_id, second.channel_id, second.loan_ts, second.loan_amount) == (8, 3, None, None)


def test_typed_columns_pass_through(spark):
    df = spark.createDataFrame([(1,)], "operation_type int")
    plan = cleaning.type_ledger(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast" not in plan.lower()


def test_either_payment_date_name(spark):
    for name in ("IN_DATE", "PAYMENT_DATE"):
        df = spark.createDataFrame([("1", "2022-01-01")], ["MSISDN", name])
        assert "pay_ts" in cleaning.to_template(df, S.PAYMENT_COLUMNS).columns


def test_finance_types(spark):
    df = spark.createDataFrame(
        [("1", "2023-01-05", "2", "75.5", "20.0", "2023-02-01", "x")],
        ["msisdn", "advancedate", "advancestatus", "qualifiedamount", "amount", "duedate", "repaydate"],
    )
    (row,) = cleaning.type_finance(df).collect()
    assert (row.qualified_amount, row.chosen_amount, row.repay_ts) == (75.5, 20, None)


def test_raw_record_items(spark):
    records = ["a,b,c,Recharge,e,f,x-Bank-1,g,h,i,y-Shop-2,z", "a,b", "a,b,c,text,e,f,nodash,g,h,i,", None]
    df = spark.createDataFrame(list(enumerate(records)), "n int, raw_record string")
    split = cleaning.split_raw_record(df)
    assert split.columns == ["n", "transaction_text", "entity", "entity_name"]
    rows = by(split.collect(), "n")
    assert rows[0][1:] == ("Recharge", "Bank", "Shop")
    assert rows[1][1:] == (None, None, None)
    assert rows[2][1:] == ("text", None, None)
    assert rows[3][1:] == (None, None, None)


def test_ledger_read_by_position(spark, tmp_path):
    (tmp_path / "one.csv").write_text("other,names,here,a,b,c,d,e\n1,x,2023-04-01 01:02:03,5.5,t,Customer,0,1\n")
    (tmp_path / "two.csv").write_text("other,names,here,a,b,c,d,e\n2,4,2023-04-02,oops,t,SP,1,\n")
    ledger = cleaning.type_ledger(read_ledger(spark, str(tmp_path)))
    rows = by(ledger.collect(), "msisdn")
    assert (rows["1"].advance_id, rows["1"].amount, rows["1"].profile_eligibility) == (None, 5.5, 1)
    assert rows["1"].event_ts == datetime(2023, 4, 1, 1, 2, 3)
    assert (rows["2"].advance_id, rows["2"].amount, rows["2"].profile_eligibility) == (4, None, None)
    wide = read_ledger(spark, str(tmp_path), names=S.WIDE_LEDGER_COLUMNS[:8])
    assert wide.columns == S.WIDE_LEDGER_COLUMNS[:8]


def test_prepare_ledger_from_the_wide_layout(spark):
    values = ["1", "7", "2023-04-22 23:59:59", "5.0", "t", "c", "Customer", "0", "9", "9", "9", "9", "f", "1"]
    record = "a,b,c,Recharge,e,f,x-Bank,g,h,i,y-Shop"
    rows = [tuple(values + [record]), tuple(values[:2] + ["2023-04-23 00:00:00"] + values[3:] + [record])]
    raw = spark.createDataFrame(rows, S.WIDE_LEDGER_COLUMNS)
    (row,) = prepare_ledger(raw, cut_over="2023-04-23").collect()
    assert (row.amount, row.operation_type, row.entity, row.entity_name) == (5.0, 0, "Bank", "Shop")
    assert "file_name" not in row and "raw_record" not in row and row.day == datetime(2023, 4, 22)


def test_year_month_day_and_dedupe(spark):
    df = spark.createDataFrame([(datetime(2023, 4, 5, 6, 7),)] * 2, "event_ts timestamp")
    (row,) = cleaning.with_day(cleaning.with_year_month(cleaning.dedupe(df))).collect()
    assert (row.year, row.month, row.day) == ("2023", "04", datetime(2023, 4, 5))


def test_ids_are_exact(spark):
    raw = spark.createDataFrame([("9007199254740993.0",), ("12.7",), (" 7 ",), ("x",)], "ADVANCE_ID string")
    typed = cleaning.type_template(cleaning.to_template(raw, S.LOAN_COLUMNS), S.LOANS)
    assert [row.loan_id for row in typed.collect()] == [9007199254740993, None, 7, None]
