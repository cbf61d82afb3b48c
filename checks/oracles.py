"""SQL for DuckDB that gives the same rows as each registered query."""

from __future__ import annotations

from airlend.plans.cohort import month_period
from checks.queries import (
    EVENT_MIN_ROWS,
    EVENT_MODEL_PERIOD,
    EVENT_WINDOWS,
    M0,
    MIN_ROWS,
    MODEL_PERIOD,
    ORDER_WINDOWS,
    PAY_DAY_WINDOWS,
    SUBSCRIBERS,
    TARGET_DAYS,
)

MONEY = "decimal(18,2)"
KINDS = {"loan": "L", "spend": "R"}

# The roles of the driver's tables, as in checks/roles.py.
ROLES = {
    "loans": f"""
        select cast(o_custkey as varchar) as msisdn, o_orderkey as loan_id,
               cast(o_totalprice as {MONEY}) as loan_amount,
               cast(cast(o_totalprice as {MONEY}) * 0.1 as {MONEY}) as service_fee,
               o_orderdate as loan_ts, cast(ascii(o_orderstatus) as bigint) as status_id,
               cast(substr(o_orderpriority, 1, 1) as bigint) as tier_id
        from orders""",
    "payments": f"""
        select cast(o_custkey as varchar) as msisdn, l_orderkey as loan_id, l_shipdate as pay_ts,
               cast(l_extendedprice as {MONEY}) as pay_amount
        from lineitem join orders on l_orderkey = o_orderkey""",
    "recharges": f"""
        select cast(o_custkey as varchar) as msisdn, l_shipdate as recharge_ts,
               cast(l_extendedprice as {MONEY}) as recharge_amount, l_returnflag as entity_type
        from lineitem join orders on l_orderkey = o_orderkey""",
    "line_ledger": f"""
        select cast(o_custkey as varchar) as msisdn, l_shipdate as event_ts,
               cast(l_extendedprice as {MONEY}) as amount,
               case when l_returnflag = 'R' then 'Organization' else 'Customer' end as other_party,
               case when l_linestatus = 'F' then 'B2C Reversal' else 'Recharge' end as transaction_text,
               case when l_linenumber <= 5 then 0 when l_linenumber = 6 then 1 else 2 end as operation_type,
               concat(l_orderkey, '-', l_linenumber) as transaction_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    "finance": """
        select cast(o_custkey as varchar) as msisdn, o_orderdate as advance_ts,
               o_totalprice / 1000 as qualified_amount,
               cast(floor(o_totalprice / 1000) as bigint) as chosen_amount,
               cast(substr(o_orderpriority, 1, 1) as bigint) as tier_id
        from orders""",
    "ledger": f"""
        select cast(user_id as varchar) as msisdn, event_id as advance_id, ts as event_ts,
               cast(value as {MONEY}) as amount, event_type as other_party, event_type as transaction_text,
               cast(case event_type when 'purchase' then 1 when 'signup' then 2 else 0 end as bigint)
                   as operation_type,
               case when cast(json_extract_string(props, '$.k') as int) >= 50 then 1::bigint else 0::bigint end
                   as profile_eligibility
        from events""",
    "event_timeline": f"""
        select cast(user_id as varchar) as msisdn,
               case when event_type = 'purchase' then event_id else 0 end as loan_id, ts,
               cast(value as {MONEY}) as amount,
               case when event_type = 'purchase' then 'L' else 'R' end as op
        from events""",
    "event_loans": f"""
        select cast(user_id as varchar) as msisdn, event_id as loan_id, cast(value as {MONEY}) as loan_amount,
               cast(1.1 as {MONEY}) as service_fee, ts as loan_ts
        from events where event_type = 'purchase'""",
    "event_payments": f"""
        select cast(user_id as varchar) as msisdn, event_id - 1 as loan_id, ts as pay_ts,
               cast(value as {MONEY}) as pay_amount
        from events where event_type = 'signup'""",
    "event_recharges": f"""
        select cast(user_id as varchar) as msisdn, ts as recharge_ts, cast(value as {MONEY}) as recharge_amount,
               event_type as entity_type
        from events where event_type not in ('purchase', 'signup')""",
}


def sql(body: str, *roles: str, **more: str) -> str:
    """A query over roles and further named subqueries."""
    parts = [f"{name} as ({ROLES[name]})" for name in roles] + [f"{n} as ({q})" for n, q in more.items()]
    return f"with {', '.join(parts)} {body}" if parts else body


def money(expression: str, name: str) -> str:
    return f"cast({expression} as double) as {name}"


def mean(value: str, over: str = "") -> str:
    return f"cast(sum({value}){over} as double) / nullif(count({value}){over}, 0)"


def in_month(ts: str, k: int = 0) -> str:
    """In the k-th month after M0."""
    lo, hi = month_period(M0, k)
    return f"{ts} >= timestamp '{lo}' and {ts} < timestamp '{hi}'"


def in_days(ts: str, span: tuple[str, str]) -> str:
    return f"{ts} >= date '{span[0]}' and {ts} < date '{span[1]}' + interval 1 day"


CUSTOMER = "operation_type = 0 and other_party = 'Customer' and transaction_text <> 'B2C Reversal'"
EPOCH = "cast(floor(epoch({})) as bigint)"


def back(n: int, order: str = "e") -> str:
    return f" over (partition by msisdn order by {order} range between {n * 86400} preceding and 1 preceding)"


def ahead(n: int) -> str:
    return f" over (partition by msisdn order by e range between current row and {n * 86400} following)"


def lookback_cells(windows) -> list[str]:
    cells = []
    for n in windows:
        w = back(n)
        for kind, op in KINDS.items():
            v = f"case when op = '{op}' then amount end"
            cells += [
                f"count(case when op = '{op}' then 1 end){w} as count_{kind}_{n}",
                money(f"sum({v}){w}", f"sum_{kind}_{n}"),
                f"{mean(v, w)} as mean_{kind}_{n}",
                money(f"max({v}){w}", f"max_{kind}_{n}"),
                money(f"min({v}){w}", f"min_{kind}_{n}"),
            ]
    return cells


def forward_cells(windows) -> list[str]:
    cells = []
    for n in windows:
        w = ahead(n)
        cells += [
            money(f"sum(case when op = 'R' then amount else 0 end){w}", f"future_spend_sum_{n}"),
            money(f"sum(case when op = 'L' then amount else 0 end){w}", f"future_loan_sum_{n}"),
            f"count(case when op = 'L' then 1 end){w} as future_loan_count_{n}",
        ]
    return cells


def pay_day_cells(windows, order: str = "e") -> list[str]:
    cells = []
    for n in windows:
        w = back(n, order)
        cells += [
            f"round({mean('days_to_pay', w)}, 6) as mean_pay_days_{n}",
            f"max(days_to_pay){w} as max_pay_days_{n}",
            f"min(days_to_pay){w} as min_pay_days_{n}",
            f"round(stddev_samp(days_to_pay){w}, 6) as std_pay_days_{n}",
        ]
    return cells


def timeline_sql(cells: list[str]) -> str:
    return sql(
        f"""select * exclude (op, e) from (
            select msisdn, loan_id, ts, cast(amount as double) as amount, op, e, {', '.join(cells)}
            from (select *, {EPOCH.format('ts')} as e from event_timeline)) where op = 'L'""",
        "event_timeline",
    )


PAID = """
    select loan_id, arg_max(msisdn, (pay_ts, msisdn)) as msisdn, sum(pay_amount) as total_paid,
           max(pay_ts) as last_pay_ts
    from payments where loan_id is not null group by loan_id"""
REPAID = """
    select l.*, p.total_paid, p.last_pay_ts, date_diff('day', l.loan_ts, p.last_pay_ts) as days_to_pay
    from loans l left join paid p on p.loan_id = l.loan_id and p.msisdn = l.msisdn"""
TIMELINE = """
    select msisdn, loan_id, loan_ts as ts, loan_amount as amount, 'L' as op from loans
    union all
    select msisdn, 0, recharge_ts, recharge_amount, 'R' from recharges"""


def targets(windows, test: str = "days_to_pay <= {n}") -> list[str]:
    return [f"case when {test.format(n=n)} then 1::bigint else 0::bigint end as target_{n}" for n in windows]


def repaid_sql(body: str) -> str:
    return sql(body, "loans", "payments", paid=PAID, repaid=REPAID)


def burst_sql(loans: str, payments: str, unit: str, more: str) -> str:
    """Bursts the long way, with windows."""
    paid = f"select loan_id, sum(pay_amount) as total_paid, max(pay_ts) as last_pay_ts from {payments} group by 1"
    w = f"over (partition by msisdn, date_trunc('{unit}', loan_ts))"
    merged = f"""
        select l.*, p.last_pay_ts, sum(loan_amount) {w} as burst_amount, sum(service_fee) {w} as burst_fee,
               count(*) {w} as burst_size, sum(p.total_paid) {w} as burst_paid,
               row_number() over (partition by msisdn, date_trunc('{unit}', loan_ts) order by loan_ts, l.loan_id) as rn
        from {loans} l left join paid p on p.loan_id = l.loan_id"""
    return sql(
        f"""select msisdn, loan_id, loan_ts, {more} {money('loan_amount', 'loan_amount')},
               {money('service_fee', 'service_fee')}, {money('burst_amount', 'burst_amount')},
               {money('burst_fee', 'burst_fee')}, burst_size, {money('burst_paid', 'total_paid')}, last_pay_ts
        from merged where rn = 1""",
        loans,
        payments,
        paid=paid,
        merged=merged,
    )


def feature_table_sql(all_loans: bool = False) -> str:
    """The whole feature table over the plain order tables, with one window per feature.

    With `all_loans` no model loan is cut, and what was not seen to its end is NULL.
    """
    history = ("1995-01-01", "2001-11-30")
    lo, hi = MODEL_PERIOD
    windows = ORDER_WINDOWS
    start = f"(date '{history[0]}' + interval (max_window + 1) day)"
    end = f"(date '{history[1]}' - interval {TARGET_DAYS + 1} day)"
    candidates = " union all ".join(f"select {n} as max_window" for n in windows)
    line_cells = lookback_cells(windows) + forward_cells(windows)
    names = [cell.rsplit(" as ", 1)[1] for cell in line_cells]
    rounded = [f"round({n}, 6) as {n}" if n.startswith("mean_") else n for n in names]
    pay_names = [cell.rsplit(" as ", 1)[1] for cell in pay_day_cells(windows)]
    labels, seen = targets(windows), ""
    if all_loans:
        days = {k: f"date_diff('day', m.loan_ts, (select {k} from horizon))" for k in ("loans", "payments", "recharges")}
        source = {"future_spend": "recharges", "future_loan": "loans"}
        rounded = [
            next((f"case when {days[s]} >= {n.rsplit('_', 1)[1]} then {n} end as {n}" for p, s in source.items() if n.startswith(p)), n)
            for n in rounded
        ]
        labels = [
            f"case when days_to_pay <= {n} then 1::bigint when {days['payments']} >= {n} then 0::bigint end as target_{n}"
            for n in windows
        ]
        seen = "".join(f", {sql_days} as days_seen_{name}" for name, sql_days in days.items())
    last = f"cast(least(max({{}}), timestamp '{history[1]}') as date)"
    return sql(
        f"""select m.msisdn, m.loan_id, m.loan_ts, 1::bigint as channel_id, m.status_id, m.tier_id,
               {money('m.service_fee', 'service_fee')}, {money('m.loan_amount', 'loan_amount')},
               {money('m.burst_amount', 'burst_amount')}, {money('m.burst_fee', 'burst_fee')}, m.burst_size,
               {money('m.qualified_amount', 'qualified_amount')}, m.service_type,
               {', '.join(rounded)}, {', '.join(pay_names)}, {', '.join(labels)}{seen}
        from chosen_model m
        join line_features f on f.msisdn = m.msisdn and f.loan_id = m.loan_id and f.op = 'L'
        join pay_features p on p.msisdn = m.msisdn and p.loan_id = m.loan_id""",
        plain_loans=ROLES["loans"],
        all_loans=f"""
            select l.*, cast(cast(o_totalprice as {MONEY}) * 2 as {MONEY}) as qualified_amount,
                   o_orderpriority as service_type
            from plain_loans l join orders on o_orderkey = l.loan_id""",
        all_payments=ROLES["payments"],
        all_recharges=ROLES["recharges"],
        loans=f"select * from all_loans where {in_days('loan_ts', history)}",
        payments=f"select * from all_payments where {in_days('pay_ts', history)}",
        recharges=f"select * from all_recharges where {in_days('recharge_ts', history)}",
        paid=PAID,
        repaid=REPAID,
        bursts=f"""
            select *, sum(loan_amount) over w as burst_amount, sum(service_fee) over w as burst_fee,
                   count(*) over w as burst_size,
                   row_number() over (partition by msisdn, date_trunc('minute', loan_ts)
                                      order by loan_ts, loan_id) as rn
            from repaid where {in_days('loan_ts', (lo, hi))}
            window w as (partition by msisdn, date_trunc('minute', loan_ts))""",
        model="select * from bursts where rn = 1",
        counted=f"""
            select max_window, {start} as s, {end} as t,
                   (select count(*) from model where loan_ts >= {start} and loan_ts < {end}) as n
            from ({candidates})""",
        chosen=f"""
            select coalesce(max(case when s < t and n >= {MIN_ROWS} then max_window end), min(max_window)) as w
            from counted""",
        horizon=f"""
            select (select {last.format('loan_ts')} from all_loans) as loans,
                   (select {last.format('pay_ts')} from all_payments) as payments,
                   (select {last.format('recharge_ts')} from all_recharges) as recharges""",
        chosen_model=f"""
            select model.* from model, counted, chosen
            where counted.max_window = chosen.w and ({str(all_loans).lower()} or loan_ts >= s and loan_ts < t)""",
        timeline=TIMELINE,
        line_features=f"""
            select msisdn, loan_id, op, {', '.join(line_cells)}
            from (select *, {EPOCH.format('ts')} as e from timeline)""",
        pay_features=f"""
            select msisdn, loan_id, {', '.join(pay_day_cells(windows))}
            from (select *, {EPOCH.format('loan_ts')} as e from repaid)""",
    )


def feasible_windows_sql() -> str:
    candidates = " union all ".join(f"select {n}::bigint as max_window" for n in (1, 3, 7, 14, 21))
    return sql(
        f"""select max_window, start_date, end_date, n_rows, ok,
               max_window = coalesce((select max(max_window) from tested where ok),
                                     (select min(max_window) from tested)) as chosen
        from tested""",
        "event_loans",
        "event_payments",
        "event_recharges",
        model=f"select * from event_loans where {in_days('loan_ts', EVENT_MODEL_PERIOD)}",
        history="select min(loan_ts)::date as first_day, max(loan_ts)::date as last_day from event_loans",
        bounds=f"""
            select max_window, cast(first_day + cast(max_window + 1 as int) as timestamp) as start_date,
                   cast(last_day - 4 as timestamp) as end_date
            from ({candidates}), history""",
        counted="""
            select *, (select count(*) from model where loan_ts >= start_date and loan_ts < end_date) as n_rows
            from bounds""",
        tested=f"select *, start_date < end_date and n_rows >= {EVENT_MIN_ROWS} as ok from counted",
    )


def oracle_sql() -> dict[str, str]:
    day = "date_trunc('day', event_ts)::timestamp as day"
    cohort = f"select * from finance where {in_month('advance_ts')}"
    bucket = """case when qualified_amount <= 50 then '50' when qualified_amount <= 100 then '50-100'
        when qualified_amount <= 150 then '100-150' when qualified_amount <= 200 then '150-200'
        when qualified_amount > 200 then '> 200' end as qualified_bucket"""

    def month_sum(k: int, name: str) -> str:
        return money(f"sum(case when {in_month('event_ts', k)} then amount end)", name)

    def cohort_sums(offsets: dict[int, str]) -> str:
        near = " or ".join(f"({in_month('event_ts', k)})" for k in offsets)
        return f"""
            select msisdn, {', '.join(month_sum(k, name) for k, name in offsets.items())}
            from (select distinct * from line_ledger) where {CUSTOMER} and ({near})
              and msisdn in (select msisdn from cohort) group by msisdn"""

    def ledger_months(rows: str, by: str = "") -> str:
        return f"""
            select month{by}, count(*) as n_subscribers, cast(sum(amount) as double) / count(*) as mean_amount,
                   cast(sum(n) as double) / count(*) as mean_number
            from (select msisdn, date_trunc('month', event_ts)::timestamp as month{by}, sum(amount) as amount,
                         count(*) as n
                  from ledger {rows} group by all) group by all"""

    offsets = {-1: "m_minus_1", 0: "m0", 1: "m_plus_1", 2: "m_plus_2"}
    subscribers = ", ".join(f"'{s}'" for s in SUBSCRIBERS)
    suffixes = "right(msisdn, 2) in ('06', '08', '22', '39', '42')"
    before = {k: in_month("recharge_ts", -k) for k in (1, 2, 3)}
    repaid_columns = """msisdn, loan_id, loan_ts, cast(loan_amount as double) as loan_amount,
        cast(total_paid as double) as total_paid, last_pay_ts, days_to_pay"""
    known_rows = f"""
        select msisdn, {EPOCH.format('last_pay_ts')} as e, days_to_pay, null::bigint as loan_id from repaid
        where last_pay_ts is not null
        union all
        select msisdn, {EPOCH.format('loan_ts')}, null, loan_id from repaid"""
    pay_names = [cell.rsplit(" as ", 1)[1] for cell in pay_day_cells(PAY_DAY_WINDOWS)]
    corrected = [
        f"round(1.1::double * future_loan_count_{n}, 6) as future_service_fee_sum_{n}, "
        f"round(future_spend_sum_{n} - future_loan_sum_{n} - 1.1::double * future_loan_count_{n}, 6) "
        f"as future_spend_sum_corrected_{n}"
        for n in EVENT_WINDOWS
    ]
    order_cells = lookback_cells(ORDER_WINDOWS)
    amount_counts = f"""select '{{0}}' as source, msisdn, count(*) as n, {money('sum({1})', 'amount')}
        from {{2}} group by msisdn"""
    padded = "lpad(msisdn, 10, '0') as msisdn"
    prepared = """
        select cast(user_id as varchar) as msisdn, event_id as advance_id, date_trunc('second', ts) as event_ts,
               case when event_id % 11 <> 0 then cast(value as double) end as amount,
               0::bigint as operation_type,
               case when event_id % 2 = 0 then 1::bigint end as profile_eligibility,
               strftime(ts, '%Y') as year, strftime(ts, '%m') as month,
               date_trunc('day', ts)::timestamp as day,
               case when event_id % 7 <> 0 then event_type end as transaction_text,
               case when event_id % 7 <> 0 then event_type end as entity,
               case when event_id % 7 <> 0 then cast(user_id as varchar) end as entity_name
        from events where ts < timestamp '2024-01-25'"""
    return {
        "daily_counts": sql(f"select {day}, count(event_ts) as n from ledger group by 1", "ledger"),
        "loan_daily": sql(
            f"""select {day}, {money('sum(amount)', 'loan_sum')}, count(event_ts) as loan_count
            from ledger where operation_type = 1 group by 1""",
            "ledger",
        ),
        "loan_amount_daily": sql(
            f"""select {money('amount', 'amount')}, {day}, {money('sum(amount)', 'loan_sum')},
               count(event_ts) as loan_count
            from ledger where operation_type = 1 group by 1, 2""",
            "ledger",
        ),
        "recharge_profile": sql(
            f"""select other_party, transaction_text, profile_eligibility, {money('sum(amount)', 'amount_sum')}
            from ledger where operation_type = 0 group by 1, 2, 3""",
            "ledger",
        ),
        "recharge_payment_daily": sql(
            f"""select {day}, operation_type, count(amount) as n, {money('sum(amount)', 'amount_sum')}
            from ledger where operation_type in (0, 2) group by 1, 2""",
            "ledger",
        ),
        "recharge_type_daily": sql(
            f"""select transaction_text, {day}, profile_eligibility, {money('sum(amount)', 'amount_sum')},
               count(transaction_text) as n
            from ledger where operation_type in (0, 2) group by 1, 2, 3""",
            "ledger",
        ),
        "split_raw_record": """
            select cast(user_id as varchar) as msisdn, concat(' ', event_id) as advance_id,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') as event_ts,
                   case when event_id % 11 = 0 then 'n/a' else printf('%.2f', value) end as amount,
                   '0' as operation_type, case when event_id % 2 = 0 then '1' else '' end as profile_eligibility,
                   case when event_id % 7 <> 0 then event_type end as transaction_text,
                   case when event_id % 7 <> 0 then event_type end as entity,
                   case when event_id % 7 <> 0 then cast(user_id as varchar) end as entity_name
            from events""",
        "typed_ledger": """
            select cast(user_id as varchar) as msisdn, event_id as advance_id, date_trunc('second', ts) as event_ts,
                   case when event_id % 11 <> 0 then cast(value as double) end as amount,
                   0::bigint as operation_type,
                   case when event_id % 2 = 0 then 1::bigint end as profile_eligibility,
                   strftime(ts, '%Y') as year, strftime(ts, '%m') as month,
                   date_trunc('day', ts)::timestamp as day
            from events where ts < timestamp '2024-01-25'""",
        "prepared_ledger": prepared,
        "wide_csv_ledger": prepared,
        "typed_finance": """
            select cast(o_custkey as varchar) as msisdn, o_orderdate as advance_ts, o_orderkey % 4 as advance_status,
                   o_totalprice as qualified_amount,
                   case when o_orderkey % 9 <> 0 then cast(floor(o_totalprice / 1000) as bigint) end as chosen_amount,
                   o_orderdate + interval 7 day as due_ts,
                   case when o_orderkey % 5 > 0 then o_orderdate + interval 3 day end as repay_ts
            from orders""",
        "normalise_msisdn": """
            select c_custkey, msisdn from (
                select c_custkey, case c_custkey % 3 when 0 then '0' || substr(c_name, 10, 9)
                                                     when 1 then '27' || substr(c_name, 11, 8)
                                                     else substr(c_name, 12, 7) end as msisdn
                from customer) where length(msisdn) = 10""",
        "type_template": f"""
            select cast(o_custkey as varchar) as msisdn, o_orderkey as loan_id, 3::bigint as channel_id,
                   o_totalprice as loan_amount,
                   case when o_orderkey % 10 <> 0 then 1.1::double end as service_fee, o_orderdate as loan_ts,
                   cast(ascii(o_orderstatus) as bigint) as status_id,
                   cast(substr(o_orderpriority, 1, 1) as bigint) as tier_id
            from orders""",
        "amount_buckets": sql(
            f"select *, {bucket} from finance where {in_month('advance_ts')}", "finance"
        ),
        "cohort_recharges": sql(
            cohort_sums({k: f"month_{k}" for k in range(3)}), "finance", "line_ledger", cohort=cohort
        ),
        "cohort_bucket_recharges": sql(
            f"""select distinct sums.msisdn, qualified_bucket, {', '.join(offsets.values())}
            from sums left join (select msisdn, {bucket} from cohort) b on b.msisdn = sums.msisdn""",
            "finance",
            "line_ledger",
            cohort=cohort,
            sums=cohort_sums(offsets),
        ),
        "m0_daily_recharges": sql(
            f"""select msisdn, {day}, {money('sum(amount)', 'amount_sum')} from line_ledger
            where {CUSTOMER} and {in_month('event_ts')} and msisdn in (select msisdn from cohort) group by 1, 2""",
            "finance",
            "line_ledger",
            cohort=cohort,
        ),
        "amount_peers": sql(
            """select a.tier_id, a.msisdn, count(distinct a.r) as n_rows, count(distinct b.r) as peer_rows,
               count(*) as n_pairs
            from numbered a join numbered b on a.tier_id = b.tier_id group by 1, 2""",
            "finance",
            numbered=f"select *, row_number() over () as r from finance where {in_month('advance_ts')}",
        ),
        "subscribers_with_amount": sql(
            "select distinct msisdn from finance where chosen_amount = 20", "finance"
        ),
        "csv_roundtrip": sql(
            f"""select msisdn, advance_id, date_trunc('second', event_ts) as event_ts, {money('amount', 'amount')},
               other_party, operation_type, profile_eligibility from ledger""",
            "ledger",
        ),
        "write_features": sql(
            f"""select msisdn, loan_id, loan_ts, {money('loan_amount', 'loan_amount')},
               strftime(loan_ts, '%Y-%m') as loan_month from loans""",
            "loans",
        ),
        "read_sources": sql(
            " union all ".join(
                amount_counts.format(*part)
                for part in (
                    ("loans", "loan_amount", "l"),
                    ("payments", "pay_amount", "p"),
                    ("recharges", "recharge_amount", "r"),
                )
            ),
            "loans",
            "payments",
            "recharges",
            l=f"select {padded}, loan_amount from loans",
            p=f"select distinct {padded}, loan_id, pay_ts, pay_amount from payments",
            r=f"select distinct {padded}, recharge_ts, recharge_amount, entity_type from recharges",
        ),
        "paid_totals": sql(
            f"select loan_id, msisdn, {money('total_paid', 'total_paid')}, last_pay_ts from paid",
            "payments",
            paid=PAID,
        ),
        "loan_repayment": repaid_sql(f"select {repaid_columns}, {', '.join(targets(PAY_DAY_WINDOWS))} from repaid"),
        "t14_full_repayment_targets": repaid_sql(
            "select msisdn, loan_id, "
            + ", ".join(targets(PAY_DAY_WINDOWS, "days_to_pay <= {n} and total_paid >= loan_amount"))
            + " from repaid"
        ),
        "pay_day_features": repaid_sql(
            f"""select msisdn, loan_id, loan_ts, last_pay_ts, days_to_pay, {', '.join(pay_day_cells(PAY_DAY_WINDOWS))}
            from (select *, {EPOCH.format('loan_ts')} as e from repaid)"""
        ),
        "pay_day_features_known": sql(
            f"""select repaid.msisdn, repaid.loan_id, loan_ts, last_pay_ts, days_to_pay, {', '.join(pay_names)}
            from repaid join features on features.loan_id = repaid.loan_id""",
            "loans",
            "payments",
            paid=PAID,
            repaid=REPAID,
            known=known_rows,
            features=f"select loan_id, {', '.join(pay_day_cells(PAY_DAY_WINDOWS))} from known",
        ),
        "merge_loan_bursts": burst_sql("loans", "payments", "minute", "status_id, tier_id,"),
        "merge_event_bursts": burst_sql("event_loans", "event_payments", "hour", ""),
        "timeline_union": sql(
            f"select msisdn, loan_id, ts, {money('amount', 'amount')}, op from timeline",
            "loans",
            "recharges",
            timeline=TIMELINE,
        ),
        "lookback_features": timeline_sql(lookback_cells(EVENT_WINDOWS)),
        "forward_features": timeline_sql(forward_cells(EVENT_WINDOWS)),
        "timeline_features": timeline_sql(lookback_cells(EVENT_WINDOWS) + forward_cells(EVENT_WINDOWS)),
        "timeline_features_by_day": timeline_sql(lookback_cells(EVENT_WINDOWS) + forward_cells(EVENT_WINDOWS)),
        "order_lookback_features": sql(
            f"""select msisdn, loan_id, ts, {money('amount', 'amount')},
               {', '.join(cell.rsplit(' as ', 1)[1] for cell in order_cells)}
            from (select msisdn, loan_id, ts, amount, op, {', '.join(order_cells)}
                  from (select *, {EPOCH.format('ts')} as e from timeline))
            where op = 'L' and {in_days('ts', MODEL_PERIOD)}""",
            "loans",
            "recharges",
            timeline=TIMELINE,
        ),
        "future_spend_corrected": sql(
            f"select *, {', '.join(corrected)} from ({timeline_sql(forward_cells(EVENT_WINDOWS))})"
        ),
        "date_spans": sql(
            f"""select 'loans' as dataset, min(loan_ts) as min_ts, max(loan_ts) as max_ts, count(*) as n from loans
            union all select 'payments', min(pay_ts), max(pay_ts), count(*) from payments
            union all select 'recharges', min(recharge_ts), max(recharge_ts), count(*) from recharges
            union all select 'model_loans', min(loan_ts), max(loan_ts), count(*) from loans
                      where {in_days('loan_ts', MODEL_PERIOD)}""",
            "loans",
            "payments",
            "recharges",
        ),
        "model_loans": sql(
            f"""select msisdn, loan_id, {money('loan_amount', 'loan_amount')}, {money('service_fee', 'service_fee')},
               loan_ts, status_id, tier_id
            from loans where {in_days('loan_ts', MODEL_PERIOD)} and tier_id in (1, 2)""",
            "loans",
        ),
        "model_tiers": sql(
            f"select distinct tier_id from loans where {in_days('loan_ts', MODEL_PERIOD)}", "loans"
        ),
        "feasible_windows": feasible_windows_sql(),
        "daily_sample": sql(
            f"""select msisdn, loan_id, loan_ts, {money('loan_amount', 'loan_amount')}, target_7, target_30,
               date_trunc('day', loan_ts)::timestamp as date, {money('total', 'total_loan_amount')},
               target_7_min, target_30_min
            from ranked where rn = 1""",
            "event_loans",
            features="""
                select *, (loan_amount > 20)::bigint as target_7, (loan_amount > 5)::bigint as target_30
                from event_loans""",
            running="""
                select *, sum(loan_amount) over w as total, min(target_7) over w as target_7_min,
                       min(target_30) over w as target_30_min
                from features window w as (partition by msisdn, loan_ts::date order by loan_ts)""",
            ranked="""
                select *, row_number() over (partition by msisdn, loan_ts::date
                                             order by total desc, loan_ts desc, loan_id) as rn
                from running""",
        ),
        "subscriber_history": sql(
            f"""select 'loan' as source, msisdn, loan_ts as ts, loan_id, {money('loan_amount', 'amount')}
            from loans where msisdn in ({subscribers})
            union all select 'payment', msisdn, pay_ts, loan_id, cast(pay_amount as double)
            from payments where msisdn in ({subscribers})
            union all select 'recharge', msisdn, recharge_ts, null, cast(recharge_amount as double)
            from recharges where msisdn in ({subscribers})""",
            "loans",
            "payments",
            "recharges",
        ),
        "rejected_values": """
            select 'ledger' as source, 'amount' as "column", 'format' as reason, count(*) as n
            from events where event_id % 11 = 0 having count(*) > 0
            union all
            select 'finance', 'chosen_amount', 'format', count(*) from orders where o_orderkey % 9 = 0 having count(*) > 0
            union all
            select 'advances', 'service_fee', 'format', 2 * count(*) from orders where o_orderkey % 10 = 0
            having count(*) > 0""",
        "sketched_months": sql(
            """select date_trunc('month', recharge_ts)::timestamp as month, count(*) as n, true as subscribers_near,
                   true as median_near
            from recharges where recharge_ts is not null group by 1""",
            "recharges",
        ),
        "build_feature_table": feature_table_sql(),
        "feature_table_all_loans": feature_table_sql(all_loans=True),
        "t1_monthly_loan_value": sql(
            f"""select date_trunc('month', loan_ts)::timestamp as month, count(loan_amount) as n_loans,
               {money('sum(loan_amount)', 'loan_sum')}, {mean('loan_amount')} as mean_loan
            from loans group by 1""",
            "loans",
        ),
        "t2_loans_per_subscriber_month": sql(
            """select month, n_loans, count(*) as n_subscribers from (
                select msisdn, date_trunc('month', loan_ts)::timestamp as month, count(*) as n_loans
                from loans group by 1, 2) group by 1, 2""",
            "loans",
        ),
        "t3_days_between_loans": sql(
            """select days, count(*) as n from (
                select date_diff('day', lag(loan_ts) over (partition by msisdn order by loan_ts, loan_id), loan_ts)
                       as days from loans) where days is not null group by 1""",
            "loans",
        ),
        "t4_repayment_time": repaid_sql(
            f"""select days_to_pay, count(*) as n_loans, {money('sum(loan_amount)', 'loan_sum')},
               {money('sum(total_paid)', 'paid_sum')}, coalesce(days_to_pay <= 30, false) as recovered
            from repaid group by days_to_pay"""
        ),
        "t5_payment_timing": sql(
            f"""select day(pay_ts) as day_of_month, hour(pay_ts) as hour, count(pay_amount) as n,
               {money('sum(pay_amount)', 'paid_sum')}, {mean('pay_amount')} as mean_paid
            from event_payments group by 1, 2""",
            "event_payments",
        ),
        "t6_loan_size_repayment": repaid_sql(
            f"""select cast(floor(loan_amount / 10000) * 10000 as bigint) as loan_size, count(*) as n_loans,
               count(total_paid) as n_paid, {money('sum(loan_amount)', 'loan_sum')},
               {money('sum(total_paid)', 'paid_sum')}
            from repaid group by 1"""
        ),
        "t7_payments_per_loan_month": sql(
            """select month, count(*) as n_loans, cast(sum(n) as bigint) as n_payments,
               cast(sum(n) as double) / count(*) as mean_payments
            from (select loan_id, date_trunc('month', pay_ts)::timestamp as month, count(*) as n
                  from payments group by 1, 2) group by 1""",
            "payments",
        ),
        "t8_recharges_per_subscriber_month": sql(
            """select month, count(*) as n_subscribers, cast(sum(amount) as double) / count(*) as mean_amount,
               cast(sum(n) as double) / count(*) as mean_number
            from (select msisdn, date_trunc('month', recharge_ts)::timestamp as month,
                         sum(recharge_amount) as amount, count(*) as n
                  from recharges group by 1, 2) group by 1""",
            "recharges",
        ),
        "t8_recharges_by_eligibility": sql(
            ledger_months("where operation_type = 0", ", profile_eligibility"), "ledger"
        ),
        "t8_without_payments": sql(ledger_months("where operation_type <> 2"), "ledger"),
        "t9_recharge_amounts": sql(
            f"select {money('recharge_amount', 'recharge_amount')}, count(*) as n from event_recharges group by 1",
            "event_recharges",
        ),
        "t10_recharges_before_loan_month": sql(
            "select msisdn, "
            + ", ".join(
                f"{money(f'sum(case when {t} then recharge_amount end)', f'sum_m_minus_{k}')}, "
                f"count(case when {t} then recharge_amount end) as n_m_minus_{k}, "
                f"{mean(f'case when {t} then recharge_amount end')} as mean_m_minus_{k}"
                for k, t in before.items()
            )
            + f""" from recharges
            where recharge_ts >= timestamp '1996-10-01' and recharge_ts < timestamp '1997-01-01'
              and msisdn in (select msisdn from loans where {in_month('loan_ts')}) group by msisdn""",
            "loans",
            "recharges",
        ),
        "t11_recharge_days": sql(
            """select dayofweek(recharge_ts) + 1 as day_of_week, day(recharge_ts) as day_of_month, count(*) as n,
               count(distinct (msisdn, recharge_ts::date)) as n_subscriber_days
            from recharges group by 1, 2""",
            "recharges",
        ),
        "t12_cohort_extract": sql(
            f"""select 'loan' as source, msisdn, loan_id, loan_ts as ts from loans
            where {in_days('loan_ts', ('1996-01-01', '1998-12-31'))} and msisdn in (select msisdn from members)
            union all select 'payment', msisdn, loan_id, pay_ts from payments
            where {in_days('pay_ts', ('1996-01-01', '1998-12-31'))} and msisdn in (select msisdn from members)
            union all select 'recharge', msisdn, null, recharge_ts from recharges
            where {in_days('recharge_ts', ('1996-01-01', '1998-12-31'))} and msisdn in (select msisdn from members)""",
            "loans",
            "payments",
            "recharges",
            members=f"""
                select distinct msisdn from loans
                where {suffixes} and {in_days('loan_ts', ('1997-01-01', '1997-03-31'))}""",
        ),
        "t13_entity_daily_recharges": sql(
            f"""select msisdn, entity_type, date_trunc('day', recharge_ts)::timestamp as day,
               {money('sum(recharge_amount)', 'amount_sum')} from event_recharges group by 1, 2, 3""",
            "event_recharges",
        ),
        "t15_subscribers_per_amount": sql(
            f"""select {money('loan_amount', 'loan_amount')}, count(distinct msisdn) as n_subscribers
            from event_loans group by 1""",
            "event_loans",
        ),
    }
