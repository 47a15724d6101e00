"""The same results in SQL, on the same tables.

The text below is built from named common table expressions; a query takes
those it needs.
"""

from __future__ import annotations

from ..schemas import FIXED_CAPS, GOLD_DROPPED, LOAN_KINDS, MODE_IMPUTED, QUANTILE_CLIPPED
from ..functions.text import snake_case
from .queries import ABSENT, END, LOAN_KIND_COLUMNS, ONE_MONTH, SEGMENTS, START

NUMERIC = [*QUANTILE_CLIPPED, *FIXED_CAPS]
FEATURES = ", ".join(f"fe_{i}" for i in range(1, 21))
WINDOW = f"between date '{START}' and date '{END}'"


def _real(*columns: str) -> str:
    return ", ".join(f"{c}::double as {c}" for c in columns)


CTE = {
    "ord": """select o_orderkey ok, o_custkey ck, o_totalprice price,
        cast(date_trunc('month', o_orderdate) as date) m from orders""",
    # Raw views.
    "loans": """select cast(ok as varchar) loan_id, cast(ck as varchar) "Customer_ID", m loan_start_date,
        10 tenure, k installment_num, price::real loan_amt,
        (case when ok % 17 = 0 or k = 0 then 0.0 else price / 10 end)::real due_amt,
        (case when (ok + k) % 4 = 0 then price / 10 else 0.0 end)::real paid_amt,
        (case when ok % 13 = 0 then null when k = 0 then 0.0 else price / 10 * ((ok + k) % 4) end)::real overdue_amt,
        (price - price / 10 * k)::real balance, cast(m + to_months(k) as date) snapshot_date
        from ord, (select cast(range as int) k from range(11))""",
    "clicks": "select "
    + ", ".join(f"cast(floor(value) as int) + cast(event_id * {i} % 101 as int) fe_{i}" for i in range(1, 21))
    + """, cast(user_id as varchar) customer_id,
        cast(date '1995-01-01' + to_months(cast(event_id % 80 as int)) as date) snapshot_date from events""",
    "attrs": """select cast(c_custkey as varchar) "Customer_ID", c_name "Name",
        concat(cast(case when c_custkey % 101 = 0 then -500 when c_custkey % 53 = 0 then 8678
            else 18 + c_custkey % 60 end as varchar), case when c_custkey % 19 = 0 then '_' else '' end) "Age",
        case when c_custkey % 17 = 0 then '#F%$D@*&8' else concat(lpad(cast(c_custkey % 1000 as varchar), 3, '0'), '-',
            lpad(cast(c_custkey % 100 as varchar), 2, '0'), '-', lpad(cast(c_custkey * 7 % 10000 as varchar), 4, '0')) end "SSN",
        case when c_custkey % 13 = 0 then '_______' when ok % 5 = 0 then 'Media_Manager' else c_mktsegment end "Occupation",
        m snapshot_date from ord join customer on ck = c_custkey""",
    "qcells": """select *, c % 7 = 4 as torn, c % 11 = 5 as long, c % 19 = 3 as undated, c % 13 = 2 and c % 8 < 4 as fed, c % 5 = 1 as quoted,
        case when c % 19 = 3 then 'soon' else cast(snapshot_date as varchar) end as day
        from (select *, cast("Customer_ID" as bigint) as c from attrs)""",
    "qnamed": """select *, case when fed then replace("Name", '#', chr(10)) when quoted then 'a "quoted", ' || "Name" else "Name" end as n from qcells""",
    "qlined": """select *, case when fed or quoted then '"' || replace(n, '"', '""') || '"' else n end as q from qnamed""",
    "fins": """select cast(ck as varchar) customer_id,
        concat(case when ok % 7 = 0 then '_' else '' end, cast(case when ok % 11 = 0 then -price else price end as varchar),
            case when ok % 5 = 0 then '_' else '' end) annual_income,
        case when ok % 9 = 0 then null else price / 12 end monthly_inhand_salary,
        cast(ok % 19 - 1 as varchar) num_bank_accounts, cast(ok % 25 as varchar) num_credit_card,
        cast(ok % 50 - 3 as varchar) interest_rate,
        concat(cast(ok % 9 as varchar), case when ok % 8 = 0 then '_' else '' end) num_of_loan,
        case ok % 6 when 0 then '' when 1 then 'Auto Loan' when 2 then 'Auto Loan, Payday Loan'
            when 3 then 'Credit-Builder Loan, and Student Loan' when 4 then 'Auto Loan, Auto Loan' end type_of_loan,
        cast(ok % 130 - 10 as varchar) delay_from_due_date,
        case when ok % 12 <> 0 then concat(cast(ok % 40 - 2 as varchar), case when ok % 10 = 0 then '_' else '' end)
            end num_of_delayed_payment,
        case when ok % 14 = 0 then '_' else cast(price as varchar) end changed_credit_limit,
        case when ok % 11 <> 0 then cast(ok % 41 as varchar) end num_credit_inquiries,
        case ok % 4 when 0 then 'Good' when 1 then 'Standard' when 2 then 'Bad' else '_' end credit_mix,
        concat(cast(price as varchar), case when ok % 20 = 0 then '_' else '' end) outstanding_debt,
        price / 10000 credit_utilization_ratio,
        case when ok % 31 = 0 then null when ok % 29 = 0 then 'NA' when ok % 23 = 0 then '1 Year and 3 Months'
            else concat(cast(ok % 30 as varchar), ' Years and ', cast(ok % 12 as varchar), ' Months') end credit_history_age,
        case ok % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end payment_of_min_amount,
        price / 100 total_emi_per_month,
        case when ok % 21 = 0 then '__10000__' else cast(price as varchar) end amount_invested_monthly,
        case ok % 7 when 0 then 'High_spent_Large_value_payments' when 1 then 'High_spent_Medium_value_payments'
            when 2 then 'High_spent_Small_value_payments' when 3 then 'Low_spent_Large_value_payments'
            when 4 then 'Low_spent_Medium_value_payments' when 5 then 'Low_spent_Small_value_payments'
            else '!@9#%8' end payment_behaviour,
        case when ok % 33 = 0 then '__-333333333333333333333333333__' else cast(price as varchar) end monthly_balance,
        m snapshot_date from ord""",
    # Loans.
    "missed": """select * replace (coalesce(due_amt, 0) as due_amt, coalesce(overdue_amt, 0) as overdue_amt),
        installment_num mob,
        coalesce(cast(ceil(overdue_amt::double / nullif(due_amt, 0)::double) as int), 0) installments_missed from loans""",
    "dated": """select *, case when installments_missed > 0
        then cast(snapshot_date - to_months(installments_missed) as date) end first_missed_date from missed""",
    "sloans": """select * rename ("Customer_ID" as customer_id), cast(case when overdue_amt > 0
        then date_diff('day', first_missed_date, snapshot_date) else 0 end as int) dpd from dated""",
    "labels30": """select loan_id, customer_id, case when dpd >= 30 then 1 else 0 end "label", '30dpd_6mob' label_def,
        snapshot_date from sloans where mob = 6""",
    # Clickstream.
    "keys": """select distinct loan_id, customer_id, loan_start_date snapshot_date from sloans
        where loan_start_date = snapshot_date""",
    "sclicks": f"""select {FEATURES}, c.customer_id, c.snapshot_date, loan_id from clicks c
        join keys k on c.customer_id = k.customer_id and c.snapshot_date = k.snapshot_date""",
    # Attributes.
    "cattrs": r"""select "Customer_ID" customer_id, "Name" "name", nullif(trim(replace("Age", '_', '')), '') age,
        case when regexp_matches("SSN", '^\d{3}-\d{2}-\d{4}$') then "SSN" end ssn,
        nullif(regexp_replace("Occupation", '[^a-zA-Z]', '', 'g'), '') occupation, snapshot_date from attrs""",
    "sattrs": "select customer_id, name, try_cast(age as int) age, ssn, snapshot_date, "
    + ", ".join(f"max(case when occupation = '{s}' then 1 else 0 end) occupation_{s.lower()}" for s in SEGMENTS)
    + " from cattrs group by all",
    # Financials.
    "cfins": r"""select customer_id, try_cast(replace(annual_income, '_', '') as real) annual_income,
        monthly_inhand_salary::real monthly_inhand_salary, try_cast(num_bank_accounts as real) num_bank_accounts,
        try_cast(num_credit_card as real) num_credit_card, try_cast(interest_rate as real) interest_rate, num_of_loan,
        coalesce(case when not regexp_matches(type_of_loan, '^\s*$') then type_of_loan end, 'Not Specified') type_of_loan,
        try_cast(delay_from_due_date as real) delay_from_due_date,
        try_cast(replace(num_of_delayed_payment, '_', '') as real) num_of_delayed_payment,
        try_cast(nullif(replace(changed_credit_limit, '_', ''), '') as real) changed_credit_limit,
        try_cast(num_credit_inquiries as real) num_credit_inquiries, nullif(replace(credit_mix, '_', ''), '') credit_mix,
        try_cast(replace(outstanding_debt, '_', '') as real) outstanding_debt,
        credit_utilization_ratio::real credit_utilization_ratio, credit_history_age, payment_of_min_amount,
        total_emi_per_month::real total_emi_per_month,
        try_cast(replace(amount_invested_monthly, '_', '') as real) amount_invested_monthly,
        replace(payment_behaviour, '!@9#%8', '') payment_behaviour,
        try_cast(replace(monthly_balance, '_', '') as real) monthly_balance, snapshot_date from fins""",
    "stats": "select snapshot_date, "
    + ", ".join(f"quantile_disc({c}, 0.5) {c}_median" for c in NUMERIC)
    + ", "
    + ", ".join(f"quantile_disc({c}, 0.999) {c}_cap" for c in QUANTILE_CLIPPED)
    + " from cfins group by snapshot_date",
    "clipped": "select * replace ("
    + ", ".join(
        f"least(greatest(coalesce({c}, {c}_median), 0), {FIXED_CAPS.get(c, f'{c}_cap')})::real as {c}" for c in NUMERIC
    )
    + ") from cfins join stats using (snapshot_date)",
    "encoded": r"""select *,
        case credit_mix when 'Good' then 3 when 'Standard' then 2 when 'Bad' then 1 end credit_mix_encoded,
        try_cast(regexp_extract(credit_history_age, '(\d+)\sYears', 1) as int) credit_history_years,
        try_cast(regexp_extract(credit_history_age, '(\d+)\sMonths', 1) as int) credit_history_months,
        try_cast(regexp_extract(credit_history_age, '(\d+)\sYears', 1) as int) * 12
            + try_cast(regexp_extract(credit_history_age, '(\d+)\sMonths', 1) as int) credit_history_months_total,
        case when payment_behaviour like 'High_spent%' then 2 when payment_behaviour like 'Low_spent%' then 1
            end spending_level_encoded,
        case when contains(payment_behaviour, 'Large_value') then 3 when contains(payment_behaviour, 'Medium_value') then 2
            when contains(payment_behaviour, 'Small_value') then 1 end transaction_value_encoded from cfins""",
}


def _hot(list_sql: str) -> str:
    return ", ".join(
        f"max(case when list_contains({list_sql}, '{k}') then 1 else 0 end) {snake_case(k)}" for k in LOAN_KINDS
    )


ENTRIES = r"regexp_split_to_array(type_of_loan, ',\s*')"
KIND_SUM = " + ".join(LOAN_KIND_COLUMNS)
OTHER = [
    "customer_id", "snapshot_date", "num_of_loan", "credit_mix", "credit_history_age", "payment_of_min_amount",
    "payment_behaviour",
]
ENCODED = [
    "credit_mix_encoded", "credit_history_years", "credit_history_months", "credit_history_months_total",
    "spending_level_encoded", "transaction_value_encoded",
]

CTE["kinds"] = f"select {', '.join([*OTHER, *NUMERIC])}, {_hot(ENTRIES)} from clipped group by all"
CTE["sfins"] = (
    f"select customer_id, snapshot_date, {_real(*QUANTILE_CLIPPED)}, "
    + ", ".join(f"cast(trunc({c}) as int) {c}" for c in FIXED_CAPS)
    + f""", {KIND_SUM} num_of_loan, {KIND_SUM} loan_type_count_sum, credit_mix, credit_history_age,
        payment_of_min_amount, payment_behaviour, """
    + CTE["encoded"].split("select *,", 1)[1].rsplit("from cfins", 1)[0]
    + f", {', '.join(LOAN_KIND_COLUMNS)} from kinds"
)
CTE["joined"] = """select a.*, f.* exclude (customer_id, snapshot_date), c.* exclude (customer_id, snapshot_date)
    from sattrs a join sfins f on a.customer_id = f.customer_id and a.snapshot_date = f.snapshot_date
    join sclicks c on a.customer_id = c.customer_id and a.snapshot_date = c.snapshot_date"""


def _modes(table: str, columns: list[str]) -> str:
    parts = [
        f"""select snapshot_date, '{c}' c, {c} v, row_number() over (partition by snapshot_date
            order by count(*) desc, {c} is null, {c}) r from {table} group by snapshot_date, {c}"""
        for c in columns
    ]
    picks = ", ".join(f"max(case when c = '{c}' then v end) {c}_mode" for c in columns)
    return f"select snapshot_date, {picks} from ({' union all '.join(parts)}) where r = 1 group by snapshot_date"


def _filled(table: str, mode_table: str, columns: list[str]) -> str:
    filled = ", ".join(f"coalesce({c}, {c}_mode) as {c}" for c in columns)
    drop = ", ".join(f"{c}_mode" for c in columns)
    return f"select * exclude ({drop}) replace ({filled}) from {table} join {mode_table} using (snapshot_date)"


SCALES = MODE_IMPUTED[:3]
CTE["emodes"] = _modes("encoded", SCALES)
CTE["jmodes"] = _modes("joined", MODE_IMPUTED)
CTE["saggr"] = _filled("joined", "jmodes", MODE_IMPUTED)


def _gold(level: int) -> str:
    return f"""select * exclude ({', '.join(GOLD_DROPPED)}), case when transaction_value_encoded > 2
        and spending_level_encoded = {level} then 1 else 0 end high_value_customer_flag from saggr"""


CTE["gold"] = _gold(3)
CTE["ages"] = "select customer_id, try_cast(age as int) age from cattrs"

LOAN_REALS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
LOAN_DOUBLES = ", ".join(f"{c}::double as {c}" for c in LOAN_REALS)
# Tables each expression reads, found by name.
_ORDER = list(CTE)


def _needs(sql: str, names: list[str]) -> set[str]:
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split())
    return words & set(names)


def _with(sql: str) -> str:
    wanted: set[str] = set()
    todo = _needs(sql, _ORDER)
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo |= _needs(CTE[name], _ORDER[: _ORDER.index(name)]) - wanted
    ctes = ",\n".join(f"{name} as ({CTE[name]})" for name in _ORDER if name in wanted)
    return f"with {ctes}\n{sql}" if ctes else sql


def _nulls(table: str, columns: list[str], by: str = "") -> str:
    lead, group = (f"{by}, ", f"group by {by}") if by else ("", "")
    return " union all ".join(
        f"""select {lead}'{c}' column_name, count(*) - count({c}) null_count,
            (count(*) - count({c})) / count(*)::double * 100 null_pct from {table} {group} having count(*) > count({c})"""
        for c in columns
    )


CLEAN = [
    "customer_id", "annual_income", "monthly_inhand_salary", "num_bank_accounts", "num_credit_card", "interest_rate",
    "num_of_loan", "type_of_loan", "delay_from_due_date", "num_of_delayed_payment", "changed_credit_limit",
    "num_credit_inquiries", "credit_mix", "outstanding_debt", "credit_utilization_ratio", "credit_history_age",
    "payment_of_min_amount", "total_emi_per_month", "amount_invested_monthly", "payment_behaviour", "monthly_balance",
]
GOLD = [
    "age", *[f"occupation_{s.lower()}" for s in SEGMENTS], *NUMERIC, "loan_type_count_sum", "credit_mix_encoded",
    "credit_history_months_total", "spending_level_encoded", "transaction_value_encoded", *LOAN_KIND_COLUMNS,
    *[f"fe_{i}" for i in range(1, 21)], "loan_id", "high_value_customer_flag",
]
BIN_LABELS = [f"{s}-{s + 9}" for s in range(0, 120, 10)] + ["Others"]


def _histogram(table: str, column: str, bins: str, spec: str = "") -> str:
    return f"""select cast(b.range as int) bin, low + b.range * ((high - low) / bins) bin_low,
        low + (b.range + 1) * ((high - low) / bins) bin_high, count(v) row_count
        from (select *, unnest(range(bins)) "range" from (select low, high, {bins} bins from (select
            min({column})::double low, max({column})::double high, count({column}) n {spec} from {table}))) b
        left join (select {column}::double v, (select min({column})::double from {table}) lo,
            (select max({column})::double from {table}) hi from {table} where {column} is not null) t
        on b.range = least(floor((v - lo) / (hi - lo) * bins), bins - 1)
        group by all"""


def _outliers(select: str, table: str, column: str) -> str:
    return f"""select {select} from {table}, (select quantile_cont({column}::double, 0.25) q1,
        quantile_cont({column}::double, 0.75) q3 from {table})
        where {column} < q1 - 1.5 * (q3 - q1) or {column} > q3 + 1.5 * (q3 - q1)"""


def _density(table: str, column: str, x_digits: int, digits: int) -> str:
    return f"""select cast(p as int) point, round(x, {x_digits}) x,
        round(sum(c * exp(-pow((x - v) / h, 2) / 2)) / (n * h * sqrt(2 * pi())), {digits}) density from (
        select p, low + p * ((high - low) / 199) x, n, h from (select min({column})::double low, max({column})::double high,
            count({column})::double n, stddev_samp({column}) * pow(count({column})::double, -0.2) h from {table}), range(200) g(p)),
        (select {column}::double v, count(*) c from {table} where {column} is not null group by 1) group by p, x, n, h"""


INFO = [
    ("customer_id", "string"), ("name", "string"), ("age", "string"), ("ssn", "string"), ("occupation", "string"),
    ("snapshot_date", "date"),
]
BAD_RATE = """select mob, avg(case when dpd >= 30 then 1 else 0 end) bad_rate from sloans
    where loan_start_date < date '1999-01-01' {} group by mob"""
MULTI_HOT = (
    f"select customer_id, snapshot_date, {KIND_SUM} num_of_loan, {', '.join(LOAN_KIND_COLUMNS)}, {KIND_SUM} "
    "loan_type_count_sum from (select customer_id, snapshot_date, num_of_loan, {} from cfins group by all)"
)
STRIPPED = r"regexp_split_to_array(regexp_replace(type_of_loan, ',\s*and\s+', ', ', 'g'), ',\s*')"

SQL = {
    "month_spine": """select cast(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
        interval 1 month)) as date) snapshot_date from orders""",
    "bronze_backfill": f"select * replace ({LOAN_DOUBLES}) from loans where snapshot_date {WINDOW}",
    "bronze_counts": "select snapshot_date, count(*) row_count from loans group by snapshot_date",
    "multi_snapshot_scan": f"select * replace ({LOAN_DOUBLES}) from loans",
    "csv_scan": "select * replace (cast(snapshot_date as varchar) as snapshot_date) from attrs",
    "csv_bronze": "select * from attrs",
    "csv_quarantine": """
        select "Customer_ID", n as "Name", "Age", "SSN", "Occupation", snapshot_date, null::varchar reason, null::varchar record
        from qlined where not (torn or long or undated)
        union all
        select null, null, null, null, null, null, case when torn or long then 'cells' else 'date' end,
          case when torn then concat_ws(',', "Customer_ID", "Name", "Age", "SSN")
            else concat_ws(',', "Customer_ID", q, "Age", "SSN", "Occupation", day) || case when long then ',more' else '' end end
        from qlined where torn or long or undated""",
    "rerun_over_snapshots": f"""select * replace ({LOAN_DOUBLES}, cast(tenure + case when snapshot_date {WINDOW} then 1 else 0 end as int)
        as tenure) from loans""",
    "read_during_rebuild": f"select * replace ({LOAN_DOUBLES}) from loans",
    "read_after_failed_rebuild": f"select * replace ({LOAN_DOUBLES}) from loans",
    "rows_of_builds": "select snapshot_date, count(*) row_count from loans group by 1",
    "first_rows": """select * from attrs order by "Customer_ID", snapshot_date, "Occupation", "Name", "Age", "SSN" limit 20""",
    "silver_loan_snapshots": f"select * replace ({LOAN_DOUBLES}) from sloans",
    "gold_label_store": "select * from labels30",
    "gold_label_store_keep_spelling": """select loan_id, customer_id "Customer_ID", case when dpd >= 60 then 1 else 0 end
        "label", '60dpd_8mob' label_def, snapshot_date from sloans where mob = 8""",
    "label_counts": 'select "label", count(*) row_count from labels30 group by 1',
    "bad_rate": BAD_RATE.format(""),
    "bad_rate_at_installment": BAD_RATE.format("and installment_num = 10"),
    "label_store_run": f"select * from labels30 where snapshot_date {WINDOW}",
    "label_store_all_months": "select * from labels30",
    "changed_months_only": f"""select * replace (case when snapshot_date = date '{ABSENT}' then 0 else "label" end as "label"),
        case when snapshot_date = date '{ABSENT}' then 1 else 0 end rebuilt from labels30""",
    "silver_loans_tiny_due": """select loan_id, installment_num, least(m, 2147483647)::int installments_missed,
        case when m between 1 and 60000000 then cast(snapshot_date - to_months(least(m, 1000)::int) as date) end first_missed_date,
        case when coalesce(overdue_amt, 0) <= 0 then 0 when m > 60000000 then 2147483647
            else date_diff('day', case when m > 0 then cast(snapshot_date - to_months(least(m, 1000)::int) as date) end, snapshot_date)
            end::int dpd
        from (select *, case when q is null then 0 else least(q, 9e18)::bigint end m from (select *, ceil(overdue_amt::double
            / nullif(case when loan_id::bigint % 19 = 0 then 1e-30::real else due_amt end, 0)::double) q from loans))""",
    "loan_keys": "select * from keys",
    "clickstream_at_loan_start": "select * from sclicks",
    "clickstream_without_loans": "select *, cast(null as varchar) loan_id from clicks",
    "cleaned_attributes": "select * from cattrs",
    "occupation_vocabulary": "select distinct occupation from cattrs where occupation is not null",
    "one_hot_occupation": "select * from sattrs",
    "one_hot_any_case": "select c_nationkey, c_acctbal, "
    + ", ".join(f"max(case when c_mktsegment = '{s}' then 1 else 0 end) segment_{s.lower()}" for s in SEGMENTS[:5])
    + " from customer group by all",
    "attributes_month_by_month": "select * from sattrs",
    "cleaned_financials": f"select * replace ({_real(*NUMERIC)}) from cfins",
    "snapshot_statistics": "select snapshot_date, "
    + _real(*[f"{c}_median" for c in NUMERIC], *[f"{c}_cap" for c in QUANTILE_CLIPPED])
    + " from stats",
    "order_statistics": "select o_orderpriority, "
    + ", ".join(
        f"cast(quantile_disc({v}, {p}) as varchar) {c}_{n}"
        for c, v in (("key", "o_orderkey + 1152921504606846976"), ("price", "o_totalprice::decimal(30, 10)"))
        for n, p in (("median", 0.5), ("cap", 0.999))
    )
    + " from orders group by 1",
    "window_quantile_sketches": """select cast(snapshot_date + to_months(k) as date) until, name,
        cast(count(case when name[1] = 'a' then annual_income else monthly_inhand_salary end) as bigint) n, 1 as "within"
        from cfins, (select cast(range as int) k from range(12)), (select unnest(['annual_income_median', 'annual_income_cap',
            'monthly_inhand_salary_median', 'monthly_inhand_salary_cap']) as name) group by 1, 2""",
    "imputed_and_clipped": f"select customer_id, snapshot_date, {_real(*NUMERIC)} from clipped",
    "multi_hot_loan_types": MULTI_HOT.format(_hot(ENTRIES)),
    "multi_hot_loan_types_strip_and": MULTI_HOT.format(_hot(STRIPPED)),
    "ordinal_scales": """select customer_id, snapshot_date, credit_mix, credit_mix_encoded, payment_behaviour,
        spending_level_encoded, transaction_value_encoded from encoded""",
    "credit_history": """select customer_id, snapshot_date, credit_history_age, credit_history_years,
        credit_history_months, credit_history_months_total from encoded""",
    "silver_financial_features": "select * from sfins",
    "feature_join": "select * from joined",
    "feature_join_of_buckets": "select * from joined",
    "snapshot_modes": "select * from emodes",
    "mode_imputed": f"""select customer_id, snapshot_date, {', '.join(SCALES)} from ({_filled("encoded", "emodes", SCALES)})""",
    "aggregated_features": "select * from saggr",
    "gold_feature_store": "select * from gold",
    "gold_feature_store_reachable_flag": _gold(2),
    "feature_store_run": f"select * from gold where snapshot_date {WINDOW}",
    "feature_store_all_months": "select * from gold",
    "feature_store_missing_month": f"select * from gold where snapshot_date <> date '{ABSENT}'",
    "one_snapshot_jobs": f"""select (select count(*) from labels30 where snapshot_date = date '{ONE_MONTH}') labels,
        (select sum("label")::bigint from labels30 where snapshot_date = date '{ONE_MONTH}') bad,
        (select count(*) from gold where snapshot_date = date '{ONE_MONTH}') features,
        (select coalesce(sum(fe_1), 0)::bigint from gold where snapshot_date = date '{ONE_MONTH}') fe_1""",
    "null_report_of_builds": _nulls("gold", ["customer_id", *GOLD], "snapshot_date"),
    "null_report": _nulls("cfins", [*CLEAN, "snapshot_date"]),
    "null_report_by_snapshot": _nulls("cfins", CLEAN, "snapshot_date"),
    "null_report_gold": _nulls("gold", ["customer_id", *GOLD], "snapshot_date"),
    "clickstream_snapshot_counts": "select snapshot_date, count(*) row_count from clicks group by 1",
    "clickstream_snapshot_range": """select min(snapshot_date) min_snapshot_date, max(snapshot_date) max_snapshot_date
        from clicks""",
    "clickstream_latest": "select * from clicks where snapshot_date = (select max(snapshot_date) from clicks)",
    "attribute_info": " union all ".join(
        f"select {i} as position, '{c}' column_name, '{t}' data_type, count({c}) non_null from cattrs"
        for i, (c, t) in enumerate(INFO)
    ),
    "customer_lookup": "select * from cattrs where customer_id = '7'",
    "customer_lookup_of_sorted": "select * from cattrs where customer_id = '7'",
    "age_range": "select min(age) min_age, max(age) max_age from ages",
    "age_counts": "select age, count(*) row_count from ages where age is not null group by age",
    "occupation_counts": """select "Occupation" occupation, count(*) row_count from attrs group by 1""",
    "invalid_ssn_rows": r"""select * from attrs where not regexp_matches("SSN", '^\d{3}-\d{2}-\d{4}$')""",
    "invalid_ssn_counts": r"""select "SSN", count(*) row_count from attrs
        where not regexp_matches("SSN", '^\d{3}-\d{2}-\d{4}$') group by 1""",
    "age_outliers": _outliers("customer_id, age", "ages", "age"),
    "value_outliers": _outliers('event_id, event_type, "value"', "events", '"value"'),
    "age_bins": "select p as position, l as bin, count(age_bin) row_count from (select unnest("
    + str(list(range(13)))
    + ") p, unnest("
    + str(BIN_LABELS)
    + """) l) left join (select case when age >= 0 and age < 120 then cast(floor(age / 10) as int) else 12 end age_bin
        from ages) on p = age_bin group by p, l""",
    "age_histogram": _histogram("ages", "age", "10"),
    "age_histogram_25": _histogram("ages", "age", "25"),
    "price_histogram_auto": _histogram(
        "orders",
        "o_totalprice",
        "cast(ceil((high - low) / least((high - low) / (log2(n) + 1), 2 * (q3 - q1) / pow(n, 1.0 / 3))) as int)",
        ", quantile_cont(o_totalprice, 0.25) q1, quantile_cont(o_totalprice, 0.75) q3",
    ),
    "age_density": _density("ages", "age", 6, 9),
    "price_density": _density("orders", "o_totalprice", 4, 12),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in SQL.items()}
