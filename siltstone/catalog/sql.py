"""SQL counterparts of the registered queries, for a second engine (DuckDB).

They state the expected results on their own terms: the only text shared with
the library is the derivation of the raw tables and the fixed values.
"""

from __future__ import annotations

from siltstone import credit
from siltstone.functions import validity as v
from siltstone.sources.derived import CSV_COLUMNS, CSV_FAULT, CSV_FIELDS, CSV_RECORD, FINANCIALS, FREE_DAYS, TABLES, raw_sql

_KEYS = ", ".join(credit.KEYS)


# --- scalar pieces


def _match(c: str, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_matches({c}, '{quoted}')"


def _double(c: str) -> str:
    return f"try_cast({c} AS double)"


def _round(value: str, scale: int) -> str:
    return f"cast(round(cast({value} AS decimal(38,12)), {scale}) AS double)"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '{credit.DIRT}', '', 'g')"


def _dirty(c: str, scale: int | None, zero: bool = False, signed: bool = False) -> str:
    value = _double(_strip(c))
    if signed:
        value = f"(CASE WHEN {_match(c, '^[^0-9.]*-[^0-9.]*[0-9.]')} THEN -1 ELSE 1 END * {value})"
    if scale is not None:
        value = _round(value, scale)
    return f"coalesce({value}, 0)" if zero else value


def _clean(c: str, scale: int, zero: bool = False) -> str:
    value = _round(_double(c), scale)
    return f"coalesce({value}, 0)" if zero else value


def _whole_part(c: str) -> str:
    return f"try_cast(regexp_extract(trim({c}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS integer)"


def _count(c: str, strip: bool = False, floor: int | None = None) -> str:
    text = f"replace({c}, '_', '')" if strip else c
    value = f"cast(trunc(coalesce({_double(text)}, 0)) AS integer)"
    return value if floor is None else f"(CASE WHEN {value} < {floor} THEN 0 ELSE {value} END)"


def _whole(c: str) -> str:
    return f"(CASE WHEN {_double(c)} = floor({_double(c)}) THEN cast({_double(c)} AS integer) END)"


def _strict_day(c: str) -> str:
    return f"(CASE WHEN {_match(c, v.ISO_DAY)} THEN try_cast({c} AS date) END)"


def _day(c: str) -> str:
    return f"try_cast({c} AS date)"


def _band(c: str, floor: int | None = None, default: str = "NULL", skip: int = 0) -> str:
    first = f"WHEN {c} IS NULL" + (f" OR {c} <= {floor}" if floor is not None else "")
    steps = [
        f"ELSE '{label}'" if upper is None else f"WHEN {c} <= {upper} THEN '{label}'"
        for upper, label in credit.AGE_BANDS[skip:]
    ]
    return f"(CASE {first} THEN {default} {' '.join(steps)} END)"


def _agree(count: str, kind: str) -> str:
    blank = f"({kind} IS NULL OR trim({kind}) = '')"
    return f"(NOT coalesce(({count} > 0 AND {blank}) OR ({count} = 0 AND NOT {blank}), false))"


# --- tables


def _select(columns: dict[str, str], source: str, where: str = "true") -> str:
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {source} WHERE {where}"


def _silver_clickstream() -> str:
    columns = {
        "Customer_ID": "Customer_ID",
        **{name: _whole_part(name) for name in credit.CLICK_FEATURES},
        "snapshot_date": _day("snapshot_date"),
    }
    readable = " AND ".join(f"{_whole_part(name)} IS NOT NULL" for name in credit.CLICK_FEATURES)
    return _select(columns, "raw_clickstream", f"{_match('Customer_ID', v.CUSTOMER_ID)} AND {readable}")


def _silver_attributes() -> str:
    age = _whole_part("replace(Age, '_', '')")
    columns = {
        "Customer_ID": "Customer_ID",
        "Age": age,
        "SSN": "SSN",
        "Occupation": "Occupation",
        "snapshot_date": _day("snapshot_date"),
        "Age_Group": _band(age),
    }
    where = f"{_match('Customer_ID', v.CUSTOMER_ID)} AND {_match('SSN', v.SSN)} AND {age} BETWEEN 18 AND 65"
    return _select(columns, "raw_attributes", where)


_RAW_FINANCIALS = (
    "Customer_ID",
    "Type_of_Loan",
    "Credit_Mix",
    "Credit_History_Age",
    "Payment_Behaviour",
)


def _silver_financials(options: bool = False) -> str:
    amounts = {
        "Annual_Income": (2, False),
        "Monthly_Inhand_Salary": (2, False),
        "Changed_Credit_Limit": (2, False),
        "Outstanding_Debt": (2, True),
        "Credit_Utilization_Ratio": (4, True),
        "Total_EMI_per_month": (4, True),
        "Amount_invested_monthly": (4, True),
        "Monthly_Balance": (4, True),
    }
    answer = "upper(trim(Payment_of_Min_Amount))"
    trimmed = "CASE {a} WHEN 'YES' THEN 'Yes' WHEN 'NO' THEN 'No' WHEN 'NM' THEN '{nm}' ELSE 'Unknown' END"
    if options:
        payment = trimmed.format(a=answer, nm="NM")
    else:
        inner = trimmed.format(a=answer, nm="Nm")
        # Proper case keeps the blanks around the answer.
        payment = (
            f"CASE WHEN {answer} IN ('YES', 'NO', 'NM') "
            f"THEN replace(Payment_of_Min_Amount, trim(Payment_of_Min_Amount), {inner}) ELSE 'Unknown' END"
        )
    columns = {
        **{name: name for name in _RAW_FINANCIALS},
        **{name: _count(name, options, 0 if options else None) for name in credit.COUNT_COLUMNS},
        **{name: _dirty(name, scale, zero, options) for name, (scale, zero) in amounts.items()},
        "Payment_of_Min_Amount": payment,
        "Spend_Level": f"regexp_extract(Payment_Behaviour, '{credit.SPEND_LEVEL}', 1)",
        "Payment_Value": f"regexp_extract(Payment_Behaviour, '{credit.PAYMENT_VALUE}', 1)",
        "snapshot_date": _day("snapshot_date"),
    }
    where = f"{_match('Customer_ID', v.CUSTOMER_ID)}"
    inner = _select(columns, "raw_financials", where)
    limit = "(Changed_Credit_Limit IS NULL OR Changed_Credit_Limit >= 0)" if options else "Changed_Credit_Limit >= 0"
    return (
        f"SELECT * FROM ({inner}) typed WHERE Type_of_Loan IS NOT NULL "
        f"AND ((Num_of_Loan > 0 AND trim(Type_of_Loan) <> '') OR Num_of_Loan < 0 "
        f"OR (Num_of_Loan = 0 AND trim(Type_of_Loan) = '')) AND {limit} "
        "AND Credit_Utilization_Ratio >= 0 AND Total_EMI_per_month >= 0 "
        "AND Amount_invested_monthly >= 0 AND Monthly_Balance >= 0"
    )


def _silver_loan_daily(signed: bool = False) -> str:
    columns = {
        "loan_id": "loan_id",
        "Customer_ID": "Customer_ID",
        "loan_start_date": _strict_day("loan_start_date"),
        **{name: _whole(name) for name in credit.LOAN_COUNT_COLUMNS},
        **{name: _dirty(name, None, True, signed) for name in credit.LOAN_MONEY_COLUMNS},
        "snapshot_date": _day("snapshot_date"),
    }
    where = (
        f"{_match('loan_id', v.LOAN_ID)} AND {_match('Customer_ID', v.CUSTOMER_ID)} "
        f"AND {_strict_day('loan_start_date')} IS NOT NULL "
        + " ".join(f"AND {_whole(name)} IS NOT NULL" for name in credit.LOAN_COUNT_COLUMNS)
    )
    return _select(columns, "raw_loan_daily", where)


def _first_rows(table: str, columns: list[str]) -> str:
    order = ", ".join(f"{name} NULLS FIRST" for name in columns if name not in credit.KEYS)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT {', '.join(columns)}, "
        f"row_number() OVER (PARTITION BY {_KEYS} ORDER BY {order}) AS copy FROM {table}) ranked WHERE copy = 1"
    )


# In the order of the raw table: rows of one key are ordered by their columns in turn.
_FIN_COLUMNS = [*FINANCIALS, "Spend_Level", "Payment_Value"]


def _gold() -> str:
    click = _first_rows("silver_clickstream", [*credit.KEYS, *credit.CLICK_FEATURES])
    attributes = _first_rows("silver_attributes", [*credit.KEYS, "Age", "Occupation"])
    return (
        f"SELECT * FROM ({_first_rows('silver_financials', _FIN_COLUMNS)}) f "
        f"LEFT JOIN ({click}) c USING ({_KEYS}) LEFT JOIN ({attributes}) a USING ({_KEYS})"
    )


_LOAN_SUMMARY = (
    f"SELECT {_KEYS}, count(*) AS loan_cnt, "
    "round(sum(loan_amt), 2) AS loan_amt_sum, max(overdue_amt) AS max_overdue "
    f"FROM silver_loan_daily GROUP BY {_KEYS}"
)

_PERFORMANCE = """
SELECT *,
  CASE WHEN snapshot_date IS NULL OR installments_missed = 0 THEN 0 ELSE try_cast(
    date_diff('day', cast(snapshot_date - to_months(cast(installments_missed % 4800 AS integer)) AS date), snapshot_date)
      + cast(installments_missed // 4800 AS hugeint) * 146097 AS bigint) END AS dpd,
  CASE WHEN installments_missed > 0 AND installments_missed <= (year(snapshot_date) - 1) * 12 + month(snapshot_date) - 1
    THEN cast(snapshot_date - to_months(cast(installments_missed AS integer)) AS date) END AS first_missed_date
FROM (
  SELECT *, installment_num AS mob,
    CASE WHEN overdue_amt > 0 AND due_amt > 0 THEN try_cast(ceil(overdue_amt / due_amt) AS bigint) ELSE 0 END
      AS installments_missed
  FROM silver_loan_daily) counted
"""

_LABELS = (
    "SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 OR dpd IS NULL THEN 1 ELSE 0 END AS label, "
    "'30dpd_6mob' AS label_def, snapshot_date FROM performance WHERE mob = 6"
)

_TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    **{f"raw_{table}": (raw_sql(table), ()) for table in TABLES},
    "silver_clickstream": (_silver_clickstream(), ("raw_clickstream",)),
    "silver_attributes": (_silver_attributes(), ("raw_attributes",)),
    "silver_financials": (_silver_financials(), ("raw_financials",)),
    "silver_loan_daily": (_silver_loan_daily(), ("raw_loan_daily",)),
    "gold": (_gold(), ("silver_clickstream", "silver_attributes", "silver_financials")),
    "loan_summary": (_LOAN_SUMMARY, ("silver_loan_daily",)),
    "performance": (_PERFORMANCE, ("silver_loan_daily",)),
    "labels": (_LABELS, ("performance",)),
}


def _query(body: str, *tables: str) -> str:
    """The body after the definitions of the named tables and what they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _TABLES[name][1]:
            need(other)
        if name not in order:
            order.append(name)

    for table in tables:
        need(table)
    definitions = ", ".join(f"{name} AS MATERIALIZED ({_TABLES[name][0]})" for name in order)
    return f"WITH {definitions} {body}"


# --- quality


def _line(table: str, column: str, rule: str, condition: str, distinct: bool = False, real: bool = True) -> str:
    failing = f"NOT coalesce({condition}, false)"
    distinct_count = f"count(DISTINCT {column}) FILTER (WHERE {failing})" if distinct else "cast(NULL AS bigint)"
    nulls = f"count(*) FILTER (WHERE {column} IS NULL)" if real else "cast(NULL AS bigint)"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule_name, count(*) AS total, "
        f"count(*) FILTER (WHERE {failing}) AS invalid, {distinct_count} AS distinct_invalid, "
        f"{nulls} AS null_count, count(*) FILTER (WHERE {failing}) = 0 AS passed FROM raw_{table}"
    )


def _family(table: str, rule: str, conditions: dict[str, str]) -> list[str]:
    each = [_line(table, column, rule, condition) for column, condition in conditions.items()]
    together = " AND ".join(f"coalesce({condition}, false)" for condition in conditions.values())
    return [*each, _line(table, "*", rule, together, real=False)]


def _numeric(c: str) -> str:
    return f"({_double(c)} IS NOT NULL AND NOT isnan({_double(c)}))"


def _is_whole(c: str) -> str:
    return f"({_double(c)} = floor({_double(c)}))"


def _profile_lines(table: str) -> list[str]:
    customer = _match("Customer_ID", v.CUSTOMER_ID)
    real_day = f"({_match('snapshot_date', v.ISO_DAY)} AND try_cast(snapshot_date AS date) IS NOT NULL)"
    if table == "clickstream":
        return [
            *_family(table, "integer", {c: _match(c, v.INTEGER) for c in credit.CLICK_FEATURES}),
            _line(table, "Customer_ID", "customer_id", customer),
            _line(table, "snapshot_date", "day", real_day),
        ]
    if table == "attributes":
        letters = _match("trim(Name)", v.PERSON_NAME)
        age = _whole_part("replace(Age, '_', '')")
        return [
            _line(table, "Customer_ID", "customer_id", customer, distinct=True),
            _line(table, "Name", "person_name", f"({letters} AND length(trim(Name)) BETWEEN 2 AND 50)"),
            _line(table, "Age", "numeric", _numeric("Age")),
            _line(table, "Age", "readable_age", f"{age} IS NOT NULL"),
            _line(table, "SSN", "ssn", _match("SSN", v.SSN)),
            _line(table, "Occupation", "known_occupation", f"Occupation <> '{credit.UNKNOWN_OCCUPATION}'"),
            _line(table, "snapshot_date", "any_day", f"{_day('snapshot_date')} IS NOT NULL"),
        ]
    if table == "financials":
        plain = ("Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit")
        non_negative = (
            "Credit_Utilization_Ratio",
            "Total_EMI_per_month",
            "Amount_invested_monthly",
            "Monthly_Balance",
        )
        return [
            *_family(table, "whole_number", {c: _is_whole(c) for c in credit.ACCOUNT_COUNTS}),
            _line(table, credit.INQUIRIES, "whole_number", _is_whole(credit.INQUIRIES)),
            _line(table, "Customer_ID", "customer_id", customer),
            *[_line(table, c, "plain_number", _match(c, v.PLAIN_NUMBER)) for c in plain],
            *[
                _line(
                    table,
                    c,
                    "plain_non_negative",
                    f"({_match(c, v.PLAIN_NUMBER)} AND coalesce({_double(c)}, 0) >= 0)",
                )
                for c in non_negative
            ],
            _line(table, "Type_of_Loan", "loans_agree", _agree(_double("Num_of_Loan"), "Type_of_Loan")),
            _line(table, "snapshot_date", "day", real_day),
        ]
    return [
        _line(table, "loan_id", "loan_id", _match("loan_id", v.LOAN_ID)),
        _line(table, "Customer_ID", "customer_id", customer, distinct=True),
        _line(table, "loan_start_date", "strict_day", f"{_strict_day('loan_start_date')} IS NOT NULL"),
        *[_line(table, c, "whole_number", _is_whole(c)) for c in credit.LOAN_COUNT_COLUMNS],
        *[_line(table, c, "numeric", _numeric(c)) for c in credit.LOAN_MONEY_COLUMNS],
        _line(table, "snapshot_date", "strict_day", f"{_strict_day('snapshot_date')} IS NOT NULL"),
    ]


def _profile(table: str) -> str:
    return _query(" UNION ALL ".join(_profile_lines(table)), f"raw_{table}")


_COLUMNS = {
    "clickstream": ("Customer_ID", *credit.CLICK_FEATURES, "snapshot_date"),
    "attributes": ("Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"),
    "financials": tuple(c for c in _FIN_COLUMNS if c not in ("Spend_Level", "Payment_Value")),
    "loan_daily": (
        "loan_id",
        "Customer_ID",
        "loan_start_date",
        *credit.LOAN_COUNT_COLUMNS,
        *credit.LOAN_MONEY_COLUMNS,
        "snapshot_date",
    ),
}


def _null_profile() -> str:
    lines = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS total FROM raw_{table}"
        for table, columns in _COLUMNS.items()
        for c in columns
    ]
    return _query(" UNION ALL ".join(lines), *[f"raw_{table}" for table in TABLES])


def _label_counts(label: str) -> str:
    lines = [
        f"SELECT {i} AS position, '{name}' AS age_group, "
        f"nullif(count(*) FILTER (WHERE {label} = '{name}'), 0) AS row_count FROM raw_attributes"
        for i, name in enumerate(credit.AGE_LABELS, start=1)
    ]
    return _query(" UNION ALL ".join(lines), "raw_attributes")


# --- queries

_BRONZE_LOANS = "(SELECT * REPLACE (try_cast(snapshot_date AS date) AS snapshot_date) FROM raw_loan_daily) bronze"

_SPINE = f"""
SELECT spine.snapshot_date, coalesce(counted.n, 0) AS row_count FROM (
  SELECT cast(unnest(generate_series(
    (SELECT date_trunc('month', min(snapshot_date)) FROM {_BRONZE_LOANS}),
    (SELECT cast(max(snapshot_date) AS timestamp) FROM {_BRONZE_LOANS}), INTERVAL 1 MONTH)) AS date) AS snapshot_date
) spine LEFT JOIN (
  SELECT snapshot_date, count(*) AS n FROM {_BRONZE_LOANS} GROUP BY snapshot_date
) counted ON spine.snapshot_date = counted.snapshot_date
"""

_HISTOGRAM = """
SELECT bin, count(*) AS row_count, min(Age) AS smallest, max(Age) AS largest FROM (
  SELECT Age, cast(least(floor((Age - lo) * 30.0 / (hi - lo)) + 1, 30) AS integer) AS bin
  FROM silver_attributes, (SELECT min(Age) AS lo, max(Age) AS hi FROM silver_attributes) bounds
) binned GROUP BY bin
"""


def _counts(table: str, value: str, name: str, where: str = "true", order: bool = False) -> str:
    tail = f" ORDER BY row_count DESC, {name} LIMIT 5" if order else ""
    return f"SELECT {value} AS {name}, count(*) AS row_count FROM {table} WHERE {where} GROUP BY 1{tail}"


def _stage(zone: str, table: str, relation: str) -> str:
    return f"SELECT '{zone}' AS zone, '{table}' AS table_name, count(*) AS row_count FROM {relation}"


def _day_patterns(column: str) -> str:
    return (
        f"SELECT * FROM (SELECT '{column}' AS column_name, {column} AS pattern, count(*) AS row_count, "
        f"CASE WHEN try_cast({column} AS date) IS NULL THEN 'Invalid Format' "
        "ELSE 'Valid Format but Invalid Date' END AS reason FROM raw_loan_daily "
        f"WHERE {column} IS NOT NULL AND {_strict_day(column)} IS NULL GROUP BY ALL "
        f"ORDER BY row_count DESC, pattern LIMIT 5) top_{column}"
    )


# The months of the backfill.
_OF_MART = "snapshot_date BETWEEN DATE '2023-01-01' AND DATE '2024-12-01' AND day(snapshot_date) = 1"


def _month_counts() -> str:
    tables = {("bronze", t): f"(SELECT {_day('snapshot_date')} AS snapshot_date FROM raw_{t}) bronze" for t in TABLES}
    tables |= {("silver", t): f"silver_{t}" for t in TABLES}
    tables |= {("gold", "feature_store"): "gold", ("gold", "label_store"): "labels"}
    lines = [
        f"SELECT '{zone}' AS zone, '{t}' AS table_name, snapshot_date, count(*) AS row_count FROM {relation} "
        f"WHERE {_OF_MART} GROUP BY snapshot_date"
        for (zone, t), relation in tables.items()
    ]
    return _query(" UNION ALL ".join(lines), *[f"raw_{t}" for t in TABLES], "silver_loan_daily", "gold", "labels")


_SKETCHED = {
    ("loan_id", "loan_id"): _match("loan_id", v.LOAN_ID),
    ("customer_id", "Customer_ID"): _match("Customer_ID", v.CUSTOMER_ID),
    ("strict_day", "loan_start_date"): f"{_strict_day('loan_start_date')} IS NOT NULL",
    **{("whole_number", c): _is_whole(c) for c in credit.LOAN_COUNT_COLUMNS},
    **{("numeric", c): _numeric(c) for c in ("due_amt", "paid_amt")},
}


def _distinct_invalid() -> str:
    lines = [
        f"SELECT 'loan_daily' AS table_name, '{rule}' AS rule_name, '{c}' AS column_name, cast(count(*) AS bigint) AS total, "
        f"count(*) FILTER (WHERE NOT coalesce({condition}, false)) AS invalid, "
        f"count(DISTINCT {c}) FILTER (WHERE NOT coalesce({condition}, false)) AS distinct_invalid "
        f"FROM {_BRONZE_LOANS} WHERE {_OF_MART}"
        for (rule, c), condition in _SKETCHED.items()
    ]
    return _query(" UNION ALL ".join(lines), "raw_loan_daily")


def _free_days() -> str:
    two = r"'^(\d{1,2})[/.-](\d{1,2})[/.-]\d{4}$'"

    def twofold(sign: str) -> str:
        day_first, month_first = (f"try_strptime(t, '{f.replace('/', sign)}')" for f in ("%d/%m/%Y", "%m/%d/%Y"))
        return (
            f"WHEN {_match('t', two[1:-1])} AND contains(t, '{sign}') THEN CASE WHEN (SELECT max(a) > 12 AND max(b) <= 12 "
            f"FROM numbers WHERE sign = '{sign}') THEN coalesce({day_first}, {month_first}) ELSE coalesce({month_first}, {day_first}) END "
        )

    plain = {r"^\d{4}-\d{1,2}-\d{1,2}$": "%Y-%m-%d", r"^\d{4}/\d{1,2}/\d{1,2}$": "%Y/%m/%d", r"^\d{8}$": "%Y%m%d"}
    plain |= {r"^\d{1,2} [A-Z][a-z]{2} \d{4}$": "%d %b %Y", r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$": "%b %d, %Y"}
    steps = [f"WHEN {_match('t', p)} THEN try_strptime(t, '{f}') " for p, f in plain.items()]
    return (
        f"WITH texts AS MATERIALIZED (SELECT {FREE_DAYS['order_key']} AS order_key, {FREE_DAYS['day_text']} AS t FROM orders), "
        f"numbers AS MATERIALIZED (SELECT regexp_extract(t, '([/.-])', 1) AS sign, "
        f"cast(regexp_extract(t, {two}, 1) AS integer) AS a, cast(regexp_extract(t, {two}, 2) AS integer) AS b "
        f"FROM texts WHERE {_match('t', two[1:-1])}) "
        f"SELECT order_key, t AS day_text, cast(CASE {''.join(map(twofold, '/-.'))}{''.join(steps)}END AS date) AS day FROM texts"
    )


_CSV = (
    f"WITH records AS MATERIALIZED (SELECT {CSV_FAULT} AS reason, {CSV_RECORD} AS record, "
    + ", ".join(f"{text} AS {name}" for name, text in CSV_FIELDS.items())
    + " FROM customer) SELECT "
    + ", ".join(f"CASE WHEN reason IS NULL THEN {name} END AS {name}" for name in CSV_COLUMNS)
    + ", CASE WHEN reason IS NOT NULL THEN record END AS record, reason FROM records"
)

_AGE = _whole_part("replace(Age, '_', '')")
_AGE_TRUNCATED = f"cast(trunc({_double('replace(Age, chr(95), chr(32))')}) AS integer)"

ORACLE: dict[str, str] = {
    "date_spine": _query(_SPINE, "raw_loan_daily"),
    "snapshot_slice": _query(
        f"SELECT * FROM {_BRONZE_LOANS} WHERE snapshot_date = DATE '2023-06-01'", "raw_loan_daily"
    ),
    "off_spine_rows": _query(
        "SELECT count(*) AS row_count, count(*) FILTER (WHERE snapshot_date IS NULL "
        f"OR year(snapshot_date) <> 2023 OR day(snapshot_date) <> 1) AS off_spine FROM {_BRONZE_LOANS}",
        "raw_loan_daily",
    ),
    "silver_clickstream": _query("SELECT * FROM silver_clickstream", "silver_clickstream"),
    "silver_attributes": _query("SELECT * FROM silver_attributes", "silver_attributes"),
    "silver_financials": _query("SELECT * FROM silver_financials", "silver_financials"),
    "silver_loan_daily": _query("SELECT * FROM silver_loan_daily", "silver_loan_daily"),
    "silver_financials_options": _query(_silver_financials(options=True), "raw_financials"),
    "silver_loan_daily_signed": _query(_silver_loan_daily(signed=True), "raw_loan_daily"),
    "clean_number_keep_sign": _query(
        f"SELECT {_KEYS}, {_dirty('Annual_Income', 2, signed=True)} AS annual_income, "
        f"{_dirty('Changed_Credit_Limit', 2, signed=True)} AS credit_limit, "
        f"{_dirty('Monthly_Balance', 4, True, True)} AS balance FROM raw_financials",
        "raw_financials",
    ),
    "number_coerce": _query(
        f"SELECT {_KEYS}, "
        + ", ".join(
            f"{_clean(c, 2)} AS {c}" for c in ("Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit")
        )
        + ", "
        + ", ".join(
            f"{_clean(c, 4, True)} AS {c}"
            for c in (
                "Credit_Utilization_Ratio",
                "Total_EMI_per_month",
                "Amount_invested_monthly",
                "Monthly_Balance",
            )
        )
        + " FROM raw_financials",
        "raw_financials",
    ),
    "outstanding_debt": _query(
        f"SELECT {_KEYS}, {_dirty('Outstanding_Debt', 2, True)} AS Outstanding_Debt FROM raw_financials",
        "raw_financials",
    ),
    "min_payment_exact": _query(
        _counts(
            "raw_financials",
            "CASE WHEN trim(Payment_of_Min_Amount) IN ('Yes', 'No', 'NM') "
            "THEN trim(Payment_of_Min_Amount) ELSE 'Unknown' END",
            "answer",
        ),
        "raw_financials",
    ),
    "behaviour_joint_split": _query(
        f"SELECT {_KEYS}, Payment_Behaviour, "
        f"nullif(regexp_extract(Payment_Behaviour, '{credit.SPEND_AND_VALUE}', 1), '') AS Spend_Level, "
        f"nullif(regexp_extract(Payment_Behaviour, '{credit.SPEND_AND_VALUE}', 2), '') AS Payment_Value "
        "FROM raw_financials",
        "raw_financials",
    ),
    "credit_history_months": _query(
        f"SELECT {_KEYS}, Credit_History_Age, "
        "try_cast(regexp_extract(Credit_History_Age, '([0-9]+) Years?', 1) AS integer) * 12 "
        "+ try_cast(regexp_extract(Credit_History_Age, '([0-9]+) Months?', 1) AS integer) AS history_months "
        "FROM raw_financials",
        "raw_financials",
    ),
    "age_band_counts": _label_counts(_band(_AGE)),
    "age_band_cut_open": _label_counts(_band(_AGE_TRUNCATED, floor=0)),
    "age_band_invalid": _query(
        _counts("raw_attributes", _band(_double("Age"), floor=17, default="'Invalid'", skip=1), "age_group"),
        "raw_attributes",
    ),
    "null_profile": _null_profile(),
    "profile_clickstream": _profile("clickstream"),
    "profile_attributes": _profile("attributes"),
    "profile_financials": _profile("financials"),
    "profile_loans": _profile("loan_daily"),
    "quality_report": _query(
        " UNION ALL ".join(line for table in TABLES for line in _profile_lines(table)),
        *[f"raw_{table}" for table in TABLES],
    ),
    "loan_type_conflicts": _query(
        f"SELECT {_KEYS}, Num_of_Loan, Type_of_Loan FROM raw_financials "
        f"WHERE NOT {_agree(_double('Num_of_Loan'), 'Type_of_Loan')}",
        "raw_financials",
    ),
    "invalid_samples": _query(
        f"SELECT DISTINCT loan_id FROM raw_loan_daily WHERE NOT {_match('loan_id', v.LOAN_ID)} "
        "ORDER BY loan_id LIMIT 10",
        "raw_loan_daily",
    ),
    "invalid_patterns": _query(
        _counts("raw_loan_daily", "due_amt", "due_amt", f"due_amt IS NOT NULL AND NOT {_numeric('due_amt')}", True),
        "raw_loan_daily",
    ),
    "invalid_day_reasons": _query(
        "SELECT loan_start_date, CASE WHEN try_cast(loan_start_date AS date) IS NULL THEN 'Invalid Format' "
        "ELSE 'Valid Format but Invalid Date' END AS reason, count(*) AS row_count FROM raw_loan_daily "
        f"WHERE {_strict_day('loan_start_date')} IS NULL GROUP BY 1, 2",
        "raw_loan_daily",
    ),
    "loan_day_patterns": _query(
        " UNION ALL ".join(_day_patterns(c) for c in ("loan_start_date", "snapshot_date")), "raw_loan_daily"
    ),
    "invalid_loan_day_samples": _query(
        "SELECT DISTINCT loan_id, Customer_ID, installment_num, loan_start_date FROM raw_loan_daily "
        f"WHERE {_strict_day('loan_start_date')} IS NULL "
        "ORDER BY loan_start_date, loan_id, Customer_ID, installment_num LIMIT 20",
        "raw_loan_daily",
    ),
    "invalid_customer_samples": _query(
        f"SELECT DISTINCT Customer_ID, Name, SSN FROM raw_attributes WHERE NOT {_match('SSN', v.SSN)} "
        "ORDER BY SSN, Customer_ID, Name LIMIT 10",
        "raw_attributes",
    ),
    "occupation_counts": _query(_counts("raw_attributes", "Occupation", "Occupation"), "raw_attributes"),
    "unknown_occupation": _query(
        "SELECT * FROM raw_attributes WHERE Occupation = '_______'", "raw_attributes"
    ),
    "distinct_occupations": _query("SELECT DISTINCT Occupation FROM raw_attributes", "raw_attributes"),
    "ssn_validity_counts": _query(
        _counts(
            "raw_attributes",
            f"CASE WHEN coalesce({_match('SSN', v.SSN)}, false) THEN 'Valid' ELSE 'Invalid' END",
            "ssn",
        ),
        "raw_attributes",
    ),
    "name_validity": _query(
        f"SELECT Customer_ID, Name, coalesce({_match('trim(Name)', v.PERSON_NAME)} "
        "AND length(trim(Name)) BETWEEN 2 AND 50, false) AS valid_name FROM raw_attributes",
        "raw_attributes",
    ),
    "age_histogram": _query(_HISTOGRAM, "silver_attributes"),
    "duplicate_keys": _query(
        "SELECT count(*) AS duplicate_keys, cast(coalesce(sum(n - 1), 0) AS bigint) AS surplus_rows FROM "
        f"(SELECT count(*) AS n FROM raw_clickstream GROUP BY {_KEYS} HAVING count(*) > 1) repeated",
        "raw_clickstream",
    ),
    "keep_first": _query(
        _first_rows("raw_clickstream", [*credit.KEYS, *credit.CLICK_FEATURES]), "raw_clickstream"
    ),
    "loan_summary": _query("SELECT * FROM loan_summary", "loan_summary"),
    "gold_features": _query("SELECT * FROM gold", "gold"),
    "gold_features_with_loans": _query(
        f"SELECT * FROM gold LEFT JOIN loan_summary USING ({_KEYS})", "gold", "loan_summary"
    ),
    "dpd_columns": _query("SELECT * FROM performance", "performance"),
    "gold_labels": _query("SELECT * FROM labels", "labels"),
    "label_balance": _query(
        "SELECT snapshot_date, label_def, count(*) AS row_count, "
        "count(*) FILTER (WHERE label = 1) AS bad_count FROM labels GROUP BY 1, 2",
        "labels",
    ),
    "bad_rate_by_mob": _query(
        "SELECT mob, avg(CASE WHEN dpd >= 30 OR dpd IS NULL THEN 1 ELSE 0 END) AS bad_rate, count(*) AS row_count "
        "FROM performance WHERE loan_start_date < DATE '2024-01-01' GROUP BY mob",
        "performance",
    ),
    "final_installment_rows": _query(
        "SELECT * FROM silver_loan_daily WHERE installment_num = 10", "silver_loan_daily"
    ),
    # The store holds the months of the backfill.
    "feature_store_union": _query(f"SELECT * FROM gold WHERE {_OF_MART}", "gold"),
    "mart_round_trip": _query(f"SELECT * FROM gold WHERE {_OF_MART}", "gold"),
    "mart_month_counts": _month_counts(),
    "csv_round_trip": _CSV,
    "invalid_distinct_by_sketch": _distinct_invalid(),
    "free_day_texts": _free_days(),
    "label_store_union": _query("SELECT * FROM labels", "labels"),
    "row_counts_by_stage": _query(
        " UNION ALL ".join(
            [
                *[_stage("bronze", table, f"raw_{table}") for table in TABLES],
                *[_stage("silver", table, f"silver_{table}") for table in TABLES],
                _stage("gold", "feature_store", "gold"),
                _stage("gold", "label_store", "labels"),
            ]
        ),
        *[f"raw_{table}" for table in TABLES],
        "silver_loan_daily",
        "gold",
        "labels",
    ),
}
