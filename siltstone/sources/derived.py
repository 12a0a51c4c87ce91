"""Raw credit tables derived from order and customer tables.

Stand-ins for the credit files, with known faults in them. All columns are text.
The expressions are plain SQL, so that another engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.credit import CLICK_FEATURES

LAST_INSTALLMENT = 10


def _customer_id(key: str) -> str:
    return f"CASE WHEN {key} % 41 = 0 THEN concat('BAD_', cast({key} AS string)) ELSE concat('CUS_0x', lower(hex({key}))) END"


def _month(number: str) -> str:
    return (
        f"concat(CASE WHEN ({number}) < 12 THEN '2023' ELSE '2024' END, '-', "
        f"lpad(cast(({number}) % 12 + 1 AS string), 2, '0'), '-01')"
    )


def _money(value: str) -> str:
    return f"cast(cast({value} AS decimal(14,2)) AS string)"


def _text(value: str) -> str:
    return f"cast({value} AS string)"


def _suffix_if(condition: str, text: str, suffix: str) -> str:
    return f"concat({text}, CASE WHEN {condition} THEN '{suffix}' ELSE '' END)"


def _dated(key: str, month: str) -> str:
    """The month, with faults by key: missing, impossible, unpadded, beyond all snapshots, no date."""
    return (
        f"CASE {key} % 71 WHEN 3 THEN NULL WHEN 4 THEN '2023-02-30' WHEN 5 THEN '2023-5-1' "
        f"WHEN 6 THEN '2031-07-01' WHEN 8 THEN 'n/a' ELSE {month} END"
    )


_K = "c_custkey"
# One customer in twenty has two rows of the same key.
_OWNER = f"(CASE WHEN {_K} % 20 = 7 THEN {_K} - 1 ELSE {_K} END)"

ATTRIBUTES = {
    "Customer_ID": _customer_id(_OWNER),
    "Name": f"CASE {_K} % 4 WHEN 0 THEN 'Anna Smith' WHEN 1 THEN 'A' WHEN 2 THEN repeat('Long Name ', 30) ELSE c_name END",
    "Age": f"CASE WHEN {_K} % 37 = 0 THEN NULL WHEN {_K} % 11 = 0 "
    f"THEN concat(cast(12 + {_K} % 70 AS string), '_') ELSE cast(12 + {_K} % 70 AS string) END",
    "SSN": f"CASE WHEN {_K} % 13 = 0 THEN 'invalid-ssn' ELSE concat(cast(100 + {_K} % 900 AS string), '-', "
    f"cast(10 + {_K} % 90 AS string), '-', cast(1000 + {_K} % 9000 AS string)) END",
    "Occupation": f"CASE WHEN {_K} % 17 = 0 THEN '_______' ELSE c_mktsegment END",
    # Not always the month of the customer's financials.
    "snapshot_date": _dated(_OWNER, _month(f"({_OWNER} + {_OWNER} % 5 % 2) % 24")),
}

FINANCIALS = {
    "Customer_ID": _customer_id(_OWNER),
    "Annual_Income": _suffix_if(f"{_K} % 9 = 0", _text("cast(c_acctbal AS decimal(12,2)) * 12"), "_"),
    "Monthly_Inhand_Salary": f"CASE WHEN {_K} % 29 = 0 THEN NULL ELSE {_text('cast(c_acctbal AS decimal(12,2))')} END",
    "Num_Bank_Accounts": f"CASE WHEN {_K} % 23 = 0 THEN NULL WHEN {_K} % 19 = 0 "
    f"THEN concat(cast({_K} % 11 AS string), '_') ELSE cast({_K} % 11 AS string) END",
    "Num_Credit_Card": _suffix_if(f"{_K} % 47 = 0", _text(f"({_K} * 3) % 9"), "_"),
    "Interest_Rate": f"concat(cast({_K} % 34 AS string), CASE WHEN {_K} % 49 = 0 THEN '.5' ELSE '.0' END)",
    "Num_of_Loan": _suffix_if(f"{_K} % 31 = 0", _text(f"{_K} % 5"), "_"),
    "Type_of_Loan": f"CASE {_K} % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' ELSE 'Auto Loan' END",
    "Delay_from_due_date": _suffix_if(f"{_K} % 57 = 0", _text(f"{_K} % 60 - 5"), "_"),
    "Num_of_Delayed_Payment": _suffix_if(f"{_K} % 43 = 0", _text(f"{_K} % 25"), "_"),
    "Changed_Credit_Limit": f"CASE WHEN {_K} % 15 = 0 THEN '_' ELSE {_money(f'{_K} * 13 % 2000 - 300')} END",
    "Num_Credit_Inquiries": f"CASE WHEN {_K} % 27 = 0 THEN NULL ELSE concat(cast({_K} % 12 AS string), '.0') END",
    "Credit_Mix": "c_mktsegment",
    "Outstanding_Debt": f"CASE WHEN {_K} % 33 = 0 THEN NULL WHEN {_K} % 8 = 0 "
    f"THEN concat({_money(f'{_K} * 3')}, '_') ELSE {_money(f'{_K} * 3')} END",
    "Credit_Utilization_Ratio": f"CASE WHEN {_K} % 21 = 0 THEN '1.2.3' ELSE concat(cast({_K} % 50 AS string), '.', "
    f"lpad(cast(({_K} * 7919) % 1000000 AS string), 6, '0')) END",
    "Credit_History_Age": f"concat(cast({_K} % 30 AS string), ' Years and ', cast({_K} % 12 AS string), ' Months')",
    "Payment_of_Min_Amount": f"CASE {_K} % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NM' "
    "WHEN 3 THEN ' yes ' WHEN 4 THEN 'nm' ELSE NULL END",
    "Total_EMI_per_month": f"CASE WHEN {_K} % 14 = 0 THEN concat('$', {_money(f'{_K} % 700')}) ELSE {_money(f'{_K} % 700')} END",
    "Amount_invested_monthly": f"CASE WHEN {_K} % 10 = 0 THEN '__10000__' ELSE {_money(f'{_K} % 900')} END",
    "Payment_Behaviour": f"concat(CASE WHEN {_K} % 2 = 0 THEN 'High' ELSE 'Low' END, '_spent_', "
    f"CASE {_K} % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'Large' END, '_value', "
    f"CASE WHEN {_K} % 4 = 0 THEN '_payments' ELSE '' END)",
    "Monthly_Balance": f"CASE WHEN {_K} % 26 = 0 THEN NULL WHEN {_K} % 16 = 0 "
    f"THEN concat('-', {_money(f'{_K} % 1200')}) ELSE {_money(f'{_K} % 1200')} END",
    "snapshot_date": _dated(_OWNER, _month(f"{_OWNER} % 24")),
}

CLICKSTREAM = {
    "Customer_ID": _customer_id("o_custkey"),
    **{
        name: f"CASE WHEN o_orderkey % 97 = {i} THEN 'bad' "
        f"ELSE cast((o_orderkey * 31 + {i} * 17) % 401 - 200 AS string) END"
        for i, name in enumerate(CLICK_FEATURES, start=1)
    },
    # The orders of a customer fall into three months.
    "snapshot_date": _dated("o_orderkey", _month("(o_custkey + o_orderkey % 3) % 24")),
}

# One row per order and installment number `i`, 0 to LAST_INSTALLMENT.
LOAN_DAILY = {
    "loan_id": f"concat({_customer_id('o_custkey')}, '_', replace({_month('o_custkey % 14')}, '-', '_'))",
    "Customer_ID": _customer_id("o_custkey"),
    "loan_start_date": f"CASE o_orderkey % 53 WHEN 0 THEN '2023-02-30' WHEN 1 THEN '2023-1-5' WHEN 2 THEN 'soon' "
    f"WHEN 3 THEN '01.03.2023' ELSE {_month('o_custkey % 14')} END",
    "tenure": "CASE WHEN o_orderkey % 59 = 0 THEN '10.5' ELSE '10' END",
    "installment_num": "CASE WHEN o_orderkey % 79 = 0 THEN 'first' ELSE cast(i AS string) END",
    "loan_amt": _suffix_if("o_orderkey % 61 = 0", _money("o_totalprice"), "_"),
    "due_amt": f"concat(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '$' END, {_money('1000 + o_orderkey % 100')})",
    "paid_amt": f"CASE WHEN (o_orderkey + i) % 4 = 0 THEN {_money('0')} WHEN o_orderkey % 73 = 0 THEN '1000.00_' ELSE {_money('1000')} END",
    "overdue_amt": f"CASE WHEN i = 0 THEN NULL "
    # More installments missed than the calendar has months before the snapshot.
    f"WHEN o_orderkey % 101 = 7 THEN '60000000' "
    # More installments than a BIGINT holds.
    f"WHEN o_orderkey % 103 = 9 THEN '{'9' * 23}' "
    f"ELSE concat(cast((o_orderkey + i) % 4 AS string), '000.00') END",
    "balance": _suffix_if("o_orderkey % 67 = 0", _money("cast(o_totalprice AS decimal(14,2)) * (10 - i) * 0.1"), "_"),
    "snapshot_date": _dated("o_orderkey", _month("o_custkey % 14 + i")),
}

PER_INSTALLMENT = ("installment_num", "paid_amt", "overdue_amt", "balance", "snapshot_date")

# Days in many forms: one shape day first by its values, one month first, one that tells neither.
_D, _M = "(o_orderkey % 28 + 1)", "(o_custkey % 12 + 1)"
_EARLY = "(o_orderkey % 12 + 1)"
_NAME = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast({_M} * 3 - 2 AS int), 3)"


def _two(value: str) -> str:
    return f"lpad(cast({value} AS string), 2, '0')"


FREE_DAYS = {
    "order_key": "o_orderkey",
    "day_text": f"CASE o_orderkey % 11 WHEN 0 THEN concat('2023-', cast({_M} AS string), '-', cast({_D} AS string)) "
    f"WHEN 1 THEN concat({_two(_D)}, '/', {_two(_M)}, '/2023') WHEN 2 THEN concat({_two(_M)}, '-', {_two(_D)}, '-2024') "
    f"WHEN 3 THEN concat({_two(_EARLY)}, '.', {_two(_M)}, '.2023') "
    f"WHEN 4 THEN concat(cast({_D} AS string), ' ', {_NAME}, ' 2023') "
    f"WHEN 5 THEN concat({_NAME}, ' ', cast({_D} AS string), ', 2024') "
    f"WHEN 6 THEN concat('2024', {_two(_M)}, {_two(_D)}) WHEN 7 THEN '30/02/2023' WHEN 8 THEN NULL "
    f"WHEN 9 THEN 'soon' ELSE concat('2024/', {_two(_M)}, '/', {_two(_D)}) END",
}


def _quoted(value: str) -> str:
    return f"""concat('"', replace({value}, '"', '""'), '"')"""


# One CSV record per customer: quotes, commas and line breaks in a field, and records that do not parse.
_NOTE = (
    f"concat(c_name, CASE {_K} % 3 WHEN 0 THEN ' says \"yes, twice\"' "
    f"WHEN 1 THEN concat(chr(10), 'second line, ', c_mktsegment) ELSE '' END)"
)
CSV_COLUMNS = ("Customer_ID", "Note", "Age", "Segment")
CSV_FIELDS = {
    "Customer_ID": _customer_id(_K),
    "Note": f"CASE WHEN {_K} % 29 = 7 THEN '' ELSE {_NOTE} END",
    "Age": f"CASE WHEN {_K} % 37 = 0 THEN NULL ELSE cast(12 + {_K} % 70 AS string) END",
    "Segment": "c_mktsegment",
}
_CSV_ID, _CSV_AGE = CSV_FIELDS["Customer_ID"], f"coalesce({CSV_FIELDS['Age']}, '')"
CSV_FAULT = (
    f"CASE WHEN {_K} % 13 = 5 THEN 'short' WHEN {_K} % 17 = 3 THEN 'long' WHEN {_K} % 19 = 4 THEN 'unterminated' "
    f"WHEN {_K} % 23 = 6 THEN 'stray quote' END"
)
CSV_RECORD = (
    f"CASE {CSV_FAULT} WHEN 'short' THEN concat({_CSV_ID}, ',', {_quoted('c_name')}) "
    f"WHEN 'long' THEN concat({_CSV_ID}, ',', {_quoted('c_name')}, ',', {_CSV_AGE}, ',', c_mktsegment, ',more') "
    f"WHEN 'unterminated' THEN concat({_CSV_ID}, ',\"', c_name, ',', {_CSV_AGE}, ',', c_mktsegment) "
    f"WHEN 'stray quote' THEN concat({_CSV_ID}, ',', {_quoted('c_name')}, ' and more,', {_CSV_AGE}, ',', c_mktsegment) "
    f"ELSE concat({_CSV_ID}, ',', {_quoted(CSV_FIELDS['Note'])}, ',', {_CSV_AGE}, ',', c_mktsegment) END"
)

TABLES = ("clickstream", "attributes", "financials", "loan_daily")


def _derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One raw table over the whole driver tables."""
    if table in ("attributes", "financials"):
        customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
        return _derive(customers, ATTRIBUTES if table == "attributes" else FINANCIALS)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if table == "clickstream":
        return _derive(orders, CLICKSTREAM)
    if table == "loan_daily":
        # What an order has once is derived before its installments are.
        once = [F.expr(text).alias(name) for name, text in LOAN_DAILY.items() if name not in PER_INSTALLMENT]
        price = F.col("o_totalprice").cast("decimal(14,2)").alias("o_totalprice")
        per_order = orders.select("o_orderkey", "o_custkey", price, *once)
        each = per_order.select("*", F.explode(F.sequence(F.lit(0), F.lit(LAST_INSTALLMENT))).alias("i"))
        return each.select(*[F.expr(LOAN_DAILY[n]).alias(n) if n in PER_INSTALLMENT else n for n in LOAN_DAILY])
    raise ValueError(f"no raw table {table!r}")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: raw_table(spark, sf_dir, table) for table in TABLES}


def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a CSV file with faults, without its header."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.expr(CSV_RECORD).alias("value"))


def free_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in many forms, one per order."""
    return _derive(spark.read.parquet(f"{sf_dir}/orders.parquet"), FREE_DAYS)


def raw_sql(table: str) -> str:
    """The same raw table as a query over views of the driver tables."""
    sources = {
        "attributes": (ATTRIBUTES, "customer"),
        "financials": (FINANCIALS, "customer"),
        "clickstream": (CLICKSTREAM, "orders"),
        "loan_daily": (
            LOAN_DAILY,
            f"(SELECT orders.*, n_nationkey AS i FROM orders, nation WHERE n_nationkey <= {LAST_INSTALLMENT})",
        ),
    }
    columns, relation = sources[table]
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {relation}"
