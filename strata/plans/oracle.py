"""DuckDB SQL for the fixtures in ``strata.plans.fixtures``.

Each constant is a comma-separated list of CTEs to put after ``WITH``.
Parity notes: DuckDB ``||`` propagates NULL like Spark ``concat``; decimal
sums are cast back to ``decimal(28,2)``; NULL inside a row sorts highest in
DuckDB, so orderings that must put NULL lowest coalesce it first.
"""

TRANSACTIONS = """
transactions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS AccountNo,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS Date,
         o_orderpriority AS TransactionDetails,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS CHQNo,
         CAST(o_orderdate AS DATE) + 2 AS ValueDate,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS WithdrawalAMT,
         CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS DepositAMT,
         CAST(o_totalprice AS DECIMAL(18,2)) AS BalanceAMT,
         o_orderkey AS TxnNo
  FROM orders
)"""

RAW = (
    TRANSACTIONS
    + """,
raw AS (
  SELECT *, TIMESTAMP '2024-01-01 08:00:00' AS IngestionTime FROM transactions
  UNION ALL
  SELECT *, TIMESTAMP '2024-01-02 08:00:00' AS IngestionTime FROM transactions
  WHERE TransactionDetails = '1-URGENT'
)"""
)

RAW_TEXT = """
raw_text AS (
  SELECT CAST(o_custkey AS VARCHAR) || '''' AS "Account No",
         CASE WHEN o_orderkey % 97 = 0 THEN 'not a date'
              WHEN o_orderkey % 5 = 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 10:30:00'
              WHEN o_orderkey % 5 = 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00'
              WHEN o_orderkey % 5 = 3 THEN strftime(CAST(o_orderdate AS DATE), '%d-%b-%y')
              WHEN o_orderkey % 5 = 4 THEN strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y')
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "DATE",
         o_orderpriority AS "TRANSACTION DETAILS",
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS "CHQ.NO.",
         CAST(CAST(o_orderdate AS DATE) + 2 AS VARCHAR) AS "VALUE DATE",
         CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              WHEN o_orderkey % 89 = 0 THEN ['NaN', '1e20', 'Infinity'][(o_orderkey // 89) % 3 + 1] END AS "WITHDRAWAL AMT",
         CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS "DEPOSIT AMT",
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "BALANCE AMT",
         CASE WHEN o_orderkey % 101 = 0 THEN '9999999999999999.99'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS "LARGE BALANCE AMT",
         '.' AS "."
  FROM orders
)"""


def typed_date(column: str) -> str:
    """The day in a text cell, NULL when no accepted form fits."""
    forms = "['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%d-%b-%y', '%m/%d/%Y']"
    return f'CAST(try_strptime("{column}", {forms}) AS DATE)'


def typed_money(column: str) -> str:
    return f'TRY_CAST("{column}" AS DECIMAL(18,2))'


# Surrogate key of the silver layer over a relation with transaction columns.
SURROGATE_KEY = """sha256(
    AccountNo || CAST(Date AS VARCHAR) || TransactionDetails
    || coalesce(CHQNo, '')
    || coalesce(CAST(WithdrawalAMT AS VARCHAR), '')
    || coalesce(CAST(DepositAMT AS VARCHAR), '')
    || coalesce(CAST(BalanceAMT AS VARCHAR), ''))"""

# Gold aggregate over a relation named ``src`` with transaction columns.
ACCOUNT_SUMMARY = """
  SELECT AccountNo,
         CAST(sum(DepositAMT) AS DECIMAL(28,2)) AS TotalDeposits,
         CAST(sum(WithdrawalAMT) AS DECIMAL(28,2)) AS TotalWithdrawals,
         arg_max_null(BalanceAMT, row(coalesce(Date, DATE '0001-01-01'), TxnNo)) AS NetBalance,
         max(Date) AS LastTransactionDate
  FROM src GROUP BY AccountNo"""
