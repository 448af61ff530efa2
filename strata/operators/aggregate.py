"""Per-account summary (A1-A3): the gold-layer aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote


def last_by(value: str, order: Sequence[str]):
    """Value of the row that is greatest by ``order`` (NULL lowest), keeping a
    NULL value. Deterministic replacement for an unordered ``last``."""
    return F.max_by(F.col(quote(value)), F.struct(*[F.col(quote(c)) for c in order]))


def account_summary(
    df: DataFrame,
    key: str = "AccountNo",
    deposit: str = "DepositAMT",
    withdrawal: str = "WithdrawalAMT",
    balance: str = "BalanceAMT",
    date: str = "Date",
    tie_break: Sequence[str] = ("TxnNo",),
) -> DataFrame:
    """Gold table: totals per account, latest balance and last date.

    One hash-partitioned aggregate with map-side partial aggregation, so a
    hot account is pre-combined in every map task before the shuffle.
    Sums of ``decimal(18,2)`` are ``decimal(28,2)``; ``NetBalance`` is the
    balance of the latest row by (date, tie-break) with NULL dates lowest.
    """
    tie = [c for c in tie_break if c in df.columns]
    return df.groupBy(F.col(quote(key)).alias(key)).agg(
        F.sum(quote(deposit)).alias("TotalDeposits"),
        F.sum(quote(withdrawal)).alias("TotalWithdrawals"),
        last_by(balance, [date, *tie]).cast(T.DecimalType(18, 2)).alias("NetBalance"),
        F.max(quote(date)).alias("LastTransactionDate"),
    )
