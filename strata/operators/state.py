"""Aggregates kept as mergeable state.

An aggregate of sums, maxima and latest values is stored per group and partition of its table. When partitions
change, only their state is computed again; the result of a group is combined from its states, however
many rows stand behind them. Sums add up, maxima are maxima of maxima, and the latest value travels with its order
columns, so the greatest of the partitions' latest is the latest of all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote


@dataclass(frozen=True)
class AggregateSpec:
    """``sums`` and ``maxes``: result column -> input column. ``latest``: result column -> (input column, order columns); of
    the row greatest by the order (NULL lowest), of equal ones the greatest value. ``types``: of result columns."""

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    maxes: Mapping[str, str] = field(default_factory=dict)
    latest: Mapping[str, tuple[str, Sequence[str]]] = field(default_factory=dict)
    types: Mapping[str, T.DataType] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.sums, *self.latest, *self.maxes]


def account_spec(tie_break: Sequence[str] = ()) -> AggregateSpec:
    """The per-account summary of ``operators.aggregate.account_summary``."""
    total = T.DecimalType(28, 2)
    return AggregateSpec(
        keys=["AccountNo"],
        sums={"TotalDeposits": "DepositAMT", "TotalWithdrawals": "WithdrawalAMT"},
        latest={"NetBalance": ("BalanceAMT", ["Date", *tie_break])},
        maxes={"LastTransactionDate": "Date"},
        types={"TotalDeposits": total, "TotalWithdrawals": total, "NetBalance": T.DecimalType(18, 2)},
    )


def _typed(spec: AggregateSpec, name: str, c: Column) -> Column:
    return (c.cast(spec.types[name]) if name in spec.types else c).alias(name)


def partial_state(df: DataFrame, spec: AggregateSpec, part: str) -> DataFrame:
    """One row per group and partition: keys, sums, latest (a struct of order columns and value), maxima, partition."""
    col = lambda c: F.col(quote(c))
    aggs = [_typed(spec, out, F.sum(col(c))) for out, c in spec.sums.items()]
    for out, (c, order) in spec.latest.items():
        pair = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], col(c).alias("value"))
        aggs.append(F.max(pair).alias(out))
    aggs += [F.max(col(c)).alias(out) for out, c in spec.maxes.items()]
    return df.groupBy(*[col(k).alias(k) for k in spec.keys], col(part).alias(part)).agg(*aggs).select(*spec.columns, part)


def combine_state(state: DataFrame, spec: AggregateSpec) -> DataFrame:
    """The aggregate itself from the states of any partitions."""
    col = lambda c: F.col(quote(c))
    aggs = [_typed(spec, out, F.sum(col(out))) for out in spec.sums]
    aggs += [_typed(spec, out, F.max(col(out))["value"]) for out in spec.latest]
    aggs += [_typed(spec, out, F.max(col(out))) for out in spec.maxes]
    return state.groupBy(*[col(k).alias(k) for k in spec.keys]).agg(*aggs)
