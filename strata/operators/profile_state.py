"""Profiles kept as mergeable state.

Per partition and column the state holds counts, ends, sum and centred second moment, and two sketches: KLL for the
quantiles and HLL for the number of distinct values. A profile is a merge of states: it reads a row per partition
and column, never the table, and two tables are compared by their states. Counts, ends, sum, mean and deviation are those of
the exact profile (but for the rounding of sums); a quantile's rank is off by at most ``rank_error(k)`` with 99 % confidence,
the distinct number by about 1.04 / sqrt(2 ** lg_k) of itself as standard error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.profile import QUANTILES, _pct_name

KLL_K = 800
HLL_LG_K = 14


def rank_error(k: int = KLL_K) -> float:
    """Normalised rank error of one quantile at 99 % confidence (fitted formula of the sketch's library)."""
    return 2.296 / k**0.9723


def partition_profile(df: DataFrame, columns: Sequence[str], part: str, k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """The state: one row per partition and column. Numbers have moments and quantiles; of other columns rows, missing and
    distinct values are kept. NaN counts as missing."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aggs, entries = [F.count(F.lit(1)).alias("n")], []
    for i, c in enumerate(columns):
        x = F.col(quote(c))
        numeric = isinstance(kinds[c], T.NumericType)
        v = x.cast("double") if numeric else F.lit(None).cast("double")
        v = F.when(~F.isnan(v), v)
        seen = v.isNotNull() if numeric else x.isNotNull()
        fields = {
            "missing": F.count_if(~seen), "seen": F.count(v), "total": F.sum(v), "m2": F.var_pop(v) * F.count(v),
            "low": F.min(v), "high": F.max(v), "zeros": F.count_if(v == 0), "negatives": F.count_if(v < 0),
            "quantiles": F.kll_sketch_agg_double(v, F.lit(k)), "distinct": F.hll_sketch_agg(F.when(seen, x.cast("string")), F.lit(lg_k)),
        }
        aggs += [e.alias(f"{name}{i}") for name, e in fields.items()]
        entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(numeric).alias("numeric"), F.col("n"), *[F.col(f"{name}{i}").alias(name) for name in fields]))
    rows = df.groupBy(F.col(quote(part)).alias("part")).agg(*aggs).select("part", F.explode(F.array(*entries)).alias("e"))
    return rows.select("e.*", F.col("part").alias(part))


def merged_profile(state: DataFrame, probs: Sequence[float] = QUANTILES) -> DataFrame:
    """(column_name, metric, value) from the states of any partitions, with the metric names of ``profile``."""
    total = state.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("n", "missing", "seen", "total", "zeros", "negatives")],
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("numeric").alias("numeric"),
        F.kll_merge_agg_double(F.when(F.col("seen") > 0, F.col("quantiles"))).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
    )
    total = total.withColumn("mean", F.when(F.col("seen") > 0, F.col("total") / F.col("seen")))
    # Centred at the common mean, so that nothing cancels.
    apart = state.select("column_name", "seen", "m2", (F.col("total") / F.when(F.col("seen") > 0, F.col("seen"))).alias("own"))
    means = total.select(F.col("column_name").alias("of"), "mean")
    moved = F.col("m2") + F.col("seen") * (F.col("own") - F.col("mean")) * (F.col("own") - F.col("mean"))
    spread = apart.join(means, F.col("column_name") == F.col("of")).groupBy("of").agg(F.sum(moved).alias("m2"))
    t = total.join(spread, F.col("column_name") == F.col("of"), "left")
    variance = F.when(F.col("seen") > 1, F.col("m2") / (F.col("seen") - 1))
    numbers = F.col("seen") > 0
    quantile = {p: F.when(numbers, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))) for p in probs}
    metrics = {
        "n": F.col("n"), "missing": F.col("missing"), "n_distinct": F.hll_sketch_estimate("distinct"), "min": F.col("low"), "max": F.col("high"),
        "mean": F.col("mean"), "std": F.sqrt(variance), "variance": variance, "sum": F.col("total"),
        "zeros": F.when(F.col("numeric"), F.col("zeros")), "negatives": F.when(F.col("numeric"), F.col("negatives")),
        "cv": F.when(F.col("mean") != 0, F.sqrt(variance) / F.col("mean")),
    } | {_pct_name(p): q for p, q in quantile.items()}
    if 0.25 in quantile and 0.75 in quantile:
        metrics["iqr"] = quantile[0.75] - quantile[0.25]
    listed = F.array(*[F.struct(F.lit(m).alias("metric"), e.cast("double").alias("value")) for m, e in metrics.items()])
    return t.select("column_name", F.explode(listed).alias("e")).select("column_name", "e.metric", "e.value")


def compare_states(first: DataFrame, second: DataFrame, probs: Sequence[float] = QUANTILES) -> DataFrame:
    """A10 from two states: (column_name, metric, value_1, value_2, difference), the difference second minus first."""
    a = merged_profile(first, probs).withColumnRenamed("value", "value_1")
    b = merged_profile(second, probs).withColumnRenamed("value", "value_2")
    return a.join(b, ["column_name", "metric"], "full").withColumn("difference", F.col("value_2") - F.col("value_1"))
