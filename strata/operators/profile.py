"""Column profiles (A7-A10) as long frames ``(column_name, metric, value, text)``.

One aggregate computes the per-column metrics of all columns in a single
pass; quantiles and top values are separate distributed jobs whose state is
bounded (no group is collected into one task and nothing is collected to the
driver). Metric names:

* every column: ``n`` (rows) and ``missing`` (NULL, and NaN in floating point
  columns); all but array, map, struct and binary ones: ``n_distinct``
* numeric: ``min max mean std variance sum zeros negatives p5 p25 p50 p75
  p95 iqr cv skewness kurtosis`` (sample std / variance, bias-corrected
  skewness and excess kurtosis, linear-interpolated quantiles)
* text: ``min_length mean_length max_length`` and ``top_<i>`` (text = value,
  value = count; ties by value ascending)
* date / timestamp: ``min max`` (text) and ``range_days``
* boolean: ``true false``
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.session import checkpoint_root

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
TOP_K = 5
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, _NUMERIC):
        return "numeric"
    if isinstance(dt, _DATES):
        return "date"
    if isinstance(dt, T.StringType):
        return "text"
    return "other"


def _pct_name(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def _corrected_skewness(g1: Column, n: Column) -> Column:
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def _corrected_kurtosis(g2: Column, n: Column) -> Column:
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def _entries(
    df: DataFrame,
    kinds: dict[str, str],
    approx_distinct: bool,
    exact_numeric_distinct: bool = False,
    exact_text_distinct: bool = False,
):
    """(column, metric, value expr, text expr) for the one-pass aggregate.
    Distinct counts that come from the value-count jobs are left out, so the
    aggregate needs no ``Expand``."""
    out: list[tuple[str, str, Column | None, Column | None]] = []
    rows = F.count(F.lit(1))
    for c, kind in kinds.items():
        x = F.col(quote(c))
        distinct = F.approx_count_distinct(x) if approx_distinct else F.count_distinct(x)
        out += [(c, "n", rows, None), (c, "missing", F.count_if(x.isNull()), None)]
        if kind == "other":
            continue
        shared = (kind == "numeric" and exact_numeric_distinct) or (kind == "text" and exact_text_distinct)
        if approx_distinct or not shared:
            out.append((c, "n_distinct", distinct, None))
        if kind == "numeric":
            v = x.cast("double")
            n = F.count(v)
            mean = F.avg(v)
            std = F.stddev_samp(v)
            out += [
                (c, "min", F.min(v), None),
                (c, "max", F.max(v), None),
                (c, "mean", mean, None),
                (c, "std", std, None),
                (c, "variance", F.var_samp(v), None),
                (c, "sum", F.sum(v), None),
                (c, "zeros", F.count_if(v == 0), None),
                (c, "negatives", F.count_if(v < 0), None),
                (c, "cv", F.when(mean != 0, std / mean), None),
                (c, "skewness", _corrected_skewness(F.skewness(v), n), None),
                (c, "kurtosis", _corrected_kurtosis(F.kurtosis(v), n), None),
            ]
        elif kind == "text":
            length = F.length(x)
            out += [
                (c, "min_length", F.min(length), None),
                (c, "mean_length", F.avg(length), None),
                (c, "max_length", F.max(length), None),
            ]
        elif kind == "date":
            text_fmt = "yyyy-MM-dd" if isinstance(df.schema[c].dataType, T.DateType) else "yyyy-MM-dd HH:mm:ss"
            out += [
                (c, "min", None, F.date_format(F.min(x), text_fmt)),
                (c, "max", None, F.date_format(F.max(x), text_fmt)),
                (c, "range_days", F.datediff(F.to_date(F.max(x)), F.to_date(F.min(x))), None),
            ]
        elif kind == "boolean":
            out += [
                (c, "true", F.count_if(x), None),
                (c, "false", F.count_if(~x), None),
            ]
    return out


def _long(agg_row: DataFrame, entries) -> DataFrame:
    """Unpivot the one-row aggregate into the long profile."""
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(m).alias("metric"),
            (F.col(f"m{i}").cast("double") if v is not None else F.lit(None).cast("double")).alias("value"),
            (F.col(f"t{i}") if t is not None else F.lit(None).cast("string")).alias("text"),
        )
        for i, (c, m, v, t) in enumerate(entries)
    ]
    return agg_row.select(F.explode(F.array(*structs)).alias("e")).select("e.*")


def _exact_keys(df: DataFrame, c: str) -> tuple[Column, Column]:
    """(long key, text key) that identify a value exactly where its double
    may not: longs as themselves, decimals up to 18 digits as their unscaled
    long, wider decimals as text; other types need no key (the double is
    exact)."""
    dt = df.schema[c].dataType
    x = F.col(quote(c))
    none_long, none_text = F.lit(None).cast("long"), F.lit(None).cast("string")
    if isinstance(dt, T.LongType):
        return x, none_text
    if isinstance(dt, T.DecimalType) and dt.precision <= 18:
        unscaled = (x * F.lit(10**dt.scale).cast(T.DecimalType(dt.scale + 1, 0))).cast("long")
        return unscaled, none_text
    if isinstance(dt, T.DecimalType):
        return none_long, x.cast("string")
    return none_long, none_text


def _numeric_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per distinct (column, value), combined map-side.

    ``v`` is the value as double; ``k`` / ``ks`` keep long and decimal values exact
    (fixed-width long keys where possible), so distinct counts stay exact beyond 2^53.
    """
    fields = []
    for c in columns:
        k, ks = _exact_keys(df, c)
        fields.append(
            F.struct(
                F.lit(c).alias("column_name"),
                k.alias("k"),
                ks.alias("ks"),
                F.col(quote(c)).cast("double").alias("v"),
            )
        )
    vals = df.select(F.explode(F.array(*fields)).alias("p")).select("p.*").where(F.col("v").isNotNull())
    return vals.groupBy("column_name", "k", "ks", "v").agg(F.count(F.lit(1)).alias("c"))


def _column_names(spark, columns: Sequence[str]) -> DataFrame:
    """One row per profiled column: a column whose values are all NULL has
    no value counts but still gets its metrics (0 or NULL)."""
    return spark.createDataFrame([(c,) for c in columns], "column_name string")


def _distinct_from_counts(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    per = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    # the name list has one row per column: a bounded broadcast
    names = F.broadcast(_column_names(counts.sparkSession, columns))
    return names.join(per, "column_name", "left").select(
        "column_name",
        F.lit("n_distinct").alias("metric"),
        F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("value"),
    )


# Accuracy of the sketch that brackets a rank: its rank error is at most rows / accuracy by its design,
# and the bracket allows twice that. Whether the rank is inside is counted, not assumed.
BRACKET_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUANTILES
) -> DataFrame:
    """Exact linear-interpolated quantiles (``quantile_cont``) of numeric
    columns, distributed.

    1. one pass counts the values, takes their ends and brackets each rank between two values by a
       sketch (one row of columns x ranks x 2 numbers comes to the driver);
    2. one aggregate counts the values below and inside each bracket; a rank that is not inside its own is
       looked for among all values;
    3. only the values inside a bracket, some rows / 2,500 each, are counted, range-
       partitioned and ranked: a running count inside each range partition plus
       the totals of the partitions before it;
    4. one aggregate picks the values at ranks floor / ceil of p*(n-1).

    No task ever holds more than one range partition of a bracket. Also emits
    ``iqr`` (p75 - p25) when both are requested. A column without values has NULLs.
    """
    spark = df.sparkSession
    out_schema = "column_name string, metric string, value double"
    columns, probs = list(columns), list(probs)
    if not columns or not probs:
        return spark.createDataFrame([], out_schema)
    v = {c: F.col(quote(c)).cast("double") for c in columns}
    v = {c: F.when(~F.isnan(x), x) for c, x in v.items()}
    reach = 2 / BRACKET_ACCURACY
    ends = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    first = []
    for i, c in enumerate(columns):
        first += [F.count(v[c]).alias(f"n{i}"), F.min(v[c]).alias(f"l{i}"), F.max(v[c]).alias(f"h{i}")]
        first.append(F.percentile_approx(v[c], ends, BRACKET_ACCURACY).alias(f"s{i}"))
    sketch = df.agg(*first).first()
    rows = [sketch[f"n{i}"] for i in range(len(columns))]

    def bracket(i: int, j: int) -> tuple[float, float]:
        if rows[i] <= 2 * BRACKET_ACCURACY:  # so few that the neighbours of a rank need more reach: all values
            return sketch[f"l{i}"], sketch[f"h{i}"]
        return sketch[f"s{i}"][2 * j], sketch[f"s{i}"][2 * j + 1]

    wanted = [(i, j, *bracket(i, j)) for i in range(len(columns)) for j in range(len(probs)) if rows[i]]  # (column number, rank number, low, high)
    counted = []
    for i, j, low, high in wanted:
        x = v[columns[i]]
        counted += [F.count_if(x < F.lit(low)).alias(f"b{i}_{j}"), F.count_if((x >= F.lit(low)) & (x <= F.lit(high))).alias(f"i{i}_{j}")]
    seen = df.agg(*(counted or [F.lit(0)])).first()
    below = {(i, j): seen[f"b{i}_{j}"] for i, j, _, _ in wanted}
    for k, (i, j, _, _) in enumerate(wanted):
        h = (rows[i] - 1) * float(probs[j])
        if not below[i, j] <= math.floor(h) <= math.ceil(h) < below[i, j] + seen[f"i{i}_{j}"]:
            wanted[k], below[i, j] = (i, j, sketch[f"l{i}"], sketch[f"h{i}"]), 0
    inside, picks = [], []
    for i, j, low, high in wanted:
        x = v[columns[i]]
        entry = F.struct(F.lit(i).alias("col"), F.lit(j).alias("rank"), x.alias("v"))
        inside.append(F.when((x >= F.lit(low)) & (x <= F.lit(high)), entry))
        h = (rows[i] - 1) * float(probs[j])
        picks.append((i, j, math.floor(h) - below[i, j], math.ceil(h) - below[i, j], h - math.floor(h)))
    if not wanted:
        inside = [F.lit(None).cast("struct<col:int,rank:int,v:double>")]
    near = df.select(F.explode(F.filter(F.array(*inside), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counts = near.groupBy("col", "rank", "v").agg(F.count(F.lit(1)).alias("c"))
    checkpoint_root(spark)  # the partition numbers must not change if a stage runs again
    dealt = counts.repartitionByRange("col", "rank", "v").withColumn("pid", F.spark_partition_id()).checkpoint(eager=True)
    upto = Window.partitionBy("pid", "col", "rank").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("col", "rank").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("col", "rank", "pid").agg(F.sum("c").alias("tot"))
    offsets = totals.withColumn("off", F.coalesce(F.sum("tot").over(before), F.lit(0))).drop("tot")
    placed = dealt.withColumn("cum", F.sum("c").over(upto)).join(offsets, ["col", "rank", "pid"])
    # one row per column and rank: a bounded broadcast
    at = F.broadcast(spark.createDataFrame(picks, "col int, rank int, lo long, hi long, part double"))
    end = F.col("off") + F.col("cum")
    hit = lambda r: (end - F.col("c") <= F.col(r)) & (F.col(r) < end)
    ends_of = placed.join(at, ["col", "rank"]).groupBy("col", "rank", "part").agg(
        F.max(F.when(hit("lo"), F.col("v"))).alias("a"), F.max(F.when(hit("hi"), F.col("v"))).alias("b")
    )
    values = ends_of.select("col", "rank", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("q"))
    per_col = values.groupBy("col").agg(*[F.max(F.when(F.col("rank") == j, F.col("q"))).alias(f"q{j}") for j in range(len(probs))])
    names = F.broadcast(spark.createDataFrame(list(enumerate(columns)), "col int, column_name string"))
    named = names.join(per_col, "col", "left")
    qs = {_pct_name(p): F.col(f"q{j}") for j, p in enumerate(probs)}
    if "p25" in qs and "p75" in qs:
        qs["iqr"] = qs["p75"] - qs["p25"]
    structs = [F.struct(F.lit(m).alias("metric"), e.cast("double").alias("value")) for m, e in qs.items()]
    return named.select("column_name", F.explode(F.array(*structs)).alias("q")).select("column_name", "q.metric", "q.value")


def _text_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per non-NULL (column, value), combined map-side."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(quote(c)).alias("t")) for c in columns])
    )
    return (
        df.select(pairs.alias("p"))
        .select("p.*")
        .where(F.col("t").isNotNull())
        .groupBy("column_name", "t")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def top_values(
    df: DataFrame, columns: Sequence[str], k: int = TOP_K, counts: DataFrame | None = None
) -> DataFrame:
    """Top ``k`` values with counts per text column (ties by value).

    ``row_number() <= k`` lets Catalyst put a partial ``WindowGroupLimit``
    before the shuffle, so each task forwards at most k rows per column."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, metric string, value double, text string")
    counts = counts if counts is not None else _text_value_counts(df, columns)
    w = Window.partitionBy("column_name").orderBy(F.col("cnt").desc(), F.col("t").asc())
    top = counts.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)
    return top.select(
        "column_name",
        F.concat(F.lit("top_"), F.col("rk").cast("string")).alias("metric"),
        F.col("cnt").cast("double").alias("value"),
        F.col("t").alias("text"),
    )


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUANTILES, accuracy: int = 10_000
) -> DataFrame:
    """Quantiles from Spark's ``percentile_approx`` sketch: one pass, memory
    bounded by ``accuracy`` per column, rank error about n / accuracy. Values
    are data values (no interpolation)."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, metric string, value double")
    aggs = [
        F.percentile_approx(F.col(quote(c)).cast("double"), list(probs), accuracy).alias(f"q{i}")
        for i, c in enumerate(columns)
    ]
    row = df.agg(*aggs)
    structs = []
    for i, c in enumerate(columns):
        for j, p in enumerate(probs):
            structs.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(_pct_name(p)).alias("metric"),
                    F.col(f"q{i}")[j].alias("value"),
                )
            )
        if 0.25 in probs and 0.75 in probs:
            structs.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit("iqr").alias("metric"),
                    (F.col(f"q{i}")[list(probs).index(0.75)] - F.col(f"q{i}")[list(probs).index(0.25)]).alias("value"),
                )
            )
    return row.select(F.explode(F.array(*structs)).alias("e")).select("e.*")


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    quantiles: Sequence[float] = QUANTILES,
    top_k: int = TOP_K,
    approx_distinct: bool = False,
    approx_quantile_accuracy: int | None = None,
) -> DataFrame:
    """Profile the given columns (default: all) as a long frame.

    ``approx_distinct`` switches ``n_distinct`` to HyperLogLog++ for very
    wide tables, where exact distinct counts expand every row once per
    column. ``approx_quantile_accuracy`` switches the exact distributed
    quantiles to ``percentile_approx`` sketches of that accuracy (one pass,
    bounded memory) when exact values are not needed."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, metric string, value double, text string")
    kinds = {c: _kind(df.schema[c].dataType) for c in columns}
    floats = [c for c in columns if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    df = df.withColumns({c: F.when(~F.isnan(F.col(quote(c))), F.col(quote(c))) for c in floats})
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    # exact distinct counts of numbers come from a value-count job of their own,
    # which keeps them (and an ``Expand``) out of the one-pass aggregate
    text = [c for c, k in kinds.items() if k == "text"]
    shared = bool(numeric and not approx_distinct)
    shared_text = bool(text and top_k and not approx_distinct)
    entries = _entries(df, kinds, approx_distinct, exact_numeric_distinct=shared, exact_text_distinct=shared_text)
    aggs = []
    for i, (_, _, v, t) in enumerate(entries):
        if v is not None:
            aggs.append(v.alias(f"m{i}"))
        if t is not None:
            aggs.append(t.alias(f"t{i}"))
    main = _long(df.agg(*aggs), entries)
    parts = [main]
    if numeric and quantiles and approx_quantile_accuracy is not None:
        no_text = F.lit(None).cast("string").alias("text")
        parts.append(approx_quantiles(df, numeric, quantiles, approx_quantile_accuracy).select("*", no_text))
    elif numeric and quantiles:
        no_text = F.lit(None).cast("string").alias("text")
        parts.append(exact_quantiles(df, numeric, quantiles).select("*", no_text))
    if shared:
        no_text = F.lit(None).cast("string").alias("text")
        parts.append(_distinct_from_counts(_numeric_value_counts(df, numeric), numeric).select("*", no_text))
    if text and top_k:
        # one value-count plan feeds both; Spark reuses its shuffle
        counts = _text_value_counts(df, text)
        parts.append(top_values(df, text, top_k, counts))
        if shared_text:
            # reading ``cnt`` (always > 0) keeps this plan identical to the
            # top-values input, so the shuffle is shared
            per = counts.groupBy("column_name").agg(F.count_if(F.col("cnt") > 0).alias("n"))
            names = F.broadcast(_column_names(df.sparkSession, text))
            parts.append(
                names.join(per, "column_name", "left").select(
                    "column_name",
                    F.lit("n_distinct").alias("metric"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("value"),
                    F.lit(None).cast("string").alias("text"),
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _profile_kind(kind: str):
    def of_kind(df: DataFrame, columns: Sequence[str] | None = None, **kw) -> DataFrame:
        return profile(df, [c for c in (columns or df.columns) if _kind(df.schema[c].dataType) == kind], **kw)

    of_kind.__doc__ = f"``profile`` of the {kind} columns."
    return of_kind


profile_numeric = _profile_kind("numeric")
profile_text = _profile_kind("text")
profile_date = _profile_kind("date")
profile_boolean = _profile_kind("boolean")


def compare_profiles(first: DataFrame, second: DataFrame) -> DataFrame:
    """A10: both profiles side by side on (column, metric) with the
    difference of numeric values. Profiles are small (columns x metrics)."""
    a = first.select(
        "column_name", "metric", F.col("value").alias("value_1"), F.col("text").alias("text_1")
    )
    b = second.select(
        "column_name", "metric", F.col("value").alias("value_2"), F.col("text").alias("text_2")
    )
    return a.join(b, ["column_name", "metric"], "full_outer").withColumn(
        "difference", F.col("value_1") - F.col("value_2")
    )
