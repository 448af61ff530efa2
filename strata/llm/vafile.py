"""Exact top-k inner-product search with a vector-approximation file.

The approximation file holds every vector as one small cell number per component. A query scans
all cells: the ends of a cell bound each product, so their sums bound the score from both sides (two
matrix products per side). Vectors whose upper bound is below k lower bounds are out. The
exact vectors of the others are read in order of their bound - the most promising ones first,
then only those whose bound still reaches the kth exact score - so the result is certain.

Equal vectors are one class with its k + 1 smallest ids, more can never be returned; so copies
cost one comparison. Queries and cells meet in blocks, a stated query set against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import conf

from . import common
from .registry import query

K = 20
SCALE = 64
CELL_BITS = 6
#: Classes on which the cell borders are fitted (in expectation, by hash); all are indexed.
SAMPLE_ROWS = 20_000
BLOCK_ROWS = 8192
QUERY_BLOCK_ROWS = 512
#: Whole numbers below this are exact in float64; bounds that may pass it are widened by their rounding.
EXACT = float(1 << 53)


@dataclass(frozen=True)
class Cells:
    """Borders of one dimension's cells: ``low[d, c]`` to ``high[d, c]`` are the values in cell c."""

    low: np.ndarray
    high: np.ndarray

    def encode(self, x: np.ndarray) -> np.ndarray:
        codes = np.empty(x.shape, dtype=np.uint8)
        for d in range(x.shape[1]):
            codes[:, d] = np.searchsorted(self.low[d, 1:], x[:, d], side="right")
        return codes

    def bounds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.arange(codes.shape[1])[None, :]
        return self.low[d, codes], self.high[d, codes]


def fit_cells(sample: np.ndarray, least: np.ndarray, most: np.ndarray, bits: int = CELL_BITS) -> Cells:
    """Borders of each dimension: equal-frequency ones from a sample, and where several fall on one whole
    number, the cells so freed halve the widest. The outer cells reach to the true extremes."""
    n = 1 << bits
    low, high = np.full((len(least), n), np.inf), np.zeros((len(least), n))
    for d, (a, b) in enumerate(zip(least, most, strict=True)):
        if b - a < n and max(abs(a), abs(b)) < EXACT:  # a cell for every value
            starts = np.arange(a, b + 1)
        else:
            inner = np.quantile(sample[:, d], np.arange(1, n) / n, method="lower") if len(sample) else []
            starts = np.unique(np.clip(np.append(inner, a), a, b))
            while len(starts) < n:
                width = np.diff(np.append(starts, b + 1))
                widest = int(width.argmax())
                starts = np.insert(starts, widest + 1, starts[widest] + width[widest] // 2)
        low[d, : len(starts)] = starts
        high[d, : len(starts)] = np.append(starts[1:] - 1, b)
    return Cells(low, high)


def score_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of q @ x for every query and every x between low and high."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    lower, upper = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    most = np.maximum(np.abs(low), np.abs(high))
    if len(q) and len(most) and np.abs(q).max(axis=0) @ most.max(axis=0) >= EXACT:
        # Each component, product and partial sum rounds by 2**-53 of its size at most.
        slack = (np.abs(q) @ most.T) * (4 * q.shape[1] + 16) / EXACT
        lower, upper = lower - slack, upper + slack
    return lower, upper


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the exact inner product of whole-number vectors; an error where it is beyond 64 bits."""
    x, y = np.abs(a.astype(np.float64)), np.abs(b.astype(np.float64))
    out = np.einsum("ij,ij->i", a, b)
    for i in np.flatnonzero(np.einsum("ij,ij->i", x, y) >= 2.0**62).tolist():
        score = sum(p * r for p, r in zip(a[i].tolist(), b[i].tolist(), strict=True))
        if not -(1 << 63) <= score < 1 << 63:
            raise OverflowError(f"inner product {score} is beyond 64 bits")
        out[i] = score
    return out


def _matrix(col: pa.Array, dim: int, kind: type = np.float64) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(col), dim)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): whole-number vectors; rows that take no part are left out (see ``top_k``)."""
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    beyond = F.raise_error(F.lit("a vector component is beyond 64 bits after scaling")).cast("long")
    fits = lambda c: (c * scale >= F.lit(-(2.0**63))) & (c * scale < F.lit(2.0**63))
    doubles = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    return doubles.filter(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False))).select(
        "id", F.transform(x, lambda c: F.when(fits(c), F.floor(c * scale).cast("long")).otherwise(beyond)).alias("v")
    )


def _blocks(rows: DataFrame, dim: int, size: int, encode=None) -> DataFrame:
    """(block, cids, data): ids and vectors (or their cells) of up to ``size`` rows packed together."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, size):
                part = b.slice(lo, size)
                v = _matrix(part.column("v"), dim, np.int64)
                data = encode.value.encode(v) if encode else v
                yield pa.RecordBatch.from_pydict({"cids": [part.column("cid").to_numpy().astype("<i8").tobytes()], "data": [data.tobytes()]})

    return rows.select("cid", "v").mapInArrow(pack, "cids binary, data binary")


def _search(classes: DataFrame, asked: DataFrame, dim: int, k: int, bits: int) -> DataFrame:
    """(qcid, cid, score): for every asked class at least all classes that can hold one of its
    k + 1 best rows, with exact scores. ``classes`` and ``asked`` (cid, v) are materialised, of one
    dimension."""
    spark = classes.sparkSession

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most, n = None, None, 0
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column("v"), dim)
                lo, hi, n = v.min(axis=0), v.max(axis=0), n + len(v)
                least, most = (lo, hi) if least is None else (np.minimum(lo, least), np.maximum(hi, most))
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "least": [least.tolist()], "most": [most.tolist()]})

    parts = classes.select("v").mapInArrow(extremes, "n long, least array<double>, most array<double>").collect()  # one row a task
    total = sum(p["n"] for p in parts)
    share = int(min(1.0, SAMPLE_ROWS / total) * 1_000_000)
    sample = classes.filter(F.pmod(F.xxhash64("cid"), F.lit(1_000_000)) < share).select("v").toArrow()
    cells = fit_cells(_matrix(sample.column("v"), dim), np.min([p["least"] for p in parts], axis=0), np.max([p["most"] for p in parts], axis=0), bits)
    held = spark.sparkContext.broadcast(cells)

    # Full blocks: the more vectors are bounded together, the more of them rule each other out.
    n_parts = -(-total // BLOCK_ROWS)
    approximation = common.cut(_blocks(classes.coalesce(n_parts), dim, BLOCK_ROWS, held).withColumn("part", F.spark_partition_id()))
    queries = _blocks(asked.coalesce(-(-asked.count() // QUERY_BLOCK_ROWS)), dim, QUERY_BLOCK_ROWS).select(F.col("cids").alias("qcids"), F.col("data").alias("q"))
    # Every query block visits every part of the approximation file.
    visits = queries.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                qcids, cids = np.frombuffer(r["qcids"], "<i8"), np.frombuffer(r["cids"], "<i8")
                q = np.frombuffer(r["q"], np.int64).reshape(-1, dim).astype(np.float64)
                lower, upper = score_bounds(q, *held.value.bounds(np.frombuffer(r["data"], np.uint8).reshape(-1, dim)))
                # Of k + 2 classes here at least k + 1 are not the query's own.
                certain = np.partition(lower, -(k + 2), axis=1)[:, -(k + 2)] if len(cids) >= k + 2 else np.full(len(qcids), -np.inf)
                row, col = np.nonzero(upper >= certain[:, None])
                first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(qcids)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qcids), pa.array(certain), pa.ListArray.from_arrays(first, pa.array(cids[col])), pa.ListArray.from_arrays(first, pa.array(upper[row, col]))],
                    names=["qcid", "certain", "cids", "uppers"],
                )

    with conf(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}):  # block pairs are large rows
        pairs = approximation.join(visits, F.col("part") == F.col("at")).select("qcids", "q", "cids", "data")
        seen = common.cut(pairs.mapInArrow(scan, "qcid long, certain double, cids array<long>, uppers array<double>"))
    limit = seen.groupBy("qcid").agg(F.max("certain").alias("limit"))
    left = seen.join(limit, "qcid").select("qcid", "limit", F.explode(F.arrays_zip("cids", "uppers")).alias("c"))
    left = common.cut(left.filter("c.uppers >= limit").select("qcid", F.col("c.cids").alias("cid"), F.col("c.uppers").alias("upper")))

    # First the most promising exact vectors; then those that the kth exact score does not rule out.
    order = Window.partitionBy("qcid").orderBy(F.col("upper").desc(), F.col("cid").asc())
    promising = left.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= 2 * (k + 1)).drop("n")
    read = common.cut(_exact(promising, classes, asked, dim))
    best = Window.partitionBy("qcid").orderBy(F.col("score").desc())
    kth = read.filter("cid <> qcid").withColumn("n", F.row_number().over(best)).filter(F.col("n") == k + 1)
    kth = kth.select(F.col("qcid").alias("k_qcid"), F.col("score").alias("kth"))
    rest = left.join(kth, F.col("qcid") == F.col("k_qcid"), "left").filter("kth is null or upper >= kth").select("qcid", "cid")
    rest = rest.join(read.select("qcid", "cid"), ["qcid", "cid"], "left_anti")
    return read.unionByName(_exact(rest, classes, asked, dim))


def _exact(wanted: DataFrame, classes: DataFrame, asked: DataFrame, dim: int) -> DataFrame:
    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = inner_products(_matrix(b.column("v"), dim, np.int64), _matrix(b.column("qv"), dim, np.int64))
            yield pa.RecordBatch.from_arrays([b.column("qcid"), b.column("cid"), pa.array(s)], names=["qcid", "cid", "score"])

    q = asked.select(F.col("cid").alias("q_cid"), F.col("v").alias("qv"))
    both = wanted.select("qcid", "cid").join(classes.select("cid", "v"), "cid").join(q, F.col("qcid") == F.col("q_cid"))
    return both.select("qcid", "cid", "v", "qv").mapInArrow(product, "qcid long, cid long, score long")


def top_k(
    rows: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE, bits: int = CELL_BITS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row for which ``is_query`` (over the column ``id``) holds
    the k rows with the largest integer inner product of floor(scale * x), its own row apart; ties go
    to the smaller id.

    Defined cases: vectors that are null, empty or hold null or non-finite components
    take no part, nor do rows without an id; a finite component that is beyond 64 bits after scaling, and
    an inner product beyond 64 bits that has to be read, is an error; only vectors of equal length are compared; a repeated id is a row like any other, and a repeated query row gets its
    results once per row; fewer than k other rows give all; an empty table gives none.
    """
    spark = rows.sparkSession
    vectors = common.cut(integer_vectors(rows, id_col, vector_col, scale))
    by_id = Window.partitionBy("v").orderBy("id")
    few = vectors.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = common.cut(classes.withColumn("cid", F.monotonically_increasing_id()))
    asking = vectors.filter(is_query).groupBy("id", "v").agg(F.count(F.lit(1)).alias("times"))
    asking = common.cut(asking.join(classes.select("v", F.col("cid").alias("qcid")), "v").select("id", "qcid", "times"))
    asked = common.cut(classes.join(asking.select(F.col("qcid").alias("cid")).distinct(), "cid", "left_semi").select("cid", "v"))
    found = spark.createDataFrame([], "qcid long, cid long, score long")
    for r in asked.select(F.size("v").alias("dim")).distinct().orderBy("dim").collect():  # one space per vector length
        same = F.size("v") == r["dim"]
        found = found.unionByName(_search(classes.filter(same), asked.filter(same), r["dim"], k, bits))
    best = Window.partitionBy("qcid").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    each = found.join(classes.select("cid", "ids"), "cid").select("qcid", "cid", "score", F.explode("ids").alias("vec_id"))
    each = each.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    listed = each.join(asking, "qcid")
    # Its own row is one of the rows of its class with its id.
    twin = Window.partitionBy("id", "qcid", "vec_id", "cid").orderBy("place")
    own = (F.col("vec_id") == F.col("id")) & (F.col("cid") == F.col("qcid")) & (F.row_number().over(twin) == 1)
    others = listed.withColumn("own", own).filter(~F.col("own"))
    rank = F.row_number().over(Window.partitionBy("id", "qcid").orderBy("place"))
    ranked = others.withColumn("rank", rank).filter(F.col("rank") <= k)
    repeated = ranked.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return repeated.select(F.col("id").alias("query_id"), "rank", "vec_id", "score")


OP2_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op2_vector_top_k", OP2_SQL)
def op2_vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(20)) == 0)
