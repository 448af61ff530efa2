"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every source gets a word target. Complete epochs come first: a source whose target
is e.g. 2.4 times its size is taken twice whole; the remaining 0.4 is a weighted
sample without replacement. Each document draws the exponential key -ln(u)/w, u
from a hash of the seed and its id, w its quality weight; keys are sorted within
the source and prefix-summed, and the documents whose midpoint lies within the
remainder are taken. So each source ends within half a document of its target.

Only (source, key, id, size) rows are sorted. What comes back from the sort is one
cut per source, which every document is then compared with, so texts are not
shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .registry import query

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17
#: Quality weight of a document by its label; unlabelled documents weigh 1.
QUALITY = {0: 0.5, 1: 2.0}


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size) rows, one row per source.

    Sources in code point order (null last) take the weights in turn and share the
    total size; a target above ``max_epochs`` sizes stops there and the excess goes to
    the others by weight. Sorted by cap/weight the stopped sources come first, so one
    running sum finds the common level of the rest.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    steps = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(steps, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("weight").over(onward))
    found = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)
    s = s.withColumn("level", F.coalesce(found["level"], F.lit(0.0)))
    return s.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def sampling_key(id_col: Column, weight: Column, seed: int = SEED) -> Column:
    """-ln(u)/w with u in (0, 1) from 52 bits of md5(seed:id); a null id counts as ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size: Column | None = None,
    quality: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    prefix: str = "",
) -> DataFrame:
    """The input rows with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` is how often the mix holds the row (0 to ``max_epochs``) and ``taken``
    its words, repeats counted. ``size`` defaults to the words of the text (null: 0);
    ``quality`` is a positive weight (null or not positive: 1).

    Defined cases: a null source is a source of its own, sorted last; a row without
    words takes nothing but complete epochs of zero words; rows with the same id and text
    stand or fall together; an empty table gives no rows; input columns named like
    an output column are replaced (``prefix`` goes before every output name).
    """
    out_names = [prefix + c for c in ("size", "source_size", "target", "copies", "taken")]
    held, back = common.set_aside(c for c in docs.columns if c not in out_names)
    w = F.coalesce(F.when(quality > 0, quality.cast("double")), F.lit(1.0)) if quality is not None else F.lit(1.0)
    keyed = docs.select(
        *held,
        F.col(source_col).cast("string").alias("__mix_source"),
        (size if size is not None else common.word_count(F.col(text_col))).cast("long").alias("__mix_size"),
        sampling_key(F.col(id_col), w, seed).alias("__mix_key"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__mix_id"),
    )
    narrow = common.cut(
        keyed.groupBy(F.col("__mix_source").alias("source"), F.col("__mix_key").alias("key"), F.col("__mix_id").alias("id"))
        .agg(F.sum("__mix_size").alias("size"))
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    # No division by an empty source: it has nothing to take.
    epochs = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(max_epochs))
    targets = common.cut(targets.withColumn("epochs", epochs.cast("int")))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    order = [F.col("key").asc(), F.col("id").asc()]
    walked = common.ranked(narrow.filter("size > 0"), ["source"], order, sum_col="size", prefix="__w")
    t = targets.select(F.col("source").alias("t_source"), "rest")
    chosen = common.bounded_join(walked, t, F.col("source").eqNullSafe(F.col("t_source"))).filter(
        F.col("__w_sum") + F.col("size") / 2 <= F.col("rest")
    )
    cuts = chosen.groupBy("t_source").agg(F.max(F.struct("key", "id")).alias("last"))
    c = cuts.select(F.col("t_source").alias("c_source"), "last")
    plan = common.cut(
        targets.join(c, F.col("source").eqNullSafe(F.col("c_source")), "left").select(
            F.col("source").alias("__plan_source"),
            F.col("source_size").alias("__plan_size"),
            F.col("target").alias("__plan_target"),
            F.col("epochs").alias("__plan_epochs"),
            F.col("last").alias("__plan_last"),
        )
    )
    own = F.struct(F.col("__mix_key").alias("key"), F.col("__mix_id").alias("id"))
    extra = F.coalesce((own <= F.col("__plan_last")) & (F.col("__mix_size") > 0), F.lit(False)).cast("int")
    joined = common.bounded_join(keyed, plan, F.col("__mix_source").eqNullSafe(F.col("__plan_source")))
    return joined.select(
        *back,
        F.col("__mix_size").alias(out_names[0]),
        F.col("__plan_size").alias(out_names[1]),
        F.col("__plan_target").alias(out_names[2]),
        (F.col("__plan_epochs") + extra).alias(out_names[3]),
        (F.col("__mix_size") * (F.col("__plan_epochs") + extra)).alias(out_names[4]),
    )


def quality_weights(labels: DataFrame) -> DataFrame:
    """(label_id, weight) from a labels table, one row per document: the mean
    weight when a document has several labels; rows without id or label are left out."""
    w = F.when(F.col("quality") == 1, F.lit(QUALITY[1])).when(F.col("quality") == 0, F.lit(QUALITY[0]))
    return (
        labels.select(F.col("doc_id").alias("label_id"), w.alias("w"))
        .filter("label_id is not null and w is not null")
        .groupBy("label_id")
        .agg(F.avg("w").alias("weight"))
    )


def mix_documents(docs: DataFrame, labels: DataFrame, prefix: str = "", size_col: str | None = None) -> DataFrame:
    """``mix`` over documents weighed by their labels; texts are counted before the
    join, so a caller that drops the text shuffles only ids and sizes. With ``size_col`` they are
    counted already."""
    size, label, weight = (common.free(c, docs.columns) for c in ("words", "label_id", "weight"))
    sized = docs.withColumn(size, F.col(size_col) if size_col else common.word_count(F.col("text")))
    q = quality_weights(labels).toDF(label, weight)
    # Documents are partitioned by id at every size, whatever the labels weigh.
    joined = sized.join(q.hint("merge"), sized["doc_id"] == q[label], "left").drop(label)
    out = mix(joined, size=F.col(size), quality=F.col(weight), prefix=prefix)
    return out.drop(size, weight)


def apply_mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mixed documents: rows the mix leaves out go, rows it takes n times stand n times."""
    names = docs.columns
    prefix = "mixed_"
    while any(c.lower().startswith(prefix) for c in names):
        prefix = f"_{prefix}"
    mixed = mix_documents(docs, labels, prefix=prefix).filter(F.col(f"{prefix}copies") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{prefix}copies"))).alias(f"{prefix}copy")
    return mixed.select(*[F.col(f"`{c}`") for c in names], copies).drop(f"{prefix}copy")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
q AS (SELECT doc_id, avg(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END) AS w FROM labels
      WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id),
k AS (SELECT d.*, -ln((CAST('0x' || substr(md5('17:' || d.doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
             / coalesce(q.w, 1.0) AS key
      FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM d GROUP BY source),
sw AS (SELECT *, 3 * source_size AS cap,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight FROM s),
lv AS (SELECT *, cap / weight AS ratio,
         ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sw),
t AS (SELECT source, source_size, least(cap, weight * coalesce((SELECT arg_min(level, ratio) FROM lv
         WHERE ratio > level), 0)) AS target FROM lv),
e AS (SELECT *, floor(target / greatest(source_size, 1)) AS epochs FROM t),
w AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, CAST(k.doc_id AS VARCHAR)
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target,
  CAST(size * (epochs + CASE WHEN size > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM w
"""


@query("op9_source_mixing", OP9_SQL)
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", common.word_count(F.col("text")).alias("n"))
    # The mix reads its rows twice; the words are counted once.
    mixed = mix_documents(common.cut(docs), common.table(spark, sf_dir, "labels"), size_col="n")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
