"""Mixing sources to target weights.

Documents get hash-random keys, are range-sorted by (source, key), and distributed prefix sums of their sizes cut each
source exactly at its budget: part totals first, then offsets of the earlier parts, then sums inside a part. A source
that holds most rows is spread over many parts, since the key takes part in the ranges. Sources whose budget exceeds
their size are taken for several epochs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.store import shuffle_partitions, table, written

WORD = r"[^\x20\x09-\x0D]+"


def target_sizes(totals: DataFrame, cap: int = 3, cycle: int = 3) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources in code point order, null last, weigh 1..cycle, repeating. Together they share all sizes; a target stops
    at ``cap`` times its source's size and the excess is reshared by weight. In the order of cap / weight, the first
    source whose share of the rest is within its cap ends the capped ones. One row per source name: a small dimension.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = totals.withColumn("weight", (F.row_number().over(by_name) - 1) % cycle + 1)
    rows = rows.withColumn("most", F.col("source_size") * cap).withColumn("level", F.col("most") / F.col("weight"))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("share", left.cast("double") / weights.cast("double"))
    rows = rows.withColumn("share", F.min(F.when(F.col("share") <= F.col("level"), F.struct("level", "source_size", "share"))).over(whole)["share"])
    target = F.least(F.col("most").cast("double"), F.col("share") * F.col("weight"))
    return rows.select("source", "source_size", F.coalesce(target, F.col("most").cast("double")).alias("target"))


def mix_sources(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source are read): doc_id, source, size, source_size, target, taken.

    size: words of the text (null or empty: 0). taken: words the mix takes, full epochs plus what is left of the
    budget in the order of hash-random keys; the document at the cut gives only the words that are left. Equal
    doc_ids have equal keys and are cut in the order of their sizes. A null source is a source, a null doc_id an id.
    No rows give no rows. Other columns are not read, so their names don't matter.
    """
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))
    sized = written(sized, "mix-sizes")
    parts = shuffle_partitions(docs.sparkSession)
    ranged = sized.repartitionByRange(parts, F.col("source").asc_nulls_last(), "key", "size")
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "mix-ranges")

    blocks = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    targets = target_sizes(blocks.groupBy("source").agg(F.sum("part_size").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before_part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    blocks = blocks.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select("b.source", "part", "before_part", "source_size", "target")
    rows = ranged.alias("r").join(blocks.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.part") == F.col("b.part")))
    rows = rows.select("doc_id", "r.source", "key", "size", "r.part", "before_part", "source_size", "target")

    inside = Window.partitionBy("source", "part").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.col("before_part") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.withColumn("budget", F.floor(F.col("target") + 0.5))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    rest = F.when(F.col("source_size") > 0, F.col("budget") % F.col("source_size")).otherwise(0)
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def repeated(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each document as often as the mix begins it, one that it never begins not at all.

    A document is not split: the one at a source's cut stays whole. One without words is taken as often as its source
    is in full, once in a source that has no words at all. Rows that share a doc_id are taken alike, as often as the
    most taken of them.
    """
    full = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(1)
    whole = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(full)
    copies = mix_sources(docs).groupBy("doc_id").agg(F.max(whole).cast("int").alias("copies")).where("copies > 0")
    rows = docs.alias("d").join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")))
    return rows.select("d.*", F.explode(F.sequence(F.lit(1), "copies")).alias("__copy")).drop("__copy")


SQL4 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS most FROM totals),
levelled AS (
  SELECT *, CAST(most AS DOUBLE) / weight AS level,
         (SELECT sum(source_size) FROM totals) AS total, (SELECT sum(weight) FROM weighed) AS weights FROM weighed),
shared AS (
  SELECT *, CAST(total - coalesce(sum(most) OVER w, 0) AS DOUBLE) / CAST(weights - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS share
  FROM levelled WINDOW w AS (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT share FROM shared WHERE share <= level ORDER BY level, source_size LIMIT 1),
targets AS (
  SELECT source, source_size,
         coalesce(least(CAST(most AS DOUBLE), (SELECT share FROM final) * weight), CAST(most AS DOUBLE)) AS target FROM shared),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before)) ELSE 0 END AS BIGINT) AS taken
FROM placed"""
