"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key. Within a source the keys are range-sorted: the leading digits of
the key are the range, the rest orders the rows of a range. A prefix sum over the ranges plus one inside
each range places every document on its source's line of words, and the source's budget cuts that line.
A hot source is spread over as many ranges as any other, and only (source, range) sums meet in a window
over one source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sugarloom.llm.common import staged, table, word_count


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target): the shares of all words by weight, no
    target over `most` times its source's size and the excess reshared by weight.

    Sources are ranked by code point with null last and take the weights in turn. Ordered by the ratio
    of limit to weight, a source is at its limit if an even share of what the earlier ones leave is
    more than that; the first source below its limit gives the final share.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")))
    order = W.orderBy(most * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ranked.select(
        "*",
        F.row_number().over(order).alias("at"),
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        ).alias("share"),
    ).withColumn("below", most * F.col("source_size") / F.col("weight") >= F.col("share"))
    final = F.min_by(F.when(F.col("below"), F.col("share")), F.when(F.col("below"), F.col("at"))).over(everything)
    first = F.min(F.when(F.col("below"), F.col("at"))).over(everything)
    return level.select(
        "source",
        "source_size",
        F.when(F.col("at") < first, (most * F.col("source_size")).cast("double")).otherwise(final * F.col("weight")).alias("target"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: str = "mix", digits: int = 3) -> DataFrame:
    """docs(doc_id, text, source, ...) to (doc_id, source, size, source_size, target, taken).

    taken sums to the whole part of each source's target: whole epochs of the source, then its documents
    in key order until the budget ends; the document at the cut gives its remaining words only. A null
    source is a source of its own, null and empty texts have size 0 and taken 0, repeated rows are rows
    of their own. A row without doc_id gets its key from its text; rows of one key go by doc_id and size, and rows
    alike in all of these are interchangeable. An empty table gives no rows. Other columns, whatever their
    names, are not read. Sources are taken to be few: their sums, a row each, meet in one window.
    """
    ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.col("text").cast("binary"))), F.lit(""))
    key = F.md5(F.concat(F.lit(seed + "/"), ident).cast("binary"))
    sized = staged(docs.select("doc_id", "source", word_count("text").alias("size"), key.alias("key")), "mix")
    sized = sized.withColumns({"line": F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")), "range": F.substring("key", 1, digits)})
    ranges = sized.groupBy("line", "range").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    targets = source_targets(ranges.groupBy("line").agg(F.first("source").alias("source"), F.sum("words").alias("source_size")).drop("line"), weights, most)
    targets = targets.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("line"), "source_size", "target")
    before = W.partitionBy("line").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    placed = ranges.select("line", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")).join(targets, "line")
    inside = W.partitionBy("line", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = sized.withColumn("end", F.sum("size").over(inside)).join(placed, ["line", "range"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - epochs * F.col("source_size")
    start = F.col("offset") + F.col("end") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - start))
    return rows.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix/' || coalesce(doc_id::VARCHAR, 'text:' || md5(text), '')) AS key
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sizes),
level AS (
  SELECT *, row_number() OVER o AS pos, 3 * source_size / weight AS ratio,
    ((SELECT sum(source_size) FROM sizes) - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / ((SELECT sum(weight) FROM ranked) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS share
  FROM ranked WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
cut AS (SELECT min(pos) AS first, arg_min(share, pos) AS share FROM level WHERE ratio >= share),
targets AS (
  SELECT level.source, source_size,
    CASE WHEN pos < cut.first THEN (3 * source_size)::DOUBLE ELSE cut.share * weight END AS target
  FROM level, cut),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
   + greatest(0, least(size, CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END - start)))::BIGINT AS taken
FROM placed
"""
