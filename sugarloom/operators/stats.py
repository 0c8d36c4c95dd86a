"""Statistics of angles, clusters and features, as aggregations with partial sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def circular(values: DataFrame, keys: Sequence[str], deg: str = "deg") -> DataFrame:
    """Of each group: n, linear mean and deviation (0 for one value), circular mean and deviation in degrees.

    The circular deviation is 180 where the resultant is 0.
    """
    rad = F.radians(deg)
    g = values.groupBy(*keys).agg(F.count(deg).alias("n"), F.avg(deg).alias("mean"), F.coalesce(F.stddev_samp(deg), F.when(F.count(deg) == 1, 0.0)).alias("sd"), F.sum(F.sin(rad)).alias("s"), F.sum(F.cos(rad)).alias("c"))
    r = F.sqrt(F.col("s") * F.col("s") + F.col("c") * F.col("c")) / F.col("n")
    spread = F.degrees(F.sqrt(F.greatest(F.lit(0.0), -2 * F.log(F.greatest(r, F.lit(1e-12))))))
    return g.select(*keys, "n", "mean", "sd", F.degrees(F.atan2("s", "c")).alias("circ_mean"), F.when(r == 0, F.lit(180.0)).otherwise(spread).alias("circ_sd"), r.alias("resultant"))


def cluster_torsion_stats(values: DataFrame, members: DataFrame, representatives: DataFrame, keys: Sequence[str] = ("mol_id", "cluster", "torsion_id")) -> DataFrame:
    """values(mol_id, frame, torsion_id, deg), members(mol_id, frame, cluster), representatives(mol_id, cluster,
    frame): circular statistics of each torsion in each cluster, and the representative's angle."""
    stats = circular(values.join(members, ["mol_id", "frame"]), keys)
    angles = representatives.join(values, ["mol_id", "frame"]).select("mol_id", "cluster", "torsion_id", F.col("deg").alias("rep_deg"))
    return stats.join(angles, list(keys), "left")


def cluster_sizes(members: DataFrame, keys: Sequence[str] = ("mol_id",)) -> DataFrame:
    """(keys, cluster, n, pct): sizes and their share of all members."""
    n = members.groupBy(*keys, "cluster").agg(F.count("*").alias("n"))
    return n.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(W.partitionBy(*keys)))


def by_size(members: DataFrame, keys: Sequence[str] = ("mol_id",)) -> DataFrame:
    """(keys, cluster, rank): 0 for the largest cluster, ties by the old number."""
    n = members.groupBy(*keys, "cluster").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "cluster")) - 1).drop("n")


def majority(pairs: DataFrame, key: str, label: str, keys: Sequence[str] = ("mol_id",)) -> DataFrame:
    """(keys, key, label, n): the most frequent label of each key, ties to the smallest."""
    n = pairs.groupBy(*keys, key, label).agg(F.count("*").alias("n"))
    first = F.row_number().over(W.partitionBy(*keys, key).orderBy(F.desc("n"), label))
    return n.withColumn("_at", first).where("_at = 1").drop("_at")


def standardised(points: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("mol_id",), sample: bool = False) -> DataFrame:
    """Columns less their mean, over their deviation (of the population, or of the sample); a deviation of 0 is 1.

    Means and deviations are one aggregation, a row a key, joined back."""
    sd = F.stddev_samp if sample else F.stddev_pop
    scale = lambda c: F.when(F.coalesce(sd(c), F.lit(0.0)) == 0, 1.0).otherwise(sd(c))
    moments = points.groupBy(*keys).agg(*(F.avg(c).alias(f"_m_{c}") for c in columns), *(scale(c).alias(f"_s_{c}") for c in columns))
    both = points.join(moments, list(keys))
    return both.select(*(x for x in points.columns if x not in columns), *(((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c) for c in columns))


def cumulative(values: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    return values.withColumn(name, F.sum(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def tightness(values: DataFrame, members: DataFrame) -> DataFrame:
    """(mol_id, tightness): the mean circular deviation over clusters and torsions, one-member clusters as 0."""
    stats = circular(values.join(members, ["mol_id", "frame"]), ["mol_id", "cluster", "torsion_id"])
    return stats.groupBy("mol_id").agg(F.avg(F.when(F.col("n") <= 1, 0.0).otherwise(F.col("circ_sd"))).alias("tightness"))


def counts_by(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(kind, value, n): one pass of grouping sets over the columns, and the total under kind all."""
    sets = table.select(*columns, F.lit(1).alias("_one"))
    long = sets.select(F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns), F.struct(F.lit("all").alias("kind"), F.lit("").alias("value")))).alias("x"))
    return long.select("x.*").where("value is not null").groupBy("kind", "value").agg(F.count("*").alias("n"))


def unique_names(rows: DataFrame, keys: Sequence[str], name: str, index: str, out: str = "export_name") -> DataFrame:
    """Names that occur more than once get their row's index behind two underscores."""
    many = F.count("*").over(W.partitionBy(*keys, name)) > 1
    return rows.withColumn(out, F.when(many, F.concat_ws("__", F.col(name), F.col(index).cast("string"))).otherwise(F.col(name)))


def first_match(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_at", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_at = 1").drop("_at")


def scaling_columns(columns: Sequence[str]) -> list[Column]:
    """Mean and deviation (ddof 1; 0 counts as 1) of each column, for one aggregation."""
    out: list[Column] = []
    for c in columns:
        sd = F.coalesce(F.stddev_samp(c), F.lit(0.0))
        out += [F.avg(c).alias(f"{c}_mean"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"{c}_sd")]
    return out
