"""Durable intermediate tables on the storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset and Spark is local, as
    in tests; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, *by: str) -> DataFrame:
    """df written once and read back: its lineage ends there, it survives lost executors and is computed one time only.
    by: columns whose values get a folder each."""
    spark = df.sparkSession
    path = new_path(spark, label)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def bucketed(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """df as staged() has it, its rows dealt over as many buckets as there are shuffle partitions: groupings and joins
    on these columns read it without another shuffle."""
    spark = df.sparkSession
    path, tasks = new_path(spark, label), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(tasks, *by)  # so each bucket is one file
    dealt.write.bucketBy(tasks, *by).sortBy(*by).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out.stage_path = path
    return out


def drop_stage(df: DataFrame | None) -> None:
    """Remove a stage that nothing reads any more."""
    path = getattr(df, "stage_path", None)
    if path:
        jvm, hadoop = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(hadoop).delete(where, True)
