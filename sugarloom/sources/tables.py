"""Sources of records: inventories, documents, listings; and sinks that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sugarloom.functions.columns import clean_null, two_formats

#: The inventory's headers and our names for them.
INVENTORY = {
    "ID": "entry_id",
    "Timestamp": "created",
    "Email address": "email",
    "Full GLYCAM name of glycan being submitted.": "glycam_name",
    "How will the data be transferred?": "source_value",
    "What is the aggregated length of the simulations?": "length",
    "What MD package was used for the simulations?": "package",
    "What force field was used for the simulations?": "forcefield",
    "What temperature target was used for the simulations? ": "temperature",
    "What pressure target was used for the simulations?": "pressure",
    "What NaCl concentration was used for the simulations?": "salt",
    "Any comments that should be noted with the submission?": "comments",
    "What is the GlyTouCan ID of the glycan?": "accession",
}
NUMBERS = ("length", "temperature", "pressure", "salt")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Submissions: trimmed texts, numbers where they are, both time formats as UTC text, TODO and null as missing."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    columns = {c: INVENTORY[c] for c in raw.columns if c in INVENTORY}
    out = raw.select(*(F.col(f"`{c}`").alias(n) for c, n in columns.items()))
    values = {n: clean_null(F.col(n), ("TODO",)) for n in columns.values()}
    values |= {n: clean_null(F.col(n)).try_cast("double") for n in NUMBERS if n in values}
    if "created" in values:
        values["created"] = two_formats(F.col("created"))
    return out.select(*(v.alias(n) for n, v in values.items()))


def first_submissions(rows: DataFrame) -> DataFrame:
    """Of the submissions with a time those of each name that come first: by time, then entry_id."""
    at = F.row_number().over(Window.partitionBy("glycam_name").orderBy("created", "entry_id"))
    return rows.where("created is not null and glycam_name is not null").withColumn("_at", at).where("_at = 1").drop("_at")


def submission_records(rows: DataFrame) -> DataFrame:
    """inventory() as records to be inserted: rows without a name fall out, texts are never null, and state and origin are
    those of migrated rows."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    names = [c for c in rows.columns if c not in NUMBERS and c not in ("created", "glycam_name")]
    fixed = [F.lit("manual").alias("source_type"), F.lit("inbucket").alias("status"), F.lit("uploaded").alias("upload_status")]
    created = F.concat("created", F.lit(".000Z")).alias("created")
    return rows.where("glycam_name is not null").select("glycam_name", *map(text, names), *(c for c in NUMBERS if c in rows.columns), created, *fixed)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One text a line, in as many files as Spark makes."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").write.mode("overwrite").text(path)


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(entry_id, columns of schema): one JSON document in each entry's folder; unreadable ones are left out."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    names = [c for c in rows.columns if c != "_corrupt_record"]
    return rows.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("entry_id"), *names, "_corrupt_record").where("_corrupt_record is null").drop("_corrupt_record")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every file below a folder, without contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def molecules(files: DataFrame, pairs: Sequence[tuple[str, str]] = (("{name}.pdb", "{name}.mol2"), ("simulation.pdb", "structure.mol2"))) -> DataFrame:
    """files(path) to (mol_id): folders that hold one of the pairs themselves."""
    parts = F.split("path", "/")
    per = files.select(F.element_at(parts, -2).alias("mol_id"), F.element_at(parts, -1).alias("file")).groupBy("mol_id").agg(F.collect_set("file").alias("files"))
    has = lambda name: F.array_contains("files", F.replace(F.lit(name), F.lit("{name}"), F.col("mol_id")))
    ok = F.lit(False)
    for a, b in pairs:
        ok = ok | (has(a) & has(b))
    return per.where(ok).select("mol_id")


def header_ok(files: DataFrame, required: Sequence[str]) -> DataFrame:
    """files(file, line of its first row) to (file, ok): whether the header has all required columns."""
    need = F.array(*map(F.lit, required))
    return files.select("file", (F.size(F.array_except(need, F.split("line", ","))) == 0).alias("ok"))


def write_by_molecule(df: DataFrame, path: str, key: str = "mol_id", buckets: int = 256) -> None:
    """Parquet under hashed folders, so that names with signs of a pattern never stand in a path."""
    df.withColumn("mol_key", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).write.mode("overwrite").option("compression", "zstd").partitionBy("mol_key").parquet(path)


def read_molecules(spark: SparkSession, path: str, names: Sequence[str] | None = None, key: str = "mol_id", buckets: int = 256) -> DataFrame:
    """What write_by_molecule wrote; with names only their folders are read."""
    df = spark.read.parquet(path)
    if names is not None:
        keys = spark.createDataFrame([(n,) for n in names], f"{key} string").select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).collect()
        df = df.where(F.col("mol_key").isin([r[0] for r in keys]) & F.col(key).isin(list(names)))
    return df.drop("mol_key")


def write_json_lines(df: DataFrame, path: str, order: str) -> None:
    """One document a line, in the order of a key, over as many files as Spark makes."""
    df.orderBy(order).write.mode("overwrite").json(path)
