"""Which folder holds a molecule: an index over records, local copies and the folders' own documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.functions.columns import clean_null


def _named(df: DataFrame, *needed: str) -> DataFrame:
    """Rows with a name and the needed values; blanks around names go."""
    out = df.withColumn("name", clean_null(F.col("name")))
    for c in ("name", *needed):
        out = out.where(F.col(c).isNotNull())
    return out


def folder_index(records: DataFrame, folders: DataFrame, local: DataFrame, documents: DataFrame) -> DataFrame:
    """One row (name, folder, rule) of every molecule that a folder is known for.

    records(name, id, accession), folders(folder, id) of those that hold a document, local(name, folder) of complete local
    copies, documents(folder, name, complete) as read from the folders. Rules, the first that holds counts: `record`, a
    record with an accession whose id has a folder; `local`; `document`, a complete document of that name in a folder that
    no name has yet. Several folders by one rule: the least. Rows without a name, and null ids or folders, count for nothing.
    The first two rules are one aggregation; a folder that they give out takes no part in the third.
    """
    known = _named(records, "id").where(clean_null(F.col("accession")).isNotNull())
    by_id = known.select("name", "id").join(folders.select("id", "folder").distinct(), "id")
    options = by_id.select("name", F.lit(1).alias("turn"), "folder").union(_named(local, "folder").select("name", F.lit(2).alias("turn"), "folder"))
    first = options.where("folder is not null").groupBy("name").agg(F.min(F.struct("turn", "folder")).alias("m")).select("name", "m.folder", F.when(F.col("m.turn") == 1, "record").otherwise("local").alias("rule"))
    free = _named(documents, "folder").where("complete").join(folders.select("folder").distinct(), "folder", "left_semi").join(first.select("folder").distinct(), "folder", "left_anti")
    rest = free.join(first, "name", "left_anti").groupBy("name").agg(F.min("folder").alias("folder")).withColumn("rule", F.lit("document"))
    return first.unionByName(rest)


def find_folders(wanted: DataFrame, index: DataFrame, records: DataFrame, folders: DataFrame, documents: DataFrame) -> DataFrame:
    """wanted(name) to (name, folder, rule), a row a name: by the index (its rule); else `id`, the folder of the name's
    record (with or without an accession) if that folder's document is complete and has the name; else `exact`, any
    document of the name, complete or not; else `caseless`, one whose name differs in case only; else nulls. Of several
    folders the least. Each rule sees only the names that those before it leave."""
    docs = _named(documents, "folder").select("folder", "name", "complete")
    left, out = _named(wanted).select("name").distinct(), None
    sure = docs.where("complete").select("folder", "name")
    by_id = _named(records, "id").select("name", "id").join(folders.select("id", "folder"), "id").join(sure, ["folder", "name"], "left_semi")
    offers = (
        ("index", index.select("name", "folder", F.col("rule").alias("said")), "name"),
        ("id", by_id.select("name", "folder"), "name"),
        ("exact", docs.select("name", "folder"), "name"),
        ("caseless", docs.select(F.lower("name").alias("low"), "folder"), "low"),
    )
    for rule, offer, on in offers:
        said = F.first("said").alias("rule") if rule == "index" else F.lit(rule).alias("rule")
        best = offer.groupBy(on).agg(F.min("folder").alias("folder"), said)
        hit = left.withColumn("low", F.lower("name")).join(best, on).select("name", "folder", "rule")
        out = hit if out is None else out.union(hit)
        left = left.join(hit, "name", "left_anti")
    return out.union(left.select("name", F.lit(None).cast("string"), F.lit(None).cast("string")))
