"""Files and documents of entries: archives, structure validation, step status, entry documents, and the bake.

files(entry, path) is a listing, paths relative to the entry; documents(entry, path, body) holds the JSON texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an entry's archive holds, and what an entry must have.
MAIN_FILES = ("data.json", "snfg.svg", "glycosmos.json", "glygen.json")
FORMAT_FOLDERS = ("PDB_format_HETATM", "CHARMM_format_HETATM", "GLYCAM_format_HETATM", "PDB_format_ATOM", "CHARMM_format_ATOM", "GLYCAM_format_ATOM")
ARCHIVED_LEVELS = ("level_1",)
REQUIRED_FILES = ("data.json", "snfg.svg")
LEVELS = (1, 2, 3)


def archive_manifest(files: DataFrame) -> DataFrame:
    """(entry, path, arcname): the files of each entry's archive. Main files and format folders keep their paths; those
    of an output level stand at the top."""
    path = F.col("path")
    level = F.regexp_extract(path, "^output/(" + "|".join(ARCHIVED_LEVELS) + ")/(.+)$", 2)
    arcname = F.when(path.isin(*MAIN_FILES) | path.rlike("^(" + "|".join(FORMAT_FOLDERS) + ")/."), path).when(level != "", level)
    return files.select("entry", "path", arcname.alias("arcname")).where("arcname is not null")


def structure_issues(entries: DataFrame, files: DataFrame, documents: DataFrame) -> DataFrame:
    """(entry, issue, detail) of each entry of entries(entry): required files and folders that it lacks, and a data.json
    that is no JSON. detail: the missing format folders."""
    top = F.element_at(F.split("path", "/"), 1)
    has = entries.select("entry").distinct().join(files.select("entry", top.alias("top")).distinct().groupBy("entry").agg(F.collect_set("top").alias("tops")), "entry", "left")
    # of the top names of one entry
    has = has.withColumn("tops", F.coalesce("tops", F.array().cast("array<string>")))
    data = documents.where("path = 'data.json'").groupBy("entry").agg(F.min("body").alias("body"))
    has = has.join(data, "entry", "left")
    missing = F.filter(F.array(*map(F.lit, FORMAT_FOLDERS)), lambda x: ~F.array_contains(F.col("tops"), x))
    lacks = lambda name: ~F.array_contains("tops", F.lit(name))
    issue = lambda when, name, detail=None: F.when(when, F.struct(F.lit(name).alias("issue"), (F.lit("") if detail is None else detail).alias("detail")))
    found = F.array(
        *(issue(lacks(x), "missing_" + x.replace(".", "_")) for x in REQUIRED_FILES),
        issue(F.col("body").isNotNull() & F.try_parse_json("body").isNull(), "invalid_json"),
        issue(lacks("output"), "missing_output_dir"),
        issue(F.size(missing) > 0, "missing_format_dirs", F.array_join(missing, ", ")),
    )
    return has.select("entry", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("entry", "x.issue", "x.detail")


def _levels(path: str) -> Column:
    """The levels that a document names, as ints."""
    return F.transform(F.from_json(F.get_json_object("body", path), "array<string>"), lambda x: F.regexp_extract(x, r"^\{?.*?(-?\d+)", 1).try_cast("int"))


def _level_objects() -> Column:
    return F.transform(F.from_json(F.get_json_object("body", "$.levels"), "array<struct<level:string>>"), lambda x: x.level.try_cast("int"))


def _covers(levels: Column) -> Column:
    return F.coalesce(F.size(F.array_except(F.array(*map(F.lit, LEVELS)), levels)) == 0, F.lit(False))


def _filled(path: str) -> Column:
    """Whether a document has something there: no null, empty text, list or object."""
    got = F.get_json_object("body", path)
    return F.coalesce(~got.isin("", "[]", "{}", "null", "false", "0"), F.lit(False))


def step_status(entries: DataFrame, files: DataFrame, documents: DataFrame, headers: DataFrame) -> DataFrame:
    """(mol_id, step, ok) of each entry and step: whether its outputs are there and complete.

    headers(entry, path, columns array) are the first lines of tables. clustering needs its three files and all
    levels; torsion_stats its blocks and levels; info schema 3, all levels and torsion metadata; structures and
    plots their files at each level; exports the component table and its document and, where torsions were
    computed, the torsion tables with their columns.
    """
    per = files.groupBy("entry").agg(F.collect_set("path").alias("paths"))  # the files of one entry
    whole = lambda name: F.col("path") == name
    info = (F.coalesce(F.get_json_object("body", "$.schema_version").try_cast("int"), F.lit(0)) >= 3) & _covers(_level_objects()) & _filled("$.torsions.metadata")
    told = documents.groupBy("entry").agg(
        F.bool_or(whole("embedding/metadata.json") & _covers(_levels("$.levels"))).alias("d_clusters"),
        F.bool_or(whole("embedding/torsion_stats.json") & _covers(_level_objects()) & _filled("$.torsions.labels") & _filled("$.torsions.metadata") & _filled("$.torsions.family_summary")).alias("d_stats"),
        F.bool_or(whole("embedding/info.json") & info).alias("d_info"),
        F.bool_or(whole("output/info.json") & info).alias("d_out"),
    )
    needs = lambda name, *columns: F.bool_or(whole(name) & (F.size(F.array_except(F.array(*map(F.lit, columns)), F.col("columns"))) == 0))
    level_columns = [f"level_{i}_{x}" for i in LEVELS for x in ("cluster", "center")]
    heads = headers.groupBy("entry").agg(
        needs("output/pca.csv", "frame", "PC1", "PC2", "PC3", "cluster").alias("h_pca"),
        needs("output/torsion_all.csv", "frame", *level_columns).alias("h_all"),
        needs("output/torsion_glycosidic.csv", "frame", "cluster", "center").alias("h_gly"),
    )
    every = entries.select("entry").distinct().join(per, "entry", "left").join(told, "entry", "left").join(heads, "entry", "left")
    there = lambda *names: F.coalesce(F.size(F.array_except(F.array(*map(F.lit, names)), F.col("paths"))) == 0, F.lit(False))
    said = lambda name: F.coalesce(F.col(name), F.lit(False))
    tables = ("output/torsion_all.csv", "output/torsion_glycosidic.csv", "output/torparts.npz", *(f"output/torsion_level_{i}_reps.csv" for i in LEVELS))
    steps = {
        "clustering": there("embedding/metadata.json", "embedding/cluster_summary.parquet", "embedding/cluster_members.parquet") & said("d_clusters"),
        "torsion_stats": said("d_stats"),
        "info": said("d_info"),
        "structures": there(*(f"output/level_{i}/{x}.pdb" for i in LEVELS for x in ("alpha", "beta"))),
        "plots": there(*(f"output/level_{i}/dist.svg" for i in LEVELS)),
        "exports": said("h_pca") & said("d_out") & (~there("embedding/torsions.csv") | there(*tables) & said("h_all") & said("h_gly")),
    }
    listed = F.array(*(F.struct(F.lit(k).alias("step"), v.alias("ok")) for k, v in steps.items()))
    return every.select(F.col("entry").alias("mol_id"), F.explode(listed).alias("x")).select("mol_id", "x.step", "x.ok")


def failed_steps(status: DataFrame) -> DataFrame:
    """(mol_id, steps) of the molecules with steps that aren't ok, by name."""
    return status.where("not ok").groupBy("mol_id").agg(F.array_sort(F.collect_set("step")).alias("steps"))


def run_totals(status: DataFrame) -> DataFrame:
    """(outcome, n): how many molecules have all steps ok, and how many have not."""
    each = status.groupBy("mol_id").agg(F.when(F.bool_and("ok"), "ok").otherwise("failed").alias("outcome"))
    return each.groupBy("outcome").agg(F.count("*").alias("n"))


# -- entry documents ------------------------------------------------------------------------------------


def level_maps(summary: DataFrame) -> DataFrame:
    """summary(entry, level, cluster, pct) to (entry, cluster_levels): map of level_N to its cluster count and the map of
    `Cluster i` to its share, two places at level 1 and four above."""
    share = F.when(F.col("level") == 1, F.round("pct", 2)).otherwise(F.round("pct", 4))
    pair = F.struct("cluster", F.concat(F.lit("Cluster "), F.col("cluster").cast("string")).alias("name"), share.alias("share"))
    per = summary.groupBy("entry", "level").agg(F.array_sort(F.collect_list(pair)).alias("c"))
    one = F.struct(F.size("c").alias("n_clusters"), F.map_from_entries(F.transform("c", lambda x: F.struct(x["name"], x.share))).alias("clusters"))
    keyed = F.struct(F.concat(F.lit("level_"), F.col("level").cast("string")).alias("key"), one.alias("value"))
    by_key = lambda a, b: F.when(a.key < b.key, -1).when(a.key > b.key, 1).otherwise(0)
    return per.groupBy("entry").agg(F.map_from_entries(F.array_sort(F.collect_list(keyed), by_key)).alias("cluster_levels"))


def with_accessions(rows: DataFrame) -> DataFrame:
    """accession from inventory_accession where it is empty, and then accession_alpha and accession_beta from it."""
    some = lambda x: F.when(F.col(x) != "", F.col(x))
    own = F.coalesce(some("accession"), some("inventory_accession"))
    return rows.withColumns({"accession": own, "accession_alpha": F.coalesce(some("accession_alpha"), own), "accession_beta": F.coalesce(some("accession_beta"), own)})


def entry_documents(rows: DataFrame, levels: DataFrame, inventory: Sequence[str] = ("length", "package", "forcefield", "temperature", "pressure", "salt")) -> DataFrame:
    """rows(entry, name, tidy, end_pos, iupac, accession, accession_alpha, accession_beta, inventory_accession, sequence,
    sequence_alpha, sequence_beta, oxford, entropy, *inventory) and level_maps() to (entry, archetype, alpha, beta,
    search_meta): the document of each entry. Anomers get names of their own; missing accessions fall back as
    with_accessions() has it."""
    r = with_accessions(rows).join(levels, "entry", "left")
    clusters = lambda level: F.coalesce(F.try_element_at("cluster_levels", F.lit(level))["clusters"], F.create_map().cast("map<string,double>"))
    archetype = F.struct(
        F.col("entry").alias("ID"),
        "name",
        F.col("tidy").alias("glycam"),
        "iupac",
        F.col("accession").alias("glytoucan"),
        F.col("sequence").alias("wurcs"),
        "oxford",
        "entropy",
        clusters("level_1").alias("clusters"),
        clusters("level_2").alias("coverage_clusters"),
        "cluster_levels",
        *inventory,
    )

    def anomer(letter: str, tag: str) -> Column:
        return F.struct(
            F.col("entry").alias("ID"),
            "name",
            F.concat("tidy", F.lit(letter), "end_pos", F.lit("-OH")).alias("glycam"),
            F.concat("iupac", F.lit(f"({letter}"), "end_pos", F.lit("-")).alias("iupac"),
            F.col(f"accession_{tag}").alias("glytoucan"),
            F.col(f"sequence_{tag}").alias("wurcs"),
        )

    none = F.array().cast("array<string>")
    meta = F.struct(none.alias("common_names"), F.lit("").alias("description"), none.alias("keywords"))
    return r.select("entry", archetype.alias("archetype"), anomer("a", "alpha").alias("alpha"), anomer("b", "beta").alias("beta"), meta.alias("search_meta"))


def missing_accessions(documents: DataFrame) -> DataFrame:
    """(entry, form, sequence) of every form of documents(entry, archetype, alpha, beta) that has a sequence and no
    accession."""
    forms = F.array(*(F.struct(F.lit(x).alias("form"), F.trim(F.col(f"{x}.wurcs")).alias("sequence"), F.trim(F.col(f"{x}.glytoucan")).alias("accession")) for x in ("archetype", "alpha", "beta")))
    long = documents.select("entry", F.explode(forms).alias("f")).select("entry", "f.*")
    return long.where("sequence <> '' and lower(sequence) <> 'null' and (accession is null or accession = '' or lower(accession) = 'null')").drop("accession")


def total_length(documents: DataFrame, length: Column) -> DataFrame:
    """(entries, total, counted, invalid): the sum of the lengths that are numbers."""
    v = F.trim(length.cast("string")).try_cast("double")
    return documents.agg(F.count("*").alias("entries"), F.sum(v).alias("total"), F.count(v).alias("counted"), (F.count("*") - F.count(v)).alias("invalid"))


def consolidated(documents: DataFrame) -> DataFrame:
    """(entry, doc): one JSON line an entry, range-partitioned and sorted by entry, so the files in order are the whole."""
    columns = [c for c in documents.columns if c != "entry"]
    return documents.select("entry", F.to_json(F.struct(*columns)).alias("doc")).repartitionByRange("entry").sortWithinPartitions("entry")


def bake(documents: DataFrame, files: DataFrame, texts: DataFrame) -> dict[str, DataFrame]:
    """The tables of a release: issues, consolidated documents, total simulated length, archive manifest, and forms that
    lack an accession."""
    return {
        "issues": structure_issues(documents.select("entry"), files, texts),
        "consolidated": consolidated(documents),
        "length": total_length(documents, F.col("archetype.length")),
        "archives": archive_manifest(files),
        "missing": missing_accessions(documents),
    }
