"""Text sources: multi-model structure files and sectioned bond files, as tables of atoms, bonds and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def escaped(path: str) -> str:
    """A path whose brackets are names, not patterns."""
    return "".join("\\" + c if c in "[]{}" else c for c in path)


def _plain(name: Column, times: int) -> Column:
    """A name as it stood before it became part of an address."""
    for _ in range(times):
        name = F.call_function("url_decode", F.replace(name, F.lit("+"), F.lit("%2B")))
    return name


def models(spark: SparkSession, path: str, folders: bool = False) -> DataFrame:
    """(mol_id, frame, lines array<string>): the models of each file in file order; with folders those of all files in a
    molecule's folder, as write_models() names it, in the order of the files' names.

    Records end at ENDMDL, so a large file is split like any text. What follows the last ENDMDL counts only
    in a file that has none at all. mol_id is the file's name without its ending. No task gets more than a block.
    """
    raw = spark.read.option("lineSep", "ENDMDL").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    atoms = F.filter(F.split("value", "\r?\n"), lambda x: x.startswith("ATOM  ") | x.startswith("HETATM"))
    rows = raw.withColumns({"lines": atoms, "opens": F.col("value").rlike(r"(^|\n)MODEL")}).where(F.size("lines") > 0).drop("value")
    # whether a file is closed by ENDMDL, and what its last record is, from one small row a file
    closed = raw.groupBy("file").agg(F.max(F.struct("block", "at", F.col("value").rlike(r"(^|\n)(ATOM  |HETATM)").alias("atoms"))).alias("m")).select("file", (~F.col("m.atoms")).alias("whole"))
    last = rows.groupBy("file").agg(F.bool_or("opens").alias("some"), F.max(F.struct("block", "at")).alias("last")).join(closed, "file")
    kept = rows.join(last, "file").where(~((F.struct("block", "at") == F.col("last")) & F.col("some") & ~F.col("whole"))).select("file", "block", "at", "lines")
    # frames are numbered within a block of the file, and blocks by the sums of the counts before them
    counts = kept.groupBy("file", "block").agg(F.count("*").alias("n"))
    folder = F.regexp_extract("file", r"/mol_id=([^/]*)/[^/]*$", 1)
    order = W.partitionBy(folder if folders else F.col("file")).orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    numbered = kept.withColumn("i", F.row_number().over(W.partitionBy("file", "block").orderBy("at")) - 1).join(counts.select("file", "block", before.alias("before")), ["file", "block"])
    rows, frame = numbered, F.col("before") + F.col("i")
    # a folder's name is escaped as such, and again in the file's address
    name = _plain(folder, 2) if folders else _plain(F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[^.]*$", ""), 1)
    return rows.select(name.alias("mol_id"), frame.cast("long").alias("frame"), "lines")


def write_models(text: DataFrame, folder: str) -> None:
    """text(mol_id, frame, text) of model_text() as files below folder, in a folder for each molecule. A range of frames is
    a task's and its file's, so a long trajectory is written by many tasks and models(folders=True) reads it in order."""
    rows = text.select(F.col("mol_id").cast("string").alias("mol_id"), "frame", F.regexp_replace("text", "\n$", "").alias("value"))
    ranged = rows.repartitionByRange("mol_id", "frame").sortWithinPartitions("mol_id", "frame")
    ranged.select("mol_id", "value").write.partitionBy("mol_id").text(folder)


def parsed(line: Column) -> Column:
    """struct of an atom line's fixed-width fields; a blank element is the name's first letter."""
    cut = lambda a, b: F.trim(F.substring(line, a + 1, b - a))
    name, element = cut(12, 16), cut(76, 78)
    return F.struct(
        cut(6, 11).try_cast("int").alias("serial"),
        name.alias("name"),
        cut(17, 20).alias("res_name"),
        cut(21, 22).alias("chain_id"),
        F.coalesce(cut(22, 26).try_cast("int"), F.lit(0)).alias("res_id"),
        *(cut(a, b).try_cast("double").alias(c) for c, (a, b) in zip("xyz", ((30, 38), (38, 46), (46, 54)), strict=True)),
        F.when(element != "", element).otherwise(F.upper(F.regexp_extract(name, "[A-Za-z]", 0))).alias("element"),
    )


def topology(models_: DataFrame) -> DataFrame:
    """Atoms of each molecule's first model, numbered from 0."""
    first = models_.where("frame = 0").select("mol_id", F.posexplode("lines").alias("atom_index", "line"))
    return first.select("mol_id", "atom_index", parsed(F.col("line")).alias("p")).select("mol_id", "atom_index", "p.serial", "p.name", "p.element", "p.res_name", "p.res_id", "p.chain_id")


def frames(models_: DataFrame) -> DataFrame:
    """(mol_id, frame, xyz array<float>)."""
    xyz = F.flatten(F.transform("lines", lambda x: F.array(*(parsed(x)[c].cast("float") for c in "xyz"))))
    return models_.select("mol_id", "frame", xyz.alias("xyz"))


def uneven(models_: DataFrame) -> DataFrame:
    """(mol_id, frame, n, expected) of frames whose atoms are more or fewer than the first one's."""
    n = models_.select("mol_id", "frame", F.size("lines").alias("n"))
    first = n.where("frame = 0").select("mol_id", F.col("n").alias("expected"))
    return n.join(first, "mol_id").where("n <> expected")


def sections(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(atoms (mol_id, id, x, y, z), bonds (mol_id, serial1, serial2), files without a section) of @<TRIPOS> files.

    Small files are read whole; lines that don't parse are left out.
    """
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.[^.]*$", "").alias("mol_id"), "value")
    cut = lambda name: F.regexp_extract("value", rf"(?s)@<TRIPOS>{name}[^\n]*\n(.*?)(?:@<TRIPOS>|\z)", 1)
    tokens = lambda name: whole.select("mol_id", F.explode(F.split(cut(name), "\n")).alias("line")).select("mol_id", F.split(F.trim("line"), r"\s+").alias("t"))
    get = lambda i, kind: F.get("t", i - 1).try_cast(kind)
    atoms = tokens("ATOM").select("mol_id", get(1, "int").alias("id"), *(get(i, "double").alias(c) for i, c in ((3, "x"), (4, "y"), (5, "z")))).where("id is not null and x is not null and y is not null and z is not null")
    bonds = tokens("BOND").where(F.size("t") == 4).select("mol_id", get(2, "int").alias("serial1"), get(3, "int").alias("serial2")).where("serial1 is not null and serial2 is not null")
    return atoms, bonds, whole.where((cut("ATOM") == "") | (cut("BOND") == "")).select("mol_id")


def model_text(coords: DataFrame, remarks: Column | None = None) -> DataFrame:
    """coords(mol_id, frame, atom_index, serial, name, res_name, chain_id, res_id, x, y, z, element) to (mol_id, frame,
    text): one MODEL block a frame, atoms in order, remarks first."""
    line = F.format_string("ATOM  %5d %-4s %3s %1s%4d    %8.3f%8.3f%8.3f  1.00  0.00          %2s", "serial", "name", "res_name", "chain_id", "res_id", *(F.col(c).cast("double") for c in "xyz"), "element")
    rows = coords.select("mol_id", "frame", "atom_index", line.alias("line"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("atom_index", "line"))), lambda x: x.line), "\n")
    out = rows.groupBy("mol_id", "frame").agg(body.alias("body"))
    head = F.format_string("MODEL     %4d", (F.col("frame") + 1).cast("long"))
    return out.select("mol_id", "frame", F.concat_ws("\n", head, *([remarks] if remarks is not None else []), "body", F.lit("ENDMDL\n")).alias("text"))
