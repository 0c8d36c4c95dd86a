"""Wide exports, frame slices, and the lookup calls on cluster results.

values(mol_id, frame, torsion_id, deg), memberships(mol_id, level, frame, cluster), representatives(mol_id, level,
cluster, frame, pct): every table holds all molecules.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.functions import names
from sugarloom.operators import molecules
from sugarloom.operators.clusters import membership_vector
from sugarloom.operators.neighbours import knn_entropy
from sugarloom.operators.staging import staged


def component_columns(columns: Sequence[str], n: int | None = None) -> list[str]:
    """The columns PC1, PC2, ... in the order of their numbers, the first n of them."""
    found = sorted((int(m[1]), c) for c in columns if (m := re.fullmatch(r"PC(\d+)", c)))
    return [c for _, c in found[: len(found) if n is None else n]]


def frame_slice(frames: DataFrame, wanted: Sequence[int] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """The wanted frames of each molecule, or those from first to last; frames that aren't there give no rows."""
    out = frames if wanted is None else frames.where(F.col("frame").isin(*wanted) if wanted else F.lit(False))
    out = out if first is None else out.where(F.col("frame") >= first)
    return out if last is None else out.where(F.col("frame") <= last)


def frames_out_of_range(frames: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(mol_id, frame) that no molecule has."""
    return wanted.join(frames.select("mol_id", "frame"), ["mol_id", "frame"], "left_anti")


# -- wide tables ------------------------------------------------------------------------------------------


def wide(values: DataFrame, columns: Sequence[tuple[int, str]]) -> DataFrame:
    """(mol_id, frame, one column a torsion) for the torsions (id, name) given."""
    named = {i: n for i, n in columns}
    out = values.where(F.col("torsion_id").isin(*named)).groupBy("mol_id", "frame").pivot("torsion_id", list(named)).agg(F.first("deg"))
    return out.select("mol_id", "frame", *(F.col(str(i)).alias(n) for i, n in named.items()))


def with_levels(rows: DataFrame, memberships: DataFrame, representatives: DataFrame, levels: Sequence[int]) -> DataFrame:
    """rows(mol_id, frame, ...) with level_N_cluster (-1: none) and level_N_center, the cluster again where the frame is its
    representative. The levels are pivoted first, so that rows are joined once whatever their number."""
    reps = representatives.select("mol_id", "level", "cluster", "frame", F.lit(True).alias("is_rep"))
    told = memberships.where(F.col("level").isin(*levels)).join(reps, ["mol_id", "level", "cluster", "frame"], "left")
    at = [x for i in levels for x in (F.max(F.when(F.col("level") == i, F.col("cluster"))).alias(f"level_{i}_cluster"), F.max(F.when((F.col("level") == i) & F.col("is_rep"), F.col("cluster"))).alias(f"level_{i}_center"))]
    both = rows.join(told.groupBy("mol_id", "frame").agg(*at), ["mol_id", "frame"], "left")
    return both.withColumns({f"level_{i}_cluster": F.coalesce(f"level_{i}_cluster", F.lit(-1)) for i in levels})


def torsion_all(values: DataFrame, memberships: DataFrame, representatives: DataFrame, columns: Sequence[tuple[int, str]], levels: Sequence[int] = (1, 2, 3)) -> DataFrame:
    return with_levels(wide(values, columns), memberships, representatives, levels)


def torsion_glycosidic(values: DataFrame, memberships: DataFrame, representatives: DataFrame, columns: Sequence[tuple[int, str]]) -> DataFrame:
    """The columns of glycosidic torsions with the first level's cluster and center."""
    out = with_levels(wide(values, columns), memberships, representatives, [1])
    return out.withColumnsRenamed({"level_1_cluster": "cluster", "level_1_center": "center"})


def representative_rows(values: DataFrame, representatives: DataFrame, columns: Sequence[tuple[int, str]], level: int) -> DataFrame:
    """(mol_id, frame, cluster_id, cluster_size_pct, one column a torsion) of the level's representatives."""
    reps = representatives.where(F.col("level") == level).select("mol_id", "frame", F.col("cluster").alias("cluster_id"), F.coalesce("pct", F.lit(0.0)).alias("cluster_size_pct"))
    own = values.join(reps.select("mol_id", "frame").distinct(), ["mol_id", "frame"], "left_semi")
    return reps.join(wide(own, columns), ["mol_id", "frame"])


def write_csv(rows: DataFrame, path: str, key: str = "mol_id") -> None:
    """A folder of CSV files with headers for each molecule."""
    rows.repartition(key).sortWithinPartitions(key, "frame").write.partitionBy(key).option("header", True).mode("overwrite").csv(path)


# -- lookups ------------------------------------------------------------------------------------------------


class ClusterResults:
    """Calls on summary(mol_id, level, cluster, n_clusters, representative, pct) and members(mol_id, level, cluster, frame),
    for all molecules at once. A summary without levels has its n_clusters for them."""

    def __init__(self, summary: DataFrame, members: DataFrame | None = None):
        level = lambda df: df if "level" in df.columns else df.withColumn("level", F.col("n_clusters"))
        self.summary, self._members = level(summary), None if members is None else level(members)

    def levels(self) -> DataFrame:
        """(mol_id, level), each once."""
        return self.summary.select("mol_id", "level").distinct()

    def representatives(self, level: int) -> DataFrame:
        return self.summary.where(F.col("level") == level)

    def clusters(self, level: int) -> DataFrame:
        """(mol_id, cluster)."""
        return self.representatives(level).select("mol_id", "cluster")

    def n_clusters(self, level: int) -> DataFrame:
        """(mol_id, n_clusters); no row for a molecule without the level."""
        return self.representatives(level).groupBy("mol_id").agg(F.min("n_clusters").alias("n_clusters"))

    def representative(self, level: int, cluster: int) -> DataFrame:
        """(mol_id, representative)."""
        return self.representatives(level).where(F.col("cluster") == cluster).select("mol_id", "representative")

    def percentage(self, level: int, cluster: int) -> DataFrame:
        """(mol_id, pct)."""
        return self.representatives(level).where(F.col("cluster") == cluster).select("mol_id", "pct")

    def members_table(self, level: int | None = None) -> DataFrame:
        if self._members is None:
            raise ValueError("no membership table")
        return self._members if level is None else self._members.where(F.col("level") == level)

    def members(self, level: int, cluster: int) -> DataFrame:
        """(mol_id, frame)."""
        return self.members_table(level).where(F.col("cluster") == cluster).select("mol_id", "frame")

    def representative_frames(self, level: int) -> DataFrame:
        """(mol_id, representative) of the clusters that have one."""
        return self.representatives(level).where("representative is not null").select("mol_id", "representative")

    def membership_vector(self, level: int) -> DataFrame:
        """(mol_id, frame, cluster) for every frame up to the last, -1 for holes."""
        return membership_vector(self.members_table(level).select("mol_id", "frame", "cluster"))


def level_entropy(points: DataFrame, memberships: DataFrame, k: int = 5) -> DataFrame:
    """(mol_id, level, entropy): the mean over clusters of two members or more of their points' entropy, whose neighbour
    count is k, and one less than the members where those are fewer.

    All clusters of all levels are handled together, once for each neighbour count in use; the points of the clusters are
    written once.
    """
    m = memberships.select("mol_id", "level", "cluster", "frame")
    sizes = m.groupBy("mol_id", "level", "cluster").agg(F.least(F.lit(k), F.count("*") - 1).cast("int").alias("k")).where("k > 0")
    keyed = m.join(sizes, ["mol_id", "level", "cluster"]).join(points, ["mol_id", "frame"]).withColumn("group", F.concat_ws("/", *(F.col(c).cast("string") for c in ("mol_id", "level", "cluster"))))
    keyed = staged(keyed.select("group", "mol_id", "level", "frame", "k", "x", "y", "z"), "levels")
    found = None
    for i in sorted(x["k"] for x in keyed.select("k").distinct().collect()) or [k]:  # k numbers at most
        one = knn_entropy(keyed.where(F.col("k") == i), i, key="group").select("group", "entropy")
        found = one if found is None else found.unionByName(one)
    named = keyed.select("group", "mol_id", "level").distinct()
    return named.join(found, "group").groupBy("mol_id", "level").agg(F.avg("entropy").alias("entropy"))


# -- torsions and structure text ------------------------------------------------------------------------------

#: Atoms a task that torsions are joined with.
ATOM_ROWS = 200_000


def annotated(torsions: DataFrame, atoms: DataFrame) -> DataFrame:
    """torsions(mol_id, torsion_id, a, b, c, d, original_name or null), atoms(mol_id, atom_index, name, res_id, res_name) to
    the metadata of each torsion: names, family, subtype, atoms and residues, and those of the central bond.

    Atoms are dealt by molecule and atom once, for all four joins, and torsions go where the atoms are: what a task sorts
    is ATOM_ROWS atoms at most in the mean, and a molecule of any size is in many tasks."""
    out = torsions.withColumn("original", F.col("original_name") if "original_name" in torsions.columns else F.lit(None).cast("string"))
    placed = molecules.dealt(atoms, ["mol_id", "atom_index"], ATOM_ROWS)
    for x in "abcd":
        one = placed.select("mol_id", F.col("atom_index").alias(x), F.struct("name", F.col("res_id").cast("int").alias("res_id"), "res_name").alias(f"_{x}"))
        out = out.join(one, ["mol_id", x])
    own, ids, residues = ([F.col(f"_{x}.{f}") for x in "abcd"] for f in ("name", "res_id", "res_name"))
    original = F.coalesce("original", F.concat_ws("-", *(F.concat_ws("_", n, r.cast("string")) for n, r in zip(own, ids, strict=True))))
    out = out.withColumn("original", original)
    glycosidic = names.glycosidic_class(F.col("original"))
    linked = ~F.coalesce(glycosidic, F.lit("other_")).startswith("other_")
    tail = F.element_at(F.split(glycosidic, "_"), -1)
    local = names.local_identity(own, ids)
    pick = lambda x, y: F.when(linked, x).otherwise(y)
    return out.select(
        "mol_id",
        "torsion_id",
        F.col("original").alias("original_name"),
        pick(glycosidic, names.canonical_name(own, ids, residues)).alias("canonical_name"),
        pick(F.lit("glycosidic"), local["family"]).alias("family"),
        pick(tail, local["subtype"]).alias("subtype"),
        pick(tail, local["common_name"]).alias("common_name"),
        F.array("a", "b", "c", "d").alias("atom_indices"),
        F.array(*own).alias("atom_names"),
        F.array(*ids).alias("residue_ids"),
        F.array(*residues).alias("residue_names"),
        F.array(own[1], own[2]).alias("central_bond_atoms"),
        F.array(ids[1], ids[2]).alias("central_bond_residues"),
        F.when(linked, glycosidic).alias("glycosidic_name"),
    )


def torsion_description(elements: Sequence[Column], indices: Sequence[Column], deg: Column) -> Column:
    """Elements with their numbers, joined by dashes, and the angle: `C1-O2-C3-C4: 60.00 deg`."""
    label = F.concat_ws("-", *(F.concat(e, i.cast("string")) for e, i in zip(elements, indices, strict=True)))
    return F.format_string("%s: %.2f deg", label, deg.cast("double"))


def header_remarks(lead: Sequence[str], accession: Column, name: Column, cluster: Column, share: Column, tail: Sequence[str] = ()) -> Column:
    """REMARK lines before a structure: the lead, then accession, name, cluster and share where there are any, then the
    tail, and a MODEL line for a cluster. The free text of lead and tail is the caller's."""
    some = lambda x: F.when(x.cast("string") != "", x.cast("string"))
    line = lambda label, x: F.concat(F.lit(f"REMARK    {label}: "), x)
    rows = [
        *(F.lit(f"REMARK    {x}") for x in lead),
        line("GlyTouCan ID", some(accession)),
        line("IUPAC Name", some(name)),
        line("Cluster ID", cluster.cast("string")),
        line("Cluster Population", F.concat(share.cast("string"), F.lit("%"))),
        *(F.lit(f"REMARK    {x}") for x in tail),
        F.concat(F.lit("MODEL     "), cluster.cast("string")),
    ]
    return F.array_join(F.filter(F.array(*rows), lambda x: x.isNotNull()), "\n")


def connection_lines(bonds: DataFrame, atoms: DataFrame) -> DataFrame:
    """(mol_id, atom_index, line): the CONECT record of each bonded atom, bonds(mol_id, a, b) both ways, partners ascending,
    four to a line."""
    serial = atoms.select("mol_id", "atom_index", "serial")
    ways = bonds.select("mol_id", "a", "b").unionByName(bonds.select("mol_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    named = ways.join(serial.withColumnsRenamed({"atom_index": "a", "serial": "sa"}), ["mol_id", "a"]).join(serial.withColumnsRenamed({"atom_index": "b", "serial": "sb"}), ["mol_id", "b"])
    # of one atom's bonds
    near = named.groupBy("mol_id", F.col("a").alias("atom_index"), "sa").agg(F.array_sort(F.collect_list("sb")).alias("near"))
    head = F.format_string("CONECT%5d", "sa")
    starts = F.sequence(F.lit(1), F.size("near"), F.lit(4))
    lines = F.transform(starts, lambda i: F.concat(head, F.array_join(F.transform(F.slice("near", i, 4), lambda x: F.lpad(x.cast("string"), 5, " ")), "")))
    return near.select("mol_id", "atom_index", F.array_join(lines, "\n").alias("line"))


def glycam_name(folder: Column, body: Column) -> Column:
    """A folder's name if it ends in -OH, else the name in its name.json, else the folder's name."""
    return F.when(folder.endswith("-OH"), folder).otherwise(F.coalesce(F.get_json_object(body, "$.indexOrderedSequence"), folder))
