"""Sources, sinks and exports, over files that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.operators import clusters, stats
from sugarloom.operators.staging import new_path, staged
from sugarloom.plans.analysis import analyse, outcome
from sugarloom.plans.analysis import run as analysis_run
from sugarloom.queries import shape
from sugarloom.sources import tables, trajectories

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def coords(spark: SparkSession, d: str) -> DataFrame:
    """Atoms of all frames, with the labels of a structure file."""
    long = shape.frames(spark, d).select("mol_id", "frame", "xyz", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("atom_index"))
    from sugarloom.operators.geometry import atom

    xyz = [v.alias(c) for v, c in zip(atom(F.col("xyz"), F.col("atom_index")), "xyz", strict=True)]
    name = F.element_at(F.array(*map(F.lit, ("C1", "O5", "O4", "C4", "H1", "C6"))), F.col("atom_index") % 6 + 1)
    return long.select("mol_id", "frame", "atom_index", (F.col("atom_index") + 1).alias("serial"), name.alias("name"), F.lit("0MA").alias("res_name"), F.lit("A").alias("chain_id"), (F.col("atom_index") % 2 + 1).cast("int").alias("res_id"), *xyz, F.substring(name, 1, 1).alias("element"))


PARSED = (
    "SELECT vec_id % 5 AS mol_id, vec_id AS frame, (a + 1)::INT AS serial, ['C1', 'O5', 'O4', 'C4', 'H1', 'C6'][a % 6 + 1] AS name, '0MA' AS res_name, (a % 2 + 1)::INT AS res_id, "
    + ", ".join(f"round(embedding[3*a+{k}]::DOUBLE, 3) AS {c}" for k, c in enumerate("xyz", 1))
    + ", ['C1', 'O5', 'O4', 'C4', 'H1', 'C6'][a % 6 + 1][1] AS element FROM embeddings, range(21) t(a)"
)


@query(PARSED)
def structure_lines(spark, d):
    """Structure text written from frames and parsed again, field by field."""
    text = trajectories.model_text(coords(spark, d))
    lines = text.select("mol_id", "frame", F.explode(F.filter(F.split("text", "\n"), lambda x: x.startswith("ATOM"))).alias("line"))
    p = lines.select("mol_id", "frame", trajectories.parsed(F.col("line")).alias("p"))
    return p.select("mol_id", "frame", *(f"p.{c}" for c in ("serial", "name", "res_name", "res_id", "x", "y", "z", "element")))


READ_BACK = f"""WITH a AS ({PARSED}), f AS (SELECT mol_id, frame AS vec_id, row_number() OVER (PARTITION BY mol_id ORDER BY frame) - 1 AS frame FROM (SELECT DISTINCT mol_id, frame FROM a))
SELECT 'm' || a.mol_id || ' [2S]' AS mol_id, f.frame, (a.serial - 1)::INT AS atom_index, a.serial, a.name, a.element, a.res_name, a.res_id, 'A' AS chain_id, round(a.x, 3) + 0.0::DOUBLE AS x, round(a.y, 3) + 0.0::DOUBLE AS y, round(a.z, 3) + 0.0::DOUBLE AS z
FROM a JOIN f ON f.mol_id = a.mol_id AND f.vec_id = a.frame"""


def _files(spark, d) -> str:
    """A structure file for each molecule, its name with brackets and a blank, its models in frame order."""
    text = trajectories.model_text(coords(spark, d))
    folder = new_path(spark, "structures")
    named = text.select(F.concat(F.lit("m"), F.col("mol_id").cast("string"), F.lit(" [2S]")).alias("mol_id"), "frame", "text")
    trajectories.write_models(named, folder)
    return folder


@query(READ_BACK)
def structure_files(spark, d):
    """Frames written as structure files, read back, kept as hashed Parquet and read again: topology and coordinates."""
    read = staged(trajectories.models(spark, f"{trajectories.escaped(_files(spark, d))}/*/*", folders=True), "models")
    folder = new_path(spark, "molecules")
    tables.write_by_molecule(trajectories.frames(read), folder)
    xyz = tables.read_molecules(spark, folder)
    atoms = trajectories.topology(read)
    at = lambda k: F.round(F.element_at("xyz", 3 * F.col("atom_index") + k).cast("double"), 3)
    return xyz.join(atoms, "mol_id").select("mol_id", "frame", "atom_index", "serial", "name", "element", "res_name", "res_id", "chain_id", *(at(k).alias(c) for k, c in enumerate("xyz", 1)))


@query("WITH f AS (SELECT vec_id % 5 AS mol_id, row_number() OVER (PARTITION BY vec_id % 5 ORDER BY vec_id) - 1 AS frame FROM embeddings) SELECT 'm' || mol_id || ' [2S]' AS mol_id, frame, (21 - frame % 3)::INT AS n, 21::INT AS expected FROM f WHERE frame % 3 <> 0")
def uneven_frames(spark, d):
    """Frames that lost atoms on the way into a file, found against the first one's topology."""
    read = trajectories.models(spark, f"{trajectories.escaped(_files(spark, d))}/*/*", folders=True)
    kept = read.withColumn("lines", F.slice("lines", 1, (F.size("lines") - F.col("frame") % 3).cast("int")))
    return trajectories.uneven(kept)


@query(f"SELECT mol_id, count(*) AS n, sum(round(x * 1000)::BIGINT)::BIGINT AS sx FROM ({PARSED}) WHERE element <> 'H' GROUP BY mol_id")
def heavy_atoms(spark, d):
    from sugarloom.operators.geometry import heavy

    c = coords(spark, d).where(heavy(F.col("element")))
    return c.groupBy("mol_id").agg(F.count("*").alias("n"), F.sum(F.round(F.round("x", 3) * 1000).cast("long")).alias("sx"))


@query("WITH a AS (SELECT DISTINCT vec_id % 5 AS mol_id, a::INT AS atom_index FROM embeddings, range(21) t(a)) SELECT mol_id, atom_index FROM a QUALIFY row_number() OVER (PARTITION BY mol_id ORDER BY (atom_index * 7919 + 13) % 101, atom_index) <= 8")
def sampled_atoms(spark, d):
    from sugarloom.operators.geometry import sample_atoms

    a = shape.frames(spark, d).select("mol_id").distinct().select("mol_id", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("atom_index"))
    return sample_atoms(a, 8, (F.col("atom_index") * 7919 + 13) % 101)


@query(shape.VALUES + ", w AS (PIVOT (SELECT mol_id, frame, torsion_id, deg FROM tv) ON torsion_id IN (0, 1, 2, 3, 4, 5) USING first(deg)), m AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, label AS cluster FROM embeddings WHERE vec_id % 3 <> 0), r AS (SELECT mol_id, cluster, min(frame) AS frame FROM m GROUP BY ALL) SELECT w.mol_id, w.frame, \"0\" AS t0, \"1\" AS t1, \"2\" AS t2, \"3\" AS t3, \"4\" AS t4, \"5\" AS t5, coalesce(m.cluster, -1) AS cluster, r.cluster AS center FROM w LEFT JOIN m USING (mol_id, frame) LEFT JOIN r ON r.mol_id = w.mol_id AND r.frame = w.frame")
def torsion_export(spark, d):
    """The wide table of all torsions with a frame's cluster, and the cluster again on its representative."""
    m = shape.points(spark, d).where("frame % 3 <> 0").select("mol_id", "frame", "cluster")
    reps = m.groupBy("mol_id", "cluster").agg(F.min("frame").alias("frame")).withColumnRenamed("cluster", "center")
    wide = shape.values(spark, d).groupBy("mol_id", "frame").pivot("torsion_id", list(range(shape.TORSIONS))).agg(F.first("deg"))
    out = wide.join(m, ["mol_id", "frame"], "left").join(reps, ["mol_id", "frame"], "left")
    return out.select("mol_id", "frame", *(F.col(str(i)).alias(f"t{i}") for i in range(shape.TORSIONS)), F.coalesce("cluster", F.lit(-1)).alias("cluster"), "center")


@query("WITH m AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, label AS cluster, embedding AS e FROM embeddings) SELECT mol_id, frame, " + ", ".join(f"round(e[{i}]::DOUBLE, 6) AS PC{i}" for i in (1, 2, 3)) + ", CASE WHEN frame % 4 = 0 THEN -1 ELSE cluster END AS cluster FROM m")
def component_export(spark, d):
    p = shape.points(spark, d)
    m = p.where("frame % 4 <> 0").select("mol_id", "frame", F.col("cluster").alias("c"))
    return p.join(m, ["mol_id", "frame"], "left").select("mol_id", "frame", *(F.round(a, 6).alias(f"PC{i}") for i, a in enumerate("xyz", 1)), F.coalesce("c", F.lit(-1)).alias("cluster"))


@query("WITH m AS (SELECT vec_id % 5 AS mol_id, label AS cluster, count(*) AS n FROM embeddings GROUP BY ALL) SELECT mol_id, count(*) AS clusters, string_agg('Cluster ' || cluster || '=' || round(100.0 * n / t, 2), ';' ORDER BY cluster) AS summary FROM (SELECT *, sum(n) OVER (PARTITION BY mol_id) AS t FROM m) GROUP BY mol_id")
def level_summary(spark, d):
    from sugarloom.functions.columns import percent

    s = stats.cluster_sizes(shape.points(spark, d))
    item = F.concat(F.lit("Cluster "), F.col("cluster").cast("string"), F.lit("="), percent(F.col("pct"), F.lit(1)).cast("string"))
    return s.groupBy("mol_id").agg(F.count("*").alias("clusters"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cluster", item.alias("s")))), lambda x: x.s), ";").alias("summary"))


@query("SELECT DISTINCT mol AS mol_id FROM (SELECT 'c' || o_custkey AS mol, list(DISTINCT o_orderpriority) AS f FROM orders GROUP BY 1) WHERE list_contains(f, '1-URGENT') AND list_contains(f, '2-HIGH') OR list_contains(f, '3-MEDIUM') AND list_contains(f, '5-LOW')")
def molecule_discovery(spark, d):
    files = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("/db/c"), F.col("o_custkey").cast("string"), F.lit("/"), "o_orderpriority").alias("path"))
    return tables.molecules(files, (("1-URGENT", "2-HIGH"), ("3-MEDIUM", "5-LOW")))


@query("SELECT c_custkey AS file, c_custkey % 3 <> 0 AS ok FROM customer")
def header_gate(spark, d):
    line = F.when(F.col("c_custkey") % 3 == 0, "frame,PC1").otherwise("PC2,frame,PC1,cluster")
    return tables.header_ok(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("file"), line.alias("line")), ["frame", "PC1", "PC2"])


@query(None)
def analysis_documents(spark, d):
    """The whole analysis of all molecules, as one document each."""
    return analyse(shape.frames(spark, d).drop("cluster"), shape.torsions(spark), list(range(21)))["info"]


def _run(spark, d):
    """A run over the frames of the five molecules, three of them at fault: 1 has a frame that lost an atom, 2 a coordinate
    that is no number, 3 torsions of atoms that it has not; and one of few frames."""
    f = shape.frames(spark, d).drop("cluster")
    few = f.where("mol_id = 0 and frame < 20").withColumn("mol_id", F.lit(9).cast("long"))
    first = F.col("frame") < 5
    xyz = F.when(first & (F.col("mol_id") == 1), F.slice("xyz", 1, 60)).when(first & (F.col("mol_id") == 2), F.transform("xyz", lambda x, i: F.when(i == 7, float("nan")).otherwise(x).cast("float"))).otherwise(F.col("xyz"))
    t = shape.torsions(spark)
    t = t.union(t.where("mol_id = 0").withColumn("mol_id", F.lit(9).cast("long"))).withColumn("d", F.when(F.col("mol_id") == 3, F.col("d") + 9).otherwise(F.col("d")))
    return analysis_run(f.withColumn("xyz", xyz).union(few), t, list(range(8)), k=3)


@query(
    """SELECT * FROM (VALUES (0::BIGINT, 'complete', NULL, NULL), (1, 'failed', 'store', 'frames have unlike numbers of atoms'), (2, 'failed', 'store', 'a coordinate is no number'),
  (3, 'failed', 'torsions', 'a torsion names an atom that is not there'), (4, 'complete', NULL, NULL), (9, 'failed', 'entropy', 'too few frames for the neighbours of a point')) v(mol_id, outcome, step, error)
WHERE mol_id = 9 OR mol_id IN (SELECT vec_id % 5 FROM embeddings)"""
)
def run_outcomes(spark, d):
    """Molecules at fault fail with the step and the reason, the others are complete."""
    return outcome(_run(spark, d)["status"])


@query("SELECT vec_id % 5 AS mol_id, 3 AS level, count(*) AS clusters, count(*) AS frames FROM embeddings WHERE vec_id % 5 IN (0, 4) GROUP BY 1 UNION ALL SELECT vec_id % 5, 1, 3, count(*) FROM embeddings WHERE vec_id % 5 IN (0, 4) GROUP BY 1 UNION ALL SELECT vec_id % 5, 2, 5, count(*) FROM embeddings WHERE vec_id % 5 IN (0, 4) GROUP BY 1")
def run_levels(spark, d):
    """How many clusters and frames each level of each document has; up to 512 frames level 3 has one each, and level 2
    has what the entropy asks for, 5 to 128, told as 5."""
    found = _run(spark, d)["info"].select("mol_id", F.explode(F.from_json(F.get_json_object("info", "$.levels"), "array<struct<level: int, n_clusters: int, clusters: array<struct<size: int>>>>")).alias("l"))
    return found.select("mol_id", "l.level", F.when((F.col("l.level") == 2) & F.col("l.n_clusters").between(5, 128), 5).otherwise(F.col("l.n_clusters")).cast("long").alias("clusters"), F.aggregate("l.clusters", F.lit(0).cast("long"), lambda a, x: a + x["size"]).alias("frames"))


@query(None)
def covered_clusters(spark, d):
    """Centres placed until every point lies within a radius, and how many each molecule took."""
    c = clusters.k_centre(shape.points(spark, d), None, radius=0.35)
    return c.groupBy("mol_id").agg(F.countDistinct("cluster").alias("clusters"))
