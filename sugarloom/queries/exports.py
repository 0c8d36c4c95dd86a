"""Wide exports, lookups on cluster results, torsion metadata and structure records, over embeddings, customer and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.operators import exports, molecules, stats
from sugarloom.plans import analysis
from sugarloom.queries import shape

QUERIES: dict = {}
SQL: dict = {}
COLUMNS = tuple((i, f"t{i}") for i in range(shape.TORSIONS))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def memberships(spark: SparkSession, d: str) -> DataFrame:
    """Three levels: labels by their rest, of frames that each level leaves out some of."""
    levels = F.array(*(F.struct(F.lit(i).alias("level"), F.when(F.col("frame") % (4 + i) > 0, (F.col("cluster") % (i + 1)).cast("int")).alias("cluster")) for i in (1, 2, 3)))
    return shape.frames(spark, d).select("mol_id", "frame", F.explode(levels).alias("x")).select("mol_id", "frame", "x.*").where("cluster is not null")


def summary(spark: SparkSession, d: str) -> DataFrame:
    m = memberships(spark, d).groupBy("mol_id", "level", "cluster").agg(F.min("frame").alias("frame"), F.count("*").alias("n"))
    total = m.groupBy("mol_id", "level").agg(F.sum("n").alias("t"), F.count("*").cast("int").alias("n_clusters"))
    out = m.join(total, ["mol_id", "level"]).withColumn("pct", F.round(100.0 * F.col("n") / F.col("t"), 6))
    return out.select("mol_id", "level", "cluster", "n_clusters", F.when(F.col("cluster") < 2, F.col("frame")).alias("frame"), "pct")


M_SQL = """
lv AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, l::INT AS level, (label % (l + 1))::INT AS cluster FROM embeddings, range(1, 4) t(l) WHERE vec_id % (4 + l) > 0),
ms AS (SELECT mol_id, level, cluster, min(frame) AS first, count(*) AS n FROM lv GROUP BY ALL),
su AS (SELECT mol_id, level, cluster, (count(*) OVER w)::INT AS n_clusters, CASE WHEN cluster < 2 THEN first END AS frame, round(100.0::DOUBLE * n / sum(n) OVER w, 6) AS pct FROM ms WINDOW w AS (PARTITION BY mol_id, level))
"""
WIDE = (
    shape.VALUES.rstrip()
    + ", "
    + M_SQL.strip()
    + """,
wide AS (SELECT mol_id, frame, any_value(deg) FILTER (torsion_id = 0) AS t0, any_value(deg) FILTER (torsion_id = 1) AS t1, any_value(deg) FILTER (torsion_id = 2) AS t2,
  any_value(deg) FILTER (torsion_id = 3) AS t3, any_value(deg) FILTER (torsion_id = 4) AS t4, any_value(deg) FILTER (torsion_id = 5) AS t5 FROM tv GROUP BY ALL),
pl AS (SELECT lv.*, CASE WHEN su.frame = lv.frame THEN lv.cluster END AS center FROM lv JOIN su USING (mol_id, level, cluster))
"""
)
LEVEL_COLUMNS = ", ".join(f"coalesce(l{i}.cluster, -1) AS level_{i}_cluster, l{i}.center AS level_{i}_center" for i in (1, 2, 3))
LEVEL_JOINS = " ".join(f"LEFT JOIN pl l{i} ON l{i}.mol_id = w.mol_id AND l{i}.frame = w.frame AND l{i}.level = {i}" for i in (1, 2, 3))


@query(WIDE + f"SELECT w.*, {LEVEL_COLUMNS} FROM wide w {LEVEL_JOINS}")
def torsion_all_levels(spark, d):
    """All torsions of each frame, with its cluster at each level and the cluster again on representatives."""
    return exports.torsion_all(shape.values(spark, d), memberships(spark, d), summary(spark, d), COLUMNS)


@query(WIDE + "SELECT w.mol_id, w.frame, t1, t4, coalesce(a.cluster, -1) AS cluster, a.center FROM wide w LEFT JOIN pl a ON a.mol_id = w.mol_id AND a.frame = w.frame AND a.level = 1")
def torsion_glycosidic(spark, d):
    return exports.torsion_glycosidic(shape.values(spark, d), memberships(spark, d), summary(spark, d), COLUMNS[1::3])


@query(WIDE + "SELECT w.*, su.cluster AS cluster_id, su.pct AS cluster_size_pct FROM wide w JOIN su ON su.mol_id = w.mol_id AND su.frame = w.frame AND su.level = 2")
def torsion_level_reps(spark, d):
    return exports.representative_rows(shape.values(spark, d), summary(spark, d), COLUMNS, 2)


@query(
    "WITH "
    + M_SQL.strip()
    + """
SELECT 'levels' AS call, mol_id, level::DOUBLE AS value FROM (SELECT DISTINCT mol_id, level FROM su)
UNION ALL SELECT 'clusters', mol_id, cluster FROM su WHERE level = 2
UNION ALL SELECT 'n_clusters', mol_id, any_value(n_clusters) FROM su WHERE level = 3 GROUP BY mol_id
UNION ALL SELECT 'representative', mol_id, frame FROM su WHERE level = 2 AND cluster = 1
UNION ALL SELECT 'percentage', mol_id, pct FROM su WHERE level = 2 AND cluster = 1
UNION ALL SELECT 'members', mol_id, frame FROM lv WHERE level = 1 AND cluster = 0
UNION ALL SELECT 'representative_frames', mol_id, frame FROM su WHERE level = 3 AND frame IS NOT NULL
UNION ALL SELECT 'membership_vector', f.mol_id, sum(coalesce(lv.cluster, -1)) FROM (SELECT mol_id, unnest(range(0, max(frame) + 1)) AS frame FROM lv WHERE level = 3 GROUP BY mol_id) f
  LEFT JOIN lv ON lv.mol_id = f.mol_id AND lv.frame = f.frame AND lv.level = 3 GROUP BY f.mol_id"""
)
def cluster_lookups(spark, d):
    """What each lookup call gives, for all molecules at once."""
    r = exports.ClusterResults(summary(spark, d).withColumnRenamed("frame", "representative"), memberships(spark, d))
    calls = {
        "levels": r.levels().withColumnRenamed("level", "value"),
        "clusters": r.clusters(2).withColumnRenamed("cluster", "value"),
        "n_clusters": r.n_clusters(3).withColumnRenamed("n_clusters", "value"),
        "representative": r.representative(2, 1).withColumnRenamed("representative", "value"),
        "percentage": r.percentage(2, 1).withColumnRenamed("pct", "value"),
        "members": r.members(1, 0).withColumnRenamed("frame", "value"),
        "representative_frames": r.representative_frames(3).withColumnRenamed("representative", "value"),
        "membership_vector": r.membership_vector(3).groupBy("mol_id").agg(F.sum("cluster").alias("value")),
    }
    out = None
    for name, df in calls.items():
        one = df.select(F.lit(name).alias("call"), "mol_id", F.col("value").cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT vec_id % 5 AS mol_id, vec_id AS frame, round(embedding[1]::DOUBLE, 6) AS x FROM embeddings WHERE vec_id IN (3, 8, 13, 21) OR vec_id BETWEEN 100 AND 140")
def frame_slices(spark, d):
    """Single frames and a range of them; frames that aren't there give no rows."""
    f = shape.frames(spark, d)
    both = exports.frame_slice(f, [3, 8, 13, 21, 10**9]).unionByName(exports.frame_slice(f, first=100, last=140))
    return both.select("mol_id", "frame", F.round(F.element_at("xyz", 1).cast("double"), 6).alias("x"))


@query("SELECT vec_id AS frame, round(embedding[2]::DOUBLE, 6) AS PC2, round(embedding[3]::DOUBLE, 6) AS PC10 FROM embeddings")
def component_order(spark, d):
    """Columns named PC and a number, in the order of the numbers, without the first."""
    p = shape.points(spark, d).select("frame", F.round("z", 6).alias("PC10"), F.round("y", 6).alias("PC2"), F.round("x", 6).alias("PC1"), F.lit(1).alias("PCX"))
    return p.select("frame", *exports.component_columns(p.columns, 3)[1:])


ATOMS = (("O5", 1), ("C1", 1), ("O4", 2), ("C4", 2), ("C5", 2), ("C6", 2), ("O6", 2), ("H6", 2))
TORSIONS = ((0, 1, 2, 3), (1, 2, 3, 4), (3, 4, 5, 6), (2, 3, 4, 5))


@query(
    """
SELECT c_custkey AS mol_id, t::INT AS torsion_id,
  CASE WHEN t = 3 AND c_custkey % 2 = 0 THEN 'given' ELSE ['O5_1-C1_1-O4_2-C4_2', 'C1_1-O4_2-C4_2-C5_2', 'C4_2-C5_2-C6_2-O6_2', 'O4_2-C4_2-C5_2-C6_2'][t + 1] END AS original_name,
  ['1_2_phi', 'r2_MAN_C4__r2_MAN_O4__r2_MAN_C5__r1_MAN_C1', 'r2_MAN_C5__r2_MAN_C6__r2_MAN_C4__r2_MAN_O6', 'r2_MAN_C4__r2_MAN_C5__r2_MAN_O4__r2_MAN_C6'][t + 1] AS canonical_name,
  ['glycosidic', 'residue_local', 'residue_local', 'residue_local'][t + 1] AS family,
  ['phi', 'bond_O4_C4', 'exocyclic_c6', 'bond_C4_C5'][t + 1] AS subtype, ['phi', NULL, 'exocyclic_c6', NULL][t + 1] AS common_name,
  ['C1-O4', 'O4-C4', 'C5-C6', 'C4-C5'][t + 1] AS central, CASE WHEN t = 0 THEN '1_2_phi' END AS glycosidic_name
FROM customer, range(4) r(t)"""
)
def torsion_metadata(spark, d):
    """The metadata of each torsion of each molecule, assembled from its atoms."""
    # twelve rows are made of each: dealt first, as they are few bytes
    c = molecules.dealt(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("mol_id")), ["mol_id"], 20_000)
    listed = F.array(*(F.struct(F.lit(i).alias("atom_index"), F.lit(n).alias("name"), F.lit(r).alias("res_id"), F.lit("MAN").alias("res_name")) for i, (n, r) in enumerate(ATOMS)))
    atoms = c.select("mol_id", F.explode(listed).alias("x")).select("mol_id", "x.*")
    each = F.array(*(F.struct(F.lit(i).alias("torsion_id"), *(F.lit(v).alias(x) for x, v in zip("abcd", t, strict=True))) for i, t in enumerate(TORSIONS)))
    torsions = c.select("mol_id", F.explode(each).alias("x")).select("mol_id", "x.*").withColumn("original_name", F.when((F.col("torsion_id") == 3) & (F.col("mol_id") % 2 == 0), "given"))
    out = exports.annotated(torsions, atoms)
    return out.select("mol_id", "torsion_id", "original_name", "canonical_name", "family", "subtype", "common_name", F.array_join("central_bond_atoms", "-").alias("central"), "glycosidic_name")


@query(shape.VALUES + "SELECT mol_id, frame, torsion_id, 'C' || torsion_id || '-O' || (torsion_id + 1) || '-C' || (torsion_id + 2) || '-H' || (torsion_id + 3) || ': ' || printf('%.2f', deg) || ' deg' AS text FROM (SELECT * REPLACE (round(deg) + 0.25 AS deg) FROM tv)")
def torsion_descriptions(spark, d):
    at = [F.col("torsion_id") + i for i in range(4)]
    v = shape.values(spark, d).withColumn("deg", F.round("deg") + 0.25)
    return v.select("mol_id", "frame", "torsion_id", exports.torsion_description([F.lit(x) for x in "COCH"], at, F.col("deg")).alias("text"))


@query(
    """SELECT c_custkey, concat_ws(chr(10), 'REMARK    made here', CASE WHEN c_custkey % 3 > 0 THEN 'REMARK    GlyTouCan ID: G' || c_custkey END, CASE WHEN c_custkey % 2 = 0 THEN 'REMARK    IUPAC Name: ' || c_name END,
  'REMARK    Cluster ID: ' || c_nationkey, CASE WHEN c_custkey % 5 > 0 THEN 'REMARK    Cluster Population: ' || (c_custkey % 100) || '.5%' END, 'REMARK    end', 'MODEL     ' || c_nationkey) AS remarks FROM customer"""
)
def header_remarks(spark, d):
    k = F.col("c_custkey")
    text = exports.header_remarks(["made here"], F.when(k % 3 > 0, F.concat(F.lit("G"), k.cast("string"))).otherwise(""), F.when(k % 2 == 0, F.col("c_name")), F.col("c_nationkey"), F.when(k % 5 > 0, k % 100 + 0.5), ["end"])
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", text.alias("remarks"))


@query(
    """
WITH b AS (SELECT c_nationkey AS mol_id, c_custkey % 50 AS a, c_custkey * 7 % 50 AS b FROM customer WHERE c_custkey % 50 <> c_custkey * 7 % 50),
w AS (SELECT DISTINCT mol_id, a, b FROM (SELECT * FROM b UNION ALL SELECT mol_id, b, a FROM b)),
n AS (SELECT mol_id, a AS atom_index, list(b + 1 ORDER BY b) AS near FROM w GROUP BY ALL)
SELECT mol_id, atom_index, array_to_string(list_transform(range(0, len(near), 4), lambda i: 'CONECT' || lpad((atom_index + 1)::VARCHAR, 5, ' ')
  || array_to_string(list_transform(near[i + 1:i + 4], lambda x: lpad(x::VARCHAR, 5, ' ')), '')), chr(10)) AS line FROM n"""
)
def connection_records(spark, d):
    k = F.col("c_custkey")
    bonds = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_nationkey").alias("mol_id"), (k % 50).alias("a"), (k * 7 % 50).alias("b")).where("a <> b")
    atoms = bonds.select("mol_id", F.explode(F.array("a", "b")).alias("atom_index")).distinct().withColumn("serial", F.col("atom_index") + 1)
    return exports.connection_lines(bonds, atoms)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || '-OH' WHEN c_custkey % 3 = 1 AND c_custkey % 2 = 0 THEN 'N' || c_nationkey ELSE c_name END AS name FROM customer")
def entry_names(spark, d):
    k = F.col("c_custkey")
    body = F.when(k % 2 == 0, F.concat(F.lit('{"indexOrderedSequence": "N'), F.col("c_nationkey").cast("string"), F.lit('"}'))).otherwise("{")
    folder = F.when(k % 3 == 0, F.concat("c_name", F.lit("-OH"))).otherwise(F.col("c_name"))
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", exports.glycam_name(folder, F.when(k % 3 < 2, body)).alias("name"))


@query(
    shape.POINTS
    + ", "
    + M_SQL.strip()
    + """,
g AS (SELECT lv.mol_id, lv.level, lv.cluster, p.frame, x, y, z, least(5, count(*) OVER (PARTITION BY lv.mol_id, lv.level, lv.cluster) - 1) AS k, count(*) OVER (PARTITION BY lv.mol_id, lv.level, lv.cluster) AS n FROM lv JOIN p USING (mol_id, frame)),
r AS (SELECT a.mol_id, a.level, a.cluster, a.n, a.k, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS r FROM g a JOIN g b ON a.mol_id = b.mol_id AND a.level = b.level AND a.cluster = b.cluster AND a.frame <> b.frame
  QUALIFY row_number() OVER (PARTITION BY a.mol_id, a.level, a.cluster, a.frame ORDER BY r) = a.k),
h AS (SELECT mol_id, level, cluster, list_sum(list_transform(range(any_value(k), any_value(n)), lambda j: 1.0::DOUBLE / j)) + ln(4 * pi() / 3) + 3 * avg(ln(CASE WHEN r = 0 THEN 1e-12 ELSE r END)) AS e FROM r GROUP BY ALL)
SELECT mol_id, level, round(avg(e), 6) AS entropy FROM h GROUP BY ALL"""
)
def level_entropies(spark, d):
    """The mean over a level's clusters of their points' entropy."""
    return exports.level_entropy(shape.points(spark, d).drop("cluster"), memberships(spark, d)).withColumn("entropy", F.round("entropy", 6))


def info(spark: SparkSession, d: str) -> DataFrame:
    m, own = memberships(spark, d), summary(spark, d)
    values = shape.values(spark, d).drop("cluster").join(m, ["mol_id", "frame"])
    figures = stats.circular(values, ["mol_id", "level", "cluster", "torsion_id"])
    sizes = m.groupBy("mol_id", "level", "cluster").agg(F.count("*").alias("n"))
    variance = shape.points(spark, d).groupBy("mol_id").agg(F.count("*").alias("n")).select("mol_id", F.explode(F.array(F.lit(0.5), F.lit(0.25), F.lit(0.125))).alias("evr")).withColumn("component", F.when(F.col("evr") == 0.5, 1).when(F.col("evr") == 0.25, 2).otherwise(3))
    meta = sizes.select("mol_id").distinct().select("mol_id", F.explode(F.array(*(F.struct(F.lit(i).alias("torsion_id"), F.lit(f"n{i}").alias("canonical_name"), F.lit("glycosidic" if i < 2 else "residue_local").alias("family"), F.lit("phi" if i == 0 else "psi" if i == 1 else "bond").alias("subtype"), F.lit(None).cast("string").alias("common_name")) for i in range(shape.TORSIONS)))).alias("x")).select("mol_id", "x.*")
    entropy = sizes.groupBy("mol_id").agg(F.sum("n").cast("double").alias("entropy"))
    return analysis.info_documents(own.withColumnRenamed("frame", "representative").join(sizes, ["mol_id", "level", "cluster"]), figures, variance, meta, entropy)


@query(
    "WITH "
    + M_SQL.strip()
    + """
SELECT mol_id, 3 AS version, count(DISTINCT level) AS levels, count(*) FILTER (level = 2) AS second, (sum(n) FILTER (level = 1))::BIGINT AS members, 0.875::DOUBLE AS variance,
  2 AS glycosidic, 4 AS bonds, sum(n)::DOUBLE AS entropy FROM su JOIN ms USING (mol_id, level, cluster) GROUP BY mol_id"""
)
def info_documents(spark, d):
    """What stands in the document of each molecule: levels, variance, torsion families and entropy."""
    get = lambda path, kind: F.get_json_object("info", path).cast(kind)
    parsed = F.from_json(F.get_json_object("info", "$.levels"), "array<struct<level: int, n_clusters: long, clusters: array<struct<size: long, torsions: string>>>>")
    at = lambda level: F.get(F.filter(parsed, lambda x: x.level == level), F.lit(0))
    return info(spark, d).select(
        "mol_id",
        get("$.schema_version", "int").alias("version"),
        F.json_array_length(F.get_json_object("info", "$.levels")).cast("long").alias("levels"),
        at(2)["n_clusters"].alias("second"),
        F.aggregate(F.filter(at(1)["clusters"], lambda x: x.torsions.isNotNull()), F.lit(0).cast("long"), lambda a, x: a + x["size"]).alias("members"),
        get("$.pca.cumulative_variance[2]", "double").alias("variance"),
        get("$.torsions.glycosidic", "int").alias("glycosidic"),
        get("$.torsions.family_summary.by_subtype.bond", "int").alias("bonds"),
        get("$.entropy_nats", "double").alias("entropy"),
    )


@query("WITH " + M_SQL.strip() + " SELECT mol_id, level, cluster, 'Cluster ' || cluster AS name, CASE WHEN level = 1 THEN round(pct, 2) ELSE round(pct, 4) END AS share FROM su")
def level_rows(spark, d):
    """The shares of all clusters, read back from the documents."""
    return analysis.level_rows(info(spark, d))
