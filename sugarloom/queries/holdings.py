"""Files and documents of entries over orders and part: an order is a file of its customer, a part an entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.operators import entry_triples, holdings, molecules

QUERIES: dict = {}
SQL: dict = {}
PATHS = (
    "data.json",
    "snfg.svg",
    "glygen.json",
    "other.txt",
    "PDB_format_ATOM/a/x.pdb",
    "PDB_format_HETATM/x.pdb",
    "CHARMM_format_ATOM/y.pdb",
    "GLYCAM_format_ATOM/z.pdb",
    "output/level_1/alpha.pdb",
    "output/level_2/alpha.pdb",
    "output/info.json",
    "PDB_format_ATOM",
)
BODIES = ('{"a": 1}', '{"a": ', "[]")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def pick(options: tuple, k: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in options)), (F.pmod(k, F.lit(len(options))) + 1).cast("int"))


def files(spark: SparkSession, d: str) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select(F.col("o_custkey").alias("entry"), pick(PATHS, F.col("o_orderkey")).alias("path"))


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return files(spark, d).where("path = 'data.json'").select("entry", "path", pick(BODIES, F.col("entry")).alias("body"))


def customers(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("entry"))


F_SQL = """
WITH f AS (SELECT o_custkey AS entry, ['data.json', 'snfg.svg', 'glygen.json', 'other.txt', 'PDB_format_ATOM/a/x.pdb', 'PDB_format_HETATM/x.pdb',
  'CHARMM_format_ATOM/y.pdb', 'GLYCAM_format_ATOM/z.pdb', 'output/level_1/alpha.pdb', 'output/level_2/alpha.pdb', 'output/info.json', 'PDB_format_ATOM'][o_orderkey % 12 + 1] AS path FROM orders)
"""


@query(
    F_SQL
    + """SELECT entry, path, CASE WHEN path = 'output/level_1/alpha.pdb' THEN 'alpha.pdb' ELSE path END AS arcname FROM f
WHERE path NOT IN ('other.txt', 'output/level_2/alpha.pdb', 'output/info.json', 'PDB_format_ATOM')"""
)
def archive_manifest(spark, d):
    return holdings.archive_manifest(files(spark, d))


@query(
    F_SQL.rstrip()
    + """,
h AS (SELECT c_custkey AS entry, coalesce(list(DISTINCT split_part(path, '/', 1)) FILTER (path IS NOT NULL), []) AS tops, bool_or(path = 'data.json') AS data FROM customer LEFT JOIN f ON entry = c_custkey GROUP BY c_custkey),
m AS (SELECT *, list_filter(['PDB_format_HETATM', 'CHARMM_format_HETATM', 'GLYCAM_format_HETATM', 'PDB_format_ATOM', 'CHARMM_format_ATOM', 'GLYCAM_format_ATOM'], lambda x: NOT list_contains(tops, x)) AS lost FROM h),
i AS (SELECT entry, lost, unnest([CASE WHEN NOT list_contains(tops, 'data.json') THEN 'missing_data_json' END, CASE WHEN NOT list_contains(tops, 'snfg.svg') THEN 'missing_snfg_svg' END,
  CASE WHEN data AND entry % 3 = 1 THEN 'invalid_json' END, CASE WHEN NOT list_contains(tops, 'output') THEN 'missing_output_dir' END, CASE WHEN len(lost) > 0 THEN 'missing_format_dirs' END]) AS issue FROM m)
SELECT entry, issue, CASE WHEN issue = 'missing_format_dirs' THEN array_to_string(lost, ', ') ELSE '' END AS detail FROM i WHERE issue IS NOT NULL"""
)
def structure_issues(spark, d):
    return holdings.structure_issues(customers(spark, d), files(spark, d), bodies(spark, d))


STEP_FILES = (
    *(f"embedding/{x}" for x in ("metadata.json", "cluster_summary.parquet", "cluster_members.parquet", "torsions.csv")),
    *(f"output/level_{i}/{x}" for i in (1, 2, 3) for x in ("alpha.pdb", "beta.pdb", "dist.svg")),
    *(f"output/torsion_level_{i}_reps.csv" for i in (1, 2, 3)),
    "output/torsion_all.csv",
    "output/torsion_glycosidic.csv",
    "output/torparts.npz",
)


def step_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every customer has all files but one in ten customers' one; documents and headers are whole but for some."""
    k = F.col("entry")
    c = customers(spark, d)
    every = F.array(*map(F.lit, STEP_FILES))
    lost = F.when(k % 3 == 0, F.element_at(every, (F.pmod(F.floor(k / 3), F.lit(len(STEP_FILES))) + 1).cast("int"))).otherwise("")
    listed = c.select("entry", F.explode(F.filter(every, lambda x: x != lost)).alias("path"))
    levels = F.when(k % 5 == 0, F.lit('[{"level": 1}, {"level": 3}]')).otherwise('[{"level": 1}, {"level": 2}, {"level": 3}]')
    version = F.when(k % 7 == 0, "2").otherwise("3")
    info = F.concat(F.lit('{"schema_version": '), version, F.lit(', "levels": '), levels, F.lit(', "torsions": {"metadata": [{"index": 0}]}}'))
    stats = F.concat(F.lit('{"levels": '), levels, F.lit(', "torsions": {"labels": ["x"], "metadata": '), F.when(k % 11 == 0, "[]").otherwise("[1]"), F.lit(', "family_summary": {"total": 1}}}'))
    meta = F.when(k % 4 == 0, F.lit('{"levels": [1, 2]}')).otherwise('{"levels": [1, 2, 3]}')
    texts = [("embedding/metadata.json", meta), ("embedding/torsion_stats.json", stats), ("embedding/info.json", info), ("output/info.json", info)]
    documents = c.select("entry", F.explode(F.array(*(F.struct(F.lit(p).alias("path"), b.alias("body")) for p, b in texts))).alias("x")).select("entry", "x.*")
    center = F.when(k % 13 == 0, F.array(F.lit("frame"))).otherwise(F.array(F.lit("frame"), F.lit("cluster"), F.lit("center")))
    all_columns = F.array(F.lit("frame"), *(F.lit(f"level_{i}_{x}") for i in (1, 2, 3) for x in ("cluster", "center")))
    first = [("output/pca.csv", F.array(*map(F.lit, ("PC1", "frame", "PC3", "PC2", "cluster")))), ("output/torsion_all.csv", all_columns), ("output/torsion_glycosidic.csv", center)]
    headers = c.select("entry", F.explode(F.array(*(F.struct(F.lit(p).alias("path"), b.alias("columns")) for p, b in first))).alias("x")).select("entry", "x.*")
    return listed, documents, headers


STEPS = """
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_custkey // 3 % 19 END AS lost FROM customer),
s AS (SELECT k, unnest([
  {'step': 'clustering', 'ok': coalesce(lost NOT IN (0, 1, 2), true) AND k % 4 <> 0},
  {'step': 'torsion_stats', 'ok': k % 5 <> 0 AND k % 11 <> 0},
  {'step': 'info', 'ok': k % 5 <> 0 AND k % 7 <> 0},
  {'step': 'structures', 'ok': coalesce(lost NOT IN (4, 5, 7, 8, 10, 11), true)},
  {'step': 'plots', 'ok': coalesce(lost NOT IN (6, 9, 12), true)},
  {'step': 'exports', 'ok': k % 5 <> 0 AND k % 7 <> 0 AND (coalesce(lost = 3, false) OR coalesce(lost < 13, true) AND k % 13 <> 0)}]) AS x FROM c),
t AS (SELECT k AS mol_id, x.step AS step, x.ok AS ok FROM s)
"""


def status(spark: SparkSession, d: str) -> DataFrame:
    return holdings.step_status(customers(spark, d), *step_tables(spark, d))


@query(STEPS + "SELECT mol_id, step, ok FROM t")
def step_status(spark, d):
    """Of each molecule and step whether its files, documents and headers are there and complete."""
    return status(spark, d)


@query(STEPS + "SELECT mol_id, string_agg(step, ',' ORDER BY step) AS steps FROM t WHERE NOT ok GROUP BY mol_id")
def failed_steps(spark, d):
    return holdings.failed_steps(status(spark, d)).select("mol_id", F.array_join("steps", ",").alias("steps"))


@query(STEPS + "SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN bool_and(ok) THEN 'ok' ELSE 'failed' END AS outcome FROM t GROUP BY mol_id) GROUP BY outcome")
def run_totals(spark, d):
    return holdings.run_totals(status(spark, d))


def entry_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return spark.read.parquet(f"{d}/part.parquet").select(
        k.alias("entry"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("tidy"),
        F.lit("1").alias("end_pos"),
        F.col("p_brand").alias("iupac"),
        pick(("G1", "", None), k).alias("accession"),
        pick((None, "GA"), k).alias("accession_alpha"),
        pick(("", None, "GB"), F.floor(k / 2)).alias("accession_beta"),
        pick(("GI", None), F.floor(k / 3)).alias("inventory_accession"),
        F.lit("W0").alias("sequence"),
        F.when(k % 5 > 0, "WA").alias("sequence_alpha"),
        F.when(k % 7 > 0, "WB").otherwise("null").alias("sequence_beta"),
        F.when(k % 4 == 0, "Ox").alias("oxford"),
        (F.col("p_retailprice") / 100).alias("entropy"),
        pick(("1.5", "n/a", None), k).alias("length"),
        *(F.lit(x).alias(x) for x in ("package", "forcefield", "temperature", "pressure", "salt")),
    )


def cluster_shares(spark: SparkSession, d: str) -> DataFrame:
    li = spark.read.parquet(f"{d}/lineitem.parquet").where("l_partkey % 2 = 0")
    n = li.groupBy(F.col("l_partkey").alias("entry"), (F.col("l_linenumber") % 3 + 1).alias("level"), (F.col("l_suppkey") % 4).cast("int").alias("cluster")).agg(F.count("*").alias("n"))
    return n.withColumn("pct", 100.0 * F.col("n") / 7)


def documents(spark: SparkSession, d: str) -> DataFrame:
    return holdings.entry_documents(entry_rows(spark, d), holdings.level_maps(cluster_shares(spark, d)))


R = """
WITH r0 AS (SELECT p_partkey AS entry, p_type, p_brand, ['G1', NULL, NULL][p_partkey % 3 + 1] AS ga0, [NULL, 'GA'][p_partkey % 2 + 1] AS aa0, [NULL, NULL, 'GB'][p_partkey // 2 % 3 + 1] AS ab0,
  ['GI', NULL][p_partkey // 3 % 2 + 1] AS gi FROM part),
r AS (SELECT *, coalesce(ga0, gi) AS ga, coalesce(aa0, ga0, gi) AS aa, coalesce(ab0, ga0, gi) AS ab FROM r0)
"""


@query(
    R.rstrip()
    + """,
n AS (SELECT l_partkey AS entry, l_linenumber % 3 + 1 AS level, l_suppkey % 4 AS cluster, count(*) AS n FROM lineitem WHERE l_partkey % 2 = 0 GROUP BY ALL),
s AS (SELECT entry, level, cluster, CASE WHEN level = 1 THEN round(100.0::DOUBLE * n / 7, 2) ELSE round(100.0::DOUBLE * n / 7, 4) END AS share FROM n)
SELECT r.entry, p_type || 'a1-OH' AS alpha_name, p_brand || '(b1-' AS beta_iupac, ga AS accession, aa AS accession_alpha, ab AS accession_beta,
  coalesce(round(sum(share) FILTER (level = 1), 2), 0) AS main_share, count(*) FILTER (level = 2) AS coverage, count(DISTINCT level) AS levels
FROM r LEFT JOIN s USING (entry) GROUP BY ALL"""
)
def entry_documents(spark, d):
    """The document of each entry: anomers' names, accessions with their fallbacks, clusters by level."""
    doc = documents(spark, d)
    total = F.aggregate(F.map_values("archetype.clusters"), F.lit(0.0), lambda a, x: a + x)
    return doc.select(
        "entry",
        F.col("alpha.glycam").alias("alpha_name"),
        F.col("beta.iupac").alias("beta_iupac"),
        F.col("archetype.glytoucan").alias("accession"),
        F.col("alpha.glytoucan").alias("accession_alpha"),
        F.col("beta.glytoucan").alias("accession_beta"),
        F.round(total, 2).alias("main_share"),
        F.size("archetype.coverage_clusters").alias("coverage"),
        F.coalesce(F.size("archetype.cluster_levels"), F.lit(0)).alias("levels"),
    )


@query(R + "SELECT entry, form, sequence FROM (SELECT entry, unnest(['archetype', 'alpha', 'beta']) AS form, unnest(['W0', CASE WHEN entry % 5 > 0 THEN 'WA' END, CASE WHEN entry % 7 > 0 THEN 'WB' END]) AS sequence, unnest([ga, aa, ab]) AS g FROM r) WHERE sequence IS NOT NULL AND g IS NULL")
def missing_accessions(spark, d):
    return holdings.missing_accessions(documents(spark, d))


@query(
    R.rstrip()
    + """,
f AS (SELECT o_custkey AS entry, o_orderkey % 12 AS p FROM orders),
i AS (SELECT entry, count(*) AS n FROM (SELECT p.p_partkey AS entry, unnest([NOT coalesce(bool_or(f.p = 0), false), NOT coalesce(bool_or(f.p = 1), false), coalesce(bool_or(f.p = 0), false) AND p.p_partkey % 3 = 1,
  NOT coalesce(bool_or(f.p IN (8, 9, 10)), false), true]) AS bad FROM part p LEFT JOIN f ON f.entry = p.p_partkey GROUP BY p.p_partkey) WHERE bad GROUP BY entry)
SELECT 'issues' AS part, sum(n)::BIGINT AS n FROM i UNION ALL SELECT 'consolidated', count(*) FROM part UNION ALL SELECT 'counted', count(*) FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'archives', count(*) FROM f WHERE p NOT IN (3, 9, 10, 11)
UNION ALL SELECT 'missing', sum((ga IS NULL)::INT + (aa IS NULL AND entry % 5 > 0)::INT + (ab IS NULL AND entry % 7 > 0)::INT)::BIGINT FROM r"""
)
def baked(spark, d):
    """How many rows each table of a release has."""
    out = holdings.bake(documents(spark, d), files(spark, d), bodies(spark, d))
    counts = [out[x].agg(F.count("*").alias("n")).select(F.lit(x).alias("part"), "n") for x in ("issues", "consolidated", "archives", "missing")]
    counts.append(out["length"].select(F.lit("counted").alias("part"), F.col("counted").alias("n")))
    all_ = counts[0]
    for c in counts[1:]:
        all_ = all_.unionByName(c)
    return all_


def graph_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of all parts with parts, motifs, termini and clusters of every kind; some lack the alpha form."""
    k = F.col("p_partkey")
    text = lambda x: x.cast("string")
    form = lambda name: F.struct(
        F.lit(name).alias("name"),
        F.when(k % 3 > 0, F.concat(F.lit("G"), text(k))).alias("glytoucan"),
        F.when(k % 2 == 0, F.concat(F.lit("W"), text(k))).alias("wurcs"),
        F.concat(F.lit("I"), text(k)).alias("iupac"),
        F.when(k % 5 == 0, F.lit("C1")).otherwise("").alias("smiles"),
        F.col("p_retailprice").alias("mass"),
        pick(("150", "none", None), k).alias("salt"),
        F.when(k % 4 == 0, F.lit(300)).alias("temperature"),
        F.array(F.struct(text(k % 7).alias("motif"), F.concat(F.lit("M"), text(k % 7)).alias("motif_label"))).alias("motifs"),
        F.array(F.lit("Gal(b1-"), F.lit("")).alias("termini"),
        F.create_map(F.lit("Gal"), F.col("p_size"), F.lit("Man"), F.lit(1)).alias("components"),
        F.create_map(F.lit("Hex"), F.lit(2)).alias("composition"),
        F.create_map(F.lit("Cluster 0"), F.lit(60.5), F.lit("Cluster 1"), F.lit(39.5)).alias("clusters"),
    )
    meta = F.struct(F.array(F.lit("Zed")).alias("common_names"), F.when(k % 2 == 0, "told").otherwise("").alias("description"), F.array(F.lit("N-Glycan"), F.col("p_type")).alias("keywords"))
    # some hundred triples are made of each: dealt first, as they are few bytes
    parts = molecules.dealt(spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_type", "p_size", "p_retailprice"), ["p_partkey"], 10_000)
    return parts.select(k.alias("entry"), form("a").alias("archetype"), F.when(k % 4 > 0, form("b")).alias("alpha"), form("c").alias("beta"), meta.alias("search_meta"))


@query(
    """
WITH f AS (SELECT p_partkey AS k, p_type, unnest(['archetype', 'alpha', 'beta']) AS form FROM part), v AS (SELECT * FROM f WHERE form <> 'alpha' OR k % 4 > 0),
c AS (
  SELECT 'onto:hasVariant' AS p, count(*) AS n FROM v UNION ALL SELECT 'onto:isAnomerOf', count(*) FROM v WHERE form <> 'archetype'
  UNION ALL SELECT 'onto:hasAlphaAnomer', count(*) FROM v WHERE form = 'alpha' UNION ALL SELECT 'owl:sameAs', count(*) FROM v WHERE k % 3 > 0
  UNION ALL SELECT 'rdfg:has_glycosequence', sum(1 + (k % 2 = 0)::INT + (k % 5 = 0)::INT)::BIGINT FROM v
  UNION ALL SELECT 'onto:mass', count(*) FROM v UNION ALL SELECT 'onto:simulationSaltConcentration', count(*) FROM v WHERE k % 3 < 2
  UNION ALL SELECT 'qudt:hasUnit', sum((k % 3 = 0)::INT + (k % 4 = 0)::INT)::BIGINT FROM v
  UNION ALL SELECT 'rdfg:has_motif', count(*) FROM v UNION ALL SELECT 'rdfg:has_terminal_residue', count(*) FROM v
  UNION ALL SELECT 'rdfg:has_cardinality', 2 * count(*) FROM v UNION ALL SELECT 'onto:hasCount', count(*) FROM v
  UNION ALL SELECT 'onto:clusterPercentage', 2 * count(*) FROM v UNION ALL SELECT 'dcterms:subject', count(*) * 2 FROM part
  UNION ALL SELECT 'dcterms:description', count(*) FROM part WHERE p_partkey % 2 = 0
  UNION ALL SELECT 'skos:prefLabel', (SELECT count(*) FROM v) + (SELECT count(DISTINCT k % 7) FROM v) + 1 + 2 + 1 + (SELECT count(DISTINCT p_type) FROM part) + 1
  UNION ALL SELECT 'rdfg:has_sequence', sum(1 + (k % 2 = 0)::INT + (k % 5 = 0)::INT)::BIGINT FROM v)
SELECT p, n FROM c"""
)
def entry_graph(spark, d):
    """How often each of these predicates stands in the triples of all entry documents."""
    found = entry_triples.entry_triples(graph_documents(spark, d)).groupBy("p").agg(F.count("*").alias("n"))
    kept = "onto:hasVariant onto:isAnomerOf onto:hasAlphaAnomer owl:sameAs rdfg:has_glycosequence onto:mass onto:simulationSaltConcentration qudt:hasUnit rdfg:has_motif rdfg:has_terminal_residue rdfg:has_cardinality onto:hasCount onto:clusterPercentage dcterms:subject dcterms:description skos:prefLabel rdfg:has_sequence"
    return found.where(F.col("p").isin(*kept.split()))
