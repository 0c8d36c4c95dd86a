"""Search metadata of entries over part: a part is an entry, its archetype and anomers made from its fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.operators import metadata

QUERIES: dict = {}
SQL: dict = {}

NAMES = ("Man(a1-3)[Man(a1-6)]Man(b1-4)GlcNAc(b1-4)GlcNAc", "Gal(b1-3)GalNAc", "IdoA(a1-4)GlcNAc", "", None)
ACCESSIONS = ("G40990LB", None, "null", "G71158TZ", "G00000XX", "G53140PB")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def pick(options: tuple, k: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in options)), (F.pmod(k, F.lit(len(options))) + 1).cast("int"))


def entries(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    text = lambda x: x.cast("string")

    def form(name: Column, shift: int, *more: Column) -> Column:
        return F.struct(
            name.alias("name"),
            F.concat("p_type", F.lit("-OH")).alias("glycam"),
            pick(NAMES, k + shift).alias("iupac"),
            F.when((k + shift) % 5 == 0, F.concat(F.lit(" ext "), "p_brand")).alias("iupac_extended"),
            pick(ACCESSIONS, k + shift).alias("glytoucan"),
            F.when((k + shift) % 3 < 2, F.concat(F.lit("W"), text(F.col("p_size")))).alias("wurcs"),
            F.when((k + shift) % 6 == 0, F.concat(F.lit("Ox"), text(F.col("p_size")))).alias("oxford"),
            *more,
        )

    return spark.read.parquet(f"{d}/part.parquet").select(
        F.concat(F.lit("GS"), text(k)).alias("id"),
        form(F.col("p_name"), 0, F.lit("GROMACS").alias("package"), F.lit(300).alias("temperature")).alias("archetype"),
        F.when(k % 4 != 0, form(F.upper("p_name"), 1)).alias("alpha"),
        F.when(k % 4 > 1, form(F.col("p_brand"), 2)).alias("beta"),
        F.when(k % 4 == 1, F.array(F.lit("old"), F.lit("GAG"))).alias("keywords"),
        F.when(k % 3 == 0, F.array(F.lit("Zed"), F.lit("gp1C "))).alias("common_names"),
        F.when(k % 7 == 0, "kept").otherwise("").alias("description"),
    )


def registry(spark: SparkSession, d: str) -> DataFrame:
    """Accessions of the sequences of even sizes, one of them twice."""
    p = spark.read.parquet(f"{d}/part.parquet").where("p_size % 2 = 0").select("p_size").distinct()
    one = p.select(F.concat(F.lit("W"), F.col("p_size").cast("string")).alias("wurcs"), F.concat(F.lit("GR"), F.col("p_size").cast("string")).alias("glytoucan"))
    return one.unionByName(one.where("wurcs = 'W2'").withColumn("glytoucan", F.lit("ZZ"))).unionByName(one.withColumn("glytoucan", F.lit("null")))


def curated(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = spark.read.parquet(f"{d}/part.parquet").where("p_partkey % 5 = 0")
    return rows.select(F.concat(F.lit("GS"), k.cast("string")).alias("id"), F.array(F.lit("mine"), F.lit("")).alias("keywords"), F.array(F.lit(" Own"), F.lit("own")).alias("common_names"), F.when(k % 2 == 0, " told ").alias("description"))


def submissions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = spark.read.parquet(f"{d}/part.parquet").where("p_partkey % 3 = 0")
    return rows.select(F.concat(F.lit("GS"), k.cast("string")).alias("id"), F.lit(" AMBER ").alias("md_package"), F.when(k % 2 == 0, "F1").alias("force_field"), F.lit("").alias("source_type"), F.when(k % 9 == 0, "seen").alias("comments"))


#: The same tables in SQL, a form as a struct of its fields.
E = """
WITH e AS (
  SELECT p_partkey AS k, 'GS' || p_partkey AS id, p_size, p_brand, {forms},
    CASE WHEN p_partkey % 4 = 1 THEN ['old', 'GAG'] END AS keywords,
    CASE WHEN p_partkey % 3 = 0 THEN ['Zed', 'gp1C '] END AS common_names,
    CASE WHEN p_partkey % 7 = 0 THEN 'kept' ELSE '' END AS description
  FROM part)
""".format(
    forms=", ".join(
        f"""CASE WHEN {when} THEN {{'name': {name}, 'glycam': p_type || '-OH',
      'iupac': ['Man(a1-3)[Man(a1-6)]Man(b1-4)GlcNAc(b1-4)GlcNAc', 'Gal(b1-3)GalNAc', 'IdoA(a1-4)GlcNAc', '', NULL][(p_partkey + {s}) % 5 + 1],
      'iupac_extended': CASE WHEN (p_partkey + {s}) % 5 = 0 THEN ' ext ' || p_brand END,
      'glytoucan': ['G40990LB', NULL, 'null', 'G71158TZ', 'G00000XX', 'G53140PB'][(p_partkey + {s}) % 6 + 1],
      'wurcs': CASE WHEN (p_partkey + {s}) % 3 < 2 THEN 'W' || p_size END,
      'oxford': CASE WHEN (p_partkey + {s}) % 6 = 0 THEN 'Ox' || p_size END}} END AS {form}"""
        for form, when, name, s in (("a", "true", "p_name", 0), ("b", "p_partkey % 4 <> 0", "upper(p_name)", 1), ("c", "p_partkey % 4 > 1", "p_brand", 2))
    )
)
LOOKUP = "map {'G40990LB': 'GA2', 'G71158TZ': 'GQ1b', 'G53140PB': 'GT1c'}"
COMMON = f"list_sort(list_distinct(list_filter([a.oxford, {LOOKUP}[a.glytoucan], {LOOKUP}[b.glytoucan], {LOOKUP}[c.glytoucan]], lambda x: x IS NOT NULL)))"
FIRSTS = "list_transform(list_filter(list_zip({x}, range(1, len({x}) + 1)), lambda p: list_position(list_transform({x}, lambda v: lower(v)), lower(p[1])) = p[2]), lambda p: p[1])"


@query(E + f"SELECT id, array_to_string({COMMON}, '|') AS names FROM e")
def common_names(spark, d):
    e = entries(spark, d)
    return e.select("id", F.array_join(metadata.common_names(e), "|").alias("names"))


@query(
    E
    + """SELECT id, form, field, trim(v) AS value FROM (
  SELECT id, unnest(['archetype', 'alpha', 'beta']) AS form, unnest([a, b, c]) AS f FROM e), LATERAL (
  SELECT unnest(['name', 'glycam', 'iupac', 'iupac_extended', 'glytoucan', 'wurcs', 'oxford']) AS field,
    unnest([f.name, f.glycam, f.iupac, f.iupac_extended, f.glytoucan, f.wurcs, f.oxford]) AS v) WHERE trim(v) <> ''"""
)
def name_variants(spark, d):
    e = entries(spark, d)
    forms = e.select("id", F.explode(metadata.name_variants(e)).alias("form", "fields"))
    return forms.select("id", "form", F.explode("fields").alias("field", "value"))


ALL_NAMES = "[" + ", ".join(f"{f}.{x}" for f in "abc" for x in ("name", "glycam", "iupac", "iupac_extended", "oxford")) + "]"
ALIASES = f"f AS (SELECT *, {COMMON} AS cn FROM e), g AS (SELECT *, list_filter(list_transform(list_concat({ALL_NAMES}, cn), lambda x: trim(x)), lambda x: x <> '') AS every FROM f)"


@query(E.rstrip() + ", " + ALIASES + f" SELECT id, array_to_string({FIRSTS.format(x='every')}, '|') AS aliases FROM g")
def aliases(spark, d):
    e = entries(spark, d)
    return e.select("id", F.array_join(metadata.aliases(e, metadata.common_names(e)), "|").alias("aliases"))


BRANCHED = (
    "Gal(b1-4)[Fuc(a1-3)]GlcNAc",
    "Fuc(a1-3)[Gal(b1-4)]GlcNAc",
    "Man(a1-3)[Gal(b1-4)[Fuc(a1-3)]GlcNAc(b1-2)Man(a1-6)]Man",
    "Fuc(a1-3)[Gal(b1-4)]GlcNAc(b1-2)Man(a1-6)[Man(a1-3)]Man",
    "Fuc(a1-3)Gal(b1-4)GlcNAc",
    "Gal(b1-4)[Fuc(a1-3)]Gal",
)


@query("SELECT p_partkey, ['X1', 'X1', 'X2', 'X2', NULL, NULL][p_partkey % 6 + 1] AS oxford FROM part")
def short_notations(spark, d):
    """Names found in a catalogue whichever way their branches are written; the first entry of a structure counts."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", pick(BRANCHED, F.col("p_partkey")).alias("iupac"))
    catalogue = spark.createDataFrame([(1, "X1", BRANCHED[1]), (2, "X2", BRANCHED[3]), (3, "X3", BRANCHED[0]), (4, "X4", BRANCHED[4] + "x")], "place int, notation string, condensed string")
    return metadata.short_notation(p, catalogue).select("p_partkey", "oxford")


def updated(spark: SparkSession, d: str) -> DataFrame:
    return metadata.updated(entries(spark, d), registry(spark, d), curated(spark, d), submissions(spark, d))


FIXED = "CASE WHEN {f} IS NULL THEN NULL WHEN coalesce({f}.glytoucan, 'null') <> 'null' THEN {f}.glytoucan WHEN {f}.wurcs IS NOT NULL AND p_size % 2 = 0 THEN 'GR' || p_size ELSE {f}.glytoucan END"
SAID = "CASE WHEN coalesce({f}.glytoucan, 'null') <> 'null' THEN 'given' WHEN {f}.wurcs IS NULL THEN 'unasked' WHEN p_size % 2 = 0 THEN 'resolved' ELSE 'still_missing' END"
UPDATED = (
    E.rstrip()
    + f""",
r AS (SELECT *, {FIXED.format(f="a")} AS ga, {FIXED.format(f="b")} AS gb, {FIXED.format(f="c")} AS gc,
    coalesce(common_names, []) AS cn0,
    [['N-Glycan', 'Oligomannose'], ['O-Glycan'], ['GAG'], [], []][k % 5 + 1] AS ruled FROM e),
s AS (SELECT *, CASE WHEN a.iupac <> '' THEN list_sort(list_distinct(list_concat(coalesce(keywords, []), ruled))) ELSE keywords END AS kw1,
    list_sort(list_distinct(list_concat(cn0, list_filter([a.oxford, {LOOKUP}[ga], {LOOKUP}[gb], {LOOKUP}[gc]], lambda x: x IS NOT NULL)))) AS cn1 FROM r),
u AS (SELECT *, list_concat(CASE WHEN k % 5 = 0 THEN ['mine'] ELSE [] END, CASE WHEN k % 3 = 0 THEN ['MD:AMBER'] ELSE [] END, CASE WHEN k % 6 = 0 THEN ['FF:F1'] ELSE [] END) AS extra FROM s),
v AS (SELECT *, CASE WHEN len(extra) > 0 THEN list_sort(list_distinct(list_concat(coalesce(kw1, []), extra))) ELSE kw1 END AS kw2,
    CASE WHEN k % 5 = 0 THEN list_sort(list_distinct(list_concat(cn1, ['Own']))) ELSE cn1 END AS cn2 FROM u),
w AS (SELECT *, CASE WHEN k % 5 <> 0 AND k % 3 <> 0 THEN description WHEN k % 10 = 0 THEN 'told' WHEN description <> '' THEN description
  ELSE concat_ws(' ', CASE WHEN a.iupac <> '' THEN id || ' is a glycan with IUPAC notation ' || a.iupac || '.' END,
    'Classified as: ' || nullif(array_to_string(list_filter(kw2, lambda x: x IN ('N-Glycan', 'Oligomannose', 'O-Glycan', 'GAG')), ', '), '') || '.',
    'Simulated with MD package GROMACS, 300K.',
    'Also known as: ' || nullif(array_to_string(cn2, ', '), '') || '.',
    CASE WHEN k % 9 = 0 THEN 'seen' END) END AS d2 FROM v)
"""
)


@query(UPDATED + "SELECT id, array_to_string(kw2, '|') AS keywords, array_to_string(cn2, '|') AS common_names, d2 AS description, ga AS accession FROM w")
def metadata_update(spark, d):
    """All entries updated in one plan: accessions by sequence, keywords by rule, names, and what curated tables add."""
    return updated(spark, d).select("id", F.array_join("keywords", "|").alias("keywords"), F.array_join("common_names", "|").alias("common_names"), "description", F.col("archetype.glytoucan").alias("accession"))


@query(
    E
    + f"""SELECT what, count(*) AS n FROM (SELECT unnest(['entries', {SAID.format(f="a")}, {SAID.format(f="b")}, {SAID.format(f="c")}]) AS what FROM e) GROUP BY what"""
)
def metadata_counts(spark, d):
    return metadata.update_counts(metadata.repaired(entries(spark, d), registry(spark, d)))


NAMES_SQL = "list_filter(list_transform(cn2, lambda x: trim(x)), lambda x: x <> '')"
PAYLOAD = (
    UPDATED.rstrip()
    + f""", x AS (SELECT *, {FIRSTS.format(x="n0")} AS n1 FROM (SELECT *, {NAMES_SQL} AS n0 FROM w)),
y AS (SELECT *, list_filter(list_transform(list_concat({ALL_NAMES}, n1), lambda x: trim(x)), lambda x: x <> '') AS every FROM x)
"""
)


@query(
    PAYLOAD
    + f"""SELECT id, coalesce(a.oxford, n1[1], trim(a.iupac_extended), nullif(a.iupac, ''), a.name) AS canonical_name, a.name AS glycam_name,
  coalesce(trim(a.iupac_extended), a.iupac, '') AS iupac_name, coalesce(ga, '') AS accession,
  array_to_string({FIRSTS.format(x="every")}, '|') AS aliases, array_to_string(n1, '|') AS common_names, array_to_string(coalesce(kw2, []), '|') AS keywords,
  d2 AS description, 1 + (k % 4 <> 0)::INT + (k % 4 > 1)::INT AS variants FROM y"""
)
def metadata_payload(spark, d):
    """The record that each entry puts into the search table."""
    p = metadata.payload(updated(spark, d))
    joined = [F.array_join(c, "|").alias(c) for c in ("aliases", "common_names", "keywords")]
    return p.select("id", "canonical_name", "glycam_name", "iupac_name", "accession", *joined, "description", F.size("name_variants").alias("variants"))


@query(
    E.rstrip()
    + """,
i AS (SELECT CASE WHEN k % 11 = 0 THEN ['missing_search_meta'] ELSE list_filter([CASE WHEN keywords IS NULL THEN 'missing_keywords' END,
    CASE WHEN coalesce(a.iupac, '') = '' THEN 'invalid_iupac' END], lambda x: x IS NOT NULL) END AS found FROM e)
SELECT issue, count(*) AS n FROM (SELECT unnest(found) AS issue FROM i UNION ALL SELECT 'all' FROM (SELECT unnest(found) FROM i)) GROUP BY issue"""
)
def metadata_issue_counts(spark, d):
    has = F.substring("id", 3, 20).cast("long") % 11 != 0
    return metadata.issue_counts(metadata.metadata_issues(entries(spark, d), has))
