"""Names, keywords and search metadata over part, customer, documents and labels.

Names are put together from fixed pieces by key, so every branch of the rules is met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.functions import columns, keywords, names
from sugarloom.operators import stats

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Pieces of names.
ARMS = ("Man(a1-3)[Man(a1-6)]", "GlcNAc(b1-2)Man(a1-3)[GlcNAc(b1-2)Man(a1-6)]", "GlcNAc(b1-2)[GlcNAc(b1-4)]Man(a1-3)[GlcNAc(b1-2)Man(a1-6)]", "GlcNAc(b1-2)Man(a1-3)[Man(a1-3)[Man(a1-6)]Man(a1-6)]", "Gal(b1-4)", "GlcA(b1-3)", "Man(a1-2)Man(a1-3)[Man(a1-6)]", "")
ENDS = ("Man(b1-4)GlcNAc(b1-4)GlcNAc", "Man(b1-4)GlcNAc(b1-4)[Fuc(a1-6)]GlcNAc", "Gal(b1-3)GalNAc", "IdoA(a1-4)GlcN", "Glc", "GalNAc")
ATOMS = ("O5_1", "C1_1", "O3_2", "C3_2", "C2_2", "O6_2", "C6_3", "C5_3", "O5_3", "N2_1", "C7_1", "C4_x")
RESIDUES = ("DManp", "DGlcpNAc", "LFucp", "DGalp", "DNeup5Ac", "LIdopA[2S]", "DGlcpA")
LINKS = ("a1-2", "b1-4", "a1-6", "b1-3")


def pick(options: tuple[str, ...], key: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, options)), (key % len(options) + 1).cast("int"))


def pick_sql(options: tuple[str, ...], key: str) -> str:
    return "[" + ", ".join(f"'{x}'" for x in options) + f"][({key}) % {len(options)} + 1]"


def part(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name", "p_type", F.concat(pick(ARMS, F.col("p_partkey")), pick(ENDS, F.floor(F.col("p_partkey") / 8))).alias("name"))


PART = f"WITH p AS (SELECT p_partkey, p_name, p_type, {pick_sql(ARMS, 'p_partkey')} || {pick_sql(ENDS, 'p_partkey // 8')} AS name FROM part)"


def torsion_names(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    parts = [pick(ATOMS, k + i * (1 + F.floor(k / 12) % 2)) for i in range(4)]
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.concat_ws("-", *parts).alias("torsion"))


TORSION = f"WITH t AS (SELECT p_partkey, concat_ws('-', {', '.join(pick_sql(ATOMS, f'p_partkey + {i} * (1 + p_partkey // 12 % 2)') for i in range(4))}) AS torsion FROM part)"
_PHI = "{0} = 'O5' AND {1} = 'C1' AND {2} LIKE 'O%' AND {2} <> 'O5' AND {3} LIKE 'C%' AND {4} = {5} AND {6} = {7} AND {4} <> {6}"
_PSI = "{0} = 'C1' AND {1} LIKE 'O%' AND {1} <> 'O5' AND {2} LIKE 'C%' AND ({3} LIKE 'C%' OR {3} LIKE 'O%') AND {4} = {5} AND {5} <> {6} AND {6} = {7}"
_OMEGA = "{0} LIKE 'O%' AND {0} <> 'O5' AND {1} = 'C6' AND {2} = 'C5' AND {3} = 'O5' AND {5} = {6} AND {6} = {7} AND {4} <> {5}"


def _class_sql() -> str:
    out = ""
    for order in ("1234", "4321"):
        v = [f"a{i}" for i in order] + [f"r{i}" for i in order]
        for rule, x, y, kind in ((_PHI, 4, 6, "phi"), (_PSI, 4, 6, "psi"), (_OMEGA, 4, 5, "omega")):
            out += f" WHEN {rule.format(*v)} THEN {v[x]} || '_' || {v[y]} || '_{kind}'"
    return f"CASE{out} END"


@query(
    TORSION
    + ", s AS (SELECT *, "
    + ", ".join(f"split_part(split_part(torsion, '-', {i}), '_', 1) AS a{i}, try_cast(split_part(split_part(torsion, '-', {i}), '_', 2) AS INT) AS r{i}" for i in range(1, 5))
    + f" FROM t) SELECT p_partkey, torsion, CASE WHEN r1 + r2 + r3 + r4 IS NULL THEN 'other_' || torsion ELSE coalesce({_class_sql()}, 'other_' || torsion) END AS class FROM s"
)
def glycosidic_classes(spark, d):
    t = torsion_names(spark, d)
    return t.select("p_partkey", "torsion", names.glycosidic_class(F.col("torsion")).alias("class"))


def _token_sql(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace({x}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'NA')"


@query(
    "WITH s AS (SELECT p_partkey, "
    + ", ".join(f"{pick_sql(('C5', 'C6', 'O6', 'C4', 'N2', 'C2', 'C7', 'C8'), f'p_partkey * 3 + {i}')} AS a{i}, (p_partkey + {i}) // 3 % 4 AS r{i}, {pick_sql(('0M A', '-', '2MA', 'YB'), f'p_partkey // 5 + {i}')} AS n{i}" for i in range(1, 5))
    + " FROM part), k AS (SELECT *, "
    + ", ".join(f"'r' || r{i} || '_' || {_token_sql(f'n{i}')} || '_' || {_token_sql(f'a{i}')} AS k{i}, r{i} || '_' || {_token_sql(f'n{i}')} || '_' || {_token_sql(f'a{i}')} AS q{i}" for i in range(1, 5))
    + """ FROM s) SELECT p_partkey, CASE WHEN ['c0_' || q3, 'c1_' || q2, 'f0_' || q4, 'f1_' || q1] < ['c0_' || q2, 'c1_' || q3, 'f0_' || q1, 'f1_' || q4] THEN concat_ws('__', k3, k2, k4, k1) ELSE concat_ws('__', k2, k3, k1, k4) END AS canonical,
 CASE WHEN r2 = r3 THEN 'residue_local' ELSE 'inter_residue' END AS family,
 CASE WHEN r2 = r3 AND list_sort([a2, a3]) = ['C5', 'C6'] AND list_contains([a1, a2, a3, a4], 'C4') AND list_contains([a1, a2, a3, a4], 'O6') THEN 'exocyclic_c6' WHEN r2 = r3 AND list_sort([a2, a3]) = ['C2', 'N2'] THEN 'n_acetyl_linker'
  WHEN r2 = r3 AND list_sort([a2, a3]) = ['C7', 'N2'] THEN 'n_acetyl_amide' WHEN r2 = r3 AND list_sort([a2, a3]) = ['C7', 'C8'] THEN 'n_acetyl_methyl' ELSE 'bond_' || a2 || '_' || a3 END AS subtype FROM k"""
)
def canonical_torsions(spark, d):
    k = F.col("p_partkey")
    p = spark.read.parquet(f"{d}/part.parquet")
    atoms = [pick(("C5", "C6", "O6", "C4", "N2", "C2", "C7", "C8"), k * 3 + i) for i in range(1, 5)]
    ids = [F.floor((k + i) / 3) % 4 for i in range(1, 5)]
    residues = [pick(("0M A", "-", "2MA", "YB"), F.floor(k / 5) + i) for i in range(1, 5)]
    s = names.local_identity(atoms, ids)
    return p.select("p_partkey", names.canonical_name(atoms, ids, residues).alias("canonical"), s["family"].alias("family"), s["subtype"].alias("subtype"))


@query(
    f"WITH n AS (SELECT p_partkey, {pick_sql(RESIDUES, 'p_partkey')} || {pick_sql(LINKS, 'p_partkey // 3')} || 'DManp' || {pick_sql(('a1-OH', 'b1-OH', 'b2-OH', 'a1-OME', 'x'), 'p_partkey // 2')} AS name FROM part)"
    + """ SELECT p_partkey, CASE WHEN name LIKE '%-OH' THEN left(name, length(name) - 5) ELSE name END AS tidy, CASE WHEN name LIKE '%-OH' THEN right(left(name, length(name) - 3), 1) END AS end_pos,
 CASE WHEN name LIKE '%-OH' THEN right(left(name, length(name) - 4), 1) END AS end_link,
 CASE WHEN l LIKE '%a1-OH%' OR l LIKE '%a2-OH%' THEN 'alpha' WHEN l LIKE '%b1-OH%' OR l LIKE '%b2-OH%' THEN 'beta' ELSE 'unknown' END AS anomer, 'GS' || upper(left(md5(name), 6)) AS fallback_id
 FROM (SELECT *, regexp_extract_all(name, '[A-Za-z0-9]+-?OH?')[-1] AS l FROM n)"""
)
def sugar_names(spark, d):
    k = F.col("p_partkey")
    name = F.concat(pick(RESIDUES, k), pick(LINKS, F.floor(k / 3)), F.lit("DManp"), pick(("a1-OH", "b1-OH", "b2-OH", "a1-OME", "x"), F.floor(k / 2)))
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", name.alias("name"))
    return p.select("p_partkey", names.tidy_name(F.col("name")).alias("t"), names.anomer(F.col("name")).alias("anomer"), names.fallback_id(F.col("name")).alias("fallback_id")).select("p_partkey", "t.*", "anomer", "fallback_id")


@query(
    PART
    + r""", c AS (SELECT p_partkey, name, string_split(regexp_replace(regexp_replace(name, '\[|\]', '', 'g'), '\(.*?\)', '.', 'g'), '.') AS parts FROM p),
e AS (SELECT p_partkey, unnest(parts) AS residue, generate_subscripts(parts, 1) AS pos FROM c)
SELECT p_partkey, residue, count(*) AS n, min(pos)::INT AS first FROM e GROUP BY ALL"""
)
def residue_composition(spark, d):
    p = part(spark, d).select("p_partkey", F.posexplode(names.composition(F.col("name"))).alias("at", "x"), "name")
    parts = F.split(F.regexp_replace(F.regexp_replace(F.col("name"), r"\[|\]", ""), r"\(.*?\)", "."), r"\.")
    return p.select("p_partkey", F.col("x.residue").alias("residue"), F.col("x.n").cast("long").alias("n"), F.array_position(parts, F.col("x.residue")).cast("int").alias("first"))


#: The rules again, with their values written out.
KEYWORDS = (
    PART
    + """,
f AS (SELECT p_partkey, name, (name LIKE '%Man(b1-4)GlcNAc(b1-4)GlcNAc' OR suffix(name, 'Man(b1-4)GlcNAc(b1-4)[Fuc(a1-6)]GlcNAc')) AS nl, (length(name) - length(replace(name, 'Man', ''))) // 3 AS man,
  (contains(name, 'Man(b1-4)GlcNAc(b1-4)GlcNAc') OR contains(name, 'Man(b1-4)GlcNAc(b1-4)[Fuc(a1-6)]GlcNAc') OR contains(name, 'Man(b1-4)GlcNAc(b1-4)[Fuc(a1-3)]GlcNAc')) AS core,
  (contains(name, 'GlcNAc(b1-2)Man(a1-3)') OR contains(name, 'GlcNAc(b1-2)]Man(a1-3)')) AS a3,
  (contains(name, 'GlcNAc(b1-2)Man(a1-6)') OR contains(name, 'GlcNAc(b1-2)]Man(a1-6)')) AS a6,
  (contains(name, 'GlcNAc(b1-4)Man(a1-3)') OR contains(name, 'GlcNAc(b1-4)[Man(a1-3)') OR contains(name, 'GlcNAc(b1-4)[GlcNAc(b1-2)]Man(a1-3)')) AS m3,
  (contains(name, 'GlcNAc(b1-6)Man(a1-6)') OR contains(name, 'GlcNAc(b1-6)[Man(a1-6)') OR contains(name, 'GlcNAc(b1-6)[GlcNAc(b1-2)]Man(a1-6)')) AS m6,
  (contains(name, 'GlcNAc(b1-2)Man') OR contains(name, 'Gal(') OR contains(name, 'Neu5Ac(') OR contains(name, 'Xyl(') OR contains(name, 'GlcNAc(b1-4)]Man') OR contains(name, 'GlcNAc(b1-6)[GlcNAc(b1-2)]Man') OR contains(name, 'GlcNAc(b1-4)[GlcNAc(b1-2)]Man')) AS ex,
  contains(CASE WHEN suffix(name, 'Man(b1-4)GlcNAc(b1-4)[Fuc(a1-6)]GlcNAc') THEN replace(name, '[Fuc(a1-6)]GlcNAc', 'GlcNAc') ELSE name END, 'Fuc(') AS fuc,
  contains(name, 'GlcNAc(b1-4)Man') AND NOT contains(name, 'Man(b1-4)GlcNAc(b1-4)GlcNAc') AS odd FROM p),
g AS (SELECT *, man >= 3 AND NOT ex AND NOT fuc AND NOT odd AS oligo, core AND contains(name, 'GlcNAc(b1-2)Man') AND a3 AND a6 AS cx, core AND man > 3 AND a3 <> a6 AS hy,
  a3::INT + m3::INT AS n3, a6::INT + m6::INT AS n6 FROM f),
h AS (SELECT *, nl AND NOT oligo AND cx AS complex, CASE WHEN n3 > 0 AND n6 > 0 THEN n3 + n6 END AS arms FROM g),
t AS (SELECT p_partkey, unnest([CASE WHEN nl THEN 'N-Glycan' END,
  CASE WHEN nl AND contains(name, 'Man(b1-4)GlcNAc(b1-4)[Fuc(a1-6)]GlcNAc') THEN 'Fucosylated N-Glycan' END,
  CASE WHEN nl AND oligo THEN 'Oligomannose' END,
  CASE WHEN complex THEN 'Complex N-Glycan' END,
  CASE WHEN complex AND arms = 2 THEN 'Biantennary N-Glycan' WHEN complex AND arms = 3 THEN 'Triantennary N-Glycan' WHEN complex AND arms >= 4 THEN 'Tetraantennary N-Glycan' END,
  CASE WHEN nl AND NOT oligo AND NOT cx AND hy THEN 'Hybrid N-Glycan' END,
  CASE WHEN (contains(name, 'Gal(b1-3)GalNAc') OR contains(name, 'GlcNAc(b1-6)[Gal(b1-3)]GalNAc') OR contains(name, 'GlcNAc(b1-3)GalNAc') OR contains(name, 'GlcNAc(b1-6)[GlcNAc(b1-3)]GalNAc')) OR suffix(name, 'GalNAc') THEN 'O-Glycan' END,
  CASE WHEN (contains(name, 'GlcA(b1-3)Gal(b1-3)Gal(b1-4)Xyl') OR contains(name, 'IdoA')) OR contains(name, 'GlcA') AND contains(name, 'GlcNAc') OR contains(name, 'GlcA') AND contains(name, 'GalNAc') OR contains(name, 'GlcN') AND contains(name, 'GlcA') OR contains(name, 'GlcN') AND contains(name, 'IdoA') THEN 'GAG' END]) AS keyword FROM h)
SELECT p_partkey, keyword FROM t WHERE keyword IS NOT NULL"""
)


@query(KEYWORDS)
def name_keywords(spark, d):
    return part(spark, d).select("p_partkey", F.explode(keywords.keywords(F.col("name"))).alias("keyword"))


@query(
    "SELECT c_custkey, CASE WHEN trim(x) = '' OR lower(trim(x)) = 'null' OR trim(x) = 'TODO' THEN NULL ELSE trim(x) END AS cleaned, try_cast(trim(x) AS DOUBLE) AS number FROM (SELECT c_custkey, ['', ' null ', 'TODO', ' 4.5', 'abc', '7e2', NULL][c_custkey % 7 + 1] AS x FROM customer)"
)
def cleaned_values(spark, d):
    x = F.element_at(F.array(*(F.lit(v) for v in ("", " null ", "TODO", " 4.5", "abc", "7e2", None))), (F.col("c_custkey") % 7 + 1).cast("int"))
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", columns.clean_null(x, ("TODO",)).alias("cleaned"), columns.safe_double(x).alias("number"))


@query(
    """WITH w AS (SELECT p_partkey, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM (SELECT p_partkey, string_split(p_name || ' ' || upper(p_type) || '  ' || p_type || ' ' || p_name, ' ') AS x FROM part)),
k AS (SELECT p_partkey, v, pos FROM w WHERE v <> '' QUALIFY row_number() OVER (PARTITION BY p_partkey, lower(v) ORDER BY pos) = 1)
SELECT p_partkey, string_agg(v, '|' ORDER BY pos) AS terms FROM k GROUP BY p_partkey"""
)
def normal_lists(spark, d):
    """A part's words, of which the first spelling stays."""
    words = F.split(F.concat_ws(" ", "p_name", F.upper("p_type"), F.lit(""), "p_type", "p_name"), " ")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.array_join(columns.normal_list(words), "|").alias("terms"))


@query(
    """WITH w AS (SELECT doc_id, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))
SELECT doc_id, v AS line, pos - 1 AS pos FROM w WHERE v <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, lower(v) ORDER BY pos) = 1"""
)
def first_spellings(spark, d):
    """Lines of whole documents folded by case, as rows: for lists too long for one array."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where("line <> ''")
    out = stats.first_match(docs.withColumn("folded", F.lower("line")), ["doc_id", "folded"], ["pos"])
    return out.select("doc_id", "line", F.col("pos").cast("long").alias("pos"))


@query(
    "SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host, split_part(split_part(url, '://', 2), '/', 2) AS segment, replace(replace(lower(split_part(url, '/', 4)), ' ', '_'), '-', '_') AS label FROM pages"
)
def storage_keys(spark, d):
    rest = F.element_at(F.split(F.col("url"), "://"), 2)
    p = spark.read.parquet(f"{d}/pages.parquet")
    return p.select("page_id", names.first_segment(rest, F.lit("")).alias("host"), names.first_segment(rest, F.concat(names.first_segment(rest, F.lit("")), F.lit("/"))).alias("segment"), names.keyword_label(F.element_at(F.split("url", "/"), 4)).alias("label"))


@query("SELECT kind, value, count(*) AS n FROM (SELECT 'brand' AS kind, p_brand AS value FROM part UNION ALL SELECT 'type', p_type FROM part UNION ALL SELECT 'all', '' FROM part) GROUP BY ALL")
def family_summary(spark, d):
    return stats.counts_by(spark.read.parquet(f"{d}/part.parquet").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")), ["brand", "type"])


@query("SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_brand, p_type) > 1 THEN p_type || '__' || p_partkey ELSE p_type END AS export_name FROM part")
def export_names(spark, d):
    return stats.unique_names(spark.read.parquet(f"{d}/part.parquet"), ["p_brand"], "p_type", "p_partkey").select("p_partkey", "export_name")


@query(
    "WITH s AS (SELECT p_partkey, 'WURCS=2.0/2,2,1/[' || "
    + pick_sql(("u2122h_2*NCC/3=O", "a1122h-1a_1-5", "a1122h-1b_1-5_2*N", "a2112h-1x_1-5", "z99"), "p_partkey")
    + """ || '][a1122h-1b_1-5]/1-2/a4-b1' AS s FROM part), f AS (SELECT *, regexp_extract(s, '\\[([^\\]]+)\\]', 1) AS r, substr(s, strpos(s, '][') + 1) AS rest FROM s),
k AS (SELECT *, CASE WHEN r[1] IN ('u', 'U') THEN 'archetype' WHEN contains(r, '-1a_') THEN 'alpha' WHEN contains(r, '-1b_') THEN 'beta' WHEN contains(r, '-1x_') THEN 'neutral' END AS kind FROM f),
m AS (SELECT *, CASE WHEN kind = 'archetype' THEN regexp_extract(r, '^[uU](\\w+)', 1) ELSE regexp_extract(r, '^a(\\w+)-1', 1) END AS body, CASE WHEN kind = 'archetype' THEN '1-5' ELSE regexp_extract(r, '_(\\d+-\\d+)', 1) END AS ring,
 CASE WHEN kind = 'archetype' THEN regexp_extract(r, '^[uU]\\w+(.*)$', 1) ELSE regexp_extract(r, '-1[abx]_\\d+-\\d+(.*)$', 1) END AS tail FROM k WHERE kind IS NOT NULL)
SELECT p_partkey, kind, 'WURCS=2.0/2,2,1/[u' || body || tail || ']' || rest AS archetype, 'WURCS=2.0/2,2,1/[a' || body || '-1a_' || ring || tail || ']' || rest AS alpha, 'WURCS=2.0/2,2,1/[a' || body || '-1b_' || ring || tail || ']' || rest AS beta FROM m""".replace("\\\\", "\\")
)
def sequence_variants(spark, d):
    s = F.concat(F.lit("WURCS=2.0/2,2,1/["), pick(("u2122h_2*NCC", "a1122h-1a_1-5", "a1122h-1b_1-5_2*N", "a2112h-1x_1-5", "z99"), F.col("p_partkey")), F.lit("][a1122h-1b_1-5]/1-2/a4-b1"))
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", names.sequence_variants(s).alias("v")).where("v is not null")
    return p.select("p_partkey", "v.*")


SQL["sequence_variants"] = SQL["sequence_variants"].replace("u2122h_2*NCC/3=O", "u2122h_2*NCC")


RESIDUE_NAMES = ("0MA", "2MB", "4YB", "ROH", "0SA", "VB", "3VB", "0fA", "0LA")


@query(
    """SELECT p_partkey, ['0MA', '2MB', '4YB', 'ROH', '0SA', 'VB', '3VB', '0fA', '0LA'][p_partkey % 9 + 1] AS residue,
  ['MAN', 'BMA', 'NAG', 'ROH', 'SIA', 'VB', 'NGA', 'FUC', 'GLA'][p_partkey % 9 + 1] AS pdb,
  ['AMAN', 'BMAN', 'BGLC', 'ROH', 'ANE5', 'VB', 'BGAL', 'FUC', 'AGAL'][p_partkey % 9 + 1] AS charmm FROM part"""
)
def renamed_residues(spark, d):
    """Residues in both other schemes; what neither knows stays."""
    r = pick(RESIDUE_NAMES, F.col("p_partkey"))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", r.alias("residue"), names.renamed_residue(r, "PDB").alias("pdb"), names.renamed_residue(r, "CHARMM").alias("charmm"))


@query(None)
def condensed_names(spark, d):
    """Full names of two residues in the condensed form."""
    k = F.col("p_partkey")
    name = F.concat(pick(RESIDUES, k), pick(LINKS, F.floor(k / 3)), pick(RESIDUES, F.floor(k / 2)))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", name.alias("full"), names.condensed_name(name).alias("condensed"))
