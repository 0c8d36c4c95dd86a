"""Search metadata, orders and small decisions over customer, part, orders, events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sugarloom.functions import names
from sugarloom.functions.columns import percent, two_formats
from sugarloom.operators import documents, records

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN c_name END, '') AS name FROM customer")
def canonical_names(spark, d):
    first = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise(" null ")
    return t(spark, d, "customer").select("c_custkey", records.canonical_name(first, F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))).alias("name"))


@query("""
SELECT p_partkey, concat_ws(' ',
  'P' || p_partkey || ' is a glycan with IUPAC notation ' || p_type || '.',
  CASE WHEN p_partkey % 2 = 0 THEN 'Classified as: GAG.' END,
  'Simulated with ' || concat_ws(', ', CASE WHEN p_partkey % 3 = 0 THEN 'MD package ' || p_brand END, 'force field f' || p_size, '300K') || '.',
  CASE WHEN p_partkey % 5 = 0 THEN 'Also known as: ' || p_name || '.' END,
  CASE WHEN p_partkey % 4 = 0 THEN 'Composed of ' || p_size || 'x Gal, 1x Man.' END,
  CASE WHEN p_partkey % 7 = 0 THEN 'noted' END) AS description
FROM part""")
def descriptions(spark, d):
    k, none = F.col("p_partkey"), F.array().cast("array<string>")
    out = records.described(
        F.concat(F.lit("P"), k.cast("string")),
        F.col("p_type"),
        F.when(k % 2 == 0, F.array("p_brand", F.lit("GAG"))).otherwise(none),
        F.when(k % 3 == 0, F.col("p_brand")),
        F.concat(F.lit("f"), F.col("p_size").cast("string")),
        F.lit(300),
        F.when(k % 5 == 0, F.array("p_name")).otherwise(none),
        F.when(k % 4 == 0, F.create_map(F.lit("Gal"), F.col("p_size").cast("string"), F.lit("Man"), F.lit("1"))),
        F.when(k % 7 == 0, "noted").otherwise(""),
    )
    return t(spark, d, "part").select("p_partkey", out.alias("description"))


@query("SELECT c_custkey, string_agg(v, '|' ORDER BY v) AS tags FROM (SELECT DISTINCT c_custkey, unnest([c_mktsegment, 'FF:' || c_nationkey, 'MD:' || (c_custkey % 3), c_mktsegment]) AS v FROM customer) GROUP BY c_custkey")
def tag_union(spark, d):
    c = t(spark, d, "customer")
    tags = documents.union_sorted(F.array("c_mktsegment", F.concat(F.lit("FF:"), F.col("c_nationkey").cast("string"))), F.array(F.concat(F.lit("MD:"), (F.col("c_custkey") % 3).cast("string")), F.col("c_mktsegment")))
    return c.select("c_custkey", F.array_join(tags, "|").alias("tags"))


@query("SELECT c_custkey, k AS key, string_agg(v, '|' ORDER BY pos) AS vals FROM (SELECT c_custkey, 'both' AS k, unnest([c_mktsegment, 'a', 'b']) AS v, unnest([1, 2, 3]) AS pos FROM customer UNION ALL SELECT c_custkey, 'new', 'c', 1 FROM customer UNION ALL SELECT c_custkey, 'old', 'd', 1 FROM customer) GROUP BY ALL")
def merged_lists(spark, d):
    """Maps of lists merged key by key."""
    old = F.create_map(F.lit("both"), F.array("c_mktsegment", F.lit("a")), F.lit("old"), F.array(F.lit("d")))
    new = F.create_map(F.lit("both"), F.array(F.lit("a"), F.lit("b"), F.col("c_mktsegment")), F.lit("new"), F.array(F.lit("c")))
    c = t(spark, d, "customer").select("c_custkey", F.explode(documents.merged_maps(old, new)).alias("key", "v"))
    return c.select("c_custkey", "key", F.array_join("v", "|").alias("vals"))


@query("SELECT o_custkey AS mol_id, count(DISTINCT CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN o_orderkey % 5 END) = 3 AS complete FROM orders GROUP BY 1")
def level_completeness(spark, d):
    return documents.levels_complete(t(spark, d, "orders").select(F.col("o_custkey").alias("mol_id"), (F.col("o_orderkey") % 5).cast("int").alias("level")), [1, 2, 3])


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'FAILED' WHEN c_custkey % 7 < 4 THEN 'COMPLETE' ELSE 'WARNING' END AS verdict,
  array_to_string(list_filter([
    CASE WHEN c_custkey % 2 = 0 THEN '[MISSING] step incomplete: info' END,
    CASE WHEN c_custkey % 3 = 0 THEN '[MISSING] static step incomplete' END,
    CASE WHEN c_custkey % 5 = 0 THEN '[MISSING] data.json' END,
    CASE WHEN c_custkey % 4 = 1 THEN '[WARN] odd file' END,
    CASE WHEN c_custkey % 7 = 4 THEN '[WARN] metadata step failed' END,
    CASE WHEN c_custkey % 7 > 4 AND c_custkey % 2 > 0 AND c_custkey % 3 > 0 THEN '[WARN] metadata step did not report a final status' END], lambda x: x IS NOT NULL), '|') AS issues
FROM customer""")
def verdicts(spark, d):
    """The verdict on each run, and its issues in order."""
    k = F.col("c_custkey")
    listed = lambda when, *names: F.when(when, F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>"))
    steps, static, told = k % 2 > 0, k % 3 > 0, F.when(k % 7 < 4, True).when(k % 7 == 4, False)
    missing = listed(k % 5 == 0, "data.json")
    issues = records.run_issues(F.lit(True), listed(~steps, "info"), static, F.lit(True), missing, listed(k % 4 == 1, "missing x", "odd file", "odd file"), steps, told)
    return t(spark, d, "customer").select("c_custkey", records.verdict(steps, static, F.size(missing), told).alias("verdict"), F.array_join(issues, "|").alias("issues"))


@query("""
SELECT c_custkey AS id, c_custkey % 4 > 0 AND c_custkey % 3 > 0 AS whole, c_custkey % 2 = 0 OR c_custkey % 5 = 0 AS known FROM customer""")
def static_states(spark, d):
    """Whether each entry is complete, by both rules."""
    k = F.col("c_custkey")
    e = t(spark, d, "customer").select(k.alias("id"), F.when(k % 4 > 0, F.col("c_name")).otherwise("null").alias("name"), F.when(k % 2 == 0, "G1").alias("accession"), F.when(k % 5 == 0, "W").otherwise("").alias("sequence"))
    issues = e.where("id % 3 = 0").select("id", F.lit("missing_data_json").alias("issue"))
    full = records.static_complete(e, issues.unionByName(issues), "full").select("id", F.col("complete").alias("whole"))
    return full.join(records.static_complete(e, issues, "simple").select("id", F.col("complete").alias("known")), "id")


@query("SELECT c_custkey, to_json({'a': c_custkey, 'b': {'x': 1, 'y': [1, 2, 3], 'z': 'new'}, 'c': [1], 'd': c_name}) AS doc FROM customer")
def merged_documents(spark, d):
    """Documents merged to any depth: objects key by key, lists without repeats, other values from the new one."""
    old = F.concat(F.lit('{"a": 0, "b": {"x": 1, "y": [1, 2], "z": {"q": 1}}, "c": 5, "d": '), F.to_json(F.struct("c_name")).substr(F.lit(11), F.length("c_name") + 2), F.lit("}"))
    new = F.concat(F.lit('{"a": '), F.col("c_custkey").cast("string"), F.lit(', "b": {"y": [2, 3], "z": "new"}, "c": [1]}'))
    return documents.merged_json(t(spark, d, "customer").select("c_custkey", old.alias("old"), new.alias("new")), "old", "new", "doc").select("c_custkey", "doc")


@query("SELECT 'C' || o_custkey AS mol_id, count(DISTINCT o_orderpriority) AS n, bool_or(o_orderpriority = '5-LOW') AS complete FROM orders GROUP BY 1")
def molecule_files(spark, d):
    """How many files each molecule has, and whether the one that ends a run is there."""
    files = t(spark, d, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("mol_id"), F.when(F.col("o_orderpriority") == "5-LOW", "output/info.json").otherwise(F.col("o_orderpriority")).alias("path"))
    return documents.files_by_molecule(files).select("mol_id", F.size("files").alias("n"), "complete")


@query("SELECT p_partkey, lower(replace(replace(p_name, ' ', '_'), '-', '_')) AS keyword, 'Gal_b1_' || p_size || '_' AS terminus, 'x_y_z' || p_size AS sequence, 'Cluster_' || p_size AS cluster FROM part")
def safe_labels(spark, d):
    """The four kinds of label that stand in names of nodes."""
    n = F.col("p_size").cast("string")
    return t(spark, d, "part").select(
        "p_partkey",
        names.keyword_label(F.col("p_name")).alias("keyword"),
        names.terminus_label(F.concat(F.lit("Gal(b1-"), n, F.lit(")"))).alias("terminus"),
        names.sequence_label(F.concat(F.lit("X (y)/z"), n)).alias("sequence"),
        names.cluster_label(F.concat(F.lit("Cluster "), n)).alias("cluster"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created FROM events WHERE event_id % 3 <> 2 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 3 = 2")
def two_time_formats(spark, d):
    k, ts = F.col("event_id") % 3, F.col("ts").cast("timestamp")
    text = F.when(k == 0, F.date_format(ts, "dd/MM/yyyy HH:mm:ss")).when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    return t(spark, d, "events").select("event_id", two_formats(text).alias("created"))


@query("SELECT o_custkey, arg_min(o_orderpriority || '/' || o_orderkey, (length(o_orderpriority || '/' || o_orderkey), o_orderpriority || '/' || o_orderkey)) AS path FROM orders GROUP BY 1")
def shortest_paths(spark, d):
    return documents.shortest(t(spark, d, "orders").select("o_custkey", F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("path")), ["o_custkey"])


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 1000000000 ELSE p_partkey % 11 END AS pos, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_partkey % 4 = 0 THEN 1000000000 ELSE p_partkey % 11 END, p_partkey) AS place FROM part")
def model_places(spark, d):
    """Models in the order of the number in their label; labels without one come last."""
    from pyspark.sql import Window as W

    label = F.when(F.col("p_partkey") % 4 == 0, "Cluster x").otherwise(F.concat(F.lit("Cluster "), (F.col("p_partkey") % 11).cast("string")))
    p = t(spark, d, "part").select("p_partkey", "p_brand", documents.model_order(label).alias("pos"))
    return p.select("p_partkey", "pos", F.row_number().over(W.partitionBy("p_brand").orderBy("pos", "p_partkey")).alias("place"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (SELECT count(*) FROM orders) > 100 OR (SELECT count(*) FROM orders) <= 100")
def capped_scan(spark, d):
    return documents.capped_scan(t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") == "F", 100).select("o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN round(o_totalprice / 7, 2) ELSE round(o_totalprice / 7, 4) END AS pct FROM orders")
def level_percent(spark, d):
    return t(spark, d, "orders").select("o_orderkey", percent(F.col("o_totalprice").cast("double") / 7, F.col("o_orderkey") % 3).alias("pct"))


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), '99') OR c_mktsegment = 'BUILDING'")
def name_matches(spark, d):
    c = t(spark, d, "customer")
    return c.where(records.name_match(F.col("c_name"), F.lit("99"), False) | records.name_match(F.col("c_mktsegment"), F.lit("BUILDING"), True)).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_custkey % 2 = 0 AND (c_custkey % 3 = 0 OR c_custkey % 5 <> 0) AS complete FROM customer")
def record_completeness(spark, d):
    k = F.col("c_custkey")
    fields = {"name": F.col("c_name"), "id": F.when(k % 2 == 0, k.cast("string")).otherwise("null"), "accession": F.when(k % 3 == 0, "G1").otherwise("TODO"), "sequence": F.when(k % 5 != 0, "W").otherwise("")}
    return t(spark, d, "customer").select("c_custkey", records.completeness(fields, ("TODO",)).alias("complete"))
