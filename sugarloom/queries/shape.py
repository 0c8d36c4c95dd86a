"""Geometry, statistics and clustering over the embeddings table, read as frames of 21 pseudo-atoms.

A vector is a frame; its elements three by three are atoms, its first three the point in component space;
vectors are dealt to five molecules by id, and a vector's label is its cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sugarloom.functions.columns import clusters_for_entropy, scott_bandwidth
from sugarloom.operators import clusters, geometry, landscapes, neighbours, stats
from sugarloom.operators.staging import staged

TORSIONS = 6
QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def frames(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    return e.select((F.col("vec_id") % 5).alias("mol_id"), F.col("vec_id").alias("frame"), F.slice("embedding", 1, 63).alias("xyz"), F.col("label").alias("cluster"))


def points(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).select("mol_id", "frame", "cluster", *(F.element_at("xyz", i + 1).cast("double").alias(a) for i, a in enumerate("xyz")))


def torsions(spark: SparkSession) -> DataFrame:
    every = spark.range(5).select(F.col("id").alias("mol_id"))
    t = spark.range(TORSIONS).select(F.col("id").cast("int").alias("torsion_id"), *((3 * F.col("id") + i).cast("int").alias(x) for i, x in enumerate("abcd")))
    return every.crossJoin(F.broadcast(t))  # 30 rows


def values(spark: SparkSession, d: str) -> DataFrame:
    return geometry.torsion_values(frames(spark, d).drop("cluster"), F.broadcast(torsions(spark)))


def _v(i: str, k: int) -> str:
    return f"e[3*({i})+{k}]::DOUBLE"


def _dihedral_sql(a: str, b: str, c: str, d: str) -> str:
    """Nested selects that give deg from e and the atom numbers."""
    return f"""
 SELECT *, degrees(atan2((cx*b2x + cy*b2y + cz*b2z) / (l1*l2*lb), (n1x*n2x + n1y*n2y + n1z*n2z) / (l1*l2))) AS raw FROM (
  SELECT *, n1y*n2z - n1z*n2y AS cx, n1z*n2x - n1x*n2z AS cy, n1x*n2y - n1y*n2x AS cz,
   coalesce(nullif(sqrt(n1x*n1x + n1y*n1y + n1z*n1z), 0), 1) AS l1, coalesce(nullif(sqrt(n2x*n2x + n2y*n2y + n2z*n2z), 0), 1) AS l2,
   coalesce(nullif(sqrt(b2x*b2x + b2y*b2y + b2z*b2z), 0), 1) AS lb FROM (
   SELECT *, b1y*b2z - b1z*b2y AS n1x, b1z*b2x - b1x*b2z AS n1y, b1x*b2y - b1y*b2x AS n1z,
    b2y*b3z - b2z*b3y AS n2x, b2z*b3x - b2x*b3z AS n2y, b2x*b3y - b2y*b3x AS n2z FROM (
    SELECT *, {", ".join(f"{_v(q, k)} - {_v(p, k)} AS b{n}{x}" for n, (p, q) in enumerate(((a, b), (b, c), (c, d)), 1) for k, x in enumerate("xyz", 1))}
    FROM src)))"""


VALUES = f"""
WITH src AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, embedding AS e, label AS cluster, t::INT AS torsion_id, 3*t AS ta FROM embeddings, range({TORSIONS}) r(t)),
tv AS (SELECT mol_id, frame, cluster, torsion_id, round(raw, 3) AS deg FROM ({_dihedral_sql("ta", "ta+1", "ta+2", "ta+3")}))"""

POINTS = "WITH p AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, label AS cluster, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"

STATS = """
stats AS (
 SELECT {keys}, count(*) AS n, avg(deg) AS mean, coalesce(stddev_samp(deg), 0) AS sd, sum(sin(radians(deg))) AS s, sum(cos(radians(deg))) AS c FROM tv GROUP BY {keys}),
circ AS (
 SELECT *, sqrt(s*s + c*c) / n AS r FROM stats)"""
CIRC = "n, round(mean, 5) AS mean, round(sd, 5) AS sd, round(degrees(atan2(s, c)), 4) AS circ_mean, round(CASE WHEN r = 0 THEN 180 ELSE degrees(sqrt(greatest(0, -2*ln(greatest(r, 1e-12))))) END, 4) AS circ_sd"


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(VALUES + "SELECT mol_id, frame, torsion_id, deg FROM tv")
def torsion_angles(spark, d):
    return values(spark, d).select("mol_id", "frame", "torsion_id", "deg")


@query(
    VALUES
    + ","
    + STATS.format(keys="mol_id, cluster, torsion_id")
    + f", rep AS (SELECT mol_id, cluster, min(frame) AS frame FROM tv GROUP BY 1, 2) SELECT mol_id, cluster, torsion_id, {CIRC}, deg AS rep_deg FROM circ JOIN rep USING (mol_id, cluster) JOIN (SELECT mol_id, frame, torsion_id, deg FROM tv) USING (mol_id, frame, torsion_id)"
)
def torsion_stats(spark, d):
    """The central product: circular statistics by cluster and torsion with the representative's angle."""
    members = frames(spark, d).select("mol_id", "frame", "cluster")
    reps = members.groupBy("mol_id", "cluster").agg(F.min("frame").alias("frame"))
    out = _rounded(stats.cluster_torsion_stats(values(spark, d), members, reps), mean=5, sd=5, circ_mean=4, circ_sd=4)
    return out.select("mol_id", "cluster", "torsion_id", "n", "mean", "sd", "circ_mean", "circ_sd", "rep_deg")


@query(
    "WITH tv AS (SELECT event_type, (floor(epoch(ts))::BIGINT % 86400) / 240.0 - 180 AS deg FROM events),"
    + STATS.format(keys="event_type")
    + f" SELECT event_type, {CIRC} FROM circ"
)
def circular_time_of_day(spark, d):
    """The same statistics of the time of day of events, as angles."""
    e = spark.read.parquet(f"{d}/events.parquet").select("event_type", ((F.unix_timestamp(F.col("ts").cast("timestamp")) % 86400) / 240.0 - 180).alias("deg"))
    return _rounded(stats.circular(e, ["event_type"]), mean=5, sd=5, circ_mean=4, circ_sd=4).select("event_type", "n", "mean", "sd", "circ_mean", "circ_sd")


@query(
    "WITH a AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, i.i, j.j, embedding AS e FROM embeddings, range(21) i(i), range(21) j(j) WHERE i.i > j.j) SELECT mol_id, frame, i::INT AS i, j::INT AS j, round(sqrt("
    + " + ".join(f"pow({_v('i', k)} - {_v('j', k)}, 2)" for k in (1, 2, 3))
    + ")::FLOAT::DOUBLE, 3) AS dist FROM a"
)
def landscape_pairs(spark, d):
    """Distances of all pairs of atoms, from the vector rows, in long form."""
    out = geometry.landscape(frames(spark, d), range(21))
    pairs = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in geometry.pair_list(list(range(21)))))
    long = out.select("mol_id", "frame", F.explode(F.arrays_zip(pairs.alias("p"), F.col("features").alias("v"))).alias("x"))
    return long.select("mol_id", "frame", F.col("x.p.i").alias("i"), F.col("x.p.j").alias("j"), F.round(F.col("x.v").cast("double"), 3).alias("dist"))


@query(f"WITH src AS (SELECT *, embedding AS e FROM embeddings) SELECT vec_id % 5 AS mol_id, vec_id AS frame, round(sqrt({' + '.join(f'pow({_v("0", k)} - {_v("7", k)}, 2)' for k in (1, 2, 3))}), 6) AS dist FROM src")
def atom_distance(spark, d):
    xyz = F.col("xyz")
    return frames(spark, d).select("mol_id", "frame", F.round(geometry.distance(geometry.atom(xyz, 0), geometry.atom(xyz, 7)), 6).alias("dist"))


@query(POINTS + "SELECT mol_id, cluster, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY mol_id), 4) AS pct, row_number() OVER (PARTITION BY mol_id ORDER BY count(*) DESC, cluster) - 1 AS rank FROM p GROUP BY mol_id, cluster")
def cluster_sizes(spark, d):
    """Sizes, shares and ranks by size, ties by the old number."""
    m = points(spark, d)
    return _rounded(stats.cluster_sizes(m).join(stats.by_size(m), ["mol_id", "cluster"]), pct=4)


@query(POINTS + ", c AS (SELECT mol_id, frame % 7 AS cover, cluster, count(*) AS n FROM p GROUP BY ALL) SELECT mol_id, cover, cluster, n FROM c QUALIFY row_number() OVER (PARTITION BY mol_id, cover ORDER BY n DESC, cluster) = 1")
def majority_cluster(spark, d):
    m = points(spark, d).withColumn("cover", F.col("frame") % 7)
    return stats.majority(m, "cover", "cluster")


@query(POINTS + "SELECT mol_id, frame, " + ", ".join(f"round(({a} - avg({a}) OVER w) / coalesce(nullif(stddev_pop({a}) OVER w, 0), 1), 5) AS {a}" for a in "xyz") + " FROM p WINDOW w AS (PARTITION BY mol_id)")
def standard_points(spark, d):
    return _rounded(stats.standardised(points(spark, d).drop("cluster"), "xyz"), x=5, y=5, z=5)


@query(POINTS + "SELECT mol_id, " + ", ".join(f"round(avg({a}), 5) AS {a}_mean, round(coalesce(nullif(coalesce(stddev_samp({a}), 0), 0), 1), 5) AS {a}_sd" for a in "xyz") + " FROM p GROUP BY mol_id")
def feature_scaling(spark, d):
    out = points(spark, d).groupBy("mol_id").agg(*stats.scaling_columns("xyz"))
    return _rounded(out, **{f"{a}_{s}": 5 for a in "xyz" for s in ("mean", "sd")})


@query(VALUES + "," + STATS.format(keys="mol_id, cluster, torsion_id") + " SELECT mol_id, round(avg(CASE WHEN n <= 1 THEN 0 WHEN r = 0 THEN 180 ELSE degrees(sqrt(greatest(0, -2*ln(greatest(r, 1e-12))))) END), 4) AS tightness FROM circ GROUP BY mol_id")
def torsion_tightness(spark, d):
    return _rounded(stats.tightness(values(spark, d), frames(spark, d).select("mol_id", "frame", "cluster")), tightness=4)


KNN = """, near AS (
 SELECT a.mol_id, a.frame, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) AS r
 FROM p a JOIN p b ON a.mol_id = b.mol_id AND a.frame <> b.frame
 QUALIFY row_number() OVER (PARTITION BY a.mol_id, a.frame ORDER BY r) = 5)"""


@query(POINTS + KNN + "SELECT mol_id, frame, round(r, 6) AS r FROM near")
def kth_neighbour(spark, d):
    return _rounded(neighbours.kth_distances(points(spark, d), 5), r=6)


@query(POINTS + KNN + ", g AS (SELECT mol_id, count(*) AS n, avg(ln(CASE WHEN r = 0 THEN 1e-12 ELSE r END)) AS m FROM near GROUP BY mol_id) SELECT mol_id, n, round((SELECT sum(1.0::DOUBLE / j) FROM range(5, n) t(j)) + ln(4.0 / 3 * pi()) + 3 * m, 5) AS entropy FROM g")
def knn_entropy(spark, d):
    return _rounded(neighbours.knn_entropy(points(spark, d)), entropy=5)


@query("WITH h AS (SELECT vec_id, (embedding[4]::DOUBLE + 1) * 12 AS entropy FROM embeddings) SELECT vec_id, CASE WHEN entropy < 5 THEN 5 ELSE round_even(5 * pow(128.0::DOUBLE / 5, (greatest(5.0, least(21.0, entropy)) - 5) / 16), 0)::INT END AS k, round(pow(vec_id + 1, -1.0 / 7), 8) AS bandwidth FROM h")
def entropy_to_clusters(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").withColumn("entropy", (F.element_at("embedding", 4).cast("double") + 1) * 12)
    return e.select("vec_id", clusters_for_entropy(F.col("entropy")).alias("k"), F.round(scott_bandwidth(F.col("vec_id") + 1, 3), 8).alias("bandwidth"))


@query(
    POINTS
    + """, mean AS (SELECT mol_id, cluster, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM p GROUP BY ALL)
SELECT mol_id, cluster, frame FROM p JOIN mean USING (mol_id, cluster)
QUALIFY row_number() OVER (PARTITION BY mol_id, cluster ORDER BY pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2), frame) = 1"""
)
def centroid_representatives(spark, d):
    p = points(spark, d)
    return clusters.nearest_to_centroid(p.drop("cluster"), p.select("mol_id", "frame", "cluster"))


@query(
    POINTS
    + """, h AS (SELECT mol_id, cluster, greatest(pow(count(*), -1.0::DOUBLE / 7) * (coalesce(stddev_samp(x), 0) + coalesce(stddev_samp(y), 0) + coalesce(stddev_samp(z), 0)) / 3, 1e-9) AS h FROM p GROUP BY ALL),
dens AS (SELECT a.mol_id, a.cluster, a.frame, sum(exp(-(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) / (2 * h * h))) AS density
 FROM p a JOIN p b USING (mol_id, cluster) JOIN h USING (mol_id, cluster) GROUP BY ALL)
SELECT mol_id, cluster, frame, round(density, 6) AS density FROM dens QUALIFY row_number() OVER (PARTITION BY mol_id, cluster ORDER BY density DESC, frame) = 1"""
)
def densest_members(spark, d):
    p = points(spark, d)
    return _rounded(clusters.densest_member(p.drop("cluster"), p.select("mol_id", "frame", "cluster")), density=6)


@query(
    POINTS
    + """, m AS (SELECT a.mol_id, a.frame, a.cluster, b.cluster AS c2, avg(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2))) AS d
 FROM p a JOIN p b ON a.mol_id = b.mol_id AND a.frame <> b.frame GROUP BY ALL),
s AS (SELECT mol_id, frame, max(CASE WHEN cluster = c2 THEN d END) AS a, min(CASE WHEN cluster <> c2 THEN d END) AS b FROM m GROUP BY ALL)
SELECT mol_id, round(avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s GROUP BY mol_id"""
)
def silhouette(spark, d):
    p = points(spark, d)
    return _rounded(clusters.silhouettes(p.drop("cluster"), p.select("mol_id", "frame", "cluster")), silhouette=6)


def _centre_sql(k: int) -> str:
    out = POINTS + ", c0 AS (SELECT mol_id, x AS cx, y AS cy, z AS cz FROM p QUALIFY row_number() OVER (PARTITION BY mol_id ORDER BY frame) = 1), s0 AS (SELECT p.*, pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2) AS d2, 0 AS k FROM p JOIN c0 USING (mol_id))"
    for i in range(1, k):
        out += f", c{i} AS (SELECT mol_id, x AS cx, y AS cy, z AS cz FROM s{i - 1} QUALIFY row_number() OVER (PARTITION BY mol_id ORDER BY d2 DESC, frame) = 1), t{i} AS (SELECT s{i - 1}.*, pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2) AS nd FROM s{i - 1} JOIN c{i} USING (mol_id)), s{i} AS (SELECT mol_id, frame, x, y, z, least(d2, nd) AS d2, CASE WHEN nd < d2 THEN {i} ELSE k END AS k FROM t{i})"
    return out + f" SELECT mol_id, frame, k AS cluster FROM s{k - 1}"


@query(_centre_sql(4))
def k_centre(spark, d):
    return clusters.k_centre(points(spark, d), 4)


@query(_centre_sql(1).rsplit(" SELECT", 1)[0] + " SELECT mol_id, arg_max(frame, (d2, -frame)) AS frame, round(max(d2), 6) AS d2 FROM s0 GROUP BY mol_id")
def farthest_point(spark, d):
    p = points(spark, d)
    first = p.groupBy("mol_id").agg(F.min_by(F.struct("x", "y", "z"), "frame").alias("c"))
    gap = sum((F.pow(F.col(a) - F.col("c")[a], 2) for a in "yz"), F.pow(F.col("x") - F.col("c")["x"], 2))
    return p.join(first, "mol_id").groupBy("mol_id").agg(F.max_by("frame", F.struct(gap, -F.col("frame"))).alias("frame"), F.round(F.max(gap), 6).alias("d2"))


@query(
    POINTS
    + """, c AS (SELECT mol_id, cluster AS centre, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM p GROUP BY ALL)
SELECT p.mol_id, frame, centre, round(pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2), 6) AS d2 FROM p JOIN c ON p.mol_id = c.mol_id
QUALIFY row_number() OVER (PARTITION BY p.mol_id, frame ORDER BY pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2), centre) = 1"""
)
def nearest_centres(spark, d):
    p = points(spark, d)
    centres = p.groupBy("mol_id", F.col("cluster").alias("centre")).agg(*(F.avg(a).alias(a) for a in "xyz"))
    return _rounded(clusters.nearest_centre(p.drop("cluster"), centres), d2=6)


@query(POINTS + ", m AS (SELECT mol_id, frame, cluster FROM p WHERE frame % 3 <> 0), s AS (SELECT mol_id, unnest(range(0, max(frame) + 1)) AS frame FROM m GROUP BY mol_id) SELECT mol_id, frame, coalesce(cluster, -1) AS cluster FROM s LEFT JOIN m USING (mol_id, frame)")
def membership_vector(spark, d):
    m = points(spark, d).where("frame % 3 <> 0").select("mol_id", "frame", "cluster")
    return clusters.membership_vector(m)


@query(POINTS + ", r AS (SELECT DISTINCT mol_id, cluster % 4 + 2 AS n_clusters FROM p WHERE cluster <> 9), l AS (SELECT *, dense_rank() OVER (PARTITION BY mol_id ORDER BY n_clusters) AS level FROM r) SELECT mol_id, frame, cluster % 6 + 2 AS n_clusters, coalesce(level, cluster % 6 + 2) AS level FROM p LEFT JOIN l ON l.mol_id = p.mol_id AND l.n_clusters = p.cluster % 6 + 2".replace("SELECT mol_id, frame, cluster % 6", "SELECT p.mol_id, frame, cluster % 6"))
def legacy_levels(spark, d):
    p = points(spark, d)
    summary = p.where("cluster <> 9").select("mol_id", (F.col("cluster") % 4 + 2).alias("n_clusters")).distinct()
    return clusters.upgrade_levels(summary, p.select("mol_id", "frame", (F.col("cluster") % 6 + 2).alias("n_clusters")))[1].select("mol_id", "frame", "n_clusters", "level")


@query(VALUES + ", b AS (SELECT mol_id, torsion_id, least(35, greatest(0, floor((deg + 180) / 10)))::INT AS bin, count(*) AS n FROM tv GROUP BY ALL) SELECT mol_id, torsion_id, bin, round(n / sum(n) OVER (PARTITION BY mol_id, torsion_id) / 10.0, 8) AS density FROM b")
def torsion_density(spark, d):
    return _rounded(clusters.density_curve(values(spark, d), ["mol_id", "torsion_id"], "deg", 36, -180.0, 180.0), density=8)


@query(VALUES + ", v AS (SELECT *, unnest([-30.0, 30.0]) AS change FROM (SELECT DISTINCT frame, torsion_id AS varied FROM tv WHERE frame < 1e18)) SELECT v.frame AS mol_id, varied, change::DOUBLE AS change, torsion_id, round(CASE WHEN varied = torsion_id THEN deg + change ELSE deg END, 3) AS deg FROM v JOIN tv ON v.frame = tv.frame")
def torsion_designs(spark, d):
    """Each torsion of each frame changed in turn, the others kept."""
    base = values(spark, d).select(F.col("frame").alias("mol_id"), "torsion_id", "deg")
    return _rounded(geometry.perturbations(base, 30.0), deg=3)


@query(
    VALUES.rstrip()
    + """,
o AS (SELECT mol_id, frame, radians(60.0 - raw) AS turn FROM (SELECT mol_id, frame, raw FROM ("""
    + _dihedral_sql("ta", "ta+1", "ta+2", "ta+3").replace("SELECT *, degrees", "SELECT mol_id, frame, ta, degrees", 1)
    + """) WHERE ta = 0)),
k AS (SELECT o.*, e, i, e[7]::DOUBLE - e[4]::DOUBLE AS kx, e[8]::DOUBLE - e[5]::DOUBLE AS ky, e[9]::DOUBLE - e[6]::DOUBLE AS kz,
  e[3*i+1]::DOUBLE - e[7]::DOUBLE AS vx, e[3*i+2]::DOUBLE - e[8]::DOUBLE AS vy, e[3*i+3]::DOUBLE - e[9]::DOUBLE AS vz
  FROM o JOIN (SELECT vec_id AS frame, embedding AS e FROM embeddings) USING (frame), range(3, 21) r(i)),
u AS (SELECT * REPLACE (kx / l AS kx, ky / l AS ky, kz / l AS kz) FROM (SELECT *, sqrt(kx*kx + ky*ky + kz*kz) AS l FROM k)),
m AS (SELECT mol_id, frame, i, (kx*vx + ky*vy + kz*vz) * (1 - cos(turn)) AS d, cos(turn) AS c, sin(turn) AS s, * EXCLUDE (mol_id, frame, i) FROM u)
SELECT mol_id, frame, 60.0::DOUBLE AS deg, round(sum(e[7] + vx*c + (ky*vz - kz*vy)*s + kx*d), 3) AS sx, round(sum(e[8] + vy*c + (kz*vx - kx*vz)*s + ky*d), 3) AS sy,
  round(sum(e[9] + vz*c + (kx*vy - ky*vx)*s + kz*d), 3) AS sz, round(any_value(e[1] + e[4] + e[7]), 3) AS fixed FROM m GROUP BY ALL"""
)
def torsion_set(spark, d):
    """Frames whose first torsion has been turned to 60 degrees: the angle, the sums of what has moved, and what stays."""
    f = staged(geometry.set_torsion(frames(spark, d), F.array(*(F.lit(i) for i in range(3, 21))), *(F.lit(i) for i in range(4)), F.lit(60.0)), "turned")
    xyz = F.col("xyz")
    at = lambda i: [v.cast("double") for v in geometry.atom(xyz, F.lit(i))]
    sums = [F.round(sum((at(i)[k] for i in range(4, 21)), at(3)[k]), 3).alias(f"s{c}") for k, c in enumerate("xyz")]
    fixed = F.round(at(0)[0] + at(1)[0] + at(2)[0], 3).alias("fixed")
    return f.select("mol_id", "frame", F.round(geometry.dihedral(*(geometry.atom(xyz, F.lit(i)) for i in range(4))), 3).alias("deg"), *sums, fixed)


@query(
    """WITH a AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, embedding AS e FROM embeddings),
n AS (SELECT *, sqrt(pow(e[4]-e[1]::DOUBLE,2)+pow(e[5]-e[2]::DOUBLE,2)+pow(e[6]-e[3]::DOUBLE,2)) AS lo, sqrt(pow(e[7]-e[1]::DOUBLE,2)+pow(e[8]-e[2]::DOUBLE,2)+pow(e[9]-e[3]::DOUBLE,2)) AS lh FROM a)
SELECT mol_id, frame, 'C1' AS atom_name, """
    + ", ".join(f"round(e[{k}]::DOUBLE, 4) AS {x}" for k, x in enumerate("xyz", 1))
    + " FROM n UNION ALL SELECT mol_id, frame, 'O1', "
    + ", ".join(f"round(e[{k}]::DOUBLE + (e[{k + 6}]::DOUBLE - e[{k}]::DOUBLE) / lh * lo, 4)" for k in (1, 2, 3))
    + " FROM n UNION ALL SELECT mol_id, frame, 'H1', "
    + ", ".join(f"round(e[{k}]::DOUBLE + (e[{k + 3}]::DOUBLE - e[{k}]::DOUBLE) / lo * lh, 4)" for k in (1, 2, 3))
    + " FROM n UNION ALL SELECT mol_id, frame, 'HO1', "
    + ", ".join(f"round(e[{k + 9}]::DOUBLE + e[{k}]::DOUBLE + (e[{k + 6}]::DOUBLE - e[{k}]::DOUBLE) / lh * lo - e[{k + 3}]::DOUBLE, 4)" for k in (1, 2, 3))
    + " FROM n"
)
def anomer_flip(spark, d):
    names = F.array(*(F.lit(x) for x in ("C1", "O1", "H1", "HO1")))
    long = frames(spark, d).select("mol_id", "frame", "xyz", F.posexplode(names).alias("i", "atom_name"))
    coords = long.select("mol_id", "frame", "atom_name", *(v.alias(c) for v, c in zip(geometry.atom(F.col("xyz"), F.col("i")), "xyz", strict=True)))
    return _rounded(geometry.flip_anomer(coords), x=4, y=4, z=4)


@query(
    """WITH a AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, embedding AS e, vec_id % 11 <> 0 AS whole FROM embeddings),
n AS (SELECT *, sqrt(pow(e[4]-e[1]::DOUBLE,2)+pow(e[5]-e[2]::DOUBLE,2)+pow(e[6]-e[3]::DOUBLE,2)) AS lo, sqrt(pow(e[7]-e[1]::DOUBLE,2)+pow(e[8]-e[2]::DOUBLE,2)+pow(e[9]-e[3]::DOUBLE,2)) AS lh FROM a),
s AS (SELECT *, ['4YA', '4YB', 'LFU'][frame % 3 + 1] AS old, CASE WHEN whole THEN ['4YB', '4YA', 'LFU'][frame % 3 + 1] ELSE ['4YA', '4YB', 'LFU'][frame % 3 + 1] END AS new FROM n)
SELECT mol_id, frame, 2 AS res_id, new AS res_name, 'C1' AS atom_name, """
    + ", ".join(f"round(e[{k}]::DOUBLE, 4) AS {x}" for k, x in enumerate("xyz", 1))
    + " FROM s UNION ALL SELECT mol_id, frame, 1, 'ROH', 'O1', "
    + ", ".join(f"round(CASE WHEN whole THEN e[{k}]::DOUBLE + (e[{k + 6}]::DOUBLE - e[{k}]::DOUBLE) / lh * lo ELSE e[{k + 3}]::DOUBLE END, 4)" for k in (1, 2, 3))
    + " FROM s UNION ALL SELECT mol_id, frame, 2, new, 'H1', "
    + ", ".join(f"round(CASE WHEN whole THEN e[{k}]::DOUBLE + (e[{k + 3}]::DOUBLE - e[{k}]::DOUBLE) / lo * lh ELSE e[{k + 6}]::DOUBLE END, 4)" for k in (1, 2, 3))
    + " FROM s UNION ALL SELECT mol_id, frame, 1, 'ROH', 'HO1', "
    + ", ".join(f"round(e[{k + 9}]::DOUBLE + e[{k}]::DOUBLE + (e[{k + 6}]::DOUBLE - e[{k}]::DOUBLE) / lh * lo - e[{k + 3}]::DOUBLE, 4)" for k in (1, 2, 3))
    + " FROM s WHERE whole"
)
def anomer_residues(spark, d):
    """The anomer flip over two residues: atoms moved and the residue's last letter turned, frames without HO1 left."""
    names = F.array(*(F.lit(x) for x in ("C1", "O1", "H1", "HO1")))
    long = frames(spark, d).select("mol_id", "frame", "xyz", F.posexplode(names).alias("i", "atom_name"))
    res = F.when(F.col("atom_name").isin("C1", "H1"), 2).otherwise(1)
    kind = F.element_at(F.array(F.lit("4YA"), F.lit("4YB"), F.lit("LFU")), (F.col("frame") % 3 + 1).cast("int"))
    coords = long.select("mol_id", "frame", res.alias("res_id"), F.when(res == 2, kind).otherwise("ROH").alias("res_name"), "atom_name", *(v.alias(c) for c, v in zip("xyz", geometry.atom(F.col("xyz"), F.col("i")), strict=True)))
    return _rounded(geometry.flip_residue(coords.where("atom_name <> 'HO1' or frame % 11 <> 0")), x=4, y=4, z=4)


FITS_SQL = """
WITH c AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, i, embedding[3*i+1]::DOUBLE AS x, embedding[3*i+2]::DOUBLE AS y, embedding[3*i+3]::DOUBLE AS z FROM embeddings, range(10) r(i)),
b AS (SELECT mol_id, min(frame) AS first FROM c GROUP BY mol_id),
j AS (SELECT c.*, r.x AS rx, r.y AS ry, r.z AS rz FROM c JOIN b ON b.mol_id = c.mol_id JOIN c r ON r.mol_id = c.mol_id AND r.frame = first AND r.i = c.i),
s AS (SELECT mol_id, frame, sqrt(avg(pow(x-rx,2) + pow(y-ry,2) + pow(z-rz,2))) AS before, (9 * (var_samp(x) + var_samp(y) + var_samp(z) + var_samp(rx) + var_samp(ry) + var_samp(rz))) AS g,
  10 * covar_pop(x, rx) AS xx, 10 * covar_pop(x, ry) AS xy, 10 * covar_pop(x, rz) AS xz, 10 * covar_pop(y, rx) AS yx, 10 * covar_pop(y, ry) AS yy, 10 * covar_pop(y, rz) AS yz,
  10 * covar_pop(z, rx) AS zx, 10 * covar_pop(z, ry) AS zy, 10 * covar_pop(z, rz) AS zz FROM j GROUP BY mol_id, frame),
h AS (  -- the singular values of the 3 x 3 covariances are the roots of the eigenvalues of its square
  SELECT *, xx*(yy*zz - yz*zy) - xy*(yx*zz - yz*zx) + xz*(yx*zy - yy*zx) AS det, xx*xx + xy*xy + xz*xz AS a, yx*yx + yy*yy + yz*yz AS d, zx*zx + zy*zy + zz*zz AS f,
    xx*yx + xy*yy + xz*yz AS b, xx*zx + xy*zy + xz*zz AS c, yx*zx + yy*zy + yz*zz AS e FROM s),
t AS (SELECT *, (a + d + f) / 3 AS m, sqrt((pow(a - (a+d+f)/3, 2) + pow(d - (a+d+f)/3, 2) + pow(f - (a+d+f)/3, 2) + 2*(b*b + c*c + e*e)) / 6) AS p FROM h),
u AS (SELECT *, acos(greatest(-1, least(1, ((a-m)*((d-m)*(f-m) - e*e) - b*(b*(f-m) - e*c) + c*(b*e - (d-m)*c)) / (2 * p*p*p)))) / 3 AS phi FROM t),
v AS (SELECT *, m + 2*p*cos(phi) AS l1, m + 2*p*cos(phi + 2*pi()/3) AS l3 FROM u),
w AS (SELECT *, sqrt(l1) + sqrt(greatest(0, 3*m - l1 - l3)) + sign(det) * sqrt(greatest(0, l3)) AS top FROM v)
SELECT mol_id, frame, round(before, 5) AS before, round(sqrt(greatest(0, g - 2 * top) / 10), 5) AS after FROM w WHERE g > 1e-9 AND before > 0"""


@query(FITS_SQL)
def superposition(spark, d):
    """Root mean square distance to each molecule's first frame, before and after superposition on ten atoms."""
    long = frames(spark, d).select("mol_id", "frame", "xyz", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("atom_index"))
    coords = long.select("mol_id", "frame", "atom_index", *(v.alias(c) for v, c in zip(geometry.atom(F.col("xyz"), F.col("atom_index")), "xyz", strict=True)))
    ref = coords.join(coords.groupBy("mol_id").agg(F.min("frame").alias("frame")), ["mol_id", "frame"], "left_semi").drop("frame")
    anchors = ref.where("atom_index < 10").select("mol_id", "atom_index")
    r = ref.select("mol_id", "atom_index", *(F.col(c).alias("r" + c) for c in "xyz"))
    gap = F.sqrt(F.avg(F.pow(F.col("x") - F.col("rx"), 2) + F.pow(F.col("y") - F.col("ry"), 2) + F.pow(F.col("z") - F.col("rz"), 2)))
    rms = lambda df, name: df.where("atom_index < 10").join(r, ["mol_id", "atom_index"]).groupBy("mol_id", "frame").agg(F.round(gap, 5).alias(name))
    return rms(coords, "before").where("before > 0").join(rms(geometry.superpose(coords, ref, anchors), "after"), ["mol_id", "frame"])


@query(FITS_SQL)
def superposition_fits(spark, d):
    """The same from the fits themselves, without moving an atom."""
    long = frames(spark, d).select("mol_id", "frame", "xyz", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("atom_index"))
    coords = long.select("mol_id", "frame", "atom_index", *(v.alias(c) for v, c in zip(geometry.atom(F.col("xyz"), F.col("atom_index")), "xyz", strict=True)))
    ref = coords.join(coords.groupBy("mol_id").agg(F.min("frame").alias("frame")), ["mol_id", "frame"], "left_semi").drop("frame")
    gap = F.sqrt(F.avg(F.pow(F.col("x") - F.col("rx"), 2) + F.pow(F.col("y") - F.col("ry"), 2) + F.pow(F.col("z") - F.col("rz"), 2)))
    before = coords.join(ref.select("mol_id", "atom_index", *(F.col(c).alias("r" + c) for c in "xyz")), ["mol_id", "atom_index"]).groupBy("mol_id", "frame").agg(F.round(gap, 5).alias("before"))
    found = geometry.fits(coords, ref, ref.select("mol_id", "atom_index")).select("mol_id", "frame", F.round("rmsd", 5).alias("after"))
    return before.where("before > 0").join(found, ["mol_id", "frame"])


def _mixture_sql(k: int, rounds: int) -> str:
    """Rounds of expectation maximisation from given labels, unrolled: g are responsibilities, m parameters."""
    names = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    out = POINTS + f", t AS (SELECT mol_id, count(*) AS total FROM p GROUP BY mol_id), g0 AS MATERIALIZED (SELECT p.* EXCLUDE (cluster), cluster % {k} AS j, 1.0::DOUBLE AS r, 0.0::DOUBLE AS l FROM p)"
    for i in range(rounds):
        cov = ", ".join(f"sum(r*{a}*{b}) / sum(r) - (sum(r*{a}) / sum(r)) * (sum(r*{b}) / sum(r)){' + 1e-6' if a == b else ''} AS {a}{b}" for a, b in names)
        out += f""", m{i} AS MATERIALIZED (SELECT *, greatest(xx*(yy*zz - yz*yz) - xy*(xy*zz - yz*xz) + xz*(xy*yz - yy*xz), 1e-30) AS det FROM (
  SELECT mol_id, j, sum(r) AS w, sum(r*x) / sum(r) AS mx, sum(r*y) / sum(r) AS my, sum(r*z) / sum(r) AS mz, {cov} FROM g{i} GROUP BY mol_id, j) WHERE w > 1e-9)
, d{i} AS (SELECT p.mol_id, frame, x, y, z, j, ln(w / total) - 0.5 * (ln(det) + 3 * ln(2 * pi()) + ((x-mx)*(x-mx)*(yy*zz - yz*yz) + (y-my)*(y-my)*(xx*zz - xz*xz) + (z-mz)*(z-mz)*(xx*yy - xy*xy)
  + 2 * ((x-mx)*(y-my)*(xz*yz - xy*zz) + (x-mx)*(z-mz)*(xy*yz - xz*yy) + (y-my)*(z-mz)*(xy*xz - xx*yz))) / det) AS d FROM p JOIN m{i} USING (mol_id) JOIN t USING (mol_id))
, g{i + 1} AS MATERIALIZED (SELECT mol_id, frame, x, y, z, j, exp(d - top) / sum(exp(d - top)) OVER (PARTITION BY mol_id, frame) AS r, top + ln(sum(exp(d - top)) OVER (PARTITION BY mol_id, frame)) AS l, d
  FROM (SELECT *, max(d) OVER (PARTITION BY mol_id, frame) AS top FROM d{i}))"""
    own = f"(SELECT mol_id, frame, arg_max(j, (d, -j)) AS j FROM g{rounds} GROUP BY mol_id, frame)"
    like = f"(SELECT mol_id, sum(l) AS l FROM (SELECT mol_id, frame, any_value(l) AS l FROM g{rounds - 1} GROUP BY mol_id, frame) GROUP BY mol_id)"
    return out + f" SELECT mol_id, j::INT AS cluster, count(*) AS n, round(any_value(f.l), 4) AS likelihood FROM {own} o JOIN {like} f USING (mol_id) GROUP BY mol_id, j"


@query(_mixture_sql(3, 5))
def mixture_fit(spark, d):
    """Five rounds of a mixture of three from given labels: sizes of the components and the likelihood."""
    p = points(spark, d)
    start = p.select("mol_id", "frame", (F.col("cluster") % 3).alias("cluster"))
    members, fits = clusters.mixture(p.drop("cluster"), 3, 5, start=start, tolerance=0.0)
    n = members.groupBy("mol_id", "cluster").agg(F.count("*").alias("n"))
    return n.join(fits.select("mol_id", F.round("l", 4).alias("likelihood")), "mol_id")


@query(None)
def mixture_clusters(spark, d):
    return clusters.gaussian_mixture(points(spark, d).drop("cluster"), 5, rounds=8).groupBy("mol_id", "cluster").agg(F.count("*").alias("n"))


def _modes_sql(rounds: int) -> str:
    """Mean shift from each cluster's mean with Scott's bandwidth, its rounds unrolled."""
    out = POINTS + """, m0 AS MATERIALIZED (SELECT mol_id, cluster, count(*) AS n, min(frame) AS first, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz,
  greatest(pow(count(*), -1/7.0) * (coalesce(stddev_samp(x), 0) + coalesce(stddev_samp(y), 0) + coalesce(stddev_samp(z), 0)) / 3, 1e-9) AS h FROM p GROUP BY ALL)"""
    for i in range(rounds):
        out += f""", m{i + 1} AS MATERIALIZED (SELECT mol_id, cluster, n, first, sum(w*x) / sum(w) AS cx, sum(w*y) / sum(w) AS cy, sum(w*z) / sum(w) AS cz, h
  FROM (SELECT p.*, n, first, h, exp(-(pow(x-cx,2) + pow(y-cy,2) + pow(z-cz,2)) / (2*h*h)) AS w FROM p JOIN m{i} USING (mol_id, cluster)) GROUP BY mol_id, cluster, n, first, h)"""
    return out + f" SELECT mol_id, cluster, CASE WHEN n < 5 THEN first ELSE arg_min(frame, (pow(x-cx,2) + pow(y-cy,2) + pow(z-cz,2), frame)) END AS frame FROM p JOIN m{rounds} USING (mol_id, cluster) GROUP BY mol_id, cluster, n, first"


@query(_modes_sql(10))
def density_modes(spark, d):
    p = points(spark, d)
    return clusters.density_mode(p.drop("cluster"), p.select("mol_id", "frame", "cluster"), rounds=10)


@query(
    POINTS
    + """, g AS (SELECT mol_id, cluster, frame, 5 * x AS x, 5 * y AS y, 5 * z AS z FROM p),
n AS (SELECT mol_id, cluster, count(*) AS n, CASE WHEN count(*) < 10 THEN 2 WHEN count(*) < 20 THEN 3 ELSE least(5, count(*) // 5) END AS f, CASE WHEN count(*) < 10 THEN 5 WHEN count(*) < 20 THEN 10 ELSE 20 END AS s FROM g GROUP BY ALL HAVING count(*) > 1),
o AS (SELECT *, row_number() OVER (PARTITION BY mol_id, cluster ORDER BY frame) - 1 AS i FROM g JOIN n USING (mol_id, cluster)),
k AS MATERIALIZED (SELECT *, CASE WHEN i < (n % f) * (n // f + 1) THEN i // (n // f + 1) ELSE n % f + (i - (n % f) * (n // f + 1)) // (n // f) END AS fold FROM o),
d AS (SELECT a.mol_id, a.cluster, a.frame, a.s, pow(a.x-b.x,2) + pow(a.y-b.y,2) + pow(a.z-b.z,2) AS d2 FROM k a JOIN k b ON a.mol_id = b.mol_id AND a.cluster = b.cluster AND a.fold <> b.fold),
t AS (SELECT *, 0.1 + 0.9 * unnest(range(0, s)) / (s - 1) AS h FROM d),
e AS (SELECT mol_id, cluster, frame, h, ln(greatest(sum(exp(-d2 / (2*h*h))), 1e-300)) - ln(count(*)) - 3 * ln(h) - 1.5 * ln(2 * pi()) AS l FROM t GROUP BY mol_id, cluster, frame, h),
l AS (SELECT mol_id, cluster, h, sum(l) AS l FROM e GROUP BY ALL)
SELECT mol_id, cluster, round(arg_max(h, (l, -h)), 6) AS h FROM l GROUP BY ALL"""
)
def held_out_bandwidths(spark, d):
    """The bandwidth that tells held-out members best, the points spread out so that candidates differ."""
    p = points(spark, d).withColumns({a: 5 * F.col(a) for a in "xyz"})
    return _rounded(clusters.cross_validated_bandwidth(p.drop("cluster"), p.select("mol_id", "frame", "cluster")), h=6)


@query(None)
def pca_scores(spark, d):
    """Three principal components of the landscape of all atoms, all molecules together."""
    features = geometry.landscape(frames(spark, d), range(21))
    scores, _ = landscapes.pca(features, 3)
    return scores.select("mol_id", "frame", *(F.round(F.element_at("pc", i + 1), 4).alias(f"PC{i + 1}") for i in range(3)))


LANDSCAPE = """
WITH c AS (SELECT vec_id % 5 AS mol_id, vec_id AS frame, i, embedding[3*i+1]::DOUBLE AS x, embedding[3*i+2]::DOUBLE AS y, embedding[3*i+3]::DOUBLE AS z FROM embeddings, range({atoms}) r(i)),
f AS MATERIALIZED (SELECT a.mol_id, a.frame, a.i * 100 + b.i AS pair, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2))::FLOAT::DOUBLE AS v FROM c a JOIN c b ON a.mol_id = b.mol_id AND a.frame = b.frame AND a.i > b.i),
m AS (SELECT mol_id, pair, avg(v) AS mean, coalesce(nullif(stddev_samp(v), 0), 1) AS sd FROM f GROUP BY ALL),
s AS MATERIALIZED (SELECT f.mol_id, frame, pair, (v - mean) / sd AS v FROM f JOIN m USING (mol_id, pair))"""


@query(
    LANDSCAPE.format(atoms=10)
    + """, corr AS (SELECT a.mol_id, a.pair AS p, b.pair AS q, sum(a.v * b.v) / (count(*) - 1) AS r FROM s a JOIN s b ON a.mol_id = b.mol_id AND a.frame = b.frame GROUP BY ALL)
SELECT mol_id, round(sum(r) FILTER (p = q), 4) AS variance, round(sum(r * r), 3) AS squared, 0.0::DOUBLE AS between, 0.0::DOUBLE AS mean, true AS falling, 1.0::DOUBLE AS shares FROM corr GROUP BY mol_id"""
)
def pca_invariants(spark, d):
    """All components of ten atoms' landscape: their variances sum to the features', the squares to the squared
    correlations; no two are correlated; they have mean 0 and fall; the shares sum to 1."""
    scores, model = landscapes.pca(geometry.landscape(frames(spark, d), range(10)), 45)
    flat = staged(scores.select("mol_id", "frame", F.posexplode("pc").alias("i", "v")), "flat")
    var = flat.groupBy("mol_id", "i").agg(F.var_samp("v").alias("var"), F.avg("v").alias("mean"))
    shares = model.select("mol_id", (F.col("component") - 1).alias("i"), "evr", F.coalesce(F.lag("evr").over(W.partitionBy("mol_id").orderBy("component")), F.lit(1.0)).alias("last"))
    each = var.join(shares, ["mol_id", "i"]).groupBy("mol_id").agg(
        F.round(F.sum("var"), 4).alias("variance"), F.round(F.sum(F.col("var") * F.col("var")), 3).alias("squared"), F.abs(F.round(F.max(F.abs("mean")), 6)).alias("mean"),
        F.min(F.col("evr") <= F.col("last") + 1e-12).alias("falling"), F.round(F.sum("evr"), 6).alias("shares"),
    )
    other = flat.select("mol_id", "frame", F.col("i").alias("j"), F.col("v").alias("w"))
    between = flat.join(other, ["mol_id", "frame"]).where("i < j").groupBy("mol_id", "i", "j").agg(F.avg(F.col("v") * F.col("w")).alias("c"))
    return each.join(between.groupBy("mol_id").agg(F.abs(F.round(F.max(F.abs("c")), 6)).alias("between")), "mol_id")


@query(
    LANDSCAPE.format(atoms=6)
    + """, b AS (SELECT mol_id, min(frame) AS frame FROM s GROUP BY mol_id)
SELECT s.mol_id, s.frame, round(sum(pow(s.v - r.v, 2)), 5) AS d2 FROM s JOIN b ON b.mol_id = s.mol_id JOIN s r ON r.mol_id = b.mol_id AND r.frame = b.frame AND r.pair = s.pair GROUP BY ALL"""
)
def pca_distances(spark, d):
    """All components of six atoms' landscape keep its distances: each frame's squared one to the molecule's first."""
    scores, _ = landscapes.pca(geometry.landscape(frames(spark, d), range(6)), 15)
    scores = staged(scores, "scores")
    first = scores.groupBy("mol_id").agg(F.min_by("pc", "frame").alias("first"))
    gap = F.aggregate(F.zip_with("pc", "first", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)
    return scores.join(first, "mol_id").select("mol_id", "frame", F.round(gap, 5).alias("d2"))


@query(None)
def pca_variance(spark, d):
    """Shares of variance of the components, and their running sum."""
    _, model = landscapes.pca(geometry.landscape(frames(spark, d), range(21)), 5)
    return _rounded(stats.cumulative(model, ["mol_id"], "component", "evr", "cumulative"), evr=5, cumulative=5)
