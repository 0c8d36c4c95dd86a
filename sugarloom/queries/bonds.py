"""Graph operators over lineitem: the parts and suppliers of an order as a bond graph.

Part numbers modulo 40 are atoms and so are supplier numbers modulo 10 above them; a molecule is a block of
orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.operators import graph, neighbours

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read_bonds(spark: SparkSession, d: str) -> DataFrame:
    """As they are read, some of them repeated."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    return li.select(F.floor(F.col("l_orderkey") / 16).alias("mol_id"), (F.col("l_partkey") % 40).alias("a"), (40 + F.col("l_suppkey") % 10).alias("b"))


def bonds(spark: SparkSession, d: str) -> DataFrame:
    return graph.dealt_once(read_bonds(spark, d))


def nodes(b: DataFrame) -> DataFrame:
    return b.select("mol_id", F.explode(F.array("a", "b")).alias("node")).distinct()


def atoms(b: DataFrame) -> DataFrame:
    """Names, elements and residues made from the atom's number."""
    n = F.col("node")
    name = F.element_at(F.array(*(F.lit(x) for x in NAMES)), (n % len(NAMES) + 1).cast("int"))
    return nodes(b).select("mol_id", n.alias("atom_index"), (100 + n).alias("serial"), name.alias("name"), F.substring(name, 1, 1).alias("element"), (n % 2).alias("res_id"))


NAMES = ("C1", "O5", "O4", "C4", "C5", "C6", "O6", "H1")
BONDS = "b AS (SELECT DISTINCT l_orderkey // 16 AS mol_id, l_partkey % 40 AS a, 40 + l_suppkey % 10 AS b FROM lineitem), n AS (SELECT mol_id, a AS node FROM b UNION SELECT mol_id, b FROM b), e AS (SELECT mol_id, a AS u, b AS v FROM b UNION SELECT mol_id, b, a FROM b)"
ATOMS = ", atoms AS (SELECT mol_id, node AS atom_index, ['" + "','".join(NAMES) + "'][node % 8 + 1] AS name, ['" + "','".join(NAMES) + "'][node % 8 + 1][1] AS element, node % 2 AS res_id FROM n)"


@query("WITH RECURSIVE " + BONDS + ", r AS (SELECT mol_id, node AS s, node AS t FROM n UNION SELECT r.mol_id, s, v FROM r JOIN e ON e.mol_id = r.mol_id AND e.u = r.t) SELECT mol_id, s AS node, min(t) AS component FROM r GROUP BY ALL")
def bond_components(spark, d):
    b = read_bonds(spark, d)
    return graph.components(nodes(b), b)


@query("WITH " + BONDS + " SELECT mol_id, u AS node, count(*) AS degree FROM e GROUP BY ALL")
def bond_degrees(spark, d):
    return graph.degrees(bonds(spark, d))


SIDE = (
    "WITH RECURSIVE "
    + BONDS
    + ", r AS (SELECT mol_id, a AS x, b AS y, a AS node FROM b UNION SELECT r.mol_id, x, y, v FROM r JOIN e ON e.mol_id = r.mol_id AND e.u = r.node WHERE NOT (u = x AND v = y) AND NOT (u = y AND v = x))"
)


@query(SIDE + " SELECT mol_id, x, y, count(*) AS n, sum(node)::BIGINT AS total FROM r GROUP BY ALL")
def cut_sides(spark, d):
    """How many atoms hang on the first atom of each bond once it is cut, and the sum of their numbers."""
    b = bonds(spark, d)
    cuts = b.select("mol_id", F.struct("a", "b").alias("cut"), F.col("a").alias("x"), F.col("b").alias("y"))
    return graph.cut_totals(read_bonds(spark, d), cuts).drop("cut")


@query(SIDE + " SELECT mol_id, x, y, node FROM r WHERE x = 3")
def cut_members(spark, d):
    """The atoms that hang on atom 3 once one of its bonds is cut."""
    b = bonds(spark, d)
    cuts = b.where("a = 3").select("mol_id", F.struct("a", "b").alias("cut"), F.col("a").alias("x"), F.col("b").alias("y"))
    return graph.cut_side(read_bonds(spark, d), cuts).drop("cut")


@query(SIDE + " SELECT mol_id, x AS a, y AS b FROM r WHERE node = y")
def ring_bonds(spark, d):
    return graph.ring_bonds(read_bonds(spark, d))


@query(
    "WITH "
    + BONDS
    + ATOMS
    + """, h AS (SELECT * FROM atoms WHERE element <> 'H'),
c1 AS (SELECT mol_id, atom_index AS c1, res_id AS r1 FROM h WHERE name = 'C1'),
ring AS (SELECT c1.mol_id, c1, min(h.atom_index) AS o5 FROM c1 JOIN e ON e.mol_id = c1.mol_id AND e.u = c1 JOIN h ON h.mol_id = e.mol_id AND h.atom_index = e.v WHERE h.name = 'O5' AND h.res_id = r1 GROUP BY ALL),
lk AS (SELECT c1.mol_id, c1, o.atom_index AS o, c.atom_index AS c FROM c1 JOIN e e1 ON e1.mol_id = c1.mol_id AND e1.u = c1 JOIN h o ON o.mol_id = e1.mol_id AND o.atom_index = e1.v
  JOIN e e2 ON e2.mol_id = o.mol_id AND e2.u = o.atom_index JOIN h c ON c.mol_id = e2.mol_id AND c.atom_index = e2.v
  WHERE o.element = 'O' AND o.name <> 'O5' AND c.element = 'C' AND c.atom_index <> c1 AND c.res_id <> r1),
nx AS (SELECT lk.mol_id, c1, o, c, n.atom_index AS n FROM lk JOIN e ON e.mol_id = lk.mol_id AND e.u = c JOIN h n ON n.mol_id = e.mol_id AND n.atom_index = e.v WHERE n.atom_index <> o AND n.element IN ('O', 'C')
  QUALIFY row_number() OVER (PARTITION BY lk.mol_id, c1, o, c ORDER BY n.element <> 'O', n.atom_index) = 1)
SELECT DISTINCT mol_id, 'phi' AS kind, o5 AS a, c1 AS b, o AS c, c AS d FROM lk JOIN ring USING (mol_id, c1) UNION SELECT DISTINCT mol_id, 'psi', c1, o, c, n FROM nx"""
)
def linkage_torsions(spark, d):
    b = bonds(spark, d)
    return graph.linkages(atoms(b), b)


@query(
    "WITH "
    + BONDS
    + ATOMS.replace("node % 2 AS res_id", "0 AS res_id")
    + """,
x AS (SELECT e.mol_id, u, v, p.name AS un, q.name AS vn FROM e JOIN atoms p ON p.mol_id = e.mol_id AND p.atom_index = u JOIN atoms q ON q.mol_id = e.mol_id AND q.atom_index = v)
SELECT f.mol_id, f.u AS a, f.v AS b, g.v AS c, h.v AS d FROM x f JOIN x g ON g.mol_id = f.mol_id AND g.u = f.v JOIN x h ON h.mol_id = g.mol_id AND h.u = g.v
WHERE f.un = 'C4' AND f.vn = 'C5' AND g.vn = 'C6' AND h.vn = 'O6'"""
)
def omega_torsions(spark, d):
    b = bonds(spark, d)
    return graph.omegas(atoms(b).withColumn("res_id", F.lit(0)), b)


@query(
    SIDE
    + ATOMS
    + """, ring AS (SELECT mol_id, x, y FROM r WHERE node = y), deg AS (SELECT mol_id, u, count(*) AS k FROM e GROUP BY ALL),
o AS (SELECT b.* FROM b ANTI JOIN ring ON ring.mol_id = b.mol_id AND x = a AND y = b JOIN deg p ON p.mol_id = b.mol_id AND p.u = a AND p.k > 1 JOIN deg q ON q.mol_id = b.mol_id AND q.u = b AND q.k > 1),
s AS (SELECT o.*, e.v, t.element <> 'O' AS late FROM o JOIN e ON e.mol_id = o.mol_id AND e.u = o.a AND e.v <> o.b JOIN atoms t ON t.mol_id = e.mol_id AND t.atom_index = e.v QUALIFY row_number() OVER (PARTITION BY o.mol_id, a, b ORDER BY late, e.v) = 1),
t AS (SELECT o.*, e.v, t.element <> 'O' AS late FROM o JOIN e ON e.mol_id = o.mol_id AND e.u = o.b AND e.v <> o.a JOIN atoms t ON t.mol_id = e.mol_id AND t.atom_index = e.v QUALIFY row_number() OVER (PARTITION BY o.mol_id, a, b ORDER BY late, e.v) = 1)
SELECT s.mol_id, s.v AS a, s.a AS b, s.b AS c, t.v AS d FROM s JOIN t ON s.mol_id = t.mol_id AND s.a = t.a AND s.b = t.b"""
)
def rotatable_bonds(spark, d):
    b = read_bonds(spark, d)
    return graph.rotatable(b, atoms(b), spark.createDataFrame([], "mol_id long, b long, c long"))


@query("WITH " + BONDS + " SELECT mol_id, a, b FROM b")
def normal_bonds(spark, d):
    """Bonds given by serials, repeated and either way round, as distinct pairs of atom indices."""
    b = bonds(spark, d)
    serials = b.select("mol_id", (100 + F.col("b")).alias("serial1"), (100 + F.col("a")).alias("serial2"))
    return graph.normal_bonds(serials.union(serials), atoms(b))


@query("WITH " + BONDS + ", t AS (SELECT mol_id, a, b, a + 1 AS c, b + 1 AS d FROM b), k AS (SELECT mol_id, a, b, c, d FROM t UNION ALL SELECT mol_id, d, c, b, a FROM t WHERE a % 2 = 0) SELECT DISTINCT mol_id, 'first' AS method, a, b, c, d FROM t WHERE len(list_distinct([a, b, c, d])) = 4")
def torsion_catalogue(spark, d):
    """Torsions found twice, once of them backwards: one row each, from the method that comes first."""
    t = bonds(spark, d).select("mol_id", F.lit("first").alias("method"), "a", "b", (F.col("a") + 1).alias("c"), (F.col("b") + 1).alias("d"))
    back = t.where("a % 2 = 0").select("mol_id", F.lit("second").alias("method"), F.col("d").alias("a"), F.col("c").alias("b"), F.col("b").alias("c"), F.col("a").alias("d"))
    return graph.catalogue(t.union(back), F.col("method"))


@query(
    SIDE
    + ATOMS.replace("node % 2 AS res_id", "node // 8 % 2 AS res_id")
    + """, h AS (SELECT * FROM atoms WHERE element <> 'H'),
c1 AS (SELECT mol_id, atom_index AS c1, res_id AS r1 FROM h WHERE name = 'C1'),
rg AS (SELECT c1.mol_id, c1, min(h.atom_index) AS o5 FROM c1 JOIN e ON e.mol_id = c1.mol_id AND e.u = c1 JOIN h ON h.mol_id = e.mol_id AND h.atom_index = e.v WHERE h.name = 'O5' AND h.res_id = r1 GROUP BY ALL),
lk AS (SELECT c1.mol_id, c1, o.atom_index AS o, c.atom_index AS c FROM c1 JOIN e e1 ON e1.mol_id = c1.mol_id AND e1.u = c1 JOIN h o ON o.mol_id = e1.mol_id AND o.atom_index = e1.v
  JOIN e e2 ON e2.mol_id = o.mol_id AND e2.u = o.atom_index JOIN h c ON c.mol_id = e2.mol_id AND c.atom_index = e2.v
  WHERE o.element = 'O' AND o.name <> 'O5' AND c.element = 'C' AND c.atom_index <> c1 AND c.res_id <> r1),
nx AS (SELECT lk.mol_id, c1, o, c, n.atom_index AS n FROM lk JOIN e ON e.mol_id = lk.mol_id AND e.u = c JOIN h n ON n.mol_id = e.mol_id AND n.atom_index = e.v WHERE n.atom_index <> o AND n.element IN ('O', 'C')
  QUALIFY row_number() OVER (PARTITION BY lk.mol_id, c1, o, c ORDER BY n.element <> 'O', n.atom_index) = 1),
xs AS (SELECT e.mol_id, u, v, p.name AS un, q.name AS vn FROM e JOIN atoms p ON p.mol_id = e.mol_id AND p.atom_index = u JOIN atoms q ON q.mol_id = e.mol_id AND q.atom_index = v WHERE p.res_id = q.res_id),
nm AS (SELECT mol_id, 1 AS o, 'phi' AS method, o5 AS a, c1 AS b, o AS c, c AS d FROM lk JOIN rg USING (mol_id, c1) UNION SELECT mol_id, 2, 'psi', c1, o, c, n FROM nx
  UNION SELECT f.mol_id, 3, 'omega', f.u, f.v, g.v, k.v FROM xs f JOIN xs g ON g.mol_id = f.mol_id AND g.u = f.v JOIN xs k ON k.mol_id = g.mol_id AND k.u = g.v WHERE f.un = 'C4' AND f.vn = 'C5' AND g.vn = 'C6' AND k.vn = 'O6'),
ring AS (SELECT mol_id, x, y FROM r WHERE node = y), deg AS (SELECT mol_id, u, count(*) AS k FROM e GROUP BY ALL),
ct AS (SELECT DISTINCT mol_id, least(b, c) AS a, greatest(b, c) AS b FROM nm),
op AS (SELECT b.* FROM b ANTI JOIN ring ON ring.mol_id = b.mol_id AND x = a AND y = b ANTI JOIN ct ON ct.mol_id = b.mol_id AND ct.a = b.a AND ct.b = b.b JOIN deg p ON p.mol_id = b.mol_id AND p.u = b.a AND p.k > 1 JOIN deg q ON q.mol_id = b.mol_id AND q.u = b.b AND q.k > 1),
s AS (SELECT op.*, e.v FROM op JOIN e ON e.mol_id = op.mol_id AND e.u = op.a AND e.v <> op.b JOIN atoms t ON t.mol_id = e.mol_id AND t.atom_index = e.v QUALIFY row_number() OVER (PARTITION BY op.mol_id, a, b ORDER BY t.element <> 'O', e.v) = 1),
t AS (SELECT op.*, e.v FROM op JOIN e ON e.mol_id = op.mol_id AND e.u = op.b AND e.v <> op.a JOIN atoms t ON t.mol_id = e.mol_id AND t.atom_index = e.v QUALIFY row_number() OVER (PARTITION BY op.mol_id, a, b ORDER BY t.element <> 'O', e.v) = 1),
al AS (SELECT * FROM nm UNION ALL SELECT s.mol_id, 4, 'other', s.v, s.a, s.b, t.v FROM s JOIN t ON s.mol_id = t.mol_id AND s.a = t.a AND s.b = t.b)
SELECT mol_id, method, a, b, c, d FROM al WHERE len(list_distinct([a, b, c, d])) = 4 QUALIFY row_number() OVER (PARTITION BY mol_id, least([a, b, c, d], [d, c, b, a]) ORDER BY o, a, b, c, d) = 1"""
)
def full_torsion_catalogue(spark, d):
    """phi, psi, omega and other torsions of all molecules in one catalogue, residues being blocks of eight atoms."""
    b = bonds(spark, d)
    return graph.full_catalogue(atoms(b).withColumn("res_id", F.floor(F.col("atom_index") / 8) % 2), b)


@query(None)
def stitched_components(spark, d):
    """Components of each molecule before and after its closest pairs have been bonded."""
    b = read_bonds(spark, d)
    at = atoms(b).withColumns({"x": F.sin("atom_index"), "y": F.cos(F.col("atom_index") * 2.0), "z": F.col("atom_index") * 0.01})
    n = nodes(b)
    count = lambda df, name: graph.components(n, df).groupBy("mol_id").agg(F.countDistinct("component").alias(name))
    return count(b, "before").join(count(graph.stitch(at, b), "after"), "mol_id")


def order_bonds(spark: SparkSession, d: str) -> DataFrame:
    """An order as a molecule: its parts modulo 40 and suppliers modulo 10 as atoms, mostly in several components. Some bonds
    are repeated."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    return li.select(F.col("l_orderkey").alias("mol_id"), (F.col("l_partkey") % 40).alias("a"), (40 + F.col("l_suppkey") % 10).alias("b"))


def placed(b: DataFrame) -> DataFrame:
    """Atoms with whole numbers as coordinates, so that distances are exact."""
    n = F.col("atom_index")
    at = nodes(b).select("mol_id", F.col("node").alias("atom_index"))
    return at.withColumns({"x": (n * 37 % 101).cast("double"), "y": (n * 59 % 103).cast("double"), "z": (n * n % 97).cast("double")})


ACROSS = (
    "WITH RECURSIVE "
    + BONDS.replace("l_orderkey // 16", "l_orderkey")
    + """, r AS (SELECT mol_id, node AS s, node AS t FROM n UNION SELECT r.mol_id, s, v FROM r JOIN e ON e.mol_id = r.mol_id AND e.u = r.t),
p AS (SELECT mol_id, s AS node, min(t) AS component, s * 37 % 101 AS x, s * 59 % 103 AS y, s * s % 97 AS z FROM r GROUP BY mol_id, s),
pr AS (SELECT p.mol_id, p.component, q.component AS other_group, (p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2 AS d2, least(p.node, q.node) AS a, greatest(p.node, q.node) AS b
  FROM p JOIN p q ON q.mol_id = p.mol_id AND q.component <> p.component)"""
)


@query(ACROSS + " SELECT mol_id, component, other_group, d2::DOUBLE AS d2, a, b FROM pr QUALIFY row_number() OVER (PARTITION BY mol_id, component ORDER BY d2, a, b) = 1")
def nearest_components(spark, d):
    """The closest pair of atoms from each component of an order to another one."""
    b = order_bonds(spark, d)
    at = placed(b)
    parts = graph.components(nodes(b), b)
    return neighbours.nearest_across(at.withColumnRenamed("atom_index", "node").join(parts, ["mol_id", "node"]))


@query(
    ACROSS
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY mol_id ORDER BY d2, a, b) AS o FROM pr WHERE component < other_group QUALIFY row_number() OVER (PARTITION BY mol_id, component, other_group ORDER BY d2, a, b) = 1),
w AS (SELECT mol_id, o, component AS at FROM k UNION SELECT w.mol_id, w.o, CASE WHEN k.component = w.at THEN k.other_group ELSE k.component END FROM w JOIN k ON k.mol_id = w.mol_id AND k.o < w.o AND (k.component = w.at OR k.other_group = w.at))
SELECT mol_id, a, b FROM b UNION SELECT mol_id, a, b FROM k ANTI JOIN w ON w.mol_id = k.mol_id AND w.o = k.o AND w.at = k.other_group"""
)
def stitched_bonds(spark, d):
    """Bonds of each order, and those that join its components: of the pairs across, one whose ends shorter pairs do not
    already join."""
    b = order_bonds(spark, d)
    return graph.stitch(placed(b), b)
