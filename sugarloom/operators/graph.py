"""Graphs of bonds: components, ring bonds, cut sides, linkages, for all molecules at once.

bonds are rows (mol_id, a, b) with a < b; atoms rows (mol_id, atom_index, name, element, res_id). Molecules of few bonds
are dealt to tasks once and handled there (see molecules); of others, rounds of loops grow with the logarithm of a
molecule's atoms, rows with its bonds. A bond that is there twice does no harm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sugarloom.operators import molecules
from sugarloom.operators.components import connected_components
from sugarloom.operators.geometry import heavy
from sugarloom.operators.neighbours import finite, nearest_across
from sugarloom.operators.staging import drop_stage, staged

KEYS = ["mol_id"]
#: Bonds a task that are made to differ.
BOND_ROWS = 250_000


def normal_bonds(bonds: DataFrame, atoms: DataFrame) -> DataFrame:
    """bonds(mol_id, serial1, serial2) to distinct (mol_id, a, b): serials as atom indices, smaller first, no loops."""
    at = lambda n: atoms.select("mol_id", F.col("serial").alias(f"serial{n}"), F.col("atom_index").alias(f"i{n}"))
    once = bonds.select("mol_id", "serial1", "serial2").distinct()  # so repeats are not joined
    both = once.join(at(1), ["mol_id", "serial1"]).join(at(2), ["mol_id", "serial2"]).where("i1 <> i2")
    return both.select("mol_id", F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b")).distinct()


def dealt_once(bonds: DataFrame) -> DataFrame:
    """bonds(mol_id, a, b, ...) of a molecule, each once. Those of molecules of few rows are dealt to tasks by molecule first, so that repeats
    fall out where later steps by molecule find them, without another shuffle, and no task that reads a file holds its
    bonds in a table by hash; a larger molecule is dealt by all columns."""
    small, large, tasks = molecules.parted(bonds, KEYS, [], per_task=BOND_ROWS)
    out = [] if small is None else [small.repartition(tasks, *KEYS).distinct()]
    if large is not None:
        out.append(large.distinct())
    return reduce(DataFrame.union, out)


def both_ways(bonds: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Every bond from either end; bonds are read once."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    return bonds.select(*keys, ends.alias("e")).select(*keys, "e.*")


def components(nodes: DataFrame, bonds: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """nodes(keys, node), bonds(keys, a, b) to (keys, node, component): the smallest node that can be reached; nodes of no
    bond are components of their own. Large graphs go by stars (see connected_components())."""
    found = linked(bonds, keys).withColumnRenamed("component", "least")
    return nodes.select(*keys, "node").distinct().join(found, [*keys, "node"], "left").select(*keys, "node", F.coalesce("least", "node").alias("component"))


def linked(bonds: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """bonds(keys, a, b) to (keys, node, component) of the nodes of all bonds."""
    small, large, tasks = molecules.parted(_whole(bonds, keys), keys, "ab")
    out = []
    if small is not None:
        out.append(_typed(molecules.by_molecule(small, keys, tasks, molecules.component_rows, "node: long, component: long"), bonds, "node", "component"))
    if large is not None:
        out.append(connected_components(large, "graph", keys))
    return reduce(DataFrame.union, out)


def _whole(bonds: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """No loops, and no bonds of missing ends or keys."""
    there = F.col("a") != F.col("b")
    for k in keys:
        there = there & F.col(k).isNotNull()
    return bonds.select(*keys, "a", "b").where(there)


def _typed(df: DataFrame, bonds: DataFrame, *names: str) -> DataFrame:
    """df with columns of nodes as bonds have them."""
    kind = bonds.schema["a"].dataType
    return df.withColumns({c: F.col(c).cast(kind) for c in names})


def _jumped(ends: DataFrame) -> DataFrame:
    """Each (mol_id, c, to) led on to where its `to` leads."""
    on = ends.select("mol_id", F.col("c").alias("to"), F.col("to").alias("end"))
    return ends.join(on, ["mol_id", "to"], "left").select("mol_id", "c", F.coalesce("end", "to").alias("to"))


def spanning_forest(bonds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """bonds(mol_id, a, b) to the bonds of a spanning tree of every component, and (mol_id, node, root) of all nodes.

    Boruvka's rounds: every group of nodes that has bonds to others takes the one that comes first by hash, and hooks on to
    the group at its end; of two groups that take the same bond the smaller stays. So no cycle arises, at least half of the
    groups are gone, and rounds grow with the logarithm of the nodes; each reads one bond of any two groups.
    """
    order = F.xxhash64(F.least("u", "v"), F.greatest("u", "v"))
    edges = staged(both_ways(bonds).distinct().select("mol_id", F.col("u").alias("c"), F.col("v").alias("to"), order.alias("h"), "u", "v"), "edges")
    root = staged(edges.select("mol_id", F.col("c").alias("node")).distinct(), "nodes").withColumn("root", F.col("node"))
    trees, hooks = [], []
    while edges.limit(1).count():
        best = F.min(F.struct("h", F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "to"))
        taken = staged(edges.groupBy("mol_id", "c").agg(best.alias("e")).select("mol_id", "c", "e.*"), "hooks")
        trees.append(taken.select("mol_id", "a", "b").distinct())
        back = taken.select("mol_id", F.col("c").alias("to"), F.col("to").alias("c"), F.lit(True).alias("mutual"))
        hook = taken.join(back, ["mol_id", "c", "to"], "left").where("mutual IS NULL OR c > to").select("mol_id", "c", "to")
        ends = staged(_jumped(_jumped(hook)), "hooks")
        hooks += [taken, ends]
        # groups that hook on to groups that hook on: to the end of the chain, which doubles what it skips
        while ends.join(ends.select("mol_id", F.col("c").alias("to")), ["mol_id", "to"], "left_semi").limit(1).count():
            ends = staged(_jumped(_jumped(ends)), "hooks")
            hooks.append(ends)
        new = edges
        for side in ("c", "to"):
            moved = ends.select("mol_id", F.col("c").alias(side), F.col("to").alias("end"))
            new = new.join(moved, ["mol_id", side], "left").withColumn(side, F.coalesce("end", side)).drop("end")
        new = staged(new.where("c <> to").groupBy("mol_id", "c", "to").agg(F.min(F.struct("h", "u", "v")).alias("e")).select("mol_id", "c", "to", "e.*"), "edges")
        drop_stage(edges)
        edges = new
        last = ends.select("mol_id", F.col("c").alias("root"), F.col("to").alias("end"))
        root = root.join(last, ["mol_id", "root"], "left").select("mol_id", "node", F.coalesce("end", "root").alias("root"))
    tree = reduce(DataFrame.union, trees) if trees else bonds.select("mol_id", "a", "b").limit(0)
    out = staged(tree, "forest"), staged(root, "roots")
    for x in (edges, *hooks):
        drop_stage(x)
    return out


def rooted(bonds: DataFrame) -> DataFrame:
    """bonds(mol_id, a, b) to (mol_id, node, root, parent, begin, end, n, total, open) of all nodes.

    A tour walks every tree of a spanning forest along each bond twice, from each arc to the next neighbour's at its end;
    an arc's place, and all sums to the tour's end, come from doubling what each arc skips, so rounds grow with the
    logarithm of the nodes. begin and end are the places of the arcs into and out of a node: those of the nodes below it
    lie between. n and total count and sum the nodes below it, itself included. open: bonds outside the tree lead from
    there to other nodes, so the bond to the parent is in a ring: the exclusive or of two random 64-bit labels of these
    bonds over the nodes below is not 0 (of m nodes one is taken wrongly with odds of m / 2**128).
    """
    tree, roots = spanning_forest(bonds)
    loose = bonds.select("mol_id", "a", "b").distinct().join(tree, ["mol_id", "a", "b"], "left_anti")
    ends = loose.select("mol_id", F.explode(F.array("a", "b")).alias("u"), *(F.xxhash64(F.lit(i), "mol_id", "a", "b").alias(f"x{i}") for i in (1, 2)))
    labels = ends.groupBy("mol_id", "u").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    around = W.partitionBy("mol_id", "u").orderBy("v")
    arcs = both_ways(tree).join(roots.withColumnRenamed("node", "u"), ["mol_id", "u"])
    arcs = arcs.select("*", F.lead("v").over(around).alias("next"), F.min("v").over(W.partitionBy("mol_id", "u")).alias("first"))
    # the arc v -> u goes on to u's next neighbour; at the root's last one the tour ends. A node counts at its first arc.
    goes = F.coalesce("next", F.when(F.col("u") != F.col("root"), F.col("first")))
    onward = arcs.select("mol_id", F.col("v").alias("from"), F.col("u").alias("at"), goes.alias("go"))
    own = arcs.where(F.col("v") == F.col("first")).join(labels, ["mol_id", "u"], "left")
    zero = F.lit(0).cast("long")
    own = own.select("mol_id", "u", "v", F.coalesce("x1", zero).alias("x1"), F.coalesce("x2", zero).alias("x2"), F.lit(1).cast("long").alias("n"), F.col("u").cast("long").alias("total"))
    sums = ("x1", "x2", "n", "total")
    add = lambda a, b, c: a.bitwiseXOR(b) if c in ("x1", "x2") else a + b
    walk = onward.select("mol_id", F.col("from").alias("u"), F.col("at").alias("v"), F.col("at").alias("nu"), F.col("go").alias("nv")).join(own, ["mol_id", "u", "v"], "left")
    walk = walk.select("mol_id", "u", "v", F.when(F.col("nv").isNotNull(), F.col("nu")).alias("nu"), "nv", F.lit(1).cast("long").alias("d"), *(F.coalesce(c, zero).alias(c) for c in sums), *(F.coalesce(c, zero).alias("own_" + c) for c in sums))

    def skipped(walk: DataFrame) -> DataFrame:
        on = walk.select("mol_id", F.col("u").alias("nu"), F.col("v").alias("nv"), F.col("nu").alias("ou"), F.col("nv").alias("ov"), F.col("d").alias("od"), *(F.col(c).alias("o_" + c) for c in sums))
        return walk.join(on, ["mol_id", "nu", "nv"], "left").select(
            "mol_id", "u", "v", F.col("ou").alias("nu"), F.col("ov").alias("nv"), (F.col("d") + F.coalesce("od", zero)).alias("d"),
            *(add(F.col(c), F.coalesce("o_" + c, zero), c).alias(c) for c in sums), *("own_" + c for c in sums),
        )

    walk = staged(walk, "tour")
    while walk.where("nv IS NOT NULL").limit(1).count():
        new = staged(skipped(skipped(walk)), "tour")
        drop_stage(walk)
        walk = new
    later = [add(F.col(c), F.col("own_" + c), c) if c in ("x1", "x2") else F.col(c) - F.col("own_" + c) for c in sums]
    into = walk.select("mol_id", F.col("u").alias("parent"), F.col("v").alias("node"), F.col("d").alias("into"), *(x.alias("in_" + c) for x, c in zip(later, sums, strict=True)))
    out = walk.select("mol_id", F.col("v").alias("parent"), F.col("u").alias("node"), F.col("d").alias("out"), *(x.alias("out_" + c) for x, c in zip(later, sums, strict=True)))
    both = into.join(out, ["mol_id", "parent", "node"]).where(F.col("into") > F.col("out"))
    below = both.select(
        "mol_id", "node", "parent", (-F.col("into")).alias("begin"), (-F.col("out")).alias("end"), (F.col("in_n") - F.col("out_n")).alias("n"), (F.col("in_total") - F.col("out_total")).alias("total"),
        ((F.col("in_x1") != F.col("out_x1")) | (F.col("in_x2") != F.col("out_x2"))).alias("open"),
    )
    whole = roots.groupBy("mol_id", "root").agg(F.count("*").alias("all_n"), F.sum(F.col("node").cast("long")).alias("all_total"))
    nodes = roots.join(below, ["mol_id", "node"], "left").join(whole.withColumnRenamed("root", "node"), ["mol_id", "node"], "left")
    done = nodes.select("mol_id", "node", "root", "parent", F.coalesce("begin", F.lit(-(2**62))).alias("begin"), F.coalesce("end", F.lit(2**62)).alias("end"), F.coalesce("n", "all_n").alias("n"), F.coalesce("total", "all_total").alias("total"), F.coalesce("open", F.lit(False)).alias("open"))
    done = staged(done, "rooted")
    for x in (walk, tree, roots):
        drop_stage(x)
    return done


def forest_bonds(bonds: DataFrame, large: DataFrame | None = None) -> DataFrame:
    """bonds(mol_id, a, b) to (mol_id, a, b, root, low, begin, end, n, total, all_n, all_total, a_degree, b_degree) of every
    bond: low is the end that hangs below the other, in a ring null as are begin and end, the places below it, and n and
    total, number and sum of the nodes there; all_n and all_total are those of the whole component.
    large: rooted() of the molecules of many bonds, where it is there already."""
    small, rest, tasks = molecules.parted(_whole(bonds), KEYS, "ab")
    out, names = [], ("root", "low", "begin", "end", "n", "total", "all_n", "all_total", "a_degree", "b_degree")
    if small is not None:
        rows = molecules.by_molecule(small, KEYS, tasks, molecules.bond_rows, "a: long, b: long, " + ", ".join(f"{c}: long" for c in names))
        out.append(_typed(rows, bonds, "a", "b", "root", "low"))
    if rest is not None:
        tree = rooted(rest) if large is None else large
        below = tree.where("parent IS NOT NULL AND NOT open").select("mol_id", F.least("node", "parent").alias("a"), F.greatest("node", "parent").alias("b"), F.col("node").alias("low"), "begin", "end", "n", "total")
        whole = tree.where("parent IS NULL").select("mol_id", "root", F.col("n").alias("all_n"), F.col("total").alias("all_total"))
        rows = rest.distinct().join(below, ["mol_id", "a", "b"], "left").join(tree.select("mol_id", F.col("node").alias("a"), "root"), ["mol_id", "a"]).join(whole, ["mol_id", "root"])
        for end in "ab":
            rows = rows.join(degrees(rest.distinct()).select("mol_id", F.col("node").alias(end), F.col("degree").alias(f"{end}_degree")), ["mol_id", end])
        out.append(rows.select("mol_id", "a", "b", *names))
    return reduce(DataFrame.union, out)


def _places(bonds: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(mol_id, root, node, at) of every node, and rooted() of the molecules of many bonds."""
    small, rest, tasks = molecules.parted(_whole(bonds), KEYS, "ab")
    out, tree = [], None
    if small is not None:
        out.append(_typed(molecules.by_molecule(small, KEYS, tasks, molecules.place_rows, "root: long, node: long, at: long"), bonds, "root", "node"))
    if rest is not None:
        tree = rooted(rest)
        out.append(tree.select("mol_id", "root", "node", F.col("begin").alias("at")))
    return reduce(DataFrame.union, out), tree


def _sides(forest: DataFrame, cuts: DataFrame) -> DataFrame:
    """cuts(mol_id, cut, x, y, ...) with what forest_bonds() has of their bonds; inside: it is x's side that lies below."""
    found = cuts.select("mol_id", "cut", "x", "y", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).join(forest, ["mol_id", "a", "b"])
    return found.withColumn("inside", F.coalesce(F.col("low") == F.col("x"), F.lit(False)))


def cut_totals(bonds: DataFrame, cuts: DataFrame) -> DataFrame:
    """bonds(mol_id, a, b), cuts(mol_id, cut, x, y) of bonds x-y: (mol_id, cut, x, y, n, total), the number and the sum of
    the nodes that hang on x once the bond is taken out. Rows grow with the bonds, no side is set out."""
    part = lambda c: F.when(F.col("inside"), F.col(c)).otherwise(F.col("all_" + c) - F.coalesce(c, F.lit(0)))
    return _sides(forest_bonds(bonds), cuts).select("mol_id", "cut", "x", "y", part("n").alias("n"), part("total").alias("total"))


def cut_side(bonds: DataFrame, cuts: DataFrame) -> DataFrame:
    """bonds(mol_id, a, b), cuts(mol_id, cut, x, y): (mol_id, cut, x, y, node) of all nodes that hang on x once the bond
    x-y is taken out: an interval of the tour, or all but that, or in a ring the whole component."""
    places, large = _places(bonds)
    below = F.coalesce((F.col("at") >= F.col("begin")) & (F.col("at") <= F.col("end")), F.lit(False))
    return _sides(forest_bonds(bonds, large), cuts).join(places, ["mol_id", "root"]).where(below == F.col("inside")).select("mol_id", "cut", "x", "y", "node")


def ring_bonds(bonds: DataFrame) -> DataFrame:
    """(mol_id, a, b) of the bonds in a cycle: those outside the spanning tree, and those of it that others lead past."""
    return forest_bonds(bonds).where("low IS NULL").select("mol_id", "a", "b")


def degrees(bonds: DataFrame) -> DataFrame:
    return both_ways(bonds).groupBy("mol_id", "u").agg(F.count("*").alias("degree")).withColumnRenamed("u", "node")


def linkages(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """phi and psi of every linkage C1-O-C between residues: (mol_id, kind, a, b, c, d).

    phi is (ring oxygen O5, C1, O, C), psi (C1, O, C, next), next being the smallest oxygen of that carbon
    other than the linking one, else its smallest carbon. Hydrogens take no part.
    """
    e = staged(both_ways(bonds), "graph")  # each step reads it
    h = atoms.where(heavy(F.col("element"))).select("mol_id", "atom_index", "name", "element", "res_id")

    def step(df: DataFrame, at: str, new: str) -> DataFrame:
        n = h.select("mol_id", F.col("atom_index").alias(new), *(F.col(c).alias(f"{new}_{c}") for c in ("name", "element", "res_id")))
        return df.join(e.select("mol_id", F.col("u").alias(at), F.col("v").alias(new)), ["mol_id", at]).join(n, ["mol_id", new])

    c1 = h.where("name = 'C1'").select("mol_id", F.col("atom_index").alias("c1"), F.col("res_id").alias("c1_res"))
    ring = step(c1, "c1", "o5").where("o5_name = 'O5' and o5_res_id = c1_res").groupBy("mol_id", "c1").agg(F.min("o5").alias("o5"))
    link = step(step(c1, "c1", "o").where("o_element = 'O' and o_name <> 'O5'"), "o", "c").where("c_element = 'C' and c <> c1 and c_res_id <> c1_res")
    phi = link.join(ring, ["mol_id", "c1"]).select("mol_id", F.lit("phi").alias("kind"), F.col("o5").alias("a"), F.col("c1").alias("b"), F.col("o").alias("c"), F.col("c").alias("d"))
    after = step(link.select("mol_id", "c1", "o", "c"), "c", "n").where("n <> o and n_element in ('O', 'C')")
    psi = after.groupBy("mol_id", "c1", "o", "c").agg(F.min(F.struct((F.col("n_element") != "O").alias("late"), "n")).alias("next"))
    return phi.union(psi.select("mol_id", F.lit("psi"), "c1", "o", "c", F.col("next.n"))).distinct()


def omegas(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(mol_id, a, b, c, d) of bonded C4-C5-C6-O6 within a residue."""
    named = lambda name, col: atoms.where(F.col("name") == name).select("mol_id", "res_id", F.col("atom_index").alias(col))
    e = staged(both_ways(bonds), "graph")
    out = named("C4", "a")
    for last, name, col in (("a", "C5", "b"), ("b", "C6", "c"), ("c", "O6", "d")):
        out = out.join(named(name, col), ["mol_id", "res_id"]).join(e.select("mol_id", F.col("u").alias(last), F.col("v").alias(col)), ["mol_id", last, col])
    return out.select("mol_id", *"abcd")


def rotatable(bonds: DataFrame, atoms: DataFrame, taken: DataFrame) -> DataFrame:
    """(mol_id, a, b, c, d) about bonds b-c in no ring, both of whose ends have further bonds, and that are no centre of
    `taken` (mol_id, b, c); the outer atoms are the smallest, oxygens first."""
    open_ = forest_bonds(bonds).where("low IS NOT NULL AND a_degree > 1 AND b_degree > 1").select("mol_id", "a", "b")
    centres = taken.select("mol_id", F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b"))
    open_ = open_.join(centres, ["mol_id", "a", "b"], "left_anti")
    element = atoms.select("mol_id", F.col("atom_index").alias("v"), (F.col("element") != "O").alias("late"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("other")), F.struct(F.col("b").alias("u"), F.col("a").alias("other"))))
    side = open_.select("mol_id", "a", "b", ends.alias("e")).select("mol_id", "a", "b", "e.*").join(both_ways(bonds), ["mol_id", "u"]).where("v <> other").join(element, ["mol_id", "v"])
    outer = lambda end, name: F.min(F.when(F.col("u") == F.col(end), F.struct("late", "v"))).alias(name)
    found = side.groupBy("mol_id", "a", "b").agg(outer("a", "first"), outer("b", "last")).where("first IS NOT NULL AND last IS NOT NULL")
    return found.select("mol_id", F.col("first.v").alias("a"), F.col("a").alias("b"), F.col("b").alias("c"), F.col("last.v").alias("d"))


def catalogue(found: DataFrame, order: Column) -> DataFrame:
    """found(mol_id, method, a, b, c, d) with one row for each torsion, read either way, of four different atoms; the
    method that comes first by `order` stays."""
    forward, back = F.array(*"abcd"), F.array(*"dcba")
    rows = found.where(F.size(F.array_distinct(forward)) == 4).withColumn("key", F.least(forward, back))
    return rows.groupBy("mol_id", "key").agg(F.min_by(F.struct("method", *"abcd"), F.struct(order.alias("o"), *"abcd")).alias("t")).select("mol_id", "t.*")


def full_catalogue(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(mol_id, method, a, b, c, d) of all torsions of all molecules: phi and psi of linkages, omega, and those about other
    bonds that turn, whose centre neither of the first has; of a torsion found twice the first method's stays."""
    linked = linkages(atoms, bonds).select("mol_id", F.col("kind").alias("method"), *"abcd")
    named = staged(linked.union(omegas(atoms, bonds).select("mol_id", F.lit("omega"), *"abcd")), "named")
    other = rotatable(bonds, atoms, named.select("mol_id", "b", "c").distinct())
    order = F.array_position(F.array(*map(F.lit, ("phi", "psi", "omega", "other"))), F.col("method"))
    return catalogue(named.union(other.select("mol_id", F.lit("other").alias("method"), *"abcd")), order)


def stitch(atoms: DataFrame, bonds: DataFrame, few: int = 256) -> DataFrame:
    """bonds (mol_id, a, b) with the closest pairs across components added until each molecule is one: atoms need x, y, z.

    Rounds as Boruvka's: every component adds its nearest pair to another (see neighbours.nearest_across), so rounds grow
    with the logarithm of the components, and the pairs are those that adding the closest pair of all, one after the
    other, gives; of equal distances the least pair goes first. After the first round components are merged as nodes of
    a small graph, and molecules that are one drop out. Atoms with a missing or non-finite coordinate are in no pair: a
    component of such atoms only stays apart. Molecules of at most `few` atoms and
    bonds are dealt to tasks once and all is done there.
    """
    axes = ["x", "y", "z"]
    keys = ["mol_id", "component"]
    several = lambda df: df.join(df.groupBy("mol_id").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("mol_id"), "mol_id", "left_semi")
    out = bonds.select("mol_id", "a", "b").distinct()
    # an atom is a row whose ends are the atom
    kind, zero = bonds.schema["a"].dataType, F.lit(0.0)
    own = finite(atoms, axes).where("mol_id IS NOT NULL").select("mol_id", F.col("atom_index").cast(kind).alias("a"), F.col("atom_index").cast(kind).alias("b"), F.lit(True).alias("atom"), *(F.col(x).cast("double").alias(x) for x in axes))
    rows = _whole(bonds).select("*", F.lit(False).alias("atom"), *(zero.alias(x) for x in axes)).union(own)
    small, large, tasks = molecules.parted(rows, KEYS, "ab", few)
    if small is not None:
        pairs = molecules.by_molecule(small, KEYS, tasks, molecules.stitch_rows(axes), "a: long, b: long", molecules.CHUNK_ROWS // 2)
        out = out.union(_typed(pairs, bonds, "a", "b"))
    if large is None:
        return out
    nodes, bonds = large.where("atom").select("mol_id", F.col("a").alias("node"), *axes), large.where("NOT atom").select("mol_id", "a", "b")
    apart = staged(several(nodes.join(components(nodes, bonds), ["mol_id", "node"])), "graph")
    while True:
        near = nearest_across(apart)
        if not near.limit(1).count():
            return out
        out = out.union(near.select("mol_id", "a", "b").distinct())
        merged = connected_components(near.select("mol_id", F.col("component").alias("a"), F.col("other_group").alias("b")), "graph", ["mol_id"])
        merged = merged.select("mol_id", F.col("node").alias("component"), F.col("component").alias("into"))
        joined = apart.join(merged, keys, "left").withColumn("component", F.coalesce("into", "component")).drop("into")
        rest = staged(several(joined), "graph")
        drop_stage(apart)
        apart = rest
