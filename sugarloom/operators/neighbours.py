"""Exact nearest neighbours and entropy of points in a few dimensions, by blocks cut at quantiles and by a grid that widens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.functions.columns import harmonic_gap, unit_ball
from sugarloom.operators import molecules
from sugarloom.operators.staging import drop_stage, staged
from sugarloom.operators.stats import standardised


def touching(d: int) -> Column:
    """The offsets of a cell and all cells that touch it in d dimensions, as an array of arrays."""
    out = F.array(F.array().cast("array<long>"))
    for _ in range(d):
        out = F.flatten(F.transform(out, lambda o: F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda x: F.concat(o, F.array(x.cast("long"))))))
    return out


#: Positions of a block, all of whose pairs are made within a task; and positions a task.
BLOCK, TASK_POSITIONS = 1024, 50_000
#: Parts that a block is cut into at once, at most.
SLICES = 8


def kth_distances(points: DataFrame, k: int, columns: Sequence[str] = ("x", "y", "z"), key: str = "mol_id", point: str = "frame") -> DataFrame:
    """points(key, point, columns) to (key, point, r): the distance to the k-th nearest other point of the key.

    Equal points are one position with a number of copies. A key's positions are cut at quantiles of their widest axis, again
    and again, into blocks of at most BLOCK, so blocks are small where points are dense. Each block is one group of a task, which
    finds the k nearest within it; what other blocks can have nearer, as the boxes around them tell, is looked for there, a row
    for each such block, and the lists are merged. So pairs grow with the points times BLOCK, however they are spread, and no
    pair leaves its task. Keys of k points or fewer have no rows. A point with a missing coordinate has a null r, one with
    another that is not finite NaN, and no point is near to them.
    """
    most = max(BLOCK, 2 * (k + 1))
    own = points.where(F.col(key).isNotNull()).select(key, point, *(F.col(c).cast("double").alias(c) for c in columns))
    some = own.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > k).select(key)
    own = own.join(some, key, "left_semi")
    positions = staged(finite(own, columns).groupBy(key, *columns).agg(F.least(F.count("*"), F.lit(k + 1)).alias("_copies")), "positions")
    dealt, tree = _blocks(positions, columns, key, most)
    spark = points.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (tree[0].agg(F.sum("n")).first()[0] or 0) // TASK_POSITIONS)
    at, schema = [key, *columns], ", ".join([*(f"{c}: double" for c in columns), "_reach: double", "_best: array<double>"])
    found = staged(molecules.by_molecule(dealt, [key, "_node"], tasks, molecules.kth_rows(columns, k), schema), "knn")
    best = found.select(*at, "_best")
    asked = _asked(found.select(*at, F.col("_node").alias("_own"), F.least(F.element_at("_best", k), "_reach").alias("_r2")), tree, columns, key, most)
    if asked is not None:
        rows = dealt.select(*at, "_node", "_copies", F.lit(False).alias("_asks")).unionByName(asked.select(*at, "_node", F.lit(0).cast("long").alias("_copies"), F.lit(True).alias("_asks")))
        best = best.union(molecules.by_molecule(rows, [key, "_node"], tasks, molecules.kth_asked_rows(columns, k), schema).select(*at, "_best"))
        best = best.groupBy(*at).agg(F.array_sort(F.flatten(F.collect_list("_best"))).alias("_best"))  # k of each block asked
    r = staged(best.select(*at, F.sqrt(F.element_at("_best", k)).alias("r")), "knn")
    there = F.lit(True)
    for c in columns:
        there = there & F.col(c).isNotNull()
    return own.join(r, at, "left").select(key, point, F.coalesce("r", F.when(there, float("nan"))).alias("r"))


def _box(columns: Sequence[str]) -> list[Column]:
    return [f(c).alias(g + c) for c in columns for f, g in ((F.min, "_lo"), (F.max, "_hi"))]


def _squares(gaps: Sequence[Column]) -> Column:
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


def _blocks(positions: DataFrame, columns: Sequence[str], key: str, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """positions(key, columns, _copies), each once, with _node, the block of at most `most` that it is in, and _reach, a squared
    length within which there are as many others as there can be in a block; and of each depth the nodes' sizes and boxes.

    A node's children are SLICES * node on. Cuts are quantiles; a value that is several of them, or the largest, gets a slice
    of its own, so every cut parts something."""
    rest, parts, tree = positions.withColumn("_node", F.lit(1).cast("long")).withColumn("_reach", F.lit(float("inf"))), [], []
    while True:
        about = staged(rest.groupBy(key, "_node").agg(F.count("*").alias("n"), *_box(columns)), "nodes")
        tree.append(about)
        large = about.where(F.col("n") > most)
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*parts, rest]), tree
        parts.append(rest.join(about.where(F.col("n") <= most).select(key, "_node"), [key, "_node"], "left_semi"))
        spans = F.array(*(F.col("_hi" + c) - F.col("_lo" + c) for c in columns))
        axis = F.array_position(spans, F.array_max(spans)).cast("int")
        diagonal = _squares([F.col("_hi" + c) - F.col("_lo" + c) for c in columns]) * (1 + 1e-9)
        large = large.select(key, "_node", "n", axis.alias("_axis"), F.element_at(F.array(*("_hi" + c for c in columns)), axis).alias("_top"), diagonal.alias("_diagonal"))
        inside = rest.join(large, [key, "_node"]).withColumn("_x", F.element_at(F.array(*columns), F.col("_axis")))
        cuts = inside.groupBy(key, "_node").agg(F.percentile_approx("_x", [i / SLICES for i in range(1, SLICES)]).alias("q"), F.first("n").alias("n"), F.first("_top").alias("_top"))
        half = SLICES // 2
        q = F.when(F.col("n") <= 2 * most, F.slice("q", half, 1)).when(F.col("n") <= half * most, F.filter("q", lambda x, i: i % 2 == 1)).otherwise(F.col("q"))
        cuts = cuts.withColumn("q", q)
        above = F.filter(F.array_distinct("q"), lambda v: v < F.col("_top"))
        heavy = F.filter(F.array_distinct("q"), lambda v: (v == F.col("_top")) | (F.size(F.filter("q", lambda w: w == v)) > 1))
        cuts = staged(cuts.select(key, "_node", above.alias("_above"), heavy.alias("_heavy")), "cuts")
        part = F.size(F.filter("_above", lambda v: F.col("_x") > v)) + F.size(F.filter("_heavy", lambda v: F.col("_x") >= v))
        rest = staged(inside.join(cuts, [key, "_node"]).select(key, *columns, "_copies", (F.col("_node") * SLICES + part).alias("_node"), F.col("_diagonal").alias("_reach")), "blocks")


def _asked(queries: DataFrame, tree: list[DataFrame], columns: Sequence[str], key: str, most: int) -> DataFrame | None:
    """queries(key, columns, _own, _r2) to (key, columns, _node): each with the other blocks whose boxes are nearer than _r2, found
    from the root down; None where no key has several blocks."""
    out, left = [], queries.withColumn("_node", F.lit(1).cast("long"))
    for level in tree[1:]:
        nodes = level.select(key, F.floor(F.col("_node") / SLICES).alias("_node"), F.col("_node").alias("_child"), (F.col("n") <= most).alias("_leaf"), *(g + c for c in columns for g in ("_lo", "_hi")))
        gap = _squares([F.greatest(F.lit(0.0), F.col("_lo" + c) - F.col(c), F.col(c) - F.col("_hi" + c)) for c in columns])
        left = left.join(nodes, [key, "_node"]).where((gap < F.col("_r2")) & (F.col("_child") != F.col("_own")))
        left = staged(left.select(key, *columns, "_own", "_r2", F.col("_child").alias("_node"), "_leaf"), "asked")
        out.append(left.where("_leaf").select(key, *columns, "_node"))
        left = left.where("NOT _leaf").drop("_leaf")
    return reduce(DataFrame.unionByName, out) if out else None


def nearest_across(points: DataFrame, columns: Sequence[str] = ("x", "y", "z"), key: str = "mol_id", group: str = "component", point: str = "node", few: int = 64) -> DataFrame:
    """points(key, group, point, columns) to (key, group, other_group, d2, a, b): of every group the nearest pair of one
    of its points and one of another group's of the key, a < b being the points; of equal distances the least (a, b).

    A point meets points of its own and the touching cells only, and cells around which there is one group drop out before
    their points are read, so the inside of a large group costs nothing. A group whose pair is no longer than the cells
    are wide is done; the others go on with cells twice as wide, until these span the key. The join is by key and cell: a
    key of any size is in many tasks. Keys of at most `few` points are dealt to tasks once and all their pairs are held
    against each other there. Points with a missing or non-finite coordinate are in no pair, and a group that is
    alone in its key has no row.
    """
    seen = finite(points, columns).where(F.col(key).isNotNull()).select(key, group, point, *(F.col(c).cast("double").alias(c) for c in columns))
    seen = staged(seen, "across")
    small, large, tasks = molecules.parted(seen, [key], [group, point], few)
    out = []
    if small is not None:
        small = small.withColumnsRenamed({group: "g", point: "p"})
        types, kinds = dict(seen.dtypes), {"other_group": group, "a": point, "b": point, group: group}
        rows = molecules.by_molecule(small, [key], tasks, molecules.nearest_rows(columns), f"{group}: long, other_group: long, d2: double, a: long, b: long", molecules.CHUNK_ROWS // 4)
        out.append(rows.withColumns({c: F.col(c).cast(types[k]) for c, k in kinds.items()}))
    if large is not None:
        out.append(_nearest_by_cells(large, columns, key, group, point))
    return reduce(DataFrame.union, out)


def finite(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Points whose coordinates are all there and finite."""
    fine = F.lit(True)
    for c in columns:
        fine = fine & F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False))  # of NaN this is false
    return points.where(fine)


def _nearest_by_cells(seen: DataFrame, columns: Sequence[str], key: str, group: str, point: str) -> DataFrame:
    """nearest_across() of finite points of keys of any size."""
    d = len(columns)
    bounds = seen.groupBy(key).agg(F.count("*").alias("n"), F.min(group).alias("g0"), F.max(group).alias("g1"), *(F.min(c).alias(f"{c}_lo") for c in columns), *(F.max(c).alias(f"{c}_hi") for c in columns)).where("g0 <> g1")
    # as wide as evenly dealt points are apart, be they in a body, in a plane or on a line
    spans = F.array_sort(F.array(*(F.col(f"{c}_hi") - F.col(f"{c}_lo") for c in columns)))
    widest, apart, size = F.element_at(spans, -1), [], F.lit(1.0)
    for i in range(1, d + 1):
        size = size * F.element_at(spans, -i)
        apart.append(F.pow(size / F.col("n"), F.lit(1.0 / i)))
    bounds = bounds.select(key, *(f"{c}_lo" for c in columns), F.greatest(*apart, F.lit(1e-12)).alias("w"), widest.alias("widest"))
    base = staged(seen.join(bounds, key), "across")
    left, scale, at = staged(base.select(key, group).distinct(), "across"), 1.0, [key, "cell"]
    done = None
    while left.limit(1).count():
        celled = base.withColumn("cell", F.array(*(F.floor((F.col(c) - F.col(f"{c}_lo")) / (F.col("w") * scale)) for c in columns)))
        held = celled.groupBy(*at).agg(F.min(group).alias("g0"), F.max(group).alias("g1")).withColumnRenamed("cell", "near")
        asked = celled.join(left, [key, group], "left_semi")
        whole = F.col("widest") < F.col("w") * scale  # one cell has all points
        alone = F.array(F.array(*[F.lit(0).cast("long")] * d))
        around = asked.select(*at, group, whole.alias("whole")).distinct().withColumn("near", F.explode(F.transform(F.when(F.col("whole"), alone).otherwise(touching(d)), lambda o: F.zip_with(F.col("cell"), o, lambda a, b: a + b))))
        around = around.join(held, [key, "near"]).where((F.col("g0") != F.col(group)) | (F.col("g1") != F.col(group))).drop("g0", "g1", "whole")
        others = celled.select(F.col(key), F.col("cell").alias("near"), F.col(group).alias("other_group"), F.col(point).alias("other"), *(F.col(c).alias("o" + c) for c in columns))
        met = asked.join(around, [*at, group]).join(others, [key, "near"]).where(F.col(group) != F.col("other_group"))
        gaps = [F.col(c) - F.col("o" + c) for c in columns]
        d2 = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
        best = met.groupBy(key, group).agg(F.min(F.struct(d2.alias("d2"), F.least(point, "other").alias("a"), F.greatest(point, "other").alias("b"), "other_group")).alias("m"), F.first("w").alias("w"), F.first("widest").alias("widest"))
        # a hair less than the width, so that rounding at the edge of a cell loses no pair
        found = staged(best.where(whole | (F.sqrt("m.d2") <= F.col("w") * (scale * (1 - 1e-9)))).select(key, group, "m.other_group", "m.d2", "m.a", "m.b"), "across")
        done = found if done is None else done.union(found)
        rest = staged(left.join(found, [key, group], "left_anti"), "across")
        drop_stage(left)
        left, scale = rest, scale * 2
    drop_stage(left)
    if done is None:
        return base.select(key, group, F.col(group).alias("other_group"), F.lit(0.0).alias("d2"), F.col(point).alias("a"), F.col(point).alias("b"))
    drop_stage(base)
    return done


def knn_entropy(points: DataFrame, k: int = 5, columns: Sequence[str] = ("x", "y", "z"), key: str = "mol_id", point: str = "frame") -> DataFrame:
    """(key, n, entropy) by Kozachenko and Leonenko: psi(n) - psi(k) + ln V + d times the mean of ln r; a distance of 0
    counts as 1e-12."""
    d = len(columns)
    r = kth_distances(points, k, columns, key, point)
    g = r.groupBy(key).agg(F.count("*").alias("n"), F.avg(F.log(F.when(F.col("r") == 0, 1e-12).otherwise(F.col("r")))).alias("m"))
    return g.select(key, "n", (harmonic_gap(F.col("n"), F.lit(k).cast("long")) + F.log(F.lit(unit_ball(d))) + d * F.col("m")).alias("entropy"))


BOLTZMANN = 1.380649e-23


def entropy_details(points: DataFrame, k: int = 5, columns: Sequence[str] = ("x", "y", "z"), key: str = "mol_id", point: str = "frame", standardise: bool = False, temperature: float | None = None) -> DataFrame:
    """(key, n, k, dim, entropy, mean_r, s_joule_per_k, kbt_h_joule) of each key of more than k points; kbt_h_joule is null
    without a temperature. Centring changes no distance, so there is no setting for it; standardise divides by the
    deviation (ddof 1; 0 counts as 1). Keys of k points or fewer are in too_few()."""
    if k < 1 or not columns:
        raise ValueError("k and the number of columns are at least 1")
    used = standardised(points, columns, (key,), sample=True) if standardise else points
    r = kth_distances(used, k, columns, key, point)
    safe = F.when(F.col("r") == 0, 1e-12).otherwise(F.col("r"))
    g = r.groupBy(key).agg(F.count("*").alias("n"), F.avg(F.log(safe)).alias("m"), F.avg(safe).alias("mean_r"))
    h = harmonic_gap(F.col("n"), F.lit(k).cast("long")) + F.log(F.lit(unit_ball(len(columns)))) + len(columns) * F.col("m")
    out = g.select(key, "n", F.lit(k).alias("k"), F.lit(len(columns)).alias("dim"), h.alias("entropy"), "mean_r")
    joule = F.col("entropy") * BOLTZMANN
    return out.withColumns({"s_joule_per_k": joule, "kbt_h_joule": joule * F.lit(temperature).cast("double")})


def too_few(points: DataFrame, k: int = 5, key: str = "mol_id") -> DataFrame:
    """(key, n) of the keys whose entropy can't be told: k points or fewer."""
    return points.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") <= k)
