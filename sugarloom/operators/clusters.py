"""Clustering of the points of many molecules at once: k-centre, mixtures, silhouettes, representatives.

points are rows (mol_id, frame, x, y, z). Loops run for all molecules together and stop when none goes on.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sugarloom.operators import molecules
from sugarloom.operators.staging import bucketed, drop_stage, staged
from sugarloom.operators.stats import tightness

AXES = ("x", "y", "z")


def _gap(prefix: str) -> Column:
    return sum(((F.col(c) - F.col(prefix + c)) * (F.col(c) - F.col(prefix + c)) for c in AXES[1:]), (F.col("x") - F.col(prefix + "x")) * (F.col("x") - F.col(prefix + "x")))


#: Pairs a task.
TASK_PAIRS = 10_000_000


def _pairs(left: DataFrame, right: DataFrame, keys: list[str], one: str, other: str, block: int = 1024) -> DataFrame:
    """Every row of left with every row of right of the same keys. A key of many rows is dealt over pairs of blocks of
    about `block` rows, so no task gets all pairs of a molecule, and over tasks by the number of pairs: rows are few bytes,
    by which they would be put together in one task."""
    n = left.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_n"))
    every = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    place = lambda c: F.pmod(F.xxhash64(c), F.col("_n")).cast("int")
    a = left.join(n, keys).withColumn("_a", place(one)).withColumn("_b", every).drop("_n")
    b = right.join(n, keys).withColumn("_b", place(other)).withColumn("_a", every).drop("_n")
    sizes = n.select(*keys, "_n").join(right.groupBy(*keys).agg(F.count("*").alias("_m")), keys)
    every = sizes.agg(F.sum(F.col("_n").cast("double") * block * F.col("_m"))).first()[0] or 0
    at = [*keys, "_a", "_b"]
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(every / TASK_PAIRS))
    return a.repartition(tasks, *at).join(b.repartition(tasks, *at), at).drop("_a", "_b")


#: Centres that are found before the points are written anew with their distances.
PENDING = 16
#: Points up to which all rounds of a molecule are done within a task.
FEW_POINTS = 200_000


def _with_pending(state: DataFrame, near: DataFrame | None) -> DataFrame:
    """state(mol_id, frame, x, y, z, d2, cluster) with the pending centres that can be near a cluster's members taken in."""
    if near is None:
        return state
    gap = lambda c: sum(((F.col(a) - c["c" + a]) * (F.col(a) - c["c" + a]) for a in AXES[1:]), (F.col("x") - c["cx"]) * (F.col("x") - c["cx"]))
    best = F.array_min(F.transform("near", lambda c: F.struct(gap(c).alias("d2"), c["cluster"].alias("cluster"))))
    rows = state.join(near, ["mol_id", "cluster"], "left").withColumn("best", best)
    closer = F.coalesce(F.col("best.d2") < F.col("d2"), F.lit(False))
    return rows.select("mol_id", "frame", *AXES, F.when(closer, F.col("best.d2")).otherwise(F.col("d2")).alias("d2"), F.when(closer, F.col("best.cluster")).otherwise(F.col("cluster")).alias("cluster"))


def k_centre(points: DataFrame, k: int | DataFrame | None, radius: float | None = None) -> DataFrame:
    """(mol_id, frame, cluster): farthest-point centres from the smallest frame on, each point to its nearest (ties to
    the earlier centre). k is one for all or (mol_id, k). A molecule of k points or fewer has one cluster a point; with
    `radius` it stops once every point is that near, and without k it goes on until then. Molecules without a k are left
    out.

    With k and no radius, molecules of at most FEW_POINTS points are dealt to tasks once and all their rounds done there.
    For others a round is one aggregation that gathers one row a molecule. Points are written with their distances once in PENDING
    rounds, the copy before dropped; centres found since are held against those clusters only whose centre is within
    twice their radius, as by the triangle inequality no member of another can be nearer to them.
    """
    if k is None and not radius:
        raise ValueError("without k a radius above 0 is needed")
    p, few, wanted = points.select("mol_id", "frame", *AXES), None, None
    if k is not None and radius is None:
        n = p.groupBy("mol_id").agg(F.count("*").alias("n"))
        wanted = staged((n.join(k.select("mol_id", "k"), "mol_id") if isinstance(k, DataFrame) else n.withColumn("k", F.lit(k))).where("k IS NOT NULL"), "wanted")
        few = wanted.where(F.col("n") <= F.col("k")).select("mol_id")
        wanted = wanted.where(F.col("n") > F.col("k")).select("mol_id", "k")
        own = p.join(few, "mol_id", "left_semi").select("mol_id", "frame", (F.row_number().over(W.partitionBy("mol_id").orderBy("frame")) - 1).alias("cluster"))
        k = wanted.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0]
        if not k:
            return own
        p = p.join(wanted, "mol_id", "left_semi")
        small, p, tasks = molecules.parted(p, ["mol_id"], ["frame"], FEW_POINTS)
        if small is not None:
            asked = small.join(wanted, "mol_id").select("mol_id", "frame", *(F.col(a).cast("double").alias(a) for a in AXES), F.col("k").cast("long").alias("k"))
            own = own.unionByName(molecules.by_molecule(asked, ["mol_id"], tasks, molecules.centre_rows, f"frame: {dict(small.dtypes)['frame']}, cluster: int"))
        if p is None:
            return own
    elif isinstance(k, DataFrame):
        raise ValueError("with a radius k is one for all")
    coordinates = [F.col(f"c.{x}").alias("c" + x) for x in AXES]
    first = p.groupBy("mol_id").agg(F.min_by(F.struct(*AXES), "frame").alias("c")).select("mol_id", *coordinates)
    centres = [staged(first.withColumn("cluster", F.lit(0)), "far")]
    start = p.join(first, "mol_id").withColumn("d2", _gap("c")).withColumn("cluster", F.lit(0))
    state = staged(start.select("mol_id", "frame", *AXES, "d2", "cluster"), "kcentre")
    pending: list[DataFrame] = []
    clusters_, near = None, None
    for i in itertools.count(1) if k is None else range(1, k):
        view = _with_pending(state, near)
        far = (view if k is not None else view.where(~F.isnan("d2"))).groupBy("mol_id").agg(F.max_by(F.struct(*AXES), F.struct("d2", -F.col("frame"))).alias("c"), F.max("d2").alias("most"))
        far = far if wanted is None else far.join(wanted.where(F.col("k") > i), "mol_id", "left_semi")
        far = staged(far.where(F.col("most") > (0.0 if radius is None else radius * radius)).select("mol_id", *coordinates, F.lit(i).alias("cluster")), "far")
        if far.isEmpty():
            break
        centres.append(far)
        pending.append(far)
        if len(pending) == PENDING:
            now = staged(_with_pending(state, _near(clusters_ or _radii(state, centres[:-PENDING]), pending)), "kcentre")
            drop_stage(state)
            drop_stage(clusters_)
            state, pending, clusters_, near = now, [], None, None
        else:
            clusters_ = clusters_ or _radii(state, centres[:-1])
            near = _near(clusters_, pending)
    out = staged(_with_pending(state, near).select("mol_id", "frame", "cluster"), "kcentre")
    for x in (state, clusters_, *centres):
        drop_stage(x)
    return out if few is None else out.unionByName(own)


def _radii(state: DataFrame, centres: list[DataFrame]) -> DataFrame:
    """(mol_id, of, x, y, z, r2) of each cluster with members: its centre and the largest squared distance from it."""
    r2 = state.groupBy("mol_id", "cluster").agg(F.max("d2").alias("r2"))
    at = reduce(DataFrame.unionByName, centres)
    return staged(r2.join(at, ["mol_id", "cluster"]).select("mol_id", F.col("cluster").alias("of"), *(F.col("c" + a).alias(a) for a in AXES), "r2"), "radii")


def _near(clusters_: DataFrame, pending: list[DataFrame]) -> DataFrame:
    """(mol_id, cluster, near): of each cluster the pending centres, PENDING at most, that can be nearer to some member."""
    new = reduce(DataFrame.unionByName, pending)
    pairs = clusters_.join(new, "mol_id").where(_gap("c") < 4 * F.col("r2") * (1 + 1e-9))
    return pairs.groupBy("mol_id", F.col("of").alias("cluster")).agg(F.collect_list(F.struct("cluster", *("c" + a for a in AXES))).alias("near"))


def nearest_centre(points: DataFrame, centres: DataFrame) -> DataFrame:
    """centres(mol_id, centre, x, y, z): (mol_id, frame, centre, d2) of each point's nearest, ties to the lowest."""
    c = centres.select("mol_id", "centre", *(F.col(a).alias("c" + a) for a in AXES))
    both = points.join(c, "mol_id").withColumn("d2", _gap("c"))
    return both.groupBy("mol_id", "frame").agg(F.min_by("centre", F.struct("d2", "centre")).alias("centre"), F.min("d2").alias("d2"))


def silhouettes(points: DataFrame, labels: DataFrame) -> DataFrame:
    """(mol_id, silhouette): the exact mean over points; null where a molecule has one cluster.

    Distances are summed by (point, cluster) as they are made, in blocks of points against blocks.
    A point alone in its cluster counts 0.
    """
    p = points.join(labels, ["mol_id", "frame"]).select("mol_id", "frame", "cluster", *AXES)
    other = p.select("mol_id", F.col("frame").alias("frame2"), F.col("cluster").alias("cluster2"), *(F.col(a).alias("o" + a) for a in AXES))
    pairs = _pairs(p, other, ["mol_id"], "frame", "frame2").where("frame <> frame2")
    mean = pairs.groupBy("mol_id", "frame", "cluster", "cluster2").agg(F.avg(F.sqrt(_gap("o"))).alias("d"))
    own = F.max(F.when(F.col("cluster") == F.col("cluster2"), F.col("d"))).alias("a")
    out = F.min(F.when(F.col("cluster") != F.col("cluster2"), F.col("d"))).alias("b")
    s = mean.groupBy("mol_id", "frame").agg(own, out)
    value = F.when(F.col("b").isNull(), None).when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return s.groupBy("mol_id").agg(F.avg(value).alias("silhouette"))


def nearest_to_centroid(points: DataFrame, labels: DataFrame) -> DataFrame:
    """(mol_id, cluster, frame): the member nearest to its cluster's mean, ties to the smallest frame."""
    p = points.join(labels, ["mol_id", "frame"])
    mean = p.groupBy("mol_id", "cluster").agg(*(F.avg(a).alias("c" + a) for a in AXES))
    return p.join(mean, ["mol_id", "cluster"]).groupBy("mol_id", "cluster").agg(F.min_by("frame", F.struct(_gap("c"), F.col("frame"))).alias("frame"))


#: Clusters of up to so many members are summed pair by pair; of larger ones most members are left out by bounds first.
DIRECT = 1000


def _cells(p: DataFrame, level: int) -> DataFrame:
    """The members' cells of 2**level a side: (mol_id, cluster, cell, h, n) and their bounds."""
    bounds = [f(a).alias(g + a) for a in AXES for f, g in ((F.min, "lo"), (F.max, "hi"))]
    return p.withColumn("cell", _cell(level)).groupBy("mol_id", "cluster", "cell").agg(F.count("*").alias("n"), F.first("h").alias("h"), *bounds)


def _cell(level: int) -> Column:
    return F.array(*(F.floor((F.col(a) - F.col(a + "0")) * (2**level) / F.col("span")).cast("int") for a in AXES))


def _candidates(p: DataFrame, levels: Sequence[int] = (3, 4, 5, 6)) -> DataFrame:
    """The members of p(mol_id, cluster, frame, x, y, z, h, x0, y0, z0, span) that can have the highest kernel sum.

    Cells against cells: what a cell's members can reach at most, every other cell at its nearest, and reach at least,
    all at their farthest. Cells that can't reach what another surely has are left out, and the rest are cut in eight.
    """
    keys = ["mol_id", "cluster"]
    kept = None
    for level in levels:
        cells = staged(_cells(p, level), "cells")
        asked = cells
        if kept is not None:
            above = F.transform("cell", lambda x: F.floor(x / 2).cast("int"))
            asked = cells.withColumn("above", above).join(kept.select(*keys, F.col("cell").alias("above")), [*keys, "above"], "left_semi").drop("above")
        sources = cells.select(*keys, F.col("cell").alias("cell2"), F.col("n").alias("m"), *(F.col(g + a).alias("s" + g + a) for a in AXES for g in ("lo", "hi")))
        pairs = _pairs(asked, sources, keys, "cell", "cell2")
        nearest = [F.greatest(F.lit(0.0), F.col("lo" + a) - F.col("shi" + a), F.col("slo" + a) - F.col("hi" + a)) for a in AXES]
        farthest = [F.greatest(F.col("hi" + a) - F.col("slo" + a), F.col("shi" + a) - F.col("lo" + a)) for a in AXES]
        weight = lambda gaps: F.sum(F.col("m") * F.exp(-sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) / (2 * F.col("h") * F.col("h"))))
        reach = staged(pairs.groupBy(*keys, "cell").agg(weight(nearest).alias("most"), weight(farthest).alias("least"), F.first("n").alias("n")), "reach")
        sure = reach.groupBy(*keys).agg(F.max("least").alias("sure"))
        now = staged(reach.join(sure, keys).where(F.col("most") >= F.col("sure") * (1 - 1e-9)).select(*keys, "cell", "n"), "kept")
        for x in (cells, reach, kept):
            drop_stage(x)
        kept = now
        left = kept.agg(F.coalesce(F.sum("n"), F.lit(0)), F.countDistinct(*keys)).first()
        if left[0] <= 200 * left[1]:
            break
    return p.withColumn("cell", _cell(level)).join(kept.drop("n"), [*keys, "cell"], "left_semi").drop("cell")


def densest_member(points: DataFrame, labels: DataFrame, bandwidth: Column | None = None) -> DataFrame:
    """(mol_id, cluster, frame, density): the member where a Gaussian kernel sum over the cluster is highest.

    bandwidth: by default Scott's, times the mean deviation of the axes. Sums are exact. In clusters of more than DIRECT
    members only those are summed that bounds over a grid of cells don't rule out; so pairs grow with the cells and
    with the members near the mode, not with the square of the members.
    """
    keys = ["mol_id", "cluster"]
    p = points.join(labels, ["mol_id", "frame"])
    sd = sum((F.coalesce(F.stddev_samp(a), F.lit(0.0)) for a in AXES[1:]), F.coalesce(F.stddev_samp("x"), F.lit(0.0))) / 3
    h = bandwidth if bandwidth is not None else F.greatest(F.pow(F.count("*").cast("double"), F.lit(-1 / 7)) * sd, F.lit(1e-9))
    span = F.greatest(*(F.max(a) - F.min(a) for a in AXES), F.lit(1e-9)) * (1 + 1e-9)
    about = p.groupBy(*keys).agg(h.alias("h"), F.count("*").alias("size"), span.alias("span"), *(F.min(a).alias(a + "0") for a in AXES))
    p = staged(p.select(*keys, "frame", *AXES).join(about, keys), "members")
    asked = p.where(F.col("size") <= DIRECT)
    large = p.where(F.col("size") > DIRECT)
    if large.limit(1).count():
        asked = asked.unionByName(_candidates(large))
    other = p.select(*keys, F.col("frame").alias("frame2"), *(F.col(a).alias("o" + a) for a in AXES))
    pairs = _pairs(asked, other, keys, "frame", "frame2")
    density = pairs.groupBy(*keys, "frame").agg(F.sum(F.exp(-_gap("o") / (2 * F.col("h") * F.col("h")))).alias("density"))
    best = density.groupBy(*keys).agg(F.max_by("frame", F.struct("density", -F.col("frame"))).alias("frame"), F.max("density").alias("density"))
    out = staged(best, "densest")
    drop_stage(p)
    return out


def cross_validated_bandwidth(points: DataFrame, labels: DataFrame, most: int = 5000) -> DataFrame:
    """(mol_id, cluster, h): the bandwidth of a Gaussian kernel with the highest log-likelihood of held-out members, for
    clusters of two to `most` members; larger ones take Scott's rule, as density_mode() does without a row.

    Candidates are even steps of [0.1, 1]: 5 with 2 folds for clusters under 10 members, 10 with 3 under 20, else 20
    with at most 5, members // 5, folds. Folds are runs of members in frame order. Each pair of members is made once, and
    a member's sums for all candidates are columns of one aggregation.
    """
    p = points.join(labels, ["mol_id", "frame"]).select("mol_id", "cluster", "frame", *AXES)
    n = p.groupBy("mol_id", "cluster").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= most))
    folds = F.when(F.col("n") < 10, 2).when(F.col("n") < 20, 3).otherwise(F.least(F.lit(5), F.floor(F.col("n") / 5))).cast("int")
    steps = F.when(F.col("n") < 10, 5).when(F.col("n") < 20, 10).otherwise(20)
    placed = p.join(n, ["mol_id", "cluster"]).withColumn("place", F.row_number().over(W.partitionBy("mol_id", "cluster").orderBy("frame")) - 1)
    # the first n % folds folds have one member more
    size, more = F.floor(F.col("n") / folds), F.col("n") % folds
    fold = F.when(F.col("place") < more * (size + 1), F.floor(F.col("place") / (size + 1))).otherwise(more + F.floor((F.col("place") - more * (size + 1)) / size))
    rows = staged(placed.select("mol_id", "cluster", "frame", *AXES, fold.cast("int").alias("fold"), steps.alias("steps")), "folds")
    other = rows.select("mol_id", "cluster", F.col("frame").alias("frame2"), F.col("fold").alias("fold2"), *(F.col(a).alias("o" + a) for a in AXES))
    pairs = _pairs(rows, other, ["mol_id", "cluster"], "frame", "frame2").where("fold <> fold2").withColumn("d2", _gap("o"))
    width = lambda i: 0.1 + 0.9 * F.lit(i) / (F.col("steps") - 1)
    sums = [F.sum(F.when(F.col("steps") > i, F.exp(-F.col("d2") / (2 * width(i) * width(i))))).alias(f"s{i}") for i in range(20)]
    each = pairs.groupBy("mol_id", "cluster", "frame").agg(F.first("steps").alias("steps"), F.count("*").alias("m"), *sums)
    dim = len(AXES)
    log_density = lambda i: F.log(F.greatest(F.col(f"s{i}"), F.lit(1e-300))) - F.log("m") - dim * F.log(width(i)) - dim / 2 * math.log(2 * math.pi)
    total = each.groupBy("mol_id", "cluster").agg(F.first("steps").alias("steps"), *(F.sum(F.when(F.col("steps") > i, log_density(i))).alias(f"l{i}") for i in range(20)))
    tried = F.filter(F.array(*(F.struct(F.col(f"l{i}").alias("l"), (-width(i)).alias("h")) for i in range(20))), lambda x: x["l"].isNotNull())
    out = staged(total.select("mol_id", "cluster", (-F.array_max(tried)["h"]).alias("h")), "bandwidths")
    drop_stage(rows)
    return out


def density_mode(points: DataFrame, labels: DataFrame, rounds: int = 20, bandwidths: DataFrame | None = None, large: int | None = None, sampled: bool = False) -> DataFrame:
    """(mol_id, cluster, frame): the member nearest to the mode that mean shift reaches from the cluster's mean.

    Clusters of fewer than five members give their first frame. bandwidths(mol_id, cluster, h), such as
    cross_validated_bandwidth() gives, come first, Scott's rule elsewhere. Each round is one sum over all members;
    with `sampled` the sums over clusters of more than `large` members (5000) are over a hash sample of
    max(1000, min(10000, a tenth)) of them, the nearest member still being looked for among all.
    """
    p = staged(points.join(labels, ["mol_id", "frame"]).select("mol_id", "cluster", "frame", *AXES), "mode")
    sd = sum((F.coalesce(F.stddev_samp(a), F.lit(0.0)) for a in AXES[1:]), F.coalesce(F.stddev_samp("x"), F.lit(0.0))) / 3
    scott = F.greatest(F.pow(F.count("*").cast("double"), F.lit(-1 / 7)) * sd, F.lit(1e-9))
    sums = p
    if sampled:
        n = p.groupBy("mol_id", "cluster").agg(F.count("*").alias("n"))
        share = F.greatest(F.lit(1000), F.least(F.lit(10_000), F.floor(F.col("n") / 10))) / F.col("n")
        drawn = F.pmod(F.xxhash64(F.lit("mode"), "mol_id", "frame"), F.lit(1 << 20)) / (1 << 20)
        sums = staged(p.join(n, ["mol_id", "cluster"]).where((F.col("n") <= (large or 5000)) | (drawn < share)).drop("n"), "mode")
    at = sums.groupBy("mol_id", "cluster").agg(*(F.avg(a).alias("c" + a) for a in AXES), scott.alias("scott"))
    h = F.col("scott")
    if bandwidths is not None:
        at, h = at.join(bandwidths, ["mol_id", "cluster"], "left"), F.coalesce("h", "scott")
    at = at.select("mol_id", "cluster", *("c" + a for a in AXES), h.alias("h"))
    for i in range(rounds):
        w = F.exp(-_gap("c") / (2 * F.col("h") * F.col("h")))
        moved = sums.join(at, ["mol_id", "cluster"]).withColumn("w", w).groupBy("mol_id", "cluster", "h").agg(*((F.sum(F.col("w") * F.col(a)) / F.sum("w")).alias("c" + a) for a in AXES))
        at = staged(moved, "mode") if i % 5 == 4 else moved
    found = p.join(at, ["mol_id", "cluster"]).groupBy("mol_id", "cluster").agg(F.count("*").alias("n"), F.min("frame").alias("first"), F.min_by("frame", F.struct(_gap("c"), F.col("frame"))).alias("near"))
    return found.select("mol_id", "cluster", F.when(F.col("n") < 5, F.col("first")).otherwise(F.col("near")).alias("frame"))


_SQUARES = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
#: Points of one salt of a molecule.
MIXED = 100_000


def _maximised(sums: DataFrame, k: int, ridge: float) -> DataFrame:
    """(mol_id, n, l, s0, sx0, sxx0, ...) to (mol_id, n, l, parts): of each component its log weight, mean, the inverse of its
    covariances in closed form, and what it adds to a log density; null for a component that nothing is left of."""
    names = ["".join(x) for x in _SQUARES]
    sums_ = F.array(*(F.struct(F.col(f"s{j}").alias("w"), *(F.col(f"s{c}{j}").alias(c) for c in (*AXES, *names))) for j in range(k)))
    # step by step within the array, so that no expression stands in another many times over
    some = lambda s: F.when(s["w"] > 1e-9, s["w"])
    mean = lambda s: F.struct(s["w"].alias("w"), *((s[a] / some(s)).alias("m" + a) for a in AXES), *((s[c] / some(s)).alias(c) for c in names))
    spread = lambda s: F.struct(s["w"].alias("w"), *(s["m" + a].alias("m" + a) for a in AXES), *((s[a + b] - s["m" + a] * s["m" + b] + (ridge if a == b else 0.0)).alias(a + b) for a, b in _SQUARES))

    def cofactors(s: Column) -> Column:
        xx, xy, xz, yy, yz, zz = (s[c] for c in names)
        inverse = {"ixx": yy * zz - yz * yz, "ixy": xz * yz - xy * zz, "ixz": xy * yz - xz * yy, "iyy": xx * zz - xz * xz, "iyz": xy * xz - xx * yz, "izz": xx * yy - xy * xy}
        det = F.greatest(xx * inverse["ixx"] + xy * inverse["ixy"] + xz * inverse["ixz"], F.lit(1e-30))
        return F.struct(s["w"].alias("w"), *(s["m" + a].alias("m" + a) for a in AXES), det.alias("det"), *(v.alias(c) for c, v in inverse.items()))

    def part(s: Column) -> Column:
        c = F.log(some(s) / F.col("n")) - 0.5 * (F.log(s["det"]) + 3 * math.log(2 * math.pi))
        return F.when(s["w"] > 1e-9, F.struct(c.alias("c"), *(s["m" + a].alias("m" + a) for a in AXES), *((s[i] / s["det"]).alias(i) for i in ("ixx", "ixy", "ixz", "iyy", "iyz", "izz"))))

    parts = sums_
    for f in (mean, spread, cofactors, part):
        parts = F.transform(parts, f)
    return sums.select("mol_id", "n", "l", parts.alias("parts"))


def _log_density(p: Column) -> Column:
    dx, dy, dz = (F.col(a) - p["m" + a] for a in AXES)
    q = dx * dx * p["ixx"] + dy * dy * p["iyy"] + dz * dz * p["izz"] + 2 * (dx * dy * p["ixy"] + dx * dz * p["ixz"] + dy * dz * p["iyz"])
    return F.coalesce(p["c"] - 0.5 * q, F.lit(-1e300))


def mixture(points: DataFrame, k: int, rounds: int = 20, ridge: float = 1e-6, start: DataFrame | None = None, tolerance: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """points(mol_id, frame, x, y, z) to members (mol_id, frame, cluster) and fits (mol_id, n, l): expectation maximisation
    with full covariances for all molecules together, and the log-likelihood of the last parameters but one.

    It starts from start(mol_id, frame, cluster), clusters from 0 to k - 1, or from k_centre. Points are dealt over buckets
    by molecule and salt once; a round joins each molecule's parameters, one row with an array of components, to them
    in place, makes a point's responsibilities an array in its row, and sums them in one aggregation combined in
    each task. It ends when no molecule's likelihood grows by more than `tolerance` of itself, or after `rounds`.
    """
    labels = start if start is not None else k_centre(points, k)
    n = points.groupBy("mol_id").agg(F.ceil(F.count("*") / MIXED).cast("int").alias("salts"))
    salts = staged(n, "salts")
    rows = points.join(labels.select("mol_id", "frame", "cluster"), ["mol_id", "frame"]).join(salts, "mol_id")
    p = bucketed(rows.select("mol_id", F.pmod(F.xxhash64("frame"), F.col("salts")).cast("int").alias("salt"), "frame", *AXES, "cluster"), "mixture", ["mol_id", "salt"])
    each = lambda model: p.join(model.join(salts, "mol_id").select("mol_id", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "parts"), ["mol_id", "salt"])

    def summed(shares: DataFrame, r: list[Column], l: Column) -> DataFrame:
        cols = [F.count("*").alias("n"), F.sum(l).alias("l")]
        for j in range(k):
            cols += [F.sum(r[j]).alias(f"s{j}"), *(F.sum(r[j] * F.col(a)).alias(f"s{a}{j}") for a in AXES), *(F.sum(r[j] * F.col(a) * F.col(b)).alias(f"s{a}{b}{j}") for a, b in _SQUARES)]
        return shares.groupBy("mol_id").agg(*cols)

    model = staged(_maximised(summed(p, [(F.col("cluster") == j).cast("double") for j in range(k)], F.lit(0.0)), k, ridge), "model")
    for i in range(1, rounds):
        e = each(model).withColumn("d", F.transform("parts", _log_density)).withColumn("top", F.array_max("d"))
        e = e.withColumn("u", F.transform("d", lambda x: F.exp(x - F.col("top")))).withColumn("total", F.aggregate("u", F.lit(0.0), lambda a, x: a + x))
        now = staged(_maximised(summed(e, [F.col("u")[j] / F.col("total") for j in range(k)], F.col("top") + F.log("total")), k, ridge), "model")
        before = model.select("mol_id", F.col("l").alias("before"))
        grown = i < 2 or tolerance <= 0 or now.join(before, "mol_id").where(F.col("l") - F.col("before") > tolerance * F.abs("l")).limit(1).count()
        drop_stage(model)
        model = now
        if not grown:
            break
    d = F.transform("parts", _log_density)
    own = each(model).select("mol_id", "frame", (F.array_position(d, F.array_max(d)) - 1).cast("int").alias("cluster"))
    return own, model.select("mol_id", "n", "l")


def gaussian_mixture(points: DataFrame, k: int, rounds: int = 20, ridge: float = 1e-6) -> DataFrame:
    """(mol_id, frame, cluster) of mixture(): each point's likeliest component, ties to the lowest."""
    return mixture(points, k, rounds, ridge)[0]


def silhouette_scan(points: DataFrame, least: int = 2, most: int = 8, rounds: int = 10) -> DataFrame:
    """(mol_id, k, silhouette) of the mixtures of least to most components; null where all members have one label."""
    tried = None
    for k in range(least, most + 1):
        one = silhouettes(points, staged(gaussian_mixture(points, k, rounds), "scan")).withColumn("k", F.lit(k))
        tried = one if tried is None else tried.unionByName(one)
    return staged(tried.select("mol_id", "k", "silhouette"), "scan")


def best_k(points: DataFrame, least: int = 3, most: int = 8, rounds: int = 10) -> DataFrame:
    """(mol_id, k, silhouette): of each molecule the number of mixture components with the highest silhouette."""
    tried = silhouette_scan(points, least, most, rounds)
    return tried.groupBy("mol_id").agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k"), F.max("silhouette").alias("silhouette"))


def k_by_tightness(points: DataFrame, values: DataFrame, threshold: float = 20.0, most: int = 8, rounds: int = 10) -> DataFrame:
    """(mol_id, k, tightness): of each molecule the fewest mixture components whose clusters' torsions spread by no more
    than threshold degrees in the mean, else `most`. A molecule that has got there takes no part in later rounds."""
    left, done = staged(points, "tight"), None
    for k in range(1, most + 1):
        found = staged(tightness(values.join(left.select("mol_id").distinct(), "mol_id", "left_semi"), gaussian_mixture(left, k, rounds)), "tight")
        ready = found.where((F.col("tightness") <= threshold) | F.lit(k == most)).select("mol_id", F.lit(k).alias("k"), "tightness")
        done = ready if done is None else done.unionByName(ready)
        left = staged(left.join(ready, "mol_id", "left_anti"), "tight")
        if left.isEmpty():
            break
    return done


def membership_vector(members: DataFrame) -> DataFrame:
    """(mol_id, frame, cluster) for every frame from 0 to the last, -1 where a frame is in no cluster."""
    span = members.groupBy("mol_id").agg(F.max("frame").alias("last")).select("mol_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last").cast("long"))).alias("frame"))
    return span.join(members.select("mol_id", F.col("frame").cast("long").alias("frame"), "cluster"), ["mol_id", "frame"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1)))


def upgrade_levels(summary: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """summary and members that carry n_clusters only, with a level added: 1 for the fewest clusters; members of an
    unknown n_clusters keep that number as their level."""
    rank = summary.select("mol_id", "n_clusters").distinct().withColumn("level", F.dense_rank().over(W.partitionBy("mol_id").orderBy("n_clusters")))
    new = members.join(rank, ["mol_id", "n_clusters"], "left").withColumn("level", F.coalesce("level", "n_clusters"))
    return summary.join(rank, ["mol_id", "n_clusters"]), new


def density_curve(values: DataFrame, keys: list[str], value: str, bins: int, low: float, high: float) -> DataFrame:
    """(keys, bin, density): the share of values in each of equal bins, by the bin's width."""
    width = (high - low) / bins
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(value) - low) / width))).cast("int")
    n = values.withColumn("bin", at).groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    return n.select(*keys, "bin", (F.col("n") / F.sum("n").over(W.partitionBy(*keys)) / width).alias("density"))
