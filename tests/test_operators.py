"""Properties and small cases of the library's own operators."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sugarloom.functions import columns, names
from sugarloom.operators import clusters, folders, geometry, graph, landscapes, molecules, neighbours, records, stats, triples


def points(spark, n=120, seed=1, mols=2):
    r = random.Random(seed)
    rows = [(m, i, *(r.gauss(4 * (i % 3), 1.0) for _ in range(3))) for m in range(mols) for i in range(n)]
    return rows, spark.createDataFrame(rows, "mol_id long, frame long, x double, y double, z double")


def test_dihedral_keeps_under_reversal_and_motion(spark):
    r = np.random.default_rng(0)
    xyz = r.normal(size=(20, 4, 3))
    q, _ = np.linalg.qr(r.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    moved = xyz @ q + 3
    rows = [(i, a.ravel().tolist(), b.ravel().tolist()) for i, (a, b) in enumerate(zip(xyz, moved, strict=True))]
    df = spark.createDataFrame(rows, "i int, a array<double>, b array<double>")
    deg = lambda c, order: geometry.dihedral(*(geometry.atom(F.col(c), i) for i in order))
    for x in df.select(deg("a", range(4)).alias("p"), deg("b", range(4)).alias("q"), deg("a", (3, 2, 1, 0)).alias("r")).collect():
        assert x["p"] == pytest.approx(x["q"], abs=1e-8) == pytest.approx(x["r"], abs=1e-8)


def test_circular_statistics(spark):
    df = spark.createDataFrame([("a", 350.0), ("a", 10.0), ("b", 90.0), ("c", 0.0), ("c", 180.0)], "k string, deg double")
    got = {x["k"]: x for x in stats.circular(df, ["k"]).collect()}
    assert got["a"]["circ_mean"] == pytest.approx(0, abs=1e-9) and got["a"]["mean"] == 180
    assert got["b"]["sd"] == 0 and got["b"]["circ_sd"] == pytest.approx(0, abs=1e-6)
    assert got["c"]["circ_sd"] > 179
    turned = {x["k"]: x for x in stats.circular(df.withColumn("deg", F.col("deg") + 25), ["k"]).collect()}
    assert turned["a"]["circ_mean"] == pytest.approx(25) and turned["a"]["circ_sd"] == pytest.approx(got["a"]["circ_sd"])


def test_neighbours_and_entropy(spark):
    rows, df = points(spark)
    rows += [(9, 0, 0.0, 0.0, 0.0), (9, 1, 1.0, 0.0, 0.0)]  # too few for k
    df = spark.createDataFrame(rows, df.schema)
    got = {(x["mol_id"], x["frame"]): x["r"] for x in neighbours.kth_distances(df, 5).collect()}
    for m in (0, 1):
        p = np.array([x[2:] for x in rows if x[0] == m])
        want = np.sort(np.linalg.norm(p[:, None] - p[None], axis=2), axis=1)[:, 5]
        assert [got[m, i] for i in range(len(p))] == pytest.approx(want.tolist())
    assert not any(m == 9 for m, _ in got)
    h = {x["mol_id"]: x["entropy"] for x in neighbours.knn_entropy(df).collect()}
    wide = df.select("mol_id", "frame", *((F.col(c) * 3).alias(c) for c in "xyz"))
    for x in neighbours.knn_entropy(wide).collect():
        assert x["entropy"] == pytest.approx(h[x["mol_id"]] + 3 * math.log(3))


def test_k_centre_radius_never_grows(spark):
    rows, df = points(spark, 60, mols=1)
    last = math.inf
    for k in (1, 3, 9):
        own = {x["frame"]: x["cluster"] for x in clusters.k_centre(df, k).collect()}
        assert len(set(own.values())) == k
        p = {x[1]: np.array(x[2:]) for x in rows}
        first = {}
        for f in sorted(p):
            first.setdefault(own[f], f)
        near = max(min(np.linalg.norm(p[f] - p[g]) for g in p if own[g] == own[f]) for f in p)
        assert near <= last
        last = min(last, max(np.ptp([p[f] for f in p if own[f] == c], axis=0).max() for c in set(own.values())))
    assert {x["cluster"] for x in clusters.k_centre(df.limit(4), 9).collect()} == {0, 1, 2, 3}


def test_centres_go_on_until_all_points_are_covered(spark):
    """Forty points farther apart than the radius, beside a molecule that needs one centre."""
    rows = [(0, i, float(i), 0.0, 0.0) for i in range(40)] + [(1, i, 0.01 * i, 0.0, 0.0) for i in range(5)]
    df = spark.createDataFrame(rows, "mol_id long, frame long, x double, y double, z double")
    own = clusters.k_centre(df, None, radius=0.35).collect()
    assert len({x["cluster"] for x in own if x["mol_id"] == 0}) == 40 and {x["cluster"] for x in own if x["mol_id"] == 1} == {0}


def test_mode_moves_over_all_members(spark):
    """Six thousand members: the mode is the plain mean shift's over all of them."""
    r = np.random.default_rng(3)
    xyz = np.concatenate([r.normal(0, 1, (3300, 3)), r.normal(2.2, 0.8, (2700, 3))])
    df = spark.createDataFrame([(0, i, *map(float, v)) for i, v in enumerate(xyz)], "mol_id long, frame long, x double, y double, z double")
    got = clusters.density_mode(df, df.selectExpr("mol_id", "frame", "0 AS cluster"), rounds=5).collect()
    h, c = len(xyz) ** (-1 / 7) * xyz.std(0, ddof=1).mean(), xyz.mean(0)
    for _ in range(5):
        w = np.exp(-((xyz - c) ** 2).sum(1) / (2 * h * h))
        c = (w[:, None] * xyz).sum(0) / w.sum()
    assert [x["frame"] for x in got] == [int(((xyz - c) ** 2).sum(1).argmin())]


def test_mixture_finds_three_blobs(spark):
    rows, df = points(spark, 150, mols=1)
    far = df.select("mol_id", "frame", *((F.col(c) + 20 * (F.col("frame") % 3)).alias(c) for c in "xyz"))
    own = {x["frame"]: x["cluster"] for x in clusters.gaussian_mixture(far, 3, rounds=6).collect()}
    groups = {i: {own[f] for f in own if f % 3 == i} for i in range(3)}
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3
    labels = spark.createDataFrame([(0, f, c) for f, c in own.items()], "mol_id long, frame long, cluster int")
    assert clusters.silhouettes(far, labels).first()["silhouette"] > 0.8
    reps = clusters.density_mode(far, labels, rounds=5).collect()
    assert len(reps) == 3 and all(own[x["frame"]] == x["cluster"] for x in reps)


def test_densest_members_of_large_clusters_are_exact(spark, monkeypatch):
    """Bounds rule out members only that can't be the densest: lumps of unlike size, a line, one point many times."""
    monkeypatch.setattr(clusters, "DIRECT", 20)
    r = np.random.default_rng(12)
    shapes = {0: np.vstack([r.normal(0, 1, (250, 3)), r.normal(4, 0.2, (120, 3))]), 1: np.outer(r.normal(size=200), [1, 2, 0]), 2: np.zeros((60, 3)), 3: r.uniform(-1, 1, (150, 3)), 4: r.normal(size=(12, 3))}
    rows = [(7, i, c, *map(float, x)) for c, xs in shapes.items() for i, x in enumerate(xs, 1000 * c)]
    df = spark.createDataFrame(rows, "mol_id long, frame long, cluster int, x double, y double, z double")
    got = {x.cluster: (x.frame, x.density) for x in clusters.densest_member(df.drop("cluster"), df.select("mol_id", "frame", "cluster")).collect()}
    for c, xs in shapes.items():
        h = max(len(xs) ** (-1 / 7) * xs.std(0, ddof=1).mean(), 1e-9)
        sums = np.exp(-((xs[:, None] - xs[None]) ** 2).sum(2) / (2 * h * h)).sum(1)
        assert got[c][1] == pytest.approx(sums.max()) and sums[got[c][0] - 1000 * c] == pytest.approx(sums.max()), c


def test_centres_over_pending_rounds(spark, monkeypatch):
    """Centres held back over several rounds, and clusters left out by their radius, give the plain result."""
    monkeypatch.setattr(clusters, "PENDING", 3)
    r = np.random.default_rng(13)
    data = {0: r.normal(size=(90, 3)), 1: np.repeat(r.normal(size=(5, 3)), 8, axis=0), 2: r.normal(size=(4, 3))}
    df = spark.createDataFrame([(m, i, *map(float, x)) for m, xs in data.items() for i, x in enumerate(xs)], "mol_id long, frame long, x double, y double, z double")
    want = {}
    for m, xs in data.items():
        d, own = ((xs - xs[0]) ** 2).sum(1), np.zeros(len(xs), int)
        for k in range(1, 11):
            if d.max() <= 0:
                break
            new = ((xs - xs[d.argmax()]) ** 2).sum(1)
            own[new < d], d = k, np.minimum(new, d)
        want |= {(m, i): int(c) for i, c in enumerate(range(len(xs)) if len(xs) <= 11 else own)}
    assert {(x.mol_id, x.frame): x.cluster for x in clusters.k_centre(df, 11).collect()} == want


def test_mixture_grows_likelier_and_bears_empty_components(spark):
    """A molecule of three points repeated, one with fewer points than components, and one start that leaves one empty."""
    r = np.random.default_rng(14)
    data = {0: r.normal(size=(60, 3)), 1: np.repeat(r.normal(size=(3, 3)), 10, axis=0), 2: r.normal(size=(2, 3))}
    df = spark.createDataFrame([(m, i, *map(float, x)) for m, xs in data.items() for i, x in enumerate(xs)], "mol_id long, frame long, x double, y double, z double")
    start = df.select("mol_id", "frame", F.lit(1).alias("cluster")).withColumn("cluster", F.when(F.col("frame") % 2 == 0, 1).otherwise(3).cast("int"))
    last = None
    for rounds in (2, 5, 9):
        members, fits = clusters.mixture(df, 4, rounds, start=start)
        now = {x.mol_id: x.l for x in fits.collect()}
        assert last is None or all(now[m] >= last[m] - 1e-6 for m in now)
        last = now
    got = members.collect()
    assert len(got) == 92 and {x.cluster for x in got} <= {1, 3}
    assert clusters.gaussian_mixture(df.limit(0), 3).count() == 0


def test_superposition_never_worsens(spark):
    r = np.random.default_rng(3)
    ref = r.normal(size=(8, 3))
    q, _ = np.linalg.qr(r.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    turned = ref @ q.T + [1, 2, 3]
    coords = spark.createDataFrame([(0, 0, i, *map(float, p)) for i, p in enumerate(turned)], "mol_id long, frame long, atom_index int, x double, y double, z double")
    base = spark.createDataFrame([(0, i, *map(float, p)) for i, p in enumerate(ref)], "mol_id long, atom_index int, x double, y double, z double")
    out = {x["atom_index"]: (x["x"], x["y"], x["z"]) for x in geometry.superpose(coords, base, base.where("atom_index < 6").select("mol_id", "atom_index")).collect()}
    assert np.array([out[i] for i in range(8)]) == pytest.approx(ref)
    few = geometry.superpose(coords, base, base.where("atom_index < 2").select("mol_id", "atom_index")).orderBy("atom_index").collect()
    assert np.array([(x["x"], x["y"], x["z"]) for x in few]) == pytest.approx(turned)


def test_fits_of_odd_anchors(spark):
    """Mirror images, planes, lines, one point, equal frames and far ones: no worse than by singular values, no reflection."""
    r = np.random.default_rng(9)
    base = r.normal(size=(6, 3))
    refs = {0: base, 1: base * [1, 1, 0], 2: base[:, :1] * [[1.0, 2.0, -1.0]], 3: np.zeros((6, 3)) + [4, 5, 6], 4: base * 1e3 + 1e5}
    frames = {0: base, 1: base * [1, 1, -1], 2: r.normal(size=(6, 3)), 3: base[:, :1] * [[0.3, 0.0, 1.0]], 4: base * 1e3, 5: np.zeros((6, 3)), 6: -base}
    coords = spark.createDataFrame([(m, f, i, *map(float, p)) for m in refs for f, x in frames.items() for i, p in enumerate(x)], "mol_id long, frame long, atom_index int, x double, y double, z double")
    ref = spark.createDataFrame([(m, i, *map(float, p)) for m, x in refs.items() for i, p in enumerate(x)], "mol_id long, atom_index int, x double, y double, z double")
    found = geometry.fits(coords, ref, ref.select("mol_id", "atom_index")).collect()
    assert len(found) == len(refs) * len(frames)
    for x in found:
        p, q = frames[x.frame], refs[x.mol_id]
        pc, qc = p - p.mean(0), q - q.mean(0)
        u, s, vt = np.linalg.svd(pc.T @ qc)
        best = np.sqrt(max(0, (pc**2).sum() + (qc**2).sum() - 2 * (s[0] + s[1] + np.sign(np.linalg.det(u @ vt)) * s[2])) / 6)
        turn = np.array([[x[f"r{i}{j}"] for j in range(3)] for i in range(3)])
        scale = 1e-4 * (1 + np.sqrt((pc**2).sum() + (qc**2).sum()))
        assert turn @ turn.T == pytest.approx(np.eye(3), abs=1e-6) and np.linalg.det(turn) == pytest.approx(1, abs=1e-6)
        assert x.rmsd == pytest.approx(best, abs=scale)
        assert np.sqrt(((pc @ turn - qc) ** 2).sum() / 6) == pytest.approx(best, abs=scale)


def test_pca_matches_the_plain_one(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(80, 12)) @ np.diag([9, 6, 4] + [0.5] * 9)
    df = spark.createDataFrame([(0, i, v.tolist()) for i, v in enumerate(x)], "mol_id long, frame long, features array<float>")
    scores, model = landscapes.pca(df, 3, scale=False)
    c = x - x.mean(0)
    s = np.linalg.svd(c, compute_uv=False) ** 2
    assert [m["evr"] for m in model.orderBy("component").collect()] == pytest.approx((s[:3] / s.sum()).tolist(), rel=1e-3)
    got = np.array([v["pc"] for v in scores.orderBy("frame").collect()])
    assert np.var(got, axis=0).sum() == pytest.approx(s[:3].sum() / 80, rel=1e-3)


def test_pca_in_many_groups_matches_the_plain_one(spark, monkeypatch):
    """Molecules of unlike widths and sizes, one with fewer frames than features, over trees of reductions."""
    monkeypatch.setattr(landscapes, "GROUP_BYTES", 600)
    monkeypatch.setattr(landscapes, "FAN", 2)
    r = np.random.default_rng(5)
    data = {"a": r.normal(3, 2, (60, 9)), "b": r.normal(size=(7, 20)), "c": np.ones((4, 5)), "d": r.normal(size=(1, 3))}
    rows = [(m, i, v.tolist()) for m, x in data.items() for i, v in enumerate(x)] + [("e", 0, []), ("e", 1, None)]
    scores, model = landscapes.pca(spark.createDataFrame(rows, "mol_id string, frame long, features array<double>"), 4)
    got, shares = {}, {}
    for x in scores.orderBy("mol_id", "frame").collect():
        got.setdefault(x.mol_id, []).append(x.pc)
    for x in model.orderBy("mol_id", "component").collect():
        shares.setdefault(x.mol_id, []).append(x.evr)
    assert set(got) == set(shares) == set("abcd")
    for m in "ab":
        x = data[m]
        z = (x - x.mean(0)) / x.std(0, ddof=1)
        u, s, v = np.linalg.svd(z, full_matrices=False)
        v = v[:4] * np.sign(v[:4][np.arange(4), np.abs(v[:4]).argmax(1)])[:, None]
        assert shares[m] == pytest.approx((s[:4] ** 2 / (s**2).sum()).tolist(), rel=1e-4)
        assert np.array(got[m]) == pytest.approx(z @ v.T, abs=1e-2)
    assert np.array(got["c"]) == pytest.approx(0) and np.array(got["d"]) == pytest.approx(0)
    assert landscapes.pca(spark.createDataFrame([], "mol_id string, frame long, features array<double>"), 2)[0].count() == 0


def test_graph(spark):
    bonds = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (0, 0, 2), (0, 2, 3), (0, 3, 4), (0, 7, 8)], "mol_id long, a long, b long")
    nodes = spark.createDataFrame([(0, i) for i in (0, 1, 2, 3, 4, 7, 8, 9)], "mol_id long, node long")
    assert {x["node"]: x["component"] for x in graph.components(nodes, bonds).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 7: 7, 8: 7, 9: 9}
    assert {(x["a"], x["b"]) for x in graph.ring_bonds(bonds).collect()} == {(0, 1), (1, 2), (0, 2)}
    atoms = spark.createDataFrame([(0, i, float(i), 0.0, 0.0) for i in (0, 1, 2, 3, 4, 7, 8, 9)], "mol_id long, atom_index long, x double, y double, z double")
    whole = graph.components(nodes, graph.stitch(atoms, bonds))
    assert {x["component"] for x in whole.collect()} == {0}


def test_nearest_across_and_stitching(spark):
    """Clumps far apart, points in a plane, on a line and on one spot, lone groups, missing places, against all pairs."""
    r = np.random.default_rng(4)
    rows = []
    for m, n in (("clumps", 90), ("plane", 60), ("line", 40), ("spot", 12), ("lone", 5), ("holes", 8)):
        for i in range(n):
            x, y, z = (float(v) for v in r.integers(0, 30, 3))
            g = i % 6
            if m == "clumps":
                x, y, z = x * 0.01 + 1000.0 * (g % 2), y * 0.01, z * 0.01 + 7.0 * (g // 2) ** 2
            elif m == "plane":
                z = 1.5
            elif m == "line":
                y = z = 0.0
            elif m == "spot":
                x = y = z = 2.0
            elif m == "lone":
                g = 0
            elif m == "holes" and g in (1, 2):
                x = float("nan") if g == 1 else None
            rows.append((m, i, g, x, y, z))
    points = spark.createDataFrame(rows, "mol_id string, node long, component long, x double, y double, z double")
    want = {}
    for m, i, g, *p in rows:
        for k, j, h, *q in rows:
            if m == k and g != h and all(v is not None and v == v for v in p + q):
                d2 = sum((u - v) ** 2 for u, v in zip(p, q, strict=True))
                want[m, g] = min(want.get((m, g), (np.inf,)), (d2, min(i, j), max(i, j), h))
    for few in (0, 64):
        got = {(x.mol_id, x.component): (x.d2, x.a, x.b, x.other_group) for x in neighbours.nearest_across(points, few=few).collect()}
        assert got.keys() == want.keys() and all(got[k][1:] == want[k][1:] and got[k][0] == pytest.approx(want[k][0], abs=1e-9) for k in want)
    assert neighbours.nearest_across(points.where("false")).count() == 0

    atoms = points.withColumnRenamed("node", "atom_index").drop("component")
    own = points.alias("p").join(points.alias("q"), ["mol_id", "component"]).where("p.node < q.node and q.node - p.node = 6").select("mol_id", F.col("p.node").alias("a"), F.col("q.node").alias("b"))
    whole = graph.stitch(atoms, own)
    left = {x.mol_id: x.n for x in graph.components(points, whole).groupBy("mol_id").agg(F.countDistinct("component").alias("n")).collect()}
    # the atoms without a place stay apart; in 'lone' nothing was bonded at first
    assert left == {"clumps": 1, "plane": 1, "line": 1, "spot": 1, "lone": 1, "holes": 3}
    assert whole.count() == own.count() + 5 * 4 + 4 + 3


def test_rings_and_sides_of_random_graphs(spark):
    """A chain, trees with some bonds more, and a dense one, against walks with the bond taken out."""
    r = np.random.default_rng(8)
    graphs = {0: {(i, i + 1) for i in range(70)}, 1: {(int(r.integers(0, i)), i) for i in range(1, 40)} | {(3, 30), (10, 39)}, 2: {tuple(sorted(map(int, r.integers(0, 12, 2)))) for _ in range(30)}, 3: {(5, 9)}}
    bonds = [(m, a, b) for m, es in graphs.items() for a, b in es if a != b]
    near: dict = {}
    for m, a, b in bonds:
        near.setdefault((m, a), set()).add(b)
        near.setdefault((m, b), set()).add(a)

    def side(m, x, y):
        seen, go = {x}, [x]
        while go:
            u = go.pop()
            for v in near[m, u] - seen:
                if (u, v) not in ((x, y), (y, x)):
                    seen.add(v)
                    go.append(v)
        return seen

    df = spark.createDataFrame(bonds, "mol_id long, a long, b long")
    assert {tuple(x) for x in graph.ring_bonds(df).collect()} == {(m, a, b) for m, a, b in bonds if b in side(m, a, b)}
    cuts = [(m, i, *((a, b) if i % 2 else (b, a))) for i, (m, a, b) in enumerate(bonds)]
    asked = spark.createDataFrame(cuts, "mol_id long, cut long, x long, y long")
    want = {(m, c): side(m, x, y) for m, c, x, y in cuts}
    got: dict = {}
    for x in graph.cut_side(df, asked).collect():
        got.setdefault((x.mol_id, x.cut), set()).add(x.node)
    assert got == want
    assert {(x.mol_id, x.cut): (x.n, x.total) for x in graph.cut_totals(df, asked).collect()} == {k: (len(v), sum(v)) for k, v in want.items()}
    assert graph.ring_bonds(df.limit(0)).count() == 0


def test_molecules_of_few_and_of_many_bonds_give_the_same(spark, monkeypatch):
    """Trees with some bonds more, some bonds repeated: all within tasks, and large ones by joins."""
    r = np.random.default_rng(5)
    rows = []
    for m in range(8):
        n = int(r.integers(2, 16))
        rows += [(m, int(r.integers(0, i)), i) for i in range(1, n) if r.random() < 0.95] + [(m, *sorted(map(int, r.choice(n, 2, replace=False)))) for _ in range(int(r.integers(0, 4)))]
    bonds = spark.createDataFrame(rows + rows[:50], "mol_id long, a long, b long")
    atoms = bonds.select("mol_id", F.explode(F.array("a", "b")).alias("atom_index")).distinct().withColumn("element", F.when(F.col("atom_index") % 3 == 0, "O").otherwise("C"))
    cuts = bonds.distinct().select("mol_id", F.struct("a", "b").alias("cut"), F.col("b").alias("x"), F.col("a").alias("y"))
    nodes = atoms.select("mol_id", F.col("atom_index").alias("node"))

    def found():
        out = graph.rotatable(bonds, atoms, spark.createDataFrame([], "mol_id long, b long, c long")), graph.components(nodes, bonds), graph.cut_side(bonds, cuts)
        return [sorted(map(tuple, x.collect())) for x in out]

    whole = found()
    monkeypatch.setattr(molecules, "FEW", 9)
    assert found() == whole and all(whole)


def test_triples_of_other_predicates_are_not_made(spark):
    """A predicate that no pattern asks for is left out of the plan, with what its value costs."""
    df = spark.range(6).withColumn("k", F.concat(F.lit("e:"), F.col("id").cast("string")))
    wrong = F.raise_error(F.lit("made")).cast("string")
    every = [triples.uri(F.col("k"), "a:next", F.lit("e:0")), triples.literal(F.col("k"), "a:n", F.col("id")), triples.literal(F.col("k"), "a:bad", wrong), *triples.quantity(F.col("k"), "a:t", F.when(F.col("id") > 2, F.col("id")), "u:K", "a:T")]
    patterns = [("?e", "a:next", "?to"), ("?e", "a:n", "?n"), ("?e", "a:t", "?q"), ("?q", "qudt:numericValue", "?v")]
    made = triples.emit(df, every, True, triples.predicates(*patterns))
    assert {(x.e, x.n, x.v) for x in triples.match(triples.Store(made), patterns).collect()} == {(f"e:{i}", str(i), f"{i}.0") for i in (3, 4, 5)}
    assert triples.emit(df, every, True, {"a:none"}).count() == 0
    assert triples.predicates(("?s", "?p", "?o")) is None


def test_many_centres_take_few_jobs(spark):
    """Against a plain loop, with ties and more centres than different points."""
    r = np.random.default_rng(3)
    rows = [(m, i, *map(float, r.integers(0, 4 + 5 * (m < 2), 3))) for m in range(3) for i in range(90)]
    points = spark.createDataFrame(rows, "mol_id long, frame long, x double, y double, z double")
    wanted = {0: 7, 1: 60, 2: 80}
    k = spark.createDataFrame(list(wanted.items()), "mol_id long, k int")
    spark.sparkContext.setJobGroup("centres", "centres")
    got = {(x.mol_id, x.frame): x.cluster for x in clusters.k_centre(points, k).collect()}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("centres")) <= 16
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = {}
    for m, n in wanted.items():
        at = [x[2:] for x in rows if x[0] == m]
        gap = lambda i, j, at=at: sum((p - q) ** 2 for p, q in zip(at[i], at[j], strict=True))
        centres = [0]
        while len(centres) < n:
            far = max(range(90), key=lambda i: (min(gap(i, c) for c in centres), -i))
            if min(gap(far, c) for c in centres) == 0:
                break
            centres.append(far)
        want |= {(m, i): min(range(len(centres)), key=lambda j, i=i: (gap(i, centres[j]), j)) for i in range(90)}
    assert got == want


def test_few_jobs_for_many_small_molecules(spark):
    """Small molecules take no rounds of joins, whatever their shape."""
    bonds = spark.range(400).select(F.floor(F.col("id") / 20).alias("mol_id"), (F.col("id") % 20).alias("a"), (F.col("id") % 20 + 1).alias("b")).where("a <> 9")
    atoms = bonds.select("mol_id", F.explode(F.array("a", "b")).alias("atom_index")).distinct()
    atoms = atoms.withColumns({"element": F.lit("C"), "x": F.col("atom_index") * 1.0, "y": F.lit(0.0), "z": F.lit(0.0)})
    context = spark.sparkContext
    for name, make in {
        "rings": lambda: graph.ring_bonds(bonds), "rotatable": lambda: graph.rotatable(bonds, atoms, spark.createDataFrame([], "mol_id long, b long, c long")),
        "components": lambda: graph.components(atoms.withColumnRenamed("atom_index", "node"), bonds), "stitch": lambda: graph.stitch(atoms, bonds),
    }.items():
        context.setJobGroup(name, name)
        n = len(make().collect())
        assert n == {"rings": 0, "rotatable": 20 * 15, "components": 20 * 21, "stitch": 20 * 20}[name], (name, n)
        assert len(context.statusTracker().getJobIdsForGroup(name)) <= 16, name
    context.setLocalProperty("spark.jobGroup.id", None)


def test_torsion_names(spark):
    cases = {"O5_1-C1_1-O3_2-C3_2": "1_2_phi", "C3_2-O3_2-C1_1-O5_1": "1_2_phi", "C1_1-O3_2-C3_2-C2_2": None, "C1_1-O3_1-C3_2-C2_2": "1_2_psi", "O3_2-C6_3-C5_3-O5_3": "2_3_omega", "A-B-C-D": None, "x": None}
    df = spark.createDataFrame([(k,) for k in cases], "n string").select("n", names.glycosidic_class(F.col("n")).alias("c"))
    for x in df.collect():
        assert x["c"] == (cases[x["n"]] or "other_" + x["n"])


def test_condensed_names(spark):
    cases = {"DManpa1-2DManpa1": "Man(a1-2)Mana1", "LFucpa1-6DGlcpNAcb1": "Fuc(a1-6)GlcNAcb1", "DGlcp[2S]": "Glc2S", "DManpa1-OH": "Man(a1-O)H"}
    for x in spark.createDataFrame([(k,) for k in cases], "n string").select("n", names.condensed_name(F.col("n")).alias("c")).collect():
        assert x["c"] == cases[x["n"]]


def test_branch_keys_of_long_chains_and_branches():
    from sugarloom.operators.metadata import branch_key

    assert branch_key("A(a1-2)[B(b1-3)]C") == branch_key("B(b1-3)[A(a1-2)]C") != branch_key("A(a1-2)B(b1-3)C")
    assert branch_key("C") == "{C{}}" and branch_key("") is None and branch_key(None) is None
    assert branch_key("Glc(b1-4)" * 3000 + "Glc").count("{") == 3002


def test_lists_fold_by_case_only(spark):
    df = spark.createDataFrame([(["Ab1", " ab1 ", "", None, "ab10", "AB10", "c"],)], "v array<string>")
    assert df.select(columns.normal_list(F.col("v")).alias("v")).first()["v"] == ["Ab1", "ab10", "c"]


def test_accession_repair(spark):
    """Only what is missing is filled; what the registry lacks stays missing and is reported."""
    v = spark.createDataFrame([("alpha", "S1", ""), ("beta", "S2", "G2"), ("archetype", "S3", None), ("gamma", None, "null")], "variant string, sequence string, accession string")
    out = {x["variant"]: (x["accession"], x["outcome"]) for x in records.resolve(v, spark.createDataFrame([("S1", "G1"), ("S2", "G9")], "sequence string, accession string")).collect()}
    assert out == {"alpha": ("G1", "resolved"), "beta": ("G2", "given"), "archetype": (None, "still_missing"), "gamma": (None, "unasked")}


def test_plans_and_gates(spark):
    s = spark.createDataFrame([(1, "a", True), (1, "b", True), (2, "a", True), (2, "b", False), (3, "a", False)], "mol_id long, step string, ok boolean")
    assert {x["mol_id"]: x["action"] for x in records.decide(s, ["a", "b"], "incremental").collect()} == {1: "skip", 2: "run", 3: "run"}
    assert {x["mol_id"]: x["action"] for x in records.decide(s, ["a", "b"], "refresh").collect()} == {1: "metadata", 2: "skip", 3: "skip"}
    gates = {(x["mol_id"], x["stage"]): x["state"] for x in records.gated_stages(s.withColumnRenamed("step", "stage"), ["a", "b"]).collect()}
    assert gates[2, "b"] == "failed" and gates[3, "a"] == "failed" and gates[1, "b"] == "ok"


def test_store_of_triples(spark):
    """A store gives what the triples themselves give, in whatever order; patterns about one subject shuffle nothing."""
    r = np.random.default_rng(3)
    rows = [(f"s{a}", f"p{b}", f"s{c}" if c % 2 else f"v{c}", "uri", None) for a, b, c in zip(r.integers(0, 30, 600), r.integers(0, 4, 600), r.integers(0, 30, 600), strict=True)]
    df = spark.createDataFrame([*rows, *rows[:50]], "s string, p string, o string, o_kind string, o_type string")
    store = triples.Store(df)
    plain = df.distinct()
    assert store.triples.count() == plain.count() and set(store.about) == {"p0", "p1", "p2", "p3"}
    for patterns, optional in (([("?a", "p0", "?b"), ("?a", "p1", "?c")], []), ([("?a", "p0", "?b"), ("?b", "p1", "?c"), ("?c", "p2", "v4")], []), ([("s3", "?p", "?o")], []), ([("?a", "p9", "?b")], []), ([("?a", "p2", "?a")], []), ([("?a", "p0", "v2")], [("?a", "p3", "?d")])):
        got, want = triples.match(store, patterns, optional), triples.match(plain, patterns, optional)
        columns = sorted(want.columns)
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect())), patterns
    assert store.ordered([("?a", "p0", "?b"), ("?x", "p1", "?y"), ("?b", "p2", "v4")])[0] == ("?b", "p2", "v4")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = triples.match(store, [("?a", "p0", "?b"), ("?a", "p1", "?c"), ("?a", "p2", "?d")])
        plan = star._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "PartitionFilters: [isnotnull(p" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_literals_take_the_type_that_fits(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), ("true",), ("",), (None,)], "v string")
    got = [(x["t"]["o"], x["t"]["o_type"]) if x["t"] else None for x in df.select(triples.literal(F.lit("s"), "p", F.col("v")).alias("t")).collect()]
    assert got == [("1", "integer"), ("2.5", "double"), ("x", "string"), ("true", "boolean"), None, None]
    hard = [(x["t"]["o"], x["t"]["o_type"]) if x["t"] else None for x in df.select(triples.literal(F.lit("s"), "p", F.col("v"), "integer").alias("t")).collect()]
    assert hard[:3] == [("1", "integer"), ("2", "integer"), ("x", "string")]


def test_structure_files_and_stream(spark, tmp_path):
    from sugarloom.sources import tables, trajectories
    from sugarloom.streaming.ingest import ingest

    atom = lambda i, name, x: f"ATOM  {i:5d} {name:<4s} 0MA A   1    {x:8.3f}{1.0:8.3f}{2.0:8.3f}  1.00  0.00           {name[0]}"
    model = lambda k, n=3: "\n".join([f"MODEL     {k:4d}", *(atom(i + 1, f"C{i + 1}", i + k) for i in range(n)), "ENDMDL"])
    folder = tmp_path / "db"
    folder.mkdir()
    (folder / "a.pdb").write_text(model(1) + "\n" + model(2) + "\n" + model(3, 2) + "\nEND\n")
    (folder / "b.pdb").write_text("\n".join(atom(i, "O5", i) for i in (1, 2)) + "\n")
    (folder / "c.pdb").write_text(model(1) + "\n" + "MODEL        2\n" + atom(1, "C1", 5.0) + "\n")
    m = trajectories.models(spark, str(folder))
    n = {(x["mol_id"], x["frame"]): len(x["lines"]) for x in m.collect()}
    assert n == {("a", 0): 3, ("a", 1): 3, ("a", 2): 2, ("b", 0): 2, ("c", 0): 3}
    assert [(x["mol_id"], x["frame"]) for x in trajectories.uneven(m).collect()] == [("a", 2)]
    top = {(x["mol_id"], x["atom_index"]): (x["name"], x["element"]) for x in trajectories.topology(m).collect()}
    assert top["b", 1] == ("O5", "O") and top["a", 2] == ("C3", "C")
    assert trajectories.frames(m).where("mol_id = 'a' and frame = 1").first()["xyz"][:3] == [2.0, 1.0, 2.0]
    for _ in range(2):
        ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    assert tables.listing(spark, str(folder)).count() == 3
    odd = spark.createDataFrame([("x[2S]", 1), ("y", 2)], "mol_id string, v int")
    tables.write_by_molecule(odd, str(tmp_path / "t"))
    assert [tuple(x) for x in tables.read_molecules(spark, str(tmp_path / "t"), ["x[2S]"]).collect()] == [("x[2S]", 1)]


def test_inventory_and_sections(spark, tmp_path):
    from sugarloom.sources import tables, trajectories

    path = tmp_path / "i.csv"
    path.write_text("﻿" + ",".join(f'"{c}"' for c in tables.INVENTORY) + '\nGS1,"18/12/2023 15:58:20",a@b,"DManp[2S,3S]a1-OH",x,1.5,p,f,300,bad,,, TODO\n', encoding="utf-8")
    x = tables.inventory(spark, str(path)).first()
    assert (x["entry_id"], x["created"], x["glycam_name"], x["length"], x["pressure"], x["accession"]) == ("GS1", "2023-12-18 15:58:20", "DManp[2S,3S]a1-OH", 1.5, None, None)
    f = tmp_path / "m.mol2"
    f.write_text("@<TRIPOS>MOLECULE\nx\n@<TRIPOS>ATOM\n 1 C1 0.5 1.0 2.0 C\nbad line\n 2 O5 1 2 3 O\n@<TRIPOS>BOND\n 1 1 2 1\n 2 2\n")
    atoms, bonds, lacking = trajectories.sections(spark, str(f))
    assert [tuple(a) for a in atoms.collect()] == [("m", 1, 0.5, 1.0, 2.0), ("m", 2, 1.0, 2.0, 3.0)]
    assert [tuple(b) for b in bonds.collect()] == [("m", 1, 2)] and lacking.count() == 0


def test_bandwidths_and_tightness(spark):
    """Held-out likelihoods against a plain version, and the fewest clusters that are tight enough."""
    import math
    import random

    from sugarloom.operators import clusters

    r = random.Random(3)
    rows = [(m, f, *(r.gauss(3 * (f % 2), 0.3 + 0.2 * m) for _ in "xyz")) for m, n in ((0, 8), (1, 15), (2, 26)) for f in range(n)]
    points = spark.createDataFrame(rows, "mol_id int, frame int, x double, y double, z double")
    labels = points.select("mol_id", "frame", F.lit(0).alias("cluster"))
    got = {x["mol_id"]: x["h"] for x in clusters.cross_validated_bandwidth(points, labels).collect()}
    for m, folds, steps in ((0, 2, 5), (1, 3, 10), (2, 5, 20)):
        own = [x[2:] for x in rows if x[0] == m]
        n = len(own)
        sizes = [n // folds + (i < n % folds) for i in range(folds)]
        fold = [i for i, k in enumerate(sizes) for _ in range(k)]
        best = None
        for i in range(steps):
            h = 0.1 + 0.9 * i / (steps - 1)
            total = 0.0
            for a, p in enumerate(own):
                rest = [q for b, q in enumerate(own) if fold[b] != fold[a]]
                s = sum(math.exp(-sum((u - v) ** 2 for u, v in zip(p, q)) / (2 * h * h)) for q in rest)
                total += math.log(max(s, 1e-300) / len(rest)) - 3 * math.log(h) - 1.5 * math.log(2 * math.pi)
            if best is None or total > best[0]:
                best = (total, h)
        assert abs(got[m] - best[1]) < 1e-9
    values = points.select("mol_id", "frame", F.lit(0).alias("torsion_id"), F.when(F.col("frame") % 2 == 0, 10.0).otherwise(150.0).alias("deg"))
    k = {x["mol_id"]: (x["k"], x["tightness"]) for x in clusters.k_by_tightness(points.where("mol_id < 2"), values, 20.0, 4, 5).collect()}
    assert set(k) == {0, 1} and all(n == 2 and t < 1e-3 for n, t in k.values())
    near = clusters.density_mode(points, labels, 5, clusters.cross_validated_bandwidth(points, labels))
    assert near.count() == 3 and clusters.density_mode(points, labels, 5, large=10, sampled=True).count() == 3


def test_documents_submissions_and_names(spark, tmp_path):
    from sugarloom.sources import tables, trajectories

    (tmp_path / "e1").mkdir()
    (tmp_path / "e2").mkdir()
    (tmp_path / "e1" / "data.json").write_text('{"a": 1, "b": {"c": "x"}}')
    (tmp_path / "e2" / "data.json").write_text('{"a": ')
    assert [tuple(x) for x in tables.documents(spark, f"{tmp_path}/*/data.json", "a int, b struct<c: string>").select("entry_id", "a", "b.c").collect()] == [("e1", 1, "x")]
    rows = spark.createDataFrame([("1", "N", "2024-01-02 00:00:00", 1.0), ("2", "N", "2024-01-01 00:00:00", None), ("3", "N", None, 2.0), ("4", None, "2024-01-01 00:00:00", None)], "entry_id string, glycam_name string, created string, length double")
    assert [x["entry_id"] for x in tables.first_submissions(rows).collect()] == ["2"]
    made = {x["entry_id"]: x for x in tables.submission_records(rows).collect()}
    assert set(made) == {"1", "2", "3"} and made["1"]["created"] == "2024-01-02 00:00:00.000Z" and made["3"]["created"] is None and made["2"]["status"] == "inbucket"
    tables.write_lines(rows, "glycam_name", f"{tmp_path}/lines")
    assert spark.read.text(f"{tmp_path}/lines").count() == 3
    assert trajectories.escaped("/a[b]/{c}") == "/a\\[b\\]/\\{c\\}"
    one = spark.range(1)
    assert one.select(names.without_series(F.lit("D-Gal-L-Fuc"))).first()[0] == "Gal-Fuc"
    assert tuple(one.select(names.anomer_variants(F.lit("Gal"), F.lit("DGalp"), F.lit("1"))).first()[0]) == ("Gal(a1-", "Gal(b1-", "DGalpa1-OH", "DGalpb1-OH")
    with pytest.raises(ValueError):
        geometry.selected_atoms(one, "some")


def test_entropy_details_and_best_k(spark):
    r = random.Random(2)
    rows = [(0, f, *(r.gauss(8 * (f % 3), 0.4) for _ in "xyz")) for f in range(45)] + [(1, f, 0.0, 0.0, float(f)) for f in range(3)]
    points = spark.createDataFrame(rows, "mol_id int, frame int, x double, y double, z double")
    plain = neighbours.knn_entropy(points).first()["entropy"]
    got = neighbours.entropy_details(points, temperature=300.0).collect()
    assert len(got) == 1 and abs(got[0]["entropy"] - plain) < 1e-9 and abs(got[0]["kbt_h_joule"] - plain * neighbours.BOLTZMANN * 300) < 1e-30
    assert [x["mol_id"] for x in neighbours.too_few(points).collect()] == [1]
    assert abs(neighbours.entropy_details(points, standardise=True).first()["entropy"] - plain) > 1
    best = clusters.best_k(points.where("mol_id = 0"), 2, 4, 6).first()
    assert best["k"] == 3 and best["silhouette"] > 0.7


def test_folders_and_entries_with_gaps(spark):
    recs = spark.createDataFrame([("a", "G1", "X"), ("a", "G0", "X"), ("b", "G2", None), (" ", "G3", "X"), (None, "G3", "X"), ("c", None, "X"), ("e", "G9", "null")], "name string, id string, accession string")
    there = spark.createDataFrame([(f"s/G{i}", f"G{i}") for i in (0, 1, 2, 3, 9)] + [("s/G4", "G4"), ("s/G4", "G4")], "folder string, id string")
    local = spark.createDataFrame([("a", "l/a"), ("c", "l/c2"), ("c", "l/c1"), ("d", None)], "name string, folder string")
    docs = spark.createDataFrame([("s/G0", "z", True), ("s/G2", "b", True), ("s/G3", "D", False), ("s/G4", None, True), ("s/G7", "f", True), ("s/G9", "e", False)], "folder string, name string, complete boolean")
    index = folders.folder_index(recs, there, local, docs)
    assert {tuple(x) for x in index.collect()} == {("a", "s/G0", "record"), ("c", "l/c1", "local"), ("b", "s/G2", "document")}
    wanted = spark.createDataFrame([("a",), ("b",), ("d",), ("e",), ("q",), (None,), ("a",)], "name string")
    found = {x.name: (x.folder, x.rule) for x in folders.find_folders(wanted, index, recs, there, docs).collect()}
    assert found == {"a": ("s/G0", "record"), "b": ("s/G2", "document"), "d": ("s/G3", "caseless"), "e": ("s/G9", "exact"), "q": (None, None)}
    assert folders.folder_index(*(x.where("false") for x in (recs, there, local, docs))).count() == 0

    old = spark.createDataFrame([("1", "one", ["x"], "kept text"), ("2", "two", None, None)], "id string, name string, aliases array<string>, search_text string")
    new = spark.createDataFrame([("2", None, ["B", " b ", ""]), ("3", "three", None), (" ", "blank", None), (None, "none", None)], "id string, name string, aliases array<string>")
    got = {x.id: (x.name, x.aliases, x.search_text, x.action) for x in records.upsert_entries(old, new, "id", ["name"], ["aliases"]).collect()}
    assert got["1"] == ("one", ["x"], "kept text", "kept")
    assert got["2"] == ("two", ["B"], "two\nB", "updated")
    assert got["3"][0] == "three" and got["3"][2] == "three" and got["3"][3] == "created" and set(got) == {"1", "2", "3"}


def test_followed_trajectories(spark, tmp_path):
    """State over three runs: models in parts, a part that comes again under another name, a gap, files that are whole at
    once, against the angles of all models."""
    from sugarloom.streaming import ingest as streams

    r = np.random.default_rng(6)
    xyz = {m: np.round(r.normal(size=(9, 5, 3)) * 3, 3) for m in ("m1", "m2", "m3")}

    def put(folder: str, mol: str, models: list[int]) -> None:
        lines = []
        for k in models:
            lines.append(f"MODEL     {k:4d}")
            lines += [f"ATOM  {i + 1:5d}  C{i}  GLC A   1    {x:8.3f}{y:8.3f}{z:8.3f}  1.00  0.00           C  " for i, (x, y, z) in enumerate(xyz[mol][k - 1])]
            lines.append("ENDMDL")
        where = tmp_path / "in" / folder
        where.mkdir(parents=True, exist_ok=True)
        (where / f"{mol}.pdb").write_text("\n".join(lines) + "\n")

    def run() -> dict:
        q = streams.follow(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), str(tmp_path / "cp"), [(0, 1, 2, 3), (1, 2, 3, 4), (2, 3, 4, 7)], expected=9)
        q.awaitTermination()
        return {x.mol_id: x for x in streams.progress(spark, str(tmp_path / "out")).collect()}

    put("one", "m1", [1, 2, 3])
    put("one", "m2", list(range(1, 10)))
    first = run()
    assert (first["m1"].status, first["m1"].n_models, first["m2"].status) == ("partial", 3, "complete")
    put("two", "m1", [2, 3, 6, 7])
    put("two", "m3", [4])
    second = run()
    assert (second["m1"].n_models, second["m1"].n_gaps, second["m1"].last_model, second["m3"].first_model) == (5, 1, 7, 4)
    put("three", "m1", [9, 8, 5, 4, 1])
    third = run()
    assert (third["m1"].status, third["m1"].n_models, third["m1"].n_gaps, third["m3"].status) == ("complete", 9, 0, "partial")
    assert third["m1"].angle_n == [9, 9, 0] and third["m1"].mean_deg[2] is None

    def angle(p: np.ndarray) -> float:
        b1, b2, b3 = p[1] - p[0], p[2] - p[1], p[3] - p[2]
        n1, n2 = np.cross(b1, b2), np.cross(b2, b3)
        return math.atan2(np.dot(np.cross(n1, n2), b2 / np.linalg.norm(b2)), np.dot(n1, n2))

    for t in (0, 1):
        z = np.mean([np.exp(1j * angle(m[t : t + 4])) for m in xyz["m1"]])
        assert np.exp(1j * math.radians(third["m1"].mean_deg[t])) == pytest.approx(z / abs(z), abs=1e-9) and third["m1"].resultant[t] == pytest.approx(abs(z))
    again = run()
    assert again == third


def test_annotated_is_dealt_over_tasks_by_its_rows(spark, monkeypatch):
    from sugarloom.operators import exports

    monkeypatch.setattr(exports, "ATOM_ROWS", 50)
    atoms = spark.range(0, 100, 1, 1).selectExpr("id AS mol_id", "explode(sequence(0, 7)) AS atom_index").selectExpr("*", "'C' || atom_index AS name", "1 AS res_id", "'MAN' AS res_name")
    torsions = spark.range(0, 100, 1, 1).selectExpr("id AS mol_id", "0 AS torsion_id", "0 AS a", "1 AS b", "2 AS c", "3 AS d")
    out = exports.annotated(torsions, atoms)
    assert out.rdd.getNumPartitions() == 16  # 800 atoms from one partition
    assert {(x["n"], x["m"]) for x in out.groupBy("original_name").agg(F.count("*").alias("n"), F.countDistinct("mol_id").alias("m")).collect()} == {(100, 100)}


def test_kth_distances_by_blocks_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 24)
    r, k = np.random.default_rng(5), 3
    line = np.column_stack([np.zeros(120), np.zeros(120), r.normal(size=120)])
    heavy = np.where(r.random((150, 3)) < 0.6, 1.0, r.normal(size=(150, 3)))  # many on one spot, many on one plane
    mixed = {"a": np.concatenate([r.normal(size=(300, 3)) * 0.01, r.normal(size=(40, 3)) * 100]), "b": np.concatenate([line, heavy]), "c": np.ones((30, 3)), "d": r.normal(size=(5, 3)), "e": np.ones((3, 3))}
    rows = [(m, i, *map(float, x)) for m, p in mixed.items() for i, x in enumerate(p)]
    df = spark.createDataFrame([*rows, ("d", 90, None, 0.0, 0.0), ("d", 91, float("nan"), 0.0, 0.0), (None, 1, 0.0, 0.0, 0.0)], "mol_id string, frame long, x double, y double, z double")
    got = {(x["mol_id"], x["frame"]): x["r"] for x in neighbours.kth_distances(df, k).collect()}
    assert got.pop(("d", 90)) is None and math.isnan(got.pop(("d", 91)))
    want = {}
    for m, p in mixed.items():
        d = np.sort(np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2)), axis=1)
        want |= {(m, i): d[i, k] for i in range(len(p)) if len(p) > k}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-12) for x in want)
    positions = df.where("mol_id = 'b'").groupBy("mol_id", *"xyz").agg(F.count("*").alias("_copies"))
    dealt, tree = neighbours._blocks(positions, list("xyz"), "mol_id", 24)
    assert max(x["count"] for x in dealt.groupBy("_node").count().collect()) <= 24 and len(tree) > 2


def test_bonds_are_dealt_once_by_molecule(spark, monkeypatch):
    monkeypatch.setattr(molecules, "FEW", 50)
    rows = [(m, i % 7, 10 + i % 5) for m in (1, 2, None) for i in range(40)] + [(3, i % 30, 50 + i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "mol_id long, a long, b long")
    assert sorted(map(tuple, graph.dealt_once(df).collect()), key=str) == sorted(set(rows), key=str)
    few = graph.dealt_once(df.where("mol_id < 3"))
    # repeats fall out, and degrees are counted, where the rows have been dealt to by molecule
    assert graph.degrees(few)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
