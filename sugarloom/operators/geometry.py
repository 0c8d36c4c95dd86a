"""Geometry of frames: distances, dihedrals, landscapes, superposition, torsion edits.

frames are rows (mol_id, frame, xyz array<float> of 3 numbers an atom); everything stays in the row, so a
trajectory of any length is as many independent rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]


def atom(xyz: Column, index: Column | int) -> Vector:
    """The place of an atom, counted from 0, as doubles."""
    i = F.lit(index) if isinstance(index, int) else index
    return tuple(F.element_at(xyz, (3 * i + k).cast("int")).cast("double") for k in (1, 2, 3))


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Vector, b: Vector) -> Column:
    return norm(minus(a, b))


def dihedral(a: Vector, b: Vector, c: Vector, d: Vector) -> Column:
    """Degrees in (-180, 180]; vectors of no length count as unit ones."""
    whole = lambda x: F.when(x == 0, F.lit(1.0)).otherwise(x)
    b1, b2, b3 = minus(b, a), minus(c, b), minus(d, c)
    n1, n2 = cross(b1, b2), cross(b2, b3)
    l1, l2, lb = whole(norm(n1)), whole(norm(n2)), whole(norm(b2))
    y = dot(cross(n1, n2), b2) / (l1 * l2 * lb)
    return F.degrees(F.atan2(y, dot(n1, n2) / (l1 * l2)))


def torsion_values(frames: DataFrame, torsions: DataFrame, digits: int = 3) -> DataFrame:
    """frames x torsions(mol_id, torsion_id, a, b, c, d) to (mol_id, frame, torsion_id, deg).

    Torsions of a molecule are few and meet its frames by mol_id; the frames aren't shuffled where Spark
    finds the torsions small.
    """
    joined = frames.join(torsions, "mol_id")
    deg = dihedral(*(atom(F.col("xyz"), F.col(x)) for x in "abcd"))
    return joined.select(*(c for c in frames.columns if c != "xyz"), "torsion_id", F.round(deg, digits).alias("deg"))


def pair_list(atoms: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs i > j in the order of a lower triangle."""
    return [(atoms[i], atoms[j]) for i in range(len(atoms)) for j in range(i)]


def landscape(frames: DataFrame, atoms: Sequence[int]) -> DataFrame:
    """(mol_id, frame, features array<float>): all distances of the chosen atoms, by numpy blocks.

    Fewer than two atoms give empty features.
    """
    pairs = np.array(pair_list(list(atoms)), int).reshape(-1, 2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                xyz = np.stack(pdf["xyz"].to_numpy()).reshape(len(pdf), -1, 3).astype(np.float64)
                d = np.sqrt(((xyz[:, pairs[:, 0]] - xyz[:, pairs[:, 1]]) ** 2).sum(2)).astype(np.float32)
                yield pd.DataFrame({"mol_id": pdf["mol_id"], "frame": pdf["frame"], "features": list(d)})

    kinds = {f.name: f.dataType.simpleString() for f in frames.schema.fields}
    return frames.select("mol_id", "frame", "xyz").mapInPandas(run, f"mol_id {kinds['mol_id']}, frame {kinds['frame']}, features array<float>")


def selected_atoms(atoms: DataFrame, method: str, most: int = 300, seed: int = 0) -> DataFrame:
    """The atoms that a landscape is made of: noH_fast takes up to `most` heavy atoms by a seeded hash, noH all heavy ones,
    all every one; in atom order."""
    if method not in ("noH_fast", "noH", "all"):
        raise ValueError(f"unknown method {method}")
    kept = atoms if method == "all" else atoms.where(heavy(F.col("element")))
    return sample_atoms(kept, most, F.xxhash64(F.lit(seed), "mol_id", "atom_index")) if method == "noH_fast" else kept


def sample_atoms(atoms: DataFrame, most: int, key: Column) -> DataFrame:
    """Of each molecule up to `most` atoms, those with the smallest key (a hash), in atom order."""
    from pyspark.sql import Window as W

    rank = F.row_number().over(W.partitionBy("mol_id").orderBy(key, "atom_index"))
    return atoms.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def heavy(element: Column) -> Column:
    """True for atoms other than hydrogen; a null element counts as heavy."""
    return ~F.coalesce(F.upper(F.trim(element)), F.lit("")).startswith("H")


def _det3(m: list[list[Column]]) -> Column:
    a, b, c = m
    return a[0] * (b[1] * c[2] - b[2] * c[1]) - a[1] * (b[0] * c[2] - b[2] * c[0]) + a[2] * (b[0] * c[1] - b[1] * c[0])


def _cofactor(m: list[list[Column]], i: int, j: int) -> Column:
    return (-1) ** (i + j) * _det3([[x for c, x in enumerate(row) if c != j] for r, row in enumerate(m) if r != i])


#: A thousandth of a millionth of each entry's place in a matrix without symmetry: where anchors lie on a line, many
#: rotations fit alike, and this chooses one of them.
_TILT = [[1e-10 * (1 + 0.37 * i + 0.61 * j * j) for j in range(3)] for i in range(3)]


def fits(coords: DataFrame, reference: DataFrame, anchors: DataFrame) -> DataFrame:
    """(mol_id, frame, n, rmsd, p0..p2, q0..q2, r00..r22): the rotation r, about the anchors' centre p, that with q brings a
    frame's anchors nearest to the reference's, and the root mean square distance that is left.

    Covariances are sums of one aggregation a frame. The best rotation is the unit quaternion of the largest eigenvalue of
    a symmetric 4 x 4 matrix of them (Horn 1987); the eigenvalue comes from Newton steps on the characteristic polynomial
    from above (Theobald 2005), the quaternion from the cofactors, all as column expressions. Under three anchors nothing
    is turned or moved. A frame without anchors has no row.
    """
    ref = reference.join(anchors, ["mol_id", "atom_index"]).select("mol_id", "atom_index", *(F.col(c).alias("r" + c) for c in "xyz"))
    both = coords.join(ref, ["mol_id", "atom_index"])
    squares = lambda cols: F.sum(sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0])))
    sums = [F.sum(c).alias("s" + c) for c in ("x", "y", "z", "rx", "ry", "rz")] + [F.sum(F.col(a) * F.col("r" + b)).alias(f"c{a}{b}") for a in "xyz" for b in "xyz"]
    f = both.groupBy("mol_id", "frame").agg(F.count("*").alias("n"), *sums, squares(["x", "y", "z"]).alias("g"), squares(["rx", "ry", "rz"]).alias("h"))
    n = F.col("n")
    norm = lambda p: (F.col(p + "x") * F.col(p + "x") + F.col(p + "y") * F.col(p + "y") + F.col(p + "z") * F.col(p + "z")) / n
    f = f.withColumn("e", (F.greatest(F.lit(0.0), F.col("g") - norm("s")) + F.greatest(F.lit(0.0), F.col("h") - norm("sr"))) / 2)
    safe = F.when(F.col("e") > 0, F.col("e")).otherwise(1.0)
    f = f.withColumns({f"m{a}{b}": (F.col(f"c{a}{b}") - F.col("s" + a) * F.col("sr" + b) / n) / safe + _TILT[i][j] for i, a in enumerate("xyz") for j, b in enumerate("xyz")})
    m = {a + b: F.col(f"m{a}{b}") for a in "xyz" for b in "xyz"}
    upper = [
        [m["xx"] + m["yy"] + m["zz"], m["yz"] - m["zy"], m["zx"] - m["xz"], m["xy"] - m["yx"]],
        [m["xx"] - m["yy"] - m["zz"], m["xy"] + m["yx"], m["zx"] + m["xz"]],
        [m["yy"] - m["xx"] - m["zz"], m["yz"] + m["zy"]],
        [m["zz"] - m["xx"] - m["yy"]],
    ]
    f = f.withColumns({f"k{i}{i + j}": v for i, row in enumerate(upper) for j, v in enumerate(row)})
    k = [[F.col(f"k{min(i, j)}{max(i, j)}") for j in range(4)] for i in range(4)]
    c2 = -2 * sum((m[a + b] * m[a + b] for a in "xyz" for b in "xyz"), F.lit(0.0))
    c1 = -8 * _det3([[m[a + b] for b in "xyz"] for a in "xyz"])
    c0 = sum((k[0][j] * _cofactor(k, 0, j) for j in range(1, 4)), k[0][0] * _cofactor(k, 0, 0))
    f = f.withColumns({"c2": c2, "c1": c1, "c0": c0})
    # no row's sums of absolute values is under the largest eigenvalue, so the steps come down to it
    start = F.greatest(*(sum((F.abs(x) for x in row[1:]), F.abs(row[0])) for row in k))

    def newton(v: Column, _: Column) -> Column:
        value = ((v * v + F.col("c2")) * v + F.col("c1")) * v + F.col("c0")
        slope = (4 * v * v + 2 * F.col("c2")) * v + F.col("c1")
        return F.when(F.abs(slope) > 1e-14, v - value / slope).otherwise(v)

    f = f.withColumn("top", F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, newton))
    left = [[x - F.col("top") if i == j else x for j, x in enumerate(row)] for i, row in enumerate(k)]
    f = f.withColumns({f"a{i}{j}": _cofactor(left, i, j) for i in range(4) for j in range(i, 4)})
    a = [[F.col(f"a{min(i, j)}{max(i, j)}") for j in range(4)] for i in range(4)]
    rows = F.array(*(F.struct(F.abs(a[i][i]).alias("size"), F.array(*a[i]).alias("q")) for i in range(4)))
    f = f.withColumn("quaternion", F.array_max(rows)["q"])
    q = [F.col("quaternion")[i] for i in range(4)]
    f = f.withColumn("length", sum((x * x for x in q[1:]), q[0] * q[0]))
    w, x, y, z = (v / F.sqrt("length") for v in q)
    turn = [
        [w * w + x * x - y * y - z * z, 2 * (x * y + w * z), 2 * (x * z - w * y)],
        [2 * (x * y - w * z), w * w - x * x + y * y - z * z, 2 * (y * z + w * x)],
        [2 * (x * z + w * y), 2 * (y * z - w * x), w * w - x * x - y * y + z * z],
    ]
    fit = (n >= 3) & (F.col("length") > 0)
    out = {f"r{i}{j}": F.when(fit, turn[i][j]).otherwise(float(i == j)) for i in range(3) for j in range(3)}
    out |= {f"{p}{i}": F.when(fit, F.col(s + c) / n).otherwise(0.0) for p, s in (("p", "s"), ("q", "sr")) for i, c in enumerate("xyz")}
    stay = F.sqrt(F.greatest(F.lit(0.0), F.col("g") + F.col("h") - 2 * (F.col("cxx") + F.col("cyy") + F.col("czz"))) / n)
    rmsd = F.when(fit, F.sqrt(F.greatest(F.lit(0.0), 2 * F.col("e") * (1 - F.col("top"))) / n)).otherwise(stay)
    return f.select("mol_id", "frame", "n", rmsd.alias("rmsd"), *(v.alias(c) for c, v in out.items()))


def superpose(coords: DataFrame, reference: DataFrame, anchors: DataFrame) -> DataFrame:
    """coords(mol_id, frame, atom_index, x, y, z) laid over reference(mol_id, atom_index, x, y, z) by the anchors
    (mol_id, atom_index): the least squares rotation without reflection, see fits(). Fewer than three anchors leave a
    frame as it is."""
    moved = coords.join(fits(coords, reference, anchors).drop("n", "rmsd"), ["mol_id", "frame"], "left")
    centred = [F.col(c) - F.coalesce(F.col(f"p{i}"), F.lit(0.0)) for i, c in enumerate("xyz")]
    new = [F.coalesce(sum((centred[i] * F.col(f"r{i}{j}") for i in range(1, 3)), centred[0] * F.col(f"r0{j}")) + F.col(f"q{j}"), F.col(c)).alias(c) for j, c in enumerate("xyz")]
    return moved.select("mol_id", "frame", "atom_index", *new)


def rotate_about(point: Vector, origin: Vector, axis: Vector, radians: Column) -> Vector:
    """A point turned about a line through origin along a unit vector (Rodrigues)."""
    k, v = axis, minus(point, origin)
    c, s = F.cos(radians), F.sin(radians)
    kv, kd = cross(k, v), dot(k, v)
    return tuple(o + a * c + b * s + n * kd * (1 - c) for o, a, b, n in zip(origin, v, kv, k, strict=True))


def set_torsion(frames: DataFrame, moving: Column, a: Column, b: Column, c: Column, d: Column, target: Column) -> DataFrame:
    """Frames with the atoms in the array `moving` turned about the bond b-c, so that the torsion is `target` degrees."""
    xyz = F.col("xyz")
    now = dihedral(*(atom(xyz, i) for i in (a, b, c, d)))
    axis = minus(atom(xyz, c), atom(xyz, b))
    length = norm(axis)
    unit = [F.when(length == 0, F.lit(0.0)).otherwise(x / length) for x in axis]
    # what all atoms share is worked out once a frame
    turned = frames.withColumns({"_turn": F.radians(target - now), "_axis": F.array(*unit), "_origin": F.array(*(x.cast("double") for x in atom(xyz, c)))})
    k, origin = (tuple(F.get(name, F.lit(i)) for i in range(3)) for name in ("_axis", "_origin"))

    def one(i: Column) -> Column:
        p = atom(xyz, i)
        return F.when(F.array_contains(moving, i), F.array(*rotate_about(p, origin, k, F.col("_turn")))).otherwise(F.array(*(x.cast("double") for x in p)))

    index = F.sequence(F.lit(0), (F.size(xyz) / 3).cast("int") - 1)
    return turned.withColumn("xyz", F.flatten(F.transform(index, one))).drop("_turn", "_axis", "_origin")


def perturbations(torsions: DataFrame, step: float, both_ways: bool = True) -> DataFrame:
    """torsions(mol_id, torsion_id, deg) to designs (mol_id, varied, change, torsion_id, deg): each torsion in turn
    changed by the step, the others as they are."""
    changes = F.array(F.lit(-step), F.lit(step)) if both_ways else F.array(F.lit(step))
    varied = torsions.select("mol_id", F.col("torsion_id").alias("varied"), F.explode(changes).alias("change"))
    out = varied.join(torsions, "mol_id")
    return out.select("mol_id", "varied", "change", "torsion_id", F.when(F.col("varied") == F.col("torsion_id"), F.col("deg") + F.col("change")).otherwise(F.col("deg")).alias("deg"))


def _flipped(coords: DataFrame, role: Column, needed: tuple[str, ...], default_co: float, default_ch: float) -> DataFrame:
    """coords with x, y, z after the flip of the atoms whose role is C1, O1, H1 or HO1, and `_done`, whether their frame had
    all of the needed ones."""
    named = {n: [F.max(F.when(role == n, F.col(c))).alias(f"{n}_{c}") for c in "xyz"] for n in ("C1", "O1", "H1", "HO1")}
    four = coords.groupBy("mol_id", "frame").agg(*(x for cols in named.values() for x in cols))
    at = {n: tuple(F.col(f"{n}_{c}") for c in "xyz") for n in named}
    co, ch = minus(at["O1"], at["C1"]), minus(at["H1"], at["C1"])
    lo, lh = norm(co), norm(ch)
    ko, kh = F.when(lo > 0, lo).otherwise(default_co), F.when(lh > 0, lh).otherwise(default_ch)
    new_o = tuple(o + x / F.when(lh > 0, lh).otherwise(1.0) * ko for o, x in zip(at["C1"], ch, strict=True))
    new_h = tuple(o + x / F.when(lo > 0, lo).otherwise(1.0) * kh for o, x in zip(at["C1"], co, strict=True))
    done = F.lit(True)
    for n in needed:
        done = done & F.col(f"{n}_x").isNotNull()
    moves = four.select("mol_id", "frame", done.alias("_done"), *(v.alias(f"o_{c}") for v, c in zip(new_o, "xyz", strict=True)), *(v.alias(f"h_{c}") for v, c in zip(new_h, "xyz", strict=True)), *(F.col(f"O1_{c}") for c in "xyz"))
    out = coords.join(moves, ["mol_id", "frame"])
    pick = lambda c: (
        F.when(F.col("_done") & (role == "O1"), F.col(f"o_{c}"))
        .when(F.col("_done") & (role == "H1"), F.col(f"h_{c}"))
        .when(F.col("_done") & (role == "HO1"), F.col(c) + F.col(f"o_{c}") - F.col(f"O1_{c}"))
        .otherwise(F.col(c))
    )
    return out.select(*(c for c in coords.columns if c not in tuple("xyz")), *(pick(c).alias(c) for c in "xyz"), "_done")


def flip_anomer(coords: DataFrame, default_co: float = 1.43, default_ch: float = 1.09) -> DataFrame:
    """coords(mol_id, frame, atom_name, x, y, z) with the directions C1-O1 and C1-H1 swapped, bond lengths kept and
    the hydroxyl hydrogen carried along; frames without C1, O1 or H1 stay."""
    return _flipped(coords, F.col("atom_name"), ("C1", "O1", "H1"), default_co, default_ch).select("mol_id", "frame", "atom_name", "x", "y", "z")


def flip_residue(coords: DataFrame, cap: int = 1, ring: int = 2, default_co: float = 1.43, default_ch: float = 1.09) -> DataFrame:
    """coords(mol_id, frame, res_id, res_name, atom_name, x, y, z, more) with the anomer of the residue `ring` flipped: its
    C1 and H1 against O1 and HO1 of the residue `cap`, and the last letter of its name, A or B, turned into the other.
    A frame that lacks one of the four atoms stays as it is, its name too; other last letters stay."""
    role = F.when(((F.col("res_id") == ring) & F.col("atom_name").isin("C1", "H1")) | ((F.col("res_id") == cap) & F.col("atom_name").isin("O1", "HO1")), F.col("atom_name"))
    out = _flipped(coords, F.coalesce(role, F.lit("")), ("C1", "O1", "H1", "HO1"), default_co, default_ch)
    last = F.substring("res_name", -1, 1)
    other = F.concat(F.expr("left(res_name, length(res_name) - 1)"), F.when(last == "A", "B").otherwise("A"))
    name = F.when(F.col("_done") & (F.col("res_id") == ring) & last.isin("A", "B"), other).otherwise(F.col("res_name"))
    return out.withColumn("res_name", name).select(*coords.columns)
