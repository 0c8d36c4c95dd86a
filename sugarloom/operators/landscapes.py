"""Principal components of wide landscapes, without ever forming features x features.

A randomised range finder (Halko, Martinsson and Tropp 2011) with its matrices on the executors: a molecule's frames are
dealt over groups of bounded size once, in a bucketed table; every pass meets the molecule's thin basis group by group,
and what the groups give is added, or decomposed anew, by a tree of reductions within the molecule. The driver sees the
size of the largest molecule and nothing else, and the jobs are as many for one molecule as for a million.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.operators.staging import bucketed, drop_stage, staged

EXTRA = 8
#: Bytes of features that one group of frames holds, and groups that one reduction takes in.
GROUP_BYTES, FAN = 48 << 20, 16


def _grouped(features: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """features dealt over (mol_id, salt), how many salts each molecule has, and the most that one has."""
    used = features.where(F.size("features") > 0).select("mol_id", "frame", "features")
    sizes = used.groupBy("mol_id").agg(F.count("*").alias("n"), F.max(F.size("features")).alias("wide"))
    salts = F.ceil(F.col("n") * F.col("wide") * 8 / GROUP_BYTES).cast("int")
    sizes = staged(sizes.select("mol_id", salts.alias("salts")), "sizes")
    rows = used.join(sizes, "mol_id").select("mol_id", F.pmod(F.xxhash64("frame"), F.col("salts")).cast("int").alias("salt"), "frame", "features")
    return bucketed(rows, "groups", ["mol_id", "salt"]), sizes, sizes.agg(F.coalesce(F.max("salts"), F.lit(1))).first()[0]


def _block(frames: pd.DataFrame) -> np.ndarray:
    return np.stack(frames["features"].to_numpy()).astype(float)


def _tree(parts: DataFrame, most: int, merge: Callable[[list[dict]], dict]) -> DataFrame:
    """parts(mol_id, salt, n, m) merged within molecules, FAN at a time, to (mol_id, n, m)."""
    schema = parts.schema

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        out = merge([{"n": int(n), "m": np.asarray(m, float)} for n, m in zip(pdf["n"], pdf["m"], strict=True)])
        return pd.DataFrame({"mol_id": pdf["mol_id"].iloc[:1], "salt": pdf["salt"].iloc[:1], "n": [out["n"]], "m": [out["m"]]})

    while most > 1:
        most = -(-most // FAN)
        parts = parts.withColumn("salt", F.expr(f"salt div {FAN}").cast("int")).groupBy("mol_id", "salt").applyInPandas(reduce, schema)
    return parts.select("mol_id", "n", "m")


def _moments(parts: list[dict]) -> dict:
    """Counts, means and sums of squared gaps of two and more parts, by Chan's update."""
    n, mean, gaps = 0, 0.0, 0.0
    for p in parts:
        m, q = p["m"].reshape(2, -1)
        apart, total = m - mean, n + p["n"]
        gaps = gaps + q + apart**2 * (n * p["n"] / total)
        mean = mean + apart * (p["n"] / total)
        n = total
    return {"n": n, "m": np.concatenate([mean, gaps])}


def _added(parts: list[dict]) -> dict:
    return {"n": sum(p["n"] for p in parts), "m": np.sum([p["m"] for p in parts], axis=0)}


def _triangles(k: Callable[[np.ndarray], int]) -> Callable[[list[dict]], dict]:
    """Triangles on top of each other to one triangle; the last number of each part, a sum of squares, is added."""

    def merge(parts: list[dict]) -> dict:
        stack = np.vstack([p["m"][:-1].reshape(-1, k(p["m"])) for p in parts])
        return {"n": sum(p["n"] for p in parts), "m": np.append(np.linalg.qr(stack, mode="r").ravel(), sum(p["m"][-1] for p in parts))}

    return merge


def _model(row: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, sd = np.asarray(row["mean"].iloc[0], float), np.asarray(row["sd"].iloc[0], float)
    return mean, sd, np.asarray(row["basis"].iloc[0], float).reshape(len(mean), -1)


def pca(features: DataFrame, n: int, scale: bool = True, power: int = 2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """features(mol_id, frame, features array) to scores (mol_id, frame, pc array<double>) and the model (mol_id,
    component, evr).

    Features are centred and, if scale, divided by their deviation (ddof 1; 0 counts as 1). n is cut to the rank. A
    component's sign is such that its largest loading is positive. Frames without features have no row. power + 4
    passes read the groups in place; a group and its molecule's basis (features x (n + EXTRA)) are in one task's memory.
    The singular values come from a tree of QR factorisations of the groups' projections.
    """
    groups, sizes, most = _grouped(features)
    kind = {f.name: f.dataType.simpleString() for f in groups.schema.fields}
    part = f"mol_id {kind['mol_id']}, salt int, n long, m array<double>"
    own = groups.groupBy("mol_id", "salt")

    def moments(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _block(pdf)
        m = np.concatenate([x.mean(0), ((x - x.mean(0)) ** 2).sum(0)])
        return pd.DataFrame({"mol_id": pdf["mol_id"].iloc[:1], "salt": pdf["salt"].iloc[:1], "n": [len(x)], "m": [m]})

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        count, (mean, gaps) = int(pdf["n"].iloc[0]), np.asarray(pdf["m"].iloc[0], float).reshape(2, -1)
        var = gaps / max(1, count - 1)
        sd = np.where(var > 1e-18, np.sqrt(var), 1.0) if scale else np.ones(len(mean))
        k = min(n + EXTRA, count, len(mean))
        basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(mean), k)))[0]
        return pd.DataFrame({"mol_id": pdf["mol_id"], "count": [count], "mean": [mean], "sd": [sd], "basis": [basis.ravel()]})

    model_kind = f"mol_id {kind['mol_id']}, count long, mean array<double>, sd array<double>, basis array<double>"
    total = _tree(own.applyInPandas(moments, part), most, _moments)
    model = staged(total.groupBy("mol_id").applyInPandas(begin, model_kind), "pca")

    def meets(model: DataFrame, make: Callable, schema: str) -> DataFrame:
        """make(group, its molecule's row of the model) over all groups."""
        each = model.join(sizes, "mol_id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        return own.cogroup(each.groupBy("mol_id", "salt")).applyInPandas(make, schema)

    def product(pdf: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or row.empty:
            return pd.DataFrame({"mol_id": [], "salt": [], "n": [], "m": []})
        mean, sd, basis = _model(row)
        x = (_block(pdf) - mean) / sd
        return pd.DataFrame({"mol_id": pdf["mol_id"].iloc[:1], "salt": pdf["salt"].iloc[:1], "n": [len(x)], "m": [(x.T @ (x @ basis)).ravel()]})

    def orthogonal(row: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
        wide = len(row["mean"].iloc[0])
        return row.assign(basis=[np.linalg.qr(np.asarray(z["m"].iloc[0], float).reshape(wide, -1))[0].ravel()])

    for _ in range(power + 1):
        z = _tree(meets(model, product, part), most, _added)
        now = staged(model.groupBy("mol_id").cogroup(z.groupBy("mol_id")).applyInPandas(orthogonal, model_kind), "pca")
        drop_stage(model)
        model = now

    def triangle(pdf: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or row.empty:
            return pd.DataFrame({"mol_id": [], "salt": [], "n": [], "m": []})
        mean, sd, basis = _model(row)
        x = (_block(pdf) - mean) / sd
        y = x @ basis
        r = np.linalg.qr(np.vstack([y, np.zeros((max(0, y.shape[1] - len(y)), y.shape[1]))]), mode="r")
        return pd.DataFrame({"mol_id": pdf["mol_id"].iloc[:1], "salt": pdf["salt"].iloc[:1], "n": [len(x)], "m": [np.append(r.ravel(), (x * x).sum())]})

    def finish(row: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        m = np.asarray(found["m"].iloc[0], float)
        _, s, turn = np.linalg.svd(m[:-1].reshape(-1, _side(m)))
        basis = _model(row)[2]
        most = min(n, max(1, int(row["count"].iloc[0]) - 1), len(s))
        w = basis @ turn[:most].T
        sign = np.sign(w[np.abs(w).argmax(0), np.arange(most)])
        return row.assign(basis=[(w * np.where(sign == 0, 1, sign)).ravel()], evr=[s[:most] ** 2 / (m[-1] or 1.0)])

    r = _tree(meets(model, triangle, part), most, _triangles(_side))
    done = staged(model.groupBy("mol_id").cogroup(r.groupBy("mol_id")).applyInPandas(finish, f"{model_kind}, evr array<double>"), "pca")
    drop_stage(model)

    def score(pdf: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or row.empty:
            return pd.DataFrame({"mol_id": [], "frame": [], "pc": []})
        mean, sd, basis = _model(row)
        return pd.DataFrame({"mol_id": pdf["mol_id"], "frame": pdf["frame"], "pc": list((_block(pdf) - mean) / sd @ basis)})

    scores = meets(done, score, f"mol_id {kind['mol_id']}, frame {kind['frame']}, pc array<double>")
    shares = done.select("mol_id", F.posexplode("evr").alias("at", "evr"))
    return scores, shares.select("mol_id", (F.col("at") + 1).alias("component"), "evr")


def _side(m: np.ndarray) -> int:
    """The side of a square triangle that lies before one more number."""
    return round((len(m) - 1) ** 0.5)
