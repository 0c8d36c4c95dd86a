"""Continuous ingest of structure files: the incremental planner as a file stream."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sugarloom.operators.geometry import dihedral
from sugarloom.sources.trajectories import parsed


def _models(spark: SparkSession, source: str) -> DataFrame:
    """(mol_id, model, atoms) of every model of every new file below source; a file's name without its ending is the
    molecule."""
    raw = spark.readStream.option("lineSep", "ENDMDL").text(source).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.filter(F.split("value", "\r?\n"), lambda x: x.startswith("ATOM  ") | x.startswith("HETATM"))
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[^.]*$", "")
    return raw.select(name.alias("mol_id"), F.regexp_extract("value", r"MODEL\s+(\d+)", 1).try_cast("long").alias("model"), F.transform(lines, parsed).alias("atoms")).where(F.size("atoms") > 0)


def _start(rows: DataFrame, target: str, checkpoint: str, mode: str) -> StreamingQuery:
    """rows to target, a folder a batch: a batch that is repeated replaces its own, so a retry leaves no doubles."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    return rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Every new file below source, once: a row (mol_id, model, n_atoms, mean_x, mean_y, mean_z) a model appended to
    target. The checkpoint holds what has been read; a batch that is repeated replaces its own folder, so a
    retry leaves no doubles."""
    mean = lambda c: (F.aggregate("atoms", F.lit(0.0), lambda s, a: s + a[c]) / F.size("atoms")).alias(f"mean_{c}")
    rows = _models(spark, source).select("mol_id", "model", F.size("atoms").alias("n_atoms"), *(mean(c) for c in "xyz"))
    return _start(rows, target, checkpoint, "append")


PROGRESS = "mol_id string, status string, n_models long, first_model long, last_model long, n_gaps long, angle_n array<long>, mean_deg array<double>, resultant array<double>"


def _merged(lo: np.ndarray, hi: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges lo..hi, apart and in order, with the numbers `new`, none of which they hold."""
    lo, hi = np.concatenate([lo, new]), np.concatenate([hi, new])
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    begins = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    return lo[begins], hi[np.concatenate([begins[1:], [True]])]


def follow(spark: SparkSession, source: str, target: str, checkpoint: str, torsions: Sequence[Sequence[int]], expected: int | None = None, patience: str | None = None) -> StreamingQuery:
    """Running torsion statistics of every molecule, brought up to date by each new file below source.

    The state of a molecule is which models have come, as ranges of numbers, and for each torsion (four positions of
    atoms) how many angles there were and the sums of their sines and cosines; so it does not grow with the frames, only
    with the gaps among them. A model that came before, in whatever file, counts once; one without a number is number 1; an
    angle of missing atoms is left out. A molecule is `complete` with the models 1 to
    `expected`, else `partial`; with `patience` (such as "2 hours") one that has been partial for that long is said to be
    `stalled`. Rows as in PROGRESS, a folder a batch, are read with progress(). State lies in the checkpoint: a restart
    goes on from it, and a lost executor's part is read again.
    """
    at = lambda i: tuple(F.get("atoms", F.lit(i))[c] for c in "xyz")
    angles = F.array(*(dihedral(*(at(i) for i in four)).cast("double") for four in torsions))
    rows = _models(spark, source).select("mol_id", F.coalesce("model", F.lit(1)).alias("model"), angles.alias("deg"))
    size, wait = len(torsions), patience

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = json.loads(state.get[0]) if state.exists else {"lo": [], "hi": [], "n": [0] * size, "sin": [0.0] * size, "cos": [0.0] * size}
        lo, hi = (np.array(kept[k], dtype="int64") for k in ("lo", "hi"))
        n, sin, cos = np.array(kept["n"], dtype="int64"), np.array(kept["sin"]), np.array(kept["cos"])
        for chunk in chunks:
            chunk = chunk.drop_duplicates("model")
            model = chunk["model"].to_numpy("int64")
            place = np.searchsorted(lo, model, side="right") - 1
            fresh = np.ones(len(model), dtype=bool) if not len(lo) else (place < 0) | (hi[np.maximum(place, 0)] < model)
            if fresh.any():
                lo, hi = _merged(lo, hi, model[fresh])
                rad = np.radians(np.array([list(x) for x in chunk["deg"][fresh]], dtype="float64").reshape(-1, size))
                n, sin, cos = n + np.isfinite(rad).sum(0), sin + np.nansum(np.sin(rad), 0), cos + np.nansum(np.cos(rad), 0)
        whole = expected is not None and len(lo) == 1 and lo[0] == 1 and hi[0] >= expected
        said = "complete" if whole else "stalled" if state.hasTimedOut else "partial"
        state.update((json.dumps({"lo": lo.tolist(), "hi": hi.tolist(), "n": n.tolist(), "sin": sin.tolist(), "cos": cos.tolist()}),))
        if wait and said == "partial":
            state.setTimeoutDuration(wait)
        some = n > 0
        mean = [float(x) if s else None for x, s in zip(np.degrees(np.arctan2(sin, cos)), some, strict=True)]
        length = [float(x) if s else None for x, s in zip(np.hypot(sin, cos) / np.maximum(n, 1), some, strict=True)]
        row = (key[0], said, int((hi - lo + 1).sum()), int(lo[0]), int(hi[-1]), len(lo) - 1, n.tolist(), mean, length)
        yield pd.DataFrame([row], columns=[c.split()[0] for c in PROGRESS.split(", ")])

    timer = GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout
    return _start(rows.groupBy("mol_id").applyInPandasWithState(step, PROGRESS, "kept string", "update", timer), target, checkpoint, "update")


def progress(spark: SparkSession, target: str) -> DataFrame:
    """The last row of each molecule that follow() has written to target."""
    every = spark.read.schema(PROGRESS + ", batch long").parquet(target)
    columns = [c.split()[0] for c in PROGRESS.split(", ")][1:]
    return every.groupBy("mol_id").agg(F.max_by(F.struct(*columns), "batch").alias("last")).select("mol_id", "last.*")
