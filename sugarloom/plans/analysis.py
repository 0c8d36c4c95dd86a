"""The analysis of all molecules as one plan: landscape, components, entropy, clusters, torsions, statistics, document."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sugarloom.functions.columns import clusters_for_entropy, percent
from sugarloom.operators import clusters, geometry, landscapes, neighbours, stats
from sugarloom.operators.staging import staged


def analyse(frames: DataFrame, torsions: DataFrame, atoms: list[int], components: int = 3, k: int = 5) -> dict[str, DataFrame]:
    """frames(mol_id, frame, xyz), torsions(mol_id, torsion_id, a, b, c, d) to tables scores, variance, members,
    representatives, torsion_stats, entropy and info. Molecules go through together; no step gathers one."""
    scores, variance = landscapes.pca(geometry.landscape(frames, atoms), components)
    points = staged(scores.select("mol_id", "frame", *(F.coalesce(F.get("pc", F.lit(i)), F.lit(0.0)).alias(a) for i, a in enumerate("xyz"))), "scores")
    members = staged(clusters.gaussian_mixture(points, k, rounds=8), "members")
    reps = staged(clusters.nearest_to_centroid(points, members), "reps")
    values = geometry.torsion_values(frames, torsions)
    torsion_stats = staged(stats.cluster_torsion_stats(values, members, reps), "stats")
    entropy = neighbours.knn_entropy(points)
    return {"scores": scores, "variance": variance, "members": members, "representatives": reps, "torsion_stats": torsion_stats, "entropy": entropy, "info": info(members, reps, torsion_stats, entropy)}


#: The steps of a run, in order; a molecule that fails one takes no part in those after it.
STEPS = ("store", "pca", "entropy", "torsions", "level_1", "level_2", "level_3", "statistics", "info")


def _faults(frames: DataFrame) -> DataFrame:
    """(mol_id, error) of every molecule: what is wrong with its frames, null for nothing."""
    size = F.size("xyz")
    odd = F.exists("xyz", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    seen = frames.groupBy("mol_id").agg(F.count("*").alias("n"), F.countDistinct("frame").alias("different"), F.sum(F.col("xyz").isNull().cast("int")).alias("none"), F.min(size).alias("least"), F.max(size).alias("most"), F.bool_or(F.coalesce(odd, F.lit(False))).alias("odd"))
    error = (
        F.when(F.col("none") > 0, "a frame has no coordinates").when(F.col("least") != F.col("most"), "frames have unlike numbers of atoms").when((F.col("most") % 3 != 0) | (F.col("most") == 0), "coordinates are not three an atom")
        .when(F.col("odd"), "a coordinate is no number").when(F.col("different") < F.col("n"), "a frame is there twice").when(F.col("n") < 2, "one frame only")
    )
    return seen.select("mol_id", error.alias("error"))


class Run:
    """The steps of an analysis that have been done: what each gave, how long it took, and which molecules still go on."""

    def __init__(self, molecules: DataFrame):
        self.going = staged(molecules.select("mol_id").distinct(), "going")
        self.rows: list[DataFrame] = []

    def step(self, name: str, result: DataFrame, reason: str, faults: DataFrame | None = None) -> DataFrame:
        """result written once and counted on the way; molecules that have no row of it, or a fault, fail for `reason` or
        their fault and stop here."""
        began, seen = time.perf_counter(), Observation()
        out = staged(result.observe(seen, F.count("*").alias("rows")), name)
        took = time.perf_counter() - began
        ready = out.select("mol_id").distinct().withColumn("there", F.lit(True))
        told = self.going.join(ready, "mol_id", "left").join(faults if faults is not None else self.going.select("mol_id", F.lit(None).cast("string").alias("error")), "mol_id", "left")
        error = F.coalesce("error", F.when(F.col("there").isNull(), reason))
        state = staged(told.select("mol_id", F.lit(name).alias("step"), error.isNull().alias("ok"), F.lit(took).alias("seconds"), F.lit(seen.get["rows"]).cast("long").alias("rows"), error.alias("error")), "status")
        self.rows.append(state)
        self.going = state.where("ok").select("mol_id")
        return out.join(self.going, "mol_id", "left_semi")

    def only(self, df: DataFrame) -> DataFrame:
        return df.join(self.going, "mol_id", "left_semi")

    def status(self) -> DataFrame:
        """(mol_id, step, ok, seconds, rows, error) of the steps that each molecule has reached."""
        return reduce(DataFrame.unionByName, self.rows)


def run(frames: DataFrame, torsions: DataFrame, atoms: list[int], components: int = 3, k: int = 5, most: int = 512) -> dict[str, DataFrame]:
    """frames(mol_id, frame, xyz), torsions(mol_id, torsion_id, a, b, c, d) to tables status, scores, entropy, members
    and summary of three levels, torsion_stats and info, for all molecules together.

    Level 1 is a mixture of k components, level 2 as many centres as the entropy asks for, level 3 up to `most` centres.
    A molecule whose frames or torsions are at fault, or that a step gives nothing for, is `failed` in status with the
    step and the reason, and the others go on; no molecule's fault ends the run.
    """
    chain = Run(frames)
    good = chain.step("store", frames.select("mol_id", "frame", "xyz"), "no frames", _faults(frames))
    scores, variance = landscapes.pca(geometry.landscape(good, atoms), components)
    axes = [F.coalesce(F.get("pc", F.lit(i)), F.lit(0.0)).alias(a) for i, a in enumerate("xyz")]
    points = chain.step("pca", scores.select("mol_id", "frame", *axes), "no components")
    entropy = chain.step("entropy", neighbours.knn_entropy(points).select("mol_id", "entropy"), "too few frames for the neighbours of a point")
    wide = good.groupBy("mol_id").agg((F.max(F.size("xyz")) / 3).alias("wide"))
    out = torsions.join(wide, "mol_id").where((F.greatest(*"abcd") >= F.col("wide")) | (F.least(*"abcd") < 0)).select("mol_id", F.lit("a torsion names an atom that is not there").alias("error")).distinct()
    sound = chain.only(torsions).join(out, "mol_id", "left_anti")
    values = chain.step("torsions", geometry.torsion_values(chain.only(good), sound), "no torsions", out)
    members = []
    for level in (1, 2, 3):
        p = chain.only(points)
        if level == 1:
            found = clusters.gaussian_mixture(p, k, rounds=8)
        else:
            found = clusters.k_centre(p, chain.only(entropy).select("mol_id", clusters_for_entropy(F.col("entropy")).alias("k")) if level == 2 else most)
        members.append(chain.step(f"level_{level}", found.select("mol_id", F.lit(level).alias("level"), "frame", F.col("cluster").cast("int").alias("cluster")), "no clusters"))
    every = chain.only(reduce(DataFrame.unionByName, members))
    # a level of a molecule is a key of its own in what follows
    keyed = lambda df: df.withColumn("mol_id", F.struct("mol_id", "level")).drop("level")
    plain = lambda df: df.select("mol_id.mol_id", "mol_id.level", *(c for c in df.columns if c != "mol_id"))
    levels = F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("level")
    reps = staged(clusters.nearest_to_centroid(keyed(chain.only(points).select("*", levels)), keyed(every)), "reps")
    figures = stats.cluster_torsion_stats(keyed(chain.only(values).select("*", levels)), keyed(every), reps)
    torsion_stats = chain.step("statistics", plain(figures), "no figures")
    sizes = stats.cluster_sizes(keyed(every)).join(reps.withColumnRenamed("frame", "representative"), ["mol_id", "cluster"], "left")
    summary = staged(plain(sizes), "summary")
    told = {c: F.col(c) if c in torsions.columns else F.lit(None).cast("string") for c in ("canonical_name", "family", "subtype", "common_name")}
    told |= {c: F.coalesce(told[c], F.lit("other")) for c in ("family", "subtype")}
    about = chain.only(torsions).select("mol_id", "torsion_id", *(v.alias(c) for c, v in told.items()))
    documents = chain.step("info", info_documents(summary, torsion_stats, chain.only(variance), about, entropy), "no document")
    return {"status": chain.status(), "scores": points, "entropy": entropy, "members": every, "summary": summary, "torsion_stats": torsion_stats, "info": documents}


def outcome(status: DataFrame) -> DataFrame:
    """status to (mol_id, outcome, step, error): complete after all STEPS, else failed at a step."""
    last = F.min(F.when(~F.col("ok"), F.struct(F.array_position(F.array(*map(F.lit, STEPS)), F.col("step")).alias("at"), "step", "error"))).alias("bad")
    whole = status.groupBy("mol_id").agg(last, F.countDistinct("step").alias("n"))
    return whole.select("mol_id", F.when(F.col("bad").isNull() & (F.col("n") == len(STEPS)), "complete").otherwise("failed").alias("outcome"), "bad.step", "bad.error")


def info(members: DataFrame, reps: DataFrame, torsion_stats: DataFrame, entropy: DataFrame) -> DataFrame:
    """(mol_id, info): one nested JSON document a molecule; a cluster's torsions as a map."""
    per = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("torsion_id").cast("string").alias("key"), F.struct("n", "mean", "sd", "circ_mean", "circ_sd", "rep_deg").alias("value")))))
    t = torsion_stats.groupBy("mol_id", "cluster").agg(per.alias("torsions"))
    c = stats.cluster_sizes(members).join(reps.withColumnRenamed("frame", "representative"), ["mol_id", "cluster"], "left").join(t, ["mol_id", "cluster"], "left")
    listed = F.array_sort(F.collect_list(F.struct("cluster", "n", "pct", "representative", F.to_json("torsions").alias("torsions"))))
    doc = c.groupBy("mol_id").agg(listed.alias("clusters")).join(entropy.select("mol_id", "entropy"), "mol_id", "left")
    return doc.select("mol_id", F.to_json(F.struct(F.lit(3).alias("schema_version"), "entropy", "clusters")).alias("info"))


def info_documents(summary: DataFrame, torsion_stats: DataFrame, variance: DataFrame, torsions: DataFrame, entropy: DataFrame) -> DataFrame:
    """(mol_id, info): the whole document of each molecule, of any number of levels.

    summary(mol_id, level, cluster, n, pct, representative), torsion_stats(mol_id, level, cluster, torsion_id, and its
    figures), variance(mol_id, component, evr), torsions(mol_id, torsion_id, canonical_name, family, subtype,
    common_name), entropy(mol_id, entropy). A block without rows is null.
    """
    figures = [c for c in torsion_stats.columns if c not in ("mol_id", "level", "cluster", "torsion_id")]
    by_key = lambda a, b: F.when(a.key < b.key, -1).when(a.key > b.key, 1).otherwise(0)
    # of one cluster's torsions, one level's clusters, one molecule's levels
    own = torsion_stats.groupBy("mol_id", "level", "cluster").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("torsion_id").cast("string").alias("key"), F.struct(*figures).alias("value"))), by_key))).alias("torsions"))
    clusters_ = summary.join(own, ["mol_id", "level", "cluster"], "left").select("mol_id", "level", F.struct(F.col("cluster").alias("cluster_id"), F.col("n").alias("size"), F.col("pct").alias("cluster_size_pct"), "representative", "torsions").alias("c"))
    levels = clusters_.groupBy("mol_id", "level").agg(F.array_sort(F.collect_list("c")).alias("clusters"))
    levels = levels.groupBy("mol_id").agg(F.array_sort(F.collect_list(F.struct("level", F.size("clusters").alias("n_clusters"), "clusters"))).alias("levels"))
    shares = variance.groupBy("mol_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("component", "evr"))), lambda x: x.evr).alias("evr"))
    running = F.transform("evr", lambda _, i: F.aggregate(F.slice("evr", 1, i + 1), F.lit(0.0), lambda a, x: a + x))
    pca = shares.select("mol_id", F.struct(F.col("evr").alias("explained_variance_ratio"), running.alias("cumulative_variance"), F.size("evr").alias("n_components")).alias("pca"))
    meta = F.array_sort(F.collect_list(F.struct(F.col("torsion_id").alias("index"), "canonical_name", "family", "subtype", "common_name")))
    told = torsions.groupBy("mol_id").agg(meta.alias("metadata"))
    is_linked = lambda x: x.family == "glycosidic"
    count = lambda name: F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.transform("metadata", lambda x: x[name]))), lambda v: F.struct(v, F.size(F.filter("metadata", lambda x: x[name] == v)))))
    told = told.select("mol_id", F.struct(F.size("metadata").alias("count"), F.size(F.filter("metadata", is_linked)).alias("glycosidic"), F.size(F.filter("metadata", lambda x: ~is_linked(x))).alias("non_glycosidic"), F.struct(count("family").alias("by_family"), count("subtype").alias("by_subtype")).alias("family_summary"), "metadata").alias("torsions"))
    out = levels.join(pca, "mol_id", "left").join(told, "mol_id", "left").join(entropy.select("mol_id", "entropy"), "mol_id", "left")
    return out.select("mol_id", F.to_json(F.struct(F.lit(3).alias("schema_version"), F.col("entropy").alias("entropy_nats"), "pca", "levels", "torsions")).alias("info"))


def level_rows(documents: DataFrame) -> DataFrame:
    """info documents (mol_id, info) back to rows (mol_id, level, cluster, name, share), shares rounded as they are shown."""
    kind = "array<struct<level: int, clusters: array<struct<cluster_id: int, cluster_size_pct: double>>>>"
    levels = documents.select("mol_id", F.explode(F.from_json(F.get_json_object("info", "$.levels"), kind)).alias("l"))
    each = levels.select("mol_id", F.col("l.level").alias("level"), F.explode("l.clusters").alias("c"))
    share = percent(F.col("c.cluster_size_pct"), F.col("level"))
    return each.select("mol_id", "level", F.col("c.cluster_id").alias("cluster"), F.concat(F.lit("Cluster "), F.col("c.cluster_id").cast("string")).alias("name"), share.alias("share"))
