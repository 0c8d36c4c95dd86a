"""Merging and ordering of documents."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged_maps(old: Column, new: Column) -> Column:
    """map<string, array<string>> of both: lists joined without repeats, old values first; a key of one side stays."""
    empty = F.array().cast("array<string>")
    return F.map_zip_with(old, new, lambda k, a, b: F.array_distinct(F.concat(F.coalesce(a, empty), F.coalesce(b, empty))))


def _deep(old, new):
    """new over old: objects key by key, lists joined without repeats, anything else replaced."""
    if isinstance(old, dict) and isinstance(new, dict):
        return {**old, **{k: _deep(old[k], v) if k in old else v for k, v in new.items()}}
    if isinstance(old, list) and isinstance(new, list):
        kept: dict[str, object] = {}
        for x in [*old, *new]:
            kept.setdefault(json.dumps(x, sort_keys=True), x)
        return list(kept.values())
    return new


def merged_json(rows: DataFrame, old: str, new: str, out: str) -> DataFrame:
    """rows with the deep merge of two columns of JSON texts; a text that is null or no JSON leaves the other as it is."""

    def read(text):
        try:
            return json.loads(text) if text else None
        except ValueError:
            return None

    def one(a, b):
        a, b = read(a), read(b)
        merged = b if a is None else a if b is None else _deep(a, b)
        return None if merged is None else json.dumps(merged, separators=(",", ":"), ensure_ascii=False)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=object)

    return rows.withColumn(out, F.pandas_udf(run, "string")(F.col(old), F.col(new)))


def files_by_molecule(files: DataFrame, last: str = "output/info.json") -> DataFrame:
    """files(mol_id, path) to (mol_id, files, complete): the distinct files of each molecule, and whether `last` is there."""
    return files.groupBy("mol_id").agg(F.array_sort(F.collect_set("path")).alias("files"), F.bool_or(F.col("path") == last).alias("complete"))


def union_sorted(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def model_order(label: Column) -> Column:
    """Sort key of a cluster label: its number, what is none last."""
    return F.coalesce(F.regexp_extract(label, r"(-?\d+)\s*$", 1).try_cast("long"), F.lit(10**9))


def shortest(paths: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """Of each key the shortest path, ties by text."""
    return paths.groupBy(*keys).agg(F.min_by(path, F.struct(F.length(path), F.col(path))).alias(path))


def levels_complete(levels: DataFrame, required: list[int]) -> DataFrame:
    """levels(mol_id, level) to (mol_id, complete)."""
    need = F.array(*map(F.lit, required))
    return levels.groupBy("mol_id").agg((F.size(F.array_except(need, F.collect_set("level"))) == 0).alias("complete"))


def capped_scan(rows: DataFrame, priority: Column, most: int | None) -> DataFrame:
    """All rows if there are at most `most`, else those with priority: the broad scan's rule. The count is one aggregate.
    With most None every row is scanned."""
    if most is None:
        return rows
    n = rows.agg(F.count("*").alias("_n"))
    return rows.crossJoin(F.broadcast(n)).where((F.col("_n") <= most) | priority).drop("_n")
