"""The driver's contract, and a sample of queries against their SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sugarloom import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


def plain(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", ["torsion_stats", "silhouette", "glycosidic_classes", "name_keywords", "record_upsert", "coverage_tree", "search_texts", "pattern_parameters", "sequence_variants", "stage_gates", "metadata_payload", "short_notations", "step_status", "entry_documents", "structure_issues", "torsion_all_levels", "cluster_lookups", "torsion_metadata", "entry_graph", "level_entropies"])
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = con.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    places = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in places) for r in rel.fetchall())
