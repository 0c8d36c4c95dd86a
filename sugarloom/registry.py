"""All queries of the library proper, with the SQL that gives the same rows."""

from __future__ import annotations

from sugarloom.queries import bonds, entries, exports, holdings, metadata, records, shape, sources, text

FLAGSHIP = "torsion_stats"
QUERIES: dict = {**shape.QUERIES, **bonds.QUERIES, **text.QUERIES, **records.QUERIES, **sources.QUERIES, **metadata.QUERIES, **entries.QUERIES, **holdings.QUERIES, **exports.QUERIES}
ORACLE_SQL: dict = {**shape.SQL, **bonds.SQL, **text.SQL, **records.SQL, **sources.SQL, **metadata.SQL, **entries.SQL, **holdings.SQL, **exports.SQL}
