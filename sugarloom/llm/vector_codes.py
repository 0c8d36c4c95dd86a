"""Vector code compression: codebooks a part position, trained by Lloyd rounds on resident members.

A vector's parts live with the codebook entry that they belong to: rows are dealt by (position, entry, salt) once. In each
round the tasks that hold an entry's parts sum them where they lie, only these sums meet, and with the new codebook each
part is assigned again in place. Parts that keep their entry stay in the files they are in; those that change it, and no
others, go through the next shuffle to the tasks of their new entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sugarloom.llm.common import drop_stage, sliced, staged, table

#: Components count as at most so much, so that squares and sums fit 64 bits.
LIMIT = 1 << 27
#: Distances that one step of an assignment holds; rows of a hot entry that one salt holds; labels that are broadcast.
DISTANCES, SALT_ROWS, FEW_LABELS = 1 << 20, 100_000, 100_000


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) to (row, vec_id, label, ints): rows of a whole, finite vector, its components as
    floor(256 * x), written once so that row numbers hold."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(e.cast("array<double>"), lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * 256))).cast("int"))
    rows = vectors.select("vec_id", "label", "embedding").where(e.isNotNull() & ~bad)
    return staged(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", ints.alias("ints")), "vectors")


def seeds(rows: DataFrame, parts: int, entries: int) -> list[list[int]]:
    """The vectors of the `entries` smallest vec_ids, null last; of rows of one id the least vector. Each pass brings
    `entries` rows to the driver, and more than one is needed only if ids repeat."""
    found: list[list[int]] = []
    rest = rows.where((F.size("ints") > 0) & (F.size("ints") % parts == 0)).select("vec_id", "ints")
    part = rest.where("vec_id IS NOT NULL")
    while len(found) < entries:
        some = part.orderBy("vec_id", "ints").limit(entries).collect()
        last = None
        for x in some:
            if x.vec_id != last and len(found) < entries and len(x.ints) == len(found[0] if found else x.ints):
                found.append(x.ints)
            last = x.vec_id
        if len(some) < entries:
            break
        part = rest.where(F.col("vec_id") > F.lit(last))
    if len(found) < entries:
        found += [x.ints for x in rest.where("vec_id IS NULL").orderBy("ints").limit(1).collect() if not found or len(x.ints) == len(found[0])]
    return found


def nearest(part: np.ndarray, position: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each part the nearest entry of its position's codebook (ties: the lower one) and the squared distance."""
    entry, error = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    step = max(1, DISTANCES // (books.shape[1] * books.shape[2]))
    for p in np.unique(position):
        own = np.flatnonzero(position == p)
        for at in range(0, len(own), step):
            i = own[at : at + step]
            apart = ((part[i][:, None, :] - books[p][None]) ** 2).sum(2)
            entry[i] = apart.argmin(1)
            error[i] = apart[np.arange(len(i)), entry[i]]
    return entry, error


_PARTS = "row long, position int, salt int, entry int, part array<int>"
_ASSIGNED = f"{_PARTS}, moved boolean, error long"


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(values.reshape(-1).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def _ints(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width).astype(np.int64)


def cut(rows: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """Vectors to their parts, each with its nearest entry."""
    parts, width = books.shape[0], books.shape[2]

    def run(batches):
        for batch in sliced(batches, 4096, 4 << 20):
            part = _ints(batch.column("ints"), width)
            row = np.repeat(batch.column("row").to_numpy(), parts)
            position = np.tile(np.arange(parts), batch.num_rows)
            entry = nearest(part, position, books)[0]
            columns = [row, position.astype(np.int32), (row % salts).astype(np.int32), entry.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), _lists(part)], ["row", "position", "salt", "entry", "part"])

    return rows.select("row", "ints").mapInArrow(run, _PARTS)


def reassign(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members where they are, each with its entry in these codebooks, whether that is another one, and its error."""
    width = books.shape[2]

    def run(batches):
        for batch in sliced(batches, 1 << 15, 4 << 20):
            entry, error = nearest(_ints(batch.column("part"), width), batch.column("position").to_numpy(), books)
            moved = entry != batch.column("entry").to_numpy()
            columns = [batch.column("row"), batch.column("position"), batch.column("salt"), pa.array(entry.astype(np.int32)), batch.column("part"), pa.array(moved), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _ASSIGNED.split(", ")])

    return members.mapInArrow(run, _ASSIGNED)


def updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks of the floors of the members' means; entries without members stay. A task sums its residents to a row
    an entry that it holds; a row an entry in all comes to the driver."""
    entries, width = books.shape[1:]

    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            key = batch.column("position").to_numpy().astype(np.int64) * entries + batch.column("entry").to_numpy()
            order = np.argsort(key, kind="stable")
            part = _ints(batch.column("part"), width)[order]
            keys, first, n = np.unique(key[order], return_index=True, return_counts=True)
            for k, s, m in zip(keys.tolist(), np.add.reduceat(part, first, axis=0) if len(first) else [], n.tolist(), strict=True):
                have = sums.setdefault(k, [0, np.zeros(width, np.int64)])
                have[0] += m
                have[1] += s
        yield pa.RecordBatch.from_pydict({"key": pa.array(list(sums), pa.int64()), "n": pa.array([x[0] for x in sums.values()], pa.int64()), "sums": pa.array([x[1].tolist() for x in sums.values()], pa.list_(pa.int64()))})

    partial = members.select("position", "entry", "part").mapInArrow(run, "key long, n long, sums array<long>")
    total = partial.groupBy("key").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
    books = books.copy()
    for x in total.collect():
        books[x.key // entries, x.key % entries] = [s // x.n for s in x.sums]
    return books


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """(vec_id, embedding, label, ...) to (vec_id, label, code, error, label_error, codebooks_sha256).

    Vectors that are null or hold null or non-finite components are dropped, as are those whose length is not that of the
    smallest vec_id's vector or no multiple of `parts`. Components beyond 2**27 / 256 count as that. The first codebooks
    are the parts of the smallest distinct vec_ids, null as the last id, of rows of one id the least vector; fewer ids give
    fewer entries. Null and repeated ids, and repeated rows, give a row each; null labels are one label. No vectors give no
    rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = kept_vectors(vectors)
    first = seeds(rows, parts, entries)
    kinds = {f.name: f.dataType for f in vectors.schema}
    if not first:
        fields = [("vec_id", kinds["vec_id"]), ("label", kinds["label"]), ("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType())]
        return spark.createDataFrame([], T.StructType([T.StructField(*x) for x in fields]))
    width = len(first[0]) // parts
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    rows_of = rows.where(F.size("ints") == len(first[0]))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-rows_of.count() // SALT_ROWS), -(-tasks // parts))
    owners = ["position", "entry", "salt"]
    members = staged(cut(rows_of, books, salts).repartition(*owners), "members")
    stages = [members]
    for _ in range(rounds - 1):
        books = updated(members, books)
        now = staged(reassign(members, books), "assigned")
        moved = staged(now.where("moved").select(*members.columns).repartition(*owners), "moved")
        for x in stages:
            drop_stage(x)
        stages = [now, moved]
        members = now.where("NOT moved").select(*members.columns).union(moved)
    if rounds:
        books = updated(members, books)
    last = reassign(members, books)
    code = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: F.lpad(F.lower(F.hex(x["entry"])), 2, "0")), "")
    coded = last.groupBy("row").agg(code.alias("code"), F.sum("error").alias("error"))
    result = staged(rows_of.select("row", "vec_id", "label").join(coded, "row"), "codes")
    for x in (*stages, rows):
        drop_stage(x)
    labels = result.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    if labels.count() <= FEW_LABELS:
        labels = F.broadcast(labels)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return result.join(labels, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def _assigned_sql(books: str) -> str:
    """Of each part the entry and the error, from tables x(rid, pos, j, v) and books(pos, entry, j, y)."""
    return f"""(SELECT rid, pos, arg_min(entry, (d, entry)) AS entry, min(d) AS error FROM (
    SELECT rid, pos, entry, sum((v - y) * (v - y))::BIGINT AS d FROM x JOIN {books} USING (pos, j) GROUP BY ALL) GROUP BY ALL)"""


def _updated_sql(books: str) -> str:
    return f"""(SELECT pos, entry, j, coalesce(m, y) AS y FROM {books} LEFT JOIN (
    SELECT pos, entry, j, floor(sum(v)::DOUBLE / count(*))::BIGINT AS m FROM x JOIN {_assigned_sql(books)} USING (rid, pos) GROUP BY ALL) USING (pos, entry, j))"""


OP12_SQL = f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * 256)::BIGINT) AS ints
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
lead AS (SELECT len(ints) AS n FROM whole WHERE len(ints) > 0 AND len(ints) % 16 = 0 ORDER BY vec_id NULLS LAST, ints LIMIT 1),
kept AS MATERIALIZED (SELECT whole.* FROM whole, lead WHERE len(ints) = n),
x AS MATERIALIZED (
  SELECT rid, (i - 1) // (len(ints) // 16) AS pos, (i - 1) % (len(ints) // 16) AS j, ints[i] AS v FROM (SELECT rid, ints, unnest(range(1, len(ints) + 1)) AS i FROM kept)),
first AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS entry, rid FROM (
    SELECT vec_id, rid FROM kept QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ints) = 1) ORDER BY vec_id NULLS LAST LIMIT 64),
b0 AS MATERIALIZED (SELECT pos, entry, j, v AS y FROM x JOIN first USING (rid)),
b1 AS MATERIALIZED {_updated_sql("b0")},
b2 AS MATERIALIZED {_updated_sql("b1")},
codes AS (SELECT rid, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY pos) AS code, sum(error)::BIGINT AS error FROM {_assigned_sql("b2")} GROUP BY rid),
digest AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY pos, entry, j)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (rid), digest
"""
