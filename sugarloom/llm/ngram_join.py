"""N-gram Jaccard join of documents by prefix tree.

Documents with one shingle set are one class. Shingles are put in one global order, by frequency rank
and then by hash, so that a set's prefix holds its rarest members: two sets that are alike enough share
one of them. The classes that share a prefix member form a group, and the groups' sets meet in tries
(setjoin.SetTrie), which give the links; components of the links are the result.

Frequencies come from a sketch of fixed size over all documents. It only sets the order, which may be
any; too small a sketch costs time, never a link.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import drop_stage, ngram_hashes, release, sliced, staged, table, texts, words_of
from sugarloom.llm.components import connected_components
from sugarloom.llm.setjoin import group_links, heads_of, pack, prefix_length

SKETCH_BITS, SLICE_BITS, BLOOM_BITS = 24, 17, 24
#: Tasks that each merge a part of what is counted into one slice of the sketch, or of a filter.
MERGERS = 16
#: Bits of a sort key that hold the frequency rank.
RANK_BITS = 6
#: Hundredths of a set that its prefix is longer, so that chance hits on few tokens fall out.
MORE = 4


def shingles(text: str | None, k: int) -> np.ndarray:
    """The distinct k-word shingles as ascending hashes; of a shorter text, its words as one."""
    return np.unique(ngram_hashes(words_of(text), k))


def class_id(hashes: np.ndarray) -> int:
    """A signed 64-bit id of a set; two of n sets share one with a chance of n * n / 2**65."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def ranked(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles as sort keys of the global order, ascending: frequency rank in the top bits, then hash."""
    of = ranks[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((of << np.uint64(64 - RANK_BITS)) | (hashes >> np.uint64(RANK_BITS)))


def _scan(k: int):
    """Of each task: (doc_id, class, n) of its documents, then slices of its shingle counts."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        known: set[int] = set()
        for batch in batches:
            ids, classes, sizes = [], [], []
            kind = batch.column("doc_id").type
            for doc_id, text in texts([batch], "doc_id", "text"):
                h = shingles(text, k)
                c = class_id(h) if len(h) else None
                ids.append(doc_id)
                classes.append(c)
                sizes.append(len(h))
                if c is not None and c not in known:
                    if len(known) < 1_000_000:
                        known.add(c)
                    # no shingle occurs twice in h, but two may share a counter
                    np.add.at(counts, (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            n = len(ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["doc_id", "cls", "n", "slice", "counts"])
        packer = zstandard.ZstdCompressor(level=1)
        for at in range(1 << (SKETCH_BITS - SLICE_BITS)):
            part = counts[at << SLICE_BITS : (at + 1) << SLICE_BITS]
            if part.any():
                raw = packer.compress(part.tobytes())
                yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(1, kind), "cls": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()), "slice": pa.array([at], pa.int32()), "counts": pa.array([raw], pa.binary())})

    return run


def _sum_slices(batches):
    """Adds up the slices of a task, one at a time; the rows come sorted by slice."""
    unpack, packer, now, total = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), None, None
    out = lambda: pa.RecordBatch.from_pydict({"slice": pa.array([now], pa.int32()), "counts": pa.array([packer.compress(total.astype(np.uint32).tobytes())], pa.binary())})
    for at, raw in texts(batches, "slice", "counts"):
        if at != now:
            if now is not None:
                yield out()
            now, total = at, np.zeros(1 << SLICE_BITS, np.uint64)
        total += np.frombuffer(unpack.decompress(raw), np.uint32)
    if now is not None:
        yield out()


def frequency_ranks(slices: DataFrame) -> np.ndarray:
    """Of each counter its frequency rank: sixteen steps a mean up to three means, then one for each doubling.

    What comes to the driver is the sketch, whose size is fixed.
    """
    unpack = zstandard.ZstdDecompressor()
    # first some tasks a slice, so that no task merges what all others have counted
    parts = slices.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(MERGERS))).repartition("slice", "salt").sortWithinPartitions("slice")
    halves = parts.select("slice", "counts").mapInArrow(_sum_slices, "slice int, counts binary")
    summed = halves.repartition("slice").sortWithinPartitions("slice").mapInArrow(_sum_slices, "slice int, counts binary")
    packed = {r["slice"]: bytes(r["counts"]) for r in summed.toLocalIterator()}
    read = lambda raw: np.frombuffer(unpack.decompress(raw), np.uint32)
    mean = max(1.0, sum(int(read(x).sum(dtype=np.uint64)) for x in packed.values()) / (1 << SKETCH_BITS))
    ranks = np.zeros(1 << SKETCH_BITS, np.uint8)
    for at, raw in packed.items():  # a slice at a time, so the driver holds one byte a counter
        counts = read(raw).astype(np.float64)
        coarse = 48 + np.log2(np.maximum(1, counts / (3 * mean)))
        ranks[at << SLICE_BITS : (at + 1) << SLICE_BITS] = np.minimum(63, np.where(counts > 3 * mean, coarse, np.minimum(47, counts * (16 / mean))))
    return ranks


def _bloom_hits(ids: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each id in a filter of packed flags, whose size is a power of two."""
    bits = len(flags).bit_length() + 2
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - bits)).astype(np.int64), ((x >> np.uint64(8)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def id_filter(ids: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of 2**bits flags over a column `doc_id`, built where the rows are and merged by slices: the driver
    gets each slice once, however many tasks there are."""
    slice_bytes = 1 << (SLICE_BITS - 3)

    def rows(flags: dict[int, np.ndarray]):
        packer = zstandard.ZstdCompressor(level=1)
        for at, part in flags.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "flags": pa.array([packer.compress(part.tobytes())], pa.binary())})

    def build(batches):
        flags, size = np.zeros(1 << bits, bool), np.empty(1 << (bits - 3), np.uint8)
        for batch in batches:
            for at in _bloom_hits(batch.column("doc_id").to_numpy(), size):
                flags[at] = True
        packed = np.packbits(flags).reshape(-1, slice_bytes)
        yield from rows({at: part for at, part in enumerate(packed) if part.any()})

    def merge(batches):
        flags: dict[int, np.ndarray] = {}
        for at, raw in texts(batches, "slice", "flags"):
            part = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
            flags[at] = flags[at] | part if at in flags else part
        yield from rows(flags)

    kind = "slice int, flags binary"
    parts = ids.select("doc_id").mapInArrow(build, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(MERGERS))).repartition("slice", "salt")
    merged = parts.select("slice", "flags").mapInArrow(merge, kind).repartition("slice").mapInArrow(merge, kind)
    total = np.zeros((1 << (bits - SLICE_BITS), slice_bytes), np.uint8)
    for r in merged.toLocalIterator():
        total[r["slice"]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["flags"])), np.uint8)
    return total.reshape(-1)


def _named(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, cls, n) of each row, cls null without words, and (cls, doc_id, n_copies, component) of each class: its
    smallest doc_id and the class that its component goes by, null if it has no links."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    scanned = staged(docs.mapInArrow(_scan(k), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, cls long, n long, slice int, counts binary"), "shingles")
    rows = scanned.where("slice is null").select("doc_id", "cls", "n")
    ranks = spark.sparkContext.broadcast(frequency_ranks(scanned.where("slice is not null").select("slice", "counts")))
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))

    def prefixes(batches):
        known: set[int] = set()
        for batch in sliced(batches):
            tokens, owners, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                h = shingles(text, k)
                if not len(h):
                    continue
                c = class_id(h)
                if c in known:
                    continue
                if len(known) < 1_000_000:
                    known.add(c)
                n = len(h)
                tokens.append(ranked(h, ranks.value)[: prefix_length(n, num, den, MORE)].view(np.int64))
                owners.append(np.full(len(tokens[-1]), c, np.int64))
                sizes.append(np.full(len(tokens[-1]), n, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, owners, sizes)], names=["token", "cls", "n"])

    groups = heads_of(docs.select("text").mapInArrow(prefixes, "token long, cls long, n int"), num, den, MORE)
    release(spark)
    members = groups.select("member").distinct()
    bloom = spark.sparkContext.broadcast(id_filter(members.select(F.col("member").alias("doc_id"))))

    def packed(batches):
        done: set[int] = set()
        for batch in sliced(batches):
            ids, sets = [], []
            for text in batch.column("text").to_pylist():
                h = shingles(text, k)
                if not len(h):
                    continue
                c = class_id(h)
                if c in done or not all(bloom.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 for (at,) in _bloom_hits(np.array([c]), bloom.value)):
                    continue
                if len(done) < 1_000_000:
                    done.add(c)
                ids.append(c)
                sets.append(pack(ranked(h, ranks.value)))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["member", "members"])

    # a row of each class, whatever ids its documents have
    sets = staged(docs.select("text").mapInArrow(packed, "member long, members binary").join(members, "member", "left_semi").dropDuplicates(["member"]), "sets")
    parts = connected_components(group_links(groups, sets, num, den))
    for done in (groups, sets):
        drop_stage(done)
    return rows, classes.join(parts.select(F.col("node").alias("cls"), "component"), "cls", "left")


def per_group(rows: DataFrame, key: str, of: str, *sums: Column) -> DataFrame:
    """rows with sums over the rows of their key. The sums are combined in each task, and a key's rows are dealt over
    MERGERS tasks by the column `of`, as one key can hold much of the corpus."""
    totals = rows.groupBy(key).agg(*sums).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(MERGERS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(of), F.lit(MERGERS)).cast("int")).join(totals, [key, "salt"]).drop("salt")


def with_least(named: DataFrame) -> DataFrame:
    """named(cls, doc_id, n_copies, component or null) with `least`, the smallest doc_id of the class's component; a class
    of no component is its own."""
    linked = per_group(named.where("component is not null"), "component", "cls", F.min("doc_id").alias("least"))
    alone = named.where("component is null").withColumn("component", F.col("cls")).withColumn("least", F.col("doc_id"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, n_shingles, component_id, n_copies).

    Two documents link if the Jaccard of their sets of k-word shingles is num/den or more; component_id
    is the smallest doc_id reachable. A document without words is linked with nothing and has
    component_id doc_id and n_copies 1; n_copies counts the rows with the document's own set. Repeated
    rows are kept; a null doc_id counts as larger than any other, links as all do, and a component of rows
    without doc_id has a null component_id. doc_id may be of any orderable type. An empty table gives no rows.
    """
    rows, named = _named(docs, k, num, den)
    of_class = with_least(named).select("cls", F.col("least").alias("component_id"), "n_copies")
    out = rows.join(of_class, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def first_of_components(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """docs(doc_id, text, ...): of each component of near duplicates one row, the first by doc_id (nulls last) and then
    text. Rows of one id but unlike texts are documents of their own. Of texts without words, which are linked with
    nothing, each stays, rows of the same doc_id and text once."""
    _, named = _named(docs, k, num, den)

    def classed(batches):
        for batch in sliced(batches):
            sets = (shingles(t, k) for t in batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([class_id(h) if len(h) else None for h in sets], pa.int64())], names=[*batch.schema.names, "cls"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    rows = docs.mapInArrow(classed, f"{schema}, cls long")
    # a component's first class is one that holds its smallest id, so only rows of that id can be its first
    of_class = with_least(named).where(F.col("doc_id").eqNullSafe(F.col("least"))).select("cls", "component", "least")
    near = rows.join(of_class, "cls").where(F.col("doc_id").eqNullSafe(F.col("least")))
    order = F.struct("text", *(c for c in docs.columns if c != "text"))
    # min is combined in each task before the rows are dealt
    first = near.groupBy("component").agg(F.min(order).alias("row")).select(*(F.col("row")[c].alias(c) for c in docs.columns))
    empty = rows.where("cls is null").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return first.unionByName(empty)


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
