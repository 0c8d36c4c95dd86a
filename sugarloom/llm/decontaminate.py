"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a document with at most e errors, split into e + 1 pieces, has one piece
there without error. So the pieces are looked for exactly, all at once, and around each hit the item is
matched with Myers' bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import sliced, table, words_of

#: First bytes of a piece that are looked up at each place of a text; all of a shorter piece.
GRAM = 8
#: Text of items held in memory at a time; a larger benchmark goes in blocks of this size.
BLOCK_BYTES = 32 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22


def normalised(text: str | None) -> bytes:
    """Lower-cased, words parted by one space."""
    return b" ".join(words_of(text.lower(), lower=False)) if text else b""


def errors_allowed(length: int, rate: float) -> int:
    """rate times the length, less than one error a byte."""
    return max(0, min(int(rate * length), length - 1))


def pieces_of(item: bytes, errors: int) -> list[tuple[int, bytes]]:
    """(offset, piece) of errors + 1 pieces whose lengths differ by one at most."""
    edges = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def myers(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(distance, end) of the best match of the whole pattern inside text; the first end of the best."""
    m = len(pattern)
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full  # a match may begin anywhere
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def best_match(item: bytes, window: bytes) -> tuple[int, int, int]:
    """(distance, start, end) of the best match of item in window."""
    distance, end = myers(item, window)
    _, back = myers(item[::-1], window[:end][::-1])
    return distance, end - back, end


def _grams(raw: bytes) -> np.ndarray:
    """The GRAM bytes from each place on as one number, zeros after the end."""
    return np.ndarray((len(raw),), "<u8", raw + b"\0" * GRAM, strides=(1,)) if raw else np.empty(0, np.uint64)


def _in_word(byte: int) -> bool:
    return byte >= 128 or chr(byte).isalnum()


def stands_alone(raw: bytes, start: int, end: int) -> bool:
    """Whether raw[start:end] begins and ends at the edge of a word."""
    left = start == 0 or not (_in_word(raw[start - 1]) and _in_word(raw[start]))
    return left and (end == len(raw) or not (_in_word(raw[end - 1]) and _in_word(raw[end])))


class ItemIndex:
    """The pieces of a block of items by their first bytes, a table for each number of bytes up to GRAM."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        self.items: list[tuple[object, bytes, int]] = []
        self.tables: dict[int, dict[int, list[tuple[int, int, bytes]]]] = {}
        for item_id, text in items:
            raw = normalised(text)
            if not raw:
                continue
            errors = errors_allowed(len(raw), rate)
            at = len(self.items)
            self.items.append((item_id, raw, errors))
            for offset, p in pieces_of(raw, errors):
                table_ = self.tables.setdefault(min(GRAM, len(p)), {})
                table_.setdefault(int.from_bytes(p[:GRAM], "little"), []).append((at, offset, p))
        self.flags: dict[int, np.ndarray] = {}
        for size, table_ in self.tables.items():
            flags = self.flags[size] = np.zeros(1 << _TABLE_BITS, bool)
            flags[np.array(sorted(table_), np.uint64) * _MIX >> np.uint64(64 - _TABLE_BITS)] = True

    def _hits(self, raw: bytes):
        """(place in raw, item, offset in the item, piece) of the pieces that stand in raw."""
        grams = _grams(raw)
        for size, table_ in self.tables.items():
            own = grams & np.uint64((1 << 8 * size) - 1)
            for at in np.flatnonzero(self.flags[size][own * _MIX >> np.uint64(64 - _TABLE_BITS)]).tolist():
                for k, offset, piece in table_.get(int(own[at]), ()):
                    if raw[at : at + len(piece)] == piece:
                        yield at, k, offset

    def matches(self, text: str | None) -> list[tuple[object, int, int, int, int]]:
        """(item_id, distance, errors allowed, start, end) of the best match of each item within its errors."""
        raw = normalised(text)
        found: dict[int, tuple[int, int, int]] = {}
        looked: dict[int, list[tuple[int, int]]] = {}
        for at, k, offset in self._hits(raw):
            _, item, errors = self.items[k]
            start, end = at - offset, at - offset + len(item)
            if start >= 0 and raw[start:end] == item:
                if (errors or stands_alone(raw, start, end)) and (k not in found or (0, start) < found[k][:2]):
                    found[k] = (0, start, end)
                continue
            if not errors or k in found and found[k][0] == 0:
                continue
            lo, hi = max(0, start - errors), min(len(raw), end + errors)
            if any(a <= lo and hi <= b for a, b in looked.get(k, ())):
                continue
            looked.setdefault(k, []).append((lo, hi))
            distance, a, b = best_match(item, raw[lo:hi])
            if distance <= errors and (k not in found or (distance, lo + a) < found[k][:2]):
                found[k] = (distance, lo + a, lo + b)
        out = [(self.items[k][0], d, self.items[k][2], a, b) for k, (d, a, b) in found.items()]
        return sorted(out, key=lambda x: (x[3], str(x[0])))


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of bounded size, one at a time; the usual benchmark is one block."""
    items = benchmark.where("text is not null").select("item_id", "text").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_BYTES) or 1
    for i in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield sorted(((r["item_id"], r["text"]) for r in own.collect()), key=lambda x: (str(x[0]), x[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08) -> DataFrame:
    """docs(doc_id, text, ...), benchmark(item_id, text) to (doc_id, item_id, distance, errors, start, end, n_bytes).

    One row for each document and item that occurs in it with at most `rate` errors a byte of the item,
    both lower-cased and with words parted by one space; start and end are bytes of the document so
    written, n_bytes its length. The whole text is searched. Of equally good matches the first counts. An item
    too short for an error (under 1/rate bytes) must begin and end at the edge of a word. Null and empty
    texts and items match nothing, a null doc_id or item_id stays null; repeated documents match each;
    either table may be empty; other columns, whatever their names, are not read. The benchmark, a
    stated query set, is held against all documents in blocks of at most BLOCK_BYTES, a pass each.
    """
    spark = docs.sparkSession
    kinds = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "item_id": benchmark.schema["item_id"].dataType.simpleString()}
    out = None
    for block in _item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = ItemIndex(shared.value, rate)
            for batch in sliced(batches):
                ids, rows = batch.column("doc_id"), []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    hits = index.matches(text)
                    if hits:
                        n = len(normalised(text))
                        rows += [(i, *h, n) for h in hits]
                if rows:
                    at, items, *rest = zip(*rows, strict=True)
                    kind = pa.string() if kinds["item_id"] == "string" else pa.int64() if kinds["item_id"] == "bigint" else pa.int32()
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(items, kind), *(pa.array(x, pa.int64()) for x in rest)], names=["doc_id", "item_id", "distance", "errors", "start", "end", "n_bytes"])

        found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, distance long, errors long, start long, end long, n_bytes long")
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08) -> DataFrame:
    """The rows of docs(text, ...) that hold no item, with all their columns.

    Each row is judged by its own text, so rows of a null or repeated doc_id stay or go by themselves. Null
    and empty texts stay; either table may be empty. Nothing is shuffled.
    """
    spark = docs.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    for block in _item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = ItemIndex(shared.value, rate)
            for batch in sliced(batches):
                yield batch.filter(pa.array([not index.matches(t) for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
