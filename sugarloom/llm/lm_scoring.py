"""Language-model scoring with an Elias-Fano n-gram trie.

Level 1 holds the words: their 64-bit hashes, ascending, and their counts; a word's id is its place.
Level k holds the k-grams under their context, the (k-1)-gram they extend, by the context's place. A
child is stored by its rank among the words seen after the context's own last words one level below
(context-relative), which keeps the numbers small, and a level is one ascending sequence of
context * width + child in Elias-Fano code, with monotone pointers to where each context's children
begin. Beside it lie the quantised probability of each k-gram and the weight each context leaves to the
level below. A level is cut by ranges of contexts into segments of a bounded number of tokens; each is built
by one task, written to the folder that all executors share, and mapped into memory where texts are
scored, so a task's memory grows neither with the model nor with the corpus. What is counted in a
context that alone has more tokens than a segment is merged by several tasks first.

Texts are tokenised twice: for the counts of words, and to write each text's word ids once, which all
later passes read.

score interpolates absolutely discounted counts: p_k(w | c) = (n(cw) - d) / n(c) + d * t(c) / n(c) *
p_{k-1}(w | c'), with t(c) the number of different words after c, down to add-one counts of words.
"""

from __future__ import annotations

import json
import mmap
import os
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.llm.common import new_path, ngram_hashes, py_part, release, staged, table, texts, words_of
from sugarloom.llm.elias_fano import EliasFano, build

#: The token that ends every text: no word, as it holds a blank.
END = b"</s> "
#: Tokens gathered before their n-grams are counted and looked up, so a task's memory is bounded.
CHUNK = 1 << 19
#: Tokens of a segment, so contexts of it at most; a context with more has one alone.
SEGMENT = 1 << 22
#: Bits of a packed n-gram for the child; the rest are for the context's place in its segment.
CHILD_BITS = 41
#: Probabilities are kept as -log10 in steps of 1/STEP; NONE marks a context without children.
STEP, NONE = 4096, 65535
_UP, _DOWN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


# -- counts on their way ----------------------------------------------------------------------------


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as differences, and counts, in compressed byte planes."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T for x in (gaps, counts.astype(np.uint64))]
    return _UP.compress(np.ascontiguousarray(np.vstack(planes)).tobytes())


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(_DOWN.decompress(raw), np.uint8).reshape(16, -1)
    gaps, counts = (np.ascontiguousarray(x.T).view("<u8").ravel() for x in (planes[:8], planes[8:]))
    return np.cumsum(gaps, dtype=np.uint64), counts


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending keys and the sums of their counts."""
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts, starts)


def _cut(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, blob) of ascending keys whose bucket ascends with them."""
    if not len(keys):
        return
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    rows = [(int(bucket[a]), _pack(keys[a:b], counts[a:b])) for a, b in zip(edges, np.append(edges[1:], len(keys)), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])


def _chunks(batches, keep: Callable[[object], bool] | None = None) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Some documents at a time: their ids, the hashes of their tokens and each one's first token."""
    ids, parts, starts, n = [], [], [], 0
    for doc_id, text in texts(batches, "doc_id", "text"):
        if keep and not keep(doc_id):
            continue
        words = words_of(text)
        ids.append(doc_id)
        starts.append(n)
        parts.append(np.append(ngram_hashes(words, 1), END_HASH))
        n += len(words) + 1
        if n >= CHUNK:
            yield ids, np.concatenate(parts), np.array(starts)
            ids, parts, starts, n = [], [], [], 0
    if ids:
        yield ids, np.concatenate(parts), np.array(starts)


END_HASH = ngram_hashes([END.strip() + b"\x00end"], 1)[0]


# -- segments ---------------------------------------------------------------------------------------


def _posix(path: str) -> str:
    """The shared folder as a path of the file system; segments are mapped, so it must be mounted."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"the trie is memory-mapped: spark.checkpoint.dir must be a folder mounted on all executors, not {path}")
    return path


def _write(folder: str, level: int, bucket: int, arrays: dict[str, np.ndarray]) -> tuple[str, str]:
    """One file of all arrays under a name of its own, so that a repeated task does no harm; its layout as JSON."""
    os.makedirs(folder, exist_ok=True)
    path, layout, at = f"{folder}/{level}-{bucket}-{uuid.uuid4().hex}.seg", {}, 0
    with open(path + ".part", "wb") as f:
        for name, x in arrays.items():
            f.write(b"\0" * (-at % 64))
            at += -at % 64
            layout[name] = (at, str(x.dtype), len(x))
            f.write(x.tobytes())
            at += x.nbytes
    os.rename(path + ".part", path)
    return path, json.dumps(layout)


_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}
#: Segments of a level that a process keeps mapped: those used last, fewer where each holds a handle.
MAPPED = 1024 if _UNTRACKED else 64


class Segment:
    """Contexts lo to hi of a level: the code of their children, pointers, probabilities and weights."""

    def __init__(self, row: dict):
        self.lo, self.hi, self.first, self.n, self.width = row["lo"], row["hi"], row["first"], row["n"], max(1, row["width"])
        with open(row["path"], "rb") as f:  # the map itself holds no handle where Python can do without
            raw = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED), np.uint8)
        get = {k: raw[a : a + np.dtype(d).itemsize * n].view(d) for k, (a, d, n) in json.loads(row["layout"]).items()}
        part = lambda p: {k: get[p + k] for k in ("meta", "low", "upper", "ones")}
        self.keys = EliasFano(part("k_"))
        self.starts = EliasFano(part("s_")) if "s_meta" in get else None
        self.values, self.weights, self.counts = get.get("values"), get.get("weights"), get.get("counts")


class Level:
    """All segments of a level in context order, mapped when they are first asked for; MAPPED of them stay mapped."""

    def __init__(self, rows: list[dict]):
        self.rows = sorted(rows, key=lambda r: r["lo"])
        self.los = np.array([r["lo"] for r in self.rows], np.uint64)
        self.firsts = np.array([r["first"] for r in self.rows], np.int64)
        self.mapped: dict[int, Segment] = {}

    def segment(self, i: int) -> Segment:
        found = self.mapped.pop(i, None) or Segment(self.rows[i])
        self.mapped[i] = found  # the last one used is the last in the dictionary
        if len(self.mapped) > MAPPED:
            del self.mapped[next(iter(self.mapped))]
        return found

    def _routed(self, context: np.ndarray) -> Iterator[tuple[Segment, np.ndarray]]:
        """Of ascending contexts the run that each segment has; contexts without children can be in none."""
        if not len(context):
            return
        which = np.searchsorted(self.los, context, "right").astype(np.int64) - 1
        edges = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(which)), strict=True):
            if which[a] >= 0:
                own = self.segment(int(which[a]))
                yield own, slice(a, a + int(np.searchsorted(context[a:b], np.uint64(own.hi))))

    def find(self, context: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Places of (context, child) pairs in ascending order; -1 for unseen ones."""
        out = np.full(len(context), -1, np.int64)
        for s, at in self._routed(context):
            own, rel = context[at] - np.uint64(s.lo), child[at]
            known = rel < s.width
            place, same = s.keys.successor(own[known] * np.uint64(s.width) + rel[known].astype(np.uint64))
            found = np.full(len(own), -1, np.int64)
            found[known] = np.where(same, place + s.first, -1)
            out[at] = found
        return out

    def begin(self, context: np.ndarray) -> np.ndarray:
        """The place of the first child of each context, in ascending order."""
        out = np.zeros(len(context), np.int64)
        for s, at in self._routed(context):
            out[at] = s.starts.access((context[at] - np.uint64(s.lo)).astype(np.int64)).astype(np.int64) + s.first
        return out

    def weight(self, context: np.ndarray) -> np.ndarray:
        """What each context leaves to the level below; 1 for one without children."""
        out = np.ones(len(context))
        for s, at in self._routed(context):
            q = s.weights[(context[at] - np.uint64(s.lo)).astype(np.int64)]
            out[at] = np.where(q == NONE, 1.0, 10.0 ** (-q.astype(float) / STEP))
        return out

    def value(self, place: np.ndarray, name: str) -> np.ndarray:
        """The stored array `name` at ascending places."""
        out = np.zeros(len(place), np.int64)
        if not len(place):
            return out
        which = np.searchsorted(self.firsts, place, "right") - 1
        edges = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(which)), strict=True):
            s = self.segment(int(which[a]))
            out[a:b] = getattr(s, name)[place[a:b] - s.first]
        return out


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending values and where each element's is."""
    n = len(x)
    bits = int(x.max(initial=0)).bit_length()
    if bits + n.bit_length() <= 64:  # value and place in one number: sorting is quicker than finding an order
        both = np.sort(x.astype(np.uint64) << np.uint64(n.bit_length()) | np.arange(n, dtype=np.uint64))
        order = (both & np.uint64((1 << n.bit_length()) - 1)).astype(np.int64)
    else:
        order = np.argsort(x)
    ordered = x[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if n else np.empty(0, bool)
    at = np.empty(n, np.int64)
    at[order] = np.cumsum(new) - 1
    return ordered[new], at


class Grams:
    """The distinct k-grams of a chunk: their places, ascending by context; of each token which one ends there (-1: none);
    their contexts and their child numbers there."""

    def __init__(self, place: np.ndarray, at: np.ndarray, rank: np.ndarray):
        self.place, self.at, self.rank = place, at, rank


class Trie:
    """The levels so far, mapped from their manifests."""

    def __init__(self, manifests: list[list[dict]], total: int):
        self.total = total
        self.words = Level(manifests[0])
        self.levels = [Level(m) for m in manifests[1:]]
        self.vocabulary = sum(r["n"] for r in manifests[0])

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of tokens, -1 for unknown ones."""
        own, at = _distinct(hashes)
        # the words are one level whose contexts are the upper 32 bits of a hash
        return self.words.find(own >> np.uint64(32), (own & np.uint64(0xFFFFFFFF)).astype(np.int64))[at]

    def grams(self, ids: np.ndarray, new: np.ndarray, levels: int) -> Iterator[tuple[Grams, np.ndarray, np.ndarray, Grams | None]]:
        """For k = 2, 3, ... `levels` times: the (k-1)-grams of the tokens; of each token its context among them and its
        own last (k-1)-gram among them (-1: none); and, where the level is built, the k-grams seen, unseen
        ones with place -1. new: where texts begin.

        A child's number at level 2 is the word's id; above, the place of the (k-1)-gram without its
        first word, counted from the first child of that one's context.
        """
        known = np.flatnonzero(ids >= 0)
        own, where = _distinct(ids[known])
        at = np.full(len(ids), -1, np.int64)
        at[known] = where
        now = Grams(own, at, own)
        for k in range(levels):
            before = np.full(len(ids), -1, np.int64)
            before[1:] = now.at[:-1]
            before[new] = -1
            if k == len(self.levels):
                yield now, before, now.at, None
                return
            reach = np.flatnonzero((before >= 0) & (now.at >= 0))
            bits = np.uint64(max(1, len(now.place).bit_length()))
            pairs, where = _distinct(before[reach].astype(np.uint64) << bits | now.at[reach].astype(np.uint64))
            context, child = (pairs >> bits).astype(np.int64), (pairs & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            place = self.levels[k].find(now.place[context].astype(np.uint64), now.rank[child])
            at = np.full(len(ids), -1, np.int64)
            seen = place >= 0
            at[reach] = np.where(seen, np.cumsum(seen) - 1, -1)[where]
            place, context = place[seen], context[seen]
            contexts = now.place[context]
            edge = np.append(True, contexts[1:] != contexts[:-1]) if len(contexts) else np.empty(0, bool)
            first = self.levels[k].begin(contexts[edge].astype(np.uint64))[np.cumsum(edge) - 1] if len(contexts) else contexts
            grams = Grams(place, at, place - first)
            yield now, before, now.at, grams
            now = grams

    def log10(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: log10 probability, base log10 probability, whether it is known."""
        new = np.zeros(len(ids), bool)
        new[starts] = True
        counts, p, base = np.zeros(len(ids), np.int64), np.empty(0), np.empty(0)
        for k, (below, before, own, grams) in enumerate(self.grams(ids, new, len(self.levels) or 1)):
            if k == 0:
                known = own >= 0
                counts[known] = self.words.value(below.place, "counts")[own[known]]
                p = (counts + 1.0) / (self.total + self.vocabulary + 1)
                base = np.log10(p)
            if grams is None:
                break
            level = self.levels[k]
            some = np.flatnonzero(before >= 0)
            p[some] *= level.weight(below.place.astype(np.uint64))[before[some]]
            seen = np.flatnonzero(grams.at >= 0)
            p[seen] += (10.0 ** (-level.value(grams.place, "values") / STEP))[grams.at[seen]]
        return np.log10(p), base, counts > 0


# -- building ---------------------------------------------------------------------------------------

MANIFEST = "bucket long, path string, layout string, lo long, hi long, n long, width long, words long, cuts string"


def _manifest(spark: SparkSession, blobs: DataFrame, make: Callable[[int, np.ndarray, np.ndarray], dict], label: str, segment: int, tokens: list[int] | None = None) -> list[dict]:
    """Merge the blobs of each bucket, build and write its segment; rows of metadata come to the driver.

    tokens: how many each bucket has at most. One of several segments' size is merged by as many tasks first.
    """

    def gathered(batches):
        held: list = []
        now = None
        for bucket, blob in texts(batches, "bucket", "blob"):
            if bucket != now and now is not None:
                yield now, merged(held)
                held = []
            now = bucket
            held.append(_unpack(blob))
            if len(held) > 64:
                held = [merged(held)]
        if now is not None:
            yield now, merged(held)

    def run(batches):
        schema = pa.schema([("bucket", pa.int64()), ("path", pa.string()), ("layout", pa.string()), *((x, pa.int64()) for x in ("lo", "hi", "n", "width", "words")), ("cuts", pa.string())])
        for bucket, own in gathered(batches):
            yield pa.RecordBatch.from_pylist([make(bucket, *own)], schema)

    def halve(batches):
        for bucket, (keys, counts) in gathered(batches):
            yield from _cut(keys, counts, np.full(len(keys), bucket))

    hot = {i: n // segment for i, n in enumerate(tokens or ()) if n >= 2 * segment}
    if hot:  # so few as words with a segment's tokens
        salts = F.element_at(F.create_map(*(F.lit(x) for i, n in hot.items() for x in (i, n))), F.col("bucket").cast("int"))
        several = blobs.withColumn("salts", salts)
        halves = several.where("salts is not null").withColumn("salt", F.pmod(F.xxhash64("blob"), F.col("salts"))).repartition("bucket", "salt").sortWithinPartitions("bucket")
        blobs = several.where("salts is null").select("bucket", "blob").unionByName(halves.select("bucket", "blob").mapInArrow(halve, "bucket long, blob binary"))
    dealt = blobs.repartition("bucket").sortWithinPartitions("bucket")
    rows = [r.asDict() for r in staged(dealt.mapInArrow(run, MANIFEST), label).collect()]
    first = 0
    for r in sorted(rows, key=lambda r: r["lo"]):
        r["first"] = first
        first += r["n"]
    del dealt, blobs
    release(spark)
    return rows


def _cuts(counts: np.ndarray, segment: int) -> str:
    """Where the places of a segment are cut, as contexts of the next level, and the tokens of each part: about `segment`
    or one context."""
    turn = (np.cumsum(counts) - 1) // segment
    edges = np.flatnonzero(np.append(True, turn[1:] != turn[:-1])) if len(counts) else np.empty(0, int)
    return json.dumps([edges.tolist(), np.add.reduceat(counts, edges).astype(int).tolist() if len(edges) else []])


def _contexts(manifest: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Of a built level the places that buckets of the next begin at, and the tokens of each."""
    los, tokens = [], []
    for r in sorted(manifest, key=lambda r: r["lo"]):
        edges, sums = json.loads(r["cuts"])
        los += [r["first"] + x for x in edges]
        tokens += sums
    return np.array(los, np.int64), np.array(tokens, np.int64)


def _prefixed(prefix: str, parts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {prefix + k: v for k, v in parts.items()}


def _ids(words: np.ndarray) -> bytes:
    """Word ids in compressed byte planes, -1 as 0."""
    return _UP.compress(np.ascontiguousarray((words + 1).astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _read_ids(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_DOWN.decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel() - 1


def _coded(batches) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Of each chunk its documents, word ids and where each document begins."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("docs")[i].as_py(), _read_ids(batch.column("words")[i].as_py()), np.frombuffer(batch.column("starts")[i].as_py(), np.int64)


def train(docs: DataFrame, order: int = 3, discount: float = 0.75, parts: int = 7, held_out: int = 2, segment: int = SEGMENT) -> tuple[list[list[dict]], int, DataFrame]:
    """The manifests of levels 1 to order, the number of training tokens, and the staged chunks of word ids.

    Counts are over all documents whose crc32(doc_id as text) mod parts isn't held_out.
    """
    spark = docs.sparkSession
    folder = _posix(new_path(spark, "trie"))
    keep = lambda i: py_part(i, parts) != held_out
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(4, size // (8 * segment))

    def words(batches):
        for _, hashes, _ in _chunks(batches, keep):
            own, counts = np.unique(hashes, return_counts=True)
            yield from _cut(own, counts, ((own >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64))

    def make_words(bucket, keys, counts):
        lo, hi = -(-(bucket << 32) // buckets), -(-((bucket + 1) << 32) // buckets)
        arrays = _prefixed("k_", build(keys - np.uint64(lo << 32))) | {"counts": counts.astype(np.uint64)}
        path, layout = _write(folder, 1, bucket, arrays)
        return {"bucket": bucket, "path": path, "layout": layout, "lo": lo, "hi": hi, "n": len(keys), "width": 1 << 32, "words": int(counts.sum()), "cuts": _cuts(counts, segment)}

    manifests = [_manifest(spark, docs.mapInArrow(words, "bucket long, blob binary"), make_words, "words", segment)]
    total = sum(r["words"] for r in manifests[0])
    first = spark.sparkContext.broadcast((list(manifests), total))  # paths and sizes: a row a segment

    def coded(batches):
        trie = Trie(*first.value)
        rows = list(batches)
        for held in (False, True):
            for own, hashes, starts in _chunks(iter(rows), lambda i, held=held: keep(i) != held):
                cols = [pa.array([held]), pa.array([own], pa.list_(pa.string() if kind == "string" else pa.int64())), pa.array([starts.astype(np.int64).tobytes()]), pa.array([_ids(trie.word_ids(hashes))])]
                yield pa.RecordBatch.from_arrays(cols, names=["held", "docs", "starts", "words"])

    def coded_in_turn(batches):
        """Some batches together, so that chunks fill and memory is bounded."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > CHUNK * 16:
                yield from coded(held)
                held, size = [], 0
        yield from coded(held)

    chunks = staged(docs.mapInArrow(coded_in_turn, f"held boolean, docs array<{'string' if kind == 'string' else 'long'}>, starts binary, words binary"), "word-ids")
    for level in range(2, order + 1):
        los, tokens = _contexts(manifests[-1])
        contexts = sum(r["n"] for r in manifests[-1])
        if not contexts:
            break
        shared = spark.sparkContext.broadcast((list(manifests), total))
        begins = spark.sparkContext.broadcast(los)

        def grams(batches, shared=shared, level=level, begins=begins):
            trie, los = Trie(*shared.value), begins.value
            for _, ids, starts in _coded(batches):
                new = np.zeros(len(ids), bool)
                new[starts] = True
                *_, (below, before, own, _) = trie.grams(ids, new, level - 1)
                seen = (before >= 0) & (own >= 0)
                bits = np.uint64(max(1, len(below.place).bit_length()))
                pairs, counts = np.unique(before[seen].astype(np.uint64) << bits | own[seen].astype(np.uint64), return_counts=True)
                context, child = below.place[(pairs >> bits).astype(np.int64)], below.rank[(pairs & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)]
                bucket = np.searchsorted(los, context, "right") - 1
                keys = (context - los[bucket]).astype(np.uint64) << np.uint64(CHILD_BITS) | child.astype(np.uint64)
                if level > 2:  # ranks don't ascend with the pairs' order
                    order = np.lexsort((keys, bucket))
                    keys, counts, bucket = keys[order], counts[order], bucket[order]
                yield from _cut(keys, counts, bucket)

        def make(bucket, keys, counts, level=level, contexts=contexts, begins=begins):
            los = begins.value
            lo, hi = int(los[bucket]), int(los[bucket + 1]) if bucket + 1 < len(los) else contexts
            context = (keys >> np.uint64(CHILD_BITS)).astype(np.int64)
            child = keys & np.uint64((1 << CHILD_BITS) - 1)
            width = int(child.max(initial=0)) + 1
            kinds = np.bincount(context, minlength=hi - lo)
            total = np.bincount(context, counts.astype(float), hi - lo)
            steps = lambda p: np.minimum(NONE - 1, np.rint(-np.log10(p) * STEP)).astype(np.uint16)
            some = kinds > 0
            weights = np.full(hi - lo, NONE, np.uint16)
            weights[some] = steps(discount * kinds[some] / total[some])
            starts = np.concatenate(([0], np.cumsum(kinds)))[:-1].astype(np.uint64)
            arrays = _prefixed("k_", build(context.astype(np.uint64) * np.uint64(width) + child)) | _prefixed("s_", build(starts))
            arrays |= {"values": steps((counts - discount) / total[context]), "weights": weights}
            path, layout = _write(folder, level, bucket, arrays)
            return {"bucket": bucket, "path": path, "layout": layout, "lo": lo, "hi": hi, "n": len(keys), "width": width, "words": int(counts.sum()), "cuts": _cuts(counts, segment)}

        counted = chunks.where("not held").select("docs", "starts", "words").mapInArrow(grams, "bucket long, blob binary")
        manifests.append(_manifest(spark, counted, make, f"grams{level}", segment, tokens.tolist()))
    return manifests, total, chunks


# -- scoring ----------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, order: int = 3, discount: float = 0.75, parts: int = 7, held_out: int = 2, segment: int = SEGMENT) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Every whole text is scored by a trie of all documents outside the held-out part. A null or empty text
    is its end token alone. Repeated rows count and are scored each; a null doc_id is in the part that the
    empty text's crc32 gives and stays null. Other columns, whatever their names, are not read. With no
    training text at all every token is unknown: base_score and score come from N = 0 and V = 0. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = "string" if docs.schema["doc_id"].dataType.simpleString() == "string" else "long"
    docs = docs.select(F.col("doc_id").cast(kind).alias("doc_id"), "text")
    manifests, total, chunks = train(docs, order, discount, parts, held_out, segment)
    shared = spark.sparkContext.broadcast((manifests, total))
    schema = pa.schema([("doc_id", pa.string() if kind == "string" else pa.int64()), ("held_out", pa.bool_()), *((x, pa.int64()) for x in ("n_tokens", "n_known", "train_tokens")), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches):
        trie = Trie(*shared.value)
        for own, ids, starts in _coded(batches):
            p, base, known = trie.log10(ids, starts)
            cols = [
                own,
                [py_part(i, parts) == held_out for i in own],
                np.diff(np.append(starts, len(ids))),
                np.add.reduceat(known.astype(np.int64), starts),
                np.full(len(own), trie.total, np.int64),
                np.add.reduceat(base, starts),
                np.add.reduceat(p, starts),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return chunks.select("docs", "starts", "words").mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
