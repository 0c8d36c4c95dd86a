"""Substring deduplication by paragraph MinHash banding.

Paragraphs are of two kinds: lines of at least a passage's words, and pieces, which are cut from the whole
text where the words themselves say so, across lines, so that a passage is cut alike wherever it stands.
Every paragraph gets a MinHash signature of its word shingles, cut into bands that are tuned to miss few
pairs of the wanted similarity. Paragraphs that agree in a band are joined, their sets compared exactly, and
the components of the links are the clusters.

Matched paragraphs of one document that touch are joined into stretches. A stretch with a matched line is a
passage. In any other, with the unmatched pieces around it, windows of a passage's words are held against
those of all other stretches: where one is in another document too, the passage is settled to the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sugarloom.llm.common import drop_stage, mix64, ngram_hashes, release, sliced, staged, table
from sugarloom.llm.components import connected_components
from sugarloom.llm.ngram_join import _bloom_hits, id_filter, per_group
from sugarloom.llm.setjoin import group_links, heads_of, pack

#: Bits of a shingle's hash within a set; two of n shingles share them with a chance of n * n / 2**45.
BITS = 44
#: Hundredths of similarity at which pieces link, and at most a tenth of them are missed; equal ones never are. Pieces
#: are small sets, of which less alike ones mean little: lines link from the wanted similarity on.
PIECE_SIMILARITY = 90
#: Paragraphs that are hashed at once.
CHUNK = 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def tune_bands(similarity: float, miss: float = 0.002, most_hashes: int = 64) -> tuple[int, int]:
    """(bands, rows) with the most rows a band, so the fewest chance collisions, that misses at most `miss`."""
    best = (most_hashes, 1)
    for rows in range(1, 9):
        for bands in range(1, most_hashes // rows + 1):
            if (1 - similarity**rows) ** bands <= miss:
                best = (bands, rows)
                break
    return best


class Bander:
    """Band keys of many sets of shingle hashes at once."""

    def __init__(self, bands: int, rows: int):
        r = np.random.default_rng(97)
        self.bands, self.rows = bands, rows
        self.a = r.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = r.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def keys(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of 64-bit keys a set, one a band and different for different bands; sets begin at starts."""
        least = np.empty((len(starts), self.bands * self.rows), np.uint64)
        ends = np.append(starts[1:], len(hashes))
        at = 0
        while at < len(starts):  # some thousand hashes at a time, so memory is bounded; a longer set goes alone
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + 8192, "right")))
            own, first = hashes[starts[at] : ends[to - 1]], starts[at:to] - starts[at]
            if to == at + 1:
                low = np.full(self.bands * self.rows, ~np.uint64(0))
                for i in range(0, len(own), 8192):
                    low = np.minimum(low, (own[i : i + 8192, None] * self.a + self.b).min(0))
                least[at] = low
            else:
                least[at:to] = np.minimum.reduceat(own[:, None] * self.a + self.b, first, axis=0)
            at = to
        key = np.arange(self.bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        out = np.broadcast_to(key, (len(starts), self.bands))
        for i in range(self.rows):
            out = mix64(out ^ least[:, i :: self.rows][:, : self.bands])
        return out.view(np.int64)


def breaks(h: np.ndarray, reach: int) -> np.ndarray:
    """Where h is below all `reach` before it and not above those after it; the highest value is none."""
    least = h != ~np.uint64(0)
    for d in range(1, min(reach, len(h) - 1) + 1):
        least[d:] &= h[d:] < h[:-d]
        least[:-d] &= h[:-d] <= h[d:]
    return least


class Words:
    """The words of some texts: of each the text it is of, its place and its line there, and where it begins and ends in
    code points."""

    def __init__(self, batch: list[str | None]):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in batch]
        joined = b"\n".join(raws) + b"\n"
        self.words = joined.lower().split()
        byte = np.frombuffer(joined, np.uint8)
        space = _SPACE[byte]
        begin = np.flatnonzero(~space & np.append(True, space[:-1]))
        end = np.flatnonzero(space[1:] & ~space[:-1])  # the last byte of each
        points = np.cumsum((byte & 0xC0) != 0x80, dtype=np.int64)
        first = np.concatenate(([0], np.cumsum([len(x) + 1 for x in raws])[:-1])).astype(np.int64) if raws else np.empty(0, np.int64)
        self.text = np.searchsorted(first, begin, "right") - 1
        before = points[first[self.text] - 1] * (first[self.text] > 0)
        self.start, self.end = points[begin] - 1 - before, points[end] - before
        self.line = np.cumsum(byte == 10)[begin]
        self.first = np.searchsorted(self.text, np.arange(len(raws)))

    def pieces(self, reach: int) -> np.ndarray:
        """The words that begin a piece: the first of a text, and where the hash of three words is the least around."""
        n = len(self.words)
        if not n:
            return np.empty(0, np.int64)
        new = np.append(True, self.text[1:] != self.text[:-1])
        if n < 3:
            return np.flatnonzero(new)
        # texts stand `reach` places apart, so that none looks into the next
        place = np.arange(n) + self.text * reach
        h = np.full(int(place[-1]) + 1, ~np.uint64(0))
        whole = np.flatnonzero(self.text[2:] == self.text[:-2])
        h[place[whole]] = ngram_hashes(self.words, 3)[whole] >> np.uint64(1)
        return np.flatnonzero(new | breaks(h, reach)[place])


class Units:
    """The paragraphs of some texts, pieces and then long lines: words [a, b), whether a line, words of the pieces before and
    after, distinct ascending shingle hashes, and classes (equal for equal sets of one kind)."""

    def __init__(self, words: Words, k: int, reach: int, line_words: int):
        n = len(words.words)
        cut = words.pieces(reach)
        size = np.diff(np.append(cut, n))
        same = words.text[cut[1:]] == words.text[cut[:-1]] if len(cut) else np.empty(0, bool)
        left, right = np.zeros(len(cut), np.int64), np.zeros(len(cut), np.int64)
        left[1:], right[:-1] = size[:-1] * same, size[1:] * same
        lines = np.flatnonzero(np.append(True, words.line[1:] != words.line[:-1])) if n else np.empty(0, np.int64)
        long = np.diff(np.append(lines, n))
        use, use_lines = size >= k, long >= max(k, line_words)
        none = np.zeros(int(use_lines.sum()), np.int64)
        self.a = np.concatenate((cut[use], lines[use_lines]))
        self.b = self.a + np.concatenate((size[use], long[use_lines]))
        self.is_line = np.concatenate((np.zeros(int(use.sum()), bool), np.ones(len(none), bool)))
        self.left, self.right = np.concatenate((left[use], none)), np.concatenate((right[use], none))
        self.k = k
        h = ngram_hashes(words.words, k)
        parts = [self._sets(h, lo, min(len(self.a), lo + CHUNK)) for lo in range(0, len(self.a), CHUNK)]
        self.hashes, self.sizes, self.classes = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])) if len(self.sizes) else np.empty(0, np.int64)

    def _sets(self, h: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count = self.b[lo:hi] - self.a[lo:hi] - self.k + 1
        unit = np.repeat(np.arange(hi - lo), count)
        at = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count) + self.a[lo:hi][unit]
        # paragraph and hash in one number, so that one sort orders both
        key = np.sort(unit.astype(np.uint64) << np.uint64(BITS) | h[at] >> np.uint64(64 - BITS))
        key = key[np.append(True, key[1:] != key[:-1])]
        sizes = np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=hi - lo)
        own = key & np.uint64((1 << BITS) - 1)
        starts = np.cumsum(sizes) - sizes
        sums, mixed = np.add.reduceat(mix64(own + np.uint64(1)), starts), np.bitwise_xor.reduceat(mix64(own + np.uint64(1 << 50)), starts)
        kind = self.is_line[lo:hi].astype(np.uint64)  # the last bit, so that a piece and a line are never one class
        return own, sizes, (mix64(sums ^ mix64(mixed + sizes.astype(np.uint64))) & ~np.uint64(1) | kind).view(np.int64)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i] + self.sizes[i]]


UNITS = "doc_id {kind}, row long, line boolean, at long, n_words long, start long, end long, left long, right long, cls long, size int, bands array<long>"


def _scan(k: int, reach: int, passage_words: int, similarity: float):
    def run(batches):
        known: set[int] = set()
        banders = [Bander(*tune_bands(max(similarity, PIECE_SIMILARITY / 100), 0.1, 6)), Bander(*tune_bands(similarity))]
        for batch in sliced(batches):
            words = Words(batch.column("text").to_pylist())
            u = Units(words, k, reach, passage_words)
            if not len(u.a):
                continue
            fresh = np.zeros(len(u.a), bool)
            for i, c in enumerate(u.classes.tolist()):
                if c not in known:
                    if len(known) < 1_000_000:
                        known.add(c)
                    fresh[i] = True
            counts, keys = np.zeros(len(u.a), np.int64), []
            for kind, bander in enumerate(banders):  # pieces stand before lines
                own = np.flatnonzero(fresh & (u.is_line == bool(kind)))
                if len(own):
                    sizes = u.sizes[own]
                    starts = np.cumsum(sizes) - sizes
                    at = np.arange(int(sizes.sum())) - np.repeat(starts, sizes) + np.repeat(u.starts[own], sizes)
                    keys.append(bander.keys(mix64(u.hashes[at]), starts).ravel())
                    counts[own] = bander.bands
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            text = words.text[u.a]
            of = pa.array(text)
            cols = [batch.column("doc_id").take(of), batch.column("row").take(of), u.is_line, u.a - words.first[text], u.b - u.a, words.start[u.a], words.end[u.b - 1], u.left, u.right, u.classes, pa.array(u.sizes, pa.int32()), bands]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols], names=[x.split()[0] for x in UNITS.split(", ")])

    return run


def stretches(rows: DataFrame) -> DataFrame:
    """rows(doc_id, row, at, to, ...) with `stretch`, one number for those of a document that touch or overlap."""
    of = Window.partitionBy("doc_id", "row").orderBy("at", "to")
    reached = F.max("to").over(of.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("at") <= reached, 0).otherwise(1)
    return rows.withColumn("new", new).withColumn("stretch", F.sum("new").over(of.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def _kept(bloom, column: str):
    """A task that keeps the rows whose `column` may be in the filter."""

    def run(batches):
        for batch in batches:
            hit = np.ones(batch.num_rows, bool)
            for at in _bloom_hits(batch.column(column).to_numpy(), bloom.value):
                hit &= (bloom.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            yield batch.filter(pa.array(hit))

    return run


def _matched(units: DataFrame, parts: DataFrame) -> DataFrame:
    """units whose cluster is in two documents or more, with cluster, n_members, and keeper, the row of its first document."""
    # by class before the clusters, so that a paragraph of a third of all rows is one row from each task
    classes = units.groupBy("cls").agg(F.min("row").alias("lo"), F.max("row").alias("hi"))
    named = classes.join(parts.select(F.col("node").alias("cls"), F.col("component").alias("cluster")), "cls", "left")
    named = staged(named.where("cluster is not null or lo < hi"), "classes")
    linked = per_group(named.where("cluster is not null"), "cluster", "cls", F.min("lo").alias("low"), F.max("hi").alias("high")).where("low < high")
    clusters = staged(linked.select("cls", "cluster").unionByName(named.where("cluster is null").select("cls", F.col("cls").alias("cluster"))), "clusters")
    bloom = units.sparkSession.sparkContext.broadcast(id_filter(clusters.select(F.col("cls").alias("doc_id")), 26))
    slim = units.drop("bands", "size")
    found = staged(slim.mapInArrow(_kept(bloom, "cls"), slim.schema).join(clusters, "cls"), "matched")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    return per_group(found, "cluster", "row", F.count("*").alias("n_members"), first.alias("first")).withColumn("keeper", F.col("first.row")).drop("first")


def _settled(docs: DataFrame, open_: DataFrame, passage_words: int) -> DataFrame:
    """Of the open stretches (doc_id, row, lo, hi, ...) the windows of a passage's words between lo and hi that are in
    another document's as well: (doc_id, row, lo, at, to, start, end)."""
    bloom = docs.sparkSession.sparkContext.broadcast(id_filter(open_.select(F.col("row").alias("doc_id"))))

    def windows(batches):
        for batch in sliced(batches):
            words = Words(batch.column("text").to_pylist())
            n = np.diff(np.append(words.first, len(words.words)))
            parts = []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                h = ngram_hashes(words.words[words.first[i] : words.first[i] + n[i]], passage_words)
                for x in spans:
                    at = np.arange(x["lo"], min(x["hi"], int(n[i])) - passage_words + 1)
                    own = at + words.first[i]
                    parts.append((np.full(len(at), i), np.full(len(at), x["lo"]), at, words.start[own], words.end[own + passage_words - 1], h[at].view(np.int64)))
            if parts:
                text, lo, at, start, end, h = (np.concatenate(x) for x in zip(*parts, strict=True))
                of = pa.array(text)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), batch.column("row").take(of), *(pa.array(x) for x in (lo, at, at + passage_words, start, end, h))], names=["doc_id", "row", "lo", "at", "to", "start", "end", "h"])

    spans = open_.groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # of one document
    texts_ = docs.mapInArrow(_kept(bloom, "row"), docs.schema).dropDuplicates(["doc_id", "row"]).alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.row") == F.col("s.row")))
    found = staged(texts_.select("d.doc_id", "d.row", "text", "spans").mapInArrow(windows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row long, lo long, at long, to long, start long, end long, h long"), "windows")
    several = found.groupBy("h").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("h")
    return found.join(several, "h", "left_semi").drop("h")


def repeated_passages(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100, passage_words: int = 50, reach: int = 6) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, start, end, n_words, cluster, n_members, removed): the passages of passage_words
    words or more that another document has as well.

    Such a passage is a run of paragraphs that touch, each alike to one of another document (Jaccard of k-word
    shingles num/den or more for lines, PIECE_SIMILARITY for pieces, directly or over others): with a line of passage_words words among them, or
    holding, with the unmatched pieces around it, passage_words words that stand in another document word
    for word. reach sets the size of pieces: more than `reach` words each, 2 * reach + 1 in the mean; a verbatim
    passage of passage_words words holds some of them whole.

    start and end are code points, cluster and n_members those of its longest paragraph, removed is false in the
    cluster's first document by doc_id (nulls last). What repeats within its own document only is no
    finding. doc_id may be of any orderable type. Rows of one doc_id and text are one document; rows of a null doc_id are told apart by their text. Null,
    empty and shorter texts have no passages, an empty table gives no rows, other columns are not read.
    """
    if passage_words < k + 4 * reach:
        raise ValueError("a passage needs room for some pieces")
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    units = staged(docs.mapInArrow(_scan(k, reach, passage_words, num / den), UNITS.format(kind=docs.schema["doc_id"].dataType.simpleString())), "paragraphs")
    alike = {False: (max(num * 100 // den, PIECE_SIMILARITY), 100), True: (num, den)}
    groups = {line: heads_of(units.where(F.col("line") == line).select(F.explode("bands").alias("token"), F.col("size").alias("n"), "cls"), *alike[line]) for line in alike}
    release(spark)
    members = groups[False].select("member").union(groups[True].select("member")).distinct()
    bloom = spark.sparkContext.broadcast(id_filter(members.select(F.col("member").alias("doc_id"))))

    def packed(batches):
        done: set[int] = set()
        for batch in sliced(batches):
            ids, sets = [], []
            u = Units(Words(batch.column("text").to_pylist()), k, reach, passage_words)
            hit = np.ones(len(u.a), bool)
            for at in _bloom_hits(u.classes, bloom.value):
                hit &= (bloom.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            for i in np.flatnonzero(hit).tolist():
                c = int(u.classes[i])
                if c not in done:
                    if len(done) < 1_000_000:
                        done.add(c)
                    ids.append(c)
                    sets.append(pack(u.of(i) << np.uint64(64 - BITS)))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["member", "members"])

    sets = staged(docs.select("text").mapInArrow(packed, "member long, members binary").join(members, "member", "left_semi").dropDuplicates(["member"]), "sets")
    links = {line: group_links(groups[line], sets, *alike[line]) for line in alike}
    parts = connected_components(links[False].union(links[True]))
    for done in (*groups.values(), sets):
        drop_stage(done)
    found = _matched(units, parts).withColumn("to", F.col("at") + F.col("n_words"))
    best = F.max(F.struct("n_words", "cluster", "n_members", (F.col("row") != F.col("keeper")).alias("removed"))).alias("best")
    places = [F.min("at").alias("at"), F.max("to").alias("to"), F.min("start").alias("start"), F.max("end").alias("end")]
    joined = stretches(found).groupBy("doc_id", "row", "stretch").agg(*places, F.bool_or("line").alias("whole"), F.min_by("left", "at").alias("left"), F.max_by("right", "to").alias("right"), best)
    # the words around a passage can put one more break within `reach` words of its begin, or of its last three words
    joined = joined.withColumn("lo", F.greatest(F.lit(0), F.col("at") - F.col("left") - reach)).withColumn("hi", F.col("to") + F.col("right") + reach + 2)
    joined = staged(joined.where(F.col("whole") | (F.col("hi") - F.col("lo") >= passage_words)), "stretches")
    drop_stage(units)
    open_ = joined.where("not whole").select("doc_id", "row", "lo", "hi")
    windows = _settled(docs, open_, passage_words).alias("w").join(joined.where("not whole").select("doc_id", "row", "lo", "best").alias("j"), F.col("w.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("w.row") == F.col("j.row")) & (F.col("w.lo") == F.col("j.lo")))
    columns = ["doc_id", "row", "at", "to", "start", "end", "best"]
    every = windows.select("w.doc_id", "w.row", "at", "to", "start", "end", "best").unionByName(joined.where("whole").select(*columns))
    out = stretches(every).groupBy("doc_id", "row", "stretch").agg(*places, F.max("best").alias("best"))
    return out.select("doc_id", "start", "end", (F.col("to") - F.col("at")).alias("n_words"), "best.cluster", "best.n_members", "best.removed")


def op3_paragraph_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
