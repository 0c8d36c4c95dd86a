"""Byte-level BPE: texts to token ids and back, by recursive queries of DuckDB within each partition.

Spark deals the documents out; a task finds the pieces of its texts, and the pieces it has not met before become
rows (word, place, token, next token) of a DuckDB table. A recursive query joins them with the merge table and
contracts each word's leftmost pair of least rank, once a round, until no word has a pair left. Decoding joins
token rows with the vocabulary and aggregates their bytes in order of place.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import sliced, table

#: Bytes of the longest word that is contracted as a whole; a longer one is contracted at many places in a round.
WHOLE = 256
#: Pieces that a task remembers, bytes of pieces in one recursive query, tokens in one ordered aggregation and in one
#: of its groups, and code points of a text that are split into pieces at a time.
REMEMBERED, QUERY_BYTES, QUERY_TOKENS, GROUP_TOKENS, STRETCH = 300_000, 1 << 20, 1 << 19, 1 << 16, 1 << 20

LETTER, NUMBER, SPACE = 1, 2, 3
_kinds: list[np.ndarray] = []
_SPACE_BEGINS = regex.compile(r"(?<=\S)(?=\s)")


def _kind_table() -> np.ndarray:
    """The kind of every code point: 1 letter, 2 number, 3 white space, 0 anything else."""
    if not _kinds:
        points = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\x00" for c in range(0x110000))
        kinds = np.zeros(len(points), np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, points):
                kinds[m.start() : m.end()] = kind
        _kinds.append(kinds)
    return _kinds[0]


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags of the code points that begin a piece; first: where each text begins. Pieces cover all of a text.

    The pieces are those of public_tokenizers.PATTERN: runs of letters, numbers and other signs, each with one blank
    before it; white space up to the last one before such a run; 's 't 're 've 'm 'll 'd apart.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, bool)
    kinds = _kind_table()[codes]
    begins = np.zeros(n + 3, bool)
    begins[first[first < n]] = True
    run = begins.copy()
    run[n] = True
    run[1:n] |= kinds[1:] != kinds[:-1]
    start = run.copy()
    # of white space before other signs, the last one begins a piece; a blank is the first sign of the next piece
    after = np.flatnonzero(run[1:n] & ~begins[1:n] & (kinds[1:] != SPACE) & (kinds[:-1] == SPACE)) + 1
    start[after - 1] = True
    start[after[codes[after - 1] == 32]] = False
    padded = np.append(codes, np.zeros(3, codes.dtype))
    quote = np.flatnonzero((codes == 39) & start[:n] & run[1 : n + 1] & ~begins[1 : n + 1])
    one, two = padded[quote + 1], np.where(run[quote + 2], 0, padded[quote + 2])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    start[quote[short | long] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    return start[:n]


def stretches(text: str) -> Iterator[str]:
    """A text in parts of some STRETCH code points that begin where white space does, which is where a piece begins."""
    at = 0
    while len(text) - at > 2 * STRETCH and (m := _SPACE_BEGINS.search(text, at + STRETCH)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


#: The place of a pair is in the low 32 bits of its order, its rank above them.
_START = """
  SELECT s.w, s.p, s.q, s.a, s.b, m.r, false FROM start s LEFT JOIN merges m ON m.k = (s.a::BIGINT << 16) + s.b"""
_RANKED = """
  SELECT n.w, n.p, n.q, n.a, n.b, m.r, n.done FROM moved n LEFT JOIN merges m ON m.k = (n.a::BIGINT << 16) + n.b"""
_RESULT = "SELECT w, a FROM t WHERE done ORDER BY w, p"

WORDS_SQL = f"""
WITH RECURSIVE t(w, p, q, a, b, r, done) AS ({_START}
  UNION ALL (
  WITH best AS (
    SELECT w, min((r::BIGINT << 32) + p) AS m, arg_min(q, (r::BIGINT << 32) + p) AS q FROM t WHERE NOT done GROUP BY w),
  pair AS (SELECT w, q, m & 4294967295 AS p, (m >> 32)::INTEGER AS r FROM best),
  moved AS (
    SELECT t.w, CASE WHEN t.p = x.q THEN x.p::INTEGER ELSE t.p END AS p, t.q, CASE WHEN t.p = x.q THEN x.r ELSE t.a END AS a,
      CASE WHEN t.q = x.p THEN x.r ELSE t.b END AS b, x.p IS NULL AS done
    FROM t JOIN pair x ON t.w = x.w WHERE NOT t.done AND (x.p IS NULL OR t.p <> x.p)){_RANKED}))
{_RESULT}"""

#: A word of n bytes goes in blocks of `{block}` bytes, by turns of WHOLE and of a share of the word; both are at least
#: twice the longest token. A pair that is the leftmost of least rank in its block and the two beside it is contracted in
#: this round: what happens further off reaches no more than a token's length into these blocks before it. In a run of
#: equal tokens after the token that they make, every other pair up to the block's end goes with the first, where the
#: table says that it is `even`: then what they make merges with none of its new neighbours earlier. Likewise all equal
#: pairs of two unlike tokens in the block, where what they make is `quiet`: it merges with nothing earlier.
_BLOCK = f"CASE WHEN i % 2 = 0 THEN {WHOLE} ELSE greatest({WHOLE}, n // 32) END"
LONG_SQL = f"""
WITH RECURSIVE t(w, p, q, a, b, r, done, n, i) AS (
  SELECT s.w, s.p, s.q, s.a, s.b, m.r, false, s.n, 0 FROM start s LEFT JOIN merges m ON m.k = (s.a::BIGINT << 16) + s.b
  UNION ALL (
  WITH now AS (SELECT *, p // ({_BLOCK}) AS k FROM t WHERE NOT done),
  least AS (SELECT w, k, min((r::BIGINT << 32) + p) AS m FROM now GROUP BY w, k),
  chosen AS (
    SELECT w, k, m & 4294967295 AS p FROM least
    QUALIFY m = min(m) OVER (PARTITION BY w ORDER BY k RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
  pair AS (SELECT t.* FROM now t JOIN chosen c ON t.w = c.w AND t.p = c.p),
  run AS (
    SELECT x.w, x.k, x.a, x.r, x.p, x.q - x.p AS step FROM pair x JOIN now t ON t.w = x.w AND t.q = x.p AND t.a = x.r
    JOIN even e ON e.r = x.r WHERE x.a = x.b),
  rest AS (SELECT t.w, t.k, t.p, t.q, t.r, t.a = run.a AND t.b = run.a AS same, run.p AS begins, run.step
    FROM now t JOIN run ON t.w = run.w AND t.k = run.k WHERE t.p > run.p),
  ends AS (SELECT w, k, min(p) AS p FROM rest WHERE NOT same GROUP BY w, k),
  alike AS (
    SELECT t.w, t.k, t.p, t.q, t.r, t.a = x.a AND t.b = x.b AS same
    FROM now t JOIN (SELECT pair.* FROM pair JOIN quiet ON quiet.r = pair.r WHERE a <> b) x ON t.w = x.w AND t.k = x.k AND t.r = x.r WHERE t.p > x.p),
  unlike AS (SELECT w, k, min(p) AS p FROM alike WHERE NOT same GROUP BY w, k),
  cut AS (
    SELECT w, p, q, r FROM pair
    UNION ALL SELECT s.w, s.p, s.q, s.r FROM alike s LEFT JOIN unlike e ON e.w = s.w AND e.k = s.k
    WHERE same AND s.p < coalesce(e.p, s.p + 1)
    UNION ALL SELECT s.w, s.p, s.q, s.r FROM rest s LEFT JOIN ends e ON e.w = s.w AND e.k = s.k
    WHERE same AND s.p < coalesce(e.p, s.p + 1) AND (s.p - begins) % (2 * step) = 0),
  going AS (SELECT DISTINCT w FROM cut),
  moved AS (
    SELECT t.w, coalesce(y.p, t.p) AS p, t.q, coalesce(y.r, t.a) AS a, coalesce(z.r, t.b) AS b, o.w IS NULL AS done, t.n, t.i + 1 AS i
    FROM now t LEFT JOIN cut x ON x.w = t.w AND x.p = t.p LEFT JOIN cut y ON y.w = t.w AND y.q = t.p
    LEFT JOIN cut z ON z.w = t.w AND z.p = t.q LEFT JOIN going o ON o.w = t.w WHERE x.w IS NULL)
  SELECT u.w, u.p, u.q, u.a, u.b, m.r, u.done, u.n, u.i FROM moved u LEFT JOIN merges m ON m.k = (u.a::BIGINT << 16) + u.b))
{_RESULT}"""

DECODE_SQL = """
SELECT doc, grp, unhex(string_agg(h, '' ORDER BY pos)) AS bytes, count(*) AS n FROM ids JOIN vocab ON vocab.id = ids.id GROUP BY doc, grp ORDER BY doc, grp"""


class Coder:
    """The vocabulary of a rank file, DuckDB's tables of it, and the pieces that this process has coded so far."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = ranks
        halves = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        at = {(a, b): r for a, b, r in halves}
        even = [r for a, b, r in halves if a == b and at.get((r, a), r) >= r and at.get((r, r), r) >= r]
        loud = {c for a, b, r in halves for c in (a, b) if r < c}
        if 2 * max(map(len, ranks)) > WHOLE or max(ranks.values()) >= 1 << 16:
            raise ValueError("a token is too long, or an id too large, for this coder")
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        self._table("merges", {"k": np.array([(a << 16) + b for a, b, _ in halves], np.int64), "r": np.array([r for *_, r in halves], np.int32)})
        self._table("even", {"r": np.array(even, np.int32)})
        self._table("quiet", {"r": np.array([r for r in ranks.values() if r not in loud], np.int32)})
        self._table("vocab", {"id": np.array(list(ranks.values()), np.int32), "h": pa.array([t.hex() for t in ranks])})
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.names = pa.array([str(i) for i in range(max(ranks.values()) + 1)])
        self._forget()

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _forget(self) -> None:
        """Only the tokens themselves are known, each as a piece of one id."""
        self.known = {t: i for i, t in enumerate(self.ranks)}
        self.flat = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
        self.begin = np.arange(len(self.ranks) + 1)

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and how many each word has; words are at least two bytes long."""
        raw, size = np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
        w, end = np.repeat(np.arange(len(words), dtype=np.int32), size), np.cumsum(size)
        place = (np.arange(len(raw)) - np.repeat(end - size, size)).astype(np.int32)
        a = self.byte[raw]
        b = np.append(a[1:], np.int32(-1))
        b[end - 1] = -1
        start = {"w": w, "p": place, "q": place + 1, "a": a, "b": b}
        long = size[-1] > WHOLE
        if long:
            start["n"] = np.repeat(size, size).astype(np.int32)
        self.con.register("start", pa.table(start))
        got = self.con.execute(LONG_SQL if long else WORDS_SQL).fetchnumpy()
        self.con.unregister("start")
        return np.asarray(got["a"], np.int32), np.bincount(np.asarray(got["w"]), minlength=len(words))

    def learn(self, pieces: list[bytes]) -> None:
        """Code pieces that are not known yet, shorter ones first, QUERY_BYTES of them or one longer piece at a time."""
        pieces = sorted(pieces, key=len)
        at = 0
        while at < len(pieces):
            to, room = at, QUERY_BYTES
            while to < len(pieces) and (to == at or (len(pieces[to]) <= room and (len(pieces[to]) > WHOLE) == (len(pieces[at]) > WHOLE))):
                room -= len(pieces[to])
                to += 1
            ids, n = self.contract(pieces[at:to])
            self.known.update(zip(pieces[at:to], range(len(self.begin) - 1, len(self.begin) - 1 + to - at), strict=True))
            self.flat = np.concatenate([self.flat, ids])
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(n)])
            at = to

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(size) - size
        starts = np.flatnonzero(piece_starts(codes, first))
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        raw = whole.encode("utf-8", "surrogatepass")
        if len(raw) == len(codes):
            cut = np.append(starts, len(raw))
        else:
            width = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))])
            cut = np.append(width[starts], len(raw))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        kinds = pieces.dictionary.to_pylist()
        new = [x for x in kinds if x not in self.known]
        if len(self.known) + len(new) > REMEMBERED + len(self.ranks):
            self._forget()
            new = [x for x in kinds if x not in self.known]
        self.learn(new)
        row = np.fromiter(map(self.known.__getitem__, kinds), np.int64, len(kinds))
        begin, count = self.begin[row], (self.begin[1:] - self.begin[:-1])[row]
        at = pieces.indices.to_numpy()
        n = count[at]
        total = np.cumsum(n)
        ids = self.flat[np.repeat(begin[at] - (total - n), n) + np.arange(total[-1])]
        upto = np.concatenate([[0], total])[np.searchsorted(starts, np.append(first, len(codes)))]
        return ids, np.diff(upto)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, bytes | None]]:
        """The bytes of lists of ids as (list, part), the parts of a list in order, None for a part with an unknown id;
        nothing for an empty list."""
        doc = np.repeat(np.arange(len(count), dtype=np.int32), count)
        pos = np.arange(len(ids)) - np.repeat(np.cumsum(count) - count, count)
        grp = (pos // GROUP_TOKENS).astype(np.int32)
        turns = np.append(np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(grp, prepend=-1)), len(ids))
        at = 0
        while at < len(turns) - 1:
            to = max(at + 1, int(np.searchsorted(turns, turns[at] + QUERY_TOKENS, "right")) - 1)
            part = slice(turns[at], turns[to])
            self.con.register("ids", pa.table({"doc": doc[part], "grp": grp[part], "pos": pos[part], "id": ids[part]}))
            found = {(d, g): (x, n) for d, g, x, n in self.con.execute(DECODE_SQL).fetchall()}
            self.con.unregister("ids")
            for k in range(at, to):
                x, n = found.get((int(doc[turns[k]]), int(grp[turns[k]])), (None, 0))
                yield int(doc[turns[k]]), x if n == turns[k + 1] - turns[k] else None
            at = to


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The coder of a rank file, one a process."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _groups(batches: Iterator, size: int = 4 << 20) -> Iterator[tuple[list, list[list[str]]]]:
    """Rows of (key, text) in lists of some `size` code points, a long text alone; each text as its stretches."""
    keys, texts, room = [], [], size
    for batch in sliced(batches, 4096, size):
        for key, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            if keys and len(text) > room:
                yield keys, texts
                keys, texts, room = [], [], size
            keys.append(key)
            texts.append(list(stretches(text)))
            room -= len(text)
    if keys:
        yield keys, texts


def _encoded(c: Coder, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """encode() of texts given as stretches, the stretches of a long text one by one."""
    if len(texts) > 1 or len(texts[0]) == 1:
        ids, n = c.encode([s for x in texts for s in x])
        of = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        return ids, np.bincount(of, n, len(texts)).astype(np.int64)
    parts = [c.encode([s])[0] for s in texts[0]]
    return np.concatenate(parts), np.array([sum(map(len, parts))])


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs(key, text, ...) to (key, ids): the ids of each text in order.

    A null text is an empty one and has no ids; every row gives a row, repeated ones and those of null or equal keys too;
    an empty table gives no rows; other columns are not read. Special tokens are ordinary text. Texts may be of any
    length: they are split into stretches at white space, words of over 256 bytes are contracted at many places a round.
    path: a rank file (base64 token and rank a line) that every executor can read.
    """

    def run(batches):
        c = coder(path)
        for keys, texts in _groups(batches):
            ids, n = _encoded(c, texts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, keys[0].type), lists], [key, "ids"])

    df = docs.select(F.col(key).alias(key), F.col(text).alias("text"))
    return df.mapInArrow(run, f"`{key}` {df.schema[0].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids) to (key, bytes): the bytes that the ids stand for; null for null ids, a null id or one not in the
    vocabulary, empty for no ids. Every row gives a row."""

    def run(batches):
        c = coder(path)
        for batch in sliced(batches, 4096, 4 << 20):
            lists = batch.column(1)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int32)
            out: list = [b"" if x else None for x in lists.is_valid().to_pylist()]
            for at, part in c.decode(flat, n):
                out[at] = None if part is None or out[at] is None else out[at] + part
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [key, "bytes"])

    df = rows.select(F.col(key).alias(key), F.col(ids).alias("ids"))
    return df.mapInArrow(run, f"`{key}` {df.schema[0].dataType.simpleString()}, bytes binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, n_tokens, ids_sha256, decoded_sha256): what encode() gives and what decode()
    makes of it, as digests, in one pass and without either list or bytes leaving the task. Rows as in encode()."""

    def run(batches):
        c = coder(path)
        for keys, texts in _groups(batches):
            ids, n = _encoded(c, texts)
            shas, decoded = [], [hashlib.sha256() for _ in keys]
            ends = np.cumsum(n)
            for end, size in zip(ends.tolist(), n.tolist(), strict=True):
                sha = hashlib.sha256()
                for at in range(end - size, end, QUERY_TOKENS):
                    part = c.names.take(pa.array(ids[at : min(end, at + QUERY_TOKENS)]))
                    line = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], part), " ")[0].as_py()
                    sha.update((" " * (at > end - size) + line).encode())
                shas.append(sha.hexdigest())
            for at, part in c.decode(ids, n):
                decoded[at].update(part)
            columns = [pa.array(keys, keys[0].type), pa.array(n, pa.int64()), pa.array(shas), pa.array([x.hexdigest() for x in decoded])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    df = docs.select("doc_id", "text")
    return df.mapInArrow(run, f"doc_id {df.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
