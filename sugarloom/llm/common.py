"""Helpers shared by the corpus operators: tables, durable stages, words and n-gram hashes."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.operators.staging import drop_stage, new_path, staged  # noqa: F401

#: Words are runs of anything but ASCII space and the controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column | str) -> Column:
    return F.translate(col, UPPER, LOWER)


def word_count(col: Column | str) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def split_part(col: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the split that held-out rows come from."""
    return F.crc32(F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit("")).cast("binary")) % n


def py_part(doc_id: object, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


# -- tasks and batches ----------------------------------------------------------------------------


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sliced(batches: Iterator, rows: int = 512, size: int = 8 << 20) -> Iterator:
    """Arrow batches in slices of bounded rows and about `size` bytes, as texts can be long; a text is never cut."""
    for batch in batches:
        step = max(1, min(rows, size * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def lowest_hashes(df: DataFrame, most: int, *cols: Column | str) -> DataFrame:
    """The rows whose hash of cols is among the `most` lowest (with ties): a bounded, repeatable sample.

    The cut is found over hashes alone, so no task sends rows to the driver that another would outdo.
    """
    h = F.xxhash64(F.lit("sample"), *cols)
    cut = [r[0] for r in df.select(h.alias("h")).orderBy("h").limit(most).collect()]
    return df.where(h <= max(cut)) if cut else df.limit(0)


# -- words and hashes -----------------------------------------------------------------------------


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() parts at space and TAB to CR, as WORD does."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


_BYTE = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(1 << 18, 2 * n)
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """64-bit hashes of the k-word windows in order; windows of a shorter text: one of all its words.

    A polynomial over bytes, taken from prefix sums, so that the cost is a few array operations a
    byte whatever k is. Long texts go in blocks of words, so that memory is bounded.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    k = min(k, n)
    parts = []
    for at in range(0, n - k + 1, _BLOCK):
        raw = np.frombuffer(b" ".join(words[at : at + _BLOCK + k - 1]), np.uint8)
        power, inverse = _power_tables(len(raw) + 1)
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[raw] * power[: len(raw)], out=sums[1:])
        gaps = np.flatnonzero(raw == 32)
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(raw))
        last = len(starts) - k + 1
        parts.append(mix64((sums[ends[k - 1 :]] - sums[starts[:last]]) * inverse[starts[:last]] + np.uint64(k)))
    return np.concatenate(parts)


def texts(batches: Iterator, *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of the named columns."""
    for batch in sliced(batches):
        yield from zip(*(batch.column(x).to_pylist() for x in names), strict=True)
