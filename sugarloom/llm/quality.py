"""Quality rules by distribution divergence.

A document's character-class and common-word histograms are held against those of its language, which
are gathered over all documents; the Jensen-Shannon distance to them, with a guard for short texts,
decides beside the fixed rules on counts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sugarloom.llm.common import ngram_hashes, sliced, table, texts

#: Character classes, by lead byte of UTF-8; continuation bytes count nothing.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "other")
_CLASS = np.full(256, 9, np.uint8)
_CLASS[0:128] = 7
_CLASS[192:256] = 8
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 11, 12, 13]] = 4
_CLASS[list(b".,;:")] = 5
_CLASS[list(b"!?'\"()-")] = 6

SYMBOLS = b"#*$%&|<>"
COMMON_WORDS = 64


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=10)[:9]


def bare(word: bytes) -> bytes:
    return word.lower().strip(b".,;:!?'\"()")


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2: 0 for equal histograms, 1 for disjoint ones; 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        split = np.nansum(p * np.log2(p / m)) + np.nansum(q * np.log2(q / m))
    return float(np.sqrt(max(0.0, split / 2)))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - (len(raw) - len(raw.translate(None, b" \t\n\r\x0b\x0c")))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    if len(words) > 5:
        _, at, seen = np.unique(ngram_hashes(words, 5), return_inverse=True, return_counts=True)
        starts = np.flatnonzero(seen[at] > 1)
        cover = np.zeros(len(words) + 1, np.int32)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + 5, -1)
        repeats = int((np.cumsum(cover)[:-1] > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def _shares(h: np.ndarray) -> np.ndarray:
    """Parts in a million, so that sums are the same in any order."""
    return h * 1_000_000 // max(1, int(h.sum()))


GATHERED = "lang string, kind string, word string, n long"


def _gathered(batches):
    """Of each language the number of texts with words (kind t), and over these texts the sums of their shares of each
    character class (c) and of each word (w), in parts in a million; some rows a task."""
    sums: dict[tuple, dict] = {}
    bared: dict[bytes, bytes] = {}
    held = 0

    def rows():
        nonlocal held
        flat = [(lang, kind, x, int(n)) for (lang, kind), own in sums.items() for x, n in own.items()]
        sums.clear()
        held = 0
        for at in range(0, len(flat), 100_000):
            lang, kind, words, n = zip(*flat[at : at + 100_000], strict=True)
            words = [w.decode("utf-8", "surrogatepass").encode("utf-8", "replace").decode() if isinstance(w, bytes) else w for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["lang", "kind", "word", "n"])

    for lang, text in texts(batches, "lang", "text"):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        if not words:
            continue
        for kind, own in (("t", {"": 1}), ("c", {str(i): x for i, x in enumerate(_shares(class_counts(raw))) if x})):
            into = sums.setdefault((lang, kind), {})
            for x, n in own.items():
                into[x] = into.get(x, 0) + n
        into, before, total = sums.setdefault((lang, "w"), {}), len(sums[lang, "w"]), len(words)
        for w, c in Counter(words).items():
            b = bared.get(w)
            if b is None:
                b = bared[w] = bare(w)
            into[b] = into.get(b, 0) + c * 1_000_000 // total
        held += len(into) - before
        if len(bared) > 500_000:
            bared.clear()
        if held > 500_000:
            yield from rows()
    yield from rows()


def _histogram(words: list[bytes], places: dict[bytes, int]) -> np.ndarray:
    """Counts of the common words, all others at the end."""
    out = np.zeros(len(places) + 1, np.int64)
    counts = Counter(words)
    for word, c in counts.items():
        out[places.get(bare(word), -1)] += c
    return out


def references(docs: DataFrame, common: int = COMMON_WORDS) -> dict:
    """Of each language: its common words and its histograms over all documents, each text counting alike, so that no long
    text speaks for its language. Junk counts too, as what is judged here is the corpus as it is.

    Every word of every text is counted, in one pass, by language and word; `common` words and 9 classes of
    each language come to the driver, whatever the corpus.
    """
    sums = docs.select("lang", "text").mapInArrow(_gathered, GATHERED).groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    # each task keeps its own first ones, so a language's words don't meet in one
    place = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word"))
    top = sums.where("kind <> 'w' or word <> ''").withColumn("place", place).where(F.col("place") <= max(common, len(CLASSES))).where(f"kind <> 'w' or place <= {common}").orderBy("lang", "kind", "place").collect()
    out: dict = {}
    for r in top:
        if r["kind"] == "t":
            out[r["lang"]] = {"places": {}, "c": np.zeros(len(CLASSES)), "w": [], "texts": r["n"]}
    for r in top:
        own = out[r["lang"]]
        if r["kind"] == "c":
            own["c"][int(r["word"])] = r["n"]
        elif r["kind"] == "w":
            own["places"][r["word"].encode()] = len(own["places"])
            own["w"].append(r["n"])
    for own in out.values():
        own["w"] = np.array([*own["w"], max(0, own["texts"] * 1_000_000 - sum(own["w"]))], float)
    return out


SCORED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"


def judge(text: str | None, reference: dict | None, most_class: float, most_word: float, least_words: int, least_common: int) -> tuple:
    counts = base_counts(text)
    n, repeats = counts[0], counts[4]
    failed = n < 10 or 100 * repeats > 20 * n
    by_class = by_word = 0.0
    if reference and n:
        raw = text.encode("utf-8", "surrogatepass")
        by_class = distance(class_counts(raw).astype(float), reference["c"])
        by_word = distance(_histogram(raw.split(), reference["places"]).astype(float), reference["w"])
    apart = n >= least_words and by_class > most_class or n >= least_common and by_word > most_word
    return (*counts, by_class, by_word, failed, not failed and not apart)


def quality(docs: DataFrame, most_class: float = 0.28, most_word: float = 0.44, least_words: int = 40, least_common: int = 100) -> DataFrame:
    """All columns of docs(text, lang, ...) plus those of SCORED.

    A text of under `least_words` words is too short for the histogram of classes, one of under
    `least_common` for that of common words; the counts decide all the same. A null or
    empty text has no words and fails; a null lang is a language of its own; ids, null or repeated, play no part,
    and repeated rows are judged each. Columns of docs named as in
    SCORED give way to the new ones. An empty table gives no rows.
    """
    new = [x.split()[0] for x in SCORED.split(", ")]
    docs = docs.drop(*new)
    known = references(docs)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        kinds = dict(zip(new, (pa.int64(),) * 5 + (pa.float64(),) * 2 + (pa.bool_(),) * 2, strict=True))
        for batch in sliced(batches):
            rows = [judge(t, known.get(x), most_class, most_word, least_words, least_common) for t, x in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(new)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, kinds[x]) for c, x in zip(cols, new, strict=True))], names=[*batch.schema.names, *new])

    return docs.mapInArrow(run, f"{schema}, {SCORED}")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")
