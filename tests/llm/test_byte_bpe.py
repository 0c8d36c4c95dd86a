"""Byte-level BPE against the tokenizer library, against the pattern, and in an exact round trip."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from sugarloom.llm import byte_bpe
from tests.llm.helpers import corpus, frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SIGNS = ["a", "b", "e", "th", "'s", "'", "'re", "'ll", "'t", "'S", " ", "  ", "\n", "\t", "1", "22", "é", "中文", " ", "!", "..", "_", "​", "𝔘", "re", "l", "<|endoftext|>", "\x1c", "\x85", "ⅷ", "²", "\x00"]
ODD = ["", " ", "'", " 's", "'s's", "it's 'tis", "a  b", "a \n b", "\n's", "x" * 300, "ab" * 700, "a" * 3001, " " * 900, "-=" * 500 + "-" * 777, "<|endoftext|>", "12345 678"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.coder(PATH).ranks, special_tokens={})


def texts(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(SIGNS) for _ in range(r.randint(0, 40))) for _ in range(n)]


def split(ids, n):
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_pieces_are_those_of_the_pattern():
    whole = [*texts(1, 2000), *ODD]
    size = np.array([len(x) for x in whole])
    codes = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32)
    want, at = [], 0
    for x in whole:
        want += [at + m.start() for m in regex.finditer(public_tokenizers.PATTERN, x)]
        at += len(x)
    assert np.flatnonzero(byte_bpe.piece_starts(codes, np.cumsum(size) - size)).tolist() == want


def test_every_code_point_is_of_the_kind_that_the_library_gives_it(library):
    points = [chr(c) for c in [*range(0x3100), *range(0x3100, 0x30000, 41)] if not 0xD800 <= c < 0xE000]
    whole = [f"a{c} {c}1" for c in points]
    assert split(*byte_bpe.coder(PATH).encode(whole)) == library.encode_ordinary_batch(whole, num_threads=1)


def test_ids_are_those_of_the_library(library):
    whole = [*texts(2, 1500), *ODD]
    assert split(*byte_bpe.coder(PATH).encode(whole)) == [library.encode_ordinary(x) for x in whole]


@pytest.mark.parametrize("seed", range(6))
def test_long_words(library, seed):
    r = random.Random(seed)
    word = "".join(r.choice(["ab" * r.randint(1, 90), "ti" * r.randint(1, 60), "a" * r.randint(1, 200), "ing", "nation", "the", "q"]) for _ in range(12))
    noise = "".join(r.choice("etaoinshr") for _ in range(900))
    assert split(*byte_bpe.coder(PATH).encode([word, noise, word + noise])) == [library.encode_ordinary(x) for x in (word, noise, word + noise)]


def test_other_ranks_whose_merges_come_early(tmp_path):
    """Ranks in an order that no training gives, so that what a pair makes may merge before the pair's own rank."""
    r = random.Random(3)
    made = {bytes(r.choice(b"abc") for _ in range(r.randint(2, 6))) for _ in range(150)}
    order = [bytes([b]) for b in range(256)] + sorted(made)
    r.shuffle(order)
    ranks = {x: i for i, x in enumerate(order)}
    path = tmp_path / "odd.tiktoken"
    path.write_text("".join(f"{base64.b64encode(x).decode()} {i}\n" for x, i in ranks.items()))
    library = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = ["".join(r.choice(["a", "b", "c", "ab" * 30, "a" * 40, "abc" * 9]) for _ in range(n)) for n in (3, 9, 60, 200, 200, 200)]
    assert split(*byte_bpe.Coder(str(path)).encode(whole)) == [library.encode_ordinary(x) for x in whole]


def test_frames_round_trip_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [*corpus(5, 30), *((900 + i, x, None, None, 0) for i, x in enumerate(ODD)), (None, "no id", "en", "s", 0), (None, None, None, None, None)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "lang AS ids", "source AS bytes", "n_chars AS n_tokens").repartition(3)
    got = sorted((x.doc_id if x.doc_id is not None else -1, x.ids) for x in byte_bpe.encode(docs, PATH).collect())
    assert got == sorted((x[0] if x[0] is not None else -1, library.encode_ordinary(x[1] or "")) for x in rows)
    back = sorted((x.doc_id if x.doc_id is not None else -1, bytes(x.bytes)) for x in byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).collect())
    assert back == sorted((x[0] if x[0] is not None else -1, (x[1] or "").encode()) for x in rows)
    want = []
    for x in rows:
        ids = library.encode_ordinary(x[1] or "")
        want.append((str(x[0]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x[1] or "").encode()).hexdigest()))
    assert sorted((str(x[0]), *x[1:]) for x in byte_bpe.digests(docs, PATH).collect()) == sorted(want)
    assert byte_bpe.digests(docs.limit(0), PATH).collect() == []
    text_ids = byte_bpe.digests(docs.selectExpr("concat('a', doc_id) AS doc_id", "text"), PATH)
    assert text_ids.schema["doc_id"].dataType.simpleString() == "string" and text_ids.count() == len(rows)


def test_decoding_of_odd_lists(spark):
    rows = [(1, [0, 1, 50255]), (2, []), (3, None), (4, [7, None]), (5, [7, 60_000]), (6, [5] * 200_000)]
    got = {x.doc_id: x.bytes for x in byte_bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    c = byte_bpe.coder(PATH)
    named = {i: t for t, i in c.ranks.items()}
    assert got == {1: named[0] + named[1] + named[50255], 2: b"", 3: None, 4: None, 5: None, 6: named[5] * 200_000}


def test_stretches_of_a_long_text_and_forgotten_pieces(spark, library, monkeypatch):
    text = " ".join(texts(9, 3000)) + "\n\n  end"
    want = library.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "STRETCH", 1000)
    parts = list(byte_bpe.stretches(text))
    assert len(parts) > 10 and "".join(parts) == text
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 500)
    c = byte_bpe.Coder(PATH)
    ids, n = byte_bpe._encoded(c, [parts])
    assert ids.tolist() == want and n.tolist() == [len(want)]
    ids, n = byte_bpe._encoded(c, [parts, ["one"], parts])
    assert ids.tolist() == [*want, *library.encode_ordinary("one"), *want]
