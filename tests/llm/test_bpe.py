"""Byte-level BPE against the tiktoken library, offsets against the text, and the round trip."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from plumbline.llm import bpe
from plumbline.llm.arrays import text_slices

MARKS = [
    " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "a", "b's", "'ll", "é", "ñ", "日本", " ", "　", " ", "\x85", "1", "22", "!", "...",
    "_", "<|endoftext|>", "😀", "é", "\x1c", "​", "ſ", "\x00", "×", "÷", "ÿ",
]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    found = []
    for _, data, offsets in text_slices(pa.array(texts, pa.string())):
        ids, bounds = bpe.encode_slice(data, offsets, bpe.default_vocabulary())
        found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return found


def test_ids_equal_the_library(library):
    draw = random.Random(4)
    texts = ["".join(draw.choice(MARKS) for _ in range(draw.randint(0, 14))) for _ in range(20_000)]
    wrong = [t for t, ids in zip(texts, encoded(texts), strict=True) if ids != library.encode_ordinary(t)]
    assert not wrong


def test_every_character_as_the_library(library):
    texts = [f"a{c}b 1{c}2 {c} {c}{c}x  {c} \n{c}.{c}" for c in map(chr, range(0x3100))]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_remembered_pieces_stay_right_when_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 10)
    bpe.known_pieces.cache_clear()
    texts = ["one two three four five six seven eight nine ten eleven twelve", "two ten thirteen"] * 3
    assert [encoded([t])[0] for t in texts] == [library.encode_ordinary(t) for t in texts]
    bpe.known_pieces.cache_clear()


def test_offsets_and_round_trip(spark, library):
    texts = ["Wörter, 日本語 and 😀!", "", None, "x" * 300_000, " lead", "two\n\nlines", "😀😀", "two\n\nlines"]
    rows = [(i, t, "kept", 9) for i, t in enumerate(texts)] + [(None, "no id", None, None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, ids string, n_tokens int")
    done = {r["doc_id"]: r for r in bpe.decode(bpe.encode(frame)).collect()}
    assert len(done) == len(rows)
    for i, text, *_ in rows:
        row, plain = done[i], text or ""
        assert row["ids"] == library.encode_ordinary(plain)
        assert row["n_tokens"] == len(row["ids"])
        assert np.frombuffer(bytes(row["packed_ids"]), "<u4").tolist() == row["ids"]
        assert bytes(row["decoded_bytes"]) == plain.encode() and row["decoded_text"] == plain
        for token, a, b in zip(row["ids"], row["starts"], row["ends"], strict=True):
            assert library.decode_single_token_bytes(token) in plain[a:b].encode()
    assert done[0]["starts"][0] == 0 and done[0]["ends"][-1] == len(texts[0])


def test_digests(spark, library):
    frame = spark.createDataFrame([(1, "A text, twice."), (1, "A text, twice."), (2, None)], "doc_id long, text string")
    rows = sorted(tuple(r) for r in bpe.digests(frame).collect())
    ids = np.array(library.encode_ordinary("A text, twice."), "<u4").tobytes()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    one = (1, len(ids) // 4, sha(ids), sha(b"A text, twice."))
    assert rows == [one, one, (2, 0, sha(b""), sha(b""))]
    assert bpe.digests(frame.limit(0)).count() == 0
