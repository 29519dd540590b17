"""Byte-level BPE: whole texts to token ids with character offsets, and back to bytes.

A text is cut where letters, digits and other marks meet, and where a single space or line break stands between two other
characters. The split pattern of the vocabulary has a boundary there in any context, so equal pieces have equal tokens; each
distinct piece is encoded once by the tokenizers library, and numpy puts the ids of a text together. Decoding looks up the bytes of
each id through the byte table of the vocabulary. A character that is split over tokens is restored by joining bytes before they are read as UTF-8.

Null text: empty, no tokens. Empty text: no tokens. Repeated rows: each is encoded. Strings that look like special tokens are
ordinary text. Columns of the input stay; columns with the name of a result are replaced.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import SPACE, distinct_runs, gather, hash_runs, text_slices

# First bytes of the UTF-8 forms of white space beyond ASCII; no cut is made before such a byte.
WIDE_SPACE = np.zeros(256, dtype=bool)
WIDE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True

# Kind of each byte for the cuts; an apostrophe is left to the pattern, which knows contractions.
KIND = np.zeros(256, dtype=np.uint8)
KIND[0x21:0x7F] = 3
KIND[[0x27]] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KIND[0x30:0x3A] = 2

# Pieces that a worker remembers, about 40 bytes each.
KNOWN = 250_000

PACKED = "n_tokens:bigint,packed_ids:binary"
LISTS = "ids:array<bigint>,starts:array<int>,ends:array<int>"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = {}, 256
    for byte in range(256):
        if byte in printable:
            table[chr(byte)] = byte
        else:
            table[chr(spare)] = byte
            spare += 1
    return table


BYTE_NAMES = {byte: ord(name) for name, byte in byte_characters().items()}


@functools.cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all tokens one after the other, offset of each id): the reversed byte table of the vocabulary."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    table = byte_characters()
    names = {i: bytes(table[c] for c in token) for token, i in stored["model"]["vocab"].items()}
    names |= {t["id"]: t["content"].encode() for t in stored.get("added_tokens", [])}
    each = [names.get(i, b"") for i in range(max(names) + 1)]
    offsets = np.zeros(len(each) + 1, dtype=np.int64)
    np.cumsum([len(b) for b in each], out=offsets[1:])
    return np.frombuffer(b"".join(each), dtype=np.uint8), offsets


def kinds(data: np.ndarray) -> np.ndarray:
    """1 letter, 2 digit, 3 other mark; 0 for what only the whole pattern can tell. Latin-1 letters of two bytes are letters."""
    kind = KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    return kind


def pieces(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Places where a piece starts, the end of the last one included.

    Besides the texts' ends there is a cut where letters, digits and marks meet, before a single space and around a single line break.
    """
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    cut[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    if len(data) > 2:
        blank = SPACE[data]
        alone = blank[1:-1] & ~blank[:-2] & ~blank[2:] & ~WIDE_SPACE[data[2:]]
        cut[1:-2] |= alone & ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A))
        cut[2:-1] |= alone & (data[1:-1] == 0x0A)
    return np.flatnonzero(cut)


class KnownPieces:
    """Ids of pieces seen by this worker, by hash, up to KNOWN pieces; later ones are encoded in each slice anew."""

    def __init__(self):
        self.hashes, self.sizes, self.at, self.ids = (np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.uint32))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where unknown."""
        place = np.searchsorted(self.hashes, wanted)
        place[place == len(self.hashes)] = 0
        return np.where(self.hashes[place] == wanted, place, -1) if len(self.hashes) else np.full(len(wanted), -1)

    def add(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        if len(self.hashes) >= KNOWN:
            return
        at = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        merged = np.concatenate([self.hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        self.sizes, self.at = np.concatenate([self.sizes, sizes])[order], np.concatenate([self.at, at])[order]


@functools.cache
def known_pieces(path: str) -> KnownPieces:
    return KnownPieces()


def tokens_of(raw: bytes, plain: bool, path: str) -> list[int]:
    """Ids of one piece. A plain piece is one match of the pattern, so the merges apply to it as it is."""
    if plain:
        return [t.id for t in tokenizer(path).model.tokenize(raw.decode("latin-1").translate(BYTE_NAMES))]
    return tokenizer(path).encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids


def encode_slice(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offset of each text in them)."""
    if not len(data):
        return np.empty(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
    kind = kinds(data)
    cuts = pieces(data, offsets, kind)
    starts, ends = cuts[:-1], cuts[1:]
    unclear = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(kind == 0, out=unclear[1:])
    begin = starts + ((data[starts] == 0x20) & (ends - starts > 1))
    plain = unclear[ends] == unclear[begin]
    hashes = hash_runs(data, starts, ends)
    first, which = distinct_runs(hashes)
    known = known_pieces(path)
    new = np.flatnonzero(known.find(hashes[first]) < 0)
    pick = first[new]
    raw = data.tobytes()
    made = [
        tokens_of(raw[a:b], p, path) for a, b, p in zip(starts[pick].tolist(), ends[pick].tolist(), plain[pick].tolist(), strict=True)
    ]
    sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
    ids = np.fromiter((i for m in made for i in m), dtype=np.uint32, count=int(sizes.sum()))
    at, length = np.empty(len(first), dtype=np.int64), np.empty(len(first), dtype=np.int64)
    old = np.setdiff1d(np.arange(len(first)), new, assume_unique=True)
    place = known.find(hashes[first[old]])
    at[old], length[old] = known.at[place], known.sizes[place]
    at[new], length[new] = len(known.ids) + np.cumsum(sizes) - sizes, sizes
    pool = np.concatenate([known.ids, ids])
    known.add(hashes[pick], sizes, ids)
    total = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(length[which], out=total[1:])
    return pool[gather(at[which], length[which])], total[np.searchsorted(starts, offsets)]


def character_offsets(data: np.ndarray, ids: np.ndarray, bounds: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(first, behind the last) character of each token in its text. Tokens that share a split character all cover it."""
    _, places = token_bytes(path)
    stop = np.cumsum(places[ids + 1] - places[ids])
    begin = stop - (places[ids + 1] - places[ids])
    chars = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    base = np.repeat(chars[offsets[:-1]], np.diff(bounds))
    return chars[begin + 1] - 1 - base, chars[stop] - base


def lists(values: np.ndarray, bounds: np.ndarray, kind: type) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(kind)))


def binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)


def encoder(path: str, with_lists: bool):
    @F.arrow_udf(f"struct<{PACKED},{LISTS}>" if with_lists else f"struct<{PACKED}>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for _, data, offsets in text_slices(texts):
                ids, bounds = encode_slice(data, offsets, path)
                columns = {"n_tokens": pa.array(np.diff(bounds)), "packed_ids": binaries(ids.astype("<u4"), bounds * 4)}
                if with_lists:
                    begin, stop = character_offsets(data, ids, bounds, offsets, path)
                    columns |= {
                        "ids": lists(ids, bounds, np.int64), "starts": lists(begin, bounds, np.int32), "ends": lists(stop, bounds, np.int32),
                    }
                parts.append(pa.StructArray.from_arrays(list(columns.values()), list(columns)))
            yield pa.concat_arrays(parts)

    return encode


def decoder(path: str):
    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, places = token_bytes(path)
        for packed in batches:
            parts = []
            for _, data, offsets in text_slices(packed):
                ids = np.frombuffer(data.tobytes(), dtype="<u4").astype(np.int64)
                lengths = places[ids + 1] - places[ids]
                total = np.zeros(len(ids) + 1, dtype=np.int64)
                np.cumsum(lengths, out=total[1:])
                parts.append(binaries(table[gather(places[ids], lengths)], total[offsets // 4]))
            yield pa.concat_arrays(parts)

    return decode


def encode(documents: DataFrame, text: str = "text", *, vocabulary: str | None = None, offsets: bool = True) -> DataFrame:
    """Add n_tokens and packed_ids (little-endian unsigned 32-bit numbers); with `offsets` also the lists ids, starts and ends.

    starts and ends are the character offsets of each token in its text.
    """
    path = vocabulary or default_vocabulary()
    names = ["n_tokens", "packed_ids"] + ["ids", "starts", "ends"] * offsets
    done = documents.withColumn("_bpe", encoder(path, offsets)(F.make_valid_utf8(F.coalesce(F.col(text), F.lit("")))))
    return done.withColumns({n: F.col(f"_bpe.{n}") for n in names}).drop("_bpe")


def decode(encoded: DataFrame, ids: str = "packed_ids", *, vocabulary: str | None = None) -> DataFrame:
    """Add decoded_bytes and decoded_text, which has the replacement character where the bytes are not UTF-8."""
    restored = encoded.withColumn("decoded_bytes", decoder(vocabulary or default_vocabulary())(F.coalesce(F.col(ids), F.lit(b""))))
    return restored.withColumn("decoded_text", F.decode("decoded_bytes", "UTF-8"))


def digests(documents: DataFrame, *, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes."""
    done = decode(encode(documents.select("doc_id", "text"), vocabulary=vocabulary, offsets=False), vocabulary=vocabulary)
    return done.select(
        "doc_id", "n_tokens", F.sha2("packed_ids", 256).alias("ids_sha256"), F.sha2("decoded_bytes", 256).alias("decoded_sha256"),
    )
