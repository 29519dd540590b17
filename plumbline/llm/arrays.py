"""Texts as byte arrays: word boundaries and hashes of whole Arrow batches, for code that runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Bytes of text that one slice of a batch holds at most; a longer text forms a slice of its own.
SLICE_BYTES = 1 << 20
# Words beyond this many bytes are hashed one by one.
LONG_WORD = 64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows. A null is an empty text; offsets count from the slice's first byte."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1)
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, whole[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of bytes that are not ASCII white space; a run ends where its text ends."""
    inside = ~SPACE[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[-1] = True
    edge[:1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    keep = inside[cuts[:-1]] if len(data) else np.zeros(0, dtype=bool)
    starts, ends = cuts[:-1][keep], cuts[1:][keep]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def eights(data: np.ndarray) -> np.ndarray:
    """At each position the eight bytes from there on as one number; zeros follow the last byte."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each run, eight bytes at a time for all runs together."""
    blocks = eights(data)
    lengths = ends - starts
    value = mixed(lengths.astype(np.uint64) + np.uint64(seed))
    rest, at, who = lengths, starts, slice(None)
    for k in range(0, LONG_WORD, 8):
        if k:
            who = np.flatnonzero((lengths > k) & (lengths <= LONG_WORD))
            if not len(who):
                break
            rest, at = lengths[who] - k, starts[who] + k
        block = blocks[at]
        short = np.minimum(rest, 8).astype(np.uint64) * np.uint64(8)
        block &= np.where(short == 64, ~np.uint64(0), (np.uint64(1) << (short & np.uint64(63))) - np.uint64(1))
        value[who] = mixed(value[who] ^ block)
    for i in np.flatnonzero(lengths > LONG_WORD):
        value[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), seed)
    return value


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _MIX
    value = (value ^ (value >> np.uint64(29))) * _MIX2
    return value ^ (value >> np.uint64(32))


def distinct_runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one run of each kind, kind of each run)."""
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    return first, kind


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … of all runs, one run after the other."""
    total = int(lengths.sum())
    step = np.ones(total, dtype=np.int64)
    filled = np.flatnonzero(lengths)
    if not len(filled):
        return step
    at = np.cumsum(lengths[filled])[:-1]
    step[0] = starts[filled[0]]
    step[at] = starts[filled[1:]] - starts[filled[:-1]] - lengths[filled[:-1]] + 1
    return np.cumsum(step)
