"""Dense vectors of texts: a truncated singular value decomposition of their TF-IDF rows, so that texts without a common word can meet.

Terms are hashed with a sign to SLOTS columns, so that the matrix has the same width for any vocabulary and no term is left out. The
leading right singular vectors come from subspace iteration with a random start: a round is one pass over the documents, in which every task
multiplies its rows with the current basis and adds up the products by slot. The basis (SLOTS x rank numbers) is what tasks get and what comes
back; documents are never gathered. Terms are hashed once, before the rounds. Products are formed for BLOCK_ENTRIES entries at a time, so that
the memory of a task depends neither on the length of documents nor on their number. A new text needs the basis only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.search import TextIndex, index_once, weighed
from plumbline.sources.tables import materialize

SLOTS = 1 << 15
RANK = 32
# More columns than wanted make the leading ones exact sooner.
SPARE = 8
ROUNDS = 4
SEED = 5
# Entries of rows that are multiplied at once.
BLOCK_ENTRIES = 1 << 14


@dataclass(frozen=True)
class Basis:
    """Right singular vectors (slots x rank) and singular values, largest first."""

    vectors: np.ndarray
    values: np.ndarray


def slots(terms: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(column, sign) of each term."""
    coded = terms.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(t, SEED) for t in coded.dictionary.to_pylist()], dtype=np.uint64)
    own = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(terms) else np.empty(0, np.uint64)
    return (own % np.uint64(width)).astype(np.int64), np.where(own >> np.uint64(63), -1.0, 1.0)


def products(basis: np.ndarray, columns: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows, given as runs of (column, weight), times the basis."""
    out = np.zeros((len(sizes), basis.shape[1]))
    add_runs(out, np.repeat(np.arange(len(sizes)), sizes), basis, columns, weights)
    return out


def add_runs(sums: np.ndarray, at: np.ndarray, values: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> None:
    """Add weight times row of `values` to sums[at], for ascending `at`."""
    for start in range(0, len(at), BLOCK_ENTRIES):  # a block fits into the cache
        cut = slice(start, start + BLOCK_ENTRIES)
        scaled = values[rows[cut]]
        scaled *= weights[cut, None]
        own = at[cut]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums[own[heads]] += np.add.reduceat(scaled, heads, axis=0)


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, weights, sizes) of unit rows from (…, norm, columns, weights)."""
    norm = batch.column("norm").to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(batch.column("columns")).to_numpy(zero_copy_only=False).astype(np.int64)
    columns, weights = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("columns", "weights"))
    return columns, weights / np.repeat(np.where(norm > 0, norm, 1.0), sizes), sizes


def _gathered(weighted: DataFrame, key: str, keys: str) -> DataFrame:
    """(document_id, norm, keys, weights) of (document_id, key, w). The norm is that of the index, taken in the same pass."""
    told = weighted.groupBy("document_id").agg(F.collect_list(F.struct(key, "w")).alias("s"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return told.select("document_id", "norm", F.col(f"s.{key}").alias(keys), F.col("s.w").alias("weights"))


def rows_of(index: TextIndex, n_postings: int, max_hot: int) -> DataFrame:
    """(document_id, norm, keys, weights): the weighted terms of each document that has one."""
    return _gathered(weighed(index.postings, index.terms, n_postings, max_hot), "term", "keys")


def hashed(terms: DataFrame, width: int) -> DataFrame:
    """Add the slot and the sign of each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, sign = slots(batch.column("term"), width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slot.astype(np.int32)), pa.array(sign)], [*batch.schema.names, "slot", "sign"])

    return terms.select("term", "df", "idf").mapInArrow(run, "term string, df bigint, idf double, slot int, sign double")


def hashed_rows(index: TextIndex, n_postings: int, max_hot: int, width: int) -> DataFrame:
    """(document_id, norm, columns, weights): rows_of with signed slots for terms, so that no term is shuffled to its document or hashed twice."""
    terms = materialize(hashed(index.terms, width), "slots")
    signed = weighed(index.postings, terms, n_postings, max_hot).select("document_id", "slot", (F.col("w") * F.col("sign")).alias("w"))
    return _gathered(signed, "slot", "columns")


def _placed(place: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """(place, sums): the given rows of a table of sums."""
    values = pa.array(sums.reshape(-1))
    lists = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, sums.shape[1], dtype=np.int32), values)
    return pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), lists], ["place", "sums"])


def _summed(places: int, rank: int):
    """Add up the rows of each place that meet in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((places, rank)), np.zeros(places, dtype=bool)
        for batch in batches:
            place = batch.column("place").to_numpy(zero_copy_only=False)
            order = np.argsort(place, kind="stable")
            add_runs(total, place[order], batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(-1, rank), order, np.ones(len(order)))
            seen[place] = True
        found = np.flatnonzero(seen)
        if len(found):
            yield _placed(found, total[found])

    return run


def _round(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows' transpose times rows times the basis, Gram matrix of rows times the basis)."""
    width, rank = basis.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, gram = np.zeros((width, rank)), np.zeros((rank, rank))
        for batch in batches:
            columns, weights, sizes = unpack(batch)
            image = products(basis, columns, weights, sizes)
            gram += image.T @ image
            # Entries are added up column by column: sorted by column, each is the product of a weight and its row's image.
            order = np.argsort(columns, kind="stable")
            add_runs(sums, columns[order], image, np.repeat(np.arange(len(sizes)), sizes)[order], weights[order])
        touched = np.flatnonzero(sums.any(axis=1))
        yield _placed(np.concatenate([touched, width + np.arange(rank)]), np.concatenate([sums[touched], gram]))

    parts = rows.select("norm", "columns", "weights").mapInArrow(run, "place bigint, sums array<double>")
    found = parts.repartition("place").mapInArrow(_summed(width + rank, rank), parts.schema).toArrow()  # at most SLOTS + rank rows
    total = np.zeros((width + rank, rank))
    if len(found):
        total[found.column("place").to_numpy()] = np.stack(found.column("sums").to_numpy(zero_copy_only=False))
    return total[:width], total[width:]


def fit(rows: DataFrame, *, rank: int = RANK, width: int = SLOTS, rounds: int = ROUNDS) -> Basis:
    """The leading singular vectors of stored rows (norm, columns, weights), scaled to length 1."""
    draw = np.random.default_rng(SEED)
    basis = np.linalg.qr(draw.normal(size=(width, min(width, rank + SPARE))))[0]
    for _ in range(rounds):
        image, _ = _round(rows, basis)
        if not image.any():
            break
        basis = np.linalg.qr(image)[0]
    _, gram = _round(rows, basis)
    values, turn = np.linalg.eigh(gram)
    first = np.argsort(values)[::-1][:rank]
    return Basis(basis @ turn[:, first], np.sqrt(np.maximum(values[first], 0)))


def embed(rows: DataFrame, basis: Basis) -> DataFrame:
    """(document_id, vector) of rows (document_id, norm, columns, weights)."""
    id_type = rows.schema["document_id"].dataType.simpleString()
    rank = basis.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            image = pa.array(products(basis.vectors, *unpack(batch)).reshape(-1))
            lists = pa.ListArray.from_arrays(np.arange(0, len(image) + 1, rank, dtype=np.int32), image)
            yield pa.RecordBatch.from_arrays([batch.column("document_id"), lists], ["document_id", "vector"])

    return rows.select("document_id", "norm", "columns", "weights").mapInArrow(run, f"document_id {id_type}, vector array<double>")


def document_vectors(documents: DataFrame, *, document_id: str = "document_id", text: str = "text", rank: int = RANK, width: int = SLOTS,
                     rounds: int = ROUNDS, max_hot_terms: int = 100_000) -> tuple[DataFrame, Basis]:
    """((document_id, vector) of the documents that have a weighted term, the basis)."""
    index = index_once(documents, document_id=document_id, text=text)
    rows = materialize(hashed_rows(index, index.postings.count(), max_hot_terms, width), "rows")  # read once a round
    basis = fit(rows, rank=rank, width=width, rounds=rounds)
    return embed(rows, basis), basis
