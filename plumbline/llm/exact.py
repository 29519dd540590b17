"""Exact duplicates by composable polynomial fingerprints.

The fingerprint of a text is a polynomial of its bytes over two prime fields, together with its length. Fingerprints compose:
that of two joined parts is that of the first, times base ** (length of the second), plus that of the second. Chunks of all texts
of a batch are therefore hashed side by side, however long a text is, and each text's fingerprint is the sum of its chunks' ones
shifted by the bytes that follow. Rows with equal fingerprints are then compared chunk by chunk: a group is equal if the least
and the greatest bytes of each chunk agree. The comparison combines in the map tasks, so a hot group sends one row per task and
chunk. Texts whose fingerprints agree but whose bytes differ are grouped by the bytes themselves, so results are exact.

Null and empty texts are equal to each other. Of equal texts the row with the largest id stays; a null id counts as the least.
Of several rows with that id, one stays, chosen by the hash of the row; rows that are equal in every column are the same. All columns
pass through `unique` unchanged, whatever their names; an empty table gives an empty result. Texts may have any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import text_slices
from plumbline.sources.tables import materialize

# Primes below 2 ** 31, so that a product of two residues and sums of many products of a byte fit 64 bits.
PRIMES = (2147483647, 2147483629)
BASE = 1_000_003
# Bytes hashed as one chunk.
HASH_CHUNK = 1024
# Bytes compared at a time.
COMPARE_CHUNK = 64 << 10

# Parts in which the join for the comparison deals the rows of a fingerprint.
SALTS = 16

PRINT = ["_h1", "_h2", "_size"]


def power(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base ** exponents modulo a prime, for all exponents together."""
    result = np.ones(len(exponents), dtype=np.uint64)
    square, rest = np.uint64(base % prime), exponents.astype(np.uint64)
    p = np.uint64(prime)
    while rest.any():
        odd = (rest & np.uint64(1)).astype(bool)
        result[odd] = result[odd] * square % p
        square = square * square % p
        rest >>= np.uint64(1)
    return result


def joined(left: int, right: int, right_size: int, prime: int, base: int = BASE) -> int:
    """The fingerprint of two joined parts."""
    return (left * pow(base, right_size, prime) + right) % prime


def fingerprints(data: np.ndarray, offsets: np.ndarray, primes: tuple[int, ...] = PRIMES, base: int = BASE) -> np.ndarray:
    """The polynomials of each text (a column per prime), from those of its chunks.

    Texts are filled up in front to whole chunks; leading zeros do not change a polynomial, and the length is kept beside it.
    """
    sizes = np.diff(offsets)
    chunks = -(-sizes // HASH_CHUNK)
    ends = np.cumsum(chunks) * HASH_CHUNK
    filled = np.zeros(int(chunks.sum()) * HASH_CHUNK, dtype=np.uint8)
    for stop, a, b in zip(ends.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        filled[stop - (b - a):stop] = data[a:b]
    # A byte times a weight, summed over a chunk, stays below 2 ** 49, so the product is exact in floating point.
    weights = np.stack([power(base, np.arange(HASH_CHUNK), p)[::-1] for p in primes], axis=1).astype(np.float64)
    value = np.empty((len(filled) // HASH_CHUNK, len(primes)), dtype=np.uint64)
    blocks = filled.reshape(-1, HASH_CHUNK)
    for i in range(0, len(blocks), 512):
        value[i:i + 512] = blocks[i:i + 512].astype(np.float64) @ weights
    owner = np.repeat(np.arange(len(sizes)), chunks)
    behind = (np.repeat(np.cumsum(chunks), chunks) - np.arange(len(owner)) - 1) * HASH_CHUNK
    total = np.zeros((len(sizes), len(primes)), dtype=np.uint64)
    for k, prime in enumerate(primes):
        shifted = value[:, k] % np.uint64(prime) * power(base, behind, prime) % np.uint64(prime)
        np.add.at(total[:, k], owner, shifted)
        total[:, k] %= np.uint64(prime)
    return total.astype(np.int64)


def fingerprinter(primes: tuple[int, ...]):
    @F.arrow_udf("struct<h1:bigint,h2:bigint>")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for _, data, offsets in text_slices(texts):
                value = fingerprints(data, offsets, primes)
                parts.append(pa.StructArray.from_arrays([pa.array(value[:, 0]), pa.array(value[:, 1])], ["h1", "h2"]))
            yield pa.concat_arrays(parts)

    return fingerprint


def content(text: Column) -> Column:
    return F.coalesce(text.cast("binary"), F.lit(b""))


def with_fingerprint(rows: DataFrame, text: Column, primes: tuple[int, ...]) -> DataFrame:
    """Add the fingerprint, KEY without _odd."""
    marked = rows.withColumn("_f", fingerprinter(primes)(content(text)))
    return marked.withColumns({"_h1": F.col("_f.h1"), "_h2": F.col("_f.h2"), "_size": F.octet_length(content(text))}).drop("_f")


def clashes(prints: DataFrame, texts: DataFrame, primes: tuple[int, ...]) -> DataFrame:
    """Fingerprints that different texts share, found by comparing the texts of each shared fingerprint chunk by chunk.

    A salt in the join keeps its partitions apart from those of the comparison, so that a hot fingerprint can be split and its
    chunks are compared in the map tasks first.
    """
    shared = prints.groupBy(PRINT).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(PRINT)
    salted = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = with_fingerprint(texts.select("_text"), F.col("_text"), primes).select(*PRINT, content(F.col("_text")).alias("_bytes"))
    met = told.withColumn("_salt", F.floor(F.rand(7) * SALTS).cast("int")).join(salted, [*PRINT, "_salt"], "left_semi")
    last = F.greatest(F.ceil(F.col("_size") / COMPARE_CHUNK).cast("int"), F.lit(1)) - 1
    chunks = met.select(*PRINT, "_bytes", F.explode(F.sequence(F.lit(0), last)).alias("_at")).select(
        *PRINT, "_at", F.substring("_bytes", F.col("_at") * COMPARE_CHUNK + 1, F.lit(COMPARE_CHUNK)).alias("_chunk"),
    )
    compared = chunks.groupBy(*PRINT, "_at").agg(F.min("_chunk").alias("_least"), F.max("_chunk").alias("_most"))
    return compared.filter(F.col("_least") != F.col("_most")).select(PRINT).distinct()


def refined(prints: DataFrame, clashing: DataFrame, digest: Column) -> DataFrame:
    """Add _odd, which tells apart the texts of clashing fingerprints; it is empty for all others."""
    if clashing.isEmpty():
        return prints.withColumn("_odd", F.lit(""))
    return prints.join(clashing.withColumn("_clash", F.lit(True)), PRINT, "left").withColumn(
        "_odd", F.when(F.col("_clash"), digest).otherwise(F.lit("")),
    ).drop("_clash")


def decisions(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """One row per document: the id, keep_id, group_size, kept, text_sha256."""
    slim = documents.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    prints = materialize(
        with_fingerprint(slim, F.col("_text"), primes).select(
            "_id", *PRINT, F.sha2(content(F.col("_text")), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("_row"),
        ), "fingerprints",
    )
    rows = refined(prints, materialize(clashes(prints, slim, primes), "clashes"), F.col("text_sha256"))
    groups = rows.groupBy(*PRINT, "_odd").agg(F.count("*").alias("group_size"), F.max(F.struct("_id", "_row")).alias("_last"))
    return rows.join(groups, [*PRINT, "_odd"]).select(
        F.col("_id").alias(id_col), F.col("_last._id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_last._row")).alias("kept"), "text_sha256",
    )


def unique(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """The row that stays of each group, with all its columns. Copies meet in the map tasks before they are shuffled."""
    slim = documents.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    prints = materialize(with_fingerprint(slim, F.col("_text"), primes).select(PRINT), "fingerprints")
    clashing = materialize(clashes(prints, slim, primes), "clashes")
    # The columns travel in one struct, so that none can have the name of a column added here.
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    own_text = F.col("_row")[text]
    rows = refined(with_fingerprint(whole, own_text, primes), clashing, F.sha2(content(own_text), 256))
    order = F.struct(F.col("_row")[id_col], F.xxhash64("_row"))
    stay = rows.groupBy(*PRINT, "_odd").agg(F.max_by("_row", order).alias("_row"))
    return stay.select("_row.*")
