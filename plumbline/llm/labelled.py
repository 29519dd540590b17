"""What the two text classifiers share: the split by id, the bounded sample to learn from, and fitting it in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Learned from: at most SAMPLE_ROWS documents of each label, each of at most SAMPLE_CHARS characters.
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000

Model = dict[str, np.ndarray]


def held_out(id_col: str, folds: int = 5) -> Column:
    """Whether the remainder of the CRC-32 of the id as text is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def sample(
    documents: DataFrame, labels: DataFrame, label: str, *, id_col: str, text: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """(id, label, text) of the rows to learn from: of each label those with the least hashes of their ids, none held out.

    An id with several labels has the greatest; ids without a label (0 or 1) are left out. Ids are chosen among those with a text within
    the bound, so that long texts make no gaps; of several such texts of one id the one with the least hash counts.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(
        F.max(label).cast("int").alias("label"),
    )
    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.filter(F.char_length("text") <= chars).withColumn("hash", F.xxhash64("text"))
    fitting = known.join(texts.groupBy("id").agg(F.min("hash").alias("hash")), "id")
    chosen = [fitting.filter(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(rows) for v in (0, 1)]
    return texts.join(chosen[0].union(chosen[1]), ["id", "hash"]).select("id", "label", "text").dropDuplicates(["id"])


def fit_in_task(rows: DataFrame, fit: Callable[[list[str], np.ndarray], Model]) -> Model:
    """Fit a model on a bounded sample (id, label, text) in one task; only the model goes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((i, y, t) for b in batches for i, y, t in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
        model = fit([t for _, _, t in found], np.array([y for _, y, _ in found], dtype=np.float64))
        names = sorted(model)
        arrays = [np.ascontiguousarray(model[n]) for n in names]
        yield pa.RecordBatch.from_arrays([
            pa.array(names), pa.array([str(a.dtype) for a in arrays]), pa.array([list(a.shape) for a in arrays], type=pa.list_(pa.int64())),
            pa.array([a.tobytes() for a in arrays], type=pa.binary()),
        ], ["name", "kind", "shape", "data"])

    stored = rows.repartition(1).mapInArrow(run, "name string, kind string, shape array<bigint>, data binary").collect()
    return {r["name"]: np.frombuffer(bytes(r["data"]), dtype=r["kind"]).reshape(r["shape"]) for r in stored}


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))
