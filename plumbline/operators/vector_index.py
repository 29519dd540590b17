"""An approximate index of vectors: inverted lists over k-means cells, product-quantised residuals, exact scores at the end.

A vector belongs to the cell with the nearest centre. Beside it stands a short code: its difference to the centre, cut into parts of
PART_NUMBERS numbers, each named by the nearest of up to CODES patterns. A search reads the lists of the cells nearest to a question,
estimates distances from the codes by table look-up, and computes exact scores for the best `refine` times k only. Centres and patterns
are fitted on a sample of about SAMPLE_ROWS vectors, chosen by hash of the id; every vector is indexed. Lists lie in files sorted by
cell, so that a search skips the others; a list longer than LIST_ROWS is cut into parts that different tasks read.

For `cosine` vectors are scaled to length 1, where the nearest by distance are those with the highest cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.topk import SCORE_DIGITS, BestK
from plumbline.operators.search import BLOCK_NUMBERS, MAX_SENT_NUMBERS, best_batch, best_schema, matrix_of, ranked, unit_rows
from plumbline.schemas import TOP_K
from plumbline.sources.tables import materialize

SAMPLE_ROWS = 50_000
# At most this many cells, whose centres are sent to all tasks.
MAX_CELLS = 4096
CODES = 256
PART_NUMBERS = 4
ROUNDS = 12
LIST_ROWS = 1_000_000
# A question is asked in as many cells as hold this share of the nearest CALIBRATED neighbours of sampled vectors.
TARGET = 0.98
CALIBRATED = 10
CALIBRATION_ROWS = 400
REFINE = 20
SEED = 11


def k_means(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of at most k clusters. A cluster that loses all its rows starts again at the row that is farthest from its centre."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.permutation(len(rows))[:k]].copy()
    for _ in range(ROUNDS):
        near, distance = nearest_rows(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        counts = np.bincount(near, minlength=len(centres))
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
        empty = np.flatnonzero(~filled)
        centres[empty] = rows[np.argsort(distance)[::-1][:len(empty)]]
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a column for each centre."""
    return np.maximum((rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1), 0)


def nearest_rows(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, squared distance to it) of each row, block by block."""
    step = max(1, BLOCK_NUMBERS // max(1, len(centres)))
    near, least = [np.zeros(0, np.int64)], [np.zeros(0)]
    for start in range(0, len(rows), step):
        block = distances(rows[start:start + step], centres)
        near.append(block.argmin(axis=1))
        least.append(block.min(axis=1))
    return np.concatenate(near), np.concatenate(least)


@dataclass(frozen=True)
class Quantizer:
    """Centres (cells x numbers) and patterns (parts x codes x PART_NUMBERS); vectors are filled up with zeros to whole parts.

    `probes` is the number of cells that a question is usually asked in.
    """

    centres: np.ndarray
    patterns: np.ndarray
    metric: str
    probes: int

    def prepared(self, rows: np.ndarray) -> np.ndarray:
        rows = unit_rows(rows) if self.metric == "cosine" else rows
        return np.pad(rows, ((0, 0), (0, self.centres.shape[1] - rows.shape[1])))

    def parts(self, rows: np.ndarray) -> np.ndarray:
        return rows.reshape(len(rows), -1, PART_NUMBERS)

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, code) of prepared rows."""
        cells, _ = nearest_rows(rows, self.centres)
        rest = self.parts(rows - self.centres[cells])
        codes = [nearest_rows(rest[:, p], patterns)[0] for p, patterns in enumerate(self.patterns)]
        return cells, np.stack(codes, axis=1).astype(np.uint8)

    def probed(self, questions: np.ndarray, count: int) -> np.ndarray:
        """The cells nearest to each prepared question."""
        return np.argsort(distances(questions, self.centres), axis=1, kind="stable")[:, :count]

    def estimates(self, question: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of a question to the vectors of a cell, as their codes tell them."""
        rest = self.parts((question - self.centres[cell])[None])[0]
        table = ((self.patterns - rest[:, None, :]) ** 2).sum(axis=2)
        return table[np.arange(len(table)), codes].sum(axis=1)


def fit(sample: np.ndarray, cells: int, metric: str) -> Quantizer:
    """Centres and patterns for vectors like those of the sample."""
    rows = unit_rows(sample) if metric == "cosine" else sample
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % PART_NUMBERS)))
    centres = k_means(rows, cells, SEED)
    near = nearest_rows(rows, centres)[0]
    rest = (rows - centres[near]).reshape(len(rows), -1, PART_NUMBERS)
    patterns = np.stack([k_means(rest[:, p], CODES, SEED + p) for p in range(rest.shape[1])])
    return Quantizer(centres, patterns, metric, calibrated(rows, near, centres))


def calibrated(rows: np.ndarray, near: np.ndarray, centres: np.ndarray) -> int:
    """How many cells, nearest first, hold TARGET of the nearest neighbours of some of the rows among all of them.

    Vectors in clusters need few cells; without any structure most cells must be asked for this.
    """
    asked = rows[:CALIBRATION_ROWS]
    k = min(CALIBRATED, len(rows) - 1)
    if k < 1:
        return 1
    apart = distances(asked, rows)
    apart[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    neighbours = np.argpartition(apart, k - 1, axis=1)[:, :k]
    order = np.argsort(np.argsort(distances(asked, centres), axis=1, kind="stable"), axis=1)  # the place of each cell for each row
    places = np.sort(np.take_along_axis(order, near[neighbours], axis=1).reshape(-1))
    return int(places[min(len(places) - 1, int(np.ceil(TARGET * len(places))) - 1)]) + 1


@dataclass(frozen=True)
class VectorIndex:
    """`lists`: cell, part, document_id, code, vector."""

    lists: DataFrame
    quantizer: Quantizer | None

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        stored = spark.read.parquet(f"{path}/quantizer").first()
        quantizer = None
        if stored["centres"]:
            shape = (stored["cells"], -1)
            centres = np.frombuffer(stored["centres"]).reshape(shape)
            patterns = np.frombuffer(stored["patterns"]).reshape(centres.shape[1] // PART_NUMBERS, -1, PART_NUMBERS)
            quantizer = Quantizer(centres, patterns, stored["metric"], stored["probes"])
        return cls(spark.read.parquet(f"{path}/lists"), quantizer)


def sampled(searched: DataFrame, n: int, sample_rows: int) -> np.ndarray:
    """About `sample_rows` vectors, by hash of the id; at most twice as many reach the driver."""
    steps = 1 << 20
    take = math.ceil(steps * min(1.0, sample_rows / max(n, 1)))
    chosen = searched.filter(F.pmod(F.xxhash64("document_id"), F.lit(steps)) < take).limit(2 * sample_rows)
    rows = chosen.select("document_id", "vector").toArrow().sort_by("document_id")
    return matrix_of(rows.column("vector").combine_chunks()) if len(rows) else np.zeros((0, 0))


def build(documents: DataFrame, path: str, *, document_id: str = "document_id", vector: str = "vector", metric: str = "cosine",
          cells: int | None = None, sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS) -> VectorIndex:
    """Index all rows that have an id and a vector, replacing what is in the folder. Ids must be unique."""
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = documents.sparkSession
    searched = documents.select(F.col(document_id).alias("document_id"), F.col(vector).alias("vector"))
    searched = searched.filter("document_id IS NOT NULL AND vector IS NOT NULL")
    n = searched.count()
    sample = sampled(searched, n, sample_rows)
    quantizer = None
    if len(sample):
        most = min(MAX_CELLS, max(1, MAX_SENT_NUMBERS // sample.shape[1]))
        quantizer = fit(sample, min(cells or round(math.sqrt(n)) or 1, most), metric)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cell, codes = quantizer.encode(quantizer.prepared(matrix_of(batch.column("vector"))))
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *batch.columns, packed], ["cell", "document_id", "vector", "code"])

    kinds = {f.name: f.dataType.simpleString() for f in searched.schema}
    schema = f"cell int, document_id {kinds['document_id']}, vector {kinds['vector']}, code binary"
    coded = materialize(searched.mapInArrow(run, schema), "coded")
    lengths = F.broadcast(coded.groupBy("cell").agg(F.ceil(F.count("*") / list_rows).alias("parts")))  # at most MAX_CELLS rows
    part = F.pmod(F.xxhash64("document_id"), F.col("parts")).cast("int")
    lists = coded.join(lengths, "cell").select("cell", part.alias("part"), "document_id", "code", "vector")
    lists = lists.repartitionByRange("cell", "part").sortWithinPartitions("cell", "part", "document_id")
    lists.write.mode("overwrite").parquet(f"{path}/lists")
    stored = (len(quantizer.centres), bytes(quantizer.centres.tobytes()), bytes(quantizer.patterns.tobytes()), quantizer.probes) if quantizer else (0, b"", b"", 0)
    spark.createDataFrame([(*stored, metric)], "cells int, centres binary, patterns binary, probes int, metric string").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/quantizer")
    return VectorIndex.open(spark, path)


def search(index: VectorIndex, questions: DataFrame, *, k: int = TOP_K, question_id: str = "question_id", vector: str = "vector",
           probes: int | None = None, refine: int = REFINE, max_sent: int = MAX_SENT_NUMBERS) -> DataFrame:
    """(question_id, document_id, rank, score): nearly always the k documents nearest to each question, scored exactly.

    `probes` is the number of cells that each question is asked in, by default as many as the sample called for; asked in all of them, and with all documents refined, the result
    is exact. Questions are sent to the tasks in blocks of at most `max_sent` numbers.
    """
    asked = questions.select(F.col(question_id).alias("question_id"), F.col(vector).alias("vector")).filter("vector IS NOT NULL")
    asked = materialize(asked, "questions")
    out = best_schema(asked, index.lists)
    if index.quantizer is None:
        return ranked(asked.sparkSession.createDataFrame([], out), k)
    cells, numbers = index.quantizer.centres.shape
    probes = min(cells, probes or index.quantizer.probes)
    # A question, its row of cell numbers, and the documents to be refined.
    blocks = max(1, -(-asked.count() * (numbers + probes + k * refine) // max_sent))
    found = None
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == block) if blocks > 1 else asked
        hits = _search_block(index, mine, k, probes, refine, out)
        found = hits if found is None else found.unionByName(hits)
    return ranked(found, k)


def _search_block(index: VectorIndex, asked: DataFrame, k: int, probes: int, refine: int, out) -> DataFrame:
    quantizer, arrow = index.quantizer, to_arrow_schema(out)
    sent = asked.toArrow()  # bounded by the caller
    ids = sent.column("question_id").to_pylist()
    if not ids:
        return asked.sparkSession.createDataFrame([], out)
    matrix = matrix_of(sent.column("vector").combine_chunks())
    wanted = quantizer.prepared(matrix)
    probed = quantizer.probed(wanted, probes)
    askers = {int(cell): np.flatnonzero((probed == cell).any(axis=1)) for cell in np.unique(probed)}
    lists = index.lists.filter(F.col("cell").isin(sorted(askers)))

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestK(len(ids), k * refine)
        step = max(1, BLOCK_NUMBERS // len(ids))
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                cell, names = (part.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "document_id"))
                codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(part), -1)
                scores = np.full((len(part), len(ids)), -np.inf)
                for one in np.unique(cell):
                    rows = np.flatnonzero(cell == one)
                    for question in askers[int(one)]:
                        scores[rows, question] = -quantizer.estimates(wanted[question], one, codes[rows])
                best.add(scores, names)
        yield best_batch(best, ids, arrow)

    near = ranked(lists.select("cell", "document_id", "code").mapInArrow(estimate, out), k * refine).select("question_id", "document_id")
    place = {question: i for i, question in enumerate(ids)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = matrix[[place[q] for q in batch.column("question_id").to_pylist()]]
                rows = matrix_of(batch.column("vector"))
                if quantizer.metric == "cosine":
                    scores = (unit_rows(rows) * unit_rows(own)).sum(axis=1)
                else:
                    scores = -np.sqrt(((rows - own) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([batch.column("question_id"), batch.column("document_id"), pa.array(np.round(scores, SCORE_DIGITS))], schema=arrow)

    # At most k * refine rows a question of a block: bounded by max_sent.
    pairs = lists.select("document_id", "vector").join(F.broadcast(near), "document_id")
    return pairs.select("question_id", "document_id", "vector").mapInArrow(score, out)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(question_id, n, hits, recall): how many of the exact documents of each question were found."""
    met = exact.select("question_id", "document_id").join(
        found.select("question_id", "document_id", F.lit(1).alias("hit")), ["question_id", "document_id"], "left",
    )
    counts = met.groupBy("question_id").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"))
    return counts.withColumn("recall", F.col("hits") / F.col("n"))
