"""Exact nearest-neighbour search of questions over documents, by vectors or by TF-IDF of texts.

Every task scores its documents against all questions in blocks and passes on only its best k per question; the final rank
runs over those. A set of questions is sent to the tasks only below a checked size; larger sets take a shuffled form with the
same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.text import term_counts
from plumbline.functions.topk import BestK
from plumbline.schemas import TOP_K
from plumbline.sources.tables import materialize

# Questions sent to every task: at most this many numbers (8 bytes each).
MAX_SENT_NUMBERS = 4_000_000
# A collected row of a question counts as this many numbers.
ROW_NUMBERS = 20
# Terms sent to every task. Document frequencies add up to the number of postings, so at most this many terms reach the cut.
MAX_HOT_TERMS = 100_000
# Numbers in one block of scores or products inside a task.
BLOCK_NUMBERS = 4_000_000
# Numbers of either side that one cell of the shuffled form holds, and texts of questions that it scores at a time. A row counts as
# its list's length and ROW_NUMBERS more; a term of a text counts as TERM_NUMBERS.
CELL_NUMBERS = 4_000_000
TERM_NUMBERS = 4
CELL_QUESTIONS = 64
# With at most this many question terms the scan of the postings filters by them.
MAX_PUSHED_TERMS = 1_000


def centroids(vectors: DataFrame, by: str, vector: str) -> DataFrame:
    """The mean vector of each group, aggregated in the map tasks."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return vectors.groupBy(by).agg(vector_to_array(mean).alias(vector))


def ranked(best: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("question_id").orderBy(F.col("score").desc(), F.col("document_id"))
    return best.select("*", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= k)


def best_schema(questions: DataFrame, documents: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("question_id", questions.schema["question_id"].dataType),
        T.StructField("document_id", documents.schema["document_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def best_batch(best: BestK, question_ids: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = best.rows(question_ids)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1.0, norms)


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix."""
    lengths = pc.min_max(pc.list_value_length(vectors)).as_py()
    if lengths["min"] != lengths["max"]:
        raise ValueError(f"vectors differ in length: {lengths}")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), lengths["min"] or 0)


def _score_vectors(best: BestK, questions: np.ndarray, ids: np.ndarray, documents: np.ndarray, metric: str) -> None:
    """Add the scores of some documents, block by block. `l2` scores are negative distances."""
    if metric == "cosine":
        questions = unit_rows(questions)
    step = max(1, BLOCK_NUMBERS // max(1, len(questions) + questions.shape[1]))
    for start in range(0, len(ids), step):
        block = documents[start:start + step]
        if metric == "cosine":
            scores = unit_rows(block) @ questions.T
        else:
            scores = np.column_stack([-np.sqrt(((block - q) ** 2).sum(axis=1)) for q in questions])
        best.add(scores, ids[start:start + step])


def nearest(questions: DataFrame, documents: DataFrame, *, k: int = TOP_K, metric: str = "cosine", question_id: str = "question_id",
            document_id: str = "document_id", vector: str = "vector", max_sent: int = MAX_SENT_NUMBERS) -> DataFrame:
    """(question_id, document_id, rank, score): the k documents nearest to each question, or all if there are fewer.

    `metric` is `cosine` (score = similarity) or `l2` (score = negative distance). Rows without an id or a vector take no part.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    asked = questions.select(F.col(question_id).alias("question_id"), F.col(vector).alias("vector")).filter("vector IS NOT NULL")
    asked = materialize(asked, "questions")  # measured first, then sent or shuffled: computed once
    searched = documents.select(F.col(document_id).alias("document_id"), F.col(vector).alias("vector"))
    searched = searched.filter("document_id IS NOT NULL AND vector IS NOT NULL")
    size = asked.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("numbers")).first()
    out = best_schema(asked, searched)
    if size["numbers"] > max_sent:
        return ranked(_nearest_shuffled(asked, searched, k, metric, out), k)
    arrow = to_arrow_schema(out)
    sent = asked.toArrow()  # at most max_sent numbers
    ids = sent.column("question_id").to_pylist()
    matrix = matrix_of(sent.column("vector").combine_chunks()) if ids else np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestK(len(ids), k)
        for batch in batches:
            if len(batch) and len(ids):
                _score_vectors(best, matrix, batch.column(0).to_numpy(zero_copy_only=False), matrix_of(batch.column(1)), metric)
        yield best_batch(best, ids, arrow)

    return ranked(searched.mapInArrow(run, out), k)


def _grid(asked: DataFrame, searched: DataFrame, lists: str, per_entry: int) -> tuple[DataFrame, DataFrame]:
    """Both sides keyed by (i, j): questions are hashed to rows and documents to columns of a grid, so every pair meets in one
    cell. Hashing is by id, so cells are even whatever the content; a cell holds about CELL_NUMBERS of each side, so that long
    documents make more cells and not larger ones."""
    size = F.coalesce(F.sum(F.size(lists).cast("bigint") * per_entry + ROW_NUMBERS), F.lit(0))
    rows, columns = (max(1, -(-side.agg(size).first()[0] // CELL_NUMBERS)) for side in (asked, searched))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    left = asked.select(F.pmod(F.xxhash64("question_id"), F.lit(rows)).alias("i"), numbers(columns).alias("j"), "*")
    right = searched.select(numbers(rows).alias("i"), F.pmod(F.xxhash64("document_id"), F.lit(columns)).alias("j"), "*")
    return left, right


def _nearest_shuffled(asked: DataFrame, searched: DataFrame, k: int, metric: str, out: T.StructType) -> DataFrame:
    """Each cell of the grid scores its share of both sides and sends on k rows per question."""
    arrow = to_arrow_schema(out)
    left, right = _grid(asked, searched, "vector", 1)

    def cell(questions: pa.Table, documents: pa.Table) -> pa.Table:
        ids = questions.column("question_id").to_pylist()
        best = BestK(len(ids), k)
        if len(questions) and len(documents):
            asked_rows = matrix_of(questions.column("vector").combine_chunks())
            names = documents.column("document_id").to_numpy(zero_copy_only=False)
            _score_vectors(best, asked_rows, names, matrix_of(documents.column("vector").combine_chunks()), metric)
        return pa.Table.from_batches([best_batch(best, ids, arrow)])

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(cell, out)


@dataclass(frozen=True)
class TextIndex:
    """Term statistics of a set of documents: postings (document_id, term, tf), terms (term, df, idf), norms (document_id, norm).

    Weight is tf × ln(N / df); the norm is the length of a document's weight vector.
    """

    postings: DataFrame
    terms: DataFrame
    norms: DataFrame


def weighed(postings: DataFrame, terms: DataFrame, n_postings: int, max_hot: int) -> DataFrame:
    """Join postings with (term, df, idf) without a hot key in the shuffle; a term that `terms` lacks is left out.

    Terms at or above the cut are few by construction and are sent to the tasks; each remaining term has fewer postings than
    the cut, so the shuffle by term is even.
    """
    cut = n_postings // max_hot + 1
    hot = terms.filter(F.col("df") >= cut).drop("df")
    cold = terms.filter(F.col("df") < cut).drop("df")
    joined = postings.join(F.broadcast(hot), "term")
    if cut > 1:
        joined = joined.unionByName(postings.join(F.broadcast(hot.select("term")), "term", "left_anti").join(cold, "term"))
    return joined.withColumn("w", F.col("tf") * F.col("idf")).drop("tf", "idf")


def open_index(spark: SparkSession, path: str) -> TextIndex:
    return TextIndex(*(spark.read.parquet(f"{path}/{part}") for part in ("postings", "terms", "norms")))


def _terms(postings: DataFrame, n_documents: int) -> DataFrame:
    frequencies = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return frequencies.select("term", "df", F.log(F.lit(float(n_documents)) / F.col("df")).alias("idf"))


def _norms(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy("document_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def _searched(documents: DataFrame, document_id: str, text: str) -> DataFrame:
    return documents.select(F.col(document_id).alias("document_id"), F.col(text).alias("text")).filter("document_id IS NOT NULL")


def index_once(documents: DataFrame, *, document_id: str = "document_id", text: str = "text", max_hot_terms: int = MAX_HOT_TERMS) -> TextIndex:
    """The index of documents that are asked once: postings and terms are written, as several passes read them; norms are part of the
    search's plan, which reads them once."""
    searched = _searched(documents, document_id, text)
    postings = materialize(term_counts(searched, "document_id", "text"), "postings")
    terms = materialize(_terms(postings, searched.count()), "terms")
    return TextIndex(postings, terms, _norms(weighed(postings, terms, postings.count(), max_hot_terms)))


def index_texts(documents: DataFrame, path: str, *, document_id: str = "document_id", text: str = "text", max_hot_terms: int = MAX_HOT_TERMS) -> TextIndex:
    """Count the terms of all documents that have an id (ids must be unique) and write the index to a folder, replacing what is there.

    The postings are laid out by term, so that a search reads only the parts that hold its terms; a range of one hot term is spread
    over several files.
    """
    spark = documents.sparkSession
    searched = _searched(documents, document_id, text)
    postings = materialize(term_counts(searched, "document_id", "text"), "postings")
    postings.repartitionByRange("term", "document_id").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
    # `postings` lie by document here, so the sums per document below are combined in the map tasks.
    _terms(postings, searched.count()).write.mode("overwrite").parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    _norms(weighed(postings, terms, postings.count(), max_hot_terms)).write.mode("overwrite").parquet(f"{path}/norms")
    return open_index(spark, path)


def search_texts(index: TextIndex, questions: DataFrame, *, k: int = TOP_K, question_id: str = "question_id", text: str = "text",
                 max_sent: int = MAX_SENT_NUMBERS, max_hot_terms: int = MAX_HOT_TERMS) -> DataFrame:
    """(question_id, document_id, rank, score): the k documents with the highest TF-IDF cosine per question.

    A document sharing no weighted term with a question is no hit. Only postings of the questions' terms are shuffled.
    """
    asked = questions.select(F.col(question_id).alias("question_id"), F.col(text).alias("text"))
    weighted = term_counts(asked, "question_id", "text").join(index.terms, "term").filter("idf > 0")
    weighted = weighted.select("question_id", "term", "df", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("question_id")))
    units = materialize(weighted.withColumn("u", F.col("w") / length).drop("w"), "questions")

    wanted = units.select("term", "df", "idf").distinct()
    size = units.agg(
        F.count_distinct("term").alias("terms"), F.count_distinct("question_id").alias("questions"), F.count(F.lit(1)).alias("entries"),
    ).first()
    out = best_schema(asked, index.norms)
    # Up to the limit all terms are sent; only beyond it the number of postings matters.
    n_postings = index.terms.agg(F.sum("df")).first()[0] if size["terms"] > max_hot_terms else 0
    if max(size["terms"] * size["questions"], ROW_NUMBERS * size["entries"]) > max_sent:
        hits = weighed(index.postings, wanted, n_postings, max_hot_terms)
        rows = materialize(document_rows(hits, index.norms, "term"), "rows")  # measured first, then shuffled
        return ranked(_texts_shuffled(units, rows, k, out), k)
    return ranked(_texts_sent(units, index, n_postings, max_hot_terms, k, out), k)


def tfidf_top_k(questions: DataFrame, documents: DataFrame, *, k: int = TOP_K, question_id: str = "question_id",
                document_id: str = "document_id", question_text: str = "text", document_text: str = "text",
                max_sent: int = MAX_SENT_NUMBERS, max_hot_terms: int = MAX_HOT_TERMS) -> DataFrame:
    """Index and search in one go, for documents that are asked once: see `index_once` and `search_texts`."""
    index = index_once(documents, document_id=document_id, text=document_text, max_hot_terms=max_hot_terms)
    return search_texts(index, questions, k=k, question_id=question_id, text=question_text, max_sent=max_sent, max_hot_terms=max_hot_terms)


def document_rows(hits: DataFrame, norms: DataFrame, key: str) -> DataFrame:
    """One row per document: its norm and the weights of the terms that the questions share with it."""
    shared = hits.groupBy("document_id").agg(F.collect_list(F.struct(key, "w")).alias("s"))
    return shared.join(norms, "document_id").select("document_id", "norm", F.col(f"s.{key}").alias("keys"), F.col("s.w").alias("weights"))


def _score_texts(best: BestK, matrix: np.ndarray, names: np.ndarray, norms: np.ndarray, sizes: np.ndarray, slots: np.ndarray,
                 weights: np.ndarray, first: int = 0) -> None:
    """Add the scores of documents given as runs of (slot, weight); `matrix` holds one row per slot, one column per question."""
    some = sizes > 0
    names, norms, ends = names[some], norms[some], np.cumsum(sizes[some])
    if not len(names):
        return
    starts = ends - sizes[some]
    step = max(1, BLOCK_NUMBERS // (matrix.shape[1] * int(sizes.max())))
    for a in range(0, len(names), step):
        b = min(a + step, len(names))
        cut = slice(starts[a], ends[b - 1])
        dots = np.add.reduceat(matrix[slots[cut]] * weights[cut, None], starts[a:b] - starts[a], axis=0)
        best.add(np.where(dots > 0, dots / norms[a:b, None], -np.inf), names[a:b], first)


def _texts_sent(units: DataFrame, index: TextIndex, n_postings: int, max_hot: int, k: int, out: T.StructType) -> DataFrame:
    """Questions as a (term × question) matrix in every task."""
    spark = units.sparkSession
    sent = units.collect()  # bounded by the caller's check
    if not sent:
        return spark.createDataFrame([], out)
    wanted = sorted({(row["term"], row["df"], row["idf"]) for row in sent})
    ids = sorted({row["question_id"] for row in sent})
    slot = {term: i for i, (term, _, _) in enumerate(wanted)}
    column = {question: i for i, question in enumerate(ids)}
    matrix = np.zeros((len(wanted), len(ids)))
    for row in sent:
        matrix[slot[row["term"]], column[row["question_id"]]] = row["u"]

    postings = index.postings
    if len(wanted) <= MAX_PUSHED_TERMS:
        postings = postings.filter(F.col("term").isin([term for term, _, _ in wanted]))
    slots = spark.createDataFrame([(*w, i) for i, w in enumerate(wanted)], "term string, df bigint, idf double, slot int")
    hits = weighed(postings, slots, n_postings, max_hot)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestK(len(ids), k)
        for batch in batches:
            if len(batch):
                names, norms = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
                keys, weights = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
                _score_texts(best, matrix, names, norms, sizes, keys, weights)
        yield best_batch(best, ids, arrow)

    return document_rows(hits, index.norms, "slot").mapInArrow(run, out)


def _texts_shuffled(units: DataFrame, rows: DataFrame, k: int, out: T.StructType) -> DataFrame:
    """Each cell of the grid scores its share of questions and documents, some questions at a time."""
    arrow = to_arrow_schema(out)
    asked = units.groupBy("question_id").agg(F.collect_list(F.struct("term", "u")).alias("s"))
    asked = asked.select("question_id", F.col("s.term").alias("keys"), F.col("s.u").alias("units"))
    left, right = _grid(asked, rows, "keys", TERM_NUMBERS)

    def cell(questions: pa.Table, documents: pa.Table) -> pa.Table:
        ids = questions.column("question_id").to_pylist()
        best = BestK(len(ids), k)
        if not len(questions) or not len(documents):
            return pa.Table.from_batches([best_batch(best, ids, arrow)])
        names, norms = (documents.column(c).to_numpy(zero_copy_only=False) for c in ("document_id", "norm"))
        lists = documents.column("keys").combine_chunks()
        terms, weights = lists.flatten(), documents.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(names)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        for first in range(0, len(ids), CELL_QUESTIONS):
            part = questions.slice(first, CELL_QUESTIONS)
            asked_lists = part.column("keys").combine_chunks()
            vocabulary = pc.unique(asked_lists.flatten())
            matrix = np.zeros((len(vocabulary), len(part)))
            columns = np.repeat(np.arange(len(part)), pc.list_value_length(asked_lists).to_numpy(zero_copy_only=False))
            slots = pc.index_in(asked_lists.flatten(), vocabulary).to_numpy(zero_copy_only=False)
            matrix[slots, columns] = part.column("units").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            found = pc.fill_null(pc.index_in(terms, vocabulary), -1).to_numpy(zero_copy_only=False)
            kept = found >= 0
            sizes = np.bincount(owner[kept], minlength=len(names))
            _score_texts(best, matrix, names, norms, sizes, found[kept], weights[kept], first)
        return pa.Table.from_batches([best_batch(best, ids, arrow)])

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(cell, out)


def relevance(score: Column, digits: int = 3) -> Column:
    return F.round(score, digits)


def search_catalog(catalog: DataFrame, questions: DataFrame, *, k: int = TOP_K, index: TextIndex | None = None) -> DataFrame:
    """Catalog tables that answer each question (question_id, text), best first, with their relevance.

    Pass the index of the catalog's documents if there is one; without it the documents are indexed for this call.
    """
    if index is None:
        index = index_once(catalog, document_id="table_name", text="document")
    hits = search_texts(index, questions, k=k).withColumnRenamed("document_id", "table_name")
    sources = catalog.select("table_name", "table_path", "row_count", "document")
    asked = questions.select("question_id", F.col("text").alias("question"))
    return hits.join(sources, "table_name").join(asked, "question_id").select(
        "question_id", "question", "rank", "table_name", "table_path", "row_count", "document",
        relevance(F.col("score")).alias("relevance_score"),
    )
