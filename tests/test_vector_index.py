"""The approximate vector index against exact search."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import search as se
from plumbline.operators import vector_index as vi
from plumbline.sources.tables import read_table
from tests.conftest import DATA


def clouds(spark, n=3000, numbers=10, seed=5):
    """Vectors around a few centres, half of them around one."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, numbers)) * 3
    which = np.where(draw.random(n) < 0.5, 0, draw.integers(0, 12, n))
    rows = centres[which] + draw.normal(size=(n, numbers))
    return spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(rows)], "document_id long, vector array<double>").repartition(4)


def questions_of(vectors):
    return vectors.filter("document_id % 20 = 0").select(F.col("document_id").alias("question_id"), "vector")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_recall_on_clouds(spark, tmp_path, metric):
    vectors = clouds(spark)
    index = vi.build(vectors, f"{tmp_path}/index", metric=metric, list_rows=300)
    assert index.lists.count() == 3000
    sizes = index.lists.groupBy("cell", "part").count().collect()
    assert max(r["count"] for r in sizes) < 600
    asked = questions_of(vectors)
    found, exact = vi.search(index, asked, k=5), se.nearest(asked, vectors, k=5, metric=metric)
    assert vi.recall(found, exact).agg(F.sum("hits") / F.sum("n")).first()[0] >= 0.95
    both = found.join(exact.withColumnRenamed("score", "true_score"), ["question_id", "document_id"])
    assert both.agg(F.max(F.abs(F.col("score") - F.col("true_score")))).first()[0] < 1e-8


def test_recall_on_given_vectors(spark, tmp_path):
    vectors = read_table(spark, DATA, "embeddings").select(F.col("vec_id").alias("document_id"), F.col("embedding").alias("vector"))
    index = vi.build(vectors, f"{tmp_path}/index")
    asked = questions_of(vectors)
    recall = vi.recall(vi.search(index, asked), se.nearest(asked, vectors)).agg(F.sum("hits") / F.sum("n")).first()[0]
    assert recall >= 0.95


def test_all_cells_and_all_rows_is_exact_in_blocks_too(spark, tmp_path):
    vectors = clouds(spark, 300)
    vi.build(vectors, f"{tmp_path}/index", cells=7)
    index = vi.VectorIndex.open(spark, f"{tmp_path}/index")
    asked = questions_of(vectors)
    exact = sorted(map(tuple, se.nearest(asked, vectors, k=4).collect()))
    for max_sent in (10**6, 2000):
        assert sorted(map(tuple, vi.search(index, asked, k=4, probes=7, refine=75, max_sent=max_sent).collect())) == exact


def test_lists_of_other_cells_are_not_read(spark, tmp_path):
    vectors = clouds(spark)
    index = vi.build(vectors, f"{tmp_path}/index", cells=20)
    plan = vi.search(index, questions_of(vectors).limit(1), probes=2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(cell" in plan


def test_empty_tables_nulls_and_equal_vectors(spark, tmp_path):
    empty = spark.createDataFrame([], "document_id long, vector array<double>")
    asked = spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, None), (3, [0.0, 0.0, 0.0])], "question_id long, vector array<double>")
    assert vi.search(vi.build(empty, f"{tmp_path}/a"), asked).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0, 0.0]) for k in range(9)] + [(None, [1.0, 1.0, 1.0]), (77, None)], empty.schema)
    index = vi.build(same, f"{tmp_path}/b")
    assert index.lists.count() == 9
    rows = vi.search(index, asked, k=3).filter("question_id = 1").collect()
    assert [r["document_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [0, 1, 2]
    assert vi.search(index, asked.limit(0)).count() == 0
    with pytest.raises(ValueError):
        vi.build(same, f"{tmp_path}/c", metric="dot")
