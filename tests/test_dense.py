"""Dense vectors against numpy's decomposition of the same matrix."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np

from plumbline.operators import dense
from plumbline.operators import search as se


def corpus():
    """Two topics whose words never meet a bridge word in one text, except through others."""
    draw = random.Random(2)
    topics = [[name + chr(97 + k) for k in range(25)] for name in ("sea", "hill", "town")]
    rows = [(i, " ".join(draw.choice(topics[i % 3]) for _ in range(draw.randrange(3, 12)))) for i in range(180)]
    return rows + [(500, ""), (501, None), (502, "seaa seab"), (503, "seax seay"), (504, "hilld")]


def dense_matrix(rows, width):
    out = {}
    for r in rows.collect():
        import pyarrow as pa

        columns, signs = dense.slots(pa.array(r["keys"]), width)
        row = np.zeros(width)
        np.add.at(row, columns, signs * np.array(r["weights"]) / (r["norm"] or 1))
        out[r["document_id"]] = row
    return out


def test_equals_numpy(spark):
    frame = spark.createDataFrame(corpus(), "document_id long, text string").repartition(5)
    vectors, basis = dense.document_vectors(frame, rank=6, width=512, rounds=12)
    index = se.index_once(frame)
    rows = dense_matrix(dense.rows_of(index, index.postings.count(), 10), 512)
    ids = sorted(rows)
    matrix = np.stack([rows[i] for i in ids])
    _, values, right = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(basis.values, values[:6], rtol=1e-3)
    best = matrix - matrix @ right[:6].T @ right[:6]
    own = matrix - matrix @ basis.vectors @ basis.vectors.T
    assert np.linalg.norm(own) <= 1.001 * np.linalg.norm(best)
    got = {r["document_id"]: np.array(r["vector"]) for r in vectors.collect()}
    assert sorted(got) == ids and 500 not in got
    assert all(np.allclose(got[i], rows[i] @ basis.vectors, atol=1e-9) for i in ids)


def test_products_hold_a_block_at_a_time():
    draw = np.random.default_rng(3)
    basis, sizes = draw.normal(size=(512, 8)), np.array([0, 300_000, 0, 3, 100_000])
    columns, weights = draw.integers(0, 512, sizes.sum()), draw.normal(size=sizes.sum())
    tracemalloc.start()
    got = dense.products(basis, columns, weights, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    cuts = np.split(np.arange(sizes.sum()), np.cumsum(sizes)[:-1])
    assert np.allclose(got, np.stack([weights[c] @ basis[columns[c]] for c in cuts]))
    assert peak < sizes.sum() * 8 * 8 / 2  # less than a row of the basis for each entry


def test_texts_without_a_common_word_meet(spark):
    frame = spark.createDataFrame(corpus(), "document_id long, text string")
    vectors, _ = dense.document_vectors(frame, rank=3, width=512)
    got = {r["document_id"]: np.array(r["vector"]) for r in vectors.collect()}
    cosine = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    assert cosine(502, 503) > 0.9 > 0.3 > abs(cosine(502, 504))


def test_empty(spark):
    vectors, basis = dense.document_vectors(spark.createDataFrame([(1, "")], "document_id long, text string"), rank=2, width=16)
    assert vectors.isEmpty() and not basis.values.any()
