from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.functions.text import term_counts
from plumbline.functions.topk import BestK
from plumbline.operators import search as se

VECTOR = "id bigint, vector array<double>"


def vectors(spark, n, seed, d=8):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, d)).round(3)
    rows[n // 2:] = rows[0]  # many equal vectors
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], VECTOR).repartition(3), rows


def brute(questions, documents, k, metric):
    out = []
    for q, a in enumerate(questions):
        if metric == "cosine":
            scores = documents @ a / (np.linalg.norm(documents, axis=1) * np.linalg.norm(a))
        else:
            scores = -np.linalg.norm(documents - a, axis=1)
        ranked = sorted((-round(s, 9), i) for i, s in enumerate(scores))[:k]
        out += [(q, i, r + 1, round(-s, 6)) for r, (s, i) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("max_sent", [10**6, 0])
@pytest.mark.parametrize("k", [3, 100])
def test_nearest_equals_brute_force(spark, monkeypatch, metric, max_sent, k):
    monkeypatch.setattr(se, "CELL_NUMBERS", 150)
    (questions, qs), (documents, ds) = vectors(spark, 10, 1), vectors(spark, 40, 2)
    hits = se.nearest(questions, documents, k=k, metric=metric, question_id="id", document_id="id", max_sent=max_sent)
    got = sorted((r["question_id"], r["document_id"], r["rank"], round(r["score"], 6)) for r in hits.collect())
    assert got == sorted(brute(qs, ds, k, metric))


def test_nearest_without_questions_or_documents(spark):
    documents, _ = vectors(spark, 4, 1)
    none = spark.createDataFrame([], VECTOR)
    assert se.nearest(none, documents, question_id="id", document_id="id").isEmpty()
    assert se.nearest(documents, none, question_id="id", document_id="id").isEmpty()
    with pytest.raises(ValueError, match="metric"):
        se.nearest(documents, documents, metric="dot", question_id="id", document_id="id")


def test_rows_without_a_vector_take_no_part(spark):
    documents = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], VECTOR)
    hits = se.nearest(documents.filter("id = 1"), documents, question_id="id", document_id="id").collect()
    assert [(r["document_id"], r["score"]) for r in hits] == [(1, 1.0), (3, 0.0)]


def test_best_k_over_blocks():
    rng = np.random.default_rng(0)
    scores = rng.integers(0, 5, size=(50, 3)).astype(float)
    scores[scores == 4] = -np.inf
    ids = rng.permutation(50)
    whole, parts = BestK(3, 6), BestK(3, 6)
    whole.add(scores, ids)
    for start in range(0, 50, 7):
        parts.add(scores[start:start + 7], ids[start:start + 7])
    assert whole.rows(["a", "b", "c"]) == parts.rows(["a", "b", "c"])
    expected = sorted((-scores[i, 0], ids[i]) for i in range(50) if scores[i, 0] > -np.inf)[:6]
    assert list(zip(*whole.rows(["a", "b", "c"])[1:], strict=True))[:6] == [(i, -s) for s, i in expected]


def test_best_k_with_text_ids():
    best = BestK(1, 2)
    best.add(np.array([[1.0], [1.0], [1.0]]), np.array(["c", "a", "b"], dtype=object))
    assert best.rows([7]) == ([7, 7], ["a", "b"], [1.0, 1.0])


def texts(spark, n, seed, words=30):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefé" for b in "xyzÜ"]
    rows = [(i, " ".join(rng.choices(vocabulary[: 4 + i], k=rng.randint(0, words)))) for i in range(n)]
    rows += [(n + 1, "common, ONE-two!"), (n + 2, None), (n + 3, ""), (n + 4, "123 456"), (n + 5, "common one two")]
    return spark.createDataFrame(rows, "id int, text string"), rows


def tokens(text):
    return [t for t in re.split(r"[^a-zàâäçèéêëîïôöùûüßœ]+", (text or "").lower()) if t]


def test_term_counts(spark):
    df, rows = texts(spark, 20, 3)
    got = sorted(map(tuple, term_counts(df, "id", "text").collect()))
    assert got == sorted((i, t, n) for i, text in rows for t, n in Counter(tokens(text)).items())
    assert "Exchange" not in term_counts(df, "id", "text")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_sent", [10**6, 0])
@pytest.mark.parametrize("max_hot_terms", [10**6, 3])
def test_tfidf_equals_brute_force(spark, monkeypatch, max_sent, max_hot_terms):
    monkeypatch.setattr(se, "CELL_NUMBERS", 150)
    monkeypatch.setattr(se, "CELL_QUESTIONS", 2)
    documents, rows = texts(spark, 25, 5)
    questions, asked = texts(spark, 6, 6, words=8)
    counts = {i: Counter(tokens(t)) for i, t in rows}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log(len(rows) / n) for t, n in df.items()}
    weights = {i: {t: n * idf[t] for t, n in c.items()} for i, c in counts.items()}
    expected = []
    for q, text in asked:
        w = {t: n * idf[t] for t, n in Counter(tokens(text)).items() if idf.get(t, 0) > 0}
        size = math.sqrt(sum(x * x for x in w.values()))
        scores = []
        for i, d in weights.items():
            dot = sum(x * d.get(t, 0) for t, x in w.items())
            if dot > 0:
                scores.append((-round(dot / size / math.sqrt(sum(x * x for x in d.values())), 9), i))
        expected += [(q, i, r + 1, round(-s, 6)) for r, (s, i) in enumerate(sorted(scores)[:4])]
    hits = se.tfidf_top_k(questions, documents, k=4, question_id="id", document_id="id", max_sent=max_sent, max_hot_terms=max_hot_terms)
    got = [(r["question_id"], r["document_id"], r["rank"], round(r["score"], 6)) for r in hits.collect()]
    assert sorted(got) == sorted(expected)


def test_stored_index_gives_the_same_hits(spark, tmp_path):
    documents, _ = texts(spark, 25, 5)
    questions, _ = texts(spark, 6, 6, words=8)
    se.index_texts(documents, f"{tmp_path}/index", document_id="id")
    hits = se.search_texts(se.open_index(spark, f"{tmp_path}/index"), questions, question_id="id")
    once = se.tfidf_top_k(questions, documents, question_id="id", document_id="id")
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, once.collect()))


def test_search_reads_only_its_terms(spark, tmp_path):
    documents, _ = texts(spark, 5, 5)
    index = se.index_texts(documents, f"{tmp_path}/index", document_id="id")
    hits = se.search_texts(index, spark.createDataFrame([(1, "common two")], "question_id int, text string"))
    assert "PushedFilters: [In(term, [common,two])" in hits._jdf.queryExecution().executedPlan().toString()


def test_centroids(spark):
    rows = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0]), (2, [0.0, 1.0])], "label int, v array<float>")
    assert sorted(map(tuple, se.centroids(rows, "label", "v").collect())) == [(1, [2.0, 4.0]), (2, [0.0, 1.0])]
