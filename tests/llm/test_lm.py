"""Base scores against plain counts; the model is a probability and beats the base on held-out texts."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import lm

LANGUAGES = [["the", "cat", "of", "dogs.", "ran", "and", "was", "in"], ["der", "hund", "ist", "ein", "tier", "und", "klein."]]


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def fixture():
    draw = random.Random(1)
    rows = []
    for i in range(300):
        words = LANGUAGES[i % 2]
        rows.append((i, " ".join(draw.choice(words) if draw.random() < 0.95 else f"rare{draw.randrange(300)}" for _ in range(draw.randrange(0, 60)))))
    return rows + rows[:4] + [(1000, None), (1001, ""), (1002, "  "), (None, "The cat"), (1003, "x" * 5000 + " THE"), (1004, "the " * 3000)]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, t, "clash", "clash") for i, t in fixture()]
    return lm.language_scores(spark.createDataFrame(rows, "doc_id long, text string, word string, score string")).collect()


@pytest.fixture(params=[1 << 16, 6])
def head(request, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", request.param)


def test_base_equals_counting(spark, head):
    rows = fixture()
    tokens = lambda t: (t or "").lower().split() + [None]
    count = Counter(x for i, t in rows if not held_out(i) for x in tokens(t))
    total, distinct = sum(count.values()), len(count)
    want = sorted(
        (i if i is not None else -1, held_out(i), len(tokens(t)), sum(x in count for x in tokens(t)), total,
         round(sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in tokens(t)), 6))
        for i, t in rows
    )
    got = lm.language_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(
        (r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in got
    ) == want


def test_model_beats_base_on_held_out(scored):
    rows = [r for r in scored if r["held_out"] and r["n_tokens"] > 1]
    assert len(rows) > 15
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_scores_do_not_depend_on_partitions(spark):
    frame = spark.createDataFrame([r for r in fixture() if r[0] is not None][-300:], "doc_id long, text string").dropDuplicates(["doc_id"])
    found = []
    for parts in (1, 4, 32):
        rows = lm.language_scores(frame.repartition(parts, "doc_id")).collect()
        found.append({r["doc_id"]: r["score"] for r in rows})
    for other in found[1:]:
        assert other == pytest.approx(found[0], abs=1e-3)


def test_steps_bring_expectations_to_counts(spark):
    texts = spark.createDataFrame([(t or "",) for _, t in fixture()], "text string")
    gaps = []
    for rounds in (0, 2, 8):
        model = lm.learn(texts, rounds)[0]
        met, expected = (lm.added_up(texts.mapInArrow(f(model), "row bigint, sums array<double>")) for f in (lm.meetings, lm.expectations))
        gaps.append(np.abs(met - expected).sum() / met.sum())
    assert gaps[0] > gaps[1] > gaps[2]


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([(t or "",) for _, t in fixture()], "text string")
    model, counts, total, distinct = lm.learn(texts)
    data = np.frombuffer(b"the cat ist ein unseen word", dtype=np.uint8)
    p = lm.class_probabilities(model.weights, lm.features(lm.tokens(data, np.array([0, len(data)]))))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5) and (p > 0).all()
    # Within the classes: the smoothed counts of the known words and of one unknown word per class make up the class totals.
    known = sum(r["n"] + lm.ADDED for r in counts.collect())
    assert known + lm.ADDED * lm.CLASSES == pytest.approx((10**model.class_log).sum())
    assert (total, distinct) == (sum(r["n"] for r in counts.collect()), counts.count())


def test_words_within_a_class_are_trained(spark):
    """Two words of equal ending and count follow each its own word: only a model of words, not of classes, tells them apart."""
    draw = random.Random(7)
    pairs = [("alba", "mestone"), ("corve", "gristone")]
    text = lambda swap: " ".join(f"{a} {b}" for a, b in (draw.choice([(x[0], pairs[1 - i if swap else i][1]) for i, x in enumerate(pairs)]) for _ in range(20)))
    filler = " ".join(f"w{k}x{k % 37}" for k in range(60))
    rows = [(i, text(False) + " " + filler) for i in range(1, 400) if not held_out(i)]
    tests = [(i, swap) for swap, i in zip([False, True] * 10, [i for i in range(400, 2000) if held_out(i)][:20], strict=True)]
    frame = spark.createDataFrame(rows + [(i, text(swap)) for i, swap in tests], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] / r["n_tokens"] for r in lm.language_scores(frame).collect()}
    right, wrong = ([scores[i] for i, swap in tests if swap is kind] for kind in (False, True))
    assert min(right) > max(wrong) + 0.05


def test_leaves_and_branches_sum_to_one(spark):
    texts = spark.createDataFrame([(t or "",) for _, t in fixture()], "text string")
    model, counts, *_ = lm.learn(texts)
    known = sum(r["n"] + lm.ADDED for r in counts.collect())
    tree = np.arange(lm.LEAVES) // lm.CLASSES**lm.LEVELS > lm.TOP
    single = (10**model.class_log)[:lm.TOP + 1].sum() - lm.ADDED * (lm.TOP + 1)
    assert (10**model.leaf_log[tree]).sum() == pytest.approx(known - single + lm.ADDED * tree.sum())
    t = lm.tokens(np.frombuffer(b"the cat ist ein unseen word", dtype=np.uint8), np.array([0, 27]))
    steps = list(lm.branches(t, lm.features(t), lm.classes_of(model, t)))
    assert len(steps) == lm.LEVELS and len(steps[0][0])
    assert all(np.allclose(lm.softmax(model.weights, at).sum(axis=1), 1, atol=1e-5) for _, at, _ in steps)


def test_empty_and_untrained(spark):
    frame = spark.createDataFrame([(i, "a b") for i in range(200) if held_out(i)], "doc_id long, text string")
    rows = lm.language_scores(frame).collect()
    assert len(rows) == frame.count()
    assert all(r["train_tokens"] == 0 and r["base_score"] == pytest.approx(0) and r["score"] <= 0 for r in rows)
    assert lm.language_scores(frame.limit(0)).count() == 0


def test_sums_equal_adding_token_by_token(spark):
    texts = spark.createDataFrame([(t or "",) for _, t in fixture()[:40]], "text string")
    model = lm.learn(texts)[0]
    found = lm.added_up(texts.mapInArrow(lm.expectations(model), "row bigint, sums array<double>"))
    want = np.zeros_like(found)
    for r in texts.collect():
        data = np.frombuffer(r["text"].encode(), dtype=np.uint8)
        t = lm.tokens(data, np.array([0, len(data)]))
        rows = lm.features(t)
        parts = [np.column_stack([rows, np.full(len(rows), lm.TABLE_ROWS - 1)])] + [at for _, at, _ in lm.branches(t, rows, lm.classes_of(model, t))]
        for at in (x for part in parts for x in part):
            z = model.weights[at].astype(float).sum(axis=0)
            for row in at:
                want[row] += np.exp(z) / np.exp(z).sum()
    assert np.allclose(found, want, rtol=1e-5, atol=1e-5)


def test_tables_handed_in_grow_with_the_tokens_not_with_the_partitions(spark, monkeypatch):
    tasks = []
    add = lm.added_up
    monkeypatch.setattr(lm, "added_up", lambda parts: (tasks.append(parts.rdd.getNumPartitions()), add(parts))[1])
    texts = spark.createDataFrame([(t or "",) for _, t in fixture()], "text string")
    cores = spark.sparkContext.defaultParallelism
    lm.learn(texts.repartition(8 * cores))
    assert len(tasks) == 1 + lm.ROUNDS and max(tasks) <= 2 * cores
    assert lm.dealt(texts.repartition(8 * cores), 3 * cores * lm.TASK_TOKENS).rdd.getNumPartitions() == 3 * cores
