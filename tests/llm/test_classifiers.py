"""Toxicity and quality: held-out accuracy on drawn texts, unseen spellings, and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from plumbline.llm import quality, toxicity

BAD = ["idiot", "moron", "scumbag", "worthless"]


def sentence(draw, n):
    return [draw.choice(["the", "of", "and", "a"]) if draw.random() < 0.4 else "".join(draw.choice(["an", "er", "ti", "on", "sh", "le"]) for _ in range(draw.randrange(1, 5))) for _ in range(n)]


def drawn():
    draw = random.Random(4)
    documents, labels = [], []
    for i in range(700):
        words = sentence(draw, draw.randrange(30, 400))
        toxic, good = int(i % 4 == 0), int(i % 5 != 0)
        if toxic:
            for _ in range(1 + len(words) // 60):
                words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", ".", ","]))
        if not good:
            words = [w + "###" for w in words] if i % 2 else [w for w in words[:40] for _ in range(6)]
        documents.append((i, " ".join(words), f"clash{toxic}"))
        labels.append((i, good, toxic))
    return documents, labels


ODD = [(None, "an id of null", None), (9001, None, "x"), (9002, "", "x"), (9003, "the " * 60_000, "x"), (5, "a row with an id twice", "x")]


@pytest.fixture(scope="module")
def frames(spark):
    documents, labels = drawn()
    odd = [(None, 1, 1), (9001, None, None), (3, 1, 7), (7, 1, 0), (7, 1, 0)]
    return spark.createDataFrame(documents + ODD, "doc_id long, text string, score string"), spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("run", "label", "threshold"), [(toxicity.toxicity, 2, 0.5), (quality.quality, 1, 0.3)])
def test_held_out_accuracy(frames, run, label, threshold):
    rows = run(*frames).collect()
    assert len(rows) == frames[0].count()
    truth = {r[0]: r[label] for r in drawn()[1]}
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(key.encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.95


def test_reruns_agree(frames):
    one, two = (sorted(map(str, quality.quality(*frames).collect())) for _ in range(2))
    assert one == two


def test_unseen_spelling_and_clean_text(spark, frames):
    model = toxicity.learn(*frames)
    texts = ["the shan of onle and the idiots a ti", "the shan of onle and the a ti erti", "sh an " * 3000 + "moron, idiot moron. " + "on er " * 3000]
    rows = toxicity.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[0] > 0.5 > score[1] and score[2] > 0.5


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_without_labels_or_documents(frames, run):
    documents, labels = frames
    assert {r["predicted"] for r in run(documents.limit(5), labels.limit(0)).collect()} <= {0, 1}
    assert run(documents.limit(5), labels.filter("quality = 1 and toxic = 0")).count() == 5
    assert run(documents.limit(0), labels).count() == 0


def test_good_keeps_columns(frames):
    kept = quality.good(*frames)
    assert kept.columns == frames[0].columns
    found = {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3} <= found and not {10, 15} & found


def test_attention_gradient_equals_differences():
    draw = np.random.default_rng(0)
    owner = np.array([0, 0, 0, 1, 2, 2])
    measures, labels = draw.normal(size=(6, quality.MEASURES)), np.array([1.0, 0.0, 1.0])
    model = quality.start(draw)
    loss = lambda m: sum(np.logaddexp(0, z) - y * z for z, y in zip(quality.forward(m, owner, measures, 3)["z"], labels, strict=True))
    f = quality.forward(model, owner, measures, 3)
    for name, gradient in quality.gradients(model, owner, f, quality.sigmoid(f["z"]) - labels).items():
        at = tuple(0 for _ in gradient.shape)
        up = {k: v.copy() for k, v in model.items()}
        down = {k: v.copy() for k, v in model.items()}
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert gradient[at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)
