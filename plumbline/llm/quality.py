"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words. Every passage is encoded: measures of its words and bytes and a small hashed bag of
its words go through a tanh layer. Gated attention weighs the passages of a text (a softmax over tanh and sigmoid gates), the
weighted sum of their codes represents the text, and a logistic output scores it. All layers are learned together from labels of
whole texts. Passages of a batch of texts are measured by running sums over bytes and words, so whole texts of any length are read.

Null and empty texts have one empty passage. Labels, language, source and id are no inputs. Without rows of both labels to learn
from every text scores the share of good ones (0.5 if there are none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import LOWER, hash_runs, text_slices, words
from plumbline.llm.frames import bound_batches
from plumbline.llm.labelled import Model, fit_in_task, held_out, sample, sigmoid

PASSAGE = 64
HASHED = 16
HIDDEN = 16
GATES = 8
ROUNDS = 300
RATE = 0.02
DECAY = 1e-4
THRESHOLD = 0.3


def mask(*codes: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(codes)] = True
    return table


CLASSES = (
    mask(*range(0x41, 0x5B)), mask(*range(0x61, 0x7B)), mask(*range(0x30, 0x3A)), mask(*b"#*$%&|<>"), mask(*b"!?"), mask(*b".,;:"),
    mask(*range(0x80, 0x100)),
)
MEASURES = len(CLASSES) + 5 + HASHED


def running(values: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total


def encoded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each passage, measures of each passage)."""
    starts, ends, rows = words(data, offsets)
    texts = len(offsets) - 1
    count = np.bincount(rows, minlength=texts)
    each = np.maximum(-(-count // PASSAGE), 1)
    owner = np.repeat(np.arange(texts), each)
    base = np.cumsum(count) - count
    place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    first = base[owner] + place * PASSAGE
    last = np.minimum(first + PASSAGE, base[owner] + count[owner])
    size = np.maximum(last - first, 1)
    out = np.zeros((len(owner), MEASURES), dtype=np.float32)
    if not len(starts):
        return owner, out
    lengths = running(ends - starts)
    length = np.maximum(lengths[last] - lengths[first], 1)
    begin, stop = np.append(starts, len(data))[first], np.append(0, ends)[last]
    stop = np.maximum(begin, stop)
    for k, table in enumerate(CLASSES):
        sums = running(table[data])
        out[:, k] = (sums[stop] - sums[begin]) / length
    name = hash_runs(LOWER[data], starts, ends)
    repeated = np.zeros(len(name))
    repeated[1:] = (name[1:] == name[:-1]) & (rows[1:] == rows[:-1])
    k = len(CLASSES)
    sums = running(repeated)
    out[:, k] = (sums[last] - sums[first]) / size
    passage = np.repeat(np.arange(len(owner)), last - first)
    out[:, k + 1] = np.bincount(distinct_pairs(passage, name), minlength=len(owner)) / size
    out[:, k + 2] = length / size / 10
    out[:, k + 3] = size / PASSAGE
    out[:, k + 4] = 1.0
    slots = passage * HASHED + (name >> np.uint64(60)).astype(np.int64)
    bag = np.bincount(slots, minlength=len(owner) * HASHED).reshape(-1, HASHED)
    out[:, k + 5:] = bag / size[:, None]
    return owner, out


def distinct_pairs(passage: np.ndarray, name: np.ndarray) -> np.ndarray:
    """The passage of each distinct pair."""
    order = np.lexsort((name, passage))
    p, n = passage[order], name[order]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (p[1:] != p[:-1]) | (n[1:] != n[:-1])
    return p[new]


def start(random: np.random.Generator) -> Model:
    draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    return {
        "code": draw(MEASURES, HIDDEN), "tanh_gate": draw(HIDDEN, GATES), "sigmoid_gate": draw(HIDDEN, GATES), "attention": draw(GATES),
        "output": draw(HIDDEN), "bias": np.zeros(1), "mean": np.zeros(MEASURES), "scale": np.ones(MEASURES),
    }


def forward(model: Model, owner: np.ndarray, measures: np.ndarray, texts: int) -> dict[str, np.ndarray]:
    x = (measures - model["mean"]) / model["scale"]
    h = np.tanh(x @ model["code"])
    t, s = np.tanh(h @ model["tanh_gate"]), sigmoid(h @ model["sigmoid_gate"])
    raw = (t * s) @ model["attention"]
    top = np.full(texts, -np.inf)
    np.maximum.at(top, owner, raw)
    weight = np.exp(raw - top[owner])
    weight /= np.bincount(owner, weight, minlength=texts)[owner]
    value = h @ model["output"]
    z = np.bincount(owner, weight * value, minlength=texts) + model["bias"][0]
    return {"x": x, "h": h, "t": t, "s": s, "weight": weight, "value": value, "z": z}


def gradients(model: Model, owner: np.ndarray, f: dict[str, np.ndarray], error: np.ndarray) -> Model:
    """Of the loss whose derivative by z is `error`."""
    own = error[owner]
    mean = f["z"] - model["bias"][0]
    by_value = own * f["weight"]
    by_raw = own * f["weight"] * (f["value"] - mean[owner])
    by_gate = by_raw[:, None] * model["attention"]
    by_t, by_s = by_gate * f["s"] * (1 - f["t"] ** 2), by_gate * f["t"] * f["s"] * (1 - f["s"])
    by_h = by_value[:, None] * model["output"] + by_t @ model["tanh_gate"].T + by_s @ model["sigmoid_gate"].T
    by_code = by_h * (1 - f["h"] ** 2)
    return {
        "code": f["x"].T @ by_code, "tanh_gate": f["h"].T @ by_t, "sigmoid_gate": f["h"].T @ by_s, "attention": (f["t"] * f["s"]).T @ by_raw,
        "output": f["h"].T @ by_value, "bias": np.array([error.sum()]),
    }


def fit(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 3) -> Model:
    model = start(np.random.default_rng(seed))
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return model | {"output": np.zeros(HIDDEN), "bias": np.log([share / (1 - share)])}
    pieces = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    owner, measures = encoded(np.frombuffer(b"".join(pieces), dtype=np.uint8), offsets)
    model["mean"], model["scale"] = measures.mean(axis=0), measures.std(axis=0) + 1e-3
    learned = ("code", "tanh_gate", "sigmoid_gate", "attention", "output", "bias")
    first = {k: np.zeros_like(model[k]) for k in learned}
    second = {k: np.zeros_like(model[k]) for k in learned}
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)
    for step in range(1, rounds + 1):
        f = forward(model, owner, measures, len(texts))
        for k, g in gradients(model, owner, f, (sigmoid(f["z"]) - labels) * weight).items():
            if k != "bias":
                g = g + DECAY * model[k]
            first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
            model[k] = model[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def scorer(model: Model):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for _, data, offsets in text_slices(texts):
                owner, measures = encoded(data, offsets)
                parts.append(pa.array(sigmoid(forward(model, owner, measures, len(offsets) - 1)["z"])))
            yield pa.concat_arrays(parts)

    return score


def scored(documents: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add score and predicted."""
    bound_batches(documents.sparkSession)
    done = documents.withColumn("score", scorer(model)(F.coalesce(F.col(text), F.lit(""))))
    return done.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the bounded sample of `labelled.sample`."""
    return fit_in_task(sample(documents, labels, label, id_col=id_col, text=text), fit) or fit([], np.array([]))


def quality(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, held_out, score, predicted."""
    model = learn(documents, labels, id_col=id_col, text=text)
    rows = documents.select(F.col(id_col), F.col(text).alias("_text"))
    return scored(rows, model, text="_text").select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")


def good(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that the classifier accepts, with their own columns."""
    model = learn(documents, labels, id_col=id_col, text=text)
    rows = documents.select(F.struct(*[F.col(c) for c in documents.columns]).alias("_row"), F.col(text).alias("_text"))
    return scored(rows, model, text="_text").filter("predicted = 1").select("_row.*")
