"""Toxicity from subword-bag embeddings.

A word is the mean of the vectors of its character n-grams (of its UTF-8 bytes, with a space at both ends), hashed to a fixed
table; a misspelt or inflected word shares most of them. The words of a window are averaged into a linear softmax of two classes,
and a text is as toxic as its most toxic window, however long it is. Vectors and softmax are trained together: in each round the
gradient of a text goes to the window that decides it. Averaging is linear, so for scoring the table shrinks to one number per
bucket, and a batch of whole texts is scored by lookups and running sums.

Null and empty texts have no words and score what the softmax gives the zero vector. Labels, language, source and id are no
inputs. Without rows of both labels to learn from every text scores the share of toxic ones (0.5 if there are none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import LOWER, SPACE, distinct_runs, eights, gather, hash_runs, text_slices, words
from plumbline.llm.frames import bound_batches
from plumbline.llm.labelled import Model, fit_in_task, held_out, sample, sigmoid

GRAMS = (3, 4, 5, 6)
BUCKET_BITS = 17
DIMENSIONS = 8
WINDOW = 24
STRIDE = 12
ROUNDS = 60
# Largest change of a number of the vectors in a round, and the factor of the last softmax over windows.
STEP = 2.0
SHARPEST = 4.0
# Occurrences that a bucket's own ones are added to before its gradient is divided by them.
DOUBT = 150.0
THRESHOLD = 0.5

_ODD = np.uint64(0x9E3779B97F4A7C15)


def buckets(data: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n bytes from each position on."""
    masked = (eights(data)[:-1] & np.uint64((1 << 8 * n) - 1)) + np.uint64(n << 56)
    return ((masked * _ODD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def prepared(data: np.ndarray) -> np.ndarray:
    """ASCII lower case, all white space as spaces."""
    clean = LOWER[data]
    clean[SPACE[data]] = 0x20
    return clean


def windows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in the text, words) of the windows of texts with so many words; the last one ends at the last word."""
    each = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(count)), each)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    first = np.minimum(place * STRIDE, np.maximum(count[owner] - WINDOW, 0))
    return owner, first, np.minimum(count[owner], WINDOW)


def running(values: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total


class Layout:
    """Words and windows of a slice of texts, each of which begins and ends with a space. A word repeated in a row counts once."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = prepared(data)
        starts, ends, rows = words(self.data, offsets)
        name = hash_runs(self.data, starts, ends)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (rows[1:] != rows[:-1])
        self.starts, self.ends, self.name, rows = starts[new], ends[new], name[new], rows[new]
        self.count = np.bincount(rows, minlength=len(offsets) - 1)
        self.base = np.cumsum(self.count) - self.count
        self.owner, first, self.size = windows(self.count)
        self.first = first + self.base[self.owner]
        lengths = self.ends - self.starts
        self.grams = sum(np.maximum(lengths + 3 - n, 0) for n in GRAMS)

    def window_means(self, table: np.ndarray) -> np.ndarray:
        """The mean of the words' means of `table` in each window; one with fewer than WINDOW words is filled up with zeros."""
        total = np.zeros(len(self.starts))
        for n in GRAMS:
            sums = running(table[buckets(self.data, n)])
            total += sums[np.maximum(self.ends + 2 - n, self.starts - 1)] - sums[self.starts - 1]
        sums = running(total / self.grams)
        return (sums[self.first + self.size] - sums[self.first]) / WINDOW

    def best(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts with words, the window of each with the greatest value)."""
        order = np.lexsort((-value, self.owner))
        texts, at = np.unique(self.owner[order], return_index=True)
        return texts, order[at]


class Bags:
    """The n-grams of the distinct words of a layout, so that a round of training touches each distinct word once."""

    def __init__(self, layout: Layout):
        self.layout = layout
        first, self.kind = distinct_runs(layout.name)
        starts, ends = layout.starts[first], layout.ends[first]
        self.grams = layout.grams[first]
        slots, owners = [], []
        for n in GRAMS:
            length = np.maximum(ends - starts + 3 - n, 0)
            slots.append(buckets(layout.data, n)[gather(starts - 1, length)])
            owners.append(np.repeat(np.arange(len(first)), length))
        self.slots, self.owners = np.concatenate(slots), np.concatenate(owners)
        often = np.bincount(self.kind, minlength=len(first)).astype(np.float64)
        self.support = np.bincount(self.slots, often[self.owners], minlength=1 << BUCKET_BITS)

    def window_means(self, table: np.ndarray) -> np.ndarray:
        word = np.bincount(self.owners, table[self.slots], minlength=len(self.grams)) / self.grams
        sums, lay = running(word[self.kind]), self.layout
        return (sums[lay.first + lay.size] - sums[lay.first]) / WINDOW

    def pulled(self, errors: np.ndarray) -> np.ndarray:
        """What window errors pull at each bucket."""
        lay = self.layout
        edge = np.zeros(len(self.kind) + 1)
        np.add.at(edge, lay.first, errors / WINDOW)
        np.add.at(edge, lay.first + lay.size, -errors / WINDOW)
        word = np.bincount(self.kind, np.cumsum(edge)[:-1], minlength=len(self.grams)) / self.grams
        return np.bincount(self.slots, word[self.owners], minlength=1 << BUCKET_BITS)


def fit(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> Model:
    """vectors, weights (2 x dimensions) and bias (2) of the joint model.

    The windows of a text share its error by the softmax of their values, flat at first and sharper from round to round, so that
    training starts from all windows and ends at the deciding ones. Steps are scaled by the largest one of a round: a bucket of
    chance moves little against one that many texts pull at.
    """
    random = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    model = {"vectors": np.zeros((size, DIMENSIONS)), "weights": random.normal(0, 1, (2, DIMENSIONS)), "bias": np.zeros(2)}
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return model | {"bias": np.log([1 - share, share])}
    pieces = [f" {t} ".encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    layout = Layout(np.frombuffer(b"".join(pieces), dtype=np.uint8), offsets)
    bags = Bags(layout)
    owner, count = layout.owner, len(texts)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / count
    speed = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(rounds):
        slope = model["weights"][1] - model["weights"][0]
        value = bags.window_means(model["vectors"] @ slope)
        top = np.full(count, -np.inf)
        np.maximum.at(top, owner, value)
        part = np.exp(SHARPEST * step / rounds * (value - top[owner]))
        part /= np.bincount(owner, part, minlength=count)[owner]
        z = np.bincount(owner, part * value, minlength=count) + model["bias"][1] - model["bias"][0]
        error = (sigmoid(z) - labels) * weight
        pull = bags.pulled(part * error[owner]) / (bags.support + DOUBT)
        steep = pull @ model["vectors"]
        slow = 1 - 0.9 * step / rounds
        moves = {"vectors": (pull[:, None] * slope, STEP), "weights": (np.stack([-steep, steep]), 0.02)}
        steps = {k: (g, rate * slow / max(np.abs(g).max(), 1e-7)) for k, (g, rate) in moves.items()}
        steps["bias"] = (np.array([-error.sum(), error.sum()]), 1.0)
        for name, (gradient, scale) in steps.items():
            speed[name] = 0.8 * speed[name] - 0.2 * scale * gradient
            model[name] = model[name] + speed[name]
    return model


def scorer(table: np.ndarray, bias: float):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for _, data, offsets in text_slices(texts):
                z = np.full(len(offsets) - 1, bias)
                layout = Layout(data, offsets)
                if len(layout.owner):
                    value = layout.window_means(table)
                    docs, chosen = layout.best(value)
                    z[docs] += value[chosen]
                parts.append(pa.array(sigmoid(z)))
            yield pa.concat_arrays(parts)

    return score


def scored(documents: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add score and predicted. The model reaches the tasks as one number per bucket, whatever the data's size."""
    bound_batches(documents.sparkSession)
    table = (model["vectors"] @ (model["weights"][1] - model["weights"][0])).astype(np.float32)
    padded = F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")), F.lit(" "))
    done = documents.withColumn("score", scorer(table, float(model["bias"][1] - model["bias"][0]))(padded))
    return done.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the bounded sample of `labelled.sample`."""
    return fit_in_task(sample(documents, labels, label, id_col=id_col, text=text), fit) or fit([], np.array([]))


def toxicity(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, held_out, score, predicted."""
    model = learn(documents, labels, id_col=id_col, text=text)
    rows = documents.select(F.col(id_col), F.col(text).alias("_text"))
    return scored(rows, model, text="_text").select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
