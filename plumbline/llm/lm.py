"""A hashed maximum-entropy language model with class-factored outputs.

P(word | history) = P(class | history) * P(word | class). The class part is a softmax over a few classes whose weights are looked
up by hashed features of the history: the word before, the endings of the two words before together, and the endings of the second
and the third word before on their own (skips). The word part goes down a tree below the class: LEVELS softmaxes choose a branch each, by
weights of the same features of the history, hashed together with the node. Words are dealt to branches by their hash, so every word has a
path whatever the vocabulary; words that share a leaf of the tree divide it by their smoothed counts. All parts sum to one over all words
and an unknown one in each leaf. Frequent words and the end of a text have classes of their own; other words are grouped by
their endings, which are clustered by what stands beside them.

Learning takes every training text. One pass counts words and pairs of endings, one how often each feature meets each class, which the
first weights are made of. In each training round all tasks work with the same weights; they hand in the gradient over their texts,
which is added up by a shuffle on the features, and every weight takes one step of its own size. So the model does not depend on how the
texts are dealt to tasks, but for rounding. Scoring looks up the HEAD most frequent words in the task; the counts of all others come
from a join on the words, for which each text sends each of its rarer words once.

Branches start from their shares and are trained in the same rounds as classes. Classes of a single word have no tree.

Words are told apart by 64-bit hashes. Texts of any length are taken whole, in slices. Other columns are not read, so their names cannot
clash. Null and empty texts are one token, the end. Rows that repeat are texts of their own and
score alike. A null id counts as empty text for the split. Without training texts every word has probability one within its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.arrays import LOWER, eights, hash_runs, mixed, text_slices, words
from plumbline.llm.frames import bound_batches
from plumbline.llm.labelled import held_out
from plumbline.sources.tables import materialize

FOLDS = 10
ADDED = 0.1
# Classes: the end, TOP frequent words, clusters of endings.
CLASSES = 16
TOP = 5
ENDINGS = 1024
WORD_ROWS = 1 << 14
PAIR_ROWS = 1 << 14
# Most frequent words whose counts are sent to all tasks, a table of fixed size.
HEAD = 1 << 16
ROUNDS = 2
STEP_TOKENS = 1 << 15
# Tokens whose numbers fit the cache of a core; no power of two, as columns that far apart would displace each other there.
BLOCK_TOKENS = 4000
# Tokens of a training task, about 100 MB of text: the sums it hands in have up to 14 MB.
TASK_TOKENS = 1 << 24
# Share of a feature's own evidence in its first weights, and size of the later steps: the features of a token overlap.
FIRST_RATE = 0.3
RATE = 0.3
# Tokens with the class's usual share that a feature is taken to have seen beforehand.
SHRINK = 4.0

END = np.uint64(0x5BD1E9955BD1E995)
START = np.uint64(0x9E3779B97F4A7C15)
MARK = np.zeros(256, dtype=bool)
MARK[list(b".,;:!?")] = True
# The tree below a class: its levels, each of CLASSES branches a node, and the rows that features share at all its nodes.
LEVELS = 2
BRANCH_ROWS = 1 << 16
FIRST_NODE = np.cumsum([0, *(CLASSES ** (k + 1) for k in range(LEVELS))])
NODES = int(FIRST_NODE[-1])
LEAVES = CLASSES ** (LEVELS + 1)
BRANCH = np.uint64(0x2545F4914F6CDD1D)
# Rows of the weight table: words, pairs of endings, second ending, third ending, these at nodes, shares of nodes, bias.
PLACES = np.cumsum([0, WORD_ROWS, PAIR_ROWS, ENDINGS, ENDINGS, BRANCH_ROWS, NODES])
TABLE_ROWS = int(PLACES[-1]) + 1
OF_CLASSES, OF_NODES = slice(0, int(PLACES[4])), slice(int(PLACES[4]), int(PLACES[6]))


@dataclass
class Tokens:
    """Tokens of a slice of texts: hash, ending and text of each; every text closes with the end."""

    name: np.ndarray
    ending: np.ndarray
    text: np.ndarray
    first: np.ndarray  # place of each text's first token


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    data = LOWER[data]
    starts, ends, rows = words(data, offsets)
    texts = len(offsets) - 1
    count = np.bincount(rows, minlength=texts)
    first = np.cumsum(count + 1) - count - 1
    place = np.arange(len(rows)) + rows
    name = np.full(len(rows) + texts, END)
    name[place] = hash_runs(data, starts, ends)
    ending = np.zeros(len(name), dtype=np.int32)
    if len(rows):
        marked = MARK[data[ends - 1]] & (ends - starts > 1)
        stop = ends - marked
        two = eights(data)[np.maximum(stop - 2, starts)] & np.uint64(0xFFFF)
        ending[place] = 1 + (mixed(two * np.uint64(2) + marked.astype(np.uint64)) % np.uint64(ENDINGS - 1)).astype(np.int32)
    return Tokens(name, ending, np.repeat(np.arange(texts), count + 1), first)


def behind(values: np.ndarray, t: Tokens, steps: int, fill) -> np.ndarray:
    """The value `steps` tokens before in the same text."""
    moved = np.empty_like(values)
    moved[steps:] = values[:-steps] if len(values) > steps else values[:0]
    moved[np.arange(len(values)) - t.first[t.text] < steps] = fill
    return moved


def features(t: Tokens) -> np.ndarray:
    """Rows of the weight table for each token, a column per kind of feature; the bias is the last row of the table."""
    one, two, three = (behind(t.ending, t, k, 0) for k in (1, 2, 3))
    word = (mixed(behind(t.name, t, 1, START)) & np.uint64(WORD_ROWS - 1)).astype(np.int64)
    pair = (mixed((one.astype(np.uint64) << np.uint64(20)) | two.astype(np.uint64)) & np.uint64(PAIR_ROWS - 1)).astype(np.int64)
    return np.stack([word, pair + PLACES[1], two + PLACES[2], three + PLACES[3]], axis=1)


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs?, key, ending, n): counts of words, and of pairs of endings that stand side by side."""
    for batch in batches:
        for _, data, offsets in text_slices(batch.column(0)):
            t = tokens(data, offsets)
            name, at, n = np.unique(t.name, return_index=True, return_counts=True)
            pair, m = np.unique(behind(t.ending, t, 1, 0).astype(np.int64) * ENDINGS + t.ending, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([False, True], [len(name), len(pair)])), pa.array(np.concatenate([name.view(np.int64), pair])),
                pa.array(np.concatenate([t.ending[at], np.zeros(len(pair), dtype=np.int32)])), pa.array(np.concatenate([n, m])),
            ], ["pairs", "key", "ending", "n"])


def clustered(pairs: np.ndarray, clusters: int, rounds: int = 25, seed: int = 1) -> np.ndarray:
    """The cluster of each ending, by k-means over the square roots of its neighbours' shares. Frequent endings weigh more."""
    both = np.concatenate([pairs, pairs.T], axis=1).astype(np.float64)
    total = both.sum(axis=1)
    used = np.flatnonzero(total)
    result = np.zeros(len(pairs), dtype=np.int64)
    if len(used) <= clusters:
        result[used] = np.arange(len(used))
        return result
    points, weight = np.sqrt(both[used] / total[used, None]), np.sqrt(total[used])
    random = np.random.default_rng(seed)
    centres = points[[int(np.argmax(weight))]]
    distances = lambda: np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1), 0)
    while len(centres) < clusters:
        far = weight * distances().min(axis=1)
        chosen = random.choice(len(points), p=far / far.sum()) if far.sum() else 0
        centres = np.concatenate([centres, points[[chosen]]])
    for _ in range(rounds):
        nearest = np.argmin(distances(), axis=1)
        for k in range(clusters):
            own = nearest == k
            if own.any():
                centres[k] = np.average(points[own], axis=0, weights=weight[own])
    result[used] = nearest
    return result


@dataclass
class Model:
    """What tasks need to score: the same size whatever the corpus."""

    top: np.ndarray  # sorted hashes of the words with classes of their own
    top_class: np.ndarray
    cluster: np.ndarray  # class of each ending
    weights: np.ndarray  # TABLE_ROWS x CLASSES
    head: np.ndarray  # sorted hashes of the HEAD words
    head_log: np.ndarray  # log10 of their smoothed counts
    class_log: np.ndarray  # log10 of each class's smoothed total
    leaf_log: np.ndarray  # the same of each leaf; in a class of a single word that of the class


def classes_of(model: Model, t: Tokens) -> np.ndarray:
    found = model.cluster[t.ending]
    found[t.name == END] = 0
    if len(model.top):
        place = np.minimum(np.searchsorted(model.top, t.name), len(model.top) - 1)
        found = np.where(model.top[place] == t.name, model.top_class[place], found)
    return found


def leaves_of(name: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The leaf of each word: its class and then its branches, as digits."""
    return kind.astype(np.int64) * CLASSES**LEVELS + (mixed(name ^ BRANCH) & np.uint64(CLASSES**LEVELS - 1)).astype(np.int64)


def branches(t: Tokens, rows: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, rows of the weight table, branch taken) of each level, for tokens of classes with a tree, STEP_TOKENS at a time."""
    below = np.flatnonzero(kind > TOP)
    for i in range(0, len(below), STEP_TOKENS):
        some = below[i:i + STEP_TOKENS]
        leaf, own = leaves_of(t.name[some], kind[some]), np.ascontiguousarray(rows[some].T).astype(np.uint64) * np.uint64(NODES)
        for level in range(LEVELS):
            above = leaf // CLASSES ** (LEVELS - level)
            node = FIRST_NODE[level] + above
            at = np.empty((len(own) + 1, len(some)), dtype=np.int64)
            at[:-1] = mixed(own + node.astype(np.uint64)) & np.uint64(BRANCH_ROWS - 1)
            at[:-1] += PLACES[4]
            at[-1] = PLACES[5] + node
            yield some, at.T, leaf // CLASSES ** (LEVELS - level - 1) % CLASSES


def class_probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return softmax(weights, rows, weights[-1])


def softmax(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray | float = 0.0) -> np.ndarray:
    """A row of probabilities for each token; the numbers of a class lie side by side, as numpy is slow along a short axis."""
    p = np.empty((CLASSES, len(rows)), dtype=weights.dtype)
    for i in range(0, len(rows), BLOCK_TOKENS):
        some = np.ascontiguousarray(rows[i:i + BLOCK_TOKENS].T)
        z = weights.take(some[0], axis=0)
        for row in some[1:]:
            z += weights.take(row, axis=0)
        z += bias
        z = np.ascontiguousarray(z.T)
        z -= z.max(axis=0)
        np.exp(z, out=z)
        np.divide(z, z.sum(axis=0), out=p[:, i:i + BLOCK_TOKENS])
    return p.T


def row_batch(sums: np.ndarray) -> pa.RecordBatch:
    """The rows of a table of TABLE_ROWS x CLASSES sums that are not empty."""
    seen = np.flatnonzero(sums.any(axis=1))
    flat = pa.array(sums[seen].astype(np.float64).reshape(-1))
    return pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, CLASSES, dtype=np.int32), flat)], ["row", "sums"],
    )


def meetings(model: Model):
    """How often each feature meets each class, and each branch at a node."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros((TABLE_ROWS, CLASSES))

        def add(part: slice, rows: np.ndarray, kind: np.ndarray) -> None:
            flat = met[part].reshape(-1)
            np.add.at(flat, ((rows.T - part.start) * CLASSES + kind).reshape(-1), 1.0)

        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                t = tokens(data, offsets)
                rows, kind = features(t), classes_of(model, t)
                add(OF_CLASSES, rows, kind)
                met[-1] += np.bincount(kind, minlength=CLASSES)
                for _, at, branch in branches(t, rows, kind):
                    add(OF_NODES, at, branch)
        yield row_batch(met)

    return count


def add_rows(total: np.ndarray, part: slice, rows: np.ndarray, p: np.ndarray) -> None:
    """Add the probabilities of each token to all its rows, which are in the given part of the table. A row of `total` is a class."""
    at = (rows.T - part.start).reshape(-1)
    each = np.empty((rows.shape[1], len(p)))
    for k in range(CLASSES):
        each[:] = p[:, k]
        total[k, part] += np.bincount(at, each.reshape(-1), minlength=part.stop - part.start)


def expectations(model: Model):
    """How often each feature meets each class by the model's probabilities, and each branch at the nodes that its words pass."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, TABLE_ROWS))
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                t = tokens(data, offsets)
                rows = features(t)
                for i in range(0, len(rows), STEP_TOKENS):
                    some = rows[i:i + STEP_TOKENS]
                    p = class_probabilities(model.weights, some)
                    add_rows(total, OF_CLASSES, some, p)
                    total[:, -1] += p.sum(axis=0)
                for _, at, _ in branches(t, rows, classes_of(model, t)):
                    add_rows(total, OF_NODES, at, softmax(model.weights, at))
        yield row_batch(total.T)

    return expect


def dealt(texts: DataFrame, tokens: int) -> DataFrame:
    """The same texts in tasks of TASK_TOKENS tokens or more, as each hands in a whole table; no fewer than two a core."""
    tasks = max(2 * texts.sparkSession.sparkContext.defaultParallelism, -(-tokens // TASK_TOKENS))
    return texts.coalesce(tasks)


def added_up(parts: DataFrame) -> np.ndarray:
    """The sums of all tasks, TABLE_ROWS x CLASSES numbers."""
    sums = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(CLASSES)]
    found = parts.groupBy("row").agg(*sums).toArrow()
    table = np.zeros((TABLE_ROWS, CLASSES))
    table[found.column("row").to_numpy()] = np.stack([found.column(f"s{k}").to_numpy() for k in range(CLASSES)], axis=1)
    return table


def trained(texts: DataFrame, model: Model, rounds: int) -> Model:
    """The gradient of a weight is how often its feature meets the class less how often the model expects it to; a step goes by the
    logarithm of their quotient, so that rare and frequent features move alike."""
    schema = "row bigint, sums array<double>"
    met = added_up(texts.mapInArrow(meetings(model), schema))
    if not met.any():
        return model
    usual = np.maximum(SHRINK * met[-1] / met[-1].sum(), 1e-3)
    seen = met.sum(axis=1, keepdims=True)
    weights = FIRST_RATE * np.log((met + usual) / (seen * usual / usual.sum() + usual))
    weights[-1] = model.weights[-1]
    # Nodes start from the shares of their branches, features at nodes from nothing.
    even = SHRINK / CLASSES
    weights[PLACES[4]:PLACES[5]] = 0
    weights[PLACES[5]:PLACES[6]] = np.log((met + even) / (seen + SHRINK))[PLACES[5]:PLACES[6]]
    model.weights = weights.astype(np.float32)
    tree = slice(PLACES[4], PLACES[6])
    for _ in range(rounds):
        expected = added_up(texts.mapInArrow(expectations(model), schema))
        before = np.broadcast_to(usual, met.shape).copy()
        before[tree] = np.maximum(SHRINK * expected[tree] / np.maximum(seen[tree], 1), 1e-3)
        weights = weights + RATE * np.log((met + before) / (expected + before))
        model.weights = weights.astype(np.float32)
    return model


def scorer(model: Model):
    """From (row, id, text): a row with the sums of each text, and one for each of its words beyond the head."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            number = batch.column(1).to_numpy()
            for start, data, offsets in text_slices(batch.column(2)):
                t = tokens(data, offsets)
                texts = len(offsets) - 1
                kind = classes_of(model, t)
                value = np.empty(len(kind))
                rows = features(t)
                for i in range(0, len(kind), STEP_TOKENS):
                    p = class_probabilities(model.weights, rows[i:i + STEP_TOKENS])
                    value[i:i + STEP_TOKENS] = np.log10(p[np.arange(len(p)), kind[i:i + STEP_TOKENS]])
                for some, at, branch in branches(t, rows, kind):
                    p = softmax(model.weights, at)
                    value[some] += np.log10(p[np.arange(len(p)), branch])
                value -= model.leaf_log[leaves_of(t.name, kind)]
                hit = np.zeros(len(kind), dtype=bool)
                known = np.zeros(len(kind))
                if len(model.head):
                    place = np.minimum(np.searchsorted(model.head, t.name), len(model.head) - 1)
                    hit = model.head[place] == t.name
                    known[hit] = model.head_log[place[hit]]
                sums = lambda x: np.bincount(t.text, x, minlength=texts)  # noqa: E731, B023
                own = number[start:start + texts]
                rare, name = t.text[~hit], t.name[~hit]
                order = np.lexsort((name, rare))
                rare, name = rare[order], name[order]
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (rare[1:] != rare[:-1]) | (name[1:] != name[:-1])
                begin = np.flatnonzero(new)
                times = np.diff(np.append(begin, len(rare)))
                blank = len(begin)
                fill = lambda x, kind: pa.concat_arrays([pa.array(x, type=kind), pa.nulls(blank, kind)])  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([ids.slice(start, texts), pa.nulls(blank, ids.type)]),
                    pa.array(np.concatenate([own, own[rare[begin]]])),
                    pa.concat_arrays([pa.nulls(texts, pa.int64()), pa.array(name[begin].view(np.int64))]),
                    pa.array(np.concatenate([np.bincount(t.text, minlength=texts), times])),
                    fill(sums(hit).astype(np.int64), pa.int64()), fill(sums(known), pa.float64()), fill(sums(value), pa.float64()),
                ], ["id", "row", "word", "n", "n_known", "known", "classes"])

    return score


def leaf_counts(model: Model):
    """(leaf, n, v): words counted and different words of each leaf, from (word, ending, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, ending, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("word", "ending", "n"))
            name = name.view(np.uint64)
            leaf, at = np.unique(leaves_of(name, classes_of(model, Tokens(name, ending, None, None))), return_inverse=True)
            sums = np.zeros(len(leaf), dtype=np.int64)
            np.add.at(sums, at, n)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(sums), pa.array(np.bincount(at, minlength=len(leaf)))], ["leaf", "n", "v"])

    return count


def learn(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame, int, int]:
    """(model, counts (word, n), N, V) of a frame with one column of training texts."""
    counted = texts.mapInArrow(count_tokens, "pairs boolean, key bigint, ending int, n bigint")
    counts = materialize(counted.groupBy("pairs", "key").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "counts")
    vocabulary = counts.filter("not pairs").select(F.col("key").alias("word"), "ending", "n")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    pairs = np.zeros((ENDINGS, ENDINGS))
    beside = counts.filter("pairs").select("key", "n").toArrow()  # at most ENDINGS squared rows
    pairs.reshape(-1)[beside.column("key").to_numpy()] = beside.column("n").to_numpy()
    cluster = 1 + TOP + clustered(pairs, CLASSES - 1 - TOP)

    order = [F.col("n").desc(), F.col("word")]
    head = vocabulary.orderBy(*order).limit(HEAD).select("word", "n").toArrow()
    word, n = head.column("word").to_numpy().view(np.uint64), head.column("n").to_numpy()
    ranked = np.lexsort((word.view(np.int64), -n))
    top = word[ranked][word[ranked] != END][:TOP]
    by_word = np.argsort(word)
    by_top = np.argsort(top)

    kind = F.element_at(F.array(*[F.lit(int(c)) for c in cluster]), F.col("ending") + 1)
    special = {int(np.int64(END.view(np.int64))): 0} | {int(w): k + 1 for k, w in enumerate(top.view(np.int64))}
    lookup = F.create_map(*[F.lit(x).cast("bigint") for pair in special.items() for x in pair])
    of_class = vocabulary.groupBy(F.coalesce(F.element_at(lookup, F.col("word")), kind).alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    totals = np.full(CLASSES, ADDED)
    share = np.ones(CLASSES)
    for r in of_class.collect():  # at most CLASSES rows
        totals[r["kind"]] += r["n"] + ADDED * r["v"]
        share[r["kind"]] += r["n"]
    weights = np.zeros((TABLE_ROWS, CLASSES), dtype=np.float32)
    weights[-1] = np.log(share / share.sum())
    model = Model(
        top=top[by_top], top_class=1 + by_top, cluster=cluster, weights=weights, head=word[by_word], head_log=np.log10(n[by_word] + ADDED),
        class_log=np.log10(totals), leaf_log=np.repeat(np.log10(totals), CLASSES**LEVELS),
    )
    in_leaves = vocabulary.mapInArrow(leaf_counts(model), "leaf bigint, n bigint, v bigint").groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    within = np.full(LEAVES, ADDED)
    for r in in_leaves.collect():  # at most LEAVES rows
        within[r["leaf"]] += r["n"] + ADDED * r["v"]
    tree = np.arange(LEAVES) // CLASSES**LEVELS > TOP
    model.leaf_log[tree] = np.log10(within[tree])
    return trained(dealt(texts, int(total)), model, rounds), vocabulary.select("word", "n"), int(total), int(distinct)


def language_scores(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: the id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    bound_batches(documents.sparkSession)
    content = F.coalesce(F.col(text), F.lit("")).alias("text")
    learned = documents.filter(~held_out(id_col, FOLDS)).select(content)
    model, counts, total, distinct = learn(learned, rounds)

    kind = documents.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("row", T.LongType()), T.StructField("word", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("known", T.DoubleType()), T.StructField("classes", T.DoubleType()),
    ])
    numbered = documents.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), content)
    parts = materialize(numbered.mapInArrow(scorer(model), schema), "scores")
    rare = parts.filter("word is not null").select("row", "word", F.col("n").alias("times"))
    met = rare.join(counts, "word", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(ADDED))).alias("rare"),
    )
    joined = parts.filter("word is null").join(sums, "row", "left")
    logs = F.col("known") + F.coalesce(F.col("rare"), F.lit(0.0))
    scale = float(np.log10(total + ADDED * (distinct + 1)))
    return joined.select(
        F.col("id").alias(id_col), held_out("id", FOLDS).alias("held_out"), F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce(F.col("rare_known"), F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (logs - F.col("n") * F.lit(scale)).alias("base_score"),
        (logs + F.col("classes")).alias("score"),
    )
