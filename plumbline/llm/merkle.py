"""A Merkle manifest of a table, with a proof for each row, by time-forward processing.

Rows are the leaves of a tree for each group; the roots of the groups are the leaves of one more tree. Nodes are labelled so that
children come before their parent: by the last leaf below a node, then by its level. A forward sweep visits nodes in the order of
their labels; a priority queue ordered by label delivers the digests of children to their parent. A reversed sweep delivers to each
node the proof suffix of its parent (the siblings met on the way to the root), from which it makes those of its children.

A tree is cut into blocks of FAN ** BLOCK_LEVELS neighbouring leaves. Inside a block the queue is a heap of at most FAN entries a
level. Between blocks the messages wait in sorted shuffle files: the roots of the blocks are the leaves of the next round, and on the
way back a block's proof suffix is sorted in front of its leaves. A group of any size is therefore spread over many tasks, and there
are as many rounds as the height of the largest tree has blocks.

Groups are ordered with null first, rows inside a group by id with null first, then by their digest; rows that are equal in all
fields are equal leaves side by side. A null field is `-`, an empty one `0:`. A group of one row has that leaf as its root; a table
of one group has that group's root as the root, and an empty table has no rows. Columns beside the fields are not read, so their
names cannot clash. A text of any length becomes a digest in the scan and is not moved.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Mapping, Sequence
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.frames import bound_batches
from plumbline.sources.tables import materialize, number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Children of a node.
FAN = 3
# Levels of a tree that one block spans.
BLOCK_LEVELS = 6
# Groups whose sizes are sent to all tasks; more are joined by a salted shuffle.
FEW_GROUPS = 50_000
SALTS = 16

NODE = "tree bigint, place bigint, size bigint, digest string"
PATH = "array<struct<before:string,after:string>>"
PATH_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

Step = tuple[str, str]


def framed(value: Column) -> Column:
    """A field as it enters a digest: `-` for null, else the number of its UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[framed(field) for field in fields]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    level, reach = 0, 1
    while reach < size:
        level, reach = level + 1, reach * FAN
    return level


def forward(leaves: Iterable[tuple[int, str]], size: int, top: int) -> Iterator[tuple[int, int, str]]:
    """The inner nodes of a block in the order of their labels: (level, place, digest), up to level `top`.

    `leaves` are (place, digest) in ascending order, `size` is the number of leaves of the whole tree.
    """
    queue: list[tuple[int, int, int, str]] = []

    def send(level: int, place: int, digest: str) -> None:
        if level < top:
            last = min((place // FAN + 1) * FAN ** (level + 1), size) - 1
            heapq.heappush(queue, (last, level + 1, place, digest))

    for now, leaf in leaves:
        send(0, now, leaf)
        while queue and queue[0][0] <= now:
            last, level, place, _ = queue[0]
            children = []
            while queue and queue[0][:2] == (last, level):
                children.append(heapq.heappop(queue)[3])
            digest = sha256("".join(children).encode()).hexdigest()
            yield level, place // FAN, digest
            send(level, place // FAN, digest)


def backward(leaves: Sequence[tuple[int, str]], size: int, top: int, suffix: tuple[Step, ...]) -> Iterator[tuple[int, tuple[Step, ...]]]:
    """The proof of each leaf of a block, last leaf first: (place, steps), from the proof suffix of the block's root."""
    digests = {(0, place): digest for place, digest in leaves}
    digests.update({(level, place): digest for level, place, digest in forward(leaves, size, top)})
    queue: list[tuple[int, int, int, tuple[Step, ...]]] = []

    def send(level: int, place: int, steps: tuple[Step, ...]) -> None:
        last = min((place + 1) * FAN**level, size) - 1
        heapq.heappush(queue, (-last, -level, place, steps))

    send(top, leaves[0][0] // FAN**top, suffix)
    while queue:
        _, negative, place, steps = heapq.heappop(queue)
        if negative == 0:
            yield place, steps
            continue
        below = -negative - 1
        run = [digests[below, child] for child in range(place * FAN, (place + 1) * FAN) if (below, child) in digests]
        for k in range(len(run)):
            send(below, place * FAN + k, (("".join(run[:k]), "".join(run[k + 1:])), *steps))


def block_tops(levels: int):
    """Sweep forward over blocks: a row for each block's root, as a leaf of the next round."""
    span = FAN**levels

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("tree", "place", "size", "digest")), strict=True)

        found: list[tuple] = []
        for (tree, block, size), members in groupby(rows(), key=lambda r: (r[0], r[1] // span, r[2])):
            top = min(levels, height(size))
            leaves = ((place, digest) for _, place, _, digest in members)
            root = next(leaves)[1] if top == 0 else next(d for level, _, d in forward(leaves, size, top) if level == top)
            found.append((tree, block, -(-size // span), root))
            if len(found) == 4096:
                yield node_batch(found)
                found = []
        yield node_batch(found)

    return sweep


def node_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["tree", "place", "size", "digest"])


def block_proofs(levels: int):
    """Sweep backward over blocks: each leaf with its proof. A block's message comes in front of its leaves."""
    span = FAN**levels

    def batch_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        kinds = {"tree": pa.int64(), "place": pa.int64(), "id": id_type, "digest": pa.string(), "found": pa.string(),
                 "proof": PATH_TYPE, "subroot": pa.string(), "root": pa.string()}
        steps = [step for r in rows for step in r[5]]
        ends = [0]
        for r in rows:
            ends.append(ends[-1] + len(r[5]))
        texts = [pa.array([step[k] for step in steps], pa.string()) for k in (0, 1)]
        pairs = pa.StructArray.from_arrays(texts, ["before", "after"])
        columns = [pa.array([r[k] for r in rows], kind) if k != 5 else pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                   for k, kind in enumerate(kinds.values())]
        return pa.RecordBatch.from_arrays(columns, list(kinds))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = pa.null()

        def rows():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("id").type
                yield from batch.to_pylist()

        found: list[tuple] = []
        for (tree, _), members in groupby(rows(), key=lambda r: (r["tree"], r["block"])):
            message, *leaves = members
            size = leaves[0]["size"]
            suffix = tuple((s["before"], s["after"]) for s in message["proof"])
            known = {leaf["place"]: leaf for leaf in leaves}
            nodes = [(leaf["place"], leaf["digest"]) for leaf in leaves]
            for place, steps in backward(nodes, size, min(levels, height(size)), suffix):
                leaf = known[place]
                found.append((tree, place, leaf["id"], leaf["digest"], leaf["found"], steps, message["subroot"], message["root"]))
            if len(found) >= 4096:
                yield batch_of(found, id_type)
                found = []
        if found:
            yield batch_of(found, id_type)

    return sweep


def in_blocks(nodes: DataFrame, levels: int, *order: str) -> DataFrame:
    dealt = nodes.withColumn("block", F.expr(f"place div {FAN**levels}L")) if "block" not in nodes.columns else nodes
    return dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def tops(leaves: DataFrame, largest: int, levels: int) -> list[DataFrame]:
    """The leaves of each round; the last one has a node for each tree, its root."""
    rounds = [leaves]
    while largest > 1:
        dealt = in_blocks(rounds[-1].select("tree", "place", "size", "digest"), levels, "place")
        rounds.append(materialize(dealt.mapInArrow(block_tops(levels), NODE), "tops"))
        largest = -(-largest // FAN**levels)
    return rounds


def proofs(rounds: list[DataFrame], messages: DataFrame, levels: int) -> DataFrame:
    """The leaves of the first round with their proofs, from a message for each tree: tree, proof, subroot, root.

    A round's leaves get their proofs from the messages to their blocks; these proofs are the messages to the blocks of the round below.
    """
    sent = messages.withColumn("block", F.lit(0).cast("bigint"))
    if len(rounds) > 1:
        rounds = rounds[:-1]
    for number, leaves in reversed(list(enumerate(rounds))):
        if "id" not in leaves.columns:
            leaves = leaves.withColumns({"id": F.lit(None).cast("bigint"), "found": F.lit(None).cast("string")})
        id_type = leaves.schema["id"].dataType
        message = sent.select(
            "tree", "block", F.lit(-1).cast("bigint").alias("place"), F.lit(0).cast("bigint").alias("size"), F.lit("").alias("digest"),
            F.lit(None).cast(id_type).alias("id"), F.lit(None).cast("string").alias("found"), "proof", "subroot", "root",
        )
        nodes = leaves.withColumn("block", F.expr(f"place div {FAN**levels}L")).select(
            "tree", "block", "place", "size", "digest", "id", "found", F.lit(None).cast(PATH).alias("proof"),
            F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"),
        )
        columns = f"tree bigint, place bigint, id {id_type.simpleString()}, digest string, found string, proof {PATH}, subroot string, root string"
        done = in_blocks(message.unionByName(nodes), levels, "place").mapInArrow(block_proofs(levels), columns)
        if number:
            sent = materialize(done.select("tree", F.col("place").alias("block"), "proof", "subroot", "root"), "suffixes")
    return done


def with_sizes(numbered: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add the first number and the size of each row's group. Few groups are sent to all tasks, many meet in a salted join."""
    salts = 1 if sizes.count() <= FEW_GROUPS else SALTS
    known = sizes.select(F.col("group").alias("_of"), "first", "size")
    if salts == 1:
        return numbered.join(F.broadcast(known), F.col("group").eqNullSafe(F.col("_of"))).drop("_of")
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = F.col("group").eqNullSafe(F.col("_of")) & (F.pmod("number", F.lit(salts)) == F.col("_salt"))
    return numbered.join(known, met).drop("_of", "_salt")


def manifest(
    documents: DataFrame, *, id_col: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
    found: Mapping[str, Column] | None = None, levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per document: the id, leaf, found_leaf, subroot, root and proof.

    `found` names fields as they are now, over the columns of `documents`; found_leaf is the leaf of the row with these values. A row
    is intact if `folded(found_leaf, proof)` is the root. The proof lists for each level, from the leaf to the root, the digests of the
    siblings before and after.
    """
    bound_batches(documents.sparkSession)
    now = {name: F.col(name) for name in fields}
    slim = materialize(documents.select(
        F.col(id_col).alias("id"), F.col(group).alias("group"), leaf_digest(now.values()).alias("digest"),
        leaf_digest({**now, **(found or {})}.values()).alias("found"), F.monotonically_increasing_id().alias("row"),
    ), "leaves")
    numbered = number_rows(slim, [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), "digest", "row"], "number")
    sizes = materialize(numbered.groupBy("group").agg(F.min("number").alias("first"), F.count("*").alias("size")), "groups")
    leaves = with_sizes(numbered, sizes).select(
        F.col("first").alias("tree"), (F.col("number") - F.col("first")).alias("place"), "size", "digest", "id", "found",
    )
    largest, groups = sizes.agg(F.max("size"), F.count("*")).first()
    rounds = tops(leaves, largest or 0, levels)
    roots = rounds[-1].select("tree", "digest")
    above = number_rows(roots, ["tree"], "place").select(
        F.lit(0).cast("bigint").alias("tree"), "place", F.lit(groups).cast("bigint").alias("size"), "digest", F.col("tree").alias("id"),
        F.lit(None).cast("string").alias("found"),
    )
    upper = tops(above, groups, levels)
    start = upper[-1].select("tree", F.expr(f"CAST(array() AS {PATH})").alias("proof"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    told = materialize(
        proofs(upper, start, levels).select(F.col("id").alias("tree"), "proof", F.col("digest").alias("subroot"), "root"), "subroots",
    )
    return proofs(rounds, told, levels).select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), F.col("found").alias("found_leaf"), "subroot", "root", "proof",
    )
