"""The manifest against a plain tree built level by level, with small blocks so that groups span several rounds."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def plain_leaf(row) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, for each leaf the (before, after) of each level)."""
    proofs = [[] for _ in leaves]
    owners = [[k] for k in range(len(leaves))]
    level = list(leaves)
    while len(level) > 1:
        above, owned = [], []
        for a in range(0, len(level), 3):
            run = level[a:a + 3]
            for k in range(len(run)):
                for leaf in owners[a + k]:
                    proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(h("".join(run)))
            owned.append([leaf for k in range(a, a + len(run)) for leaf in owners[k]])
        level, owners = above, owned
    return level[0], proofs


def plain_manifest(rows):
    """Sorted (id, leaf, subroot, root, proof) of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    trees = []
    for name in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append((members, *plain_tree([plain_leaf(r) for r in members])))
    root, tops = plain_tree([subroot for _, subroot, _ in trees]) if trees else (None, [])
    return sorted(
        (str(r[0]), plain_leaf(r), subroot, root, own + top)
        for (members, subroot, proofs), top in zip(trees, tops, strict=True) for r, own in zip(members, proofs, strict=True)
    )


def some_rows(count, sources, seed=3):
    draw = random.Random(seed)
    names = [None, "", *(f"s{k}" for k in range(sources)), "é", "Z"]
    rows = [(i, draw.choice(names[:2 + sources] if i % 3 else ["s0"]), draw.choice(["en", None, ""]), draw.choice([0, None, i]),
             draw.choice([None, "", f"line {i}\nnext", "é" * 40])) for i in range(count)]
    return rows + [(None, "s0", None, None, None)] * 3 + [(None, None, "en", 1, "x")] + rows[:4]


def frame_of(spark, rows):
    extra = [(*r, "keep", 1) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, source string, lang string, n_chars long, text string, digest string, tree long")


def told(frame):
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]]) for r in frame.collect())


@pytest.mark.parametrize(("count", "sources", "levels"), [(200, 2, 1), (200, 90, 2), (40, 1, 6), (1, 0, 1), (13, 40, 1)])
def test_equals_plain_tree(spark, count, sources, levels):
    rows = some_rows(count, sources)
    found = merkle.manifest(frame_of(spark, rows), levels=levels)
    assert found.columns == ["doc_id", "leaf", "found_leaf", "subroot", "root", "proof"]
    assert told(found) == plain_manifest(rows)


def test_one_row_and_no_rows(spark):
    one = merkle.manifest(frame_of(spark, [(5, None, None, None, None)])).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["proof"]) for r in one] == [(plain_leaf((5, None, None, None, None)),) * 3 + ([],)]
    assert merkle.manifest(frame_of(spark, []).limit(0)).count() == 0


def test_proofs_find_what_was_changed(spark):
    rows = some_rows(60, 2)
    changed = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    found = merkle.manifest(frame_of(spark, rows), found={"text": changed}, levels=2)
    folded = found.withColumn("folded", merkle.folded(F.col("found_leaf"), F.col("proof"))).collect()
    for r in folded:
        digest = r["found_leaf"]
        for before, after in r["proof"]:
            digest = h(before + digest + after)
        assert r["folded"] == digest
        assert (digest == r["root"]) == (r["found_leaf"] == r["leaf"])
    assert {r["found_leaf"] == r["leaf"] for r in folded} == {True, False}


def test_other_fields_groups_and_id_types(spark):
    rows = [("b", 1, "x"), ("a", 1, "y"), (None, 2, None), ("a", None, "z" * 300_000)]
    frame = spark.createDataFrame(rows, "name string, part int, body string")
    found = merkle.manifest(frame, id_col="name", group="part", fields=["name", "body"]).collect()
    leaf = {r: plain_leaf((r[0], r[2])) for r in rows}
    subroots = [leaf[rows[3]], h(leaf[rows[1]] + leaf[rows[0]]), leaf[rows[2]]]
    assert {r["root"] for r in found} == {h("".join(subroots))}
    assert sorted(r["subroot"] for r in found) == sorted([*subroots, subroots[1]])


def test_many_groups_meet_their_sizes_in_a_salted_join(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW_GROUPS", 1)
    rows = some_rows(50, 3)
    assert told(merkle.manifest(frame_of(spark, rows), levels=1)) == plain_manifest(rows)


def test_queue_stays_small():
    sizes = []
    push = merkle.heapq.heappush

    def counted(queue, item):
        push(queue, item)
        sizes.append(len(queue))

    merkle.heapq.heappush = counted
    try:
        nodes = list(merkle.forward(((k, str(k)) for k in range(3**7)), 3**7, 7))
    finally:
        merkle.heapq.heappush = push
    assert len(nodes) == (3**7 - 1) // 2
    assert max(sizes) <= 3 * 7
