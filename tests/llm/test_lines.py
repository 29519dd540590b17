"""Line de-duplication against plain sets, and an index after insertions and deletions against a fresh one."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import lines

LONG = ["a line that is repeated", "  A Line that is REPEATED\t", "another line of words", "ééééééééééé", "ÉÉÉÉÉÉÉÉÉÉÉ", "short", "", "\v", "012345678", "0123456789"]


def plain_key(line):
    key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    return key if len(key) >= 10 else None


def plain_clean(rows):
    """Sorted (id, n_lines, n_dropped, kept) of (id, text)."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if (key := plain_key(line)) is not None:
                holders.setdefault(key, set()).add(i)
    first = {key: min(ids, key=lambda i: (i is None, i or 0)) for key, ids in holders.items()}
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        stay = [p for p in parts if (key := plain_key(p)) is None or first[key] == i]
        out.append((str(i), len(parts), len(parts) - len(stay), "\n".join(stay)))
    return sorted(out)


def some_rows(count=60, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        parts = [draw.choice([*LONG, f"its own line number {i}", f"shared by few {i % 7} {draw.randrange(3)}"]) for _ in range(draw.randrange(6))]
        rows.append((i, "\n".join(parts) if parts else draw.choice([None, ""])))
    hot = "the one line that everybody has"
    rows += [(i + count, hot + "\n" + f"a line of number {i}\n" + hot) for i in range(20)]
    return rows + rows[:3] + [(2, "another text of an id that is there\n" + hot), (None, hot), (None, "only without an id\n" + hot), (None, None)]


def frame_of(spark, rows):
    extra = [(i, text, "mine", i, "k") for i, text in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, key string, mark long, row string")


def told(cleaned):
    return sorted((str(r["row"]["doc_id"]), r["n_lines"], r["n_dropped"], r["kept"]) for r in cleaned.collect())


def state(index):
    """References, counts, and for each stored key whether its filter knows it."""
    counts = {bytes(r["key"]): (r["n_docs"], r["first"]) for r in index.counts.collect()}
    refs = sorted({(bytes(r["key"]), str(r["id"])) for r in index.refs.collect()})
    return counts, refs


def test_equals_plain_sets_and_keeps_columns(spark):
    rows = some_rows()
    cleaned = lines.deduplicated(frame_of(spark, rows))
    assert told(cleaned) == plain_clean(rows)
    assert all((r["row"]["key"], r["row"]["mark"], r["row"]["row"]) == ("mine", r["row"]["doc_id"], "k") for r in cleaned.collect())


def test_long_texts_and_empty_tables(spark):
    rows = [(1, "\n".join(f"line number {k} of many" for k in range(30_000))), (2, "x" * 500_000 + "\n" + "line number 7 of many"), (3, "\n" * 9)]
    assert told(lines.deduplicated(frame_of(spark, rows))) == plain_clean(rows)
    empty = frame_of(spark, rows).limit(0)
    assert lines.deduplicated(empty).count() == 0
    index = lines.LineIndex.empty(empty).insert(empty).delete(empty.select("doc_id"))
    assert told(index.clean(frame_of(spark, [(1, "a line of some words")]))) == [("1", 1, 0, "a line of some words")]


def test_inserts_and_deletes_are_reversible(spark):
    rows = some_rows()
    parts = [rows[:30], rows[30:], rows[10:14]]  # the third is there already
    index = lines.LineIndex.empty(frame_of(spark, rows), shard_keys=20)
    for part in parts:
        index = index.insert(frame_of(spark, part))
    whole = lines.LineIndex.empty(frame_of(spark, rows), shard_keys=20).insert(frame_of(spark, rows))
    assert state(index) == state(whole)
    assert told(index.clean(frame_of(spark, rows))) == plain_clean(rows)

    out = {0, 3, 5, 60, 61, None, 999_999}
    left = [r for r in rows if r[0] not in out]
    less = index.delete(frame_of(spark, [(i, None) for i in out]).select("doc_id"))
    assert state(less) == state(lines.LineIndex.empty(frame_of(spark, rows), shard_keys=20).insert(frame_of(spark, left)))
    assert told(less.clean(frame_of(spark, left))) == plain_clean(left)
    assert told(index.clean(frame_of(spark, rows))) == plain_clean(rows)  # the index before is still there

    back = less.insert(frame_of(spark, [r for r in rows if r[0] in out]))
    assert state(back) == state(whole)


def test_filters_know_the_stored_keys_and_no_deleted_ones(spark):
    rows = some_rows(200)
    index = lines.LineIndex.empty(frame_of(spark, rows), shard_keys=50).insert(frame_of(spark, rows))
    assert index.shards > 1
    index = index.delete(frame_of(spark, [(i, None) for i in range(0, 200, 2)]).select("doc_id"))
    keys = index.counts.select(index._shard().alias("shard"), "key").collect()
    filters = {r["shard"]: lines.Cuckoo.load(bytes(r["buckets"]), bytes(r["stash"])) for r in index.filters.collect()}
    assert sum(map(len, filters.values())) == len(keys)
    for r in keys:
        assert filters[r["shard"]].contains([bytes(r["key"])])[0]


def test_hot_line_is_one_row_in_its_shard(spark):
    hot = "the line of a third of all documents"
    frame = frame_of(spark, [(i, f"{hot}\nown line number {i}" if i % 3 == 0 else f"own line number {i}") for i in range(900)])
    index = lines.LineIndex.empty(frame).insert(frame)
    assert index.counts.count() == 901
    salted = index.refs.withColumn("salt", F.pmod(F.xxhash64("mark", "id"), F.lit(lines.SALTS)))
    most = salted.groupBy("key", "salt").count().agg(F.max("count")).first()[0]
    assert most < 2 * 300 / lines.SALTS + 10


@pytest.mark.parametrize("load", [0.5, 0.95, 1.3])
def test_cuckoo_filter(load):
    draw = np.random.default_rng(4)
    keys = [draw.bytes(16) for _ in range(4000)]
    there = lines.Cuckoo(np.zeros((1024, 4), np.uint16), np.empty(0, np.uint64))
    inside, outside = keys[:int(load * 2048)], keys[3000:]
    for a in range(0, len(inside), 300):
        there.insert(inside[a:a + 300])
    assert len(there) == len(inside) and there.contains(inside).all()
    assert there.contains(outside).mean() < 0.01
    gone, kept = inside[::2], inside[1::2]
    there.delete(gone)
    assert len(there) == len(kept) and there.contains(kept).all()
    assert there.contains(gone).mean() < 0.01
    again = lines.Cuckoo.load(*there.dump())
    again.delete(kept)
    assert len(again) == 0


def test_equal_fingerprints_are_deleted_one_by_one():
    key = bytes(16)
    there = lines.Cuckoo.sized(10)
    there.insert([key] * 11)
    assert len(there) == 11 and len(there.stash) == 3
    there.delete([key] * 10)
    assert len(there) == 1 and there.contains([key])[0]
