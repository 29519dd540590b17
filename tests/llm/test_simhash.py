"""Fingerprints, links and components against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash

from plumbline.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(values, radius=4):
    """The least index of the component of each value."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(values))]


def test_close_pairs_equal_all_pairs():
    draw = random.Random(5)
    for n, spread in ((1, 3), (2, 2), (63, 5), (64, 8), (65, 3), (200, 6), (700, 9)):
        base = [draw.getrandbits(64) for _ in range(max(1, n // 20))]
        values = [draw.choice(base) ^ sum(1 << b for b in {draw.randrange(64) for _ in range(draw.randrange(spread))}) for _ in range(n)]
        groups = sorted(draw.randrange(4) for _ in range(n))
        found = {
            (int(a), int(b)) for left, right in simhash.close_pairs(np.array(values, np.uint64), np.array(groups))
            for a, b in zip(left, right, strict=True)
        }
        assert found == {(i, j) for j in range(n) for i in range(j) if groups[i] == groups[j] and (values[i] ^ values[j]).bit_count() <= 4}


def test_cells_may_go_over_batches():
    draw = random.Random(6)
    values = [draw.getrandbits(64) for _ in range(5)]
    values = np.array([v ^ (1 << k) for v in values for k in range(40)], dtype=np.uint64)
    cells = np.repeat(np.arange(5), 40)
    batches = [
        pa.RecordBatch.from_arrays([pa.array(cells[i:i + 7]), pa.array(values[i:i + 7].view(np.int64))], ["cell", "fp"]) for i in range(0, 200, 7)
    ]
    links = sum(b.num_rows for b in simhash.compare_keys(iter(batches)))
    assert links == 200 - 5  # a tree for each cell


def test_components_of_chains_and_stars(spark):
    draw = random.Random(7)
    nodes = [draw.getrandbits(62) - 2**61 for _ in range(300)]
    edges = list(zip(nodes[:120], nodes[1:120], strict=False)) + [(nodes[150], n) for n in nodes[151:250]] + [(nodes[260], nodes[261])] * 3
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: min(part) for part in (nodes[:120], nodes[150:250], nodes[260:262]) for n in part}
    assert {n: found.get(n, n) for n in want} == want


def fixture():
    draw = random.Random(8)
    texts = []
    for _ in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(400)]
        texts.append(" ".join(words))
        for _ in range(4):
            words = [w if draw.random() > 0.004 else "changed" for w in words]
            texts.append("  ".join(words).upper() if draw.random() < 0.3 else "\n".join(words))
    texts += ["", None, "   ", "one two", "one two", "One\tTWO", "one two three", "a b c d"]
    return [(i, t, "x", "y") for i, t in enumerate(texts)]


def test_near_duplicates_equal_all_pairs(spark):
    rows = fixture() + [(None, "one two", None, None), (3, fixture()[3][1], "x", "y")]
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    label = classes_of(prints)
    want = sorted(
        (i if i is not None else -1, format(p, "016x"), min(rows[j][0] for j in range(len(rows)) if label[j] == k and rows[j][0] is not None))
        for (i, *_), p, k in zip(rows, prints, label, strict=True)
    )
    frame = spark.createDataFrame(
        [(*r, "mine", r[0]) for r in rows], "doc_id long, text string, fp string, component_id string, row string, _fp long",
    )
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame).collect())
    assert got == want
    assert len({c for *_, c in want}) < len(want) - 10
    one = simhash.one_of_each(frame)
    assert one.columns == frame.columns
    assert {tuple(r) for r in one.collect()} <= {tuple(r) for r in frame.collect()}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c for *_, c in want})


def test_one_of_each_goes_by_links_and_not_by_ids(spark):
    draw = random.Random(9)
    texts = [" ".join(f"w{draw.randrange(5000)}" for _ in range(60)) for _ in range(12)]
    rows = [(None, t) for t in texts[:6]] + [(None, texts[0])] + [(7, t) for t in texts[6:10]] + [(8, texts[10]), (None, texts[10])]
    assert len(set(classes_of([plain_fingerprint(t) for _, t in rows]))) == 11
    one = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {(None, t) for t in texts[:6]} | {(7, t) for t in texts[6:10]} | {(8, texts[10])}
    got = [tuple(r) for r in one.collect()]
    assert len(got) == len(want) and set(got) == want


def test_tiles_of_a_hot_key_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    base = 0x0123456789ABCDEF
    values = sorted({base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5)})
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    found = simhash.components(simhash.links(frame)).collect()
    assert len({r["root"] for r in found}) == 1 and len(found) == len(values) - 1


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(frame).count() == 0
    assert simhash.one_of_each(frame).count() == 0


def test_rows_that_differ_in_nulls_only_are_not_confused(spark):
    rows = [(None, "a b c d e", "en", None), (None, "a b c d e", None, "en"), (None, "a b c d e", None, "en"), (4, None, None, None), (4, "", "x", None)]
    one = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(one) == 2 and {tuple(r) for r in one} <= set(rows)


def test_members_of_a_hot_root_meet_it_in_several_tasks(spark):
    base = 0x0123456789ABCDEF
    prints = [(k, base ^ (1 << k)) for k in range(60)] + [(100, base), (101, 77)]
    frame = spark.createDataFrame(prints, "id long, fp long")
    rows = {r["fp"]: (r["component_id"], r["root"]) for r in simhash.classes(frame, "id").collect()}
    least = min(p for i, p in prints if i <= 100)
    assert all(rows[p] == ((0, least) if i <= 100 else (101, 77)) for i, p in prints)
