"""Apportionment against handing out blocks one by one, and the mix against its targets."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing


def one_by_one(votes, seats):
    given = [0] * len(votes)
    for _ in range(seats if any(votes) else 0):
        best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * given[i] + 1), -i))
        given[best] += 1
    return given


def test_sainte_lague_equals_one_by_one():
    draw = random.Random(1)
    for _ in range(150):
        votes = [draw.choice([0, 1, 2, 3, 10, 10, 50, draw.randrange(1000)]) for _ in range(draw.randrange(1, 9))]
        seats = draw.randrange(0, 80)
        assert mixing.sainte_lague(np.array(votes), seats).tolist() == one_by_one(votes, seats), (votes, seats)


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1001])
def test_sources_equal_one_by_one(spark, seats):
    votes = [5, 5, 5, 0, 17, 100, 3, 1]
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(votes)], "rank long, target double")
    got = {r["rank"]: r["blocks"] for r in mixing.apportioned(frame, seats).collect()}
    assert [got[i] for i in range(len(votes))] == one_by_one(votes, seats)


def rows_of(draw):
    rows, sources = [], ["b", "a", None, "é", "Z", "tiny", "none"]
    for i in range(400):
        source = draw.choice(sources[:5]) if i > 8 else draw.choice(["tiny", "none"])
        n = 0 if source == "none" else draw.randrange(0, 4) if source == "tiny" else draw.choice([0, 3, 50, 400])
        rows.append((i, " ".join(["w"] * n) if n else draw.choice(["", None, " \n"]), source, "x", "y"))
    return rows + rows[:20] + [(None, "null id here", "a", None, None)]


def targets_of(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = [s for s in names if s not in full]
        level = Fraction(total - sum(3 * sizes[s] for s in full), sum(weight[s] for s in left)) if left else 0
        more = {s for s in left if weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= more


def plain_mix(spark, rows):
    """(id, size, words taken, whole copies) of (id, source, size), with seats handed out one by one; only hashes come from Spark."""
    rows = sorted(rows, key=str)
    frame = spark.createDataFrame([(k, i, n) for k, (i, _, n) in enumerate(rows)], "k long, _id long, size long")
    place = F.xxhash64(F.lit(mixing.SEED), F.col("_id"), F.col("size"))
    hashed = {r["k"]: (r["place"], r["deal"]) for r in frame.select("k", place.alias("place"), F.xxhash64(place, F.lit(mixing.SEED)).alias("deal")).collect()}
    sizes = {}
    for _, source, n in rows:
        sizes[source] = sizes.get(source, 0) + n
    targets = targets_of(sizes)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    blocks = dict(zip(names, one_by_one([targets[s] for s in names], round(float(sum(targets.values())) / mixing.BLOCK_WORDS)), strict=True))
    out = []
    for source in names:
        own = [k for k, r in enumerate(rows) if r[1] == source]
        count = min(-(-len(own) // mixing.SHARD_ROWS), mixing.MAX_SHARDS)
        shards = {}
        for k in own:
            shards.setdefault(hashed[k][1] % count, []).append(k)
        words = {s: sum(rows[k][2] for k in members) for s, members in sorted(shards.items())}
        quotas = dict(zip(words, one_by_one(list(words.values()), blocks[source]), strict=True))
        for shard, members in shards.items():
            due = min(quotas[shard] * mixing.BLOCK_WORDS, words[shard] * mixing.MAX_REPEATS)
            passes, rest = divmod(due, words[shard]) if words[shard] else (0, 0)
            for k in sorted(members, key=lambda k: (hashed[k][0], rows[k][2], rows[k][0] is not None, rows[k][0] or 0)):
                part = min(max(rest, 0), rows[k][2])
                rest -= rows[k][2]
                copies = passes + (2 * part >= rows[k][2]) if rows[k][2] else 0
                out.append((rows[k][0], rows[k][2], passes * rows[k][2] + part, int(copies)))
    return out


@pytest.mark.parametrize("shard_rows", [mixing.SHARD_ROWS, 7])
def test_every_document_is_taken_as_handed_out(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(mixing, "SHARD_ROWS", shard_rows)
    rows = rows_of(random.Random(5))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target string")
    plain = plain_mix(spark, [(i, s, len((t or "").encode().split())) for i, t, s, *_ in rows])
    got = mixing.mix(frame).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in got) == sorted((str(i), n, taken) for i, n, taken, _ in plain)
    copies = Counter(str(r["doc_id"]) for r in mixing.mixed(frame).collect())
    wanted = Counter()
    for i, _, _, n in plain:
        wanted[str(i)] += n
    assert copies == +wanted


def test_mix_meets_its_targets(spark):
    rows = rows_of(random.Random(2))
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    wanted = targets_of(sizes)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target string")
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    source_of = {i: s for i, _, s, *_ in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(float(wanted[s])) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, n in taken.items():
        assert abs(n - wanted[s]) <= mixing.BLOCK_WORDS, (s, n, wanted[s])
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows(spark):
    rows = rows_of(random.Random(3))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, _row string, passes string")
    taken = {}
    for r in mixing.mix(frame).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    mixed = mixing.mixed(frame)
    assert mixed.columns == frame.columns
    got = mixed.collect()
    assert {tuple(r) for r in got} <= set(rows)
    words = sum(len((r["text"] or "").split()) for r in got)
    assert abs(words - sum(taken.values())) <= 400 * 7
    assert mixing.mix(frame.limit(0)).count() == 0
    assert mixing.mixed(frame.limit(0)).count() == 0


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_ROWS", 10)
    rows = [(i, "a b c d e f g h", "big" if i % 3 else "small") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame).collect()
    big = sum(r["taken"] for r in got if r["doc_id"] % 3)
    assert abs(big - 800) <= 16 and all(r["taken"] <= 24 for r in got)
