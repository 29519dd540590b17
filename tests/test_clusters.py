"""Bursts and itemsets against plain loops."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta
from itertools import combinations

import pytest

from plumbline.operators import clusters as cl

START = datetime(2024, 1, 1)


def plain_bursts(rows, gap, least):
    out = []
    for key in {k for k, _ in rows}:
        times = sorted(t for k, t in rows if k == key and t is not None)
        runs = []
        for t in times:
            if runs and (t - runs[-1][-1]).total_seconds() <= gap:
                runs[-1].append(t)
            else:
                runs.append([t])
        for run in runs:
            n, total = len(run), len(times)
            due = total * ((run[-1] - run[0]).total_seconds() + gap) / ((times[-1] - times[0]).total_seconds() + gap)
            score = 0.0
            if n > due:
                score = n * math.log(n / due) + ((total - n) * math.log((total - n) / (total - due)) if total > n else 0)
            if n >= least:
                out.append((str(key), run[0], run[-1], n, round(score, 4)))
    return sorted(out)


@pytest.mark.parametrize("gap", [1, 60, 3600])
def test_bursts_equal_loops(spark, gap):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), START + timedelta(seconds=draw.randrange(0, 200_000))) for _ in range(600)]
    rows += [("a", START + timedelta(seconds=50_000 + draw.randrange(60))) for _ in range(80)] + [("c", None), ("d", START), ("a", START - timedelta(days=40))]
    rows += [("e", START + timedelta(seconds=k * gap)) for k in range(5)] + [("f", START + timedelta(seconds=k * (gap + 1))) for k in range(5)]
    frame = spark.createDataFrame(rows, "anomaly_type string, event_ts timestamp").repartition(7)
    got = sorted((str(r[0]), r[1], r[2], r[3], round(r[4], 4)) for r in cl.bursts(frame, gap_seconds=gap, least=2).collect())
    assert got == plain_bursts(rows, gap, 2)
    assert ("e", 5) in {(r[0], r[3]) for r in got} and "f" not in {r[0] for r in got}


def test_a_planted_burst_scores_highest(spark):
    rows = [("a", START + timedelta(hours=5 * k)) for k in range(200)] + [("a", START + timedelta(hours=402, seconds=k)) for k in range(30)]
    best = cl.bursts(spark.createDataFrame(rows, "anomaly_type string, event_ts timestamp"), gap_seconds=600).collect()
    assert [(r["n"], r["burst_start"]) for r in best] == [(30, START + timedelta(hours=402))] and best[0]["score"] > 50


def plain_itemsets(rows, fields, support):
    total = len(rows)
    sets = [[(f, v) for f, v in zip(fields, r, strict=False) if v is not None] + [("types", t) for t in (r[len(fields)] or [])] for r in rows]
    counts = {}
    for items in sets:
        for size in range(1, len(fields) + 2):
            for chosen in combinations(sorted(items), size):
                if len({f for f, _ in chosen}) == size:
                    counts[chosen] = counts.get(chosen, 0) + 1
    least = math.ceil(total * support)
    out = []
    for chosen, n in counts.items():
        if len(chosen) > 1 and n >= least:
            lift = n / total / math.prod(counts[(i,)] / total for i in chosen)
            out.append((len(chosen), ", ".join(f"{f}={v}" for f, v in chosen), n, lift))
    return sorted(out)


@pytest.mark.parametrize("support", [0.01, 0.1, 0.6])
def test_itemsets_equal_loops(spark, support):
    draw = random.Random(5)
    rows = []
    for k in range(500):
        country = draw.choice(["DE", "FR", None, "US", "US"])
        rows.append((country, "card" if country == "US" and draw.random() < 0.8 else draw.choice(["card", "paypal"]), f"user {k}", draw.choice([["x"], ["x", "y"], [], None, ["z"]])))
    frame = spark.createDataFrame(rows, "country string, payment string, who string, types array<string>")
    found = cl.itemsets(frame, ["country", "payment", "who"], support=support, several="types").collect()
    got, want = sorted((r["size"], r["items"], r["n"], r["lift"]) for r in found), plain_itemsets(rows, ["country", "payment", "who"], support)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-4)


def test_without_rows_or_frequent_values(spark):
    frame = spark.createDataFrame([(str(k), str(k)) for k in range(50)], "a string, b string")
    assert cl.itemsets(frame, ["a", "b"], support=0.1).isEmpty()
    assert cl.itemsets(frame.limit(0), ["a", "b"], support=0.1).isEmpty()
