"""Exact duplicates against grouping by the text, also with fingerprints that clash."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from plumbline.llm import exact

TEXTS = ["a", "b", "", None, "c" * 200_000, "c" * 199_999 + "d", "same words here", "é", "a\x00", "\x00a", "A"]


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, f"h2 {r[0]}", 5, "odd", "f") for r in rows], "doc_id long, text string, _h1 string, kept string, _h2 string, _size int, _odd string, _f string")


def some_rows():
    draw = random.Random(2)
    rows = [(i, draw.choice(TEXTS), "x", "y") for i in range(120)]
    return rows + rows[:5] + [(None, "a", None, None), (None, "only null", None, None), (None, "only null", None, "z")]


@pytest.mark.parametrize("primes", [exact.PRIMES, (2, 3)])
def test_equals_grouping(spark, primes):
    rows = some_rows()
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    found = exact.decisions(frame_of(spark, rows), primes=primes).collect()
    assert len(found) == len(rows)
    stays = {}
    for r in found:
        stays.setdefault(r["text_sha256"], []).append(r)
    assert set(stays) == {hashlib.sha256(t.encode()).hexdigest() for t in groups}
    for text, ids in groups.items():
        got = stays[hashlib.sha256(text.encode()).hexdigest()]
        largest = max((i for i in ids if i is not None), default=None)
        assert sorted(r["doc_id"] or -1 for r in got) == sorted(i or -1 for i in ids)
        assert {(r["keep_id"], r["group_size"]) for r in got} == {(largest, len(ids))}
        assert [r["doc_id"] for r in got if r["kept"]] == [largest]


@pytest.mark.parametrize("primes", [exact.PRIMES, (2, 3)])
def test_unique_keeps_columns_and_one_of_each(spark, primes):
    rows = some_rows()
    kept = exact.unique(frame_of(spark, rows), primes=primes)
    assert kept.columns == frame_of(spark, rows).columns
    found = kept.collect()
    given = {tuple(r) for r in frame_of(spark, rows).collect()}
    assert all(tuple(r) in given for r in found)
    assert sorted(r["text"] or "" for r in found) == sorted({t or "" for _, t, *_ in rows})
    for r in found:
        assert r["doc_id"] == max((i for i, t, *_ in rows if (t or "") == (r["text"] or "") and i is not None), default=None)


def test_empty_table(spark):
    frame = frame_of(spark, some_rows()).limit(0)
    assert exact.decisions(frame).count() == 0
    assert exact.unique(frame).count() == 0


def test_fingerprints_compose():
    draw = np.random.default_rng(1)
    for left, right in ((5, 7), (0, 3), (1500, 4097), (1024, 1024), (9, 0)):
        data = draw.integers(0, 256, left + right).astype(np.uint8)
        whole = exact.fingerprints(data, np.array([0, left + right]))[0]
        parts = exact.fingerprints(data, np.array([0, left, left + right]))
        for k, p in enumerate(exact.PRIMES):
            plain = 0
            for byte in data.tolist():
                plain = (plain * exact.BASE + byte) % p
            assert whole[k] == plain == exact.joined(int(parts[0, k]), int(parts[1, k]), right, p)
