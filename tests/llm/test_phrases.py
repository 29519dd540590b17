"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from plumbline.llm import phrases

WORDS = ["new", "York", "city", "of", "the", "É", "old", "state", "a"]


def plain_phrases(rows, min_count, max_words=5, top=2000):
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if a >= min_count and len(g) > 1}
        rows_of = []
        for g, a in found.items():
            inside = any(len(o) > len(g) and b >= a and any(o[i:i + len(g)] == g for i in range(len(o) - len(g) + 1)) for o, b in found.items())
            if inside:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            rows_of.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def some_rows(count=300, seed=2):
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        text = ""
        for _ in range(draw.randrange(1, 12)):
            text += draw.choice(["new York City", "state of the", "a a a a", "Old", *WORDS]) + draw.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", " "])
        rows.append((draw.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return rows + [("fr", None), ("fr", ""), ("fr", " .,\n"), ("it", "alone")]


def frame_of(spark, rows):
    extra = [(k, lang, text, 7, "x") for k, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(extra, "doc_id long, lang string, text string, slice long, places string")


def told(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize(("slice_bytes", "sent_bits"), [(64, phrases.SENT_BITS), (1 << 20, 0)])
def test_equals_plain_counts(spark, slice_bytes, sent_bits):
    rows = some_rows()
    found = phrases.collocations(frame_of(spark, rows), min_count=8, slice_bytes=slice_bytes, sent_bits=sent_bits)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert told(found) == plain_phrases(rows, 8)
    assert found.count() > 30


def test_top_and_ties(spark):
    rows = [("en", "b c. a b. c a. d e"), ("en", "b c. a b. c a. d e")] * 3
    found = told(phrases.collocations(frame_of(spark, rows), min_count=2, top=3))
    assert found == plain_phrases(rows, 2, top=3)
    assert [r[2] for r in found] == ["d e", "a b", "b c"]


def test_long_texts_repeated_rows_and_empty_tables(spark):
    rows = [("en", "one two three four five six " * 20_000), *[("en", "x" * 100_000 + " one two")] * 120]
    assert told(phrases.collocations(frame_of(spark, rows))) == plain_phrases(rows, 100)
    assert phrases.collocations(frame_of(spark, rows).limit(0)).count() == 0
    assert phrases.collocations(frame_of(spark, [("en", None)])).count() == 0


def test_shared_counters_keep_too_much_and_lose_nothing(spark, monkeypatch):
    rows = some_rows(60)
    monkeypatch.setattr(phrases, "COUNTERS", 0)  # 1,024 counters a bucket, and one bucket
    monkeypatch.setattr(phrases, "LEAST_BUCKETS", 1)
    assert told(phrases.collocations(frame_of(spark, rows), min_count=4)) == plain_phrases(rows, 4)


def test_judge_adds_up_slices():
    import numpy as np
    import pyarrow as pa

    def entry(counters, counts):
        planes = np.diff(counters, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
        return planes, np.array(counts, np.uint16).tobytes()

    packed = [entry([3, 3, 70_000], [4, 4, 1]), entry([3, 9, 70_000], [2, 65_535, 9]), entry([], [])]
    table = pa.table({"bucket": [0] * 3, "slice": [1, 2, 3], "deltas": [p for p, _ in packed], "counts": [c for _, c in packed]})
    out = phrases.judge(1 << 17, 10)(table).to_pylist()
    assert [(r["slice"], np.unpackbits(np.frombuffer(r["bits"], np.uint8)).tolist()[:3]) for r in out] == [(1, [1, 1, 1]), (2, [1, 1, 1]), (3, [])]
    assert [r["bits"] for r in phrases.judge(1 << 17, 11)(table).to_pylist()][:2] == [b"\x00", b"\x40"]


def test_equal_numbers_of_different_names_are_found(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    ids, names, counts = phrases.summed(np.array([7, 2, 7, 2, 7], np.uint64), pa.array(["a", "b", "a", "c", "a"]), np.array([1, 2, 3, 4, 5]))
    assert list(zip(ids.tolist(), names.to_pylist(), counts.tolist(), strict=True)) == [(2, "b", 2), (2, "c", 4), (7, "a", 9)]
    ids, names, counts = phrases.summed(np.array([], np.uint64), pa.array([], pa.string()), np.array([], np.int64))
    assert not len(ids) and not len(names) and not len(counts)
    monkeypatch.setattr(phrases, "word_ids", lambda words, seed: np.array([len(w) for w in words.to_pylist()], np.uint64))
    table = pa.table({"bucket": [0, 0, 0], "lang": ["en", "en", "de"], "names": [["a", "bb"], ["a", "cc", "ddd"], ["z"]], "counts": [[5, 4], [5, 3, 9], [50]]})
    found = sorted((r["lang"], r["id"], r["a"], r["clash"]) for r in phrases.exact_sums(6, 0)(table).to_pylist())
    assert found == [("de", 1, 50, False), ("en", 1, 10, False), ("en", 2, 7, True), ("en", 3, 9, False)]
    with pytest.raises(phrases.Clash):
        phrases.frequent_groups(spark.createDataFrame([(1, True), (2, False)], "id long, clash boolean"))


def test_scores_beyond_64_bits(spark):
    counts = [(10**12, 10**15, 10**12, 10**12 + 7), (10**13 + 1, 10**15 - 1, 10**14, 10**13 + 1), (100, 100, 100, 100)]
    frame = spark.createDataFrame(counts, "a long, n long, l long, r long")
    score = phrases.exact_score(frame["a"], frame["n"], frame["l"], frame["r"])
    assert [r[0] for r in frame.select(score).collect()] == [1000 * a * n // (left * r) for a, n, left, r in counts]
