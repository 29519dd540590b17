"""Measures and verdicts against plain loops."""

from __future__ import annotations

import random
import re

from plumbline.llm import rules


def measured(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit), "n_lines": len(lines),
        "n_stop_words": sum(w.lower() in rules.STOP_WORDS for w in words), "n_adjacent": sum(a == b for a, b in zip(words, words[1:])),
    }


def some_texts():
    draw = random.Random(3)
    parts = ["the", "of", "ab", "c", "\n", " \n", "\t", "#", "|", "The", "é", "\x0b", " ", "x y"]
    texts = [" ".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(150)]
    block = " ".join(f"w{i}" for i in range(12))
    return texts + [None, "", "   ", "\n\n", block + " " + block, (block + " ") * 30 + "tail", "one " * 400, "x" * 50_000, "a b\na b\n\na b "]


def test_measures_equal_loops(spark):
    texts = some_texts()
    frame = spark.createDataFrame([(i, t, 5, "z") for i, t in enumerate(texts)], "doc_id int, text string, n_words int, kept string")
    for row in rules.judge(frame).collect():
        want = measured(texts[row["doc_id"]])
        assert {k: row[k] for k in want} == want, texts[row["doc_id"]]
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert row["base_failed"] == failed
        assert row["kept"] == (not failed and not row["broken_rules"])


def test_clean_prose_stays_and_junk_goes(spark):
    prose = "The house by the river was old and it was the first of its kind in a town that grew along the water for years"
    rows = [(1, prose), (2, prose.upper().replace(" ", "!! ")), (3, prose.replace(" ", " | ")), (4, "word " * 50), (5, "too short"), (None, prose)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    assert sorted(r["doc_id"] or 0 for r in rules.quality_filter(frame).collect()) == [0, 1]
    assert rules.quality_filter(frame).columns == ["doc_id", "text"]
    assert rules.quality_filter(frame.limit(0)).count() == 0


def test_rules_are_one_projection(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    plan = rules.judge(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
