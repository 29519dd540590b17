"""The pipeline's rows against its stages' plain versions, and the registered queries on the smallest tables."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm import quality
from plumbline.llm.frames import table
from plumbline.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_mixing import plain_mix
from tests.llm.test_simhash import classes_of, plain_fingerprint
from tools.check_oracle import compare, open_tables


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    rows, problems = compare(entry.queries()[name](spark, DATA), open_tables(DATA), entry.oracle_sql()[name])
    assert not problems and rows > 0


def test_run_equals_plain_stages(spark, library):
    documents = table(spark, DATA, "documents")
    verdict = {r["doc_id"]: r["predicted"] for r in quality.quality(documents, table(spark, DATA, "labels")).collect()}
    kept = [r for r in documents.collect() if verdict[r["doc_id"]]]
    last = {}
    for r in kept:
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    unique = sorted((r for r in kept if last[r["text"]] == r["doc_id"]), key=lambda r: r["doc_id"])
    label = classes_of([plain_fingerprint(r["text"]) for r in unique])
    stay = {r["doc_id"]: r for k, r in enumerate(unique) if label[k] == k}
    found = corpus_pipeline.run(spark, DATA).collect()
    assert found and all(r["restored"] for r in found)
    copies = {}
    for i, _, _, n in plain_mix(spark, [(i, r["source"], len((r["text"] or "").encode().split())) for i, r in stay.items()]):
        copies[i] = n
    assert Counter(r["doc_id"] for r in found) == +Counter(copies)
    for r in found:
        ids = library.encode_ordinary(stay[r["doc_id"]]["text"] or "")
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)


def test_stages_keep_columns_and_bear_odd_rows(spark):
    odd = [(1, None, "en", None, None), (1, None, "en", None, None), (None, "the same text of a few words here", None, "a", 3), (2, "", None, "a", 0), (3, "the " * 40_000, "en", "b", 1)]
    docs = spark.createDataFrame([(*r, "extra") for r in odd], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, DATA)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            assert out.count() <= 3 * len(odd)


def test_a_task_of_the_last_stage_holds_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "en", "a", "some text"), (2, "de", None, None)], "doc_id long, lang string, source string, text string")
    done = corpus_pipeline.byte_bpe(spark, docs, DATA)
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["restored"] for r in done.collect()] == [True, True]
