"""Term counting within rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows whose terms are numbered and counted at a time.
COUNTED_ROWS = 1024


def terms(text: Column) -> Column:
    """Lower-case runs of letters of the whole text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda t: t != "")


def term_counts(documents: DataFrame, document_id: str, text: str) -> DataFrame:
    """(document_id, term, tf), counted inside each row: terms are numbered within some rows at a time, so nothing is shuffled."""
    # Empty terms before the first letter and after the last are left out below.
    split = documents.select(document_id, F.split(F.lower(F.col(text)), r"[^\p{L}]+").alias("t"))
    name = split.schema[document_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), COUNTED_ROWS):
                some = batch.slice(start, COUNTED_ROWS)
                coded = some.column(1).flatten().dictionary_encode()
                sizes = pc.fill_null(pc.list_value_length(some.column(1)), 0).to_numpy(zero_copy_only=False)
                width = max(1, len(coded.dictionary))
                row = np.repeat(np.arange(len(some), dtype=np.int64), sizes)
                met, times = np.unique(row * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
                kept = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[met % width] if len(met) else np.zeros(0, dtype=bool)
                met, times = met[kept], times[kept]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(met // width)), coded.dictionary.take(pa.array(met % width)), pa.array(times.astype(np.int32))],
                    [document_id, "term", "tf"],
                )

    return split.mapInArrow(run, f"`{document_id}` {name}, term string, tf int")
