"""Collocations by relational mining of occurrence relations.

The relation of length k has a row for each place where a phrase of k words stands that may be frequent: its piece, its position, the
phrase. It is kept sorted by piece and position, so that the relation of length k + 1 comes from a merge join with itself at the adjacent
position: a place has a candidate of k + 1 words if it and the next one have phrases of k words. Candidates are counted by group, and a
semi-join keeps the places of those that may be frequent before the next length.

The relations are stored in slices of whole texts of one language: a row holds the numbers of a slice's phrases in the order of their
places, 0 where there is none, and between pieces. Sorted by place, the merge join is one pass over the slice and its own shift.

Counting has two steps, because most groups are rare. First each slice sends a hash and a count of each of its groups, packed into one row
for each bucket of hashes; a bucket adds them up in an array of counters and answers with one bit for each, whether its counter reaches the
limit. Counters that several groups share are too high and never too low, so no frequent group is lost. Only groups with that bit stay
in the relation and send their names to the exact count, which decides. A group that is kept by mistake does no more than send one row.
Nothing but bits comes back to the slices; they are sent to all tasks if they are few, else they meet the slices in a join.

Phrases are numbered by 64-bit hashes of their words, pairs by those of their parts. The exact count compares the names of equal numbers;
should two names ever share one, all is done anew with another seed, so that results are exact.

Null texts are empty, a null language is `und`. Rows are counted as they are, repeated ones too. Equal scores are ordered by a, then by
phrase. Texts and pieces may have any length: a text longer than a slice forms a slice of its own. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.arrays import LOWER, hash_runs, mixed, text_slices
from plumbline.llm.frames import bound_batches
from plumbline.session import delete_path, new_work_path
from plumbline.sources.tables import materialize

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
# Bytes of text in a slice, and slices that a task fills at a time.
SLICE_BYTES = 4 << 20
OPEN_SLICES = 8

BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
APART = BREAK.copy()
APART[[0x20, 0x09]] = True

# Entries that a bucket of the sketch has at most, by expectation, buckets at least and at most, and counters for each entry.
BUCKET_ENTRIES = 1 << 19
LEAST_BUCKETS, MOST_BUCKETS = 32, 4096
COUNTERS = 4
# Groups that a task adds up before it sends them to the exact count.
EXACT_ENTRIES = 1 << 20
# Bytes of bits that are sent to all tasks.
SENT_BITS = 16 << 20

# A slice's relation: `places` are the codes (1, 2, …) of its phrases in the order of the text, `width` the bytes of a code, `ids` the
# numbers of the phrases; `names` are words or pairs of numbers, `beside` the places whose next one has a phrase as well.
RELATION = "slice bigint, lang string, places binary, width int, ids array<bigint>, names array<{name}>, counts array<bigint>, beside bigint"
WORD, PAIR = "string", "struct<l:bigint,r:bigint>"

def packed(codes: np.ndarray) -> tuple[bytes, int]:
    """Codes in as few bytes as the greatest one needs."""
    kind = np.min_scalar_type(int(codes.max(initial=0)))
    return codes.astype(kind).tobytes(), kind.itemsize


def unpacked(places: bytes, width: int) -> np.ndarray:
    return np.frombuffer(places, dtype=f"<u{width}").astype(np.int64)


def words_of(texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(places, words, counts) of (bytes, offsets) of texts: 0 stands between pieces."""
    data = LOWER[np.concatenate([d for d, _ in texts])]
    starts = np.concatenate([[0], np.cumsum([len(d) for d, _ in texts])])
    ends = np.unique(np.concatenate([o + s for (_, o), s in zip(texts, starts[:-1].tolist(), strict=True)]))
    inside = ~APART[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[-1] = edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[ends] = True
    cuts = np.flatnonzero(edge)
    keep = inside[cuts[:-1]] if len(data) else np.zeros(0, dtype=bool)
    first, last = cuts[:-1][keep], cuts[1:][keep]
    if not len(first):
        return np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0, np.int64)
    # Words without what is between them, so that a dictionary of them can be made without copies.
    bounds = np.concatenate([[0], np.cumsum(last - first)])
    told = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[inside]))
    known = told.dictionary_encode()
    codes = known.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    breaks = np.searchsorted(np.union1d(np.flatnonzero(BREAK[data]), ends), first, side="right")
    new = np.concatenate([[0], np.cumsum(np.diff(breaks) > 0)])
    places = np.zeros(len(codes) + int(new[-1]), dtype=np.int64)
    places[np.arange(len(codes)) + new] = codes
    return places, known.dictionary.cast(pa.string()), np.bincount(codes, minlength=len(known.dictionary) + 1)[1:]


def relation_batch(number: int, lang: str, places: np.ndarray, ids: np.ndarray, names: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    codes, width = packed(places)
    beside = int(np.count_nonzero((places[:-1] > 0) & (places[1:] > 0)))
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([lang]), pa.array([codes], pa.binary()), pa.array([width], pa.int32()),
        pa.array([ids.view(np.int64)], pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
        pa.array([counts], pa.list_(pa.int64())), pa.array([beside], pa.int64()),
    ], ["slice", "lang", "places", "width", "ids", "names", "counts", "beside"])


def word_ids(words: pa.Array, seed: int) -> np.ndarray:
    data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] else np.empty(0, np.uint8)
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    return hash_runs(data, bounds[:-1], bounds[1:], seed)


def word_slices(limit: int, seed: int):
    """The words of texts with their language, sliced."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 33
        waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[str, int] = {}

        def slice_of(lang: str) -> pa.RecordBatch:
            nonlocal serial
            places, words, counts = words_of(waiting.pop(lang))
            held.pop(lang)
            serial += 1
            return relation_batch(serial, lang, places, word_ids(words, seed), words, counts)

        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang))
                for _, data, offsets in text_slices(texts, limit):
                    waiting.setdefault(lang, []).append((data.copy(), offsets))
                    held[lang] = held.get(lang, 0) + len(data)
                    if held[lang] >= limit:
                        yield slice_of(lang)
                while sum(held.values()) >= OPEN_SLICES * limit or len(held) > 100:
                    yield slice_of(max(held, key=held.get))
        for lang in list(waiting):
            yield slice_of(lang)

    return rows


@dataclass
class Groups:
    """The groups of a slice: number, name and count of each, and for each place its group (from 1, 0 for none)."""

    places: np.ndarray
    ids: np.ndarray
    names: pa.Array
    counts: np.ndarray


def groups_of(row: dict[str, pa.Scalar], extend: bool, seed: int) -> Groups:
    """The groups of a stored slice, or, with `extend`, those of the next length: the merge join of adjacent places."""
    places = unpacked(row["places"].as_py(), row["width"].as_py())
    ids = row["ids"].values.to_numpy(zero_copy_only=False).view(np.uint64)
    if not extend:
        return Groups(places, ids, row["names"].values, row["counts"].values.to_numpy(zero_copy_only=False))
    both = np.zeros(len(places), dtype=np.int64)
    both[:-1] = np.where((places[:-1] > 0) & (places[1:] > 0), places[:-1] * (len(ids) + 1) + places[1:], 0)
    pairs, back, counts = np.unique(both, return_inverse=True, return_counts=True)
    if not len(pairs) or pairs[0] != 0:
        pairs, back, counts = np.r_[0, pairs], back + 1, np.r_[0, counts]
    left, right = np.divmod(pairs[1:], len(ids) + 1)
    left, right = ids[left - 1], ids[right - 1]
    names = pa.StructArray.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["l", "r"])
    return Groups(back, pair_ids(left, right, seed), names, counts[1:])


def pair_ids(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    return mixed(mixed(left + np.uint64(seed + 1)) ^ right)


def slots(ids: np.ndarray, lang: str, buckets: int, counters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by bucket and counter, bucket and counter in that order) of groups."""
    value = mixed(ids ^ np.uint64(xxhash.xxh64_intdigest(lang)))
    bucket = (value % np.uint64(buckets)).astype(np.int64)
    counter = (value // np.uint64(buckets) % np.uint64(counters)).astype(np.int64)
    order = np.argsort(bucket * counters + counter, kind="stable")
    return order, bucket[order], counter[order]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def sketches(extend: bool, seed: int, buckets: int, counters: int):
    """(bucket, slice, deltas, counts): the counters that a slice's groups have in each bucket, ascending, and their counts up to 65535.

    The four bytes of the deltas stand apart, as the upper ones are nearly always 0.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            groups = groups_of(row, extend, seed)
            if not len(groups.ids):
                continue
            order, bucket, counter = slots(groups.ids, row["lang"].as_py(), buckets, counters)
            counts = np.minimum(groups.counts[order], 0xFFFF).astype(np.uint16)
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            deltas = np.diff(counter, prepend=0)
            deltas[heads] = counter[heads]
            parts = list(zip(heads, np.append(heads[1:], len(bucket)), strict=True))
            planes = [deltas[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in parts]
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[heads], pa.int64()), pa.array([row["slice"].as_py()] * len(parts), pa.int64()),
                pa.array(planes, pa.binary()), pa.array([counts[a:b].tobytes() for a, b in parts], pa.binary()),
            ], ["bucket", "slice", "deltas", "counts"])

    return pack


def judge(counters: int, least: int):
    """(slice, bucket, bits) of a bucket: for each entry of each slice whether its counter reaches the limit."""

    def counters_of(planes: bytes) -> np.ndarray:
        return np.cumsum(np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64))

    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(counters, dtype=np.uint16)
        planes, counts = (table.column(c).to_pylist() for c in ("deltas", "counts"))
        for packed_deltas, packed_counts in zip(planes, counts, strict=True):
            at, more = counters_of(packed_deltas), np.frombuffer(packed_counts, np.uint16).astype(np.int64)
            heads = np.flatnonzero(np.diff(at, prepend=-1))  # groups of a slice that share a counter
            more = np.add.reduceat(more, heads)
            total[at[heads]] = np.minimum(total[at[heads]] + more, 0xFFFF)
        limit = min(least, 0xFFFF)
        bits = [np.packbits(total[counters_of(p)] >= limit).tobytes() for p in planes]
        return pa.table({"slice": table.column("slice"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})

    return run


def kept_groups(extend: bool, seed: int, buckets: int, counters: int):
    """The relation of the groups that may be frequent, from slices with the bits of each bucket in `answers`."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            groups = groups_of(row, extend, seed)
            order, bucket, _ = slots(groups.ids, row["lang"].as_py(), buckets, counters)
            answers = row["answers"].values
            sizes = np.bincount(bucket, minlength=buckets)
            frequent = np.zeros(len(groups.ids), dtype=bool)
            starts = np.cumsum(sizes) - sizes
            for b, bits in zip(answers.field(0).to_pylist(), answers.field(1).to_pylist(), strict=True):
                own = order[starts[b]:starts[b] + sizes[b]]
                frequent[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
            stay = np.flatnonzero(frequent)
            if len(stay):
                number = np.zeros(len(groups.ids) + 1, dtype=np.int64)
                number[stay + 1] = np.arange(1, len(stay) + 1)
                names = groups.names.take(pa.array(stay))
                yield relation_batch(row["slice"].as_py(), row["lang"].as_py(), number[groups.places], groups.ids[stay], names, groups.counts[stay])

    return keep


def pruned(relation: DataFrame, entries: int, extend: bool, seed: int, min_count: int, sent_bits: int) -> tuple[DataFrame, str]:
    """The relation of the groups (of the next length with `extend`) that may be frequent. `entries` bounds the slices' groups."""
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, entries // BUCKET_ENTRIES))
    counters = 1 << max(10, (COUNTERS * entries // buckets).bit_length())
    told = relation.mapInArrow(sketches(extend, seed, buckets, counters), "bucket bigint, slice bigint, deltas binary, counts binary")
    bits = told.groupBy("bucket").applyInArrow(judge(counters, min_count), "slice bigint, bucket bigint, bits binary")
    answers = materialize(bits.groupBy("slice").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), "bits")
    size = answers.agg(F.sum(F.aggregate("answers", F.lit(0).cast("bigint"), lambda n, a: n + F.octet_length(a["bits"]) + 16))).first()[0] or 0
    joined = relation.join(F.broadcast(answers) if size <= sent_bits else answers, "slice")
    return stored(joined.mapInArrow(kept_groups(extend, seed, buckets, counters), RELATION.format(name=PAIR if extend else WORD)), "relation")


def stored(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a relation, compressed well, and read it: (frame, path)."""
    path = new_work_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


class Clash(Exception):
    """Two names have the same number."""


def apart(names: pa.Array) -> np.ndarray:
    """Whether each name differs from the one before."""
    if not len(names):
        return np.zeros(0, dtype=bool)
    if pa.types.is_struct(names.type):
        fields = [names.field(k).to_numpy(zero_copy_only=False) for k in range(2)]
        differs = np.logical_or(*[f[1:] != f[:-1] for f in fields])
    else:
        differs = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[True], differs])


def numbers_of(names: pa.Array, seed: int) -> np.ndarray:
    if pa.types.is_struct(names.type):
        left, right = (names.field(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in range(2))
        return pair_ids(left, right, seed)
    return word_ids(names, seed)


def summed(ids: np.ndarray, names: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The groups added up, by number; names that share one stay apart."""
    order = np.argsort(ids, kind="stable")
    ids, names, counts = ids[order], names.take(pa.array(order)), counts[order]
    heads = np.flatnonzero(np.diff(ids, prepend=ids[:1] + np.uint64(1)).astype(bool) | apart(names))
    return ids[heads], names.take(pa.array(heads)), np.add.reduceat(counts, heads) if len(heads) else counts


def exact_parts(buckets: int, seed: int, limit: int = EXACT_ENTRIES):
    """(bucket, lang, names, counts) of the groups of many slices, added up in the task and packed by bucket of their numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[tuple[np.ndarray, pa.Array, np.ndarray]]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in waiting.items():
                ids, names, counts = summed(
                    np.concatenate([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts]), np.concatenate([p[2] for p in parts]),
                )
                bucket = (mixed(ids) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                names, counts, bucket = names.take(pa.array(order)), counts[order], bucket[order]
                heads = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = pa.array(np.append(heads, len(bucket)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[heads]), pa.array([lang] * len(heads)), pa.ListArray.from_arrays(ends, names),
                    pa.ListArray.from_arrays(ends, pa.array(counts)),
                ], ["bucket", "lang", "names", "counts"])
            waiting.clear()

        for row in rows_of(batches):
            ids = row["ids"].values.to_numpy(zero_copy_only=False).view(np.uint64)
            waiting.setdefault(row["lang"].as_py(), []).append((ids, row["names"].values, row["counts"].values.to_numpy(zero_copy_only=False)))
            held += len(ids)
            if held >= limit:
                yield from flush()
                held = 0
        yield from flush()

    return pack


def exact_sums(min_count: int, seed: int):
    """(lang, id, name, a, clash) of the frequent groups of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for lang in pc.unique(table.column("lang")).to_pylist():
            part = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
            names, counts = (part.column(c).combine_chunks().flatten() for c in ("names", "counts"))
            ids, names, counts = summed(numbers_of(names, seed), names, counts.to_numpy(zero_copy_only=False))
            heads = np.flatnonzero(np.diff(ids, prepend=ids[:1] + np.uint64(1)))
            total = np.add.reduceat(counts, heads) if len(heads) else counts
            clash = np.diff(np.append(heads, len(ids))) > 1
            stay = total >= min_count
            place = heads[stay]
            out.append(pa.table({
                "lang": pa.array([lang] * len(place), pa.string()), "id": pa.array(ids[place].view(np.int64)), "name": names.take(pa.array(place)),
                "a": pa.array(total[stay]), "clash": pa.array(clash[stay]),
            }))
        return pa.concat_tables(out)

    return run


def exact_counts(relation: DataFrame, entries: int, min_count: int, seed: int) -> DataFrame:
    """(lang, id, name, a, clash) of the frequent groups of a relation of `entries` groups in all slices.

    Groups of the slices of a task are added up there, and come to their bucket in packed rows.
    """
    name = relation.schema["names"].dataType.elementType.simpleString()
    buckets = max(LEAST_BUCKETS, entries // BUCKET_ENTRIES)
    parts = relation.select("lang", "ids", "names", "counts").mapInArrow(
        exact_parts(buckets, seed), f"bucket bigint, lang string, names array<{name}>, counts array<bigint>",
    )
    return parts.groupBy("bucket").applyInArrow(exact_sums(min_count, seed), f"lang string, id bigint, name {name}, a bigint, clash boolean")


def frequent_groups(counted: DataFrame) -> DataFrame:
    found = materialize(counted, "frequent")
    if not found.filter("clash").isEmpty():
        raise Clash
    return found.drop("clash")


def relations(
    documents: DataFrame, *, text: str, lang: str, min_count: int, max_words: int, slice_bytes: int, sent_bits: int = SENT_BITS, seed: int = 0,
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), and the frequent phrases of each length: lang, id, phrase, last, a, heads, tails.

    `heads` and `tails` are the counts of its first and of its last 1, 2, … words; `last` is its last word.
    """
    spark = documents.sparkSession
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    relation, path = stored(texts.mapInArrow(word_slices(slice_bytes, seed), RELATION.format(name=WORD)), "relation")
    total = materialize(relation.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c)).alias("n")), "totals")
    entries = relation.agg(F.sum(F.size("ids"))).first()[0] or 0
    none = F.array().cast("array<bigint>")
    frequent: list[DataFrame] = []
    for length in range(1, max_words + 1):
        longer, kept_at = pruned(relation, entries, length > 1, seed, min_count, sent_bits)
        delete_path(spark, path)  # what it was made from is not needed any more
        relation, path = longer, kept_at
        entries = relation.agg(F.sum("beside")).first()[0] or 0
        kept = relation.agg(F.sum(F.size("ids"))).first()[0] or 0
        counted = exact_counts(relation, kept, min_count, seed)
        if length == 1:
            found = counted.withColumns({"phrase": F.col("name"), "last": F.col("name"), "heads": none, "tails": none})
        else:
            before = frequent[-1]
            left = before.select("lang", F.col("id").alias("_l"), F.col("phrase").alias("begin"), F.array_append("heads", F.col("a")).alias("heads"))
            right = before.select(F.col("lang").alias("_lang"), F.col("id").alias("_r"), "last", F.array_append("tails", F.col("a")).alias("tails"))
            named = counted.select("lang", "id", F.col("name.l").alias("l"), F.col("name.r").alias("r"), "a", "clash")
            named = named.join(left.withColumnRenamed("lang", "_of"), (F.col("lang") == F.col("_of")) & (F.col("l") == F.col("_l")))
            named = named.join(right, (F.col("lang") == F.col("_lang")) & (F.col("r") == F.col("_r")))
            found = named.withColumn("phrase", F.concat_ws(" ", "begin", "last"))
        names = ["l", "r"] if length > 1 else []
        frequent.append(frequent_groups(found.select("lang", "id", *names, "phrase", "last", "a", "heads", "tails", "clash")))
    delete_path(spark, path)
    return total, frequent


def scored(total: DataFrame, frequent: list[DataFrame]) -> DataFrame:
    """Candidates with the cut that scores least: lang, phrase, a, l, r, n, score. The arithmetic has 38 digits."""
    parts = []
    for longer, phrases in zip([*frequent[2:], None], frequent[1:], strict=True):
        if longer is not None:
            whole = longer.select("lang", F.col("l").alias("id"), "a").unionByName(longer.select("lang", F.col("r").alias("id"), "a"))
            phrases = phrases.join(whole, ["lang", "id", "a"], "left_anti")
        parts.append(phrases.select("lang", "phrase", "a", "heads", "tails"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # The first k words go with the last (length - k) ones.
    cuts = F.transform(F.arrays_zip(F.col("heads").alias("l"), F.reverse("tails").alias("r")), lambda cut, k: F.struct(
        exact_score(F.col("a"), F.col("n"), cut["l"], cut["r"]).alias("score"), k.alias("k"), cut["l"].alias("l"), cut["r"].alias("r"),
    ))
    best = rows.join(total, "lang").withColumn("cut", F.array_min(cuts))
    return best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (l * r)) of counts up to 10 ** 15. As l and r are at least a, it is at most 1000 * n."""
    def wide(value: Column, digits: int) -> Column:
        return value.cast(f"decimal({digits},0)")

    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide(a, 16) * wide(n, 16)), wide(left, 16) * wide(right, 16)).cast("bigint")


def collocations(
    documents: DataFrame, *, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
    slice_bytes: int = SLICE_BYTES, sent_bits: int = SENT_BITS,
) -> DataFrame:
    """The phrases with the highest scores of each language: lang, rank, phrase, a, l, r, n, score."""
    bound_batches(documents.sparkSession)
    options = {"text": text, "lang": lang, "min_count": min_count, "max_words": max_words, "slice_bytes": slice_bytes, "sent_bits": sent_bits}
    for seed in range(10):
        try:
            total, frequent = relations(documents, seed=seed, **options)
            break
        except Clash:
            continue
    else:
        raise RuntimeError("numbers of phrases clash with ten seeds")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = scored(total, frequent).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
