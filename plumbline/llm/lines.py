"""Line de-duplication that can be undone: sharded cuckoo filters backed by exact reference-count tables.

The key of a line is the line without white space at both ends and with A-Z lower-cased; shorter keys than `min_chars` code points are
left alone. An index of lines has three tables:

- references: which document holds which key (the key as the first 16 bytes of its SHA-256), a row for each distinct pair;
- counts: for each key the exact number of its documents and the least of their ids;
- filters: for each shard of the keys a cuckoo filter of their 16-bit fingerprints, so that keys can be deleted again.

`insert` asks the filters first. A key that they do not know is new: its count is that of the batch, and neither table is read for it.
Only keys that may be known (few of a fresh batch, and one in some thousands by mistake) are looked up in the exact tables. `delete`
takes the references of documents away, lowers their counts, looks up the next holder of a key where the first one goes, and deletes
the fingerprints of keys that nobody holds any more. Insertions and deletions in any order give the tables that the remaining documents
alone would give. `clean` drops the lines with a key of several documents, except in the document with the least id.

Each change gives a new index over new tables; the old one stays readable, so a failed run leaves nothing half done. A filter's shard
has about SHARD_KEYS keys, and there are as many shards as the keys need. Keys are counted in the map tasks before they are dealt to the
shards, so that a line of very many documents is one row there; where its references meet the counts they are salted.

Rows of one id are one document; all rows without an id are one document that comes after all others. Null and empty texts are one empty
line. Other columns of the documents pass through `clean` unread, whatever their names; `clean` has a row for each row of the input, and
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrays import mixed
from plumbline.llm.frames import bound_batches
from plumbline.sources.tables import materialize

MIN_CHARS = 10
WHITE = b" \t\n\v\f\r"
KEY_BYTES = 16
SLOTS = 4
SHARD_KEYS = 20_000
# Part of the slots that may be taken before a shard's filter is built anew with more of them.
FULL = 0.85
# Rounds of moving fingerprints before one is kept beside the buckets.
ROUNDS = 200
# Parts in which a key's references meet its count.
SALTS = 16

SHARD_ROW = "shard bigint, key binary, maybe boolean, buckets binary, stash binary"


def line_key(line: bytes) -> bytes:
    """A line as it is compared; bytes.lower changes A-Z only."""
    return line.strip(WHITE).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:KEY_BYTES]


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints, four to a bucket, for many keys at a time.

    Fingerprints that find no place are kept in `stash`, as bucket << 16 | fingerprint, so that none is lost.
    """

    def __init__(self, buckets: np.ndarray, stash: np.ndarray) -> None:
        self.buckets, self.stash = buckets, stash

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        count = 1 << max(3, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * FULL)))))
        return cls(np.zeros((count, SLOTS), dtype=np.uint16), np.empty(0, np.uint64))

    @classmethod
    def load(cls, buckets: bytes, stash: bytes) -> Cuckoo:
        return cls(np.frombuffer(buckets, np.uint16).reshape(-1, SLOTS).copy(), np.frombuffer(stash, np.uint64).copy())

    def dump(self) -> tuple[bytes, bytes]:
        return self.buckets.tobytes(), self.stash.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.buckets)) + len(self.stash)

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(prints.astype(np.uint64)) & np.uint64(len(self.buckets) - 1)).astype(np.int64)

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first bucket) of each key."""
        raw = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, KEY_BYTES // 8)
        prints = (raw[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (raw[:, 0] & np.uint64(len(self.buckets) - 1)).astype(np.int64)

    def beside(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The name under which a fingerprint is kept in the stash: by the lesser of its buckets."""
        least = np.minimum(bucket, self.other(bucket, prints))
        return least.astype(np.uint64) << np.uint64(16) | prints.astype(np.uint64)

    def contains(self, keys: list[bytes]) -> np.ndarray:
        prints, first = self.places(keys)
        there = (self.buckets[first] == prints[:, None]).any(axis=1)
        there |= (self.buckets[self.other(first, prints)] == prints[:, None]).any(axis=1)
        return there | np.isin(self.beside(first, prints), self.stash) if len(self.stash) else there

    def insert(self, keys: list[bytes], seed: int = 1) -> None:
        prints, at = self.places(keys)
        draw = np.random.default_rng(seed)
        for number in range(ROUNDS):
            prints, at = self._fill(prints, at)
            if not len(prints):
                return
            if number:  # both buckets are full: one waiting fingerprint of each bucket changes places with a random one there
                _, moves = np.unique(at, return_index=True)
                slot = draw.integers(0, SLOTS, len(moves))
                out = self.buckets[at[moves], slot].copy()
                self.buckets[at[moves], slot] = prints[moves]
                prints[moves] = out
                at[moves] = self.other(at[moves], out)
            else:
                at = self.other(at, prints)
        self.stash = np.concatenate([self.stash, self.beside(at, prints)])

    def _fill(self, prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put fingerprints into empty slots of their buckets; those that are left over."""
        order = np.argsort(at, kind="stable")
        prints, at = prints[order], at[order]
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
        rank = np.arange(len(at)) - np.repeat(start, np.diff(np.r_[start, len(at)]))
        empty = self.buckets[at] == 0
        fits = rank < empty.sum(axis=1)
        slot = np.argsort(~empty, axis=1, kind="stable")[np.arange(len(at)), np.minimum(rank, SLOTS - 1)]
        self.buckets[at[fits], slot[fits]] = prints[fits]
        return prints[~fits], at[~fits]

    def delete(self, keys: list[bytes]) -> None:
        """Take one fingerprint of each key away. The keys must have been inserted."""
        prints, first = self.places(keys)
        while len(prints):
            names = self.beside(first, prints)
            _, now = np.unique(names, return_index=True)  # equal fingerprints of the same buckets one at a time
            left = now
            for bucket in (first, self.other(first, prints)):
                there = self.buckets[bucket[left]] == prints[left, None]
                hit = there.any(axis=1)
                self.buckets[bucket[left[hit]], there[hit].argmax(axis=1)] = 0
                left = left[~hit]
            for name in names[left]:
                self.stash = np.delete(self.stash, np.flatnonzero(self.stash == name)[:1])
            rest = np.setdiff1d(np.arange(len(prints)), now)
            prints, first = prints[rest], first[rest]


def reference_rows(min_chars: int):
    """The distinct keys of each row: key, id, mark."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            owners: list[int] = []
            for row, text in enumerate(batch.column("text")):
                found = {line_key(line) for line in (text.as_buffer().to_pybytes() if text.is_valid else b"").split(b"\n")}
                before = len(keys)
                keys += [digest(key) for key in found if long_enough(key, min_chars)]
                owners += [row] * (len(keys) - before)
            place = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column("id").take(place), batch.column("mark").take(place)], ["key", "id", "mark"],
            )

    return rows


def shard_sweep(change: str, ask: bool, capacity: int):
    """Go over the shards, each with its filter in front of its keys, and give back the keys, then the changed filter.

    `change` is "insert" or "delete"; with `ask` keys that may be known are told and left out of the change.
    """

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, known = None, None

        def rows(keys, maybe, filters):
            buckets, stash = zip(*filters, strict=True) if filters else ((), ())
            count = len(keys) + len(filters)
            lead = [None] * len(keys)
            return pa.RecordBatch.from_arrays([
                pa.array([shard] * count, pa.int64()), pa.array([*keys, *[None] * len(filters)], pa.binary()),
                pa.array([*maybe, *[None] * len(filters)], pa.bool_()),
                pa.array([*lead, *buckets], pa.binary()), pa.array([*lead, *stash], pa.binary()),
            ], ["shard", "key", "maybe", "buckets", "stash"])

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if start == stop:
                    continue
                if shards[start] != shard:
                    if known is not None:
                        yield rows([], [], [known.dump()])
                    shard, known = int(shards[start]), None
                part = batch.slice(start, stop - start)
                keys = part.column("key").to_pylist()
                if keys[0] is None:
                    known = Cuckoo.load(part.column("buckets")[0].as_py(), part.column("stash")[0].as_py())
                    keys = keys[1:]
                known = known if known is not None else Cuckoo.sized(capacity)
                if not keys:
                    continue
                maybe = known.contains(keys).tolist() if ask else [False] * len(keys)
                sure = [key for key, m in zip(keys, maybe, strict=True) if not m]
                if sure:
                    known.insert(sure) if change == "insert" else known.delete(sure)
                yield rows(keys, maybe, [])
        if known is not None:
            yield rows([], [], [known.dump()])

    return sweep


@dataclass(frozen=True)
class LineIndex:
    """The tables of an index; see the module's text. `refs`: key, id, mark; `counts`: key, n_docs, first; `filters`: shard, buckets, stash."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    id_col: str = "doc_id"
    text: str = "text"
    min_chars: int = MIN_CHARS
    shard_keys: int = SHARD_KEYS

    @classmethod
    def empty(cls, documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
              shard_keys: int = SHARD_KEYS) -> LineIndex:
        """An index without documents, for ids of the type that `documents` has."""
        spark, id_type = documents.sparkSession, documents.schema[id_col].dataType.simpleString()
        bound_batches(spark)
        return cls(
            spark.createDataFrame([], f"key binary, id {id_type}, mark bigint"), spark.createDataFrame([], f"key binary, n_docs bigint, first {id_type}"),
            spark.createDataFrame([], "shard bigint, buckets binary, stash binary"), 0, id_col, text, min_chars, shard_keys,
        )

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(max(self.shards, 1))).cast("bigint")

    def _sweep(self, keys: DataFrame, change: str, ask: bool) -> tuple[DataFrame, DataFrame]:
        """(keys with `maybe`, filters) after a change to the filters."""
        blank = F.lit(None).cast("binary")
        sent = self.filters.select("shard", blank.alias("key"), "buckets", "stash").unionByName(
            keys.select(self._shard().alias("shard"), "key", blank.alias("buckets"), blank.alias("stash")),
        )
        capacity = int(self.shard_keys * 1.2)
        dealt = sent.repartition("shard").sortWithinPartitions("shard", "key")  # null first: the filter
        done = materialize(dealt.mapInArrow(shard_sweep(change, ask, capacity), SHARD_ROW), "shards")
        return done.filter("key IS NOT NULL").select("key", "maybe"), done.filter("key IS NULL").select("shard", "buckets", "stash")

    def _grown(self, more: int) -> LineIndex:
        """The index with enough shards for `more` keys: their filters are built anew from the counts."""
        total = self.counts.count() + more
        if total <= self.shards * self.shard_keys * 1.2:
            return self
        wider = replace(self, shards=-(-total // self.shard_keys), filters=self.filters.limit(0))
        if self.shards == 0:
            return wider
        return replace(wider, filters=wider._sweep(self.counts.select("key"), "insert", False)[1])

    def references(self, documents: DataFrame) -> DataFrame:
        slim = documents.select(F.col(self.id_col).alias("id"), F.coalesce(F.col(self.text), F.lit("")).alias("text"))
        return slim.withColumn("mark", F.xxhash64("text")).mapInArrow(reference_rows(self.min_chars), self.refs.schema)

    def insert(self, documents: DataFrame) -> LineIndex:
        """The index with these documents as well. Documents that it holds already change nothing."""
        refs = materialize(self.references(documents), "refs")
        pairs = refs.select("key", "id").distinct()
        batch = materialize(pairs.groupBy("key").agg(F.count("*").alias("n_docs"), F.min("id").alias("first")), "batch")
        index = self._grown(batch.count())
        asked, filters = index._sweep(batch.select("key"), "insert", True)
        maybe = asked.filter("maybe").select("key")
        fresh = batch.join(asked.filter("NOT maybe").select("key"), "key", "left_semi")
        if index.shards and not maybe.isEmpty():
            held = index.refs.join(maybe, "key", "left_semi").select("key", F.col("id").alias("_id")).distinct()
            met = pairs.join(maybe, "key", "left_semi").alias("p").join(
                held.alias("h"), (F.col("p.key") == F.col("h.key")) & F.col("p.id").eqNullSafe(F.col("h._id")), "left_anti",
            )
            stored = index.counts.join(maybe, "key", "left_semi")
            added = met.groupBy("key").agg(F.count("*").alias("n_docs"), F.min("id").alias("first"))
            fresh = fresh.unionByName(
                stored.unionByName(added).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.min("first").alias("first")),
            )
            mistaken = materialize(maybe.join(index.counts, "key", "left_anti"), "mistaken")
            if not mistaken.isEmpty():
                filters = replace(index, filters=filters)._sweep(mistaken, "insert", False)[1]
        rest = index.counts.join(maybe, "key", "left_anti")
        counts = materialize(rest.unionByName(fresh), "counts")
        return replace(index, refs=index.refs.unionByName(refs), counts=counts, filters=filters)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose ids `ids` has in the id column. Unknown ids change nothing."""
        out = ids.select(F.col(self.id_col).alias("_id")).distinct()
        met = F.col("id").eqNullSafe(F.col("_id"))
        refs = materialize(self.refs.join(out, met, "left_anti"), "refs")
        gone = materialize(self.refs.join(out, met, "left_semi").groupBy("key").agg(F.countDistinct(F.struct("id")).alias("_n")), "gone")
        touched = refs.join(gone, "key", "left_semi").groupBy("key").agg(F.min("id").alias("_first"))
        left = self.counts.join(gone, "key", "left").join(touched, "key", "left").select(
            "key", (F.col("n_docs") - F.coalesce("_n", F.lit(0))).alias("n_docs"),
            F.when(F.col("_n").isNull(), F.col("first")).otherwise(F.col("_first")).alias("first"),
        )
        counts = materialize(left, "counts")
        _, filters = self._sweep(counts.filter("n_docs = 0").select("key"), "delete", False)
        return replace(self, refs=refs, counts=counts.filter("n_docs > 0"), filters=filters)

    def dropped_keys(self) -> DataFrame:
        """id, mark, keys: for each document the keys whose lines it loses."""
        repeated = self.counts.filter("n_docs > 1").select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salted = self.refs.withColumn("salt", F.pmod(F.xxhash64("mark", "id"), F.lit(SALTS)).cast("int"))
        lost = salted.join(repeated, ["key", "salt"]).filter(~F.col("id").eqNullSafe(F.col("first")))
        return lost.groupBy("id", "mark").agg(F.collect_set("key").alias("keys"))

    def clean(self, documents: DataFrame) -> DataFrame:
        """One row per row: `row` (all its columns in a struct), n_lines, n_dropped, kept (the text that stays)."""
        lost = materialize(self.dropped_keys(), "dropped")
        whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
        text = F.coalesce(F.col("row")[self.text], F.lit(""))
        marked = whole.withColumns({"mark": F.xxhash64(text), "id": F.col("row")[self.id_col]})
        there = marked.alias("d").join(
            lost.alias("l"), (F.col("d.mark") == F.col("l.mark")) & F.col("d.id").eqNullSafe(F.col("l.id")), "left",
        ).select("row", "keys")
        cut = without_lines(self.min_chars)(F.when(F.col("keys").isNotNull(), text), F.col("keys"))
        n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
        return there.withColumn("_cut", cut).select(
            "row", n_lines.cast("bigint").alias("n_lines"), F.coalesce("_cut.n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
            F.coalesce("_cut.kept", text).alias("kept"),
        )


def without_lines(min_chars: int):
    """The text without the lines whose keys are listed, and how many these are. Rows without a list are skipped."""

    @F.arrow_udf("struct<kept:string,n_dropped:bigint>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            kept: list[bytes | None] = []
            counts: list[int | None] = []
            for text, keys in zip(texts, lists, strict=True):
                if not keys.is_valid:
                    kept.append(None)
                    counts.append(None)
                    continue
                drop = set(keys.as_py())
                lines = text.as_buffer().to_pybytes().split(b"\n")
                stay = [line for line in lines if not (long_enough(key := line_key(line), min_chars) and digest(key) in drop)]
                kept.append(b"\n".join(stay))
                counts.append(len(lines) - len(stay))
            yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["kept", "n_dropped"])

    return cut


def deduplicated(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """`clean` of documents by an index of exactly these documents."""
    return LineIndex.empty(documents, id_col=id_col, text=text, min_chars=min_chars).insert(documents).clean(documents)
