"""Near duplicates by SimHash, compared bit-sliced.

A fingerprint bit is set if it is set in over half of the hashes of the text's shingles. Two fingerprints that differ in at most
four bits agree in at least two of six blocks of bits, so each distinct fingerprint is dealt to 15 tables, keyed by the values of
two blocks. Within a key the fingerprints are stored as bit planes: one word holds the same bit of 64 fingerprints. A fingerprint
is compared with a word of 64 others at once; carry-save counters add up the planes' differences, and words in which all 64 are
beyond the radius are abandoned. A key with many fingerprints is cut into tiles, and pairs of tiles are dealt to different tasks.

Within a task linked fingerprints are joined at once, so a dense group of n passes on n - 1 links and not n * n pairs, and none
of its members is lost. Components of the remaining links come from repeated joins in which each node takes the least label
around it; every round is written to the shared folder.

Null and empty texts have the fingerprint zero and link like any other. Equal texts have equal fingerprints and are one node.
A null id counts as greater than any number; a component of null ids only has a null id. An empty table gives an empty result. Other
columns are not read by `near_duplicates`; all columns pass through `one_of_each` unchanged, whatever their names.

With keys of 20 to 22 bits a key holds n / 2 ** 22 of n distinct fingerprints or more, so beyond some 10 ** 9 of them comparing grows with
their square; more blocks (BLOCKS) make longer keys and more tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.frames import bound_batches
from plumbline.sources.tables import materialize

RADIUS = 4
SHINGLE = 4
SEED = 42
# Bits of each block, lowest first.
BLOCKS = (11, 11, 11, 11, 10, 10)
# Fingerprints of one tile of a hot key.
TILE = 8192
# Parts in which the links of a node are dealt.
SALTS = 8
# Comparisons of one fingerprint with 64 others that are in work at a time.
AT_ONCE = 1 << 16

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of `width` words, joined by spaces; of the whole sequence if it has fewer words."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(parts)
    if len(parts) <= width:
        return np.array([xxhash.xxh64_intdigest(line, seed)], dtype=np.uint64)
    stops = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(parts) - width + 1].tolist(), stops[width - 1:].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(parts) - width + 1)


def simhash(text: bytes) -> int:
    hashes = shingle_hashes(text)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        some = np.ascontiguousarray(hashes[at:at + 65536])
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash_column(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = np.fromiter((simhash(t.as_py()) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.array(values.view(np.int64))

    return fingerprint(F.coalesce(text.cast("binary"), F.lit(b"")))


def fingerprints(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, fp): the fingerprint as a signed 64-bit number."""
    bound_batches(documents.sparkSession)
    return documents.select(F.col(id_col), simhash_column(F.col(text)).alias("fp"))


def bit_planes(values: np.ndarray) -> np.ndarray:
    """planes[b, w]: bit b of the 64 values from 64 * w on."""
    filled = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    filled[:len(values)] = values
    bits = np.unpackbits(filled.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def close_pairs(values: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of pairs of positions i < j with equal group and at most `radius` differing bits. Groups are sorted."""
    count = len(values)
    if count < 2:
        return
    planes = bit_planes(values)
    ends = np.searchsorted(groups, groups, side="right")
    first, last = np.arange(count) // 64, (ends - 1) // 64
    words = last - first + 1
    words[ends - 1 == np.arange(count)] = 0  # nothing follows in the group
    bits = max(1, int(radius).bit_length())
    done = np.cumsum(words)
    start = 0
    while start < count:
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + AT_ONCE, side="right")))
        query = np.repeat(np.arange(start, stop), words[start:stop])
        start = stop
        if not len(query):
            continue
        step = np.arange(len(query)) - np.repeat(np.cumsum(words[query[0]:stop]) - words[query[0]:stop], words[query[0]:stop])
        word = first[query] + step
        # Lanes behind the query and before the end of its group.
        low, high = np.clip(query + 1 - 64 * word, 0, 64), np.clip(ends[query] - 64 * word, 0, 64)
        alive = lanes_below(high) & ~lanes_below(low)
        keep = alive != 0
        query, word, alive = query[keep], word[keep], alive[keep]
        counters = np.zeros((bits, len(query)), dtype=np.uint64)
        for bit in range(64):
            own = np.uint64(0) - ((values[query] >> np.uint64(bit)) & np.uint64(1))
            carry = planes[bit][word] ^ own
            for level in range(bits):
                counters[level], carry = counters[level] ^ carry, counters[level] & carry
            alive &= ~carry
            if bit % 4 == 3:
                alive &= ~beyond(counters, radius)
                keep = np.flatnonzero(alive)
                if len(keep) < len(alive):
                    query, word, alive, counters = query[keep], word[keep], alive[keep], counters[:, keep]
                if not len(query):
                    break
        if len(query):
            hit, lane = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield query[hit], word[hit] * 64 + lane


def lanes_below(n: np.ndarray) -> np.ndarray:
    return np.where(n >= 64, _FULL, (np.uint64(1) << (n.astype(np.uint64) & np.uint64(63))) - np.uint64(1))


def beyond(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count is greater than the radius."""
    greater, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _FULL)
    for level in reversed(range(len(counters))):
        if radius >> level & 1:
            equal &= counters[level]
        else:
            greater |= equal & counters[level]
            equal &= ~counters[level]
    return greater


def join_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked positions the least label of all they are linked with; labels[i] is a position and leads to its root."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def compare_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows (cell, fp) that come sorted by cell; a cell may go over several batches."""
    held: list[np.ndarray] = []

    def links(cells: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        groups = np.cumsum(np.concatenate([[False], cells[1:] != cells[:-1]]))
        labels = np.arange(len(values))
        for left, right in close_pairs(values, groups):
            join_labels(labels, left, right)
        moved = np.flatnonzero(labels != np.arange(len(values)))
        return pa.RecordBatch.from_arrays([pa.array(values[moved].view(np.int64)), pa.array(values[labels[moved]].view(np.int64))], ["a", "b"])

    for batch in batches:
        cells, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if held:
            cells, values = np.concatenate([held[0], cells]), np.concatenate([held[1], values])
        if not len(cells):
            continue
        last = np.flatnonzero(cells != cells[-1])
        cut = int(last[-1]) + 1 if len(last) else 0
        held = [cells[cut:], values[cut:]]
        if cut:
            yield links(cells[:cut], values[:cut].view(np.uint64))
    if held:
        yield links(held[0], np.ascontiguousarray(held[1]).view(np.uint64))


def block_keys() -> list[Column]:
    """One key per pair of blocks: the table's number and the bits of both blocks."""
    starts = np.concatenate([[0], np.cumsum(BLOCKS)[:-1]]).tolist()
    value = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << n) - 1).cast("bigint")) for s, n in zip(starts, BLOCKS, strict=True)]
    return [
        (F.shiftleft(value[i], 11).bitwiseOR(value[j]).bitwiseOR(F.lit(k << 24).cast("bigint")))
        for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints within the radius, over keys that two or more fingerprints share."""
    keyed = distinct.select("fp", F.explode(F.array(*block_keys())).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    # A fingerprint of tile t meets those of each tile s in the cell (min(s, t), max(s, t)).
    cells = keyed.join(sizes, "key").select("fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    cell = F.xxhash64("key", low, high)
    spread = cells.select(cell.alias("cell"), "fp").repartition("cell").sortWithinPartitions("cell")
    return spread.mapInArrow(compare_keys, "a bigint, b bigint")


def told(links_of: DataFrame, least: DataFrame) -> DataFrame:
    """Join links (u, v) with what is known of u. The salt deals the links of a hot node to several tasks, and keeps the partitions
    of the join apart from those of the aggregation before it, so that Spark may split them further."""
    salted = least.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return links_of.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "_salt"]).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has a link and is not itself the least of its component, which is the root.

    Alternates large-star and small-star steps.
    A step sends for a node its neighbours' least one, never all pairs; with at most two rows per link a hot node's rows combine
    in the map tasks. Each round is written to the shared folder; the rounds grow with the logarithm of a component's diameter.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        # Large star: greater neighbours of a node link to the least one of the node and its neighbours.
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = told(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours link to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = told(large, low).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        before = state


def classes(prints: DataFrame, id_col: str) -> DataFrame:
    """(fp, component_id, root) of each distinct fingerprint; the root fingerprint tells components apart whatever their ids.

    Only fingerprints with a link are joined with their root; the salt deals those of a hot root to several tasks.
    """
    nodes = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    roots = materialize(components(links(nodes.select("fp"))).withColumnRenamed("node", "fp"), "roots")
    linked = roots.join(nodes, "fp")
    below = linked.groupBy("root").agg(F.min("least").alias("below"))
    named = below.join(nodes.select(F.col("fp").alias("root"), "least"), "root").select("root", F.least("below", "least").alias("component_id"))
    named = materialize(named, "components")
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    inner = linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"])
    outer = nodes.join(roots, "fp", "left_anti").join(named.withColumnRenamed("root", "fp"), "fp", "left")
    return inner.select("fp", "component_id", "root").unionByName(
        outer.select("fp", F.coalesce("component_id", "least").alias("component_id"), F.col("fp").alias("root")),
    )


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, fingerprint (16 hexadecimal digits) and component_id."""
    prints = materialize(fingerprints(documents, id_col=id_col, text=text), "simhash")
    return prints.join(classes(prints, id_col), "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def one_of_each(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that with the least id, with all its columns; ties are broken by the hash of the row.

    Fingerprints are computed once, and the rows that stay are chosen among ids and hashes of rows; texts move only once, to meet these.
    """
    bound_batches(documents.sparkSession)
    # The columns travel in one struct, so that none can have the name of a column added here.
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    nulls = F.array(*[F.col("row")[c].isNull() for c in documents.columns])  # hashes pass over nulls
    hashes = [F.xxhash64(F.lit(seed), "row", nulls).alias(f"h{seed}") for seed in (1, 2)]
    known = whole.select(F.col("row")[id_col].alias("id"), *hashes, "row")
    slim = materialize(known.select("id", "h1", "h2", simhash_column(F.col("row")[text]).alias("fp")), "simhash")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")
    # Equal fingerprints meet in the map tasks first.
    first = slim.groupBy("fp").agg(F.min(order).alias("first"))
    stay = first.join(classes(slim, "id"), "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.h1", "first.h2")
    stay = materialize(stay.withColumnsRenamed({"id": "_id", "h1": "_h1", "h2": "_h2"}), "stay")
    equal = known.groupBy("id", "h1", "h2").agg(F.first("row").alias("row"))
    met = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    return equal.join(stay, met, "left_semi").select("row.*")
