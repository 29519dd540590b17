"""Main text of web pages: page structure, and a suffix array over the pages of each host.

A page is cut into blocks in page order. Blocks inside an article or main element are its text, without the menus, forms, notices,
comments and the like inside it; a page without such an element has its unmarked blocks. The token streams of a host's pages are
concatenated, slice by slice, and a suffix array of each slice lists the runs that many pages share. A run of MIN_RUN or more tokens
that at least SHARE of the host's distinct pages have, and MIN_PAGES or more, is boilerplate. Every page loses the blocks that such runs
cover from end to end and keeps the others whole.

Any longer run that recurs is made of runs of MIN_RUN tokens that recur as often, and these cover the same tokens. The suffix array is
therefore sorted by the first MIN_RUN tokens, and runs of that length are what slices count and compare. Slices are of one host each; as
pages are dealt by a hash of their text, a run that half of a host's pages have is frequent in nearly every slice. A slice reports the
runs that a share of SHARE / 2 of its pages have, so a count is never too high, and next to nothing of a page leaves its slice.

Articles are held against the articles of their host, other text against other text, so that a headline on an index page does not remove
itself from its article. Pages with equal text count as one. Where repeated runs cover more than COPIED of an article (or COPIED_OPEN of a
page without one, a paragraph of PARAGRAPH tokens among it), the page is a copy of others and stays whole. A passage that a few pages quote stays everywhere.

Null and empty pages have an empty text. A page without a host in its url belongs to the host "". Broken markup: an element that
is never closed ends with its parent; a stray end tag is ignored; a character reference that is none stays as it is. Repeated rows
and ids have a row each. A page of any length is one row and, beyond SLICE_BYTES, does not share a slice with more than the next ones.
Columns beside id, url and html are not read, so their names cannot clash; an empty table has no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.arrays import hash_runs, mixed, text_slices, words
from plumbline.llm.frames import bound_batches
from plumbline.sources.tables import materialize

# Tokens of a run that counts as long.
MIN_RUN = 8
# A run is boilerplate on this share of the host's distinct pages, and on so many pages.
SHARE = 0.5
MIN_PAGES = 3
# Bytes of text of one slice, and pages that it has at least where the host has them.
SLICE_BYTES = 1 << 20
SLICE_PAGES = 32
# A page of which boilerplate would cover more than this share is a copy of others and stays whole. Without an article, menus may be most of
# a page, so there a whole paragraph of so many tokens must be among it.
COPIED = 0.5
COPIED_OPEN = 0.8
PARAGRAPH = 20
# What articles and other text are told apart by, before the host.
ARTICLE, OTHER = "a ", "o "
# Numbers of boilerplate runs that are sent to all tasks; beyond that they meet the pages in a salted join.
SENT_RUNS = 1_000_000
SALTS = 16

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead "
    "tr ul".split()
)
NESTED = BLOCKS - frozenset("h1 h2 h3 h4 h5 h6 hr p li dd dt tr tbody thead tfoot".split())
RAW = frozenset("iframe math noembed noframes noscript script style svg template textarea title xmp".split())
DROPPED = frozenset("aside button dialog footer form head header menu nav search select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Class names and ids that mark what is not the article, each compared as a whole: has-sidebar or article-header mark nothing.
MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer gdpr header menu modal nav navbar navigation newsletter notice overlay pagination popup promo promoted related "
    "replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget "
    "author-comments comment-section comments-section main-menu main-nav main-navigation post-navigation reader-comments related-articles "
    "related-posts side-bar site-footer site-header site-nav site-navigation sponsored-content user-comments".split()
)
# With these a mark forms longer names that mark as well: newsletter-box, cookie-notice-bar.
SHAPES = frozenset("area bar box buttons container form icons links list message panel slot strip unit wrapper".split())
# What marks an element: its class, id or role, or a form, which may stand around a whole page; another name; or that it is not shown.
NAMED, BUILT, HIDDEN = 1, 2, 3

TAG_END = re.compile(r"""(?>[^>"']+|"[^"]*"|'[^']*')*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
UNSEEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)
COMMENT_END = re.compile("--!?>")
# Open elements that a start tag closes, and what may stand open inside these.
SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt")}
LOOSE = frozenset(("address", "div", "p"))


def marking(name: str) -> bool:
    """Whether a class name or id marks: as a whole, or as marks and shapes joined by hyphens."""
    parts = name.split("-")
    return name in MARKS or len(parts) > 1 and all(p in MARKS or p in SHAPES for p in parts) and not MARKS.isdisjoint(parts)


def marked(tag: str, attributes: str, in_article: bool) -> int:
    """HIDDEN, BUILT or NAMED if an element is none of the article by not being shown, by its own name, or by role, class or id; else 0.

    The header of an article holds its title and does not count.
    """
    if attributes and UNSEEN.search(attributes):
        return HIDDEN
    if tag in DROPPED and not (tag == "header" and in_article):
        return NAMED if tag == "form" else BUILT
    if "=" not in attributes or tag in ("html", "body", "article", "main"):
        return 0
    for name, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() in ("class", "id") and any(map(marking, value.replace("_", "-").split())) or name.lower() == "role" and value in ROLES:
            return NAMED
    return 0


def close_siblings(stack: list[tuple[str, bool, int, bool]], tag: str) -> None:
    """Close what the start of a block ends: an open p, and for li, dd and dt the one before in the same list."""
    if stack and stack[-1][0] == "p":
        stack.pop()
    if tag in SIBLINGS:
        k = len(stack) - 1
        while k >= 0 and stack[k][0] in LOOSE:
            k -= 1
        if k >= 0 and stack[k][0] in SIBLINGS[tag]:
            del stack[k:]


def blocks(page: str) -> list[tuple[str, bool, int, bool]]:
    """(text, in an article, mark as none of it, in an article that stands inside a marked element) of the blocks in page order.

    Raw text, comments, head and what is not shown are left out. A mark does not reach into an article or main element, but a name like aside does reach
    into an article.
    """
    found: list[tuple[str, bool, int, bool]] = []
    stack: list[tuple[str, bool, int, bool]] = []  # (tag, in an article, mark, in a marked element's article) of open elements
    inside, off, second, hidden = False, 0, False, False
    parts: list[str] = []

    def close() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            found.append((text, inside, off, second))

    at, end = 0, len(page)
    while at < end:
        tag_at = page.find("<", at)
        if tag_at < 0:
            tag_at = end
        if tag_at > at and not hidden:
            parts.append(entities.unescape(page[at:tag_at]))
        if tag_at == end:
            break
        if page.startswith("<!--", tag_at):
            stop = COMMENT_END.search(page, tag_at + 4)
            at = stop.end() if stop else end
            continue
        closing = page.startswith("/", tag_at + 1)
        name = NAME.match(page, tag_at + 1 + closing)
        if not name:
            if page[tag_at + 1:tag_at + 2] in ("!", "?", "/"):
                stop = page.find(">", tag_at)
                at = end if stop < 0 else stop + 1
            else:
                if not hidden:
                    parts.append("<")
                at = tag_at + 1
            continue
        tag = name[0].lower()
        rest = TAG_END.match(page, name.end())
        at = rest.end() if rest else (page.find(">", name.end()) + 1 or end)
        attributes = page[name.end():at - 1]
        if tag in BLOCKS:
            close()
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag in RAW:
            if not attributes.endswith("/"):
                stop = re.compile(f"</{re.escape(tag)}", re.IGNORECASE).search(page, at)
                stop = page.find(">", stop.end()) if stop else -1
                at = end if stop < 0 else stop + 1
            continue
        elif tag not in VOID:
            if tag in BLOCKS:
                close_siblings(stack, tag)
            bad = marked(tag, attributes, any(s[0] == "article" for s in stack))
            _, within, mark, nested = stack[-1] if stack else ("", False, 0, False)
            opens = not within and max(mark, bad) < HIDDEN and (tag == "main" or tag == "article" and mark < BUILT)
            # Inside a marked element those of its own name are followed too, so that their end tags do not end it.
            if bad or tag in NESTED or mark and any(s[0] == tag for s in stack):
                stack.append((tag, within or opens, 0 if opens else max(mark, bad), nested or opens and mark > 0))
        inside, off, second = stack[-1][1:] if stack else (False, 0, False)
        hidden = off == HIDDEN or any(s[0] == "head" for s in stack[:3])
    close()
    return found


def parsed(page: str) -> tuple[str | None, list[str], list[bool]]:
    """(text of the article, or None without one; the other blocks; whether each of these is marked)."""
    found = blocks(page)
    # Articles inside marked elements (comments may be such) are the text where there are no others.
    nested = not any(inside and not off and not second for _, inside, off, second in found)
    chosen = [inside and not off and second == nested for _, inside, off, second in found]
    article = [b[0] for b, own in zip(found, chosen, strict=True) if own]
    rest = [(b[0], b[1] or b[2] > 0) for b, own in zip(found, chosen, strict=True) if not own]
    return ("\n".join(article) if article else None), [t for t, _ in rest], [off for _, off in rest]


def parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, url, host, page): (id, url, host, no article?, the blocks to judge, other unmarked text, hashes of both).

    Texts are compressed page by page, as they are written once and shuffled once; blocks are lines.
    """
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        opens, texts = [], ([], [])
        for page in batch.column(3).to_pylist():
            article, rest, marks = parsed(page or "")
            other = "\n".join(t for t, off in zip(rest, marks, strict=True) if not off)
            opens.append(article is None)
            texts[0].append(other if article is None else article)
            texts[1].append("" if article is None else other)
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:3], pa.array(opens, pa.bool_()),
            *[pa.array([pack(t.encode()) if t else None for t in column], pa.binary()) for column in texts],
            *[pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in column], pa.int64()) for column in texts],
        ], ["_id", "_url", "host", "open", "kept", "other", "kept_hash", "other_hash"])


def run_hashes(tokens: np.ndarray) -> np.ndarray:
    """A hash of the MIN_RUN tokens from each position on."""
    value = np.zeros(max(len(tokens) - MIN_RUN + 1, 0), dtype=np.uint64)
    for k in range(MIN_RUN):
        value = mixed(value ^ tokens[k:k + len(value)])
    return value


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the order of their first MIN_RUN tokens, rank of each position); a run that goes over the end ranks by what is left."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    length = 1
    while length < MIN_RUN:
        behind = np.concatenate([rank[length:], np.zeros(min(length, len(rank)), dtype=np.int64)])[:len(rank)]
        rank = np.unique(rank * (len(rank) + 2) + behind, return_inverse=True)[1].astype(np.int64) + 1
        length *= 2
    return np.argsort(rank, kind="stable"), rank


def shared_runs(tokens: np.ndarray, page: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, pages) of the runs of MIN_RUN tokens that at least `least` pages have. `page` tells the page of each token."""
    if len(tokens) < MIN_RUN:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    order, rank = suffix_array(tokens)
    order = order[order + MIN_RUN <= len(tokens)]
    order = order[page[order] == page[order + MIN_RUN - 1]]
    # Equal runs are neighbours in the suffix array; by place, and so by page, among themselves.
    new = np.ones(len(order), dtype=bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    other_page = np.ones(len(order), dtype=bool)
    other_page[1:] = page[order[1:]] != page[order[:-1]]
    heads = np.flatnonzero(new)
    if not len(heads):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    pages = np.add.reduceat((new | other_page).astype(np.int64), heads)
    many = pages >= least
    return run_hashes(tokens)[order[heads[many]]], pages[many]


def slice_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(space, pages, runs, counts) of each slice, from rows (space, stream, compressed text) sorted by space and stream."""

    def told(space: str, texts: list[bytes]) -> pa.RecordBatch:
        least = max(2, int(np.ceil(SHARE / 2 * len(texts))))
        hashes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(texts) > 1:
            for _, data, offsets in text_slices(pa.array(texts, pa.large_binary()), limit=1 << 62):
                starts, ends, rows = words(data, offsets)
                hashes, counts = shared_runs(hash_runs(data, starts, ends), rows, least)
        return pa.RecordBatch.from_arrays([
            pa.array([space]), pa.array([len(texts)], pa.int64()), pa.array([hashes.view(np.int64)], pa.list_(pa.int64())),
            pa.array([counts], pa.list_(pa.int64())),
        ], ["space", "pages", "runs", "counts"])

    unpack = zstandard.ZstdDecompressor().decompress
    space, stream, texts, size = None, None, [], 0
    for batch in batches:
        for now, own, text in zip(*(batch.column(c).to_pylist() for c in ("space", "stream", "text")), strict=True):
            text = unpack(text)
            if texts and (now != space or size >= SLICE_BYTES and len(texts) >= SLICE_PAGES and own != stream):
                yield told(space, texts)
                texts, size, stream = [], 0, None
            if now != space or own != stream or not texts:  # equal texts of a host come together and count as one
                texts.append(text)
                size += len(text)
            space, stream = now, own
    if texts:
        yield told(space, texts)


def boilerplate(streams: DataFrame) -> DataFrame:
    """(space, runs): the boilerplate of each host, from (space, stream, compressed text)."""
    dealt = streams.repartitionByRange("space", "stream").sortWithinPartitions("space", "stream")
    told = materialize(dealt.select("space", "stream", "text").mapInArrow(
        slice_runs, "space string, pages bigint, runs array<bigint>, counts array<bigint>",
    ), "runs")
    totals = told.groupBy("space").agg(F.sum("pages").alias("n")).filter(F.col("n") >= MIN_PAGES)
    rows = told.select("space", F.inline(F.arrays_zip(F.col("runs").alias("run"), F.col("counts").alias("count"))))
    counted = rows.groupBy("space", "run").agg(F.sum("count").alias("count")).filter(F.col("count") >= MIN_PAGES)
    frequent = counted.join(totals, "space").filter(F.col("count") >= SHARE * F.col("n"))
    return frequent.groupBy("space").agg(F.collect_list("run").alias("runs"))


def left_over(whole: str, runs: np.ndarray, is_open: bool) -> str:
    """The text of a page without the blocks that its boilerplate covers from end to end."""
    data = np.frombuffer(whole.encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    value = run_hashes(hash_runs(data, starts, ends))
    at = np.flatnonzero(np.isin(value, runs))
    if not len(at):
        return whole
    step = np.bincount(at, minlength=len(starts) + MIN_RUN) - np.bincount(at + MIN_RUN, minlength=len(starts) + MIN_RUN)
    covered = np.cumsum(step)[:len(starts)] > 0
    kept = whole.split("\n")
    stops = np.cumsum([len(p.encode()) + 1 for p in kept])
    edges = np.searchsorted(starts, np.concatenate([[0], stops])).tolist()
    gone = [bool(covered[a:b].all()) for a, b in pairwise(edges)]
    longest = max((b - a for (a, b), out in zip(pairwise(edges), gone, strict=True) if out), default=0)
    if covered.mean() > (COPIED_OPEN if is_open else COPIED) and (longest >= PARAGRAPH or not is_open):
        return whole
    return "\n".join(p for p, out in zip(kept, gone, strict=True) if not out)


def uncovered(known: dict[str, np.ndarray] | None):
    """(id, url, text) of pages; their boilerplate is looked up by space, or comes with them as `runs`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = []
            spaces, kept, opens = (batch.column(c).to_pylist() for c in ("space", "kept", "open"))
            for row, (space, packed, is_open) in enumerate(zip(spaces, kept, opens, strict=True)):
                text = unpack(packed).decode() if packed else ""
                if known is None:
                    own = batch.column("runs")[row]
                    runs = own.values.to_numpy().view(np.uint64) if own.is_valid else None
                else:
                    runs = known.get(space)
                texts.append(text if runs is None else left_over(text, runs, is_open))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())], ["_id", "_url", "text"])

    return cut


def extract(pages: DataFrame, *, id_col: str = "page_id", url: str = "url", html: str = "html", sent_runs: int = SENT_RUNS) -> DataFrame:
    """One row per page: the id, url, text, n_chars.

    Pages are parsed once and written to the shared folder as blocks. Their text is dealt to the slices of its host once; what comes back
    to the pages is the boilerplate of each host.
    """
    bound_batches(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    source = pages.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"), host.alias("host"), F.col(html).alias("_html"))
    kinds = [T.StructField(n, source.schema[n].dataType) for n in ("_id", "_url")]
    columns = [("host", T.StringType()), ("open", T.BooleanType()), ("kept", T.BinaryType()), ("other", T.BinaryType())]
    columns += [("kept_hash", T.LongType()), ("other_hash", T.LongType())]
    schema = T.StructType([*kinds, *[T.StructField(*c) for c in columns]])
    cut = materialize(source.mapInArrow(parse_pages, schema), "blocks")

    # Articles are held against articles, other text against other text.
    space = F.concat(F.when(F.col("open"), F.lit(OTHER)).otherwise(F.lit(ARTICLE)), "host")
    told = F.array(
        F.struct(space.alias("space"), F.col("kept_hash").alias("stream"), F.col("kept").alias("text")),
        F.struct(F.concat(F.lit(OTHER), "host").alias("space"), F.col("other_hash").alias("stream"), F.col("other").alias("text")),
    )
    found = materialize(boilerplate(cut.select(F.inline(told)).filter("text IS NOT NULL")), "boilerplate")
    rows = cut.select("_id", "_url", space.alias("space"), "open", "kept")
    if (found.agg(F.sum(F.size("runs") + 10)).first()[0] or 0) <= sent_runs:
        known = {r["space"]: np.array(r["runs"], np.int64).view(np.uint64) for r in found.collect()}  # at most sent_runs numbers
    else:
        known, salt = None, F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)).cast("int")
        spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", salt).join(spread, ["space", "salt"], "left")
    text = rows.mapInArrow(uncovered(known), T.StructType([*kinds, T.StructField("text", T.StringType())]))
    return text.select(F.col("_id").alias(id_col), F.col("_url").alias(url), "text", F.char_length("text").cast("bigint").alias("n_chars"))
